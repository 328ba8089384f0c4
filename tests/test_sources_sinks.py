"""Parquet folder source, smoke subset, missing input, CSV and parquet sinks."""

import csv
import glob
import os
from datetime import date

import pytest

from pyspark.sql import functions as F

from firmdyn.operators import firm_markup
from firmdyn.plans.outcomes import prepare, run_windows
from firmdyn.plans.queries import present
from firmdyn.schema import FIRM, FIRM_KEY, LongDiffSpec, PRESHOCK, TREATMENT
from firmdyn.session import run_folder
from firmdyn.sources import load_panel, panel_count, panel_files
from firmdyn.sources.sinks import outcome_path, write_firm_panel
from tests import micro_panels as M
from tests.helpers import assert_matches, raw_schema
from tests.test_plans import plan


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("input with space")
    raw = spark.createDataFrame(M.EDGE_PANEL, raw_schema())
    parts = [raw.where(f"year = {y}") for y in (2012, 2013)] + [raw.where("year not in (2012, 2013)")]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(str(root / f"tmp{i}"))
        (src,) = glob.glob(str(root / f"tmp{i}" / "*.parquet"))
        os.link(src, root / f"part {i}.parquet")
    (root / "notes.txt").write_text("not parquet")
    return str(root), [p.count() for p in parts]


def test_reads_every_parquet_file(spark, folder):
    path, counts = folder
    panel = load_panel(spark, path)
    assert panel_count(panel).first().n_rows == sum(counts)
    assert "_country_" in panel.columns


def test_first_file_only(spark, folder):
    path, counts = folder
    panel = load_panel(spark, path, first_file_only=True)
    assert panel.count() == counts[0]
    assert {r.year for r in panel.select("year").distinct().collect()} == {2012}


def test_missing_input_names_the_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No parquet files found"):
        load_panel(spark, str(tmp_path / "absent"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError, match=str(tmp_path / "empty")):
        load_panel(spark, str(tmp_path / "empty"))


def test_run_windows_writes_every_output(spark, folder, tmp_path):
    path, _ = folder
    panel = load_panel(spark, path)
    out = str(tmp_path / "out")
    results = run_windows(panel, save=True, out_dir=out)
    names = ["industry_markup_decomp", "industry_op_covariance", "industry_dispersion",
             "industry_concentration"]
    for name in names:
        (f,) = glob.glob(os.path.join(out, f"{name}.csv", "*.csv"))
        with open(f) as fh:
            header = next(csv.reader(fh))
        family = name.removeprefix("industry_")
        assert header == results[TREATMENT][family].columns
        assert glob.glob(os.path.join(out, "block2", f"{name}_2010base.csv", "*.csv"))
    firm = spark.read.parquet(os.path.join(out, "firm_panel_markup"))
    assert {"markup", "share", "_country_", "total_assets"} <= set(firm.columns)
    assert not os.path.exists(os.path.join(out, "block2", "firm_panel_markup"))
    assert set(results) == {TREATMENT, PRESHOCK}


def read_csv(path):
    (f,) = glob.glob(os.path.join(path, "*.csv"))
    with open(f) as fh:
        return list(csv.reader(fh))


def test_csv_holds_the_values_and_nulls_of_both_windows(spark, folder, tmp_path):
    path, _ = folder
    out = str(tmp_path / "values")
    results = run_windows(load_panel(spark, path), save=True, out_dir=out)
    seen_null = False
    for spec, tables in results.items():
        for family, df in tables.items():
            header, *rows = read_csv(outcome_path(out, family, spec))
            assert header == df.columns and (spec != PRESHOCK or all("_2010_" in c for c in header[2:]))
            want = sorted(["" if v is None else str(v) for v in r] for r in df.collect())
            assert [[*r[:2]] for r in sorted(rows)] == [[*r[:2]] for r in want]
            for got, exp in zip(sorted(rows), want):
                for a, b in zip(got[2:], exp[2:]):
                    assert (a == b == "") or float(a) == pytest.approx(float(b))
                    seen_null |= a == ""
    assert seen_null


def test_two_windows_with_one_base_year_are_both_saved(spark, folder, tmp_path):
    path, _ = folder
    panel, out = load_panel(spark, path), str(tmp_path / "same base")
    specs = [LongDiffSpec(2010, (2013,)), LongDiffSpec(2010, (2014,)), PRESHOCK]
    results = run_windows(panel, specs, save=True, out_dir=out)
    for spec in specs:
        for family, df in results[spec].items():
            assert read_csv(outcome_path(out, family, spec))[0] == df.columns
    with pytest.raises(ValueError, match="one path"):
        run_windows(panel, [specs[0], specs[0]], save=True, out_dir=out)


def test_other_reader_errors_are_passed_on(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("no parquet at all")
    with pytest.raises(Exception) as caught:
        load_panel(spark, str(tmp_path))
    assert not isinstance(caught.value, FileNotFoundError)


def test_long_customer_keys_stay_distinct_firms(spark, tmp_path):
    import duckdb

    from firmdyn.plans.naive_sql import DRIVER_PANEL_SQL
    from firmdyn.sources import derived_panel

    keys = [1, 123456789, 1234567890, 1234567891, 123456789012]
    tables = {
        "customer": ([(k, 7, "BUILDING") for k in keys], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": ([(i, k) for i, k in enumerate(keys)], "o_orderkey long, o_custkey long"),
        "part": ([(1, 10.0)], "p_partkey long, p_retailprice double"),
        "lineitem": ([(i, 1, 2.0, 100.0, 0.1, 0.05, "N", "O", date(1998, 3, 4)) for i in range(len(keys))],
                     "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")}
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
        con.register(name, df.toPandas())
    got = sorted(r.bvd_id for r in derived_panel(spark, str(tmp_path)).collect())
    assert got == sorted(f"07{k:09d}" for k in keys)
    assert got == sorted(r[0] for r in con.execute(DRIVER_PANEL_SQL).fetchall())


def test_empty_outcome_still_has_a_header(spark, tmp_path):
    from firmdyn.operators import turbulence
    from firmdyn.sources.sinks import write_outcome_csv
    from tests.helpers import to_spark

    df = turbulence(to_spark(spark, M.NO_SURVIVOR_2013))
    write_outcome_csv(df, str(tmp_path / "t"))
    (f,) = glob.glob(str(tmp_path / "t" / "*.csv"))
    assert open(f).read().strip().split(",")[0] == "fic_code"


def test_command_line(spark, folder, tmp_path, capsys):
    from firmdyn.__main__ import main

    path, counts = folder
    assert main([path, str(tmp_path / "cli"), "--window", "preshock", "--smoke"]) == 0
    out = capsys.readouterr().out
    assert f"firm-year rows: {counts[0]:,}" in out
    assert glob.glob(str(tmp_path / "cli" / "block2" / "industry_op_covariance_2010base.csv" / "*.csv"))


def test_command_line_without_saving(spark, folder, tmp_path, capsys):
    from firmdyn.__main__ import main

    path, _ = folder
    out_dir = tmp_path / "nothing"
    assert main([path, str(out_dir), "--window", "treatment", "--no-save"]) == 0
    out = capsys.readouterr().out
    assert "op_covariance 2012:" in out and "written to" not in out
    assert not out_dir.exists()


@pytest.mark.parametrize("folder_name", ["plain", "x[1] a+b%20"])
def test_first_file_whatever_its_name(spark, tmp_path, folder_name):
    """Names with characters of patterns and of encoded paths; the first in the folder's order."""
    root = tmp_path / folder_name
    root.mkdir()
    names = ["part[0] +%.parquet", "part!.parquet", "part*.parquet", "part é.parquet", "part{a,b}.parquet"]
    raw = spark.createDataFrame(M.EDGE_PANEL, raw_schema()).orderBy("bvd_id").limit(len(names)).collect()
    for i, name in enumerate(names):
        spark.createDataFrame([raw[i]], raw_schema()).withColumn("nth", F.lit(i)).coalesce(1).write.parquet(str(tmp_path / f"t{i}"))
        (src,) = glob.glob(str(tmp_path / f"t{i}" / "*.parquet"))
        os.link(src, root / name)
    path = str(root).replace("[", "\\[").replace("]", "\\]")
    assert {r.nth for r in load_panel(spark, path).collect()} == set(range(len(names)))
    first = names.index(min(names))
    assert [r.nth for r in load_panel(spark, path, first_file_only=True).collect()] == [first]
    files = panel_files(spark.read.parquet(path)).collect()
    assert sorted(r.file_name for r in files) == sorted(names) and {r.n_rows for r in files} == {1}


def test_first_file_without_rows(spark, tmp_path):
    for n, name in ((0, "a.parquet"), (1, "b.parquet")):
        spark.createDataFrame(M.EDGE_PANEL[:n], raw_schema()).coalesce(1).write.parquet(str(tmp_path / f"t{n}"))
        (src,) = glob.glob(str(tmp_path / f"t{n}" / "*.parquet"))
        (tmp_path / "folder").mkdir(exist_ok=True)
        os.link(src, tmp_path / "folder" / name)
    assert load_panel(spark, str(tmp_path / "folder"), first_file_only=True).count() == 0
    assert load_panel(spark, str(tmp_path / "folder")).count() == 1


def test_run_tables_are_deleted_after_their_last_reader(spark, sf0001_panel):
    """Tables of firms go with the run's last job, tables of industries when the result is closed."""
    def folders():
        return set(os.listdir(run_folder(spark).removeprefix("file://").removeprefix("file:")))

    before = folders()
    with prepare(sf0001_panel, [TREATMENT, PRESHOCK]) as shared:
        left = folders() - before
        assert left == {os.path.basename(p) for p in shared.tables.paths}
        for table in shared.tables.paths.values():  # none is by firm
            assert FIRM not in table.columns and not any(c.startswith("sal_") for c in table.columns)
        assert all(df.count() for tables in shared.outcomes.values() for df in tables.values())
    assert folders() == before


def test_a_failed_run_leaves_no_table(spark, sf0001_panel, tmp_path):
    def folders():
        return set(os.listdir(run_folder(spark).removeprefix("file://").removeprefix("file:")))

    before = folders()
    broken = sf0001_panel.withColumn("sales", F.when(F.col("year") == 2013, F.raise_error(F.lit("broken")).cast("double"))
                                     .otherwise(F.col("sales")))
    with pytest.raises(Exception, match="broken"):
        prepare(broken, [TREATMENT])
    assert folders() == before
    (tmp_path / "taken").write_text("a file where the folder of the outputs should be")
    with pytest.raises(Exception):
        run_windows(sf0001_panel, [TREATMENT], save=True, out_dir=str(tmp_path / "taken"))
    assert folders() == before


def test_saving_reads_the_panel_once_more(spark, folder, tmp_path, monkeypatch):
    """The sink takes its totals from the run: its plan scans the panel once and sums nothing."""
    from firmdyn.plans import outcomes

    path, _ = folder
    panel, seen = load_panel(spark, path), []
    monkeypatch.setattr(outcomes, "write_firm_panel", lambda df, *_: seen.append(df))
    run_windows(panel, [TREATMENT], save=True, out_dir=str(tmp_path / "out"))
    text = plan(seen[0])
    assert text.count("Location: InMemoryFileIndex") == 2 and "HashAggregate" not in text and "Window" not in text
    scans = [x for x in text.splitlines() if x.startswith("Location") and "input%20with%20space" in x or "input with space" in x]
    assert len(scans) == 1
    got = sorted(map(str, seen[0].collect()))
    assert got == sorted(map(str, firm_markup(panel).select(*seen[0].columns).collect()))


def test_firm_panel_dealt_by_firm(spark, sf0001_panel, tmp_path):
    path = str(tmp_path / "dealt")
    write_firm_panel(sf0001_panel, path, 3)
    back = spark.read.parquet(path)
    assert back.count() == sf0001_panel.count()
    files = back.select(*FIRM_KEY, F.input_file_name().alias("f")).distinct().groupBy(*FIRM_KEY).count()
    assert files.where("count > 1").count() == 0  # a firm lies in one file
    with pytest.raises(ValueError):
        write_firm_panel(sf0001_panel, path, table="needs_buckets")


def test_bucketed_firm_panel_needs_no_shuffle(spark, sf0001_panel, tmp_path):
    from firmdyn.plans.outcomes import firm_pivot

    spark.sql("DROP TABLE IF EXISTS firm_panel_buckets")
    write_firm_panel(sf0001_panel, str(tmp_path / "buckets"), 4, "firm_panel_buckets")
    pivot = firm_pivot(spark.table("firm_panel_buckets"), TREATMENT.years)
    assert "hashpartitioning" not in plan(pivot) and "Exchange" not in plan(pivot)
    want = firm_pivot(sf0001_panel, TREATMENT.years)
    order = ["bvd_id", "sic"]
    assert_matches(present(pivot).orderBy(*order).toPandas(), present(want).orderBy(*order).toPandas())
    spark.sql("DROP TABLE firm_panel_buckets")


def test_launcher_starts_from_another_folder(tmp_path):
    import subprocess
    import sys

    from tests.conftest import ROOT

    done = subprocess.run([sys.executable, os.path.join(ROOT, "run_firmdyn.py"), "--help"], cwd=tmp_path,
                          capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0 and "--smoke" in done.stdout

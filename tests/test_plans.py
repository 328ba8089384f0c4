"""Physical plans: no Python in the hot path, aggregates instead of windows, the
partial top-4 limit before the shuffle, pushdown and pruning into the scan."""

import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from firmdyn import operators as O
from firmdyn.operators.concentration import sales_pivot
from firmdyn.operators.dispersion import industry_year_stats
from firmdyn.operators.markup import markup_pivot
from firmdyn.plans.outcomes import prepare
from firmdyn.plans.queries import PANEL_QUERIES, QUERIES, present
from firmdyn.schema import PANEL_COLUMNS, PRESHOCK, TREATMENT
from firmdyn.session import run_folder
from firmdyn.sources import load_panel
from tests.conftest import SF0001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF")


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def parquet_panel(spark, sf0001_panel, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("panel") / "files")
    sf0001_panel.drop("_country_").write.parquet(path)
    return load_panel(spark, path)


def test_by_year_aggregates_have_no_window(sf0001_panel):
    for df in (O.opcov_by_year(sf0001_panel), O.dispersion_by_year(sf0001_panel)):
        text = plan(df)
        assert "Window" not in text and "HashAggregate" in text


def test_top4_limit_runs_before_the_shuffle(parquet_panel):
    text = plan(O.top_sales_by_year(parquet_panel))
    assert text.count("WindowGroupLimit") >= 2
    physical = text.split("\n\n")[0]
    # the partial limit sits below (is printed after) the exchange
    ex, lim = physical.rfind("Exchange"), physical.rfind("WindowGroupLimit")
    assert lim > ex


def test_last_exchange_of_the_top4_does_not_grow_with_the_map_tasks(spark, parquet_panel):
    """Two levels: 256 map tasks are dealt to 16 groups, and each sends four rows a cell on."""
    from firmdyn.operators.concentration import TOP_SALTS, largest
    from firmdyn.schema import CELL_YEAR, SALES, TOP_K

    rows = parquet_panel.where("sales > 0").select(*CELL_YEAR, SALES).repartition(256)
    text = plan(largest(rows, F.col(SALES), TOP_K))
    keys = [x for x in exchanges(text) if "_country_" in x]
    assert len(keys) == 2 and "_salt" in keys[0] and "_salt" not in keys[1]
    assert text.count("WindowGroupLimit") >= 4  # before and after each exchange
    dealt = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(TOP_SALTS)))
    cells = rows.select(*CELL_YEAR).distinct().count()
    groups = dealt.groupBy(*CELL_YEAR, "_salt").count().select(F.sum(F.least("count", F.lit(TOP_K)))).first()[0]
    assert groups <= TOP_K * cells * TOP_SALTS


def test_filters_and_columns_reach_the_scan(parquet_panel):
    text = plan(O.opcov_by_year(parquet_panel))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    for f in ("IsNotNull(number_of_employees)", "IsNotNull(sales)",
              "GreaterThan(number_of_employees,0.0)", "GreaterThan(sales,0.0)"):
        assert f in pushed
    schema = [line for line in text.splitlines() if "ReadSchema" in line][0]
    assert "costs_of_goods_sold" not in schema and "total_assets" not in schema


def read_schemas(text: str) -> list[str]:
    return [x for x in text.splitlines() if x.startswith("ReadSchema")]


def exchanges(text: str) -> list[str]:
    return [x for x in text.splitlines() if x.startswith("Arguments: hashpartitioning")]


def test_sales_pivot_reads_only_needed_columns(parquet_panel):
    text = plan(sales_pivot(parquet_panel, TREATMENT.years))
    (schema,) = read_schemas(text)
    assert "sales" in schema
    assert not any(c in schema for c in ("costs_of_goods_sold", "number_of_employees", "total_assets"))
    assert len(exchanges(text)) == 1 and "partial_" in text


def test_statistics_read_the_window_years_only(parquet_panel):
    text = plan(industry_year_stats(parquet_panel.where("year in (2012, 2013)")))
    (pushed,) = [x for x in text.splitlines() if x.startswith("PushedFilters")]
    assert "In(year, [2012,2013])" in pushed


@pytest.mark.parametrize("name", ["opcov_by_year", "panel_count", "firm_panel"])
def test_single_scan_queries_read_the_driver_tables(spark, name):
    before = len(os.listdir(local(run_folder(spark))))
    text = plan(QUERIES[name](spark, SF0001))
    assert len(os.listdir(local(run_folder(spark)))) == before  # nothing was written
    assert len(read_schemas(text)) == 4 and "ExistingRDD" not in text
    (lines,) = [x for x in read_schemas(text) if "l_orderkey" in x]
    assert "l_comment" not in lines and "l_shipmode" not in lines
    if name == "opcov_by_year":
        assert "l_tax" not in lines and "l_returnflag" not in lines


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def test_share_join_is_broadcast(sf0001_panel):
    text = plan(O.firm_markup(sf0001_panel))
    assert "BroadcastHashJoin" in text and "Window" not in text


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_share_join_without_broadcast_keeps_null_keys(spark, no_auto_broadcast):
    from tests import micro_panels as M
    from tests.helpers import to_spark

    panel = to_spark(spark, M.EDGE_PANEL)
    df = O.firm_markup(panel, max_bytes=0)
    assert "BroadcastHashJoin" not in plan(df) and "SortMergeJoin" in plan(df)
    assert "BroadcastHashJoin" in plan(O.firm_markup(panel))
    assert df.where("bvd_id is null").count() == 3


@pytest.mark.parametrize("outcome", ["turbulence", "concentration", "run"])
def test_both_join_strategies_agree(spark, no_auto_broadcast, outcome):
    from tests import micro_panels as M
    from tests.helpers import assert_matches, to_spark

    panel = to_spark(spark, M.EDGE_PANEL)
    of = {"turbulence": lambda n: O.turbulence(panel, max_bytes=n),
          "concentration": lambda n: O.concentration(panel, max_bytes=n),
          "run": lambda n: prepare(panel, [TREATMENT], max_bytes=n).outcomes[TREATMENT]["concentration"]}[outcome]
    assert_matches(present(of(0)).toPandas(), present(of(None)).toPandas())


def test_markup_pivot_has_no_join_and_one_exchange(parquet_panel):
    pivot = markup_pivot(O.markup_sample(parquet_panel), TREATMENT.years)
    text = plan(pivot)
    assert len(exchanges(text)) == 1 and "hashpartitioning(bvd_id" in exchanges(text)[0]
    (schema,) = read_schemas(text)
    assert "total_assets" not in schema and "number_of_employees" not in schema
    both = plan(O.decomposition_sums(pivot, [TREATMENT]))
    assert len(exchanges(both)) == 2
    for t in (text, both):
        assert "Join" not in t and not any(node in t for node in PYTHON_NODES)


def test_repeated_firm_years_are_read_once_for_all_windows(spark, tmp_path):
    """No outcome of a run scans the panel, also when firms have several values in a year."""
    from tests import micro_panels as M
    from tests.helpers import raw_schema

    rows = spark.createDataFrame(M.EDGE_PANEL, raw_schema())
    again = rows.where("sales > 0").withColumn("sales", F.col("sales") * 1.5)
    path = str(tmp_path / "twice")
    rows.unionByName(again).write.parquet(path)
    shared = prepare(load_panel(spark, path), [TREATMENT, PRESHOCK])
    for tables in shared.outcomes.values():
        for df in tables.values():
            text = plan(df)
            assert path not in text and "Window" not in text and "Scan parquet" in text


def test_firm_pivot_is_one_shuffle_keyed_on_the_firm(parquet_panel):
    from firmdyn.operators.pairs import window_years
    from firmdyn.plans.outcomes import firm_pivot
    from firmdyn.schema import PRESHOCK

    years = window_years([TREATMENT, PRESHOCK])
    text = plan(firm_pivot(parquet_panel.select(*PANEL_COLUMNS), years))
    exchanges = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert len(exchanges) == 1 and "hashpartitioning(bvd_id" in exchanges[0]
    assert "partial_" in text  # map-side partial aggregation before the exchange
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "In(year" in pushed and "GreaterThan(sales,0.0)" in pushed

"""Firm-year panels.

``load_panel`` reads a folder of parquet files (the production input);
``derived_panel`` builds the same layout from the TPC-H-style driver tables, which
is what the tests and benches run on.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmdyn.functions import country_of, sic2
from firmdyn.schema import COGS, COUNTRY, EMPLOYEES, ASSETS, FIRM, INDUSTRY, SALES, YEAR


def prepare_panel(df: DataFrame) -> DataFrame:
    """Add the country (first two characters of the firm id) and cut the industry
    code to two characters, in place. All other columns are kept."""
    return df.withColumn(COUNTRY, country_of(FIRM)).withColumn(INDUSTRY, sic2(INDUSTRY))


# What the reader reports for a missing folder and for one without files.
NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_panel(spark: SparkSession, path: str, first_file_only: bool = False) -> DataFrame:
    """Read every ``*.parquet`` file directly inside ``path`` as one panel.

    ``first_file_only`` reads only the first file in name order (a smoke run), which may hold no rows.
    It is chosen by its location as Spark reports it for the same scan, so a name may hold any character (a
    location that is read as a path again would be taken for a pattern). A folder with no parquet
    file raises ``FileNotFoundError``; any other error of the reader is passed on.
    """
    try:
        panel = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
        if first_file_only:
            first = min(panel.inputFiles(), key=lambda location: unquote(location.rsplit("/", 1)[-1]))
            # local files: file:/// in the listing, file:/ in the scan
            location = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
            panel = panel.where(location == re.sub("^file:/+", "file:/", first))
        return prepare_panel(panel)
    except AnalysisException as exc:
        if exc.getCondition() in NO_FILES:
            raise FileNotFoundError(f"No parquet files found in {path}/") from exc
        raise


def panel_files(scan: DataFrame) -> DataFrame:
    """(location, file_name, n_rows) of the files of a scan that have rows. ``location`` is the
    encoded one that the scan compares, ``file_name`` the name as the folder lists it. Counts come
    from the files' footers: no column is read."""
    plain = F.url_decode(F.replace(F.element_at(F.split("location", "/"), -1), F.lit("+"), F.lit("%2B")))
    files = scan.select(F.col("_metadata.file_path").alias("location")).groupBy("location").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return files.select("location", plain.alias("file_name"), "n_rows")


def panel_count(df: DataFrame) -> DataFrame:
    """Number of firm-year rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded(key: str, width: int) -> Column:
    """A key as text with leading zeros up to ``width``; a longer key stays whole."""
    text = F.col(key).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


# Market segment -> four-digit industry code of the derived panel.
SEGMENT_SIC = {
    "AUTOMOBILE": 3711,
    "BUILDING": 1520,
    "FURNITURE": 2510,
    "MACHINERY": 3500,
    "HOUSEHOLD": 3630,
}
# Fixed value: line items of 1995-2001 become panel years 2009-2015.
YEAR_SHIFT = 14


def derived_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm-year panel from the driver tables: firm = customer, country = nation key,
    industry = market segment, year = ship year + 14.

    Plan: line items are joined to their order and part and summed per (customer, year)
    before the customer join (partial aggregation keeps the line-item rows out of the
    last shuffle). Customer keys are unique, so that is the grouping of the panel
    definition. Small dimension tables are broadcast by the planner's size estimate,
    large ones are shuffle-joined.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
        (F.year("l_shipdate") + F.lit(YEAR_SHIFT)).alias(YEAR),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")

    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey)
               .join(part, li.l_partkey == part.p_partkey))
    per_customer = lines.groupBy("o_custkey", YEAR).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias(SALES),
        F.sum(F.when(F.col("l_returnflag") != "R",
                     F.col("l_quantity") * F.col("p_retailprice"))).alias(COGS),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias(EMPLOYEES),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias(ASSETS),
    )
    segment = F.col("c_mktsegment")
    sic = None
    for name, code in SEGMENT_SIC.items():
        sic = F.when(segment == name, code) if sic is None else sic.when(segment == name, code)
    return per_customer.join(customer, per_customer.o_custkey == customer.c_custkey).select(
        F.concat(padded("c_nationkey", 2), padded("c_custkey", 9)).alias(FIRM),
        sic.alias(INDUSTRY),
        F.col(YEAR), F.col(SALES), F.col(COGS), F.col(EMPLOYEES), F.col(ASSETS),
    )

"""Shared test helpers: micro panels to Spark and DuckDB, result comparison."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType)

from firmdyn.plans import naive_sql
from firmdyn.plans.queries import PANEL_QUERIES, present
from firmdyn.sources import prepare_panel
from tools.check_oracle import compare

MEASURE_FIELDS = [StructField(c, DoubleType(), True) for c in
                  ("sales", "costs_of_goods_sold", "number_of_employees", "total_assets")]


def raw_schema(sic_type=IntegerType()) -> StructType:
    return StructType([StructField("bvd_id", StringType(), True),
                       StructField("sic", sic_type, True),
                       StructField("year", IntegerType(), False), *MEASURE_FIELDS])


def to_spark(spark: SparkSession, rows, sic_type=IntegerType()) -> DataFrame:
    return prepare_panel(spark.createDataFrame(rows, raw_schema(sic_type)))


def to_duck(rows, sic_type=IntegerType()) -> duckdb.DuckDBPyConnection:
    cols = ["bvd_id", "sic", "year", "sales", "costs_of_goods_sold",
            "number_of_employees", "total_assets"]
    df = pd.DataFrame(rows, columns=cols)
    df["year"] = df["year"].astype("int32")
    for c in cols[3:]:
        df[c] = df[c].astype("float64")
    if isinstance(sic_type, IntegerType):
        df["sic"] = df["sic"].astype("Int32")
    elif isinstance(sic_type, DoubleType):
        df["sic"] = df["sic"].astype("float64")
    else:
        df["sic"] = df["sic"].astype("object")
    con = duckdb.connect()
    con.register("micro_df", df)
    con.execute("create view micro as select * from micro_df")
    return con


def spark_result(panel: DataFrame, name: str) -> pd.DataFrame:
    return present(PANEL_QUERIES[name](panel)).toPandas()


def oracle_result(con: duckdb.DuckDBPyConnection, name: str) -> pd.DataFrame:
    sql = naive_sql.queries("select * from micro", dialect="duckdb")[name]
    return con.execute(sql).df()


def assert_matches(got: pd.DataFrame, want: pd.DataFrame) -> None:
    verdict = compare(got, want)
    assert verdict == "ok", verdict

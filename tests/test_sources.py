"""Sources and sinks: read by suffix, staging counts, dynamic month overwrite, JSON reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from branchbook.sources.warehouse import (
    RAW_SCHEMA, new_root, raw_to_fact, read_table, stage, with_ingest_order, write_fact_months, write_report,
)

RAW_ROWS = [
    ("31.03.95", 1, "a", Decimal("1.000"), 1, Decimal("10.00"), 1, "1995_3", "B2B"),
    ("31.03.95", 1, "a", Decimal("1.000"), 1, Decimal("10.00"), 1, "1995_3", "B2B"),
    ("04.11.01", 2, "b", Decimal("2.000"), 2, Decimal("20.00"), 2, "2001_11", "B2C"),
]


def test_read_by_suffix_and_unsupported(spark):
    root = new_root(spark, "test_sources")
    df = spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)
    df.write.option("header", True).csv(f"{root}/ops.csv")
    df.write.parquet(f"{root}/ops.parquet")
    assert read_table(spark, f"{root}/ops.csv", RAW_SCHEMA).count() == 3
    assert read_table(spark, f"{root}/ops.parquet").count() == 3
    with pytest.raises(ValueError, match="Unsupported"):
        read_table(spark, f"{root}/ops.xlsx")


def test_stage_counts_and_dedups(spark):
    root = new_root(spark, "test_sources")
    counts = stage(spark.createDataFrame(RAW_ROWS, RAW_SCHEMA), f"{root}/stg")
    assert counts == {"rows_in": 3, "rows_staged": 2}
    f = raw_to_fact(spark.read.parquet(f"{root}/stg"))
    assert {r.operation_date for r in f.collect()} == {dt.date(1995, 3, 31), dt.date(2001, 11, 4)}


def test_dynamic_overwrite_replaces_only_touched_months(spark):
    root = new_root(spark, "test_sources")
    f = raw_to_fact(spark.createDataFrame(RAW_ROWS[1:], RAW_SCHEMA))
    write_fact_months(f, f"{root}/fact")
    changed = f.filter(F.col("period") == "2001_11").withColumn("summa", F.lit(Decimal("99.00")).cast("decimal(18,2)"))
    write_fact_months(changed, f"{root}/fact")
    got = {r.period: r.summa for r in spark.read.parquet(f"{root}/fact").collect()}
    assert got == {"1995_3": Decimal("10.00"), "2001_11": Decimal("99.00")}


def test_ingest_order_and_json_report(spark):
    root = new_root(spark, "test_sources")
    spark.createDataFrame(RAW_ROWS, RAW_SCHEMA).coalesce(1).write.parquet(f"{root}/landed.parquet")
    d = with_ingest_order(read_table(spark, f"{root}/landed.parquet"))
    seq = [r.ingest_seq for r in d.orderBy("ingest_file", "ingest_seq").collect()]
    assert seq == sorted(seq) and len(set(seq)) == 3
    write_report(spark.createDataFrame([("rows", 3)], "k string, v int"), f"{root}/report")
    assert spark.read.json(f"{root}/report").first().v == 3


def test_monthly_load_keeps_the_earliest_physical_row_per_key(spark):
    from branchbook.sources.warehouse import monthly_load

    root = new_root(spark, "test_sources")
    rows = [
        ("01.01.01", 1, "a", Decimal("1.000"), 1, Decimal("30.00"), 1, "2001_1", "B2B"),  # lands first
        ("01.01.01", 1, "a", Decimal("1.000"), 1, Decimal("10.00"), 1, "2001_1", "B2B"),
    ]
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.parquet(f"{root}/landed.parquet")
    landed = with_ingest_order(read_table(spark, f"{root}/landed.parquet"))
    branches = spark.createDataFrame([(1, "B1")], "filial_id int, filial_name string")
    products = spark.createDataFrame([(1, "a", "P", "S", "DOM")],
                                     "inc_gk bigint, inc_name string, product string, subcategory string, direction string")
    monthly_load(spark, f"{root}/wh", landed, branches, products, dt.date(2001, 1, 2),
                 dt.datetime(2001, 1, 2, 6, 0), min_rows=1)
    fact = spark.read.parquet(f"{root}/wh/fact_operations").collect()
    assert len(fact) == 1 and fact[0].summa == Decimal("30.00")

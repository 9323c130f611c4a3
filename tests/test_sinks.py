"""Sinks: aggregate CSV, dead-letter CSV, partitioned table, sink choice and URIs."""

from __future__ import annotations

import glob
import os

import pytest

from daybook.sinks.files import (
    read_aggregates_csv,
    read_dead_letters_csv,
    write_aggregates_csv,
    write_dead_letters_csv,
)
from daybook.sinks.table import aggregate_sink, parse_table_uri, write_partitioned, write_table

AGG = [("2023-10-01", "ProjectA", 2, 160.0), ("2023-10-02", "", 1, 1.0000000001e7)]
AGG_SCHEMA = "Date string, ProjectId string, NumberOfTransactions bigint, TotalVolumeUsd double"


def _lines(folder):
    out = []
    for f in sorted(glob.glob(os.path.join(folder, "part-*"))):
        with open(f) as fh:
            out.extend(fh.read().splitlines())
    return out


def test_aggregate_csv_round_trip(spark, workdir):
    out = os.path.join(workdir, "agg")
    write_aggregates_csv(spark.createDataFrame(AGG, AGG_SCHEMA).coalesce(1), out)
    lines = _lines(out)
    assert lines[0] == "Date,ProjectId,NumberOfTransactions,TotalVolumeUsd"
    assert sorted(tuple(r) for r in read_aggregates_csv(spark, out).collect()) == sorted(AGG)


def test_dead_letter_csv_has_no_header_and_escapes_quotes(spark, workdir):
    rows = [("invalid JSON format in Nums field: x", "2023-10-01 12:00:00", "P", "", '{"a": "b"}', "invalid-json")]
    df = spark.createDataFrame(rows, "Reason string, ts string, project_id string, event string, props string, "
                                     "nums string")
    out = os.path.join(workdir, "dead")
    write_dead_letters_csv(df.coalesce(1), out)
    lines = _lines(out)
    assert lines == ['invalid JSON format in Nums field: x,2023-10-01 12:00:00,P,"","{""a"": ""b""}",invalid-json']
    assert [tuple(r) for r in read_dead_letters_csv(spark, out).collect()] == rows


def test_csv_texts_are_kept_as_they_are(spark, workdir):
    out = os.path.join(workdir, "agg")
    rows = [("2023-10-01", p, 1, 1.0) for p in ("P", " P", "P ", " P ")]
    write_aggregates_csv(spark.createDataFrame(rows, AGG_SCHEMA), out)
    assert sorted(tuple(r) for r in read_aggregates_csv(spark, out).collect()) == sorted(rows)
    dead = [("why", " 2024-01-01 00:00:00 ", " P ", "two\nlines", "a, \"b\" ", "")]
    df = spark.createDataFrame(dead, "Reason string, ts string, project_id string, event string, props string, nums string")
    out = os.path.join(workdir, "dead")
    write_dead_letters_csv(df, out)
    assert [tuple(r) for r in read_dead_letters_csv(spark, out).collect()] == dead


def test_append_is_the_default(spark, workdir):
    name, agg = "daily_append_test", spark.createDataFrame(AGG, AGG_SCHEMA)
    write_table(agg, name, location=os.path.join(workdir, "table"))
    write_table(spark.createDataFrame([("2023-10-01", "Late", 1, 1.0)], AGG_SCHEMA), name)
    assert sorted(r.ProjectId for r in spark.table(name).collect()) == ["", "Late", "ProjectA"]
    spark.sql(f"DROP TABLE {name}")


def test_table_uri():
    assert parse_table_uri("table://cat/db/daily") == ("cat", "db", "daily")
    for bad in ("table://cat/db", "table://cat/db/t/x", "file://cat/db/t", "table:///db/t"):
        with pytest.raises(ValueError):
            parse_table_uri(bad)


def test_catalog_table_created_once_and_replaced_by_date(spark, workdir):
    name = "daily_test_table"
    loc = os.path.join(workdir, "table")
    agg = spark.createDataFrame(AGG, AGG_SCHEMA)
    write_table(agg, name, mode="replace", location=loc)
    write_table(agg, name, mode="replace", location=loc)          # replay: no duplicates
    assert spark.table(name).count() == 2
    more = spark.createDataFrame([("2023-10-02", "ProjectZ", 5, 5.0)], AGG_SCHEMA)
    write_table(more, name, mode="replace", location=loc)         # replaces only 2023-10-02
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"     # the caller's setting is back
    got = sorted((str(r.Date), r.ProjectId) for r in spark.table(name).collect())
    assert got == [("2023-10-01", "ProjectA"), ("2023-10-02", "ProjectZ")]
    write_table(more, name, mode="append", location=loc)          # append duplicates
    assert spark.table(name).count() == 3
    schema = {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
    assert schema == {"ProjectId": "string", "NumberOfTransactions": "bigint", "TotalVolumeUsd": "double",
                      "Date": "date"}
    spark.sql(f"DROP TABLE {name}")


def test_partitioned_files_layout(spark, workdir):
    out = os.path.join(workdir, "parts")
    write_partitioned(spark.createDataFrame(AGG, AGG_SCHEMA), out)
    assert sorted(os.path.basename(p) for p in glob.glob(os.path.join(out, "Date=*"))) == [
        "Date=2023-10-01", "Date=2023-10-02"]


def test_null_in_table_row_fails(spark, workdir):
    agg = spark.createDataFrame([("2023-10-01", None, 1, 1.0)], AGG_SCHEMA)
    with pytest.raises(Exception, match="ProjectId must not be NULL"):
        write_partitioned(agg, os.path.join(workdir, "t"))


def test_sink_choice(spark, workdir):
    out = os.path.join(workdir, "csv")
    aggregate_sink(out)(spark.createDataFrame(AGG, AGG_SCHEMA))
    assert read_aggregates_csv(spark, out).count() == 2
    spark.sql("CREATE DATABASE IF NOT EXISTS sinkdb")
    aggregate_sink("table://spark_catalog/sinkdb/daily", location=os.path.join(workdir, "tbl"))(
        spark.createDataFrame(AGG, AGG_SCHEMA))
    assert spark.table("spark_catalog.sinkdb.daily").count() == 2
    spark.sql("DROP TABLE spark_catalog.sinkdb.daily")


def test_shared_folder_comes_from_the_session(spark):
    from daybook.session import scratch_path, shared_dir

    base = shared_dir(spark)
    assert base and scratch_path(spark, "x").startswith(base + "/daybook/x-")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert base == configured.rstrip("/")


def test_existing_table_with_other_layout_is_refused(spark, workdir):
    spark.sql("CREATE TABLE other_layout (a STRING, b INT) USING parquet")
    try:
        with pytest.raises(ValueError, match="exists with columns"):
            write_table(spark.createDataFrame(AGG, AGG_SCHEMA), "other_layout")
    finally:
        spark.sql("DROP TABLE other_layout")

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pacewise.functions.measures import day
from pacewise.sources import readers, schemas as S, tables
from samples import write


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return write(tmp_path_factory.mktemp("raw"))


def test_strict_read_parses_day_first_dates_and_strips_the_mark(spark, paths):
    df = readers.read_strict(spark, paths[S.PERFORMANCE], S.PERFORMANCE, S.DATE)
    assert df.columns == list(S.RAW_TYPES[S.PERFORMANCE])
    days = {r["date"] for r in df.collect()}
    assert dt.date(2024, 8, 1) in days and None not in days


def test_strict_read_fails_on_a_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_strict(spark, str(tmp_path / "none.csv"), S.AUDIENCE)


def test_tolerant_read_of_a_missing_file_is_empty(spark, tmp_path):
    df = readers.read_tolerant(spark, str(tmp_path / "none.csv"), S.AUDIENCE)
    assert df.count() == 0 and df.columns == list(S.RAW_TYPES[S.AUDIENCE])


def test_casts_turn_bad_numbers_into_nulls(spark, paths):
    raw = readers.read_tolerant(spark, paths[S.PERFORMANCE], S.PERFORMANCE)
    df = readers.cast_table(raw, S.PERFORMANCE)
    assert df.schema == S.typed_schema(S.PERFORMANCE)
    rows = {(r["date"], r["ad_set_id"]): r for r in df.collect()}
    assert rows[("03/08/2024", "A1")]["clicks"] is None
    assert rows[("04/08/2024", "A3")]["impressions"] == 400


def test_cast_all_but_keys_makes_text_columns_null(spark, paths):
    raw = readers.read_tolerant(spark, paths[S.BUDGET], S.BUDGET)
    df = readers.cast_all_but(raw, S.KEYS)
    assert {r["pacing_status"] for r in df.collect()} == {None}


def test_bad_dates_are_listed_and_strict_parsing_raises(spark):
    df = spark.createDataFrame([("01/08/2024",), ("2024-08-01",), (None,)], "date string")
    found = readers.rejects(df).collect()
    assert [(r["date"], r["reason"]) for r in found] == [("2024-08-01", "date is no d/M/yyyy date")]
    assert readers.rejects(df.select(F.lit(1).alias("x"))).isEmpty()
    with pytest.raises(Exception, match="(?i)parse"):
        df.select(day("date", strict=True)).collect()


def test_tables_are_replaced_counted_and_found(spark):
    tables.ensure_layers(spark, ["scratch"])
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    assert tables.write_table(df, "scratch.t", sort_by=["id"], partition_by=["k"]) == 10
    assert tables.write_table(df.limit(4), "scratch.t") == 4
    assert tables.table_exists(spark, "scratch.t")
    assert not tables.table_exists(spark, "scratch.none")
    tables.register(df, "some_view")
    assert tables.write_view(spark, "some_view", "scratch.v") == 10
    tables.append_audit(spark, {"scratch.t": 4}, "scratch.audit")
    assert spark.table("scratch.audit").first()["row_count"] == 4


def test_quoted_text_keeps_its_columns(spark, tmp_path):
    path = tmp_path / "audience.csv"
    path.write_text(
        ",".join(S.RAW_TYPES[S.AUDIENCE]) + "\n"
        'A1,"The ""Big"", one",25-45,"back\\slash, and \\"" quote",vip,500\n',
        encoding="utf-8",
    )
    row = readers.read_strict(spark, str(path), S.AUDIENCE).first()
    assert tuple(row) == ("A1", 'The "Big", one', "25-45", 'back\\slash, and \\" quote', "vip", "500")
    tables.export_csv(readers.read_strict(spark, str(path), S.AUDIENCE), str(tmp_path / "out"))
    assert readers.read_strict(spark, str(tmp_path / "out"), S.AUDIENCE).first() == row


def test_exports_and_empty_guard(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "'a,b' AS text")
    tables.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    tables.export_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3
    with pytest.raises(RuntimeError, match="empty"):
        tables.require_rows(df.limit(0), "nothing")
    assert tables.require_rows(df, "something") is df

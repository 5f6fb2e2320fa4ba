"""Versioned tables: a write is seen whole or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fluxweave.sources import readers, sinks, versions

FIELDS = "scenario string, score double"


def rows_of(spark, path):
    return sorted(tuple(r) for r in versions.read(spark, path).select("scenario", "score").collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "a table")
    versions.write(spark.createDataFrame([("A", 1.0), ("A", 2.0), ("B", 3.0)], FIELDS), path, ["scenario"])
    return path


def test_partitions_are_replaced(spark, table):
    versions.write(spark.createDataFrame([("A", 9.0), ("C/d=e f", 4.0), (None, 5.0)], FIELDS), table, ["scenario"])
    got = {(r["scenario"], r["score"]) for r in versions.read(spark, table).collect()}
    assert got == {("A", 9.0), ("B", 3.0), ("C/d=e f", 4.0), (None, 5.0)} and len(versions.live(table)) == 4
    # Only live files are left, so a plain scan sees the same rows.
    assert spark.read.parquet(table).count() == 4


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, table):
    before = rows_of(spark, table)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") % 2 == 0, "A").otherwise("D").alias("scenario"), F.expr("IF(id = 999, raise_error('lost'), id)").cast("double").alias("score"))
    with pytest.raises(Exception, match="lost"):
        versions.write(broken, table, ["scenario"])
    assert rows_of(spark, table) == before
    versions.write(spark.createDataFrame([("B", 0.5)], FIELDS), table, ["scenario"])
    assert rows_of(spark, table) == [("A", 1.0), ("A", 2.0), ("B", 0.5)]


@pytest.mark.parametrize("step", ["_swap", "_clean"])
def test_a_driver_lost_around_the_swap(spark, table, monkeypatch, step):
    def lost(*_):
        raise RuntimeError("driver lost")

    before = rows_of(spark, table)
    with monkeypatch.context() as m:
        m.setattr(versions, step, lost)
        with pytest.raises(RuntimeError):
            versions.write(spark.createDataFrame([("A", 7.0), ("D", 8.0)], FIELDS), table, ["scenario"])
    assert rows_of(spark, table) == (before if step == "_swap" else [("A", 7.0), ("B", 3.0), ("D", 8.0)])
    versions.write(spark.createDataFrame([("A", 0.0)], FIELDS), table, ["scenario"])
    assert rows_of(spark, table) == [("A", 0.0), ("B", 3.0)] + ([("D", 8.0)] if step == "_clean" else [])


def test_rows_of_the_table_itself_are_written_back(spark, table):
    versions.write(versions.read(spark, table).withColumn("score", F.col("score") * 2), table, ["scenario"])
    assert rows_of(spark, table) == [("A", 2.0), ("A", 4.0), ("B", 6.0)]


def test_columns_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write(spark.createDataFrame([("2025", 1, "x")], "vintage string, n int, only_old string"), path, ["vintage"])
    versions.write(spark.createDataFrame([("2026", 2, "y")], "vintage string, n int, only_new string"), path, ["vintage"])
    got = versions.read(spark, path)
    assert dict(got.dtypes) == {"vintage": "string", "n": "int", "only_old": "string", "only_new": "string"}
    assert sorted(tuple(r) for r in got.select("vintage", "n", "only_old", "only_new").collect()) == [("2025", 1, "x", None), ("2026", 2, None, "y")]


def test_empty_and_foreign_tables(spark, tmp_path):
    path, none = str(tmp_path / "t"), spark.createDataFrame([], FIELDS)
    with pytest.raises(FileNotFoundError):
        readers.read_stored(spark, path)
    versions.write(none, path, ["scenario"])
    assert versions.exists(path) and versions.read(spark, path).count() == 0
    sinks.write_store(spark.createDataFrame([("A", 1.0)], FIELDS), path, "scenario", overwrite=True)
    versions.write(none, path, ["scenario"])
    assert rows_of(spark, path) == [("A", 1.0)]
    sinks.write_store(none, path, "scenario", overwrite=True)
    assert rows_of(spark, path) == []
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    with pytest.raises(FileExistsError):
        versions.write(none, plain, ["scenario"])


def test_stored_results_pass_a_gate(spark, table):
    with pytest.raises(Exception, match="method"):
        readers.read_stored(spark, table, "result")

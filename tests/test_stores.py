"""Cells through a committing sink, sketches that merge, tables saved in buckets."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.membership import joined_membership
from tidemark.operators.sketches import daily_sketches, distinct_in_span, merged_sketches
from tidemark.sinks.cells import cell_sink, read_cells
from tidemark.sinks.widecolumn import WriteOptions
from tidemark.sources.catalog import save_bucketed

CELL = "rowkey STRING, family STRING, qualifier STRING, value STRING, version BIGINT"


def cells(spark, first, last, parts=2):
    rows = [(f"k{i}", "f", "q", f"v{i}", 1) for i in range(first, last)]
    return spark.createDataFrame(rows, CELL).repartition(parts)


def keys(df):
    return sorted(int(r["rowkey"][1:]) for r in df.collect())


class TestCellSink:
    @pytest.fixture
    def place(self, tmp_path):
        return str(tmp_path / "cells")

    def files(self, place, batch):
        return sorted(os.listdir(f"{place}/batch={batch}"))

    def test_batches_add_up_and_a_repeated_one_replaces_itself(self, spark, place):
        sink = cell_sink(place, WriteOptions("t", "q"))
        sink(cells(spark, 0, 10), 0)
        for _ in range(2):
            sink(cells(spark, 10, 15), 1)
        assert keys(read_cells(spark, place)) == list(range(15))
        sink(cells(spark, 0, 0), 1)  # the batch has nothing any more
        assert keys(read_cells(spark, place)) == list(range(10))
        assert read_cells(spark, place).dtypes[-1] == ("version", "bigint")

    def test_buffers_are_flushed_by_rows_bytes_and_time(self, spark, place):
        cell_sink(place, WriteOptions("t", "q", flush_rows=4))(cells(spark, 0, 10, 1), 0)
        assert len(self.files(place, 0)) == 3
        long = cells(spark, 0, 4, 1).withColumn("value", F.repeat(F.lit("x"), 700_000))
        cell_sink(place, WriteOptions("t", "q", flush_bytes=1_048_576))(long, 1)
        assert len(self.files(place, 1)) == 2
        cell_sink(place, WriteOptions("t", "q", flush_millis=1))(cells(spark, 0, 20_000, 1), 2)
        assert len(self.files(place, 2)) > 1
        assert keys(read_cells(spark, place).filter("version = 1")) == sorted([*range(10), *range(4), *range(20_000)])

    def test_a_failed_batch_leaves_nothing(self, spark, place):
        sink = cell_sink(place, WriteOptions("t", "q", flush_rows=1))
        sink(cells(spark, 0, 3), 0)
        fails = F.when(F.col("rowkey") == "k19", F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
        with pytest.raises(Exception, match="lost"):
            sink(cells(spark, 10, 20, 4).withColumn("value", fails), 1)
        assert keys(read_cells(spark, place)) == [0, 1, 2]
        assert not os.path.exists(f"{place}/batch=1")
        sink(cells(spark, 10, 12), 1)  # Spark repeats the batch
        assert keys(read_cells(spark, place)) == [0, 1, 2, 10, 11]
        assert not os.listdir(f"{place}/_staged")

    def test_null_values_and_missing_columns(self, spark, place):
        sink = cell_sink(place, WriteOptions("t", "q"))
        sink(spark.createDataFrame([("k1", "f", "q", None, None)], CELL), 0)
        assert [tuple(r) for r in read_cells(spark, place).collect()] == [("k1", "f", "q", None, None)]
        with pytest.raises(Exception, match="value"):
            sink(cells(spark, 0, 1).drop("value"), 1)


class TestSketches:
    def sketches(self, spark, n, lg_k=12):
        days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))
        rows = spark.range(n).select(F.lit("u").alias("u"), days.cast("timestamp").alias("t"), (F.col("id") % (n // 2)).alias("v"))
        return daily_sketches(rows, ["u"], "t", ["v"], lg_k)

    def count(self, sketches, first="2024-01-01", last="2024-01-04"):
        return distinct_in_span(sketches, ["u"], {"v": "n"}, first, last).first()["n"]

    def test_small_counts_are_exact_over_any_span(self, spark):
        sketches = self.sketches(spark, 400)
        assert sketches.count() == 4
        assert self.count(sketches) == 200
        assert self.count(sketches, "2024-01-02", "2024-01-02") == 50
        assert self.count(sketches, "2024-01-02", "2024-01-03") == 100

    @pytest.mark.parametrize("lg_k", [10, 14])
    def test_error_against_exact_counts(self, spark, lg_k):
        found = self.count(self.sketches(spark, 200_000, lg_k))
        assert abs(found - 100_000) <= 4 * 0.83 / 2 ** (lg_k / 2) * 100_000

    def test_a_sketch_has_a_fixed_size(self, spark):
        sizes = [self.sketches(spark, n).agg(F.max(F.length("v"))).first()[0] for n in (100_000, 800_000)]
        assert max(sizes) <= 2 ** 12 + 64 and sizes[0] > 0.9 * sizes[1]

    def test_merging_twice_changes_nothing(self, spark):
        sketches = self.sketches(spark, 50_000)
        once = merged_sketches(sketches, ["u"], ["v"])
        again = merged_sketches(once.union(once), ["u"], ["v"])
        estimate = F.hll_sketch_estimate("v")
        assert once.select(estimate).first() == again.select(estimate).first()

    def test_nulls_and_rows_without_a_time(self, spark):
        rows = spark.createDataFrame([("u", None, "a"), ("u", "2024-01-02", None)], "u STRING, t STRING, v STRING")
        sketches = daily_sketches(rows.withColumn("t", F.col("t").cast("timestamp")), ["u"], "t", ["v"])
        assert self.count(sketches) == 0


class TestBuckets:
    @pytest.fixture
    def saved(self, spark, folder):
        names = {
            "users": spark.range(200).selectExpr("id AS uid", "concat('n', id) AS name", "CAST(id AS INT) AS age"),
            "classes": spark.range(5).selectExpr("id AS cid", "concat('c', id) AS cname"),
            "links": spark.range(1000).selectExpr("id % 250 AS uid", "id % 5 AS cid", "'s' AS utype").distinct(),
        }
        keys = {"users": "uid", "classes": "cid", "links": "uid"}
        out = {n: save_bucketed(df, f"test_{n}", [keys[n]], 4, f"{folder}/{n}") for n, df in names.items()}
        yield out
        for name in names:
            spark.sql(f"DROP TABLE test_{name}")

    def plan(self, spark, saved):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        try:
            # Users are taken for too large to be sent to every task, classes are not.
            size = int(spark.sql("DESCRIBE TABLE EXTENDED test_classes").filter("col_name = 'Statistics'").first()[1].split()[0])
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size))
            df = joined_membership(saved["users"], saved["classes"], saved["links"])
            return df, df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def test_links_and_users_meet_without_a_shuffle(self, spark, saved):
        df, plan = self.plan(spark, saved)
        assert "Exchange hashpartitioning" not in plan
        assert "SelectedBucketsCount: 4 out of 4" in plan
        assert df.count() == 200

    def test_statistics_choose_the_join(self, spark, saved):
        _, plan = self.plan(spark, saved)
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
        found = {r["info_name"]: r["info_value"] for r in spark.sql("DESCRIBE EXTENDED test_users uid").collect()}
        assert abs(int(found["distinct_count"]) - 200) <= 20 and found["max"] == "199"

    def test_a_bucket_is_one_file(self, spark, saved):
        assert saved["links"].select(F.input_file_name()).distinct().count() == 4

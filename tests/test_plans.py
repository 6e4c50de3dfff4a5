"""What the physical plans must and must not hold."""

import pytest

from tidemark.operators.lookup import lookup_in_ranges
from tidemark.plans import batch
from tidemark.sources.ranges import asked_cells, read_ranges, write_ranges

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapCoGroups")
# The lookup in ranges compares its keys with the edges of a bounded number of ranges.
DECLARATIVE = sorted(set(batch.BATCH_QUERIES) - {"cogroup_apply", "lookup_ranged"})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DECLARATIVE)
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    plan = plan_of(batch.BATCH_QUERIES[name](spark, sf_dir))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", *PYTHON):
        assert node not in plan


def test_asof_moves_each_side_once(spark, sf_dir):
    orders, rates = batch.orders_and_rates(spark, sf_dir)
    from tidemark.operators.asof import asof_join

    joined = asof_join(orders, rates, ["currency"], "o_rowtime", "r_rowtime", ["rate_id"])
    plan = plan_of(joined)
    # Both sides meet by key in one shuffle. Dealing out the small scans of the test
    # tables is not part of the operator.
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("ENSURE_REQUIREMENTS" in line for line in shuffles) == 1


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = plan_of(batch.tumbling_reduce(spark, sf_dir))
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "event_type" not in schema and "value" not in schema


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(batch.catalog_select(spark, sf_dir))
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan


def test_tumbling_windows_combine_before_the_shuffle(spark, sf_dir):
    assert "partial_sum" in plan_of(batch.tumbling_sum_start(spark, sf_dir))


class TestLookupInRanges:
    @pytest.fixture
    def table(self, spark, folder):
        cells = [(f"k{i:04d}", "info", "name", f"n{i}", 1) for i in range(400)]
        cells += [("k0007", "info", "name", f"v{v}", v) for v in range(2, 90)] + [(None, "info", "name", "x", 1)]
        df = spark.createDataFrame(cells, "rowkey STRING, family STRING, qualifier STRING, value STRING, version BIGINT")
        write_ranges(df, folder, 10)
        return read_ranges(spark, folder)

    def found(self, spark, table, *keys):
        asked = spark.createDataFrame([(k,) for k in keys], "id STRING")
        schema = "rowkey STRING, info STRUCT<name: STRING>"
        return lookup_in_ranges(asked, table, schema, "id", {"name": "info.name"})

    def test_values(self, spark, table):
        rows = self.found(spark, table, "k0003", "k0007", "k0399", "k9", "a", None, "k0003").collect()
        assert sorted((r["id"], r["name"]) for r in rows) == [
            ("k0003", "n3"), ("k0003", "n3"), ("k0007", "v89"), ("k0399", "n399")
        ]
        assert self.found(spark, table).count() == 0

    def test_rows_are_whole_and_ranges_apart(self, table):
        edges = sorted((r["low"], r["high"]) for r in table.ranges.collect())
        assert len(edges) >= 8
        assert all(before[1] < after[0] for before, after in zip(edges, edges[1:]))
        assert table.cells.count() == 488

    def test_only_ranges_of_asked_keys_are_read(self, spark, table):
        asked = spark.createDataFrame([("k0001",), ("k0002",)], "id STRING")
        read = asked_cells(asked, table, "id")
        assert "dynamicpruning" in plan_of(read)
        read.collect()
        scans = [line for line in metrics_of(read) if line[0].startswith("Scan parquet") and line[1].get("numFiles")]
        files = min(metrics["numFiles"] for _, metrics in scans if "numPartitions" in metrics)
        assert files == 1

    def test_number_of_ranges_is_bounded(self, table):
        for bad in (0, 100_000):
            with pytest.raises(ValueError):
                write_ranges(table.cells, "unused", bad)


def metrics_of(df):
    """Name and metrics of the nodes of a plan that has run."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        values = node.metrics()
        names = values.keys().toSeq()
        found.append((node.nodeName(), {names.apply(i): values.apply(names.apply(i)).value() for i in range(names.size())}))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found

"""Updates by key against a rewrite of the whole table."""

from __future__ import annotations

import random
import time
import uuid
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import fresh, rows
from wardlens.plans.keyed import KeyedTable
from wardlens.sources.versions import Conflict

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def _frame(spark, state):
    return spark.createDataFrame(sorted(state.items()), SCHEMA)


def test_random_updates_equal_a_rewrite(spark):
    rng = random.Random(9)
    state = {rng.randrange(-500, 500): f"v{i}" for i in range(300)}
    table = KeyedTable(spark, fresh(spark, "test-keyed"), SCHEMA, "id", rows_per_range=20)
    table.build(_frame(spark, state))
    assert len(table.ranges()) > 8
    for step in range(4):
        before = table.table.parts()
        changed = {k: f"c{step}" for k in rng.sample(sorted(state), 4)}
        changed |= {rng.randrange(-700, 700): f"n{step}" for _ in range(3)}
        gone = rng.sample(sorted(set(state) - set(changed)), 3)
        state = {k: v for k, v in (state | changed).items() if k not in gone}
        done = table.update(_frame(spark, changed), spark.createDataFrame([(k,) for k in [*gone, 9999]], "id long"))
        assert rows(table.read()) == sorted(state.items(), key=lambda r: repr(tuple(r)))
        after = table.table.parts()
        assert {p: f for p, f in before.items() if p not in done}.items() <= after.items()
        assert not set(done) & set(after)
        bounds = [table._range(p) for p in table.ranges()]
        assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_only_the_ranges_of_the_keys_are_read_and_rewritten(spark):
    table = KeyedTable(spark, fresh(spark, "test-keyed-ranges"), SCHEMA, "id", rows_per_range=50)
    table.build(spark.range(0, 1000, 2).select("id", F.lit("a").alias("v")))
    parts = len(table.ranges())
    assert len(table.update(_frame(spark, {500: "b"}))) == 1
    assert len(table.update(removed=spark.createDataFrame([(501,)], "id long"))) <= 1
    assert rows(table.read(498, 502)) == [(498, "a"), (500, "b"), (502, "a")]
    assert len(table.read(498, 502).inputFiles()) < parts
    assert table.update(removed=spark.createDataFrame([(10 ** 6,), (None,)], "id long")) == []
    # A range that grows too large is cut.
    table.update(spark.range(2000, 2400).select("id", F.lit("n").alias("v")))
    assert len(table.ranges()) > parts + 3 and table.read().count() == 900
    with pytest.raises(ValueError, match="unique"):
        table.update(spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA))
    assert table.read().count() == 900


def test_empty_tables_and_writers(spark):
    table = KeyedTable(spark, fresh(spark, "test-keyed-empty"), SCHEMA, "id")
    table.build(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == 0
    table.update(_frame(spark, {1: "a"}))
    assert rows(table.read()) == [(1, "a")]
    version, name = table.table.newest(), table.ranges()[0]
    table.update(_frame(spark, {1: "b"}))
    with pytest.raises(Conflict):
        table.table.commit(version, {name: None, "5_5_x": "data/x/part=0"})


def test_a_row_does_not_meet_all_ranges(spark):
    table = KeyedTable(spark, fresh(spark, "test-keyed-place"), SCHEMA, "id")
    starts = sorted(random.Random(4).sample(range(-10 ** 9, 10 ** 9), 20_000))
    some = [(k,) for s in [*starts[:9], *starts[-9:]] for k in (s - 1, s, s + 1)]
    some += [(-2 ** 63,), (2 ** 63 - 1,), (0,), (None,)]
    for n in (0, 1, 2, 3, 4, 7, 8, 20_000):
        placed = spark.createDataFrame(some, "id long").select("id", table._place(starts[:n]).alias("at"))
        assert placed.schema["at"].dataType == T.IntegerType()
        assert all(r["at"] == (0 if r["id"] is None else bisect_right(starts[:n], r["id"]))
                   for r in placed.collect())

    def seconds(n):
        began = time.time()
        keys = spark.range(-200_000, 200_000, numPartitions=4).select((F.col("id") * 5000).alias("id"))
        keys.select(F.sum(table._place(starts[:n]))).collect()
        return time.time() - began
    seconds(20)
    assert seconds(20_000) < 10 * seconds(20) + 5  # comparisons with all starts: 1000 times as many


def _jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ranges_that_grow_are_cut_together(spark):
    jobs = []
    for n in (6, 24):
        table = KeyedTable(spark, fresh(spark, "test-keyed-cuts"), SCHEMA, "id", rows_per_range=10)
        table.build(spark.range(0, 60 * n, 6).select("id", F.lit("a").alias("v")))
        assert len(table.ranges()) == n
        odd = spark.range(0, 60 * n).where("id % 6 != 0").select("id", F.lit("n").alias("v"))
        jobs.append(_jobs(spark, lambda: table.update(odd)))
        bounds = [table._range(p) for p in table.ranges()]
        assert len(bounds) > 4 * n and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
        assert rows(table.read()) == sorted([(i, "n" if i % 6 else "a") for i in range(60 * n)], key=repr)
        # What was written before the cut is not left behind.
        live = set(table.table.parts().values())
        folders = {f.rsplit("/", 1)[0] for f in live}
        for folder in folders:
            left = {f"{folder}/{name}" for name, _ in table.table._names(table.table.path(folder)) if "=" in name}
            assert left <= live
    assert jobs[1] - jobs[0] <= 4


def test_keys_of_updates_and_builds_are_checked(spark):
    table = KeyedTable(spark, fresh(spark, "test-keyed-unique"), SCHEMA, "id", rows_per_range=5)
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError, match="unique"):
            table.build(spark.createDataFrame(bad, SCHEMA))
    table.build(_frame(spark, {i: "a" for i in range(40)}))
    for bad in ([(3, "x"), (3, "y")], [(7, "x"), (None, "y")], [(99, "x"), (99, "x")]):
        with pytest.raises(ValueError, match="unique"):
            table.update(spark.createDataFrame(bad, SCHEMA))
    # A key that is removed and given again, and one that is removed twice.
    table.update(_frame(spark, {3: "x"}), spark.createDataFrame([(3,), (4,), (4,), (None,)], "id long"))
    assert rows(table.read()) == rows(_frame(spark, {i: "x" if i == 3 else "a" for i in range(40) if i != 4}))

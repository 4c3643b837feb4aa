"""The nearest join on a bucket table equals brute force and stays free of all-pairs plans."""

import bisect
import math
import random

from pyspark.sql import functions as F

from broadsheet.operators import catalogs as C

BUCKETS = "bucket DOUBLE, found BIGINT"


def near(spark, values, buckets, default=-1):
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "id BIGINT, v DOUBLE, _range STRING")
    table = spark.createDataFrame(buckets, BUCKETS)
    return C.nearest_in(df, "v", table, "bucket", "found", F.lit(default).cast("bigint"), "near")


def plain(value, buckets, default=-1):
    good = [(b, f) for b, f in buckets if b is not None and f is not None and math.isfinite(b)]
    if value is None or not math.isfinite(value) or not good:
        return default
    return min((abs(b - value), b, f) for b, f in good)[2]


def check(spark, values, buckets):
    rows = near(spark, values, buckets).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(values)))
    for r in rows:
        assert r["near"] == plain(values[r["id"]], buckets), values[r["id"]]


def test_ties_ends_repeats_and_what_has_no_place(spark):
    inf, nan = math.inf, math.nan
    buckets = [(8.0, 600), (14.0, 900), (30.0, 1200), (30.0, 1100), (None, 1), (nan, 2), (inf, 3), (-inf, 4), (9.0, None)]
    check(spark, [8.0, 11.0, 11.5, 22.0, 22.1, -5.0, 99.0, None, nan, inf, -inf, 11.0, 30.0, 9.0], buckets)
    check(spark, [1.0, None, -0.0], [(0.0, 7)])
    check(spark, [1.0, None], [])
    check(spark, [], [(1.0, 1)])


def test_clashing_columns_keep_their_values(spark):
    df = spark.createDataFrame([(1.0, "a", "b", 5)], "v DOUBLE, at STRING, before STRING, near INT")
    out = C.nearest_in(df, "v", spark.createDataFrame([(2.0, 9)], BUCKETS), "bucket", "found", F.lit(0).cast("bigint"), "near")
    assert [tuple(r) for r in out.collect()] == [(1.0, "a", "b", 9)] and out.columns == df.columns


def test_many_buckets_across_ranges(spark):
    """100,000 buckets in clumps: whole ranges hold only values or only buckets; a third of the rows share one value."""
    rng = random.Random(3)
    buckets = [(float(rng.randint(0, 40) * 10_000) + rng.random() * 50, i) for i in range(100_000)]
    values = [rng.uniform(-10, 420_000) for _ in range(20_000)] + [5_000.0] * 10_000
    out = near(spark, values, buckets)
    places = sorted(buckets)
    keys = [b for b, _ in places]
    rows = out.collect()
    assert len(rows) == len(values)
    for r in rows:
        at = bisect.bisect_left(keys, values[r["id"]])
        assert r["near"] == plain(values[r["id"]], places[max(0, at - 1):at + 1])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import StateTable, decode, live_rows, merge_state, publish_changes, read_feed, row_images, state_changes
from tidemark.schemas import envelope

SCHEMA = "a long, b string, v int, op string, ts_ms double"
IMAGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("v", T.IntegerType())])


def brute(old, new):
    held, then = ({r[:2]: r for r in rows} for rows in (old, new))
    out = []
    for key in held.keys() | then.keys():
        one, two = held.get(key), then.get(key)
        before = one[:3] if one and one[3] not in ("d", None) else None
        after = two[:3] if two and two[3] not in ("d", None) else None
        if before != after:
            out.append(("d" if after is None else "c" if before is None else "u", before, after, two[4] if two else 99.0))
    return sorted(out, key=repr)


def states(seed):
    rng = random.Random(seed)

    def some():
        keys = {(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "x", "y", "z"])) for _ in range(14)}
        return [(*k, rng.choice([None, 0, 1]), rng.choice(["c", "u", "d", None]), float(rng.randint(0, 5))) for k in keys]

    return some(), some()


@pytest.mark.parametrize("seed", range(6))
def test_random_states(spark, seed):
    old, new = states(seed)
    found = state_changes(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), "a,b", at=F.lit(99.0)).collect()
    plain = [(r.op, r.before and tuple(r.before), r.after and tuple(r.after), r.ts_ms) for r in found]
    assert sorted(plain, key=repr) == brute(old, new)


@pytest.mark.parametrize("seed", range(3))
def test_the_feed_turns_one_state_into_the_other(spark, tmp_path, seed):
    old, new = (spark.createDataFrame([(*r[:4], r[4] + 10 * k) for r in rows], SCHEMA) for k, rows in enumerate(states(seed)))
    publish_changes(old, new, ["a", "b"], str(tmp_path / "feed"), at=F.lit(99.0))
    feed = read_feed(spark, str(tmp_path / "feed"), schema=T.StructType.fromDDL("key string, value string"))
    merged = merge_state(old, row_images(decode(feed, envelope(IMAGE))), ["a", "b"])
    columns = ["a", "b", "v"]
    assert sorted(map(tuple, merged.select(columns).collect()), key=repr) == sorted(map(tuple, live_rows(new).select(columns).collect()), key=repr)


def test_equal_states_and_columns_that_one_lacks(spark):
    rows = spark.createDataFrame([(1, "x", 1, "c", 1.0), (2, "y", 2, "d", 1.0)], SCHEMA)
    assert state_changes(rows, rows, "a").count() == 0
    wider = rows.withColumn("w", F.when(F.col("a") == 1, 5))
    (found,) = state_changes(rows, wider, "a").collect()
    assert found.op == "u" and found.before.w is None and found.after.w == 5
    assert state_changes(wider, rows, "a").first().after.w is None


def test_versions_of_a_bucketed_table_are_joined_where_they_lie(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "a", buckets=4)
    one = table.apply(spark.range(5000).selectExpr("id a", "'x' b", "1 v", "'c' op", "1D ts_ms"))
    two = table.apply(spark.range(50).selectExpr("id a", "'x' b", "2 v", "'u' op", "2D ts_ms"))
    old, new = table.read_version(one), table.read_version(two)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        changes = state_changes(old, new, "a")
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert changes.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # the rows with a null key are shuffled, and there are none
    assert plan.count("Exchange hashpartitioning(coalesce(") == 2 == plan.count("Exchange hashpartitioning")
    with pytest.raises(FileNotFoundError):
        table.read_version(77)

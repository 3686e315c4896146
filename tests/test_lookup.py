from pyspark.sql import functions as F

from gramloom.plans.lookup import KEY_BYTES, STORED_HASH, frequent_keys, key_hash, lookup_join


def test_hot_and_cold_keys_and_misses(spark):
    table = spark.range(5000).select(
        F.lit(1).alias("n"), F.col("id").cast("string").alias("ctx"),
        F.when(F.col("id") < 3, 100_000).otherwise(F.col("id") % 5 + 1).cast("bigint").alias("w"),
        (F.col("id") * 2).alias("v"),
    )
    total = table.agg(F.sum("w")).head()[0]
    probe = spark.range(20_000).select(
        F.col("id").alias("gid"), F.lit(1).alias("n"),
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("ctx"),
    )
    joined = lookup_join(probe, table, ["n", "ctx"], ["v"], F.col("w"), total, ["gid"])
    plain = probe.join(table.select("n", "ctx", "v"), ["n", "ctx"], "left").select("gid", "n", "ctx", "v")
    assert joined.columns == ["gid", "n", "ctx", "v"]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_hot_rows_are_dealt_out_over_the_partitions(spark):
    """Half of all rows share one key, yet no partition holds much more than its part."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.range(1000).select(
            F.col("id").cast("string").alias("k"), F.when(F.col("id") == 0, 1_000_000).otherwise(1).alias("w"), "id"
        )
        probe = spark.range(40_000).select(
            F.col("id").alias("gid"), F.when(F.col("id") % 2 == 0, "0").otherwise((F.col("id") % 1000).cast("string")).alias("k")
        )
        joined = lookup_join(probe, table, ["k"], ["id"], F.col("w"), 1_000_999, ["gid"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "hashpartitioning(_hash" in plan
    assert sum(sizes) == 40_000 and max(sizes) < 1.3 * 40_000 / len(sizes)


def test_keys_frequent_among_the_questions_only_are_dealt_out(spark):
    """A third of the questions ask for one key that the table knows but rates as rare, a third for one that it lacks."""
    table = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("w"), "id")
    key = F.when(F.col("id") % 3 == 0, "7").when(F.col("id") % 3 == 1, "unknown").otherwise((F.col("id") % 3000).cast("string"))
    probe = spark.range(60_000).select(F.col("id").alias("gid"), key.alias("k"))
    (often,) = frequent_keys(probe, ["k"])
    hashes = {r.k: r.h for r in probe.select("k", key_hash(["k"]).alias("h")).distinct().collect()}
    assert set(often) == {hashes["7"], hashes["unknown"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for known in (table, table.withColumn(STORED_HASH, key_hash(["k"]))):
            joined = lookup_join(probe, known, ["k"], ["id"], F.col("w"), 3000, ["gid"], often).cache()
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("part")).count().collect()]
            assert sum(sizes) == 60_000 and max(sizes) < 1.3 * 60_000 / len(sizes)
            assert joined.filter("k = '7' and id = 7").count() == 20_000
            assert joined.filter("id is null").count() == joined.filter("k = 'unknown'").count() == 20_000
            joined.unpersist()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_long_keys_are_not_broadcast_and_still_found(frame):
    long = "x" * (KEY_BYTES + 1)
    table = frame([(long, 900, 1), ("b", 100, 2)], "k string, w int, v int")
    probe = frame([(0, long), (1, "b"), (2, None), (3, "c")], "gid int, k string")
    (often,) = frequent_keys(probe, ["k"])
    joined = lookup_join(probe, table, ["k"], ["v"], F.col("w"), 1000, ["gid"], often)
    assert {r.gid: r.v for r in joined.collect()} == {0: 1, 1: 2, 2: None, 3: None}


def test_frequent_keys_of_nothing(frame):
    assert frequent_keys(frame([], "k string"), ["k"]) == [[]]


def test_keys_travel_as_one_string_and_nulls_match_nothing(spark, frame):
    """Rows of one hash are told apart by their keys, which are dealt out in one column."""
    table = frame([(1, "", "a", 7), (1, "a", "", 8), (11, "", "a", 9), (1, None, "a", 5)], "n int, ctx string, target string, v int")
    asked = [(0, 1, "", "a"), (1, 1, "a", ""), (2, 11, "", "a"), (3, 1, None, "a"), (4, 1, "a", None), (5, 1, "a", "a")]
    joined = lookup_join(
        frame(asked, "gid int, n int, ctx string, target string"), table, ["n", "ctx", "target"], ["v"], F.lit(0), 1, ["gid"]
    )
    assert {r.gid: r.v for r in joined.collect()} == {0: 7, 1: 8, 2: 9, 3: None, 4: None, 5: None}
    assert "_cold_keys" in joined._jdf.queryExecution().optimizedPlan().toString()

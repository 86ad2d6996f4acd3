from collections import Counter

from pyspark.sql import functions as F

from meterflow.llm import common


def test_join_spread_is_the_plain_join(spark, monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 7)
    sizes = {1: 1, 2: 7, 3: 8, 4: 300, 5: 0}
    rows = [(k, f"r{k % 2}", i) for k, n in sizes.items() for i in range(n)]
    rows = spark.createDataFrame([*rows, (9, "none", 1)], "a long, b string, number long")
    groups = rows.filter("a <> 9").groupBy("a", "b").agg(
        F.min("number").alias("m"), F.count("*").alias("n")
    ).unionByName(spark.sql("select 5L a, 'r1' b, 0L m, 0L n"))
    found = common.join_spread(rows, groups, ["a", "b"], "number")
    wanted = rows.join(groups, ["a", "b"])
    assert found.columns == wanted.columns
    assert Counter(found.collect()) == Counter(wanted.collect())


def test_a_hot_key_is_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 10)
    rows = spark.range(400).select(F.lit(1).alias("k"), F.col("id").alias("number"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = common.join_spread(rows, groups.hint("merge"), ["k"], "number")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(sizes) == 400 and len(sizes) > 1 and max(sizes) < 200

"""Nearest vectors as products of matrices, against the plain formula over all pairs."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.operators import vectors

TYPE = "vec_id long, embedding array<float>"


def plain(queries, rows, k):
    pairs = queries.filter("embedding is not null").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")).crossJoin(rows.filter("embedding is not null"))
    pairs = pairs.select("query_id", "vec_id", F.round(vectors.cosine(F.col("q"), F.col("embedding")), 9).alias("similarity"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc_nulls_last("similarity"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k)


def found(df):
    return sorted(map(str, df.select("query_id", "vec_id", "similarity", "rank").collect()))


def given():
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, [x + rng.gauss(0, 0.01) for x in base[i % 40]]) for i in range(700)]
    rows += [(800 + i, [2 * x for x in base[i % 2]]) for i in range(60)]  # copies but for length
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0] * 5), (904, [1.0, None] * 4), (905, [1e-30] * 8), (906, [float("nan")] * 8), (907, [1.0] * 5), (5, rows[5][1])]
    return rows


def test_against_all_pairs(spark):
    df = spark.createDataFrame(given(), TYPE).repartition(5)
    queries = df.filter("vec_id % 9 = 0 or vec_id >= 895 or vec_id = 5")
    assert found(vectors.topk_cosine(queries, df, 4)) == found(plain(queries, df, 4))
    assert found(vectors.topk_cosine(queries, df, 800)) == found(plain(queries, df, 800))


def test_pairs_are_not_rows(spark):
    """No step but the search itself sees more rows than tasks times queries times k, however many copies there are."""
    df = spark.createDataFrame([(i, [1.0, float(i % 3)]) for i in range(3000)], TYPE).repartition(2)
    out = vectors.topk_cosine(df.filter("vec_id % 50 = 0"), df, 3)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 180


def test_other_ids_and_empty_tables(spark):
    df = spark.createDataFrame(given()[:200], TYPE).withColumn("vec_id", F.concat(F.lit("v"), "vec_id"))
    assert found(vectors.topk_cosine(df.limit(20), df, 3)) == found(plain(df.limit(20), df, 3))
    none = spark.createDataFrame([], TYPE)
    some = spark.createDataFrame(given()[:5], TYPE)
    assert vectors.topk_cosine(none, some, 3).collect() == [] and vectors.topk_cosine(some, none, 3).collect() == []

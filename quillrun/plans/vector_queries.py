"""Queries: search, clusters, duplicates and run differences over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions.vectors import as_doubles, cosine
from quillrun.operators import joining, search, similarity
from quillrun.plans.registry import query, table
from quillrun.session import materialise

DIMENSIONS = 64


def label_means(embeddings):
    """The mean vector of each label: the query set of the search."""
    vector = as_doubles(F.col("embedding"))
    return embeddings.groupBy(F.col("label").alias("query_id")).agg(
        F.array(*[F.avg(F.get(vector, F.lit(i))) for i in range(DIMENSIONS)]).alias("embedding"))


MEANS_SQL = "SELECT label AS query_id, [" + ", ".join(
    f"avg(CAST(embedding[{i}] AS DOUBLE))" for i in range(1, DIMENSIONS + 1)
) + "] AS q FROM embeddings GROUP BY label"


@query("k1_semantic_search", f"""
WITH means AS ({MEANS_SQL}),
scored AS (
  SELECT query_id, vec_id,
    round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 9) AS score
  FROM means, embeddings)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5""")
def semantic_search(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    return search.semantic_search(label_means(embeddings), embeddings, 5)


@query("j5_query_corpus_scores", f"""
WITH means AS ({MEANS_SQL})
SELECT vec_id, label, round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 9) AS score
FROM embeddings JOIN means ON label = query_id""")
def query_corpus_scores(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    # one vector per label, found by the label: an equi-join, small side chosen by Spark
    means = label_means(embeddings).withColumnRenamed("embedding", "q")
    return embeddings.join(means, F.col("label") == F.col("query_id")).select(
        "vec_id", "label",
        F.round(cosine(F.col("q"), as_doubles(F.col("embedding"))), 9).alias("score"))


@query("n1_clusters", """
SELECT vec_id, vec_id % 50 <> 7 AS clustered, CASE WHEN vec_id % 50 <> 7 THEN true END AS at_nearest
FROM embeddings""")
def clusters(spark, sf_dir):
    """Settled clusters: every row is at the nearest of the means of the clusters' members."""
    missing = F.when(F.col("vec_id") % 50 != 7, F.col("embedding"))
    rows = materialise(similarity.cluster(
        table(spark, sf_dir, "embeddings").withColumn("embedding", missing), 2, max_iter=300, tol=0.0),
        "clusters")
    vector = as_doubles(F.col("embedding"))
    # one row per cluster
    means = rows.where("cluster IS NOT NULL").groupBy("cluster").agg(
        F.array(*[F.avg(F.get(vector, F.lit(i))) for i in range(DIMENSIONS)]).alias("mean"))
    other = rows.select("vec_id", vector.alias("v"), F.explode(F.array(F.lit(0), F.lit(1))).alias("there"))
    gap = F.aggregate(F.zip_with("v", "mean", lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                      lambda s, x: s + x)
    nearest = other.join(F.broadcast(means), F.col("there") == F.col("cluster")).groupBy("vec_id").agg(
        F.min_by("there", F.struct(gap, "there")).alias("nearest"))
    return rows.select("vec_id", "cluster").join(nearest, "vec_id").select(
        "vec_id", F.col("cluster").isNotNull().alias("clustered"),
        (F.col("nearest") == F.col("cluster")).alias("at_nearest"))


ODD_SQL = """CASE vec_id % 40 WHEN 3 THEN 'missing' WHEN 5 THEN 'size 63' WHEN 9 THEN 'not finite'
  WHEN 11 THEN 'not finite' END"""


def with_odd_vectors(embeddings):
    kind, vector = F.col("vec_id") % 40, as_doubles(F.col("embedding"))
    odd = F.when(kind == 5, F.slice(vector, 1, DIMENSIONS - 1)) \
        .when(kind == 9, F.concat(F.slice(vector, 1, DIMENSIONS - 1), F.array(F.lit(float("nan"))))) \
        .when(kind == 11, F.concat(F.array(F.lit(None).cast("double")), F.slice(vector, 2, DIMENSIONS - 1))) \
        .when(kind != 3, vector)
    return embeddings.withColumn("embedding", odd)


@query("k1_odd_vectors", f"""
WITH means AS ({MEANS_SQL}),
scored AS (
  SELECT query_id, vec_id,
    round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 9) AS score
  FROM means, embeddings WHERE {ODD_SQL} IS NULL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(NULL AS VARCHAR) AS reason FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
UNION ALL SELECT NULL, NULL, vec_id, {ODD_SQL} FROM embeddings WHERE {ODD_SQL} IS NOT NULL""")
def odd_vectors(spark, sf_dir):
    """A search that leaves odd vectors out, and the list of them."""
    embeddings = table(spark, sf_dir, "embeddings")
    corpus = with_odd_vectors(embeddings)
    found = search.semantic_search(label_means(embeddings), corpus, 5, on_odd="leave_out")
    return joining.bind_rows(found.drop("score"), search.odd_vectors(corpus, DIMENSIONS)).select(
        "query_id", "rank", "vec_id", "reason")


@query("n2_near_duplicates", """
SELECT b.vec_id, min(a.vec_id) AS duplicate_of FROM embeddings a JOIN embeddings b
ON a.vec_id < b.vec_id AND list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
                                                  CAST(b.embedding AS DOUBLE[])) >= 0.4
GROUP BY b.vec_id""")
def near_duplicates(spark, sf_dir):
    return similarity.near_duplicates(table(spark, sf_dir, "embeddings"), 0.4)


SHIFT = 1_000_000_000


@query("n2_planted_near_copies", f"""
WITH rows AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  UNION ALL
  SELECT vec_id + {SHIFT}, list_transform(range(1, len(embedding) + 1),
    lambda i: CAST(embedding[i] AS DOUBLE) + CASE WHEN i = vec_id % 64 + 1 THEN (vec_id % 8) / 16.0 ELSE 0 END)
  FROM embeddings)
SELECT b.vec_id, min(a.vec_id) AS duplicate_of FROM rows a JOIN rows b
ON a.vec_id < b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
GROUP BY b.vec_id""")
def planted_near_copies(spark, sf_dir):
    """Every vector again with one number moved, by eight steps: the small ones are found."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", as_doubles(F.col("embedding")).alias("embedding"))
    moved = F.transform("embedding", lambda x, i: F.when(
        i == F.col("vec_id") % DIMENSIONS, x + (F.col("vec_id") % 8) / F.lit(16.0)).otherwise(x))
    return similarity.near_duplicates(embeddings.unionAll(
        embeddings.select((F.col("vec_id") + SHIFT).alias("vec_id"), moved)), 0.95)


@query("n3_run_difference", """
SELECT vec_id, CAST(CASE WHEN vec_id % 3 = 0 THEN 0.25 ELSE 0 END AS DOUBLE) AS max_abs_diff FROM embeddings""")
def run_difference(spark, sf_dir):
    first = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * 8) / 8).alias("embedding"))
    shifted = F.transform("embedding", lambda x, i: F.when(
        (F.col("vec_id") % 3 == 0) & (i == 7), x + 0.25).otherwise(x))
    return joining.run_difference(first, first.withColumn("embedding", shifted), "vec_id").select(
        "vec_id", F.col("max_abs_diff").cast("double"))

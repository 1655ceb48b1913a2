"""Review queue: signals, priority, quotas, near duplicates, diverse picks."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window as W, functions as F

from boxloom.functions.scalars import binary_entropy, hamming, least_confidence
from boxloom.operators.scale import exact_percent_rank, part_running_sum, range_parts
from boxloom.operators.review import hash_order
from boxloom.operators.similarity import embedding_pairs
from boxloom.session import checkpointed, stored


def uncertainty(df: DataFrame) -> DataFrame:
    return df.withColumns({"least_confidence": least_confidence("score"), "entropy": binary_entropy("score")})


def class_margin(df: DataFrame, keys: list[str]) -> DataFrame:
    """Best minus second best class score of a cluster; 1 - nothing when only one class is seen."""
    per_class = df.groupBy(*keys, "class_id").agg(F.max("score").alias("score"))
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "class_id")
    top = per_class.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= 2)
    first = F.max(F.when(F.col("_n") == 1, F.col("score")))
    second = F.max(F.when(F.col("_n") == 2, F.col("score")))
    return top.groupBy(*keys).agg(
        F.max(F.when(F.col("_n") == 1, F.col("class_id"))).alias("class_id"),
        (first - F.coalesce(second, F.lit(0.0))).alias("margin"),
    )


def rank_signal(df: DataFrame, signal: str) -> DataFrame:
    """Relative rank in [0, 1] of a signal over the whole queue (one sort of its distinct values)."""
    return exact_percent_rank(df, signal, f"{signal}_rank")


def under_represented(images: DataFrame, dims: list[str], ident: str = "image_id") -> DataFrame:
    """How rare an image's cell (camera, hour of day, ...) is: 0 for the fullest cell, towards 1 for the emptiest."""
    counts = images.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"))
    rarity = counts.withColumn("under_represented", 1.0 - F.col("_n") / counts.agg(F.max("_n")).scalar()).drop("_n")
    return images.select(ident, *dims).join(rarity, dims).select(ident, "under_represented")


def temporal_inconsistency(hits: DataFrame, ident: str = "image_id") -> DataFrame:
    """Share of an image's tracked boxes that stand alone in time. `hits` holds `isolated` per box."""
    return hits.groupBy(ident).agg(F.avg(F.col("isolated").cast("double")).alias("temporal"))


def diversity(vectors: DataFrame, ident: str = "vec_id", cluster: str = "label") -> DataFrame:
    """How sparse the region of an embedding is: 1 over the size of its cluster."""
    sizes = vectors.groupBy(cluster).agg((1.0 / F.count(F.lit(1))).alias("diversity"))
    return vectors.select(ident, cluster).join(sizes, cluster).select(ident, "diversity")


def mistake_score(disagreement: DataFrame) -> DataFrame:
    """Possible annotation mistakes per image: detections (a) against human labels (b).

    A missing label or another class weighs the detection's score, a poor location the lost overlap.
    """
    points = (
        F.when(F.col("kind").isin("a_only", "class"), F.col("a_score"))
        .when(F.col("kind") == "location", F.col("a_score") * (1.0 - F.col("iou")))
        .otherwise(0.0)
    )
    return disagreement.groupBy("image_id").agg(F.max(points).alias("mistake"))


def review_priority(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted sum of signals held to [0, 1]; a missing signal counts 0."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        held = F.least(F.greatest(F.coalesce(F.col(name), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
        total = total + F.lit(float(weight)) * held
    return df.withColumn("priority", total)


def top_queue(df: DataFrame, k: int, ident: str = "image_id") -> DataFrame:
    return df.orderBy(F.col("priority").desc(), F.col(ident)).limit(k)


def quota_rank(df: DataFrame, dims: list[str], ident: str = "image_id") -> DataFrame:
    """Rank of every row in its cell by (priority desc, id). A cell of any size is spread over range parts."""
    order = [F.col("priority").desc(), F.col(ident).asc()]
    return part_running_sum(range_parts(df, dims, order), dims, order, {"quota_rank": F.lit(1).cast("bigint")})


def quota_batch(df: DataFrame, dims: list[str], quota: int, k: int, ident: str = "image_id") -> DataFrame:
    """Best `quota` rows of each cell first, then the best of the rest up to `k` rows in all.

    The rank filter lets Spark keep only `quota` rows per cell before the shuffle.
    """
    df = stored(df)  # read twice below
    order = W.partitionBy(*dims).orderBy(F.col("priority").desc(), F.col(ident))
    chosen = df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= quota).drop("_rank")
    chosen = chosen.withColumn("_first", F.lit(0)).orderBy(F.col("priority").desc(), F.col(ident)).limit(k)
    rest = df.join(chosen.select(ident, *dims), [ident, *dims], "left_anti").withColumn("_first", F.lit(1))
    rest = rest.orderBy(F.col("priority").desc(), F.col(ident)).limit(k)
    both = chosen.unionByName(rest).orderBy("_first", F.col("priority").desc(), F.col(ident)).limit(k)
    return both.withColumn("picked_by", F.when(F.col("_first") == 0, "quota").otherwise("fill")).drop("_first")


def near_duplicates(df: DataFrame, max_dist: int, *, ident: str = "image_id", bands: int | None = None) -> DataFrame:
    """Near duplicates by 64-bit hash (`hash` column), exact for every distance up to `max_dist`.

    Equal hashes are reduced to the smallest id first: each further copy is one row against that
    id, so a pile of copies gives as many rows as copies. Distinct hashes meet only where
    `bands - max_dist` of their bands agree, which any close pair must do by counting.
    """
    bands = bands or max_dist + 2
    if not max_dist < bands <= 64:
        raise ValueError("bands must lie above max_dist and at most 64")
    first = df.groupBy("hash").agg(F.min(ident).alias("rep"))
    copies = df.join(first, "hash").filter(F.col(ident) != F.col("rep"))
    copies = copies.select(F.col("rep").alias("id_a"), F.col(ident).alias("id_b"), F.lit(0).alias("distance"))
    edges = [round(64 * i / bands) for i in range(bands + 1)]

    def band(i: int):
        low, high = edges[i], edges[i + 1]
        mask = (1 << (high - low)) - 1
        return F.shiftrightunsigned("hash", low).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))

    combos = [
        F.struct(F.lit(n).alias("n"), F.array(*[band(i) for i in chosen]).alias("v"))
        for n, chosen in enumerate(combinations(range(bands), bands - max_dist))
    ]
    keyed = first.withColumn("_key", F.explode(F.array(*combos)))
    a = keyed.select("_key", F.col("rep").alias("id_a"), F.col("hash").alias("hash_a"))
    b = keyed.select("_key", F.col("rep").alias("id_b"), F.col("hash").alias("hash_b"))
    near = a.join(b, "_key").filter((F.col("id_a") < F.col("id_b")) & (hamming("hash_a", "hash_b") <= max_dist))
    near = near.select("id_a", "id_b", hamming("hash_a", "hash_b").alias("distance")).distinct()
    return copies.unionByName(near)


def diverse_pick(
    df: DataFrame, k: int, seed: int, *, ident: str = "vec_id", vector: str = "embedding", min_cosine: float | None = None
) -> DataFrame:
    """About `k` rows from as many regions of the embedding space: the best row of each cluster.

    With `min_cosine`, a pick leaves if a better one (by priority, then hash of the id) is a near duplicate of it.
    """
    rows = df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(rows)
    placed = model.transform(rows).drop("_features")
    rank = F.struct(F.col("priority"), hash_order(str(seed), ident)) if "priority" in df.columns else F.struct(hash_order(str(seed), ident))
    best = placed.groupBy("cluster").agg(F.max_by(F.struct(*df.columns), rank).alias("_b"), F.count(F.lit(1)).alias("cluster_size"), F.max(rank).alias("_rank"))
    best = best.select("cluster", "cluster_size", "_rank", "_b.*")
    if min_cosine is not None:
        best = checkpointed(best)
        near = embedding_pairs(best, min_cosine, ident=ident, vector=vector)
        ranks = best.select(F.col(ident).alias("_id"), F.col("_rank").alias("_r"))
        sides = near.join(ranks.withColumnsRenamed({"_id": "id_a", "_r": "_ra"}), "id_a").join(ranks.withColumnsRenamed({"_id": "id_b", "_r": "_rb"}), "id_b")
        worse = sides.select(F.when(F.col("_ra") < F.col("_rb"), F.col("id_a")).otherwise(F.col("id_b")).alias(ident)).distinct()
        best = best.join(worse, ident, "left_anti")
    return best.select("cluster", "cluster_size", *df.columns)

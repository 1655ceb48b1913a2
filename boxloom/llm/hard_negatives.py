"""Hard negatives by bounds along spanning trees of anchors.

Anchors of one label are joined by a minimum spanning tree of their distances. Against a candidate x, a child anchor's
score differs from its parent's by at most (edge length) * |x|, so a score, or an interval for it, carries on from
parent to child. A candidate is scored anew only where the interval meets what is still open: the lowest of the best
positives so far, or the window of a positive above the lowest of its best negatives so far. All scores are integer
products, so the result is exact.

Candidates travel as packed blocks, each to every shelf of trees; a task holds a tree and a block. Best rows are
merged by group, never gathered: an anchor has at most POSITIVES rows per block, then NEGATIVES per positive and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from boxloom.llm.common import checkpointed, table
from boxloom.llm.registry import query

POSITIVES, NEGATIVES = 5, 3
#: Anchors of a tree, candidates of a block, trees of a shelf, and most copies of an anchor that block keys ask for.
TREE, BLOCK, SHELF, SPREAD = 1_024, 2_048, 256, 8_192
#: Blocks that share a copy of the trees once there are many.
BLOCKS_A_KEY = 64
#: Scores that a double holds exactly.
EXACT = float(2**53)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent (place in the order, -1 for the root) and edge length of a minimum spanning tree of the rows of x.

    Parents come before their children; each step adds the row nearest to the tree. Holds a few numbers per row.
    """
    n = len(x)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    best, via, open_ = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    at = 0
    for step in range(n):
        if step:
            at = int(np.argmin(np.where(open_, best, np.inf)))
            parent[step], edge[step] = via[at], best[at]
        order[step], open_[at] = at, False
        gap = np.sqrt(((x - x[at]) ** 2).sum(1))
        nearer = open_ & (gap < best)
        best[nearer], via[nearer] = gap[nearer], step
    return order, parent, edge


class Tree:
    """Anchors of one label in tree order, with intervals for their scores against a block of candidates."""

    def __init__(self, vectors: np.ndarray, parent: np.ndarray, edge: np.ndarray) -> None:
        self.q, self.parent, self.edge = vectors, parent, edge
        self.norms = np.sqrt((vectors.astype(float) ** 2).sum(1))

    def walk(self, x: np.ndarray):
        """Yield (anchor, lower bounds, upper bounds, settle) in tree order.

        settle(wanted) gives the rows of x that are wanted and their exact scores; others keep their interval.
        """
        norms = np.sqrt((x.astype(float) ** 2).sum(1))
        small = self.norms.max(initial=0) * norms.max(initial=0) < EXACT
        doubles = x.astype(float) if small else x
        low, high = np.empty((len(self.q), len(x))), np.empty((len(self.q), len(x)))
        for a in range(len(self.q)):
            p = self.parent[a]
            if p < 0:
                low[a], high[a] = -np.inf, np.inf
            else:
                # one unit and a relative margin beyond the bound, for the rounding of its own computation
                slack = self.edge[a] * norms * (1 + 1e-9) + 1 + 1e-12 * self.norms[p] * norms
                np.subtract(low[p], slack, out=low[a])
                np.add(high[p], slack, out=high[a])

            def settle(wanted: np.ndarray, a: int = a) -> tuple[np.ndarray, np.ndarray]:
                rows = np.flatnonzero(wanted)
                if small:
                    anchor = self.q[a].astype(float)
                    scores = (doubles @ anchor)[rows] if 2 * len(rows) > len(x) else doubles[rows] @ anchor
                else:
                    scores = doubles[rows] @ self.q[a]
                low[a][rows] = high[a][rows] = scores
                return rows, scores.astype(np.int64)

            yield a, low[a], high[a], settle


def best_of(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the best rows: higher scores first, ties by smaller id."""
    if len(ids) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:most]]
    return np.lexsort((ids, -scores))


def windows(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest integer n with 50 p <= 100 n <= 95 p."""
    return -(-positive // 2), positive // 20 * 19 + positive % 20 * 19 // 20


def chunks(trees: int, rows: np.ndarray) -> Iterator[np.ndarray]:
    step = max(256, 4_000_000 // max(1, trees))
    for k in range(0, len(rows), step):
        yield rows[k : k + step]


def positives_of(tree: Tree, anchors: np.ndarray, x: np.ndarray, ids: np.ndarray, most: int):
    """(anchor, id, score) of the best rows with another id, for each anchor of the tree."""
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in anchors]
    for part in chunks(len(anchors), np.arange(len(x))):
        for a, low, high, settle in tree.walk(x[part]):
            known, points = held[a]
            wanted = ids[part] != anchors[a]
            if len(points) == most:
                wanted &= high >= points[-1]
            if np.count_nonzero(wanted) > most:  # so many rows score at least this, whatever the others do
                wanted &= high >= np.partition(low[wanted], -most)[-most]
            rows, scores = settle(wanted)
            known, points = np.concatenate([known, ids[part][rows]]), np.concatenate([points, scores])
            keep = best_of(known, points, most)
            held[a] = known[keep], points[keep]
    return held


def negatives_of(tree: Tree, asked: list[np.ndarray], x: np.ndarray, ids: np.ndarray, most: int):
    """For each anchor and each of its positive scores, (ids, scores) of the best rows inside the window."""
    none = np.zeros(0, np.int64)
    held = [[(none, none) for _ in scores] for scores in asked]
    spans = [windows(scores) for scores in asked]
    for part in chunks(len(asked), np.arange(len(x))):
        for a, low, high, settle in tree.walk(x[part]):
            bottom, top = spans[a]
            floor = np.array([max(b, points[-1]) if len(points) == most else b for b, (_, points) in zip(bottom, held[a])], np.int64)
            live = floor <= top
            wanted = (high >= floor[live].min()) & (low <= top[live].max()) if live.any() else np.zeros(len(part), bool)
            rows, scores = settle(wanted)
            for j in np.flatnonzero(live):
                inside = (scores >= floor[j]) & (scores <= top[j])
                if inside.any():
                    known, points = held[a][j]
                    known, points = np.concatenate([known, ids[part][rows[inside]]]), np.concatenate([points, scores[inside]])
                    keep = best_of(known, points, most)
                    held[a][j] = known[keep], points[keep]
    return held


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label (long) and q, the floors of scale * component, of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**40))
    rows = vectors.filter("vec_id is not null and label is not null").filter(F.coalesce(fine, F.lit(False)))
    label = F.col("label").cast("long")
    q = F.transform(v, lambda x: F.floor(x * scale).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), q.alias("q"))
    length = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return rows.filter(length < 2.0**62)



def narrow(x: np.ndarray) -> bytes:
    """Vectors in the smallest integers that hold them, after one byte that tells which."""
    for code, kind in enumerate((np.int16, np.int32)):
        if x.size == 0 or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return bytes([code]) + x.astype(kind).tobytes()
    return bytes([2]) + x.tobytes()


def wide(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, (np.int16, np.int32, np.int64)[data[0]], offset=1).astype(np.int64).reshape(-1, width)


def mine(vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of `vectors` (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by `every`. Scores are integer products of vectors whose components
    were multiplied by `scale` and rounded down. An anchor's positives are its first rows of the same label and another
    vec_id, by score and then smaller vec_id; for each positive the first rows of another label with
    50 * positive_score <= 100 * negative_score <= 95 * positive_score are its negatives, ranked from 1.

    Rows with a null vec_id or label, or a null or empty vector, or one with a null or non-finite component, take no
    part; nor do those with a component of 2^40 or more or a scaled length of 2^31 or more, whose scores might not fit
    a long. Only vectors of the same width meet. Repeated rows count as rows each, but anchors that agree in
    vec_id, label and vector are one. Other columns are not read; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale).withColumn("width", F.size("q"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                x = part.column("q").flatten().to_numpy().reshape(-1, width)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                for k in range(0, len(x), BLOCK):
                    s = slice(k, k + BLOCK)
                    yield pa.RecordBatch.from_pylist([{
                        "width": int(width), "rows": len(ids[s]), "c_ids": ids[s].tobytes(), "c_labels": labels[s].tobytes(), "c_vectors": narrow(x[s]),
                    }], schema=blocks_schema)

    blocks_schema = pa.schema([("width", pa.int32()), ("rows", pa.int64()), ("c_ids", pa.binary()), ("c_labels", pa.binary()), ("c_vectors", pa.binary())])
    blocks = checkpointed(rows.mapInArrow(pack, "width int, rows long, c_ids binary, c_labels binary, c_vectors binary"))

    # trees: anchors of a width and label, dealt over as many parts as their number asks for
    anchors = checkpointed(rows.filter(F.col("vec_id") % every == 0).distinct())
    sizes = anchors.groupBy("width", "label").agg(F.ceil(F.count(F.lit(1)) / TREE).cast("long").alias("parts"))
    dealt = anchors.join(sizes, ["width", "label"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "q"), F.col("parts")))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        q = np.stack(group["q"]).astype(np.int64)
        order, parent, edge = spanning_tree(q.astype(float))
        return pd.DataFrame([{
            "width": int(group["width"].iloc[0]), "label": int(group["label"].iloc[0]), "part": int(group["part"].iloc[0]),
            "a_ids": group["vec_id"].to_numpy(np.int64)[order].tobytes(), "a_keys": group["key"].to_numpy(np.int64)[order].tobytes(),
            "a_vectors": narrow(q[order]), "parents": parent.astype(np.int64).tobytes(), "edges": edge.tobytes(),
        }])

    keyed = dealt.withColumn("key", F.xxhash64("vec_id", "label", "q"))
    trees = keyed.groupBy("width", "label", "part").applyInPandas(
        grow, "width int, label long, part long, a_ids binary, a_keys binary, a_vectors binary, parents binary, edges binary")
    # a tree's shelf, and how many keys the blocks are dealt over
    n_blocks, n_trees = blocks.count(), sizes.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    shelves = max(1, -(-n_trees // SHELF))
    keys = max(1, min(n_blocks, max(64, n_blocks // BLOCKS_A_KEY), SPREAD))
    trees = checkpointed(trees.withColumn("shelf", F.pmod(F.xxhash64("label", "part"), F.lit(shelves))))
    on = ["width", "shelf", "deal"]
    spread = blocks.withColumn("deal", F.pmod(F.xxhash64("c_ids"), F.lit(keys))).withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1)).cast("array<long>")))
    copies = trees.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(keys - 1)).cast("array<long>")))
    work = spread.repartition(*on).join(copies, on)

    def opened(batch: pa.RecordBatch) -> Iterator[tuple]:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            width = row["width"]
            longs = {c: np.frombuffer(row[c], np.int64) for c in ("c_ids", "c_labels", "a_ids", "a_keys", "parents")}
            tree = Tree(wide(row["a_vectors"], width), longs["parents"], np.frombuffer(row["edges"]))
            yield row, longs, tree, wide(row["c_vectors"], width)

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, longs, tree, x in opened(batch):
                same = longs["c_labels"] == row["label"]
                held = positives_of(tree, longs["a_ids"], x[same], longs["c_ids"][same], positives)
                n = [len(ids) for ids, _ in held]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(longs["a_ids"], n)), pa.array(np.repeat(longs["a_keys"], n)),
                    *[pa.array(np.concatenate([h[k] for h in held])) for k in (0, 1)],
                ], ["anchor_id", "key", "positive_id", "positive_score"])

    some = work.mapInArrow(find_positives, "anchor_id long, key long, positive_id long, positive_score long")
    first = W.partitionBy("anchor_id", "key").orderBy(F.desc("positive_score"), "positive_id")
    chosen = checkpointed(some.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives))
    # the scores asked for ride on the trees
    asked = chosen.groupBy("anchor_id", "key").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("asked"))
    asked = asked.join(keyed.select(F.col("vec_id").alias("anchor_id"), "key", "width", "label", "part"), ["anchor_id", "key"])
    asked = asked.groupBy("width", "label", "part").agg(F.collect_list(F.struct("key", "anchor_id", F.col("asked.positive_score").alias("scores"))).alias("asked"))
    again = trees.join(asked, ["width", "label", "part"]).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(keys - 1)).cast("array<long>")))
    work = spread.repartition(*on).join(again, on)

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, longs, tree, x in opened(batch):
                known = {(a["anchor_id"], a["key"]): np.array(a["scores"], np.int64) for a in row["asked"]}
                scores = [known.get(a, np.zeros(0, np.int64)) for a in zip(longs["a_ids"].tolist(), longs["a_keys"].tolist())]
                other = longs["c_labels"] != row["label"]
                held = negatives_of(tree, scores, x[other], longs["c_ids"][other], negatives)
                found = [(a, j, *pair) for a, anchor in enumerate(held) for j, pair in enumerate(anchor) if len(pair[0])]
                if found:
                    n = [len(f[2]) for f in found]
                    at = np.repeat([f[0] for f in found], n)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(longs["a_ids"][at]), pa.array(longs["a_keys"][at]), pa.array(np.repeat([f[1] + 1 for f in found], n).astype(np.int32)),
                        *[pa.array(np.concatenate([f[k] for f in found])) for k in (2, 3)],
                    ], ["anchor_id", "key", "place", "negative_id", "negative_score"])

    some = work.mapInArrow(find_negatives, "anchor_id long, key long, place int, negative_id long, negative_score long")
    first = W.partitionBy("anchor_id", "key", "place").orderBy(F.desc("negative_score"), "negative_id")
    taken = some.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    out = taken.join(chosen, ["anchor_id", "key", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


@query(
    """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS k,
    other_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 3
"""
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors, searched among all vectors."""
    return mine(table(spark, sf_dir, "embeddings"))

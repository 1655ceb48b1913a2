"""Similarity join over embeddings: blocks of all rows or random hyperplanes find candidates, exact cosines decide."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from boxloom.functions.scalars import c, cosine
from boxloom.session import checkpointed, stored

#: Rows that a bucket should hold on average, and rows beyond which it is cut into blocks.
BUCKET, HOT = 64, 1_024
#: Chance that a pair at the threshold is found: no pair is lost in practice, for three times the tables that 0.999 takes.
RECALL = 1 - 1e-9
#: Hyperplanes of a worker that are kept between batches, in numbers.
KEPT_PLANES = 16_000_000
#: Copies of a row that are dealt at a time, so that the disk holds no more of them.
COPIES = 16


def lsh_plan(n: int, min_cosine: float, recall: float, bucket: int = BUCKET) -> tuple[int, int]:
    """Bits of a key and number of tables: the bits cut n rows into buckets, the tables find a pair at the threshold.

    A hyperplane parts two vectors with a chance of angle / pi, so a pair at `min_cosine` shares a key of b bits with
    chance p^b, and one of t tables finds it with 1 - (1 - p^b)^t. Nearer pairs are found more surely.
    """
    if not 0 < min_cosine <= 1 or not 0 < recall < 1:
        raise ValueError("min_cosine must lie in (0, 1] and recall in (0, 1)")
    bits = min(48, max(6, round(math.log2(max(1, n) / bucket)) if n > bucket else 6))
    agree = (1 - math.acos(min_cosine) / math.pi) ** bits
    return bits, 1 if agree >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def usable(vector: str) -> Column:
    """Vectors with a direction: not null, empty or zero, all components finite."""
    fine = (F.size(c(vector)) > 0) & F.forall(c(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(c(vector), lambda x: x != 0), F.lit(False))


class Planes:
    """Seeded hyperplanes per width and table; the same in every task."""

    def __init__(self, bits: int, tables: int, seed: int) -> None:
        self.bits, self.tables, self.seed = bits, tables, seed
        self.kept: dict[tuple[int, int], np.ndarray] = {}

    def of(self, width: int, table: int) -> np.ndarray:
        planes = self.kept.get((width, table))
        if planes is None:
            planes = np.random.default_rng([self.seed, width, table]).standard_normal((width, self.bits))
            if (len(self.kept) + 1) * planes.size <= KEPT_PLANES:
                self.kept[width, table] = planes
        return planes

    def keys(self, x: np.ndarray, table: int) -> np.ndarray:
        return (x @ self.of(x.shape[1], table) > 0) @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow for large components
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def by_width(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, unit vectors) of a batch, one width at a time."""
    sizes, values = pa.compute.list_value_length(batch.column("v")).to_numpy(), batch.column("v")
    for width in np.unique(sizes):
        part = pa.array(sizes == width)
        x = values.filter(part).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        yield batch.column("id").filter(part).to_numpy(), unit(x)


def sketch(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors in bytes, the scale of each, and the distance of each from what the bytes say."""
    scale = np.abs(x).max(1) / 127
    small = np.rint(x / scale[:, None]).astype(np.int8)
    return small, scale, np.sqrt(((small * scale[:, None] - x) ** 2).sum(1))


def near_rows(table: pa.Table, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pairs of a bucket, or of two of its blocks, that may reach the threshold by their sketches."""
    ids, block, scale, error = (table.column(n).to_numpy() for n in ("id", "block", "scale", "error"))
    x = np.stack([np.frombuffer(s, np.int8) for s in table.column("sketch").to_pylist()]).astype(np.float32)
    p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
    left = np.flatnonzero(block == p)
    right = left if p == q else np.flatnonzero(block == q)
    none = np.zeros(0, np.int64)
    a, b = [none], [none]
    for k in range(0, len(left), 512):
        rows = left[k : k + 512]
        product = (x[rows] @ x[right].T) * np.outer(scale[rows], scale[right])  # sums of whole numbers below 2^24, exact for width 1,024
        bound = error[rows][:, None] + (1 + error[rows][:, None]) * error[right][None, :] + 1e-4
        i, j = np.nonzero(product + bound >= min_cosine)
        i, j = ids[rows[i]], ids[right[j]]
        some = i < j if p == q else i != j
        a.append(np.minimum(i, j)[some])
        b.append(np.maximum(i, j)[some])
    return np.concatenate(a), np.concatenate(b)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of batches sorted by long columns; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            name = tuple(at[:, a].tolist())
            if held and name != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = name
    if held:
        yield pa.Table.from_batches(held)


def candidates(rows: DataFrame, min_cosine: float, recall: float, seed: int, hot: int) -> DataFrame:
    """Pairs (id_a < id_b) of `rows` (id, v) that share a key in some table and may reach the threshold.

    A bucket of more than `hot` rows is cut into blocks and its rows copied to every pair of blocks, so that no task
    holds more than two blocks; only the counts of buckets are shuffled to find it. Buckets and pairs of blocks take turns
    where a row has more than COPIES copies: the disk of one turn is free before the next.
    """
    n = rows.count()
    bits, tables = lsh_plan(n, min_cosine, recall)
    if n <= tables * hot:
        bits, tables = 0, 1  # all rows in one bucket: its blocks copy a row no more often than the tables would, and miss nothing
    planes = Planes(bits, tables, seed)

    def keys_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in by_width(batch):
                for t in range(tables):
                    found, n = np.unique(planes.keys(x, t), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k)) for k in (x.shape[1], t)] + [pa.array(found), pa.array(n)], ["width", "t", "key", "n"])

    turns = max(1, -(-(tables if tables > 1 else n // hot) // COPIES))

    def sketched(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in by_width(batch):
                small, scale, error = sketch(x)
                data = pa.array([s.tobytes() for s in small], pa.binary())
                for t in range(turn, tables, turns) if tables > 1 else [0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), k)) for k in (x.shape[1], t)] + [pa.array(v) for v in (planes.keys(x, t), ids)] + [data, pa.array(scale), pa.array(error)],
                        ["width", "t", "key", "id", "sketch", "scale", "error"])

    bucket = ["width", "t", "key"]
    counts = rows.mapInArrow(keys_only, "width long, t long, key long, n long").groupBy(*bucket).agg(F.sum("n").alias("n"))
    hot_buckets = checkpointed(counts.filter(F.col("n") > hot).select(*bucket, F.ceil(F.col("n") / hot).cast("long").alias("parts")))
    heavy = not hot_buckets.isEmpty()

    def dealt(turn: int) -> DataFrame:
        keyed = rows.mapInArrow(lambda batches: sketched(batches, turn), "width long, t long, key long, id long, sketch binary, scale double, error double")
        keyed = keyed.join(hot_buckets, bucket, "left") if heavy else keyed.withColumn("parts", F.lit(None).cast("long"))
        parts = F.coalesce("parts", F.lit(1).cast("long"))
        out = keyed.withColumn("block", F.pmod(F.xxhash64("id"), parts)).withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        out = out.withColumns({"p": F.least("_x", "block"), "q": F.greatest("_x", "block")}).drop("_x", "parts")
        return out if tables > 1 or turns == 1 else out.filter(F.pmod(F.xxhash64("width", "p", "q"), F.lit(turns)) == turn)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, [*bucket, "p", "q"]):
            if group.num_rows > 1:
                a, b = near_rows(group, min_cosine)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["id_a", "id_b"])

    whole = [*bucket, "p", "q"]
    found = [dealt(turn).repartition(*whole).sortWithinPartitions(*whole).mapInArrow(compare, "id_a long, id_b long").distinct() for turn in range(turns)]
    return found[0] if turns == 1 else reduce(DataFrame.unionAll, [stored(f) for f in found]).distinct()


def embedding_pairs(
    vectors: DataFrame, min_cosine: float = 0.9, *, ident: str = "vec_id", vector: str = "embedding", recall: float = RECALL, seed: int = 7, hot: int = HOT
) -> DataFrame:
    """(id_a, id_b, cosine) of vectors at a cosine of at least `min_cosine`, none below; one row per pair.

    Equal vectors (by 128 bits of hash) fall to the smallest id first: each further copy is one row against that id, so
    a pile of copies gives as many rows as copies. Of different vectors every pair is given: all are
    compared where that copies them less than the tables would, else a pair is missed with a chance of 1 - `recall` at the threshold and less above it. Null, empty and zero vectors, and those with null or non-finite
    components, pair with nothing; nor do vectors of different width. Ids are longs; rows without one are left out.
    """
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.transform(v, lambda x: x + 0.0).alias("v")).filter(F.col("id").isNotNull() & usable("v"))
    rows = rows.withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(3), F.size("v"), F.reverse("v"))})
    first = checkpointed(rows.groupBy("h", "g").agg(F.min("id").alias("id"), F.any_value("v").alias("v")))
    copies = rows.select("id", "h", "g").join(first.select(F.col("id").alias("id_a"), "h", "g"), ["h", "g"]).filter("id <> id_a")
    copies = copies.select("id_a", F.col("id").alias("id_b"), F.lit(1.0).alias("cosine")).distinct()
    # an id with several vectors stands for all of them; a pair keeps its best cosine
    found = candidates(first.select("id", "v"), min_cosine, recall, seed, hot)
    exact = cosine_recheck(found, first.select("id", "v"), min_cosine, ident="id", vector="v")
    return copies.unionByName(exact.groupBy("id_a", "id_b").agg(F.max("cosine").alias("cosine")))


def cosine_recheck(pairs: DataFrame, vectors: DataFrame, min_cosine: float, *, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Exact cosine of candidate pairs."""
    a = vectors.select(F.col(ident).alias("id_a"), F.col(vector).alias("_va"))
    b = vectors.select(F.col(ident).alias("id_b"), F.col(vector).alias("_vb"))
    rows = pairs.join(a, "id_a").join(b, "id_b").withColumn("cosine", cosine("_va", "_vb"))
    return rows.filter(F.col("cosine") >= min_cosine).drop("_va", "_vb")

"""Connected components of an edge table, and streaming of sorted groups. Used by the similarity operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boxloom.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of all vertices that edges (a, b) tie to a smaller one; component is the smallest vertex reachable.

    Alternating large-star and small-star steps: neighbours move to the smallest one known, until nothing moves. The
    smallest is an aggregate combined before its shuffle and the join on the vertex may be split, so hubs are no
    bottleneck. Every round is frozen on the shared folder; nothing but two numbers reaches the driver.
    """
    e = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return e.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = checkpointed(small.select("e.u", "e.v").filter("u <> v").distinct())


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of batches sorted by long columns `keys`; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
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


def in_blocks(rows: DataFrame, key: str, blocks, ident: str) -> DataFrame:
    """Deal the rows of each `key` over `blocks` (a column) blocks by the hash of `ident`, and copy them to pairs of blocks.

    Adds p and q: with one block p = q = 0, else every pair of blocks p < q, so that any two rows of a key meet.
    """
    rows = rows.withColumn("_n", blocks.cast("long")).withColumn("_b", F.pmod(F.xxhash64(F.lit(7), ident), F.col("_n")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda x: x != F.col("_b"))
    rows = rows.withColumn("_x", F.explode(F.when(F.col("_n") == 1, F.array(F.lit(0).cast("long"))).otherwise(others)))
    return rows.withColumns({"p": F.least("_x", "_b"), "q": F.greatest("_x", "_b")}).drop("_n", "_b", "_x")


def edges_by(dealt: DataFrame, keys: list[str], kernel: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Edges (a, b) that `kernel` finds in each group of `keys`; groups are dealt by their keys and streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, n = [], [], 0
        for group in groups(batches, keys):
            left, right = kernel(group)
            a.append(left)
            b.append(right)
            n += len(left)
            if n > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])
                a, b, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def search(n: int, neighbours: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of an implicit graph on 0 .. n-1: `neighbours(v, others)` picks from the vertices not reached yet."""
    rest, a, b = np.arange(n), [], []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            v = queue.pop()
            near = neighbours(v, rest)
            if len(near):
                a.append(np.full(len(near), v))
                b.append(near)
                rest = np.setdiff1d(rest, near, assume_unique=True)
                queue += near.tolist()
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])

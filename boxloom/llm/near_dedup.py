"""Near-duplicate documents by SetSketch registers: band, estimate, verify.

Equal shingle sets first fall to one representative. Its registers (exponentially spaced truncated minima) are banded;
documents that share a band, have fitting sizes and enough equal registers are tied into candidate groups. Within a
group, pairs whose jointly estimated similarity may reach the threshold are confirmed on the full shingle sets.

Neither stage emits pairs: a large bucket or group is dealt over blocks of bounded size, every pair of blocks is one
unit of work, and each unit reports a spanning forest of the links it found. Pairs already tied are not looked at again.
What can be missed: two sets at the threshold share no band with probability (1 - t^4)^30 (2e-10 at 0.85, 1e-7 at
0.8), and fall below `margin` standard deviations of the register count with about 3e-7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.llm.common import checkpointed, known_id, lists, real_id, slices, table, texts
from boxloom.llm.components import components, edges_by, in_blocks, search
from boxloom.llm.registry import query
from boxloom.llm.setsketch import REGISTERS, Shingler, bands, estimate, registers

#: Documents, and shingles, that a block of a bucket or group holds about.
BLOCK_DOCS, BLOCK_SHINGLES = 1_024, 2_000_000
MARGIN = 5.0


def sketches(k: int):
    """Per document: set size, 128-bit digest of the set, registers and hashed bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in slices(batches, "text", 4_000_000):
            sets = [shingler(x) for x in texts(batch.column("text"))]
            digests = [xxhash.xxh3_128_intdigest(x.tobytes()) for x in sets]
            regs = np.stack([registers(x) for x in sets])
            keys = bands(regs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("t1"), batch.column("t2"), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([(d >> 64) - 2**63 for d in digests], pa.int64()), pa.array([(d & (2**64 - 1)) - 2**63 for d in digests], pa.int64()),
                    pa.array([x.tobytes() for x in regs], pa.binary()), lists(np.arange(len(sets) + 1) * keys.shape[1], keys.ravel()),
                ],
                ["doc_id", "t1", "t2", "n_shingles", "high", "low", "regs", "bands"],
            )

    return run


def keyed_sets(k: int):
    """Full sets, with the columns that deal them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in slices(batches, "text", 4_000_000):
            sets = [shingler(x).view(np.int64) for x in texts(batch.column("text"))]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("key"), batch.column("blocks"), lists(offsets, np.concatenate(sets))], ["row", "key", "blocks", "shingles"]
            )

    return run


def least_equal(percent: int) -> int:
    """Equal registers that a pair at the threshold has but for MARGIN standard deviations."""
    t = percent / 100
    return max(1, math.floor(REGISTERS * (t - MARGIN * math.sqrt(t * (1 - t) / REGISTERS))))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def fits(sizes: np.ndarray, v: int, rest: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that allow the threshold at all."""
    return 100 * np.minimum(sizes[v], sizes[rest]) >= percent * np.maximum(sizes[v], sizes[rest])


def alike(percent: int):
    """Ties within a bucket: fitting sizes and enough equal registers."""
    least = least_equal(percent)

    def kernel(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes, regs = group.column("row").to_numpy(), group.column("n_shingles").to_numpy(), matrix(group.column("regs"))

        def neighbours(v: int, rest: np.ndarray) -> np.ndarray:
            return rest[fits(sizes, v, rest, percent) & ((regs[rest] == regs[v]).sum(1) >= least)]

        a, b = search(len(ids), neighbours)
        return ids[a], ids[b]

    return kernel


def confirmed(percent: int):
    """Links within a candidate group: estimated jointly by likelihood, then verified on the full sets."""
    least = least_equal(percent)
    low = percent / 100 - MARGIN * math.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)

    def kernel(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = group.column("row").to_numpy()
        shingles = group.column("shingles").combine_chunks()
        flat, cuts = shingles.flatten().to_numpy().view(np.uint64), shingles.offsets.to_numpy().astype(np.int64)
        cuts = cuts - cuts[0]
        sets = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        sizes = np.diff(cuts)
        regs = np.stack([registers(x) for x in sets])

        def neighbours(v: int, rest: np.ndarray) -> np.ndarray:
            rest = rest[fits(sizes, v, rest, percent)]
            same = (regs[rest] == regs[v]).sum(1)
            rest, same = rest[same >= least], same[same >= least]
            if not len(rest):
                return rest
            more = (regs[rest] > regs[v]).sum(1)
            maybe = estimate(same, more, REGISTERS - same - more, sizes[rest].astype(float), np.full(len(rest), sizes[v], float)) >= low
            rest = rest[maybe]
            if not len(rest):
                return rest
            own = sets[v]
            other = np.concatenate([sets[u] for u in rest])
            at = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = np.add.reduceat((own[at] == other).astype(np.int64), np.cumsum(sizes[rest]) - sizes[rest])
            return rest[100 * both >= percent * (sizes[v] + sizes[rest] - both)]

        a, b = search(len(ids), neighbours)
        return ids[a], ids[b]

    return kernel


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of `docs`.

    Words are runs of anything but [\\x20\\x09-\\x0D], A-Z lower-cased. A document's set holds its distinct `shingle`-word
    shingles (64-bit hashes); with fewer words, the whole sequence as one. Documents are linked if 100 * intersection
    >= `percent` * union; component_id is the smallest doc_id reachable, kept tells whether it is the own one.

    Null and empty texts and texts without words have an empty set and are linked with nothing. Rows that share a
    doc_id are one document; rows without doc_id too, and that document comes before all others, its component_id being
    null where it is the smallest. Other columns are not read; an empty table gives an empty one.
    """
    # t1 and t2 tell the rows of one id apart where texts are read again
    slim = docs.select(known_id().alias("doc_id"), "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    kind = "doc_id long, t1 long, t2 long, n_shingles long, high long, low long, regs binary, bands array<long>"
    sketched = checkpointed(slim.mapInArrow(sketches(shingle), kind).withColumn("row", F.monotonically_increasing_id()))
    full = sketched.filter("n_shingles > 0")
    # equal sets are a class, named by one of its rows; everything up to the links is keyed by it, whatever ids repeat
    classes = checkpointed(full.groupBy("high", "low").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row")))
    reps = full.join(classes.select("row"), "row", "left_semi")
    members = reps.select("row", F.explode("bands").alias("key"))
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = checkpointed(members.join(counts, "key"))
    seen = shared.groupBy("row").agg(F.lit(1).alias("one")).select("row")
    known = full.join(seen, "row", "left_semi").select("row", "n_shingles", "regs")
    rows = in_blocks(shared.join(known, "row"), "key", F.ceil(F.col("n") / BLOCK_DOCS), "row")
    tied = edges_by(rows.select("key", "p", "q", "row", "n_shingles", "regs"), ["key", "p", "q"], alike(percent))
    candidates = components(tied)
    # candidate groups: their roots have no row of their own in `candidates`
    grouped = candidates.unionByName(candidates.select(F.col("component").alias("vertex"), "component").distinct())
    grouped = grouped.withColumnsRenamed({"vertex": "row", "component": "key"})
    grouped = checkpointed(grouped.join(full.select("row", "doc_id", "t1", "t2", "n_shingles"), "row"))
    sizes = grouped.groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks")
    )
    # rows that repeat id and text would come back more than once
    wanted = slim.join(grouped.drop("n_shingles").join(sizes, "key"), ["doc_id", "t1", "t2"]).dropDuplicates(["doc_id", "t1", "t2"])
    sets = wanted.select("row", "key", "blocks", "text").mapInArrow(keyed_sets(shingle), "row long, key long, blocks long, shingles array<long>")
    rows = in_blocks(sets.filter(F.size("shingles") > 0), "key", F.col("blocks"), "row").drop("blocks")
    links = edges_by(rows.select("key", "p", "q", "row", "shingles"), ["key", "p", "q"], confirmed(percent))
    for end in ("a", "b"):
        links = links.join(classes.select(F.col("row").alias(end), F.col("rep").alias(f"rep_{end}")), end)
    links = links.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    # an id whose rows lie in classes of several representatives ties these; other ids just follow their one
    owned = checkpointed(full.select("doc_id", "high", "low").join(classes.drop("row"), ["high", "low"]).select("doc_id", "rep"))
    homes = owned.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("most"))
    several = owned.filter("rep <> doc_id").join(homes.filter("rep <> most").select("doc_id"), "doc_id", "left_semi")
    linked = components(links.unionByName(several.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    placed = homes.join(linked.withColumnRenamed("vertex", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    out = sketched.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return out.select(real_id("doc_id"), "n_shingles", real_id("component_id"), "kept")


@query(
    r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM worded
), classes AS (
  SELECT md5(array_to_string(list_sort(s), '|')) AS d, min(doc_id) AS rep, any_value(s) AS s, any_value(len(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY d
), flat AS (
  SELECT rep, n, unnest(s) AS sh FROM classes
), common AS (
  SELECT sh FROM flat GROUP BY sh HAVING count(*) > 1
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM flat a JOIN common USING (sh) JOIN flat b ON a.sh = b.sh AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(v, c) AS (
  SELECT a, a FROM edges UNION SELECT e.b, r.c FROM reach r JOIN edges e ON r.v = e.a WHERE r.c < e.b
), comp AS (
  SELECT v, min(c) AS c FROM reach GROUP BY v
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(comp.c, k.rep) END AS component_id,
  s.doc_id = CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(comp.c, k.rep) END AS kept
FROM sets s LEFT JOIN classes k ON k.d = md5(array_to_string(list_sort(s.s), '|')) LEFT JOIN comp ON comp.v = k.rep
"""
)
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents on 3-word shingles at 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)

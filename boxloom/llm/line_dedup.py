"""Drop lines that many documents repeat, by a sharded minimal perfect hash.

All distinct long line keys are dealt over shards of a bounded number of keys. Each shard gets a minimal perfect hash
(one pilot per small bucket of keys) over three arrays: a 64-bit fingerprint, the number of documents and the document
that keeps the line. Documents send their line hashes to the shards and probe these arrays: the count that a probe finds
decides. No line is joined with another line. A shard is one row of bounded size, streamed before its probes; shards with
many probes are copied under several salts, so that a very common line is spread.

Line keys are 128-bit hashes: 64 bits choose shard and slot, 64 bits are the fingerprint; lines are dropped by all 128.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from boxloom.llm.common import SPACE, checkpointed, known_id, lower_az, slices, table, texts
from boxloom.llm.registry import query

#: Keys of a shard at most (on average: lines are counted, and no shard has more keys than lines).
SHARD_KEYS = 16_384
#: Probes of a shard beyond which it is copied under another salt; also at most this share of all probes.
SALT_PROBES, SALT_SHARE = 200_000, 1_000
BUCKET = 4


def line_key(line: str) -> str:
    """White space stripped at both ends, A-Z in lower case."""
    return lower_az(line.strip(SPACE))


def key_hash(key: str) -> bytes:
    """Two halves of 8 bytes: the one for shard and slot, and the fingerprint."""
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))


def halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)


def long_lines(min_chars: int):
    """Distinct hashed keys of each document's lines with at least `min_chars` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            n, found = [], []
            for text in texts(batch.column("text")):
                keys = {k for line in text.split("\n") if len(line) >= min_chars and len(k := line_key(line)) >= min_chars}
                n.append(len(keys))
                found.extend(map(key_hash, keys))
            both = halves(found)
            ids, rows = (np.repeat(batch.column(c).to_numpy(), n) for c in ("doc_id", "text_hash"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, rows, both[:, 0], both[:, 1])], ["doc_id", "text_hash", "slot_hash", "print"])

    return run


def mixed(h: np.ndarray, pilot: np.ndarray) -> np.ndarray:
    """A 64-bit hash of (h, pilot)."""
    x = h.view(np.uint64) ^ (pilot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def slots_of(h: np.ndarray, pilots: np.ndarray, size: int) -> np.ndarray:
    bucket = (mixed(h, np.zeros(1, np.uint64)) % np.uint64(len(pilots))).astype(np.int64)
    return (mixed(h, pilots[bucket].astype(np.uint64) + np.uint64(1)) % np.uint64(size)).astype(np.int64)


def perfect_hash(h: np.ndarray) -> np.ndarray:
    """Pilots by which the distinct hashes `h` fall on 0 .. len(h)-1, one each; the largest buckets choose first."""
    n = len(h)
    pilots = np.zeros(max(1, -(-n // BUCKET)), np.uint32)
    bucket = (mixed(h, np.zeros(1, np.uint64)) % np.uint64(len(pilots))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(len(pilots) + 1))
    free = np.ones(n, bool)
    tries = 64
    for b in np.argsort(-np.diff(starts), kind="stable"):
        keys = h[order[starts[b] : starts[b + 1]]]
        if not len(keys):
            break
        first = 0
        while True:  # `tries` pilots at once
            candidates = np.arange(first, first + tries, dtype=np.uint64)
            at = (mixed(keys[None, :], candidates[:, None] + np.uint64(1)) % np.uint64(n)).astype(np.int64)
            good = free[at].all(1)
            if len(keys) > 1:
                ranked = np.sort(at, 1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(1)
            if good.any():
                k = int(good.argmax())
                pilots[b] = first + k
                free[at[k]] = False
                break
            first += tries
            tries = min(4096, tries * 2) if len(keys) == 1 else tries
    return pilots


def build_shard(keys: pd.DataFrame) -> pd.DataFrame:
    h = keys["slot_hash"].to_numpy(np.int64)
    first = np.unique(h, return_index=True)[1]  # two keys that share 64 bits: the spare one goes to `rest`
    rest = np.setdiff1d(np.arange(len(h)), first)
    pilots = perfect_hash(h[first])
    at = slots_of(h[first], pilots, len(first))
    arrays = {}
    for name, kind in (("print", np.int64), ("n_docs", np.uint32), ("keeper", np.int64)):
        values = np.empty(len(first), kind)
        values[at] = keys[name].to_numpy()[first]
        arrays[name] = values.tobytes()
    spare = keys.iloc[rest][["slot_hash", "print", "n_docs", "keeper"]].to_numpy(np.int64).tobytes()
    return pd.DataFrame([{"shard": keys["shard"].iloc[0], "pilots": pilots.tobytes(), "prints": arrays["print"], "counts": arrays["n_docs"], "keepers": arrays["keeper"], "spare": spare}])


ARRAYS = ("pilots", "prints", "counts", "keepers", "spare")
SHARD = "shard long, pilots binary, prints binary, counts binary, keepers binary, spare binary"


class Shard:
    """The arrays of a shard, and the lookup."""

    def __init__(self, pilots: bytes, prints: bytes, counts: bytes, keepers: bytes, spare: bytes) -> None:
        self.pilots, self.prints, self.counts = np.frombuffer(pilots, np.uint32), np.frombuffer(prints, np.int64), np.frombuffer(counts, np.uint32)
        self.keepers, self.spare = np.frombuffer(keepers, np.int64), np.frombuffer(spare, np.int64).reshape(-1, 4)

    def dropped(self, doc: np.ndarray, h: np.ndarray, prints: np.ndarray, min_docs: int) -> np.ndarray:
        """Which lines lie in `min_docs` documents and are kept by another one."""
        at = slots_of(h, self.pilots, len(self.prints))
        out = (self.prints[at] == prints) & (self.counts[at] >= min_docs) & (self.keepers[at] != doc)
        for slot_hash, fingerprint, n_docs, keeper in self.spare:
            if n_docs >= min_docs:
                out |= (h == slot_hash) & (prints == fingerprint) & (keeper != doc)
        return out


def probe(min_docs: int):
    """Rows come sorted by (shard, salt), the arrays of a shard before its probes; one shard is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "salt", "is_probe")])
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1
            columns = {c: [np.zeros(0, np.int64)] for c in ("doc_id", "text_hash", "slot_hash", "print")}
            for a, b in zip([0, *cuts], [*cuts, place.shape[1]]):
                if b == a:
                    continue
                where = tuple(place[:2, a].tolist())
                if not place[2, a]:
                    row = batch.slice(a, 1)
                    shard, at = Shard(*(row.column(c)[0].as_py() for c in ARRAYS)), where
                elif at == where:
                    part = {c: batch.column(c).slice(a, b - a).to_numpy(zero_copy_only=False) for c in columns}
                    gone = shard.dropped(part["doc_id"], part["slot_hash"], part["print"], min_docs)
                    for c, values in part.items():
                        columns[c].append(values[gone])
            doc, row, h, p = (np.concatenate(x) for x in columns.values())
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(h), [None, pa.py_buffer(np.stack([h, p], 1).tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(row), keys.cast(pa.binary())], ["doc_id", "text_hash", "line"])

    return run


def without_lines(name: str):
    """Rebuild each text without the lines whose hash is in column `name`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            kept, n_lines, n_dropped = [], [], []
            for text, gone in zip(texts(batch.column("text")), batch.column(name).to_pylist()):
                lines = text.split("\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [x for x in lines if key_hash(line_key(x)) not in gone]
                    text = "\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(text)
            names = [n for n in batch.schema.names if n != name]
            columns = [pa.array(kept, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    return run


def routed(lines: DataFrame, counts: DataFrame) -> DataFrame:
    """Shards of the counted keys and the lines that probe them, with the (shard, salt) where they meet.

    `counts` has a row (slot_hash, print, n_docs, keeper) for each distinct key of `lines`. There are at least as many
    shards as keep both keys and probes of a shard bounded; a shard with more probes is copied under several salts.
    """
    n_lines = lines.count()
    most = max(SALT_PROBES, n_lines // SALT_SHARE)
    n_shards = max(1, -(-n_lines // min(SHARD_KEYS, most)))

    def shard_of():
        return F.pmod(F.xxhash64("slot_hash"), F.lit(n_shards)).alias("shard")

    shards = checkpointed(counts.withColumn("shard", shard_of()).groupBy("shard").applyInPandas(build_shard, SHARD))
    placed = lines.withColumn("shard", shard_of())
    loads = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("probes")).filter(F.col("probes") > most)
    # shards beyond `most` probes only: SALT_SHARE rows at most
    hot = F.broadcast(checkpointed(loads.select("shard", (F.floor(F.col("probes") / most) + 1).alias("salts"))))
    salts = F.coalesce("salts", F.lit(1).cast("long"))
    nothing = [F.lit(None).cast("binary").alias(c) for c in ARRAYS]
    # by row and not by document: one id may have many rows
    numbered = placed.withColumn("at", F.monotonically_increasing_id()).join(hot, "shard", "left")
    own = ("doc_id", "text_hash", "slot_hash", "print")
    probes = numbered.select("shard", F.pmod("at", salts).alias("salt"), F.lit(True).alias("is_probe"), *own, *nothing)
    copies = shards.join(hot, "shard", "left").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(False).alias("is_probe"),
        *[F.lit(None).cast("long").alias(c) for c in own], *ARRAYS,
    )
    return copies.unionByName(probes)


def fresh(name: str, taken: list[str]) -> str:
    """`name`, with marks before it until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """`docs` with `text` rid of repeated lines, plus n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least `min_chars` code
    points that at least `min_docs` documents hold stay only in the largest doc_id that holds them.
    Null and empty texts are one empty line. Rows that share a doc_id are one document here, and rows without doc_id
    are one document that comes before all others. All other columns pass through, but n_lines and n_dropped of the
    input are replaced; an empty table gives an empty one.
    """
    docs = docs.drop("n_lines", "n_dropped")
    known, row, lost = (fresh(n, docs.columns) for n in ("known", "row", "lost"))
    # rows of one id are one document, but each text gets its own lines only
    slim = docs.select(known_id().alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    lines = checkpointed(slim.mapInArrow(long_lines(min_chars), "doc_id long, text_hash long, slot_hash long, print long"))
    per_doc = lines.groupBy("slot_hash", "print", "doc_id").agg(F.lit(1).alias("one"))  # a line twice in rows of one id
    counts = per_doc.groupBy("slot_hash", "print").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    dealt = routed(lines, counts).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "is_probe")
    gone = dealt.mapInArrow(probe(min_docs), "doc_id long, text_hash long, line binary")
    gone = gone.groupBy(F.col("doc_id").alias(known), F.col("text_hash").alias(row)).agg(F.collect_set("line").alias(lost))  # a text's own lines
    joined = docs.withColumns({known: known_id(), row: F.xxhash64("text")}).join(gone, [known, row], "left").drop(known, row)
    schema = StructType(docs.schema.fields).add("n_lines", LongType()).add("n_dropped", LongType())
    return joined.mapInArrow(without_lines(lost), schema)


@query(
    """
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, f.k IS NOT NULL AND f.keeper <> l.doc_id AS gone FROM lines l LEFT JOIN frequent f ON l.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and the hash of the text that stays, per document."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))

"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (lines, long ones into pieces of bounded length); each digest, together with how often it
came before, is added to one cell in each third of a small table of (count, xor of digests, xor of checks). Sketches
of two versions subtract cell by cell, and peeling cells that hold one digest recovers the paragraphs that differ; where
peeling gets stuck, that pair is sketched again with twice the cells. Likeness is the share of common paragraphs.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.llm.common import known_id, real_id, table
from boxloom.llm.registry import query

#: Code points of a paragraph piece; cells of the fingerprint (a multiple of 3).
LEAST, MOST, CELLS = 12, 48, 24
PIECE = re.compile(rf"[^\n]{{{LEAST},{MOST}}}?(?<=[aeiouy.,;:!?] )|[^\n]{{1,{MOST}}}")
#: Documents of a block of neighbours in id order; so many blocks at most (their bounds travel with the plan).
BLOCK_DOCS, BLOCKS = 2_000, 20_000
#: Characters that are worked on at once.
BATCH = 4_000_000


def paragraphs(text: str) -> list[str]:
    """Lines, cut at the first end of a word or clause after LEAST code points (a space after a vowel or stop), or at MOST.

    Where a piece ends depends on what stands there, so pieces fall into step again soon after an insertion.
    """
    return PIECE.findall(text)


def digests(text: str) -> np.ndarray:
    """64-bit digests; the n-th repetition of a paragraph has a digest of its own."""
    pieces = paragraphs(text)
    out = np.fromiter((xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in pieces), np.uint64, len(pieces))
    if len(set(pieces)) < len(pieces):
        seen: Counter = Counter()
        for k, p in enumerate(pieces):
            out[k] = (int(out[k]) + seen[p] * 0x9E3779B97F4A7C15) & (2**64 - 1)
            seen[p] += 1
    return out


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def check_of(x: np.ndarray) -> np.ndarray:
    return mixed(x, 99)


def cells_of(x: np.ndarray, cells: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The three cells of each digest, in a table of `cells` cells that starts at `first`."""
    third = (cells // 3).astype(np.uint64)
    return np.stack([first + j * (cells // 3) + (mixed(x, j + 1) % third).astype(np.int64) for j in range(3)])


class Sketches:
    """Sketches of many sets, one table after another: `cells` of each, digests `x` with the set's number `of`."""

    def __init__(self, x: np.ndarray, of: np.ndarray, cells: np.ndarray) -> None:
        self.cells = cells
        self.first = np.cumsum(cells) - cells
        n = int(cells.sum())
        self.count, self.key, self.check = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.add(x, of, np.ones(len(x), np.int64))

    def add(self, x: np.ndarray, of: np.ndarray, sign: np.ndarray) -> None:
        for at in cells_of(x, self.cells[of], self.first[of]):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, x)
            np.bitwise_xor.at(self.check, at, check_of(x))

    def minus(self, other: Sketches) -> None:
        self.count -= other.count
        self.key ^= other.key
        self.check ^= other.check

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recovered digests, the set of each, its sign (1: only here, -1: only there), and which sets came out whole.

        A cell is pure if its check fits its key and it is one of the key's own cells. There are at most as many passes
        as cells, since each settles one; what is left then is not whole.
        """
        owner = np.repeat(np.arange(len(self.cells)), self.cells)
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for _ in range(int(self.cells.max(initial=0)) + 1):
            pure = np.flatnonzero(np.abs(self.count) == 1)
            pure = pure[check_of(self.key[pure]) == self.check[pure]]
            if not len(pure):
                break
            pure = pure[(cells_of(self.key[pure], self.cells[owner[pure]], self.first[owner[pure]]) == pure).any(0)]
            if not len(pure):
                break
            x, of, sign = self.key[pure], owner[pure], self.count[pure]
            order = np.lexsort((x, of))
            x, of, sign = x[order], of[order], sign[order]
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (of[1:] != of[:-1])
            x, of, sign = x[new], of[new], sign[new]
            found.append((x, of, sign))
            self.add(x, of, -sign)
        whole = np.ones(len(self.cells), bool)
        whole[owner[(self.count != 0) | (self.key != 0)]] = False
        return *(np.concatenate(z) for z in zip(*found)), whole

    def written(self) -> list[str]:
        """Each sketch as text: base64 of the counts, keys and checks of its cells."""
        cells = np.zeros(len(self.count), [("n", "<u4"), ("key", "<u8"), ("check", "<u8")])
        cells["n"], cells["key"], cells["check"] = self.count, self.key, self.check
        raw, width = cells.tobytes(), cells.itemsize
        return [base64.b64encode(raw[a * width : (a + n) * width]).decode() for a, n in zip(self.first.tolist(), self.cells.tolist())]


def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), [len(x) for x in sets])


def fingerprints(sets: list[np.ndarray], cells: int = CELLS) -> list[str]:
    return Sketches(*flat(sets), np.full(len(sets), cells)).written()


def likeness(here: list[np.ndarray], there: list[np.ndarray]) -> np.ndarray:
    """Common over all paragraphs of each pair, from peeling the difference of their sketches; 1 for two empty ones.

    Pairs that stick are peeled from larger sketches. Digests that no sketch can tell apart (two equal ones in a set)
    would stick for ever: from 64 cells a paragraph on, the sets are compared themselves.
    """
    out = np.ones(len(here))
    todo, cells = np.arange(len(here)), CELLS
    n_here, n_there = (np.array([len(x) for x in s], np.int64) for s in (here, there))
    while len(todo):
        for i in todo[cells > 64 * (n_here[todo] + n_there[todo] + 1)]:
            common = len(np.intersect1d(here[i], there[i]))
            out[i] = common / max(1, len(np.union1d(here[i], there[i])))
        todo = todo[cells <= 64 * (n_here[todo] + n_there[todo] + 1)]
        if not len(todo):
            break
        size = np.full(len(todo), cells)
        difference = Sketches(*flat([here[i] for i in todo]), size)
        difference.minus(Sketches(*flat([there[i] for i in todo]), size))
        _, of, sign, whole = difference.peel()
        only_here, only_there = np.bincount(of[sign > 0], minlength=len(todo)), np.bincount(of[sign < 0], minlength=len(todo))
        union = n_here[todo] + only_there
        value = np.where(union > 0, (n_here[todo] - only_here) / np.maximum(union, 1), 1.0)
        out[todo[whole]] = value[whole]
        todo, cells = todo[~whole], cells * 2
    return out


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) of the code points gives way to as many first ones of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (block, guest, doc_id, text) in id order within each block; each block ends with the document that follows it.

    Blocks are cut at approximate quantiles of the ids, which are ids themselves, so that the first document of every
    block is known beforehand and goes to the block before as a guest (the first of all to the last block).
    """
    rows = docs.select(known_id().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    stats = ids.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")).first()
    parts = min(BLOCKS, stats["n"] // BLOCK_DOCS + 1)
    bounds = np.zeros(0, np.int64)
    if parts > 1:
        shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
        quantiles = ids.agg(F.percentile_approx("doc_id", shares, F.lit(max(10_000, 10 * parts)))).first()[0]
        bounds = np.unique(np.array(quantiles, np.int64))
        bounds = bounds[bounds > stats["low"]]
    low = stats["low"]

    @F.pandas_udf("array<long>")
    def blocks(doc_id: pd.Series) -> pd.Series:
        x = doc_id.to_numpy(np.int64)
        own = np.searchsorted(bounds, x, side="right")
        out = own[:, None].tolist()
        starts = x == (low if low is not None else 0)
        if len(bounds):
            starts |= np.isin(x, bounds)
        for k in np.flatnonzero(starts).tolist():
            out[k].append(int(own[k]) - 1 if own[k] else len(bounds))
        return pd.Series(out)

    dealt = rows.select("doc_id", "text", F.posexplode(blocks("doc_id")).alias("guest", "block"))
    return dealt.repartition("block").sortWithinPartitions("block", "guest", "doc_id", "text")


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next per document.

    Fingerprints are text (base64 of CELLS cells); equal texts have equal ones. The edited text is `edited(text, next)`
    with the next document by doc_id, after the last the first. near_* are the shares of common paragraphs, 0 to 1.

    Null texts count as empty, and two empty texts are alike (1). Rows without doc_id come first; rows that share one
    follow each other in the order of their texts. A single document is its own next one. Other columns are not read; an
    empty table gives an empty one.
    """

    def finish(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
        changed = [edited(t, n) for _, t, n in rows]
        own = [digests(t) for _, t, _ in rows]
        # the next document is mostly the next row
        after = [own[k + 1] if k + 1 < len(rows) and rows[k + 1][1] is n else digests(n) for k, (_, _, n) in enumerate(rows)]
        new = [digests(t) for t in changed]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _, _ in rows], pa.int64()), pa.array([len(t) for _, t, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                pa.array(fingerprints(own), pa.string()), pa.array(fingerprints(new), pa.string()),
                pa.array(likeness(own, new), pa.float64()), pa.array(likeness(own, after), pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # block, doc_id, text of the last row, unless a guest
        rows: list[tuple[int, str, str]] = []
        size = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "guest", "doc_id", "text"))
            for block, guest, doc_id, text in zip(*columns):
                if held is not None and held[0] == block:
                    rows.append((held[1], held[2], text))
                    size += len(held[2]) + len(text)
                held = None if guest else (block, doc_id, text)
                if size > BATCH:
                    yield finish(rows)
                    rows, size = [], 0
        if rows:
            yield finish(rows)

    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    out = with_next(docs).mapInArrow(run, kind)
    return out.withColumn("doc_id", real_id("doc_id"))


@query()
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return fingerprint(table(spark, sf_dir, "documents"))

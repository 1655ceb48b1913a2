"""Quality rules: fixed repetition rules, then a hashed n-gram likelihood ratio against trusted documents.

Every document is a bag of hashed n-grams: its words, its pairs of neighbouring words and the character trigrams inside
its words. Two multinomials over the same buckets are counted over the whole corpus: one from every document, one from
the documents that labels call good (the trusted target). A document's score is the mean over its n-grams of
log(p_target / p_corpus), so that its length does not matter, and one threshold decides every document; nothing is drawn.

The counts are summed in the tasks and by bucket; the model is one number per bucket, however large the corpus is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from boxloom.llm.common import slices, table, texts
from boxloom.llm.registry import query

WORD = re.compile(r"[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"
#: Words of a window that must not repeat; least words; largest share of repeated words in percent.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Buckets of the hashed n-grams, counts added to each bucket, lowest mean log ratio that is kept.
BUCKETS, PRIOR, THRESHOLD = 1 << 16, 4.0, -0.2
#: Bytes of text that a worker holds as words at a time.
SLICE = 4_000_000

RESULT = StructType([
    *[StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    StructField("base_failed", BooleanType()), StructField("ratio", DoubleType()), StructField("kept", BooleanType()),
])


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer, over arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bag:
    """The words and hashed n-grams of some texts.

    `doc` and `code` give each word's text and its place among the distinct words; `pair` and `pair_doc` each pair of
    neighbours; `own` a distinct word's bucket, `gram` and `gram_word` the buckets of its character trigrams.
    """

    def __init__(self, values: list[str]) -> None:
        found = [WORD.findall(t) for t in values]
        self.n_words = np.array([len(w) for w in found], np.int64)
        self.word_chars = np.array([sum(map(len, w)) for w in found], np.int64)
        flat = np.empty(int(self.n_words.sum()), object)
        at = 0
        for words in found:
            flat[at : at + len(words)] = words
            at += len(words)
        del found
        codes, distinct = pd.factorize(flat)
        self.doc = np.repeat(np.arange(len(values)), self.n_words)
        self.code = codes.astype(np.int64)
        self.n_distinct = len(distinct)
        hashed = mixed(np.array([zlib.crc32(w.encode()) for w in distinct], np.uint64) + np.uint64(1 << 40))
        self.own = self.bucket(hashed)
        inside = self.doc[1:] == self.doc[:-1]
        left, right = hashed[self.code[:-1][inside]], hashed[self.code[1:][inside]]
        self.pair, self.pair_doc = self.bucket(mixed(left * np.uint64(3) + right)), self.doc[1:][inside]
        size = np.array([len(w) for w in distinct], np.int64)
        chars = np.frombuffer("".join(f"\x02{w}\x03" for w in distinct).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.gram_word = np.repeat(np.arange(len(distinct)), size)
        start = np.arange(len(self.gram_word)) + 2 * self.gram_word  # two marks a word
        packed = (chars[start] << np.uint64(42)) | (chars[start + 1] << np.uint64(21)) | chars[start + 2] if len(start) else start.astype(np.uint64)
        self.gram = self.bucket(mixed(packed))
        self.gram_size = size

    @staticmethod
    def bucket(x: np.ndarray) -> np.ndarray:
        return (x % np.uint64(BUCKETS)).astype(np.int64)

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """How often each bucket occurs in all texts, or in the chosen ones."""
        words = self.code if chosen is None else self.code[chosen[self.doc]]
        pairs = self.pair if chosen is None else self.pair[chosen[self.pair_doc]]
        times = np.bincount(words, minlength=self.n_distinct)
        out = np.bincount(pairs, minlength=BUCKETS) + np.bincount(self.own, times, BUCKETS).astype(np.int64)
        return out + np.bincount(self.gram, times[self.gram_word], BUCKETS).astype(np.int64)

    def ratios(self, model: np.ndarray) -> np.ndarray:
        """Mean of the model's numbers over each text's n-grams; 0 for a text without words."""
        n = len(self.n_words)
        word = model[self.own] + np.bincount(self.gram_word, model[self.gram], self.n_distinct)
        total = np.bincount(self.doc, word[self.code], n) + np.bincount(self.pair_doc, model[self.pair], n)
        grams = np.bincount(self.doc, 1 + self.gram_size[self.code], n) + np.bincount(self.pair_doc, minlength=n)
        return np.divide(total, grams, out=np.zeros(n), where=grams > 0)

    def repeated(self) -> np.ndarray:
        """Per text, the words that lie in a window of WINDOW words found twice or more in this text."""
        n, last = len(self.n_words), len(self.code) - WINDOW + 1
        if last < 1:
            return np.zeros(n, np.int64)
        start = np.flatnonzero(self.doc[:last] == self.doc[WINDOW - 1 :])
        columns = [self.doc[start], *[self.code[start + k] for k in range(WINDOW)]]
        key = np.zeros(len(start), np.uint64)
        for c in columns:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        a, b = order[1:][same], order[:-1][same]
        if any((c[a] != c[b]).any() for c in columns):  # a collision of hashes: sort the windows themselves
            order = np.lexsort(columns)
            same = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in columns])
            a, b = order[1:][same], order[:-1][same]
        twice = start[np.union1d(a, b)]
        edge = np.zeros(len(self.code) + 1, np.int64)
        edge[twice] += 1
        edge[twice + WINDOW] -= 1
        return np.bincount(self.doc[np.cumsum(edge[:-1]) > 0], minlength=n)


def duplicate_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """One log ratio per bucket, from all texts of `docs` (doc_id, text) and those that `labels` (doc_id, quality) trusts.

    A document is trusted if labels name it and all their rows with a quality say 1. Without trusted documents, or
    without words, all ratios are 0. Null ids are never trusted.
    """
    trusted = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id"))
    trusted = trusted.agg(F.min(F.col("quality") == 1).alias("_trusted")).filter("_trusted")
    # always by hash of the id: labels grow with the corpus, so whether they fit a broadcast must not decide the plan
    known = docs.select("doc_id", "text").join(trusted.hint("shuffle_hash"), F.col("doc_id") == F.col("_id"), "left").select("text", F.col("_trusted").isNotNull().alias("trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part in slices(batches, "text", SLICE):
            bag = Bag(texts(part.column("text")))
            corpus += bag.counts()
            target += bag.counts(part.column("trusted").to_numpy(zero_copy_only=False).astype(bool))
        some = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(corpus[some]), pa.array(target[some])], ["bucket", "corpus", "target"])

    sums = known.mapInArrow(count, "bucket long, corpus long, target long").groupBy("bucket")
    rows = sums.agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target")).collect()  # BUCKETS rows at most
    corpus, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in rows:
        corpus[row["bucket"]], target[row["bucket"]] = row["corpus"], row["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    # the target's counts on the corpus's scale, so that the prior favours neither and a bucket without evidence says nothing
    return np.log((target * (corpus.sum() / target.sum()) + PRIOR) / (corpus + PRIOR))


def judge(docs: DataFrame, model: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio and kept.

    A null text counts as empty: no words, so base_failed, and a ratio of 0. base_failed documents have fewer than 10
    words, or more than 20 % of them in repeated five-word windows; kept are the others with a ratio of at least
    `threshold`. One row per row of `docs`, repeated rows and ids included; other columns pass, but columns of these
    names are replaced. An empty table gives an empty one.
    """
    names = set(RESULT.names)
    rest = [c for c in docs.columns if c not in names]
    schema = StructType([*[docs.schema[c] for c in rest], *RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            values = texts(part.column("text"))
            bag = Bag(values)
            repeated, ratio = bag.repeated(), bag.ratios(model)
            symbols = [sum(map(t.count, SYMBOLS)) for t in values]
            failed = (bag.n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * bag.n_words)
            made = [bag.n_words, bag.word_chars, symbols, [duplicate_lines(t) for t in values], repeated, failed, ratio, ~failed & (ratio >= threshold)]
            arrays = [pa.array(v, t) for v, t in zip(made, [*[pa.int64()] * 5, pa.bool_(), pa.float64(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *arrays], schema.names)

    return docs.select(*rest).mapInArrow(run, schema)


@query()
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and likelihood ratio of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")

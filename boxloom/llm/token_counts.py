"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

A batch of texts is cut into pre-tokens; the distinct ones that the task has not met before become one ragged numpy
array of byte symbols, in which every sequence applies its lowest-ranked pair at the same time, round by round. What
survives is counted and remembered. Counts equal the library's, whose vocabulary file is read and never trained.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.llm.common import slices, table, texts
from boxloom.llm.ragged import PairTable, merge
from boxloom.llm.registry import query

#: The split pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points that two versions of the Unicode tables may class differently; texts with others are split by the library.
SETTLED = r"\u0000-\u0530\u2010-\u2064\u20a0-\u20bf\u2190-\u21ff\u3000-\u303f\u3041-\u3096\u4e00-\u9fef\uac00-\ud7a3"
REMEMBERED = 2_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """Counts tokens with one vocabulary file of the `tokenizers` library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.byte_ids = np.zeros(256, np.int64)
        for letter, b in byte_letters().items():
            self.byte_ids[b] = vocab[letter]
        ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int64)
        self.pairs = PairTable(ids[:, 0], ids[:, 1], np.arange(len(ids)), ids[:, 2])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern, self.unsettled = regex.compile(PATTERN), regex.compile(f"[^{SETTLED}]")
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        if self.unsettled.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings, which are one token each."""
        if self.special is None or not self.special.search(text):
            return self.pieces(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(self.pieces, parts))), len(parts) - 1

    def learn(self, new: list[str]) -> None:
        raw = [x.encode("utf-8", "surrogatepass") for x in new]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.known.update(zip(new, merge(symbols, starts, self.pairs).tolist()))

    def count(self, batch: list[str]) -> np.ndarray:
        split = [self.split(x) for x in batch]
        distinct = set().union(*(p for p, _ in split))
        new = [p for p in distinct if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(distinct)
        if new:
            self.learn(new)
        get = self.known.__getitem__
        return np.array([sum(map(get, p)) + extra for p, extra in split], np.int64)


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text.

    A null text counts as empty: 0 bytes, 0 tokens. Rows are independent: repeated or null ids stay as they are, other
    columns are not read, an empty table gives an empty one. `vocabulary` names a file each executor can read, by
    default byte_bpe_50k.json of the installed package of public tokenizers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        own = counter(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
        for batch in slices(batches, "text", 2_000_000):
            counts = own.count(texts(batch.column("text")))
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, against a limit of 512."""
    return count_tokens(table(spark, sf_dir, "documents"))

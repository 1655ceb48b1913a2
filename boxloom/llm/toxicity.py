"""Toxic spans and document scores from a linear-chain conditional random field.

Labels mark documents, so tokens are labelled first: features (a word, its beginnings) that are significantly more
frequent in toxic documents mark the tokens of toxic documents that have them. The field is fitted to these labelled
tokens on a bounded sample; every token of every text then gets its forward-backward marginal. A document's score is
a logistic function of its largest marginal and of the expected number of toxic tokens; runs of tokens with a marginal
of 0.5 or more are the offending spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxloom.llm.common import slices, table, texts
from boxloom.llm.registry import query

WORD = re.compile(r"\w+")
#: The sample for fitting: so many toxic and clean documents, of texts up to so many code points.
FIT_TOXIC, FIT_CLEAN, FIT_CHARS = 1_000, 3_000, 20_000
ROUNDS, CHUNK_TOKENS = 25, 200_000
REMEMBERED = 200_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0. A null id is never learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(token: str) -> list[str]:
    token = token.lower()
    return [token, *(f"{token[:n]}-" for n in (4, 5, 6) if len(token) > n)]


@dataclass
class Layout:
    """Tokens of several documents in time-major order: all first tokens, then all second ones, longest document first."""

    sizes: np.ndarray
    place: np.ndarray = field(init=False)
    cuts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = int(self.sizes.sum())
        order = np.argsort(-self.sizes, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        starts = np.cumsum(self.sizes) - self.sizes
        t = np.arange(n) - np.repeat(starts, self.sizes)
        steps = int(self.sizes.max()) if len(self.sizes) else 0
        alive = len(order) - np.searchsorted(np.sort(self.sizes), np.arange(steps), side="right")
        self.cuts = np.concatenate([[0], np.cumsum(alive)])
        self.place = self.cuts[t] + np.repeat(rank, self.sizes)

    def chains(self, scores: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of the forward and backward messages of each token (document order); their sum is the marginal's."""
        (a, b), (c, d) = np.exp(trans)
        e = np.empty_like(scores)
        e[self.place] = scores
        forward, backward = e.copy(), np.zeros_like(e)
        cuts = self.cuts
        for t in range(1, len(cuts) - 1):
            x = np.exp(np.minimum(forward[cuts[t - 1] : cuts[t - 1] + cuts[t + 1] - cuts[t]], 60))
            forward[cuts[t] : cuts[t + 1]] += np.log((b + d * x) / (a + c * x))
        for t in range(len(cuts) - 3, -1, -1):
            n = cuts[t + 2] - cuts[t + 1]
            x = np.exp(np.minimum(e[cuts[t + 1] : cuts[t + 2]] + backward[cuts[t + 1] : cuts[t + 2]], 60))
            backward[cuts[t] : cuts[t] + n] = np.log((c + d * x) / (a + b * x))
        return forward[self.place], backward[self.place]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Field:
    """The fitted model: weights of the selected features, transitions, and the document's logistic function."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.array([-60.0, 0, 0]))

    def emission(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(token))

    def marginals(self, tokens: Iterable[list[str]], known: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens, one document after another, and the sizes. Holds the tokens of one document at a time."""
        found = []
        for doc in tokens:
            if len(known) > REMEMBERED:
                known.clear()
            for t in set(doc):
                if t not in known:
                    known[t] = self.emission(t)
            found.append(np.fromiter(map(known.__getitem__, doc), float, len(doc)))
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.concatenate([np.zeros(0), *found])
        forward, backward = Layout(sizes).chains(flat, self.trans)
        return sigmoid(forward + backward), sizes

    def score(self, marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return sigmoid(summary(marginals, sizes) @ self.document)


def summary(marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """1, the largest marginal and the log of 1 + the expected number of toxic tokens, per document."""
    out = np.zeros((len(sizes), 3))
    out[:, 0] = 1
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        out[full, 1] = np.maximum.reduceat(marginals, starts)
        out[full, 2] = np.log1p(np.add.reduceat(marginals, starts))
    return out


class Sample:
    """The labelled texts as arrays: token numbers, and the feature numbers of each distinct token."""

    def __init__(self, rows: list[str]) -> None:
        tokens: dict[str, int] = {}
        found = [np.array([tokens.setdefault(t, len(tokens)) for t in WORD.findall(x)], np.int32) for x in rows]
        names: dict[str, int] = {}
        self.features = [np.array([names.setdefault(f, len(names)) for f in features(t)], np.int32) for t in tokens]
        self.names = list(names)
        self.sizes = np.array([len(x) for x in found], np.int64)
        self.flat = np.concatenate([np.zeros(0, np.int32), *found])
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names), np.uint64, len(names))

    def own(self, doc: int) -> np.ndarray:
        """Distinct features of a document."""
        end = int(self.sizes[: doc + 1].sum())
        return np.unique(np.concatenate([np.zeros(0, np.int32), *(self.features[t] for t in np.unique(self.flat[end - self.sizes[doc] : end]))]))

    def family(self, own: np.ndarray) -> tuple[int, int]:
        """Two min-hashes: near copies nearly always share them, so that a family of copies counts as one document."""
        hashes = self.hashes[own]
        return tuple(int((hashes * np.uint64(m)).min()) if len(own) else 0 for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))


def select_features(sample: Sample, toxic: np.ndarray) -> dict[int, float]:
    """Features whose document frequency among toxic documents is larger beyond chance (G test), with their log ratio."""
    families: list[dict] = [{}, {}]
    for doc, label in enumerate(toxic.tolist()):
        own = sample.own(doc)
        families[label].setdefault(sample.family(own), []).append(own)
    seen = [np.zeros(len(sample.names), np.int64) for _ in families]
    for counts, groups in zip(seen, families):
        for members in groups.values():
            counts[np.unique(np.concatenate(members))] += 1
    n0, n1 = map(len, families)
    least = 2 * math.log(max(20, int((seen[1] > 0).sum())))
    out = {}
    for f in np.flatnonzero(seen[1]).tolist():
        k0, k1 = int(seen[0][f]), int(seen[1][f])
        share = (k1 + k0) / (n1 + n0)
        g = 2 * sum(k * math.log(k / (n * p)) for k, n, p in ((k1, n1, share), (k0, n0, share), (n1 - k1, n1, 1 - share), (n0 - k0, n0, 1 - share)) if k)
        ratio = math.log((k1 + 0.5) / (n1 + 1)) - math.log((k0 + 0.5) / (n0 + 1))
        if g > least and ratio > math.log(5):
            out[f] = ratio
    return out


def transitions(theta: np.ndarray) -> np.ndarray:
    return np.array([[0, theta[-2]], [theta[-3], theta[-1]]])


class Chunk:
    """Some documents of the sample, so that the arrays of a round stay small; slopes add up over chunks."""

    def __init__(self, sizes: np.ndarray, at: np.ndarray, which: np.ndarray, toxic: np.ndarray) -> None:
        self.sizes, self.at, self.which = sizes, at, which
        self.layout = Layout(sizes)
        self.labelled = np.zeros(int(sizes.sum()), np.float32)
        self.labelled[at] = 1
        self.labelled *= np.repeat(toxic, sizes)
        first = np.zeros(len(self.labelled), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        self.second = np.flatnonzero(~first)  # tokens that follow another one
        a, b = self.labelled[self.second - 1], self.labelled[self.second]
        self.observed = np.array([(a * (1 - b)).sum(), ((1 - a) * b).sum(), (a * b).sum()], float)

    @classmethod
    def of(cls, sizes: np.ndarray, at: np.ndarray, which: np.ndarray, toxic: np.ndarray) -> Iterator[Chunk]:
        """Cut a sample (feature `which[i]` at token `at[i]`, in token order) into chunks of about CHUNK_TOKENS tokens."""
        ends = np.cumsum(sizes)
        part = (ends - sizes) // CHUNK_TOKENS
        for docs in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part)) + 1):
            if len(docs):
                low, high = ends[docs[0]] - sizes[docs[0]], ends[docs[-1]]
                a, b = np.searchsorted(at, [low, high])
                yield cls(sizes[docs], at[a:b] - low, which[a:b], toxic[docs])

    def scores(self, theta: np.ndarray) -> np.ndarray:
        out = np.full(len(self.labelled), theta[-4])
        np.add.at(out, self.at, theta[self.which])
        return out

    def chains(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.layout.chains(self.scores(theta), transitions(theta))

    def slope(self, theta: np.ndarray) -> np.ndarray:
        """Of the log likelihood of the labels: weights, bias, and transitions toxic-clean, clean-toxic, toxic-toxic."""
        trans, scores, second = transitions(theta), self.scores(theta), self.second
        forward, backward = self.layout.chains(scores, trans)
        rest = self.labelled - sigmoid(forward + backward)
        # pairs of neighbours: forward odds, transition, emission and backward odds
        x = np.exp(np.clip(forward[second - 1], -60, 60))
        y = np.exp(np.clip(scores[second] + backward[second], -60, 60))
        joint = [np.exp(trans[1, 0]) * x, np.exp(trans[0, 1]) * y, np.exp(trans[1, 1]) * x * y]
        total = 1 + sum(joint)
        expected = np.array([(j / total).sum() for j in joint])
        return np.concatenate([np.bincount(self.which, rest[self.at], len(theta) - 4), [rest.sum()], self.observed - expected])


def fit(sample: list[tuple[str, int]], weight_of_clean: float) -> Field:
    """Fit field and document function to (text, toxic) rows."""
    toxic = np.array([y for _, y in sample], np.int64)
    model = Field()
    if not toxic.any() or toxic.all():  # nothing to tell apart: every score is the one label seen
        model.document = np.array([4.0 if len(toxic) and toxic.all() else -4.0, 0, 0])
        return model
    read = Sample([t for t, _ in sample])
    chosen = select_features(read, toxic)
    numbers = {f: k for k, f in enumerate(chosen)}
    sizes, flat = read.sizes, read.flat
    pairs = {t: [numbers[f] for f in fs.tolist() if f in numbers] for t, fs in enumerate(read.features)}
    pairs = {t: ks for t, ks in pairs.items() if ks}
    hit = np.flatnonzero(np.isin(flat, list(pairs)))
    at = np.repeat(hit, [len(pairs[t]) for t in flat[hit].tolist()])
    which = np.array([k for t in flat[hit].tolist() for k in pairs[t]], np.int64)
    names = [read.names[f] for f in chosen]
    del read, flat, pairs, hit  # the sample is large next to what is fitted
    k = len(chosen)
    chunks = list(Chunk.of(sizes, at, which, toxic))
    theta = np.concatenate([np.fromiter(chosen.values(), float, k), [-6.0, 0, 0, 0]])
    prior = np.concatenate([np.zeros(k), [-6.0, 0, 0, 0]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        slope = sum((c.slope(theta) for c in chunks), -0.1 * (theta - prior))
        mean, square = 0.8 * mean + 0.2 * slope, 0.95 * square + 0.05 * slope**2
        theta = theta + 0.3 * (mean / (1 - 0.8**step)) / (np.sqrt(square / (1 - 0.95**step)) + 1e-6)
    model.weights = {f: float(w) for f, w in zip(names, theta[:k])}
    model.bias = float(theta[k])
    model.trans = transitions(theta)
    z = np.concatenate([summary(sigmoid(sum(c.chains(theta))), c.sizes) for c in chunks])
    weight = np.where(toxic == 1, 1.0, weight_of_clean)
    beta = np.zeros(3)
    for _ in range(25):  # Newton steps with a small ridge
        s = sigmoid(z @ beta)
        slope = z.T @ (weight * (toxic - s)) - 0.05 * beta
        curve = (z * (weight * s * (1 - s))[:, None]).T @ z + 0.05 * np.eye(3)
        beta = beta + np.linalg.solve(curve, slope)
    model.document = beta
    return model


def train(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_clean: int = FIT_CLEAN, fit_chars: int = FIT_CHARS) -> Field:
    """Fit on at most `fit_toxic` and `fit_clean` documents, chosen by a hash of their id, with at most `fit_chars` code points each."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((0, fit_clean), (1, fit_toxic))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # fit_clean + fit_toxic rows at most
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id").filter(F.length("text") <= fit_chars)
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    used = Counter(r["toxic"] for r in rows)
    clean = (counts.get(0, 0) / max(1, used[0])) / (max(1, counts.get(1, 0)) / max(1, used[1])) if used[1] else 1.0
    return fit([(r["text"], r["toxic"]) for r in rows], clean)


SPANS = "array<struct<start: int, end: int, marginal: double>>"


def score_toxicity(docs: DataFrame, model: Field) -> DataFrame:
    """`docs` plus score (0 to 1), predicted (1 if score >= 0.5) and toxic_spans (code points, end exclusive).

    Null texts count as empty; empty texts get the score of a text without toxic words. Rows are independent, all
    columns pass through (score, predicted and toxic_spans of the input are replaced), an empty table gives an empty one.
    """
    docs = docs.drop("score", "predicted", "toxic_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        kind = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("end", pa.int32()), pa.field("marginal", pa.float64())]))
        for batch in slices(batches, "text", 4_000_000):
            rows = texts(batch.column("text"))
            marginals, sizes = model.marginals(map(WORD.findall, rows), known)
            scores = model.score(marginals, sizes)
            spans: list[list] = [[] for _ in rows]
            starts = np.cumsum(sizes) - sizes
            hot = np.flatnonzero(marginals >= 0.5)
            owner = np.searchsorted(starts, hot, side="right") - 1
            for doc in np.unique(owner).tolist():
                where = [m.span() for m in WORD.finditer(rows[doc])]
                last = -2
                for i in (hot[owner == doc] - starts[doc]).tolist():
                    p = float(marginals[starts[doc] + i])
                    if i == last + 1:
                        spans[doc][-1] |= {"end": where[i][1], "marginal": max(p, spans[doc][-1]["marginal"])}
                    else:
                        spans[doc].append({"start": where[i][0], "end": where[i][1], "marginal": p})
                    last = i
            more = [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "score", "predicted", "toxic_spans"])

    schema = docs.limit(0).withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "toxic_spans": F.array().cast(SPANS)}).schema
    return docs.mapInArrow(run, schema)


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; rows with held_out took no part in the fitting."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model).drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "toxic_spans")

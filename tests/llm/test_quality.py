"""Quality rules against a plain version, one document and one n-gram at a time."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from boxloom.llm import quality
from tests.llm import cases

MASK = 2**64 - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    own = [mixed(zlib.crc32(w.encode()) + 2**40) for w in words]
    out = [h % 65536 for h in own] + [mixed((a * 3 + b) & MASK) % 65536 for a, b in zip(own, own[1:])]
    for w in words:
        c = [2, *map(ord, w), 3]
        out += [mixed(x << 42 | y << 21 | z) % 65536 for x, y, z in zip(c, c[1:], c[2:])]
    return out


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def brute(rows, labels):
    good = {i for i, q in labels if i is not None and q == 1} - {i for i, q in labels if q not in (1, None)}
    corpus, target = Counter(), Counter()
    for r in rows:
        corpus.update(grams(r[1]))
        if r[0] in good:
            target.update(grams(r[1]))
    n, m = sum(corpus.values()), sum(target.values())
    out = []
    for r in rows:
        g = grams(r[1])
        ratio = sum(math.log((target[x] * (n / m) + 4) / (corpus[x] + 4)) for x in g) / len(g) if g and m else 0.0
        facts = base(r[1])
        out.append((r[0], *facts, ratio, not facts[-1] and ratio >= -0.2))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def compare(spark, rows, labels, clashing=False):
    docs = cases.frame(spark, rows, clashing)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.judge(docs, quality.train(docs, known))
    assert got.filter("text is null").count() == sum(r[1] is None for r in rows)
    names = ("doc_id", *quality.RESULT.names)
    got = [tuple(r[c] for c in names) for r in got.collect()]
    want = brute(rows, labels)
    assert sorted((g[:7] for g in got), key=key) == sorted((w[:7] for w in want), key=key)
    assert np.allclose(sorted(g[7] for g in got), sorted(w[7] for w in want), atol=1e-9)
    assert sorted(((g[0], g[8]) for g in got), key=key) == sorted(((w[0], w[8]) for w in want), key=key)


@pytest.mark.parametrize("clashing", [False, True])
def test_hostile_rows(spark, clashing):
    rows = cases.documents()
    labels = [(11, 1), (12, 1), (12, 0), (20, 1), (30, 1), (30, None), (31, None), (None, 1), (35, 0), (9999, 1)]
    compare(spark, rows, labels, clashing)


def test_no_labels_and_no_rows(spark):
    compare(spark, cases.documents()[:12], [])
    none = cases.frame(spark, []).select("doc_id", "text")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(none, quality.train(none, labels)).count() == 0


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice(["tha", "en", "or", "li", "st", "ve"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def prose():
        return " ".join(rng.choice(vocabulary) for _ in range(rng.randint(60, 200)))

    rows, labels = [], []
    for k in range(300):
        text = prose()
        if k % 10 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif k % 10 == 1:
            text = " ".join(w + rng.choice(["###", "$$$"]) for w in text.split())
        rows.append((k, text, "en", "s", len(text)))
        if k % 3 == 0:
            labels.append((k, int(k % 10 > 1)))
    docs = cases.frame(spark, rows)
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    for row in quality.judge(docs, model).collect():
        assert row["kept"] == (row["doc_id"] % 10 > 1), row["doc_id"]


def test_windows_that_collide_are_told_apart(monkeypatch):
    rng = random.Random(2)
    values = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 4, 5, 9, 60, 200)] + ["a b c d e a b c d e"]
    want = quality.Bag(values).repeated().tolist()
    assert want == [base(v)[4] for v in values]
    bag = quality.Bag(values)
    monkeypatch.setattr(quality, "mixed", lambda x: x % np.uint64(7))
    assert bag.repeated().tolist() == want

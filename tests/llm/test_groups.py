"""Operators that bring rows together, against brute force on small tables and their SQL on the smallest scale."""

import hashlib
import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from cases import documents, frame  # noqa: E402

from boxloom.llm import curriculum, embedding_dedup, line_dedup, near_dedup  # noqa: E402
from boxloom.llm.catalog import ORACLES, QUERIES  # noqa: E402
from boxloom.llm.components import components  # noqa: E402
from boxloom.llm.setsketch import REGISTERS, Shingler, estimate, registers  # noqa: E402
from check_queries import connect, rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SPACE = " \t\n\v\f\r"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def known(i):
    return -(2**63) if i is None else i


def roots(vertices, links):
    parent = {v: v for v in vertices}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {v: find(v) for v in vertices}


def lines_by_hand(rows, min_chars=20, min_docs=3):
    def key(line):
        return low(line.strip(SPACE))

    holders = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(known(i))
    gone = {k: max(d) for k, d in holders.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), known(i)) == known(i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("salted", [False, True])
def test_lines(spark, monkeypatch, salted):
    if salted:  # many shards, every one of them hot
        monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
        monkeypatch.setattr(line_dedup, "SALT_PROBES", 1)
        monkeypatch.setattr(line_dedup, "SALT_SHARE", 10_000)
    for rows in (documents(), documents() * 2, []):
        got = line_dedup.dedup_lines(frame(spark, rows, clashing=True)).select("doc_id", "text", "n_lines", "n_dropped").collect()
        assert sorted(map(tuple, got), key=repr) == lines_by_hand(rows)


def test_unique_lines_do_not_meet_in_one_shard(spark, monkeypatch):
    """Few repeated keys and many unique lines, and many rows of one id: no (shard, salt) gets much more than its share."""
    monkeypatch.setattr(line_dedup, "SALT_PROBES", 50)
    shared = [f"shared line number {k} of this corpus" for k in range(40)]
    rows = [(i if i % 2 else None, "\n".join([*shared[: 1 + i % 40], *(f"unique line {i} {k} of this corpus" for k in range(10))]), "en", "s", 1) for i in range(200)]
    dealt, real = [], line_dedup.routed

    def counted(lines, frequent):
        dealt.append({(r.shard, r.salt): r.n for r in real(lines, frequent).filter("is_probe").groupBy("shard", "salt").agg(F.count("*").alias("n")).collect()})
        return real(lines, frequent)

    monkeypatch.setattr(line_dedup, "routed", counted)
    got = line_dedup.dedup_lines(frame(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=repr) == lines_by_hand(rows)
    assert len({s for s, _ in dealt[0]}) > 10 and max(dealt[0].values()) <= 2 * 50


def test_lines_of_rows_without_id_stay_apart(spark):
    """Rows without id are one document, but none is handed the lines of the others; inner names of the input pass."""
    rows = [(None, "\n".join([f"line of every odd row {i % 3} here", f"unique line {i} of this corpus"]), "en", "s", 1) for i in range(60)]
    rows += [(i, f"line of every odd row {i % 3} here", "en", "s", 1) for i in range(9)]
    df = frame(spark, rows).withColumns({c: F.lit("mine") for c in ("known", "row", "lost", "_known", "_gone", "line", "text_hash")})
    got = line_dedup.dedup_lines(df)
    assert set(df.columns) < set(got.columns) and got.filter("known = 'mine' and _gone = 'mine' and lost = 'mine'").count() == len(rows)
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr) == lines_by_hand(rows)


def test_the_count_of_a_probe_decides():
    """A shard holds keys of any count, two of them with the same 64 bits for shard and slot."""
    import pandas as pd

    keys = pd.DataFrame({"shard": 0, "slot_hash": [5, 5, 9, 11], "print": [1, 2, 3, 4], "n_docs": [3, 3, 2, 3], "keeper": [7, 8, 9, 10]})
    shard = line_dedup.Shard(*line_dedup.build_shard(keys).loc[0, list(line_dedup.ARRAYS)])
    doc, h, p = (np.array(x, np.int64) for x in ([1, 7, 1, 8, 1, 1, 1, 1], [5, 5, 5, 5, 9, 11, 11, 77], [1, 1, 2, 2, 3, 4, 5, 1]))
    assert shard.dropped(doc, h, p, 3).tolist() == [True, False, True, False, False, True, False, False]


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 1000, 20_000):
        h = np.unique(rng.integers(-(2**62), 2**62, n))
        assert sorted(line_dedup.slots_of(h, line_dedup.perfect_hash(h), len(h)).tolist()) == list(range(len(h)))


def shingles(text, k):
    w = [x for x in "".join(" " if c in SPACE else c for c in low(text or "")).split(" ") if x]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups_by_hand(rows, k, percent):
    sets = [shingles(t, k) for _, t, *_ in rows]
    ids = [known(r[0]) for r in rows]
    links = [(ids[a], ids[b]) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = roots(ids, links)
    out = [(rows[n][0], len(sets[n]), root[i] if root[i] != known(None) else None, root[i] == i) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def copies(n, words, most, seed):
    """Texts with up to `most` changed words each, chains included."""
    rng = random.Random(seed)
    first = [f"w{rng.randrange(3000)}" for _ in range(words)]
    rows, last = [], first
    for i in range(n):
        new = list(first if i % 3 else last)
        for _ in range(rng.randint(0, most)):
            new[rng.randrange(words)] = f"c{rng.randrange(10**6)}"
        rows.append((10_000 + seed * 1_000 + i, " ".join(new), "en", "s", 1))
        last = new
    return rows


@pytest.mark.parametrize("k, percent, blocks", [(3, 85, 1024), (5, 80, 1024), (3, 85, 8)])
def test_near_duplicates(spark, monkeypatch, k, percent, blocks):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", blocks)
    rows = documents() + copies(60, 120, 5, 1) + copies(40, 60, 3, 2)
    got = near_dedup.near_duplicates(frame(spark, rows, clashing=True), k, percent).collect()
    assert sorted(map(tuple, got), key=repr) == groups_by_hand(rows, k, percent)
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_rows_of_one_id_are_one_document(spark, monkeypatch):
    a, b, c, d = (f"{x} " * 3 + " ".join(f"{x}{k}" for k in range(20)) for x in "abcd")
    rows = [(5, a), (5, b), (3, b), (9, c), (9, d), (9, d), (8, d), (7, c), (6, ""), (6, a + " more"), (11, None), (11, None), (2, None), (2, "alone here")]
    rows = [(i, t, "en", "s", 1) for i, t in rows] + [(None, t, *r) for _, t, *r in copies(60, 120, 5, 3) * 2]
    dealt, real = [], near_dedup.edges_by

    def counted(df, keys, kernel):
        dealt.append(df.count())
        return real(df, keys, kernel)

    monkeypatch.setattr(near_dedup, "edges_by", counted)
    got = near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()
    assert sorted(map(tuple, got), key=repr) == groups_by_hand(rows, 3, 85)
    assert max(dealt) <= 30 * len(rows)  # not the square of the rows without id
    assert {r.component_id for r in got if r.doc_id == 5} == {3}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.85, 0.95):
        n = 2000
        both = rng.integers(0, 2**63, int(n * share)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, (n - len(both)) // 2).astype(np.uint64)])) for _ in range(2))
        x, y = registers(a), registers(b)
        assert (np.maximum(x, y) == registers(np.union1d(a, b))).all()
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        counts = [np.array([s]) for s in ((x == y).sum(), (x > y).sum(), (x < y).sum())]
        assert abs(estimate(*counts, np.array([len(a)]), np.array([len(b)]))[0] - j) < 5 * np.sqrt(j * (1 - j) / REGISTERS)
    assert len(Shingler(3)("a b")) == 1 and len(Shingler(3)(" ")) == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({v for e in links for v in e}, links)
    assert got == {v: r for v, r in want.items() if v != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("tile", [4096, 16])
def test_embeddings(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(60)]
    seed = rng.normal(size=24)
    rows += [(100 + i, (seed + rng.normal(size=24) * 0.35).tolist()) for i in range(60)]  # about the threshold
    rows += [(200 + i, (seed * (i + 1)).tolist()) for i in range(5)] + [(210 + i, seed.tolist()) for i in range(6)]
    # the cosine is 0.9 but for rounding, and just below
    rows += [(300, [1.0, 0.0]), (301, [0.9, (1 - 0.81) ** 0.5]), (302, [0.9 - 1e-15, (1 - 0.81) ** 0.5]), (303, [9.0, (100 - 81) ** 0.5])]
    rows += [(400, None), (401, []), (402, [0.0] * 24), (403, [1.0, None] * 12), (404, [float("nan")] * 24), (405, [float("inf")] * 24), (None, seed.tolist()), (7, rng.normal(size=24).tolist())]
    df = spark.createDataFrame([(i, v, "mine") for i, v in rows], "vec_id long, embedding array<double>, label string").withColumn("kept", F.lit("mine"))
    got = sorted((tuple(r) for r in embedding_dedup.link_vectors(df).collect()), key=repr)
    fine = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    ids = [known(i) for i, _ in rows]
    n, links = [0] * len(rows), []
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and fine[a] and fine[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array([rows[a][1]]), np.array([rows[b][1]])
                if embedding_dedup.cosines(x, y)[0] >= 0.9:
                    n[a] += 1
                    links.append((ids[a], ids[b]))
    root = roots(ids, links)
    want = sorted([(r[0], n[k], root[ids[k]] if root[ids[k]] != known(None) else None, root[ids[k]] == ids[k]) for k, r in enumerate(rows)], key=repr)
    assert got == want
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def mixed_by_hand(rows, weights=(3, 1, 2)):
    def words(t):
        return len([x for x in "".join(" " if c in SPACE else c for c in t or "").split(" ") if x])

    size = defaultdict(int)
    for _, t, _, s, _ in rows:
        size[s] += words(t)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, full = {}, set()
    while True:  # share what is left by weight, over and over
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        level = {s: rest * weight[s] / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = {s for s in level if level[s] > 2 * size[s]}
        if not over:
            target = {s: float(2 * size[s]) if s in full else level[s] for s in order}
            return size, target, words
        full |= over


def test_mix(spark):
    rows = documents()
    size, target, words = mixed_by_hand(rows)
    got = curriculum.mix(frame(spark, rows, clashing=True)).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.repeat_position is None) == (r.taken <= r.size)
    assert {s: int(t + 1e-9) for s, t in target.items()} == dict(taken)
    assert sorted(r.size for r in got) == sorted(words(t) for _, t, *_ in rows)
    again = curriculum.mix(frame(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    order = curriculum.training_order(curriculum.mix(frame(spark, rows))).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and sum(r.words for r in order) == sum(taken.values())
    assert curriculum.mix(frame(spark, [])).count() == 0 and curriculum.mix(frame(spark, [(1, None, "en", None, 0)])).first().taken == 0


def test_positions_invert_the_schedules(spark):
    for k, knots in enumerate(curriculum.SCHEDULES):
        shares = np.linspace(0, 1, 41)
        df = spark.createDataFrame([(float(s),) for s in shares], "s double")
        got = [r[0] for r in df.select(curriculum.position(F.col("s"), F.lit(k))).collect()]
        times, heights = zip(*knots)
        grid = np.linspace(0, 1, 20_001)
        h = np.interp(grid, times, heights)
        area = np.concatenate([[0], np.cumsum((h[1:] + h[:-1]) / 2 * np.diff(grid))])
        assert area[-1] == pytest.approx(1) and got == pytest.approx(np.interp(shares, area, grid).tolist(), abs=1e-3)


def test_copies_of_all_sizes_do_not_leave_blocks(spark, monkeypatch):
    """A pile of equal vectors and a pile of equal texts give counts, not pairs."""
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(500)], "vec_id long, embedding array<double>")
    assert {(r.n_links, r.component_id) for r in embedding_dedup.link_vectors(df).collect()} == {(499, 0)}
    text = hashlib.sha256(b"x").hexdigest() + " one two three"
    docs = frame(spark, [(i, text, "en", "s", 1) for i in range(500)])
    assert {r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {0}

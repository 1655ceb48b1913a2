"""The auction against exact assignment, its bound, and hot components."""

from __future__ import annotations

import time

import numpy as np
import pytest

from boxloom.operators import matching
from boxloom.operators.auction import assignment_gap, auction, local_auction


def graph(seed, lefts, rights, degree, levels=None):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(lefts):
        for r in rng.choice(rights, size=min(degree, rights), replace=False):
            rows.append((1, k, int(r), float(rng.integers(1, levels) / levels) if levels else float(rng.uniform(0.5, 1))))
    return rows


def optimum(rows, lefts, rights):
    gain = np.zeros((lefts, rights))
    for _, a, b, w in rows:
        gain[a, b] = w
    r, c = matching.best_assignment(gain)
    return gain[r, c].sum()


def solved(spark, rows, **kw):
    pairs = spark.createDataFrame(rows, "image_id long, det_id long, annotation_id long, iou double")
    matched, prices = auction(pairs, ["image_id"], "det_id", "annotation_id", **kw)
    got = matched.collect()
    assert len({r["det_id"] for r in got}) == len({r["annotation_id"] for r in got}) == len(got)
    assert {tuple(r) for r in got} <= set(rows)
    return sum(r["iou"] for r in got), assignment_gap(pairs, matched, prices, ["image_id"], "det_id", "annotation_id").first()


def along(seed, lefts, rights, reach=4, levels=None):
    """Choices near one's own place, as overlaps have them."""
    rng = np.random.default_rng(seed)
    rows = {}
    for k in range(lefts):
        for _ in range(reach):
            r = int(np.clip(round(k * rights / lefts + rng.normal() * reach), 0, rights - 1))
            rows[k, r] = (1, k, r, float(rng.integers(1, levels) / levels) if levels else float(rng.uniform(0.5, 1)))
    return list(rows.values())


@pytest.mark.parametrize("lefts, rights", [(300, 300), (300, 150)])
def test_total_is_within_the_bound(spark, lefts, rights):
    rows = along(lefts + rights, lefts, rights)
    total, proof = solved(spark, rows, epsilon=1e-3, block=100, patience=None)
    best = optimum(rows, lefts, rights)
    assert best - 1e-3 * lefts <= total <= best + 1e-9
    assert best - 1e-9 <= proof["bound"] and proof["gap"] <= 1e-3 * lefts + 1e-9 and abs(proof["total"] - total) < 1e-9


def test_small_epsilon_gives_the_optimum(spark):
    rows = along(9, 80, 60, levels=16)
    total, _ = solved(spark, rows, epsilon=1 / 16 / 100, block=40, patience=None)
    assert abs(total - optimum(rows, 80, 60)) < 1e-9


def test_contests_without_a_place_end_with_a_proof(spark):
    """Random choices compete across all blocks; growing bids end that, and the prices still bound the optimum."""
    rows = graph(5, 240, 220, 4)
    total, proof = solved(spark, rows, epsilon=1e-3, block=60, patience=4)
    best = optimum(rows, 240, 220)
    assert total <= best + 1e-9 <= proof["bound"] + 2e-9 and proof["gap"] < 0.2 * best


def test_component_of_five_thousand(spark):
    rows = along(3, 5000, 4800)
    total, proof = solved(spark, rows, epsilon=1e-3)
    assert 0 <= proof["gap"] <= 5.0 and proof["gap"] < 0.002 * total


def test_match_boxes_auctions_what_is_too_large(spark, boxes):
    rng = np.random.default_rng(1)
    place = (np.arange(400) * 6.0).tolist()
    dets = [(k, "i", 1, x, 10.0, x + 40.0 + float(rng.uniform(0, 2)), 50.0, 0.5) for k, x in enumerate(place)]
    truth = [(k, "i", 1, x + 3.0, 10.0, x + 43.0 + float(rng.uniform(0, 2)), 50.0, 1.0) for k, x in enumerate(place)]
    run = lambda **kw: matching.match_boxes(boxes(dets, size=(4000, 100)), boxes(truth, "annotation_id", size=(4000, 100)), 0.5, "optimal", group_limit=64, **kw)
    exact = run().collect()
    dealt = run(exact_limit=100, epsilon=1e-5).collect()
    assert len(dealt) == len({r["det_id"] for r in dealt}) == len({r["annotation_id"] for r in dealt})
    assert abs(sum(r["iou"] for r in exact) - sum(r["iou"] for r in dealt)) <= 1e-5 * 400


def test_a_contest_takes_no_steps_of_epsilon():
    """Three bidders for two boxes of equal worth: bids in steps of epsilon would take ten million of them."""
    price, owner = np.zeros(2), np.full(2, -1)
    begin = time.time()
    moved = local_auction(np.array([0, 2, 4, 6]), np.array([0, 1] * 3), np.ones(6), price, owner, 1e-7)
    assert time.time() - begin < 5
    assert moved.tolist() == [0, 1] and len(set(owner.tolist())) == 2 and np.allclose(price, 1.0)


@pytest.mark.parametrize("seed", range(40))
def test_a_block_is_settled_within_epsilon_at_its_prices(seed):
    """Every bidder holds its best choice at the new prices, also where bidders of other blocks hold boxes."""
    rng = np.random.default_rng(seed)
    lefts, rights = rng.integers(1, 30, 2)
    rows = graph(seed, lefts, rights, 4, levels=16)
    start = np.concatenate([[0], np.cumsum(np.bincount([r[1] for r in rows], minlength=lefts))])
    right, worth = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    price, owner = np.zeros(rights), np.full(rights, -1)
    if seed % 2:
        outside = rng.random(rights) < 0.3
        price[outside], owner[outside] = rng.integers(0, 8, outside.sum()) / 16, -2
    before = price.copy()
    local_auction(start, right, worth, price, owner, 1e-4)
    hold = {k: j for j, k in enumerate(owner.tolist()) if k >= 0}
    assert len(hold) == (owner >= 0).sum() and (price >= before - 1e-12).all() and (price[owner == -1] == 0).all()
    for k in range(lefts):
        gain = {right[e]: worth[e] - price[right[e]] for e in range(start[k], start[k + 1])}
        assert (gain[hold[k]] if k in hold else 0.0) >= max(0.0, *gain.values()) - 1e-4 - 1e-9
    if not seed % 2:
        assert abs(sum(r[3] for r in rows if hold.get(r[1]) == r[2]) - optimum(rows, lefts, rights)) < 1e-9


def test_match_boxes_gives_the_optimum_of_a_component_of_any_size(spark, boxes, monkeypatch):
    """1,010 predictions that one wide truth links, and whose other overlaps differ by less than the auction's step: they are not auctioned."""
    def refused(*_, **__):
        raise AssertionError("auctioned")

    monkeypatch.setattr(matching, "auction", refused)
    rng = np.random.default_rng(5)
    n, size = 1_010, (20_000, 100)
    wide = 40 + rng.uniform(0, 0.05, (2, n))
    dets = [(k, "i", 1, 14.0 * k, 10.0, 14.0 * k + float(wide[0, k]), 50.0, 0.5) for k in range(n)]
    truth = [(k, "i", 1, 14.0 * k + 7, 10.0, 14.0 * k + 7 + float(wide[1, k]), 50.0, 1.0) for k in range(n)] + [(n, "i", 1, 0.0, 10.0, 15_000.0, 50.0, 1.0)]
    got = matching.match_boxes(boxes(dets, size=size), boxes(truth, "annotation_id", size=size), 0.002).collect()
    assert len(got) == len({r["det_id"] for r in got}) == len({r["annotation_id"] for r in got})
    d, t = np.array([x[3:7:2] for x in dets])[:, None, :], np.array([x[3:7:2] for x in truth])[None, :, :]
    shared = np.maximum(0, np.minimum(d[..., 1], t[..., 1]) - np.maximum(d[..., 0], t[..., 0]))
    gain = shared / (d[..., 1] - d[..., 0] + t[..., 1] - t[..., 0] - shared)
    gain[gain < 0.002] = 0
    best = gain[matching.best_assignment(gain)].sum()
    assert abs(sum(r["iou"] for r in got) - best) < 1e-9


def test_lists_and_tables_pick_the_same_boxes():
    rng = np.random.default_rng(2)
    for seed in range(20):
        rows = sorted(graph(seed, 30, 25, 4))
        left, right = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        gain = rng.uniform(0.5, 1, len(rows))
        table = np.zeros((30, 25))
        table[left, right] = gain
        choice = np.zeros(table.shape, bool)
        choice[matching.best_assignment(table)] = True
        assert matching._picked_sparsely(np.arange(len(rows)), left, right, gain).tolist() == np.flatnonzero(choice[left, right]).tolist()

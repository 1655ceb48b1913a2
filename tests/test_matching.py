import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.operators import matching, metrics, pairs, suppression


def iou(a, b):
    w = min(a[2], b[2]) - max(a[0], b[0])
    h = min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    area = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1])
    return w * h / (area - w * h)


def crowd(seed, n, images=3, classes=2, spread=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.randrange(spread), rng.randrange(spread)
        box = (float(x), float(y), float(x + rng.randrange(20, 40)), float(y + rng.randrange(20, 40)))
        rows.append((i, f"i{rng.randrange(images)}", rng.randrange(classes), *box, rng.randrange(1, 20) / 20))
    return rows


def pairs_of(pred, truth, least=0.5):
    return [(iou(p[3:7], t[3:7]), p[0], t[0], (p[1], p[2])) for p in pred for t in truth if p[1:3] == t[1:3] and iou(p[3:7], t[3:7]) >= least]


def greedy(found):
    used_p, used_t, out = set(), set(), set()
    for _, p, t, _ in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
        if p not in used_p and t not in used_t:
            used_p.add(p), used_t.add(t), out.add((p, t))
    return out


def ids(df):
    return {(r["det_id"], r["annotation_id"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [256, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_and_greedy_in_normal_and_hot_groups(boxes, limit, seed):
    pred, truth = crowd(seed, 60), crowd(seed + 50, 50)
    p, t = boxes(pred), boxes(truth, "annotation_id")
    found = pairs_of(pred, truth)
    got = pairs.iou_pairs(p, t, 0.5, group_limit=limit, cell=16)
    assert ids(got) == {(a, b) for _, a, b, _ in found} and got.count() == len(found)
    assert ids(matching.match_boxes(p, t, 0.5, "greedy", group_limit=limit)) == greedy(found)


@pytest.mark.parametrize("limit", [256, 1])
def test_optimal_has_the_largest_total(boxes, limit):
    pred, truth = crowd(7, 14, images=2, classes=1, spread=25), crowd(8, 12, images=2, classes=1, spread=25)
    found = pairs_of(pred, truth, 0.3)
    got = matching.match_boxes(boxes(pred), boxes(truth, "annotation_id"), 0.3, "optimal", group_limit=limit).collect()
    assert len({r["det_id"] for r in got}) == len({r["annotation_id"] for r in got}) == len(got)
    best = 0.0
    for image in {f[3] for f in found}:
        here = [f for f in found if f[3] == image]
        rows, cols = sorted({f[1] for f in here}), sorted({f[2] for f in here})
        gain = np.zeros((len(rows), len(cols)))
        for v, a, b, _ in here:
            gain[rows.index(a), cols.index(b)] = v
        best += best_by_subsets(gain)
    total = sum(r["iou"] for r in got)
    assert total == pytest.approx(best)
    assert total >= sum(v for v, a, b, _ in found if (a, b) in greedy(found)) - 1e-9


def best_by_subsets(gain):
    """Exact optimum by dynamic programming over sets of columns."""
    table = {0: 0.0}
    for row in gain:
        following = dict(table)
        for used, value in table.items():
            for k, v in enumerate(row):
                if v > 0 and not used >> k & 1:
                    key = used | 1 << k
                    following[key] = max(following.get(key, -1.0), value + v)
        table = following
    return max(table.values())


def test_assignment_against_all_permutations():
    rng = np.random.default_rng(3)
    for n, m in [(1, 1), (3, 5), (5, 3), (5, 5)]:
        gain = rng.random((n, m)) * (rng.random((n, m)) > 0.3)
        rows, cols = matching.best_assignment(gain)
        assert gain[rows, cols].sum() == pytest.approx(best_by_subsets(gain))


@pytest.mark.parametrize("limit", [256, 1])
def test_coco_takes_turns_by_score(boxes, limit):
    pred, truth = crowd(11, 70), crowd(12, 50)
    got = matching.match_coco(boxes(pred), boxes(truth, "annotation_id"), group_limit=limit).collect()
    assert {r["det_id"] for r in got} == {p[0] for p in pred}
    table = {(a, b): v for v, a, b, _ in pairs_of(pred, truth, 0.5)}
    for i, level in enumerate(metrics.IOU_LEVELS):
        used, want = set(), {}
        for p in sorted(pred, key=lambda p: (-p[7], p[0])):
            free = [(-table[p[0], t[0]], t[0]) for t in truth if table.get((p[0], t[0]), 0) >= level and t[0] not in used]
            want[p[0]] = min(free)[1] if free else None
            used.add(want[p[0]])
        assert {r["det_id"]: r["hits"][i] for r in got} == want


def test_coco_limit_per_group(boxes):
    pred = [(i, "a", 0, 0.0, 0.0, 10.0, 10.0, i / 10) for i in range(6)]
    got = matching.match_coco(boxes(pred), boxes([(1, "a", 0, 0.0, 0.0, 10.0, 10.0, 1.0)], "annotation_id"), max_dets=3).collect()
    assert {r["det_id"]: r["tp"][0] for r in got} == {5: True, 4: False, 3: False}


def test_coco_scores_every_prediction_of_a_large_group(spark, boxes):
    """More than 300 predictions on one image and class, in rounds and in one fold."""
    pred = [(i, "a", 0, 10.0 * (i % 40), 0.0, 10.0 * (i % 40) + 10.0 + i % 3, 10.0, (i * 7 % 331) / 331) for i in range(331)]
    truth = [(i, "a", 0, 10.0 * i, 0.0, 10.0 * i + 10.0, 10.0, 1.0) for i in range(40)]
    p, t = boxes(pred), boxes(truth, "annotation_id")
    rounds, fold = (
        {r["det_id"]: r["hits"] for r in matching.match_coco(p, t, group_limit=limit).collect()} for limit in (256, 1_000)
    )
    assert len(rounds) == 331 and rounds == fold


def test_optimal_ties_do_not_depend_on_the_group_limit(boxes):
    pred = [(i, "a", 0, 100.0 * (i // 2), 0.0, 100.0 * (i // 2) + 10.0, 10.0, 0.5) for i in range(20)]
    truth = [(i, "a", 0, 100.0 * (i // 2), 0.0, 100.0 * (i // 2) + 10.0, 10.0, 1.0) for i in range(20)]
    p, t = boxes(pred), boxes(truth, "annotation_id")
    a, b = ({(r["det_id"], r["annotation_id"]) for r in matching.match_boxes(p, t, 0.5, group_limit=n).collect()} for n in (256, 1))
    assert a == b and len(a) == 20


def test_suppression_with_text_ids_and_flat_boxes(spark):
    rows = [("b", "i", 0, 0.0, 0.0, 10.0, 10.0, 0.9), ("a", "i", 0, 0.0, 0.0, 10.0, 10.0, 0.9), ("c", "i", 0, 5.0, 5.0, 5.0, 9.0, 0.5), ("d", "i", 0, 5.0, 5.0, 5.0, 9.0, 0.4)]
    df = spark.createDataFrame(rows, "det_id string, image_id string, class_id int, x1 double, y1 double, x2 double, y2 double, score double")
    assert {r["det_id"] for r in suppression.nms(df).collect()} == {"a", "c", "d"}
    assert {(r["det_id"], r["members"]) for r in suppression.fuse_boxes(df).collect()} == {("a", 2), ("c", 1), ("d", 1)}


def test_double_review_tells_places_apart(boxes):
    a, b = [(1, "a", 0, 0.0, 0.0, 10.0, 10.0, 1.0), (2, "a", 0, 50.0, 0.0, 60.0, 10.0, 1.0)], [(3, "a", 0, 3.0, 0.0, 13.0, 10.0, 1.0), (4, "a", 0, 50.0, 0.0, 60.0, 10.0, 1.0)]
    assert sorted(r["kind"] for r in matching.double_review(boxes(a), boxes(b)).collect()) == ["agree", "location"]


def nms_serial(rows, least):
    kept = []
    for r in sorted(rows, key=lambda r: (-r[7], r[0])):
        if not any(k[1:3] == r[1:3] and iou(k[3:7], r[3:7]) >= least for k in kept):
            kept.append(r)
    return {k[0] for k in kept}


@pytest.mark.parametrize("limit", [256, 1])
@pytest.mark.parametrize("seed", [21, 22])
def test_nms_in_normal_and_hot_groups(boxes, limit, seed):
    rows = crowd(seed, 80)
    rows += [(1000 + i, *rows[0][1:7], 0.01 * i) for i in range(15)]  # copies of one box
    assert {r["det_id"] for r in suppression.nms(boxes(rows), 0.4, group_limit=limit).collect()} == nms_serial(rows, 0.4)


def test_nms_chain(boxes):
    chain = [(1, "a", 0, 0.0, 0.0, 10.0, 10.0, 0.9), (2, "a", 0, 3.0, 0.0, 13.0, 10.0, 0.8), (3, "a", 0, 6.0, 0.0, 16.0, 10.0, 0.7)]
    for limit in (256, 1):
        assert {r["det_id"] for r in suppression.nms(boxes(chain), 0.5, group_limit=limit).collect()} == {1, 3}


def test_fusion_weighs_by_score(boxes):
    rows = [(1, "a", 0, 0.0, 0.0, 10.0, 10.0, 0.9), (2, "a", 0, 2.0, 0.0, 12.0, 10.0, 0.3), (3, "a", 0, 50.0, 50.0, 60.0, 60.0, 0.5)]
    got = {r["det_id"]: r for r in suppression.fuse_boxes(boxes(rows)).collect()}
    assert got[1]["x1"] == pytest.approx(0.5) and got[1]["score"] == pytest.approx(0.6) and got[1]["members"] == 2
    assert got[3]["members"] == 1


def test_object_across_tiles_becomes_one(boxes):
    from boxloom.operators.boxes import cut_to_tiles

    cut = cut_to_tiles(boxes([(1, "a", 0, 530.0, 100.0, 636.0, 200.0, 0.9)]))
    cut = cut.withColumn("det_id", F.col("tile_x").cast("bigint"))
    assert cut.count() == 2 and suppression.merge_tiles(cut).count() == 1


def test_average_precision_by_hand(boxes, spark):
    truth = boxes([(i, "a", 0, 20.0 * i, 0.0, 20.0 * i + 10, 10.0, 1.0) for i in range(4)], "annotation_id")
    pred = boxes([(0, "a", 0, 0.0, 0.0, 10.0, 10.0, 0.9), (1, "a", 0, 500.0, 0.0, 510.0, 10.0, 0.8), (2, "a", 0, 20.0, 0.0, 30.0, 10.0, 0.7)])
    counts = spark.createDataFrame([(0, 4), (3, 2)], "class_id int, n_truth bigint")
    got = {r["class_id"]: r for r in metrics.coco_summary(matching.match_coco(pred, truth), counts).collect()}
    assert got[0]["ap50"] == pytest.approx((26 * 1.0 + 25 * (2 / 3)) / 101)
    assert got[3]["ap50"] == 0.0


def test_class_without_truth_has_no_ap(boxes, spark):
    truth = boxes([(0, "a", 0, 0.0, 0.0, 10.0, 10.0, 1.0)], "annotation_id")
    pred = boxes([(0, "a", 5, 0.0, 0.0, 10.0, 10.0, 0.9)])
    got = {r["class_id"]: r["ap50"] for r in metrics.coco_summary(matching.match_coco(pred, truth), spark.createDataFrame([(0, 1)], "class_id int, n_truth bigint")).collect()}
    assert got == {0: 0.0, 5: None}


def test_result_does_not_depend_on_partitions_or_order(boxes):
    pred, truth = crowd(31, 60), crowd(32, 60)
    first = ids(matching.match_boxes(boxes(pred), boxes(truth, "annotation_id"), 0.5, "greedy"))
    again = ids(matching.match_boxes(boxes(pred[::-1]).repartition(7), boxes(truth[::-1], "annotation_id").coalesce(1), 0.5, "greedy"))
    assert first == again


def test_adjacent_support(spark):
    rows = [(1, "s", "c", 1, 0, 0.0), (2, "s", "c", 2, 0, 1.0), (3, "s", "c", 4, 0, 1.0), (4, "s", "d", 3, 0, 1.0)]
    df = spark.createDataFrame([(*r[:5], r[5], 0.0, r[5] + 10, 10.0) for r in rows], "det_id bigint, sequence_id string, camera_id string, frame_id bigint, class_id int, x1 double, y1 double, x2 double, y2 double")
    got = {r["det_id"]: (r["support_before"], r["support_after"]) for r in pairs.adjacent_support(df).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (False, False), 4: (False, False)}


def test_plans_of_pair_operators_have_no_cross_join(boxes):
    p, t = boxes(crowd(1, 20)), boxes(crowd(2, 20), "annotation_id")
    for df in (pairs.iou_pairs(p, t), matching.match_boxes(p, t, 0.5, "greedy"), matching.match_coco(p, t), suppression.nms(p)):
        plan = df._jdf.queryExecution().toString()
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
            assert node not in plan




def test_chains_and_piles_of_middling_groups_take_no_rounds(boxes, monkeypatch):
    """Groups beyond the fold that one task can hold are settled there, with flat boxes and missing scores among them."""
    chain = [(k, "a", 1, 3.0 * k, 0.0, 3.0 * k + 10, 10.0, 1 - k / 1000) for k in range(300)]
    pile = [(1000 + k, "b", 1, k / 1000, 0.0, 100 + k / 500, 100.0, 1 - k / 4000) for k in range(300)]
    odd = [(2000, "b", 1, 5.0, 5.0, 5.0, 9.0, 0.9), (2001, "b", 1, 0.5, 0.0, 100.0, 100.0, None), (2002, "b", 1, 0.0, 0.0, float("inf"), 9.0, 0.9)]

    def no_rounds(df, iou):
        raise AssertionError("rounds")

    monkeypatch.setattr(suppression, "_thinned", no_rounds)
    kept = {r["det_id"] for r in suppression.nms(boxes(chain + pile + odd)).collect()}
    assert kept == {*range(0, 300, 2), 2000, 2001, 2002}


def test_contested_groups_share_calls_of_the_assignment(spark, boxes, monkeypatch):
    """500 contested groups with the same ids go to the assignment in one call, not one each; none takes another's boxes."""
    from pyspark.sql.group import GroupedData

    keys = []
    real = GroupedData.applyInPandas

    def spied(self, func, schema):
        keys.append(self._jgd.toString())
        return real(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", spied)
    pred = boxes([(k, f"i{n}", 1, 0.0, 0.0, 10.0 + k, 10.0, 0.5) for n in range(500) for k in range(2)])
    truth = boxes([(k, f"i{n}", 1, 0.0, 0.0, 10.5 + k, 10.0, 0.5) for n in range(500) for k in range(2)], "annotation_id")
    got = matching.match_boxes(pred, truth, 0.3).collect()
    assert sorted((r["image_id"], r["det_id"], r["annotation_id"]) for r in got) == sorted((f"i{n}", k, k) for n in range(500) for k in range(2))
    assert keys and all("grouping expressions: ['pmod(" in k for k in keys)


def test_development_gate_counts_once(spark):
    """The counts come from all boxes, so they are made once, however often the report reads them."""
    made = spark.sparkContext.accumulator(0)

    def note(parts):
        for part in parts:
            made.add(len(part))
            yield part

    rows = [(f, c, 60, 1) for f in range(3) for c in range(2)]
    schema = "fold_id int, class_id int, tp long, fn long"
    counts = spark.createDataFrame(rows, schema).mapInPandas(note, schema)
    rules = spark.createDataFrame([(0, 0.9), (1, 0.95)], "class_id int, min_recall double")
    assert len(metrics.development_gate(counts, rules).collect()) == 9
    assert made.value == len(rows)

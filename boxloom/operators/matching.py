"""One-to-one assignment of predictions to truth.

`match_boxes` is the review operating point (maximum IoU), `match_coco` the COCO rule (score
order, ten IoU levels). Both start from overlap pairs that already meet the IoU threshold.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from boxloom.constants import IOU_LEVELS
from boxloom.functions.geometry import CORNERS
from boxloom.operators.auction import EPSILON, auction, local_auction
from boxloom.operators.pairs import GROUP_LIMIT, overlap_parts
from boxloom.session import checkpointed, stored

#: Cells of a component that are held as a table, and cells per overlap up to which larger ones are too; others are held as lists.
TABLE_CELLS, TABLE_FILL = 1_000_000, 16
#: Pairs of contested groups that one call of the assignment gets on average.
CHUNK = 20_000


def match_boxes(
    pred: DataFrame,
    truth: DataFrame,
    iou: float = 0.5,
    mode: str = "optimal",
    keys: tuple[str, ...] = ("image_id", "class_id"),
    *,
    left_id: str = "det_id",
    right_id: str = "annotation_id",
    group_limit: int = GROUP_LIMIT,
    exact_limit: int | None = None,
    epsilon: float = EPSILON,
) -> DataFrame:
    """Matched pairs (keys, prediction id, truth id, iou); unmatched rows are FP and FN.

    `optimal`: largest total IoU per group, whatever its size; a component of boxes that compete is settled by one task. Only
    where `exact_limit` is given, a component of more predictions is auctioned over many tasks instead, to within
    `epsilon` per prediction of it. `greedy`: largest IoU first, ties to the lower prediction id, then the lower truth id.
    """
    if mode not in ("greedy", "optimal"):
        raise ValueError(f"unknown mode {mode!r}")
    keys = list(keys)
    parts = overlap_parts(pred, truth, keys, iou, left_id=left_id, right_id=right_id, group_limit=group_limit)
    small, hot = [
        None if p is None else p.select(*keys, F.col("a.id").alias(left_id), F.col("b.id").alias(right_id), "iou", F.col("a.x1").alias("_x"))
        for p in parts
    ]
    if mode == "greedy":
        matched = _greedy_fold(small, keys, left_id, right_id)
        if hot is not None:
            matched = matched.unionByName(greedy_rounds(hot.drop("_x"), keys, left_id, right_id))
        return matched
    matched = _optimal(small, keys, keys, left_id, right_id)
    if hot is not None:
        unit = [*keys, "_component"]
        linked = _components(hot, keys, left_id, right_id)
        if exact_limit is None:
            return matched.unionByName(_optimal(linked, unit, keys, left_id, right_id))
        sizes = linked.groupBy(*unit).agg(F.count_distinct(left_id).alias("_lefts"), F.count(F.lit(1)).alias("_pairs"))
        large = checkpointed(sizes.filter((F.col("_lefts") > exact_limit) | (F.col("_pairs") > exact_limit * exact_limit)).select(*unit))
        columns = matched.columns
        matched = matched.unionByName(_optimal(linked.join(large, unit, "left_anti"), unit, keys, left_id, right_id))
        if not large.isEmpty():
            pairs = checkpointed(linked.join(large, unit, "left_semi"))
            matched = matched.unionByName(auction(pairs, unit, left_id, right_id, epsilon, order="_x")[0].select(*columns))
    return matched


def _greedy_fold(pairs: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Bounded groups: sort the pairs of a group and take each one whose ends are free."""
    entry = F.struct((-F.col("iou")).alias("rank"), F.col(left_id).alias("l"), F.col(right_id).alias("r"))
    grouped = pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("queue"))
    none = F.slice(F.col("queue"), 1, 0)

    def step(taken: Column, pair: Column) -> Column:
        clash = F.exists(taken, lambda t: (t["l"] == pair["l"]) | (t["r"] == pair["r"]))
        return F.when(clash, taken).otherwise(F.concat(taken, F.array(pair)))

    chosen = F.when(F.size("queue") == 1, F.col("queue")).otherwise(F.aggregate("queue", none, step))
    taken = grouped.select(*keys, F.explode(chosen).alias("p"))
    return taken.select(*keys, F.col("p.l").alias(left_id), F.col("p.r").alias(right_id), (-F.col("p.rank")).alias("iou"))


def greedy_rounds(
    pairs: DataFrame, keys: list[str], left_id: str, right_id: str, left_order: Column | None = None, right_order: Column | None = None
) -> DataFrame:
    """Groups of any size: a pair that is first for both of its ends is taken, then its ends leave.

    By default both ends order pairs by (iou desc, left id, right id). This takes the same pairs as the fold, since no
    pair before it can claim either end. Every round is a distributed aggregation keyed by box, and settles at least
    one pair per group.
    """
    order = F.struct((-F.col("iou")).alias("rank"), F.col(left_id).alias("l"), F.col(right_id).alias("r"))
    left_order, right_order = (order if x is None else x for x in (left_order, right_order))
    live = checkpointed(pairs)
    done: list[DataFrame] = []
    while not live.isEmpty():
        best_l = live.groupBy(*keys, left_id).agg(F.min_by(F.struct(right_id, "iou"), left_order).alias("best"))
        best_l = best_l.select(*keys, left_id, f"best.{right_id}", "best.iou")
        best_r = live.groupBy(*keys, right_id).agg(F.min_by(left_id, right_order).alias(left_id))
        taken = checkpointed(best_l.join(best_r, [*keys, left_id, right_id]))
        done.append(taken)
        live = live.join(taken.select(*keys, left_id), [*keys, left_id], "left_anti")
        live = checkpointed(live.join(taken.select(*keys, right_id), [*keys, right_id], "left_anti"))
    columns = [*keys, left_id, right_id, "iou"]
    return reduce(DataFrame.unionByName, [d.select(*columns) for d in done])


def _optimal(pairs: DataFrame, unit: list[str], keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Uncontested pairs stay in SQL; a group with any contested box goes to the assignment."""
    per_l, per_r = W.partitionBy(*unit, left_id), W.partitionBy(*unit, right_id)
    one = F.count(F.lit(1))
    flagged = pairs.withColumn("_clash", (one.over(per_l) > 1) | (one.over(per_r) > 1))
    flagged = flagged.withColumn("_contested", F.max("_clash").over(W.partitionBy(*unit)))
    columns = [*keys, left_id, right_id, "iou"]
    free = flagged.filter(~F.col("_contested")).select(*columns)

    def assign(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values([left_id, right_id], ignore_index=True)
        l_code, r_code = (chunk.groupby([*unit, ident], dropna=False).ngroup().to_numpy() for ident in (left_id, right_id))
        # boxes that never compete part ways: ties fall alike, whatever group the pairs came in
        label = np.arange(l_code.max() + 1)
        while True:
            per_right = np.full(r_code.max() + 1, len(label))
            np.minimum.at(per_right, r_code, label[l_code])
            new = label.copy()
            np.minimum.at(new, l_code, per_right[r_code])
            if (new == label).all():
                break
            label = new
        return chunk.loc[_picked(label[l_code], l_code, r_code, chunk["iou"].to_numpy()), columns]

    hard = checkpointed(flagged.filter("_contested").select(*dict.fromkeys([*unit, *columns])))
    chunks = max(1, -(-hard.count() // CHUNK))
    schema = pairs.select(*columns).schema
    return free.unionByName(hard.groupBy(F.pmod(F.xxhash64(*unit), F.lit(chunks))).applyInPandas(assign, schema))


def _picked(part: np.ndarray, left: np.ndarray, right: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Rows that the best assignment of their component (`part`) takes; rows are in order of left and right box."""
    order = np.lexsort((np.arange(len(part)), -gain, part))
    starts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
    taken = []
    for rows in np.split(order, starts[1:]):
        if (left[rows] == left[rows[0]]).all() or (right[rows] == right[rows[0]]).all():
            taken.append(rows[:1])  # a single box on one side takes its best partner
            continue
        lefts, l_code = np.unique(left[rows], return_inverse=True)
        rights, r_code = np.unique(right[rows], return_inverse=True)
        if len(lefts) * len(rights) > max(TABLE_CELLS, TABLE_FILL * len(rows)):
            taken.append(_picked_sparsely(np.sort(rows), left, right, gain))
            continue
        table = np.zeros((len(lefts), len(rights)))
        table[l_code, r_code] = gain[rows]
        choice = np.zeros(table.shape, bool)
        choice[best_assignment(table)] = True
        taken.append(np.sort(rows[choice[l_code, r_code] & (gain[rows] > 0)]))
    return np.concatenate(taken)


def _picked_sparsely(rows: np.ndarray, left: np.ndarray, right: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """The same for one component, in memory that follows its overlaps and not the product of its sides."""
    _, l_code = np.unique(left[rows], return_inverse=True)
    rights, r_code = np.unique(right[rows], return_inverse=True)
    owner = np.full(len(rights), -1)
    # a single block without bidders elsewhere: its shortest chains end at the optimum, and nothing is added to a bid
    local_auction(np.concatenate([[0], np.cumsum(np.bincount(l_code))]), r_code, gain[rows], np.zeros(len(rights)), owner, 0.0)
    return rows[owner[r_code] == l_code]


def best_assignment(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the assignment with the largest total gain (shortest augmenting paths)."""
    flipped = gain.shape[0] > gain.shape[1]
    cost = -(gain.T if flipped else gain)
    n, m = cost.shape
    row_price, col_price = np.zeros(n), np.zeros(m)
    owner = np.full(m, -1)
    for start in range(n):
        distance = np.full(m, np.inf)
        parent = np.full(m, -1)
        closed = np.zeros(m, dtype=bool)
        row, reached, end = start, 0.0, -1
        while end < 0:
            reduced = reached + cost[row] - row_price[row] - col_price
            better = ~closed & (reduced < distance)
            distance[better] = reduced[better]
            parent[better] = row
            k = int(np.argmin(np.where(closed, np.inf, distance)))
            reached = distance[k]
            closed[k] = True
            if owner[k] < 0:
                end = k
            else:
                row = owner[k]
        for k in np.flatnonzero(closed):
            if owner[k] >= 0:
                row_price[owner[k]] += reached - distance[k]
            col_price[k] -= reached - distance[k]
        row_price[start] += reached
        k = end
        while k >= 0:
            row = parent[k]
            previous = np.flatnonzero(owner == row)
            owner[k] = row
            k = int(previous[previous != k][0]) if row != start else -1
    cols = np.flatnonzero(owner >= 0)
    rows = owner[cols]
    return (cols, rows) if flipped else (rows, cols)


def _components(pairs: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Label every pair with its connected component: boxes that never compete part ways.

    The smallest left id spreads over shared ends, one distributed aggregation per end and round.
    """
    live = checkpointed(pairs.withColumn("_component", F.col(left_id)))
    while True:
        by_r = live.groupBy(*keys, right_id).agg(F.min("_component").alias("_r"))
        step = live.join(by_r, [*keys, right_id])
        by_l = step.groupBy(*keys, left_id).agg(F.min("_r").alias("_l"))
        step = checkpointed(step.drop("_r").join(by_l, [*keys, left_id]))
        changed = not step.filter(F.col("_l") < F.col("_component")).isEmpty()
        live = step.withColumn("_component", F.least("_component", "_l")).drop("_l")
        if not changed:
            return live


def match_coco(
    pred: DataFrame,
    truth: DataFrame,
    levels: list[float] = IOU_LEVELS,
    max_dets: int | None = None,
    keys: tuple[str, ...] = ("image_id", "class_id"),
    *,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per scored prediction: `tp` holds one flag per IoU level, `hits` the truth ids.

    Predictions take turns by (score desc, det_id); each takes the free truth with the largest IoU. Every prediction
    is scored, unless an evaluation asks for the best `max_dets` of each group. Groups of up to `group_limit` boxes are
    folded in one array; larger ones are settled in distributed rounds, with the same result.
    """
    keys = list(keys)
    scored = pred.select(*keys, "det_id", "score", *CORNERS)
    if max_dets is not None:
        turn = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("det_id"))
        scored = scored.withColumn("_turn", F.row_number().over(turn)).filter(F.col("_turn") <= max_dets).drop("_turn")
    parts = overlap_parts(
        scored, truth, keys, min(levels), left_id="det_id", right_id="annotation_id", left_extra=["score"], group_limit=group_limit
    )
    small, hot = [
        None if p is None else p.select(*keys, F.col("a.id").alias("det_id"), F.col("a.score").alias("score"), F.col("b.id").alias("annotation_id"), "iou")
        for p in parts
    ]
    hits = _coco_fold(small, keys, levels)
    if hot is not None:
        hits = hits.unionByName(_coco_rounds(hot, keys, levels))
    none = F.array(*[F.lit(None).cast(dict(truth.dtypes)["annotation_id"]) for _ in levels])
    out = scored.select(*keys, "det_id", "score").join(hits, [*keys, "det_id"], "left").withColumn("hits", F.coalesce("hits", none))
    return out.withColumn("tp", F.transform("hits", lambda h: h.isNotNull()))


def _coco_fold(pairs: DataFrame, keys: list[str], levels: list[float]) -> DataFrame:
    """(keys, det_id, hits) of bounded groups, for predictions with any candidate."""
    candidates = pairs.groupBy(*keys, "det_id", "score").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("iou")).alias("rank"), F.col("annotation_id").alias("t")))).alias("cand")
    )
    entry = F.struct((-F.col("score")).alias("rank"), "det_id", "cand")
    grouped = candidates.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("queue"))
    no_hit = F.slice(F.transform(F.array(F.lit(0)), lambda _: F.lit(None).cast(dict(pairs.dtypes)["annotation_id"])), 1, 0)

    def fold(level: float) -> Column:
        def step(taken: Column, det: Column) -> Column:
            able = F.filter(det["cand"], lambda k: (-k["rank"] >= F.lit(level)) & ~F.coalesce(F.array_contains(taken, k["t"]), F.lit(False)))
            # a prediction without a free truth leaves a null, so positions stay aligned
            return F.concat(taken, F.array(F.get(able, F.lit(0))["t"]))

        return F.aggregate("queue", no_hit, step)

    # where no truth is wanted twice, every prediction simply takes its best candidate
    wanted = F.flatten(F.transform("queue", lambda d: F.transform(d["cand"], lambda k: k["t"])))
    contested = F.size(wanted) != F.size(F.array_distinct(wanted))
    # entry i of a level's list is what prediction i took
    grouped = grouped.withColumn("_by_level", F.when(contested, F.array(*[fold(level) for level in levels])))
    each = grouped.select(*keys, F.posexplode("queue").alias("_i", "d"), "_by_level")
    first = F.get(F.col("d.cand"), F.lit(0))
    alone = F.transform(F.array(*[F.lit(level) for level in levels]), lambda level: F.when(-first["rank"] >= level, first["t"]))
    hits = F.when(F.col("_by_level").isNull(), alone).otherwise(F.transform("_by_level", lambda level: F.get(level, F.col("_i"))))
    return each.select(*keys, F.col("d.det_id").alias("det_id"), hits.alias("hits"))


def _coco_rounds(pairs: DataFrame, keys: list[str], levels: list[float]) -> DataFrame:
    """The same for groups of any size: all levels at once, each level of a group on its own."""
    at = F.array(*[F.lit(level) for level in levels])
    pairs = pairs.withColumn("_level", F.explode(F.filter(at, lambda level: level <= F.col("iou"))))
    taken = greedy_rounds(
        pairs, [*keys, "_level"], "det_id", "annotation_id",
        F.struct((-F.col("iou")).alias("rank"), "annotation_id"), F.struct((-F.col("score")).alias("rank"), "det_id"),
    )
    found = taken.groupBy(*keys, "det_id").agg(F.map_from_entries(F.collect_list(F.struct("_level", "annotation_id"))).alias("_hit"))
    return found.select(*keys, "det_id", F.transform(at, lambda level: F.try_element_at("_hit", level)).alias("hits"))


def disagreements(
    a: DataFrame, b: DataFrame, iou: float = 0.5, close_iou: float = 0.75, *, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """Compare two sets of boxes per image, class-blind: agree, class, location, a_only, b_only."""
    left = a.withColumnRenamed("det_id", "a_id")
    right = b.withColumnRenamed("det_id", "b_id")
    hits = stored(match_boxes(left, right, iou, "greedy", ("image_id",), left_id="a_id", right_id="b_id", group_limit=group_limit))
    rows = left.select("image_id", "a_id", F.col("class_id").alias("a_class"), F.col("score").alias("a_score"))
    rows = rows.join(hits, ["image_id", "a_id"], "left")
    other = right.select("image_id", "b_id", F.col("class_id").alias("b_class"), F.col("score").alias("b_score"))
    rows = rows.join(other, ["image_id", "b_id"], "full_outer")
    kind = (
        F.when(F.col("b_id").isNull(), "a_only")
        .when(F.col("a_id").isNull(), "b_only")
        .when(F.col("a_class") != F.col("b_class"), "class")
        .when(F.col("iou") < close_iou, "location")
        .otherwise("agree")
    )
    return rows.withColumn("kind", kind)


def missing_labels(pred: DataFrame, human: DataFrame, score: float = 0.8, iou: float = 0.5) -> DataFrame:
    """Strong detections without any human box of their class: possible missing labels."""
    strong = pred.filter(F.col("score") >= score)
    hits = match_boxes(strong, human, iou, "greedy")
    return strong.join(hits.select("image_id", "class_id", "det_id"), ["image_id", "class_id", "det_id"], "left_anti")


def double_review(a: DataFrame, b: DataFrame, iou: float = 0.5, close_iou: float = 0.75) -> DataFrame:
    """Reviewer A x reviewer B at box, place and class level, one row per decision."""
    return disagreements(a, b, iou, close_iou)

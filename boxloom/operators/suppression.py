"""Suppression, fusion and merging of overlapping boxes of one image and class."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from boxloom.functions import geometry as g
from boxloom.operators.boxes import untile
from boxloom.operators.pairs import CELL, GROUP_LIMIT, cells, overlap_join
from boxloom.operators.scale import hot_keys, split_by_keys
from boxloom.session import checkpointed

KEYS = ["image_id", "class_id"]
#: Pixels of a block in which large groups are settled before an exchange, and overlaps of a block at most.
LOCAL_BLOCK, LOCAL_EDGES = 512.0, 200_000
#: Groups of up to this many times `group_limit` boxes are settled one by one in tasks, in order of score.
SERIAL = 16


def nms(df: DataFrame, iou: float = 0.5, *, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Keep a box when no kept box before it (score desc, det_id) overlaps it by `iou` or more.

    Exact copies fall to their best copy first, by a plain aggregation, so a pile of copies
    never forms pairs. Groups above `group_limit` go through numpy, one group at a time; those above SERIAL times as many
    boxes are settled in distributed rounds.
    """
    rest = [c for c in df.columns if c not in (*KEYS, *g.CORNERS)]
    best = F.min_by(F.struct(*rest), F.struct((-F.col("score")).alias("rank"), "det_id"))
    # boxes without area overlap nothing, not even their copies
    alone = F.when(g.area(g.corners()) <= 0, F.col("det_id")).alias("_alone")
    distinct = df.groupBy(*KEYS, *g.CORNERS, alone).agg(best.alias("_b")).select(*KEYS, *g.CORNERS, "_b.*")
    big = hot_keys(df, KEYS, group_limit)
    small, hot = split_by_keys(distinct, KEYS, big)
    kept = _fold(small, iou)
    if hot is not None:
        hot = checkpointed(hot)
        middle, hot = split_by_keys(hot, KEYS, hot_keys(hot, KEYS, SERIAL * group_limit))
        settled = _in_order(middle.select(*KEYS, "det_id", "score", *g.CORNERS), iou)
        kept = kept.unionByName(middle.join(settled, [*KEYS, "det_id"], "left_semi"))
    if hot is not None:
        sure, rest = _thinned(hot.select(*KEYS, "det_id", "score", *g.CORNERS), iou)
        settled = sure.unionByName(_rounds(rest, iou))
        kept = kept.unionByName(hot.join(settled, [*KEYS, "det_id"], "left_semi"))
    return kept.select(*df.columns)


def _thinned(df: DataFrame, iou: float) -> tuple[DataFrame, DataFrame]:
    """(keys, det_id) kept for sure, and the boxes that are still open, without making any pair of a pile.

    A box that is the best one in every cell it reaches has no better neighbour: it is kept, and what it overlaps goes.
    A cell has one such box at most, so a pass costs a row per box and cell. Passes go on while they at least halve.
    """
    done: list[DataFrame] = []
    left = df.count()
    while True:
        body = F.struct(F.col("det_id").alias("id"), "score", *g.CORNERS)
        placed = checkpointed(cells(df.select(*KEYS, body.alias("b")), "b", CELL))
        spot = [*KEYS, "_cx", "_cy"]
        best = placed.groupBy(*spot).agg(F.min_by("b", F.struct((-F.col("b.score")).alias("rank"), F.col("b.id"))).alias("a"))
        wins = best.groupBy(*KEYS, F.col("a.id").alias("det_id")).agg(F.count(F.lit(1)).alias("_won"))
        reach = placed.groupBy(*KEYS, F.col("b.id").alias("det_id")).agg(F.count(F.lit(1)).alias("_all"))
        sure = checkpointed(wins.join(reach, [*KEYS, "det_id"]).filter("_won = _all").select(*KEYS, "det_id"))
        owned = best.withColumn("det_id", F.col("a.id")).join(sure, [*KEYS, "det_id"], "left_semi").drop("det_id")
        hidden = placed.join(owned, spot).filter((F.col("a.id") != F.col("b.id")) & (g.iou(g.corners("a"), g.corners("b")) >= iou))
        gone = hidden.select(*KEYS, F.col("b.id").alias("det_id")).unionByName(sure).distinct()
        df = checkpointed(df.join(gone, [*KEYS, "det_id"], "left_anti"))
        done.append(sure)
        now = df.count()
        if not now or now > left / 2:
            return reduce(DataFrame.unionByName, done), df
        left = now


def _fold(df: DataFrame, iou: float) -> DataFrame:
    # whole rows travel in the sorted array, so the kept ones need no join afterwards
    rest = [c for c in df.columns if c not in (*KEYS, *g.CORNERS, "det_id")]
    entry = F.struct((-F.col("score")).alias("rank"), "det_id", *g.CORNERS, F.struct(*rest).alias("rest"))
    grouped = df.groupBy(*KEYS).agg(F.sort_array(F.collect_list(entry)).alias("queue"))
    none = F.slice(F.col("queue"), 1, 0)

    def step(kept: Column, box: Column) -> Column:
        corners = [box[n] for n in g.CORNERS]
        hidden = F.exists(kept, lambda k: g.iou([k[n] for n in g.CORNERS], corners) >= iou)
        return F.when(hidden, kept).otherwise(F.concat(kept, F.array(box)))

    kept = F.when(F.size("queue") == 1, F.col("queue")).otherwise(F.aggregate("queue", none, step))
    rows = grouped.select(*KEYS, F.explode(kept).alias("b"))
    return rows.select(*KEYS, "b.det_id", *[F.col(f"b.{n}") for n in g.CORNERS], "b.rest.*")


def _in_order(df: DataFrame, iou: float) -> DataFrame:
    """(keys, det_id) kept in groups that one task can hold: the best open box stays, what it overlaps goes."""
    columns = [*KEYS, "det_id"]
    flat = df.select(*columns, F.col("score").isNotNull().alias("_scored"), (-F.col("score")).alias("_rank"), *[F.col(n).cast("double") for n in g.CORNERS])

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_scored", "_rank", "det_id"], ignore_index=True)
        x1, y1, x2, y2 = (part[n].to_numpy(float) for n in g.CORNERS)
        area = (x2 - x1) * (y2 - y1)
        # boxes without a positive finite area overlap nothing
        able = (x2 > x1) & (y2 > y1) & np.isfinite(area)
        hidden = np.zeros(len(part), bool)
        for i in np.flatnonzero(able):
            if hidden[i]:
                continue
            rest = i + 1 + np.flatnonzero((able & ~hidden)[i + 1 :])
            shared = np.maximum(0, np.minimum(x2[i], x2[rest]) - np.maximum(x1[i], x1[rest])) * np.maximum(0, np.minimum(y2[i], y2[rest]) - np.maximum(y1[i], y1[rest]))
            hidden[rest] = shared / (area[i] + area[rest] - shared) >= iou
        return part.loc[~hidden, columns]

    return flat.groupBy(*KEYS).applyInPandas(settle, df.select(*columns).schema)


def _rounds(df: DataFrame, iou: float) -> DataFrame:
    """A live box without a better live neighbour is kept; its neighbours leave; repeat.

    Before each exchange, boxes are settled within blocks of the image as far as their better neighbours lie in the same
    block, so that a chain of boxes takes about as many rounds as it crosses blocks. Blocks move from round to round;
    those with more than LOCAL_EDGES overlaps are left to the exchange.
    """
    def before(a: Column, b: Column) -> Column:
        return (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (a["id"] < b["id"]))

    if df.isEmpty():
        return df.select(*KEYS, "det_id")
    pairs = overlap_join(
        df, df, KEYS, iou, left_id="det_id", right_id="det_id",
        left_extra=["score"], right_extra=["score"], residual=before, group_limit=0,
    )
    edges = checkpointed(pairs.select(*KEYS, *[F.col(f"{side}.{name}").alias(f"{end}{name}") for side, end in (("a", "w_"), ("b", "l_")) for name in ("id", "x1", "y1", "score")]))
    live = checkpointed(df.select(*KEYS, "det_id"))
    done: list[DataFrame] = []
    while not live.isEmpty():
        free = live.join(edges.select(*KEYS, F.col("l_id").alias("det_id")), [*KEYS, "det_id"], "left_anti")
        kept = checkpointed(free.unionByName(_settled(edges, len(done))).distinct())
        done.append(kept)
        losers = edges.join(kept.withColumnRenamed("det_id", "w_id"), [*KEYS, "w_id"], "left_semi")
        gone = losers.select(*KEYS, F.col("l_id").alias("det_id"))
        settled = checkpointed(gone.unionByName(kept).distinct())
        live = checkpointed(live.join(settled, [*KEYS, "det_id"], "left_anti"))
        edges = edges.join(settled.withColumnRenamed("det_id", "l_id"), [*KEYS, "l_id"], "left_anti")
        edges = checkpointed(edges.join(settled.withColumnRenamed("det_id", "w_id"), [*KEYS, "w_id"], "left_anti"))
    return reduce(DataFrame.unionByName, done)


def _settled(edges: DataFrame, number: int) -> DataFrame:
    """Boxes that are kept for sure, judging by the overlaps of one block of the image at a time."""
    shift = number * LOCAL_BLOCK / 3

    def block(end: str) -> list[Column]:
        return [F.floor((F.col(f"{end}{c}") + shift) / LOCAL_BLOCK) for c in ("x1", "y1")]

    (lx, ly), (wx, wy) = block("l_"), block("w_")
    rows = edges.withColumns({"_bx": lx, "_by": ly, "_inside": (lx == wx) & (ly == wy)})
    unit = [*KEYS, "_bx", "_by"]
    small = rows.groupBy(*unit).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= LOCAL_EDGES).drop("_n")
    kind = dict(edges.dtypes)
    columns = [*KEYS, "det_id"]

    def settle(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        better: dict = {}
        for winner, loser, inside in zip(part["w_id"], part["l_id"], part["_inside"]):
            better.setdefault(loser, []).append((winner, inside))
        score = dict(zip(part["w_id"], part["w_score"])) | dict(zip(part["l_id"], part["l_score"]))
        here = set(part["l_id"]) | set(part.loc[part["_inside"], "w_id"])
        state: dict = {}
        for box in sorted(here, key=lambda b: (-score[b], b)):
            above = [state.get(w) if inside else None for w, inside in better.get(box, [])]
            if any(x is True for x in above):
                state[box] = False
            elif all(x is False for x in above):
                state[box] = True
        kept = [b for b, x in state.items() if x is True]
        return pd.DataFrame({**{k: [v] * len(kept) for k, v in zip(KEYS, key)}, "det_id": kept}, columns=columns)

    schema = ", ".join(f"{c} {kind['l_id'] if c == 'det_id' else kind[c]}" for c in columns)
    return rows.join(small, unit).groupBy(*unit).applyInPandas(settle, schema)


def fuse_boxes(df: DataFrame, iou: float = 0.5, *, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Weighted box fusion: every suppressed box joins the kept box it overlaps most.

    Corners are the score-weighted mean of the cluster, the score its plain mean; `det_id` is
    the kept box, `members` the cluster size. Bounded groups are clustered in the array that suppression folds over, with
    one shuffle; larger groups take a second overlap join.
    """
    df = df.select(*KEYS, "det_id", "score", *g.CORNERS)
    big = hot_keys(df, KEYS, group_limit)
    small, hot = split_by_keys(df, KEYS, big)
    parts = _fold_clusters(small, iou)
    if hot is not None:
        parts = parts.unionByName(_joined_clusters(checkpointed(hot), iou, group_limit))
    weight = F.sum("score")
    return parts.groupBy(*KEYS, "det_id").agg(
        *[F.coalesce(F.try_divide(F.sum(F.col(n) * F.col("score")), weight), F.avg(n)).alias(n) for n in g.CORNERS],
        F.avg("score").alias("score"),
        F.count(F.lit(1)).alias("members"),
    )


def _fold_clusters(df: DataFrame, iou: float) -> DataFrame:
    """(keys, det_id of the kept box, corners and score of a member) for bounded groups."""
    entry = F.struct((-F.col("score")).alias("rank"), "det_id", *g.CORNERS)
    queue = df.groupBy(*KEYS).agg(F.sort_array(F.collect_list(entry)).alias("queue"))
    none = F.slice(F.col("queue"), 1, 0)

    def overlap(a: Column, b: Column) -> Column:
        return g.iou([a[n] for n in g.CORNERS], [b[n] for n in g.CORNERS])

    def step(kept: Column, box: Column) -> Column:
        return F.when(F.exists(kept, lambda k: overlap(k, box) >= iou), kept).otherwise(F.concat(kept, F.array(box)))

    folded = queue.withColumn("kept", F.when(F.size("queue") == 1, F.col("queue")).otherwise(F.aggregate("queue", none, step)))
    rows = folded.select(*KEYS, "kept", F.explode("queue").alias("b"))
    # kept boxes before the member in the queue, the largest overlap first
    def before(k: Column) -> Column:
        return (k["rank"] < F.col("b.rank")) | ((k["rank"] == F.col("b.rank")) & (k["det_id"] < F.col("b.det_id")))

    options = F.transform(
        F.filter("kept", lambda k: before(k) & (overlap(k, F.col("b")) >= iou)),
        lambda k: F.struct((-overlap(k, F.col("b"))).alias("rank"), k["det_id"].alias("det_id")),
    )
    keeper = F.when(F.exists("kept", lambda k: k["det_id"] == F.col("b.det_id")), F.col("b.det_id")).otherwise(F.array_min(options)["det_id"])
    return rows.select(*KEYS, keeper.alias("det_id"), *[F.col(f"b.{n}").alias(n) for n in g.CORNERS], (-F.col("b.rank")).alias("score"))


def _joined_clusters(df: DataFrame, iou: float, group_limit: int) -> DataFrame:
    kept = checkpointed(nms(df, iou, group_limit=group_limit))
    rest = df.join(kept.select(*KEYS, "det_id"), [*KEYS, "det_id"], "left_anti")
    near = overlap_join(
        rest, kept, KEYS, iou, left_id="det_id", right_id="det_id",
        left_extra=["score"], right_extra=["score"], group_limit=group_limit,
        residual=lambda a, b: (b["score"] > a["score"]) | ((b["score"] == a["score"]) & (b["id"] < a["id"])),
    )
    member = F.struct(*[F.col(f"a.{n}").alias(n) for n in (*g.CORNERS, "score")])
    choice = F.struct((-F.col("iou")).alias("rank"), F.col("b.id"))
    near = near.groupBy(*KEYS, F.col("a.id").alias("_a")).agg(
        F.min_by(F.struct(F.col("b.id").alias("id"), member.alias("m")), choice).alias("c")
    )
    return near.select(*KEYS, F.col("c.id").alias("det_id"), "c.m.*").unionByName(
        kept.select(*KEYS, "det_id", *g.CORNERS, "score")
    )


def merge_tiles(tiles: DataFrame, iou: float = 0.5, method: str = "nms", *, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Tile detections back in the full image, an object seen by several tiles becoming one."""
    full = untile(tiles)
    merge = {"nms": nms, "fuse": fuse_boxes}[method]
    return merge(full, iou, group_limit=group_limit)


def tile_duplicate_rate(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Share of tiled boxes removed by the merge, per key."""
    n_before = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("tiled_boxes"))
    n_after = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("merged_boxes"))
    rows = n_before.join(n_after, keys, "left").fillna(0, ["merged_boxes"])
    removed = (F.col("tiled_boxes") - F.col("merged_boxes")).cast("double")
    return rows.withColumn("duplicate_rate", F.try_divide(removed, F.col("tiled_boxes")))

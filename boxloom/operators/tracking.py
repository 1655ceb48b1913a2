"""Track association over ordered frames and the operators around it.

Association is sequential within a lane (camera, segment, class). Lanes run in parallel, and a
lane is cut further wherever no box appears for longer than a track may survive, which changes
nothing: no track lives across such a pause. What is still long is relayed in frame blocks: every
block starts from the few tracks that the block before it left alive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from boxloom.functions import geometry as g
from boxloom.operators.manifest import FRAME_BUCKET
from boxloom.operators.matching import match_boxes
from boxloom.operators.scale import carry, running_sum
from boxloom.session import checkpointed, stored_by

LANE = ("sequence_id", "camera_id", "segment_id")
CORNERS = list(g.CORNERS)
#: Boxes that one call of the association gets on average, whole lanes each.
LOT = 50_000
#: Tracks times boxes of a frame up to which plain numbers are faster than arrays.
FEW_PAIRS = 64
STATE = ["track_id", "last_frame", "hits", "x1", "y1", "x2", "y2", "vx", "vy"]
STATE_TYPE = "track_id string, last_frame bigint, hits bigint, x1 double, y1 double, x2 double, y2 double, vx double, vy double"


@dataclass(frozen=True)
class TrackConfig:
    """`classes` overrides (low, high) per class, `cameras` overrides (min_iou, max_shift) per camera."""

    low: float = 0.1
    high: float = 0.5
    min_iou: float = 0.3
    max_shift: float = 200.0
    max_gap: int = 3
    classes: dict = field(default_factory=dict)
    cameras: dict = field(default_factory=dict)


def associate(tracks: pd.DataFrame, boxes: pd.DataFrame, cfg: TrackConfig, min_iou: float, max_shift: float) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Run the frames of `boxes` (sorted; `strong` set) from the live `tracks`.

    Strong boxes are matched first, then weak ones to the tracks left; unmatched strong boxes
    start tracks. Returns (det_id, track_id, pass) rows and the tracks still alive.
    """
    live = [dict(zip(STATE, row)) for row in tracks[STATE].itertuples(index=False, name=None)]
    found: list[tuple] = []
    frames = boxes["frame_id"].to_numpy()
    corners = boxes[CORNERS].to_numpy(dtype=float)
    strong = boxes["strong"].to_numpy(dtype=bool)
    dets = boxes["det_id"].to_numpy()
    cuts = np.flatnonzero(np.diff(frames)) + 1
    for rows in np.split(np.arange(len(frames)), cuts):
        if not len(rows):
            continue
        frame = int(frames[rows[0]])
        live = [t for t in live if frame - t["last_frame"] <= cfg.max_gap]
        taken: set[int] = set()
        for name, use in (("strong", strong[rows]), ("weak", ~strong[rows])):
            free = [t for t in live if t["last_frame"] < frame]
            here = rows[use]
            for t, i in _best_pairs(free, corners, here, dets, frame, min_iou, max_shift):
                _extend(t, corners[i], frame)
                found.append((dets[i], t["track_id"], name))
                taken.add(i)
        for i in rows[strong[rows]]:
            if i not in taken:
                box = corners[i]
                live.append(dict(zip(STATE, (f"t{dets[i]}", frame, 1, *box, 0.0, 0.0))))
                found.append((dets[i], f"t{dets[i]}", "start"))
    return pd.DataFrame(found, columns=["det_id", "track_id", "pass"]), pd.DataFrame(live, columns=STATE)


def _best_pairs(tracks, corners, here, dets, frame, min_iou, max_shift):
    """Largest IoU with the predicted box first, ties by track id, then by box id."""
    if not tracks or not len(here):
        return []
    if len(tracks) * len(here) <= FEW_PAIRS:
        return _few_pairs(tracks, corners, here, dets, frame, min_iou, max_shift)
    last = np.array([[t[n] for n in CORNERS] for t in tracks])
    age = np.array([frame - t["last_frame"] for t in tracks], dtype=float)
    drift = np.array([[t["vx"], t["vy"], t["vx"], t["vy"]] for t in tracks]) * age[:, None]
    want, have = (last + drift)[:, None, :], corners[here][None, :, :]
    span = np.minimum(want[..., 2:], have[..., 2:]) - np.maximum(want[..., :2], have[..., :2])
    shared = np.prod(np.clip(span, 0, None), axis=-1)
    size = np.prod(want[..., 2:] - want[..., :2], axis=-1) + np.prod(have[..., 2:] - have[..., :2], axis=-1)
    iou = shared / np.maximum(size - shared, 1e-12)
    shift = np.linalg.norm((want[..., :2] + want[..., 2:] - have[..., :2] - have[..., 2:]) / 2, axis=-1)
    able = np.argwhere((iou >= min_iou) & (shift <= max_shift))
    queue = sorted((-iou[a, b], tracks[a]["track_id"], dets[here[b]], a, b) for a, b in able)
    used_a, used_b, pairs = set(), set(), []
    for _, _, _, a, b in queue:
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            pairs.append((tracks[a], here[b]))
    return pairs


def _few_pairs(tracks, corners, here, dets, frame, min_iou, max_shift):
    """`_best_pairs` number by number, which costs less than arrays for the few boxes of a frame."""
    boxes = corners[here].tolist()
    queue = []
    for a, t in enumerate(tracks):
        age = float(frame - t["last_frame"])
        dx, dy = t["vx"] * age, t["vy"] * age
        x1, y1, x2, y2 = t["x1"] + dx, t["y1"] + dy, t["x2"] + dx, t["y2"] + dy
        for b, (u1, v1, u2, v2) in enumerate(boxes):
            across, down = min(x2, u2) - max(x1, u1), min(y2, v2) - max(y1, v1)
            shared = across * down if across > 0 and down > 0 else 0.0
            iou = shared / max((x2 - x1) * (y2 - y1) + (u2 - u1) * (v2 - v1) - shared, 1e-12)
            if iou < min_iou:
                continue
            right, below = (x1 + x2 - u1 - u2) / 2, (y1 + y2 - v1 - v2) / 2
            if math.sqrt(right * right + below * below) <= max_shift:
                queue.append((-iou, t["track_id"], dets[here[b]], a, b))
    used_a, used_b, pairs = set(), set(), []
    for _, _, _, a, b in sorted(queue):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            pairs.append((tracks[a], here[b]))
    return pairs


def _extend(track: dict, box: np.ndarray, frame: int) -> None:
    steps = max(frame - track["last_frame"], 1)
    x1, y1, x2, y2 = box.tolist()
    vx = ((x1 + x2) - (track["x1"] + track["x2"])) / 2 / steps
    vy = ((y1 + y2) - (track["y1"] + track["y2"])) / 2 / steps
    track.update(x1=x1, y1=y1, x2=x2, y2=y2, vx=vx, vy=vy, last_frame=frame, hits=int(track["hits"]) + 1)


def _with_strength(df: DataFrame, cfg: TrackConfig) -> DataFrame:
    low, high = F.lit(cfg.low), F.lit(cfg.high)
    for cid, (class_low, class_high) in cfg.classes.items():
        low = F.when(F.col("class_id") == cid, F.lit(class_low)).otherwise(low)
        high = F.when(F.col("class_id") == cid, F.lit(class_high)).otherwise(high)
    return df.filter(F.col("score") >= low).withColumn("strong", F.col("score") >= high)


def track(
    df: DataFrame,
    cfg: TrackConfig = TrackConfig(),
    *,
    lane: tuple[str, ...] = LANE,
    reverse: bool = False,
    block_frames: int = FRAME_BUCKET,
) -> DataFrame:
    """Track ids for boxes (lane, frame_id, det_id, class_id, corners, score); null when unmatched.

    `reverse` runs the frames backwards. `block_frames` bounds what one task holds at once.
    """
    if block_frames <= cfg.max_gap:
        raise ValueError("block_frames must exceed max_gap")
    keys = [*lane, "class_id"]
    sign = -1 if reverse else 1
    columns = dict.fromkeys([*keys, "camera_id", "frame_id", "det_id", "score", "strong", *CORNERS])
    rows = _with_strength(df, cfg).select(*columns).withColumn("_f", F.lit(sign) * F.col("frame_id"))
    rows = checkpointed(rows)
    spans = rows.groupBy(*keys).agg(F.min("_f").alias("_first"), F.max("_f").alias("_last"), F.count(F.lit(1)).alias("_n"))
    whole = spans.agg(F.max(F.col("_last") - F.col("_first")), F.sum("_n")).first()
    lots = max(1, -(-(whole[1] or 0) // LOT))
    if whole[0] is None or whole[0] < block_frames:
        linked = _one_block(rows, keys, cfg, lots)
    else:
        linked = _in_runs(rows, keys, cfg, block_frames, lots)
    found = linked.select("det_id", "track_id", F.col("pass").alias("association"))
    return df.join(found, ["det_id"], "left")


def _in_runs(rows: DataFrame, keys: list[str], cfg: TrackConfig, block_frames: int, lots: int) -> DataFrame:
    """Lanes too long for one block, cut where no track can survive, and into blocks where they are still too long."""
    frames = rows.select(*keys, "_f").distinct()
    frames = checkpointed(carry(frames, keys, "_f", {"_prev": F.col("_f")}, width=FRAME_BUCKET))
    fresh = F.coalesce((F.col("_f") - F.col("_prev") > cfg.max_gap).cast("long"), F.lit(1).cast("long"))
    frames = checkpointed(running_sum(frames, keys, "_f", {"_run": fresh}, width=FRAME_BUCKET))
    runs = frames.groupBy(*keys, "_run").agg(F.min("_f").alias("_run_first"), F.max("_f").alias("_run_last"))
    starts = frames.select(*keys, "_f", "_run").join(runs, [*keys, "_run"])
    starts = starts.withColumn("_block", F.floor((F.col("_f") - F.col("_run_first")) / block_frames).cast("int"))
    rows = rows.join(starts.select(*keys, "_f", "_run", "_block"), [*keys, "_f"])
    unit = [*keys, "_run"]
    blocks = runs.agg(F.max(F.floor((F.col("_run_last") - F.col("_run_first")) / block_frames))).first()[0]
    if not blocks:
        return _one_block(rows, unit, cfg, lots)
    return _relay(stored_by(rows, "_block"), unit, cfg, int(blocks) + 1, lots)


def associate_lanes(
    lane: np.ndarray, frames: np.ndarray, dets: np.ndarray, corners: np.ndarray, strong: np.ndarray, cfg: TrackConfig,
    min_iou: np.ndarray, max_shift: np.ndarray, state: dict[str, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """`associate` for many lanes at once: the n-th frames of all lanes are settled together.

    `lane` numbers the lane of a box; `min_iou` and `max_shift` go by lane; `state` holds live tracks (STATE and lane).
    Returns box positions, their track ids and passes, and the tracks still alive.
    """
    by_lane = np.lexsort((dets, frames, lane))
    lanes, frame_of = lane[by_lane], frames[by_lane]
    first = np.r_[True, lanes[1:] != lanes[:-1]] if len(lanes) else np.zeros(0, bool)
    turn = np.cumsum(first | np.r_[True, frame_of[1:] != frame_of[:-1]]) if len(lanes) else np.zeros(0, int)
    turn = turn - turn[first][np.cumsum(first) - 1]  # the number of the box's frame within its lane
    order = by_lane[np.argsort(turn, kind="stable")]
    cuts = np.r_[0, np.cumsum(np.bincount(turn))].astype(int) if len(turn) else np.zeros(1, int)
    places = len(min_iou)
    last_turn = np.full(places, -1)
    np.maximum.at(last_turn, lanes, turn)

    old = {n: np.empty(0) for n in STATE} | {"lane": np.empty(0, int)} if state is None else state
    names = np.concatenate([old["track_id"].astype(object), np.array([f"t{d}" for d in dets.tolist()], object)])
    name_rank = np.unique(names.astype(str), return_inverse=True)[1]
    det_rank = np.unique(dets, return_inverse=True)[1]
    n_old = len(old["lane"])
    live = {
        "lane": old["lane"].astype(int), "name": np.arange(n_old), "frame": old["last_frame"].astype(np.int64), "hits": old["hits"].astype(np.int64),
        "box": np.column_stack([old[n].astype(float) for n in CORNERS]).reshape(n_old, 4), "v": np.column_stack([old["vx"], old["vy"]]).astype(float).reshape(n_old, 2),
    }
    ended, found = [], []
    now = np.zeros(places, np.int64)
    start, count = np.zeros(places, int), np.zeros(places, int)
    for step in range(len(cuts) - 1):
        here = order[cuts[step] : cuts[step + 1]]
        over = last_turn[live["lane"]] < step
        if over.any():
            ended.append({n: v[over] for n, v in live.items()})
        now[lane[here]] = frames[here]
        keep = ~over & (now[live["lane"]] - live["frame"] <= cfg.max_gap)
        live = {n: v[keep] for n, v in live.items()}
        free_box = strong[here].copy()
        for name, use in (("strong", here[strong[here]]), ("weak", here[~strong[here]])):
            # the boxes of a lane lie side by side
            count[:] = 0
            edge = np.flatnonzero(np.r_[True, lane[use][1:] != lane[use][:-1]]) if len(use) else np.zeros(0, int)
            start[lane[use][edge]] = edge
            count[lane[use][edge]] = np.diff(np.r_[edge, len(use)])
            waiting = np.flatnonzero((live["frame"] < now[live["lane"]]) & (count[live["lane"]] > 0))
            at = live["lane"][waiting]
            a = np.repeat(waiting, count[at])
            b = use[np.arange(len(a)) - np.repeat(np.cumsum(count[at]) - count[at], count[at]) + np.repeat(start[at], count[at])]
            age = (now[live["lane"][a]] - live["frame"][a]).astype(float)
            want, have = live["box"][a] + live["v"][a][:, [0, 1, 0, 1]] * age[:, None], corners[b]
            span = np.clip(np.minimum(want[:, 2:], have[:, 2:]) - np.maximum(want[:, :2], have[:, :2]), 0, None)
            shared = span[:, 0] * span[:, 1]
            size = np.prod(want[:, 2:] - want[:, :2], axis=-1) + np.prod(have[:, 2:] - have[:, :2], axis=-1)
            iou = shared / np.maximum(size - shared, 1e-12)
            shift = np.linalg.norm((want[:, :2] + want[:, 2:] - have[:, :2] - have[:, 2:]) / 2, axis=-1)
            able = (iou >= min_iou[lane[b]]) & (shift <= max_shift[lane[b]])
            a, b, iou = a[able], b[able], iou[able]
            queue = np.lexsort((b, a, det_rank[b], name_rank[live["name"][a]], -iou))
            a, b = _first_of_both(a[queue], b[queue], len(live["lane"]), len(lane))
            steps = np.maximum(now[live["lane"][a]] - live["frame"][a], 1)
            box, before = corners[b], live["box"][a]
            live["v"][a] = ((box[:, :2] + box[:, 2:]) - (before[:, :2] + before[:, 2:])) / 2 / steps[:, None]
            live["box"][a], live["frame"][a] = box, now[live["lane"][a]]
            live["hits"][a] += 1
            found.append((b, live["name"][a], np.full(len(b), name, object)))
            if name == "strong":
                free_box &= ~np.isin(here, b)
        fresh = here[free_box]
        found.append((fresh, n_old + fresh, np.full(len(fresh), "start", object)))
        born = {"lane": lane[fresh], "name": n_old + fresh, "frame": frames[fresh], "hits": np.ones(len(fresh), np.int64), "box": corners[fresh], "v": np.zeros((len(fresh), 2))}
        live = {n: np.concatenate([v, born[n]]) for n, v in live.items()}
    live = {n: np.concatenate([v, *[e[n] for e in ended]]) for n, v in live.items()}
    alive = {"lane": live["lane"], "track_id": names[live["name"]], "last_frame": live["frame"], "hits": live["hits"], "vx": live["v"][:, 0], "vy": live["v"][:, 1]}
    alive |= {n: live["box"][:, i] for i, n in enumerate(CORNERS)}
    if not found:
        return np.zeros(0, int), np.zeros(0, object), np.zeros(0, object), alive
    box, name, passes = (np.concatenate(x) for x in zip(*found))
    return box, names[name], passes, alive


def _first_of_both(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are taken one by one in their order, each where both ends are free: a pair first for both ends is never passed by."""
    taken_a, taken_b = [a[:0]], [b[:0]]
    first_a, first_b = np.zeros(n_a, int), np.zeros(n_b, int)
    done_a, done_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
    while len(a):
        number = np.arange(len(a))
        first_a[a[::-1]] = number[::-1]
        first_b[b[::-1]] = number[::-1]
        now = (first_a[a] == number) & (first_b[b] == number)
        taken_a.append(a[now])
        taken_b.append(b[now])
        done_a[a[now]], done_b[b[now]] = True, True
        left = ~done_a[a] & ~done_b[b]
        a, b = a[left], b[left]
    return np.concatenate(taken_a), np.concatenate(taken_b)


def _lot_of_lanes(boxes: pd.DataFrame, state: pd.DataFrame | None, unit: list[str], cfg: TrackConfig) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(det_id, track_id, pass) rows of the lanes of `boxes`, and the tracks left alive with their lane's keys."""
    keys = boxes[unit] if state is None else pd.concat([boxes[unit], state[unit]], ignore_index=True)
    code = keys.groupby(unit, sort=False, dropna=False).ngroup().to_numpy()
    lane, behind = code[: len(boxes)], code[len(boxes) :]
    first = np.unique(lane, return_index=True)[1]
    gates = [cfg.cameras.get(c, (cfg.min_iou, cfg.max_shift)) for c in boxes["camera_id"].iloc[first]]
    before = None
    if state is not None:
        known = behind <= lane.max()  # lanes without a box have nothing to hand on
        before = {n: state[n].to_numpy()[known] for n in STATE} | {"lane": behind[known]}
    at, track_id, passes, alive = associate_lanes(
        lane, boxes["_f"].to_numpy(np.int64), boxes["det_id"].to_numpy(), boxes[CORNERS].to_numpy(float), boxes["strong"].to_numpy(bool),
        cfg, np.array([g[0] for g in gates], float), np.array([g[1] for g in gates], float), before,
    )
    found = pd.DataFrame({"det_id": boxes["det_id"].to_numpy()[at], "track_id": track_id, "pass": passes})
    live = boxes[unit].iloc[first[alive["lane"]]].reset_index(drop=True).assign(**{n: alive[n] for n in STATE})
    return found, live


def _lot(unit: list[str], lots: int) -> Column:
    return F.pmod(F.xxhash64(*unit), F.lit(lots))


def _one_block(rows: DataFrame, unit: list[str], cfg: TrackConfig, lots: int) -> DataFrame:
    det_type = dict(rows.dtypes)["det_id"]
    columns = dict.fromkeys([*unit, "camera_id", "_f", "det_id", "strong", *CORNERS])
    lanes = rows.select(*columns).groupBy(_lot(unit, lots))
    return lanes.applyInPandas(lambda boxes: _lot_of_lanes(boxes, None, unit, cfg)[0], f"det_id {det_type}, track_id string, pass string")


def _relay(rows: DataFrame, unit: list[str], cfg: TrackConfig, blocks: int, lots: int) -> DataFrame:
    """Blocks in order, all lanes of a block at once; live tracks are the only thing handed on.

    `rows` is a table partitioned by _block: each step reads its own block only.
    """
    det_type = dict(rows.dtypes)["det_id"]
    keys = ", ".join(f"`{k}` {dict(rows.dtypes)[k]}" for k in unit)
    schema = f"{keys}, det_id {det_type}, pass string, {STATE_TYPE}"
    columns = [*unit, "det_id", "pass", *STATE]

    def run(boxes: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        if boxes.empty:
            return pd.DataFrame(columns=columns)
        found, live = _lot_of_lanes(boxes, state, unit, cfg)
        return pd.concat([found, live], ignore_index=True).reindex(columns=columns)

    empty = rows.limit(0).select(*unit)
    state = empty.select(*unit, *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in STATE_TYPE.split(", ")])
    done = []
    for block in range(blocks):
        here = rows.filter(F.col("_block") == block).groupBy(_lot(unit, lots))
        out = checkpointed(here.cogroup(state.groupBy(_lot(unit, lots))).applyInPandas(run, schema))
        done.append(out.filter(F.col("det_id").isNotNull()).select("det_id", "track_id", "pass"))
        state = out.filter(F.col("det_id").isNull()).select(*unit, *STATE)
    return reduce(DataFrame.unionByName, done)


# --- statistics -----------------------------------------------------------------------

def jitter(tracks: DataFrame, keys: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Centre shift and relative size change against the hit before, per hit."""
    held = F.struct("frame_id", *CORNERS)
    rows = carry(tracks, list(keys), "frame_id", {"_prev": held}, width=FRAME_BUCKET)
    here, before = g.corners(), g.corners("_prev")
    (cx, cy), (px, py) = g.centre(here), g.centre(before)
    return rows.withColumns({
        "frame_step": F.col("frame_id") - F.col("_prev.frame_id"),
        "centre_shift": F.sqrt((cx - px) * (cx - px) + (cy - py) * (cy - py)),
        "size_change": F.abs(F.try_divide(g.area(here), g.area(before)) - 1.0),
    }).drop("_prev")


def track_stats(tracks: DataFrame, keys: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Age, hits, gaps, mean confidence and jitter of every track."""
    rows = jitter(tracks, keys)
    return rows.groupBy(*keys).agg(
        F.min("frame_id").alias("first_frame"),
        F.max("frame_id").alias("last_frame"),
        (F.max("frame_id") - F.min("frame_id") + 1).alias("age"),
        F.count(F.lit(1)).alias("hits"),
        F.count_if(F.col("frame_step") > 1).alias("gaps"),
        F.avg("score").alias("mean_score"),
        F.avg("centre_shift").alias("mean_shift"),
        F.max("size_change").alias("max_size_change"),
    )


def identity_changes(matches: DataFrame, keys: tuple[str, ...] = ("object_id",)) -> DataFrame:
    """Id switches, fragmentation and class changes along each true object.

    `matches`: object_id, frame_id, track_id (null when missed), class_id.
    """
    seen = F.when(F.col("track_id").isNotNull(), F.struct("track_id", "class_id"))
    held = {"_any": F.struct(F.col("track_id").isNotNull().alias("hit")), "_prev": seen}
    rows = carry(matches, list(keys), "frame_id", held, width=FRAME_BUCKET)
    hit = F.col("track_id").isNotNull()
    same = F.col("_prev.track_id") == F.col("track_id")
    return rows.withColumns({
        "id_switch": F.coalesce(hit & ~same, F.lit(False)),
        "fragmented": F.coalesce(hit & ~F.col("_any.hit") & F.col("_prev").isNotNull(), F.lit(False)),
        "class_change": F.coalesce(hit & same & (F.col("_prev.class_id") != F.col("class_id")), F.lit(False)),
    }).drop("_any", "_prev")


def track_errors(tracked: DataFrame, truth: DataFrame, iou: float = 0.5) -> DataFrame:
    """One row of track error counts.

    `tracked`: image_id, det_id, class_id, track_id, association, corners (source `tracker` rows are
    propagated). `truth`: image_id, annotation_id, object_id, frame_id, class_id, corners.
    """
    hits = match_boxes(tracked, truth, iou, "greedy", ("image_id",))
    named = hits.join(tracked.select("image_id", "det_id", "track_id", "association", F.col("class_id").alias("class_id")), ["image_id", "det_id"])
    along = truth.select("image_id", "annotation_id", "object_id", "frame_id")
    along = along.join(named, ["image_id", "annotation_id"], "left")
    changes = identity_changes(along.select("object_id", "frame_id", "track_id", "class_id")).agg(F.struct(
        F.count_if("id_switch").alias("id_switches"),
        F.count_if("fragmented").alias("fragmentations"),
        F.count_if("class_change").alias("class_changes"),
    ))
    judged = tracked.select("image_id", "det_id", "association").join(hits.select("image_id", "det_id", "iou"), ["image_id", "det_id"], "left")
    weak, gap = F.col("association") == "weak", F.col("association") == "gap"
    right = F.col("iou").isNotNull()
    counts = judged.agg(
        F.count_if(weak).alias("recovered"),
        F.try_divide(F.count_if(weak & right).cast("double"), F.count_if(weak)).alias("recovery_precision"),
        F.count_if(gap).alias("propagated"),
        F.count_if(gap & ~right).alias("false_propagation"),
    )
    return counts.withColumn("_c", changes.scalar()).select("*", "_c.*").drop("_c")


# --- refinement -----------------------------------------------------------------------

def recover_weak(tracks: DataFrame, high: float, *, min_hits: int = 3, max_gap_share: float = 0.5, keys: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Flag low-score boxes that lie inside a stable track; raw scores stay."""
    stats = track_stats(tracks, keys).select(*keys, "hits", "age", "first_frame", "last_frame")
    rows = tracks.join(stats, list(keys), "left")
    stable = (F.col("hits") >= min_hits) & (F.col("hits") >= (1.0 - max_gap_share) * F.col("age"))
    inside = (F.col("frame_id") > F.col("first_frame")) & (F.col("frame_id") < F.col("last_frame"))
    flag = F.coalesce((F.col("score") < high) & stable & inside, F.lit(False))
    return rows.withColumn("recovered", flag).drop("hits", "age", "first_frame", "last_frame")


def suppress_isolated(tracks: DataFrame, min_hits: int = 2, window: int = 2, keys: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Flag boxes whose track has fewer than `min_hits` hits within `window` frames around them.

    Neighbours are found through shifted copies and a bounded (2 * window + 1) fan-out.
    """
    offsets = F.array(*[F.lit(d).cast("long") for d in range(-window, window + 1)])
    spread = tracks.select(*keys, F.explode(F.transform(offsets, lambda o: F.col("frame_id") + o)).alias("frame_id"))
    around = spread.groupBy(*keys, "frame_id").agg(F.count(F.lit(1)).alias("_near"))
    rows = tracks.join(around, [*keys, "frame_id"], "left")
    return rows.withColumn("isolated", F.coalesce(F.col("_near"), F.lit(0)) < min_hits).drop("_near")


def smooth(tracks: DataFrame, k: int = 1, max_scale: float = 1.5, keys: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Mean box over the frames within `k` of a hit, left alone where the scale jumps.

    Both boxes are kept: raw corners stay, `s_*` hold the result and `smoothed` says if it differs.
    """
    names = [*keys, "frame_id"]
    offsets = F.array(*[F.lit(d).cast("long") for d in range(-k, k + 1)])
    body = F.struct(*CORNERS, g.area(g.corners()).alias("area"))
    spread = tracks.select(*keys, F.explode(F.transform(offsets, lambda o: F.col("frame_id") + o)).alias("frame_id"), body.alias("b"))
    means = spread.groupBy(*names).agg(
        *[F.avg(f"b.{n}").alias(f"_m_{n}") for n in CORNERS],
        F.max("b.area").alias("_big"), F.min("b.area").alias("_little"), F.count(F.lit(1)).alias("_n"),
    )
    rows = tracks.join(means, names)
    calm = (F.col("_n") > 1) & (F.col("_big") <= max_scale * F.col("_little"))
    return rows.withColumns({
        **{f"s_{n}": F.when(calm, F.col(f"_m_{n}")).otherwise(F.col(n).cast("double")) for n in CORNERS}, "smoothed": calm,
    }).drop(*[f"_m_{n}" for n in CORNERS], "_big", "_little", "_n")


def propose_gaps(tracks: DataFrame, max_gap: int = 3, keys: tuple[str, ...] = ("track_id",), held: tuple[str, ...] = ()) -> DataFrame:
    """Linear boxes for the missing frames between two hits at most `max_gap` frames apart inside.

    `held` columns come from the earlier hit. The class must be the same at both ends.
    """
    body = F.struct("frame_id", "class_id", *CORNERS)
    rows = carry(tracks, list(keys), "frame_id", {}, later={"_next": body}, width=FRAME_BUCKET)
    missing = F.col("_next.frame_id") - F.col("frame_id") - 1
    rows = rows.filter((missing >= 1) & (missing <= max_gap) & (F.col("_next.class_id") == F.col("class_id")))
    rows = rows.withColumn("_at", F.explode(F.sequence(F.col("frame_id") + 1, F.col("_next.frame_id") - 1)))
    share = (F.col("_at") - F.col("frame_id")) / (F.col("_next.frame_id") - F.col("frame_id"))
    box = [(F.col(n) + share * (F.col(f"_next.{n}") - F.col(n))).alias(n) for n in CORNERS]
    return rows.select(*keys, *held, F.col("_at").alias("frame_id"), "class_id", *box, F.lit("tracker").alias("source"))


def refine(tracks: DataFrame, *, high: float = 0.5, min_hits: int = 2, window: int = 2, k: int = 1, max_scale: float = 1.5,
           max_gap: int = 3, keys: tuple[str, ...] = ("track_id",), held: tuple[str, ...] = ()) -> DataFrame:
    """Suppression flag, smoothing and gap boxes in one table; detector boxes keep their ids."""
    flagged = suppress_isolated(tracks, min_hits, window, keys)
    moved = smooth(flagged, k, max_scale, keys)
    gaps = propose_gaps(tracks, max_gap, keys, held).withColumns({
        **{f"s_{n}": F.col(n) for n in CORNERS}, "smoothed": F.lit(False), "isolated": F.lit(False),
        "association": F.lit("gap"), "review_status": F.lit("unreviewed_prediction"),
    })
    return moved.withColumn("source", F.lit("detector")).unionByName(gaps, allowMissingColumns=True)


def consensus(fwd: DataFrame, bwd: DataFrame, iou: float = 0.5) -> DataFrame:
    """Forward against backward boxes per image: trusted when class and place agree.

    Ids are `det_id` on both sides; any disagreement becomes a high-priority review item.
    """
    a, b = fwd.withColumnRenamed("det_id", "fwd_id"), bwd.withColumnRenamed("det_id", "bwd_id")
    hits = match_boxes(a, b, iou, "greedy", ("image_id",), left_id="fwd_id", right_id="bwd_id")
    rows = a.select("image_id", "fwd_id", F.col("class_id").alias("fwd_class")).join(hits, ["image_id", "fwd_id"], "left")
    rows = rows.join(b.select("image_id", "bwd_id", F.col("class_id").alias("bwd_class")), ["image_id", "bwd_id"], "full_outer")
    agree = F.coalesce(F.col("fwd_class") == F.col("bwd_class"), F.lit(False))
    return rows.withColumns({
        "verdict": F.when(agree, "trusted").otherwise("review"),
        "priority": F.when(agree, "normal").otherwise("high"),
    })


def refinement_audit(raw: DataFrame, refined: DataFrame) -> DataFrame:
    """Raw and refined box side by side with the largest edge move."""
    a = raw.select("det_id", F.struct(*CORNERS, "class_id", "score").alias("raw"))
    b = refined.filter(F.col("det_id").isNotNull()).select("det_id", F.struct(*[F.col(f"s_{n}").alias(n) for n in CORNERS], "class_id").alias("refined"))
    rows = a.join(b, "det_id", "left")
    moved = F.greatest(*[F.abs(F.col(f"raw.{n}") - F.col(f"refined.{n}")) for n in CORNERS])
    return rows.withColumns({"edge_move": moved, "class_changed": F.col("raw.class_id") != F.col("refined.class_id")})


def temporal_guards(refined: DataFrame, *, max_gap: int = 3, min_hits: int = 2, support: int = 3, keys: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Violations by rule: class change inside a track, a bridge over a cut, a long gap, few hits,
    an inserted box without a detector box within `support` frames on both sides.

    `refined`: keys, frame_id, class_id, segment_id, source.
    """
    whole = refined.filter(F.col(keys[0]).isNotNull())
    spans = whole.groupBy(*keys).agg(
        F.min("class_id").alias("_c1"), F.max("class_id").alias("_c2"),
        F.min("segment_id").alias("_g1"), F.max("segment_id").alias("_g2"),
        F.count_if(F.col("source") == "detector").alias("_hits"),
    )
    per_track = spans.select(*keys, F.lit(None).cast("bigint").alias("frame_id"), F.explode(F.array_compact(F.array(
        F.when(F.col("_c1") != F.col("_c2"), "class_change"),
        F.when(F.col("_g1") != F.col("_g2"), "bridges_cut"),
        F.when(F.col("_hits") < min_hits, "few_hits"),
    ))).alias("violation"))
    real = F.when(F.col("source") == "detector", F.col("frame_id"))
    rows = carry(whole, list(keys), "frame_id", {"_before": real}, later={"_later": real}, width=FRAME_BUCKET)
    detector = F.col("source") == "detector"
    near: Column = (F.col("frame_id") - F.col("_before") <= support) & (F.col("_later") - F.col("frame_id") <= support)
    per_row = rows.select(*keys, "frame_id", F.explode(F.array_compact(F.array(
        F.when(detector & (F.col("frame_id") - F.col("_before") - 1 > max_gap), "long_gap"),
        F.when(~detector & ~F.coalesce(near, F.lit(False)), "no_detector_support"),
    ))).alias("violation"))
    return per_track.unionByName(per_row)


def compare_propagation(a: DataFrame, b: DataFrame, truth: DataFrame, names: tuple[str, str] = ("tracker", "challenger"), iou: float = 0.5) -> DataFrame:
    """Box and track errors of two propagation methods against the same truth, one row each."""
    parts = []
    for name, df in zip(names, (a, b)):
        hits = match_boxes(df, truth, iou, "greedy", ("image_id",))
        n = df.agg(F.count(F.lit(1)).alias("boxes")).withColumns({
            "truths": truth.agg(F.count(F.lit(1))).scalar(),
            "_h": hits.agg(F.struct(F.count(F.lit(1)).alias("tp"), F.avg("iou").alias("mean_iou"))).scalar(),
            "_e": track_errors(df, truth, iou).select(F.struct("*")).scalar(),
        })
        parts.append(n.select(F.lit(name).alias("method"), "boxes", "truths", "_h.*", "_e.*"))
    return parts[0].unionByName(parts[1])

"""Optimal assignment of components too large for one task: an auction whose bidders are dealt over many.

Every left box bids for the right box that is worth most to it at the present prices: the price rises by what the best
is worth more than the second best, plus epsilon. Blocks of bidders hold their own auctions at once, from the same
prices; of the bids for a right box the highest stands, and boxes that lost theirs bid again in the next round. Prices
of a block are never above those after the round, so a winner still gets its best within epsilon. No box pays more than
an overlap is worth: it stays single instead. At the end the total lies within epsilon per left box of the optimum,
and the prices prove by how much at most.
"""

from __future__ import annotations

from functools import reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from boxloom.operators.scale import join_small, part_running_sum, range_parts
from boxloom.session import checkpointed

#: What a bid adds, bidders of a block, and rounds after which what a bid adds doubles every few rounds.
EPSILON, BLOCK, PATIENCE, DOUBLING = 1e-3, 1_024, 16, 3
#: Bidders that one call of the bidding gets on average.
CHUNK = 20_000
#: Columns of a block of bidders: the bidders, their choices in a row, and what is known of the right boxes.
SIDES = ["_lefts", "_ranks", "_sizes", "_rights", "_worths", "_known", "_prices", "_owners"]


def local_auction(start: np.ndarray, right: np.ndarray, worth: np.ndarray, price: np.ndarray, owner: np.ndarray, epsilon: float) -> np.ndarray:
    """Settle every bidder on a right box or on none worth its price; changes price and owner in place.

    Bidder k's choices are right[start[k] : start[k + 1]]. owner holds a bidder, -1 for nobody or -2 for a bidder of
    another block, whose box costs epsilon more than its price. Bidders come one after the other, and each takes the
    cheapest chain of moves that ends at a box nobody here holds, or with a bidder that stays single; prices along the
    chain rise to what makes it cheapest. At last every box held here is priced at the most its block would pay for
    it, so that blocks contest a box in one bid and not by steps. Returns the right boxes that changed hands or price.
    """
    first, item, value = start.tolist(), right.tolist(), worth.tolist()
    ours = owner.copy()
    held = ours.tolist()
    cost = np.where(ours == -2, price + epsilon, price).tolist()
    at = [-1] * (len(first) - 1)  # the choice that a bidder holds
    for j, k in enumerate(held):
        if k >= 0:
            at[k] = next(e for e in range(first[k], first[k + 1]) if item[e] == j)
    for bidder in [k for k, e in enumerate(at) if e < 0]:
        choices = range(first[bidder], first[bidder + 1])
        top, best = 0.0, -1
        for e in choices:
            if value[e] - cost[item[e]] > top:
                top, best = value[e] - cost[item[e]], e
        if best < 0:
            continue
        if held[item[best]] < 0:
            held[item[best]], at[bidder] = bidder, best
            continue
        # shortest chain over reduced costs; `bound` is the shortest end so far, at first the bidder's staying single
        bound, single, end = top, bidder, -1
        reach, via, closed, heap = {}, {}, [], []
        for e in choices:
            j, d = item[e], top - (value[e] - cost[item[e]])
            if d < bound and d < reach.get(j, bound):
                reach[j], via[j] = d, (e, bidder)
                heappush(heap, (d, j))
        while heap:
            d, j = heappop(heap)
            if d >= bound:
                break
            if d > reach[j]:
                continue
            k = held[j]
            if k < 0:
                bound, end = d, j
                break
            closed.append((j, d))
            gain = value[at[k]] - cost[j]
            if d + max(0.0, gain) < bound:
                bound, single = d + max(0.0, gain), k
            for e in range(first[k], first[k + 1]):
                other = item[e]
                far = d + max(0.0, gain - (value[e] - cost[other]))
                if other != j and far < bound and far < reach.get(other, bound):
                    reach[other], via[other] = far, (e, k)
                    heappush(heap, (far, other))
        for j, d in closed:
            cost[j] += bound - d
        if end < 0:
            if single == bidder:
                continue
            end, at[single] = item[at[single]], -1
        while True:
            e, k = via[end]
            before, held[end], at[k] = at[k], k, e
            if k == bidder:
                break
            end = item[before]
    # how far the price of a box may rise: shortest way from it to an end, all boxes at once
    room, back, heap = {}, {}, []
    for k, e in enumerate(at):
        if e < 0:
            continue
        gain = value[e] - cost[item[e]]
        least = max(0.0, gain)
        for c in range(first[k], first[k + 1]):
            if c != e:
                slack = max(0.0, gain - (value[c] - cost[item[c]]))
                if held[item[c]] < 0:
                    least = min(least, slack)
                else:
                    back.setdefault(item[c], []).append((item[e], slack))
        room[item[e]] = least
        heap.append((least, item[e]))
    heapify(heap)
    while heap:
        d, j = heappop(heap)
        if d > room[j]:
            continue
        for other, slack in back.get(j, ()):
            if d + slack < room[other]:
                room[other] = d + slack
                heappush(heap, (d + slack, other))
    for j, d in room.items():
        cost[j] += d
    held, cost = np.array(held, dtype=int), np.array(cost)
    moved = (held >= 0) & ((held != ours) | (cost > price))
    price[moved], owner[moved] = cost[moved], held[moved]
    return np.flatnonzero(moved)


def auction(
    pairs: DataFrame, unit: list[str], left_id: str, right_id: str, epsilon: float = EPSILON, block: int = BLOCK,
    order: str | None = None, patience: int | None = PATIENCE,
) -> tuple[DataFrame, DataFrame]:
    """(matched, prices) of `pairs` (unit, left, right, iou > 0): a one-to-one choice per unit, and its proof.

    `matched` has the columns of `pairs`; `prices` has unit, right id, price and owner. Ties between equal bids go to
    the larger left id. Bidders are cut into blocks along `order` (a number of the left box, such as its place; else its
    first right id), and every other round into blocks that reach over the edges of these, so that those who compete
    over an edge meet in one task. After the first round only blocks with a bidder that lost its box bid, and units
    without one are put aside. Rounds end when nobody bids. After `patience` rounds what a bid adds grows, so that
    even contests of boxes that never meet in a block end; the total is then proved by `assignment_gap` alone. With None
    it never grows, and the total lies within `epsilon` per bidder of the optimum.
    """
    place = F.min(right_id if order is None else order)
    lefts = pairs.groupBy(*unit, left_id).agg(place.alias("_place"), F.sort_array(F.collect_list(F.struct(F.col(right_id).alias("r"), F.col("iou").alias("w")))).alias("_choices"))
    along = [F.col("_place").asc(), F.col(left_id).asc()]
    lefts = part_running_sum(range_parts(lefts, unit, along), unit, along, {"_rank": F.lit(1).cast("bigint")})
    lefts = lefts.select(*unit, F.col(left_id).alias("_left"), "_rank", "_choices")

    def block_of(rank: str, cut: int) -> Column:
        return F.floor((F.col(rank) + cut * (block // 2)) / block).alias("_block")

    # a block of bidders is one row
    where, entry = [*unit, "_block"], F.sort_array(F.collect_list(F.struct("_rank", "_left", "_choices")))
    blocks = []
    for cut in range(2):
        rows = lefts.groupBy(*unit, block_of("_rank", cut)).agg(entry.alias("_e"))
        choices = F.flatten("_e._choices")
        blocks.append(checkpointed(rows.select(
            *where, F.col("_e._left").alias("_lefts"), F.col("_e._rank").alias("_ranks"), F.transform("_e", lambda x: F.size(x["_choices"])).alias("_sizes"),
            choices["r"].alias("_rights"), choices["w"].alias("_worths"),
        )))
    kinds = pairs.schema
    price_schema = StructType([
        *[kinds[c] for c in unit], kinds[right_id], StructField("price", DoubleType()), StructField("owner", kinds[left_id].dataType), StructField("_rank", LongType()),
    ])

    def bidding(step: float):
        def bid(rows: pd.DataFrame) -> pd.DataFrame:
            out, counts = [], []
            for ids, ranks, sizes, rights, worths, known, prices, owners in zip(*[rows[c] for c in SIDES]):
                names, right = np.unique(rights, return_inverse=True)
                price, owner = np.zeros(len(names)), np.full(len(names), -1)
                if known is not None:
                    at = np.searchsorted(names, known)
                    mine = pd.Index(ids).get_indexer(owners)
                    price[at], owner[at] = prices, np.where(mine < 0, -2, mine)
                start = np.concatenate([[0], np.cumsum(sizes)])
                moved = local_auction(start, right, np.asarray(worths, float), price, owner, step)
                out.append((names[moved], price[moved], np.asarray(ids)[owner[moved]], np.asarray(ranks)[owner[moved]]))
                counts.append(len(moved))
            done = {c: rows[c].to_numpy().repeat(counts) for c in unit}
            return pd.DataFrame(done | dict(zip([right_id, "price", "owner", "_rank"], map(np.concatenate, zip(*out)))))[price_schema.names]

        return bid

    prices = pairs.sparkSession.createDataFrame([], price_schema)
    settled: list[DataFrame] = []
    active, rounds = None, 0
    while True:
        bidders = blocks[rounds % 2] if active is None else join_small(blocks[rounds % 2], active, where, "left_semi")
        if active is None:
            none = [F.lit(None).cast(ArrayType(price_schema[c].dataType)).alias(k) for k, c in zip(SIDES[-3:], [right_id, "price", "owner"])]
            bidders = bidders.select("*", *none)
        else:
            bidders = checkpointed(bidders)
            seen = bidders.select(*where, F.explode(F.array_distinct("_rights")).alias(right_id)).join(prices, [*unit, right_id])
            seen = seen.groupBy(*where).agg(F.collect_list(F.struct(right_id, "price", "owner")).alias("_s"))
            seen = seen.select(*where, *[F.col(f"_s.{c}").alias(k) for k, c in zip(SIDES[-3:], [right_id, "price", "owner"])])
            bidders = bidders.join(seen, where, "left")
        late = 0 if patience is None else max(0, rounds - patience) // DOUBLING
        chunks = max(1, -(-bidders.count() * block // CHUNK)) if active is None else max(1, -(-active.count() * block // CHUNK))
        bids = bidders.groupBy(F.pmod(F.xxhash64(*where), F.lit(chunks))).applyInPandas(bidding(epsilon * 2**late), price_schema)
        # a bid from the owner's own block stands above the price it was made from
        both = prices.withColumn("_new", F.lit(0)).unionByName(bids.withColumn("_new", F.lit(1)))
        first = W.partitionBy(*unit, right_id).orderBy(*[F.col(c).desc() for c in ("price", "_new", "owner")])
        both = checkpointed(both.withColumns({"_turn": F.row_number().over(first), "_winner": F.first("_rank").over(first)}))
        best, lost = both.filter("_turn = 1"), both.filter("_rank <> _winner")
        rounds += 1
        lost = lost.join(best.filter("_new = 1").select(*unit, "_rank"), [*unit, "_rank"], "left_anti")
        active = checkpointed(lost.select(*unit, block_of("_rank", rounds % 2)).distinct())
        prices = best.select(*price_schema.names)
        if active.isEmpty():
            break
        live = active.select(*unit).distinct()
        settled.append(prices.join(live, unit, "left_anti"))
        prices = checkpointed(prices.join(live, unit, "left_semi"))
    prices = reduce(DataFrame.unionByName, [*settled, prices]).drop("_rank")
    matched = pairs.join(prices.select(*unit, right_id, F.col("owner").alias(left_id)), [*unit, right_id, left_id])
    return matched.select(*pairs.columns), prices


def assignment_gap(pairs: DataFrame, matched: DataFrame, prices: DataFrame, unit: list[str], left_id: str, right_id: str) -> DataFrame:
    """unit, total, bound, gap: what was matched, and what no assignment can exceed by the prices (weak duality)."""
    paid = prices.groupBy(*unit).agg(F.sum("price").alias("_paid"))
    left = pairs.join(prices.select(*unit, right_id, "price"), [*unit, right_id], "left")
    profit = left.groupBy(*unit, left_id).agg(F.greatest(F.max(F.col("iou") - F.coalesce("price", F.lit(0.0))), F.lit(0.0)).alias("_profit"))
    bound = profit.groupBy(*unit).agg(F.sum("_profit").alias("_profit")).join(paid, unit, "left")
    bound = bound.select(*unit, (F.col("_profit") + F.coalesce("_paid", F.lit(0.0))).alias("bound"))
    total = matched.groupBy(*unit).agg(F.sum("iou").alias("total"))
    return bound.join(total, unit, "left").select(*unit, F.coalesce("total", F.lit(0.0)).alias("total"), "bound", (F.col("bound") - F.coalesce("total", F.lit(0.0))).alias("gap"))

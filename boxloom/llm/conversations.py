"""Conversation repair by the cheapest edits: a Viterbi search whose chunks run in parallel and are mended until they agree.

Rows are range-partitioned by conversation and turn, so a task holds runs of whole conversations; these are settled
where they are, thousands at a time. A conversation that reaches over a partition's edge, or is longer than a chunk, is
handed on in chunks. A chunk first computes its costs to go from a speculative vector at its end. A fix-up pass gives
every chunk the vector its successor really begins with; the chunk reruns from the end only until the old and the new
vector differ by a constant, since from there on nothing changes. Passes go on until no chunk's vector moves. With the
costs to go known up to a constant, each chunk traces the least audit from every state it may be entered in, and the
exits are chained. Only the text digest and the audit of a conversation, sequential by nature, are streamed by one task.

The grammar of role initials is (s?(ua)+)?; its states are start, after s, after u and after a. Whatever is inserted or
given a new role is decided by the state: an a after u, else a u.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.llm.common import SPACE, checkpointed, known_id, real_id, table
from boxloom.llm.components import groups
from boxloom.llm.registry import query
from boxloom.operators.scale import carry

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows and characters of a chunk, rows that a worker settles at a time.
CHUNK, CHUNK_CHARS, AT_ONCE = 2_048, 4_000_000, 20_000
#: Places a partition's chunks lie apart in the order of chunks.
APART = 2**32

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after an inserted or reroled row.
NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])
#: State after a kept row, by its initial (s, u, a, other) and the state before; 4: not allowed.
KEPT = np.array([[AFTER_S, 4, 4, 4], [AFTER_U, AFTER_U, 4, AFTER_U], [4, 4, AFTER_A, 4], [4, 4, 4, 4]])
FAR = np.int64(2**40)
INITIAL = {"s": 0, "u": 1, "a": 2}
FINE, CUT, GOES = range(3)
#: Costs to go at the end of a conversation, inserts included.
FINAL = np.array([0, 2 * INSERT, INSERT, 0])

FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "conv_id long, " + ", ".join(f"{n} long" for n in FACTS) + ", audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone of the damaged rows; a dropped row stays as a mark of its conversation."""
    pick = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), pick.alias("pick"))
    changed = F.when(F.col("pick") <= 1, "").when(F.col("pick") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": changed, "role": F.when(F.col("pick") == 4, "user").otherwise(F.col("role")), "gone": F.col("pick") == 0})
    times = F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(times)).drop("pick", "_copy")


def fault_of(text: str) -> int | None:
    """None for a blank text, CUT for one that ends without a stop, else FINE."""
    end = text.rstrip(SPACE)[-1:]
    return None if not end else FINE if end in ".!?" else CUT


def coded(roles: list[str], texts: list[str], fresh) -> tuple[np.ndarray, tuple[int, int, int]]:
    """A code per row (initial and fault) and how many are blank, duplicate, truncated; fresh(k) tells first occurrences."""
    codes, counts = np.zeros(len(roles), np.uint8), [0, 0, 0]
    for k, (role, text) in enumerate(zip(roles, texts)):
        fault, new = fault_of(text), fresh(k)
        if fault is None or not new:
            counts[0 if fault is None else 1] += 1
            fault = GOES
        else:
            counts[2] += fault == CUT
        codes[k] = INITIAL.get(role[:1], 3) + 4 * fault
    return codes, tuple(counts)


def firsts(roles: list[str], texts: list[str]):
    """Tells whether row k's role and text occur there for the first time; to be asked in order."""
    seen: set[tuple[str, str]] = set()

    def fresh(k: int) -> bool:
        before = len(seen)
        seen.add((roles[k], texts[k]))
        return len(seen) > before

    return fresh


def illegal_pairs(initials: np.ndarray) -> int:
    """Neighbours that are neither su, ua nor au."""
    a, b = initials[:-1], initials[1:]
    return int(len(a) - ((a == 0) & (b == 1) | (a == 1) & (b == 2) | (a == 2) & (b == 1)).sum())


def step(v: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Costs to go before a row of each chunk from those after it: edits of the row, then inserts before it."""
    initial, fault = code & 3, code >> 2
    stays = (fault != GOES)[:, None]
    extra = (TRUNCATED * (fault == CUT))[:, None]
    padded = np.concatenate([v, np.full((len(v), 1), FAR)], 1)
    kept = np.take_along_axis(padded, KEPT[initial], 1) + extra
    out = np.where(stays, np.minimum(np.minimum(kept, v[:, NEXT] + REROLE + extra), v + DELETE), v + DELETE)
    out = np.minimum(out, out[:, NEXT] + INSERT)
    return np.minimum(out, out[:, NEXT] + INSERT)


class Chunks:
    """Chunks of row codes, longest first, padded to one matrix of rows by chunks."""

    def __init__(self, codes: list[np.ndarray]) -> None:
        size = np.array([len(c) for c in codes], np.int64)
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.rows = int(size.max(initial=0))
        self.codes = np.zeros((self.rows, len(codes)), np.int64)
        for at, k in enumerate(self.order):
            self.codes[: size[k], at] = codes[k]
        #: chunks that have a row k
        self.live = np.searchsorted(-self.size, -np.arange(self.rows), "left")

    def to_go(self, ends: np.ndarray) -> np.ndarray:
        """Costs to go before every row and at the end, given the vectors at the ends (in the order of the chunks given)."""
        v = np.zeros((self.rows + 1, len(self.size), 4), np.int64)
        v[self.size, np.arange(len(self.size))] = ends[self.order]
        for k in range(self.rows - 1, -1, -1):
            m = self.live[k]
            v[k, :m] = step(v[k + 1, :m], self.codes[k, :m])
        return v

    def back(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[self.order] = values
        return out

    def trace(self, v: np.ndarray, entries: np.ndarray, last: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The least cheapest edits of each chunk from its entry state, and the state it leaves in.

        Rows are taken in the order Delete, Insert, Keep, Rerole (their initials' order) as soon as the costs to go
        agree. Inserts at a chunk's end belong to the next chunk, unless it is the last of its conversation.
        """
        n = len(self.size)
        state, last = entries[self.order].copy(), last[self.order]
        row = np.zeros(n, np.int64)
        said: list[tuple[np.ndarray, np.ndarray]] = []
        chunk = np.arange(n)
        while True:
            at, s = row[chunk], state[chunk]
            ended = at == self.size[chunk]
            more = ~ended | last[chunk] & ((s == AFTER_S) | (s == AFTER_U))
            chunk, at, s, ended = chunk[more], at[more], s[more], ended[more]
            if not len(chunk):
                break
            now = v[at, chunk, s]
            if self.rows:
                code = self.codes[np.minimum(at, self.rows - 1), chunk]
                following = v[np.minimum(at + 1, self.rows), chunk]
            else:
                code, following = np.zeros(len(chunk), np.int64), np.zeros((len(chunk), 4), np.int64)
            pick = np.arange(len(chunk))
            fault, kept = code >> 2, KEPT[code & 3, s]
            extra = TRUNCATED * (fault == CUT)
            stays = ~ended & (fault != GOES)
            delete = ~ended & (following[pick, s] + DELETE == now)
            insert = v[at, chunk, NEXT[s]] + INSERT == now
            keep = stays & (kept < 4) & (following[pick, np.minimum(kept, 3)] + extra == now)
            edit = np.select([delete, insert, keep], [0, 1, 2], 3)
            state[chunk] = np.select([edit == 0, edit == 2], [s, kept], NEXT[s])
            row[chunk] += edit != 1
            said.append((chunk, np.frombuffer(b"DIKR", np.uint8)[edit]))
        if said:
            chunks, letters = np.concatenate([c for c, _ in said]), np.concatenate([x for _, x in said])
            order = np.argsort(chunks, kind="stable")
            cuts = np.cumsum(np.bincount(chunks, minlength=n))[:-1]
            audits = [x.tobytes().decode() for x in np.split(letters[order], cuts)]
        else:
            audits = [""] * n
        out = [""] * n
        for a, k in zip(audits, self.order):
            out[k] = a
        return out, self.back(state)


def batched(codes: list[np.ndarray], most: int = 200_000) -> Iterator[list[int]]:
    """Indexes of the chunks, those of like length together, so that a padded matrix holds about `most` rows."""
    order = sorted(range(len(codes)), key=lambda k: len(codes[k]))
    held: list[int] = []
    for k in order:
        if held and (len(held) + 1) * (len(codes[k]) + 1) > most:
            yield held
            held = []
        held.append(k)
    if held:
        yield held


def replay(audit: str, codes: np.ndarray, roles: list[str], texts: list[str], state: int) -> tuple[int, list[str]]:
    """Cost of the edits, and the rows `role:text` that they leave."""
    cost, row, out = 0, 0, []
    for edit in audit:
        if edit == "D":
            cost += DELETE
        else:
            code = int(codes[row]) if edit != "I" else 0
            cost += INSERT if edit == "I" else TRUNCATED * (code >> 2 == CUT) + (REROLE if edit == "R" else 0)
            after = int(KEPT[code & 3, state]) if edit == "K" else int(NEXT[state])
            role = roles[row] if edit == "K" else "assistant" if after == AFTER_A else "user"
            out.append(f"{role}:{'' if edit == 'I' else texts[row]}")
            state = after
        row += edit != "I"
    return cost, out


def whole(held: list[tuple]) -> pa.RecordBatch:
    """Results of conversations (id, turns, roles, texts) that lie whole in a task."""
    parts = [coded(roles, texts, firsts(roles, texts)) for _, _, roles, texts in held]
    codes = [c for c, _ in parts]
    audits = [""] * len(held)
    for some in batched(codes):
        chunks = Chunks([codes[k] for k in some])
        v = chunks.to_go(np.tile(FINAL, (len(some), 1)))
        found, _ = chunks.trace(v, np.zeros(len(some), np.int64), np.ones(len(some), bool))
        for k, a in zip(some, found):
            audits[k] = a
    rows = []
    for (ident, turns, roles, texts), (code, counts), audit in zip(held, parts, audits):
        known = [t for t in turns if t is not None]
        gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
        cost, kept = replay(audit, code, roles, texts, START)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        rows.append((ident, min(gaps, 2**63 - 1), *counts, illegal_pairs(code & 3), cost, audit, digest, None, None, None, None))
    return to_batch(rows)


LOCAL = pa.schema([
    ("conv_id", pa.int64()), *[(n, pa.int64()) for n in FACTS], ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ("at", pa.int64()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(LOCAL)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, LOCAL)], schema=LOCAL)


def settler(most: int):
    """Whole conversations of a sorted partition, settled; the first and last one, and those of `most` rows, in chunks."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() * APART
        ready: list[tuple] = []
        turns, roles, texts, chars = [], [], [], 0
        ident, first, cut, n_chunks, n_ready = None, True, False, 0, 0
        started = False

        def chunk() -> pa.RecordBatch:
            nonlocal turns, roles, texts, chars, n_chunks
            out = to_batch([(ident, *[None] * (len(FACTS) + 2), place + n_chunks, turns, roles, texts)])
            turns, roles, texts, chars, n_chunks = [], [], [], 0, n_chunks + 1
            return out

        for batch in batches:
            for conv, turn, role, text, gone in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")]):
                if not started or conv != ident:
                    if started:
                        if first or cut:
                            yield chunk()
                        else:
                            ready.append((ident, turns, roles, texts))
                            n_ready += len(turns) + 1
                            turns, roles, texts, chars = [], [], [], 0
                            if n_ready >= AT_ONCE:
                                yield whole(ready)
                                ready, n_ready = [], 0
                        first = False
                    ident, cut, started = conv, False, True
                if not gone:
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text)
                    chars += len(text)
                    if len(turns) >= most or chars >= CHUNK_CHARS:
                        cut = True
                        yield chunk()
        if started:
            yield chunk()
        if ready:
            yield whole(ready)

    return settle


def longs(column: pa.Array) -> list[np.ndarray | None]:
    return [None if x is None else np.array(x, np.int64) for x in column.to_pylist()]


def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes, counts and edges of each chunk, and the vector it begins with if it ends with a speculative one."""
    for batch in batches:
        rows = []
        for conv, at, turns, roles, texts, fresh in zip(*[batch.column(c).to_pylist() for c in ("conv", "at", "turns", "roles", "texts", "fresh")]):
            new = set(fresh or ())
            codes, counts = coded(roles, texts, new.__contains__)
            known = [t for t in turns if t is not None]
            ends = (known[0], known[-1], len(set(known))) if known else (None, None, 0)
            initials = codes & 3
            edges = (int(initials[0]), int(initials[-1])) if len(codes) else (None, None)
            mixes = bool((codes >> 2 != GOES).any())  # else it hands every vector on as it is
            begin = Chunks([codes]).to_go(np.zeros((1, 4), np.int64))[0, 0] if mixes else None
            begin = None if begin is None else (begin - begin.min()).tolist()
            rows.append((conv, at, codes.tobytes(), *counts, illegal_pairs(initials), *ends, *edges, [0] * 4 if mixes else None, begin))
        columns = list(zip(*rows)) or [[]] * len(PREPARED)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, PREPARED)], schema=PREPARED)


PREPARED = pa.schema([
    ("conv", pa.int64()), ("at", pa.int64()), ("codes", pa.binary()),
    *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "low_turn", "high_turn", "n_turns", "first_initial", "last_initial")],
    ("used", pa.list_(pa.int64())), ("begin", pa.list_(pa.int64())),
])
PREPARED_DDL = (
    "conv long, at long, codes binary, blank long, duplicate long, truncated long, illegal long, low_turn long, high_turn long, n_turns long, "
    "first_initial long, last_initial long, used array<long>, begin array<long>"
)


def rerun(codes: np.ndarray, old: np.ndarray, new: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The vector a chunk begins with, from the new vector at its end: runs until old and new differ by a constant."""
    both = np.stack([old, new])
    for k in range(len(codes) - 1, -1, -1):
        if np.ptp(both[1] - both[0]) == 0:
            return begin
        both = step(both, np.repeat(codes[k : k + 1], 2))
    return begin if np.ptp(both[1] - both[0]) == 0 else both[1] - both[1].min()


def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Give chunks the vector that their successor begins with."""
    for batch in batches:
        begins, used = [], []
        for codes, old, begin, new in zip(batch.column("codes").to_pylist(), *[longs(batch.column(c)) for c in ("used", "begin", "next")]):
            if begin is not None:
                new = FINAL if new is None else new
                begin = rerun(np.frombuffer(codes, np.uint8).astype(np.int64), old, new, begin)
                old = new
            begins.append(None if begin is None else begin.tolist())
            used.append(None if old is None else old.tolist())
        yield pa.RecordBatch.from_arrays([
            batch.column("conv"), batch.column("at"), batch.column("codes"), pa.array(used, pa.list_(pa.int64())), pa.array(begins, pa.list_(pa.int64())),
        ], ["conv", "at", "codes", "used", "begin"])


def trace_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exits and audits of each chunk for each of the four states it may be entered in."""
    for batch in batches:
        codes = [np.frombuffer(c, np.uint8) for c in batch.column("codes").to_pylist()]
        ends = longs(batch.column("next"))
        last = np.array(batch.column("is_last").to_pylist(), bool)
        exits, audits = [None] * len(codes), [None] * len(codes)
        for some in batched(codes, 20_000):
            chunks = Chunks([codes[k] for k in some])
            v = chunks.to_go(np.stack([FINAL if ends[k] is None else ends[k] for k in some]))
            runs = [chunks.trace(v, np.full(len(some), s), last[some]) for s in range(4)]
            for at, k in enumerate(some):
                audits[k], exits[k] = [r[0][at] for r in runs], [int(r[1][at]) for r in runs]
        yield pa.RecordBatch.from_arrays([
            batch.column("conv"), batch.column("at"), pa.array(exits, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())),
        ], ["conv", "at", "exits", "audits"])


def joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, cost and audit of each conversation from its chunks in order; holds the audit and one chunk."""
    ident, digest, cost, audit, any_row = None, None, 0, [], False

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"conv": ident, "cost": cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}],
            schema=pa.schema([("conv", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))

    for part in groups(batches, ["conv", "at"]):
        for row in part.to_pylist():
            if digest is None or row["conv"] != ident:
                if digest is not None:
                    yield done()
                ident, digest, cost, audit, any_row = row["conv"], hashlib.sha256(), 0, [], False
            codes = np.frombuffer(row["codes"], np.uint8)
            spent, kept = replay(row["audits"][row["entry"]], codes, row["roles"], row["texts"], row["entry"])
            if kept:
                digest.update((("\n" if any_row else "") + "\n".join(kept)).encode())
                any_row = True
            cost += spent
            audit.append(row["audits"][row["entry"]])
    if digest is not None:
        yield done()


def stitched(chunks: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several chunks (conv, at, turns, roles, texts)."""
    key = ["conv", "at"]
    wide = {"keys": ["conv"], "order": "at", "width": APART}
    # rows whose role and text occur for the first time in their conversation, by 128 bits of hash
    each = chunks.select(*key, F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "x"))
    each = each.select(*key, "i", F.xxhash64("x.roles", "x.texts").alias("h"), F.xxhash64(F.lit(7), "x.texts", "x.roles").alias("g"))
    new = each.groupBy("conv", "h", "g").agg(F.min(F.struct("at", "i")).alias("first")).groupBy("conv", F.col("first.at").alias("at")).agg(F.collect_list("first.i").alias("fresh"))
    facts = checkpointed(chunks.join(new, key, "left").select(*key, "turns", "roles", "texts", "fresh").mapInArrow(prepare, PREPARED_DDL))
    vectors = facts.select(*key, "codes", "used", "begin")
    while True:
        following = checkpointed(carry(vectors, values={}, later={"next": F.col("begin")}, **wide))
        end = F.coalesce("next", F.array(*[F.lit(int(x)).cast("long") for x in FINAL]))
        if following.filter(F.col("begin").isNotNull() & (F.col("used") != end)).isEmpty():
            break
        vectors = checkpointed(following.mapInArrow(mend, "conv long, at long, codes binary, used array<long>, begin array<long>"))
    ended = carry(following, values={}, later={"later_at": F.col("at")}, **wide).withColumn("is_last", F.col("later_at").isNull())
    traced = checkpointed(ended.select(*key, "codes", "next", "is_last").mapInArrow(trace_all, "conv long, at long, exits array<long>, audits array<string>"))
    # the state each chunk is entered in: -1 stands for one that is not known yet, a chunk that hands states on says nothing
    same, straight = F.array_distinct("exits"), F.array(*[F.lit(k).cast("long") for k in range(4)])
    known = F.when(F.col("exits") != straight, F.when(F.size(same) == 1, F.element_at(same, 1)).otherwise(F.lit(-1).cast("long")))
    states = traced.select(*key, "exits", known.alias("exit"))
    while True:
        states = checkpointed(carry(states, values={"entry": F.col("exit")}, **wide).withColumn("entry", F.coalesce("entry", F.lit(START).cast("long"))))
        if states.filter("entry = -1").isEmpty():
            break
        states = states.withColumn("exit", F.when((F.col("exit") == -1) & (F.col("entry") >= 0), F.get("exits", F.col("entry").cast("int"))).otherwise(F.col("exit"))).drop("entry")
    text = chunks.select(*key, "roles", "texts").join(traced.select(*key, "audits"), key).join(states.select(*key, "entry"), key).join(facts.select(*key, "codes"), key)
    text = text.repartition("conv").sortWithinPartitions(*key).mapInArrow(joined_up, "conv long, cost long, audit string, repaired_sha256 string")
    # sums over chunks; a turn or a pair of rows may reach over the edge between two
    edges = carry(facts, values={"turn_before": F.col("high_turn"), "initial_before": F.col("last_initial")}, **wide)
    pair = F.concat_ws("", F.col("initial_before").cast("string"), F.col("first_initial").cast("string"))
    over = F.when(F.col("initial_before").isNotNull() & F.col("first_initial").isNotNull() & ~pair.isin("01", "12", "21"), 1).otherwise(0)
    again = F.when(F.col("turn_before") == F.col("low_turn"), 1).otherwise(0)
    # turns lie in order, so that those of two chunks differ but for the edge
    wide_turns = F.max("high_turn").cast("decimal(38,0)") - F.min("low_turn") + 1 - F.sum(F.col("n_turns") - again)
    sums = edges.groupBy("conv").agg(
        F.when(F.max("high_turn").isNull(), 0).otherwise(F.least(wide_turns, F.lit(2**63 - 1).cast("decimal(38,0)"))).cast("long").alias("gaps"),
        *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + over).alias("illegal"),
    )
    return sums.join(text, "conv").select(real_id("conv", "conv_id"), *FACTS, "audit", "repaired_sha256")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conv_id of `rows`
    (conv_id, turn, role, text), after the contract's damage.

    Null conv_ids are one conversation, whose conv_id is null. Null roles and texts are one space, null turns come
    first. Rows of one turn are taken by role and then text (code points), equal ones side by side. A conversation
    without rows after damage has zeros, an empty audit and the digest of nothing. Other columns are not read; an empty
    table gives an empty one. gaps beyond a long are its largest value.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "_own")]
    ordered = damaged(rows).withColumn("_own", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    local = checkpointed(ordered.drop("_own").mapInArrow(settler(chunk), RESULT + ", at long, turns array<long>, roles array<string>, texts array<string>"))
    done = local.filter("at is null").select("conv_id", *FACTS, "audit", "repaired_sha256")
    chunks = local.filter("at is not null").select(known_id("conv_id").alias("conv"), "at", "turns", "roles", "texts")
    return done.unionByName(stitched(chunks))


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(state: str, cost: str, letter: str, row: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {row}}}"


def _inserts(source: str) -> str:
    """SQL over a table with the states z, s, u, a (cost, audit, rows): with up to two inserts before the next row."""
    up = _least("u", *[_edit(x, "3", "I", "'user:' || chr(10)") for x in "zsa"])
    down = _edit("{u}", "3", "I", "'assistant:' || chr(10)")
    once = f"SELECT *, {up} AS u1, {_least('a', down.replace('{u}', 'u'))} AS a1 FROM {source}"
    return f"SELECT * REPLACE ({_least('u1', _edit('a1', '3', 'I', chr(39) + 'user:' + chr(39) + ' || chr(10)'))} AS u, {_least('a1', down.replace('{u}', 'u1'))} AS a) FROM ({once})"


_OWN = "d.role || ':' || d.body || chr(10)"
_KEEP = {(x, i): f"CASE WHEN d.fault < 2 AND d.initial = '{i}' THEN {_edit('t.' + x, '3 * d.fault', 'K', _OWN)} END" for x, i in ("zs", "zu", "su", "au", "ua")}
_NEW = {x: f"CASE WHEN d.fault < 2 THEN {_edit('t.' + x, '3 + 3 * d.fault', 'R', f'{chr(39)}{r}:{chr(39)} || d.body || chr(10)')} END" for x, r in zip("zsau", ("user", "user", "user", "assistant"))}
_GONE = {x: _edit(f"t.{x}", "4", "D") for x in "zsua"}
_AFTER = {
    "z": _GONE["z"], "s": _least(_GONE["s"], _KEEP["z", "s"]), "a": _least(_GONE["a"], _KEEP["u", "a"], _NEW["u"]),
    "u": _least(_GONE["u"], *[_KEEP[x, "u"] for x in "zsa"], *[_NEW[x] for x in "zsa"]),
}
_NOTHING = "{'c': CAST(%s AS BIGINT), 'a': '', 'r': ''}"


@query(
    f"""
WITH RECURSIVE poly AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS p FROM range(256) x(i)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
      lambda c, b: xor(c >> 8, p[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS pick
  FROM conversations, poly
), damaged AS (
  SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN pick = 1 THEN '' WHEN pick = 2 THEN translate(text, '.!?', '') ELSE text END AS body,
    unnest(CASE WHEN pick = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed WHERE pick <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body, copy) AS k, left(role, 1) AS initial,
    regexp_replace(body, '[\x20\x09-\x0D]+$', '') AS bare
  FROM damaged
), d AS (
  SELECT *, CASE WHEN bare = '' THEN 3 WHEN row_number() OVER (PARTITION BY conv_id, role, body ORDER BY k) > 1 THEN 2
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair
  FROM placed
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
), states AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, {_NOTHING % 0} AS z, {_NOTHING % 10**9} AS s, {_NOTHING % 10**9} AS u, {_NOTHING % 10**9} AS a FROM ids
  UNION ALL
  SELECT t.conv_id, d.k, {", ".join(f"{e} AS {x}" for x, e in _AFTER.items() if x in "zs")}, {_AFTER["u"]} AS u, {_AFTER["a"]} AS a
  FROM ({_inserts("states")}) t JOIN d ON d.conv_id IS NOT DISTINCT FROM t.conv_id AND d.k = t.k + 1
), last AS (
  SELECT conv_id, {_least("z", "a")} AS best FROM ({_inserts("(SELECT * FROM states QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1)")})
), facts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM d GROUP BY conv_id
)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(CASE WHEN best.r = '' THEN '' ELSE left(best.r, length(best.r) - 1) END) AS repaired_sha256
FROM last l LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM l.conv_id
"""
)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation."""
    return repair(table(spark, sf_dir, "conversations"))

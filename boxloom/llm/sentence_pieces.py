"""SentencePiece encoding and decoding (BPE models with byte fallback) by suffix-array matching.

Texts are cut where no piece can reach across: before a run of spaces, around line breaks, and between letters, single
digits and other characters (a model with pieces that reach across is refused). The distinct parts of
a batch that the task has not met are concatenated and their suffixes sorted (by the longest piece's length). Every
piece of the vocabulary is found by binary search as a range of suffixes; the ranges are the edges of a lattice, sorted by
position and relaxed from left to right: the last piece of a prefix's encoding is the one edge that is compatible with
the last piece of the prefix before it. Two pieces are compatible if merging their characters gives just these two;
neighbours that are so in every place make up the one encoding that greedy merging gives. Answers are remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.llm.common import lists, slices, table, texts
from boxloom.llm.ragged import PairTable, merge
from boxloom.llm.registry import query

SPACE = "▁"
#: Parts that no piece reaches out of: spaces and then letters, a digit, or other characters.
PART = re.compile(r" *+(?:[^\W\d_²]+|\d|(?:[^\w \n]|[_²])+)| +|\n+")
REMEMBERED, PAIRS_REMEMBERED = 300_000, 1_000_000
#: Characters that are indexed at once.
INDEXED = 300_000
#: Parts of at most so many characters are relaxed by the length of the edges too.
LONG = 256
#: Characters of a piece that are packed into one sort key, and the bits of each.
PACK, BITS = 4, 15
UNKNOWN = -1
#: What decoding shows for the unknown piece.
UNKNOWN_SHOWN = " ⁇ ".encode()


class Pieces:
    """A model's vocabulary as arrays, with encoder and decoder."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.byte_ids) != 256 or not all(PART.fullmatch(names[i].replace(SPACE, " ")) for i in plain):
            raise ValueError("the model needs byte fallback and no piece that reaches out of a part")
        self.shown = [names[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in self.byte_ids.items():
            self.shown[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self.shown[i] = b""
            elif sp.is_unknown(i):
                self.shown[i] = UNKNOWN_SHOWN
        letters = sorted({c for i in plain for c in names[i]})
        self.code = np.zeros(0x110000, np.int64)  # 0: in no piece
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.code[ord(" ")] = self.code[ord(SPACE)]
        if len(letters) >= 1 << BITS:
            raise ValueError("too many characters for the packed keys")
        ids = {names[i]: i for i in plain}
        score = {i: sp.get_score(i) for i in plain}
        self.length = np.ones(n + 1, np.int64)  # UNKNOWN, the last one, is one character long
        self.letters: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        pairs = []
        for i in plain:
            name = names[i]
            self.length[i] = len(name)
            self.letters[i] = np.array([ids[c] for c in name], np.int64)
            pairs += [(ids[name[:k]], ids[name[k:]], score[i], i) for k in range(1, len(name)) if name[:k] in ids and name[k:] in ids]
        left, right, scores, product = (np.array(x) for x in zip(*pairs))
        by_score = np.unique(-np.array(sorted({score[i] for i in set(product.tolist())})))
        self.pairs = PairTable(left, right, np.searchsorted(by_score, -scores), product)
        self.longest = int(self.length.max())
        self.known: dict[str, bytes] = {}
        self.pair_keys, self.pair_good = np.zeros(0, np.int64), np.zeros(0, bool)
        # pieces that greedy merging of their own characters gives; no other can come up
        alone = self.merged([[i] for i in plain])
        self.usable = np.array([i for i, good in zip(plain, alone) if good], np.int64)
        codes = np.zeros((len(self.usable), -(-self.longest // PACK) * PACK), np.int64)
        for row, i in enumerate(self.usable):
            codes[row, : self.length[i]] = self.code[[ord(c) for c in names[i]]]
        within = np.arange(codes.shape[1])[None, :] < self.length[self.usable][:, None]
        self.low = self.packed(codes)
        self.high = self.packed(np.where(within, codes, (1 << BITS) - 1))

    @staticmethod
    def packed(codes: np.ndarray) -> list[np.ndarray]:
        """Rows of characters as columns of keys, PACK characters each; keys compare as the characters do."""
        out = []
        for k in range(0, codes.shape[1], PACK):
            key = np.zeros(len(codes), np.int64)
            for j in range(PACK):
                key = (key << BITS) | codes[:, k + j]
            out.append(key)
        return out

    def merged(self, wanted: list[list[int]]) -> list[bool]:
        """Whether merging the characters of each list of pieces gives the list again."""
        rows = [np.concatenate([self.letters[i] for i in x]) for x in wanted]
        sizes = np.array([len(x) for x in rows], np.int64)
        good = np.zeros(len(rows), bool)

        def watch(which, symbols, starts):
            ends = np.append(starts[1:], len(symbols))
            for row, a, b in zip(which.tolist(), starts.tolist(), ends.tolist()):
                good[row] = symbols[a:b].tolist() == wanted[row]

        if len(rows):
            merge(np.concatenate(rows), np.cumsum(sizes) - sizes, self.pairs, watch, one_at_a_time=True)
        return good.tolist()

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = ((left + 1) << 32) | (right + 1)
        at = np.searchsorted(self.pair_keys, keys)
        seen = np.zeros(len(keys), bool)
        if len(self.pair_keys):
            seen = self.pair_keys[np.minimum(at, len(self.pair_keys) - 1)] == keys
        if not seen.all():
            new = np.unique(keys[~seen])
            a, b = (new >> 32) - 1, (new & 0xFFFFFFFF) - 1
            good = (a == UNKNOWN) | (b == UNKNOWN)
            check = np.flatnonzero(~good)
            good[check] = self.merged([[x, y] for x, y in zip(a[check].tolist(), b[check].tolist())])
            if len(self.pair_keys) > PAIRS_REMEMBERED:
                keep = np.isin(self.pair_keys, keys)
                self.pair_keys, self.pair_good = self.pair_keys[keep], self.pair_good[keep]
            where = np.searchsorted(self.pair_keys, new)
            self.pair_keys, self.pair_good = np.insert(self.pair_keys, where, new), np.insert(self.pair_good, where, good)
            at = np.searchsorted(self.pair_keys, keys)
        return self.pair_good[at]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of all places of all pieces in the concatenated text."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.longest + PACK, np.int64)])
        first = np.zeros(n + self.longest, np.int64)
        for j in range(PACK):
            first = (first << BITS) | padded[j : j + len(first)]
        # sort suffixes by their first PACK characters, then twice as many, until a piece fits in
        rank = np.unique(first, return_inverse=True)[1]
        width = PACK
        while width < self.longest:
            later = np.concatenate([rank[width:], np.zeros(width, np.int64)])
            rank = np.unique((rank << 32) | later, return_inverse=True)[1]
            width *= 2
        suffixes = np.argsort(rank[:n], kind="stable")
        columns = [first[np.minimum(suffixes + k * PACK, len(first) - 1)] for k in range(len(self.low))]

        def bound(wanted: list[np.ndarray], inclusive: bool) -> np.ndarray:
            low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), n, np.int64)
            while (low < high).any():
                mid = np.minimum((low + high) // 2, n - 1)
                less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
                for column, key in zip(columns, wanted):
                    here = column[mid]
                    less |= same & (here < key)
                    same &= here == key
                less |= same & inclusive
                open_ = low < high
                low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
            return low

        a, b = bound(self.low, False), bound(self.high, True)
        counts = b - a
        total = int(counts.sum())
        at = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(a, counts)
        return suffixes[at], np.repeat(self.usable, counts)

    def learn(self, parts: list[str]) -> None:
        """Encode parts that are not remembered yet."""
        text = "\0".join(parts) + "\0"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(sizes + 1) - sizes - 1
        codes = self.code[points]
        inside = np.ones(len(points), bool)
        inside[starts + sizes] = False
        codes[~inside] = 0  # a part ends here, whatever character stands for the end
        begin, piece = self.edges(codes)
        odd = np.flatnonzero(inside & (codes == 0))
        begin, piece = np.concatenate([begin, odd]), np.concatenate([piece, np.full(len(odd), UNKNOWN)])
        offset = np.arange(len(points)) - np.repeat(starts, sizes + 1)
        # relax in the order of the edge's end within its part
        end = begin + self.length[piece]
        # and, of edges that end together, the longest first: it is the likeliest one, and one is enough
        step, length = offset[end], self.length[piece]
        if sizes.max() <= LONG:
            step = step * (self.longest + 1) + self.longest - length
        order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")
        begin, piece, end = begin[order], piece[order], end[order]
        cuts = np.flatnonzero(np.diff(step[order], prepend=-1))
        last = np.full(len(points) + 1, UNKNOWN - 1)
        for a, b in zip(cuts, [*cuts[1:], len(end)]):
            open_ = last[end[a:b]] < UNKNOWN
            s, p, e = begin[a:b][open_], piece[a:b][open_], end[a:b][open_]
            good = offset[s] == 0
            inner = np.flatnonzero(~good)
            if len(inner):
                good[inner] = self.compatible(last[s[inner]], p[inner])
            last[e[good]] = p[good]
        # walk back from the end of every part at once, and note each token where it begins
        at, begins = starts + sizes, starts
        chosen = np.full(len(points), UNKNOWN - 1)
        while len(at):
            token = last[at]
            if (token < UNKNOWN).any():
                raise AssertionError("a prefix without encoding")
            at = at - self.length[token]
            chosen[at] = token
            more = at > begins
            at, begins = at[more], begins[more]
        places = np.flatnonzero(chosen >= UNKNOWN)
        tokens = chosen[places].astype(np.int32)
        bounds = np.searchsorted(places, np.append(starts, len(points)))
        rows = np.repeat(np.arange(len(parts)), np.diff(bounds))
        strange = set(rows[tokens == UNKNOWN].tolist())
        raw = tokens.tobytes()
        for k, part in enumerate(parts):
            a, b = int(bounds[k]), int(bounds[k + 1])
            if k in strange:
                ids: list[int] = []
                for t, x in zip(tokens[a:b].tolist(), places[a:b].tolist()):
                    ids += [t] if t != UNKNOWN else [self.byte_ids[c] for c in chr(points[x]).encode("utf-8", "surrogatepass")]
                self.known[part] = np.array(ids, np.int32).tobytes()
            else:
                self.known[part] = raw[4 * a : 4 * b]

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of each text as the library gives them, without begin and end pieces."""
        split = [PART.findall(" " + x.replace(SPACE, " ")) if x else [] for x in batch]
        distinct = set().union(*split)
        new = [x for x in distinct if x not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(distinct)
        new.sort(key=len)  # long parts among themselves
        size, first = 0, 0
        for k, part in enumerate(new):
            size += len(part) + 1
            if size >= INDEXED or k == len(new) - 1:
                self.learn(new[first : k + 1])
                size, first = 0, k + 1
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, x)), np.int32) for x in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; the space that encoding puts first goes."""
        shown = list(map(self.shown.__getitem__, ids.tolist()))
        raw = b"".join(shown)
        if next(filter(None, shown), b"") != UNKNOWN_SHOWN:
            raw = raw.removeprefix(b" ")
        return raw.decode("utf-8", "replace")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _model(path: str | None) -> Pieces:
    import public_tokenizers

    return pieces(path or public_tokenizers.path("piece_bpe_32k.model"))


def encode(docs: DataFrame, model: str | None = None, verify: bool = False) -> DataFrame:
    """`docs` plus token_ids of every whole text, as the library's encode gives them.

    With `verify` also decoded_sha256 (of the text that decoding the ids gives) and round_trip (whether it is the text).
    Null and empty texts have no ids. Rows are independent and keep all other columns (those named here are replaced); an
    empty table gives an empty one. `model` names a file each executor can read, by default piece_bpe_32k.model of the
    installed package of public tokenizers.
    """
    docs = docs.drop("token_ids", *["decoded_sha256", "round_trip"] * verify)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(model)
        for batch in slices(batches, "text", 2_000_000):
            given = texts(batch.column("text"))
            rows = own.encode(given)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
            columns, names = [lists(offsets, np.concatenate([np.zeros(0, np.int32), *rows]))], ["token_ids"]
            if verify:
                back = [own.decode(x) for x in rows]
                columns.append(pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in back], pa.string()))
                columns.append(pa.array([x == y for x, y in zip(given, back)], pa.bool_()))
                names += ["decoded_sha256", "round_trip"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    made = {"token_ids": F.array().cast("array<int>")} | ({"decoded_sha256": F.lit(""), "round_trip": F.lit(True)} if verify else {})
    return docs.mapInArrow(run, docs.limit(0).withColumns(made).schema)


def decode(encoded: DataFrame, model: str | None = None, name: str = "decoded") -> DataFrame:
    """`encoded` plus the text of token_ids, in column `name`. Null ids give an empty text, as no ids do."""
    encoded = encoded.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(model)
        for batch in batches:
            column = batch.column("token_ids")
            rows = [own.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid and len(x.values) else "" for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.string())], [*batch.schema.names, name])

    return encoded.mapInArrow(run, encoded.limit(0).withColumn(name, F.lit("")).schema)


@query()
def op4_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text again."""
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), verify=True)
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_sha256", "round_trip")

"""Secret scan by assignment-aware lexing.

Three base kinds are fixed patterns. Beside them, lines with an assignment are lexed: source and configuration syntax
(`name = "x"`, `name: x`, `"name": "x"`, `name => 'x'`, `name := x`, `NAME=x`, a key of a table `x["name"] = "y"`) gives pairs
of a target name and an expression of literals and names. Constants are propagated: a name that was given literals
earlier in the text stands for them, also through further names and concatenation. Each literal is scored by how
sensitive its target names are and by how much it looks like a secret rather than a word, a path or a placeholder.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxloom.llm.common import slices, table, texts
from boxloom.llm.registry import query

KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")

#: How sensitive a part of a target name is; the parts of a name add up, to 1 at most.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.8,
    "credentials": 0.8, "private": 0.5, "auth": 0.5, "authorization": 0.6, "bearer": 0.7, "access": 0.4, "api": 0.4, "key": 0.5, "client": 0.1,
    "signing": 0.4, "encryption": 0.4, "session": 0.3, "salt": 0.3, "webhook": 0.4, "dsn": 0.5, "cert": 0.3,
}
#: Parts that make a name harmless.
HARMLESS = {"public", "name", "id", "type", "length", "len", "field", "file", "path", "url", "count", "label", "example", "hint", "regex", "format"}
LEAST_LITERAL, LEAST_SCORE = 8, 0.5
PLACEHOLDER = re.compile(r"(?i)^(?:(?:x+|\*+|\.+|none|null|true|false|undefined|todo|test)$|your|change|example|sample|dummy|<|\$\{|\{\{|%)")
TARGET = re.compile(r"""(?:\[\s*+)?(["']?)(?<![A-Za-z0-9_.\-])([A-Za-z_][A-Za-z0-9_.\-]*+)\1(?:\s*+\])?(?:\s*+:\s*+[A-Za-z_][\w.\[\]]*+(?=\s*+=[^=]))?\s*+(:=|=>|=(?![=~])|:(?![:/]))\s*+""")
OPERAND = re.compile(r"""[bru]?"((?:[^"\\\n]|\\.)*)"|[bru]?'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|([A-Za-z_][\w.]*+)(?![\w(+/=\-])|(?![A-Za-z_][\w.]*+\s*+\()([A-Za-z0-9+/_.=~!@#%^&*-]{8,})""")
JOIN = re.compile(r"\s*+(?:\+|\.\.|\.|&|\|\|)?\s*+(?=[\"'`A-Za-z_bru])")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def sensitivity(name: str) -> float:
    """0 to 1: the parts of a name (cut at case changes, digits and punctuation) that point to a secret."""
    parts = [p.lower() for p in PARTS.findall(name)]
    if HARMLESS & set(parts[-1:]):
        return 0.0
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


def secrecy(value: str, phrase: bool = False) -> float:
    """0 to 1: length, variety and mixture of characters of a literal; one with spaces only counts as a `phrase`."""
    if len(value) < LEAST_LITERAL or PLACEHOLDER.search(value) or (not phrase and any(c in value for c in " \t")):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = any(map(str.isdigit, value)) + any(map(str.islower, value)) + any(map(str.isupper, value)) + any(not c.isalnum() for c in value)
    return min(1.0, entropy / 3.5) * (0.6 + 0.2 * min(kinds - 1, 2))


Literal = tuple[int, int]


def lexed(text: str) -> dict[Literal, tuple[float, str]]:
    """Scored literals (start, end) with the most sensitive target name that reaches them."""
    literals: list[list[Literal]] = []  # of each definition
    uses: list[list[int]] = []  # earlier definitions that it names
    names: list[str] = []
    latest: dict[str, int] = {}
    start = 0
    for line in text.split("\n"):
        if "=" in line or ":" in line:
            at = 0
            while m := TARGET.search(line, at):
                at, own, used = m.end(), [], []
                while operand := OPERAND.match(line, at):
                    group, at = operand.lastindex, operand.end()
                    if group == 4 and operand[4] in latest:
                        used.append(latest[operand[4]])
                    elif group != 4 or (m[3] in ("=", ":") and any(map(str.isdigit, operand[4]))):
                        own.append((start + operand.start(group), start + operand.end(group)))
                    joint = JOIN.match(line, at)
                    if not joint or not joint[0].strip():
                        break
                    at = joint.end()
                if own or used:
                    latest[m[2]] = len(names)
                    names.append(m[2])
                    literals.append(own)
                    uses.append(used)
        start += len(line) + 1
    # uses point backwards, so one pass from the last definition brings every target name to the literals below it
    reach: list[tuple[float, str]] = [(sensitivity(n), n) for n in names]
    found: dict[Literal, tuple[float, str]] = {}
    for d in reversed(range(len(names))):
        target, name = reach[d]
        if target:
            for u in uses[d]:
                reach[u] = max(reach[u], (target, name))
            for a, b in literals[d]:
                # words are a secret only where the name asks for words, or where they begin a key
                phrase = "passphrase" in name.lower() or text.startswith("-----BEGIN ", a)
                if (score := target * secrecy(text[a:b], phrase)) >= LEAST_SCORE:
                    found[a, b] = (score, name)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three fixed patterns."""
    out: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS) or not text.isascii():
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def named_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float, str]]:
    """(start, kind number, end, score, name) of the literals that no one base span holds whole."""
    base = sorted(base)
    starts, ends = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))

    def covered(a: int, b: int) -> bool:
        k = bisect_right(starts, a)
        return k > 0 and b <= ends[k - 1]

    return [(a, 3, b, score, name) for (a, b), (score, name) in lexed(text).items() if not covered(a, b)]


SPAN = "array<struct<kind: string, start: int, end: int, score: double, name: string>>"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """`docs` plus secret_spans: (kind, start, end, score, name), by start and then kind; code points, end exclusive.

    Kinds assign, access and hex are the fixed patterns (score 1, no name). Kind named are literals that assignments
    bring to a sensitive name; those that one base span covers whole are not told again, others stand beside it. Null and empty texts have no spans; rows
    are independent and keep all other columns (secret_spans is replaced); an empty table gives an empty one.
    """
    docs = docs.drop("secret_spans")
    fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("name", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([pa.field(n, t) for n, t in fields]))
        for batch in slices(batches, "text"):
            rows = []
            for text in texts(batch.column("text")):
                base = base_spans(text)
                spans = [(s, k, e, 1.0, None) for s, k, e in base]
                if "=" in text or ":" in text:
                    spans += named_spans(text, base)
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "score": x, "name": name} for s, k, e, x, name in sorted(spans, key=lambda x: x[:3])])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, "secret_spans"])

    schema = docs.limit(0).withColumn("secret_spans", F.array().cast(SPAN)).schema
    return docs.mapInArrow(run, schema)


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans of every document."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("secret_spans")

    def n(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "named")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(digest(base), 256).alias("base_sha256"), digest(spans).alias("spans"))

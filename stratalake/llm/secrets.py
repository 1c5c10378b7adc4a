"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: what every match must contain. Each slice
of an Arrow batch is an index segment: the trigrams of its texts that any query names give posting lists of row numbers,
the queries intersect and unite these, and only the rows left are searched with the rule's expression. A rule without a
mandatory trigram searches every row. Segments hold a bounded number of bytes, so memory does not grow with the input,
and no text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from re import _parser as parser  # the standard library's own reading of an expression


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False


#: The base kinds, in the order in which spans of one start are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |)PRIVATE KEY-----"),
)
KINDS = tuple(r.kind for r in BASE + MORE)
#: Most strings that a part of an expression may stand for before only its trigrams are kept, and bytes of a segment.
MOST_STRINGS, SEGMENT = 64, 1 << 22
SPANS = "array<struct<kind:string,start:int,end:int>>"

# A query is True (no condition), a trigram, or ("and" | "or", queries).


def both(kind: str, parts: list) -> object:
    neutral = kind == "and"
    parts = [p for p in parts if p is not True] if neutral else ([True] if any(p is True for p in parts) else parts)
    parts = list(dict.fromkeys(parts))
    return True if not parts or parts == [True] else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def holds(strings: set[str]) -> object:
    """What a text must have that contains one of the strings."""
    return both("or", [both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def derive(tree) -> tuple[set[str] | None, object]:
    """The strings that the parsed part can match, if they are few, else None; and the query of the part."""
    done, exact = [], {""}

    def flush():
        nonlocal exact
        done.append(holds(exact))
        exact = {""}

    open_end = False  # whether something unknown has been passed
    for op, arg in tree:
        name, strings, query = str(op), None, True
        if name == "LITERAL":
            strings = {chr(arg).lower()}
        elif name == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
            chars = {chr(c).lower() for o, a in arg for c in (range(a[0], a[1] + 1) if str(o) == "RANGE" else [a])}
            strings = chars if len(chars) <= 8 else None
        elif name == "SUBPATTERN":
            strings, query = derive(arg[-1])
        elif name == "BRANCH":
            parts = [derive(x) for x in arg[1]]
            strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
            query = both("or", [q for _, q in parts])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            s, q = derive(inner)
            if s is not None and high == 1:
                strings = s | ({""} if low == 0 else set())
            elif s is not None and low == high and low <= 4:
                strings = reduce(lambda x, _: {a + b for a in x for b in s}, range(low), {""})
            query = q if low else True
        elif name == "AT":
            strings = {""}
        if strings is not None and len(strings) * len(exact) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in strings}
        else:
            flush()
            done.append(holds(strings) if strings is not None else query)
            open_end = True
    if not open_end:
        return exact, holds(exact)
    flush()
    return None, both("and", done)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a regular expression, over texts with A-Z in lower case; True: it must search all."""
    return derive(parser.parse(pattern))[1]


def trigrams_of(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


class Scanner:
    """The rules with their queries and the table of trigrams that any of them names."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)), trigram_query(r.pattern)) for r in rules]
        self.trigrams = sorted(t for t in set().union(*(trigrams_of(q) for _, _, q in self.rules)) if t.isascii())
        self.number = {t: i + 1 for i, t in enumerate(self.trigrams)}
        self.table = np.zeros(1 << 24, np.int16)
        for t, i in self.number.items():
            a, b, c = t.encode()
            self.table[a << 16 | b << 8 | c] = i

    def postings(self, raw: list[bytes]) -> list[np.ndarray]:
        """For each trigram's number, the rows whose text has it, ascending."""
        data = np.frombuffer(b"\0\0".join(raw).lower(), np.uint8)
        ends = np.cumsum([len(r) + 2 for r in raw])
        if len(data) < 3:
            return [np.zeros(0, np.int64)] * (len(self.trigrams) + 1)
        code = data[:-2].astype(np.uint32)
        code = (code << 16) | (data[1:-1].astype(np.uint32) << 8) | data[2:]
        found = self.table[code]
        at = np.flatnonzero(found)
        pairs = np.unique(found[at].astype(np.int64) * len(raw) + np.searchsorted(ends, at, "right"))
        cut = np.searchsorted(pairs, np.arange(len(self.trigrams) + 2) * len(raw))
        return [pairs[a:b] - i * len(raw) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:]))]

    def rows(self, query: object, lists: list[np.ndarray], every: np.ndarray) -> np.ndarray:
        if query is True:
            return every
        if isinstance(query, str):
            return lists[self.number[query]] if query in self.number else every
        parts = (self.rows(q, lists, every) for q in query[1])
        return reduce((lambda a, b: np.intersect1d(a, b, True)) if query[0] == "and" else np.union1d, parts)

    def segment(self, texts: list[str], raw: list[bytes]) -> list[list[tuple]]:
        lists, every, out = self.postings(raw), np.arange(len(texts)), [[] for _ in texts]
        for order, (rule, expression, query) in enumerate(self.rules):
            for i in self.rows(query, lists, every):
                for m in expression.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), order, m.end(), rule.kind))
        return out

    def scan(self, texts: list[str]) -> Iterator[list[tuple]]:
        part, raw, size = [], [], 0
        for text in texts:
            part.append(text)
            raw.append(text.encode("utf-8", "replace"))
            size += len(raw[-1])
            if size >= SEGMENT:
                yield from self.segment(part, raw)
                part, raw, size = [], [], 0
        if part:
            yield from self.segment(part, raw)


def find_secrets(text: Column, rules: tuple[Rule, ...] = BASE + MORE) -> Column:
    """All spans (kind, start, end) of secrets in each text, by start and then by the order of the rules.

    Offsets are code points, the end is exclusive. Matches of a kind are leftmost and do not overlap; a match whose
    group is shorter than the rule asks is dropped after matching. Null and empty texts have no spans. Rows are
    scanned one by one, so repeated rows give repeated results.
    """

    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(rules)
        for batch in batches:
            found = scanner.scan([t or "" for t in batch.tolist()])
            yield pd.Series([[{"kind": k, "start": s, "end": e} for s, _, e, k in sorted(x)] for x in found], dtype=object)

    return run(F.coalesce(text, F.lit("")))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """docs with the spans in column `out`, which replaces a column of that name; rows and other columns stay."""
    return docs.withColumn(out, find_secrets(F.col(text)))


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span replaced by `mark`; spans that overlap are replaced together."""
    step = lambda acc, s: F.when(
        s["start"] >= acc["at"],
        F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"), s["end"].alias("at")),
    ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))))

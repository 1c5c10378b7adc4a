"""URL filters by a bit-parallel wildcard automaton.

Every glob rule is laid out as a run of bits in one multiword mask: a start bit, then a bit per character. One step of
the automaton on byte c is D = ((D << 1) & STEP[c]) | (D & STAY[c]): Shift-And, where STAY holds the bits behind which
a `*` stands. All rules run at once over each canonical URL, and whole Arrow batches of URLs run side by side in numpy.

A rule is `hostglob/pathglob`, matched against the canonical form `.host/path` (host in lower case, no query or
fragment). `*` in the host part stands for any characters but `/`, in the path part for any characters; `?` for one
character, of however many bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: The rules that a verdict must follow, by host and path prefix.
BASE_RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: Globs that decide where no base rule fits; the first to match in this order, else DEFAULT.
GLOBS = (
    ("*.ads-*/*", "block"),
    ("*.ads.*/*", "block"),
    ("*.track*.*/*", "block"),
    ("*.doubleclick.*/*", "block"),
    ("*.casino*/*", "block"),
    ("*/wp-login.php*", "block"),
    ("*/*/wp-login.php*", "block"),
    ("*/wp-admin/*", "block"),
    ("*/*/wp-admin/*", "block"),
    ("*/cart/*", "block"),
    ("*/*/cart/*", "block"),
    ("*/*.exe", "block"),
    ("*/*.zip", "block"),
    ("*/*.mp?", "block"),
)
DEFAULT = "allow"


class Automaton:
    """Shift-And masks of all globs, packed one behind the other into words of 64 bits."""

    def __init__(self, globs: Sequence[str]):
        step, stay, start, final, at = [], [], [], [], 0
        for glob in globs:
            host, slash, path = glob.partition("/")
            start.append(at)
            for i, c in enumerate((host + slash + path).encode()):
                if c == ord("*"):
                    stay.append((at, i < len(host.encode())))
                else:
                    at += 1
                    step.append((at, c))
            final.append(at)
            at += 1
        self.words = at // 64 + 1
        self.step, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for bit, c in step:
            mask = np.uint64(1 << bit % 64)
            if c == ord("?"):  # one character: its first byte leads on, the bytes that continue it stay
                self.step[:0x80, bit // 64] |= mask
                self.step[0xC0:, bit // 64] |= mask
                self.stay[0x80:0xC0, bit // 64] |= mask
            else:
                self.step[c, bit // 64] |= mask
        for bit, in_host in stay:
            self.stay[:, bit // 64] |= np.uint64(1 << bit % 64)
            if in_host:
                self.stay[ord("/"), bit // 64] &= ~np.uint64(1 << bit % 64)
        for bit in start:
            self.start[bit // 64] |= np.uint64(1 << bit % 64)
        self.final = np.array(final, np.int64)

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """A boolean row for each text, a column for each glob: whether it matches the whole text."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(-length, kind="stable")
        data = np.frombuffer(b"".join(raw), np.uint8)
        begin = (np.cumsum(length) - length)[order]
        length = length[order]
        state = np.tile(self.start, (len(raw), 1))
        active = len(raw)
        for j in range(int(length[0]) if len(raw) else 0):
            active = int(np.searchsorted(-length[:active], -j))  # those longer than j
            c = data[begin[:active] + j]
            d = state[:active]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.step[c]) | (d & self.stay[c])
        bits = (state[:, self.final // 64] >> (self.final % 64).astype(np.uint64)) & np.uint64(1)
        out = np.empty(bits.shape, bool)
        out[order] = bits.astype(bool)
        return out


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(url: Column, rules: Sequence[Rule] = BASE_RULES, globs: Sequence[tuple[str, str]] = GLOBS, default: str = DEFAULT) -> Column:
    """A struct (host, path, rule, verdict, glob) for each URL.

    The longest base rule whose host equals the URL's host or is one of its parents, and whose path is a prefix of the
    URL's path, gives rule and verdict. Otherwise rule is null and the first matching glob gives verdict and glob; with
    none, `default`. Null URLs and those without `://` have an empty host and path, no rule, and the verdict block.
    Rows are judged one by one: repeated rows give repeated results, and no column but the URL is read.
    """
    by_length = sorted(rules, key=lambda r: -len(r.host + r.path))
    automaton = Automaton([f"*.{r.host}{r.path}*" for r in by_length] + [g for g, _ in globs])
    names = np.array([r.host + r.path for r in by_length] + [None] * (len(globs) + 1), object)
    shown = np.array([None] * len(by_length) + [g for g, _ in globs] + [None], object)
    verdicts = np.array([r.verdict for r in by_length] + [v for _, v in globs] + [default], object)

    @F.pandas_udf("rule string, verdict string, glob string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for canonical in batches:
            hit = automaton.matches(canonical.tolist())
            first = np.where(hit.any(axis=1), hit.argmax(axis=1), len(verdicts) - 1) if len(hit) else np.zeros(0, int)
            verdict = np.where((canonical == ".").to_numpy(bool), "block", verdicts[first])
            yield pd.DataFrame({"rule": names[first], "verdict": verdict, "glob": shown[first]})

    host, path = host_of(url), path_of(url)
    judged = run(F.concat(F.lit("."), host, path))
    return F.struct(host.alias("host"), path.alias("path"), judged["rule"].alias("rule"), judged["verdict"].alias("verdict"), judged["glob"].alias("glob"))


def filter_urls(pages: DataFrame, url: str = "url", out: str = "judged") -> DataFrame:
    """pages with the struct of judge() in column `out`, which replaces a column of that name; all rows and other columns stay."""
    return pages.withColumn(out, judge(F.col(url)))


def allowed(pages: DataFrame, url: str = "url") -> DataFrame:
    """The rows of pages whose URL is allowed, with their own columns only."""
    return pages.where(judge(F.col(url))["verdict"] == "allow")


def glob_pattern(glob: str) -> str:
    """The regular expression of a glob, for the SQL that checks the automaton."""
    host, slash, path = glob.partition("/")
    part = lambda text, star: "".join({"*": star, "?": "."}.get(c, "\\" + c if c in ".-+" else c) for c in text)
    return "(?s)^" + part(host, "[^/]*") + slash + part(path, ".*") + "$"


def verdict_sql() -> str:
    by_length = sorted(BASE_RULES, key=lambda r: -len(r.host + r.path))
    fits = lambda r: f"(('.' || host) LIKE '%.{r.host}' AND starts_with(path, '{r.path}'))"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r.host}{r.path}'" for r in by_length)
    verdict = " ".join([f"WHEN {fits(r)} THEN '{r.verdict}'" for r in by_length] + ["WHEN host || path = '' THEN 'block'"] + [f"WHEN regexp_matches('.' || host || path, '{glob_pattern(g)}') THEN '{v}'" for g, v in GLOBS])
    return f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE '{DEFAULT}' END AS verdict FROM parts"""

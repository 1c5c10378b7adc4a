"""Benchmark decontamination with built-in functions only.

The benchmark's distinct windows of words are a table. A document's positions are first held against a bitset of fixed size
over the hashes of the windows' first words, so that only the few that pass are emitted, each with its words; these are
verified against the windows themselves, by a broadcast hash set where the table's counted size allows it and by a salted
shuffle where it does not. What a text holds is then gathered by the text's digest and joined to the documents. The
plan and what the driver holds have the same size whatever the benchmark's.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, settled, stored

#: Fixed value: characters that separate words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WINDOW, ANCHOR = 13, 3
#: Windows that are sent to all tasks at most, bits of the bitset, bytes of any table sent to all tasks, shares of a shuffled key.
BLOCK_WINDOWS, BITS, SENT_BYTES, SALTS = 200_000, 1 << 20, 32 << 20, 32


def bench_words(text: Column) -> Column:
    """Runs of ASCII digits, letters (A-Z in lower case) and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS + "+", -1), "")


def anchor(words: str, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(min(n, ANCHOR))])


def bench_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct rows (n, win, anchor, item_id): each item's windows, their lengths and the hashes of their first words.

    Items of fewer than `window` words, but not none, are one window. Items with a null id give windows without an id.
    """
    split = benchmark.select(F.col("item_id").cast("string").alias("item_id"), bench_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    rows = split.select("item_id", "w", F.explode(starts).alias("at")).select(
        "item_id", F.least(F.size("w"), F.lit(window)).alias("n"), F.array_join(F.slice("w", F.col("at") + 1, F.lit(window)), " ").alias("win"),
        *[anchor("w", F.col("at"), k).alias(f"a{k}") for k in range(1, ANCHOR + 1)],
    )
    key = F.coalesce(*[F.when(F.col("n") >= k, F.col(f"a{k}")) for k in range(ANCHOR, 0, -1)])
    return rows.select("n", "win", key.alias("anchor"), "item_id").distinct()


def bitset(windows: DataFrame) -> Column:
    """A constant array of BITS / 64 integers with the bits of the windows' anchors set. Tasks unite bits into integers, so
    the driver gets BITS / 64 rows at most."""
    bit = F.pmod("anchor", F.lit(BITS))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    found = windows.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(F.bit_or(mask).alias("mask")).collect()
    whole = [0] * (BITS // 64)
    for r in found:
        whole[r.at] = r["mask"]
    return F.from_json(F.lit(json.dumps({"v": whole})), "v array<bigint>")["v"]


def candidates(words: str, bits: Column, lengths: list[int]) -> Column:
    """Structs (at, n, win) of the places in the array column `words` whose first words pass the bitset, for each length."""
    found = []
    for size in sorted({min(n, ANCHOR) for n in lengths}):
        bit = lambda at: F.pmod(anchor(words, at, size), F.lit(BITS))  # noqa: B023, E731
        set_at = lambda b: F.call_function("getbit", F.get(bits, F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1
        passed = F.filter(F.sequence(F.lit(0), F.size(words) - size), lambda at: set_at(bit(at)))  # noqa: B023
        passed = F.when(F.size(words) >= size, passed).otherwise(F.array().cast("array<int>"))
        for n in (n for n in lengths if min(n, ANCHOR) == size):
            fits = F.filter(passed, lambda at: at + n <= F.size(words))  # noqa: B023
            found.append(F.transform(fits, lambda at: F.struct(at.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice(words, at + 1, F.lit(n)), " ").alias("win"))))  # noqa: B023
    return F.concat(*found)


def verified(rows: DataFrame, windows: DataFrame, sent: bool, how: str) -> DataFrame:
    """rows joined to windows on win. Shuffled, a window that very many rows hold is dealt to SALTS tasks."""
    if sent:
        return rows.join(F.broadcast(windows), "win", how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    each = windows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(each, ["win", "_salt"], how).drop("_salt")


def text_hits(texts: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame | None:
    """For texts (key, text), a row (key, items, spans) for each key with a hit: items are the ids, as sorted strings, of items with
    windows in the text, spans the hit runs of words (first, end exclusive). None if the benchmark has no window.

    Windows are sent to all tasks if they are at most block_windows and SENT_BYTES, which is counted.
    """
    windows = stored(bench_windows(benchmark, window), "windows")
    distinct = windows.select("n", "win", "anchor").distinct()
    lengths = sorted(r.n for r in distinct.select("n").distinct().collect())
    if not lengths:
        return None
    counted = windows.agg(F.count("*").alias("n"), F.sum(F.octet_length("win") + F.coalesce(F.octet_length("item_id"), F.lit(0))).alias("bytes")).first()
    sent = counted.n <= block_windows and counted.bytes <= SENT_BYTES
    split = texts.select("key", bench_words(F.col("text")).alias("w"))
    passed = split.select("key", F.inline(candidates("w", bitset(distinct), lengths)))
    hits = stored(verified(passed, distinct.select("win"), sent, "left_semi").distinct(), "hits")
    begin = F.from_json(F.lit("[]"), "array<struct<first:int,end:int>>")
    alone = lambda h: F.array(F.struct(h["at"].alias("first"), (h["at"] + h["n"]).alias("end")))
    last = lambda acc: F.element_at(acc, -1)
    longer = lambda acc, h: F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["end"], h["at"] + h["n"]).alias("end"))))
    joined = lambda acc, h: F.when(F.size(acc) == 0, alone(h)).when(h["at"] <= last(acc)["end"], longer(acc, h)).otherwise(F.concat(acc, alone(h)))
    places = hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("places"))
    spans = places.select("key", F.aggregate("places", begin, joined).alias("spans"))
    of_item = verified(hits.select("key", "win").distinct(), windows.where("item_id IS NOT NULL").select("win", "item_id").distinct(), sent, "inner")
    items = of_item.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return spans.join(items, "key", "left")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, out: str = "bench") -> DataFrame:
    """docs with a struct column `out` (replacing one of that name): n_words, n_hit, items, spans.

    A word is hit if it lies in any occurrence of a window; items and spans are those of text_hits(). Null and empty texts
    have no words. An empty benchmark hits nothing. Rows with one text are found by its digest and have equal results;
    all rows and other columns stay. The texts with hits are sent to all tasks if they come to SENT_BYTES or less, else
    documents are shuffled to them.
    """
    none = {"items": F.array().cast("array<string>"), "spans": F.from_json(F.lit("[]"), "array<struct<first:int,end:int>>")}
    found = text_hits(docs.select(F.md5(text).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL"), benchmark, window, block_windows)
    if found is None:
        result = docs.withColumns({f"_stratalake_{c}": v for c, v in none.items()})
    else:
        found = stored(found.select(F.col("key").alias("_stratalake_hit"), *[F.coalesce(c, v).alias(f"_stratalake_{c}") for c, v in none.items()]), "found")
        size = 64 + 8 * F.size("_stratalake_spans") + F.octet_length(F.array_join("_stratalake_items", ",   "))
        small = found.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= SENT_BYTES
        keyed = docs.withColumn("_stratalake_text", F.md5(text))
        result = keyed.join(F.broadcast(found) if small else found, F.col("_stratalake_text") == F.col("_stratalake_hit"), "left")
        result = result.withColumns({f"_stratalake_{c}": F.coalesce(f"_stratalake_{c}", v) for c, v in none.items()})
    n_hit = F.aggregate("_stratalake_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["first"])
    bench = F.struct(F.size(bench_words(F.col(text))).cast("long").alias("n_words"), n_hit.alias("n_hit"), F.col("_stratalake_items").alias("items"), F.col("_stratalake_spans").alias("spans"))
    return result.withColumn(out, settled(bench)).drop("_stratalake_text", "_stratalake_hit", *[f"_stratalake_{c}" for c in none])


def contaminated(bench: str = "bench") -> Column:
    """Whether a document of decontaminate() is to go: some words are hit, and these are a twentieth of its words or more."""
    return (F.col(f"{bench}.n_hit") > 0) & (20 * F.col(f"{bench}.n_hit") >= F.col(f"{bench}.n_words"))


def remove_spans(text: Column, spans: Column) -> Column:
    """The text without its hit words and the separators after each; what precedes the first word stays."""
    apart = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # with capitals as letters
    lead = F.regexp_extract(text, f"^([{apart}]*)", 1)
    pieces = F.regexp_extract_all(text, F.lit(f"([^{apart}]+[{apart}]*)"), 1)
    kept = F.filter(pieces, lambda p, i: ~F.exists(spans, lambda s: (s["first"] <= i) & (i < s["end"])))
    return F.when(F.size(spans) > 0, F.concat(lead, F.array_join(kept, ""))).otherwise(text)


DECONTAMINATION_SQL = r"""WITH split(id, is_item, w) AS (
  SELECT CAST(doc_id AS VARCHAR), false, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') FROM documents
  UNION ALL SELECT CAST(item_id AS VARCHAR), true, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') FROM benchmark),
wins AS (SELECT DISTINCT id AS item, least(len(w), 13) AS n, array_to_string(list_slice(w, k, k + 12), ' ') AS win
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM split WHERE is_item AND len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM wins),
places AS (SELECT id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM split, lengths WHERE NOT is_item AND len(w) >= n),
hits AS (SELECT id, p.n, k, item FROM places p JOIN wins ON wins.n = p.n AND win = array_to_string(list_slice(w, k, k + p.n - 1), ' ')),
found AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(k, k + n)) AS place FROM hits) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM documents JOIN split ON NOT is_item AND id = CAST(doc_id AS VARCHAR) LEFT JOIN found USING (id) LEFT JOIN items USING (id)"""

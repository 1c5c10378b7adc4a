import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stratalake.llm import queries, secrets as s

from .conftest import same_rows

BITS = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "AKIA", "ghp_", "xoxb-", '"', "'", " ", "  ", ":", "=", ": ", "abcdef0123456789", "0f" * 9, "Zz9+/_.=-" * 2, "\n", "é𝒳", "ſecret", "toKen=", "-----BEGIN RSA PRIVATE KEY-----"]


def base(text):
    found = []
    for k, (pattern, flags, group, least) in enumerate([(s.BASE[0].pattern, re.I | re.A, 2, 12), ("AKIA[A-Z0-9]+", 0, 0, 18), ("[0-9a-f]+", 0, 0, 16)]):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(found)


def random_texts(n=3000):
    r = random.Random(2)
    return ["".join(r.choice(BITS) if r.random() < 0.7 else r.choice("abcf019 XY:=") * r.randrange(1, 9) for _ in range(r.randrange(12))) for _ in range(n)]


def test_queries_never_miss():
    """Every text that a rule matches passes the rule's trigram query."""
    scanner = s.Scanner(s.BASE + s.MORE)
    for t in random_texts():
        lists = scanner.postings([t.encode()])
        for rule, expression, query in scanner.rows and scanner.rules:
            if expression.search(t):
                import numpy as np

                assert 0 in scanner.rows(query, lists, np.arange(1)), (rule.kind, t)


def test_derived_queries():
    assert s.trigram_query("[0-9a-f]+") is True
    assert s.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert s.trigrams_of(s.trigram_query("a(bcd|efg)h")) == {"abc", "bcd", "cdh", "aef", "efg", "fgh"}
    assert s.trigram_query("(abc)?x") is True and s.trigram_query("(abc|x+)") is True
    assert s.trigrams_of(s.trigram_query("abc.*def")) == {"abc", "def"}


def test_spans_equal_plain_search():
    texts = random_texts() + ["", "x" * 200_000 + " token=abcdefghijklmn"]
    got = list(s.Scanner(s.BASE).scan(texts))
    for t, spans in zip(texts, got):
        assert sorted((a, k, e) for a, k, e, _ in spans) == base(t)


def test_odd_rows_and_query(spark, odd, empty, data):
    got = s.scan_secrets(odd.withColumn("secrets", F.lit(1)))
    assert same_rows(odd, got) and s.scan_secrets(empty).count() == 0
    for r in queries.op5_secret_scan(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        want = ",".join(f"{s.KINDS[k]}:{a}:{e}" for a, k, e in base(r.text))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_redact(spark):
    df = spark.createDataFrame([("a token=abcdefghijkl0123456789abcdef b 𝒳 0123456789abcdef",), ("none",)], "text string")
    got = s.scan_secrets(df).select(s.redact(F.col("text"), F.col("secrets")).alias("t")).collect()
    assert [r.t for r in got] == ["a [secret] b 𝒳 [secret]", "none"]


@pytest.mark.parametrize("text", [None, ""])
def test_nothing(spark, text):
    assert s.scan_secrets(spark.createDataFrame([(text,)], "text string")).first().secrets == []

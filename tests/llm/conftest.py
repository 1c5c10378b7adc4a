import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, extra string"


def prose(seed, n=80, words=("alder", "birch", "cedar", "dogwood", "elm", "fir", "gorse", "hazel", "ivy", "juniper", "kelp", "larch", "maple", "nettle", "oak")):
    r = random.Random(seed)
    return " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows and ids, and more columns."""
    rows = [(1, prose(1), "en", "a"), (1, prose(1), "en", "a"), (2, prose(2), None, "b"), (None, prose(3), "en", None), (3, None, "de", "a"), (4, "", "en", "b"), (5, " \t\n", "en", "b"), (6, prose(6, 30_000), "en", "a"), (2, prose(7), "en", "b"), (8, prose(1), "en", "b"), (9, "Ünï 漢字 𝒳 <|endoftext|> 0 don't", "xx", "c"), (None, None, None, None)]
    return spark.createDataFrame([(i, t, lang, s, None, None, "x") for i, t, lang, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1), (3, None, 1), (None, 1, 1), (4, 1, None), (6, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


def same_rows(before, after):
    """after has all rows of before, with the columns of before unchanged."""
    columns = [c for c in before.columns if c in after.columns]
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    return key(before) == key(after)


def load(spark, data, name):
    return spark.read.parquet(f"{data}/{name}.parquet").select(F.col("*"))

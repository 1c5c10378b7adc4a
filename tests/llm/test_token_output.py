import io
import json
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalake.llm import queries, token_output as t
from stratalake.llm.common import new_dir

from .conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \t\n", "Plain words, and MORE words!", "don't 'tis it's'll x'ta,", "0 00 a0b 1.5%", "<|endoftext|> x <|startoftext|>", "É é Ü ß ñ", "W̊ é 𝒳 漢字", "a b\x85c\x1cd", "!!! ... %%% a%%% A.b,c", prose(1), prose(2, 20_000), "ﬁ K ſ", "'s 't x's.", "a|b a| |b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("split", [True, False])
def test_encoder_equals_the_library(library, split):
    encoder = t.Encoder(PATH, split)
    for _ in range(2):
        got = encoder.encode([x or "" for x in TEXTS])
        for text, raw in zip(TEXTS, got):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_memo_is_bounded(monkeypatch, library):
    monkeypatch.setattr(t, "MEMO_WORDS", 50)
    encoder = t.Encoder(PATH, True)
    for k in range(20):
        text = prose(k)
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.memo) < 400


def test_words_of_plain_letters_go_to_the_model(monkeypatch, library):
    texts = ["zebra quaint zebrafish quaint, zebra!", "zebra \u00c9t\u00e9 r2d2 It's quaint."] * 3
    want, asked = [library.encode(x, add_special_tokens=False).ids for x in texts], []
    encoder, plain = t.Encoder(PATH, True), t.Encoder(PATH, True)
    plain.direct = False
    monkeypatch.setattr(encoder, "ids", lambda text: asked.append(text) or t.Encoder.ids(encoder, text))
    for e in (encoder, plain):
        assert [np.frombuffer(r, "<u4").tolist() for _ in range(3) for r in e.encode(texts)] == want * 3
    assert encoder.direct and not any("zebra" in x or "quaint" in x for x in asked)


def test_letters_beyond_ascii_go_to_the_model(monkeypatch, library):
    texts = ["\u00c9t\u00e9 na\u00efve \u00fcber\u00df, \u00d1u\u00aa."]
    want, asked = [library.encode(x, add_special_tokens=False).ids for x in texts], []
    encoder = t.Encoder(PATH, True)
    monkeypatch.setattr(encoder, "ids", lambda text: asked.append(text) or t.Encoder.ids(encoder, text))
    assert [np.frombuffer(r, "<u4").tolist() for _ in range(3) for r in encoder.encode(texts)] == want * 3
    assert not any(c.isalpha() for x in asked for c in x)


def test_words_are_cut_at_marks_once(library):
    encoder = t.Encoder(PATH, True)
    texts = ["zebra zebra. zebra, .zebra zebra!.zebra (zebra) zebra's.zebra zebra'.z", "Zebra|zebra;zebra&"]
    for _ in range(3):
        assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert sorted(w for w in encoder.memo if b"zebra" in w) == [b"(zebra)", b"zebra", b"zebra'.", b"zebra's"]


def test_random_signs_equal_the_library(library):
    r, encoder = random.Random(7), t.Encoder(PATH, True)
    signs = [*map(chr, range(256)), *"abAB'.,!?;:%&$*#|  \n\t0129/-<>" * 8, "'s", "'ll", "\u00e9", "\u00df"]
    for _ in range(4):
        texts = ["".join(r.choice(signs) for _ in range(r.randrange(50))) for _ in range(500)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def changed(library, tmp_path, change):
    spec = json.loads(library.to_str())
    change(spec)
    (tmp_path / "changed.json").write_text(json.dumps(spec))
    return str(tmp_path / "changed.json")


def test_marks_that_a_tokenizer_keeps_beside_letters(library, tmp_path):
    parts = [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
    path = changed(library, tmp_path, lambda s: s.update(pre_tokenizer={"type": "Sequence", "pretokenizers": parts}))
    encoder, own, texts = t.Encoder(path, True), Tokenizer.from_file(path), ["zebra, the. a,b", "Plain words! x"]
    for _ in range(3):
        assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(texts)] == [own.encode(x, add_special_tokens=False).ids for x in texts]


def test_added_words_are_found(library, tmp_path):
    token = {"id": 49408, "content": "a.b", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}
    path = changed(library, tmp_path, lambda s: s["added_tokens"].append(token))
    assert 49408 in np.frombuffer(t.Encoder(path, True).encode(["see a.b, and a. b"])[0], "<u4")


def test_many_rows_are_encoded_at_a_time(library, monkeypatch):
    encoder, calls = t.Encoder(PATH, True), []
    monkeypatch.setattr(encoder, "encode", lambda texts: calls.append(len(texts)) or t.Encoder.encode(encoder, texts))
    texts = [None if i % 100 == 0 else f"zebra {i}" for i in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(texts)], ["doc_id", "text"])
    got = [(d, raw) for piece, found in encoder.encode_rows(batch) for d, raw in zip(piece.column("doc_id").to_pylist(), found)]
    assert [d for d, _ in got] == list(range(1500)) and sum(calls) == 1500 and len(calls) == 2
    assert [np.frombuffer(r, "<u4").tolist() for _, r in got] == [library.encode(x or "", add_special_tokens=False).ids for x in texts]
    long = pa.RecordBatch.from_arrays([pa.array(["word " * (t.ENCODED_BYTES // 8)] * 4)], ["text"])
    assert [piece.num_rows for piece, _ in encoder.encode_rows(long)] == [1, 1, 1, 1]


def test_frames_are_checked():
    data = t.frame(b"abc") + t.frame(b"")
    assert list(t.frames(io.BytesIO(data))) == [b"abc", b""]
    for broken in (data[:-1], data[:5] + b"\1" + data[6:], data[:13] + b"x" + data[14:], data[:7]):
        with pytest.raises(ValueError):
            list(t.frames(io.BytesIO(broken)))


def expected(rows, library):
    at, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [t.END]
        out.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("range_rows,file_bytes", [(4000, 32 << 20), (3, 200)])
def test_round_trip(spark, library, monkeypatch, range_rows, file_bytes):
    monkeypatch.setattr(t, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(t, "FILE_BYTES", file_bytes)
    rows = [(100 - i, x, "extra") for i, x in enumerate(TEXTS)] + [(None, "null id", "e"), (95, "again", "e"), (95, "again", "e"), (-7, "negative", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(4)
    path = new_dir(spark, "test")
    manifest = t.write_records(docs, path, PATH)
    got = sorted((tuple(r) for r in t.read_records(spark, path).collect()), key=lambda r: r[1])
    assert got == expected([r[:2] for r in rows], library)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    one = manifest.orderBy("part", "file").first()
    picked = list(t.fetch(path, one.path, range(one.records - 1, -1, -1)))
    assert [d for d, _ in picked][::-1] == [r[0] for r in got][: one.records]


def test_empty_table(spark, empty):
    path = new_dir(spark, "test")
    assert t.write_records(empty, path, PATH).count() == 0 and t.read_records(spark, path).count() == 0


def test_query(spark, data, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op9_token_output(spark, data).collect()), key=lambda r: r[1])
    assert got == expected(docs, library)


def parts(manifest):
    return manifest.select("part").distinct().count()


def test_one_id_fills_several_ranges(spark, library, monkeypatch):
    monkeypatch.setattr(t, "RANGE_ROWS", 100)
    docs = spark.range(2000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("boilerplate " * 9), F.col("id").cast("string")).alias("text"))
    path = new_dir(spark, "test")
    manifest = t.write_records(docs, path, PATH)
    assert parts(manifest) > 10 and manifest.agg({"records": "max"}).first()[0] < 400 and t.read_records(spark, path).count() == 2000
    equal, path = docs.withColumn("text", F.lit("same")), new_dir(spark, "test")
    manifest = t.write_records(equal, path, PATH, part_equal=True)
    assert parts(manifest) > 10 and manifest.agg({"records": "sum"}).first()[0] == 2000


def test_ranges_are_bounded():
    assert t.ranges_of(0, 0, 8) == 1 and t.ranges_of(10**10, 10**14, 8000) == 10**14 // t.RANGE_BYTES + 1
    assert t.ranges_of(1000, 1 << 20, 8) == 1 and t.ranges_of(300_000, 1 << 29, 8) == 8 * t.RANGES_EACH


def test_files_stay_where_they_are_asked_to(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert queries.encoded(docs, f"file://{tmp_path}/kept").count() == 1 and list((tmp_path / "kept").glob("*.rec"))

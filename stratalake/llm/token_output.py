"""Token ids as length-delimited binary records.

A data file is a run of frames: payload length (8 bytes), masked CRC-32 of these 8 bytes (4), payload, masked CRC-32 of
the payload (4), all little-endian. The payload of a document is a byte with the width of an id (2 or 4), a byte that
says whether the document id is null, the document id (8 bytes, signed), and the token ids as unsigned integers of that
width. Beside each data file stands an index file with the 8-byte offset of each frame, so that a reader can fetch
records in any order. The tasks that hold the sorted rows write the files, under names of their own for each attempt;
the manifest names the files of the attempts that succeeded, so a lost executor only makes its tasks run again.
"""

from __future__ import annotations

import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Collection, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .batches import Memo, slices

#: The id that ends each document.
END = 1
#: Bytes after which a task begins another file; words that a worker remembers at most, and the bytes that they may hold.
FILE_BYTES, MEMO_WORDS, MEMO_BYTES = 32 << 20, 340_000, 48 << 20
#: Rows and bytes of text that are encoded at a time: more than elsewhere, as a word is looked up once in them.
ENCODED_ROWS, ENCODED_BYTES = 1024, 4 << 20
#: Bytes of text and rows of a range of ids at most, ranges for each core where the whole is small, and the characters by
#: which rows of one id are put in order first.
RANGE_BYTES, RANGE_ROWS, RANGES_EACH, LEADING = 128 << 20, 200_000, 6, 64
MANIFEST = "part int, file int, path string, records long, ids long"


def masked(data: bytes) -> int:
    """CRC-32, turned right by 15 bits plus a constant: a checksum of data that may hold checksums."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def frames(stream) -> Iterator[bytes]:
    """The payloads of a stream of frames, each held against its checksums; an incomplete or damaged frame raises."""
    while head := stream.read(12):
        if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
            raise ValueError("damaged frame: length")
        body = stream.read(struct.unpack("<Q", head[:8])[0] + 4)
        if len(body) != struct.unpack("<Q", head[:8])[0] + 4 or struct.unpack("<I", body[-4:])[0] != masked(body[:-4]):
            raise ValueError("damaged frame: payload")
        yield body[:-4]


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers.

    With `split_on_space`, for a tokenizer that always breaks at white space and folds case, the ids of a text are those
    of its words in turn, so a worker asks the library for the words that it does not remember (batches.Memo). Words are also
    cut between a letter and a mark where the tokenizer does so. That holds for texts within Latin-1, where neither
    normalisation nor lower-casing looks beyond a character; any other text goes to the library whole. Where the tokenizer
    leaves a word of letters in one part, such a word goes to its model at once.

    The texts of a call are cut together: Arrow numbers the different words, and their ids are taken by number.
    """

    #: Marks that a tokenizer may part from the letters beside them, and a digit, which is a token of its own.
    MARKS, SEPARATOR = b".,!?;:%&$*#|", "0"
    LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())

    def __init__(self, path: str, split_on_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.memo, self.split_on_space = Tokenizer.from_file(path), Memo(), split_on_space
        self.cut = self.ids(self.SEPARATOR)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.split_on_space &= len(self.cut) == 1 and all("<|" in x for x in added)  # texts with that sign go to the library whole
        self.direct, self.spelled = self.leaves_letters()
        space, letter, mark, other = range(4)
        marks = self.MARKS if self.parts_marks() else b""
        self.kinds = bytes(space if bytes([b]).isspace() else letter if chr(b) in self.LETTERS else mark if b in marks else other for b in range(256))
        apart = {(letter, mark), (mark, letter)}
        pairs = [(k >> 2, k & 3) for k in range(16)]  # the kinds of a byte and of the next
        self.begins = bytes(y != space and (x == space or (x, y) in apart) for x, y in pairs).ljust(256, b"\0")
        self.ends = bytes(x != space and (y == space or (x, y) in apart) for x, y in pairs).ljust(256, b"\0")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 and END < 1 << 16 else 4

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def leaves_letters(self) -> tuple[bool, dict[int, str]]:
        """Whether the model gets a word of letters in one part, letter by letter, and what it gets for each letter."""
        t = self.tokenizer
        if t.pre_tokenizer is None or t.post_processor is not None or t.truncation is not None or t.padding is not None:
            return False, {}
        parts = lambda x: [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(x) if t.normalizer else x)]
        spelled = {ord(c): "".join(parts(c)) for c in self.LETTERS}
        return parts(self.LETTERS) == ["".join(spelled.values())], spelled

    def parts_marks(self) -> bool:
        """Whether each mark is parted from a letter before and after it, also where other signs stand beside it."""
        t = self.tokenizer
        cuts = lambda x: {hi for _, (_, hi) in t.pre_tokenizer.pre_tokenize_str(x)}
        return t.pre_tokenizer is not None and all({1, 1 + len(m)} <= cuts(f"a{m}b") for c in self.MARKS.decode() for m in (c, f"{c}{c}", f"{c}'{c}", f"{c}/{c}"))

    def learn(self, found: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words, many in one call."""
        direct, flat, ends, letters, plain, fresh = [], [], [], {}, {}, {}
        tokenize, spelled = self.tokenizer.model.tokenize, self.spelled
        for w in found:
            t = w.decode("latin-1")
            if t.isalpha():
                if self.direct:
                    flat += [x.id for x in tokenize(t if t.isascii() else t.translate(spelled))]
                    ends.append(4 * len(flat))
                    direct.append(w)
                else:
                    letters[w] = t
            elif self.SEPARATOR not in t and "<|" not in t:
                plain[w] = t
            else:
                fresh[w] = self.ids(t).tobytes()
        self.part(fresh, direct, np.array(flat, "<u4"), ends, 0)
        ids = self.ids(" ".join(letters.values()))  # each is cut into one word, so one id ends it
        self.part(fresh, letters, ids, ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist(), 0)
        ids = self.ids(f" {self.SEPARATOR} ".join(plain.values()))
        self.part(fresh, plain, ids, [*(np.flatnonzero(ids == self.cut[0]) * 4).tolist(), 4 * len(ids)] if plain else [], 4)
        return fresh

    def part(self, fresh: dict[bytes, bytes], words: Collection[bytes], ids: np.ndarray, ends: list[int], gap: int) -> None:
        """Takes the words' ids from the ids of all of them, by the bytes at which each ends and those between two."""
        if len(ends) != len(words):
            raise ValueError("this tokenizer doesn't keep words apart: use split_on_space=False")
        raw, at = ids.tobytes(), 0
        for w, end in zip(words, ends):
            fresh[w], at = raw[at:end], end + gap

    def words(self, text: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of a text that begins and ends with a space, and where each begins."""
        kind = np.frombuffer(text.translate(self.kinds), np.uint8)
        pair = (kind[:-1] << 2 | kind[1:]).tobytes()
        starts, stops = (np.flatnonzero(np.frombuffer(pair.translate(t), bool)) + 1 for t in (self.begins, self.ends))
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(stops - starts, out=offsets[1:])
        kept = np.frombuffer(text, np.uint8)[kind != 0]
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode(), starts

    def of_words(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts in lower case, by their words."""
        words, starts = self.words(b"".join([b" ", *(t + b" " for t in texts)]))
        here = words.dictionary.to_pylist()
        self.memo.bound(MEMO_WORDS, MEMO_BYTES)
        known = list(map(self.memo.get, here))
        fresh = self.learn([w for w, x in zip(here, known) if x is None])
        known = [fresh[w] if x is None else x for w, x in zip(here, known)]
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(lengths)), np.frombuffer(b"".join(known), "<u4"))
        ids = lists.take(words.indices).flatten().to_numpy()
        ends = np.append(0, np.cumsum(lengths[words.indices.to_numpy()]))
        first = ends[np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)]))]
        self.memo.remember(fresh)
        return [ids[lo:hi].tobytes() for lo, hi in zip(first[:-1], first[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        for t in texts:
            try:
                out.append(t.encode("latin-1").lower() if self.split_on_space and "<|" not in t else None)
            except UnicodeEncodeError:
                out.append(None)
        split = iter(self.of_words([x for x in out if x is not None]))
        return [self.ids(t).tobytes() if x is None else next(split) for t, x in zip(texts, out)]

    def encode_rows(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        """The rows of a batch in order, in slices, and the ids of each row's text; null texts are encoded as empty ones."""
        for piece in slices(batch, "text", ENCODED_ROWS, ENCODED_BYTES):
            yield piece, self.encode([t or "" for t in piece.column("text").to_pylist()])


@lru_cache(maxsize=2)
def encoder_of(path: str, split_on_space: bool) -> Encoder:
    """The encoder of this worker process: later tasks find the words that earlier ones have met."""
    return Encoder(path, split_on_space)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def ranges_of(rows: int, size: int, cores: int) -> int:
    """Ranges for `rows` rows with `size` bytes of text: bounded ones, and RANGES_EACH a core unless that makes them tiny."""
    return max(1, -(-size // RANGE_BYTES), -(-rows // RANGE_ROWS), min(RANGES_EACH * cores, size >> 20))


def write_records(docs: DataFrame, path: str, tokenizer: str, split_on_space: bool = False, part_equal: bool = False) -> DataFrame:
    """Encodes every whole text of docs (doc_id, text) and writes its ids under `path`; returns the manifest.

    Documents are written in ascending order of doc_id, null ids first, rows of one id by their first LEADING characters,
    null texts (which are encoded as empty ones) first, and then by the hash of the text. Repeated rows are written as often
    as they occur; other columns are not read. An empty table gives an empty manifest and no file. `path` is a folder that
    all executors reach, by an address that Arrow knows (file, hdfs, s3, gs).

    Ranges of rows in this order are bounded in bytes and rows, also where one id fills several of them. Rows equal
    in id and text stand in one range unless `part_equal`, which deals them by their place in the input: give it for a
    table read from storage only, whose rows a task that runs again finds in their old places.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    ranges = ranges_of(counted.n, counted.bytes, spark.sparkContext.defaultParallelism)
    order = [F.col("doc_id").asc_nulls_first(), F.substring("text", 1, LEADING).asc_nulls_first(), F.xxhash64("text").asc()]
    equal = [F.monotonically_increasing_id().asc()] if part_equal else []
    ordered = rows.repartitionByRange(ranges, *order, *equal).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (fs, base) = encoder_of(tokenizer, split_on_space), open_fs(path)
        fs.create_dir(base, recursive=True)
        part, file, done, out = TaskContext.get().partitionId(), 0, [], None
        small = f"<u{encoder.width}"

        def close():
            nonlocal out, file
            out.close()
            with fs.open_output_stream(f"{name}.idx") as index:
                index.write(np.array(offsets, "<i8").tobytes())
            done.append((part, file, f"{name}.rec", len(offsets), ids))
            out, file = None, file + 1

        for batch in batches:
            for piece, found in encoder.encode_rows(batch):
                for doc, raw in zip(piece.column("doc_id").to_pylist(), found):
                    if out is None:
                        name = posixpath.join(base, f"part-{part:05d}-{file:04d}-{uuid.uuid4().hex}")
                        out, at, ids, offsets = fs.open_output_stream(f"{name}.rec"), 0, 0, []
                    tokens = np.frombuffer(raw + struct.pack("<I", END), "<u4")
                    payload = struct.pack("<BBq", encoder.width, doc is None, doc or 0) + tokens.astype(small).tobytes()
                    offsets.append(at)
                    at += out.write(framed := frame(payload)) or len(framed)
                    ids += len(tokens)
                    if at >= FILE_BYTES:
                        close()
        if out is not None:
            close()
        columns = zip(*done) if done else [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "file", "path", "records", "ids"])

    manifest = f"{path}/manifest.parquet"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def record(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    width, null, doc = struct.unpack("<BBq", payload[:10])
    return None if null else doc, np.frombuffer(payload, f"<u{width}", offset=10).astype("<u4")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The documents in the files under `path`: doc_id, start (ids of all documents before), n_tokens and ids_crc32.

    The files' starts come from a running sum over the manifest, one row per file of up to FILE_BYTES. Each file is one
    reader's work, which holds a frame at a time and checks all checksums.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest.parquet")
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    n = max(1, files.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = open_fs(path)
        for batch in batches:
            for name, start in zip(batch.path, batch.start):
                rows = []
                with fs.open_input_stream(name, buffer_size=1 << 20) as stream:
                    for payload in frames(stream):
                        doc, ids = record(payload)
                        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64", "start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})

    return files.repartition(n, "path").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(uri: str, path: str, rows: Iterable[int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of one data file in the order asked for, found through its offset index; uri names the store."""
    fs, _ = open_fs(uri)
    index = np.frombuffer(fs.open_input_stream(re.sub(r"\.rec$", ".idx", path)).read(), "<i8")
    with fs.open_input_file(path) as data:
        for row in rows:
            data.seek(int(index[row]))
            yield record(next(frames(data)))

"""Token-id files of independent zstandard frames.

File layout: frames of little-endian unsigned 32-bit ids, several whole
documents each; a skippable frame with the document table (doc_id, frame,
first id in the frame, number of ids); a skippable frame with the public
zstd seek table (compressed size, size, XXH64 low word of each frame, then
the nine-byte footer).  A reader takes the two tables from the end of the
file and decompresses only the frames that hold the documents asked for.

Edge cases: a null or empty text holds the end id alone; a null doc_id sorts
first and is stored as such; repeated rows are each written; an empty table
writes no file; columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, work_path

# Fixed values of the public seekable zstd format.
SEEK_MAGIC = 0x8F92EAB1
SKIP_SEEK = 0x184D2A5E
SKIP_DOCS = 0x184D2A50
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 15
FILE_IDS = 1 << 26
NULL_ID = -(1 << 63)
_DOC = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("n", "<u4")])
_SEEK = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


# --- encoding ---------------------------------------------------------------

def _letters(kind: str) -> str:
    """Latin characters (below U+0250) of a Unicode category, for a class of a pattern."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c)).startswith(kind))


def splits_into_pieces(settings: dict) -> bool:
    """Whether a tokenizer file is a byte-level BPE whose pre-tokens follow from
    the text alone, so that equal pre-tokens have equal ids everywhere."""
    pre, model = settings.get("pre_tokenizer") or {}, settings["model"]
    return (settings.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True)
            and pre.get("use_regex", True) and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))


class PieceEncoder(dict):
    """Ids of pre-tokens, two generations of at most ``size`` entries.

    The pre-tokens of a byte-level BPE are the matches of a published pattern;
    each is encoded once while it is remembered.  The pattern's classes are
    spelled out for Latin text; a text with other characters parts before
    single spaces, where pre-tokens never join, and its foreign parts are
    encoded by the library.  A text that holds an added token, and every text
    of a tokenizer of another kind, is encoded whole.
    """

    def __init__(self, path: str, size: int = 400_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tok, self.size, self.old = Tokenizer.from_file(path), size, {}
        self.model = self.tok.model
        settings = json.loads(self.tok.to_str())
        self.by_piece = splits_into_pieces(settings)
        self.added = [t["content"] for t in settings.get("added_tokens") or []]
        letter, number = _letters("L"), _letters("N")
        # Fixed value: the published pattern of byte-level pre-tokens.
        self.split = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+").findall
        self.foreign = re.compile("[^\x00-\u024f]").search
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(keep)]
        self.bytes = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:
            if piece.isascii() and piece.isprintable():
                shown = piece.replace(" ", self.bytes[32])
            else:
                shown = piece.encode().decode("latin-1").translate(self.bytes)
            got = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = got
        return got

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_piece or any(t in text for t in self.added):
            return self.whole(text)
        if text.isascii() or not self.foreign(text):
            return self._latin(text)
        parts = text.split(" ")
        if not all(p and not p[0].isspace() and not p[-1].isspace() for p in parts):
            return self.whole(text)
        parts[1:] = [" " + p for p in parts[1:]]
        return b"".join([self.whole(p) if self.foreign(p) else self._latin(p) for p in parts])


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# --- file format -------------------------------------------------------------

def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class FrameWriter:
    """Streams documents into frames; keeps one frame and the tables, 20 bytes
    a document and 12 a frame, in memory."""

    def __init__(self, out, frame_ids: int = FRAME_IDS) -> None:
        self.out, self.frame_ids = out, frame_ids
        self.pack = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.docs = {name: array(code) for name, code in (("doc_id", "q"), ("frame", "I"), ("first", "I"), ("n", "I"))}
        self.seek = array("I")
        self.held: list[bytes] = []
        self.n = self.total = self.frames = 0

    @property
    def n_docs(self) -> int:
        return len(self.docs["n"])

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        if self.n and self.n + n > self.frame_ids:
            self.flush()
        for column, v in zip(self.docs.values(), (NULL_ID if doc_id is None else doc_id, self.frames, self.n, n), strict=True):
            column.append(v)
        self.held.append(ids)
        self.n += n
        self.total += n

    def flush(self) -> None:
        if self.n:
            raw = b"".join(self.held)
            frame = self.pack.compress(raw)
            self.out.write(frame)
            self.seek.extend((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.frames += 1
            self.held, self.n = [], 0

    def close(self) -> None:
        self.flush()
        table = np.zeros(self.n_docs, _DOC)
        for name, column in self.docs.items():
            table[name] = np.frombuffer(column, column.typecode) if len(column) else 0
        body = zstandard.ZstdCompressor(level=3).compress(table.tobytes())
        self.out.write(_skippable(SKIP_DOCS, body + struct.pack("<I", len(body))))
        self.out.write(_skippable(SKIP_SEEK, self.seek.tobytes() + struct.pack("<IBI", self.frames, CHECKSUM_FLAG, SEEK_MAGIC)))


class FrameReader:
    """Random access: tables first, then single frames, each checked."""

    def __init__(self, file, size: int) -> None:
        self.file = file
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        at = size - 9 - n * _SEEK.itemsize
        self.seek = np.frombuffer(self._at(at, n * _SEEK.itemsize), _SEEK)
        self.at = np.concatenate([[0], np.cumsum(self.seek["packed"], dtype=np.int64)])
        packed = struct.unpack("<I", self._at(at - 12, 4))[0]
        self.docs = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._at(at - 12 - packed, packed)), _DOC)
        self.unpack = zstandard.ZstdDecompressor()

    def _at(self, pos: int, n: int) -> bytes:
        self.file.seek(pos)
        return self.file.read(n)

    def frame(self, k: int) -> np.ndarray:
        raw = self.unpack.decompress(self._at(int(self.at[k]), int(self.seek["packed"][k])),
                                     max_output_size=int(self.seek["size"][k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(self.seek["check"][k]):
            raise ValueError(f"frame {k}: checksum differs")
        return np.frombuffer(raw, "<u4")

    def scan(self, wanted: set[int] | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, first id in the file, ids) of the documents wanted, frame by frame."""
        starts = np.concatenate([[0], np.cumsum(self.docs["n"], dtype=np.int64)])
        now, ids = -1, None
        for i, (doc_id, frame, first, n) in enumerate(self.docs.tolist()):
            if wanted is not None and doc_id not in wanted:
                continue
            if frame != now:
                now, ids = frame, self.frame(frame)
            yield doc_id, int(starts[i]), ids[first:first + n]


def _open(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    return fs, path


# --- Spark -------------------------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 2, frame_ids: int = FRAME_IDS,
                      file_ids: int = FILE_IDS) -> list[dict]:
    """Encode every text and write files of about ``file_ids`` ids, one after
    the other in each range of doc_id and text hash; returns the manifest, one
    small record per file, in id order.

    A file gets its final name by a rename after it is complete, so a task
    that is lost or run twice leaves the same files.  A file that was moved
    already is overwritten with equal bytes.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        fs, base = _open(folder)
        enc, end = encoder(tokenizer), struct.pack("<I", end_id)
        writer, out, name, temp, number = None, None, "", "", 0

        def close() -> pa.RecordBatch:
            writer.close()
            out.close()
            fs.move(temp, f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"name": [name], "n_docs": [writer.n_docs], "n_ids": [writer.total],
                                               "size": [fs.get_file_info(f"{base}/{name}").size]})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is not None and writer.total >= file_ids:
                    yield close()
                    writer, number = None, number + 1
                if writer is None:
                    name = f"part-{ctx.partitionId():06d}-{number:06d}.zst"
                    temp = f"{base}/.{name}.{ctx.taskAttemptId()}"
                    out = fs.open_output_stream(temp, compression=None)
                    writer = FrameWriter(out, frame_ids)
                writer.add(doc_id, enc.encode(text.as_py() or "") + end)
        if writer is not None:
            yield close()

    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    order = ["doc_id", "h", "text"]
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("h", F.xxhash64("text")).repartitionByRange(parts(spark), "doc_id", "h").sortWithinPartitions(*order)
            .select("doc_id", "text").mapInArrow(write, "name string, n_docs long, n_ids long, size long"))
    manifest, base_id = [], 0
    for r in sorted(rows.collect()):       # one record per file
        manifest.append(r.asDict() | {"base": base_id})
        base_id += r.n_ids
    return manifest


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict],
                     doc_ids: set[int] | None = None) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it over all files),
    ids as bytes.  ``doc_ids`` (a small set) reads only the frames it needs."""
    files = spark.createDataFrame([(m["name"], m["size"], m["base"]) for m in manifest],
                                  "name string, size long, base long").repartition(max(1, len(manifest)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with fs.open_input_file(f"{path}/{f['name']}") as file:
                    out, held = ([], [], []), 0
                    for doc_id, at, ids in FrameReader(file, f["size"]).scan(doc_ids):
                        for col, v in zip(out, (None if doc_id == NULL_ID else doc_id, f["base"] + at, ids.tobytes()), strict=True):
                            col.append(v)
                        held += len(ids)
                        if held > 1 << 19:
                            yield _doc_batch(out)
                            out, held = ([], [], []), 0
                    yield _doc_batch(out)

    return files.mapInArrow(read, "doc_id long, start long, ids binary")


def _doc_batch(cols: tuple[list, list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.binary())], names=["doc_id", "start", "ids"])


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the whole documents table as token files, then read them back."""
    import public_tokenizers

    from .common import table
    folder = work_path(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(spark, folder, manifest).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def crc32_ids(ids: list[int]) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())

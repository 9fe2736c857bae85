"""Token ids as Arrow stream files of equal-length sequences with masks.

Documents are encoded where they are read; only ids move, in one shuffle that deals them by ranges of doc_id, one range
per file. A task streams its sorted range into two Arrow streams: ``tokens``, batches of fixed-size lists (ids, and a
mask that is false on the padding of the file's last sequence), and ``documents`` (doc_id, first id's place in the file,
number of ids). All batches but the last hold the same number of sequences, and neither lists nor masks are
compressed, so a memory map gives sequence k without a copy. A file is written under a name of its attempt and renamed
when whole; a rerun writes the same bytes. A document's ids run on from one sequence to the next within its file.
"""

import json
import re
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrubline.llm.common import arrow_map, cut, fresh_dir

# The letters and digits of plain Latin text, and the pattern that splits text before merging, with
# these in place of \p{L} and \p{N}.
_LATIN = re.compile(r"[\t\n\r\x20-\x7E\xA1-ſ]*")
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\s{_LETTER}{_DIGIT}]+|\s+(?!\S)|\s+")
_REMEMBERED = 1 << 20


@dataclass(frozen=True)
class TokenFiles:
    """The tokenizer's file, the end id, ids per sequence, sequences per batch, bytes of text per file, the most files, beyond
    which files grow (from 640 GB of text on), and whether strings of special tokens in a text are ordinary text. They are
    not by default: the tokenizer's plain call gives them their own ids."""

    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    end_id: int = 2
    length: int = 1024
    batch: int = 512
    file_bytes: int = 32 << 20
    most_files: int = 20_000
    special_as_text: bool = False


class Encoder:
    """Ids of whole texts, as little-endian bytes.

    The pattern cuts plain Latin text into pieces that the tokenizer merges one by one, so ids of a piece are asked for once
    and remembered, up to a fixed number of pieces, for all tasks of a worker. Any other text goes to the tokenizer whole, and
    so does every text if the tokenizer's file cuts texts in another way.
    """

    def __init__(self, rule: TokenFiles):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(rule.tokenizer)
        self.tokenizer.encode_special_tokens = rule.special_as_text
        added = {t.content: t.special for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.marks = [mark for mark, special in added.items() if not (special and rule.special_as_text)]
        self.by_pieces = _cuts_alike(json.loads(self.tokenizer.to_str()))
        self.kind = id_type(self.tokenizer.get_vocab_size(), rule.end_id)
        self.end = np.array([rule.end_id], dtype=self.kind).tobytes()
        outer = self

        class Memory(dict):
            def __missing__(self, piece: str) -> bytes:
                ids = outer.whole(piece)
                if len(self) < _REMEMBERED:
                    self[piece] = ids
                return ids

        self.memory = Memory()

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if not self.by_pieces or not _LATIN.fullmatch(text) or any(mark in text for mark in self.marks):
            return self.whole(text) + self.end
        return b"".join(map(self.memory.__getitem__, _PIECES.findall(text))) + self.end


def _cuts_alike(file: dict) -> bool:
    """Whether a tokenizer cuts texts by the pattern above, and merges every piece by itself and always alike."""
    cut_by, model = file.get("pre_tokenizer") or {}, file["model"]
    plain = cut_by.get("type") == "ByteLevel" and cut_by.get("use_regex", True) and not cut_by.get("add_prefix_space")
    return plain and not file.get("normalizer") and not file.get("post_processor") and not file.get("truncation") and not file.get("padding") and model.get("type") == "BPE" and not model.get("dropout")


@lru_cache(maxsize=1)
def _worker_encoder(rule: TokenFiles) -> Encoder:
    return Encoder(rule)


def id_type(vocabulary: int, end_id: int) -> str:
    return "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"


def _quantiles(docs: DataFrame, rule: TokenFiles) -> list[int]:
    """Upper ends of ranges of doc_id that hold equally many rows; an id that fills whole ranges occurs several times."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    n = min(-(-size // rule.file_bytes), rule.most_files)
    if n <= 1:
        return []
    parts = F.lit(np.arange(1, n) / n)
    return list(docs.agg(F.percentile_approx("doc_id", parts, 100_000)).first()[0] or [])


def _bounds(docs: DataFrame, rule: TokenFiles) -> list[int]:
    """Upper ends of the files' ranges of doc_id, all but the last one's."""
    return sorted(set(_quantiles(docs, rule)))


@dataclass(frozen=True)
class Ranges:
    """Upper ends of ranges of doc_id, all but the last one's, and how many files each has: the first number is for rows without
    a doc_id, which come first. Only these and ranges of a single id have several, in the order of their texts' hashes."""

    ends: list[int]
    parts: list[int]

    def files(self) -> int:
        return sum(self.parts)

    def file_of(self, doc_ids: list[int | None], contents: list[int]) -> list[int]:
        ends, first = np.array(self.ends, dtype=np.int64), np.r_[0, np.cumsum(self.parts)].tolist()
        ranges = [0 if i is None else 1 + int(np.searchsorted(ends, i)) for i in doc_ids]
        return [first[r] + ((c + (1 << 63)) * self.parts[r] >> 64) for r, c in zip(ranges, contents)]


def _ranges(docs: DataFrame, rule: TokenFiles) -> Ranges:
    """``_bounds``, with ids of very many rows in ranges of their own and those, and missing ids, over several files."""
    found = _quantiles(docs, rule)
    hot = sorted(i for i, n in Counter(found).items() if n > 1)
    ends = sorted({*found, *(i - 1 for i in hot)})
    apart = docs.filter(F.col("doc_id").isNull() | F.col("doc_id").isin(hot)) if hot else docs.filter(F.col("doc_id").isNull())
    counted = apart.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes"), F.count("*").alias("n")).collect()
    each = max(rule.file_bytes, sum(r["bytes"] for r in counted) // rule.most_files)
    sizes = {r["doc_id"]: min(-(-r["bytes"] // each), r["n"]) for r in counted}
    alone = [ends[k] if k < len(ends) and k and ends[k] - ends[k - 1] == 1 else None for k in range(len(ends) + 1)]
    return Ranges(ends, [sizes.get(None, 1), *[1 if i is None else sizes.get(i, 1) for i in alone]])


def _encode(ranges: Ranges, rule: TokenFiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(rule)
        for batch in batches:
            file = ranges.file_of(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            texts = batch.column(2).to_pylist()
            for at in range(0, len(texts), 500):
                tokens = pa.array([encoder(t) for t in texts[at : at + 500]], pa.binary())
                columns = [pa.array(file[at : at + 500], pa.int32()), batch.column(0)[at : at + 500], batch.column(1)[at : at + 500], tokens]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "content", "tokens"])

    return run


class _Writer:
    """One file pair: ids are gathered into whole batches of sequences."""

    def __init__(self, directory: str, file: int, kind: str, rule: TokenFiles):
        self.fs, root = pafs.FileSystem.from_uri(directory)
        self.fs.create_dir(root, recursive=True)
        self.rule, self.kind, self.file = rule, kind, file
        self.names = {x: f"{root}/{x}-{file:06d}.arrows" for x in ("tokens", "documents")}
        self.attempt = {x: f"{name}.{uuid.uuid4().hex}" for x, name in self.names.items()}
        value = pa.uint16() if kind == "<u2" else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(value, rule.length)), ("mask", pa.list_(pa.bool_(), rule.length))])
        self.index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.outs = {x: self.fs.open_output_stream(path) for x, path in self.attempt.items()}
        self.tokens = pa.ipc.new_stream(self.outs["tokens"], self.schema)
        self.documents = pa.ipc.new_stream(self.outs["documents"], self.index)
        self.held: list[bytes] = []
        self.held_ids = self.written = self.docs = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // np.dtype(self.kind).itemsize
        self.rows.append((doc_id, self.written, n))
        self.held.append(ids)
        self.held_ids += n
        self.written += n
        self.docs += 1
        if len(self.rows) >= 10_000:
            self._index()
        if self.held_ids >= self.rule.length * self.rule.batch:
            self._flush(False)

    def _index(self) -> None:
        if self.rows:
            arrays = [pa.array(column, pa.int64()) for column in zip(*self.rows)]
            self.documents.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.index))
            self.rows.clear()

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), dtype=self.kind)
        full = self.rule.length * self.rule.batch
        whole = len(flat) // full * full
        for at in range(0, whole, full):
            self._write(flat[at : at + full], full)
        rest = flat[whole:]
        if last and len(rest):
            self._write(rest, -(-len(rest) // self.rule.length) * self.rule.length)
            rest = rest[:0]
        self.held, self.held_ids = [rest.tobytes()], len(rest)

    def _write(self, ids: np.ndarray, room: int) -> None:
        values, mask = np.zeros(room, dtype=ids.dtype), np.arange(room) < len(ids)
        values[: len(ids)] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.rule.length) for x in (values, mask)]
        self.tokens.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> tuple:
        self._flush(True)
        self._index()
        for stream in (self.tokens, self.documents, *self.outs.values()):
            stream.close()
        for x, path in self.attempt.items():
            try:
                self.fs.move(path, self.names[x])
            except OSError:  # some stores refuse to replace the same file of an earlier attempt
                if self.fs.get_file_info(self.names[x]).type != pafs.FileType.File:
                    raise
                self.fs.delete_file(path)
        return self.file, self.docs, self.written


_FILES = "file int, n_docs bigint, n_ids bigint"


def _write(directory: str, kind: str, rule: TokenFiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        done = []
        for batch in batches:
            for file, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if writer is None or writer.file != file:
                    if writer is not None:
                        done.append(writer.close())
                    writer = _Writer(directory, file, kind, rule)
                writer.add(doc_id, ids.as_py())
        if writer is not None:
            done.append(writer.close())
        columns = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["file", "n_docs", "n_ids"]
        )

    return run


def write(docs: DataFrame, directory: str, rule: TokenFiles = TokenFiles()) -> DataFrame:
    """Writes the files of ``docs`` in ascending doc_id order; returns (file, n_docs, n_ids, start), one row per file.

    start is the number of ids in the files before. A null or empty text is its end id alone. Rows without a doc_id come
    first; rows of one doc_id follow each other, ordered by a hash of their text, over several files if they are very many
    (those equal in doc_id and text in one). A text of any length is encoded whole by one task. Columns other than doc_id and
    text are ignored, whatever their names. An empty table gives no file.
    """
    kind = Encoder(rule).kind
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("content"), "text")
    ranges = _ranges(narrow, rule)
    encoded = narrow.transform(arrow_map, _encode(ranges, rule), "file int, doc_id bigint, content bigint, tokens binary")
    dealt = encoded.repartitionById(ranges.files(), "file").sortWithinPartitions("file", "doc_id", "content")
    files = cut(dealt.transform(arrow_map, _write(directory, kind, rule), _FILES))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return cut(files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint"))))


def open_stream(directory: str, name: str) -> pa.RecordBatchStreamReader:
    """A stream of the directory; on a local disk a memory map, so batches are views of the file."""
    fs, root = pafs.FileSystem.from_uri(directory)
    path = f"{root}/{name}"
    return pa.ipc.open_stream(pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path))


class Sequences:
    """Random access to one file's sequences: views of the file, nothing copied."""

    def __init__(self, directory: str, file: int):
        self.batches = list(open_stream(directory, f"tokens-{file:06d}.arrows"))
        self.per_batch = self.batches[0].num_rows if self.batches else 0

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= k < len(self):
            raise IndexError(k)
        batch = self.batches[k // self.per_batch].slice(k % self.per_batch, 1)
        return batch.column(0).flatten().to_numpy(zero_copy_only=True), batch.column(1).flatten()


def _stored(directory: str, file: int) -> Iterator[tuple]:
    """(doc_id, start, n_tokens, crc32 of the ids as 32-bit integers), in order, one batch of sequences at a time."""
    flats = _valid_ids(directory, file)
    flat, used = np.zeros(0, dtype=np.uint16), 0
    for index in open_stream(directory, f"documents-{file:06d}.arrows"):
        for doc_id, start, n in zip(*(index.column(i).to_pylist() for i in range(3))):
            crc, left = 0, n
            while left:
                if used == len(flat):
                    flat, used = next(flats), 0
                take = flat[used : used + left]
                crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                used += len(take)
                left -= len(take)
            yield doc_id, start, n, crc
    if used != len(flat) or next(flats, None) is not None:
        raise ValueError(f"file {file} holds more ids than its documents")


def _valid_ids(directory: str, file: int) -> Iterator[np.ndarray]:
    for batch in open_stream(directory, f"tokens-{file:06d}.arrows"):
        ids, mask = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy(zero_copy_only=False)
        yield ids if mask.all() else ids[mask]


def read(files: DataFrame, directory: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files that ``write`` returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, start, n, crc in _stored(directory, file):
                    rows.append((doc_id, before + start, n, crc))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    n = max(1, files.count())
    each = files.select("file", "start").repartitionById(n, "file")
    return each.transform(arrow_map, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, rule: TokenFiles = TokenFiles()) -> DataFrame:
    """Writes the files into the shared folder and returns what they hold, one row per row of ``docs``."""
    directory = fresh_dir(docs.sparkSession, "tokens")
    return read(write(docs, directory, rule), directory)

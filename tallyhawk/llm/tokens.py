"""Token ids of documents in binary shards with a shared compression dictionary.

A shard holds a run of documents in ascending doc_id order::

    magic 8 | SHA-256 of the dictionary 32 | bytes per id 4 | documents 4
    one zstandard frame per document: its ids, little-endian, the end id last
    doc_id 8 x n | has a doc_id 1 x n | ids per document 8 x n | frame offset 8 x (n + 1)
    offset of the index 8

Each document is a frame of its own, compressed with one dictionary trained on serialized
id arrays, so a short document is read alone and still compresses well. The dictionary
lies beside the shards; its hash in every shard says which one it was.

Tasks write shards straight to the shared folder, under a name of their attempt first and
the final one when complete, so a task that runs again replaces its own shard.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage, new_folder, ship_package, spread, uniform
from tallyhawk.llm.shingles import joined_texts, span_hashes

MAGIC = b"TKSHARD1"
_HEAD = struct.Struct("<8s32sII")
DICTIONARY = "dictionary"
DICTIONARY_BYTES = 65_536
#: Documents the dictionary is trained on, about, and bytes that it takes of each at most: of
#: longer documents a slice from a place that the document's hash names.
SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 16_384
#: Documents of a shard, about.
SHARD_ROWS = 50_000
#: Distinct pieces an encoder remembers.
PIECES = 800_000
#: Pieces that are encoded as one text.
JOINED = 256
LEVEL = 3
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SPACE_BYTES = frozenset(np.flatnonzero(_SPACE).tolist())
#: Lead bytes of white space outside ASCII.
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE_SPACE = re.compile("[\x85\xa0  -     　][\t-\r ]")


class Encoder:
    """Ids of whole texts by the tokenizers library, remembering pieces it has seen.

    The byte-level pre-tokenizer never joins a character that is not white space with
    white space after it, so a text may be encoded in pieces that begin at white space.
    Texts where white space outside ASCII meets white space are encoded whole. Pieces are
    known by two 64-bit hashes of their bytes; texts whose pieces clash in one are encoded
    whole too.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocabulary = self.tokenizer.get_vocab()
        # A byte-level token has a character for each byte that it stands for.
        self._bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[int, int] = {}
        self._second = np.zeros(1024, np.uint64)
        self._from = np.zeros(1024, np.int64)
        self._size = np.zeros(1024, np.int64)
        self._flat = np.zeros(4096, self.dtype)
        self._used = 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size - len(array), len(array)), array.dtype)])

    def _whole(self, text: bytes) -> np.ndarray:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype)

    def _alone(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.array([k for ids in found for k in ids], self.dtype), np.array([len(ids) for ids in found], np.int64)

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_alone``, but JOINED pieces at a time as one text.

        Pieces begin at white space and end without any, so their ids are those of the text, cut
        where the bytes that the ids stand for come to a piece's end. Where they do not, as under
        a tokenizer that changes texts, the pieces are encoded alone.
        """
        ends = [np.cumsum([len(p) for p in pieces[k : k + JOINED]]) for k in range(0, len(pieces), JOINED)]
        texts = [b"".join(pieces[k : k + JOINED]).decode() for k in range(0, len(pieces), JOINED)]
        ids, sizes = [], []
        for k, (found, end) in enumerate(zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), ends, strict=True)):
            got = np.array(found.ids, np.int64)
            reached = np.cumsum(self._bytes[got])
            places = np.searchsorted(reached, end)
            if len(got) and reached[-1] == end[-1] and (reached[places] == end).all():
                ids.append(got.astype(self.dtype))
                sizes.append(np.diff(places, prepend=-1))
            else:
                alone = self._alone(pieces[k * JOINED : (k + 1) * JOINED])
                ids.append(alone[0])
                sizes.append(alone[1])
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, keys: list[int], seconds: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Remember pieces; returns the slot of each."""
        # Neither side of a seam may be white space but for the one a piece begins with.
        joins = np.array([p[0] in _SPACE_BYTES and p[-1] < 0x80 and p[-1] not in _SPACE_BYTES for p in pieces])
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        n = int(joins.sum())
        parts = [
            encode([pieces[k] for k in some.tolist()])
            for encode, some in ((self._pieces, order[:n]), (self._alone, order[n:])) if len(some)
        ]
        ids, sizes = (np.concatenate(column) for column in zip(*parts, strict=True))
        first, total = len(self._slots), self._used
        end, slots = first + len(keys), np.empty(len(keys), np.int64)
        slots[order] = np.arange(first, end)
        self._slots.update(zip(keys, slots.tolist(), strict=True))
        for name in ("_second", "_from", "_size"):
            setattr(self, name, self._room(getattr(self, name), end))
        self._second[first:end] = seconds[order]
        self._size[first:end] = sizes
        self._from[first:end] = total + np.cumsum(sizes) - sizes
        self._flat = self._room(self._flat, total + len(ids))
        self._flat[total : total + len(ids)] = ids
        self._used = total + len(ids)
        return slots

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a missing text has none."""
        for data, bounds, _ in joined_texts(texts):
            yield from self._encode(data, bounds)

    def _encode(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        n = len(data)
        if n == 0:
            for _ in bounds[1:]:
                yield np.empty(0, self.dtype)
            return
        if len(self._slots) > PIECES:
            self._forget()
        space = _SPACE[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        heads = bounds[:-1][bounds[:-1] < n]
        begins[heads] = True
        starts = np.flatnonzero(begins)
        stops = np.append(starts[1:], n)
        keys, seconds = span_hashes(data, starts, stops)
        distinct, where, piece = np.unique(keys, return_index=True, return_inverse=True)
        listed = distinct.tolist()
        slots = np.array([self._slots.get(k, -1) for k in listed], dtype=np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            view = data.tobytes()
            pieces = [
                view[s:e]
                for s, e in zip(starts[where[new]].tolist(), stops[where[new]].tolist(), strict=True)
            ]
            slots[new] = self._learn([listed[k] for k in new], seconds[where[new]], pieces)
        slot = slots[piece]
        clash = self._second[slot] != seconds
        sizes = self._size[slot]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._flat[np.arange(ends[-1]) + np.repeat(self._from[slot] - ends[:-1], sizes)]
        first = np.searchsorted(starts, bounds)
        clashes = np.concatenate([[0], np.cumsum(clash)])
        leads = np.concatenate([[0], np.cumsum(_LEADS[data])])
        for k in range(len(bounds) - 1):
            a, b = bounds[k], bounds[k + 1]
            odd = clashes[first[k + 1]] > clashes[first[k]]
            if not odd and leads[b] > leads[a]:
                odd = _WIDE_SPACE.search(data[a:b].tobytes().decode()) is not None
            if odd:
                yield self._whole(data[a:b].tobytes())
            else:
                yield ids[ends[first[k]] : ends[first[k + 1]]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; the samples themselves where they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _slice(ids: np.ndarray, key: int) -> np.ndarray:
    """SAMPLE_BYTES of a document for the dictionary, from a place that its hash names."""
    size = SAMPLE_BYTES // ids.itemsize
    start = key % (len(ids) - size + 1) if len(ids) > size else 0
    return ids[start : start + size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard; nothing but the index and one frame is held in memory."""

    def __init__(self, path: str, dictionary: bytes, dtype: np.dtype) -> None:
        self.fs, self.path = _open(path)
        self.part = f"{self.path}.{os.getpid()}.{os.urandom(4).hex()}"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.dtype = dtype
        self.ids: list[int] = []
        self.known: list[bool] = []
        self.sizes: list[int] = []
        self.offsets = [_HEAD.size]
        self._compress = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=_dictionary(dictionary) if dictionary else None,
            write_checksum=False, write_content_size=True, write_dict_id=False,
        ).compress
        self.head = hashlib.sha256(dictionary).digest()
        # The number of documents is in the index; the head only names the format.
        self.out.write(_HEAD.pack(MAGIC, self.head, dtype.itemsize, 0))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self._compress(ids.astype(self.dtype, copy=False).tobytes())
        self.out.write(frame)
        self.ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.sizes.append(len(ids))
        self.offsets.append(self.offsets[-1] + len(frame))

    def close(self) -> None:
        index = self.offsets[-1]
        self.out.write(np.array(self.ids, "<i8").tobytes())
        self.out.write(np.array(self.known, "u1").tobytes())
        self.out.write(np.array(self.sizes, "<i8").tobytes())
        self.out.write(np.array(self.offsets, "<i8").tobytes())
        self.out.write(struct.pack("<QQ", len(self.ids), index))
        self.out.close()
        if self.fs.get_file_info(self.path).type != pa.fs.FileType.NotFound:
            self.fs.delete_file(self.path)  # of an earlier attempt, with the same bytes
        self.fs.move(self.part, self.path)


class ShardReader:
    """Reads a shard document by document, or one document alone."""

    def __init__(self, path: str, dictionary: bytes) -> None:
        fs, name = _open(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        magic, head, width, _ = _HEAD.unpack(self.file.read_at(_HEAD.size, 0))
        if magic != MAGIC or head != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no shard of this dictionary")
        n, index = struct.unpack("<QQ", self.file.read_at(16, size - 16))
        raw = self.file.read_at(size - 16 - index, index)
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.ids = np.frombuffer(raw, "<i8", n)
        self.known = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        self.sizes = np.frombuffer(raw, "<i8", n, 9 * n)
        self.offsets = np.frombuffer(raw, "<i8", n + 1, 17 * n)
        self._decompress = zstandard.ZstdDecompressor(
            dict_data=_dictionary(dictionary) if dictionary else None
        ).decompress

    def document(self, place: int) -> np.ndarray:
        """The ids of the document at ``place``, its end id last."""
        start, end = int(self.offsets[place]), int(self.offsets[place + 1])
        return np.frombuffer(self._decompress(self.file.read_at(end - start, start)), self.dtype)

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The documents of that doc_id; rows without one come first in a shard."""
        low = int((~self.known).sum())
        a, b = np.searchsorted(self.ids[low:], [doc_id, doc_id + 1])
        return [self.document(low + k) for k in range(a, b)]

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        buffer, at = b"", 0  # documents are read some at a time
        for k in range(len(self.ids)):
            start, end = int(self.offsets[k]) , int(self.offsets[k + 1])
            if end > at + len(buffer):
                at = start
                buffer = self.file.read_at(max(end - start, 1 << 22), start)
            frame = buffer[start - at : end - at]
            ids = np.frombuffer(self._decompress(frame), self.dtype)
            yield (int(self.ids[k]) if self.known[k] else None), ids


def _read_file(path: str) -> bytes:
    fs, name = _open(path)
    with fs.open_input_file(name) as file:
        return file.read()


def write_shards(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Write ``docs(doc_id, text)`` to ``folder``: (shard, path, n_docs, n_ids) by shard.

    Shards are numbered by doc_id, null first; rows of one doc_id follow the hash of their
    text. Null and empty texts are the end id alone. Repeated rows are written as often as
    they come. An empty table gives a dictionary and no shard.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n = docs.count()

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for batch in batches:
            blobs = [
                _slice(ids, key).tobytes() for ids, key in zip(code.encode(batch.column(1)), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary())], ["ids"])

    key = F.xxhash64("doc_id", "text")
    picked = docs.withColumn("key", key).where(uniform(F.coalesce("doc_id", F.xxhash64("text")), F.lit(29)) < SAMPLE_DOCS / max(n, 1))
    sample = sorted(r["ids"] for r in picked.mapInArrow(serialize, "ids binary").collect())
    dictionary = train_dictionary(sample)
    fs, name = _open(folder)
    fs.create_dir(name, recursive=True)
    with fs.open_output_stream(f"{name}/{DICTIONARY}", compression=None) as out:
        out.write(dictionary)
    raw = spark.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES at most

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, shard, writer, total = encoder(tokenizer), TaskContext.get().partitionId(), None, 0
        end = np.array([end_id], dtype=code.dtype)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), code.encode(batch.column(1)), strict=True):
                if writer is None:
                    path = f"{folder}/shard-{shard:06d}"
                    writer = ShardWriter(path, raw.value, code.dtype)
                writer.add(doc_id, np.concatenate([ids, end]))
                total += len(ids) + 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([path]), pa.array([len(writer.ids)], pa.int64()),
                 pa.array([total], pa.int64())],
                ["shard", "path", "n_docs", "n_ids"],
            )

    ordered = docs.withColumn("th", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(
        spread(docs, -(-n // shard_rows)), F.col("doc_id").asc_nulls_first(), "th"
    ).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "th")
    return cut_lineage(
        ordered.select("doc_id", "text").mapInArrow(write, "shard long, path string, n_docs long, n_ids long")
    )


def read_shards(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone.

    ``shards`` is what ``write_shards`` returned: one row per file, so that its running
    sum is small. start is the number of ids of all documents before.
    """
    ship_package(spark)
    rows = sorted((r["shard"], r["path"], r["n_ids"]) for r in shards.collect())
    before = np.cumsum([0, *[r[2] for r in rows]]).tolist()
    listed = spark.createDataFrame(
        [(path, start) for (_, path, _), start in zip(rows, before, strict=False)], "path string, start long"
    )
    listed = listed.repartition(max(1, min(len(rows), spread(listed))), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _read_file(f"{folder}/{DICTIONARY}")
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = ShardReader(path, dictionary)
                crcs = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in reader]
                sizes = reader.sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.ids, mask=~reader.known), pa.array(start + np.cumsum(sizes) - sizes),
                     pa.array(sizes), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_digest(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all documents as shards and list them as read back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    return read_shards(spark, folder, write_shards(docs, str(tokenizer), folder))

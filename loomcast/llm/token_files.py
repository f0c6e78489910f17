"""Token ids in binary shards with a minimal perfect hash index for keyed access.

One shard is a payload file, the raw little-endian ids of its documents in
ascending id order, and an index file. The index maps a document key to the place
of its ids by a minimal perfect hash (levels of bit arrays as in Limasset et al.,
"Fast and Scalable Minimal Perfect Hashing for Massive Key Sets", 2017); a stored
fingerprint tells keys that were never indexed. A lookup reads one entry.

Files are written by the tasks into the shared folder. Each attempt writes under
a name of its own and only the names in the manifest, a written table, are read:
a lost executor or a repeated task leaves at most a file that nobody reads.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from loomcast.llm.common import GOLDEN, Scratch, mix64

MAGIC = b"IDX1"
FOUND = np.dtype([("print", "<u4"), ("rows", "<u4"), ("first", "<u8")])
NULL_KEY = -(2**63)
_CACHE_LIMIT = 1_000_000


@dataclass(frozen=True)
class TokenFileSettings:
    """``tokenizer`` is the path of a tokenizer file on every node.

    ``shard_bytes`` is the text per shard that the number of shards aims at; raise it
    for collections that would have too many files.
    """

    tokenizer: str
    end_id: int = 0
    shard_bytes: int = 16 << 20


class Encoder:
    """Encodes whole texts, keeping the ids of pieces it has seen.

    A byte-level tokenizer with the common splitting rule always starts a new
    piece at a single space that a visible character follows, so the pieces
    between such spaces encode independently of each other. Only pieces outside
    the cache reach the library, many at a time.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.cache: dict[str, bytes] = {"": b""}

    @staticmethod
    def pieces(text: str) -> list[str]:
        """Pieces that encode independently and join to the text."""
        lines = text.split("\n")
        if len(lines) > 1:
            plain = all(x and not x[0].isspace() and not x[-1].isspace() for x in lines)
            lines = lines if plain else [text]
        out = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            if line.isprintable() and "  " not in line and line[-1:] != " ":
                out += line.replace(" ", "\0 ").split("\0")  # no line like this has a NUL
                continue
            first, *rest = line.split(" ")
            out.append(first)
            for part in rest:
                if part and not part[0].isspace():
                    out.append(" " + part)
                else:
                    out[-1] += " " + part
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Encode pieces that the cache lacks; closing marks apart from their word."""
        cache, words, split = self.cache, set(), []
        for piece in pieces:
            stem = piece.rstrip(".,")
            if len(stem) < len(piece) and stem[-1:].isalpha():
                split.append((piece, stem, piece[len(stem) :]))
                words.update((stem, piece[len(stem) :]))
            else:
                words.add(piece)
        words = [x for x in words if x not in cache]
        for start in range(0, len(words), 4096):
            part = words[start : start + 4096]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, dtype=self.dtype).tobytes()
            owner = np.array([-1 if w is None else w for w in got.word_ids], dtype=np.int64)
            cuts = np.searchsorted(owner, np.arange(len(part) + 1)) * self.dtype.itemsize
            for piece, i, j in zip(part, cuts.tolist(), cuts[1:].tolist(), strict=False):
                cache[piece] = ids[i:j]
        for piece, stem, mark in split:
            cache[piece] = cache[stem] + cache[mark]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian bytes; null is empty."""
        cache = self.cache
        if len(cache) > _CACHE_LIMIT:
            cache.clear()
            cache[""] = b""
        split = [self.pieces(text) if text else [] for text in texts]
        missing = set(chain.from_iterable(split)).difference(cache)
        if missing:
            self._learn(missing)
        for pieces in split:
            yield b"".join(map(cache.__getitem__, pieces))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys; vectorised build and lookup."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sums = [0]
        self.ranks = []
        for bits in levels:
            rank = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(rank - bits + sums[-1])
            sums.append(sums[-1] + int(bits.sum()))

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.array([level + 1], dtype=np.uint64) * GOLDEN
        return (mix64(keys ^ seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = 2 * len(keys) + 1
            slot = cls._slot(keys, len(levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[slot]]
        return cls(levels)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in 0..n-1; -1 or any place for a key never indexed."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            slot = self._slot(keys[left], level, len(bits))
            hit = bits[slot]
            out[left[hit]] = self.ranks[level][slot[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        parts = [struct.pack("<I", len(self.levels))]
        for bits in self.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, file: io.BytesIO) -> PerfectHash:
        levels = []
        for _ in range(struct.unpack("<I", file.read(4))[0]):
            size = struct.unpack("<Q", file.read(8))[0]
            packed = np.frombuffer(file.read((size + 7) // 8), dtype=np.uint8)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
        return cls(levels)


def _print(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys + GOLDEN) >> np.uint64(32)).astype(np.uint32)


def write_index(keys: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """Index of documents in payload order; equal keys must be neighbours.

    ``ends`` holds the payload position, in ids, after each document. Layout:
    magic, id width, number of documents, keys, ends, perfect hash, entries.
    """
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    distinct = keys[first].astype(np.int64).view(np.uint64)
    hashed = PerfectHash.build(distinct)
    entries = np.zeros(len(distinct), dtype=FOUND)
    at = hashed.lookup(distinct)
    entries["print"][at] = _print(distinct)
    entries["first"][at] = first
    entries["rows"][at] = np.diff(np.append(first, len(keys)))
    head = MAGIC + struct.pack("<IQ", width, len(keys))
    lists = keys.astype("<i8").tobytes() + ends.astype("<u8").tobytes()
    return head + lists + hashed.dump() + entries.tobytes()


class ShardReader:
    """Keyed access to one shard."""

    def __init__(self, index: bytes, payload: bytes | np.ndarray):
        file = io.BytesIO(index)
        if file.read(4) != MAGIC:
            raise ValueError("not an index file")
        width, self.n_docs = struct.unpack("<IQ", file.read(12))
        self.keys = np.frombuffer(file.read(8 * self.n_docs), dtype="<i8")
        self.ends = np.frombuffer(file.read(8 * self.n_docs), dtype="<u8").astype(np.int64)
        self.hashed = PerfectHash.load(file)
        self.entries = np.frombuffer(file.read(), dtype=FOUND)
        self.ids = np.frombuffer(payload, dtype=f"<u{width}")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document number (-1: not indexed) and number of rows of each key."""
        unsigned = np.asarray(keys, dtype=np.int64).view(np.uint64)
        at = self.hashed.lookup(unsigned)
        known = at >= 0
        known[known] = self.entries["print"][at[known]] == _print(unsigned[known])
        first, rows = np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
        first[known] = self.entries["first"][at[known]]
        rows[known] = self.entries["rows"][at[known]]
        return first, rows

    def document(self, number: int) -> np.ndarray:
        start = self.ends[number - 1] if number else 0
        return self.ids[start : self.ends[number]]

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every document with this key."""
        first, rows = self.find(np.array([key]))
        return [self.document(int(first[0]) + i) for i in range(int(rows[0]))]


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that the cluster's default file system gives it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString()


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_shards(
    documents: DataFrame,
    folder: str,
    settings: TokenFileSettings,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the shards into ``folder``, on every node's reach; returns the manifest plan.

    Rows go to shards by ranges of their id, sorted by id and then by text; null
    ids come first and share the key -2 ** 63, which no document may use. A null
    text has only the end id. The manifest has one row per shard that holds
    documents: number, names, documents, ids, smallest and largest key.
    """
    rows = documents.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("key"),
        F.col(text_col).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // settings.shard_bytes))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, store = None, None
        keys, sizes = [], []
        end = b""
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = _encoder(settings.tokenizer)
                end = np.array([settings.end_id], dtype=encoder.dtype).tobytes()
                store, base = _filesystem(folder)
                store.create_dir(base, recursive=True)
                shard = TaskContext.get().partitionId()
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
                payload = store.open_output_stream(f"{base}/{name}.ids")
            keys.append(batch.column(0).to_numpy())
            texts = batch.column(1).to_pylist()
            for start in range(0, len(texts), 256):
                for ids in encoder.encode(texts[start : start + 256]):
                    payload.write(ids + end)
                    sizes.append(len(ids) // encoder.dtype.itemsize + 1)
        if encoder is None:
            return
        payload.close()
        all_keys, ends = np.concatenate(keys), np.cumsum(sizes)
        with store.open_output_stream(f"{base}/{name}.idx") as index:
            index.write(write_index(all_keys, ends, encoder.dtype.itemsize))
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "shard": shard,
                    "name": name,
                    "n_docs": len(all_keys),
                    "n_ids": int(ends[-1]),
                    "min_key": int(all_keys[0]),
                    "max_key": int(all_keys[-1]),
                }
            ]
        )

    return ordered.mapInArrow(
        run,
        "shard long, name string, n_docs long, n_ids long, min_key long, max_key long",
    )


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards, each fetched by its key through the index.

    doc_id, start (ids of all documents before it), n_tokens, ids_crc32. Documents
    that share a key come one after another, in the order of their texts.
    """
    starts = manifest.select(
        "shard",
        "name",
        (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("before"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _filesystem(folder)
        for batch in batches:
            for name, before in zip(batch["name"], batch["before"], strict=True):
                with store.open_input_file(f"{base}/{name}.idx") as file:
                    index = file.read()
                with store.open_input_file(f"{base}/{name}.ids") as file:
                    reader = ShardReader(index, file.read())
                yield _documents(reader, int(before))

    return starts.repartition("shard").mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _documents(reader: ShardReader, before: int) -> pd.DataFrame:
    keys = np.unique(reader.keys)
    first, rows = reader.find(keys)
    if (first < 0).any() or int(rows.sum()) != reader.n_docs:
        raise ValueError("the index does not cover its shard")
    at = np.repeat(first, rows) + np.arange(reader.n_docs) - np.repeat(np.cumsum(rows) - rows, rows)
    owner = np.repeat(keys, rows)
    start = np.where(at > 0, reader.ends[at - 1], 0)
    digests = [zlib.crc32(reader.document(i).astype("<u4").tobytes()) for i in at.tolist()]
    ids = pd.Series(owner, dtype="Int64").mask(owner == NULL_KEY)
    return pd.DataFrame(
        {
            "doc_id": ids,
            "start": start + before,
            "n_tokens": reader.ends[at] - start,
            "ids_crc32": np.array(digests, dtype=np.int64),
        }
    )


def token_files(
    documents: DataFrame, settings: TokenFileSettings, folder: str | None = None
) -> DataFrame:
    """Write the shards, keep the manifest as a table and read the shards back.

    One row per document. Without ``folder`` the files go to the shared scratch
    folder. An empty table gives no shard and no row.
    """
    scratch = Scratch(documents.sparkSession, "token-files")
    # Tasks of other machines must not take a path without a scheme for a local one.
    folder = qualified(documents.sparkSession, folder or f"{scratch.path}/shards")
    manifest = scratch.save(write_shards(documents, folder, settings), "manifest")
    return read_shards(manifest, folder)

"""Near-duplicate groups of documents by SimHash and Golay-code fuzzy hashing.

Charikar's fingerprint (2002) of 64 bits over word shingles. Two fingerprints are
linked at ``2`` or fewer differing bits.

The perfect binary Golay code (23, 12) puts every 23-bit word within three errors
of exactly one codeword. A fingerprint is cut into three segments of 22, 21 and 21
bits, each decoded to the 12-bit index of its codeword, and three indices make a
key. Fingerprints two bits apart have a point between them, one bit at most from
either. That one error falls into one segment (pigeonhole), so each fingerprint
takes the key of its own decoding and those in which one segment is decoded after
one bit error there: at most 1 + 3 * 5 keys, as a segment has at most five other
codewords in reach, and two linked fingerprints share the key of the point between.

1. Documents become fingerprints; equal fingerprints one class.
2. Keys that several fingerprints carry are joined to their members.
3. A member is verified through the points that it has under the shared key: two
   fingerprints are linked exactly if they are both within one bit of some point.
   A point has at most 65 fingerprints around it, so rows grow with a key's
   members and not with their square, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from loomcast.llm.common import Scratch, slices
from loomcast.llm.components import connected_components

SEED = 42
SEGMENTS = (22, 21, 21)
#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
CHUNK = 1 << 14


@dataclass(frozen=True)
class SimHashSettings:
    """``width`` words a shingle. The keys are made for links at two bits."""

    width: int = 3


@lru_cache(maxsize=1)
def decoder() -> np.ndarray:
    """Index of the nearest codeword for every 23-bit word."""
    data = np.arange(4096, dtype=np.int64)
    rest = data << 11
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    codewords = data << 11 | rest
    errors = [0]
    for _ in range(3):
        errors = sorted({e | 1 << i for e in errors for i in range(23)} | set(errors))
    table = np.empty(1 << 23, dtype=np.int16)
    for error in errors:
        table[codewords ^ error] = data
    return table


def segments(prints: np.ndarray) -> list[np.ndarray]:
    out, shift = [], 0
    for size in SEGMENTS:
        out.append((prints >> np.uint64(shift) & np.uint64((1 << size) - 1)).astype(np.int64))
        shift += size
    return out


def _joined(indices: list[np.ndarray]) -> np.ndarray:
    return indices[0] << 24 | indices[1] << 12 | indices[2]


def point_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 65 points within one bit of each fingerprint, and the points' keys."""
    table, parts = decoder(), segments(prints)
    own = [table[part].astype(np.int64) for part in parts]
    points, keys, shift = [prints], [_joined(own)], 0
    for s, size in enumerate(SEGMENTS):
        for bit in range(size):
            moved = list(own)
            moved[s] = table[parts[s] ^ (1 << bit)].astype(np.int64)
            points.append(prints ^ np.uint64(1 << (shift + bit)))
            keys.append(_joined(moved))
        shift += size
    return np.stack(points, axis=1), np.stack(keys, axis=1)


def fingerprint(raw: bytes | None, width: int) -> int:
    """Majority bits of the hashes of all word shingles; no words give zero.

    Words are runs of bytes other than ASCII white space after lower-casing A-Z. A
    text with fewer words than ``width`` is one shingle.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        hashes = np.fromiter(
            (
                xxh64_intdigest(b" ".join(words[i : i + width]), SEED)
                for i in range(start, min(start + CHUNK, n))
            ),
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            # Sizes first: Python objects of a slice at a time, however long texts are.
            lengths = [range(n or 0) for n in pc.binary_length(texts).to_pylist()]
            for start, end in slices(lengths):
                found = [
                    fingerprint(raw, width) for raw in texts.slice(start, end - start).to_pylist()
                ]
                prints = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(prints)],
                    names=["doc_id", "print"],
                )

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, print), each key of a fingerprint once."""
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        keys = np.sort(point_keys(prints)[1], axis=1)
        new = np.ones(keys.shape, dtype=bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[new]),
                pa.array(np.repeat(prints, new.sum(axis=1)).view(np.int64)),
            ],
            names=["key", "print"],
        )


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(point, print) for the points that a member has under its key."""
    for batch in batches:
        prints = batch.column(1).to_numpy().view(np.uint64)
        points, keys = point_keys(prints)
        mine = keys == batch.column(0).to_numpy()[:, None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(points[mine].view(np.int64)),
                pa.array(np.repeat(prints, mine.sum(axis=1)).view(np.int64)),
            ],
            names=["point", "print"],
        )


def fingerprints(
    documents: DataFrame,
    settings: SimHashSettings = SimHashSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, print): one row per input row, the fingerprint as a signed long."""
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).mapInArrow(_fingerprints(settings.width), "doc_id long, print long")


def links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) over distinct fingerprints: edges whose components are those of all links."""
    keyed = scratch.save(prints.mapInArrow(_keys, "key long, print long"), "keys")
    shared = (
        keyed.groupBy("key")
        .agg(F.min("print").alias("low"), F.max("print").alias("high"))
        .where("low <> high")
        .select("key")
    )
    around = (
        keyed.join(shared, "key")
        .mapInArrow(_points, "point long, print long")
        .groupBy("point")
        .agg(F.collect_set("print").alias("near"))
        .where(F.size("near") > 1)
    )
    found = around.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return scratch.save(found.where((F.col("a") != F.col("b")) & (apart <= 2)).distinct(), "links")


def simhash_groups(
    documents: DataFrame,
    settings: SimHashSettings = SimHashSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint``, ``component_id``.

    ``component_id`` is the smallest id that links reach, itself included. Null,
    empty and blank texts have fingerprint zero, which is linked like any other.
    Rows without an id take the component's id and never lend theirs; the id is null
    where no row of the component has one. Rows that repeat an id follow each its own
    text; equal texts are one class. An empty table gives no rows. Other columns are
    ignored.
    """
    scratch = Scratch(documents.sparkSession, "simhash")
    rows = scratch.save(fingerprints(documents, settings, id_col, text_col), "prints")
    classes = scratch.save(
        rows.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows")),
        "classes",
    )
    roots = connected_components(links(classes.select("print"), scratch), scratch)
    linked = roots.union(roots.select("root", "root").distinct())
    placed = (
        classes.join(linked, classes["print"] == linked["v"], "left")
        .where("n_rows > 1 or root is not null")
        .select("print", "least", F.coalesce("root", "print").alias("root"))
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = scratch.save(placed.join(names, "root").select("print", "component_id"), "groups")
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return rows.join(groups, "print", "left").select(
        "doc_id",
        digits.alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )

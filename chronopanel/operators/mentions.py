"""Names in texts (P31) by an inverted dictionary.

Every name is filed under its first bytes (eight, four or fewer, as many as it
has). Texts are read once: all windows of those lengths are looked up, for a
whole Arrow batch at a time, in a bit table of the filed keys, and only the
places that may begin a name become rows (text, key, following bytes). These
meet the names in one equi-join on the key, are compared with the whole name,
and are grouped back by text. The bit table is the only thing that every task
holds; its size is set by the number of names and bounded. No array of the
names, no comparison of a text with all of them.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_key

__all__ = ["mentions", "with_mentions"]

BLOCK = 1 << 20
MOST_BITS = 27


def _text_key(text: str) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit("text"), F.col(text)).alias("_k2")]


def _key_length(n: Column) -> Column:
    return F.when(n >= 8, 8).when(n >= 4, 4).otherwise(n)


def _slots(windows: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Place of keys (little-endian integers of ``length`` bytes) in the table."""
    h = (windows ^ np.uint64(length * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


def _windows(data: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(max(len(data) - length + 1, 0), np.uint64)
    for j in range(length):
        out |= data[j: j + len(out)].astype(np.uint64) << np.uint64(8 * j)
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offs


def _filed(bits: int):
    """Slots of the names' keys."""
    def run(batches):
        for b in batches:
            slots = [int(_slots(_windows(np.frombuffer(k, np.uint8), len(k)), len(k), bits)[0]) for k in b.column("key").to_pylist()]
            yield pa.record_batch([pa.array(slots, pa.int64())], names=["slot"])

    return run


def _places(table: bytes, bits: int, lengths: dict[str, list[int]], longest: dict[str, int]):
    """Rows (text key, kind, key, following bytes) where a name may begin."""
    def run(batches):
        held = np.frombuffer(table, np.uint8)
        for b in batches:
            if not b.num_rows:
                continue
            k1, k2 = b.column("_k1").to_numpy(zero_copy_only=False), b.column("_k2").to_numpy(zero_copy_only=False)
            for kind in lengths:
                data, offs = _bytes_of(b.column(kind))
                for n in lengths[kind]:
                    for a in range(int(offs[0]), int(offs[-1]), BLOCK):
                        stop = min(a + BLOCK + n - 1, int(offs[-1]))
                        slot = _slots(_windows(data[a:stop], n), n, bits)
                        at = np.flatnonzero(held[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1) + a
                        row = np.searchsorted(offs, at, "right") - 1
                        end = offs[row + 1]
                        inside = at + n <= end
                        at, row, end = at[inside], row[inside], np.minimum(end[inside], at[inside] + longest[kind])
                        found = {(int(r), data[x:y].tobytes()) for r, x, y in zip(row, at, end)}
                        if found:
                            rows, parts = zip(*found)
                            rows = np.array(rows)
                            yield pa.record_batch([pa.array(k1[rows]), pa.array(k2[rows]), pa.array([kind] * len(rows)), pa.array([p[:n] for p in parts], pa.binary()),
                                                   pa.array(parts, pa.binary())], names=["_k1", "_k2", "kind", "key", "part"])

    return run


def mentions(df: DataFrame, text: str, names: DataFrame, name: str, order: str) -> DataFrame:
    """(_k1, _k2, entities) for every text of ``df`` that holds a name: the
    names found as they are (any case), or, if there is none, those found when
    text and name are reduced to their letters and digits; in ``order``. A
    missing name and one without characters (for the second search: without
    letters and digits) are found nowhere."""
    spark = df.sparkSession
    base = names.where(F.col(name).isNotNull()).select(F.col(order).alias("ord"), F.col(name).alias("name"),
                                                       F.lower(name).alias("exact"), norm_key(name).alias("loose"))
    long = base.unpivot(["ord", "name"], ["exact", "loose"], "kind", "pattern").select("ord", "name", "kind", F.encode("pattern", "utf-8").alias("pattern"))
    long = long.where(F.length("pattern") > 0).withColumn("key", F.substring("pattern", 1, _key_length(F.length("pattern"))))
    facts = long.groupBy("kind").agg(F.count("*").alias("n"), F.max(F.length("pattern")).alias("longest"),
                                     F.sort_array(F.collect_set(F.length("key"))).alias("lengths")).collect()
    if not facts:
        return df.select(*_text_key(text), F.array().cast("array<string>").alias("entities")).limit(0)
    # 32 places a name, so that few other windows look like a key
    bits = min(max(16, (32 * sum(r["n"] for r in facts)).bit_length()), MOST_BITS)
    table = bytearray(1 << (bits - 3))
    slots = long.select("key").distinct().mapInArrow(_filed(bits), "slot long")
    pieces = slots.groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"))
    for r in pieces.collect():                # the bit table in pieces of 2^15 bits
        at = (r["b"] - 1) << 12
        table[at: at + len(r["bits"])] = r["bits"][: len(table) - at]
    packed = bytes(table)
    t = df.where(F.col(text).isNotNull()).select(*_text_key(text), F.lower(text).alias("exact"), norm_key(F.lower(text)).alias("loose"))
    kinds = {r["kind"]: r for r in facts}
    scan = _places(packed, bits, {k: r["lengths"] for k, r in kinds.items()}, {k: r["longest"] for k, r in kinds.items()})
    places = t.mapInArrow(scan, "_k1 long, _k2 long, kind string, key binary, part binary")
    hits = places.join(long, ["kind", "key"]).where(F.substring("part", 1, F.length("pattern")) == F.col("pattern"))
    found = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.struct("ord", "name"))))
    g = hits.groupBy("_k1", "_k2").agg(found("exact").alias("e"), found("loose").alias("l"))
    return g.select("_k1", "_k2", F.transform(F.when(F.size("e") > 0, F.col("e")).otherwise(F.col("l")), lambda x: x["name"]).alias("entities"))


def with_mentions(df: DataFrame, text: str, names: DataFrame, name: str, order: str, out: str = "entities") -> DataFrame:
    """``df`` with the array of the names in each text (empty if there are
    none). Texts are joined by their 128-bit keys, so they are not shuffled
    unless ``df`` goes on using them."""
    found = mentions(df, text, names, name, order).withColumnsRenamed({"_k1": "_m1", "_k2": "_m2", "entities": "_entities"})
    k1, k2 = _text_key(text)
    x = df.withColumns({"_k1": k1, "_k2": k2}).join(found, (F.col("_k1") == F.col("_m1")) & (F.col("_k2") == F.col("_m2")), "left")
    return x.withColumn(out, F.coalesce("_entities", F.array().cast("array<string>"))).drop("_k1", "_k2", "_m1", "_m2", "_entities")


# Python workers must not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

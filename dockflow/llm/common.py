"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: lineage ends, every executor sees it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def texts_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text) with empty text for null; other columns, whatever their names, are left out."""
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


FILTER_BITS = 1 << 28
FILTER_SEGMENTS = 64
FILTER_PROBES = 3


def filter_positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, probes) bits of 64-bit hashes; ``bits`` is a power of two."""
    x = hashes.astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        steps = [(x * np.uint64(f)) >> np.uint64(20) for f in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
    return np.stack([(s & np.uint64(bits - 1)).astype(np.int64) for s in steps], axis=1)


def key_filter(hashes: DataFrame, rows: int, max_bits: int = FILTER_BITS) -> tuple[bytes, int]:
    """Bloom filter (bitmap, bits) of a column ``hash``: 16 bits a row, ``max_bits`` (32 MB) at most.

    A fuller filter lets more rows through to the join that follows, which stays exact.
    """
    bits = 1 << 16
    while bits < min(16 * rows, max_bits):
        bits *= 2
    width = bits // FILTER_SEGMENTS

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(filter_positions(batch.column("hash").to_numpy(zero_copy_only=False), bits))
            cut = np.searchsorted(at, np.arange(FILTER_SEGMENTS + 1) * width)
            full = [k for k in range(FILTER_SEGMENTS) if cut[k] < cut[k + 1]]
            parts = [(at[cut[k]:cut[k + 1]] - k * width).astype("<u4").tobytes() for k in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(parts, pa.binary())], names=["segment", "seen"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, seen in zip(*(c.to_pylist() for c in batch.columns)):
                state.setdefault(segment, np.zeros(width, bool))[np.frombuffer(seen, "<u4")] = True
        maps = [np.packbits(m, bitorder="little").tobytes() for m in state.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(state), pa.int32()), pa.array(maps, pa.binary())], names=["segment", "bitmap"])

    sent = hashes.select("hash").mapInArrow(local, "segment int, seen binary")
    parts = sent.repartition(FILTER_SEGMENTS, "segment").mapInArrow(merge, "segment int, bitmap binary").collect()  # max_bits / 8 bytes at most
    bitmap = np.zeros(bits // 8, np.uint8)
    for segment, part in parts:
        bitmap[segment * width // 8:(segment + 1) * width // 8] = np.frombuffer(part, np.uint8)
    return bitmap.tobytes(), bits


def maybe_in(bitmap: bytes, bits: int, hashes: np.ndarray) -> np.ndarray:
    at = filter_positions(hashes, bits)
    return ((np.frombuffer(bitmap, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)

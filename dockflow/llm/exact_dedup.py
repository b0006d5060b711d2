"""Exact dedup by two-pass Bloom filtering.

Pass 1 reads the hash of every text into Bloom filters that remember "seen" and "seen again". A text that occurs twice has
all its bits in "seen again", so a row that misses one bit is unique for certain. Pass 2 lets those rows pass straight through;
only the possibly repeated rest is shuffled and grouped by its full SHA-256, which also clears false positives.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the row with the largest key
stays; a null key ranks below any other, and of rows that tie on the largest key exactly one stays. An empty table gives an
empty result. Other columns pass through untouched, whatever their names.

Memory: the filter has 16 bits a row up to ``max_bits`` (64 MB by default). Beyond that its false positives rise, so more rows are
shuffled; the result stays the same. Bits travel as sorted positions, so what a task sends follows its rows, not the filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.llm.common import LOWER, UPPER, staged

PROBES = 3
BITS_PER_ROW = 16
MAX_BITS = 1 << 29
SEGMENTS = 64
FLUSH_ROWS = 500_000


def text_sha(text: str | None) -> str:
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass").lower()).hexdigest()


def _digests(frame: DataFrame, text: str, sha: str) -> DataFrame:
    """``frame`` with column ``sha``: lower hex SHA-256 of the text after lower-casing A-Z."""
    schema = T.StructType([*frame.schema.fields, T.StructField(sha, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [text_sha(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], names=[*batch.schema.names, sha])

    return frame.mapInArrow(run, schema)


def _positions(shas: list[str], bits: int) -> np.ndarray:
    """(rows, PROBES) bit positions; ``bits`` is a power of two."""
    raw = np.frombuffer(b"".join(bytes.fromhex(s) for s in shas), dtype="<u8").reshape(-1, 4)
    return (raw[:, :PROBES] & np.uint64(bits - 1)).astype(np.int64)


def repeated_filter(digests: DataFrame, rows: int, max_bits: int = MAX_BITS) -> tuple[bytes, int]:
    """Pass 1 over column ``sha``: (bitmap, bits); a text that occurs twice has all its bits set."""
    bits = 1 << 16
    while bits < min(BITS_PER_ROW * rows, max_bits):
        bits *= 2
    width = bits // SEGMENTS

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sightings(shas: list[str]) -> pa.RecordBatch:
            once, counts = np.unique(np.array(shas), return_counts=True)
            at = _positions(once.tolist(), bits)
            seen, again = np.unique(at), np.unique(at[counts > 1])
            cut = np.arange(SEGMENTS + 1) * width
            a, b = np.searchsorted(seen, cut), np.searchsorted(again, cut)
            full = [k for k in range(SEGMENTS) if a[k] < a[k + 1]]
            return pa.RecordBatch.from_pydict({
                "segment": pa.array(full, pa.int32()),
                "seen": pa.array([(seen[a[k]:a[k + 1]] - cut[k]).astype("<u4").tobytes() for k in full], pa.binary()),
                "again": pa.array([(again[b[k]:b[k + 1]] - cut[k]).astype("<u4").tobytes() for k in full], pa.binary()),
            })

        held: list[str] = []
        for batch in batches:
            held += batch.column("sha").to_pylist()
            if len(held) >= FLUSH_ROWS:
                yield sightings(held)
                held = []
        if held:
            yield sightings(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
                if segment not in state:
                    state[segment] = np.zeros(width, bool), np.zeros(width, bool)
                once, twice = state[segment]
                at = np.frombuffer(seen, "<u4")
                twice[at[once[at]]] = True
                once[at] = True
                twice[np.frombuffer(again, "<u4")] = True
        if state:
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(list(state), pa.int32()),
                "bitmap": pa.array([np.packbits(twice, bitorder="little").tobytes() for _, twice in state.values()], pa.binary()),
            })

    sent = digests.select("sha").mapInArrow(local, "segment int, seen binary, again binary")
    parts = sent.repartition(SEGMENTS, "segment").mapInArrow(merge, "segment int, bitmap binary").collect()  # max_bits / 8 bytes at most
    bitmap = np.zeros(bits // 8, np.uint8)
    for segment, part in parts:
        bitmap[segment * width // 8:(segment + 1) * width // 8] = np.frombuffer(part, np.uint8)
    return bitmap.tobytes(), bits


def _marked(shas: list[str], bitmap: bytes, bits: int) -> np.ndarray:
    """Whether all bits of each hash are set."""
    at = _positions(shas, bits)
    return ((np.frombuffer(bitmap, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1) if len(at) else np.zeros(0, bool)


def _probed(frame: DataFrame, sha: str, bitmap: bytes, bits: int, flag: str) -> DataFrame:
    """``frame`` with ``flag``: true where the text is possibly repeated."""
    shared = frame.sparkSession.sparkContext.broadcast(bitmap)
    schema = T.StructType([*frame.schema.fields, T.StructField(flag, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = _marked(batch.column(sha).to_pylist(), shared.value, bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=[*batch.schema.names, flag])

    return frame.mapInArrow(run, schema)


def dedup_ledger(df: DataFrame, text: str = "text", key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    digests = staged(_digests(narrow, "text", "sha").select("doc_id", "sha", F.monotonically_increasing_id().alias("row")), "exact")
    bitmap, bits = repeated_filter(digests, digests.count(), max_bits)
    probed = _probed(digests, "sha", bitmap, bits, "maybe")
    alone = probed.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    rest = probed.where("maybe").select("doc_id", "sha", "row")
    rank = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.col("row").alias("at"))
    groups = rest.groupBy("sha").agg(F.max(rank).alias("best"), F.count("*").alias("group_size"))
    decided = rest.join(groups, "sha").select("doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.at")).alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.unionByName(decided)


def drop_exact(df: DataFrame, text: str = "text", key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` that stay, as they are. Unique rows aren't shuffled; copies meet in a pre-aggregated maximum."""
    sha, flag = "__sha", "__maybe"
    own = df.columns
    at = {c: f"c{k}" for k, c in enumerate(own)}
    plain = F.translate(F.coalesce(F.col(at[text]).cast("string"), F.lit("")), UPPER, LOWER)
    hashed = df.toDF(*at.values()).withColumn(sha, F.sha2(plain, 256))
    bitmap, bits = repeated_filter(hashed.select(F.col(sha).alias("sha")), df.count(), max_bits)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf(T.BooleanType())
    def maybe(shas: pd.Series) -> pd.Series:  # only the hashes go to Python
        return pd.Series(_marked(shas.tolist(), shared.value, bits))

    probed = hashed.withColumn(flag, maybe(sha))
    columns: list[Column] = [F.col(at[c]) for c in own]
    alone = probed.where(~F.col(flag)).select(*columns)
    row = F.struct(*columns)
    rank = F.struct(F.col(at[key]).isNotNull(), F.col(at[key]))
    best = probed.where(flag).groupBy(sha).agg(F.max_by(row, rank).alias("row")).select("row.*")
    return alone.unionByName(best).toDF(*own)

"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes decides the cuts, so an insertion moves only the cuts next to it. Chunks are named by a 128-bit
digest; the first document (least key) that holds a digest keeps it, in later documents it is a repeat. Repeats next to each other whose
bytes add up to ``min_run`` are removed; a lone short chunk that two texts share by chance stays.

The digests are pre-aggregated before they are shuffled, and a frequent digest meets its chunks in a plain join that Spark can split.
Cuts never fall inside a UTF-8 character, so the kept text is valid.

A null text counts as empty: no chunks, empty kept text. Rows with the same key and text are one document and are treated alike; rows with the
same key and different texts are ordered by a hash of the text; a null key ranks before all others. An empty table gives an empty result; other
columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import staged, texts_of

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 24, 512, 5
MIN_RUN = 100


def gear_table() -> np.ndarray:
    """256 mixed 32-bit values from a rule: multiples of an odd constant, mixed by shifts."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(np.uint32)


GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Hash after each byte: sum of gear[b] << age over the last 32 bytes, by doubling the span."""
    h = GEAR[data]
    for span in (1, 2, 4, 8, 16):
        shifted = np.zeros_like(h)
        shifted[span:] = h[:-span] << np.uint32(span) if len(h) > span else 0
        h = h + shifted
    return h


def cuts(body: bytes) -> list[int]:
    """End of each chunk."""
    n = len(body)
    if not n:
        return []
    data = np.frombuffer(body, np.uint8)
    wanted = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    inside = wanted < n
    wanted = wanted[inside & ((data[np.minimum(wanted, n - 1)] & 0xC0) != 0x80)].tolist()
    ends, last = [], 0
    for at in [*wanted, n]:
        while at - last > MAX_CHUNK:
            cut = last + MAX_CHUNK
            while body[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        if at - last >= MIN_CHUNK or at == n and at > last:
            ends.append(at)
            last = at
    return ends


def _keyed(df: DataFrame, text: str, key: str) -> DataFrame:
    rows = texts_of(df, key, text)
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("hash"), "text")


def chunk_table(keyed: DataFrame) -> DataFrame:
    """id, hash, digests and ends: the chunks of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ends = [], []
            for body in batch.column("text").cast(pa.large_binary()).to_pylist():
                own = cuts(body)
                digests.append([hashlib.blake2b(body[a:b], digest_size=16).digest() for a, b in zip([0, *own], own)])
                ends.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("hash"), pa.array(digests, pa.list_(pa.binary())), pa.array(ends, pa.list_(pa.int32()))], names=["id", "hash", "digests", "ends"]
            )

    return keyed.select("id", "hash", "text").mapInArrow(run, "id long, hash long, digests array<binary>, ends array<int>")


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """id, hash, repeats: numbers of the chunks that an earlier document holds."""
    each = chunks.select("id", "hash", F.posexplode("digests").alias("number", "digest"))
    first = each.groupBy("digest").agg(F.min(F.struct("id", "hash")).alias("first"), F.max(F.struct("id", "hash")).alias("last")).where(F.col("first") != F.col("last"))
    late = each.join(first.select("digest", "first"), "digest").where(F.struct("id", "hash") != F.col("first"))
    return late.groupBy("id", "hash").agg(F.collect_set("number").alias("repeats"))


def dedup_chunks(df: DataFrame, text: str = "text", key: str = "doc_id", min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeats, n_removed, n_spans and the kept text: one row per row of ``df``."""
    keyed = _keyed(df, text, key)
    chunks = staged(chunk_table(keyed), "chunks")
    repeats = repeated_chunks(chunks)
    ends = chunks.groupBy("id", "hash").agg(F.first("ends").alias("ends"))
    marked = ends.join(repeats, ["id", "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, own, late in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("ends").to_pylist(), batch.column("repeats").to_pylist()):
                out.append(strip(body, own if own is not None else cuts(body), late or [], min_run))
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int64()] * 5 + [pa.string()])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_chunks", "n_repeats", "n_removed", "n_spans", "text"])

    joined = keyed.join(marked, ["id", "hash"], "left").select("doc_id", "text", "ends", "repeats")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_chunks long, n_repeats long, n_removed long, n_spans long, text string")


def strip(body: bytes, ends: list[int], repeats: list[int], min_run: int) -> tuple[int, int, int, int, int, str]:
    """(bytes, chunks, repeats, bytes removed, runs removed, kept text) of one document."""
    spans: list[list[int]] = []
    for k in sorted(repeats):
        a, b = (ends[k - 1] if k else 0), ends[k]
        if spans and spans[-1][1] == a:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    spans = [s for s in spans if s[1] - s[0] >= min_run]
    kept, at = [], 0
    for a, b in spans:
        kept.append(body[at:a])
        at = b
    kept.append(body[at:])
    return len(body), len(ends), len(repeats), sum(b - a for a, b in spans), len(spans), b"".join(kept).decode("utf-8", "surrogatepass")

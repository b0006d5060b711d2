"""Interaction of five corpus filters in every order they can be applied.

Method: a byte transducer whose transition table, (state, byte class) to (next state, counts), is driven over the UTF-8 bytes of each text once.
It counts capitals, code points and symbols and marks where words start and end; the spans go into a hash table that keeps one span per
different word of a document, a span being taken for a copy only after document, length and all bytes were compared with the table's entry.
As the next state follows from the byte alone, whole slabs of bytes are looked up at once; the state is carried from slab to slab, so a text of any
length is read in slabs of ``SLAB`` bytes. What is kept per text are its word spans.

Each document becomes the set of filters it fails, as five bits. Four of them follow from the text; the fifth (a text with a smaller ``doc_id``
is identical) from the least ``doc_id`` of its SHA-256. Documents are counted per (text, part, labels) first, so a text that fills a third of
the table is one row per task before anything is shuffled by it. 32 counts per part give all 120 orders: no order reads the documents again.

A null text is empty, a null part the empty string. A null ``doc_id`` is neither smaller nor larger than any other. Rows repeated under one
``doc_id`` each count, none as the other's copy. Several labels of one document count as their maximum; a missing or null one as 0.
An empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SLAB = 1 << 20
SLICE = 1 << 22
#: Words longer than this are compared and hashed as a whole, shorter ones eight bytes at a time.
LONG_WORD = 64

SPACE, CAPITAL, SYMBOL, OTHER, CONTINUED = range(5)
BETWEEN, INSIDE = range(2)
FIELD = 21


def byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    table[ord("A"):ord("Z") + 1] = CAPITAL
    table[list(b"#$%&*|")] = SYMBOL
    table[0x80:0xC0] = CONTINUED
    return table


def transitions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Next state per class; counts, word start and word end per (state, class).

    Counts are three fields of ``FIELD`` bits: capitals, code points, symbols; a slab can't overflow them.
    """
    after = np.array([BETWEEN if c == SPACE else INSIDE for c in range(5)], np.uint8)
    counts = np.array([(c == CAPITAL) + ((c != CONTINUED) << FIELD) + ((c == SYMBOL) << 2 * FIELD) for _ in range(2) for c in range(5)], np.int64)
    starts = np.array([s == BETWEEN and after[c] == INSIDE for s in range(2) for c in range(5)])
    ends = np.array([s == INSIDE and after[c] == BETWEEN for s in range(2) for c in range(5)])
    return after, counts, starts, ends


CLASSES = byte_classes()
AFTER, COUNTS, STARTS, ENDS = transitions()
MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def transduce(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts per text, 3 columns), word starts and word ends of the texts ``data[cuts[k]:cuts[k + 1]]``."""
    counts = np.zeros((len(cuts) - 1, 3), np.int64)
    starts, ends, carried = [], [], BETWEEN
    for low in range(0, int(cuts[-1]), SLAB):
        high = min(low + SLAB, int(cuts[-1]))
        classes = CLASSES[data[low:high]]
        after = AFTER[classes]
        state = np.empty_like(after)
        state[0], state[1:] = carried, after[:-1]
        first, last = np.searchsorted(cuts, low, "left"), np.searchsorted(cuts, high, "left")
        state[cuts[first:last] - low] = BETWEEN
        carried = after[-1]
        step = state * np.uint8(5) + classes
        starts.append(np.flatnonzero(STARTS[step]) + low)
        closed = np.zeros(high - low + 1, bool)
        closed[:-1] = ENDS[step]
        ending = cuts[np.searchsorted(cuts, low, "right"):np.searchsorted(cuts, high, "right")] - low
        ending = ending[after[ending - 1] == INSIDE]
        closed[ending] = True
        ends.append(np.flatnonzero(closed) + low)
        # A text's share of this slab lies between the cuts clipped to the slab.
        texts = np.arange(max(np.searchsorted(cuts, low, "right") - 1, 0), last)
        sums = np.concatenate([[0], np.cumsum(COUNTS[step])])
        part = sums[np.clip(cuts[texts + 1], low, high) - low] - sums[np.clip(cuts[texts], low, high) - low]
        for k in range(3):
            counts[texts, k] += part >> k * FIELD & (1 << FIELD) - 1
    none = np.zeros(0, np.int64)
    return counts, np.concatenate([none, *starts]), np.concatenate([none, *ends])


class Words:
    """Word spans of several texts; ``data`` has eight spare bytes at its end."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, texts: np.ndarray):
        self.data, self.starts, self.sizes, self.texts = data, starts, sizes, texts
        self.eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        self.heads = self.load(np.arange(len(starts)), 0)

    def load(self, words: np.ndarray, at: int) -> np.ndarray:
        """Up to eight bytes of each word from its byte ``at`` on, as numbers."""
        return self.eights[self.starts[words] + at] & MASKS[np.minimum(self.sizes[words] - at, 8)]

    def bytes_of(self, word: int) -> bytes:
        return self.data[self.starts[word]:self.starts[word] + self.sizes[word]].tobytes()

    def hashes(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.heads ^ (self.texts.astype(np.uint64) << np.uint64(40)) ^ self.sizes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            words, at = np.flatnonzero((self.sizes > 8) & (self.sizes <= LONG_WORD)), 8
            while words.size:
                h[words] = (h[words] ^ self.load(words, at)) * np.uint64(0xBF58476D1CE4E5B9)
                h[words] ^= h[words] >> np.uint64(31)
                at += 8
                words = words[self.sizes[words] > at]
            for word in np.flatnonzero(self.sizes > LONG_WORD):
                h[word] ^= np.uint64(xxhash.xxh3_64_intdigest(self.bytes_of(word)))
            return h ^ h >> np.uint64(32)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        equal = (self.texts[a] == self.texts[b]) & (self.sizes[a] == self.sizes[b]) & (self.heads[a] == self.heads[b])
        open_, at = np.flatnonzero(equal & (self.sizes[a] > 8) & (a != b)), 8
        while open_.size and at < LONG_WORD:
            ok = self.load(a[open_], at) == self.load(b[open_], at)
            equal[open_[~ok]] = False
            at += 8
            open_ = open_[ok & (self.sizes[a[open_]] > at)]
        for k in open_:
            equal[k] = self.bytes_of(a[k]) == self.bytes_of(b[k])
        return equal

    def distinct(self) -> np.ndarray:
        """Words that entered the hash table, one of each kind in its text."""
        room = 1 << max(int(2 * len(self.starts)).bit_length(), 4)
        table, slots = np.full(room, -1, np.int64), (self.hashes() & np.uint64(room - 1)).astype(np.int64)
        waiting, entered = np.arange(len(self.starts)), []
        while waiting.size:
            at = slots[waiting]
            free = table[at] < 0
            table[at[free]] = waiting[free]
            holder = table[at]
            entered.append(waiting[holder == waiting])
            waiting = waiting[~self.same(waiting, holder)]
            slots[waiting] = slots[waiting] + 1 & room - 1
        return np.concatenate([np.zeros(0, np.int64), *entered])


def measure_texts(texts: pa.StringArray) -> np.ndarray:
    """Rows of words, different words, capitals, code points, symbols; one column per text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.zeros(size + 8, np.uint8)
    if size:
        data[:size] = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    cuts = offsets - offsets[0]
    counts, starts, ends = transduce(data, cuts)
    of = np.searchsorted(cuts, starts, "right") - 1
    different = Words(data, starts, ends - starts, of).distinct()
    n = len(texts)
    return np.stack([np.bincount(of, minlength=n), np.bincount(of[different], minlength=n), *counts.T])


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of ``SLICE`` bytes together, or of one longer text."""
    low, held = 0, 0
    for k, size in enumerate(sizes):
        if k > low and held + size > SLICE:
            yield low, k
            low, held = k, 0
        held += size
    if low < len(sizes):
        yield low, len(sizes)


MEASURES = ("n_words", "n_different", "n_capitals", "n_chars", "n_symbols")


def measured(df: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """doc_id, part, SHA-256 of the text and its measures, per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for low, high in slices(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)):
                rows = batch.slice(low, high - low)
                found = measure_texts(texts.slice(low, high - low))
                kept = [rows.column(c) for c in ("doc_id", "part", "digest")]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, found)], names=["doc_id", "part", "digest", *MEASURES])

    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), body.alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, " + ", ".join(f"{m} long" for m in MEASURES))


def text_failures() -> Column:
    """Bits of the filters A to D over the measures."""
    failed = [
        F.col("n_words") < 200,
        100 * F.col("n_different") < 50 * F.col("n_words"),
        100 * F.col("n_capitals") > 3 * F.col("n_chars"),
        F.col("n_symbols") > 0,
    ]
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed)), F.lit(0))


def failure_counts(df: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits), good, toxic, n: documents by the filters they fail and their labels."""
    rows = measured(df).select("doc_id", "part", "digest", text_failures().alias("bits"))
    rows = rows.groupBy("doc_id", "part", "digest", "bits").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    groups = rows.groupBy("digest", "bits", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unnumbered"))
    # A text has one group per part and pair of labels by now.
    owner = F.min("least").over(W.partitionBy("digest"))
    first = F.col("n_unnumbered") + F.when(F.col("least") == owner, F.col("n_least")).otherwise(0)
    split = groups.withColumn("first", first).select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("bits").alias("failed"), F.col("first").alias("n")),
        F.struct((F.col("bits") + (1 << FILTERS.index("E"))).alias("failed"), (F.col("n") - F.col("first")).alias("n")))).alias("x"))
    return split.select("part", "good", "toxic", "x.*").where("n > 0").groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def order_report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts per set of failed filters (128 per part at most)."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "good", "toxic", "n")).alias("sets"))
    orders = parts.select("*", F.explode(F.lit(ORDERS)).alias("filter_order"))
    rows = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bits = lambda letters: F.aggregate(
        F.transform(F.lit(list(FILTERS)), lambda f, k: F.when(F.contains(letters, f), F.pow(F.lit(2), k).cast("int")).otherwise(0)), F.lit(0), lambda a, x: a + x)
    rows = rows.withColumns({"own": bits(F.expr("substring(filter_order, step, 1)")), "before": bits(F.expr("substring(filter_order, 1, step - 1)"))})

    def total(wanted, value=lambda x: x["n"]) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda a, x: a + F.when(wanted(x), value(x)).otherwise(0))

    own, before = F.col("own"), F.col("before")
    fails = lambda x: x["failed"].bitwiseAND(own) != 0
    removed = lambda x: fails(x) & (x["failed"].bitwiseAND(before) == 0)
    # A document is removed by one of the k filters it fails in 120 / k of the orders.
    orders_won = lambda x: (x["n"] * len(ORDERS) / F.bit_count(x["failed"])).cast("long")
    return rows.select(
        "part", "filter_order", "step",
        total(lambda x: x["failed"].bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda x: fails(x) & ~removed(x)).alias("redundant"),
        total(lambda x: x["failed"] == own).alias("unique_fails"),
        total(lambda x: removed(x) & x["good"]).alias("good_lost"),
        total(lambda x: removed(x) & x["toxic"]).alias("toxic_lost"),
        total(fails, orders_won).alias("shapley"),
    )


def audit(df: DataFrame, labels: DataFrame) -> DataFrame:
    return order_report(failure_counts(df, labels))

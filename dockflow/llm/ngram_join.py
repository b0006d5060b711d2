"""N-gram Jaccard join by MinHash banding.

A text is the set of its five-word shingles (lower case A-Z, words between ASCII white space; a shorter text is one shingle). Equal sets form one
class, so copies cost one row. Band and row counts follow from the target recall at the threshold: the most rows per band whose bands fit
``MAX_HASHES`` (24 bands of 5 rows for 0.9999 at 0.8). Classes are shuffled on their band hashes; inside a bucket signatures only say who could be alike
(estimate not more than six standard errors below the threshold), and a bucket sends on a spanning forest, never its pairs. Each component of these
links is then verified on the full shingle sets, in blocks, each set sent once per block pair; a verification task counts links and
sends one link per member at most. Counts are exact for all pairs of a component.

Result: one row per row of the input with its class (least doc_id of its group of verified links) and its number of links (other rows with
Jaccard ``threshold`` or more, copies included).

Texts without a word (null, empty) equal each other. Repeated rows are copies. Rows with a null key belong to groups like others; a group of null keys alone has
class null. An empty table gives an empty result; other columns pass through ``drop_near`` untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import key_filter, maybe_in, staged, texts_of
from dockflow.llm.graph import components

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BUCKET_BLOCK = 512
VERIFY_BLOCK = 128
SLICE_BYTES = 1 << 20
MAX_WORDS = 50_000
_U = np.uint64


def bands_for(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding within ``most`` hashes that finds a pair at the threshold with the recall."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def multipliers(n: int) -> np.ndarray:
    """Odd 64-bit multipliers by a rule."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        return (x ^ (x >> _U(27))) | _U(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


HASHES = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def gram_sets(bodies: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [b.lower().split() for b in bodies]
    sizes = np.array([len(w) for w in words])
    flat = np.fromiter((h for w in words for h in map(HASHES.__getitem__, w)), _U, int(sizes.sum()))
    rolled = np.zeros(max(0, len(flat) - GRAM + 1), _U)
    for k in range(GRAM):
        rolled = rolled * _U(0x100000001B3) + flat[k:k + len(rolled)]
    rolled = mixed(rolled)
    sets, at = [], 0
    for n in sizes.tolist():
        if n >= GRAM:
            sets.append(np.unique(rolled[at:at + n - GRAM + 1]))
        elif n:
            short = _U(n)
            for h in flat[at:at + n]:
                short = short * _U(0x100000001B3) + h
            sets.append(mixed(np.array([short], _U)))
        else:
            sets.append(np.zeros(0, _U))
        at += n
    return sets


def signatures(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """(texts, hashes) minima; an empty set has the largest value throughout."""
    out = np.full((len(sets), len(factors)), 0xFFFFFFFF, np.uint32)
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[k] for k in full])
        starts = np.cumsum([0, *[len(sets[k]) for k in full[:-1]]])
        for j, a in enumerate(factors):
            out[full, j] = np.minimum.reduceat(((flat * a) >> _U(32)).astype(np.uint32), starts)
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch of about SLICE_BYTES of text each, with their texts."""
    sizes = pc.binary_length(batch.column("text")).to_pylist()
    at = size = 0
    for k, n in enumerate(sizes):
        size += n
        if size >= SLICE_BYTES or k == len(sizes) - 1:
            part = batch.slice(at, k + 1 - at)
            yield part, part.column("text").cast(pa.large_binary()).to_pylist()
            at, size = k + 1, 0


def signed(keyed: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, id, hash, grams (digest of the set), signature and band keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(bands * rows)
        salt = multipliers(bands)
        with np.errstate(over="ignore"):
            for batch in batches:
                for part, bodies in _slices(batch):
                    sets = gram_sets(bodies)
                    signs = signatures(sets, factors)
                    keys = np.zeros((len(sets), bands), _U) + salt
                    for r in range(rows):
                        keys = mixed(keys + signs[:, r::rows].astype(_U) + _U(1))
                    yield pa.RecordBatch.from_arrays([
                        *(part.column(c) for c in ("doc_id", "id", "hash")),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in signs], pa.binary()),
                        pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64())),
                    ], names=["doc_id", "id", "hash", "grams", "signature", "bands"])

    return keyed.mapInArrow(run, "doc_id long, id long, hash long, grams binary, signature binary, bands array<long>")


def _block_pairs(members: DataFrame, group: str, n: str, block: int) -> DataFrame:
    """Members spread over the pairs (i, j), i <= j, of the blocks of their group; ``own`` is a member's block."""
    blocks = F.ceil(F.col(n) / block).cast("int")
    own = members.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return own.select("*", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})


def plausible_links(classes: DataFrame, hashes: int, threshold: float) -> DataFrame:
    """a, b: spanning forests of the pairs in a bucket that signatures don't rule out."""
    least = math.floor(hashes * (threshold - 6 * math.sqrt(threshold * (1 - threshold) / hashes)))
    each = classes.select("node", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = each.join(shared, "band").join(classes.select("node", "signature"), "node")
    groups = _block_pairs(members, "band", "n", BUCKET_BLOCK).groupBy("band", "i", "j").agg(F.collect_list(F.struct("node", "signature")).alias("m")).where(F.size("m") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for m in batch.column("m"):
                nodes = m.values.field("node").to_numpy()
                signs = np.frombuffer(b"".join(m.values.field("signature").to_pylist()), np.uint32).reshape(len(nodes), hashes)
                for x, found in forest(len(nodes), lambda x, rest: (signs[rest] == signs[x]).sum(axis=1) >= least):
                    left += [int(nodes[x])] * len(found)
                    right += nodes[found].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return groups.select("m").mapInArrow(run, "a long, b long").distinct()


def forest(n: int, linked) -> Iterator[tuple[int, np.ndarray]]:
    """(node, new neighbours) of a breadth-first walk; ``linked(x, rest)`` tells which of ``rest`` are neighbours of ``x``."""
    rest = np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = linked(x, rest)
            found, rest = rest[hit], rest[~hit]
            if len(found):
                yield x, found
                queue += found.tolist()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, over the shingles that two sets share, some thousand columns at a time."""
    n = len(sets)
    counts = np.zeros((n, n), np.float64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    dense = np.cumsum(often > 1) - 1
    shared = often[column] > 1
    owner, column = owner[shared], dense[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        counts += part @ part.T
    return counts


def verified(keyed: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """node, links, parent: per block pair the rows each member is linked to, and a spanning forest."""
    bitmap, bits = key_filter(members, members.count())
    shared = keyed.sparkSession.sparkContext.broadcast(bitmap)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                wanted = batch.filter(pa.array(maybe_in(shared.value, bits, batch.column("hash").to_numpy(zero_copy_only=False))))
                for part, bodies in _slices(wanted):
                    got = [s.tobytes() for s in gram_sets(bodies)]
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("hash"), pa.array(got, pa.binary())], names=["id", "hash", "grams"])

    found = keyed.select("id", "hash", "text").mapInArrow(sets, "id long, hash long, grams binary")
    grams = found.join(members.select("id", "hash", "node"), ["id", "hash"]).groupBy("node").agg(F.first("grams").alias("grams"))
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    whole = members.select("node", "size", "component").join(sizes, "component").join(grams, "node")
    groups = _block_pairs(whole, "component", "n", VERIFY_BLOCK).groupBy("component", "i", "j").agg(F.collect_list(F.struct("node", "size", "own", "grams")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, j, m in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("m")):
                node, weight, own = (m.values.field(c).to_numpy() for c in ("node", "size", "own"))
                sets = [np.frombuffer(x, _U) for x in m.values.field("grams").to_pylist()]
                inter = overlaps(sets)
                size = np.array([len(s) for s in sets], np.float64)
                union = size[:, None] + size[None, :] - inter
                link = (inter >= threshold * union - 1e-9) & (union > 0)
                np.fill_diagonal(link, False)
                if i != j:
                    link &= own[:, None] != own[None, :]
                links = link @ weight
                parent: list[int | None] = [None] * len(sets)
                for x, found in forest(len(sets), lambda x, rest: link[x, rest]):
                    for k in found.tolist():
                        parent[k] = int(node[x])
                out += [(x, int(n), p) for x, n, p in zip(node.tolist(), links.tolist(), parent) if n]
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "parent"])

    return groups.mapInArrow(run, "node long, links long, parent long")


def near_ledger(df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, id, hash, class_id, n_links and ``least`` (true for one text of each group): one row per row of ``df``."""
    bands, rows = bands_for(threshold, recall)
    keyed = texts_of(df, key, text).select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("hash"), "text")
    signs = staged(signed(keyed, bands, rows), "signatures")
    classes = signs.groupBy("grams").agg(
        F.min(F.struct("id", "hash")).alias("first"), F.min("doc_id").alias("least"), F.count("*").alias("size"), F.first("signature").alias("signature"), F.first("bands").alias("bands"),
    )
    classes = staged(classes.select(F.monotonically_increasing_id().alias("node"), "grams", "first", "least", "size", "signature", "bands"), "classes")
    possible = components(plausible_links(classes, bands * rows, threshold))
    members = staged(classes.join(possible, "node").select("node", "component", "size", F.col("first.id").alias("id"), F.col("first.hash").alias("hash")), "members")
    links = staged(verified(keyed, members, threshold), "links")
    groups = components(links.where("parent is not null").select(F.col("node").alias("a"), F.col("parent").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = classes.select("node", "grams", "first", "least", "size").join(groups, "node", "left").join(counts, "node", "left")
    nodes = nodes.select("grams", "least", "first", F.coalesce("component", "node").alias("group"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    heads = nodes.groupBy("group").agg(F.min("least").alias("class_id"), F.min("first").alias("head"))
    placed = nodes.join(heads, "group").select("grams", "class_id", "head", "n_links")
    return signs.select("doc_id", "id", "hash", "grams").join(placed, "grams").select("doc_id", "id", "hash", "class_id", "n_links", (F.struct("id", "hash") == F.col("head")).alias("least"))


def near_join(df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links: one row per row of ``df``."""
    return near_ledger(df, text, key, threshold, recall).select("doc_id", "class_id", "n_links")


def drop_near(df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The row with the least key of each group, as it is."""
    own = df.columns
    at = {c: f"c{k}" for k, c in enumerate(own)}
    rows = df.toDF(*at.values())
    rows = rows.withColumns({"__id": F.coalesce(F.col(at[key]).cast("long"), F.lit(-(1 << 63))), "__hash": F.xxhash64(F.coalesce(F.col(at[text]).cast("string"), F.lit("")))})
    stay = near_ledger(df, text, key, threshold).where("least").select(F.col("id").alias("__id"), F.col("hash").alias("__hash"))
    return rows.join(stay.distinct(), ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"]).select(*at.values()).toDF(*own)

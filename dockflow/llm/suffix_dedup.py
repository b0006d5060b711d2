"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in an earlier document are removed.

Windows of ``WINDOW`` bytes are dealt out by their minimiser, the least hash of the ``SEED``-byte strings inside: equal windows have equal
minimisers, so they meet. Neighbouring windows with one minimiser form a stretch, named by a hash of its bytes.
1. Texts are packed into slices of some megabytes, written once in buckets by slice, so later steps meet them without moving them again.
2. Every slice sends each of its minimisers once, in 13 bytes (part of the minimiser, stretch name of 64 bits), with the least document that has it. A shard
   answers where another document has it too: with that owner where all stretches are the same, else that they differ. A minimiser in a
   third of all documents thus costs one entry a slice.
3. Where stretches differ, their bytes are pre-aggregated by name and each minimiser's different stretches get one suffix array, but for those that
   agree with no other one in enough bytes around the seed to share a window. The seed, once in each, is one symbol there. Suffixes are
   grouped by their Lyndon prefix, groups are processed in descending order with previous-smaller pointers, then each group's order is emitted
   from left to right, without recursive renaming. Suffixes with equal first 50 bytes stand together; the earliest document of each such run
   owns it. Beyond ``MAX_STRINGS`` stretches of one minimiser the windows themselves are grouped, by a pre-aggregated shuffle.
4. Spans go back to the slices, are merged and cut out.

Order is by key. Rows with the same key are one document and don't remove each other's bytes; a null key ranks first. A null or empty text has
no bytes. An empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import staged, texts_of
from dockflow.session import scratch_path, shuffle_width

WINDOW, SEED = 50, 24
SPAN = WINDOW - SEED + 1
MAX_RUN = 200
MAX_STRINGS = 4000
SLICE_BYTES = 1 << 21
#: Bytes before and after the seed: whatever window two strings share, they share the seed with one of these.
AROUND = [(k, max(SPAN - 1 - (k + 3), 0)) for k in range(0, SPAN, 4)]
NO_KEY = -(1 << 63)
DIFFER = NO_KEY
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_P_INVERSE = _U(pow(int(_P), -1, 1 << 64))


def _table() -> np.ndarray:
    """256 mixed 64-bit values by a rule."""
    with np.errstate(over="ignore"):
        x = np.arange(1, 257, dtype=_U) * _P
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U(31))


BYTE = _table()


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the seed that starts at each byte, by doubling."""
    with np.errstate(over="ignore"):
        h1 = BYTE[data]
        h2 = h1[:-1] * _P + h1[1:]
        p2 = _P * _P
        h4 = h2[:-2] * p2 + h2[2:]
        p4 = p2 * p2
        h8 = h4[:-4] * p4 + h4[4:]
        p8 = p4 * p4
        h16 = h8[:-8] * p8 + h8[8:]
        h = h16[:len(data) - SEED + 1] * p8 + h8[16:]
        h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
        return h ^ (h >> _U(29))


def minimisers(data: np.ndarray) -> np.ndarray:
    """Least seed hash of every window; minima by doubling."""
    h = seed_hashes(data)
    size = 1
    while 2 * size <= SPAN:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (SPAN - size)], h[SPAN - size:])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[_U(1)], np.full(n, base, _U)]))


class Stretches:
    """All stretches of a slice: owner (number of the document), at (in the blob), n (windows), least (minimiser), name."""

    def __init__(self, blob: bytes, sizes: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        self.begin = ends - sizes
        empty = np.zeros(0, np.int64)
        self.owner, self.at, self.n, self.least, self.name = empty, empty, empty, empty.astype(_U), empty.astype(_U)
        if len(blob) < WINDOW or not (sizes >= WINDOW).any():
            return
        data = np.frombuffer(blob, np.uint8)
        with np.errstate(over="ignore"):
            least = minimisers(data)
            inside = np.zeros(len(least) + 1, np.int8)
            full = sizes >= WINDOW
            np.add.at(inside, self.begin[full], 1)
            np.add.at(inside, ends[full] - WINDOW + 1, -1)
            valid = np.cumsum(inside[:-1]) > 0
            first = valid.copy()
            first[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
            first[self.begin[full]] = True
            starts = np.flatnonzero(first)
            owner = np.searchsorted(ends, starts, side="right")
            stop = np.minimum(np.append(starts[1:], len(least)), ends[owner] - WINDOW + 1)
            parts = -((starts - stop) // MAX_RUN)
            if (parts > 1).any():
                before = np.cumsum(parts) - parts
                starts = np.repeat(starts, parts) + MAX_RUN * (np.arange(parts.sum()) - np.repeat(before, parts))
                owner = np.searchsorted(ends, starts, side="right")
                stop = np.minimum(np.append(starts[1:], len(least)), ends[owner] - WINDOW + 1)
            sums = np.concatenate([[_U(0)], np.cumsum(BYTE[data] * powers(_P_INVERSE, len(data) - 1))])
            size = stop - starts + WINDOW - 1
            value = (sums[starts + size] - sums[starts]) * powers(_P, len(data))[starts]
            self.name = mixed(value + size.astype(_U))
        self.owner, self.at, self.n, self.least = owner, starts, stop - starts, least[starts]


def codes(least: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 32 further bits of each minimiser: enough to tell shared ones from others, with few false alarms."""
    return ((least % _U(shards)) << _U(32)) | ((least // _U(shards)) & _U(0xFFFFFFFF))


def _by_code(code: np.ndarray, name: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per code: (code, entry with the least key, entries, least and greatest key, whether names differ), codes ascending."""
    order = np.lexsort((key, code))
    code, name, key = code[order], name[order], key[order]
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(code)) if len(code) else starts
    differ = np.maximum.reduceat(name, starts) != np.minimum.reduceat(name, starts) if len(code) else np.zeros(0, bool)
    return code[starts], order[starts], key[starts], key[ends - 1], differ


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def sliced(rows: DataFrame, buckets: int) -> DataFrame:
    """Texts in slices: slice, doc_ids, sizes, blob; a table in buckets by slice below the shared folder."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, bodies = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()
            at = size = 0
            for k, body in enumerate(bodies):
                size += len(body)
                if size >= SLICE_BYTES or k == len(bodies) - 1:
                    blob = b"".join(bodies[at:k + 1])
                    name = xxhash.xxh3_64_intdigest(repr(ids[at:k + 1]).encode() + blob) - (1 << 63)
                    yield _batch({
                        "slice": ([name], pa.int64()), "doc_ids": ([ids[at:k + 1]], pa.list_(pa.int64())),
                        "sizes": ([[len(b) for b in bodies[at:k + 1]]], pa.list_(pa.int64())), "blob": ([squeeze.compress(blob)], pa.binary()),
                    })
                    at, size = k + 1, 0

    path = scratch_path(rows.sparkSession, "slices")
    table = "slices_" + path.rsplit("-", 1)[-1]
    packed = rows.mapInArrow(pack, "slice long, doc_ids array<long>, sizes array<long>, blob binary")
    packed.repartition(buckets, "slice").write.bucketBy(buckets, "slice").option("path", path).saveAsTable(table)
    return rows.sparkSession.table(table)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, bytes]]:
    for name, ids, sizes, blob in zip(*(batch.column(c).to_pylist() for c in ("slice", "doc_ids", "sizes", "blob"))):
        yield name, ids, np.array([NO_KEY if i is None else i for i in ids], np.int64), np.array(sizes, np.int64), zstandard.ZstdDecompressor().decompress(blob)


#: Of a slice's entry: one document and stretch, one document with different stretches, several documents with one stretch, with different ones.
ALONE, WITHIN, MORE, MIXED = 0, 1, 2, 3


def shared_minimisers(slices: DataFrame, shards: int) -> DataFrame:
    """slice, codes, owners: the minimisers of a slice that another document has too, with the owner where all stretches are the same."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, _, keys, sizes, blob in _opened(batch):
                s = Stretches(blob, sizes)
                code, first, low, high, differ = _by_code(codes(s.least, shards), s.name, keys[s.owner])
                flag = np.where(differ, np.where(low != high, MIXED, WITHIN), np.where(low != high, MORE, ALONE)).astype(np.uint8)
                cut = np.searchsorted(code >> _U(32), np.arange(shards + 1))
                out: list[tuple] = []
                for k in range(shards):
                    part = slice(cut[k], cut[k + 1])
                    if cut[k] < cut[k + 1]:
                        order = np.argsort(low[part], kind="stable")
                        docs, counts = np.unique(low[part], return_counts=True)
                        stretch = s.name[first[part]][order].astype("<u8")
                        out.append((k, name, docs.tobytes(), counts.astype("<u4").tobytes(), code[part][order].astype("<u4").tobytes(), stretch.tobytes(), flag[part][order].tobytes()))
                columns = zip(*out) if out else [()] * 7
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
                yield _batch(dict(zip(("shard", "slice", "keys", "counts", "codes", "names", "flags"), zip(columns, kinds))))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for shard, name, keys, counts, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                key = np.repeat(np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<u4"))
                held.setdefault(shard, []).append((name, key, *(np.frombuffer(x, t) for x, t in zip(rest, ("<u4", "<u8", "u1")))))
        for shard, rows in held.items():
            key, code, name, flag = (np.concatenate([r[k] for r in rows]) for k in (1, 2, 3, 4))
            once, _, low, high, differ = _by_code(code, name, key)
            where = np.searchsorted(once, code)
            most = np.zeros(len(once), np.uint8)
            np.maximum.at(most, where, flag)
            # The name sent stands for one stretch only where a slice has no other.
            unlike = differ | (np.bincount(where[(flag == WITHIN) | (flag == MIXED)], minlength=len(once)) > 0)
            shared = (low != high) | (most >= MORE)
            owner = np.where(unlike, DIFFER, low)
            # A slice that has mixed stretches knows it; the owner's own slice needs no answer unless others there have the stretch too.
            asks = shared[where] & (flag != MIXED) & ((owner[where] == DIFFER) | (flag == MORE) | (key != low[where]))
            at, out = 0, []
            for r in rows:
                hit = np.flatnonzero(asks[at:at + len(r[1])])
                if len(hit):
                    out.append((r[0], (r[2][hit].astype(_U) | (_U(shard) << _U(32))).tobytes(), owner[where[at + hit]].tobytes()))
                at += len(r[1])
            columns = zip(*out) if out else [()] * 3
            yield _batch(dict(zip(("slice", "codes", "owners"), zip(columns, (pa.int64(), pa.binary(), pa.binary())))))

    sent = slices.mapInArrow(send, "shard int, slice long, keys binary, counts binary, codes binary, names binary, flags binary")
    return sent.repartition(shards, "shard").mapInArrow(answer, "slice long, codes binary, owners binary")


FOUND = "slice long, doc int, id long, at int, minimiser long, name long, string binary, spans binary"


def found_stretches(slices: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """Two kinds of rows: the spans of a slice whose owner is known, packed, and single stretches whose minimiser has different ones."""
    lists = shared.groupBy("slice").agg(F.collect_list(F.struct("codes", "owners")).alias("lists"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        names = ("slice", "doc", "id", "at", "minimiser", "name", "string", "spans")
        for batch in batches:
            for (name, _, keys, sizes, blob), answers in zip(_opened(batch), batch.column("lists").to_pylist()):
                s = Stretches(blob, sizes)
                code, key = codes(s.least, shards), keys[s.owner]
                known = np.frombuffer(b"".join(x["codes"] for x in answers or []), "<u8")
                owner = np.frombuffer(b"".join(x["owners"] for x in answers or []), "<i8")
                order = np.argsort(known, kind="stable")
                known, owner = known[order], owner[order]
                once, _, low, high, differ = _by_code(code, s.name, key)
                own_mixed = (differ & (low != high))[np.searchsorted(once, code)]
                at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
                hit = (known[at] == code) if len(known) else np.zeros(len(code), bool)
                has = np.where(hit, owner[at] if len(known) else 0, 0)
                apart = own_mixed | (hit & (has == DIFFER))
                late = np.flatnonzero(hit & ~apart & (key > has))
                start = s.at - s.begin[s.owner]
                if len(late):
                    spans = np.stack([s.owner[late], start[late], start[late] + s.n[late] - 1 + WINDOW]).astype("<u4").tobytes()
                    yield _batch(dict(zip(names, zip(([name], *[[None]] * 6, [spans]), kinds))))
                own = np.flatnonzero(apart)
                if len(own):
                    ends = s.at[own] + s.n[own] + WINDOW - 1
                    strings = [blob[a:b] for a, b in zip(s.at[own].tolist(), ends.tolist())]
                    columns = (
                        np.full(len(own), name), s.owner[own].astype(np.int32), key[own], start[own].astype(np.int32),
                        s.least[own].view(np.int64), s.name[own].view(np.int64), strings, [None] * len(own),
                    )
                    yield _batch(dict(zip(names, zip(columns, kinds))))

    return slices.join(lists, "slice", "left").mapInArrow(run, FOUND)


def suffix_array(text: Sequence[int]) -> list[int]:
    """Suffixes of ``text`` in order: grouped by Lyndon prefix, then each group's order is emitted from left to right."""
    n = len(text)
    rank = {c: k for k, c in enumerate(sorted(set(text)))}
    group = [rank[c] for c in text]  # the number of a group is a name; `below` and `above` give the order
    fresh = len(rank)
    members: list[set[int]] = [set() for _ in rank]
    for i, g in enumerate(group):
        members[g].add(i)
    below = [*range(-1, fresh - 1), *[-1] * n]
    above = [*range(1, fresh + 1), *[-1] * n]
    done, previous, order = bytearray(n), [-1] * n, []
    current = fresh - 1

    def split(g: int, those: set[int]) -> int:
        """A new group of some members of ``g``, right above it."""
        members[g] -= those
        members.append(those)
        new = len(members) - 1
        over = above[g]
        below[over], above[new], below[new], above[g] = new, over, g, new
        for p in those:
            group[p] = new
        return new

    while current != -1:
        order.append(current)
        own = members[current]
        if len(own) == 1:
            (i,) = own
            done[i] = 1
            p = i - 1
            while p >= 0 and done[p]:  # suffixes of this group or a higher one are not smaller
                p = previous[p]
            previous[i] = p
            if p >= 0 and len(members[group[p]]) > 1:
                split(group[p], {p})
        else:
            counts: dict[int, int] = {}
            for i in sorted(own):
                done[i] = 1
                p = i - 1
                while p >= 0 and done[p]:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    counts[p] = counts.get(p, 0) + 1
            moved: dict[tuple[int, int], set[int]] = {}
            for p, c in counts.items():
                moved.setdefault((group[p], c), set()).add(p)
            for g, c in sorted(moved, reverse=True):  # more repeats go higher
                if len(moved[g, c]) < len(members[g]):
                    split(g, moved[g, c])
        current = below[current]
    start, at = [0] * len(members), 0
    for g in reversed(order):
        start[g] = at
        at += len(members[g])
    array, placed = [0] * n, bytearray(n)
    for k in range(-1, n):
        p = (array[k] if k >= 0 else n) - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            array[start[g]] = p
            start[g] += 1
            placed[p] = 1
            p = previous[p]
    return array


def seed_places(strings: list[bytes], least: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per string the place of its seed, -1 unless every string of its group has its own once, and whether it may share a window with another one.

    A window holds its seed and ``SPAN - 1`` bytes around it, so strings that share one agree in the seed with the bytes of one of ``AROUND``.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(strings), np.uint8)
    number = np.repeat(np.arange(len(strings)), sizes)[:len(data) - SEED + 1]
    spots = np.flatnonzero(seed_hashes(data) == least[number])
    own = number[spots]
    inside = spots + SEED <= (begin + sizes)[own]
    spots, own = spots[inside], own[inside]
    once = np.bincount(own, minlength=len(strings)) == 1
    place = np.full(len(strings), -1, np.int64)
    place[own] = spots - begin[own]
    unsure = np.zeros(group.max() + 1, bool)
    unsure[group[~once]] = True
    unsure = unsure[group]
    place[unsure] = -1
    may = unsure.copy()
    with np.errstate(over="ignore"):
        sums = np.concatenate([[_U(0)], np.cumsum(BYTE[data] * powers(_P_INVERSE, len(data) - 1))])
        scale = powers(_P, len(data))
        for before, after in AROUND:
            there = np.flatnonzero(~unsure & (place >= before) & (place + SEED + after <= sizes))
            at = begin[there] + place[there] - before
            value = mixed((sums[at + before + SEED + after] - sums[at]) * scale[at] + group[there].astype(_U) * _U(0xD6E8FEB86659FD93))
            _, which, n = np.unique(value, return_inverse=True, return_counts=True)
            may[there[n[which] > 1]] = True
    return place, may


def group_owners(minimisers: list[int], groups: list[list[bytes]], owners: list[list[int]]) -> list[list[list[tuple[int, int, int]]]]:
    """For each minimiser the ranges of its strings, as ``window_owners`` gives them; strings that can't share a window aren't sorted."""
    if not groups:
        return []
    counts = [len(g) for g in groups]
    least = np.repeat(np.array(minimisers, np.int64).view(_U), counts)
    place, may = seed_places([s for g in groups for s in g], least, np.repeat(np.arange(len(groups)), counts))
    out, at = [], 0
    for strings, own in zip(groups, owners):
        found = [[(0, len(s) - WINDOW + 1, o)] for s, o in zip(strings, own)]
        sort = np.flatnonzero(may[at:at + len(strings)]).tolist()
        if len(sort) > 1:
            seeds = place[at:at + len(strings)][sort].tolist()
            for k, r in zip(sort, window_owners([strings[k] for k in sort], [own[k] for k in sort], seeds)):
                found[k] = r
        out.append(found)
        at += len(strings)
    return out


def window_owners(strings: list[bytes], owners: list[int], seeds: list[int] | None = None) -> list[list[tuple[int, int, int]]]:
    """For each string its ranges (first window, windows, least owner of a string with that window).

    ``seeds`` are the places of the one seed that every window of every string holds; if it is the same one, it counts as a single symbol.
    """
    if len(strings) == 1:
        return [[(0, len(strings[0]) - WINDOW + 1, owners[0])]]
    folded = seeds is not None and min(seeds) >= 0 and len({s[p:p + SEED] for s, p in zip(strings, seeds)}) == 1
    text: list[int] = []
    place: list[tuple[int, int] | None] = []
    for k, string in enumerate(strings):
        if folded:
            text += string[:seeds[k]]
            text.append(256)
            text += string[seeds[k] + SEED:]
        else:
            text += string
        text.append(-1)
        windows = len(string) - WINDOW + 1
        place += [(k, i) for i in range(windows)]
        place += [None] * (len(text) - len(place))
    least = [[0] * (len(s) - WINDOW + 1) for s in strings]
    run: list[tuple[int, int]] = []

    def close() -> None:
        if run:
            owner = min(owners[k] for k, _ in run)
            for k, i in run:
                least[k][i] = owner
            run.clear()

    last = None
    for spot in map(place.__getitem__, suffix_array(text)):
        if spot is not None:
            k, i = spot
            window = strings[k][i:i + WINDOW]
            if window != last:
                if len(run) > 1:
                    close()
                elif run:
                    (j, h), = run
                    least[j][h] = owners[j]
                    run.clear()
                last = window
            run.append(spot)
    close()
    return [ranges(own) for own in least]


def ranges(own: list[int]) -> list[tuple[int, int, int]]:
    out, at = [], 0
    for k in range(1, len(own) + 1):
        if k == len(own) or own[k] != own[at]:
            out.append((at, k - at, own[at]))
            at = k
    return out


OWNED = "minimiser long, name long, ranges array<struct<at:int,n:int,owner:long>>"


def owned_windows(strings: DataFrame) -> DataFrame:
    """minimiser, name, ranges: for each stretch (minimiser, name, string, owner) the earliest owner of its windows."""
    many = strings.groupBy("minimiser").agg(F.count("*").alias("n")).where(F.col("n") > MAX_STRINGS).select("minimiser")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            minimisers = batch.column("minimiser").to_pylist()
            own, strings, owners = ([m.values.field(c).to_pylist() for m in batch.column("m")] for c in ("name", "string", "owner"))
            keys = [m for m, o in zip(minimisers, own) for _ in o]
            names = [name for o in own for name in o]
            found = [r for g in group_owners(minimisers, strings, owners) for r in g]
            flat = [r for ranges in found for r in ranges]
            at, n, owner = zip(*flat) if flat else ((), (), ())
            parts = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(owner, pa.int64())], names=["at", "n", "owner"])
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), parts)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.int64()), lists], names=["minimiser", "name", "ranges"])

    few = strings.join(many, "minimiser", "left_anti").groupBy("minimiser").agg(F.collect_list(F.struct("name", "string", "owner")).alias("m"))
    sorted_ones = few.mapInArrow(run, OWNED)
    each = F.explode(F.expr(f"sequence(0, octet_length(string) - {WINDOW})")).alias("at")
    cut = strings.join(many, "minimiser", "left_semi").select("minimiser", "name", "owner", "string", each)
    cut = cut.select("minimiser", "name", "owner", "at", F.expr(f"substring(string, at + 1, {WINDOW})").alias("window"))
    least = cut.groupBy("window").agg(F.min("owner").alias("owner"))
    range_ = F.struct("at", F.lit(1).alias("n"), "owner")
    grouped = cut.select("minimiser", "name", "at", "window").join(least, "window").groupBy("minimiser", "name").agg(F.collect_list(range_).alias("ranges"))
    return sorted_ones.unionByName(grouped)


def cut_out(body: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, maximal runs removed)."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept.append(body[at:a])
        at = b
    kept.append(body[at:])
    return b"".join(kept), sum(b - a for a, b in merged), len(merged)


def dedup_suffixes(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes: one row per row of ``df``."""
    shards = shuffle_width(df.sparkSession)
    slices = sliced(texts_of(df, key, text), shards)
    found = staged(found_stretches(slices, shared_minimisers(slices, shards), shards), "stretches")
    apart = found.where("string is not null")
    strings = apart.groupBy("minimiser", "name").agg(F.first("string").alias("string"), F.min("id").alias("owner"))
    owners = owned_windows(staged(strings, "strings"))
    earlier = F.expr("filter(ranges, r -> r.owner < id)")
    late = apart.select("slice", "doc", "id", "at", "minimiser", "name").join(owners, ["minimiser", "name"]).select("slice", "doc", "at", earlier.alias("ranges")).where(F.size("ranges") > 0)
    pieces = F.transform("ranges", lambda r: F.struct(F.col("doc").alias("doc"), (F.col("at") + r["at"]).alias("a"), (F.col("at") + r["at"] + r["n"] - 1 + WINDOW).alias("b")))
    some = late.select("slice", pieces.alias("pieces")).groupBy("slice").agg(F.flatten(F.collect_list("pieces")).alias("pieces"))
    whole = found.where("spans is not null").groupBy("slice").agg(F.collect_list("spans").alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 4, pa.binary())
        for batch in batches:
            for (_, ids, _, sizes, blob), packed, pieces in zip(_opened(batch), batch.column("spans").to_pylist(), batch.column("pieces").to_pylist()):
                spans: list[list] = [[] for _ in ids]
                for block in packed or []:
                    for doc, a, b in np.frombuffer(block, "<u4").reshape(3, -1).T.tolist():
                        spans[doc].append((a, b))
                for x in pieces or []:
                    spans[x["doc"]].append((x["a"], x["b"]))
                out, at = [], 0
                for doc_id, size, own in zip(ids, sizes.tolist(), spans):
                    kept, removed, n = cut_out(blob[at:at + size], set(own))
                    out.append((doc_id, size, removed, n, kept))
                    at += size
                yield _batch(dict(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept"), zip(zip(*out), kinds))))

    joined = slices.join(whole, "slice", "left").join(some, "slice", "left")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")

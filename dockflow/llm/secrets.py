"""Secret scan: base patterns, and a randomness battery with length-aware control of false discoveries.

Base: assignments to a secret's name, access keys and hex strings by pattern, leftmost and non-overlapping per kind.

Method: every other long run of key characters is a candidate. Its encoding is the smallest alphabet that holds its characters (decimal, hex,
base32, one case of letters with or without digits, base62, base64 or its URL form). Three tests ask whether the symbols could be
uniform and independent: chi-squared over the alphabet, runs above and below the middle symbol, serial correlation at lag one. The battery's p
is three times the least of the three, at most 1. Short strings give the tests little power, so ordinary text passes them too. How often is told
by decoys: ``DECOYS`` strings per (encoding, length band), drawn by a fixed seed from the letters of the corpus outside base spans and
candidates, in the encoding's case (a quarter capitals at least where both occur, as in words run together), and scored in that encoding. Candidates beyond ``TEXT_LEVEL``, which random keys reach in at most 1 %, tell
how many candidates are text (divided by the decoys' share beyond it). Accepted are those up to the last level at which the text expected
there, that number x the decoys' share, stays within ``fdr`` of the candidates there; no number of candidates is asked for. Where text looks
as random as keys none is accepted. The level table has 12 encodings x 6 bands x 41 levels at any input size and goes to the driver.

A null or empty text has no spans; repeated rows each get their row; an empty table gives an empty result; other columns aren't read.
Spans count code points, end exclusive. Patterns are linear in the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import staged, texts_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
BANDS = (20, 24, 32, 40, 64, 128)
LEVELS = 40
DECOYS = 10_000
TEXT_LEVEL = 8
CAPITALS = 0.25
FDR = 0.01
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from small to large, each in its usual order.
ALPHABETS = (
    ("decimal", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER), ("base32", _UPPER + "234567"),
    ("lower36", _DIGITS + _LOWER), ("upper36", _DIGITS + _UPPER), ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"), ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
RANKS = tuple((name, {c: k for k, c in enumerate(letters)}) for name, letters in ALPHABETS)


#: Letters in English text per thousand, for a corpus without text outside the candidates.
ENGLISH = dict(zip(_LOWER, (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)))


def encoding(token: str) -> tuple[str, dict[str, int]]:
    used = set(token)
    return next((name, ranks) for name, ranks in RANKS if used <= ranks.keys())


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(symbols: list[int], k: int) -> float:
    """Upper tail of the uniformity statistic; a gamma law with its exact mean and variance, by the cube-root rule."""
    n = len(symbols)
    counts = [0] * k
    for s in symbols:
        counts[s] += 1
    value = k / n * sum(c * c for c in counts) - n
    mean, variance = k - 1, 2 * (k - 1) * (n - 1) / n
    df = 2 * mean * mean / variance
    return _tail(((value / mean) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def runs_p(symbols: list[int], k: int) -> float:
    high = [s >= k / 2 for s in symbols]
    n, a = len(high), sum(high)
    b = n - a
    if not a or not b:
        return 0.0
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    mean = 1 + 2 * a * b / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 2 * _tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 0.0


def serial_p(symbols: list[int]) -> float:
    n = len(symbols)
    mean = sum(symbols) / n
    spread = sum((s - mean) ** 2 for s in symbols)
    if not spread:
        return 0.0
    r = sum((x - mean) * (y - mean) for x, y in zip(symbols, symbols[1:])) / spread
    return 2 * _tail(abs(r + 1 / n) * math.sqrt(n))


def battery(token: str) -> float:
    """p of the battery under uniform, independent symbols of the inferred encoding."""
    _, ranks = encoding(token)
    symbols, k = [ranks[c] for c in token], len(ranks)
    return min(1.0, 3 * min(chi_squared_p(symbols, k), runs_p(symbols, k), serial_p(symbols)))


def level(p: float) -> int:
    """0 for p near 1, one more for each quarter of a power of ten."""
    return LEVELS if p <= 10 ** (-LEVELS / 4) else int(-4 * math.log10(p))


def band(length: int) -> int:
    return sum(length >= b for b in BANDS) - 1


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number), by start, then kind."""
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 18] if "AKIA" in text else []
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda x: (x[0], x[2]))


def candidates(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)]


def outside(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans."""
    if not spans:
        return text
    parts, at = [], 0
    for a, b in sorted(spans):
        parts.append(text[at:max(at, a)])
        at = max(at, b)
    return "".join([*parts, text[at:]])


def group(name: str, length: int) -> int:
    """One number for (encoding, length band)."""
    return next(k for k, (own, _) in enumerate(ALPHABETS) if own == name) * len(BANDS) + band(length)


def _scan(df: DataFrame, text: str, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
        scored = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("group", pa.int32()), ("level", pa.int32())]))
        for batch in batches:
            base, targets, letters = [], [], np.zeros(128, np.int64)
            for body in batch.column("text").to_pylist():
                spans, own = base_matches(body), candidates(body)
                base.append([{"s": s, "k": k, "e": e} for s, e, k in spans])
                targets.append([{"s": s, "e": e, "group": group(encoding(t)[0], e - s), "level": level(battery(t))} for s, e, t in own])
                free = outside(body, [x[:2] for x in (*spans, *own)])
                letters += np.bincount(np.frombuffer(free.encode("utf-8", "replace"), np.uint8), minlength=256)[:128]
            # The letters of a batch stand in its first row.
            counts = [letters.tolist(), *[None] * (len(base) - 1)] if base else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, span), pa.array(targets, scored), pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "base", "targets", "letters"]
            )

    kinds = "doc_id long, base array<struct<s:int,k:int,e:int>>, targets array<struct<s:int,e:int,group:int,level:int>>, letters array<long>"
    return texts_of(df, key, text).mapInArrow(run, kinds)


def decoy_levels(name: str, length: int, letters: dict[str, int], n: int = DECOYS) -> list[int]:
    """Decoys at each level: strings of the corpus letters that the encoding has, in its case."""
    ranks = dict(RANKS)[name]
    weights = np.zeros(len(ranks))
    one_case = str.upper if not ranks.keys() & set(_LOWER) else str.lower if not ranks.keys() & set(_UPPER) else str
    for c, count in letters.items():
        k = ranks.get(one_case(c))
        if k is not None:
            weights[k] += count
    if one_case is str:  # words run together have more capitals than prose
        big, small = (sum(weights[ranks[c]] for c in those) for those in (_UPPER, _LOWER))
        for upper, lower in zip(_UPPER, _LOWER):
            both = weights[ranks[upper]] + weights[ranks[lower]]
            weights[ranks[upper]], weights[ranks[lower]] = both * (share := max(CAPITALS, big / max(big + small, 1))), both * (1 - share)
    if not weights.sum():
        return [n, *[0] * LEVELS]
    rng = np.random.default_rng(length)
    drawn = rng.choice(len(ranks), size=(n, length), p=weights / weights.sum()).tolist()
    k = len(ranks)
    found = [0] * (LEVELS + 1)
    for symbols in drawn:
        found[level(min(1.0, 3 * min(chi_squared_p(symbols, k), runs_p(symbols, k), serial_p(symbols))))] += 1
    return found


def last_level(targets: dict[int, int], decoys: list[int], fdr: float = FDR) -> int:
    """The last level at which the text expected among the candidates stays within ``fdr`` of them; -1 for none."""
    n = sum(decoys)
    beyond = max(sum(decoys[TEXT_LEVEL + 1:]), 1) / n
    text = (1 + sum(c for k, c in targets.items() if k > TEXT_LEVEL)) / beyond
    best, accepted, passed = -1, 0, 0
    for k in range(TEXT_LEVEL + 1):
        accepted, passed = accepted + targets.get(k, 0), passed + decoys[k]
        if accepted and text * (1 + passed) / (1 + n) <= fdr * accepted:
            best = k
    return best


def accepted_levels(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Last accepted level of each (encoding, length band) that has one."""
    counts = scanned.select(F.explode("targets").alias("x")).groupBy("x.group", "x.level").agg(F.count("*").alias("n")).collect()
    place = scanned.select(F.posexplode("letters").alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n"))
    letters = {chr(r.c): r.n for r in place.collect() if chr(r.c).isalnum()}
    letters = letters if sum(letters.values()) else ENGLISH
    groups: dict[int, dict[int, int]] = {}
    for r in counts:
        groups.setdefault(r.group, {})[r.level] = r.n
    levels = {}
    for g, targets in groups.items():
        name, length = ALPHABETS[g // len(BANDS)][0], BANDS[g % len(BANDS)]
        levels[g] = last_level(targets, decoy_levels(name, length, letters), fdr)
    return {g: k for g, k in levels.items() if k >= 0}


def find_secrets(df: DataFrame, text: str = "text", key: str = "doc_id", fdr: float = FDR) -> DataFrame:
    """doc_id, base and spans, arrays of (s, k, e) with k the number of the kind: one row per row of ``df``."""
    scanned = staged(_scan(df, text, key), "secrets")
    levels = accepted_levels(scanned, fdr)
    least = F.create_map(*[F.lit(v) for pair in levels.items() for v in pair]) if levels else F.expr("cast(map() as map<int,int>)")
    rows = scanned.select("doc_id", "base", "targets", least.alias("levels"))
    free = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    random = F.filter("targets", lambda x: (x["level"] <= F.coalesce(F.try_element_at("levels", x["group"]), F.lit(-1))) & free(x))
    added = F.transform(random, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index("random")).alias("k"), x["e"].alias("e")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, count per base kind, SHA-256 of the base spans and all spans as kind:start:end."""
    names = F.array(*map(F.lit, KINDS))
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))

"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

In byte-pair encoding a token sequence is the encoding of a text exactly if every two neighbours are the encoding of their own text.
So the last token of a prefix is the one piece that ends there, starts where a prefix ended before, and agrees with that prefix's last
token. Which earlier ends can matter is bounded by the vocabulary: those from which the text since is still the beginning of a piece.
A transducer state is that list: (characters since, last token there, tokens there relative to now). A transition reads one character
and is annotated with the change of the count. States and transitions are compiled when first met and shared by a worker's texts.

No piece has a space sign after another character, so the transducer is back in its start state at each change from non-space to space.
Texts beyond ``CHUNK`` characters are cut into chunk rows that any task may count. The state map of a stretch is (entry, tokens of the head,
tokens after it, exit): the head up to the first reset depends on the state that comes in, everything behind it doesn't. A chunk's map is made
for the entry state that the ``CONTEXT`` characters before it lead to; where the stretch on its left ends in another state, its head is run
again from there, so the guess decides only the time. Maps compose associatively, in the rounds of a prefix scan's up-sweep, as only the map
of the whole text is wanted: a text without any space costs linear memory.

A null or empty text has 0 bytes and 0 tokens; repeated rows each get their row; an empty table gives an empty result; other columns
aren't read. Characters outside the vocabulary count as their UTF-8 bytes (byte fallback). The caches of a worker start anew at a bound.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import texts_of

SPACE = "▁"
CHUNK = 1 << 15
CONTEXT = 64
LONG_UNIT = 256
MAX_UNITS = 400_000
MAX_TRANSITIONS = 400_000
LIMIT = 4096


class Transducer:
    """Counts the tokens of units: runs of space signs followed by other characters."""

    def __init__(self, model_path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        own = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in own}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece with a space after another character: texts cannot be cut at spaces")
        self.starts = {p[:k] for p in self.score for k in range(1, len(p))}
        self.agree: dict[tuple[str | None, str], bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.states: list[tuple[str, tuple]] = [("", ((0, None, 0),))]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.compiled = 0

    def merged(self, text: str) -> list[str]:
        """Encoding of a short string by merging its best pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def agrees(self, last: str | None, piece: str) -> bool:
        if last is not None and (piece not in self.score or last not in self.score):
            return self.agrees(None, piece)
        found = self.agree.get((last, piece))
        if found is None:
            if len(self.agree) > MAX_TRANSITIONS:
                self.agree.clear()
            found = self.agree[last, piece] = self.merged((last or "") + piece) == ([piece] if last is None else [last, piece])
        return found

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        tail, ends = self.states[state]
        tail += char
        for back, last, count in ends:
            piece = tail[len(tail) - back - 1:]
            if (back == 0 or piece in self.score) and self.agrees(last, piece):
                change = count + (1 if piece in self.score else len(piece.encode("utf-8", "surrogatepass")))
                break
        else:
            raise AssertionError("every prefix has an encoding")
        kept = tuple((b + 1, t, c - change) for b, t, c in ends if tail[len(tail) - b - 1:] in self.starts)
        reach = max((b for b, _, _ in kept), default=0)
        new = (tail[len(tail) - reach:], ((0, piece, 0), *kept))
        move = self.moves[state][char] = (self._add(new), change)
        self.compiled += 1
        return move

    def _walk(self, text: str, state: int) -> tuple[int, int]:
        """State after a text read from ``state``, and the sum of the annotations along the path."""
        total = 0
        moves = self.moves
        for char in text:
            move = moves[state].get(char)
            if move is None:
                if self.compiled > MAX_TRANSITIONS:
                    value = self.states[state]
                    self._clear()
                    moves, state = self.moves, self._add(value)
                move = self._compile(state, char)
            state = move[0]
            total += move[1]
        return state, total

    def run(self, text: str, entry: str) -> tuple[str, int]:
        """``_walk`` between states as other workers can read them."""
        state, total = self._walk(text, self._state(entry))
        return json.dumps(self.states[state]), total

    def _add(self, value: tuple[str, tuple]) -> int:
        if value not in self.number:
            self.number[value] = len(self.states)
            self.states.append(value)
            self.moves.append({})
        return self.number[value]

    def _state(self, written: str) -> int:
        if written == START:
            return 0
        tail, ends = json.loads(written)
        return self._add((tail, tuple(map(tuple, ends))))

    def count(self, unit: str) -> int:
        """Tokens of one unit."""
        return self._walk(unit, 0)[1]


START = json.dumps(["", [[0, None, 0]]])


class Units(dict):
    """Counts of the units met so far."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer = transducer

    def __missing__(self, unit: str) -> int:
        if len(unit) > LONG_UNIT:
            return self.transducer.count(unit)
        if len(self) > MAX_UNITS:
            self.clear()
        found = self[unit] = self.transducer.count(unit)
        return found


class ChunkMap(NamedTuple):
    """State map of a stretch of text; ``open``: no reset inside, the head is the whole stretch."""

    head: str
    entry: str
    inner: int  # tokens of the head, read from the entry state
    count: int  # tokens after the head
    exit: str
    spaced: bool  # ends in a space sign
    open: bool


@lru_cache(maxsize=2)
def compiled(model_path: str) -> Units:
    return Units(Transducer(model_path))


def units_of(text: str) -> list[str]:
    """Units of a text whose spaces are space signs already."""
    cells = text.split(SPACE)
    if "" not in cells[1:]:
        return [*cells[:1 if cells[0] else 0], *(SPACE + c for c in cells[1:])]
    joined, lead = [cells[0]], ""  # runs of spaces: the signs before a unit belong to it
    for cell in cells[1:]:
        lead += SPACE
        if cell:
            joined.append(lead + cell)
            lead = ""
    if lead:
        joined.append(lead)
    return joined if joined[0] else joined[1:]


def entry_state(before: str, text: str, units: Units) -> str:
    """The state that the characters before a chunk lead to, as far as they tell."""
    if not before or before[-1] != SPACE and text[:1] == SPACE:
        return START
    return units.transducer.run(units_of(before)[-1], START)[0]


def chunk_map(text: str, units: Units, entry: str = START) -> ChunkMap:
    cells = units_of(text) or [""]
    state, inner = units.transducer.run(cells[0], entry)
    if len(cells) < 2:
        return ChunkMap(cells[0], entry, inner, 0, state, text[-1:] == SPACE, True)
    state, last = units.transducer.run(cells[-1], START)
    return ChunkMap(cells[0], entry, inner, sum(map(units.__getitem__, cells[1:-1])) + last, state, text[-1:] == SPACE, False)


def compose(a: ChunkMap, b: ChunkMap, units: Units) -> ChunkMap:
    """The map of two neighbouring stretches, for the entry state of the left one."""
    if not b.head:
        return a
    if not a.head:
        return b if a.entry == b.entry else compose_from(a.entry, b, units)
    reset = not a.spaced and b.head[0] == SPACE
    b = compose_from(START if reset else a.exit, b, units)
    if a.open and not reset:
        return ChunkMap(a.head + b.head, a.entry, a.inner + b.inner, b.count, b.exit, b.spaced, b.open)
    return ChunkMap(a.head, a.entry, a.inner, a.count + b.inner + b.count, b.exit, b.spaced, False)


def compose_from(entry: str, m: ChunkMap, units: Units) -> ChunkMap:
    """A stretch's map for another entry state: its head is run again."""
    if m.entry == entry:
        return m
    state, inner = units.transducer.run(m.head, entry)
    return m._replace(entry=entry, inner=inner, exit=state if m.open else m.exit)


def scan_total(maps: list[ChunkMap], join: Callable[[ChunkMap, ChunkMap], ChunkMap]) -> ChunkMap:
    """The last prefix of a scan: log2(n) rounds of independent compositions of neighbours."""
    while len(maps) > 1:
        pairs = [join(a, b) for a, b in zip(maps[::2], maps[1::2])]
        maps = pairs + maps[len(maps) & ~1:]
    return maps[0]


def total(m: ChunkMap, units: Units) -> int:
    """Tokens of a whole text, from its start state."""
    m = compose_from(START, m, units)
    return m.inner + m.count


def prepared(text: str, first: bool) -> str:
    """Spaces as space signs; a text starts with one more."""
    return (SPACE if first and text else "") + text.replace(" ", SPACE)


def count_tokens(df: DataFrame, model_path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``df``."""
    rows = texts_of(df, key, text)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = compiled(model_path)
        for batch in batches:
            counts = [sum(map(units.__getitem__, units_of(prepared(t, True)))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = compiled(model_path)
        for batch in batches:
            maps = []
            for c, before, t in zip(*(batch.column(n).to_pylist() for n in ("chunk", "before", "text"))):
                body = prepared(t, c == 0)
                maps.append(chunk_map(body, units, entry_state(prepared(before, False), body, units)))
            cols = [batch.column(c) for c in ("row", "doc_id", "n_bytes", "chunk")]
            lists = [pa.array([m[k] for m in maps], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*cols, *lists], names=["row", "doc_id", "n_bytes", "chunk", *ChunkMap._fields])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = compiled(model_path)
        for batch in batches:
            counts = []
            for maps in batch.column("maps").to_pylist():
                ordered = [ChunkMap(*(m[f] for f in ChunkMap._fields)) for m in maps]
                counts.append(total(scan_total(ordered, lambda a, b: compose(a, b, units)), units))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    size = F.octet_length("text").cast("long").alias("n_bytes")
    short = rows.where(F.length("text") <= chunk).select("doc_id", size, "text").mapInArrow(whole, "doc_id long, n_bytes long, n_tokens long")
    long = rows.where(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "doc_id", size, "text")
    at = F.explode(F.sequence(F.lit(0), F.expr(f"cast((length(text) - 1) div {chunk} as int)"))).alias("chunk")
    cut = long.select("row", "doc_id", "n_bytes", "text", at).select(
        "row", "doc_id", "n_bytes", "chunk", F.expr(f"substring(text, chunk * {chunk} + 1, {chunk})").alias("text"),
        F.expr(f"substring(text, greatest(chunk * {chunk} - {CONTEXT}, 0) + 1, least(chunk * {chunk}, {CONTEXT}))").alias("before"),
    )
    fields = "head string, entry string, inner long, count long, exit string, spaced boolean, open boolean"
    maps = cut.repartition("row", "chunk").mapInArrow(mapped, f"row long, doc_id long, n_bytes long, chunk int, {fields}")
    listed = maps.groupBy("row", "doc_id", "n_bytes").agg(F.array_sort(F.collect_list(F.struct("chunk", *ChunkMap._fields))).alias("maps"))
    counted = listed.select("doc_id", "n_bytes", "maps").mapInArrow(scanned, "doc_id long, n_bytes long, n_tokens long")
    return short.unionByName(counted).withColumn("over_limit", F.col("n_tokens") > limit)

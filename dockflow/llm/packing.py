"""Packing documents into token windows by the sum-of-squares rule.

Each document's ids (with a closing id) fill whole windows first; what is left, less than a window, is one item. The level array holds how
many open windows are filled to each level; an item goes to the level (or to a new window) after which the sum of the squared counts is
least, so no level piles up and most windows end exactly full. Every task packs its own part of the table and needs no shuffle. At its end,
or beyond ``MAX_OPEN`` open windows, the open ones are emptied into full windows by cutting, and the last rest is cut into windows whose
lengths are powers of two, which need no padding.

Ids come from a byte-level BPE file of the `tokenizers` library; the same merges are run by `tiktoken` from the rank file, one space-led
stretch of text at a time (its pattern never joins text across such a place), and kept as bytes. A special string in a text becomes its
special id, as in the library's default.

A null or empty text is a document of the closing id alone; repeated rows are packed each on its own; an empty table gives no windows;
other columns aren't read. A task holds the open windows' ids and one document; what a retry packs again stays inside its own windows.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from dockflow.llm.common import texts_of

WINDOW = 1024
MAX_OPEN = 4096
MAX_UNITS = 60_000
SPACED = re.compile(r"\s ")
BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class UnitIds(dict):
    """Little-endian ids of each stretch of text met so far."""

    def __init__(self, ranks_path: str, pattern: str, special: str, special_id: int) -> None:
        import tiktoken

        super().__init__()
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special, self.special_ids = special, struct.pack("<I", special_id)

    def __missing__(self, unit: str) -> bytes:
        if len(self) > MAX_UNITS:
            self.clear()
        found = self[unit] = np.array(self.encode(unit), "<u4").tobytes()
        return found

    def plain(self, text: str) -> bytes:
        if SPACED.search(text):
            units = BEFORE_SPACE.split(text)
        else:
            units = text.split(" ")
            units[1:] = [" " + u for u in units[1:]]
        return b"".join(map(self.__getitem__, units)) if text else b""

    def ids(self, text: str) -> bytes:
        if self.special not in text:
            return self.plain(text)
        return self.special_ids.join(map(self.plain, text.split(self.special)))


@lru_cache(maxsize=2)
def tokenizer(ranks_path: str, pattern: str, special: str, special_id: int) -> UnitIds:
    return UnitIds(ranks_path, pattern, special, special_id)


class SumOfSquares:
    """Open windows by level; ``emit(window, pieces)`` gets each finished one, a piece being (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int, emit) -> None:
        self.window, self.emit = window, emit
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def best_level(self, size: int) -> int:
        """Level whose growth by ``size`` leaves the least sum of squares; 0: a new window. Half the change, less one, is compared."""
        now, then = self.levels[1:self.window + 1 - size], self.levels[1 + size:]
        change = np.where(now > 0, then - now, np.iinfo(np.int64).max // 4).astype(np.float64)
        if change.size:
            change[-1] -= 0.5  # a window that gets full leaves the array
            at = int(change.argmin())
            if change[at] <= self.levels[size] - 0.5:
                return at + 1
        return 0

    def place(self, piece: tuple, size: int) -> None:
        level = self.best_level(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.emit(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.levels[level + size] += 1
        self.n_open += 1
        if self.n_open > MAX_OPEN:
            self.close()

    def close(self) -> None:
        """Empty the open windows: full ones by cutting, the rest in powers of two."""
        rest = [p for level in sorted(self.open) for pieces in self.open[level] for p in pieces]
        left = sum(len(p[2]) // 4 for p in rest)
        room, pieces = 0, []
        for doc_id, start, ids, tokens in rest:
            at, size = 0, len(ids) // 4
            while at < size:
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                n = min(room, size - at)
                pieces.append((doc_id, start + at, ids[4 * at:4 * (at + n)], tokens))
                at, room, left = at + n, room - n, left - n
                if not room:
                    self.emit(pieces)
                    pieces = []
        self.open, self.n_open = {}, 0
        self.levels[:] = 0


def pack(
    df: DataFrame, ranks_path: str, pattern: str, special: str = "<|endoftext|>", special_id: int = 50256, closing_id: int = 0,
    window: int = WINDOW, text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = tokenizer(ranks_path, pattern, special, special_id)
        first = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        done = 0
        closing = struct.pack("<I", closing_id)

        def emit(pieces: list) -> None:
            nonlocal done
            offset = 0
            for doc_id, start, ids, tokens in pieces:
                size = len(ids) // 4
                out.append((doc_id, start, size, zlib.crc32(ids), tokens, first + done, offset))
                offset += size
            done += 1

        def rows() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        packer = SumOfSquares(window, emit)
        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = units.ids(body) + closing
                tokens = len(ids) // 4
                whole = tokens - tokens % window
                for at in range(0, whole, window):
                    emit([(doc_id, at, ids[4 * at:4 * (at + window)], tokens)])
                if whole < tokens:
                    packer.place((doc_id, whole, ids[4 * whole:], tokens), tokens - whole)
            if out:
                yield rows()
        packer.close()
        if out:
            yield rows()

    return texts_of(df, key, text).mapInArrow(run, SCHEMA)

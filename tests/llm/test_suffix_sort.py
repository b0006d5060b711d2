"""Suffixes are sorted only where strings may share a window, with the seed as one symbol; owners as by comparing all windows."""

from __future__ import annotations

import random

import numpy as np

from dockflow.llm import suffix_dedup as sd


def stretch(blob: bytes) -> list[tuple[int, bytes]]:
    s = sd.Stretches(blob, np.array([len(blob)]))
    return [(int(m), blob[a:a + n + sd.WINDOW - 1]) for m, a, n in zip(s.least.view(np.int64), s.at.tolist(), s.n.tolist())]


def plain(strings, owners):
    windows = [[s[i:i + sd.WINDOW] for i in range(len(s) - sd.WINDOW + 1)] for s in strings]
    least: dict[bytes, int] = {}
    for own, o in zip(windows, owners):
        for w in own:
            least[w] = min(o, least.get(w, o))
    return [sd.ranges([least[w] for w in own]) for own in windows]


def grouped(blobs):
    groups: dict[int, dict[bytes, int]] = {}
    for k, blob in enumerate(blobs):
        for m, s in stretch(blob):
            groups.setdefault(m, {}).setdefault(s, k)
    return list(groups), [list(g) for g in groups.values()], [list(g.values()) for g in groups.values()]


def test_owners_of_groups(monkeypatch):
    rng = random.Random(5)
    word = lambda n: bytes(rng.choices(range(97, 123), k=n))
    passage, phrase = word(130), word(30)
    blobs = [word(60) + phrase + word(60) for _ in range(20)]
    blobs += [word(40) + passage[a:a + 100] + word(40) for a in range(0, 30, 3)]
    blobs += [word(20) + b"ab" * 60 + word(20), b"ab" * 45 + word(30), b"x" * 300 + word(9), b"x" * 70]
    sorted_, whole = [], sd.suffix_array
    monkeypatch.setattr(sd, "suffix_array", lambda text: sorted_.append(len(text)) or whole(text))
    minimisers, groups, owners = grouped(blobs)
    assert sd.group_owners(minimisers, groups, owners) == [plain(g, o) for g, o in zip(groups, owners)]
    # Surroundings of the phrase differ, so no window with it is shared and none of its strings is sorted.
    assert 0 < sum(sorted_) < sum(len(s) + 1 for g in groups if len(g) > 1 for s in g) / 2
    sorted_.clear()
    minimisers, groups, owners = grouped(blobs[:20])
    assert max(map(len, groups)) > 5
    sd.group_owners(minimisers, groups, owners)
    assert sorted_ == [] and sd.group_owners([], [], []) == []


def test_seeds_of_one_hash_stay_apart():
    """Strings that don't hold the same bytes where their seeds are said to be are sorted byte by byte."""
    rng = random.Random(6)
    a = bytes(rng.choices(range(97, 123), k=60))
    b = a[:26] + b"Z" + a[27:]
    assert sd.window_owners([a, b], [1, 2], [10, 10]) == plain([a, b], [1, 2])
    assert sd.window_owners([a, a[:55]], [2, 1], [10, 10]) == plain([a, a[:55]], [2, 1])


def test_long_runs_are_cut():
    blob = b"a" * 1000 + bytes(random.Random(7).choices(range(98, 123), k=500)) + b"xy" * 300
    s = sd.Stretches(blob, np.array([len(blob)]))
    assert s.n.max() == sd.MAX_RUN and (s.at[1:] == s.at[:-1] + s.n[:-1]).all() and s.n.sum() == len(blob) - sd.WINDOW + 1

"""Weighted acyclic automata over word sequences: sorted levels of arcs with a count on every state.

A state of depth ``d`` stands for the ``d`` labels read to reach it and holds
how often that sequence was counted.  The arcs into the states of one depth
are kept sorted by (source, label), so a union is one sorted merge per depth,
a run of first labels is a slice of every depth, and reading many sequences
at once is one binary search per label.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: One depth: source state (place in the depth above), label, count of the state reached.
Level = tuple[np.ndarray, np.ndarray, np.ndarray]


def _place(n: int) -> type:
    """The smaller kind of number that holds places among ``n`` states."""
    return np.int32 if n < 1 << 31 else np.int64


def _counts(values: np.ndarray) -> np.ndarray:
    """Sums of counts in half the bytes, if all fit."""
    return values.astype(np.int32) if len(values) and values.max() < 1 << 31 else values


def build(columns: Sequence[np.ndarray], counts: np.ndarray | None = None) -> list[Level]:
    """The automaton of the rows of ``columns`` (one array of labels per depth), each counted once or ``counts`` times.

    Depth after depth the rows are sorted by (state so far, next label): equal
    beginnings become one state, and the sorted order is that of the arcs.
    """
    place = _place(len(columns[0]))
    state = np.zeros(len(columns[0]), place)
    levels: list[Level] = []
    for depth, labels in enumerate(columns):
        order = np.lexsort((labels, state))
        source, label = state[order], labels[order]
        new = np.ones(len(order), bool)
        new[1:] = (source[1:] != source[:-1]) | (label[1:] != label[:-1])
        first = np.flatnonzero(new)
        state = np.empty(len(order), place)
        state[order] = np.cumsum(new, dtype=place) - 1
        weight = np.zeros(len(first), np.int32)
        if depth == len(columns) - 1 and len(first):
            weight = _counts(np.add.reduceat(np.ones(len(order), np.int64) if counts is None else counts[order].astype(np.int64), first))
        levels.append((source[first], label[first], weight))
    return levels


def union(parts: Sequence[list[Level]]) -> list[Level]:
    """One automaton for all parts; states reached by the same labels are one, their counts added."""
    if len(parts) == 1:
        return list(parts[0])
    depth = max(map(len, parts), default=0)
    at = [np.zeros(1, np.int32) for _ in parts]
    out: list[Level] = []
    for d in range(depth):
        live = [i for i, p in enumerate(parts) if d < len(p)]
        ends = np.cumsum([0] + [len(parts[i][d][0]) for i in live])
        place = _place(int(ends[-1]))
        source = np.concatenate([at[i][parts[i][d][0]] for i in live])
        label = np.concatenate([parts[i][d][1] for i in live])
        order = np.lexsort((label, source)).astype(place)
        source, label = source[order], label[order]
        new = np.ones(len(order), bool)
        new[1:] = (source[1:] != source[:-1]) | (label[1:] != label[:-1])
        first = np.flatnonzero(new)
        source, label = source[first], label[first]
        weight = np.concatenate([parts[i][d][2] for i in live])
        if len(first):
            weight = _counts(np.add.reduceat(weight[order], first, dtype=np.int64))
        out.append((source, label, weight))
        state = np.empty(len(order), place)
        state[order] = np.cumsum(new, dtype=place) - 1
        for k, i in enumerate(live):
            at[i] = state[ends[k]:ends[k + 1]]
    return out


def pruned(levels: list[Level], least: int) -> list[Level]:
    """Only the states counted ``least`` times or more, and those on the way to them."""
    keep = [w >= least for _, _, w in levels]
    for d in range(len(levels) - 1, 0, -1):
        keep[d - 1][levels[d][0][keep[d]]] = True
    out: list[Level] = []
    place = np.zeros(1, np.int64)
    for (source, label, weight), k in zip(levels, keep):
        out.append((place[source[k]], label[k], np.where(weight[k] >= least, weight[k], 0)))
        place = np.cumsum(k) - 1
    return out


def split(levels: list[Level]) -> list[tuple[int, list[Level]]]:
    """``(label, automaton)`` for every first label: a slice of each depth."""
    first = levels[0][1]
    owner = np.arange(len(first))
    cuts = []
    for d, (source, _, _) in enumerate(levels):
        owner = owner if d == 0 else owner[source]
        cuts.append(np.searchsorted(owner, np.arange(len(first) + 1)))
    out = []
    for k in range(len(first)):
        part: list[Level] = []
        above = 0
        for (source, label, weight), cut in zip(levels, cuts):
            a, b = cut[k], cut[k + 1]
            part.append((source[a:b] - above, label[a:b], weight[a:b]))
            above = a
        part[0] = (np.zeros(1, np.int64), part[0][1], part[0][2])
        out.append((int(first[k]), part))
    return out


def read(levels: list[Level], columns: Sequence[np.ndarray]) -> np.ndarray:
    """The state that each row of ``columns`` reaches at their last depth, or -1: both automata are walked side by side."""
    state = np.zeros(len(columns[0]), np.int64)
    for (source, label, _), want in zip(levels, columns):
        if not len(label):
            return np.full(len(state), -1)
        kinds = np.unique(label)
        rank = np.searchsorted(kinds, want).clip(max=len(kinds) - 1)
        ok = (state >= 0) & (kinds[rank] == want)
        arc = source.astype(np.int64) * len(kinds) + np.searchsorted(kinds, label)
        goal = state * len(kinds) + rank
        place = np.searchsorted(arc, goal).clip(max=len(arc) - 1)
        state = np.where(ok & (arc[place] == goal), place, -1)
    return state


def paths(levels: list[Level], depth: int) -> np.ndarray:
    """The labels on the way to every state of ``depth`` (counted from 0), one row for each."""
    at = np.arange(len(levels[depth][0]))
    out = []
    for d in range(depth, -1, -1):
        out.append(levels[d][1][at])
        at = levels[d][0][at]
    return np.stack(out[::-1], axis=1) if out else np.zeros((0, 0), np.uint64)


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def dump(levels: list[Level]) -> bytes:
    """Bytes of an automaton: arcs out of each state, labels, counts; counts and sources in as few bytes as they need."""
    out = [np.array([len(levels)], np.uint8).tobytes()]
    above = 1
    for source, label, weight in levels:
        fan = _small(np.bincount(source, minlength=above))
        weight = _small(weight)
        out.append(np.array([above, len(label), fan.itemsize, weight.itemsize], np.int64).tobytes())
        out += [fan.tobytes(), label.astype(np.uint64).tobytes(), weight.tobytes()]
        above = len(label)
    return b"".join(out)


def load(data: bytes) -> list[Level]:
    kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}
    at, out = 1, []
    for _ in range(data[0]):
        above, n, f, w = np.frombuffer(data, np.int64, 4, at).tolist()
        at += 32
        fan = np.frombuffer(data, kinds[f], above, at)
        at += above * f
        label = np.frombuffer(data, np.uint64, n, at)
        at += 8 * n
        weight = np.frombuffer(data, kinds[w], n, at).astype(np.int64)
        at += n * w
        out.append((np.repeat(np.arange(above), fan), label, weight))
    return out

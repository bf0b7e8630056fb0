"""Suffix arrays of many short byte strings, by Larsson-Sadakane refinement, in numpy."""

from __future__ import annotations

import numpy as np


def refine(data: np.ndarray, room: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with ``depth`` bytes of room, sorted by these bytes, and a rank of every position;
    equal ranks of such positions mean equal bytes. ``room``: bytes up to the end of the string.

    Positions start in groups of equal first eight bytes. Each pass doubles the depth: groups of
    two and more are sorted by the rank of what follows; groups of one are left alone, and so are positions
    without room for more. A group's parts get ranks from the group's own on, so the others' stay as they are."""
    n = len(data)
    padded = np.append(data, np.zeros(8, np.uint8))
    key = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)  # eight bytes from each place on
    room = room.astype(np.int32)
    active = np.flatnonzero(room >= min(8, depth)).astype(np.int32)
    key = key[active]
    by = np.argsort(key, kind="stable")
    active = active[by]
    rank = np.full(n, -1, np.int32)
    rank[active] = _starts(key[by])
    reached = 8
    while reached < depth and len(active):
        to = min(2 * reached, depth)
        active = active[room[active] >= to]
        if not len(active):
            break
        group = rank[active]
        same = group[1:] == group[:-1]
        many = np.append(same, False) | np.append(False, same)
        active, group = active[many], group[many].astype(np.int64)
        pair = group * (n + 1) + rank[active + (to - reached)]
        by = np.argsort(pair, kind="stable")  # groups stay where they are
        active = active[by]
        rank[active] = group + _starts(pair[by]) - _starts(group)
        reached = to
    order = np.flatnonzero(room >= depth)
    return order[np.argsort(rank[order], kind="stable")], rank


def _starts(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the number at which each one's group of equals starts."""
    first = np.ones(len(keys[0]), bool)
    if len(first):
        first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.maximum.accumulate(np.where(first, np.arange(len(first), dtype=np.int32), 0))


def kasai(data: np.ndarray, room: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix of ``order`` with the one before it (0 for the first).

    By Kasai's rule, if a suffix and its neighbour follow the same byte and those suffixes are
    neighbours too, the prefix is one shorter than theirs. Only the others are compared, eight
    bytes at a time."""
    n = len(data)
    common = np.zeros(n, np.int64)
    if len(order) < 2:
        return common[: len(order)]
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(before >= 0)
    other = before[at]
    follows = np.zeros(n, bool)
    inner = at[(at > 0) & (other > 0)]
    to = before[inner]
    follows[inner] = (before[inner - 1] == to - 1) & (data[inner - 1] == data[to - 1]) & (room[inner - 1] == room[inner] + 1) & (room[to - 1] == room[to] + 1)
    fresh = at[~follows[at]]
    to, most = before[fresh], np.minimum(room[fresh], room[before[fresh]])
    length = np.zeros(len(fresh), np.int64)
    padded = np.append(data, np.zeros(8, np.uint8))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    active = np.arange(len(fresh))
    while len(active):
        a = np.minimum(fresh[active] + length[active], n)
        b = np.minimum(to[active] + length[active], n)
        equal = words[a] == words[b]
        run = np.where(equal.all(1), 8, np.argmin(equal, 1))
        length[active] = np.minimum(length[active] + run, most[active])
        active = active[(run == 8) & (length[active] < most[active])]
    common[fresh] = length
    # the rest: what the last compared position before has, less the distance
    source = np.maximum.accumulate(np.where(~follows, np.arange(n), 0))
    rest = np.flatnonzero(follows)
    common[rest] = common[source[rest]] - (rest - source[rest])
    return common[order]

"""Two-stage suffix sorting of a byte text, and which windows occur more than once."""

from __future__ import annotations

import numpy as np


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """Per place: whether the suffix there sorts before the one that follows it. The
    empty suffix at the end sorts first."""
    if not len(data):
        return np.zeros(0, bool)
    step = np.diff(data.astype(np.int16), append=-1)
    moves = np.flatnonzero(step)
    return step[moves[np.searchsorted(moves, np.arange(len(data)))]] > 0


def suffix_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted places in order of the ``depth`` bytes that start there.

    Only suffixes smaller than their successors are sorted directly. The others are
    induced: going through the buckets of first bytes in order, the place before each
    sorted suffix, if it is larger than its successor, is next in its own bucket.
    ``wanted`` must hold, after each larger suffix, its successor as well.
    """
    small = smaller_than_successor(data)
    text = data.tobytes().decode("latin-1")
    direct = np.flatnonzero(small & wanted)
    keys = [text[i : i + depth] for i in direct.tolist()]
    rank = sorted(range(len(keys)), key=keys.__getitem__)
    direct = direct[np.array(rank, np.int64)] if len(rank) else direct
    del keys
    large = wanted & ~small
    limits = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if len(data) and large[-1]:
        waiting[data[-1]].append(np.array([len(data) - 1]))
    out = []
    for byte in range(256):
        bucket = []
        front = waiting[byte]
        front = np.concatenate(front) if front else np.zeros(0, np.int64)
        while len(front):
            bucket.append(front)
            before = front[front > 0] - 1
            front = before[large[before] & (data[before] == byte)]
        bucket.append(direct[limits[byte] : limits[byte + 1]])
        here = np.concatenate(bucket)
        if not len(here):
            continue
        out.append(here)
        before = here[here > 0] - 1
        before = before[large[before] & (data[before] > byte)]
        if len(before):
            first = data[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            edge = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, edge):
                waiting[data[part[0]]].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def same_prefix(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Per neighbouring pair of ``order``: whether their common prefix has ``depth``
    bytes or more."""
    left, right = order[:-1], order[1:]
    pairs = np.arange(len(left))
    # Most pairs differ early; bytes spread over the prefix rule those out.
    for at in (0, depth - 1, *range(7, depth - 1, 24)):
        pairs = pairs[data[left[pairs] + at] == data[right[pairs] + at]]
    text = data.tobytes()
    out = np.zeros(len(left), bool)
    hits = [
        k
        for k, i, j in zip(
            pairs.tolist(), left[pairs].tolist(), right[pairs].tolist(), strict=True
        )
        if text[i : i + depth] == text[j : j + depth]
    ]
    out[hits] = True
    return out


def window_runs(
    segments: list[bytes], starts: list[int], depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """(place, run) of the first ``starts[i]`` windows of every segment in suffix
    order; equal windows have the same run. A place counts from the start of all
    segments joined. Each segment has ``starts[i] - 1 + depth`` bytes at least."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    size = np.array([len(s) for s in segments], np.int64)
    begin = np.cumsum(size) - size
    count = np.array(starts, np.int64)
    asked = np.zeros(len(data) + 1, np.int8)
    np.add.at(asked, begin, 1)
    np.add.at(asked, begin + count, -1)
    asked = np.cumsum(asked[:-1]) > 0
    # A larger suffix needs its successors up to the next smaller one.
    small = np.append(np.flatnonzero(smaller_than_successor(data)), len(data) - 1)
    until = small[np.minimum(np.searchsorted(small, begin + count - 1), len(small) - 1)]
    wanted = np.zeros(len(data) + 1, np.int32)
    np.add.at(wanted, begin, 1)
    np.add.at(wanted, np.minimum(until + 1, len(data)), -1)
    order = suffix_order(data, np.cumsum(wanted[:-1]) > 0, depth)
    order = order[asked[order]]
    same = same_prefix(data, order, depth)
    run = np.concatenate(([0], np.cumsum(~same))) if len(order) else order
    return order, run

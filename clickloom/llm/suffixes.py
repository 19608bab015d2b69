"""Suffix arrays of byte strings, in numpy."""

from __future__ import annotations

import numpy as np

#: A number below the k-th of these fits in k bytes.
_BYTES_NEEDED = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one big-endian number; zeros past the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their next `depth` bytes, and the rank of each position.

    Larsson-Sadakane refinement: the order by h bytes gives that by 2h bytes, and only groups
    that are still equal are sorted again. Positions equal in all `depth` bytes share a rank and
    stand in the order of the text.
    """
    n = len(text)
    first = words_at(text)
    order = np.argsort(first, kind="stable")
    begins = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    rank = np.full(n + depth, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    h = 8
    while h < depth:
        lonely = begins & np.concatenate([begins[1:], [True]])
        at = np.flatnonzero(~lonely)
        if not len(at):
            break
        step = min(h, depth - h)
        pos = order[at]
        pair = rank[pos] * (n + 1) + rank[pos + step] + 1
        by = np.argsort(pair, kind="stable")
        pos, pair = pos[by], pair[by]
        order[at] = pos
        begins[at] = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[pos] = np.maximum.accumulate(np.where(begins[at], at, 0))
        h += step
    return order, rank[:n]


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """For each place in `order`, the bytes shared with the place before, `depth` at most.

    `order` holds the positions compared, sorted: of each string (`starts`) the first `sizes`. Kasai's
    recurrence, one step to the right loses at most one shared byte, runs for all strings side by
    side, so that a step is one vector operation. It does not hold after a full match, since equal
    positions stand in no order, nor where the right neighbour of the place before is not compared;
    there the rank tells whether the next is a full match too, and else the comparison starts anew.
    """
    n = len(text)
    word = np.concatenate([words_at(text), np.zeros(depth + 8, np.uint64)])
    place = np.full(n + 1, -1, np.int64)
    place[order] = np.arange(len(order))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(order), np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    shared, last = np.zeros(len(starts), np.int64), np.full(len(starts), n, np.int64)
    alive = len(starts)
    for j in range(int(sizes[0]) if len(sizes) else 0):
        while sizes[alive - 1] <= j:
            alive -= 1
        p = starts[:alive] + j
        q = before[p]
        known = shared[:alive]
        follows = (known < depth) & (place[np.minimum(last[:alive] + 1, n)] >= 0)
        known = np.where(follows, np.maximum(known - 1, 0), 0)
        full = (q >= 0) & (rank[p] == rank[q])
        known = np.where(full, depth, np.where(q < 0, 0, known))
        going = np.flatnonzero(~full & (q >= 0))
        while len(going):
            differ = word[p[going] + known[going]] ^ word[q[going] + known[going]]
            unequal = differ != 0
            more = 8 - np.searchsorted(_BYTES_NEEDED, differ, side="right")
            known[going] += more
            going = going[~unequal & (known[going] < depth)]
        shared[:alive] = np.minimum(known, depth)
        last[:alive] = np.where(q < 0, n, q)
        out[place[p]] = shared[:alive]
    return out


def repeated(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, times: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Which positions start `depth` bytes that start elsewhere too, and the class of each position.

    The text holds strings side by side, each counted `times` times; only positions whose bytes
    lie within one string count, and only those are compared. The class of the others is -1.
    """
    order, rank = suffix_array(text, depth)
    ends = np.zeros(len(text) + 1, np.int64)
    valid = np.maximum(sizes - depth + 1, 0)
    np.add.at(ends, starts, times)
    np.subtract.at(ends, starts + valid, times)
    weight = np.cumsum(ends[:-1])
    order = order[weight[order] > 0]
    shared = common_prefixes(text, order, rank, starts, valid, depth)
    classes = np.full(len(text), -1, np.int64)
    classes[order] = np.cumsum(shared < depth) - 1
    total = np.bincount(classes[order], weight[order], minlength=1)
    flags = np.zeros(len(text), bool)
    flags[order] = total[classes[order]] > 1
    return flags, classes

"""Blockwise suffix sorting of byte windows with a difference cover, in numpy.

A block is a buffer of byte snippets and the places where suffixes start. Suffixes are sorted by their first 32 bytes;
longer ties are resolved by ranks of a sample of places: any two places have a common distance, below the period, to
two sampled ones, so one comparison of ranks replaces a comparison of hundreds of bytes.
"""

from __future__ import annotations

import numpy as np

PREFIX = 32
# The perfect difference set of order 5; every distance modulo 31 is a difference of two members.
PERIOD, COVER = 31, np.array([0, 1, 3, 8, 12, 18])


def _shift_table() -> np.ndarray:
    """Distance to a common pair of sampled places for each pair of residues."""
    member = np.zeros(PERIOD, dtype=bool)
    member[COVER] = True
    out = np.full((PERIOD, PERIOD), PERIOD)
    for d in range(PERIOD - 1, -1, -1):
        hit = member[(np.arange(PERIOD) + d) % PERIOD]
        out[np.outer(hit, hit)] = d
    assert out.max() < PERIOD
    return out


SHIFT = _shift_table()


def _words(text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The 32 bytes at each place as four integers that compare like the bytes, least significant first."""
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    return [np.ascontiguousarray(view[at + k]).view(">u8").ravel().astype(np.uint64) for k in (24, 16, 8, 0)]


def _dense(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each element in ``order``, equal for equal keys."""
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        ranked = k[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def cover_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Rank of the sampled places by at least ``length`` bytes, by place; -1 elsewhere. ``text`` ends in padding."""
    n = len(text) - PREFIX
    places = (np.arange(0, n, PERIOD)[:, None] + COVER[None, :]).ravel()
    places = places[places < n]
    keys = _words(text, places)
    rank = _dense(np.lexsort(keys), keys)
    by_place = np.full(len(text) + 2 * length + 2 * PERIOD, -1, dtype=np.int64)
    width = PERIOD
    while True:
        by_place[places] = rank
        if width >= length or (len(rank) and rank.max() == len(rank) - 1):
            return by_place
        keys = [by_place[places + width], rank]
        rank = _dense(np.lexsort(keys), keys)
        width *= 2


def sorted_suffixes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """``starts`` in the order of their suffixes' first ``length`` bytes; ``text`` ends in ``length`` bytes of padding."""
    keys = _words(text, starts)
    order = np.lexsort(keys)
    group = _dense(order, keys)[order]
    ranks = None
    # A vectorised three-way quicksort of all ties at once: each group is split at its first suffix.
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    count = np.diff(np.r_[head, len(order)])
    todo = [(h, c) for h, c in zip(head[count > 1].tolist(), count[count > 1].tolist())]
    first = np.array([h for h, _ in todo], dtype=np.int64)
    size = np.array([c for _, c in todo], dtype=np.int64)
    while len(first):
        if ranks is None:
            ranks = cover_ranks(text, length)
        owner = np.repeat(np.arange(len(first)), size)
        slot = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + first[owner]
        place = starts[order[slot]]
        pivot = starts[order[first]][owner]
        shift = SHIFT[place % PERIOD, pivot % PERIOD]
        side = np.sign(ranks[place + shift] - ranks[pivot + shift])
        by = np.lexsort((side, owner))
        order[slot] = order[slot[by]]
        less = np.bincount(owner[side < 0], minlength=len(first))
        more = np.bincount(owner[side > 0], minlength=len(first))
        nxt_first = np.concatenate([first, first + size - more])
        nxt_size = np.concatenate([less, more])
        keep = nxt_size > 1
        first, size = nxt_first[keep], nxt_size[keep]
    return starts[order]


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Those of ``starts`` whose ``length`` bytes another start has too."""
    padded = np.concatenate([text, np.zeros(length + PREFIX, dtype=np.uint8)])
    ordered = sorted_suffixes(padded, starts, length)
    view = np.lib.stride_tricks.sliding_window_view(padded, length)
    hit = np.zeros(len(ordered), dtype=bool)
    for a in range(0, len(ordered) - 1, 8192):
        b = min(a + 8192, len(ordered) - 1)
        same = (view[ordered[a:b]] == view[ordered[a + 1: b + 1]]).all(axis=1)
        hit[a:b] |= same
        hit[a + 1: b + 1] |= same
    return ordered[hit]

"""Suffix sorting of many short strings by Lyndon-prefix groups, all strings in step.

The Lyndon prefix of a suffix reaches to the next smaller suffix. Suffixes are
grouped by it; groups in the order of their prefixes are blocks of the suffix
array, and within a group the suffixes behind the prefix decide, which lie in
lower groups. So the pointers to the next smaller suffix are found from the
right (from the suffixes others contain), the groups get their places, and
each group's order is written once from places already known: nothing is
renamed or sorted again.
"""

from __future__ import annotations

import numpy as np


class Strings:
    """Byte strings of bounded length as a matrix, 0 behind their ends, and the 8 bytes from each place on."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.width = int(self.lengths.max(initial=0))
        joined = np.frombuffer(b"".join(strings), np.uint8)
        matrix = np.zeros((len(strings), self.width + 16), np.uint8)
        inside = np.arange(self.width) < self.lengths[:, None]
        matrix[:, : self.width][inside] = joined + np.uint8(1)  # UTF-8 has no byte 255
        words = np.zeros((len(strings), self.width + 9), np.uint64)
        for k in range(8):
            words = (words << np.uint64(8)) | matrix[:, k : k + self.width + 9]
        self.words = words

    def places(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The index of each place among the words of all strings, one string after another."""
        return row * self.words.shape[1] + place

    def word(self, places: np.ndarray) -> np.ndarray:
        """The 8 bytes from these places on; behind a string's last word they are any."""
        return self.words.ravel().take(places, mode="clip")


def next_smaller(strings: Strings) -> np.ndarray:
    """For each place the next one where a smaller suffix begins; a string's end is smaller than all."""
    rows, width = len(strings.lengths), strings.width
    # Longest strings first, place by place: those that reach to a place are neighbours.
    order = np.argsort(-strings.lengths, kind="stable")
    lengths = strings.lengths[order]
    reach = np.searchsorted(-lengths, -np.arange(width), "left")
    words = np.ascontiguousarray(strings.words[order].T)
    following = np.empty((width + 1, rows), np.int32)
    following[:] = lengths
    all_words, all_following = words.ravel(), following.ravel()
    for place in range(width - 1, -1, -1):
        active, at = np.arange(reach[place]), np.full(reach[place], place + 1)
        a, b = words[place, : len(active)], words[place + 1, : len(active)]
        while len(active):
            # Whether the suffix at ``place`` precedes the one at ``at``; at a string's end stands 0, below all.
            smaller = a < b
            open_ = np.flatnonzero(a == b)
            step = 8
            while len(open_):
                row = active[open_]
                a_more = all_words.take((place + step) * rows + row)
                b_more = all_words.take((at[open_] + step) * rows + row)
                smaller[open_[a_more < b_more]] = True
                open_ = open_[a_more == b_more]
                step += 8
            following[place, active] = at  # the last one written is right
            active, a = active[smaller], a[smaller]
            at = all_following.take(at[smaller] * rows + active).astype(np.int64)
            b = all_words.take(at * rows + active)
    by_string = np.empty((rows, width + 1), np.int32)
    by_string[order] = following.T
    return by_string


# The first 0 to 8 bytes of a word.
_FIRST_BYTES = np.array([0] + [(1 << 64) - (1 << 8 * k) for k in range(7, -1, -1)], np.uint64)


def groups(strings: Strings, row: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rank of each suffix's Lyndon prefix (``size`` bytes from ``place``), eight bytes at a time."""
    rank = np.zeros(len(row), np.int64)
    open_ = np.arange(len(row))
    at = strings.places(row, place)
    step = 0
    while len(open_):
        left = size[open_] - step
        word = strings.word(at[open_] + step) & _FIRST_BYTES.take(left, mode="clip")
        order = np.lexsort((word, rank[open_])) if step else np.argsort(word)
        open_, word = open_[order], word[order]
        mine = rank[open_]
        new_group = np.append(True, mine[1:] != mine[:-1])
        new = new_group | np.append(True, word[1:] != word[:-1])
        # A suffix's rank counts those before its group: ranks of closed groups stay as they are.
        starts = np.flatnonzero(new)
        members = np.diff(starts, append=len(new))
        base = np.maximum.accumulate(np.where(new_group[starts], starts, 0))
        rank[open_] = mine + np.repeat(starts - base, members)
        step += 8
        longer = np.maximum.reduceat(size[open_], starts) > step
        open_ = open_[np.repeat((members > 1) & longer, members)]
    return rank


def suffix_places(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Strings]:
    """String, place and suffix-array position of every suffix of all strings.

    At most 2**25 bytes in all, and 2**12 in a string.
    """
    data = Strings(strings)
    if data.width >= 1 << 12 or data.lengths.sum() >= 1 << 25:
        raise ValueError("too much to sort at once")
    following = next_smaller(data)
    total = int(data.lengths.sum())
    begin = np.cumsum(data.lengths) - data.lengths
    row = np.repeat(np.arange(len(strings)), data.lengths)
    place = np.arange(total) - begin[row]
    behind = following[row, place]
    rank = groups(data, row, place, behind - place)
    # Suffixes behind the prefix; ``total`` stands for a string's end, which precedes all.
    target = np.where(behind < data.lengths[row], begin[row] + behind, total)
    group = np.append(rank, -1)
    # A prefix repeated: the more often the larger; then what follows the last decides.
    repeats = np.zeros(total, np.int64)
    pointer = np.append(target, total)
    same = np.flatnonzero(group[target] == rank)
    while len(same):
        repeats[same] += 1
        target[same] = pointer[target[same]]
        same = same[group[target[same]] == rank[same]]
    # A group alone in its place is placed; another waits for the suffixes its members point to.
    # A rank is the group's first place, so its members stand there in the order of ranks.
    position = np.append(rank, -1)
    members = np.bincount(rank, minlength=total + 1)
    by_rank = _order(rank)
    by_target = _order(target)
    pointing = np.bincount(target, minlength=total + 1)
    ends = np.cumsum(pointing)
    begins = ends - pointing
    crowded = members[np.append(rank, total)] > 1
    waits = np.bincount(rank[crowded[target] & crowded[:-1]], minlength=total + 1)
    ready = np.flatnonzero((members > 1) & (waits == 0))
    while len(ready):
        own = by_rank[_ranges(ready, ready + members[ready])]
        own = own[np.argsort(((rank[own] << 12 | repeats[own]) << 25) + position[target[own]])]
        ranks = rank[own]
        first = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
        position[own] = ranks + np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
        behind = by_target[_ranges(begins[own], ends[own])]
        told, times = np.unique(rank[behind[crowded[behind]]], return_counts=True)
        waits[told] -= times
        ready = told[waits[told] == 0]
    return row, place, position[:-1], data


def _order(values: np.ndarray) -> np.ndarray:
    """The order of at most 2**25 values of at most 2**25: sorted with their places, they need no gathering."""
    return np.sort(values << 25 | np.arange(len(values))) & ((1 << 25) - 1)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of all ranges, one range after another."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)

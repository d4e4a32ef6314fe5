"""Suffix arrays by linear grouping: Lyndon-prefix groups in descending order, then their order."""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """Group start and previous smaller suffix of each suffix of a text that ends in its one least symbol.

    Suffixes begin in groups by first symbol. From the highest group down, the members' nearest
    earlier suffix of a lower group is their previous smaller one; that suffix's known prefix is
    followed by the group's prefix, once per member that points at it, so it moves up within its
    group: above those that no member points at, and the higher the more members do. When a
    group is reached all its members have the same Lyndon prefix.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for at, suffix in enumerate(order):
        if at and text[order[at - 1]] != text[suffix]:
            start = at
        place[suffix], group[suffix] = at, start
        size[start] += 1
    before = [-1] * n
    end = n
    while end:
        low = group[order[end - 1]]
        members = order[low:end]
        members.sort()
        pointed: dict[int, int] = {}
        for suffix in members:
            p = suffix - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[suffix] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count: dict[int, list[int]] = defaultdict(list)
        for p, count in pointed.items():
            by_count[count].append(p)
        for count in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for p in by_count[count]:
                own = group[p]
                size[own] -= 1
                last = own + size[own]
                other, at = order[last], place[p]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
                moved[own] = moved.get(own, 0) + 1
            for own, number in moved.items():
                first = own + size[own]
                if first != own:
                    for at in range(first, first + number):
                        group[order[at]] = first
                size[first] = number
        end = low
    return group, before


def suffix_array(text: list[int]) -> list[int]:
    """The starts of the suffixes in ascending order; the last symbol must be the one least.

    Groups in hand, the order follows without sorting or renaming: the least suffix is known, and
    each suffix, in its turn, places the one before it, and along the previous smaller pointers
    all those not yet placed, at the next free place of their groups.
    """
    n = len(text)
    group, before = lyndon_groups(text)
    front = list(range(n))
    out = [-1] * n
    placed = [False] * n
    out[0], placed[n - 1] = n - 1, True
    for at in range(n):
        p = out[at] - 1
        while p >= 0 and not placed[p]:
            first = group[p]
            out[front[first]] = p
            front[first] += 1
            placed[p] = True
            p = before[p]
    return out


def longest_shared(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For distinct strings, the leading symbols each shares with any other, and with any lesser one.

    The strings are joined, each followed by a 0 below all symbols; in the order of the suffixes
    that begin a string, the most similar string stands next to it.
    """
    lengths = np.array([len(s) for s in strings])
    if len(strings) < 2:
        return np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
    joined = np.zeros(int(lengths.sum()) + len(strings) + 1, np.int64)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    inside = np.ones(len(joined), bool)
    inside[starts + lengths] = False
    inside[-1] = False
    joined[inside] = np.unique(np.concatenate(strings), return_inverse=True)[1] + 2
    joined[~inside] = 1
    joined[-1] = 0
    owner = np.full(len(joined), -1)
    owner[starts] = np.arange(len(strings))
    ranked = owner[np.array(suffix_array(joined.tolist()))]
    ranked = ranked[ranked >= 0]
    left, right = starts[ranked[:-1]], starts[ranked[1:]]
    most = np.minimum(lengths[ranked[:-1]], lengths[ranked[1:]])
    common, live = np.zeros(len(left), np.int64), np.arange(len(left))
    while len(live):
        live = live[common[live] < most[live]]
        live = live[joined[left[live] + common[live]] == joined[right[live] + common[live]]]
        common[live] += 1
    out = np.zeros(len(strings), np.int64)
    np.maximum.at(out, ranked[:-1], common)
    np.maximum.at(out, ranked[1:], common)
    lesser = np.zeros(len(strings), np.int64)
    lesser[ranked[1:]] = common
    return out, lesser

"""Suffix arrays by linear grouping construction, and longest common prefixes."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order; a prefix comes before what it begins.

    First, suffixes are grouped by their longest Lyndon prefix. Groups start out by first symbol and
    are worked in descending order: each member points to the nearest suffix before it of a lower
    group (its previous smaller one), found by hopping over pointers already set. The suffixes
    pointed to, taken by how many members point to them, most first, extend their own Lyndon prefix
    by so many copies of this group's and move to new groups right above their old ones. Then the
    groups, in order, already separate suffixes by Lyndon prefix; within a group, suffixes follow
    the order of what they end in. Going through the order from its smallest element, each placed
    suffix puts the one before it, and that one's chain of previous smaller ones, at the next place
    of its group. No recursion and no renaming of symbols.
    """
    n = len(text)
    if n < 2:
        return list(range(n))
    members: list[list[int]] = []
    symbols: dict[int, int] = {}
    group = [0] * n
    for symbol in sorted(set(text)):
        symbols[symbol] = len(members)
        members.append([])
    for i, symbol in enumerate(text):
        g = group[i] = symbols[symbol]
        members[g].append(i)
    # Groups as a linked order; a new group is linked in right above its old one.
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    moved = [False] * len(members)
    size, apart = [len(inside) for inside in members], len(members)  # apart: groups that are not empty
    previous, done = [-1] * n, [False] * (n + 1)  # the last is that of place -1, before the text
    final: list[tuple[int, int]] = []  # group and size, highest first
    top = highest = len(members) - 1
    above[top] = -1
    while top >= 0:
        if apart == n:  # a suffix a group: the groups are in order already
            holds = dict(zip(group, range(n)))
            order = []
            while highest >= 0:
                if size[highest]:
                    order.append(holds[highest])
                highest = below[highest]
            order.reverse()
            return order
        alone = size[top]
        if not alone:
            top = below[top]
            continue
        inside = members[top]
        if moved[top]:
            inside = [i for i in inside if group[i] == top]
        final.append((top, alone))
        if alone == 1:
            i = inside[0]
            p = i - 1
            while done[p]:
                p = previous[p]
            previous[i] = p
            done[i] = True
            levels = [[p]] if p >= 0 and size[group[p]] > 1 else []
        else:
            pointed = []
            for i in inside:
                p = i - 1
                while done[p]:
                    p = previous[p]
                previous[i] = p
                done[i] = True
                if p >= 0:
                    pointed.append(p)
            once = dict.fromkeys(pointed)
            if len(once) == len(pointed) or len(once) == 1:
                levels = [list(once)] if once else []
            else:
                times: dict[int, int] = {}
                for p in pointed:
                    times[p] = times.get(p, 0) + 1
                by_times: dict[int, list[int]] = {}
                for p, t in times.items():
                    by_times.setdefault(t, []).append(p)
                levels = [by_times[t] for t in sorted(by_times, reverse=True)]
        for level in levels:
            if len(level) == size[group[level[0]]] and len({group[p] for p in level}) == 1:
                continue  # all of a group, which stays where it is
            fresh: dict[int, int] = {}
            for p in level:
                old = group[p]
                new = fresh.get(old)
                if new is None:
                    if size[old] == 1:
                        continue
                    new = fresh[old] = len(members)
                    members.append([])
                    moved.append(False)
                    size.append(0)
                    apart += 1
                    moved[old] = True
                    below.append(old)
                    above.append(above[old])
                    below[above[old]] = new
                    above[old] = new
                members[new].append(p)
                group[p] = new
                size[new] += 1
                size[old] -= 1
                if not size[old]:
                    apart -= 1
        top = below[top]
    place, at = [0] * len(members), 0
    for g, count in reversed(final):
        place[g] = at
        at += count
    order, put = [0] * n, [False] * n
    k, j = -1, n - 1  # as if an empty suffix came first
    while True:
        while j >= 0 and not put[j]:
            put[j] = True
            order[place[group[j]]] = j
            place[group[j]] += 1
            j = previous[j]
        k += 1
        if k == n:
            return order
        j = order[k] - 1


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Of each suffix in order, how many symbols it shares with the one before it."""
    n = len(text)
    rank = [0] * n
    for k, i in enumerate(order):
        rank[i] = k
    out, h = [0] * n, 0
    for i in range(n):
        if not rank[i]:
            h = 0
            continue
        j = order[rank[i] - 1]
        while i + h < n and j + h < n and text[i + h] == text[j + h]:
            h += 1
        out[rank[i]] = h
        h = max(0, h - 1)
    return out


def common_prefix(a: bytes, b: bytes) -> int:
    """How many bytes two texts share from their start."""
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differing.bit_length() + 7) // 8

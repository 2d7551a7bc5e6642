"""Suffix arrays by grouping suffixes by their longest Lyndon prefix.

Phase one keeps the suffixes in ordered groups, at first by symbol, and goes through the groups from the highest down. A group that is
reached is final: its members' longest Lyndon prefixes are the same word u. Each member's parent is the nearest suffix to its left that is in
no group reached so far, which is the previous smaller suffix; pointers over the reached ones are shortened as they
are followed. A parent's own Lyndon prefix goes on with u as often as it has children in the group, so the parents leave their group
for new ones directly above it, by ascending number of children. Every move belongs to a suffix's edge to its parent: n moves in all.

Phase two fills the groups, lowest first. Inside a group, order is that of the suffixes that follow the Lyndon prefix, and these are the next
smaller ones. So when the suffix s takes its place, all suffixes that s is the next smaller one of (s - 1 and its chain of parents, up to the
parent of s) take the next free places of their groups. No symbols are renamed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(s: list[int]) -> list[int]:
    """Start positions of the suffixes of s in ascending order; a suffix that is a prefix of another comes before it."""
    n = len(s)
    if n == 0:
        return []
    members: list[list[int]] = []
    number = {c: g for g, c in enumerate(sorted(set(s)))}
    members = [[] for _ in number]
    of = [0] * n
    for i, c in enumerate(s):
        g = number[c]
        of[i] = g
        members[g].append(i)
    size = [len(m) for m in members]
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    parent = [-1] * n
    jump = list(range(-1, n - 1))
    reached = bytearray(n)
    final: list[tuple[int, int]] = []  # (group, size), highest first

    g = len(members) - 1
    while g >= 0:
        m = members[g] if len(members[g]) == size[g] else [i for i in members[g] if of[i] == g]
        members[g] = []
        final.append((g, len(m)))
        for i in m:
            reached[i] = 1
        children: dict[int, int] = {}
        for i in m:
            p = jump[i]
            if p >= 0 and reached[p]:
                q = i
                while p >= 0 and reached[p]:
                    jump[q] = r = jump[p]  # halves the path
                    q, p = p, r
                jump[i] = p
            parent[i] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
        if len(children) == 1:
            (p,) = children
            h = of[p]
            if size[h] > 1:
                _above(h, [p], of, members, size, below, above)
        elif children:
            by: dict[tuple[int, int], list[int]] = {}
            for p, c in children.items():
                by.setdefault((of[p], c), []).append(p)
            if len(by) == 1:
                ((h, _),) = by
                ps = by[h, _]
                if size[h] > len(ps):
                    _above(h, ps, of, members, size, below, above)
            else:
                at: dict[int, int] = {}
                for h, c in sorted(by):
                    ps = by[h, c]
                    if h in at or size[h] > len(ps):
                        at[h] = _above(at.get(h, h), ps, of, members, size, below, above, h)
        g = below[g]

    free, at = {}, 0
    for g, k in reversed(final):
        free[g] = at
        at += k
    out = [-1] * n
    j = n - 1
    while j >= 0:
        f = of[j]
        out[free[f]] = j
        free[f] += 1
        j = parent[j]
    for k in range(n):
        i = out[k]
        j, stop = i - 1, parent[i]
        while j != stop:
            f = of[j]
            out[free[f]] = j
            free[f] += 1
            j = parent[j]
    return out


def _above(at: int, ps: list[int], of: list[int], members: list[list[int]], size: list[int], below: list[int], above: list[int], home: int = -1) -> int:
    """Moves ps from their group (home, or at) to a new one directly above `at`."""
    new, up = len(members), above[at]
    members.append(ps)
    size.append(len(ps))
    below.append(at)
    above.append(up)
    above[at] = new
    if up >= 0:
        below[up] = new
    size[home if home >= 0 else at] -= len(ps)
    for p in ps:
        of[p] = new
    return new

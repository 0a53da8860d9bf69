"""Suffix sorting by linear grouping, without recursive renaming (Baier's construction)."""

from __future__ import annotations

from tidewatch.shipping import ship_by_value

ship_by_value(__name__)


def suffix_array(symbols: list[int]) -> list[int]:
    """The order of all suffixes of ``symbols``.  A suffix that is a prefix of another comes before it.

    First phase: suffixes are grouped by their first symbol, and groups are taken from the greatest to the least.  The
    previous-smaller pointer of a suffix leads to the nearest suffix before it in a lesser group.  Suffixes that l
    members of the group taken point at are followed by l repetitions of its prefix: they move to a new group right
    behind their own.  In the end each group holds the suffixes with one longest Lyndon prefix.

    Second phase: going through the suffixes in order, the suffix before each of them, and those that pointers lead to
    from there, are next in their groups.
    """
    n = len(symbols)
    firsts: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        firsts.setdefault(s, []).append(i)
    # Group 0 holds the empty suffix, the least of all.
    members, group = [[n], *(firsts[s] for s in sorted(firsts))], [0] * (n + 1)
    for g, those in enumerate(members):
        for i in those:
            group[i] = g
    # The list of groups in order, linked both ways.
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    prev, taken_already, order = [-1] * (n + 1), [False] * (n + 1), []
    g = len(members) - 1
    while g >= 0:
        taken = sorted(i for i in members[g] if group[i] == g)
        if taken:
            order.append((g, len(taken)))
        pointed: dict[int, int] = {}
        for i in taken:
            j = i - 1
            while j >= 0 and taken_already[j]:
                j = prev[j]
            prev[i] = j
            taken_already[i] = True
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, count in pointed.items():
            by_count.setdefault(count, []).append(j)
        # Those before more repetitions move first; those before fewer then get their place in front of them.
        for count in sorted(by_count, reverse=True):
            moved: dict[int, list[int]] = {}
            for j in by_count[count]:
                moved.setdefault(group[j], []).append(j)
            for old, those in moved.items():
                new, after = len(members), above[old]
                members.append(those)
                below.append(old)
                above.append(after)
                above[old] = new
                if after >= 0:
                    below[after] = new
                for j in those:
                    group[j] = new
        g = below[g]

    free, at = {}, 0
    for g, size in reversed(order):
        free[g] = at
        at += size
    out, placed = [-1] * (n + 1), [False] * (n + 1)
    out[0], placed[n] = n, True
    for k in range(n + 1):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = prev[j]
    return out[1:]

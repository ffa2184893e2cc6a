"""Suffix array by linear grouping: suffixes are grouped by their Lyndon prefix, then groups are put in order.

First phase. Suffixes start in groups of equal first symbol, and groups are taken in descending order. Every
suffix of a group points to the nearest suffix before it in a lower group (previous smaller). Suffixes that are
pointed to continue with the group's prefix, so within their own group those pointed to more often are greater:
they are split off as new groups right above it. At the end every group shares one Lyndon prefix.

Second phase. From the least suffix on, the suffix before each emitted one, and those reached from it by pointers,
take the next free places of their groups, until one is met that has its place. No names are assigned anew.
"""


def suffix_array(symbols: list[int]) -> list[int]:
    """Order of the suffixes of a list whose last symbol is its unique least one."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    # groups are numbered as they arise; above[g] is the next greater group, below[g] the next lesser
    distinct = sorted(set(symbols))
    number = {s: g for g, s in enumerate(distinct)}
    group = [number[s] for s in symbols]
    members: list[list[int]] = [[] for _ in distinct]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]  # members that have left a group are dropped when its turn comes
    above = [g + 1 for g in range(len(distinct))]
    above[-1] = -1
    below = [g - 1 for g in range(len(distinct))]
    done = [False] * len(distinct)
    pointer = [-1] * n
    current = len(distinct) - 1
    while current >= 0:
        own = members[current] = [i for i in members[current] if group[i] == current]
        done[current] = True
        counts: dict[int, int] = {}
        for i in own:  # ascending, so pointers of earlier members are known
            p = i - 1
            while p >= 0 and done[group[p]]:
                p = pointer[p]
            pointer[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, k in counts.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):
            by_group: dict[int, list[int]] = {}
            for p in by_times[k]:
                by_group.setdefault(group[p], []).append(p)
            for g, chosen in by_group.items():
                if len(chosen) == size[g]:
                    continue
                new = len(members)
                chosen.sort()
                members.append(chosen)
                for p in chosen:
                    group[p] = new
                size[g] -= len(chosen)
                size.append(len(chosen))
                up = above[g]
                above.append(up)
                below.append(g)
                done.append(False)
                above[g] = new
                if up >= 0:
                    below[up] = new
        current = below[current]
    # second phase
    free = [0] * len(members)
    g, place = 0, 0
    while below[g] >= 0:
        g = below[g]
    while g >= 0:
        free[g] = place
        place += size[g]
        g = above[g]
    order = [-1] * n
    placed = [False] * n
    order[0] = n - 1
    placed[n - 1] = True
    free[group[n - 1]] += 1
    for at in range(n):
        j = order[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = pointer[j]
    return order


def repeated_windows(texts: list[bytes], size: int) -> list[list[tuple[int, int]]]:
    """For each text the ranges [first, last) of starts whose ``size`` bytes also start elsewhere in the texts."""
    ends, symbols = [], []
    whole = bytearray()
    for k, t in enumerate(texts):
        whole += b"\1" * max(0, len(t) - size + 1)
        whole += bytes(len(t) + 1 - max(0, len(t) - size + 1))
        symbols.extend(b + len(texts) for b in t)
        symbols.append(len(texts) - 1 - k)  # each end is a symbol of its own, the last one the least
        ends.append(len(symbols))
    joined = b"\0".join(texts) + b"\0"
    order = suffix_array(symbols)
    flags = bytearray(len(symbols))
    last_start, last = -1, b""
    for start in order:
        if not whole[start]:  # it ends behind its text
            continue
        own = joined[start:start + size]
        if own == last and last_start >= 0:
            flags[start] = flags[last_start] = 1
        last_start, last = start, own
    out, begin = [], 0
    for end, t in zip(ends, texts):
        own = flags[begin:begin + max(0, len(t) - size + 1)]
        ranges, at = [], 0
        while (first := own.find(1, at)) >= 0:
            at = own.find(0, first)
            at = len(own) if at < 0 else at
            ranges.append((first, at))
        out.append(ranges)
        begin = end
    return out

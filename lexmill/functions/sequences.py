"""Longest common subsequences of two lists, in a time that grows with their length times their differences."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


def common(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Places (in ``a``, in ``b``) of a longest common subsequence; of several, one that takes what ``a`` has alone first.

    Greedy paths by number of differences: what is kept are the furthest reaches of each number, so equal lists cost
    one walk and memory grows with the square of the differences alone.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    reach, trail = {1: 0}, []
    for d in range(len(x) + len(y) + 1):
        trail.append(dict(reach))
        for k in range(-d, d + 1, 2):
            i = reach[k + 1] if k == -d or (k != d and reach[k - 1] < reach[k + 1]) else reach[k - 1] + 1
            while i < len(x) and i - k < len(y) and x[i] == y[i - k]:
                i += 1
            reach[k] = i
            if i >= len(x) and i - k >= len(y):
                break
        else:
            continue
        break
    middle, i, j = [], len(x), len(y)
    for d in range(len(trail) - 1, -1, -1):
        k, was = i - j, trail[d]
        from_ = k + 1 if k == -d or (k != d and was[k - 1] < was[k + 1]) else k - 1
        i0 = was[from_] if d else 0
        j0 = i0 - from_ if d else 0
        start = (0, 0) if not d else (i0, j0 + 1) if from_ == k + 1 else (i0 + 1, j0)
        while (i, j) != start:
            i, j = i - 1, j - 1
            middle.append((i, j))
        i, j = i0, j0
    middle.reverse()
    out = [(t, t) for t in range(head)] + [(i + head, j + head) for i, j in middle]
    return out + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]


def aligned(old: Sequence[tuple], new: Sequence[tuple]) -> list[tuple[str, int | None, int | None]]:
    """(kind, place in ``old``, place in ``new``) of what differs between two lists of (href, text).

    What stands between the members of a longest common subsequence is compared by text alone: equal texts in order are
    ``retarget``, the rest is ``only_old`` or ``only_new``.
    """
    out, i, j = [], 0, 0
    for a, b in [*common(old, new), (len(old), len(new))]:
        same = common([x[1] for x in old[i:a]], [x[1] for x in new[j:b]])
        out += [("retarget", i + p, j + q) for p, q in same]
        out += [("only_old", i + p, None) for p in range(a - i) if p not in {s[0] for s in same}]
        out += [("only_new", None, j + q) for q in range(b - j) if q not in {s[1] for s in same}]
        i, j = a + 1, b + 1
    return out

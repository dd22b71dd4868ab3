"""Levenshtein distance of whole texts, as an Arrow function: a column of the table is one integer's bits."""

from operator import ne

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def _shared(a: str, b: str, i: int, j: int) -> int:
    """How many signs from a[i] and b[j] on are equal: slices are compared, longer and longer, then halved."""
    most, n, step = min(len(a) - i, len(b) - j), 0, 16
    while step <= most - n and a[i + n : i + n + step] == b[j + n : j + n + step]:
        n, step = n + step, step * 2
    step = min(step, most - n)
    while step:
        if n + step <= most and a[i + n : i + n + step] == b[j + n : j + n + step]:
            n += step
        else:
            step //= 2
    return n


def _within(a: str, b: str) -> bool:
    """Is b what is left of a when signs of a are taken out?"""
    at, find = 0, a.find
    for c in b:
        at = find(c, at) + 1
        if not at:
            return False
    return True


def _at_least(a: str, b: str) -> int:
    """A bound from below: the signs that either text has more often."""
    both = set(a) | set(b)
    more = [a.count(c) - b.count(c) for c in both]
    return max(sum(x for x in more if x > 0), -sum(x for x in more if x < 0))


#: Where two texts go on alike after a change, nearest first: signs of either that the change takes.
_STEPS = sorted(((p, q) for p in range(9) for q in range(9) if p or q), key=lambda s: (max(s), -min(s)))


def _at_most(a: str, b: str) -> int:
    """A bound from above: the cost of one alignment, found change by change, until it loses its way."""
    i = j = cost = 0
    while True:
        n = _shared(a, b, i, j)
        i, j = i + n, j + n
        if i == len(a) or j == len(b):
            return cost + len(a) - i + len(b) - j
        for alike in (12, 5, 2):
            step = next(((p, q) for p, q in _STEPS if (x := a[i + p : i + p + alike]) == b[j + q : j + q + alike] and len(x) == alike), None)
            if step:
                break
        else:
            return cost + max(len(a) - i, len(b) - j)
        i, j, cost = i + step[0], j + step[1], cost + max(step)


def distance(a: str, b: str) -> int:
    """Exact, in code points. Equal heads and tails go first. Most edits need no table then: signs were only taken out or
    put in, or the bounds from below and above are the same. The others take a step for each sign of the longer text."""
    if a == b:
        return 0
    head = _shared(a, b, 0, 0)
    a, b = a[head:][::-1], b[head:][::-1]
    tail = _shared(a, b, 0, 0)
    b, a = sorted((a[tail:], b[tail:]), key=len)
    if not b or b in a or len(b) < len(a) and _within(a, b):
        return len(a) - len(b)
    if len(a) <= 8:
        return _columns(a, b)
    least = max(len(a) - len(b), _at_least(a, b))
    if len(a) == len(b) and (most := sum(map(ne, a, b))) == least:
        return least
    most = min(_at_most(a, b), most if len(a) == len(b) else len(a))
    if most == least:
        return least
    # either's time, about: the diagonals grow with the square of the changes, the columns with both lengths
    return _diagonals(a, b, most) if most * most < len(a) * (2 + len(b) / 500) else _columns(a, b)


def _diagonals(a: str, b: str, most: int) -> int:
    """The distance if it is under `most`, or else `most`: how far each diagonal gets with 0, 1, 2, ... changes."""
    goal = len(a) - len(b)
    far = {}  # diagonal (place in a less place in b): place in a
    for e in range(most):
        now = {}
        for k in range(max(-e, goal - most + e + 1), min(e, goal + most - e - 1) + 1):
            i = max(far.get(k - 1, -2) + 1, far.get(k, -2) + 1, far.get(k + 1, -2)) if e else 0
            i = min(i, len(a), len(b) + k)
            if i < max(0, k):
                continue
            if i < len(a) and i - k < len(b) and a[i] == b[i - k]:
                i += _shared(a, b, i, i - k)
            if k == goal and i == len(a):
                return e
            now[k] = i
        far = now
    return most


def _columns(a: str, b: str) -> int:
    """The distance of two texts, b not empty and not the longer one, a column of the table for each sign of a."""
    m = len(b)
    places = {c: int("".join("1" if x == c else "0" for x in reversed(b)), 2) for c in set(b)}
    full, top, score = (1 << m) - 1, m - 1, m
    more, less = full, 0  # places of the column that are one more, or one less, than the place before
    for c in a:
        eq = places.get(c, 0)
        down = eq | less
        side = (((eq & more) + more) ^ more) | eq
        up, low = less | (full ^ ((side | more) & full)), more & side
        score += (up >> top & 1) - (low >> top & 1)
        up, low = ((up << 1) | 1) & full, (low << 1) & full
        more, less = low | (full ^ (down | up)), up & down
    return score


def _distances(old: pd.Series, new: pd.Series) -> pd.Series:
    pairs = zip(old, new, strict=True)
    return pd.Series([None if a is None or b is None else distance(a, b) for a, b in pairs], dtype="Int32")


#: Named non-deterministic only so that filters on the distance do not compute it once more.
edit_distance = F.pandas_udf(_distances, IntegerType()).asNondeterministic()

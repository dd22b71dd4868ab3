"""Sentence BLEU without smoothing, four grams, uniform weights, as an Arrow function."""

import math
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TOKEN = re.compile(r"[^\W]+|[^\w\s]")


def _missing(reference: list[str], candidate: list[str], n: int) -> int:
    """How many of the candidate's n-grams the reference has not, each as often as the candidate has it."""
    have = Counter(zip(*(reference[i:] for i in range(n)), strict=False))
    left, out = have.get, 0
    for g in zip(*(candidate[i:] for i in range(n)), strict=False):
        k = left(g)
        if k:
            have[g] = k - 1
        else:
            out += 1
    return out


def bleu(reference: list[str], candidate: list[str], order: int = 4) -> float:
    """0 without a shared word; a higher order without overlap counts as the smallest normal float."""
    r, c = len(reference), len(candidate)
    most = min(r, c)
    head = next((i for i in range(most) if reference[i] != candidate[i]), most) if reference != candidate else most
    tail = next((i for i in range(most - head) if reference[-1 - i] != candidate[-1 - i]), most - head)
    logs = 0.0
    for n in range(1, order + 1):
        total = max(0, c - n + 1)
        # n-grams within an equal head or tail stand on both sides: they take nothing from each other's matches
        a, b = max(0, head - n + 1), max(0, tail - n + 1)
        hit = total - (_missing(reference[a : r - b], candidate[a : c - b], n) if head < c or head < r else 0)
        if n == 1 and not hit:
            return 0.0
        p = hit / max(1, total)
        logs += math.log(p if hit else sys.float_info.min) / order
    penalty = 1.0 if c > r else (math.exp(1 - r / c) if c else 0.0)
    return penalty * math.exp(logs)


@F.arrow_udf(DoubleType())
def _scored(old: pa.Array, new: pa.Array) -> pa.Array:
    """Old text as reference, new text as candidate; null counts as empty. Texts are read one at a time: a batch of whole
    documents never stands a second time as Python strings."""
    pairs = ((a.as_py() or "", b.as_py() or "") for a, b in zip(old, new, strict=True))
    return pa.array((bleu(_TOKEN.findall(a), _TOKEN.findall(b)) for a, b in pairs), pa.float64())


#: Named non-deterministic only so that filters on the score do not compute it once more.
bleu_score = _scored.asNondeterministic()

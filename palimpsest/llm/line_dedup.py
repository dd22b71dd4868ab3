"""Line-level deduplication by pairwise alignment.

The shortest runs of lines with MIN_WORDS words or more, from each line on and up to each line (one line, if it is
long enough), link each document that holds them to the first document that does. Any block of that many words consists
of such runs, so every such block that a document shares with an earlier one makes a pair with its first holder. A run,
however common, gives one pair for each later holder, never the pairs among its holders, and none is left out; pairs
found by several runs count once. (So no run has to be left out for being common, and rare ones need no choosing.) Each
pair's whole line sequences are aligned by patience diff (common heads and tails, then lines unique on both sides in their
longest common order, then between those again; last come blocks that moved or stand once more), and the aligned blocks
that hold MIN_WORDS words are deleted from the later document. An alignment may tear a shared run apart (of lines that
stand several times), and no other pair would give it: so runs that are not in an aligned block are looked up among all
of the first holder's, and go too. Blank lines inside a block go with it.

A first holder's lines travel once for each BLOCK of its later holders, not with each of them, and such blocks are
aligned in tasks of their own.

Documents are in the order of doc_id, null last, then of a hash of the text. Rows alike in both are one document and
share its fate: they are not compared with each other.

Defined cases: null text has no lines and stays null; a text of blank lines stays as it is; a document all of whose
lines are deleted gets an empty text; lines are compared without white space at their ends; an empty table gives an
empty result; columns other than doc_id and text are carried through unchanged, whatever their names, but that columns
named n_lines or deleted give way to the result's in `dedup_lines`.
"""

from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.common import cut, read

MIN_WORDS = 5
#: Later holders that are aligned with a first holder in one go.
BLOCK = 1024


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by their second place, whose first places rise too."""
    ends, piles, back = [], [], []
    for k, (i, _) in enumerate(pairs):
        p = bisect_left(ends, i)
        back.append(piles[p - 1] if p else -1)
        if p == len(ends):
            ends.append(i), piles.append(k)
        else:
            ends[p], piles[p] = i, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (in a, in b) of equal items, rising on both sides."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: i for i, x in enumerate(a[a0:a1], a0) if na[x] == 1 and nb.get(x) == 1}
        anchors = _in_order([(where[x], j) for j, x in enumerate(b[b0:b1], b0) if x in where])
        if anchors:
            for (i, j), (i1, j1) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
                todo.append((i + 1, i1, j + 1, j1))
            out += anchors
            continue
        # no line is unique on both sides: each of b's takes the next one of a's
        places: dict = {}
        for i in range(a0, a1):
            places.setdefault(a[i], []).append(i)
        at = a0 - 1
        for j in range(b0, b1):
            of = places.get(b[j], ())
            k = bisect_right(of, at)
            if k < len(of):
                at = of[k]
                out.append((at, j))
    return sorted(out)


def _moved(a: list, b: list, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Lines of b that are left over, in b's order, with a place in a: the one after the last match if that is equal, or
    the first place that nothing took, or the first of all (a block that b has more often than a)."""
    used, done = {i for i, _ in pairs}, {j for _, j in pairs}
    first: dict = {}
    for free in (False, True):  # free places are written last, over taken ones
        for i in range(len(a) - 1, -1, -1):
            if (i not in used) == free:
                first[a[i]] = i
    out, at = [], -1
    for j, x in enumerate(b):
        if j in done or x not in first:
            at = -1
            continue
        at = at + 1 if 0 <= at < len(a) - 1 and a[at + 1] == x else first[x]
        out.append((at, j))
    return out


class Holder(list):
    """The lines of a document, none of them blank, with its stretches of so many lines."""

    def __init__(self, lines: list):
        super().__init__(lines)
        self._stretches: dict[int, set] = {}

    def has(self, stretch: list) -> bool:
        n = len(stretch)
        if n not in self._stretches:  # a shortest run has `least` lines at most
            self._stretches[n] = {tuple(self[i : i + n]) for i in range(len(self) - n + 1)}
        return tuple(stretch) in self._stretches[n]


def common_lines(a: list, b: list, words: list[int], least: int = MIN_WORDS) -> list[int]:
    """Places in b of aligned blocks with `least` words or more; blocks that moved are aligned after the others. Then
    those of the shortest runs that a has, too, and no aligned block holds."""
    out, block, size = [], [], 0
    last = (-2, -2)
    pairs = patience(a, b)
    for i, j in [*pairs, (-9, -9), *_moved(a, b, pairs), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if size >= least:
                out += block
            block, size = [], 0
        if j >= 0:
            block.append(j)
            size += words[j]
        last = (i, j)
    done, a = set(out), a if isinstance(a, Holder) else Holder(a)
    torn = [(i, j) for i, j in runs(words, least) if not done.issuperset(range(i, j)) and a.has(b[i:j])]
    return sorted(done.union(*(range(i, j) for i, j in torn)))


def without_lines(text: str, gone: list[int]) -> str:
    """text without these of its lines that are not blank (counted from 0), and the blank ones between two of them."""
    drop, kept, k, held, cutting = set(gone), [], -1, [], False
    for line in text.split("\n"):
        if not line.strip():
            held.append(line)
            continue
        k += 1
        now = k in drop
        if not (now and cutting):
            kept += held
        held, cutting = [], now
        if not now:
            kept.append(line)
    return "\n".join(kept + ([] if cutting and not kept else held)) if drop else text


def runs(words: list[int], least: int) -> set[tuple[int, int]]:
    """(from, to) of the shortest run with `least` words from each line on, and of that up to each line."""
    out, i, size = set(), 0, 0
    for j, n in enumerate(words):  # i: the last start of a run up to j
        size += n
        while size - words[i] >= least:
            size -= words[i]
            i += 1
        if size >= least:
            out.add((i, j + 1))
    j, size = 0, 0
    for i, n in enumerate(words):  # j: the first end of a run from i on
        while size < least and j < len(words):
            size += words[j]
            j += 1
        if size < least:
            break
        out.add((i, j))
        size -= n
    return out


def _lines(least: int):
    def run(batches):
        for b in batches:
            keys, words, hashes = [], [], []
            for text in b.column("text"):
                lines = [x for x in (text.as_py() or "").split("\n") if x.strip()]
                key, n = b"".join(xxhash.xxh3_128_digest(x.strip()) for x in lines), [len(x.split()) for x in lines]
                keys.append(key), words.append(n)
                found = {xxhash.xxh3_64_intdigest(key[16 * i : 16 * j]) for i, j in runs(n, least)}
                hashes.append(np.fromiter(found, np.uint64, len(found)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("nul", "id", "th")), pa.array(keys, pa.binary()),
                 pa.array([x.tolist() for x in hashes], pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))],
                ["nul", "id", "th", "keys", "hs", "words"],
            )

    return run


_OUT = ["nul", "id", "th", "gone"]


def _hashes(keys: bytes) -> list[bytes]:
    return [keys[i : i + 16] for i in range(0, len(keys), 16)]


def _aligned(least: int):
    """Rows come in runs: a first holder, then the later holders to be aligned with it."""

    def run(batches):
        old = Holder([])
        for b in batches:
            at, gone = [], []
            for k, (later, keys) in enumerate(zip(b.column("later").to_pylist(), b.column("keys"), strict=True)):
                lines = _hashes(keys.as_py())
                if not later:
                    old = Holder(lines)
                    continue
                found = common_lines(old, lines, b.column("words")[k].as_py(), least)
                if found:
                    at.append(k), gone.append(found)
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in _OUT[:3]), pa.array(gone, pa.list_(pa.int32()))], _OUT)

    return run


def _cut_out(batches):
    for b in batches:
        new, n, gone = [], [], []
        for text, lines in zip(b.column("text"), b.column("gone"), strict=True):
            text, lines = text.as_py(), lines.as_py()
            n.append(0 if text is None else sum(1 for x in text.split("\n") if x.strip()))
            new.append(without_lines(text, lines) if lines else text)
            gone.append(lines or [])
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(new, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
            ["row", "text", "n_lines", "deleted"],
        )


def _key(text: Column) -> dict[str, Column]:
    return {"nul": F.col("doc_id").isNull(), "id": F.col("doc_id"), "th": F.xxhash64(text)}


KEY = ["nul", "id", "th"]


def deletions(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """nul, id, th, gone: places (among lines that are not blank) to delete from each document that loses any."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = f"nul boolean, id {kind}, th bigint"
    some = docs.filter(F.length("text") > 0).select(*[c.alias(k) for k, c in _key(F.col("text")).items()], "text")
    lines = cut(some.mapInArrow(_lines(least), f"{own}, keys binary, hs array<bigint>, words array<int>"))
    who = F.struct(F.col("nul"), F.col("id"), F.col("th"))
    held = lines.select(who.alias("k"), F.explode("hs").alias("h"))
    firsts = held.groupBy("h").agg(F.min("k").alias("a"), F.max("k").alias("z")).filter("a <> z").select("h", "a")
    pairs = held.join(firsts, "h").filter("k <> a").select("a", F.col("k").alias("b")).distinct()
    lines = lines.select(who.alias("k"), "keys", "words")
    # a document that is the first of many is a hot key of the joins, which Spark splits, and is dealt to blocks by them
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    pairs = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("s"), "b")
    holders = lines.withColumnRenamed("k", "a").join(many, "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("s"), F.lit(False).alias("later"),
        F.lit(None).cast("boolean").alias("nul"), F.lit(None).cast(kind).alias("id"), F.lit(None).cast("bigint").alias("th"),
        "keys", F.lit(None).cast("array<int>").alias("words"),
    )
    later = pairs.join(lines.withColumnRenamed("k", "b"), "b").select("a", "s", F.lit(True).alias("later"), "b.nul", "b.id", "b.th", "keys", "words")
    runs_ = holders.unionByName(later).repartition("a", "s").sortWithinPartitions("a", "s", "later")
    gone = runs_.mapInArrow(_aligned(least), f"{own}, gone array<int>")
    return gone.groupBy(*KEY).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def deduped(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """row (docs' columns but text, as one), text without the repeated blocks, n_lines (before, blank ones not counted)
    and `deleted`."""
    gone = cut(deletions(docs.select("doc_id", "text"), least))
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    keyed = docs.select(rest, "text", *[c.alias(f"_{k}") for k, c in _key(F.col("text")).items()])
    on = [F.col(f"_{k}").eqNullSafe(gone[k]) for k in KEY]
    marked = keyed.join(gone, on[0] & on[1] & on[2], "left").select("row", "text", "gone")
    out = T.StructType([marked.schema["row"]]).add("text", "string").add("n_lines", "long").add("deleted", T.ArrayType(T.IntegerType()))
    return marked.mapInArrow(_cut_out, out)


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with the repeated blocks gone from `text`, and n_lines and `deleted`."""
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "deleted")]
    return deduped(docs, least).select(*(F.col(f"row.`{c}`") for c in rest), "text", "n_lines", "deleted")


def op4(spark, sf_dir):
    """doc_id, n_lines, deleted, n_chars, text_sha256 (null for null) of every document after line dedup."""
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "deleted", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))

"""Bulk-synchronous best-fit packing of tokenised documents into sequences of a fixed number of tokens.

Lengths are taken in bands, from long to short, as best-fit decreasing would. For a band, documents and the gaps of the
sequences so far are sorted by length, and a sweep from long to short finds each document's successor, the smallest gap
that holds it and that no document before it took. That is the matching of brackets: gaps open, documents close, and what
stands on one level belongs together. Levels come from counts by length and from ranks within a length, so a sweep is a
few shuffles of slim rows, with no order of all rows in one task. Documents that want one gap are told apart by rank; a
gap with room for several of the band's longest stands for as many places. Then gaps are updated, and the next sweep
follows, until one places nothing: each fills a good part of the gaps' room, so they are few. What is left of the band
opens new sequences, each by as many documents of neighbouring ranks as it has tokens for. Full pieces have a sequence
each. The number of sequences comes near that of best-fit decreasing, one document after the other (the README has
figures).

Defined cases: null text counts as empty and gives the end token alone; repeated rows are packed each; an empty table
gives an empty result; other columns are ignored.
"""

import base64
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import cut, read

CAPACITY = 1024
END = 2
SPECIAL = "<|endoftext|>"
NAMED, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Sub-ranges of a length that are ranked apart.
BUCKETS = 64
#: Rows of a sweep that one task takes: its tables are slim, and tasks, files and shuffle blocks far below this size cost
#: more than they carry. Never more tasks than the session's shuffles have.
TASK_ROWS = 1 << 15
#: White space without a break that the fast library cannot take.
LONG_SPACE = re.compile(r"\s{1000}")


def vocabulary(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts as bytes (little-endian unsigned 32-bit), those of the named tokenizer. A faster library gives
    them from the same vocabulary (the tests compare the two); what it fails on goes to the named one itself."""

    def __init__(self, path: str, named: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding(
            "palimpsest", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
        )
        self.named, self.exact = named or vocabulary(NAMED), None

    def slowly(self, text: str) -> list[int]:
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.named)
        return self.exact.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        if LONG_SPACE.search(text):
            ids = self.slowly(text)
        else:
            ids = self.bpe.encode(text, allowed_special="all") if SPECIAL in text else self.bpe.encode_ordinary(text)
        return array("I", ids).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int, end: int):
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        encode = encoder(path).ids
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column("text")):
                ids = encode(text.as_py() or "") + last
                n = len(ids) // 4
                head = n % capacity or capacity
                for k, at in enumerate([0, *range(head, n, capacity)]):
                    to = head if not k else at + capacity
                    row.append(i), piece.append(k), start.append(at), length.append(to - at)
                    crc.append(zlib.crc32(ids[at * 4 : to * 4]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a long document's first piece takes the remainder."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(_pieces(path, capacity, end), schema)


def bands(capacity: int) -> list[tuple[int, int]]:
    """(over, up to) lengths, from long to short: shares of the capacity, fine ones first, then halves."""
    shares, k = [1, 2, 3, 4, 6, 8, 12, 16], 32
    while k < capacity:
        shares.append(k)
        k *= 2
    tops = sorted({1} | {capacity // k for k in shares if k <= capacity}, reverse=True)
    return list(zip([*tops[1:], 0], tops, strict=True))


def _ranked(rows: DataFrame, group: list[str], sub: list[str], tasks: int, more=lambda start: start) -> DataFrame:
    """rows with `r`, their rank (from 1) within a group: by `sub`, a bucket of a hash, and id. The table of counts has at
    most as many rows as there are groups, subs and buckets, all bounded by the capacity; `more` adds columns to it."""
    rows = rows.withColumn("b", F.pmod(F.xxhash64("id", "j"), F.lit(BUCKETS)).cast("int"))
    keys = [*group, *sub, "b"]
    before = Window.partitionBy(*group).orderBy(*sub, "b").rowsBetween(Window.unboundedPreceding, -1)
    start = rows.groupBy(*keys).agg(F.count("*").alias("n")).coalesce(1)
    start = more(start.withColumn("o", F.coalesce(F.sum("n").over(before), F.lit(0)))).drop("n")
    own = F.row_number().over(Window.partitionBy(*keys).orderBy("id", "j"))
    return rows.withColumn("r", own).coalesce(tasks).join(F.broadcast(start), keys).withColumn("r", F.col("r") + F.col("o")).drop("o", "b")


def _open_before(start: DataFrame) -> DataFrame:
    """start: counts `n` by opens, size and more. Adds `open`, the places open before a size, and `s`, those of the size."""
    down = Window.orderBy(F.desc("size"))
    longer = down.rangeBetween(Window.unboundedPreceding, -1)
    change = F.when(F.col("opens"), F.col("n")).otherwise(-F.col("n"))
    sums = start.withColumns({
        "p": F.sum(change).over(down.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        "q": F.coalesce(F.sum(change).over(longer), F.lit(0)),
        "s": F.coalesce(F.sum(F.when(F.col("opens"), F.col("n"))).over(Window.partitionBy("size")), F.lit(0)),
    })
    # documents that found no place are gone: the level never falls below zero
    low = F.least(F.coalesce(F.min("p").over(longer), F.lit(0)), F.lit(0))
    return sums.withColumn("open", F.col("q") - low).drop("p", "q")


def _sweep(docs: DataFrame, gaps: DataFrame, low: int, top: int, capacity: int, tasks: int) -> DataFrame:
    """docs: id, length (over low, up to top). gaps: seq, gap. Gives id, seq, offset, length of the documents placed."""
    places = F.greatest(F.floor(F.col("gap") / top), F.lit(1))
    slots = gaps.filter(F.col("gap") > low).select(
        F.lit(True).alias("opens"), F.least("gap", F.lit(top)).cast("bigint").alias("size"), (capacity - F.col("gap")).alias("sub"),
        F.col("seq").alias("id"), F.explode(F.sequence(F.lit(1), places.cast("int"))).alias("j"), "gap",
    )
    closing = docs.select(
        F.lit(False).alias("opens"), F.col("length").alias("size"), F.lit(0).cast("bigint").alias("sub"), "id", F.lit(0).alias("j"),
        F.lit(None).cast("bigint").alias("gap"),
    )
    items = slots.unionByName(closing)
    placed = _ranked(items, ["opens", "size"], ["sub"], tasks, _open_before)
    level = F.when(F.col("opens"), F.col("open") + F.col("r")).otherwise(F.col("open") + F.col("s") - F.col("r") + 1)
    placed = placed.withColumn("level", level).filter("level >= 1")
    order = Window.partitionBy("level").orderBy(F.desc("size"), F.desc("opens"))  # a length stands on a level twice at most
    slot = F.last(F.when(F.col("opens"), F.struct(F.col("id").alias("seq"), F.col("gap"))), ignorenulls=True).over(order)
    met = placed.withColumn("to", slot).filter("not opens").coalesce(tasks).select("id", F.col("size").alias("length"), "to.seq", "to.gap")
    within = Window.partitionBy("seq").orderBy(F.desc("length"), "id").rowsBetween(Window.unboundedPreceding, -1)
    offset = capacity - F.col("gap") + F.coalesce(F.sum("length").over(within), F.lit(0))
    return met.select("id", "seq", offset.alias("offset"), "length").coalesce(tasks)


def _openings(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """counts: (length, documents). From long to short, each new sequence takes as many neighbours as it has tokens for:
    (length, rank before its first one, documents that still go to the sequence opened last, that sequence, documents of
    this length to a sequence). At most `capacity` rows."""
    out, before, last, room = [], 0, -1, 0
    for length, n in sorted(counts, reverse=True):
        joining, each = min(n, room // length), capacity // length
        out.append((length, before, joining, last, each))
        before, room, rest = before + n, room - joining * length, n - joining
        if rest:
            last += -(-rest // each)
            room = capacity - ((rest - 1) % each + 1) * length
    return out


def _opened(docs: DataFrame, capacity: int, tasks: int) -> DataFrame:
    """New sequences, full of documents of neighbouring ranks. As `_sweep` gives them."""
    counts = [tuple(x) for x in docs.groupBy("length").count().collect()]  # at most `capacity` rows
    kinds = "length bigint, before bigint, joining bigint, last bigint, each bigint"
    known = F.broadcast(docs.sparkSession.createDataFrame(_openings(counts, capacity), kinds).coalesce(1))
    ranked = _ranked(docs.select("id", "length", F.lit(0).alias("j"), (-F.col("length")).alias("sub"), F.lit(0).alias("all")), ["all"], ["sub"], tasks)
    own = F.col("r") - F.col("before") - F.col("joining") - 1  # below 0: it joins
    number = F.col("last") + F.when(own < 0, 0).otherwise(1 + F.floor(own / F.col("each")))
    group = Window.partitionBy("s")
    before = group.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.join(known, "length").withColumn("s", number)
    return ranked.select("id", F.min("id").over(group).alias("seq"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length").coalesce(tasks)


def _left(gaps: DataFrame, placed: DataFrame) -> DataFrame:
    """gaps after the documents placed; full ones go."""
    used = placed.groupBy("seq").agg(F.sum("length").alias("u"))
    return gaps.join(used, "seq", "left").select("seq", (F.col("gap") - F.coalesce("u", F.lit(0))).alias("gap")).filter("gap > 0")


def _widest(gaps: DataFrame, top: int, wanted: int) -> int:
    """The gap up to which places of `top` tokens suffice for `wanted` documents: a wider one gets none, as the smallest
    that holds a document is taken first."""
    have = gaps.filter(F.col("gap") >= top).groupBy("gap").count().collect()  # at most `capacity` rows
    widest = 0
    for gap, n in sorted(map(tuple, have)):
        if wanted <= 0:
            break
        widest, wanted = gap, wanted - n * (gap // top)
    return max(widest, top)


def places(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """docs: id, length (1 to capacity), checkpointed. Gives id, seq, offset of each."""
    have = {r[0]: r[1] for r in docs.groupBy("length").count().collect()}  # at most `capacity` rows
    tasks = max(1, -(-sum(have.values()) // TASK_ROWS))
    docs = cut(docs.coalesce(tasks))
    done = [docs.filter(F.col("length") == capacity).select("id", F.col("id").alias("seq"), F.lit(0).cast("bigint").alias("offset"))]
    gaps = None
    for low, top in bands(capacity):
        left = sum(n for length, n in have.items() if low < length <= top and length < capacity)
        band = docs.filter((F.col("length") > low) & (F.col("length") <= top) & (F.col("length") < capacity))
        while left and gaps is not None:
            near = gaps.filter(F.col("gap") <= _widest(gaps, top, left))
            new = cut(_sweep(band, near, low, top, capacity, tasks))
            n = new.count()
            done.append(new.drop("length"))
            if n:
                gaps, left = cut(_left(gaps, new).coalesce(tasks)), left - n
                band = cut(band.join(new.select("id"), "id", "left_anti").coalesce(tasks)) if left else band
            if not n:
                break
        if left:
            new = cut(_opened(band, capacity, tasks))
            done.append(new.drop("length"))
            opened = new.groupBy("seq").agg((capacity - F.sum("length")).alias("gap")).filter("gap > 0")
            gaps = cut((opened if gaps is None else gaps.unionByName(opened)).coalesce(tasks))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (token_pieces' columns) of 1 to `capacity` tokens."""
    pieces = cut(pieces.withColumn("id", F.monotonically_increasing_id()))  # numbers stay as they were written
    found = places(pieces.select("id", "length"), capacity).withColumnRenamed("seq", "sequence_id")
    return pieces.join(found, "id").drop("id")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece. path: the vocabulary's ranks."""
    return pack(token_pieces(docs, path or vocabulary(), capacity, end), capacity)


def op6(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"))

"""Near duplicates: minima of many universal hashes, banding, verification by signature and on full shingle sets,
components by alternating large-star and small-star.

Documents of one shingle set form a class and go on as one. Two quick turns join most classes: a band's bucket is ordered
by the minima that follow the band's own, so that classes with more minima in common stand together (a longer prefix, as
in an LSH forest), and every class meets the next one; links are confirmed on full sets and joined to components. Then
every class meets those of the next REACH ones in its bucket that are of other components; buckets of REACH + 1 classes
or fewer have met in full by that. In larger ones then all pairs meet that are still of different components, in blocks
within one task each: no pair is a row, and none is left out, whatever the bucket's size. With 32 bands of 4 minima a
pair at the threshold shares no bucket with a chance of 5e-8.

Defined cases: null, empty or blank text has no shingles and links with nothing; a text of fewer words than a shingle
is one shingle; repeated rows and ids are each a row of the result; the component's id is its least doc_id that is not
null; an empty table gives an empty result; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import cut, read, slim
from palimpsest.llm.components import components
from palimpsest.llm.shingles import Minima, scramble, set_print, shingle_set, text_words

BANDS, ROWS = 32, 4
#: Signature agreement below which a pair is no link: the threshold less five standard errors (one link in 2,000,000).
SLACK = 5
#: Places that a class looks ahead in its bucket in the quick turns, and rows of a bucket that meet in one task.
REACH, BLOCK = 4, 2048
#: In a file of the shared folder: rows with signatures and bands (450 bytes each), and bytes of shingle sets.
CLASS_ROWS, SET_BYTES = 1 << 15, 1 << 23
#: Shingles compared at once.
AT_ONCE = 1 << 20


def signature(least: np.ndarray) -> np.ndarray:
    """A byte of each minimum, mixed: a minimum's own top bits are 0 in every large set. As whole longs."""
    return (scramble(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).view(np.int64)


def _prints(k: int):
    def run(batches):
        minima = Minima(BANDS, ROWS)
        for b in batches:
            n, prints, bands, sigs = [], [], [], []
            for words in text_words(b.column("text")):
                s = shingle_set(words, k)
                n.append(len(s))
                if len(s):
                    least = minima.least(s)
                    prints.append(set_print(s))
                    bands.append(minima.bands(least))
                    sigs.append(signature(least))
                else:
                    prints.append(None), bands.append(None), sigs.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "print", "bands", "sig"],
            )

    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            sets = [shingle_set(w, k) for w in text_words(b.column("text"))]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_print(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["print", "body"],
            )

    return run


def _sets_of(column) -> list[np.ndarray]:
    """The sets of a binary column, as views of its buffer."""
    _, ends, data = column.cast(pa.large_binary()).buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [np.frombuffer(data[a:b], np.uint64) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _linked(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(_sets_of(b.column("body_a")), _sets_of(b.column("body_b")), strict=True):
                i = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(i * 100 >= (len(x) + len(y) - i) * percent)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _most(percent: int) -> int:
    """How many bytes of two signatures may differ."""
    t, m = percent / 100, BANDS * ROWS
    return m - int((t - SLACK * (t * (1 - t) / m) ** 0.5) * m)


def _shared(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of the other sets has in common with x."""
    out, at = np.zeros(len(others), np.int64), 0
    ends = np.cumsum([len(o) for o in others])
    while at < len(others):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        y = np.concatenate(others[at:to])
        hit = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
        out[at:to] = np.add.reduceat(hit, np.r_[0, ends[at : to - 1] - before], dtype=np.int64)
        at = to
    return out


def _groups(batches):
    """The rows of each (h, g1, g2), which come one after the other, as one table."""
    held, last = [], None
    for b in batches:
        key = np.column_stack([b.column(x).to_numpy() for x in ("h", "g1", "g2")])
        at = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
        for i, j in zip(at[:-1], at[1:], strict=True):
            if i == j:
                continue
            if held and (key[i] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = key[i]
    if held:
        yield pa.Table.from_batches(held)


class _Group:
    """Two blocks of a bucket, or one with itself. `c` is each row's component, and may change between two rows."""

    def __init__(self, t: pa.Table, percent: int):
        self.n, self.c, self.g, self.band = (t.column(x).to_numpy().copy() for x in ("n", "c", "g", "band"))
        self.sig, self.bands = (t.column(x).combine_chunks().flatten().to_numpy().reshape(len(t), -1) for x in ("sig", "bands"))
        self.sig, self.percent, self.most = self.sig.view(np.uint8), percent, _most(percent)
        self.one = t.column("g1")[0].as_py() == t.column("g2")[0].as_py()

    def pairs(self):
        """Yields each row and those of other components that may be linked with it and meet it here first: pairs that
        share several buckets meet in that of the least band."""
        if (self.c == self.c[0]).all():
            return
        for i in range(len(self.c)):
            if self.one:
                j = np.flatnonzero(self.c[i + 1 :] != self.c[i]) + i + 1
            else:
                j = np.flatnonzero((self.c != self.c[i]) & (self.g > self.g[i]))
            n, own = self.n[j], self.n[i]
            j = j[np.minimum(n, own) * 100 >= np.maximum(n, own) * self.percent]
            j = j[(self.sig[j] != self.sig[i]).sum(axis=1) <= self.most]
            j = j[(self.bands[j] == self.bands[i]).argmax(axis=1) == self.band[i]]
            if len(j):
                yield i, j


def _facing(percent: int):
    """Of each group the rows that have a pair."""

    def run(batches):
        for t in _groups(batches):
            use = np.zeros(len(t), bool)
            for i, j in _Group(t, percent).pairs():
                use[i] = use[j] = True
            if use.any():
                yield from t.select(["h", "g1", "g2", "g", "band", "cid", "c"]).filter(pa.array(use)).to_batches()

    return run


def _joining(percent: int):
    """Links, on the full sets, that join two components of a group."""

    def run(batches):
        for t in _groups(batches):
            x, cid, u, v = _Group(t, percent), t.column("cid").to_numpy(), [], []
            sets = _sets_of(t.column("body").combine_chunks())
            for i, j in x.pairs():
                both = _shared(sets[i], [sets[z] for z in j])
                for z in j[both * 100 >= (x.n[i] + x.n[j] - both) * percent]:
                    if x.c[z] != x.c[i]:
                        x.c[x.c == x.c[z]] = x.c[i]
                        u.append(cid[i]), v.append(cid[z])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _unequal(a, b):
    """How many bytes of two longs differ: each byte's bits are folded into its lowest one."""
    x = a.bitwiseXOR(b)
    for s in (4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, s))
    return F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))


def _near(x, z, percent: int):
    """Whether sizes and signatures of two neighbours allow a link."""
    size = F.least(x.n, z.n) * 100 >= F.greatest(x.n, z.n) * percent
    differ = F.aggregate(F.zip_with(x.sig, z.sig, _unequal), F.lit(0), lambda s, d: s + d)
    return F.when((z.c != x.c) & size, differ <= _most(percent)).otherwise(False)


def _fetched(ids: DataFrame, docs: DataFrame, classes: DataFrame, n: int, size: int, k: int) -> DataFrame:
    """cid, body: the shingle sets of these classes (`n` of `size` shingles at most), from the texts of their first documents."""
    wanted = slim(ids.join(classes.select("cid", "print", "least_id"), "cid"), n)
    first = wanted.select(F.col("least_id").alias("_id")).distinct()
    texts = docs.join(first.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets(k), "print binary, body binary")
    # once for each print, on the join's own partitioning: bodies are shuffled once
    sets = sets.join(wanted.select("print", "cid"), "print").dropDuplicates(["print"]).select("cid", "body")
    return slim(sets, size * 8, SET_BYTES)


def _confirmed(maybe: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) among the pairs, on the full sets. To be read once."""
    side = lambda c: sets.select(F.col("cid").alias(c), F.col("body").alias(f"body_{c}"))
    x = maybe.join(side("b"), "b").join(side("a"), "a")
    return x.select("a", "b", "body_a", "body_b").mapInArrow(_linked(percent), "a bigint, b bigint").toDF("u", "v")


def _block():
    """The block of a row: a bucket of more than BLOCK rows is dealt at random to several."""
    return F.pmod(F.xxhash64("cid", "h"), F.ceil(F.col("m") / BLOCK))


def _partners(rows: DataFrame, classes: DataFrame, reach: int, most: int, percent: int) -> DataFrame:
    """rows: h, m, band, cid, c, at most `most`. Distinct pairs (a, b) that may be links of classes of different c, at most `reach` places
    apart in their block's order. Signatures join the rows here only, and what leaves is pairs of numbers."""
    longs = BANDS * ROWS // 8
    at = [F.pmod(F.floor(F.col("band") / 2) + 1 + d, F.lit(longs)).cast("int") + 1 for d in (0, 1)]
    rows = rows.join(classes.select("cid", "n", "sig"), "cid").withColumns({
        "g": _block(), "d1": F.element_at("sig", at[0]), "d2": F.element_at("sig", at[1]),
    })
    order = Window.partitionBy("h", "g").orderBy("d1", "d2", "cid")
    it = F.struct("cid", "c", "n", "sig", "d1", "d2")
    after = F.array(*(F.lead(it, d).over(order) for d in range(1, reach + 1)))
    met = rows.select(it.alias("x"), after.alias("next"))
    near = F.transform(F.filter("next", lambda z: _near(F.col("x"), z, percent)), lambda z: z.cid)
    met = met.select(F.col("x.cid").alias("cid"), F.explode(near).alias("z"))
    return slim(met.select(F.least("cid", "z").alias("a"), F.greatest("cid", "z").alias("b")).distinct(), most * reach)


def _remaining(rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """rows: h, m, band, cid, c. Links (u, v) that join classes of different c, to be read once, and how many there are at
    most: all pairs of a bucket meet. Every block meets every other one and itself, in one group each; sets go only to the
    rows that signatures leave, and each link joins two of a group's components."""
    keys, kinds = ["h", "g1", "g2"], "h bigint, g1 bigint, g2 bigint, g bigint, band int, cid bigint, c bigint"
    rows = rows.withColumn("g", _block()).withColumn("o", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / BLOCK) - 1)))
    rows = rows.select("h", F.least("g", "o").alias("g1"), F.greatest("g", "o").alias("g2"), "g", "band", "cid", "c")
    dealt = lambda x: x.repartition(*keys).sortWithinPartitions(*keys)
    about = classes.select("cid", "n", "sig", "bands")
    left = cut(dealt(rows.join(about, "cid")).mapInArrow(_facing(percent), kinds))
    found = dealt(left.join(about, "cid").join(sets, "cid")).mapInArrow(_joining(percent), "u bigint, v bigint")
    return found, left.count()


def _with_component(shared: DataFrame, comps: DataFrame, most: int) -> DataFrame:
    """shared, at most `most` rows, with c, the classes' component now. Buckets of one component give no pairs any more and
    go whole."""
    state = shared.join(comps.select(F.col("node").alias("cid"), "root"), "cid", "left")
    state, bucket = state.withColumn("c", F.coalesce("root", "cid")).drop("root"), Window.partitionBy("h")
    ends = state.withColumns({"c0": F.min("c").over(bucket), "c1": F.max("c").over(bucket)})
    return slim(ends.filter("c0 < c1").drop("c0", "c1"), most)


def _links(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """node, root of the classes' components."""
    n, size = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = classes.select(F.posexplode("bands").alias("band", "h"), "cid")
    many = rows.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1")
    shared = slim(rows.join(many, "h"), n * BANDS)  # the members of buckets with two classes or more
    most = shared.count()
    maybe = _partners(shared.withColumn("c", F.col("cid")), classes, 1, most, percent)
    open_ = shared.filter(F.col("m") > 2)
    # all that later turns may meet is fetched with the first pairs, so the texts are shuffled once
    ids = maybe.select(F.explode(F.array("a", "b")).alias("cid")).unionByName(open_.select("cid")).distinct()
    sets = _fetched(ids, docs, classes, n, size, k)
    comps = components(_confirmed(maybe, sets, percent), maybe.count())
    open_ = _with_component(open_, comps, most)
    maybe = _partners(open_, classes, REACH, open_.count(), percent)
    # a component of n classes is n - 1 links
    comps = components(_confirmed(maybe, sets, percent).unionByName(comps.toDF("u", "v")), maybe.count() + n)
    # buckets of REACH + 1 classes have met in full
    open_ = _with_component(open_.drop("c").filter(F.col("m") > REACH + 1), comps, most)
    found, most = _remaining(open_, classes, sets, percent)
    return components(found.unionByName(comps.toDF("u", "v")), most + n)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept. Links have 100 x shared >= percent x union."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, print binary, bands array<bigint>, sig array<bigint>"
    prints = cut(docs.mapInArrow(_prints(k), schema))
    classes = prints.filter("n_shingles > 0").groupBy("print").agg(
        F.min("doc_id").alias("least_id"), F.first(F.struct("n_shingles", "bands", "sig")).alias("x")
    )
    classes = slim(classes.select(
        F.monotonically_increasing_id().alias("cid"), "print", "least_id", F.col("x.n_shingles").alias("n"), "x.bands", "x.sig"
    ), prints.count(), CLASS_ROWS)
    comps = _links(docs, classes, k, percent)
    named = classes.select("cid", "print", "least_id").join(
        comps.select(F.col("node").alias("cid"), "root"), "cid", "left"
    ).withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select("print", "component_id")
    out = prints.select("doc_id", "n_shingles", "print").join(named, "print", "left")
    own = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def op10(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), k=2, percent=80)

"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

Vectors get one more coordinate that brings them all to the largest norm (queries get 0 there), so that the largest
inner product is the smallest angle. A table rotates by three rounds of random signs and the fast Hadamard transform and
hashes to the nearest signed axis; with more rows a second, smaller polytope splits the buckets further. Every row is in
every table. A query probes the buckets of its next-nearest axes; what shares a probed bucket is scored exactly, block
by block, and only each block's best go on. A query that found fewer than it should is scored against every row, in blocks.

The number of probes is fitted: for SAMPLE queries at most, taken by hash, the true neighbours are found by brute force
in one pass over all rows, and the probes are the fewest that find RECALL of them.

Defined cases: vectors that are null, zero, hold null or non-finite components, or are not of the most common length
take no part, nor do rows with a null vec_id; rows of one id and vector count once; equal scores go to the smaller id;
an empty table gives an empty result; other columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import cut, read

NEAREST = 20
TABLES = 8
SAMPLE = 64
RECALL = 0.97
#: Rows that a bucket should hold at most on average before the second polytope splits it, and rows of a block.
BUCKET_ROWS, BLOCK = 1024, 4096
_KEY = "t int, h int"


def best(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: np.ndarray, n: int):
    """(query row, id, score) of each query's n best among vectors, without its own id; ties to smaller ids.

    The product finds them; the scores are summed anew in one order, so that they do not depend on the block.
    """
    query, vectors = query.astype(np.float64), vectors.astype(np.float64)
    rough = query @ vectors.T
    rough[own[:, None] == ids[None, :]] = -np.inf
    k = min(n, len(ids))
    least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
    q, x = np.nonzero((rough >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & (rough > -np.inf))
    score = (query[q] * vectors[x]).sum(axis=1)
    order = np.lexsort((ids[x], -score, q))
    q, x, score = q[order], x[order], score[order]
    first = np.searchsorted(q, q)
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[x[keep]], score[keep]


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep norms."""
    rows, n = x.shape
    h = 1
    while h < n:
        x = x.reshape(rows, n // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(rows, n)
        h *= 2
    return x / np.sqrt(n)


class Polytopes:
    """Hashes and probes of all tables for vectors of one length, with norms up to `top`."""

    def __init__(self, dim: int, top: float, rows: int, tables: int = TABLES):
        self.top, self.tables = top, tables
        self.width = 1 << int(dim).bit_length()  # room for the coordinate more
        want = max(1, rows // (BUCKET_ROWS * 2 * self.width))
        self.split = 0 if want < 2 else min(self.width, 1 << (int(want).bit_length() - 2) if want >= 4 else 1)
        rng = np.random.default_rng(20)
        self.signs = rng.integers(0, 2, (tables, 2, 3, self.width)).astype(np.float64) * 2 - 1

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(v), self.width))
        v = v.astype(np.float64)
        out[:, : v.shape[1]] = v
        if not query:
            out[:, v.shape[1]] = np.sqrt(np.maximum(0, self.top**2 - (v * v).sum(1)))
        return out / np.maximum(np.sqrt((out * out).sum(1)), 1e-300)[:, None]

    def _axes(self, x: np.ndarray, table: int, part: int, most: int) -> np.ndarray:
        for s in self.signs[table, part]:
            x = hadamard(x * s)
        return np.concatenate([x, -x], axis=1) if most >= self.width else np.concatenate([x[:, :most], -x[:, :most]], axis=1)

    def scores(self, v: np.ndarray, query: bool, table: int) -> np.ndarray:
        """How near each bucket of the table is to each vector."""
        x = self.lifted(v, query)
        near = self._axes(x, table, 0, self.width)
        if self.split:
            far = self._axes(x, table, 1, self.split)
            near = (near[:, :, None] + far[:, None, :]).reshape(len(v), -1)
        return near

    def hashes(self, v: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table."""
        x, out = self.lifted(v, False), []
        for t in range(self.tables):
            h = self._axes(x, t, 0, self.width).argmax(1)
            out.append(h * 2 * self.split + self._axes(x, t, 1, self.split).argmax(1) if self.split else h)
        return np.stack(out, 1).astype(np.int32)

    def probes(self, v: np.ndarray, n: int) -> np.ndarray:
        """(rows, tables, n): the n nearest buckets."""
        per = []
        for t in range(self.tables):
            s = self.scores(v, True, t)
            per.append(np.argpartition(-s, min(n, s.shape[1]) - 1, axis=1)[:, :n])
        return np.stack(per, 1).astype(np.int32)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of lists of one length; lists of 4-byte numbers stay such."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _arrow(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v: the rows that take part. v holds double numbers, or 4-byte ones if the vectors do: those stay exact, and are
    half as much to shuffle."""
    small = rows.schema[vector].dataType.simpleString() == "array<float>"
    v = F.col(vector) if small else F.col(vector).cast("array<double>")
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    out = rows.select(F.col(key).cast("bigint").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    return out.filter(fine)


def _brute(sample_ids: np.ndarray, sample: np.ndarray, n: int):
    def run(batches):
        for b in batches:
            ids, v = b.column("id").to_numpy(), _matrix(b.column("v"))
            if len(ids):
                q, x, s = best(sample, ids, v, sample_ids, n)
                yield _arrow(query_id=pa.array(sample_ids[q]), vec_id=pa.array(x), score=pa.array(s))

    return run


def _ranked(found: DataFrame, n: int) -> DataFrame:
    """Best n of each query: query_id, rank, vec_id, score. Rows found twice have one place."""
    place = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = found.withColumn("rank", place).filter(F.col("rank") <= n).groupBy("query_id", "rank", "vec_id", "score").count()
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def fit_probes(base: DataFrame, queries: DataFrame, hashing: Polytopes, n: int) -> int:
    """Fewest probes that find RECALL of the sampled queries' true neighbours."""
    sample = queries.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return 1
    ids, v = np.array([r.id for r in sample]), np.array([r.v for r in sample], np.float64)
    true = _ranked(base.mapInArrow(_brute(ids, v, n), _FOUND), n)  # SAMPLE x n rows
    true = true.join(base.select(F.col("id").alias("vec_id"), "v"), "vec_id").select("query_id", "vec_id", "v").collect()
    if not true:
        return 1
    at = {q: i for i, q in enumerate(ids.tolist())}
    who, hashes = np.array([at[r.query_id] for r in true]), hashing.hashes(np.array([r.v for r in true], np.float64))
    need = np.full(len(true), np.iinfo(np.int64).max)
    for t in range(hashing.tables):
        s = hashing.scores(v, True, t)[who]
        need = np.minimum(need, (s > s[np.arange(len(who)), hashes[:, t]][:, None]).sum(1) + 1)
    return int(np.sort(need)[min(len(need) - 1, int(np.ceil(RECALL * len(need))) - 1)])


def _tabled(hashing: Polytopes):
    def run(batches):
        for b in batches:
            v = _matrix(b.column("v"))
            if not len(v):
                continue
            h, t = hashing.hashes(v), hashing.tables
            rows = np.repeat(np.arange(len(v)), t)
            yield _arrow(
                t=pa.array(np.tile(np.arange(t, dtype=np.int32), len(v))), h=pa.array(h.ravel()),
                id=b.column("id").take(pa.array(rows)), body=pa.array([v[i].tobytes() for i in range(len(v))], pa.binary()).take(pa.array(rows)),
            )

    return run


def _probing(hashing: Polytopes, n: int):
    def run(batches):
        for b in batches:
            v = _matrix(b.column("v"))
            for at in range(0, len(v), 256):
                part = v[at : at + 256]
                p = hashing.probes(part, n)
                rows = np.repeat(np.arange(at, at + len(part)), p.shape[1] * p.shape[2])
                t = np.tile(np.repeat(np.arange(hashing.tables, dtype=np.int32), p.shape[2]), len(part))
                yield _arrow(
                    t=pa.array(t), h=pa.array(p.ravel()), id=b.column("id").take(pa.array(rows)),
                    body=pa.array([x.tobytes() for x in part], pa.binary()).take(pa.array(rows - at)),
                )

    return run


def _scored(n: int, kind: str):
    def matrix(column) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids, v, qid, q = right["id"].to_numpy(), matrix(right["body"]), left["id"].to_numpy(), matrix(left["body"])
        parts = [best(q[i : i + 256], ids, v, qid[i : i + 256], n) for i in range(0, len(q), 256)]
        at = np.concatenate([p[0] + 256 * i for i, p in enumerate(parts)])
        return pa.table([qid[at], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])], names)

    return run


def search(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", n: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the n nearest that the tables find of each query, among all other rows.

    Buckets are split into blocks of some BLOCK rows, which every query of the bucket meets in turn, so that a bucket
    with a large part of all rows is many tasks' work.
    """
    base = usable(rows, key, vector)
    common = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("m"))
    top = common.orderBy(F.desc("c"), "d").first()
    if top is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    base = cut(base.filter(F.size("v") == top.d).dropDuplicates())
    queries = base.filter(is_query)
    hashing = Polytopes(top.d, float(np.sqrt(top.m)), top.c)
    probes = fit_probes(base, queries, hashing, n)
    tabled = cut(base.mapInArrow(_tabled(hashing), f"{_KEY}, id bigint, body binary"))
    blocks = tabled.groupBy("t", "h").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    right = tabled.join(blocks, ["t", "h"]).withColumn("b", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    left = queries.mapInArrow(_probing(hashing, probes), f"{_KEY}, id bigint, body binary").join(blocks, ["t", "h"])
    left = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # the queries of a block are split too: no group is unbounded
    halves = left.groupBy("t", "h", "b").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    left = left.join(halves, ["t", "h", "b"]).withColumn("p", F.pmod(F.xxhash64("id", F.lit(1)), "parts").cast("int"))
    right = right.join(halves, ["t", "h", "b"]).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    place = ["t", "h", "b", "p"]
    met = left.select(*place, "id", "body").groupBy(*place).cogroup(right.select(*place, "id", "body").groupBy(*place))
    kind = "<f4" if dict(base.dtypes)["v"] == "array<float>" else "<f8"
    found = cut(_ranked(met.applyInArrow(_scored(n, kind), _FOUND), n))
    # every query gets n rows, or as many as there are rows of other ids: what falls short is searched everywhere
    have = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("got"))
    own = base.groupBy("id").agg(F.count("*").alias("own"))
    short = queries.join(have, "id", "left").join(own, "id").filter(F.coalesce("got", F.lit(0)) < F.least(F.lit(n), base.count() - F.col("own")))
    short = cut(short.select("id", "v"))
    if short.isEmpty():
        return found
    more = _ranked(_everywhere(short, base, n, kind), n)
    return found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(more)


_FOUND = "query_id bigint, vec_id bigint, score double"


def _packed(b: pa.RecordBatch) -> pa.RecordBatch:
    v = _matrix(b.column("v"))
    return _arrow(g=b.column("g"), p=b.column("p"), id=b.column("id"), body=pa.array([x.tobytes() for x in v], pa.binary()))


def _everywhere(queries: DataFrame, base: DataFrame, n: int, kind: str) -> DataFrame:
    """query_id, vec_id, score of each block's n best for each query: all rows, BLOCK queries by BLOCK rows at a time."""
    blocks, parts = (max(1, -(-df.count() // BLOCK)) for df in (base, queries))
    pack = lambda df: df.mapInArrow(lambda batches: (_packed(b) for b in batches), "g int, p int, id bigint, body binary")
    mod = lambda k, *c: F.pmod(F.xxhash64(*c), F.lit(k)).cast("int")
    all_of = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    right = pack(base.select(mod(blocks, "id").alias("g"), "id", "v").select("g", all_of(parts).alias("p"), "id", "v"))
    left = pack(queries.select(mod(parts, "id", F.lit(1)).alias("p"), "id", "v").select(all_of(blocks).alias("g"), "p", "id", "v"))
    return left.groupBy("g", "p").cogroup(right.groupBy("g", "p")).applyInArrow(_scored(n, kind), _FOUND)


def op7(spark, sf_dir):
    return search(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)

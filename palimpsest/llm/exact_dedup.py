"""Exact duplicates by distributed radix partitioning on successive bytes, most significant first.

A group is split by its texts' next bytes until it is a single document or its bytes are at an end; equality rests on
the bytes alone. The first digit takes the length and 64 bytes, later ones widen, so the number of rounds is that of
the doublings up to the longest text. Only documents whose group is still open go on, their bytes dealt out in chunk
rows, one for each digit, so that a round reads nothing but its own digit.

Defined cases: null text counts as empty, and empty texts are equal to each other; a null doc_id comes after all
others; of rows alike in all, one stays; an empty table gives an empty result; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import SPACE, cut, read

FIRST = 64
WIDEST = 1 << 20


def digit_bounds(longest: int) -> list[tuple[int, int]]:
    """(start, width) of the digits after the first one, up to the longest text."""
    out, at, width = [], FIRST, 1024
    while at < longest:
        out.append((at, width))
        at, width = at + width, min(width * 2, WIDEST)
    return out


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{SPACE}]+", "")


def radix_groups(rows: DataFrame) -> DataFrame:
    """rows: rid, gid, body (binary), of the open groups. Gives rid, gid of the final groups.

    Each round groups by (gid, digit) with partial sums, so a group of copies sends one row a task, and renames a group
    by the least rid in it.
    """
    longest = rows.agg(F.max(F.length("body"))).first()[0] or 0
    bounds = digit_bounds(longest)
    state = rows.select("rid", "gid")
    if not bounds:
        return state
    parts = F.array(*[F.substring("body", at + 1, width) for at, width in bounds])
    digits = cut(rows.select("rid", F.posexplode(parts).alias("k", "digit")).filter(F.length("digit") > 0))
    done = []
    for k in range(len(bounds)):
        now = state.join(digits.filter(F.col("k") == k).select("rid", "digit"), "rid")
        groups = now.groupBy("gid", "digit").agg(F.min("rid").alias("new"), F.count("*").alias("n"))
        split = now.join(groups, ["gid", "digit"]).select("rid", F.col("new").alias("gid"), "n")
        # texts of a group have one length, so they end together: those without this digit are at their end
        done.append(state.join(now.select("rid"), "rid", "left_anti").select("rid", "gid"))
        split = cut(split)
        done.append(split.filter("n = 1").select("rid", "gid"))
        state = split.filter("n > 1").select("rid", "gid")
    done.append(state)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the most code points in its original text stays, then the smallest doc_id.
    """
    base = docs.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("points"), normal(F.col("text")).cast("binary").alias("body")
    ).withColumns({"bytes": F.length("body"), "head": F.substring("body", 1, FIRST)})
    key = ["bytes", "head"]
    rank = F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id")
    open_keys = base.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(*key, F.lit(True).alias("_open"))
    marked = base.join(open_keys, key, "left").withColumn("text_sha256", F.sha2("body", 256))
    alone = marked.filter("_open is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"),
        "text_sha256",
    )
    rows = cut(
        marked.filter("_open")
        .select("doc_id", "points", "body", "text_sha256", *key)
        .withColumn("rid", F.monotonically_increasing_id())
    )
    first = rows.groupBy(key).agg(F.min("rid").alias("gid"))
    rows = rows.join(first, key).select("rid", "gid", "doc_id", "points", "body", "text_sha256")
    final = radix_groups(rows).join(rows.select("rid", "doc_id", "points", "text_sha256"), "rid")
    best = final.groupBy("gid").agg(F.min(F.struct(rank.alias("r"), "rid")).alias("b"), F.count("*").alias("group_size"))
    best = best.select("gid", F.col("b.r.doc_id").alias("keep_id"), F.col("b.rid").alias("keep_rid"), "group_size")
    grouped = final.join(best, "gid").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped)


def op2(spark, sf_dir):
    return exact_groups(read(spark, sf_dir, "documents"))


ORACLE = r"""
with a as (select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as body from documents),
b as (select *, count(*) over (partition by body) as group_size,
  row_number() over (partition by body order by points desc, doc_id) as rn, first_value(doc_id) over (partition by body order by points desc, doc_id) as keep_id from a)
select doc_id, keep_id, group_size, rn = 1 as kept, sha256(body) as text_sha256 from b
"""

"""Operators on the revision stream: reverts, surviving chain, latest picks, pairing, title and archive filters."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.comments import is_npov_edit

# Fixed value: titles outside the article namespace.
NAMESPACES = r"(?i)^.*?(?:talk|user|wikipedia|template|help|file|draft|category):"


def _by_page():
    return Window.partitionBy("page_id").orderBy("rev_ord")


def drop_namespaces(df: DataFrame, title: str = "page_title") -> DataFrame:
    return df.filter(~F.col(title).rlike(NAMESPACES))


def keep_titles(df: DataFrame, titles: DataFrame, title: str = "page_title") -> DataFrame:
    """Semi join on the trimmed title; Catalyst broadcasts the list if it is small enough."""
    return df.join(titles.select(F.trim(F.col(title)).alias("_t")), F.trim(F.col(title)) == F.col("_t"), "left_semi")


def skip_processed(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return df.join(ledger.select(key), key, "left_anti")


def node_split(df: DataFrame, nodes: int, order: str) -> DataFrame:
    """Contiguous, almost equal ranges of a small archive list; the first ones take the remainder."""
    return df.withColumn("node_id", F.ntile(nodes).over(Window.orderBy(order)) - 1)


def with_first_seen(revs: DataFrame) -> DataFrame:
    """first_ord: where this content (sha1, size) first stood on its page; a later return to it is a revert."""
    w = Window.partitionBy("page_id", "sha1", "text_size")
    return revs.withColumn("first_ord", F.min("rev_ord").over(w)).withColumn(
        "is_revert", F.col("first_ord") < F.col("rev_ord")
    )


def revert_counts(revs: DataFrame) -> DataFrame:
    return (
        with_first_seen(revs)
        .groupBy("page_id")
        .agg(F.count("*").alias("revisions"), F.count_if("is_revert").alias("reverts"))
    )


def _walk_back(batches):
    """Rows page_id, rev_ord, first_ord, before; each page's in one run, newest first. Gives those on the path from the
    last state to the first: a row is on it if the path has reached its ordinal, and it goes on to what stood before."""
    page, want = None, None
    for b in batches:
        keep = []
        columns = (b.column(c).to_pylist() for c in ("page_id", "rev_ord", "first_ord", "before"))
        for k, (p, ordinal, first, before) in enumerate(zip(*columns, strict=True)):
            if (p,) != page:
                page, want = (p,), first
            if ordinal == want:
                keep.append(k)
                want = before
        out = b.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([out.column(c) for c in ("page_id", "rev_ord", "before")], ["page_id", "rev_ord", "parent_ord"])


def surviving_chain(revs: DataFrame) -> DataFrame:
    """Revisions on the path from the last state back to the first, with chain position and chain parent.

    Only ids and ordinals are walked, never texts: one linear pass over each page's rows from the newest on, which holds
    one ordinal at a time.
    """
    seen = with_first_seen(revs.select("page_id", "rev_ord", "sha1", "text_size"))
    seen = seen.withColumn("before", F.lag("first_ord").over(_by_page())).select("page_id", "rev_ord", "first_ord", "before")
    kind = dict(seen.dtypes)
    walk = seen.sortWithinPartitions("page_id", F.desc("rev_ord"))  # a page's rows are together since the window
    chain = walk.mapInArrow(_walk_back, f"page_id {kind['page_id']}, rev_ord {kind['rev_ord']}, parent_ord {kind['rev_ord']}")
    chain = chain.withColumn("chain_pos", F.row_number().over(_by_page()))
    return revs.join(chain, ["page_id", "rev_ord"])


def _large_enough(batches):
    """Rows page_id, rev_ord, text_size, ok; each page's in one run, oldest first. Gives those that are accepted."""
    page, last = None, None
    for b in batches:
        keep = []
        for k, (p, size, ok) in enumerate(zip(*(b.column(c).to_pylist() for c in ("page_id", "text_size", "ok")), strict=True)):
            if (p,) != page:
                page, last = (p,), None
            if ok and (last is None or size is not None and size * 10 >= last):
                keep.append(k)
                last = size
        out = b.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([out.column(c) for c in ("page_id", "rev_ord")], ["page_id", "rev_ord"])


def accepted(revs: DataFrame, ok: Column | None = None) -> DataFrame:
    """Drops revisions under a tenth of the last accepted size; order matters, so sizes alone go through each page once."""
    ok = F.lit(True) if ok is None else F.coalesce(ok, F.lit(False))
    slim = revs.select("page_id", "rev_ord", "text_size", ok.alias("ok"))
    kind = dict(slim.dtypes)
    run = slim.repartition("page_id").sortWithinPartitions("page_id", "rev_ord")
    kept = run.mapInArrow(_large_enough, f"page_id {kind['page_id']}, rev_ord {kind['rev_ord']}")
    return revs.join(kept, ["page_id", "rev_ord"], "left_semi")


def consecutive_pairs(revs: DataFrame, ok: Column | None = None) -> DataFrame:
    """Each accepted revision with the accepted one before it."""
    out = accepted(revs, ok)
    return out.withColumn("prev_rev_id", F.lag("rev_id").over(_by_page())).filter("prev_rev_id is not null")


def latest_n(revs: DataFrame, n: int = 5) -> DataFrame:
    """Last n revisions whose time exceeds every earlier one."""
    before = F.max("ts").over(_by_page().rowsBetween(Window.unboundedPreceding, -1))
    up = revs.withColumn("_m", before).filter("_m is null or ts > _m").drop("_m")
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("rev_ord")))
    return up.withColumn("recency", rank).filter(F.col("recency") <= n)


def up_to(revs: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows up to and with the reference revision (page_id, latest_ord)."""
    return revs.join(latest, "page_id").filter("rev_ord <= latest_ord").drop("latest_ord")


def npov_edits(revs: DataFrame) -> DataFrame:
    """Surviving revisions with a neutrality comment, and the id of their chain parent (null for a root)."""
    chain = surviving_chain(revs)
    ids = revs.select("page_id", F.col("rev_ord").alias("parent_ord"), F.col("rev_id").alias("parent_rev_id"))
    return chain.filter(is_npov_edit(F.col("comment"))).join(ids, ["page_id", "parent_ord"], "left")


def npov_pairs(edits: DataFrame, revs: DataFrame) -> DataFrame:
    """Edit rows with the sizes of child and parent; a child under a tenth of its parent is a deletion and goes."""
    child = revs.select("page_id", "rev_id", F.col("text_size").alias("new_size"))
    parent = revs.select("page_id", F.col("rev_id").alias("parent_rev_id"), F.col("text_size").alias("old_size"))
    out = edits.select("page_id", "rev_id", "parent_rev_id", "comment")
    out = out.join(child, ["page_id", "rev_id"]).join(parent, ["page_id", "parent_rev_id"])
    return out.filter("new_size * 10 >= old_size")

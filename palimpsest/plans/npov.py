"""Neutrality edits: surviving revisions whose comment tells of one, and their diffs against the chain's parent."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators import revisions as r
from palimpsest.operators import sections as s
from palimpsest.plans.fa import DIFF


def find_edits(revs: DataFrame) -> DataFrame:
    """page_id, page_title, rev_id, parent_rev_id, comment. Pages outside the article namespace have none. Texts are not
    needed, so stubs will do."""
    articles = r.drop_namespaces(revs.select("page_id", "page_title", "rev_id", "rev_ord", "sha1", "text_size", "comment"))
    return r.npov_edits(articles).select("page_id", "page_title", "rev_id", "parent_rev_id", "comment")


def diffs(revs: DataFrame, edits: DataFrame, context: int = 3) -> DataFrame:
    """DIFF rows of the edits, all changes retained. An edit whose parent is unknown, one of less than a tenth of the
    parent's size, and one of whose texts cannot be parsed have none. Two joins of edits with revisions: a page's texts
    never come together."""
    todo = edits.filter("parent_rev_id is not null").select("page_id", "rev_id", "parent_rev_id")
    child = revs.select("page_id", "rev_id", "page_title", "ts", "contributor", "comment", F.col("text_size").alias("new_size"), F.col("text").alias("new"))
    parent = revs.select("page_id", F.col("rev_id").alias("parent_rev_id"), F.col("text_size").alias("old_size"), F.col("text").alias("old"))
    both = todo.join(child, ["page_id", "rev_id"]).join(parent, ["page_id", "parent_rev_id"]).filter("new_size * 10 >= old_size")
    both = s.with_sections(both.repartition("page_id", "rev_id"), "new").filter("error is null").drop("error", "new")
    both = s.with_sections(both.withColumnRenamed("sections", "new_sections"), "old").filter("error is null").drop("error", "old")
    rows = both.select(
        "page_title", "page_id", "rev_id", F.col("parent_rev_id").alias("prev_rev_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        "contributor", "comment", F.col("sections").alias("old_sections"), "new_sections", F.lit(None).cast(s.SECTIONS).alias("latest"),
        F.lit(True).alias("save_all"),
    )
    return s.section_diffs(rows, context).select(*DIFF)

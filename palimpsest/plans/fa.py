"""Featured articles: diffs whose new text is still in the newest revision."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.comments import is_fa_edit
from palimpsest.operators import revisions as r
from palimpsest.operators import sections as s
from palimpsest.session import stored

DIFF = ["page_title", "page_id", "rev_id", "prev_rev_id", "timestamp", "contributor", "comment", "section", "old_text", "new_text"]


def extract(revs: DataFrame, titles: DataFrame) -> DataFrame:
    """Revisions of the listed pages."""
    return r.keep_titles(revs, titles)


def parsed_chain(revs: DataFrame) -> DataFrame:
    """Surviving revisions up to the page's reference revision, with error, sections, and the newest text's sections as
    `latest`; sections that this no longer has are gone."""
    slim = r.surviving_chain(revs.select("page_id", "rev_ord", "sha1", "text_size")).select("page_id", "rev_ord")
    newest = stored(s.newest_sections(revs))
    rows = r.up_to(revs.join(slim, ["page_id", "rev_ord"], "left_semi"), newest)
    # one page's revisions are dealt to many tasks before the costly parse
    rows = s.with_sections(rows.repartition("page_id", "rev_ord"))
    here = F.transform("latest", lambda x: x.path)
    return rows.withColumn("sections", F.filter("sections", lambda x: F.array_contains(here, x.path)))


def retained_diffs(revs: DataFrame, context: int = 3) -> DataFrame:
    """DIFF rows of each accepted revision against the one accepted before it. Changes that the newest text does not hold
    are dropped, unless the comment tells of work on a featured article. Revisions that cannot be parsed, and those of
    less than a tenth of the last accepted one's size, count for nothing."""
    rows = stored(parsed_chain(revs))
    pairs = r.consecutive_pairs(rows.select("page_id", "rev_ord", "rev_id", "text_size", "error"), F.col("error").isNull())
    before = F.lag("rev_ord").over(Window.partitionBy("page_id").orderBy("rev_ord"))
    order = r.accepted(rows.select("page_id", "rev_ord", "text_size", "error"), F.col("error").isNull()).withColumn("prev_ord", before)
    pairs = pairs.select("page_id", "rev_ord", "prev_rev_id").join(order.select("page_id", "rev_ord", "prev_ord"), ["page_id", "rev_ord"])
    old = rows.select("page_id", F.col("rev_ord").alias("prev_ord"), F.col("sections").alias("old_sections"))
    new = rows.select(
        "page_id", "rev_ord", "page_title", "rev_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "contributor",
        "comment", F.col("sections").alias("new_sections"), "latest", is_fa_edit(F.col("comment")).alias("save_all"),
    )
    both = new.join(pairs, ["page_id", "rev_ord"]).join(old, ["page_id", "prev_ord"])
    return s.section_diffs(both, context).select(*DIFF)

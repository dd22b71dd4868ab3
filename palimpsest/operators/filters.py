"""Row filters of the preference pipeline. Every threshold that depends on the data stays a one-row DataFrame."""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import text as X
from palimpsest.functions.bleu import bleu_score
from palimpsest.functions.comments import is_fa_edit
from palimpsest.functions.distance import edit_distance
from palimpsest.session import stored


def _old() -> Column:
    return F.col("old_text")


def _new() -> Column:
    return F.col("new_text")


# What counts as markup left in a text.
HTML_TAGS = [
    "p",
    "div",
    "li",
    "ul",
    "h1",
    "h2",
    "h3",
    "h4",
    "h5",
    "table",
    "td",
    "tr",
    "th",
    "url",
    "nowiki",
    "blockquote",
    "font",
]
MARKERS = ["{{", "}}", "[[", "]]", "<ref", "</ref", "ref>", "<!--", "-->"]


def drop_empty(df: DataFrame) -> DataFrame:
    return df.filter(X.has_text(_old()) & X.has_text(_new()))


def drop_same(df: DataFrame, simple: bool = False) -> DataFrame:
    """Equal after white-space collapse; with `simple`, also where one raw text contains the other."""
    same = X.collapse_ws(_old()) == X.collapse_ws(_new())
    return df.filter(~(same | _old().contains(_new()) | _new().contains(_old())) if simple else ~same)


def drop_short(df: DataFrame, words: int = 5) -> DataFrame:
    return df.filter(X.has_spaced_words(_old(), words) & X.has_spaced_words(_new(), words))


def cut_relative_length(df: DataFrame, q: float, low: float = 150.0, high: float = 200.0) -> DataFrame:
    """Keeps rows up to the q-quantile of the relative length difference, clamped to [low, high]."""
    df = df.withColumn("rel_len_diff", X.relative_length_difference(_old(), _new()))
    cut = df.agg(F.least(F.lit(high), F.greatest(F.lit(low), F.percentile("rel_len_diff", q))).alias("_cut"))
    return df.crossJoin(F.broadcast(cut)).filter("rel_len_diff <= _cut").drop("_cut")  # one row


def with_edit_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("edit_distance", edit_distance(_old(), _new()))


def cut_edit_distance(df: DataFrame, least: int = 4) -> DataFrame:
    return df.filter(F.col("edit_distance") > least)


def cut_relative_edit_distance(df: DataFrame, least: float = 0.1, spare: Column | None = None) -> DataFrame:
    """Keeps a row whose distance exceeds a share of the old text, or that `spare` excuses."""
    far = F.col("edit_distance") / F.length(_old()) > least
    return df.filter(far if spare is None else far | spare)


def outliers(df: DataFrame, q: float, simple: bool, spare: Column | None = None) -> DataFrame:
    """All outlier filters in order. Run it again after rendering: the quantile moves."""
    df = drop_short(drop_same(drop_empty(df), simple))
    df = with_edit_distance(cut_relative_length(df, q))
    return cut_relative_edit_distance(cut_edit_distance(df), spare=spare)


def outliers_npov(df: DataFrame) -> DataFrame:
    return outliers(df, 0.95, simple=True)


def outliers_fa(df: DataFrame) -> DataFrame:
    return outliers(df, 0.99, simple=False, spare=is_fa_edit(F.col("comment")))


def has_markup(c: Column) -> Column:
    """Braces, links, references, comments, HTML tags or template arguments left in a text; null has none."""
    tags = "|".join(HTML_TAGS)
    marks = "|".join(re.escape(m) for m in MARKERS)
    # one alternation: a contains() for each marker would outgrow a generated method
    out = c.rlike(rf"{marks}|<(?:{tags}) |</(?:{tags})[> ]|(?m:^\s*\|.*?=.*$)|(?i:redirects here)")
    return F.coalesce(out, F.lit(False))


def drop_markup(df: DataFrame) -> DataFrame:
    return df.filter(~(has_markup(_old()) | has_markup(_new())))


def with_bleu(df: DataFrame) -> DataFrame:
    guarded = X.has_problem_pattern(_old()) | X.has_problem_pattern(_new())
    return df.withColumn("bleu_score", F.when(guarded, F.lit(0.0)).otherwise(bleu_score(_old(), _new())))


def cut_bleu(df: DataFrame, threshold: Callable[[Column], Column] | float) -> DataFrame:
    """Keeps threshold < score < 1. A callable is an aggregate over all scores, such as a percentile."""
    df = with_bleu(df)
    if callable(threshold):
        df = stored(df)  # scored once, read for the threshold and for the filter
        cut = df.agg(threshold(F.col("bleu_score")).alias("_cut"))
        df = df.crossJoin(F.broadcast(cut))  # one row
    else:
        df = df.withColumn("_cut", F.lit(float(threshold)))
    return df.filter("_cut < bleu_score and bleu_score < 1").drop("_cut")


def cut_bleu_npov(df: DataFrame) -> DataFrame:
    return cut_bleu(df, 0.15)


def cut_bleu_fa(df: DataFrame) -> DataFrame:
    return cut_bleu(df, lambda c: F.percentile(c, 0.01))


#: The native stand-in for sentence counting in the removal test: runs of end marks that close a sentence.
SENTENCE_ENDS = r"[.!?]+(?:\s|$)"


def drop_removals(df: DataFrame, most: float = 0.2) -> DataFrame:
    """Drops edits with fewer sentences and over `most` of the tokens gone, and guarded texts."""
    s_old, s_new = (F.regexp_count(c, F.lit(SENTENCE_ENDS)) for c in (_old(), _new()))
    t_old, t_new = X.token_count(_old()), X.token_count(_new())
    removal = (s_new < s_old) & (t_new < t_old) & ((t_old - t_new) / F.greatest(t_old, F.lit(1)) > most)
    return df.filter(~(removal | X.has_problem_pattern(_old()) | X.has_problem_pattern(_new())))


def keep_single_edits(df: DataFrame) -> DataFrame:
    """Rows whose (page, revision) has no second row. A count and a semi join: no window holds a page's rows."""
    one = df.groupBy("page_id", "rev_id").count().filter("count = 1").drop("count")
    return df.join(one, ["page_id", "rev_id"], "left_semi")


def first_per_text(df: DataFrame, src: str, order: str) -> DataFrame:
    """First row of each old_text within a source file. min_by keeps the partial sums small on repeated texts."""
    cols = [F.col(c) for c in df.columns]
    best = df.groupBy(src, "old_text").agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r"))
    return best.select("_r.*")


def drop_long(df: DataFrame, most: int = 1024, counter: Callable[[Column], Column] = X.token_count) -> DataFrame:
    """Counts tokens of the longer text (old on a tie); `counter` is pluggable."""
    longer = F.when(F.length(_new()) > F.length(_old()), _new()).otherwise(_old())
    return df.filter(counter(longer) <= most)


def merge_dedupe(df: DataFrame, src: str, order: str, most: int = 1024) -> DataFrame:
    """First per text within a file, then the length cut: a first row that is too long still shadows later ones."""
    return drop_long(first_per_text(df, src, order), most)


def quantile_profile(df: DataFrame, column: str, qs=(0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    v = F.col(column).cast("double")
    return df.agg(F.percentile(v, F.array(*map(F.lit, qs))).alias("p")).select(
        *(F.col("p")[i].alias(f"p{round(q * 100):02d}") for i, q in enumerate(qs))
    )

"""Connected components by alternating large-star and small-star. Defined cases: no links give no rows; repeated
links, links in both directions and links of a node to itself count once or not at all."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import slim


def _fan(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows (u, v) for each of the column pairs: one pass, where a union would read df again."""
    return df.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])))


def _large_star(e: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least of its neighbourhood."""
    n = _fan(e, ("u", "v"), ("v", "u"))
    least = n.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return _fan(n.filter("v > u").join(least, "u"), ("v", "m")).filter("u <> v")


def _small_star(e: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the least of them. Links run from large to small here."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return _fan(e.join(least, "u"), ("v", "m"), ("u", "m")).filter("u <> v")


def _is_forest_of_stars(e: DataFrame) -> bool:
    """No node has two links upwards, or one upwards and one from below."""
    ends = e.select(F.inline(F.array(
        F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )))
    by = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return by.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """links: u, v, at most `most` rows (counted, if not given; else links is read once). Gives node, root: for each linked
    node but the roots, the least node of its component. A turn never adds links."""
    most = links.count() if most is None else most
    e = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = slim(e, most)
    while not _is_forest_of_stars(e):
        e = slim(_small_star(_large_star(e)).distinct(), most)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))

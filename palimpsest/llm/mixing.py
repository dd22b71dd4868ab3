"""Mixing sources to target weights by a time-varying curriculum. Native.

Each source has a weight schedule over training time [0, 1], piecewise linear; its integral is the source's weight and
its share of all words. Targets stop at `most_repeats` times the source's words, the excess being reshared by weight.
A source's words are laid end to end in hash order, again and again up to its target; the word at a fraction q of the
target is due when the schedule's integral has reached q, and documents are range-sorted by that position.

Defined cases: null text has no words; a null source is a source of its own, the last; a document without words, or
past its source's target, is taken 0 times and has no position; repeated rows count each; an empty table gives an
empty result; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD, cut, read

WEIGHTS = [1.0, 2.0, 3.0]
MOST_REPEATS = 3
#: Shapes by weight: early, even and late sources; scaled so that each integrates to 1.
SCHEDULES = [[(0.0, 1.5), (1.0, 0.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 0.4), (0.5, 1.0), (1.0, 1.6)]]
#: Sub-ranges of a source's hash order that are summed apart: no task holds a whole source.
BUCKET_BITS = 10


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: list[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """sizes: source, source_size; one row a source. Adds `kind` (place in the weights' cycle) and `target`.

    The repeated resharing ends at one level L with target = least(most x size, L x weight): in the order of
    size / weight, the first source that its share does not fill gives L.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("kind", (F.row_number().over(order) - 1) % len(weights))
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1))
    s = s.withColumn("cap", F.col("source_size").cast("double") * most).withColumn("fill", F.col("cap") / F.col("w"))
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up = Window.orderBy("fill", "kind", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("level", F.when(
        F.col("source_size") >= 0,
        (F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("cap").over(up), F.lit(0.0)))
        / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(up), F.lit(0.0))),
    ))
    s = s.withColumn("level", F.min_by(F.when(F.col("level") <= F.col("fill"), F.col("level")),
                                       F.when(F.col("level") <= F.col("fill"), F.col("fill"))).over(whole))
    target = F.least("cap", F.col("level") * F.col("w"))
    return s.select("source", "source_size", "kind", F.coalesce(target, F.lit(0.0)).alias("target"))


def due(q: Column, knots: list[tuple[float, float]]) -> Column:
    """The time at which the schedule's integral reaches the fraction q of its whole."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    total, at, out = sum(areas), 0.0, F.lit(1.0)
    spans = []
    for (a, b), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        spans.append((a, b, at))
        at += area
    for (t0, w0), (t1, w1), before in reversed(spans):
        need, slope = q * total - before, (w1 - w0) / (t1 - t0)
        # w0 x + slope x^2 / 2 = need, in the form that also holds for slope 0
        x = 2 * need / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))))
        inside = q * total >= before
        out = F.when(inside & (q * total <= before + (t1 - t0) * (w0 + w1) / 2), t0 + x).otherwise(out)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


def mix(docs: DataFrame, key: list[str], carry: list[str] = (), weights=WEIGHTS, schedules=SCHEDULES,
        most: int = MOST_REPEATS) -> DataFrame:
    """Rows of docs (key, source, size and carry) with source_size, kind, start, target, taken and position.

    The running sum of a source is that within a sub-range of its hash order plus the sub-range's offset, so that one
    source with a third of all rows still spreads over tasks.
    """
    docs = docs.withColumn("_h", F.xxhash64(*key, F.lit("mix"))).withColumns({
        "_b": F.shiftrightunsigned("_h", 64 - BUCKET_BITS).cast("int"),
        "_s": F.coalesce("source", F.lit("")), "_z": F.col("source").isNull(),
    })
    place = ["_s", "_z", "_b"]
    parts = cut(docs.groupBy(*place).agg(F.sum("size").alias("_n")))
    before = Window.partitionBy("_s", "_z").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*place, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    own_source = F.when(~F.col("_z"), F.col("_s")).alias("source")
    sizes = parts.groupBy("_s", "_z").agg(F.sum("_n").alias("source_size")).select(own_source, "source_size")
    sources = targets(sizes, weights, most).select(
        F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_z"), "source_size", "kind", "target"
    )
    inner = Window.partitionBy(*place).orderBy("_h", *key, "size").rowsBetween(Window.unboundedPreceding, -1)
    own = docs.withColumn("_c", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    x = own.join(offsets.join(sources, ["_s", "_z"]), place)
    start = F.col("_o") + F.col("_c")
    passes = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0)
    rest = F.round("target").cast("bigint") - passes * F.col("source_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    x = x.withColumns({"start": start, "taken": taken.cast("bigint")})
    position = F.when(F.col("taken") > 0, position_of(F.col("start"), schedules))
    return x.select(*key, "source", *carry, "size", "source_size", "kind", "start", "target", "taken", position.alias("position"))


def position_of(start: Column, schedules=SCHEDULES) -> Column:
    """Training time of the word at `start` of a source's laid-out words; of columns kind and target."""
    q = F.when(F.col("target") > 0, F.least(F.lit(1.0), start / F.col("target")))
    out = F.lit(None).cast("double")
    for kind, knots in enumerate(schedules):
        out = F.when(F.col("kind") % len(schedules) == kind, due(q, knots)).otherwise(out)
    return out


def training_rows(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them, range-sorted by training position.

    A document comes as often as its taken words make up whole copies, rounded; copy k stands where the source's words
    are laid out for the k-th time. The texts are shuffled twice: by sub-range of their source, and by position.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d")
    x = docs.select("doc_id", "source", F.xxhash64("text").alias("_th"), words(F.col("text")).alias("size"), row)
    x = mix(x, ["doc_id", "_th"], ["_d"]).filter("taken > 0")
    x = x.withColumn("copies", F.round(F.col("taken") / F.col("size")).cast("int")).filter("copies > 0")
    x = x.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    x = x.withColumn("_p", position_of(F.col("start") + F.col("_k") * F.col("source_size")))
    return x.orderBy("_p", "doc_id").select("_d.*")


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, position; in training order."""
    thin = cut(docs.select("doc_id", "source", words(F.col("text")).alias("size")))  # the texts are read once
    out = mix(thin, ["doc_id"]).orderBy(F.col("position").asc_nulls_last(), "doc_id")
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "position")


def op9(spark, sf_dir):
    return mix_documents(read(spark, sf_dir, "documents"))

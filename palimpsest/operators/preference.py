"""Section diffs as rows, preference records, prompts and the split."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import diffs as D
from palimpsest.operators.sections import SECTIONS, section_diffs

META = ["page_id", "page_title", "section", "rev_id", "prev_rev_id", "timestamp", "contributor", "comment"]
# Fixed value: how the prompt without a model begins.
PROMPT = "Write something about "

ASK = "Give an instruction that this text would answer."

Client = Callable[[list[str]], list[str]]


def diff_rows(df: DataFrame, old: str, new: str, context: int = 3, save_all: bool = True, latest: str | None = None):
    """(old_text, new_text) rows of each text pair, each text taken as one section.

    latest: the newest text; changes that it does not hold are dropped unless save_all.
    """
    rest = [c for c in df.columns if c not in (old, new, latest, "section")]
    one = lambda c: F.array(F.struct(F.lit("").alias("path"), F.coalesce(F.col(c), F.lit("")).alias("text")))
    pairs = df.select(
        *(F.col(f"`{c}`") for c in rest), one(old).alias("old_sections"), one(new).alias("new_sections"),
        (one(latest) if latest else F.lit(None).cast(SECTIONS)).alias("latest"), F.lit(save_all).alias("save_all"),
    )
    return section_diffs(pairs, context).drop("section")


def simple_prompt(title: Column, section: Column) -> Column:
    return F.concat(F.lit(PROMPT), title, F.lit(" - "), section)


def prompt_messages(title: Column, section: Column, text: Column) -> Column:
    """The chat request for a prompt model, as canonical JSON."""
    ask = F.to_json(F.struct(title.alias("title"), section.alias("section"), text.alias("text")))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.to_json(F.array(turn("system", F.lit(ASK)), turn("user", ask)))


def strip_instruction(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"^\s*Instruction:", ""))


PROMPT_KEY = ["page_id", "rev_id", "section", "old_text", "new_text"]


def generate_prompts(df: DataFrame, client: Client, done: DataFrame | None = None) -> DataFrame:
    """PROMPT_KEY and prompt of the rows that have none in `done`, asked from the injected client, a batch at a time."""
    todo = df.select("page_title", *PROMPT_KEY).dropDuplicates(PROMPT_KEY)
    if done is not None:
        have = done.filter("prompt <> ''").select(*(F.col(c).alias(f"_{c}") for c in PROMPT_KEY))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PROMPT_KEY]
        todo = todo.join(have, on[0] & on[1] & on[2] & on[3] & on[4], "left_anti")
    asked = todo.select(*PROMPT_KEY, prompt_messages(F.col("page_title"), F.col("section"), F.col("new_text")).alias("prompt"))

    def run(batches):
        for b in batches:
            answers = pa.array([a or "" for a in client(b.column("prompt").to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in PROMPT_KEY), answers], b.schema.names)

    return asked.mapInArrow(run, asked.schema).withColumn("prompt", strip_instruction(F.col("prompt")))


def prompted(df: DataFrame, client: Client, folder: str, tries: int = 3) -> DataFrame:
    """df with a model's prompts. Answers are added to the table in `folder`; rows that it has are not asked again, neither
    in a later try nor in a later run. Raises if a row has no prompt after the last try."""
    spark = df.sparkSession
    left = 0
    for _ in range(tries):
        try:
            done = spark.read.parquet(folder)
        except AnalysisException:
            done = None
        generate_prompts(df, client, done).filter("prompt <> ''").write.mode("append").parquet(folder)
        have = spark.read.parquet(folder).dropDuplicates(PROMPT_KEY)
        have = have.select("prompt", *(F.col(c).alias(f"_{c}") for c in PROMPT_KEY))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PROMPT_KEY]
        out = df.join(have, on[0] & on[1] & on[2] & on[3] & on[4], "left").drop(*(f"_{c}" for c in PROMPT_KEY))
        left = out.filter("prompt is null").count()
        if not left:
            return out
    raise ValueError(f"{left} rows are left without a prompt")


def records(df: DataFrame) -> DataFrame:
    """prompt, chosen (new text) and rejected (old text) as two-turn chats, with the metadata."""

    def chat(c: Column) -> Column:
        return F.array(
            F.struct(F.col("prompt").alias("content"), F.lit("user").alias("role")),
            F.struct(c.alias("content"), F.lit("assistant").alias("role")),
        )

    return df.select(*META, "prompt", chat(F.col("new_text")).alias("chosen"), chat(F.col("old_text")).alias("rejected"))


def split(df: DataFrame, keys: list[str], test_size: int | float = 2000, seed: int = 42) -> DataFrame:
    """Adds `split`. A fraction is a threshold on a hash of the keys; a row count is met exactly: rows are ranked by that
    hash, and rows alike in their keys by a hash of all columns. Ranks come from counts by hash range, so that no task
    ranks more than a range's rows."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    if isinstance(test_size, float):
        u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
        return df.withColumn("split", F.when(u < test_size, "test").otherwise("train"))
    rows = df.withColumns({"_h": h, "_x": F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), "_r": F.substring(h, 1, 4)})
    counts = rows.groupBy("_r").agg(F.count("*").alias("_n"))  # 65,536 rows at most
    before = F.sum("_n").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_r", F.coalesce(before, F.lit(0)).alias("_b"))
    place = F.row_number().over(Window.partitionBy("_r").orderBy("_h", "_x"))
    out = rows.join(F.broadcast(counts), "_r").withColumn("split", F.when(F.col("_b") + place <= test_size, "test").otherwise("train"))
    return out.select(*(F.col(f"`{c}`") for c in df.columns), "split")


def review_sample(df: DataFrame, n: int = 1000, seed: int | None = None) -> DataFrame:
    """n random rows, each with its texts' differences marked sign by sign."""
    marked = F.udf(lambda o, w: D.review_html(o or "", w or ""), "string", useArrow=True)
    return df.orderBy(F.rand(seed)).limit(n).withColumn("review", marked("old_text", "new_text"))


def diff_json(segments: Column) -> Column:
    """Nested diff items (structs of kind, text, old and new) as JSON."""
    return F.to_json(segments)

"""Diff rows to preference records, stage by stage, each written under one folder and taken up again from there."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators import filters as f
from palimpsest.operators import preference as p
from palimpsest.operators import templates as t
from palimpsest.operators.sinks import Stages, write_records


def _nothing(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def build(
    diffs: DataFrame, kind: str, folder: str, prompt: str = "simple", client: p.Client | None = None, test_size: int | float = 2000,
    renderer: t.Renderer | None = None, known: DataFrame | None = None, invalid: DataFrame | None = None,
) -> DataFrame:
    """Records with `split`, also written as JSON lines to folder/train and folder/test.

    diffs: the ten diff columns, `source` and `row_ord`. kind: fa or npov. known and invalid: lookup tables of templates.
    prompt: simple, or model with a client.
    """
    if kind not in ("fa", "npov") or prompt not in ("simple", "model"):
        raise ValueError(f"unknown kind {kind!r} or prompt {prompt!r}")
    spark, stage = diffs.sparkSession, Stages(diffs.sparkSession, folder)
    outliers = f.outliers_fa if kind == "fa" else f.outliers_npov
    merged = stage("merged", lambda: f.merge_dedupe(diffs, "source", "row_ord"))
    cols = merged.columns
    first = (lambda: outliers(merged)) if kind == "fa" else (lambda: outliers(f.keep_single_edits(merged)))
    filtered = stage("filtered", lambda: first().select(*cols))
    known = _nothing(spark, "template string, rendered string") if known is None else known
    invalid = _nothing(spark, "template string") if invalid is None else invalid
    rendered = stage("rendered", lambda: t.render_rows(filtered, known, invalid, renderer)[0])
    bleu = f.cut_bleu_fa if kind == "fa" else f.cut_bleu_npov
    cleaned = stage("cleaned", lambda: f.drop_removals(bleu(outliers(f.drop_markup(rendered)))).select(*cols))
    if prompt == "simple":
        asked = cleaned.withColumn("prompt", p.simple_prompt(F.col("page_title"), F.col("section")))
    else:
        asked = p.prompted(cleaned, client, f"{folder.rstrip('/')}/prompts")
    records = stage("records", lambda: p.split(p.records(asked), ["page_id", "rev_id", "section"], test_size))
    write_records(records, folder.rstrip("/"))
    return records

"""Tables on disk: page histories, diffs with their rejects, stage checkpoints, and the published records."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Signs that no file name should hold.
UNSAFE = '/\\<>:"|?*'


def safe_name(title: Column) -> Column:
    return F.translate(title, UNSAFE, "_" * len(UNSAFE))


def write_pages(revs: DataFrame, folder: str, buckets: int = 64) -> None:
    """Revisions by page: all of a page's in one bucket's folder, in their order. Buckets, not pages, are folders."""
    rows = revs.withColumns({"page_file": safe_name(F.col("page_title")), "bucket": F.pmod(F.xxhash64("page_id"), F.lit(buckets))})
    rows.repartition("bucket", F.pmod(F.col("page_id"), F.lit(8))).sortWithinPartitions("bucket", "page_id", "rev_ord").write.mode(
        "overwrite"
    ).partitionBy("bucket").parquet(folder)


def write_checked(df: DataFrame, folder: str, rejects: str, error: str = "error") -> None:
    """Rows without an error go to `folder`, the others to `rejects`; a folder is there once its write has ended."""
    df.filter(F.col(error).isNull()).drop(error).write.mode("overwrite").parquet(folder)
    df.filter(F.col(error).isNotNull()).write.mode("overwrite").parquet(rejects)


def write_edits(edits: DataFrame, folder: str) -> None:
    cols = ["page_id", "page_title", "rev_id", "parent_rev_id", "comment"]
    edits.select(*cols).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(folder)


class Stages:
    """Named stage tables under one folder. A stage that is there is read, any other is made, written and read again, so
    a run that broke goes on where it stopped."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.seen = spark, folder.rstrip("/"), {}

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{name}"
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:
            pass
        rows = Observation(name)
        # a half-written stage has files but no schema of its own, so it does not count as there
        make().observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        self.seen[name] = rows.get["rows"]
        return self.spark.read.parquet(path)


def write_records(records: DataFrame, folder: str) -> None:
    """train and test as JSON lines, a folder each."""
    for name in ("train", "test"):
        records.filter(F.col("split") == name).drop("split").write.mode("overwrite").json(f"{folder}/{name}")

"""What the operators share: lineage cuts in the cluster's shared folder, and the definition of white space."""

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts define it.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def shared_dir(spark: SparkSession) -> None:
    """The checkpoint folder is the cluster's. Only a local master (tests) may go without: it gets a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder: later plans read it there, lost executors or not."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def slim(df: DataFrame, rows: int, each: int = 1 << 18) -> DataFrame:
    """`cut` for a table of narrow rows, at most `rows` of them: its last stage has a task, and the folder a file, for
    every `each` rows, not for every shuffle partition. (A store that is a local file system without Hadoop's native
    library starts processes for each file, for its permissions.)"""
    return cut(df.coalesce(max(1, -(-rows // each))))


def carried(df: DataFrame, **own: Column) -> DataFrame:
    """One column `row` with all of df's, whatever their names, beside the named ones that an operator needs."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(c.alias(n) for n, c in own.items()))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unit_hash(*cols: Column) -> Column:
    """A double in (0, 1) from 53 bits of a stable hash."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(1 << 53)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

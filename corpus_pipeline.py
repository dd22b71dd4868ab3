"""A corpus pipeline of five training-data operators, from documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs, which have the columns of `documents`; all but
the last return those columns. Rows without a doc_id go through all stages like others. An empty table gives an empty
result.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import langid, line_dedup, mixing, near_dedup, packing
from palimpsest.llm.common import carried, cut, read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the texts that are in no language: those without a letter. A document without a language gets the predicted
    one. If no language could be learned, all texts with a letter stay as they are.

    Null and empty texts have no letter. Repeated rows share their fate. Columns beside doc_id, text and lang do not matter
    and stay."""
    learned = langid.learned(docs)
    if not learned:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    told = langid.tell(carried(docs, text=F.col("text")), learned)
    known = F.col("lang_pred") != langid.UNKNOWN
    now = {"lang": F.coalesce("row.lang", "lang_pred")}
    return told.filter(known).select(*(now.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes blocks of lines that an earlier document has; a document of which nothing is left goes.

    Null texts and texts without a line that is not blank stay. Rows alike in id and text are one document."""
    out = line_dedup.deduped(docs)
    left = (F.size("deleted") == 0) | (F.size("deleted") < F.col("n_lines"))
    now = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return out.filter(left).select(*(now.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id, null last, of each group of near duplicates; rows alike in id and text count
    once. Rows are told apart by id and 128 bits of the text, in that order, as ids may be null or repeated: so no row
    needs a number, and whole rows are shuffled once, at the end. Null and blank texts link with nothing and stay."""
    bits = {"th": F.xxhash64("text"), "uh": F.xxhash64(F.lit(1), "text")}
    key = F.struct(F.col("doc_id").isNull().alias("nul"), F.col("doc_id").alias("id"), *(c.alias(n) for n, c in bits.items()))
    found = near_dedup.near_duplicates(docs.select(key.alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id").alias("key")).distinct()
    rows = carried(docs, key=key).join(kept, "key", "left_semi").dropDuplicates(["key"])
    return rows.select(*(F.col(f"row.`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target takes them, in training order."""
    return mixing.training_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_near),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]
#: Alignment, minima and packing are no SQL; no brute-force version of the whole pipeline exists yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs

"""Title lists, dump manifests, edit lists and stage tables."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the class of the elements that list a featured article.
FEATURED_CLASS = "featured_article_metadata has_been_on_main_page"
STUB = r"stub-meta-history\d+\.xml\.gz$"
EDIT_COLUMNS = "page_id bigint, page_title string, rev_id bigint, parent_rev_id bigint, comment string"


def featured_titles(pages: DataFrame, html: str = "html") -> DataFrame:
    """title, slug of the articles that pages of a title list name: of each listing element, its first link, if that
    leads to a wiki page."""
    span = rf'(?s)<span[^>]*class="{FEATURED_CLASS}"[^>]*>(?:(?!</span>).)*?<a\s[^>]*>.*?</a>'
    found = pages.select(F.explode(F.regexp_extract_all(html, F.lit(span), F.lit(0))).alias("x"))
    slug = F.regexp_extract("x", r'(?s)<a\s[^>]*href="/wiki/([^"#]+)', 1)
    title = F.regexp_replace(F.regexp_extract("x", r"(?s)<a\s[^>]*>(.*?)</a>", 1), "<[^>]+>", "")
    for mark, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(mark), F.lit(sign))
    return found.select(title.alias("title"), slug.alias("slug")).filter("slug <> ''")


def manifest(spark: SparkSession, path: str, job: str) -> DataFrame:
    """name, url of the files of one job of a dump status file."""
    files = "struct<files: map<string, struct<url: string, size: bigint>>>"
    status = spark.read.text(path, wholetext=True).select(F.from_json("value", f"jobs struct<{job}: {files}>").alias("s"))
    return status.select(F.explode(F.col(f"s.jobs.{job}.files")).alias("name", "file")).select("name", "file.url")


def history_archives(spark: SparkSession, path: str) -> DataFrame:
    return manifest(spark, path, "metahistorybz2dump")


def stub_archives(spark: SparkSession, path: str) -> DataFrame:
    """Numbered stub archives only, in the order of their names."""
    return manifest(spark, path, "xmlstubsdump").filter(F.col("name").rlike(STUB)).orderBy("name")


def titles(spark: SparkSession, path: str) -> DataFrame:
    """page_title: the first column of a CSV list with a header, each once."""
    df = spark.read.csv(path, header=True, quote='"', escape='"')
    return df.select(F.col(f"`{df.columns[0]}`").alias("page_title")).distinct()


def edits(spark: SparkSession, path: str) -> DataFrame:
    """An edit list in CSV, with or without a header line; a root revision's parent is null."""
    raw = spark.read.csv(path, schema=re.sub("bigint", "string", EDIT_COLUMNS), quote='"', escape='"', multiLine=True)
    number = lambda c: F.expr(f"try_cast(nullif({c}, '') as bigint)").alias(c)
    return raw.filter("page_id <> 'page_id'").select(
        number("page_id"), "page_title", number("rev_id"), number("parent_rev_id"), F.coalesce("comment", F.lit("")).alias("comment")
    )


def files(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """path, size of a folder's files with this ending, the largest first. Their contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").load(folder)
    return found.select("path", F.col("length").alias("size")).orderBy(F.desc("size"), "path")


def history_files(spark: SparkSession, folder: str) -> DataFrame:
    return files(spark, folder, ".xml")


def diff_files(spark: SparkSession, folder: str) -> DataFrame:
    """Finished diff files; .ERROR and .INP are not among them."""
    return files(spark, folder, ".csv")


DIFF_COLUMNS = (
    "page_title string, page_id bigint, rev_id bigint, prev_rev_id bigint, timestamp string, contributor string, comment string, "
    "section string, old_text string, new_text string"
)


def diffs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all diff files in a folder, with `source` (their file) and `row_ord`, which rises in the file's order. Empty
    fields are empty texts; words like NA or null are texts as they stand."""
    read = spark.read.option("pathGlobFilter", "*.csv")
    raw = read.csv(folder, schema=DIFF_COLUMNS, header=True, quote='"', escape='"', multiLine=True, nullValue="", emptyValue="")
    text = {c: F.coalesce(c, F.lit("")) for c, kind in raw.dtypes if kind == "string"}
    return raw.withColumn("source", F.col("_metadata.file_path")).withColumns(text).withColumn("row_ord", F.monotonically_increasing_id())

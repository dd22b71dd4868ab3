"""Revision histories (XML, also .gz and .bz2) as one row for each revision.

The files are read as text that ends at each revision's closing tag, so Spark splits large files, reads every store and
compression that it knows, and no task holds more than one revision. A page's title and id stand before its first
revision only: within a split they are carried on from row to row, and the first rows of a split take them from the last
split before that names a page, through a table of one row for each split.
"""

import html
import re
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END = "</revision>"
_PAGE = re.compile(r"<page\b[^>]*>(?:(?!<page\b).)*\Z", re.S)
_FIELDS = {
    "page_id": pa.int64(), "page_title": pa.string(), "page_ns": pa.int32(), "rev_id": pa.int64(), "parent_id": pa.int64(),
    "ts": pa.string(), "is_minor": pa.bool_(), "contributor": pa.string(), "comment": pa.string(), "sha1": pa.string(),
    "text_size": pa.int32(), "text": pa.string(), "error": pa.string(), "file": pa.string(), "split": pa.int64(), "place": pa.int64(),
}
_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}
SCHEMA = ", ".join(f"{n} {_TYPES[t]}" for n, t in _FIELDS.items())
COLUMNS = [n for n in _FIELDS if n not in ("file", "split", "place")]


def _number(text: str | None, otherwise: int | None = None) -> int | None:
    text = (text or "").strip()
    return int(text) if re.fullmatch(r"-?\d+", text) else otherwise


def page_of(head: str) -> dict | None:
    """Title, id and namespace of the last page that opens in the text before a revision; None if none does."""
    m = _PAGE.search(head)
    if not m:
        return None
    one = lambda tag: next(iter(re.findall(rf"<{tag}>(.*?)</{tag}>", m.group(), re.S)), None)
    title = one("title")
    return {
        "page_id": _number(one("id")), "page_title": None if title is None else html.unescape(title), "page_ns": _number(one("ns"))
    }


def revision_of(body: str, with_text: bool = True) -> dict:
    """Fields of one revision, given as what stands between its tags. Names of contributors or their addresses count, not
    their ids; a size that is missing or no number is -1; text that is no XML gives an error and nothing else."""
    try:
        x = ElementTree.fromstring(f"<revision>{body}</revision>")
    except ElementTree.ParseError as e:
        return {"error": f"xml: {e}"}
    who, text = x.find("contributor"), x.find("text")
    name = None if who is None else who.findtext("username") if who.find("username") is not None else who.findtext("ip")
    return {
        "rev_id": _number(x.findtext("id")), "parent_id": _number(x.findtext("parentid")), "ts": x.findtext("timestamp"),
        "is_minor": x.find("minor") is not None, "contributor": name, "comment": x.findtext("comment"), "sha1": x.findtext("sha1"),
        "text_size": -1 if text is None else _number(text.get("bytes"), -1),
        "text": (text.text or "") if with_text and text is not None else None,
    }


def _parsed(with_text: bool):
    def run(batches):
        at, page, place = None, {}, 0
        for b in batches:
            rows = []
            for chunk, file, split in zip(*(b.column(c).to_pylist() for c in ("value", "file", "split")), strict=True):
                if (file, split) != at:
                    at, page, place = (file, split), {}, 0
                head, opened, body = chunk.partition("<revision>")
                page = page_of(head) or page
                if opened:
                    rows.append(page | revision_of(body, with_text) | {"file": file, "split": split, "place": place})
                    place += 1
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in _FIELDS} for r in rows], pa.schema(_FIELDS))

    return run


def read_history(spark: SparkSession, path: str | list[str], with_text: bool = True) -> DataFrame:
    """Revisions with their page's fields and rev_ord, which rises in the file's order (not by ones).

    with_text: False leaves `text` null, for stubs and for work on comments alone. Rows with an `error` hold no fields
    of their own. An empty file gives no rows; text outside pages is ignored.
    """
    own = ["value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    chunks = spark.read.option("lineSep", END).text(path).select(*own)
    rows = chunks.mapInArrow(_parsed(with_text), SCHEMA)
    # the page that is open at a split's end: one row for each split, from the last chunk that opens one
    opening = F.col("value").contains("<page>")
    opens = chunks.withColumn("at", F.when(opening, F.monotonically_increasing_id())).groupBy("file", "split").agg(
        F.max_by(F.when(opening, F.element_at(F.split("value", "<page>"), -1)), "at").alias("head")
    )
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = opens.select("file", "split", F.last("head", ignorenulls=True).over(before).alias("head"))
    title = F.regexp_extract("head", r"(?s)<title>(.*?)</title>", 1)
    for mark, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(mark), F.lit(sign))
    known = carried.filter("head is not null").select(
        "file", "split", title.alias("t"), F.expr(r"try_cast(regexp_extract(head, '<id>(\\d+)</id>', 1) as bigint)").alias("i"),
        F.expr(r"try_cast(regexp_extract(head, '<ns>(-?\\d+)</ns>', 1) as int)").alias("n"),
    )
    rows = rows.join(known, ["file", "split"], "left").withColumns({
        "page_title": F.coalesce("page_title", "t"), "page_id": F.coalesce("page_id", "i"), "page_ns": F.coalesce("page_ns", "n"),
        "ts": F.to_timestamp("ts"), "rev_ord": F.shiftleft(F.col("split"), 24) + F.col("place"),
    })
    return rows.select(*COLUMNS, "file", "rev_ord")

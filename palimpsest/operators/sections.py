"""Wiki text to sections, their sentences, and section-wise diffs, as Arrow functions over whole rows.

Defined cases: null markup is empty markup, with one empty lead section; markup that cannot be parsed has no sections and
an error code in place of an exception; an empty table gives an empty result; other columns are carried through.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import diffs as D
from palimpsest.functions import text as X
from palimpsest.functions import wikitext as W
from palimpsest.functions.sentences import Splitter, rule_sentences, section_sentences

SECTIONS = "array<struct<path: string, text: string>>"
PARSED = f"struct<error: string, sections: {SECTIONS}>"


_PARSED = pa.struct([("error", pa.string()), ("sections", pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())])))])


def _by_slices(fn, kind: pa.DataType, ddl: str, rows: int = 64):
    """fn as an Arrow function of one column. A few rows at a time are Python objects, so that a batch of whole documents
    and its results stand in memory once, as Arrow."""

    def run(c: pa.Array) -> pa.Array:
        parts = [pa.array([fn(x) for x in c.slice(k, rows).to_pylist()], kind) for k in range(0, len(c), rows)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return F.arrow_udf(run, ddl)


def _parse(markup: str | None, lenient: bool) -> dict:
    try:
        found = W.sections(markup or "", lenient)
    except W.MarkupError as e:
        return {"error": str(e), "sections": None}
    return {"error": None, "sections": [{"path": p, "text": t} for p, t in found]}


def parse(markup: Column, lenient: bool = False) -> Column:
    """struct(error, sections) of a markup."""
    return _by_slices(lambda m: _parse(m, lenient), _PARSED, PARSED)(markup)


def with_sections(df: DataFrame, markup: str = "text", lenient: bool = False) -> DataFrame:
    """Adds `error` and `sections`; sections that a sentence splitter would choke on make an error of their own."""
    bad = F.exists("sections", lambda s: X.has_problem_pattern(s.text) | X.too_long_for_model(s.text))
    # the function's result is used several times: not deterministic in name only, so that it runs once
    one = _by_slices(lambda m: _parse(m, lenient), _PARSED, PARSED).asNondeterministic()(F.col(markup))
    out = df.withColumn("_p", one).withColumns({"error": F.col("_p.error"), "sections": F.col("_p.sections")}).drop("_p")
    return out.withColumn("error", F.when(F.col("error").isNull() & bad, "unsplittable").otherwise(F.col("error")))


def normalised(sections: str = "sections") -> Column:
    """path -> text with white space collapsed; the last of equal paths counts."""
    pairs = F.transform(sections, lambda s: F.struct(s.path, X.collapse_ws(s.text)))
    lasting = F.filter(pairs, lambda p: p.path.isNotNull())
    return F.aggregate(
        lasting, F.create_map().cast("map<string,string>"),
        lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["path"]), F.create_map(p["path"], p["col2"])),
    )


def section_sentence_rows(df: DataFrame, splitter: Splitter = rule_sentences) -> DataFrame:
    """page columns, section, sentences (newline runs are sentences too) of each of `sections`."""
    rest = [c for c in df.columns if c != "sections"]
    split = _by_slices(lambda t: section_sentences(t, splitter), pa.list_(pa.string()), "array<string>")
    rows = df.select(*rest, F.posexplode("sections").alias("place", "s"))
    return rows.select(*rest, "place", F.col("s.path").alias("section"), split("s.text").alias("sentences"))


def _rows(context: int, splitter: Splitter, rest: pa.Schema):
    schema = pa.schema([*rest, pa.field("section", pa.string()), pa.field("old_text", pa.string()), pa.field("new_text", pa.string())])

    def run(batches):
        for b in batches:
            out = {"row": [], "section": [], "old_text": [], "new_text": []}
            for k in range(b.num_rows):
                old, new, latest, save_all = (b.column(c)[k].as_py() for c in ("old_sections", "new_sections", "latest", "save_all"))
                latest = None if latest is None else {s["path"]: " ".join(s["text"].split()) for s in latest}
                right = {s["path"]: s["text"] for s in new or []}
                # a section that the newest text no longer has, or that did not change, needs no sentences
                old = [s for s in old or [] if s["path"] in right and right[s["path"]] != s["text"] and (latest is None or s["path"] in latest)]
                left = [(s["path"], s["text"], section_sentences(s["text"], splitter)) for s in old]
                other = [(s["path"], right[s["path"]], section_sentences(right[s["path"]], splitter)) for s in old]
                for path, segments in D.compare_sections(left, other, context):
                    now = None if latest is None else latest[path]
                    keep = (lambda o, n, now=now: D.is_retained(now, o, n)) if now is not None else (lambda o, n: True)
                    for o, n in D.pair_rows(segments, keep, bool(save_all)):
                        for c, v in (("row", k), ("section", path), ("old_text", o), ("new_text", n)):
                            out[c].append(v)
            at = pa.array(out.pop("row"), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(f.name).take(at) for f in rest), *(pa.array(v, pa.string()) for v in out.values())], schema=schema)

    return run


def section_diffs(pairs: DataFrame, context: int = 3, splitter: Splitter = rule_sentences) -> DataFrame:
    """pairs: any columns, old_sections, new_sections, latest (sections of the newest text, or null to retain every
    change) and save_all. Gives the other columns with section, old_text and new_text of each merged change."""
    from pyspark.sql.pandas.types import to_arrow_schema

    used = ("old_sections", "new_sections", "latest", "save_all")
    rest = pairs.select(*(c for c in pairs.columns if c not in used))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    schema = ", ".join(x for x in (fields, "section string, old_text string, new_text string") if x)
    return pairs.mapInArrow(_rows(context, splitter, to_arrow_schema(rest.schema)), schema)


def newest_sections(revs: DataFrame, n: int = 5, text: str = "text") -> DataFrame:
    """page_id, latest_ord, latest: sections of each page's newest revision that can be parsed, among its last n; if none
    can, of the newest, parsed leniently. Only the last n of a page are parsed."""
    from palimpsest.operators.revisions import latest_n

    slim = latest_n(revs.select("page_id", "rev_ord", "ts"), n).select("page_id", "rev_ord", "recency")
    few = revs.select("page_id", "rev_ord", text).join(slim, ["page_id", "rev_ord"])
    strict = _by_slices(lambda m: _parse(m, False), _PARSED, PARSED).asNondeterministic()(F.col(text))
    tried = few.withColumn("p", strict).select("page_id", "rev_ord", "recency", text, "p.error", "p.sections")
    best = tried.groupBy("page_id").agg(
        F.min_by(F.struct("rev_ord", "sections"), F.when(F.col("error").isNull(), F.col("recency"))).alias("good"),
        F.min_by(F.struct("rev_ord", F.col(text).alias("markup")), "recency").alias("newest"),
    )
    spare = parse(F.when(F.col("good").isNull(), F.col("newest.markup")), lenient=True)
    return best.withColumn("spare", spare).select(
        "page_id", F.coalesce("good.rev_ord", "newest.rev_ord").alias("latest_ord"), F.coalesce("good.sections", "spare.sections").alias("latest")
    )

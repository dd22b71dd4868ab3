"""Templates in texts: replaced by their rendered text from a lookup table, and by an injected renderer for what it lacks.

Defined cases: null text stays null and unchanged; a text without templates is not changed; a template that is known to be
invalid, or that cannot be rendered, makes the whole text fail (null); an empty rendering is looked up again each time.
"""

import html as html_entities
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from palimpsest.functions import wikitext as W

# The marks around a template in a request, the longest request, and what unwanted HTML looks like.
MARK_START, MARK_END = "WIKIDPOSTART__", "__WIKIDPOEND"
LONGEST = 8081
UNWANTED = (
    r'(?s)(<[^>]*\bclass=".*?(locmap|thumb|error|mw-message-box-error|mw-ext-score).*?"[^>]*>)|'
    r'(<a[^>]*\bclass="new"[^>]*\btitle="Template[^"]*"[^>]*>)'
)
STYLE, RAISED, TAG = r'(?s)<style data-mw-deduplicate="TemplateStyles[^>]*>.*?</style>', r"(?s)<sup[^>]*>.*?</sup>", r"<[^>]+>"

Renderer = Callable[[str], str | None]
_unescape = F.udf(lambda s: None if s is None else html_entities.unescape(s), StringType(), useArrow=True)


def decode_html(c: Column) -> Column:
    """Rendered HTML as text; null if it shows an error, a map, an image or a missing template."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, STYLE, ""), RAISED, ""), TAG, "")
    # only texts with an entity leave the JVM's hands
    text = F.when(text.contains("&"), _unescape(text)).otherwise(text)
    return F.when(~c.rlike(UNWANTED), F.replace(text, F.lit(" "), F.lit(" ")))


def between_marks(c: Column) -> Column:
    """What a page shows between the marks, on one line; null if they are not there."""
    found = F.regexp_extract(c, f"{MARK_START}(.*?){MARK_END}", 1)
    return F.when(c.rlike(f"{MARK_START}.*?{MARK_END}"), found)


def top_templates(c: Column) -> Column:
    """Sources of a text's top-level templates; an array without rows for null."""
    return F.when(c.contains("{{"), F.udf(W.templates, "array<string>", useArrow=True)(c)).otherwise(F.array().cast("array<string>"))


class Remote:
    """Renders through `fetch(params) -> (status, answer)`; an answer is a parse result with its page under
    parse.text.*. Status 429 is tried again after 1, 2, 4, ... seconds, `tries` times in all; any other failure, and a
    request that is too long, gives None."""

    def __init__(self, fetch: Callable[[dict], tuple[int, dict | None]], tries: int = 5, wait: Callable[[float], None] = time.sleep):
        self.fetch, self.tries, self.wait = fetch, tries, wait

    def __call__(self, template: str) -> str | None:
        text = f"{MARK_START}{template}{MARK_END}"
        if len(text) > LONGEST:
            return None
        params = {"action": "parse", "format": "json", "contentmodel": "wikitext", "text": text, "prop": "text|templates"}
        for k in range(self.tries):
            status, answer = self.fetch(params)
            if status == 200:
                return answer["parse"]["text"]["*"]
            if status != 429:
                return None
            self.wait(2**k)
        return None


def _asked(renderer: Renderer):
    def run(batches):
        for b in batches:
            pages = [renderer(t) for t in b.column("template").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("template"), pa.array(pages, pa.string())], ["template", "page"])

    return run


def lookups(texts: DataFrame, known: DataFrame, invalid: DataFrame, renderer: Renderer | None = None) -> DataFrame:
    """template, rendered (null: it cannot be rendered) of each distinct template in texts (one column, text).

    known: template, rendered; an empty one does not count. invalid: template. Only what neither holds goes to the
    renderer, each template once; without one it cannot be rendered.
    """
    wanted = texts.select(F.explode(top_templates(F.col("text"))).alias("template")).distinct()
    known = known.filter("rendered <> ''").select("template", "rendered").dropDuplicates(["template"])
    bad = invalid.select("template", F.lit(True).alias("bad")).distinct()
    held = wanted.join(known, "template", "left").join(bad, "template", "left")
    sure = held.filter("rendered is not null or bad").select("template", "rendered")
    rest = held.filter("rendered is null and bad is null").select("template")
    if renderer is None:
        return sure.unionByName(rest.withColumn("rendered", F.lit(None).cast("string")))
    pages = rest.mapInArrow(_asked(renderer), "template string, page string")
    return sure.unionByName(pages.select("template", decode_html(between_marks(F.col("page"))).alias("rendered")))


def rendered(texts: DataFrame, found: DataFrame) -> DataFrame:
    """texts: text, each once. found: as `lookups` gives. text, changed, result (null: some template cannot be rendered)."""
    # a text is known by its hash here: most texts have the same few templates, and whole ones would all meet in their tasks
    keyed = texts.filter(F.col("text").isNotNull()).select("text", F.md5("text").alias("_k"))
    rows = keyed.select("_k", F.explode_outer(top_templates(F.col("text"))).alias("template")).distinct()
    rows = rows.join(found.withColumn("_in", F.lit(True)), "template", "left")
    per = rows.groupBy("_k").agg(
        F.collect_set(F.when(F.col("rendered").isNotNull(), F.struct("template", "rendered"))).alias("by"),
        F.count_if(F.col("template").isNotNull() & F.col("rendered").isNull()).alias("failed"),
    )
    # longer sources first: one template's source may be part of another's
    order = F.array_sort("by", lambda a, b: F.length(b.template) - F.length(a.template))
    out = F.aggregate(order, F.col("text"), lambda t, x: F.replace(t, x.template, x.rendered))
    return keyed.join(per, "_k").select("text", (F.size("by") > 0).alias("changed"), F.when(F.col("failed") == 0, out).alias("result"))


def render_rows(df: DataFrame, known: DataFrame, invalid: DataFrame, renderer: Renderer | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of df with the templates of old_text and new_text replaced, and the lookups made. A row goes if a text fails,
    or if something changed and both texts became equal. Equal texts are rendered once."""
    texts = df.select(F.explode(F.array("old_text", "new_text")).alias("text")).filter(F.col("text").contains("{{")).distinct()
    found = lookups(texts, known, invalid, renderer)
    done = rendered(texts, found)
    side = lambda c: done.select(F.col("text").alias(c), F.col("changed").alias(f"_c_{c}"), F.col("result").alias(f"_r_{c}"))
    out = df.join(side("old_text"), "old_text", "left").join(side("new_text"), "new_text", "left")
    failed = lambda c: F.coalesce(F.col(f"_c_{c}").isNotNull() & F.col(f"_r_{c}").isNull(), F.lit(False))
    now = lambda c: F.coalesce(F.col(f"_r_{c}"), F.col(c))
    changed = F.coalesce("_c_old_text", F.lit(False)) | F.coalesce("_c_new_text", F.lit(False))
    out = out.filter(~failed("old_text") & ~failed("new_text") & ~(changed & (now("old_text").eqNullSafe(now("new_text")))))
    out = out.withColumns({"old_text": now("old_text"), "new_text": now("new_text")})
    return out.select(*df.columns), found


def grown(known: DataFrame, invalid: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lookup tables with what `lookups` found: write them anew, in place of the old ones."""
    good, bad = found.filter("rendered <> ''"), found.filter("rendered is null").select("template")
    return known.select("template", "rendered").unionByName(good).dropDuplicates(["template"]), invalid.select("template").unionByName(bad).distinct()

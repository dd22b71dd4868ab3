"""Named queries over the driver tables, with DuckDB twins where SQL can say the same."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import views as V
from palimpsest.functions import text as X
from palimpsest.functions.comments import FEATURED_TAGS, NEUTRAL_TAGS, POV_TOKEN, is_fa_edit, is_npov_edit, tag_pattern
from palimpsest.operators import filters as f
from palimpsest.operators import preference as p
from palimpsest.operators import revisions as r
from palimpsest.operators import sections as w
from palimpsest.operators import templates as t

Query = Callable[[SparkSession, str], DataFrame]
_TABLES = "documents events conversations pages labels"
KEY = ["page_id", "rev_id"]
PAIR = [*KEY, "old_text", "new_text"]


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table, or a view of views.py, over the tables in sf."""
    for t in _TABLES.split():
        if name == t:
            return spark.read.parquet(f"{sf}/{t}.parquet")
    sql = V.VIEWS[name].replace(V.LINES, V.SPARK_LINES)
    source = next(t for t in _TABLES.split() if f"from {t}" in sql)
    sql = sql.replace("{", "{{").replace("}", "}}").replace(f"from {source}", "from {src}")
    return spark.sql(sql, src=spark.read.parquet(f"{sf}/{source}.parquet"))


def _on(name: str, op: Callable[[DataFrame], DataFrame], *cols) -> Query:
    return lambda spark, sf: (op(view(spark, sf, name)).select(*cols) if cols else op(view(spark, sf, name)))


def _lines(sql: str) -> str:
    return V.duck(sql)


_WS = r"[\s\v\x85\x1c-\x1f\pZ]"
_STRIP = rf"regexp_replace({{0}}, '^{_WS}+|{_WS}+$', '', 'g')"
_COLL = rf"trim(regexp_replace({{0}}, '{_WS}+', ' ', 'g'))"
_TOK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
_MAP = "translate({0}, 'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöüÀàâôûùîïëœ', concat(" + ", ".join(
    f"chr({i})" for i in [*range(1, 9), *range(14, 32), 127, *range(33, 38)][:31]
) + "))"
_LEV = f"levenshtein({_MAP.format('old_text')}, {_MAP.format('new_text')})"
_EMPTY = f"{_STRIP.format('old_text')} <> '' and {_STRIP.format('new_text')} <> ''"
_SAME = f"{_COLL.format('old_text')} = {_COLL.format('new_text')}"
_SIMPLE = f"({_SAME} or contains(old_text, new_text) or contains(new_text, old_text))"
_SHORT = r"len(regexp_extract_all(old_text, '[^\s\p{Z}]+')) >= 5 and len(regexp_extract_all(new_text, '[^\s\p{Z}]+')) >= 5"
_REL = "abs(cast(greatest(1, length(new_text)) - length(old_text) as double) / least(greatest(1, length(new_text)), length(old_text))) * 100"
_LOW = "lower(coalesce(comment, ''))"


def _sql_tags(tags: list[str]) -> str:
    return tag_pattern(tags).replace("'", "''")


_CLEAN = (
    f"{_LOW} <> '' and not starts_with({_LOW}, 'rv ') and not regexp_matches({_LOW}, "
    "'revert|undo|undid|rollback|vandalism|wp:vand|wp:vd')"
)
_FA = f"({_CLEAN} and regexp_matches({_LOW}, '{_sql_tags(FEATURED_TAGS)}'))"
_NPOV = (
    f"({_CLEAN} and (regexp_matches({_LOW}, '{POV_TOKEN}') or regexp_matches({_LOW}, "
    f"'npov|neutralized bias|removed pov|impartial|fairness') or regexp_matches({_LOW}, '{_sql_tags(NEUTRAL_TAGS)}')))"
)


def _outlier_sql(q: float, same: str, spare: str, cols: str, src: str = "edits") -> str:
    return V.duck(f"""
with a as (select *, {_REL} as rel from {src} where {_EMPTY}),
b as (select * from a where not {same} and {_SHORT}),
c as (select least(200.0, greatest(150.0, quantile_cont(rel, {q}))) as cut from b),
d as (select b.*, {_LEV} as edit_distance from b, c where rel <= cut)
select {cols} from d where edit_distance > 4
and (cast(edit_distance as double) / length(old_text) > 0.1 or {spare})""").replace("from edits where", "from edits where")


def _twice_sql() -> str:
    """The outlier filters, and once more over what they leave: the second quantile is another one."""
    one = """
a{n} as (select *, {rel} as rel from {src} where {empty}),
b{n} as (select * from a{n} where not {same} and {short}),
c{n} as (select least(200.0, greatest(150.0, quantile_cont(rel, 0.95))) as cut from b{n}),
d{n} as (select b{n}.*, {lev} as far from b{n}, c{n} where rel <= cut),
o{n} as (select * exclude (rel, far) from d{n} where far > 4 and cast(far as double) / length(old_text) > 0.1)"""
    parts = dict(rel=_REL, empty=_EMPTY, same=_SIMPLE, short=_SHORT, lev=_LEV)
    return V.duck("with " + one.format(n=1, src="edits", **parts) + "," + one.format(n=2, src="o1", **parts) + " select page_id, rev_id from o2")


#: HTML as text, but for its entities.
_html = (
    r"case when not regexp_matches(html, '" + t.UNWANTED + r"') then regexp_replace(regexp_replace(regexp_replace(html, '"
    + t.STYLE + r"', '', 'g'), '" + t.RAISED + r"', '', 'g'), '" + t.TAG + r"', '', 'g') end"
)


def _sections(src: str) -> str:
    """The two sections that are left of a page of the wiki views."""
    text = _STRIP.format(r"replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), chr(160), ' ')")
    last = _STRIP.format(text + " || ' label'")
    both = f"[{{'path': 'default__wiki__article__introduction__heading', 'x': {text}}}, {{'path': 'History', 'x': {last}}}]"
    return (
        "cast(null as varchar) as error, u.path as path, cast(length(u.x) as int) as size, md5(u.x) as print "
        f"from (select page_id, unnest({both}) as u from {src})"
    )


_RECORD = "page_id, page_title, section, rev_id, prev_rev_id, timestamp, contributor, comment"


def _records(spark: SparkSession, sf: str, name: str = "edits") -> DataFrame:
    df = f.outliers_npov(view(spark, sf, name))
    out = p.records(df.withColumn("prompt", p.simple_prompt(F.col("page_title"), F.col("section"))))
    return out.select(
        *p.META, "prompt", F.col("chosen")[1].content.alias("chosen"), F.col("rejected")[1].content.alias("rejected")
    )


def _ids(df: DataFrame) -> DataFrame:
    return df.select(*KEY)


def _title_list(spark, sf):
    return view(spark, sf, "edits").filter("page_id % 2 = 0").select("page_title").distinct()


def _newest(revs: DataFrame) -> DataFrame:
    return r.latest_n(revs, 1).select("page_id", F.col("rev_ord").alias("latest_ord"))


def _parsed(name: str, markup: str = "markup") -> Query:
    """page_id, error, path, size, print: a row for each section, or one with the error."""

    def run(spark, sf):
        rows = w.with_sections(view(spark, sf, name), markup).select("page_id", "error", F.explode_outer("sections").alias("s"))
        return rows.select("page_id", "error", F.col("s.path").alias("path"), F.length("s.text").alias("size"), F.md5("s.text").alias("print"))

    return run


def _template_lookup(spark, sf):
    docs = view(spark, sf, "templated")
    rest = [("{{plus}}", "+"), ("{{broken}}", None), *((f"{{{{convert|{i}|km}}}}", f"{i} kilometres") for i in range(4))]
    table = view(spark, sf, "template_table").unionByName(spark.createDataFrame(rest, "template string, rendered string"))
    known, invalid = table.filter("rendered is not null"), table.filter("rendered is null").select("template")
    found = t.lookups(docs.select("text").distinct(), known, invalid)
    out = t.rendered(docs.select("text").distinct(), found)
    # joined by the texts' hashes: no task holds the texts of many copies
    out = out.select(F.md5("text").alias("k"), "changed", F.md5("result").alias("result"))
    return docs.select("page_id", F.md5("text").alias("k")).join(out, "k").select("page_id", "changed", "result")


def _section_rows(spark, sf):
    """Section-wise diffs of each page's markup against an edited one; changes that the newest text lacks are dropped."""
    both = view(spark, sf, "wiki_pages").withColumn("other", F.replace(F.replace("markup", F.lit(" the "), F.lit(" a ")), F.lit(" de "), F.lit(" en ")))
    new = w.with_sections(both, "other").withColumnRenamed("sections", "new_sections").drop("other", "error")
    old = w.with_sections(new, "markup").withColumnRenamed("sections", "old_sections").drop("markup", "error")
    some = F.filter("new_sections", lambda x, i: (i + F.col("page_id")) % 3 != 0)
    rows = w.section_diffs(old.withColumns({"latest": some, "save_all": F.lit(False)}))
    return rows.select("page_id", "section", F.md5("old_text").alias("old_text"), F.md5("new_text").alias("new_text"))


def _wiki_text(spark, sf):
    return view(spark, sf, "wiki_pages").select("page_id", X.collapse_ws(F.col("markup")).alias("norm"))


#: Known before any session is there; the queries themselves are built of columns, which need one.
NAMES = """
q_minimum_preference_records
q_empty_text
q_same_text
q_simple_edit
q_short_text
q_rel_length_quantile_cut
q_edit_distance
q_abs_edit_distance_cut
q_rel_edit_distance
q_outliers_npov
q_outliers_fa
q_outliers_twice
q_comment_fa
q_comment_npov
q_markup_leftovers
q_markup_filter
q_single_edit
q_merge_dedupe
q_length_filter
q_removal
q_bleu
q_bleu_filter_npov
q_bleu_filter_fa
q_quantile_profile
q_word_tokens
q_token_counts
q_line_split
q_text_normalise
q_problem_patterns
q_length_guard
q_namespace_filter
q_title_semi_join
q_processed_anti_join
q_node_split
q_revert_flags
q_revert_counts
q_revision_chain
q_chain_pairs
q_latest_n
q_npov_edits
q_npov_parent_join
q_section_diff
q_up_to
q_wiki_sections
q_reference_stop
q_duplicate_sections
q_template_lookup
q_html_decode
q_section_sentences
q_section_rows
q_diff_rows
q_retained_diffs
q_prompt_messages
q_preference_split
""".split()


#: Those of them that work on the texts of edits, once more over the whole documents (WHOLE_EDITS) under q_whole_.
#: They have no DuckDB twin: its edit distance takes too long on whole texts.
WHOLE = """
q_minimum_preference_records
q_empty_text
q_same_text
q_simple_edit
q_short_text
q_rel_length_quantile_cut
q_edit_distance
q_abs_edit_distance_cut
q_rel_edit_distance
q_outliers_npov
q_outliers_fa
q_outliers_twice
q_removal
q_bleu
q_bleu_filter_npov
q_bleu_filter_fa
q_quantile_profile
q_diff_rows
q_retained_diffs
""".split()


def _built(e: str = "edits") -> dict[str, Query]:
    comment = lambda fn: lambda d: d.select(*KEY, fn(F.col("comment")).alias("hit"))
    return {
        "q_minimum_preference_records": lambda s, d: _records(s, d, e),
        "q_empty_text": _on(e, f.drop_empty, *PAIR),
        "q_same_text": _on(e, f.drop_same, *PAIR),
        "q_simple_edit": _on(e, lambda d: f.drop_same(d, True), *PAIR),
        "q_short_text": _on(e, f.drop_short, *PAIR),
        "q_rel_length_quantile_cut": _on(e, lambda d: f.cut_relative_length(f.drop_empty(d), 0.95), *KEY),
        "q_edit_distance": _on(e, f.with_edit_distance, *KEY, "edit_distance"),
        "q_abs_edit_distance_cut": _on(e, lambda d: f.cut_edit_distance(f.with_edit_distance(d)), *KEY),
        "q_rel_edit_distance": _on(
            e, lambda d: f.cut_relative_edit_distance(f.with_edit_distance(f.drop_empty(d)), spare=is_fa_edit(F.col("comment"))), *KEY
        ),
        "q_outliers_npov": _on(e, f.outliers_npov, *PAIR, "edit_distance"),
        "q_outliers_fa": _on(e, f.outliers_fa, *PAIR, "edit_distance"),
        "q_outliers_twice": _on(e, lambda d: f.outliers_npov(f.outliers_npov(d).select(*d.columns)), *KEY),
        "q_comment_fa": _on(e, comment(is_fa_edit)),
        "q_comment_npov": _on(e, comment(is_npov_edit)),
        "q_markup_leftovers": _on("leftovers", lambda d: d.select("page_id", f.has_markup(F.col("markup")).alias("hit"))),
        "q_markup_filter": _on("leftovers", lambda d: f.drop_markup(d.withColumnsRenamed({"markup": "old_text", "text": "new_text"})), "page_id"),
        "q_single_edit": _on(
            e, lambda d: f.keep_single_edits(d.withColumn("page_id", F.col("page_id") % 900).withColumn("rev_id", F.col("rev_id") % 1000000)), *PAIR
        ),
        "q_merge_dedupe": _on("whole_edits", lambda d: f.merge_dedupe(d, "source", "rev_id"), *PAIR),
        "q_length_filter": _on("whole_edits", f.drop_long, *KEY),
        "q_removal": _on(e, f.drop_removals, *KEY),
        "q_bleu": _on(e, lambda d: f.with_bleu(d).select(*KEY, F.round("bleu_score", 6).alias("bleu_score"))),
        "q_bleu_filter_npov": _on(e, f.cut_bleu_npov, *KEY),
        "q_bleu_filter_fa": _on(e, f.cut_bleu_fa, *KEY),
        "q_quantile_profile": _on(
            e, lambda d: f.quantile_profile(f.drop_empty(d).withColumn("v", X.relative_length_difference(F.col("old_text"), F.col("new_text"))), "v").select(
                *(F.round(c, 6).alias(c) for c in ("p10", "p25", "p50", "p75", "p90", "p95", "p99")))
        ),
        "q_word_tokens": _on("documents", lambda d: d.select("doc_id", F.md5(F.array_join(X.word_tokens(F.col("text")), "|")).alias("tokens"))),
        "q_token_counts": _on("documents", lambda d: d.select("doc_id", X.token_count(F.col("text")).cast("bigint").alias("n"))),
        "q_line_split": _on("documents", lambda d: d.select("doc_id", F.md5(F.array_join(X.line_split(F.col("text")), "|")).alias("pieces"))),
        "q_text_normalise": _wiki_text,
        "q_problem_patterns": _on("repeats", lambda d: d.select("page_id", X.has_problem_pattern(F.col("text")).alias("hit"))),
        "q_length_guard": _on("documents", lambda d: d.select("doc_id", X.too_long_for_model(F.col("text"), 20000).alias("hit"))),
        "q_namespace_filter": _on("pages", lambda d: r.drop_namespaces(d.withColumn("t", F.concat(F.when(F.col("page_id") % 5 == 0, "User talk:").otherwise(""), "url")), "t"), "page_id"),
        "q_title_semi_join": lambda s, d: r.keep_titles(view(s, d, e), _title_list(s, d)).select(*KEY),
        "q_processed_anti_join": lambda s, d: r.skip_processed(view(s, d, "documents"), view(s, d, "labels"), "doc_id").select("doc_id"),
        "q_node_split": _on("documents", lambda d: r.node_split(d.select("source").distinct(), 7, "source").select("source", F.col("node_id").cast("int").alias("node_id"))),
        "q_revert_flags": _on("revs", r.with_first_seen, *KEY, "first_ord", "is_revert"),
        "q_revert_counts": _on("revs", r.revert_counts),
        "q_revision_chain": _on("revs", r.surviving_chain, *KEY, "chain_pos", "rev_ord", "parent_ord"),
        "q_chain_pairs": _on("revs", r.consecutive_pairs, *KEY, "prev_rev_id"),
        "q_latest_n": _on("revs", r.latest_n, *KEY, F.col("recency").cast("int").alias("recency")),
        "q_npov_edits": _on("revs", r.npov_edits, *KEY, "parent_rev_id"),
        "q_npov_parent_join": lambda s, d: r.npov_pairs(r.npov_edits(view(s, d, "revs")), view(s, d, "revs")).select(*KEY, "parent_rev_id"),
        "q_section_diff": _on("chat_pairs", lambda d: p.diff_rows(d, "old_text", "new_text")),
        "q_up_to": _on("revs", lambda d: r.up_to(d, _newest(d)), *KEY),
        "q_wiki_sections": _parsed("wiki_pages"),
        "q_reference_stop": _parsed("wiki_tails"),
        "q_duplicate_sections": _parsed("wiki_twins"),
        "q_template_lookup": _template_lookup,
        "q_html_decode": _on("pages", lambda d: d.select("page_id", F.md5(t.decode_html(F.col("html"))).alias("text"))),
        "q_section_sentences": _on("wiki_pages", lambda d: w.section_sentence_rows(w.with_sections(d, "markup").select("page_id", "sections"))
            .select("page_id", "section", F.size("sentences").alias("n"), F.md5(F.array_join("sentences", "|")).alias("print"))),
        "q_section_rows": _section_rows,
        "q_diff_rows": _on(e, lambda d: p.diff_rows(d.select(*PAIR), "old_text", "new_text")),
        "q_retained_diffs": _on(
            # the newest text is that after the edit, or before it, or neither: about a third of the changes is retained
            e, lambda d: p.diff_rows(
                d.select(*PAIR).withColumn("latest", F.element_at(F.array("new_text", "old_text", F.substring("new_text", 1, 200)), F.pmod("page_id", F.lit(3)).cast("int") + 1)),
                "old_text", "new_text", save_all=False, latest="latest",
            )
        ),
        "q_prompt_messages": _on(e, lambda d: d.select(*KEY, p.prompt_messages(F.col("page_title"), F.col("section"), F.lit("x")).alias("messages"))),
        "q_preference_split": _on(e, lambda d: p.split(d.select(*KEY), KEY, 200), *KEY, "split"),
    }


def queries() -> dict[str, Query]:
    lines = {name: lambda spark, sf, name=name: _built()[name](spark, sf) for name in NAMES}
    whole = {f"q_whole_{n[2:]}": lambda spark, sf, n=n: _built("whole_edits")[n](spark, sf) for n in WHOLE}
    return lines | whole


def oracle_sql() -> dict[str, str]:
    k, pair = "page_id, rev_id", "page_id, rev_id, old_text, new_text"
    e = lambda cols, where="true": V.duck(f"select {cols} from edits where {where}")
    chain = """
with recursive s as (select *, min(rev_ord) over (partition by page_id, sha1, text_size) as fo from revs),
n as (select page_id, rev_ord, fo, lag(fo) over (partition by page_id order by rev_ord) as before from s),
w(page_id, ord, depth) as (
  select page_id, arg_max(fo, rev_ord), 0 from n group by page_id
  union all
  select w.page_id, n.before, depth + 1 from w join n on n.page_id = w.page_id and n.rev_ord = w.ord where n.before is not null),
c as (select page_id, ord as rev_ord, cast(max(depth) over (partition by page_id) - depth + 1 as int) as chain_pos,
  lead(ord) over (partition by page_id order by depth) as parent_ord from w)"""
    edits = f"""{chain}, ed as (select revs.page_id, revs.rev_id, p.rev_id as parent_rev_id, revs.text_size as new_size, p.text_size as old_size
 from c join revs on revs.page_id = c.page_id and revs.rev_ord = c.rev_ord
 left join revs p on p.page_id = c.page_id and p.rev_ord = c.parent_ord where {_NPOV.replace('comment', 'revs.comment')})"""
    dirty = " or ".join(f"contains({{0}}, '{m}')" for m in f.MARKERS) + " or " + " or ".join(
        f"contains({{0}}, '<{t} ') or contains({{0}}, '</{t}>') or contains({{0}}, '</{t} ')" for t in f.HTML_TAGS
    ) + r" or regexp_matches({0}, '(?m)^\s*\|.*?=.*$') or contains(lower({0}), 'redirects here')"
    removal = " and ".join([
        r"len(regexp_extract_all(new_text, '[.!?]+(?:\s|$)')) < len(regexp_extract_all(old_text, '[.!?]+(?:\s|$)'))",
        f"len(regexp_extract_all(new_text, '{_TOK}')) < len(regexp_extract_all(old_text, '{_TOK}'))",
        f"(len(regexp_extract_all(old_text, '{_TOK}')) - len(regexp_extract_all(new_text, '{_TOK}')))::double / greatest(1, len(regexp_extract_all(old_text, '{_TOK}'))) > 0.2",
    ])
    qs = ", ".join(f"round(quantile_cont({_REL}, {q}), 6) as p{round(q * 100):02d}" for q in (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99))
    bleu = r"""
with t as (select page_id, rev_id, regexp_extract_all(old_text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]') as a,
  regexp_extract_all(new_text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]') as b from edits),
g as (select page_id, rev_id, n, side, g, count(*) as k from (
  select page_id, rev_id, n, 0 as side, array_to_string(a[i:i + n - 1], '|') as g from t, range(1, 5) as r(n), lateral (select unnest(range(1, cast(len(a) - n + 2 as bigint))) as i)
  union all
  select page_id, rev_id, n, 1, array_to_string(b[i:i + n - 1], '|') from t, range(1, 5) as r(n), lateral (select unnest(range(1, cast(len(b) - n + 2 as bigint))) as i)) group by all),
h as (select c.page_id, c.rev_id, c.n, sum(least(c.k, coalesce(o.k, 0))) as hit, sum(c.k) as have from (select * from g where side = 1) c
  left join (select * from g where side = 0) o using (page_id, rev_id, n, g) group by all),
s as (select page_id, rev_id, sum(case when hit > 0 then ln(hit::double / have) else ln(2.2250738585072014e-308) end) / 4
  + (4 - count(*)) * ln(2.2250738585072014e-308) / 4 as lg, max(case when n = 1 then hit else 0 end) as h1 from h group by all),
z as (select t.page_id, t.rev_id, case when coalesce(h1, 0) = 0 then 0.0 else
  (case when len(b) > len(a) then 1.0 when len(b) = 0 then 0.0 else exp(1 - len(a)::double / len(b)) end) * exp(lg) end as bleu_score
  from t left join s using (page_id, rev_id))
"""
    return {
        "q_minimum_preference_records": _outlier_sql(
            0.95, _SIMPLE, "false",
            f"{_RECORD}, concat('{p.PROMPT}', page_title, ' - ', section) as prompt, new_text as chosen, old_text as rejected",
        ),
        "q_empty_text": e(pair, _EMPTY),
        "q_same_text": e(pair, f"not {_SAME}"),
        "q_simple_edit": e(pair, f"not {_SIMPLE}"),
        "q_short_text": e(pair, _SHORT),
        "q_rel_length_quantile_cut": V.duck(f"""with a as (select *, {_REL} as rel from edits where {_EMPTY}),
c as (select least(200.0, greatest(150.0, quantile_cont(rel, 0.95))) as cut from a) select {k} from a, c where rel <= cut"""),
        "q_edit_distance": e(f"{k}, cast({_LEV} as int) as edit_distance"),
        "q_abs_edit_distance_cut": e(k, f"{_LEV} > 4"),
        "q_rel_edit_distance": e(k, f"{_EMPTY} and (cast({_LEV} as double) / length(old_text) > 0.1 or {_FA})"),
        "q_outliers_npov": _outlier_sql(0.95, _SIMPLE, "false", f"{pair}, cast(edit_distance as int) as edit_distance"),
        "q_outliers_fa": _outlier_sql(0.99, f"({_SAME})", _FA, f"{pair}, cast(edit_distance as int) as edit_distance"),
        "q_comment_fa": e(f"{k}, {_FA} as hit"),
        "q_comment_npov": e(f"{k}, {_NPOV} as hit"),
        "q_markup_leftovers": V.duck(f"select page_id, {dirty.replace('{0}', 'markup')} as hit from leftovers"),
        "q_markup_filter": V.duck(f"select page_id from leftovers where not ({dirty.replace('{0}', 'markup')} or {dirty.replace('{0}', 'text')})"),
        # every repeat in that view but the last is over a limit, and no document is
        "q_problem_patterns": V.duck("select page_id, page_id % 6 in (1, 2, 3) as hit from repeats"),
        "q_outliers_twice": _twice_sql(),
        "q_bleu_filter_fa": V.duck(bleu + ", c as (select quantile_cont(bleu_score, 0.01) as cut from z) select page_id, rev_id from z, c where bleu_score > cut and bleu_score < 1"),
        "q_prompt_messages": e(f"""{k}, cast(to_json([{{'role': 'system', 'content': '{p.ASK}'}},
 {{'role': 'user', 'content': cast(to_json({{'title': page_title, 'section': section, 'text': 'x'}}) as varchar)}}]) as varchar) as messages"""),
        "q_up_to": V.duck("""with a as (select *, max(ts) over (partition by page_id order by rev_ord rows between unbounded preceding and 1 preceding) as m from revs),
b as (select page_id, max(rev_ord) as latest_ord from a where m is null or ts > m group by page_id)
select revs.page_id, rev_id from revs join b on b.page_id = revs.page_id where rev_ord <= latest_ord"""),
        "q_wiki_sections": V.duck(f"select page_id, {_sections('wiki_pages')}"),
        "q_reference_stop": V.duck(f"select page_id, {_sections('wiki_tails')}"),
        "q_duplicate_sections": V.duck("""select page_id, case when page_id % 3 = 0 then 'duplicate' when page_id % 3 = 1 then 'broken' end as error,
cast(null as varchar) as path, cast(null as int) as size, cast(null as varchar) as print from wiki_twins where page_id % 3 < 2
union all select page_id, null, unnest(['default__wiki__article__introduction__heading', 'One', 'One // Two', 'Three', 'Three // Two']), unnest([4, 1, 1, 1, 1]),
unnest([md5('lead'), md5('a'), md5('b'), md5('c'), md5('d')]) from wiki_twins where page_id % 3 = 2"""),
        "q_template_lookup": V.duck("""with a as (select page_id, text, replace(replace(replace(text, '{{flag|' || lang || '}}', 'Flag of ' || lang),
  '{{convert|' || (page_id % 4) || '|km}}', (page_id % 4) || ' kilometres'), '{{plus}}', '+') as result from templated)
select page_id, not contains(text, '{{broken}}') or contains(text, '{{flag') or contains(text, '{{convert') or contains(text, '{{plus}}') as changed,
case when not contains(text, '{{broken}}') then md5(result) end as result from a"""),
        "q_html_decode": f"select page_id, md5(replace(replace(replace(replace({_html}, '&quot;', chr(34)), '&middot;', chr(183)), '&copy;', chr(169)), '&amp;', '&')) as text from pages",
        "q_single_edit": V.duck("""with a as (select page_id % 900 as page_id, rev_id % 1000000 as rev_id, old_text, new_text from edits),
b as (select *, count(*) over (partition by page_id, rev_id) as n from a) select page_id, rev_id, old_text, new_text from b where n = 1"""),
        "q_merge_dedupe": V.duck(f"""with a as (select *, row_number() over (partition by source, old_text order by rev_id) as rn from whole_edits)
select {pair} from a where rn = 1 and len(regexp_extract_all(case when length(new_text) > length(old_text) then new_text else old_text end, '{_TOK}')) <= 1024"""),
        "q_length_filter": V.duck(f"""select {k} from whole_edits
where len(regexp_extract_all(case when length(new_text) > length(old_text) then new_text else old_text end, '{_TOK}')) <= 1024"""),
        "q_removal": e(k, f"not ({removal})"),
        "q_bleu": V.duck(bleu + "select page_id, rev_id, round(bleu_score, 6) as bleu_score from z"),
        "q_bleu_filter_npov": V.duck(bleu + "select page_id, rev_id from z where bleu_score > 0.15 and bleu_score < 1"),
        "q_quantile_profile": e(qs, _EMPTY),
        "q_word_tokens": f"select doc_id, md5(array_to_string(regexp_extract_all(text, '{_TOK}'), '|')) as tokens from documents",
        "q_token_counts": f"select doc_id, len(regexp_extract_all(text, '{_TOK}')) as n from documents",
        "q_line_split": r"select doc_id, md5(array_to_string(regexp_extract_all(text, '\n+|[^\n]+'), '|')) as pieces from documents",
        "q_text_normalise": V.duck(f"select page_id, {_COLL.format('markup')} as norm from wiki_pages"),
        "q_length_guard": "select doc_id, length(text) > 20000 as hit from documents",
        "q_namespace_filter": "select page_id from pages where not regexp_matches(concat(case when page_id % 5 = 0 then 'User talk:' else '' end, url), '(?i)^.*?(?:talk|user|wikipedia|template|help|file|draft|category):')",
        "q_title_semi_join": e(k, "page_title in (select page_title from edits where page_id % 2 = 0)"),
        "q_processed_anti_join": "select doc_id from documents where doc_id not in (select doc_id from labels)",
        "q_node_split": "select source, cast(ntile(7) over (order by source) - 1 as int) as node_id from (select distinct source from documents) d",
        "q_revert_flags": V.duck(f"""with s as (select *, min(rev_ord) over (partition by page_id, sha1, text_size) as first_ord from revs)
select {k}, first_ord, first_ord < rev_ord as is_revert from s"""),
        "q_revert_counts": V.duck("""with s as (select *, min(rev_ord) over (partition by page_id, sha1, text_size) as fo from revs)
select page_id, count(*) as revisions, count(*) filter (where fo < rev_ord) as reverts from s group by page_id"""),
        "q_revision_chain": V.duck(chain + " select c.page_id, rev_id, chain_pos, c.rev_ord, parent_ord from c join revs using (page_id, rev_ord)"),
        "q_chain_pairs": V.duck("""with recursive w(page_id, rev_ord, last, prev, cur, good) as (
 select page_id, rev_ord, text_size, cast(null as bigint), rev_id, true from revs where rev_ord = 1
 union all select r.page_id, r.rev_ord, case when r.text_size * 10 >= last then r.text_size else last end,
  case when r.text_size * 10 >= last then cur else prev end, case when r.text_size * 10 >= last then r.rev_id else cur end, r.text_size * 10 >= last
 from w join revs r on r.page_id = w.page_id and r.rev_ord = w.rev_ord + 1)
select page_id, cur as rev_id, prev as prev_rev_id from w where good and prev is not null"""),
        "q_latest_n": V.duck("""with a as (select *, max(ts) over (partition by page_id order by rev_ord rows between unbounded preceding and 1 preceding) as m from revs),
b as (select *, cast(row_number() over (partition by page_id order by rev_ord desc) as int) as recency from a where m is null or ts > m)
select page_id, rev_id, recency from b where recency <= 5"""),
        "q_npov_edits": V.duck(edits + " select page_id, rev_id, parent_rev_id from ed"),
        "q_npov_parent_join": V.duck(edits + " select page_id, rev_id, parent_rev_id from ed where new_size * 10 >= old_size"),
        "q_preference_split": e(f"{k}, case when row_number() over (order by md5(concat('42|', page_id, '|', rev_id))) <= 200 then 'test' else 'train' end as split"),
    }

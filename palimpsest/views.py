"""Edit-shaped views over the driver tables, in SQL that Spark and DuckDB both accept."""

EDIT_PAIRS = """
select doc_id + 1 as page_id, concat('Page ', source) as page_title, source,
       (doc_id * 100000 + i) * 10 + 2 as rev_id, (doc_id * 100000 + i) * 10 + 1 as prev_rev_id, lang as contributor, '2024-04-01' as timestamp,
       case (doc_id + i) % 8 when 0 then 'removed pov wording' when 1 then 'Reverted edits by user'
            when 2 then 'per WP:PEACOCK' when 3 then 'rm npov statement' when 4 then 'typo'
            when 5 then 'see WP:FRINGE' when 6 then 'rv vandalism' else '' end as comment,
       concat('Section ', cast(doc_id % 3 as string)) as section,
       old_text,
       case (doc_id + i) % 7 when 0 then old_text
            when 1 then replace(old_text, ' the ', ' a ')
            when 2 then substr(old_text, 1, 300)
            when 3 then concat(old_text, ' Added closing words for this revision.')
            when 4 then replace(old_text, 'on', 'xy')
            when 5 then substr(old_text, 60, 540)
            else concat(substr(old_text, 1, 200), substr(old_text, 260, 340)) end as new_text
from {text} d
"""
#: The edit distance is quadratic in the text, so an edit here is one line of a document; every line of every document is
#: one. WHOLE_EDITS take whole documents. LINES stands for the lines in either engine's words.
LINES = "{lines}"
EDITS = EDIT_PAIRS.replace("{text}", "{lines}")
SPARK_LINES = "(select doc_id, source, lang, posexplode(split(text, '\\n')) as (i, old_text) from documents)"
DUCK_LINES = """(select doc_id, source, lang, unnest(range(len(l))) as i, unnest(l) as old_text
from (select doc_id, source, lang, string_split(text, chr(10)) as l from documents) t)"""
WHOLE_EDITS = (
    EDIT_PAIRS.replace("{text}", "(select doc_id, source, lang, 0 as i, text as old_text from documents)")
    .replace("substr(old_text, 60, 540)", "substr(old_text, 60)")
    .replace("substr(old_text, 260, 340)", "substr(old_text, 260)")
)
REVS = """
select user_id as page_id, event_id as rev_id,
       cast(row_number() over (partition by user_id order by event_id) as int) as rev_ord,
       ts, event_type as sha1, cast(floor(value / 8) as int) as text_size,
       case event_id % 5 when 0 then 'neutralized bias' when 1 then 'undo last' when 2 then 'fix pov'
            when 3 then 'copyedit' else '' end as comment
from events
"""
CHAT_PAIRS = """
select * from (select conv_id as page_id, turn as rev_id, role as contributor,
         lag(text) over (partition by conv_id order by turn) as old_text, text as new_text
  from conversations) c where old_text is not null
"""
WIKI_PAGES = """
select doc_id as page_id, text,
       concat('{{Infobox x|name=', source, '}}', chr(10), text, chr(10), chr(10),
              '== History ==', chr(10), text, ' [[Target|label]]',
              case when doc_id % 3 = 0 then '<ref name="a">cite</ref>' else '' end, chr(10), chr(10),
              case when doc_id % 4 = 0 then concat('=== Notes ===', chr(10), 'n', chr(10), chr(10)) else '' end,
              '== References ==', chr(10), '{{reflist}}', chr(10)) as markup
from documents
"""
#: Pages whose section of references is followed by others, which do not count.
WIKI_TAILS = WIKI_PAGES.replace("'{{reflist}}', chr(10))", "'{{reflist}}', chr(10), '== History ==', chr(10), text, chr(10), '=== Legacy ===', chr(10), 'z', chr(10))")
#: Pages with two sections of one path, with a heading that an open template hides, or with neither.
WIKI_TWINS = """
select doc_id as page_id,
       concat('lead', chr(10), '== One ==', chr(10), 'a', chr(10), '=== Two ===', chr(10), 'b', chr(10),
              case doc_id % 3 when 0 then '== One ==' when 1 then concat('<div>', chr(10), '== Three ==', chr(10), '</div>') else '== Three ==' end, chr(10), 'c', chr(10),
              '=== Two ===', chr(10), 'd', chr(10)) as markup
from documents
"""
#: Each document, and with something at its end that counts as markup left over, or that just does not.
LEFTOVERS = """
select doc_id as page_id, text,
       concat(text, chr(10), case doc_id % 14 when 0 then ' {{' when 1 then ']] ' when 2 then '<ref' when 3 then '<p>' when 4 then '<p class' when 5 then '</td>'
              when 6 then '  | a = b' when 7 then '| a' when 8 then 'it Redirects Here.' when 9 then '<!-- x' when 10 then '<em>x</em>' when 11 then '</h6>'
              when 12 then '{ } [ ]' else '' end) as markup
from documents
"""
#: Documents with runs of signs after them: too many sentence marks, one sign or a few signs too often, or not quite.
REPEATS = """
select doc_id as page_id, concat(text, case doc_id % 6 when 1 then repeat('a? ', 1000) when 2 then repeat('z', 1002)
       when 3 then repeat('-=', 102) when 4 then repeat('a? ', 90) when 5 then repeat('z', 900) else '' end) as text
from documents
"""
TEMPLATED = """
select doc_id as page_id, lang, concat(text, ' {{flag|', lang, '}} and {{convert|', cast(doc_id % 4 as string), '|km}} or {{plus}}',
       case when doc_id % 5 = 0 then ' {{broken}}' else '' end) as text
from documents
"""
TEMPLATE_TABLE = """
select distinct concat('{{flag|', lang, '}}') as template, concat('Flag of ', lang) as rendered from documents
"""
VIEWS = {
    "edits": EDITS, "whole_edits": WHOLE_EDITS, "revs": REVS, "chat_pairs": CHAT_PAIRS, "wiki_pages": WIKI_PAGES, "wiki_tails": WIKI_TAILS,
    "wiki_twins": WIKI_TWINS, "leftovers": LEFTOVERS, "repeats": REPEATS, "templated": TEMPLATED, "template_table": TEMPLATE_TABLE,
}


def duck(sql: str) -> str:
    """Puts the views that the text names in front, as common table expressions."""
    used = [k for k in VIEWS if f"from {k}" in sql or f"join {k}" in sql]
    ctes = ", ".join(f"{k} as ({VIEWS[k].replace('as string', 'as varchar').replace(LINES, DUCK_LINES)})" for k in used)
    if not ctes:
        return sql
    if sql.lstrip().startswith("with recursive"):
        return f"with recursive {ctes}, " + sql.lstrip()[len("with recursive"):]
    return f"with {ctes}, " + sql.lstrip()[4:] if sql.lstrip().startswith("with ") else f"with {ctes} {sql}"

import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import diffs as D
from palimpsest.functions import wikitext as W
from palimpsest.functions.sentences import ONE_SENTENCE, section_sentences
from palimpsest.operators import preference as p
from palimpsest.operators import sections as s
from palimpsest.operators import sinks
from palimpsest.operators import templates as t
from palimpsest.plans import create, fa, npov
from palimpsest.sources import history, lists

LEAD = W.LEAD


@pytest.mark.parametrize(
    ("markup", "want"),
    [
        ("<!-- a -->\nText<!-- b --> on.", "Text on."),
        ("{{Infobox x\n|a=[[b]]\n|c={{d}}}}\n\n'''Bold''' and ''slanted''.", 'Bold and "slanted".'),
        ("A [[Target page|label]] and [[plain]] [http://a.b/c shown] &amp; &nbsp;x", "A label and plain shown &  x"),
        ("One[[File:x.png|thumb|a [[b]] c]] two. [[Category:Z]]", "One two."),
        ("A<ref name='x'>b</ref> c<ref name=y/> d.", "A c d."),
        ("a\n{| class='x'\n| b {{c}}\n|}\nd", "a\n\nd"),
        ("* one\n* two\n:three", "* one\n* two\n three"),
        ("Sum <math display='block'>a^2</math> ok", "Sum <math>a^2</math> ok"),
        ("Long{{ndash}}dash {{convert|5|km}} of {{cite web|x}}it", "Long - dash {{convert|5|km}} of it"),
        ("Text.\n\n{{Quote box|x}}\n\nMore {{lang|fr|mot}} here.", "Text.\n\nMore {{lang|fr|mot}} here."),
        ("Text.\n\n{{lonely|x}}\n{{other}}\n\nMore.", "Text.\n\nMore."),
        ("''{{lang|fr|mot}}'' stays", '"{{lang|fr|mot}}" stays'),
        ("<div>in <b>a</b> {{lost}}div</div><br>x", "in a divx"),
        ("<nowiki>[[a]]</nowiki> {{ open", "[[a]] {{ open"),
        ("", ""),
    ],
)
def test_markup_of_a_lead(markup, want):
    assert W.sections(markup) == [(LEAD, want)]


def test_section_paths():
    text = "lead\n==A==\na\n===B===\nb\n=====C=====\nc\n==D {{x}}==\n== Notes ==\nn\n===E===\ne\n= F ==\nf\n==References==\n==G==\ng"
    got = dict(W.sections(text))
    assert list(got) == [LEAD, "A", "A // B", "A // B //  // C", "D", "Notes // E", "F ="] and got["D"] == ""
    assert W.Paths().next(2, "x") == "x"
    with pytest.raises(W.MarkupError, match="duplicate"):
        W.sections("==A==\n==A==\n")
    assert len(dict(W.sections("==A==\n===B===\n==C==\n===B===\n"))) == 5
    with pytest.raises(W.MarkupError, match="broken"):
        W.sections("<div>\n==A==\n</div>")
    assert W.sections("<div>\n==A==\n</div>x", lenient=True)
    assert "".join(n.source for n in W.parse(text)) == text


def test_tables_of_templates_go():
    text = "a\n\n{{Nat fs start}}\n{{player|1}}\n{{nat fs end}}\nb\n\n{{nat fs g start}}\n{{player|2}}\n\n==X==\nc"
    assert dict(W.sections(text)) == {LEAD: "a\n\nb", "X": "c"}


@pytest.mark.parametrize("name", ONE_SENTENCE)
def test_each_one_sentence_template(name):
    unit = "{{" + name + "|One. Two. {{x|y}}}}"
    assert section_sentences(f"Aa bb. {unit}  Cc dd.") == ["Aa bb.", unit, "Cc dd."]
    assert section_sentences("Aa {{quotation|One. Two.}}")[0].startswith("Aa {{quotation|One.")
    assert section_sentences("open {{quote] cc") == ["open {{quote] cc"]


def rows(*items, save_all=False, keep=None):
    """Items: text, or (old, new), or (old, new, False) for a change that is not retained."""
    lost = {x[:2] for x in items if not isinstance(x, str) and len(x) == 3}
    hunk = [x if isinstance(x, str) else x[:2] for x in items]
    return D.pair_rows([hunk], lambda o, n: (o, n) not in lost, save_all)


@pytest.mark.parametrize(
    ("items", "save_all", "want"),
    [
        (["text", "\n\n"], False, []),
        (["text", ("old", "new", False)], False, []),
        (["a ", ("old", "new")], False, [("a old", "a new")]),
        (["a ", ("old", "new"), " b"], False, [("a old", "a new")]),
        (["a ", ("x", "y"), " b ", ("z", "w")], False, [("a x b z", "a y b w")]),
        (["a ", ("x", "y"), "\n\n", "b ", ("z", "w")], False, [("a x", "a y"), ("b z", "b w")]),
        (["a ", ("x", "y"), " c\n\nd ", ("z", "w")], False, [("a x", "a y"), ("d z", "d w")]),
        (["a ", (None, "new"), " c\n\nd"], False, [("a  c", "a new c")]),
        (["text ", ("old\n\nmore", "new")], False, [("text old", "text new")]),
        (["text text ", ("old\n\n", None)], True, [("text text old", "text text")]),
        (["text ", ("old\n\n", None)], False, []),
        (["text ", ("old" * 10, None)], True, []),
        ([("x", "y"), ("z", "w", False), "a ", ("u", "v")], False, [("x", "y"), ("a u", "a v")]),
        ([("x", "y"), ("z", "w", False)], True, [("xz", "yw")]),
        ([(None, "only new")], False, []),
        (['a ', ("x", "y"), ' b\n\n"quoted"'], False, [("a x", "a y")]),
    ],
)
def test_merging_of_changes(items, save_all, want):
    assert rows(*items, save_all=save_all) == want


def test_paragraph_ends():
    assert D.paragraph_ends("a\n\nb") == ("a", "b") and D.paragraph_ends('a\n\n"b"') == ('a\n\n"b"', "")
    assert D.paragraph_ends("a\n\nb\n\nc") == ("a", "c") and D.paragraph_ends("a\n\n'b\n\nc") == ("a'b", "c")


def test_hunks_join_sentences():
    assert D.hunks(["a.", "b.", "c."], ["a.", "x.", " y.", "c."]) == [["a.", ("b.", "x. y."), "c."]]
    assert D.hunks(["a."], ["a.", "b."]) == [["a.", (None, "b.")]]
    assert D.hunks(["-- gone", "b"], ["b"]) == [["b"]] and D.hunks(["a"], ["a"]) == []
    far = [str(i) for i in range(30)]
    assert len(D.hunks(far, ["x", *far[1:-1], "y"], 3)) == 2
    assert D.review_html("a<b", "a&b") == "a<del>&lt;</del><ins>&amp;</ins>b"


def page(title, ident, revisions):
    out = f"<page><title>{title}</title><ns>0</ns><id>{ident}</id>"
    for r in revisions:
        parent = f"<parentid>{r['parent']}</parentid>" if "parent" in r else ""
        who = f"<username>{r['user']}</username><id>77</id>" if "user" in r else "<ip>1.2.3.4</ip>"
        comment = f"<comment>{r['comment']}</comment>" if "comment" in r else ""
        size = r.get("size", len(r["text"]))
        out += (
            f"<revision><id>{r['id']}</id>{parent}<timestamp>2024-01-01T00:00:{r['id'] % 60:02d}Z</timestamp><contributor>{who}</contributor>"
            f"{'<minor/>' if r.get('minor') else ''}{comment}<model>wikitext</model><text bytes=\"{size}\">{r['text']}</text><sha1>{r.get('sha', r['id'])}</sha1></revision>"
        )
    return out + "</page>"


ONE = "The first sentence stands here for good. The second one is rather plain. A third one ends it all."
TWO = ONE.replace("rather plain", "now much better than it was before")
HISTORY = [
    {"id": 1, "text": ONE, "user": "Ann", "sha": "a"},
    {"id": 2, "parent": 1, "text": "junk &lt;b&gt;", "size": 3, "comment": "vandal", "sha": "v"},
    {"id": 3, "parent": 2, "text": ONE, "comment": "Reverted", "sha": "a"},
    {"id": 4, "parent": 3, "text": TWO, "comment": "fix npov issue", "user": "Bo", "minor": True, "sha": "b"},
    {"id": 5, "parent": 4, "text": TWO + " One more closing sentence comes now.", "sha": "c"},
]


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dump")
    xml = f"<mediawiki><siteinfo><x/></siteinfo>{page('A &amp; B', 7, HISTORY)}{page('Talk:C', 8, HISTORY[:2])}</mediawiki>"
    (folder / "a.xml").write_text(xml)
    (folder / "b.xml.gz").write_bytes(gzip.compress(page("Zip", 9, HISTORY).encode()))
    (folder / "c.xml.bz2").write_bytes(bz2.compress(page("Bz", 10, HISTORY[:1]).encode()))
    return folder


def test_history_source(spark, dump):
    got = history.read_history(spark, str(dump)).orderBy("page_id", "rev_ord").collect()
    assert [(x.page_id, x.rev_id) for x in got] == [*((7, i) for i in range(1, 6)), (8, 1), (8, 2), *((9, i) for i in range(1, 6)), (10, 1)]
    first, second = got[0], got[1]
    assert (first.page_title, first.page_ns, first.parent_id, first.contributor, first.text) == ("A & B", 0, None, "Ann", ONE)
    assert (second.contributor, second.text, second.text_size, second.comment, second.is_minor) == ("1.2.3.4", "junk <b>", 3, "vandal", False)
    assert got[3].is_minor and {x.error for x in got} == {None} and str(first.ts) == "2024-01-01 00:00:01"
    assert history.read_history(spark, str(dump / "a.xml"), with_text=False).filter("text is not null").count() == 0


def test_history_source_across_splits(spark, tmp_path):
    pages = [page(f"P{i}", i, [{"id": 100 * i + k, "text": f"text {k} " * 40} for k in range(9)]) for i in range(30)]
    (tmp_path / "x.xml").write_text("<mediawiki>" + "".join(pages) + "</mediawiki>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = history.read_history(spark, str(tmp_path / "x.xml")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({x.rev_ord for x in got}) == 270
    order = [(x.page_id, x.page_title, x.rev_id) for x in sorted(got, key=lambda x: x.rev_ord)]
    assert order == [(i, f"P{i}", 100 * i + k) for i in range(30) for k in range(9)]
    assert history.revision_of("<id>1</id><broken")["error"].startswith("xml")


def test_plans_end_to_end(spark, dump, tmp_path):
    revs = history.read_history(spark, str(dump)).filter("error is null").drop("error").checkpoint()
    listed = fa.extract(revs, spark.createDataFrame([("A & B",), ("None",)], "page_title string"))
    kept = fa.retained_diffs(listed).collect()
    assert [(x.rev_id, x.prev_rev_id) for x in kept] == [(4, 1)] and kept[0].section == LEAD
    assert "rather plain" in kept[0].old_text and "much better" in kept[0].new_text and "A third" not in kept[0].new_text
    edits = npov.find_edits(revs)
    assert {(x.page_id, x.rev_id, x.parent_rev_id) for x in edits.collect()} == {(7, 4, 1), (9, 4, 1)}  # no talk page
    diffs = npov.diffs(revs, edits)
    assert {(x.page_id, x.rev_id) for x in diffs.collect()} == {(7, 4), (9, 4)}
    sinks.write_edits(edits, f"{tmp_path}/edits")
    again = lists.edits(spark, f"{tmp_path}/edits")
    assert {tuple(x) for x in again.collect()} == {tuple(x) for x in edits.collect()}
    rows = diffs.withColumns({"source": F.lit("f"), "row_ord": F.col("page_id")}).checkpoint()
    made = create.build(rows, "npov", f"{tmp_path}/out", test_size=1)
    assert made.count() == 1 and made.first().split == "test"  # both pages have the same old text: the first stays
    assert made.first().prompt.startswith("Write something about ") and made.first().chosen[1].role == "assistant"
    line = next(x for f in (tmp_path / "out" / "test").iterdir() if f.suffix == ".json" for x in f.read_text().splitlines())
    assert json.loads(line)["rev_id"] == 4
    assert create.build(rows.limit(0), "npov", f"{tmp_path}/out").count() == 1  # all stages are there already
    sinks.write_pages(revs, f"{tmp_path}/pages", 4)
    assert spark.read.parquet(f"{tmp_path}/pages").filter("page_file = 'Talk_C'").count() == 2
    bad = spark.createDataFrame([(1, None), (2, "xml")], "a int, error string")
    sinks.write_checked(bad, f"{tmp_path}/good", f"{tmp_path}/bad")
    assert (spark.read.parquet(f"{tmp_path}/good").count(), spark.read.parquet(f"{tmp_path}/bad").first().error) == (1, "xml")


def test_broken_newest_revision(spark):
    texts = ["== A ==\nx", "== A ==\ny", "<div>\n== A ==\n</div>"]
    df = spark.createDataFrame([(1, k, f"2024-01-0{k + 1}", m) for k, m in enumerate(texts)] + [(2, 0, "2024-01-01", texts[2])],
                               "page_id int, rev_ord int, ts string, text string")
    got = {x.page_id: x for x in s.newest_sections(df).collect()}
    assert got[1].latest_ord == 1 and {a.path: a.text for a in got[1].latest}["A"] == "y"
    assert got[2].latest_ord == 0 and got[2].latest  # read leniently
    odd = spark.createDataFrame([(None,), ("a" * 2000,)], "text string")
    assert [x.error for x in s.with_sections(odd).collect()] == [None, "unsplittable"]
    assert s.with_sections(odd.limit(0)).count() == 0


def test_lists(spark, tmp_path):
    html = ('<span class="featured_article_metadata has_been_on_main_page"><i><a href="/wiki/A_%26_B" title="x">A &amp; <b>B</b></a></i></span>'
            '<span class="other"><a href="/wiki/No">No</a></span>')  # fmt: skip
    got = lists.featured_titles(spark.createDataFrame([(html,), (None,)], "html string")).collect()
    assert [tuple(x) for x in got] == [("A & B", "A_%26_B")]
    files = {"enwiki-stub-meta-history2.xml.gz": {"url": "/2"}, "enwiki-stub-meta-history1.xml.gz": {"url": "/1"}, "enwiki-stub-meta-history.xml.gz": {"url": "/all"}}
    status = {"jobs": {"xmlstubsdump": {"files": files}, "metahistorybz2dump": {"files": {"h.bz2": {"url": "/h", "size": 3}}}}}
    (tmp_path / "status.json").write_text(json.dumps(status, indent=1))
    assert [x.url for x in lists.stub_archives(spark, f"{tmp_path}/status.json").collect()] == ["/1", "/2"]
    assert [tuple(x) for x in lists.history_archives(spark, f"{tmp_path}/status.json").collect()] == [("h.bz2", "/h")]
    (tmp_path / "titles.csv").write_text('title,slug\n"A, B",x\nC,y\n')
    assert {x.page_title for x in lists.titles(spark, f"{tmp_path}/titles.csv").collect()} == {"A, B", "C"}
    (tmp_path / "d.csv").write_text('page_title,page_id,rev_id,prev_rev_id,timestamp,contributor,comment,section,old_text,new_text\nA,1,2,1,t,u,,s,NA,"x\n""y"""\n')
    (tmp_path / "d.csv.ERROR").write_text("x")
    got = lists.diffs(spark, str(tmp_path)).filter("page_id = 1").first()
    assert (got.comment, got.old_text, got.new_text) == ("", "NA", 'x\n"y"')
    assert {x.path.rsplit("/")[-1] for x in lists.diff_files(spark, str(tmp_path)).collect()} == {"titles.csv", "d.csv"}
    (tmp_path / "s.xml").write_text("x"), (tmp_path / "l.xml").write_text("xxx")
    assert [x.size for x in lists.history_files(spark, str(tmp_path)).collect()] == [3, 1]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<span class="nowrap">5&nbsp;km</span> <sup>[1]</sup>&lt;', "5 km <"),
        ('a<style data-mw-deduplicate="TemplateStyles:r1">.b{}</style>c', "ac"),
        ('<div class="thumb">x</div>', None),
        ('<strong class="error">x</strong>', None),
        ('<a href="/x" class="new" title="Template:X">y</a>', None),
        (None, None),
    ],
)
def test_html_decode(spark, html, want):
    assert spark.createDataFrame([(html,)], "h string").select(t.decode_html(F.col("h"))).first()[0] == want


def test_templates_are_replaced(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a {{x|1}} b", "a {{x|2}} b"), (2, "plain", "{{x|1}}{{x|1}}"), (3, "{{bad}}", "z"), (4, "{{x|1}}", "one"), (5, None, "q {{new|{{x|1}}}}")],
        "k int, old_text string, new_text string",
    )
    known = spark.createDataFrame([("{{x|1}}", "one"), ("{{x|2}}", "two"), ("{{empty}}", "")], "template string, rendered string")
    invalid = spark.createDataFrame([("{{bad}}",)], "template string")
    asked = []
    page = lambda x: f"<p>{t.MARK_START}<b>N</b>&amp;{t.MARK_END}</p>" if x.startswith("{{new") else None
    out, found = t.render_rows(df, known, invalid, page)
    got = {x.k: (x.old_text, x.new_text) for x in out.collect()}
    assert got == {1: ("a one b", "a two b"), 2: ("plain", "oneone"), 5: (None, "q N&")}  # 3 failed, 4 became equal
    now, bad = t.grown(known, invalid, found)
    assert {x.template for x in now.collect()} == {"{{x|1}}", "{{x|2}}", "{{empty}}", "{{new|{{x|1}}}}"} and bad.count() == 1
    assert {x.k for x in t.render_rows(df, known, invalid)[0].collect()} == {1, 2}  # nobody to ask
    states = iter([(429, None), (429, None), (200, {"parse": {"text": {"*": "ok"}}})])
    remote = t.Remote(lambda params: asked.append(params["text"]) or next(states), wait=lambda s: asked.append(s))
    assert remote("{{a}}") == "ok" and [x for x in asked if isinstance(x, int)] == [1, 2]
    assert t.Remote(lambda p: (500, None))("{{a}}") is None and t.Remote(lambda p: (429, None), wait=lambda s: None)("{{a}}") is None
    assert t.Remote(lambda p: 1 / 0)("x" * t.LONGEST) is None


def test_prompts_are_asked_once_and_must_come(spark, tmp_path):
    df = spark.createDataFrame([("T", "s", i, i, "o", f"n{i}") for i in range(6)], "page_title string, section string, page_id int, rev_id int, old_text string, new_text string")
    log = str(tmp_path / "asked")

    def client(messages):
        with open(log, "a") as f:
            f.writelines("x\n" for _ in messages)
        return [f"Instruction: do {json.loads(json.loads(m)[1]['content'])['text']}" for m in messages]

    got = p.prompted(df, client, str(tmp_path / "prompts")).collect()
    assert {x.prompt for x in got} == {f"do n{i}" for i in range(6)}
    again = p.prompted(df, client, str(tmp_path / "prompts"))
    assert again.count() == 6 and len(open(log).readlines()) == 6
    with pytest.raises(ValueError, match="6 rows"):
        p.prompted(df, lambda m: [""] * len(m), str(tmp_path / "none"), tries=2)


def test_split_and_sample(spark):
    df = spark.createDataFrame([(i % 10, i, "ab", "ac") for i in range(50)], "k int, v int, old_text string, new_text string")
    for n in (0, 7, 13, 50, 99):
        out = p.split(df, ["k"], n)
        assert out.filter("split = 'test'").count() == min(n, 50) and out.columns == [*df.columns, "split"]
    got = p.review_sample(df, 5).collect()
    assert len(got) == 5 and got[0].review == "a<del>b</del><ins>c</ins>"


def test_reverts_of_a_stream(spark, tmp_path):
    from palimpsest.streaming.reverts import revert_stream

    rows = [(1, 10, 1, "a", 5), (1, 11, 2, "b", 5), (1, 12, 3, "a", 5), (2, 20, 1, "a", 5), (1, 13, 4, "b", 6), (1, 14, 5, "b", 5)]
    schema = "page_id bigint, rev_id bigint, rev_ord bigint, sha1 string, text_size int"
    for k, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = revert_stream(stream).writeStream.format("memory").queryName("reverts").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {x.rev_id: (x.first_ord, x.is_revert) for x in spark.table("reverts").collect()}
    assert got == {10: (1, False), 11: (2, False), 12: (1, True), 20: (1, False), 13: (4, False), 14: (2, True)}


def test_whole_texts_do_not_meet_by_their_templates(spark):
    texts = spark.createDataFrame([("x {{plus}} {{plus}}",), ("y {{plus}}",), ("plain",), ("z {{gone}} {{plus}}",), (None,)], "text string")
    found = spark.createDataFrame([("{{plus}}", "+"), ("{{gone}}", None)], "template string, rendered string")
    out = t.rendered(texts, found)
    got = {x.text: (x.changed, x.result) for x in out.collect()}
    assert got == {"x {{plus}} {{plus}}": (True, "x + +"), "y {{plus}}": (True, "y +"), "plain": (False, "plain"), "z {{gone}} {{plus}}": (True, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    grouped = [x for x in plan.splitlines() if "Aggregate [" in x]
    assert grouped and not any("text#" in x.split("],")[0] for x in grouped)


def test_a_batch_of_pages_is_read_in_slices(spark):
    texts = [(i, None if i % 7 == 0 else f"lead {i}\n== A ==\nx {i}. y.") for i in range(150)]
    df = spark.createDataFrame(texts, "i int, text string").coalesce(1)
    size = s._by_slices(lambda x: len(x or ""), s.pa.int64(), "bigint", rows=4)
    assert {x.i: x.n for x in df.select("i", size("text").alias("n")).collect()} == {i: len(x or "") for i, x in texts}
    got = {x.i: [tuple(y) for y in x.sections] for x in s.with_sections(df).select("i", "sections").collect()}
    assert got == {i: W.sections(x or "") for i, x in texts}

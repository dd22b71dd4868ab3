import math
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import bleu as bleu_of
from palimpsest.functions import diffs as D
from palimpsest.functions import distance
from palimpsest.functions import text as X
from palimpsest.functions.bleu import bleu
from palimpsest.functions.comments import is_fa_edit, is_npov_edit
from palimpsest.functions.sentences import rejoin_math, rule_sentences, section_sentences, split_templates
from palimpsest.operators import filters as f
from palimpsest.operators import preference as p
from palimpsest.operators import revisions as r


def test_bleu_of_equal_and_foreign_texts():
    a = "the cat sat on the mat".split()
    assert math.isclose(bleu(a, a), 1.0)
    assert bleu(a, ["dog"]) == 0.0
    assert 0 < bleu(a, "the dog ran".split()) < 1e-50  # no shared pair of words


def test_bleu_against_plain_counts():
    def plain(a, b):
        logs = 0.0
        for n in range(1, 5):
            have, most = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (b, a))
            hit = sum((have & most).values())
            if n == 1 and not hit:
                return 0.0
            logs += math.log(hit / sum(have.values()) if hit else sys.float_info.min) / 4
        return (1.0 if len(b) > len(a) else math.exp(1 - len(a) / len(b)) if b else 0.0) * math.exp(logs)

    rng = random.Random(3)
    for _ in range(3000):
        a = rng.choices("abcd", k=rng.randint(0, 14))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 3)] = rng.choices("abcd", k=rng.randint(0, 3))
        assert bleu(a, b) == plain(a, b)


def test_bleu_skips_equal_ends(monkeypatch):
    """An edit within a long text costs its own n-grams, not the text's."""
    seen = []
    monkeypatch.setattr(bleu_of, "_missing", lambda a, b, n, f=bleu_of._missing: seen.append(len(a) + len(b)) or f(a, b, n))
    words = [str(i % 97) for i in range(50_000)]
    assert 0.99 < bleu(words, [*words[:20_000], "new", *words[20_000:]]) < 1 and max(seen) < 20


@pytest.mark.parametrize(
    ("comment", "npov", "fa"),
    [("fix npov issue", True, False), ("rv npov", False, False), ("reverted pov", False, False),
     ("per WP:PEACOCK", False, True), ("", False, False), (None, False, False), ("poverty figures", False, False)],
)
def test_comments(spark, comment, npov, fa):
    df = spark.createDataFrame([(comment,)], "c string").select(is_npov_edit(F.col("c")), is_fa_edit(F.col("c")))
    assert tuple(df.first()) == (npov, fa)


def test_sentences_keep_every_sign():
    text = "Mr. Smith went home. He slept!  Was it late? Yes."
    got = rule_sentences(text)
    assert got == ["Mr. Smith went home.", "He slept!", "Was it late?", "Yes."]
    assert "".join("".join(got).split()) == "".join(text.split())
    assert split_templates("a {{quote|b}} c {{x}}") == [(False, "a "), (True, "{{quote|b}}"), (False, "c {{x}}")]
    assert rejoin_math(["<math>a", "b</math>", "c"]) == ["<math>a b</math>", "c"]
    assert section_sentences("* One. Two.\n\nThree.") == ["* One.Two.", "\n\n", "Three."]


def test_a_line_without_braces_is_not_read_sign_by_sign():
    class Line(str):
        def __getitem__(self, k):
            asked.append(k)
            return str.__getitem__(self, k)

    asked = []
    line = Line("One word. " * 1000)
    assert split_templates(line) == [(False, str(line))] and len(asked) < 5
    assert split_templates("{{a {{quote|b}} }}  {{bq|c}}  d }} {{") == [(False, "{{a {{quote|b}} }}  "), (True, "{{bq|c}}"), (False, "d }} {{")]


def test_diff_rows_of_a_changed_sentence():
    old, new = ["A one.", "B two.", "C three."], ["A one.", "B 2.", "C three."]
    got = D.hunks(old, new)
    assert got == [["A one.", ("B two.", "B 2."), "C three."]]
    assert D.pair_rows(got, save_all=True) == [("A one.B two.", "A one.B 2.")]
    assert D.pair_rows(got, keep=lambda o, n: False) == []
    assert not D.is_retained("x", "ends b", "b") and D.is_retained("a  b c".replace("  ", " "), "z", "b c")


def test_distance_of_long_edited_texts_needs_no_table(monkeypatch):
    """The table of two texts of 100,000 signs takes seconds; lines and documents have it only where the bounds differ."""
    rng = random.Random(1)
    words = ["the", "on", "station", "a", "wherever", "xylophone", "tin", "of"]
    text = " ".join(rng.choice(words) for _ in range(20_000))
    cut = text[:200] + text[259:]
    tables = []
    monkeypatch.setattr(distance, "_columns", lambda a, b: tables.append((a, b)))
    on = text.count("on")
    pairs = [(text, text, 0), (text, text[:300], len(text) - 300), (text, text[59:], 59), (text, cut, 59), (text, text + " More.", 6),
             (text, text.replace("on", "é!"), 2 * on)]
    assert [distance.distance(a, b) for a, b, _ in pairs] == [d for _, _, d in pairs]
    assert [distance.distance(b, a) for a, b, _ in pairs] == [d for _, _, d in pairs] and not tables


def test_distance_against_the_table():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(2)
    for _ in range(3000):
        signs = rng.choice(["ab", "abc ", "abcdefgh é\n"])
        a = "".join(rng.choices(signs, k=rng.randint(0, 50)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 3)] = rng.choices(signs, k=rng.randint(0, 3))
        b = "".join(b)
        assert distance.distance(a, b) == plain(a, b)
        if a and b:
            most = max(len(a), len(b))
            assert distance._diagonals(a, b, most) == plain(a, b) == distance._columns(*sorted((a, b), key=len, reverse=True))


def test_only_runs_are_problem_patterns(spark):
    runs = ["!?." * 334, "z" * 1001, "-=" * 101, "é" * 1001, "a? " * 1000]
    none = ["AT!! WITH!! THE!! " * 300, "One. Two! " * 600, "?!." * 33, " " * 500, "\n" * 1200, ". a" * 1200, "z" * 1000, "a? " * 999, ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*runs, *none, None])], "i int, t string")
    got = [x.hit for x in df.orderBy("i").select(X.has_problem_pattern(F.col("t")).alias("hit")).collect()]
    assert got == [True] * len(runs) + [False] * len(none) + [None]
    shouts = spark.createDataFrame([(1, 2, "AT!! WITH!! " * 600, "AT!! WITH!! " * 600)], "page_id int, rev_id int, old_text string, new_text string")
    assert f.with_bleu(shouts).first().bleu_score == 1 and f.drop_removals(shouts).count() == 1


def test_white_space_shortcuts_agree_with_the_plain_forms(spark):
    rng = random.Random(5)
    signs = ["a", "é", " ", "\n", "\t", "\xa0", "\u2009", "\x1c", "\x85", "\u3000", "\u200b", "\r"]
    rows = [("".join(rng.choices(signs, weights=[4, 2, 4] + [1] * 9, k=rng.randint(0, 24))),) for _ in range(3000)] + [(None,)]
    df, c = spark.createDataFrame(rows, "t string"), F.col("t")
    same = [F.trim(F.regexp_replace(c, r"(?U)\s+", " ")).eqNullSafe(X.collapse_ws(c)), (X.strip_ws(c) != "").eqNullSafe(X.has_text(c))]
    same += [(X.spaced_words(c) >= n).eqNullSafe(X.has_spaced_words(c, n)) for n in (1, 2, 5)]
    assert df.select(*(F.count_if(~x) for x in same)).first() == (0,) * 5


def test_revert_leaves_the_chain(spark):
    rows = [(1, 10, 1, "a", 100), (1, 11, 2, "b", 100), (1, 12, 3, "a", 100), (1, 13, 4, "c", 100)]
    df = spark.createDataFrame(rows, "page_id int, rev_id int, rev_ord int, sha1 string, text_size int")
    assert sorted(x.rev_id for x in r.surviving_chain(df).collect()) == [10, 13]
    assert tuple(r.revert_counts(df).first()) == (1, 4, 1)
    tiny = spark.createDataFrame([(1, 1, 1, "a", 100), (1, 2, 2, "b", 5), (1, 3, 3, "c", 90)], df.schema)
    assert [(x.rev_id, x.prev_rev_id) for x in r.consecutive_pairs(tiny).collect()] == [(3, 1)]


def test_filters_on_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, 1, "a b", " "), (1, 2, None, "x"), (2, 3, "one two three four five", "six two three four five")],
                               "page_id int, rev_id int, old_text string, new_text string")
    assert [x.rev_id for x in f.drop_empty(df).collect()] == [3]
    assert [x.rev_id for x in f.drop_short(df).collect()] == [3]
    assert f.keep_single_edits(df.unionByName(df)).count() == 0
    assert f.drop_empty(df.limit(0)).count() == 0


def test_split_has_the_asked_size(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    assert p.split(df, ["k"], 7).filter("split = 'test'").count() == 7


def test_every_query_has_rows(spark):
    from palimpsest.queries import NAMES, _built, oracle_sql, queries

    assert NAMES == list(_built())
    assert set(oracle_sql()) <= set(queries())
    got = queries()["q_revision_chain"](spark, "/root/testdata/sf0.001")
    assert got.count() > 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_is_exact(spark):
    import random

    rng = random.Random(3)
    rows = [("", ""), ("ab", ""), (None, "a"), ("é" * 9, "é" * 4 + "ß"), ("na\nïve", "ive")]
    for _ in range(300):
        a = "".join(rng.choice("abé\n") for _ in range(rng.randint(0, 30)))
        rows += [(a, "".join(c if rng.random() < 0.8 else rng.choice("aß") for c in a)), (a, a[::-1]), (a, a[3:] + "aé")]
    got = f.with_edit_distance(spark.createDataFrame(rows, "old_text string, new_text string")).collect()
    assert len(got) == len(rows)
    assert all(x.edit_distance == (None if x.old_text is None else _distance(x.old_text, x.new_text)) for x in got)


def test_whole_edits_reach_the_queries(spark, tmp_path):
    from palimpsest.queries import WHOLE, queries

    texts = ["\n\n".join(f"Part {i} of text {d} sits on the shelf. The on and on line {i} ends.\nIt has one more." for i in range(9 + d))
             for d in range(14)]
    rows = [(d, t, "en", "s", len(t)) for d, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    new = [
        (t, t.replace(" the ", " a "), t[:300], t + " Added closing words for this revision.", t.replace("on", "xy"), t[59:], t[:200] + t[259:])[d % 7]
        for d, t in enumerate(texts)
    ]
    q = {n[8:]: fn(spark, str(tmp_path)).collect() for n, fn in queries().items() if n.startswith("q_whole_")}
    assert len(q) == len(WHOLE)
    at = lambda x: x.page_id - 1
    assert min(map(len, texts)) > 600 and {(at(x), x.old_text, x.new_text) for x in q["empty_text"]} == {(d, t, new[d]) for d, t in enumerate(texts)}
    assert {at(x) for x in q["same_text"]} == {d for d in range(14) if d % 7}
    assert {at(x): x.edit_distance for x in q["edit_distance"]} == {d: _distance(t, new[d]) for d, t in enumerate(texts)}
    far = {d: _distance(t, new[d]) for d, t in enumerate(texts) if t not in new[d] and new[d] not in t}
    assert {at(x): x.edit_distance for x in q["outliers_npov"]} == {d: k for d, k in far.items() if k > 4 and k / len(texts[d]) > 0.1}
    words = [(f_old.split(), f_new.split()) for f_old, f_new in zip(texts, new, strict=True)]
    assert {at(x) for x in q["removal"]} == {d for d, (a, b) in enumerate(words) if len(b) > 0.8 * len(a)}
    assert {at(x) for x in q["bleu"] if x.bleu_score == 1} == {d for d in range(14) if d % 7 in (0,)}
    assert all("\n\n" not in x.old_text for x in q["diff_rows"])  # rows end at paragraph breaks
    assert any("\n" in x.old_text for x in q["diff_rows"]) and q["retained_diffs"]

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import (
    exact_dedup,
    langid,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    sharding,
    tool_calls,
    url_filter,
)
from palimpsest.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
rng = random.Random(5)
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def text(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, long, repeated and equal rows, and columns whose names clash with inner ones."""
    long = text(30_000)
    rows = [(1, None, "a"), (2, "", None), (3, " \n\t", "a"), (4, long, "b"), (5, long, "b"), (5, long, "b"),
            (None, "x y z", "a"), (7, "x  y z", ""), (8, "Wörter größer", "b")]
    return docs_of(spark, rows).withColumn("size", F.lit("q")).withColumn("shard", F.lit(1)).withColumn("h", F.lit(2))


def test_sharding(spark, odd):
    got = sharding.shard_documents(odd).collect()
    assert len(got) == 9 and all(g.grown_shard in (g.shard, 40) for g in got)
    for s, slots in {g.shard: sorted(x.slot for x in got if x.shard == g.shard) for g in got}.items():
        assert slots == list(range(len(slots))), s
    assert {g.doc_id: g.text_crc32 for g in got}[8] == zlib.crc32("Wörter größer".encode())
    assert sharding.shard_documents(odd.limit(0)).count() == 0


def test_exact_groups(spark, odd):
    got = {(g.doc_id, g.kept): g for g in exact_dedup.exact_groups(odd).collect()}
    assert got[(1, False)].keep_id == 3 and got[(3, True)].group_size == 3
    assert sum(k for _, k in got) == 4 and got[(7, True)].keep_id == 7
    assert exact_dedup.exact_groups(odd.limit(0)).count() == 0


def test_tool_calls(spark):
    import json

    call = json.dumps({"tool_calls": [{"id": "b", "name": "f", "arguments": {"z": 1, "a": "x"}, "depends_on": ["a"]},
                                      {"id": "a", "name": "f", "arguments": {"a": 3}}]})
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", call), (1, 2, "tool", '{"tool_call_id":"a","content":"r"}'),
            (1, 3, "tool", '{"tool_call_id":"q","content":"r"}'), (1, 4, "user", None), (None, 0, "user", "{broken")]
    m = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("id", F.lit(0))
    tools = {"f": {"properties": {"a": {"type": "string"}, "z": {"type": "integer"}}, "required": ["a"]}}
    got = {(x.part, x.call_id): x for x in tool_calls.link(m, tools).collect()}
    a, b = got[("call", "a")], got[("call", "b")]
    assert (a.level, a.valid, a.status) == (0, False, "linked") and (b.level, b.valid, b.status) == (1, True, "no_result")
    assert b.json == '{"arguments":{"a":"x","z":1},"id":"b","name":"f","type":"tool_call"}'
    assert got[("result", "q")].status == "orphan" and got[("result", "a")].level == 0
    assert tool_calls.link(m, tools).filter("part = 'message'").count() == 3
    ring = json.dumps({"tool_calls": [{"id": "a", "name": "f", "depends_on": ["b"]}, {"id": "b", "name": "f", "depends_on": ["a"]}]})
    circle = spark.createDataFrame([(1, 0, "assistant", ring)], "conv_id bigint, turn bigint, role string, text string")
    assert {x.status for x in tool_calls.link(circle, tools).collect()} == {"cycle"}
    assert tool_calls.link(m.limit(0), tools).count() == 0


def test_patience_aligns_equal_items():
    for _ in range(500):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 10))] for _ in "ab")
        got = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
        assert a != b or len(got) == len(a)


def test_line_dedup(spark, odd):
    one, two, three = text(60), text(8), text(9)
    rows = [(1, f"{one}\n\nup\n{two}", "a"), (2, f"{three}\n{two}\n\n{one}\nend", "a"), (3, f"{one}\n\nup\n{two}", "a")]
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[3] == ""
    assert one not in got[2] and two not in got[2] and three in got[2] and got[2].endswith("end")
    out = line_dedup.dedup_lines(odd).collect()
    assert len(out) == 9 and {x.doc_id: x.text for x in out}[1] is None
    assert [len(x.deleted) for x in out if x.doc_id == 5] == [1, 1]
    names = ["id", "nul", "th", "gone", "later", "a", "k", "row", "keys", "_h", "a b.c"]
    clash = odd.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))
    got_ = line_dedup.dedup_lines(clash.withColumn("n_lines", F.lit("x")))
    assert sorted(got_.columns) == sorted([*odd.columns, *names, "n_lines", "deleted"])
    assert {tuple(x[c] for c in names) for x in got_.collect()} == {tuple(range(len(names)))}
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_line_dedup_of_short_lines(spark):
    verse = ["one two", "three", "four five six", "seven eight"]
    rows = [(1, f"{text(9)}\nx", "a"), (2, "\n".join(["p q", *verse, "end"]), "a"), (3, "\n".join(["r s t", *verse, "x"]), "a"),
            (4, "a b c d\ne\nx", "a"), (5, "a b c d\ne\nf", "a"), (6, "a b c d\ne\nf", "a"), (7, "three\nx\nseven eight", "a")]
    rows += [(8, f"{rows[0][1]}\nm n\no p q", "a"), (9, f"{rows[0][1]}\nz\nm n\no p q", "a")]
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got[3] == "r s t\nx" and got[5] == "f" and got[6] == "" and got[8] == "m n\no p q" and got[9] == "z"
    assert all(got[i] == rows[i - 1][1] for i in (1, 2, 4, 7))


def test_line_dedup_takes_later_copies_in_one_document(spark):
    verse, own = text(7), text(6)
    rows = [(1, f"{verse}\nx", "a"), (2, f"{verse}\n{own}\n{verse}\ny z\n{own}", "a")]
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: f"{own}\ny z\n{own}"}


def test_no_shared_block_is_left(spark):
    """Against a search through all pairs: nothing that an earlier document has is left whole."""
    lines = [text(rng.choice([1, 2, 3, 6])) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(lines) if rng.random() < 0.5 else text(3) for _ in range(rng.randint(1, 14))), "a") for i in range(60)]
    got = {x.doc_id: set(x.deleted) for x in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    split = {i: t.split("\n") for i, t, _ in rows}
    found = lost = 0
    for i, mine in split.items():
        for a, b in line_dedup.runs([len(x.split()) for x in mine], 5):
            earlier = any(mine[a:b] == split[j][k : k + b - a] for j in range(i) for k in range(len(split[j])))
            found, lost = found + earlier, lost + (earlier and not got[i] & set(range(a, b)))
    assert found > 50 and not lost
    for i, gone in got.items():  # and nothing goes that no earlier document has
        assert all(any(split[i][k] in split[j] for j in range(i)) for k in gone)


def test_a_first_holder_with_many_later_ones(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    common = text(12)
    rows = [(i, f"{text(4)}\n{common}\n{text(3)}", "a") for i in range(50)]
    got = {x.doc_id: list(x.deleted) for x in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == {i: [1] if i else [] for i in range(50)}


def test_runs_cover_every_block():
    for _ in range(300):
        words = [rng.randint(1, 7) for _ in range(rng.randint(0, 9))]
        got, n = line_dedup.runs(words, 5), len(words)
        blocks = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if sum(words[i:j]) >= 5]
        assert got <= set(blocks)
        for i, j in blocks:
            assert set(range(i, j)) == {k for a, b in got if i <= a and b <= j for k in range(a, b)}


def test_url_rules(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.net/x?y", ""), (2, "https://example.net/en/a", None), (3, "nothing", ""), (4, None, ""),
         (5, "http://m.example.com/de/", '<a href="http://bad.net/">'), (6, "http://x.org/fr/#z", "")], "page_id bigint, url string, html string"
    )
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter.judge(pages).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[2][2:] == ("example.net/en/", "allow")
    assert got[3] == ("", "", None, "allow") and got[4] == got[3]
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == ("org/fr/", "allow")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_verdicts_spread_from_hosts_with_few_ruled_pages(spark):
    bad, good = '<a href="http://bad.example.com/1">', '<a href="http://friend.test/">'
    rows = [(1, "http://bad.example.com/de/", ""), *((i, f"http://bad.example.com/{i}", "") for i in (2, 3, 4)),
            (5, "http://good.org/fr/", good), *((i, f"http://good.org/{i}", "") for i in (6, 7, 8)),
            (9, "http://suspect.test/", bad), (10, "http://friend.test/", ""), (11, "http://far.test/", "")]
    verdicts = lambda r: {x.page_id: x.verdict for x in url_filter.judge(spark.createDataFrame(r, "page_id bigint, url string, html string")).collect()}
    got = verdicts(rows)
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 3, 4, 9}
    assert verdicts([(i, u, "" if i == 9 else h) for i, u, h in rows])[9] == "allow"  # no link, no distrust
    both = [(i, u, bad if i == 10 else h) for i, u, h in rows]
    assert verdicts(both)[10] == "allow"  # half of suspect's distrust, all of good's trust
    assert verdicts([(i, u, "" if i == 5 else h) for i, u, h in both])[10] == "block"


def test_propagation_is_personalised_pagerank(spark):
    """Against the linear system, on a graph with a hub, a ring, sinks and hosts of their own."""
    hosts = [f"h{i}" for i in range(40)]
    edges = [(hosts[0], h, 1.0) for h in hosts[1:25]] + [(h, hosts[0], 2.0) for h in hosts[5:15]]
    edges += [(hosts[i], hosts[25 + (i - 24) % 8], 1.0) for i in range(25, 33)] + [(hosts[3], hosts[25], 3.0), (hosts[33], hosts[34], 1.0)]
    seeds = [("trust", hosts[i], w) for i, w in ((0, 0.25), (3, 0.5), (38, 0.25))] + [("distrust", hosts[i], 0.5) for i in (26, 34)]
    got = url_filter.propagate(
        spark.createDataFrame(seeds, "kind string, host string, seed double"), spark.createDataFrame(edges, "src string, dst string, w double")
    )
    got = {(x.kind, x.host): x.score for x in got.collect()}
    for kind in ("trust", "distrust"):
        m, s, d = np.zeros((40, 40)), np.zeros(40), url_filter.DAMPING
        for a, b, w in edges:
            a, b = (int(x[1:]) for x in ((a, b) if kind == "trust" else (b, a)))
            m[b, a] += w
        m /= np.maximum(m.sum(0), 1e-300)
        for k, h, w in seeds:
            s[int(h[1:])] += w * (k == kind)
        want = np.linalg.solve(np.eye(40) - d * m, (1 - d) * s)
        assert sum(abs(got.get((kind, f"h{i}"), 0) - want[i]) for i in range(40)) < 1e-5
        assert want.max() > 0.02


def test_tokens_are_those_of_the_named_tokenizer():
    import pyarrow.parquet as pq
    import public_tokenizers
    from tokenizers import Tokenizer

    exact, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder(packing.vocabulary())
    texts = ["", "a  b", "x\n  y", " it's 12 é <|endoftext|> b", *(text(20) for _ in range(20)), " " * 1_000_000 + "a", "x" + "\n" * 999 + "y",
             "a\u3000" * 5000, "b" * 100_000, "1" * 9999, "?!" * 9999]
    texts += [x or "" for x in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()]
    for t in texts:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == exact.encode(t, add_special_tokens=False).ids


def best_fit_decreasing(lengths, cap):
    """The gaps of the sequences."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        bisect.insort(gaps, (gaps.pop(at) if at < len(gaps) else cap) - n)
    return gaps


@pytest.mark.parametrize(("cap", "n", "most"), [(7, 60, 7), (1024, 2500, 700), (1024, 0, 9)])
def test_sweeps_pack_like_best_fit_decreasing(spark, cap, n, most):
    lengths = [rng.randint(1, most) if rng.random() < 0.7 else rng.choice([1, 2, most, most // 3 + 1]) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(lengths)), "id bigint, length bigint").checkpoint()
    got, by = packing.places(docs, cap).collect(), defaultdict(list)
    assert sorted(x.id for x in got) == list(range(n))
    for x in got:
        by[x.seq].append((x.offset, lengths[x.id]))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [sum(m for _, m in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(m for _, m in parts) <= cap
    want = len(best_fit_decreasing(lengths, cap))
    assert len(by) <= want * 1.01 + 1, (len(by), want)


def test_bands_cover_all_lengths():
    for cap in (1, 2, 3, 5, 17, 64, 1000, 1024, 4096):
        got = packing.bands(cap)
        assert got[0][1] == cap and got[-1][0] == 0 and all(a[0] == b[1] for a, b in zip(got, got[1:], strict=False))


def test_packing(spark, odd):
    got = packing.pack_documents(odd).collect()
    by = defaultdict(list)
    for x in got:
        by[x.sequence_id].append((x.offset, x.length))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    long = sorted((x.start, x.length) for x in got if x.doc_id == 4)
    assert all(n == 1024 for _, n in long[1:]) and long[0][0] == 0
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_search_finds_the_nearest(spark):
    g = np.random.default_rng(3)
    v = g.normal(size=(600, 16)) * g.uniform(0.5, 2, size=(600, 1))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, [0.0] * 16), (901, None), (920, [float("nan")] * 16), (940, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.search(df, F.col("id") % 20 == 0).collect()
    hits = defaultdict(set)
    for x in got:
        assert abs(x.score - v[x.query_id] @ v[x.vec_id]) < 1e-9 and x.query_id != x.vec_id
        hits[x.query_id].add(x.vec_id)
    want = {q: set(np.argsort(-np.where(np.arange(600) == q, -np.inf, v @ v[q]))[:20].tolist()) for q in range(0, 600, 20)}
    assert sum(len(want[q] & hits[q]) for q in want) / (20 * len(want)) >= 0.9
    assert neighbours.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_search_fills_every_query(spark):
    """Two far clusters of unequal size, equal vectors and repeated rows: all have as many rows as there are, in order."""
    g = np.random.default_rng(4)
    v = np.concatenate([g.normal(size=(300, 8)) + 9, -9 - g.normal(size=(5, 8))]).astype(np.float32)
    v[7] = v[8] = v[9]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame([*rows, rows[0], rows[300]], "vec_id bigint, embedding array<float>")
    got = defaultdict(list)
    for x in neighbours.search(df, F.col("id") % 20 == 0, n=50).collect():
        got[x.query_id].append((x.rank, -x.score, x.vec_id))
    exact = v.astype(np.float64) @ v.astype(np.float64).T
    for q in range(0, 305, 20):
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 51)) and [x[1:] for x in found] == sorted(x[1:] for x in found)
        assert all(abs(-s - exact[q, i]) < 1e-9 for _, s, i in found)
    few = neighbours.search(df.filter("vec_id in (0, 1, 2)"), F.col("id") == 0).collect()
    assert [(x.rank, x.vec_id) for x in sorted(few, key=lambda x: x.rank)] == [(r + 1, i) for r, i in enumerate(sorted((1, 2), key=lambda i: -exact[0, i]))]


def test_language(spark):
    rows = [(i, " ".join(rng.choice(w) for _ in range(12)), lang) for i in range(120)
            for lang, w in [rng.choice([("x", ["the", "and", "this"]), ("y", ["oui", "être", "pour"])])]]
    df = spark.createDataFrame([*rows, (500, "123 ...", "x"), (501, None, None)], "doc_id bigint, text string, lang string")
    got = {x.doc_id: x for x in langid.identify(df).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert (got[500].lang_pred, got[500].score, got[501].lang_pred) == ("und", 0.0, "und")
    assert langid.identify(df.limit(0)).count() == 0


def test_language_triples_and_bundles():
    letters = langid.Letters.one()
    for sample in ["Яблоко да груша, ёлка", "مرحبا بالعالم", "日本語の文章です", "Größe ΣΊΣΥΦΟΣ"]:
        assert (letters.slots[[ord(c) for c in sample if c.isalpha()]] > 0).all()
    assert len(set(letters.slots[0x430:0x450])) == 32 and letters.slots[ord("Я")] == letters.slots[ord("я")]
    assert len({*letters.slots[97:123], *letters.slots[0x3B1:0x3C2], *letters.slots[0x627:0x63B]}) == 26 + 17 + 20
    words = [text(30), "", "ab 12 çà", "Б" * 9]
    (i, n, doc, triple, count), = letters.counted(words)
    whole = [letters._long(w) for w in words]
    for k, (kinds, total) in enumerate(whole):
        assert (triple[doc == k] == kinds).all() and (count[doc == k] == total).all()
    slow = np.zeros((4, langid.DIM))
    for d, x, c in zip(doc, triple, count, strict=True):  # a triple's vector is the product of its letters', permuted
        a, b, z = x >> 24, x >> 12 & 4095, x & 4095
        slow[d] += c * np.roll(letters.third[a], 2).astype(int) * np.roll(letters.third[b], 1) * letters.third[z]
    assert (letters.bundles(n, doc, triple, count.astype(np.float64)) == slow).all()
    assert len(letters._long("a" * (langid.SLICE + 5))[0]) == 3


def test_mixing(spark, odd):
    rows = [(i, text(rng.randint(1, 40)), rng.choice("abcd")) for i in range(400)]
    got = mixing.mix_documents(docs_of(spark, rows)).collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    share = {s: w for s, w in zip(sorted(size), [1, 2, 3, 1], strict=True)}
    want, free, left = {}, set(size), float(sum(size.values()))
    while free:
        level = left / sum(share[s] for s in free)
        over = {s for s in free if level * share[s] > 3 * size[s]}
        for s in over or free:
            want[s] = 3 * size[s] if over else level * share[s]
        left -= sum(want[s] for s in over)
        free = free - over if over else set()
    took = Counter()
    for x in got:
        assert abs(x.target - want[x.source]) < 1e-6 and 0 <= x.taken <= 3 * x.size
        took[x.source] += x.taken
    assert all(abs(took[s] - want[s]) <= 1 for s in want)
    assert mixing.mix_documents(odd).count() == 9 and mixing.mix_documents(odd.limit(0)).count() == 0
    assert mixing.training_rows(odd).columns == odd.columns


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    rows = []
    for i in range(0, 120, 4):
        base = text(60).split()
        for j in range(4):
            w = list(base)
            for _ in range(j * 2):
                w[rng.randrange(60)] = rng.choice(WORDS)
            rows.append((i + j, " ".join(w), "a"))
    rows += [(900, None, "a"), (901, " ", "a"), (902, "solo", "a"), (903, "SOLO", "a")]
    sets = {}
    for i, t, _ in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    got = near_dedup.near_duplicates(docs_of(spark, rows), k=k).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == {i: (len(sets[i]), find(i)) for i in sets}
    assert near_dedup.near_duplicates(docs_of(spark, rows).limit(0), k=k).count() == 0


@pytest.mark.parametrize("block", [2048, 200])
def test_links_within_large_groups_of_near_copies(spark, monkeypatch, block):
    """Copies of one text that are a little too far from each other to be linked, and a few that are not: against all
    pairs. Words are numbers, so a shingle stands at one place only."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    g = np.random.default_rng(11)
    made = np.tile(np.arange(400), (1300, 1))
    for i in range(1300):
        if i >= 1288:  # a link to one of the others, just within the threshold
            made[i] = made[i - 1288]
        at = g.choice(400, 22 if i >= 1288 else 14, replace=False)
        made[i, at] = 1000 * (i + 1) + at
    alike = [((made[:, 1:] == w[1:]) & (made[:, :-1] == w[:-1])).sum(axis=1) for w in made]
    root = np.arange(1300)
    for b in range(1300):
        for a in np.flatnonzero(alike[b][:b] * 100 >= (798 - alike[b][:b]) * 80):
            lo, hi = sorted((root[a], root[b]))
            root[root == hi] = lo
    assert 12 <= (root != np.arange(1300)).sum() < 200
    docs = docs_of(spark, [(i, " ".join(map(str, w)), "a") for i, w in enumerate(made.tolist())])
    got = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(docs, k=2).collect()}
    assert got == dict(enumerate(root.tolist()))


def test_common_shingles_are_counted_in_parts(monkeypatch):
    monkeypatch.setattr(near_dedup, "AT_ONCE", 50)
    g = np.random.default_rng(4)
    sets = [np.unique(g.integers(0, 300, n, dtype=np.uint64)) for n in (40, 1, 200, 7, 60, 90)]
    assert near_dedup._shared(sets[0], sets[1:]).tolist() == [len(np.intersect1d(sets[0], s)) for s in sets[1:]]


def test_signatures_of_unrelated_large_sets_differ():
    g = np.random.default_rng(2)
    minima = near_dedup.Minima(near_dedup.BANDS, near_dedup.ROWS)
    for n in (250, 1000, 4000):
        a, b = (near_dedup.signature(minima.least(np.unique(g.integers(0, 1 << 63, n, dtype=np.uint64)))).view(np.uint8) for _ in "ab")
        assert (a == b).sum() <= 8 and len(a) == 128


def test_pipeline(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, names = docs.columns, [n for n, _ in c.STAGES]
    assert len(names) == 5
    for k, (_, stage) in enumerate(c.STAGES):
        docs = stage(spark, docs, "/root/testdata/sf0.001").checkpoint()
        assert docs.count() > 0 and (k == 4 or docs.columns == columns)


def test_unlabelled_documents_pass_the_language_stage(spark):
    import corpus_pipeline as c

    rows = [(1, text(80), "a"), (2, "123 ... \n", "a"), (3, None, "a"), (None, "né", "b"), (5, "", "b")]
    docs = docs_of(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    got = c.language_id(spark, docs, "").collect()
    assert sorted(x.text for x in got) == sorted([rows[0][1], "né"]) and {x.lang for x in got} == {None}
    assert got[0].asDict().keys() == set(docs.columns)


def test_one_row_of_each_near_group_stays(spark):
    import corpus_pipeline as c

    a, b, z = text(200), text(200), text(50)
    rows = [(1, a, "a"), (None, a + " x", "a"), (None, z, "a"), (None, None, "a"), (4, b, "a"), (7, b + " y", "a"), (7, "lone words", "a"), (7, "lone words", "a")]
    got = c.dedup_near(spark, docs_of(spark, rows), "").collect()
    assert {(x.doc_id, x.text) for x in got} == {(1, a), (None, z), (None, None), (4, b), (7, "lone words")} and len(got) == 5


def test_pipeline_keeps_one_row_of_each_component_of_a_large_group(spark):
    """As above, with the pipeline's shingles of five words: against all pairs."""
    import corpus_pipeline as c

    g = np.random.default_rng(12)
    made = np.tile(np.arange(400), (1100, 1))
    for i in range(1100):
        if i >= 1088:
            made[i] = made[i - 1088]
        at = g.choice(400, 8 if i >= 1088 else 6, replace=False)
        made[i, at] = 1000 * (i + 1) + at
    root = np.arange(1100)
    for b in range(1100):
        same = made == made[b]
        both = np.logical_and.reduce([same[:, d : 396 + d] for d in range(5)]).sum(axis=1)
        for a in np.flatnonzero(both[:b] * 100 >= (792 - both[:b]) * 80):
            lo, hi = sorted((root[a], root[b]))
            root[root == hi] = lo
    docs = docs_of(spark, [(i, " ".join(map(str, w)), "a") for i, w in enumerate(made.tolist())])
    assert sorted(x.doc_id for x in c.dedup_near(spark, docs, "").collect()) == np.unique(root).tolist()


def test_every_run_of_lines_that_an_earlier_document_has_goes(spark):
    """Against a search through all pairs, on documents of few different lines, whose runs an alignment may tear apart."""
    import corpus_pipeline as c

    r = random.Random(8)
    kinds = ["a b", "c d e", "f", "g h i j", "k l m", "n", "o p", "q r s t"]
    rows = [(1, "a b c\nv w x y z\na b c\nd e f", "a"), (2, "a b c\nd e f", "a")]
    rows += [(i, "\n".join(r.choice(kinds) for _ in range(r.randint(1, 9))), "a") for i in range(3, 60)]
    split, want = [t.split("\n") for _, t, _ in rows], {}
    for i, mine in enumerate(split):
        held = [x for x in line_dedup.runs([len(y.split()) for y in mine], 5)
                if any(mine[slice(*x)] == split[j][k : k + x[1] - x[0]] for j in range(i) for k in range(len(split[j])))]
        want[rows[i][0]] = sorted({k for a, b in held for k in range(a, b)})
    docs = docs_of(spark, rows)
    assert {x.doc_id: list(x.deleted) for x in line_dedup.dedup_lines(docs).collect()} == want and want[2] == [0, 1]
    assert {x.doc_id for x in c.dedup_lines(spark, docs, "").collect()} == {i for i, t, _ in rows if len(want[i]) < len(t.split("\n"))}


def test_new_sequences_are_filled(spark):
    """Tables of lengths just above a band's lower end: a sequence, new or not, takes as many as it has tokens for."""
    r = random.Random(9)
    for lengths in ([33] * 1000, [r.randint(86, 90) for _ in range(500)], [520] * 30 + [33] * 2310):
        docs = spark.createDataFrame(list(enumerate(lengths)), "id bigint, length bigint").checkpoint()
        by = defaultdict(list)
        for x in packing.places(docs).collect():
            by[x.seq].append((x.offset, lengths[x.id]))
        for parts in by.values():
            assert [o for o, _ in sorted(parts)] == [sum(m for _, m in sorted(parts)[:i]) for i in range(len(parts))]
            assert sum(m for _, m in parts) <= 1024
        assert sum(map(len, by.values())) == len(lengths) and len(by) == len(best_fit_decreasing(lengths, 1024))


def test_near_dedup_stage_writes_no_whole_rows_to_the_shared_folder(spark):
    """Columns beside doc_id and text are large here, and stay out of all checkpoints."""
    import os
    import corpus_pipeline as c

    def written():
        folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)

    r = random.Random(10)
    rows = [(i % 150, " ".join(str(r.randrange(99)) for _ in range(30)), "a") for i in range(180)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t), r.randbytes(50_000)) for i, t, s in [*rows, *rows[:20]]], DOCS + ", more binary")
    c.dedup_near(spark, docs.limit(0), "").count()  # there is a folder now
    before = written()
    got = c.dedup_near(spark, docs, "").collect()
    assert written() - before < 200 * 50_000 / 4
    assert sorted((x.doc_id, x.text) for x in got) == sorted((i, t) for i, t, _ in rows) and all(len(x.more) == 50_000 for x in got)


def test_near_dedup_writes_few_files_for_small_tables(spark):
    """However many partitions shuffles have: a file is written for so many rows, not for each partition of each table."""
    import os

    def files():
        folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return sum(f.startswith("part-") for _, _, names in os.walk(folder) for f in names)

    r = random.Random(13)
    base = [str(r.randrange(99)) for _ in range(40)]
    rows = [(i, " ".join(str(r.randrange(99)) if r.random() < 0.01 else w for w in base), "a") for i in range(60)]
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {x: spark.conf.get(x) for x in held}
    want = {(x.doc_id, x.component_id, x.kept) for x in near_dedup.near_duplicates(docs_of(spark, rows)).collect()}
    try:
        for x, v in held.items():
            spark.conf.set(x, v)
        before = files()
        got = {(x.doc_id, x.component_id, x.kept) for x in near_dedup.near_duplicates(docs_of(spark, rows)).collect()}
        assert files() - before < 3 * 40
    finally:
        for x, v in old.items():
            spark.conf.set(x, v)
    assert got == want and len({c for _, c, _ in got}) < 60

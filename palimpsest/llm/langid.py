"""Language identification by hyperdimensional profiles.

Each letter has a random vector of signs. A letter triple is the product (binding) of its letters' vectors, permuted by
their place; a text is the sum (bundle) of its triples, and a language the sum of its texts, each scaled to one length.
A document gets the language whose profile, less the mean of all profiles, has the largest cosine with its bundle.

A language's bundle is linear in its triples' counts, so training adds counts up in whole numbers and multiplies by the
vectors once a task: sums do not depend on the order of tasks. Profiles are one row of DIM numbers a language, and the
number of languages is checked against MOST_LANGUAGES before they are sent out.

Defined cases: null text, or a text without a letter, gives `und` with score 0, as does any text if nothing was learned;
a null doc_id is held out or not by the empty string's checksum; a language's ties go to the first by code point; rows
of null text or null lang are not learned from; repeated rows count each; an empty table gives an empty result; other
columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.common import read

DIM = 1024
#: Letter slots, 0 for the gap between words. Letters of alphabets and syllabaries have slots of their own; those of the
#: large sets (more than LARGE code points in a row of letters without case, such as Han and Hangul) share the last ones.
SLOT_BITS = 12
SLOTS = 1 << SLOT_BITS
LARGE, SHARED = 1000, 1024
#: Characters handled at once, and rows of the two tables that are multiplied at once.
SLICE, BLOCK = 1 << 20, 2048
MOST_LANGUAGES = 4096
UNKNOWN = "und"
_SCALE = 1 << 16


def _slots() -> np.ndarray:
    """Slot of each code point: 0 unless it is a letter; both cases of a letter share a slot."""
    letter = np.array([chr(cp).isalpha() for cp in range(0x110000)])
    low = np.arange(0x110000)
    for cp in np.flatnonzero(letter):
        c = chr(cp).lower()
        low[cp] = ord(c[0])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], letter.astype(np.int8), [0]])))
    out, free = np.zeros(0x110000, np.int64), 1
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        if b - a > LARGE:
            out[a:b] = SLOTS - SHARED + np.arange(a, b) * 0x9E3779B1 % (1 << 32) % SHARED
            continue
        for cp in range(a, b):
            if low[cp] == cp or not letter[low[cp]]:
                out[cp] = free if free < SLOTS - SHARED else SLOTS - SHARED + cp * 0x9E3779B1 % (1 << 32) % SHARED
                free += 1
    cased = letter & (low != np.arange(0x110000)) & letter[low]
    out[cased] = out[low[cased]]
    return out


class Letters:
    """Triples of letters in texts, and their vectors. One in each worker."""

    _one = None

    def __init__(self):
        self.slots = _slots()
        signs = np.random.default_rng(1729).integers(0, 2, (SLOTS, DIM), dtype=np.int8) * np.int8(2) - np.int8(1)
        self.first, self.second, self.third = np.roll(signs, 2, 1), np.roll(signs, 1, 1), signs

    @classmethod
    def one(cls) -> "Letters":
        cls._one = cls._one or cls()
        return cls._one

    def triples(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of code points that begin and end with a gap: each triple around a letter, and that letter's place."""
        s = self.slots[codes]
        at = np.flatnonzero((s[1:] != 0) | (s[:-1] != 0)) + 1
        at = np.concatenate([[0], at])
        s = s[at]
        t = (s[:-2] << 2 * SLOT_BITS) | (s[1:-1] << SLOT_BITS) | s[2:]
        mid = s[1:-1] != 0
        return t[mid], at[1:-1][mid]

    def vectors(self, triples: np.ndarray) -> np.ndarray:
        low = SLOTS - 1
        return self.first[triples >> 2 * SLOT_BITS] * self.second[triples >> SLOT_BITS & low] * self.third[triples & low]

    def counted(self, texts: list[str]):
        """Yields (first text, number of texts, place of the text, triple, count) over slices of texts, sorted by text. A
        longer text than a slice is one of its own, whose pieces overlap by the letters that its triples at the seam need."""
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) < SLICE):
                size += len(texts[j])
                j += 1
            if size > SLICE:
                kinds, total = self._long(texts[i])
                yield i, 1, np.zeros(len(kinds), np.int64), kinds, total
            else:
                part = texts[i:j]
                lengths = np.array([len(x) + 2 for x in part])
                codes = np.frombuffer((" " + "  ".join(part) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
                t, place = self.triples(codes)
                key, n = np.unique(np.repeat(np.arange(len(part)), lengths)[place] << 3 * SLOT_BITS | t, return_counts=True)
                yield i, len(part), key >> 3 * SLOT_BITS, key & ((1 << 3 * SLOT_BITS) - 1), n
            i = j

    def _long(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        kinds, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(text), SLICE):
            lead = " " if not at else ""
            piece = lead + text[max(0, at - 1) : at + SLICE + 1] + (" " if at + SLICE + 1 >= len(text) else "")
            s = self.slots[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
            t = (s[:-2] << 2 * SLOT_BITS) | (s[1:-1] << SLOT_BITS) | s[2:]
            k, n = np.unique(t[s[1:-1] != 0], return_counts=True)
            kinds, back = np.unique(np.concatenate([kinds, k]), return_inverse=True)
            total = np.bincount(back, np.concatenate([total, n]), len(kinds)).astype(np.int64)
        return kinds, total

    def bundles(self, n: int, doc: np.ndarray, triple: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The n texts' sums of weighted vectors. Tables of BLOCK triples at most are multiplied at once."""
        out = np.zeros((n, DIM), weight.dtype)
        kinds, back = np.unique(triple, return_inverse=True)
        order = np.argsort(back, kind="stable")
        edge = np.searchsorted(back[order], np.arange(0, len(kinds) + BLOCK, BLOCK))
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            vectors, part = self.vectors(kinds[k * BLOCK : (k + 1) * BLOCK]).astype(weight.dtype), order[a:b]
            rows, at = np.unique(doc[part], return_inverse=True)
            for lo in range(0, len(rows), BLOCK):
                mine = (at >= lo) & (at < lo + BLOCK)
                table = np.zeros((min(BLOCK, len(rows) - lo), len(vectors)), weight.dtype)
                table[at[mine] - lo, back[part[mine]] - k * BLOCK] = weight[part[mine]]
                out[rows[lo : lo + BLOCK]] += table @ vectors
        return out


def _learn(batches):
    letters, sums = Letters.one(), {}
    for b in batches:
        langs = b.column("lang").to_pylist()
        for i, n, doc, triple, count in letters.counted(b.column("text").to_pylist()):
            if not len(doc):
                continue
            size = np.sqrt(np.bincount(doc, count.astype(np.float64) ** 2, n))
            scaled = np.rint(count * (_SCALE / np.maximum(size, 1))[doc])
            names = sorted(set(langs[i : i + n]))
            which = np.array([names.index(x) for x in langs[i : i + n]])[doc]
            # a language's triples in one sum; whole numbers below 2^53 in all, so the product is exact
            key, back = np.unique(which << 3 * SLOT_BITS | triple, return_inverse=True)
            total = np.bincount(back, scaled, len(key))
            found = letters.bundles(len(names), key >> 3 * SLOT_BITS, key & ((1 << 3 * SLOT_BITS) - 1), total)
            for lang, part in zip(names, found.astype(np.int64), strict=True):
                sums[lang] = sums.get(lang, 0) + part
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
            ["lang", "bundle"],
        )


def profiles(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Language -> unit profile, from rows (text, lang) without nulls."""
    parts = labelled.select("text", "lang").mapInArrow(_learn, "lang string, bundle array<bigint>")
    sums = parts.select("lang", F.posexplode("bundle").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("d", "x"))).x.alias("x"))
    got = rows.limit(MOST_LANGUAGES + 1).collect()
    if len(got) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    unit = {r.lang: v / max(np.linalg.norm(v), 1e-300) for r in got for v in [np.array(r.x, np.float64)]}
    mean = sum(unit.values()) / len(unit) if len(unit) > 1 else 0.0
    return {k: (v - mean) / max(np.linalg.norm(v - mean), 1e-300) for k, v in sorted(unit.items())}


def _tell(known: dict[str, np.ndarray]):
    names = list(known)
    table = np.array([known[k] for k in names], np.float32).reshape(len(names), DIM)

    def run(batches):
        letters = Letters.one()
        for b in batches:
            best, score = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
            for i, n, doc, triple, count in letters.counted(b.column("text").fill_null("").to_pylist()):
                if not len(doc) or not names:
                    continue
                found = letters.bundles(n, doc, triple, count.astype(np.float32))
                size = np.sqrt((found * found).sum(1))
                cos = found @ table.T / np.maximum(size, 1e-30)[:, None]
                top, some = cos.round(6).argmax(1), np.unique(doc)
                best[i + some] = np.array(names, object)[top[some]]
                score[i + some] = np.clip(cos[some, top[some]], 0, 1).round(6)
            keep = [b.column(c) for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*(c for c in b.schema.names if c != "text"), "lang_pred", "score"],
            )

    return run


def tell(rows: DataFrame, known: dict[str, np.ndarray]) -> DataFrame:
    """Replaces `text` by lang_pred and score; other columns stay."""
    out = T.StructType([f for f in rows.schema if f.name != "text"]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_tell(known), out)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learned(docs: DataFrame) -> dict[str, np.ndarray]:
    """Profiles from the documents that are not held out."""
    return profiles(docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return tell(rows, learned(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op8(spark, sf_dir):
    return identify(read(spark, sf_dir, "documents"))

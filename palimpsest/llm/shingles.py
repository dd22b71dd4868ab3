"""Word hashes, shingle sets and minima over Arrow buffers: numpy only, no Spark.

Words are the runs of bytes other than ASCII white space, with A-Z lowered. A word's hash is a polynomial over random
64-bit values of its bytes, taken for a whole slice at once by running sums; nothing is done word by word.
"""

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE = 1 << 20
_rng = np.random.default_rng(20240401)


def _odd(n: int, bits: int = 64) -> np.ndarray:
    kind = U if bits == 64 else np.uint32
    return _rng.integers(0, 1 << bits, n, dtype=kind, endpoint=False) | kind(1)


_BYTE = _rng.integers(0, 1 << 63, 256, dtype=U) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = int(_odd(1)[0])
_BACK = pow(_STEP, -1, 1 << 64)
_JOIN = int(_odd(1)[0])
_SHORT = int(_odd(1)[0])
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, SLICE + 1)
        fill = [np.full(n, x, U) for x in (_STEP, _BACK)]
        for f in fill:
            f[0] = 1
        _POWERS[:] = [np.multiply.accumulate(f) for f in fill]
    return _POWERS[0], _POWERS[1]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the 64-bit finaliser of a well-known public hash)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _hash_slice(buf: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words in buf; `cuts` are places where a word ends in any case."""
    solid = ~_SPACE[buf]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = cuts[(cuts > 0) & (cuts < len(buf))]
    begin[inner] |= solid[inner]
    end[inner - 1] |= solid[inner - 1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=total[1:])
    return (total[end] - total[begin]) * down[begin], begin


def _long(buf: np.ndarray) -> np.ndarray:
    """Word hashes of one text, in slices that end at white space."""
    out, at = [], 0
    while at < len(buf):
        to = min(at + SLICE, len(buf))
        if to < len(buf):
            gaps = np.flatnonzero(_SPACE[buf[at:to]])
            while not len(gaps) and to < len(buf):
                step = min(to + SLICE, len(buf))
                gaps = np.flatnonzero(_SPACE[buf[to:step]]) + (to - at)
                to = step
            to = at + int(gaps[-1]) + 1 if len(gaps) else to
        out.append(_hash_slice(buf[at:to], np.zeros(0, np.int64))[0])
        at = to
    return np.concatenate(out) if out else np.zeros(0, U)


def text_words(column: pa.Array):
    """Yields the word hashes of each text; null has none."""
    column = column.fill_null("").cast(pa.large_binary())
    _, ends, data = column.buffers()
    offs = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        if offs[i + 1] - offs[i] > SLICE:
            yield _long(data[offs[i] : offs[i + 1]])
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + SLICE, "right")) - 1)
        cuts = offs[i : j + 1] - offs[i]
        words, begin = _hash_slice(data[offs[i] : offs[j]], cuts)
        at = np.searchsorted(begin, cuts)
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield words[a:b]
        i = j


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word runs; of a shorter text, its whole sequence as one; none without words."""
    n = len(words)
    if not n:
        return words
    own = n if n < k else k
    g = words[: n - own + 1].copy()
    for t in range(1, own):
        g = g * U(_JOIN) + words[t : n - own + 1 + t]
    if n < k:
        g = g * U(_SHORT) + U(n)
    g = np.sort(scramble(g))
    keep = np.ones(len(g), bool)
    np.not_equal(g[1:], g[:-1], out=keep[1:])
    return g[keep]


def set_print(s: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    a = scramble(s ^ U(0x9E3779B97F4A7C15)).sum(dtype=U)
    b = scramble(s * U(0xD6E8FEB86659FD93)).sum(dtype=U)
    return a.tobytes() + (b + U(len(s))).tobytes()


class Minima:
    """The least values of `n` universal hashes a x + b (mod 2^32) over a set, and hashes of bands of them."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(7)
        n = bands * rows
        self.a = rng.integers(0, 1 << 32, (n, 1), dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (n, 1), dtype=np.uint32)
        self.mix = rng.integers(0, 1 << 63, (rows,), dtype=U) * U(2) + U(1)
        self.salt = rng.integers(0, 1 << 63, (bands,), dtype=U)
        self.shape, self.room = (bands, rows), np.empty((n, 512), np.uint32)

    def least(self, s: np.ndarray) -> np.ndarray:
        x = (s >> U(32)).astype(np.uint32)
        out = None
        for at in range(0, len(x), 512):
            part = x[None, at : at + 512]
            room = self.room[:, : part.shape[1]]
            np.multiply(self.a, part, out=room)
            np.add(room, self.b, out=room)
            low = room.min(axis=1)
            out = low if out is None else np.minimum(out, low)
        return out

    def bands(self, least: np.ndarray) -> np.ndarray:
        v = scramble((least.reshape(self.shape).astype(U) + U(1)) * self.mix).sum(axis=1, dtype=U)
        return scramble(v ^ self.salt).view(np.int64)

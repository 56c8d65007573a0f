"""Statistics of whole texts, many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .text import SPACED, translated, words

#: Classes of bytes; bytes beyond ASCII count once per character, by the lead byte.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "symbol", "other", "tail")
NAMES = (
    "log_chars",
    "log_words",
    "word_chars",
    "upper",
    "digit",
    "stop",
    "symbol",
    "other",
    "lines_per_word",
    "distinct_words",
    "top_word",
    "repeated_pairs",
    "repeated_lines",
    "single_letter_words",
)


def _classes() -> np.ndarray:
    out = np.full(256, CLASSES.index("symbol"), np.uint8)
    for first, last, name in (("a", "z", "lower"), ("A", "Z", "upper"), ("0", "9", "digit"), ("\t", "\r", "space"), (" ", " ", "space")):
        out[ord(first) : ord(last) + 1] = CLASSES.index(name)
    out[ord("\n")] = CLASSES.index("line")
    for c in ".,;:?'\"-()":
        out[ord(c)] = CLASSES.index("stop")
    out[0x80:] = CLASSES.index("other")
    out[0x80:0xC0] = CLASSES.index("tail")
    return out


_CLASS = _classes()
_SAME = bytes(range(256))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of distinct keys, and the count of the most frequent."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])]) if len(k) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    runs = np.diff(np.concatenate([heads, [len(k)]]))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, r[heads], runs)
    return np.bincount(r[heads], minlength=n), top


def of_texts(texts: pa.Array) -> np.ndarray:
    """(texts, statistics) in the order of ``NAMES``; zeros for an empty text."""
    flat = translated(texts, _SAME)
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[: len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2], np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
    n = len(flat)
    kind = _CLASS[raw]
    share = {c: _sums(kind == i, offsets).astype(float) for i, c in enumerate(CLASSES) if c != "lower"}
    chars = np.diff(offsets) - share["tail"]
    codes, distinct, counts = words(texts, SPACED)
    row = np.repeat(np.arange(n), counts)
    one = np.maximum(counts, 1)
    types, top = _distinct(codes, row, n)
    inner = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    pairs = codes[inner] * np.int64(len(distinct) + 1) + codes[inner + 1] if len(inner) else inner
    pair_types, _ = _distinct(pairs, row[inner] if len(inner) else inner, n)
    short = np.array([len(w) < 2 for w in distinct], bool)
    single = np.bincount(row, short[codes].astype(float) if len(codes) else None, n) if len(row) else np.zeros(n)
    repeated = np.zeros(n)
    for i in np.flatnonzero(share["line"] > 0).tolist():
        lines = [x for x in raw[offsets[i] : offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
        repeated[i] = 1 - len(set(lines)) / max(len(lines), 1)
    some = np.maximum(chars, 1)
    visible = np.maximum(chars - share["space"] - share["line"], 1)
    return np.stack(
        [
            np.log1p(chars),
            np.log1p(counts),
            (visible / one) * (counts > 0),
            share["upper"] / some,
            share["digit"] / some,
            share["stop"] / some,
            share["symbol"] / some,
            share["other"] / some,
            share["line"] / one,
            types / one,
            top / one,
            1 - pair_types / np.maximum(counts - 1, 1) * (counts > 1) - (counts < 2),
            repeated,
            single / one,
        ],
        axis=1,
    )

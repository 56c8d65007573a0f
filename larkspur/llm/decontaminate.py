"""Benchmark decontamination.

Benchmark questions and answers are normalised and cut into windows of
consecutive words, and the windows into parts of bounded bytes.  One
Aho-Corasick automaton for each part scans each normalised text; a text's hit
words and items are united over the parts.  Offsets of hits are mapped back to the original text.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import passing
from .text import ALNUM, gathered, slices, translated

#: Benchmark text of one part: a task holds the automaton of one part at a time (some ten nodes for each byte of text).
MAX_BENCHMARK_BYTES = 2_000_000
#: Where there are several parts, each automaton is built once for so many bytes of texts.
GROUP_BYTES = 64_000_000


def normalised(text: str | None) -> str:
    """Lower-cased words joined by one space, one character a byte."""
    return b" ".join((text or "").encode().translate(ALNUM).split()).decode("latin-1")


def windows_of(text: str, size: int) -> list[str]:
    """Runs of ``size`` words, between spaces; all words where there are fewer."""
    ws = text.split()
    return [f" {' '.join(ws[i : i + size])} " for i in range(max(len(ws) - size, 0) + 1)] if ws else []


def build(windows: dict[str, list]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for w, items in windows.items():
        found.add_word(w, (w.count(" ") - 1, items))
    if windows:
        found.make_automaton()
    return found


def _benchmark_parts(benchmark: DataFrame, item_col: str, text_cols: list[str], size: int):
    """Parts of the benchmark, each of windows to the ids of their items.  A
    byte of text is in ``size`` windows, so a part's windows have at most so
    many times ``MAX_BENCHMARK_BYTES``; the driver holds one part at a time.  A
    single window beyond the bound is an error."""
    whole = benchmark.select(F.col(item_col).cast("string").alias("item"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(text_cols)])
    out: dict[str, list] = {}
    held = 0
    for row in whole.toLocalIterator():
        for text in row[1:]:
            for w in windows_of(normalised(text), size):
                if len(w) > MAX_BENCHMARK_BYTES:
                    raise ValueError(f"a window of {len(w)} bytes does not fit into parts of at most {MAX_BENCHMARK_BYTES}")
                if w not in out and out and held + len(w) > size * MAX_BENCHMARK_BYTES:
                    yield out
                    out, held = {}, 0
                if w not in out:
                    held += len(w)
                items = out.setdefault(w, [])
                if row.item is not None and row.item not in items:
                    items.append(row.item)
    if out:
        yield out


def _shared_parts(benchmark: DataFrame, *args) -> list:
    return [benchmark.sparkSession.sparkContext.broadcast(part) for part in _benchmark_parts(benchmark, *args)]


class _Automata:
    """The parts' automata.  One part's is built once for each worker; of
    several, each is built when its turn comes and forgotten with its windows."""

    def __init__(self, shared: list):
        self.shared = shared

    def __iter__(self):
        if len(self.shared) == 1:
            own = self.shared[0]
            if "_automaton" not in own.__dict__:  # the same object in all tasks of a worker, until it drops the broadcast
                own._automaton = build(own.value)
            yield own._automaton
            return
        for part in self.shared:
            found = build(part.value)
            part.__dict__.pop("_value", None)  # the worker's copy; it is read again from its file
            yield found
            del found


SCHEMA = "id {id}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def _groups(batches, parts: int):
    return batches if parts < 2 else gathered(batches, "text", GROUP_BYTES)


def _scan_batches(shared: list, with_spans: bool):
    def run(batches):
        automata = _Automata(shared)
        for batch in _groups(batches, len(shared)):
            for part in slices(batch, "text") if len(shared) < 2 else [batch]:
                yield _scan(part, automata, with_spans)

    return run


def _lines(raws: list[bytes]) -> list[str]:
    return [f" {b' '.join(raw.split()).decode('latin-1')} " for raw in raws]


def _scan(part: pa.RecordBatch, automata: _Automata, with_spans: bool) -> pa.RecordBatch:
    flat = translated(part.column("text"), ALNUM).to_pylist()
    lines = _lines(flat)
    every: list = [[] for _ in flat]
    names: list = [set() for _ in flat]
    for automaton in automata:
        for i, line in enumerate(lines):
            for end, (count, ids) in automaton.iter(line):
                every[i].append((end, count))
                names[i].update(ids)
    n_words, n_hit, items, spans = [], [], [], []
    for i, (raw, line, hits, found) in enumerate(zip(flat, lines, every, names)):
        ws = raw.split()
        n_words.append(len(ws))
        if not hits:
            n_hit.append(0)
            items.append([])
            spans.append([])
            continue
        ends = np.array([h[0] for h in hits])
        counts = np.array([h[1] for h in hits])
        # a window ends on the space behind its last word: the spaces so far number the words
        spaces = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
        last = spaces[ends] - 1
        edge = np.zeros(len(ws) + 1, np.int64)
        np.add.at(edge, last - counts, 1)
        np.add.at(edge, last, -1)
        hit = np.cumsum(edge[:-1]) > 0
        n_hit.append(int(hit.sum()))
        items.append(sorted(found))
        spans.append(_original(raw, hit, part.column("text")[i].as_py()) if with_spans else [])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [part.column("id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, kind)],
        ["id", "n_words", "n_hit", "items", "spans"],
    )


def _original(raw: bytes, hit: np.ndarray, text: str) -> list[dict]:
    """Runs of hit words as code-point spans of the original text."""
    own = np.frombuffer(raw, np.uint8) != 0x20
    before = np.concatenate([[False], own[:-1]])
    starts = np.flatnonzero(own & ~before)
    ends = np.flatnonzero(~own & before)
    ends = np.concatenate([ends, [len(raw)]]) if own[-1] else ends
    # code points before each byte: bytes that do not continue a character
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)])
    change = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1))]


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_cols: tuple[str, ...] = ("text",), window: int = 10, spans: bool = True) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, n_hit, items, spans.

    Words are runs of letters and digits with A-Z lower-cased; a window is
    ``window`` consecutive words of an item, or all of a shorter item's.  A
    word inside any occurrence of a window is hit; items are those with an
    occurring window; spans are runs of hit words in code points of the
    original text.  Null and empty texts have no words and no hits; empty or
    null items have no windows; items without an id hit but are not named;
    repeated rows and ids stay.  Other columns are not read.  A benchmark
    beyond ``MAX_BENCHMARK_BYTES`` is scanned in parts.
    """
    spark = docs.sparkSession
    shared = _shared_parts(benchmark, item_col, list(item_text_cols), window)
    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_scan_batches(shared, spans), SCHEMA.format(id=kind))
    return out.withColumnRenamed("id", id_col)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_cols: tuple[str, ...] = ("text",), window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all columns.  Null
    and empty texts stay, as does everything beside an empty benchmark; rows
    that repeat are judged alike; columns may have any names."""
    shared = _shared_parts(benchmark, item_col, list(item_text_cols), window)
    if len(shared) < 2:
        flagged, name = passing(docs, text_col, T.BooleanType(), lambda texts: _clean(texts, _Automata(shared)))
        return flagged.where(F.col(name)).drop(name)
    names, at = docs.columns, docs.columns.index(text_col)
    flat = docs.toDF(*["text" if i == at else f"c{i}" for i in range(len(names))])

    def run(batches):
        automata = _Automata(shared)
        for batch in _groups(batches, len(shared)):
            yield batch.filter(_clean(batch.column("text"), automata))

    return flat.mapInArrow(run, flat.schema).toDF(*names)


def _clean(texts: pa.Array, automata: _Automata) -> pa.Array:
    lines = _lines(translated(texts, ALNUM).to_pylist())
    good = [True] * len(lines)
    for automaton in automata:
        good = [g and next(automaton.iter(line), None) is None for g, line in zip(good, lines)]
    return pa.array(good, pa.bool_())

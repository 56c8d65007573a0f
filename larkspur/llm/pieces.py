"""SentencePiece encoding and decoding by a shared-prefix forward pass.

Texts are cut into marked words; the distinct words, sorted, spell a trie that
is walked depth-first, and the forward states of a common prefix are computed
once.  For unigram models a state is Viterbi's best score.  For BPE models
(whose scores are merge ranks, so that the best sum is not what the merges
give) the state is the last piece of the prefix's own encoding: a run of pieces
is the encoding of its text exactly if each two neighbours are that of theirs,
so each prefix has one last piece, found from shorter prefixes.  Both give what
the model's own encoder gives.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import slices, translated

MARK = "▁"
UNITS = re.compile(f"{MARK}+[^{MARK}]*")
#: Encoded words, and judged neighbours, that a worker remembers between batches.
REMEMBERED = 100_000
FITS = 400_000
#: Bytes of text at once: ids take some ten times as much while they are put in place.
TEXT_BYTES = 2_000_000
_SAME = bytes(range(256))
_UNKNOWN = -1


class Pieces:
    """A model's vocabulary with its forward pass."""

    def __init__(self, model: bytes, kind: str = "bpe"):
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"kind is bpe or unigram, not {kind}")
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.kind, size = kind, own.get_piece_size()
        self.text = [own.id_to_piece(i) for i in range(size)]
        self.score = [own.get_score(i) for i in range(size)]
        plain = [i for i in range(size) if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i) or own.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if own.is_byte(i)}
        self.unk = own.unk_id()
        self.worst = min((self.score[i] for i in plain), default=0.0) - 10.0
        #: each ending of a piece, with the piece's id where it is one itself
        self.tails: dict[str, int] = {}
        for i in plain:
            for k in range(len(self.text[i])):
                self.tails.setdefault(self.text[i][k:], _UNKNOWN)
        self.tails.update(self.id)
        self.fits: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}
        out = [b" \xe2\x81\x87 " if i == self.unk else b"" for i in range(size)]
        for i in plain:
            out[i] = self.text[i].replace(MARK, " ").encode()
        for b, i in self.byte.items():
            out[i] = bytes([b])
        self.lengths = np.array([len(x) for x in out], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        self.marked = np.array([self.text[i].startswith(MARK) and i in set_ for set_ in [set(plain)] for i in range(size)])

    def merged(self, text: str) -> list[int]:
        """BPE by its definition: merge the neighbours of best score, leftmost
        first, while any two make a piece.  For short texts."""
        parts = list(text)
        while True:
            best = max(((self.score[self.id[a + b]], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.id), default=None)
            if best is None:
                return [self.id.get(p, _UNKNOWN) for p in parts]
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _fit(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``before`` (unknown: a hard edge)."""
        key = (before + 1) << 32 | piece
        if key not in self.fits:
            if len(self.fits) >= FITS:
                self.fits.clear()
            if before == _UNKNOWN:
                self.fits[key] = self.merged(self.text[piece]) == [piece]
            else:
                self.fits[key] = self.merged(self.text[before] + self.text[piece]) == [before, piece]
        return self.fits[key]

    def _forward_bpe(self, word: str, i: int, last: list[int]) -> None:
        tails, fits = self.tails, self.fits
        j = i - 1
        while j >= 0:
            piece = tails.get(word[j:i])
            if piece is None:
                break
            if piece >= 0:
                before = last[j]
                good = fits.get((before + 1) << 32 | piece)
                if good is None:
                    good = self._fit(before, piece)
                if good:
                    last[i] = piece
                    return
            j -= 1
        last[i] = _UNKNOWN

    def _forward_unigram(self, word: str, i: int, last: list[int], best: list[float]) -> None:
        last[i], best[i] = _UNKNOWN, best[i - 1] + self.worst
        j = i - 1
        while j >= 0:
            piece = self.tails.get(word[j:i])
            if piece is None:
                break
            if piece >= 0 and best[j] + self.score[piece] > best[i]:
                last[i], best[i] = piece, best[j] + self.score[piece]
            j -= 1

    def encode_words(self, distinct: list[str]) -> list[list[int]]:
        """Ids of each word, in the order given."""
        found = {}
        last, best, before = [_UNKNOWN], [0.0], ""
        bpe = self.kind == "bpe"
        for word in sorted(w for w in distinct if w not in self.known):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            if len(word) >= len(last):
                last.extend([_UNKNOWN] * (len(word) - len(last) + 1))
                best.extend([0.0] * (len(word) - len(best) + 1))
            for i in range(shared + 1, len(word) + 1):
                if bpe:
                    self._forward_bpe(word, i, last)
                else:
                    self._forward_unigram(word, i, last, best)
            before = word
            ids, i = [], len(word)
            while i:
                piece = last[i]
                if piece == _UNKNOWN:
                    ids.extend(self._fallback(word[i - 1]))
                    i -= 1
                else:
                    ids.append(piece)
                    i -= len(self.text[piece])
            ids.reverse()
            found[word] = ids
        known = self.known
        out = [known[w] if w in known else found[w] for w in distinct]
        for w, ids in found.items():
            if len(known) >= REMEMBERED:
                break
            if len(w) <= 32:
                known[w] = ids
        return out

    def _fallback(self, char: str) -> list[int]:
        """Backwards: the bytes of an unknown character, or the unknown id."""
        return [self.byte[b] for b in reversed(char.encode())] if self.byte else [self.unk]


def _spread(starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions of the runs (starts, lengths) that ``codes`` name, in order."""
    own = lengths[codes]
    return np.repeat(starts[codes] - (np.cumsum(own) - own), own) + np.arange(own.sum())


def _lists(pieces: Pieces, codes: np.ndarray, distinct: list[str], counts: np.ndarray) -> pa.ListArray:
    ids = pieces.encode_words(distinct)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
    values = flat[_spread(np.cumsum(lengths) - lengths, lengths, codes)] if len(codes) else flat[:0]
    ends = np.concatenate([[0], np.cumsum(lengths[codes])])[np.concatenate([[0], np.cumsum(counts)])] if len(codes) else np.zeros(len(counts) + 1)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def encode_texts(pieces: Pieces, texts: pa.Array) -> pa.ListArray:
    flat = translated(texts, _SAME)
    odd = pc.or_(pc.or_(pc.match_substring(flat, b"  "), pc.match_substring(flat, MARK.encode())), pc.or_(pc.starts_with(flat, b" "), pc.ends_with(flat, b" ")))
    odd = pc.or_(odd, pc.equal(pc.binary_length(flat), 0)).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(flat.filter(pa.array(~odd)), b" ")
    coded = parts.flatten().dictionary_encode()
    easy = _lists(pieces, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [MARK + w.decode() for w in coded.dictionary.to_pylist()], np.diff(parts.offsets.to_numpy()))
    if not odd.any():
        return easy
    place: dict[str, int] = {}
    codes, counts = [], []
    for raw in flat.filter(pa.array(odd)).to_pylist():
        units = UNITS.findall(MARK + raw.decode().replace(" ", MARK)) if raw else []
        codes.extend(place.setdefault(u, len(place)) for u in units)
        counts.append(len(units))
    hard = _lists(pieces, np.array(codes, np.int64), list(place), np.array(counts, np.int64))
    order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    return pa.concat_arrays([easy, hard]).take(pa.array(np.argsort(order)))


def decode_ids(pieces: Pieces, lists: pa.Array) -> pa.Array:
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    heads = np.concatenate([[0], np.cumsum(counts)])
    flat = pieces.bytes[_spread(pieces.starts, pieces.lengths, ids)] if len(ids) else np.zeros(0, np.uint8)
    ends = np.concatenate([[0], np.cumsum(pieces.lengths[ids])])[heads] if len(ids) else np.zeros(len(heads), np.int64)
    some = counts > 0
    marked = np.zeros(len(counts), bool)
    marked[some] = pieces.marked[ids[heads[:-1][some]]]
    keep = np.ones(len(flat), bool)
    keep[ends[:-1][marked]] = False  # the mark before the first word
    ends = ends - np.concatenate([[0], np.cumsum(marked)])
    raw = flat[keep].tobytes()
    try:
        raw.decode()
        return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw))
    except UnicodeDecodeError:
        return pa.array([raw[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:])], pa.large_string())


def _pieces(shared, kind: str) -> Pieces:
    """One per worker, so that remembered words serve many batches.  It lies
    beside the broadcast's value and goes with it: a worker outlives the query."""
    made = shared.__dict__.setdefault("_pieces", {})
    if kind not in made:
        made[kind] = Pieces(shared.value, kind)
    return made[kind]


def _map(shared, kind, column, out, work):
    def run(batches):
        pieces = _pieces(shared, kind)
        for batch in batches:
            for part in slices(batch, column, TEXT_BYTES) if column == "text" else _runs(batch):
                new = work(pieces, part.column(column))
                yield pa.RecordBatch.from_arrays([*part.columns, new], [*part.schema.names, out])

    return run


def _runs(batch: pa.RecordBatch, rows: int = 256):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def load(spark, model_path: str):
    """The model file, read by the driver and shipped (its size is that of a
    vocabulary, fixed for all inputs)."""
    with open(model_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", kind: str = "bpe") -> DataFrame:
    """(id, text, ids) for each row of ``docs``.  Null and empty texts have no
    ids; characters beyond the vocabulary become bytes; repeated rows and null
    ids are rows like others.  Other columns are not read."""
    shared = load(docs.sparkSession, model_path)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = dict(docs.dtypes)[id_col]
    out = source.mapInArrow(_map(shared, kind, "text", "ids", encode_texts), f"id {id_type}, text string, ids array<int>")
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "ids")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", kind: str = "bpe") -> DataFrame:
    """(id, ids, same) for each row of ``docs``: ``encode`` and ``decode`` in
    one pass, and whether the ids give the text back (null as empty)."""
    shared = load(docs.sparkSession, model_path)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        pieces = _pieces(shared, kind)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                ids = encode_texts(pieces, part.column("text"))
                same = pc.equal(decode_ids(pieces, ids), pc.fill_null(part.column("text"), "").cast(pa.large_string()))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, same], ["id", "ids", "same"])

    return source.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, ids array<int>, same boolean").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded", kind: str = "bpe") -> DataFrame:
    """All columns of ``encoded`` and the text of its ids.  Null or empty lists
    give an empty text; bytes that are no UTF-8 become replacement characters;
    ids outside the vocabulary raise."""
    shared = load(encoded.sparkSession, model_path)
    names, at = encoded.columns, encoded.columns.index(ids_col)
    flat = encoded.toDF(*["ids" if i == at else f"c{i}" for i in range(len(names))])
    schema = T.StructType([*flat.schema.fields, T.StructField("out", T.StringType())])
    return flat.mapInArrow(_map(shared, kind, "ids", "out", decode_ids), schema).toDF(*names, out_col)

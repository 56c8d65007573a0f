"""Katz back-off language model: Good-Turing discounted n-gram counts with
exactly normalised back-off weights.

Texts become blocks of token codes, dealt out by block.  For each order in
turn, blocks ask the partitions of that order's table and get answers in the
same order:

* words, partitioned by word: a block sends its distinct words with their
  training counts and gets each word's dense id and corpus count;
* n-grams, partitioned by history: a block sends its distinct n-grams with
  their training counts and gets each one's corpus count and the history's
  denominator and back-off weight.  A history's count is the corpus count of
  the shorter n-gram that the order before told.  That order also tells which
  n-grams no other block holds: what follows these is all in the block, which
  counts it by itself and sends only its counts of counts.

Then each token's probability is evaluated by the recursion
P(w|h) = d(c) c(h,w) / c(h) if c(h,w) > 0, else a(h) P(w|h'), where h' is h
without its first word, down to P(w), which backs off to the mass of unseen
words.  Every history that occurs in training is modelled; one that does not
has the probabilities of its shorter history, which is what the recursion says.

Everything that crosses the network is counted once per block, so frequent
n-grams cost a row for each block and not for each occurrence.  Histories that
hold more than a share of a partition are split over several partitions by
their last word; their totals (a bounded number: they are frequent) meet in the
driver.  The number of partitions grows with the bytes of text.

The work per partition is array work on blocks, so this operator uses pair
RDDs: blocks, answers and tables share partitioners, and a shuffle's files serve
several jobs.  Answers are checkpointed in the shared folder, so a lost
executor's part is read again, and the requests' files can go.
"""

from __future__ import annotations

import gc
import pickle
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, partitions, shared_dir, written
from .text import SPACED, gathered, lean, mix, roomy, slices, word_hashes, words

#: Good-Turing discounts apply to counts up to this one.
CUTOFF = 5
#: The end of a text, as a hash that stands beside the words' hashes.
END = np.uint64(0x6A09E667F3BCC908)
BLOCK_BYTES = 9_000_000
#: The model's order in ``score`` and ``fit``, and how often a modelled history of two and more words occurs at least: all that occur.
ORDER, LEAST = 3, 1
#: Bytes of text for each partition: a 4000th of all, within these bounds.
PART_BYTES = (32_000_000, 256_000_000)
#: Parts of the n-gram tables in each partition; one is in memory at a time.
PARTS = 2


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(*values) -> bytes:
    return _ZIP.compress(pickle.dumps(values, protocol=5))


class _Planes:
    """An array of whole numbers with its first bytes first, then its second
    ones: small numbers pack better so."""

    def __init__(self, x: np.ndarray):
        self.kind, self.raw = x.dtype.str, x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()

    def array(self) -> np.ndarray:
        width = np.dtype(self.kind).itemsize
        return np.frombuffer(self.raw, np.uint8).reshape(width, -1).T.copy().view(self.kind).reshape(-1)


def _unpack(blob: bytes):
    return pickle.loads(_UNZIP.decompress(blob))


def _small(x: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    return (mix(x.astype(np.uint64) * _STEP + np.uint64(7)) % np.uint64(n)).astype(np.int64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct key, by key; the number of each key)."""
    order = np.argsort(keys)
    found = keys[order]
    new = np.concatenate([[True], found[1:] != found[:-1]])[: len(found)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def by_bucket(bucket: int) -> int:
    """Buckets go round the partitions in turn."""
    return bucket


def discounts(n: list[int]) -> np.ndarray:
    """Katz's discount ratios d(1..CUTOFF) from counts of counts n[r] (r from 1
    to CUTOFF + 1).  Where Good-Turing gives no ratio within (0, 1), half a
    count is taken off instead."""
    out = np.ones(CUTOFF + 1)
    tail = (CUTOFF + 1) * n[CUTOFF + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUTOFF + 1):
        d = 0.0
        if n[r] and n[r + 1] and tail < 1:
            d = ((r + 1) * n[r + 1] / (n[r] * r) - tail) / (1 - tail)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts > CUTOFF, 1.0, d[np.minimum(counts, CUTOFF)]) * counts


class Unigrams:
    """Word probabilities from the totals of the unigram table."""

    def __init__(self, tokens: int, types: int, texts: int, counts_of_counts: list[int]):
        self.tokens, self.types, self.texts = tokens, types, texts
        self.d = discounts(counts_of_counts)
        kept = tokens - sum(n * r * (1 - self.d[r]) for r, n in enumerate(counts_of_counts[: CUTOFF + 1]))
        # without any discounted word half a count is left to the unseen
        self.total = float(tokens) if tokens - kept > 0.25 else kept + 0.5
        self.unseen = (self.total - kept) / self.total if self.total else 1.0

    def prob(self, counts: np.ndarray) -> np.ndarray:
        """P(w) of words by count; count 0 is the class of all unseen words."""
        return np.where(counts > 0, _discounted(counts, self.d) / max(self.total, 1.0), self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of add-half estimates over the types and one unseen class."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def salts(self, counts: np.ndarray, buckets: int) -> np.ndarray:
        """Partitions over which a history of this count is spread."""
        return np.maximum(1, np.ceil(counts * (4.0 * buckets) / max(self.tokens, 1))).astype(np.int64).clip(1, buckets)


def _block_batches(batches):
    task, k = TaskContext.get().partitionId(), 0
    for batch in gathered(batches, "text", BLOCK_BYTES):
        for part in slices(batch, "text", BLOCK_BYTES):
            codes, distinct, counts = words(part.column("text"), SPACED)
            hashes = np.concatenate([word_hashes(distinct), [END]])
            codes = np.insert(codes, np.cumsum(counts), len(distinct))  # each text's end is a token
            held = part.column("held").to_numpy(zero_copy_only=False)
            blob = _pack(part.column("id").to_pylist(), held, counts + 1, hashes, _Planes(_small(codes)))
            yield pa.RecordBatch.from_arrays([pa.array([task << 24 | k], pa.int64()), pa.array([blob], pa.binary())], ["block", "blob"])
            k += 1


class _Block:
    def __init__(self, blob: bytes):
        self.ids, self.held, self.lengths, self.hashes, codes = _unpack(blob)
        self.codes = codes.array().astype(np.int64)
        self.train = np.repeat(~self.held, self.lengths)
        self.first = np.cumsum(self.lengths) - self.lengths

    def words(self, buckets: int):
        """(order, bounds): the block's words by bucket."""
        at = _spread(self.hashes, buckets).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(at, kind="stable")
        return order, np.searchsorted(at[order], np.arange(buckets + 1))

    def known(self, answers: dict[int, bytes], buckets: int):
        """Ids and corpus counts of the block's words from the answers."""
        order, bounds = self.words(buckets)
        ids, counts = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            i, c = _unpack(answers[b])
            mine = order[bounds[b] : bounds[b + 1]]
            ids[mine], counts[mine] = i, c
        return ids, counts


class _Asked:
    """The distinct n-grams of one order that a block asks for, by bucket and
    history: ``at`` the tokens that end one, ``number`` which one each ends,
    ``end`` a token that ends it, ``count`` its history's count, ``lead`` where
    histories begin, ``names`` these histories' word ids, ``bounds`` where
    buckets begin among n-grams and ``leads`` among histories.  After the last
    bucket come the histories that no other block holds; they are not sent."""


def _shifted(x: np.ndarray, first: np.ndarray, value: int) -> np.ndarray:
    """The value of the token before; ``value`` before a text's first."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = value
    return out


class _Grams:
    """The n-grams of a block, one order after the other; at each, of every
    token: the number of its n-gram, its count, its history's denominator,
    whether no other block holds it, and the log10 probability so far."""

    def __init__(self, block: _Block, ids: np.ndarray, counts: np.ndarray, model: Unigrams):
        self.block, self.ids, self.model, self.order = block, ids, model, 1
        self.place = np.arange(len(block.codes)) - np.repeat(block.first, block.lengths)
        self.number, self.count, self.below, self.alone, self.d = block.codes, counts[block.codes], None, None, None
        self.logs = np.log10(model.prob(counts))[block.codes]

    def _words(self, end: np.ndarray, back: int) -> np.ndarray:
        """Ids of the words so many tokens before; a text's start beyond it."""
        found = self.ids[self.block.codes[np.maximum(end - back, 0)]]
        return np.where(self.place[end] >= back, found, self.model.types + 1)

    def asked(self, buckets: int) -> _Asked:
        k, own, out = self.order + 1, self.block, _Asked()
        width = len(own.hashes) + 1  # the last code is the start of a text
        if k == 2:
            count, history = _shifted(self.count, own.first, self.model.texts), _shifted(self.number, own.first, width - 1)
            at, codes = slice(None), own.codes  # a history that never occurs backs off with weight one
        else:
            at = np.flatnonzero(_shifted(self.count, own.first, 0) >= LEAST)
            history, count, codes = self.number[at - 1], self.count[at - 1], own.codes[at]
        first, number = _distinct(history * width + codes)
        end, history, count = first if k == 2 else at[first], history[first], count[first]
        lead = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]])[: len(history)])
        runs = np.diff(np.concatenate([lead, [len(history)]]))
        names = [self._words(end[lead], i) for i in range(k - 1, 0, -1)]
        hashed = np.zeros(len(lead), np.uint64)
        for w in names:
            hashed = mix(hashed * _STEP + w.astype(np.uint64))
        bucket = np.repeat(_spread(hashed, buckets).astype(np.uint16 if buckets + 1 < 1 << 16 else np.int64), runs)
        wide = np.flatnonzero(self.model.salts(count[lead], buckets) > 1)
        if len(wide):
            some = np.repeat(lead[wide], runs[wide]) + np.arange(runs[wide].sum()) - np.repeat(np.cumsum(runs[wide]) - runs[wide], runs[wide])
            salt = _spread(self._words(end[some], 0) + 1, 1 << 30) % self.model.salts(count[some], buckets)
            bucket[some] = (bucket[some] + salt) % buckets
        if self.alone is not None:
            bucket = np.where(self.alone[end - 1], buckets, bucket)
        order = np.argsort(bucket, kind="stable")
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        bucket, run = bucket[order], np.repeat(np.arange(len(lead)), runs)[order]
        out.at, out.number, out.end, out.count = at, where[number], end[order], count[order]
        out.lead = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (run[1:] != run[:-1])])[: len(bucket)])
        out.names = [w[run[out.lead]] for w in names]
        out.bounds = np.searchsorted(bucket, np.arange(buckets + 2))
        out.leads = np.searchsorted(out.lead, out.bounds)
        return out

    def trained(self, asked: _Asked) -> np.ndarray:
        return np.bincount(asked.number[self.block.train[asked.at]], minlength=len(asked.end))

    def answered(self, asked: _Asked, answers: dict[int, bytes], d: np.ndarray, last: bool = False) -> None:
        got, below, weight = (np.zeros(len(asked.end), kind) for kind in (np.int64, np.float64, np.float64))
        alone = np.zeros(len(asked.end), bool)
        for b in np.flatnonzero(np.diff(asked.bounds[:-1])).tolist():
            total, extra, weights, bits = _unpack(answers[b])
            s, lead = slice(asked.bounds[b], asked.bounds[b + 1]), asked.lead[asked.leads[b] : asked.leads[b + 1]]
            runs = np.diff(np.concatenate([lead, [s.stop]]))
            got[s] = total
            below[s] = asked.count[s] + np.repeat(extra, runs)
            backs_off = np.add.reduceat((total == 0).astype(np.int64), lead - s.start) > 0
            of_history = np.ones(len(lead))
            of_history[backs_off] = weights
            weight[s] = np.repeat(of_history, runs)
            if bits is not None:
                alone[s] = np.unpackbits(bits, count=len(total))
        s, lead = slice(*asked.bounds[-2:]), asked.lead[asked.leads[-2] :]
        if len(lead):
            total, end, runs = self.trained(asked)[s], asked.end[s], np.diff(np.concatenate([lead, [s.stop]]))
            shorter = _discounted(self.count[end], self.d) / np.maximum(self.below[end], 1)
            under, of_history = _backoff(asked.count[lead], *_totals(total, shorter, lead - s.start), d)
            got[s], below[s], weight[s], alone[s] = total, np.repeat(under, runs), np.repeat(of_history, runs), total > 0
        self.d = d
        seen = got > 0
        log = np.log10(np.where(seen, _discounted(got, d) / np.maximum(below, 1), np.maximum(weight, 1e-300)))
        kept = np.where(seen, 0.0, 1.0)
        self.logs[asked.at] = log[asked.number] + kept[asked.number] * self.logs[asked.at]
        self.order += 1
        if not last and self.order == 2:
            self.number, self.count, self.below, self.alone = asked.number, got[asked.number], below[asked.number], alone[asked.number]
        elif not last:
            n = len(self.block.codes)
            self.number, self.count, self.below, self.alone = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
            self.number[asked.at], self.count[asked.at], self.below[asked.at] = asked.number, got[asked.number], below[asked.number]
            self.alone[asked.at] = alone[asked.number]


def _word_requests(buckets: int):
    def run(rows):
        for block, blob in rows:
            own = _Block(blob)
            seen = np.bincount(own.codes[own.train], minlength=len(own.hashes))
            order, bounds = own.words(buckets)
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                mine = order[bounds[b] : bounds[b + 1]]
                yield b, (block, _pack(own.hashes[mine], _small(seen[mine])))

    return run


def _by_part(rows, histograms: list | None = None):
    """(bucket, its requests) of a partition, unpacked one bucket at a time.
    The counts of counts that blocks made by themselves go to ``histograms``."""
    per = defaultdict(list)
    for b, (block, blob) in rows:
        if isinstance(blob, bytes):
            per[b].append((block, blob))
        elif histograms is not None:
            histograms.append(blob)
    while per:
        b, packed = per.popitem()
        yield b, [(block, *_unpack(blob)) for block, blob in packed]
        lean()


def _sum_words(asked) -> tuple[np.ndarray, np.ndarray]:
    """The words seen in training among the requests, and their counts."""
    keys, inverse = np.unique(np.concatenate([x[1] for x in asked]), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([x[2] for x in asked]).astype(np.float64), len(keys)).astype(np.int64)
    return keys[total > 0], total[total > 0]


def _histogram(counts: np.ndarray) -> np.ndarray:
    return np.bincount(counts[counts <= CUTOFF + 1], minlength=CUTOFF + 2)


def _word_totals(rows):
    for b, asked in _by_part(rows):
        keys, counts = _sum_words(asked)
        yield b, len(keys), int(counts.sum()), _histogram(counts).tolist()


def _word_answers(first_id, unseen: int):
    def run(rows):
        for b, asked in _by_part(rows):
            keys, counts = _sum_words(asked)
            for block, hashes, _ in asked:
                at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
                known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                ids = np.where(known, first_id.value[b] + at, unseen)
                yield block, (1, b, _pack(_small(ids), _small(np.where(known, counts[at] if len(keys) else 0, 0))))

    return run


def _grouped(rows):
    """The rows of a partition by block: payload, and answers by order."""
    roomy()
    out = defaultdict(lambda: [None, defaultdict(dict)])
    for block, x in rows:
        if isinstance(x, tuple):
            out[block][1][x[0]][x[1]] = x[2]
        else:
            out[block][0] = x
    while out:
        block, (blob, answers) = out.popitem()
        yield block, _Block(blob), answers
        lean()


def _told(own: _Block, answers: dict, model: Unigrams, buckets: int, ds: list, last: bool = False) -> tuple[_Grams, np.ndarray]:
    """The block's n-grams with the answers of all orders so far, and its
    words' counts."""
    ids, counts = own.known(answers[1], buckets)
    grams = _Grams(own, ids, counts, model)
    for k, d in enumerate(ds, 2):
        grams.answered(grams.asked(buckets), answers[k], d, last and k == len(ds) + 1)
    return grams, counts


def _gram_requests(model: Unigrams, buckets: int, ds: list):
    """What blocks ask of the order after ``ds``: by bucket, histories with
    their counts, denominators and runs, then words, counts of the shorter
    n-grams and training counts.  One bucket also gets the counts of counts, as
    a list, of what the block counts by itself."""

    def run(rows):
        for block, own, answers in _grouped(rows):
            grams, _ = _told(own, answers, model, buckets, ds)
            x = grams.asked(buckets)
            trained, last, low = grams.trained(x), grams.ids[own.codes[x.end]], grams.count[x.end]
            alone = trained[x.bounds[-2] :]
            if len(alone):
                yield block % buckets, (block, _histogram(alone[alone > 0]).tolist())
            for b in np.flatnonzero(np.diff(x.bounds[:-1])).tolist():
                s, lead = slice(x.bounds[b], x.bounds[b + 1]), x.lead[x.leads[b] : x.leads[b + 1]]
                runs = np.diff(np.concatenate([lead, [s.stop]]))
                history = [_Planes(_small(w[x.leads[b] : x.leads[b + 1]])) for w in x.names]
                below = None if grams.below is None else _Planes(_small(grams.below[x.end[lead]]))
                yield b, (block, _pack(history, _small(x.count[lead]), below, _small(runs), _Planes(_small(last[s])), _Planes(_small(low[s])), _small(trained[s])))

    return run


def _totals(total: np.ndarray, shorter: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the histories that begin at ``first``: types of counts up to the
    cutoff, and mass of their seen words in the shorter order."""
    types = np.stack([np.add.reduceat((total == r).astype(np.int64), first) for r in range(1, CUTOFF + 1)], axis=1)
    return types, np.add.reduceat(np.where(total > 0, shorter, 0.0), first)


class _Table:
    """One bucket of an order's table, from the requests: ``asked`` the blocks'
    own, ``place`` where each request's n-gram is, ``total`` counts, ``words``
    ids, ``history`` the row of each one's history; of histories ``first`` their
    first n-gram, ``count``, ``types`` of counts up to the cutoff, and ``mass``
    of their seen words in the shorter order."""

    def __init__(self, asked, model: Unigrams, d_low):
        self.asked = asked
        runs = np.concatenate([x[4] for x in asked]).astype(np.int64)
        heads = [np.concatenate([x[1][i].array() for x in asked]).astype(np.int64) for i in range(len(asked[0][1]))]
        last = np.concatenate([x[5].array() for x in asked]).astype(np.int64)
        width = model.types + 2
        key = heads[0]
        for w in heads[1:]:
            key = _distinct(key)[1] * width + w
        of_run = _distinct(key)[1]
        first, self.place = _distinct(np.repeat(of_run, runs) * width + last)
        trained = np.concatenate([x[7] for x in asked]).astype(np.float64)
        self.total = np.bincount(self.place, trained, len(first)).astype(np.int64)
        run_of = np.repeat(np.arange(len(runs)), runs)[first]
        number = of_run[run_of]
        self.first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        self.history = np.repeat(np.arange(len(self.first)), np.diff(np.concatenate([self.first, [len(number)]])))
        self.words = [*(w[run_of] for w in heads), last[first]]
        self.count = np.concatenate([x[2] for x in asked]).astype(np.int64)[run_of[self.first]]
        low = np.concatenate([x[6].array() for x in asked]).astype(np.int64)[first]
        if asked[0][3] is None:
            shorter = model.prob(low)
        else:
            shorter = _discounted(low, d_low) / np.maximum(np.concatenate([x[3].array() for x in asked]).astype(np.float64)[run_of], 1)
        self.types, self.mass = _totals(self.total, shorter, self.first)

    def names(self, some) -> list[tuple]:
        return list(zip(*(w[self.first[some]].tolist() for w in self.words[:-1])))

    def share(self, model: Unigrams, buckets: int, hot) -> None:
        """Histories that lie in several buckets get their whole totals."""
        some = np.flatnonzero(model.salts(self.count, buckets) > 1)
        for i, name in zip(some.tolist(), self.names(some)):
            self.types[i], self.mass[i] = hot.value[name]


def _tables(rows, model: Unigrams, d_low, histograms: list | None = None):
    for b, asked in _by_part(rows, histograms):
        yield b, _Table(asked, model, d_low)


def _gram_totals(model: Unigrams, buckets: int, d_low):
    def run(rows):
        histograms = []
        for _, t in _tables(rows, model, d_low, histograms):
            some = np.flatnonzero(model.salts(t.count, buckets) > 1)
            yield _histogram(t.total[t.total > 0]).tolist(), list(zip(t.names(some), t.types[some].tolist(), t.mass[some].tolist()))
        if histograms:
            yield np.sum(histograms, axis=0).tolist(), []

    return run


def _backoff(counts, types, mass, d):
    """(denominator, weight) of histories.  A history without discounted mass
    gets one more count in its denominator, so that unseen words keep some."""
    freed = (types * np.arange(1, CUTOFF + 1) * (1 - d[1:])).sum(axis=-1)
    below = counts + np.where(freed > 1e-9, 0.0, 1.0)
    freed = np.where(freed > 1e-9, freed, 1.0)
    return below, freed / below / np.maximum(1 - mass, 1e-300)


def _gram_answers(order: int, model: Unigrams, buckets: int, d_low, d: np.ndarray, hot, tell: bool):
    """The answers; ``tell`` adds a bit for each n-gram of the training texts
    that only one block holds."""

    def run(rows):
        for b, t in _tables(rows, model, d_low):
            t.share(model, buckets, hot)
            below, weight = _backoff(t.count, t.types, t.mass, d)
            alone = (np.bincount(t.place, minlength=len(t.total)) == 1) & (t.total > 0)
            extra = (below - t.count).astype(np.uint8)
            done = 0
            for block, _, _, _, runs, *_ in t.asked:
                n = int(runs.sum())
                mine = t.place[done : done + n]
                done += n
                first = np.cumsum(runs.astype(np.int64)) - runs
                heads, got = t.history[mine[first]], t.total[mine]
                backs_off = np.add.reduceat((got == 0).astype(np.int64), first) > 0
                yield block, (order, b, _pack(_small(got), extra[heads], weight[heads[backs_off]], np.packbits(alone[mine]) if tell else None))

    return run


def _scores(model: Unigrams, buckets: int, ds: list):
    def run(rows):
        for _, own, answers in _grouped(rows):
            grams, counts = _told(own, answers, model, buckets, ds, last=True)
            total, base = np.add.reduceat(grams.logs, own.first), np.add.reduceat(model.base(counts)[own.codes], own.first)
            known = np.add.reduceat((counts > 0).astype(np.int64)[own.codes], own.first)
            yield from zip(own.ids, own.held.tolist(), own.lengths.tolist(), known.tolist(), [model.tokens] * len(own.ids), base.tolist(), total.tolist())

    return run


class _Fit:
    """The blocks, the tables' partitions and the totals of one corpus."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, held_out, order: int, keep: bool = False):
        if order < 2:
            raise ValueError("a back-off model has an order of two at least")
        spark = docs.sparkSession
        self.sc = sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(shared_dir(spark))
        held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
        source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held"))
        size, texts = source.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held"))).first()
        part = min(max((size or 0) // 4000, PART_BYTES[0]), PART_BYTES[1])
        self.n = n = max(partitions(spark), -(-(size or 0) // part))
        self.buckets = buckets = PARTS * n
        tokens = source.mapInArrow(_block_batches, "block bigint, blob binary").rdd
        tasks = max(tokens.getNumPartitions(), 1)

        def by_block(block: int) -> int:
            """A task's blocks go to partitions of their own, evenly."""
            return (block >> 24) * n // tasks + (block & 0xFFFFFF)

        self.by_block = by_block
        self.blocks = tokens.map(lambda r: (r.block, bytes(r.blob))).partitionBy(n, by_block)
        self.told, self.ds, self.hot, self.tables = [], [], [], []
        words = self.blocks.mapPartitions(_word_requests(buckets)).partitionBy(n, by_bucket)
        # a row for each bucket: sizes only
        totals = sorted(words.mapPartitions(_word_totals).collect())
        first, at = {}, 0
        for b, types, *_ in totals:
            first[b] = at
            at += types
        self.model = model = Unigrams(sum(t[2] for t in totals), at, texts, np.sum([t[3] for t in totals], axis=0).tolist() if totals else [0] * (CUTOFF + 2))
        self.first_id = sc.broadcast(first)
        self.tables.append(words)
        self._answer(words.mapPartitions(_word_answers(self.first_id, model.types)))
        del words
        for k in range(2, order + 1):
            if not keep:
                self.settle()
            low = self.ds[-1] if self.ds else None
            asked = self.whole().mapPartitions(_gram_requests(model, buckets, list(self.ds))).partitionBy(n, by_bucket)
            counts, shared = np.zeros(CUTOFF + 2, np.int64), {}
            for histogram, hot in asked.mapPartitions(_gram_totals(model, buckets, low)).collect():
                counts += np.array(histogram)
                for name, types, mass in hot:
                    old = shared.get(name, (np.zeros(CUTOFF, np.int64), 0.0))
                    shared[name] = (old[0] + np.array(types), old[1] + mass)
            self.ds.append(discounts(counts.tolist()))
            self.hot.append(sc.broadcast(shared))
            self.tables.append(asked)
            tell = k < order and not keep  # tables that are kept hold all n-grams
            self._answer(asked.mapPartitions(_gram_answers(k, model, buckets, low, self.ds[-1], self.hot[-1], tell)))
            del asked

    def whole(self):
        """Blocks with the answers so far."""
        out = self.blocks
        for told in self.told:
            out = out.union(told)
        return out

    def _answer(self, rows) -> None:
        told = rows.partitionBy(self.n, self.by_block)
        told.checkpoint()
        self.told.append(told)

    def settle(self) -> None:
        """Write the last answers to the shared folder now, and let the files
        of all requests go."""
        self.told[-1]._jrdd.count()
        self.tables.clear()
        for _ in range(3):  # Spark deletes a shuffle's files soon after nothing refers to it any more
            gc.collect()
            self.sc._jvm.System.gc()
            time.sleep(0.4)

    def close(self) -> None:
        for told in self.told:
            drop_path(self.sc, told.getCheckpointFile())


def _word_rows(model: Unigrams, first_id):
    def run(rows):
        for b, asked in _by_part(rows):
            keys, counts = _sum_words(asked)
            p = np.log10(model.prob(counts))
            yield from zip([b] * len(keys), keys.view(np.int64).tolist(), range(first_id.value[b], first_id.value[b] + len(keys)), counts.tolist(), p.tolist())

    return run


def _gram_rows(model: Unigrams, buckets: int, d_low, d: np.ndarray, hot):
    def run(rows):
        for b, t in _tables(rows, model, d_low):
            t.share(model, buckets, hot)
            below, weight = _backoff(t.count, t.types, t.mass, d)
            seen = np.flatnonzero(t.total > 0)
            row = t.history[seen]
            p, back = np.log10(_discounted(t.total[seen], d) / below[row]), np.log10(weight[row])
            history = np.stack([w[seen] for w in t.words[:-1]], axis=1).tolist()
            yield from zip([b] * len(seen), history, t.words[-1][seen].tolist(), t.total[seen].tolist(), p.tolist(), back.tolist())

    return run


def fit(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", held_out=None, order: int = ORDER) -> list[DataFrame]:
    """The model as Parquet tables below ``path``, partitioned by bucket:

    * ``1-grams`` (bucket, word, id, count, log_prob): ``word`` is the xxh3
      hash of the lower-cased word (``END`` for a text's end);
    * ``2-grams`` up to ``order`` (bucket, history, id, count, log_prob,
      log_backoff): ids of the history's words and of the last one (the start of
      a text has the id beyond the unseen words'), log10 P(w|h), and the
      history's log10 back-off weight.

    Returns them by order.  Without training rows all are empty."""
    spark = docs.sparkSession
    f = _Fit(docs, id_col, text_col, held_out, order, keep=True)
    rows = [(f.tables[0].mapPartitions(_word_rows(f.model, f.first_id)), "bucket int, word bigint, id bigint, count bigint, log_prob double")]
    for low, d, hot, asked in zip([None, *f.ds], f.ds, f.hot, f.tables[1:]):
        rows.append((asked.mapPartitions(_gram_rows(f.model, f.buckets, low, d, hot)), "bucket int, history array<bigint>, id bigint, count bigint, log_prob double, log_backoff double"))
    out = []
    for k, (table, schema) in enumerate(rows, 1):
        spark.createDataFrame(table, schema, verifySchema=False).write.partitionBy("bucket").parquet(f"{path}/{k}-grams")
        out.append(spark.read.schema(schema).parquet(f"{path}/{k}-grams"))
    f.close()
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, order: int = ORDER) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Tokens are words between white space with A-Z lower-cased, then one end.
    The model learns from the rows where ``held_out`` (a Column; false if not
    given, null counts as false) is false, and scores all: ``score`` is the
    text's log10 probability by n-grams up to ``order``, ``base_score`` that of
    add-half unigrams.  Null and empty texts are their end alone; repeated rows
    and null ids are rows like others; without any training row all words are
    unseen.  Other columns are not read.  The result is a table in the shared
    folder.
    """
    f = _Fit(docs, id_col, text_col, held_out, order)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    rows = f.whole().mapPartitions(_scores(f.model, f.buckets, f.ds))
    out = written(docs.sparkSession.createDataFrame(rows, schema, verifySchema=False), "scores")
    f.close()
    return out

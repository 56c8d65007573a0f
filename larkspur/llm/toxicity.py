"""Toxicity by noisy-channel deobfuscation.

Words that look disguised (leetspeak, inserted separators, spaced letters,
repeated letters) become lattices of the characters and word boundaries that
they may stand for, and Viterbi's algorithm decodes them under a model of
words: those that the corpus holds often, or a character trigram model.
The restored words are scored by a sparse logistic model over the words and word
beginnings that labelled texts show to be toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import learn
from .common import drop, passing, written
from .text import SPACED, coded_words, mix, shingle_sets, slices

#: What a character of a disguised word may stand for, besides itself.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
JOINS = frozenset(".-_*'~,:;/\\#%&^=·​")
#: Words of the lexicon occur so often at least, and make such a share of the corpus's words: one over it bounds their number.
COMMON, SHARE = 5, 1e-5
#: Bytes of texts that are cut into words at once, and of those whose words, or features, are counted before the counts go out.
CUT_BYTES, COUNTED_BYTES, FEATURED_BYTES = 1_000_000, 16_000_000, 2_000_000
PREFIXES = (4, 5, 6, 7, 8)
REMEMBERED = 100_000
#: Near-equal texts count once: so many least hashes of three-word shingles, looked up in bands, alike in half at least.
HASHES, BAND, SHINGLE = 128, 4, 3
_RARE = "¿"


def _letter(c: str) -> str:
    return c if "a" <= c <= "z" or "ß" <= c <= "ÿ" else _RARE


class Letters:
    """A character trigram model with interpolated bigrams and unigrams, and
    a lexicon of common words."""

    #: Share of words that are drawn from the lexicon.
    KNOWN = 0.9

    def __init__(self, counts: dict[str, int], lexicon: dict[str, int] | None = None):
        lexicon = lexicon or {}
        every = sum(lexicon.values())
        self.lexicon = {w: math.log(self.KNOWN * n / every) for w, n in lexicon.items()}
        self.trie = None
        self.tri = Counter(counts)
        self.bi, self.bi_all, self.uni = Counter(), Counter(), Counter()
        for t, n in counts.items():
            self.bi_all[t[:2]] += n
            self.bi[t[1:]] += n
            self.uni[t[2]] += n
        self.first = Counter()
        for b, n in self.bi.items():
            self.first[b[0]] += n
        self.total = sum(self.uni.values())
        self.memo: dict[str, float] = {}

    def begins(self, some: str) -> bool:
        """Whether a word of the lexicon begins so."""
        if self.trie is None:
            self.trie = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for w in self.lexicon:
                self.trie.add_word(w)
        return bool(self.lexicon) and self.trie.match(some)

    def log(self, two: str, c: str) -> float:
        key = two + c
        if key not in self.memo:
            low = (self.uni[c] + 0.5) / (self.total + 40)
            mid = (self.bi[two[1] + c] + 4 * low) / (self.first[two[1]] + 4)
            self.memo[key] = math.log((self.tri[key] + 4 * mid) / (self.bi_all[two] + 4))
        return self.memo[key]


def trigrams(word: str) -> list[str]:
    padded = "^^" + "".join(map(_letter, word)) + "$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def core(word: str) -> str:
    """A word in lower case without the marks around it.  Marks that may stand
    for letters stay where they touch letters and are no run of one mark."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum() and (word[a] not in LEET or word[a + 1 : a + 2] == word[a] or b - a == 1):
        run = word[a]
        while a < b and word[a] == run:
            a += 1
    while b > a and not word[b - 1].isalnum() and (word[b - 1] != "$" and word[b - 1] != "@" or word[b - 2 : b - 1] == word[b - 1]):
        run = word[b - 1]
        while b > a and word[b - 1] == run:
            b -= 1
    return word[a:b]


_LONG = re.compile(r"([^\W\d_])\1{3,}")


def shortened(word: str) -> str:
    """Runs of a letter cut to three.  The restored word is the same: of a
    run at most two letters are best kept, and each other costs one amount."""
    return _LONG.sub(r"\1\1\1", word)


def disguised(word: str) -> bool:
    """Whether a core has letters together with other signs, or a letter three
    times in a row among others."""
    if len(word) < 3 or len(set(word)) == 1:
        return False
    letters = sum(map(str.isalpha, word))
    if letters < len(word):
        return letters >= 1 and 2 * sum(c in LEET or c in JOINS or c.isalpha() for c in word) > len(word)
    return any(word[i] == word[i + 1] == word[i + 2] for i in range(len(word) - 2))


#: A state is the last two characters of a word by trigrams, ``"="`` and what there is of a word of the lexicon, or nothing between words.
_UNKNOWN = math.log(1 - Letters.KNOWN)


def _put(new: dict, state: str, cost: float, out) -> None:
    if state not in new or cost > new[state][0]:
        new[state] = (cost, out)


def _ended(states: dict, model: Letters):
    """The best (score, output) over all states, each at the end of a word."""
    best = None
    for state, (s, out) in states.items():
        if state.startswith("="):
            if state[1:] not in model.lexicon:
                continue
            s += model.lexicon[state[1:]]
        elif state:
            s += model.log(state, "$")
        if best is None or s > best[0]:
            best = (s, out)
    return best


def _with_letter(states: dict, new: dict, o: str, cost: float, model: Letters) -> None:
    letter = _letter(o)
    for state, (s, out) in states.items():
        if state.startswith("="):
            if model.begins(state[1:] + o):
                _put(new, state + o, s + cost, (out, o))
            continue
        two, s = (state, s) if state else ("^^", s + _UNKNOWN)
        _put(new, two[1] + letter, s + cost + model.log(two, letter), (out, o))
        if not state and model.begins(o):
            _put(new, "=" + o, s - _UNKNOWN + cost, (out, o))


def decode(word: str, model: Letters, spaced: bool = False) -> list[str]:
    """The best restored words by Viterbi.  A mark may be a letter, nothing or
    the boundary of two words; where letters were ``spaced``, each gap may be
    nothing or a boundary.  No state is dropped: there are at most as many as
    pairs of the letters that signs stand for, and as the lexicon's beginnings."""
    states: dict[str, tuple] = {"": (0.0, None)}
    for i, c in enumerate(word):
        if spaced and i:
            s, out = _ended(states, model)
            states = {state: (old - 0.2, o) for state, (old, o) in states.items() if state}
            _put(states, "", s - 1.6, (out, " "))
        new: dict[str, tuple] = {}
        if c.isalpha():
            _with_letter(states, new, c, -0.05, model)
            if i and word[i - 1] == c:
                long_run = i > 1 and word[i - 2] == c or word[i + 1 : i + 2] == c
                for state, (s, out) in states.items():
                    if state:
                        _put(new, state, s - (0.2 if long_run else 3.0), out)
        else:
            for o in LEET.get(c, ""):
                _with_letter(states, new, o, -1.0, model)
            drop = 0.7 if c in JOINS else 12.0 if c in LEET else 3.0
            for state, (s, out) in states.items():
                _put(new, state, s - drop, out)
            if c not in JOINS and c not in LEET:
                _with_letter(states, new, _RARE, -3.0, model)
            if not c.isalnum():
                s, out = _ended(states, model)
                _put(new, "", s - (2.0 if c in LEET else 0.7), (out, " "))
        states = new
    out, found = _ended(states, model)[1], []
    while out:
        out, o = out
        found.append(o)
    return "".join(reversed(found)).replace(_RARE, "").split()


_RUNS = re.compile(r"[^\W\d_]{2,}")


def features_of(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]


class Restorer:
    """Words and spaced words of texts, restored."""

    def __init__(self, model: Letters):
        self.model, self.known = model, {}

    def parts(self, raw: str) -> tuple[list[str], list[str]]:
        """Restored words, and the runs of letters between marks that are none
        of them (a letter alone is left to the restored words)."""
        found = self.known.get(raw)
        if found is None:
            whole = shortened(core(raw))
            if disguised(whole):
                best = decode(whole, self.model)
                found = best, [w for w in dict.fromkeys(_RUNS.findall(whole)) if w not in best]
            else:
                found = [whole] if whole else [], []
            if len(self.known) < REMEMBERED:
                self.known[raw] = found
        return found

    def word(self, raw: str) -> str:
        return " ".join(self.parts(raw)[0])

    def block(self, texts: pa.Array):
        """(codes, restored words, row of each code, rows).  The words that
        three or more lone letters in a row hold are more words."""
        raw_codes, distinct, counts = coded_words(texts, SPACED)
        distinct = distinct.cast(pa.binary()).cast(pa.string())
        plain, odd = _by_kind(distinct)
        place: dict[str, int] = {}
        held = [[place.setdefault(w, len(plain) + len(place)) for some in self.parts(raw) for w in some] for raw in distinct.take(pa.array(odd)).to_pylist()]
        raw_row = np.repeat(np.arange(len(counts)), counts)
        # a plain word is itself, another is any number of words
        size = np.ones(len(distinct), np.int64)
        size[odd] = np.fromiter(map(len, held), np.int64, len(held))
        start = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), np.int64)
        flat[start[plain]] = np.arange(len(plain))
        flat[np.repeat(start[odd] - (np.cumsum(size[odd]) - size[odd]), size[odd]) + np.arange(size[odd].sum())] = np.fromiter(chain.from_iterable(held), np.int64)
        width = size[raw_codes]
        codes = flat[np.repeat(start[raw_codes] - (np.cumsum(width) - width), width) + np.arange(width.sum())]
        row = np.repeat(raw_row, width)
        short = np.flatnonzero(pc.utf8_length(distinct).to_numpy(zero_copy_only=False) == 1)
        lone = {k: w for k, w in zip(short.tolist(), distinct.take(pa.array(short)).to_pylist()) if w.isalpha() or w in LEET}
        extra_codes, extra_rows = [], []
        if lone:
            is_lone = np.zeros(len(distinct), bool)
            is_lone[list(lone)] = True
            at = is_lone[raw_codes]
            run = np.cumsum(_run_starts(at, raw_row))[at]
            places = np.flatnonzero(at)
            for k in np.flatnonzero(np.bincount(run) >= 3).tolist():
                some = places[np.searchsorted(run, k) : np.searchsorted(run, k, side="right")]
                for w in decode("".join(lone[c] for c in raw_codes[some].tolist()), self.model, spaced=True):
                    if len(w) > 1:  # a letter alone is a word already
                        extra_codes.append(place.setdefault(w, len(plain) + len(place)))
                        extra_rows.append(raw_row[some[0]])
        codes = np.concatenate([codes, np.array(extra_codes, np.int64)])
        row = np.concatenate([row, np.array(extra_rows, np.int64)])
        return codes, pa.concat_arrays([distinct.take(pa.array(plain)), pa.array(list(place), pa.string())]), row, len(counts)


#: Words that need no look: lower-case letters of the alphabet, none three times in a row.
_ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_ODD = f"[^{_ALPHABET}]|" + "|".join(c * 3 for c in _ALPHABET)


def _by_kind(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(places of the plain words, of the others)."""
    odd = pc.match_substring_regex(distinct, _ODD).to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(~odd), np.flatnonzero(odd)


def _run_starts(at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where runs of true begin, each within one row."""
    same = np.concatenate([[False], row[1:] == row[:-1]])[: len(at)]
    return at & ~(np.concatenate([[False], at[:-1]])[: len(at)] & same)


class ToxicModel:
    def __init__(self, letters: Letters, features: list[str], weights: np.ndarray, bias: float):
        self.letters, self.features, self.weights, self.bias = letters, features, weights, bias
        self.place = {f: i for i, f in enumerate(features)}
        self.begins = pa.array(sorted({f[1 : 1 + PREFIXES[0]] for f in features}), pa.string())
        self.restorer = Restorer(letters)

    def counts(self, texts: pa.Array):
        """(row, feature, count) triples, words of each row."""
        codes, restored, row, n = self.restorer.block(texts)
        total = np.bincount(row, minlength=n)
        # few words begin as a feature does
        near = np.flatnonzero(pc.is_in(pc.utf8_slice_codeunits(restored, 0, PREFIXES[0]), self.begins).to_numpy(zero_copy_only=False))
        held: dict[int, list[int]] = {}
        for k, w in zip(near.tolist(), restored.take(pa.array(near)).to_pylist()):
            found = [self.place[f] for f in features_of(w) if f in self.place]
            if found:
                held[k] = found
        told = np.zeros(len(restored), bool)
        told[list(held)] = True
        hit = told[codes]
        width = max(len(self.features), 1)
        keys = np.fromiter((r * width + f for c, r in zip(codes[hit].tolist(), row[hit].tolist()) for f in held[c]), np.int64)
        keys, count = np.unique(keys, return_counts=True)
        return keys // width, keys % width, count, total

    def score(self, texts: pa.Array) -> np.ndarray:
        row, feature, count, total = self.counts(texts)
        value = np.log1p(100 * count / np.maximum(total[row], 1))
        z = self.bias + np.bincount(row, value * self.weights[feature], len(total)) if len(row) else np.full(len(total), self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _counted(texts: pa.Array) -> pa.RecordBatch:
    """(raw, n) of the words of texts between spaces, without the letters that
    stand alone three or more in a row: these are words written apart."""
    codes, distinct, counts = coded_words(texts, SPACED)
    often = np.bincount(codes, minlength=len(distinct))
    at = (pc.binary_length(distinct).to_numpy(zero_copy_only=False) == 1)[codes]
    run = np.cumsum(_run_starts(at, np.repeat(np.arange(len(counts)), counts)))[at]
    apart = np.bincount(codes[at][(np.bincount(run) >= 3)[run]], minlength=len(distinct))
    return pa.RecordBatch.from_arrays([distinct.cast(pa.binary()), pa.array(often - apart)], ["raw", "n"])


def _summed(counted: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Batches of a name and counts as one, each name once."""
    coded = pa.concat_arrays([b.column(0) for b in counted]).dictionary_encode()
    at, names = coded.indices.to_numpy(), coded.dictionary
    sums = [np.zeros(len(names), c.type.to_pandas_dtype()) for c in counted[0].columns[1:]]
    for k, total in enumerate(sums, 1):
        np.add.at(total, at, np.concatenate([b.column(k).to_numpy() for b in counted]))
    return pa.RecordBatch.from_arrays([names, *map(pa.array, sums)], counted[0].schema.names)


def _word_batches(batches):
    """``_counted`` of all texts.  Few texts are cut into words at a time, since
    their words take many times as much as they do; the counts go out together."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", CUT_BYTES):
            held.append(_counted(part.column("text")))
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size >= COUNTED_BYTES:
                yield _summed(held)
                held, size = [], 0
    if held:
        yield _summed(held)


def _core_batches(batches):
    """(word, n) of the plain words among raw ones, and of others' cores."""
    for batch in batches:
        raws, counts = batch.column("raw").cast(pa.string()), batch.column("n").to_numpy()
        plain, odd = _by_kind(raws)
        found, of = [], []
        for k, raw in zip(odd.tolist(), raws.take(pa.array(odd)).to_pylist()):
            w = shortened(core(raw))
            if w.isalpha() and not disguised(w):
                found.append(w)
                of.append(k)
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([raws.take(pa.array(plain)), pa.array(found, pa.string())]), pa.array(counts[np.concatenate([plain, np.array(of, np.int64)])])], ["word", "n"])


def _trigram_batches(batches):
    """(gram, weight) of distinct words; a word weighs the root of its count."""
    total: Counter = Counter()
    for batch in batches:
        for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            for t in trigrams(w):
                total[t] += math.sqrt(n)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.float64())], ["gram", "weight"])


def letters_of(docs: DataFrame, text_col: str = "text") -> Letters:
    """The model of words of all documents.  Words are counted on the cluster;
    to the driver come trigrams (bounded by the alphabet) and the words whose
    share of all is ``SHARE`` at least (at most one over it)."""
    source = docs.select(F.col(text_col).alias("text")).mapInArrow(_word_batches, "raw binary, n bigint")
    raws = source.groupBy("raw").agg(F.sum("n").alias("n")).where("n > 0")
    counted = written(raws.mapInArrow(_core_batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    every = counted.agg(F.sum("n")).first()[0] or 0
    grams = counted.mapInArrow(_trigram_batches, "gram string, weight double").groupBy("gram").agg(F.round(F.sum("weight"), 6).alias("weight")).collect()
    lexicon = counted.where(F.col("n") >= max(COMMON, math.ceil(SHARE * every))).collect()
    drop(counted)
    return Letters({r.gram: r.weight for r in sorted(grams)}, {r.word: r.n for r in sorted(lexicon)})


def _keys(texts: pa.Array) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t or "") - (1 << 63) for t in texts.to_pylist()]


def _sketches(texts: pa.Array) -> np.ndarray:
    """The least hashes of each text's shingles; all ones where it has none."""
    hashes, offsets = shingle_sets(texts, SHINGLE)
    some = np.flatnonzero(np.diff(offsets))
    out = np.full((len(texts), HASHES), 0xFFFFFFFF, np.uint32)
    for k in range(HASHES if len(some) else 0):
        mixed = mix(hashes ^ mix(np.full(1, k + 1, np.uint64)))
        out[some, k] = np.minimum.reduceat(mixed, offsets[some]) >> np.uint64(32)
    return out


def _sketch_batches(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            sketches = [s.tobytes() for s in _sketches(part.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(_keys(part.column("text")), pa.int64()), part.column("y"), pa.array(sketches, pa.binary())], ["key", "y", "sketch"])


def shares(keys: list[int], sketches: np.ndarray) -> dict[int, float]:
    """For each key of a text one by the number of rows whose texts are near
    it, by links of at least half of the sketch."""
    above = list(range(len(keys)))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = i = above[above[i]]
        return i

    for at in range(0, HASHES, BAND):
        _, first, group = np.unique(sketches[:, at : at + BAND], axis=0, return_index=True, return_inverse=True)
        first = first[group.reshape(-1)]
        later = np.flatnonzero(first != np.arange(len(keys)))
        near = later[(sketches[later] == sketches[first[later]]).mean(axis=1) >= 0.5]
        for i, j in zip(near.tolist(), first[near].tolist()):
            above[top(i)] = top(j)
    tops = np.array([top(i) for i in range(len(keys))], np.int64)
    size = np.bincount(tops, minlength=len(keys))[tops]
    return dict(zip(keys, (1 / size).tolist()))


def _featured(part: pa.RecordBatch, restorer: Restorer, share: dict) -> pa.RecordBatch:
    """(feature, bad, good): each feature's texts of either class, near-equal ones as one."""
    codes, restored, row, n = restorer.block(part.column("text"))
    place: dict[str, int] = {}
    own = [[place.setdefault(f, len(place)) for f in features_of(w)] for w in restored.to_pylist()]
    size = np.fromiter(map(len, own), np.int64, len(own))
    flat = np.fromiter(chain.from_iterable(own), np.int64, int(size.sum()))
    start = np.cumsum(size) - size
    pairs = np.unique(codes * n + row)  # each word once a text, then each feature once a text
    word, text = pairs // max(n, 1), pairs % max(n, 1)
    width = size[word]
    at = np.repeat(start[word] - (np.cumsum(width) - width), width) + np.arange(width.sum())
    once = np.unique(flat[at] * n + np.repeat(text, width))
    y = part.column("y").to_numpy(zero_copy_only=False)
    weight = np.array([share[k][key] for k, key in zip(y.tolist(), _keys(part.column("text")))], float)
    bad, good = (np.bincount(once // max(n, 1), (weight * (y == k))[once % max(n, 1)], len(place)) for k in (1, 0))
    return pa.RecordBatch.from_arrays([pa.array(list(place), pa.string()), pa.array(bad), pa.array(good)], ["feature", "bad", "good"])


def _feature_batches(shared, shared_shares):
    def run(batches):
        restorer, share = Restorer(shared.value), shared_shares.value
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", CUT_BYTES // 2):
                held.append(_featured(part, restorer, share))
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size >= FEATURED_BYTES:
                    yield _summed(held)
                    held, size = [], 0
        if held:
            yield _summed(held)

    return run


def _count_batches(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                row, feature, count, total = model.counts(part.column("text"))
                lists = [[] for _ in range(len(total))]
                for r, f, c in zip(row.tolist(), feature.tolist(), count.tolist()):
                    lists[r].append((f, c / max(total[r], 1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.array([[f for f, _ in x] for x in lists], pa.list_(pa.int64())), pa.array([[v for _, v in x] for x in lists], pa.list_(pa.float64()))],
                    ["y", "feature", "value"],
                )

    return run


def learned(docs: DataFrame, labels: DataFrame, target: str = "toxic", id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", max_rows: int = learn.MAX_ROWS) -> ToxicModel:
    """A model of ``target`` (0 or 1) from at most ``max_rows`` labelled rows
    outside fold 0; the words and trigrams by which disguises are read come
    from all of ``docs``, without labels.  To the driver come trigram counts
    (bounded by the alphabet), the corpus's common words (bounded by their
    share), a sketch of each of the sample's texts, all features that show
    toxic texts by a z test, and the sample's counts of them.  In the test
    near-equal texts of a class count as one.  Null, empty and repeated rows
    count as they are; without labels of both classes the score is one
    constant."""
    spark = docs.sparkSession
    sample = learn.labelled_sample(docs, labels, target, id_col, text_col, label_id_col, max_rows)
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return ToxicModel(Letters({}), [], np.zeros(0), learn.logistic(np.zeros((bad + good, 0)), np.r_[np.ones(bad), np.zeros(good)])[1])
    letters = letters_of(docs, text_col)
    near = {1: [], 0: []}
    for r in sample.mapInArrow(_sketch_batches, "key bigint, y int, sketch binary").collect():
        near[r.y].append((r.key, bytes(r.sketch)))
    share, texts = {}, {}
    for k, some in near.items():
        some.sort()
        share[k] = shares([key for key, _ in some], np.frombuffer(b"".join(x for _, x in some), np.uint32).reshape(len(some), HASHES))
        texts[k] = sum(share[k][key] for key, _ in some)
    cast = spark.sparkContext.broadcast
    counted = sample.mapInArrow(_feature_batches(cast(letters), cast(share)), "feature string, bad double, good double").groupBy("feature").agg(F.round(F.sum("bad"), 6).alias("bad"), F.round(F.sum("good"), 6).alias("good"))
    spread = F.sqrt((F.col("bad") + F.col("good") + 2) / (texts[1] + texts[0]) * (1 / texts[1] + 1 / texts[0]))
    ranked = counted.withColumn("z", F.round((F.col("bad") / texts[1] - F.col("good") / texts[0]) / spread, 9)).where("bad >= 3 and z > 4").orderBy(F.desc("z"), "feature").collect()
    features = [r.feature for r in ranked]
    model = ToxicModel(letters, features, np.zeros(len(features)), 0.0)
    rows = sample.mapInArrow(_count_batches(cast(model)), "y int, feature array<bigint>, value array<double>").collect()
    rows.sort(key=lambda r: (r.y, r.feature, r.value))
    y = np.array([r.y for r in rows], float)
    row = np.repeat(np.arange(len(rows)), [len(r.feature) for r in rows])
    column = np.fromiter(chain.from_iterable(r.feature for r in rows), np.int64, len(row))
    value = np.log1p(100 * np.fromiter(chain.from_iterable(r.value for r in rows), float, len(row)))
    x = learn.Sparse(row, column, value, (len(rows), len(features)))
    weights, bias = learn.logistic(x, y, ridge=5e-5, positive=True, rounds=800)
    drop(sample)
    return ToxicModel(letters, features, weights, bias)


def _score_batches(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(model.score(part.column("text")))], ["id", "score"])

    return run


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``; null, empty and wordless texts
    score as texts without any toxic word; repeated rows and null ids stay.
    Only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_score_batches(shared), f"id {kind}, score double")
    return out.withColumnRenamed("id", id_col)


def without_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, with all columns.  Null
    and empty texts score as texts without any toxic word; rows that repeat are
    judged alike; columns may have any names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored, name = passing(docs, text_col, T.DoubleType(), lambda texts: pa.array(shared.value.score(texts)))
    return scored.where(F.col(name) < least).drop(name)

"""Words of whole columns of texts at once, in Arrow and numpy."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SPACE = frozenset([0x20, *range(0x09, 0x0E)])


def _bytes_table(is_word) -> bytes:
    lowered = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return bytes(c if is_word(c) else 0x20 for c in lowered)


#: Lower-cases A-Z and blanks white space.
SPACED = _bytes_table(lambda c: c not in _SPACE)
#: Lower-cases A-Z and blanks all but a-z, 0-9 and bytes of characters beyond ASCII.
ALNUM = _bytes_table(lambda c: c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A)


_lean: list = []


def lean() -> None:
    """Give freed memory back to the system: workers outlive their tasks, and
    several share an executor's memory."""
    if not _lean:
        try:
            libc = ctypes.CDLL(None)
            libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: arrays of a megabyte go back when freed
            _lean.append(libc.malloc_trim)
        except (AttributeError, OSError):  # another C library
            _lean.append(lambda _: None)
        pa.set_memory_pool(pa.system_memory_pool())
    _lean[0](0)


def roomy() -> None:
    """Let arrays of some megabytes reuse memory until the next ``lean``, for
    work that makes very many of them: fresh pages cost as much as the work."""
    lean()
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD, the most it may be
        libc.mallopt(-1, 512 << 20)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):  # another C library
        return


def slices(batch: pa.RecordBatch, column: str, most: int = 4_000_000):
    """The batch in runs of rows whose texts have about ``most`` bytes at most
    (a longer text makes a run of its own)."""
    lean()
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def gathered(batches, column: str, least: int):
    """Batches put together until their texts have about ``least`` bytes."""
    held, size = [], 0
    for batch in batches:
        n = pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held and size + n > least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def translated(texts: pa.Array, table: bytes) -> pa.LargeBinaryArray:
    """Texts as bytes, each byte mapped by ``table``; null becomes empty."""
    flat = pc.fill_null(texts, "").cast(pa.large_string())
    flat = pa.concat_arrays([flat])  # offsets start at this slice
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = flat.buffers()[2]
    raw = memoryview(data)[offsets[0] : offsets[-1]].tobytes().translate(table) if data is not None else b""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(flat), [None, pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(raw)])


def coded_words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes of all words in order, the distinct words, words of each text)."""
    parts = pc.split_pattern(translated(texts, table), b" ")
    flat, ends = parts.flatten(), parts.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    coded = flat.filter(real).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, np.diff(before[ends - ends[0]])


def words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """``coded_words`` with the distinct words as a list."""
    codes, distinct, counts = coded_words(texts, table)
    return codes, distinct.to_pylist(), counts


def word_hashes(distinct: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct shingles of ``size`` words,
    sorted.  A text of fewer words has its whole sequence as one shingle; one
    without words has none."""
    codes, distinct, counts = words(texts, SPACED)
    hashes = word_hashes(distinct)[codes]
    starts = np.concatenate([[0], np.cumsum(counts)])
    whole = len(hashes)
    state = np.full(max(whole - size + 1, 0), np.uint64(size))
    for k in range(size):
        state = mix(state * _STEP + hashes[k : k + len(state)])
    out, offsets = [], np.zeros(len(counts) + 1, np.int64)
    for i, n in enumerate(counts.tolist()):
        if n >= size:
            own = np.sort(state[starts[i] : starts[i] + n - size + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            one = np.array([n], np.uint64)
            for h in hashes[starts[i] : starts[i] + n]:
                one = mix(one * _STEP + h)
            own = one
        else:
            own = hashes[:0]
        out.append(own)
        offsets[i + 1] = offsets[i] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), offsets

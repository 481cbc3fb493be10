"""Vectorised primitives over UTF-8 buffers: joining texts, word hashes, shingle sets."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: The k lowest bytes of a block of eight.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: The six ASCII white-space bytes.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters, digits and every byte of a non-ASCII character make words here; the rest separates.
NOT_ALNUM = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    NOT_ALNUM[_a:_b] = False


#: Rows of an Arrow batch of texts, where the session keeps Spark's default; rows are some kilobytes each, and batches stand in memory several times.
BATCH_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few rows, unless the session has a setting of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


#: Only glibc has it; other allocators give pages back by themselves.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers from one query to the next, and what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


Kernel = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def giving_back(run: Kernel) -> Kernel:
    """A kernel for ``mapInArrow`` that gives freed memory back after every batch and at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                give_back()

        yield from run(each())
        give_back()

    return whole


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Split rows into runs of at most ``limit`` bytes, a larger row alone."""
    i, n = 0, len(sizes)
    ends = np.cumsum(sizes)
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield i, j
        i = j


def byte_blocks(raw: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of runs, none empty, as blocks of eight (the last one filled with zeros), and each run's first block."""
    count = (lens + 7) >> 3
    first = np.cumsum(count) - count
    place = np.arange(int(count.sum()), dtype=np.int64)
    place -= np.repeat(first, count)
    place <<= 3
    view = np.ndarray((len(raw),), "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))
    blocks = view[np.repeat(begin, count) + place]
    blocks &= FIRST_BYTES[np.minimum(np.repeat(lens, count) - place, 8)]
    return blocks, first


def block_hashes(blocks: np.ndarray, first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs: every block is mixed with its place before the blocks are summed, so that no pattern of bytes cancels out."""
    count = np.diff(first, append=len(blocks))
    place = np.arange(len(blocks), dtype=np.uint64)
    place -= np.repeat(first, count).astype(np.uint64)
    place += np.uint64(1)
    place *= _STEP
    return mix64(np.add.reduceat(mix64(blocks ^ mix64(place)), first) + lens.astype(np.uint64))


def word_hashes(texts: list[bytes], separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and each text's count of words."""
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sep = separator[raw]
    edge = np.flatnonzero(np.diff(sep.view(np.int8), prepend=np.int8(1)))
    begin, end = edge[0::2], edge[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(begin, bounds), prepend=0)
    if not len(begin):
        return np.empty(0, np.uint64), counts
    blocks, first = byte_blocks(LOWER[raw], begin, end - begin)
    return block_hashes(blocks, first, end - begin), counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``width`` words in a row; with fewer words, of all of them; with none, empty."""
    words, counts = word_hashes(texts)
    out: list[np.ndarray] = []
    if not len(words):
        return [np.empty(0, np.uint64)] * len(texts)
    size = len(words) - width + 1
    if size > 0:
        rolled = np.zeros(size, np.uint64)
        for k in range(width):
            rolled *= np.uint64(0xD1342543DE82EF95)
            rolled += words[k : k + size]
        rolled = mix64(rolled)
    at = 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            h = np.uint64(n)
            for w in words[at : at + n]:
                h = np.uint64((int(h) * 0xD1342543DE82EF95 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix64(np.array([h], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out

"""Mixture-controlled packing: deficit round-robin over source queues into windows of fixed size.

Texts are tokenized where they are. The tokens of a source make one stream, in the order of a hash of its documents. A target
mixture says how much of each stream is due after any number of windows; partitions are runs of whole windows, each is given exactly what is
due between its ends, and what rounding leaves owed goes with it to the next one. In a partition every window adds to each
source's deficit what is due for it; the source furthest behind sends next, what it is owed but not less than ``least_piece`` (unless its
document or the window ends), so deficits carry from window to window and from partition to partition. All sequences are full windows but those
of the corpus's last rest, which is cut into powers of two, so no sequence needs padding.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.llm.bytesops import block_hashes, byte_blocks, giving_back, slices, text_batches
from thalweg.session import stage_table

WINDOW = 2048
LEAST_PIECE = 256
END_ID = 1
#: Ids of a document that stand in one row; longer documents make several.
MOST_PIECE = 1 << 14
#: Documents of a source are ordered in 2 ** BUCKET_BITS buckets by hash.
BUCKET_BITS = 12
#: Windows of a partition, unless there would be more than so many partitions, or more than so many (partition, source) pairs.
PART_WINDOWS, MOST_PARTS, MOST_CUTS = 1024, 8192, 1 << 18
#: Words a worker remembers, some 150 bytes each.
REMEMBERED = 500_000
_BATCH_CHARS = 1 << 22


# Byte classes of simple texts: white space, letters, digits, other marks.
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = 2
for _range in ((65, 91), (97, 123), (128, 256)):
    _KIND[_range[0] : _range[1]] = 1


class WordTokenizer:
    """Token ids of whole texts, the same as the tokenizer gives, with a memory for words.

    The tokenizer cuts a text into runs of letters, single digits and runs of other marks, and tokenizes each by itself. In
    texts of ASCII and Latin letters without contractions these runs are found and hashed by numpy, and only a run that
    the memory lacks goes to the tokenizer. Other texts are cut at white space, which the tokenizer's pattern never
    crosses, and their words go to the tokenizer as they are.
    """

    _known: dict[str, WordTokenizer] = {}
    #: What makes a text not simple: letters beyond U+024F, letters whose lower case is long, marks beyond ASCII, control characters that
    #: only one side takes for white space, contractions, names of special tokens.
    _unlike = re.compile("[\x1c-\x1f\x80-\xbf\xd7\xf7\u0130\u0250-\U0010ffff]|'(?:[stmdSTMD]|[rRvV][eE]|[lL][lL])|<\\|")
    _separators = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.engine = Tokenizer.from_file(path)
        vocab = self.engine.get_vocab(with_added_tokens=True)
        self.dtype = np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    @classmethod
    def at(cls, path: str) -> WordTokenizer:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.hashes, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        #: The bytes of the runs behind ``hashes``, by number: blocks of eight, the first one's place and the length.
        self.blocks, self.block_at, self.length = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.tokens = np.empty(0, self.dtype)
        self.start = self.size = np.empty(0, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, self.dtype) for e in self.engine.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, ids: np.ndarray, size: np.ndarray, blocks: np.ndarray | None = None, first: np.ndarray | None = None, lens: np.ndarray | None = None) -> np.ndarray:
        """Remember token lists that stand in a row, with the bytes they are of if these are to be compared; return their numbers."""
        if blocks is None:
            at, lens, own = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), self.blocks[:0]
        else:
            count = (lens + 7) >> 3
            begin = np.cumsum(count) - count
            at, own = len(self.blocks) + begin, blocks[np.repeat(first - begin, count) + np.arange(int(count.sum()))]
        self.block_at, self.length, self.blocks = np.concatenate([self.block_at, at]), np.concatenate([self.length, lens]), np.concatenate([self.blocks, own])
        self.start = np.concatenate([self.start, len(self.tokens) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.tokens = np.concatenate([self.tokens, ids])
        return np.arange(len(self.size) - len(size), len(self.size))

    def _learn(self, runs: list[str], *data: np.ndarray) -> np.ndarray:
        """Numbers of runs: tokenized as one text and cut where words end."""
        ids = self._whole([" ".join(runs)])[0]
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(runs) or cut[-1] != len(ids):
            lists = self._whole(runs)
            return self._store(np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists)), *data)
        return self._store(ids, np.diff(cut, prepend=0), *data)

    def _simple(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all runs of simple texts, and each text's count of runs."""
        data = [t.lower().encode() for t in texts]
        raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
        kind = _KIND[raw]
        edge = np.flatnonzero((np.diff(kind.view(np.int8), prepend=np.int8(-1)) != 0) | (kind == 2))
        stop = np.append(edge[1:], len(raw))
        run = kind[edge] != 0
        begin, end = edge[run], stop[run]
        counts = np.diff(np.searchsorted(begin, np.cumsum([len(d) + 1 for d in data])), prepend=0)
        if not len(begin):
            return np.empty(0, np.int64), counts
        lens = end - begin
        blocks, first = byte_blocks(raw, begin, lens)
        h = block_hashes(blocks, first, lens)
        distinct, one, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        number = np.empty(len(distinct), np.int64)
        if len(self.hashes):
            number[known] = self.numbers[at[known]]
        new = np.flatnonzero(~known)
        view = raw.tobytes()
        word = lambda k: view[begin[k] : end[k]].decode()
        if len(new):
            number[new] = self._learn([word(k) for k in one[new].tolist()], blocks, first[one[new]], lens[one[new]])
            hashes = np.concatenate([self.hashes, distinct[new]])
            order = np.argsort(hashes, kind="stable")
            self.hashes, self.numbers = hashes[order], np.concatenate([self.numbers, number[new]])[order]
        number = number[inverse]
        # a hash only proposes: bytes decide, and a run that shares another's hash is looked up by itself
        count = (lens + 7) >> 3
        there = np.repeat(self.block_at[number] - first, count) + np.arange(len(blocks))
        same = self.length[number] == lens
        there[np.repeat(~same, count)] = 0
        same &= np.logical_and.reduceat(self.blocks[there] == blocks, first)
        for k in np.flatnonzero(~same).tolist():
            number[k] = self._other([word(k)])[0][0]
        return number, counts

    def _other(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for other texts and their words; a text with odd separators is a word."""
        words = [[t] if self._separators.search(t) else t.split() for t in texts]
        new = sorted({w for own in words for w in own if w not in self.words})
        if new:
            lists = self._whole(new)
            self.words.update(zip(new, self._store(np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))).tolist(), strict=True))
        return np.array([self.words[w] for own in words for w in own], np.int64), np.array([len(own) for own in words], np.int64)

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.size) > REMEMBERED:
            self._forget()
        odd = np.fromiter((self._unlike.search(t) is not None for t in texts), bool, len(texts))
        out: list = [None] * len(texts)
        for group, numbers in ((np.flatnonzero(~odd).tolist(), self._simple), (np.flatnonzero(odd).tolist(), self._other)):
            if not group:
                continue
            at, counts = numbers([texts[k] for k in group])
            size = self.size[at]
            place = np.arange(int(size.sum()))
            place += np.repeat(self.start[at] - (np.cumsum(size) - size), size)
            ids = self.tokens[place]
            stop = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)].tolist()
            for k, a, b in zip(group, [0, *stop], stop, strict=False):
                out[k] = ids[a:b]
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = []
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), _BATCH_CHARS):
            out += self._some(texts[i:j])
        return out


@dataclass(frozen=True)
class Mixture:
    """How much of each source is due after any number of tokens of the corpus: in proportion to ``targets`` while a source lasts.

    ``names``: the sources, ``totals``: their tokens. Sources without a target come after all others, in proportion to their size.
    """

    names: tuple[str | None, ...]
    totals: np.ndarray
    targets: np.ndarray

    @property
    def total(self) -> int:
        return int(self.totals.sum())

    def due(self, x: np.ndarray) -> np.ndarray:
        """Rows of each source's tokens due after ``x`` tokens: with a clock that runs so that sum(min(total, target * clock)) = x."""
        x = np.atleast_1d(np.asarray(x, float))
        wanted = self.targets > 0
        stops = np.sort(self.totals[wanted] / self.targets[wanted])
        ticks = np.concatenate([[0.0], stops])
        at = np.array([np.minimum(self.totals[wanted], self.targets[wanted] * t).sum() for t in ticks])
        out = np.zeros((len(x), len(self.totals)))
        if wanted.any():
            out[:, wanted] = np.minimum(self.totals[wanted], self.targets[wanted] * np.interp(x, at, ticks)[:, None])
        rest = self.totals[~wanted].sum()
        if rest:
            out[:, ~wanted] = self.totals[~wanted] * np.clip((x - at[-1]) / rest, 0, 1)[:, None]
        return out

    def cuts(self, windows: np.ndarray, window: int) -> np.ndarray:
        """Whole tokens of each source before partitions that begin at ``windows`` and, as the last row, at the end.

        A row sums up to the tokens before it; what rounding leaves a source owed or ahead is its deficit there, always less than
        two tokens, and the next partition starts with it.
        """
        x = np.append(windows * window, self.total)
        due = self.due(x)
        out = np.zeros(due.shape, np.int64)
        for p in range(1, len(x)):
            row = np.maximum(out[p - 1], np.floor(due[p] + 1e-6).astype(np.int64))
            row = np.minimum(row, self.totals)
            while (left := int(x[p] - row.sum())) > 0:
                room = np.flatnonzero(row < self.totals)
                row[room[np.argsort(row[room] - due[p][room], kind="stable")[:left]]] += 1
            while (over := int(row.sum() - x[p])) > 0:
                ahead = np.flatnonzero(row > out[p - 1])
                row[ahead[np.argsort(due[p][ahead] - row[ahead], kind="stable")[:over]]] -= 1
            out[p] = row
        return out


class Packer:
    """Deficit round-robin of one partition: windows from queues that are filled from a stream of (source number, doc_id, ids, start, doc_tokens).

    The stream comes in the order of progress through the partition's part of each source, so the queues stay short.
    """

    def __init__(self, mixture: Mixture, window: int, least: int, first: int, before: np.ndarray, after: np.ndarray, rows: Iterator[tuple]):
        self.mixture, self.window, self.least, self.sequence, self.rows = mixture, window, least, first, rows
        self.x, self.left = int(before.sum()), after - before
        self.due = mixture.due(self.x)[0]
        self.owed = self.due - before
        self.queues: list[deque] = [deque() for _ in mixture.names]

    def _head(self, k: int) -> list:
        while not self.queues[k]:
            source, *row = next(self.rows)
            self.queues[source].append(row)
        return self.queues[k][0]

    def _fill(self, size: int) -> Iterator[tuple]:
        due = self.mixture.due(self.x + size)[0]
        self.owed += due - self.due
        self.due, self.x = due, self.x + size
        offset = 0
        while offset < size:
            k = int(np.where(self.left > 0, self.owed, -np.inf).argmax())
            doc_id, ids, start, tokens = head = self._head(k)
            n = min(size - offset, len(ids), max(self.least, math.ceil(self.owed[k])))
            yield doc_id, start, n, zlib.crc32(ids[:n].astype("<u4").tobytes()), tokens, self.sequence, offset, k
            offset += n
            self.owed[k] -= n
            self.left[k] -= n
            if n == len(ids):
                self.queues[k].popleft()
            else:
                head[1], head[2] = ids[n:], start + n
        self.sequence += 1

    def pack(self) -> Iterator[tuple]:
        """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source number); what fills no window makes sequences of a power of two."""
        while (left := int(self.left.sum())) > 0:
            yield from self._fill(self.window if left >= self.window else 1 << (left.bit_length() - 1))


_TOKENS = "key string, source string, h long, row long, doc_id long, start long, length long, doc_tokens long, ids binary"
_OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, target double"


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.at(path)
        for batch in batches:
            ids = words.ids([x or "" for x in batch.column(5).to_pylist()])
            tokens = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
            # pieces of long documents: which row, from where, how long
            count = -(-tokens // MOST_PIECE)
            row = np.repeat(np.arange(len(ids)), count)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * MOST_PIECE
            size = np.minimum(MOST_PIECE, tokens[row] - start)
            flat = np.empty(int(tokens.sum()), words.dtype)
            ends = np.cumsum(tokens)
            own = np.ones(len(flat), bool)
            own[ends - 1] = False
            flat[own] = np.concatenate([*ids, flat[:0]])
            flat[ends - 1] = END_ID
            at = np.concatenate([[0], np.cumsum(size)]) * flat.itemsize
            raw = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat.astype(flat.dtype.newbyteorder("<")))])
            take = pa.array(row)
            columns = [*(batch.column(k).take(take) for k in range(5)), pa.array(start), pa.array(size), pa.array(tokens[row]), raw.cast(pa.binary())]
            table = pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _TOKENS.split(", ")])
            for k in range(0, len(row), 4096):
                yield table.slice(k, 4096)

    return run


def _crossing(keys: list[str], cuts: np.ndarray):
    """Rows (key, bucket, before, n) of buckets that a cut falls into."""
    number = {k: i for i, k in enumerate(keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            own = np.zeros(len(low), bool)
            for at, (key, a, b) in enumerate(zip(batch.column(0).to_pylist(), low.tolist(), (low + n).tolist(), strict=True)):
                column = cuts[1:-1, number[key]]
                own[at] = np.searchsorted(column, a, "left") < np.searchsorted(column, b, "left")
            yield batch.filter(pa.array(own))

    return run


def _find(keys: list[str], cuts: np.ndarray):
    """Rows of crossed buckets in order, (key, h, row, start, length), each bucket behind a row that gives the source's tokens before it: the row that
    every cut falls into, as (p, k, h, row, start, within), with the tokens of the row that lie before the cut."""
    number = {k: i for i, k in enumerate(keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = 0, []
        for batch in batches:
            for key, h, row, start, n in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if row is None:
                    at = n
                    continue
                k = number[key]
                lo, hi = np.searchsorted(cuts[1:-1, k], [at, at + n], "left") + 1
                out += [(p, k, h, row, start, int(cuts[p, k]) - at) for p in range(int(lo), int(hi))]
                at += n
        columns = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), *[pa.int64()] * 4), strict=True)], names=["p", "k", "h", "row", "start", "within"])

    return run


def _place(keys: list[str], marks: list[tuple[np.ndarray, ...]]):
    """Rows become pieces of partitions by the rows that the cuts fall into: ``marks`` has, for each source, these as columns (p, h, row, start, within)."""
    number = {k: i for i, k in enumerate(keys)}
    names = ["p", "progress", "k", "h", "row", "doc_id", "start", "length", "doc_tokens", "ids"]
    kinds = (pa.int32(), pa.float64(), pa.int32(), *[pa.int64()] * 6, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, row, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 4))
            key = batch.column(0).dictionary_encode()
            k = np.array([number[x] for x in key.dictionary.to_pylist()], np.int64)[key.indices.to_numpy()]
            p, progress, near = np.zeros(len(h), np.int32), np.empty(len(h)), np.zeros(len(h), bool)
            for s in np.unique(k).tolist():
                own = np.flatnonzero(k == s)
                parts, at, *_ = marks[s]
                place = np.searchsorted(at, h[own], "right")
                # the partition that the last mark before the row begins
                p[own] = np.append(0, parts)[place]
                near[own] = np.searchsorted(at, h[own], "left") < place
                ends = np.concatenate([[-(2.0**63)], at.astype(float), [2.0**63]])
                progress[own] = (h[own] - ends[place]) / np.maximum(1.0, ends[place + 1] - ends[place])
            far = np.flatnonzero(~near)
            rest = batch.take(pa.array(far))
            yield pa.RecordBatch.from_arrays([pa.array(p[far]), pa.array(progress[far]), pa.array(k[far].astype(np.int32)), *(rest.column(c) for c in (1, 2, 3, 4, 5, 6, 7))], names=names)
            out = []
            for r in np.flatnonzero(near).tolist():  # rows that share their hash with a mark, most of them the marks themselves
                parts, at, rows, starts, within = marks[int(k[r])]
                n, raw, own = batch.column(5)[r].as_py(), batch.column(7)[r].as_py(), (int(row[r]), int(start[r]))
                wide = len(raw) // n
                lo, hi = int(np.searchsorted(at, h[r], "left")), int(np.searchsorted(at, h[r], "right"))
                part, done = int(parts[lo - 1]) if lo else 0, 0
                pieces = []
                for m in range(lo, hi):
                    mark = (int(rows[m]), int(starts[m]))
                    if mark < own:
                        part = int(parts[m])
                    elif mark == own:
                        pieces.append((part, done, int(within[m])))
                        part, done = int(parts[m]), int(within[m])
                pieces.append((part, done, n))
                for part, a, b in pieces:
                    if a < b:
                        out.append((part, 0.0 if a or part in parts[lo:hi] else 1.0, int(k[r]), int(h[r]), own[0], batch.column(3)[r].as_py(), own[1] + a, b - a, batch.column(6)[r].as_py(), raw[a * wide : b * wide]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def _pack(mixture: Mixture, cuts: np.ndarray, firsts: np.ndarray, window: int, least: int):
    target = mixture.targets / max(1e-300, mixture.targets.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for p, k, doc_id, start, length, tokens, raw in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                    yield p, (k, doc_id, np.frombuffer(raw, f"<u{len(raw) // length}"), start, tokens)

        def emit(out: list[tuple]) -> pa.RecordBatch:
            *columns, k = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array([mixture.names[i] for i in k], pa.string()), pa.array([float(target[i]) for i in k])], names=[x.split()[0] for x in _OUT.split(", ")]
            )

        for p, own in groupby(rows(), lambda r: r[0]):
            packer = Packer(mixture, window, least, int(firsts[p]), cuts[p], cuts[p + 1], (r for _, r in own))
            held = []
            for piece in packer.pack():
                held.append(piece)
                if len(held) == 1 << 14:
                    yield emit(held)
                    held = []
            if held:
                yield emit(held)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, targets: dict[str | None, float] | None = None, least_piece: int = LEAST_PIECE) -> DataFrame:
    """Pack all texts of ``docs`` (doc_id, text, source, any more columns); return a row for each piece of a document.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, target): a document is its token ids and
    ``END_ID``; each id lies in exactly one piece; sequences hold ``window`` ids, or a power of two at the corpus's end. ``targets`` gives
    shares of tokens by source (any scale; a source it lacks goes last); by default each source's share of the corpus's tokens, the one
    mixture that lasts to the last window. ``target`` is the share that was aimed at. Nothing is dropped when a source runs out: the others
    share its part.
    A null text counts as empty and is its end id alone; rows that repeat are packed each; a null source is a
    queue of its own; an empty table gives no rows. The result depends on the rows alone, not on how they are partitioned.
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    source, text, doc_id = F.col("source").cast("string"), F.col("text").cast("string"), F.col("doc_id").cast("long")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    # the row's number only tells equal rows apart
    base = docs.select(key.alias("key"), source.alias("source"), F.xxhash64(doc_id, text).alias("h"), F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), text.alias("text"))
    tokens = stage_table(base.mapInArrow(giving_back(_tokenize(tokenizer_path)), _TOKENS), "tokens")
    bucket = F.shiftright("h", 64 - BUCKET_BITS).cast("int").alias("bucket")
    sums = stage_table(tokens.groupBy("key", "source", bucket).agg(F.sum("length").alias("n")), "token-sums")
    found = sorted(sums.groupBy("key", "source").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["key"])
    if not found:
        return spark.createDataFrame([], _OUT)
    keys, names, totals = [r["key"] for r in found], tuple(r["source"] for r in found), np.array([r["n"] for r in found], np.int64)
    wanted = totals.astype(float) if targets is None else np.array([max(0.0, targets.get(s, 0.0)) for s in names])
    mixture = Mixture(names, totals, wanted)
    windows = mixture.total // window
    parts = max(1, min(-(-windows // PART_WINDOWS), MOST_PARTS, MOST_CUTS // len(names)))
    firsts = np.arange(parts, dtype=np.int64) * windows // parts
    cuts = mixture.cuts(firsts, window)
    # the rows that cuts fall into are found among those of the crossed buckets, without their ids; the tokens that a source has before a
    # bucket come to it as a row of their own, in front of all others
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ordered = sums.select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), "n")
    crossed = stage_table(ordered.mapInArrow(_crossing(keys, cuts), "key string, bucket int, before long, n long"), "crossed")
    none = lambda name: F.lit(None).cast("long").alias(name)
    rows = tokens.select("key", bucket, "h", "row", "start", "length").join(crossed.select("key", "bucket"), ["key", "bucket"], "left_semi")
    rows = rows.union(crossed.select("key", "bucket", none("h"), none("row"), none("start"), F.col("before").alias("length")))
    rows = rows.repartition("key", "bucket").sortWithinPartitions("key", "bucket", F.col("h").asc_nulls_first(), "row", "start").drop("bucket")
    cut_rows = rows.mapInArrow(_find(keys, cuts), "p int, k int, h long, row long, start long, within long").toPandas().sort_values(["k", "p"])
    marks = [tuple(cut_rows.loc[cut_rows["k"] == k, c].to_numpy() for c in ("p", "h", "row", "start", "within")) for k in range(len(keys))]
    placed = tokens.select("key", "h", "row", "doc_id", "start", "length", "doc_tokens", "ids").mapInArrow(
        giving_back(_place(keys, marks)), "p int, progress double, k int, h long, row long, doc_id long, start long, length long, doc_tokens long, ids binary"
    )
    dealt = placed.repartitionById(parts, F.col("p")).sortWithinPartitions("p", "progress", "k", "h", "row", "start").select("p", "k", "doc_id", "start", "length", "doc_tokens", "ids")
    return dealt.mapInArrow(giving_back(_pack(mixture, cuts, firsts, window, least_piece)), _OUT)


def ids_crc32(ids: list[int]) -> int:
    """CRC-32 of ids as little-endian 32-bit numbers."""
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))

"""Improbable-feature digests: rare byte windows of a text in chained Bloom filters.

Every 64-byte window has an entropy, scaled to 0..1000. The rarer a scaled entropy is among the windows of a
reference corpus, the lower its rank. Each run of 64 windows votes for its leftmost window of lowest rank; windows
with at least 16 votes become features. A feature's hash sets five bits in a Bloom filter of 2048 bits; after
160 features the next filter of the chain begins. Two digests are compared filter by filter: the overlap of
bits, less what chance explains, over the most that the smaller filter allows.

The exact entropy of all windows comes without a loop over bytes: how often a byte occurs among the 63 after it (and
before it) is a sum of 63 shifted comparisons, and the change of entropy from one window to the next depends on these
two counts alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import mix64, slices, text_batches

WINDOW = 64
SCALE = 1000
VOTES = 16
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
#: Share of the way from chance to the full overlap below which filters count as unrelated.
CUTOFF = 0.1
BATCH_BYTES = 1 << 20
_TILE = 1 << 15
_UNIT = 1 << 20

_COUNT = np.arange(WINDOW + 1, dtype=np.float64)
_CLOGC = np.round(_COUNT * np.log2(np.maximum(_COUNT, 1)) * _UNIT).astype(np.int64)
#: What one more occurrence of a byte adds to the sum of c * log2(c).
_STEP = np.diff(_CLOGC).astype(np.int32)
_MULT = np.random.default_rng(11).integers(1, 2**62, WINDOW // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Scaled entropies outside these bounds carry no features: near-constant and near-random windows.
LOWEST, HIGHEST = 100, 990
_NEVER = np.int32(SCALE + 1)


def window_entropy(buf: np.ndarray) -> np.ndarray:
    """Scaled entropy of the window at each of the first ``len(buf) - 63`` bytes."""
    n = len(buf)
    if n < WINDOW:
        return np.empty(0, np.int32)
    after, before = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    same = np.empty(_TILE, bool)
    for at in range(0, n, _TILE):
        for lag in range(1, WINDOW):
            stop = min(at + _TILE, n - lag)
            if stop <= at:
                break
            eq = same[: stop - at]
            np.equal(buf[at:stop], buf[at + lag : stop + lag], out=eq)
            one = eq.view(np.uint8)
            after[at:stop] += one
            before[at + lag : stop + lag] += one
    gain, loss = _STEP[before], _STEP[after]
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = gain[:WINDOW].sum(dtype=np.int64)
    np.cumsum(gain[WINDOW:].astype(np.int64) - loss[: n - WINDOW], out=total[1:])
    total[1:] += total[0]
    # log2(64) - total / 64, over the most there can be, log2(64)
    top = 6 * WINDOW * _UNIT
    return ((top - total) * SCALE // top).astype(np.int32)


def entropy_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each scaled entropy."""
    out = np.zeros(SCALE + 1, np.int64)
    for buf, valid in _joined(texts):
        out += np.bincount(window_entropy(buf)[valid[: max(0, len(buf) - WINDOW + 1)]], minlength=SCALE + 1)
    return out


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """Ranks 0.. by rising count, ties by entropy; entropies out of bounds never win over others."""
    ranks = np.empty(SCALE + 1, np.int32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(SCALE + 1, dtype=np.int32)
    ranks[:LOWEST] = ranks[HIGHEST + 1 :] = SCALE
    return ranks


def _joined(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for i, j in slices(sizes, BATCH_BYTES):
        buf = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        yield buf, _valid(sizes[i:j])


def _valid(sizes: np.ndarray) -> np.ndarray:
    """Where a window lies inside one text."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())
    return left >= WINDOW


def features(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all selected features, in order and distinct within a text, and each one's text.

    A text with windows but no window of enough votes gives its most voted one; a text shorter than a window gives
    itself; an empty text gives none.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes, owners = [], []
    for i, j in slices(sizes, BATCH_BYTES):
        h, o = _features(b"".join(texts[i:j]), sizes[i:j], ranks)
        short = [k for k in range(i, j) if 0 < sizes[k] < WINDOW]
        if short:
            own = np.array([int.from_bytes(hashlib.sha1(texts[k]).digest()[:8], "little") for k in short], np.uint64)
            h, o = np.concatenate([h, own]), np.concatenate([o, np.array(short) - i])
            order = np.argsort(o, kind="stable")
            h, o = h[order], o[order]
        hashes.append(h)
        owners.append(o + i)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _features(raw: bytes, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    if n < WINDOW:
        return none
    buf = np.frombuffer(raw, np.uint8)
    valid = _valid(sizes)
    if not valid.any():
        return none
    rank = np.full(n + WINDOW, _NEVER, np.int64)
    rank[: n - WINDOW + 1] = np.where(valid[: n - WINDOW + 1], ranks[window_entropy(buf)], _NEVER)
    # leftmost lowest rank of 64 windows, by doubling; the 63 last bytes of a text are never valid, so texts don't mix
    low = (rank << 40) + np.arange(n + WINDOW, dtype=np.int64)
    for step in (1, 2, 4, 8, 16, 32):
        low = np.minimum(low[:-step], low[step:])
    low = low[:n][valid]
    winner = low & ((1 << 40) - 1)
    new = np.flatnonzero(np.diff(winner, prepend=-1))
    votes = np.diff(new, append=len(winner))
    at = winner[new]
    owner = np.searchsorted(np.cumsum(sizes), at, "right")
    chosen = votes >= VOTES
    # the most voted, leftmost, of each text that has no other
    lacking = np.setdiff1d(owner, owner[chosen])
    if len(lacking):
        order = np.lexsort((at, -votes, owner))
        first = order[np.unique(owner[order], return_index=True)[1]]
        chosen[first[np.isin(owner[first], lacking)]] = True
    at, owner = at[chosen], owner[chosen]
    words = np.lib.stride_tricks.sliding_window_view(buf, WINDOW)[at].view("<u8").reshape(-1, WINDOW // 8)
    h = np.zeros(len(at), np.uint64)
    for k in range(WINDOW // 8):
        h = mix64(h + words[:, k] * _MULT[k])
    order = np.lexsort((np.arange(len(h)), h, owner))
    again = (np.diff(h[order], prepend=~h[order[:1]]) == 0) & (np.diff(owner[order], prepend=-1) == 0)
    keep = np.ones(len(h), bool)
    keep[order[again]] = False
    return h[keep], owner[keep]


def chains(hashes: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Filters as rows of bytes, and how many of them each of ``count`` texts has; features fill them in order."""
    each = np.bincount(owner, minlength=count)
    filters = -(-each // FILTER_FEATURES)
    first = np.cumsum(filters) - filters
    nth = np.arange(len(hashes)) - np.repeat(np.cumsum(each) - each, each)
    row = first[owner] + nth // FILTER_FEATURES
    bits = np.zeros((int(filters.sum()), FILTER_BITS), np.uint8)
    for k in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1), filters


def digests(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return chains(*features(texts, ranks), len(texts))


def render(rows: np.ndarray) -> str:
    """A digest as text: count of filters, then their bytes."""
    return f"{len(rows)}:{base64.b64encode(rows.tobytes()).decode()}"


def parse(text: str) -> np.ndarray:
    n, _, body = text.partition(":")
    return np.frombuffer(base64.b64decode(body), np.uint8).reshape(int(n), FILTER_BITS // 8)


def filter_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised overlaps of rows of filters."""
    x, y = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    na, nb = (np.bitwise_count(v).sum(1, dtype=np.int64).astype(float) for v in (x, y))
    both = np.bitwise_count(x & y).sum(1, dtype=np.int64).astype(float)
    most, chance = np.minimum(na, nb), na * nb / FILTER_BITS
    cut = chance + CUTOFF * (most - chance)
    score = np.where(both > cut, (both - cut) / np.maximum(most - cut, 1e-9), 0.0)
    return np.where((a == b).all(1), 1.0, np.minimum(score, 1.0))


def likeness(rows_a: np.ndarray, n_a: np.ndarray, rows_b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeness of the k-th chain of one side and the k-th of the other: the mean over the shorter chain's filters of each one's best match.

    Two empty chains are alike (1), an empty and another are not (0). Long chains are compared a few filters at a time.
    """
    out = np.where((n_a == 0) & (n_b == 0), 1.0, 0.0)
    at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    single = np.flatnonzero((n_a == 1) & (n_b == 1))
    if len(single):
        out[single] = filter_scores(rows_a[at_a[single]], rows_b[at_b[single]])
    for k in np.flatnonzero((n_a > 0) & (n_b > 0) & (n_a + n_b > 2)).tolist():
        a, b = rows_a[at_a[k] : at_a[k] + n_a[k]], rows_b[at_b[k] : at_b[k] + n_b[k]]
        if len(a) > len(b):
            a, b = b, a
        step = max(1, (1 << 14) // len(b))
        total = 0.0
        for s in range(0, len(a), step):
            part = a[s : s + step]
            total += filter_scores(np.repeat(part, len(b), 0), np.tile(b, (len(part), 1))).reshape(len(part), len(b)).max(1).sum()
        out[k] = total / len(a)
    return out


# ---- over tables


def corpus_ranks(docs: DataFrame) -> np.ndarray:
    """Rarity ranks from all windows of all texts: a histogram of 1001 counts for each partition, summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SCALE + 1, np.int64)
        for batch in batches:
            total += entropy_counts([x or b"" for x in batch.column(0).cast(pa.binary()).to_pylist()])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["e", "n"])

    counts = np.zeros(SCALE + 1, np.int64)
    for e, n in docs.select(F.col("text").cast("string")).mapInArrow(count, "e long, n long").groupBy("e").agg(F.sum("n")).collect():
        counts[e] = n
    return rarity_ranks(counts)


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(ranks: np.ndarray):
    """Rows of a partition in descending order, each but the halo row with its successor."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()], batch.column(2).to_pylist(), strict=True)

    def emit(block: list[tuple]) -> pa.RecordBatch:
        own, nxt = block[:-1], block[1:]
        texts = [x[1] for x in block]
        edited = []
        for (_, text, _), (_, after, _) in zip(own, nxt, strict=True):
            half = len(text) // 2
            edited.append((text[: len(text) - half] + after[:half]).encode())
        raw = [t.encode() for t in texts]
        rows, n = digests(raw, ranks)
        erows, en = digests(edited, ranks)
        at, eat = np.cumsum(n) - n, np.cumsum(en) - en
        m = len(own)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in own], pa.int64()),
                pa.array([len(x[1]) for x in own], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in edited]),
                pa.array([render(rows[at[k] : at[k] + n[k]]) for k in range(m)]),
                pa.array([render(erows[eat[k] : eat[k] + en[k]]) for k in range(m)]),
                pa.array(likeness(rows, n[:m], erows, en)),
                pa.array(likeness(rows, n[:m], rows[n[0] :], n[1:])),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in rows(batches):
            held.append(row)
            size += len(row[1])
            if row[2]:  # the halo row ends a range
                yield emit(held)
                held, size = [], 0
            elif size >= BATCH_BYTES and len(held) > 1:
                yield emit(held)
                held, size = held[-1:], len(row[1])

    return run


def fingerprint_neighbours(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of each text and of its edit, with two likenesses, for each row of ``docs`` (doc_id, text, any more columns).

    The edited text has its last floor(n_chars / 2) code points replaced by as many first ones (or all) of the next
    document in descending doc_id, after the last the first. Rows with equal doc_id stand in the order of their
    texts, rows without doc_id last. A null text counts as empty. A single row is its own next. An empty table gives
    no rows. ``ranks`` fixes the rarity ranks, for fingerprints that are to be compared across corpora; by
    default they are counted over ``docs``.

    The table is dealt into ranges of doc_id, and the first row of each range also goes to the range before, so each
    range is done by itself: one shuffle of the texts, no row meets more than its neighbour.
    """
    spark = docs.sparkSession
    text_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if ranks is None:
        ranks = corpus_ranks(base)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = base.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []
    cuts = sorted(set(cuts))
    # range 0 has the largest ids; rows without doc_id come last in the last range
    dealt = base.withColumn("pid", _range_of(cuts))
    ends = {r["pid"]: r for r in dealt.groupBy("pid").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(ends)
    if not order:
        return spark.createDataFrame([], OUT)
    # a copy of each range's first row goes to the range before, the table's first row to the last range
    before = spark.createDataFrame([(p, order[k - 1]) for k, p in enumerate(order)], "pid int, target int")
    # by number of range: a literal array is asked by place, whatever its length
    tops = F.array(*[F.lit(ends[p]["top"] if p in ends else None).cast("long") for p in range(order[-1] + 1)])
    is_first = F.col("doc_id").eqNullSafe(F.get(tops, F.col("pid")))
    firsts = dealt.filter(is_first).groupBy("pid").agg(F.min_by(F.struct("doc_id", "text"), F.coalesce("text", F.lit(""))).alias("r"))
    halo = firsts.join(before, "pid").select("r.doc_id", "r.text", F.col("target").alias("pid"), F.lit(1).alias("halo"))
    rows = dealt.withColumn("halo", F.lit(0)).unionByName(halo)
    rows = rows.repartitionById(len(cuts) + 1, F.col("pid").cast("int"))
    rows = rows.sortWithinPartitions("pid", "halo", F.col("doc_id").desc_nulls_last(), F.coalesce("text", F.lit("")))
    return rows.select("doc_id", "text", "halo").mapInArrow(_neighbours(ranks), OUT)


def _range_of(cuts: list[int]):
    """The range of doc_id, counted from the largest: binary search for the number of smaller cuts."""
    n = len(cuts)
    if not n:
        return F.lit(0)
    table = F.array(*map(F.lit, cuts))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    smaller = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when((at + step <= n) & (F.element_at(table, F.least(at + step, F.lit(n))) < F.col("doc_id")), at + step).otherwise(at),
    )
    return F.lit(n) - smaller

"""Near-duplicate documents by MinHash bands, odd sketches and an exact check on full shingle sets.

1. One pass over the texts gives each document the count and a 128-bit digest of its shingle set, hashes of
   MinHash bands, and an odd sketch: every MinHash sample flips one bit of a bitmap, so that the XOR of two
   bitmaps has about as many ones as the samples differ.
2. Documents with equal sets fold into the one with the smallest id (a partial aggregation, so that a group
   of copies of any size costs one row a task).
3. Every document is linked tentatively with the smallest of its bands' smallest members; the links that the sketch
   and then the full sets confirm give first components. Documents that share a bucket get a finer sketch of more
   samples. In each bucket, members of *different* components are then compared by it, in blocks, and what passes
   is confirmed on full sets. Pairs within a component need no comparison, and of buckets that a pair shares only the
   first reports it, so a large group of near copies never yields all its pairs.

The number of rows in a band is the largest for which a pair at the threshold shares a bucket with a chance
of at least ``1 - miss``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import giving_back, mix64, shingle_sets, slices, text_batches
from thalweg.operators.components import connected_components
from thalweg.session import stage_table

SAMPLES = 256
SKETCH_BITS = 1024
MISS = 1e-5
#: The finer sketch, for documents that share a bucket.
FINE_SAMPLES, FINE_BITS = 2048, 8192
#: The sketches may underestimate by this much before a true link is lost: over four standard deviations.
MARGIN, FINE_MARGIN = 0.11, 0.037
#: Members of a bucket that one task compares with as many others.
BLOCK = 512
BATCH_BYTES = 1 << 19

_RNG = np.random.default_rng(7)
_MUL = _RNG.integers(0, 2**31, FINE_SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _RNG.integers(0, 2**32, FINE_SAMPLES, dtype=np.uint32)


def band_rows(threshold: float, samples: int = SAMPLES, miss: float = MISS) -> int:
    """The most rows a band can have while a pair at the threshold is missed with a chance of at most ``miss``."""
    return max(r for r in range(1, 17) if (1 - threshold**r) ** (samples // r) <= miss)


def minhash(sets: list[np.ndarray], count: int = SAMPLES) -> np.ndarray:
    """Samples by document: the smallest value of each hash function over a set; sets must not be empty."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((count, len(sets)), np.uint32)
    tmp = np.empty_like(x)
    for k in range(count):
        np.bitwise_xor(x, _XOR[k], out=tmp)
        np.multiply(tmp, _MUL[k], out=tmp)
        np.minimum.reduceat(tmp, starts, out=out[k])
    return out


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """A row of ``bits`` / 8 bytes for each document: bit parities of the hashed (function, sample) pairs."""
    k, n = samples.shape
    tagged = samples.astype(np.uint64) | (np.arange(k, dtype=np.uint64)[:, None] << np.uint64(32))
    bit = (mix64(tagged) >> np.uint64(64 - int(math.log2(bits)))).astype(np.int64)
    bit += np.arange(n, dtype=np.int64)[None, :] * bits
    ones = (np.bincount(bit.ravel(), minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(ones.reshape(n, bits), axis=1)


def most_ones(similarity: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """The count of ones in the XOR of two sketches up to which their similarity is estimated at least so high."""
    return math.floor(bits * (1 - math.exp(-4 * samples * (1 - similarity) / bits)) / 2)


def estimate(ones: np.ndarray, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> np.ndarray:
    """Similarity from the count of ones in the XOR of two sketches."""
    share = np.minimum(2 * np.asarray(ones, float) / bits, 1 - 1e-9)
    return 1 + bits / (4 * samples) * np.log(1 - share)


def band_hashes(samples: np.ndarray, rows: int) -> np.ndarray:
    """Documents by bands; the band's number is part of the hash."""
    bands = samples.shape[0] // rows
    out = np.empty((samples.shape[1], bands), np.int64)
    for b in range(bands):
        h = np.full(samples.shape[1], b + 1, np.uint64)
        for row in samples[b * rows : (b + 1) * rows]:
            h = mix64(h * np.uint64(0xD1342543DE82EF95) + row)
        out[:, b] = h.view(np.int64)
    return out


def _list(values: np.ndarray) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32), pa.array(values.ravel()))


def _texts(column: pa.Array) -> list[bytes]:
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def _signatures(shingle: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), _texts(batch.column(1))
            for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), BATCH_BYTES):
                sets = shingle_sets(texts[i:j], shingle)
                full = [k for k, s in enumerate(sets) if len(s)]
                bands = [None] * (j - i)
                sketches: list[bytes | None] = [None] * (j - i)
                digest = np.zeros((j - i, 2), np.uint64)
                if full:
                    samples = minhash([sets[k] for k in full])
                    drawn = _list(band_hashes(samples, rows)).to_pylist()
                    for k, b, o in zip(full, drawn, odd_sketches(samples), strict=True):
                        bands[k], sketches[k] = b, o.tobytes()
                        s = sets[k]
                        digest[k] = mix64(s + np.uint64(0x632BE59BD9B4E019)).sum(), (s ^ mix64(s * np.uint64(3))).sum()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digest[:, 0].view(np.int64)),
                        pa.array(digest[:, 1].view(np.int64)),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "sketch"],
                )

    return run


def signatures(docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands, sketch) for each row of ``docs`` (doc_id, text)."""
    schema = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sketch binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        giving_back(_signatures(shingle, band_rows(threshold))), schema
    )


def _sets_of(shingle: int, bits: int, words: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.unpackbits(np.frombuffer(words, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            place = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(listed[place]))
            texts = _texts(batch.column(1))
            for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), BATCH_BYTES):
                sets = shingle_sets(texts[i:j], shingle)
                ids = batch.column(0).slice(i, j - i)
                if not all(map(len, sets)):  # a document without words shares no bucket
                    full = [k for k, s in enumerate(sets) if len(s)]
                    sets, ids = [sets[k] for k in full], ids.take(pa.array(full, pa.int64()))
                if not sets:
                    continue
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                fine = odd_sketches(minhash(sets, FINE_SAMPLES), FINE_BITS)
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, values), pa.array([r.tobytes() for r in fine])], names=["id", "words", "fine"])

    return run


#: The filter that names documents to a second pass never exceeds 8 MB; with more documents it lets more pass by chance, which costs time alone.
FILTER_BITS = 1 << 26


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, words, fine) of the documents listed in ``ids`` (and a few others): full sets for exact checks, and finer sketches."""
    count = ids.count()
    bits = 1 << min(max(10, math.ceil(math.log2(16 * count + 1))), int(math.log2(FILTER_BITS)))
    place = F.pmod(F.xxhash64(F.col("id")), F.lit(bits)).cast("int")
    words = ids.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, p & 31)")).alias("b")).collect()
    table = np.zeros(bits // 32, np.uint32)
    for w, b in words:
        table[w] = b
    source = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(bits)).cast("int").alias("p")
    ).filter("id is not null")
    return source.mapInArrow(giving_back(_sets_of(shingle, bits, table.tobytes())), "id long, words array<long>, fine binary")


def _compare(threshold: float):
    """Rows of a block pair, sorted by its key, give the pairs of different components whose sketches are close."""
    limit = most_ones(max(0.0, threshold - FINE_MARGIN), FINE_SAMPLES, FINE_BITS)

    def pairs(bh: int, side: np.ndarray, ids: np.ndarray, comp: np.ndarray, size: np.ndarray, sketch: np.ndarray, bands: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return
        words = np.ascontiguousarray(sketch).view(np.uint64)
        for at in range(0, len(left), 16):
            a = left[at : at + 16]
            near = (size[a][:, None] >= threshold * size[right][None, :]) & (size[right][None, :] >= threshold * size[a][:, None]) & (comp[a][:, None] != comp[right][None, :])
            if same:
                near &= ids[a][:, None] < ids[right][None, :]
            x, y = np.nonzero(near)
            if len(x):
                ones = np.bitwise_count(words[a[x]] ^ words[right[y]]).sum(1)
                x, y = a[x[ones <= limit]], right[y[ones <= limit]]
                first = (bands[x] == bands[y]).argmax(1)
                here = bands[x, first] == bh
                yield ids[x[here]], ids[y[here]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if not table.num_rows:
                return
            table = table.combine_chunks()
            bh, bi, bj = (table.column(k).to_numpy() for k in ("bh", "bi", "bj"))
            cut = np.flatnonzero((np.diff(bh) != 0) | (np.diff(bi) != 0) | (np.diff(bj) != 0)) + 1
            starts = np.concatenate([[0], cut, [len(bh)]])
            ids, comp, size, side = (table.column(k).to_numpy() for k in ("id", "comp", "n", "side"))
            sketch = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(len(ids), -1)
            bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            left, right = [], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s > 1:
                    for x, y in pairs(bh[s], side[s:e], ids[s:e], comp[s:e], size[s:e], sketch[s:e], bands[s:e], bi[s] == bj[s]):
                        left.append(np.minimum(x, y))
                        right.append(np.maximum(x, y))
            if left:
                found = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            keys = [table.column(k) for k in ("bh", "bi", "bj")]
            last = [c[-1].as_py() for c in keys]
            if [c[0].as_py() for c in keys] != last:  # all but the last group is whole
                other = ~np.logical_and.reduce([c.to_numpy() == v for c, v in zip(keys, last, strict=True)])
                whole = int(other.sum())
                yield from flush(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("words").alias("wa"))
    right = sets.select(F.col("id").alias("b"), F.col("words").alias("wb"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("wa", "wb")).cast("long"))
    return joined.filter(F.col("both") * 100 >= percent * (F.size("wa") + F.size("wb") - F.col("both"))).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text, any more columns).

    Words are runs of bytes other than the six ASCII white-space bytes, A-Z lower-cased. Two documents are linked if
    100 * intersection >= percent * union of their sets of ``shingle`` words in a row. A shorter text has
    its whole sequence as the only shingle; a null, empty or blank text has none and is linked with nothing.
    Rows that repeat a doc_id are one node of the graph and come back once each. A row without a doc_id takes the
    component of its copies that have one, else null, and is not kept. An empty table gives no rows.
    """
    text_batches(docs.sparkSession)
    threshold = percent / 100
    sig = stage_table(signatures(docs, shingle, threshold), "minhash")
    rep = sig.filter("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    folded = stage_table(sig.filter("n_shingles > 0").select("doc_id", "n_shingles", "k1", "k2").join(rep, ["k1", "k2"], "left").select("doc_id", "n_shingles", "rep"), "folded")
    # a representative's own row carries its bands and sketch
    heads = sig.filter("n_shingles > 0").join(rep.select("k1", "k2", F.col("rep").alias("doc_id")), ["doc_id", "k1", "k2"]).dropDuplicates(["doc_id", "k1", "k2"])
    heads = stage_table(heads.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands", "sketch"), "heads")

    bands = heads.select(F.explode("bands").alias("bh"), "id")
    buckets = bands.groupBy("bh").agg(F.min("id").alias("low"), F.count("*").alias("members")).filter("members > 1 ")
    shared = stage_table(bands.join(buckets, "bh"), "buckets")
    sketch = heads.select("id", "n", "sketch")
    firsts = shared.groupBy("id").agg(F.min("low").alias("a")).filter("a < id").select("a", F.col("id").alias("b"))
    close = _close(firsts, sketch, threshold)
    members = shared.select("id").distinct()
    sets = stage_table(full_sets(docs, members, shingle).join(members, "id", "left_semi"), "sets")
    links = stage_table(confirm(close, sets, percent), "links")
    comp = connected_components(links, "a", "b", at_once=0)

    placed = shared.join(comp, "id", "left").select("bh", "id", "members", F.coalesce("component", "id").alias("comp"))
    placed = stage_table(placed, "placed")
    mixed = placed.groupBy("bh").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 <> c2").select("bh")
    rows = placed.join(mixed, "bh", "left_semi").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "bh", "id", "comp", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side")
    )
    fine = sets.select("id", F.size("words").cast("long").alias("n"), "fine").join(heads.select("id", "bands"), "id")
    rows = rows.join(fine, "id").repartition("bh", "bi", "bj").sortWithinPartitions("bh", "bi", "bj")
    more = rows.select("bh", "bi", "bj", "id", "comp", "n", "side", "fine", "bands").mapInArrow(giving_back(_compare(threshold)), "a long, b long").distinct()
    more = stage_table(more, "candidates")
    links = links.union(stage_table(confirm(more, sets, percent), "more-links"))
    comp = connected_components(links, "a", "b", at_once=0)

    done = folded.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    bare = sig.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return done.union(bare).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _close(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sketches and sizes don't rule out the threshold; both sides stay in the JVM."""
    limit = most_ones(max(0.0, threshold - MARGIN))
    left = sketch.select(F.col("id").alias("a"), F.col("n").alias("na"), F.hex("sketch").alias("sa"))
    right = sketch.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.hex("sketch").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").filter((F.col("na") >= threshold * F.col("nb")) & (F.col("nb") >= threshold * F.col("na")))
    word = lambda c, k: F.conv(F.substring(c, 1 + 8 * k, 8), 16, 10).cast("long")
    ones = sum((F.bit_count(word("sa", k).bitwiseXOR(word("sb", k))) for k in range(1, SKETCH_BITS // 32)), F.bit_count(word("sa", 0).bitwiseXOR(word("sb", 0))))
    return joined.filter(ones <= limit).select("a", "b")

"""Features of texts for the classifiers, and the bounded samples that they are fitted on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import FIRST_BYTES, LOWER, NOT_ALNUM, block_hashes, byte_blocks, mix64

#: Whole words and their first bytes, so that inflected forms share a feature.
PREFIXES = (0, 4, 5)


def texts_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def word_features(texts: list[bytes], bits: int, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs: hashed words of letters and digits, and hashed prefixes; ``keep`` masks features of interest."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not texts:
        return none
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sep = NOT_ALNUM[raw]
    edge = np.flatnonzero(np.diff(sep.view(np.int8), prepend=np.int8(1)))
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return none
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.searchsorted(np.cumsum(sizes + 1), begin, "right")
    lens = end - begin
    blocks, first = byte_blocks(LOWER[raw], begin, lens)
    rows, cols = [], []
    for k in PREFIXES:
        if k:
            own = lens >= k
            h, who = mix64(blocks[first[own]] & FIRST_BYTES[k]), owner[own]
        else:
            h, who = block_hashes(blocks, first, lens), owner
        f = (mix64(h + np.uint64(k)) >> np.uint64(64 - bits)).astype(np.int64)
        if keep is not None:
            used = keep[f]
            f, who = f[used], who[used]
        rows.append(who)
        cols.append(f)
    pair = np.unique((np.concatenate(rows) << bits) | np.concatenate(cols))
    return pair >> bits, pair & ((1 << bits) - 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows of ``docs`` with ``label``, at most ``per_class`` of each value, and how many rows each value has in all.

    Which rows is a matter of the hash of doc_id alone. Rows of ``labels`` without an id or label are ignored, of several labels of an id the
    smallest holds. The sample is bounded, so its ids may be broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("_label")).dropna().groupBy("doc_id").agg(F.min("_label").alias("_label"))
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for value in sorted(totals):
        part = known.filter(F.col("_label") == value).orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    if picked is None:
        picked = known.limit(0)
    ids = docs.sparkSession.createDataFrame(picked.collect(), "doc_id long, _label int")
    return docs.join(F.broadcast(ids), "doc_id"), totals

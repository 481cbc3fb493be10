"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) is the logistic of threshold k less one weighted sum that all grades share; thresholds are kept in
order by fitting the logarithms of their gaps. The expected grade is the severity. Features are the presence of
hashed words and word beginnings that differ clearly between toxic and clean labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import give_back, giving_back, mix64, slices, text_batches
from thalweg.llm.features import labelled_sample, texts_of, word_features

BITS = 20
#: The most labelled documents of each class that the model is fitted on.
PER_CLASS = 3000
#: Features are kept from this many standard errors of difference on, if one class has them so many times as often, in this
#: many of its documents and this share of them; a few copies of a document don't make a feature.
LEAST_Z, LEAST_LIFT, LEAST_DOCS, LEAST_SHARE, MOST_FEATURES = 5.0, 5.0, 4, 0.006, 1 << 14
GRADES = 4
#: Parts of the labelled documents, each graded by a model of the others.
FOLDS = 4
ROUNDS, RATE, RIDGE = 300, 0.1, 1e-3
#: A document counts as toxic from this chance on that its grade is above 0.
TOXIC_FROM = 0.5
_BATCH = 1 << 20


@dataclass(frozen=True)
class OrdinalModel:
    """``features`` (sorted ids), their ``weights`` and the ordered ``thresholds``."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, score: np.ndarray) -> np.ndarray:
        """Rows of the chances of each grade."""
        below = _logistic(self.thresholds[None, :] - score[:, None])
        edges = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.diff(edges, axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        keep = np.zeros(1 << BITS, bool)
        keep[self.features] = True
        rows, cols = word_features(texts, BITS, keep)
        return np.bincount(rows, self.weights[np.searchsorted(self.features, cols)], len(texts))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def select_features(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Features that clearly more documents of one class have, by ``LEAST_Z`` and the bounds beside it."""
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    size = 1 << BITS
    a, b = np.bincount(cols[toxic[rows]], minlength=size), np.bincount(cols[~toxic[rows]], minlength=size)
    p = (a + b + 1) / (n1 + n0 + 2)
    z = (a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    more, fewer = np.maximum(a / n1, b / n0), np.minimum(a / n1, b / n0)
    docs = np.where(a / n1 > b / n0, a, b)
    found = np.flatnonzero((np.abs(z) >= LEAST_Z) & (more >= LEAST_LIFT * fewer) & (more >= LEAST_SHARE) & (docs >= LEAST_DOCS))
    return np.sort(found[np.argsort(-np.abs(z[found]), kind="stable")[:MOST_FEATURES]])


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, weight: np.ndarray, features: np.ndarray) -> OrdinalModel:
    """Weighted maximum likelihood with a ridge, by Adam over all rows."""
    inside = np.isin(cols, features)
    rows, cols = rows[inside], np.searchsorted(features, cols[inside])
    top = int(grade.max()) if len(grade) else 0
    if not len(features) or top == 0:
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.full(1, 30.0 if top == 0 else 0.0))
    weight = weight / weight.sum()
    share = np.clip(np.cumsum(np.bincount(grade, weight, top + 1))[:-1], 1e-4, 1 - 1e-4)
    first = np.log(share / (1 - share))
    # weights, the first threshold, the logarithms of the gaps
    x = np.concatenate([np.zeros(len(features)), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(x), np.zeros_like(x)
    n, f = len(grade), len(features)
    for t in range(1, ROUNDS + 1):
        theta = np.cumsum(np.concatenate([x[f : f + 1], np.exp(x[f + 1 :])]))
        score = np.bincount(rows, x[cols], n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = _logistic(edges[grade + 1] - score), _logistic(edges[grade] - score)
        chance = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) * weight / chance, lo * (1 - lo) * weight / chance
        dscore = dhi - dlo  # of the loss
        grad = np.zeros_like(x)
        grad[:f] = np.bincount(cols, dscore[rows], f) + RIDGE * x[:f] / f
        dtheta = np.bincount(grade, -dhi, top + 1)[:top] + np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, dlo, 0), top)
        grad[f] = dtheta.sum()
        for k in range(1, top):
            grad[f + k] = dtheta[k:].sum() * np.exp(x[f + k])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        x = x - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    theta = np.cumsum(np.concatenate([x[f : f + 1], np.exp(x[f + 1 :])]))
    return OrdinalModel(features, x[:f], theta)


def unseen_scores(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray, weight: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    """Each document's score by a model of two grades that was fitted on the other folds alone, features chosen there too."""
    n = len(toxic)
    out = np.zeros(n)
    fold = np.arange(n) % folds
    for k in range(folds):
        learn, ask = fold != k, fold == k
        if not toxic[learn].any() or toxic[learn].all():
            continue
        inside = learn[rows]
        place = np.cumsum(learn) - 1
        own = place[rows[inside]], cols[inside]
        features = select_features(*own, toxic[learn])
        model = fit_ordinal(*own, toxic[learn].astype(np.int64), weight[learn], features)
        seen = ask[rows] & np.isin(cols, model.features)
        score = np.bincount(rows[seen], model.weights[np.searchsorted(model.features, cols[seen])], n) if len(model.features) else np.zeros(n)
        out[ask] = score[ask]
    return out


def severity_grades(toxic: np.ndarray, scores: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grades 0..grades-1 for documents of which only toxic or not is known: toxic ones in equal shares by the score of a model that has not seen them."""
    grade = np.zeros(len(toxic), np.int64)
    if toxic.any():
        cuts = np.quantile(scores[toxic], np.arange(1, grades - 1) / (grades - 1))
        grade[toxic] = 1 + np.searchsorted(cuts, scores[toxic], "left")
    return grade


def unlike_rows(rows: np.ndarray, cols: np.ndarray, n: int, keys: int = 12, size: int = 6, common: float = 0.05) -> np.ndarray:
    """Mark documents that share no key of ``size`` least hashed features with an earlier one, so that near copies are learnt from once.

    Features of more than a share ``common`` of the documents say nothing about copies and don't count.
    """
    rare = np.bincount(cols, minlength=1 << BITS)[cols] <= max(10, common * n)
    rows, cols = rows[rare], cols[rare]
    first = np.searchsorted(rows, np.arange(n))
    there = np.append(first[1:], len(rows)) > first
    least = np.full((keys * size, n), np.iinfo(np.uint64).max, np.uint64)
    for k in range(keys * size):
        h = mix64(cols.astype(np.uint64) + np.uint64((k + 1) << 40))
        least[k, there] = np.minimum.reduceat(h, first[there])
    keep, seen = np.ones(n, bool), set()
    for d in range(n):
        own = {(k, *least[k * size : (k + 1) * size, d].tolist()) for k in range(keys)}
        keep[d] = not there[d] or seen.isdisjoint(own)
        if keep[d]:
            seen |= own
    return keep


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), _BATCH):
            rows, cols = word_features(texts[i:j], BITS)
            cut = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.ListArray.from_arrays(cut, pa.array(cols.astype(np.int32)))], names=["doc_id", "label", "features"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> OrdinalModel:
    """Fit on at most ``per_class`` documents of each label.

    Labels of more than two values are grades themselves. Of two values, toxic or not, the greater is graded by how strongly a model of other
    documents marks it.
    """
    text_batches(docs.sparkSession)
    sample, totals = labelled_sample(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels, label, per_class)
    table = sample.select("doc_id", "text", "_label").mapInArrow(giving_back(_pairs), "doc_id long, label int, features array<int>").toArrow().combine_chunks().sort_by("doc_id")
    lists = table.column("features").combine_chunks()
    cols = lists.flatten().to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) if len(lists) else np.empty(0, np.int64)
    value = table.column("label").to_numpy().astype(np.int64)
    unlike = unlike_rows(rows, cols, len(value))
    inside = unlike[rows]
    rows, cols, value = (np.cumsum(unlike) - 1)[rows[inside]], cols[inside], value[unlike]
    toxic = value > 0
    features = select_features(rows, cols, toxic)
    seen = {v: max(1, int((value == v).sum())) for v in totals}
    weight = np.array([totals[int(v)] / seen[int(v)] for v in value], float)
    grade = np.searchsorted(sorted(totals), value) if len(totals) > 2 else severity_grades(toxic, unseen_scores(rows, cols, toxic, weight))
    return fit_ordinal(rows, cols, grade, weight, features)


def severity_column(model: OrdinalModel, text: str = "text"):
    """A column struct<severity double, grade int, toxic boolean> for a text column; a null or empty text has the base rate's severity."""

    @F.arrow_udf("struct<severity:double,grade:int,toxic:boolean>")
    def score(column: pa.Array) -> pa.Array:
        texts = texts_of(column)
        out = np.empty((len(texts), 3))
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), _BATCH):
            chance = model.chances(model.scores(texts[i:j]))
            out[i:j, 0] = chance @ np.arange(chance.shape[1])
            out[i:j, 1] = chance.argmax(1)
            out[i:j, 2] = 1 - chance[:, 0]
        severity = np.round(out[:, 0], 6)
        give_back()
        return pa.StructArray.from_arrays([pa.array(severity), pa.array(out[:, 1].astype(np.int32)), pa.array(out[:, 2] >= TOXIC_FROM)], ["severity", "grade", "toxic"])

    return score(F.col(text).cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, severity, grade, toxic) for each row of ``docs`` (doc_id, text, any more columns).

    ``severity`` is the expected grade, 0 (clean) to 3, ``grade`` the likeliest. Without usable labels, or with one class alone, every
    document is clean. Rows that repeat come back each, with equal values; an empty table gives no rows.
    """
    model = fit_toxicity(docs, labels)
    return docs.select("doc_id", severity_column(model).alias("s")).select("doc_id", "s.severity", "s.grade", "s.toxic")

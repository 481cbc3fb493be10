"""Quality by co-training: a text view and a page view teach each other, and their calibrated answers are joined.

The text view sees the words: frequencies of short patterns of character classes and how words repeat. The page view sees no characters, only
what a crawl's records tell of a page: source, language, size and the lengths of its lines. Both start from labelled documents; in each round
either gives the other the unlabelled documents it is surest of, with its answer as label. Each view's log-odds are then calibrated on
labelled documents kept apart, and there too the joint log-odds are fitted as a weighted sum of both views'.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import give_back, giving_back, slices, text_batches, word_hashes
from thalweg.llm.features import labelled_sample, texts_of

#: The most labelled documents of each class, and unlabelled ones, that the views are fitted on.
PER_CLASS, UNLABELLED = 3000, 4000
ROUNDS = 4
#: Documents of either answer that a view hands over in a round.
HANDED = 200
HELD_OUT = 4
STEPS, RATE, RIDGE = 250, 0.05, 1e-4
PATTERNS = 512
SOURCES, LANGS = 64, 16
#: A document stays from this score on: of two errors, rejecting good text is the worse.
KEEP_FROM = 0.35
_BATCH = 1 << 20

# Character classes: upper, lower, digit, space, line end, sentence marks, other marks, bytes beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
for _range, _to in (((65, 91), 0), ((97, 123), 1), ((48, 58), 2), ((128, 256), 7)):
    _CLASS[_range[0] : _range[1]] = _to
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
_CLASS[[33, 39, 44, 46, 58, 59, 63]] = 5


def text_view(texts: list[bytes]) -> np.ndarray:
    """Rows of the text view: shares of hashed patterns of four character classes, and repetition of words."""
    n = len(texts)
    out = np.zeros((n, PATTERNS + 4), np.float32)
    if not n:
        return out
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    if len(raw) >= 4:
        c = _CLASS[raw].astype(np.uint32)
        code = c[:-3] | c[1:-2] << 3 | c[2:-1] << 6 | c[3:] << 9
        code = (code * np.uint32(2654435761)) >> np.uint32(23)
        owner = np.repeat(np.arange(n), sizes)
        whole = owner[:-3] == owner[3:]
        counts = np.bincount(owner[:-3][whole] * PATTERNS + code[whole], minlength=n * PATTERNS).reshape(n, PATTERNS)
        out[:, :PATTERNS] = np.log1p(1000 * counts / np.maximum(1, sizes)[:, None])
    words, counts = word_hashes(texts)
    at = 0
    for k, m in enumerate(counts.tolist()):
        if m:
            own = words[at : at + m]
            _, times = np.unique(own, return_counts=True)
            out[k, PATTERNS:] = len(times) / m, (own[1:] == own[:-1]).mean() if m > 1 else 0, times.max() / m, np.log1p(m)
        at += m
    return out


#: Upper ends of the classes of line lengths, in bytes.
LINE_CLASSES = (1, 40, 80, 160, 320, 640, 1280)


def page_view(sizes: list[np.ndarray], sources: list[str | None], langs: list[str | None]) -> np.ndarray:
    """Rows of the page view: hashed source and language, size, and the layout, from the lengths of each document's lines."""
    n = len(sizes)
    out = np.zeros((n, SOURCES + LANGS + 6 + len(LINE_CLASSES)), np.float32)
    for k, (lines, source, lang) in enumerate(zip(sizes, sources, langs, strict=True)):
        out[k, zlib.crc32((source or "").encode()) % SOURCES] = 1
        out[k, SOURCES + zlib.crc32((lang or "").encode()) % LANGS] = 1
        total, count = int(lines.sum()), len(lines)
        shares = np.bincount(np.searchsorted(LINE_CLASSES, lines, "left"), minlength=len(LINE_CLASSES) + 1)[: len(LINE_CLASSES)] / count
        out[k, SOURCES + LANGS :] = (np.log1p(total), np.log1p(count), np.log1p(lines.mean()), np.log1p(lines.max()), lines.std() / (1 + lines.mean()), 1 - len(np.unique(lines)) / count, *shares)
    return out


def line_sizes(texts: list[bytes]) -> list[np.ndarray]:
    """The lengths of the lines of each text, at least one."""
    return [np.fromiter(map(len, t.split(b"\n")), np.int64) for t in texts]


@dataclass(frozen=True)
class Logistic:
    """A logistic regression on standardised features, and the line that calibrates its log-odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return self.slope * self.raw(x) + self.shift


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> Logistic:
    """Weighted logistic regression by Adam over all rows."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale < 1e-6, 1.0, scale).astype(np.float32)
    z = (x - mean) / scale
    weight = (weight / weight.sum()).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), float(np.log((weight[y].sum() + 1e-6) / (weight[~y].sum() + 1e-6)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        error = (_logistic(z @ w + b) - y) * weight
        grad = np.append(z.T @ error + RIDGE * w, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = (w - step[:-1]).astype(np.float32), b - float(step[-1])
    return Logistic(mean.astype(np.float32), scale, w, b)


def calibrate(model: Logistic, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Logistic:
    """Fit slope and shift of the log-odds on documents that the model has not seen."""
    if not y.any() or y.all():
        return model
    raw = model.raw(x)[:, None].astype(np.float32)
    line = fit_logistic(raw, y, weight, 200)
    slope = float(line.weights[0] / line.scale[0])
    return Logistic(model.mean, model.scale, model.weights, model.bias, slope, float(line.bias - slope * line.mean[0]))


@dataclass(frozen=True)
class QualityModel:
    """Both views, and how their log-odds are joined."""

    text: Logistic | None
    page: Logistic | None
    both: Logistic | None = None

    def scores(self, texts: list[bytes], sources: list[str | None], langs: list[str | None]) -> np.ndarray:
        """Rows of the text view's, the page view's and the joint chance of good quality."""
        if self.text is None:
            return np.ones((len(texts), 3))
        a, b = self.text.odds(text_view(texts)), self.page.odds(page_view(line_sizes(texts), sources, langs))
        return np.stack([_logistic(a), _logistic(b), _logistic(self.joint(a, b))], 1)

    def joint(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Log-odds of both views together."""
        return self.both.raw(np.stack([a, b], 1).astype(np.float32))


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, weight: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> QualityModel:
    """Train both views on labelled rows and on what the other is sure of in ``pool``; every ``HELD_OUT``-th labelled row calibrates."""
    if not len(y) or y.all() or not y.any():
        return QualityModel(None, None)
    held = np.arange(len(y)) % HELD_OUT == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    learn = ~held
    given: list[dict[int, bool]] = [{}, {}]  # pseudo-labels by view
    models: list[Logistic] = []
    typical = float(weight.mean())
    for turn in range(rounds + 1):
        models = []
        for k in (0, 1):
            rows = sorted(given[k])
            x = np.concatenate([views[k][learn], pool[k][rows]])
            models.append(fit_logistic(x, np.append(y[learn], [given[k][r] for r in rows]).astype(bool), np.append(weight[learn], np.full(len(rows), typical))))
        if turn == rounds or not len(pool[0]):
            break
        for k in (0, 1):
            odds = models[k].raw(pool[k])
            order = np.argsort(odds, kind="stable")
            for r in [r for r in order[:HANDED].tolist() if odds[r] < -2]:
                given[1 - k].setdefault(r, False)
            for r in [r for r in order[::-1][:HANDED].tolist() if odds[r] > 2]:
                given[1 - k].setdefault(r, True)
    check = held if held.any() else learn
    text, page = (calibrate(m, v[check], y[check], weight[check]) for m, v in zip(models, views, strict=True))
    odds = np.stack([text.odds(views[0][check]), page.odds(views[1][check])], 1).astype(np.float32)
    return QualityModel(text, page, fit_logistic(odds, y[check], weight[check], 400))


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        sources, langs = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), _BATCH):
            a, b = text_view(texts[i:j]), page_view(line_sizes(texts[i:j]), sources[i:j], langs[i:j])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(4).slice(i, j - i), pa.array([r.tobytes() for r in a]), pa.array([r.tobytes() for r in b])], names=["doc_id", "label", "a", "b"])


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")])


def _sampled(rows: DataFrame) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    table = rows.mapInArrow(giving_back(_views), "doc_id long, label int, a binary, b binary").toArrow().combine_chunks().sort_by("doc_id")
    views = []
    for name, like in (("a", text_view([])), ("b", page_view([], [], []))):
        views.append(np.frombuffer(b"".join(table.column(name).to_pylist()), np.float32).reshape(-1, like.shape[1]))
    return table.column("label").to_numpy(), (views[0], views[1])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, unlabelled: int = UNLABELLED) -> QualityModel:
    """Co-train on at most ``per_class`` documents of each label and ``unlabelled`` without one, chosen by hashes of doc_id."""
    text_batches(docs.sparkSession)
    source = _columns(docs)
    sample, totals = labelled_sample(source, labels, label, per_class)
    value, views = _sampled(sample.select("doc_id", "text", "source", "lang", "_label"))
    value = value.astype(np.int64)
    seen = {v: max(1, int((value == v).sum())) for v in totals}
    weight = np.array([totals[int(v)] / seen[int(v)] for v in value], float)
    free = source.select("doc_id").filter("doc_id is not null").join(labels.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_anti")
    ids = docs.sparkSession.createDataFrame(free.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled).collect(), "doc_id long")
    _, pool = _sampled(source.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "source", "lang", F.lit(0).alias("_label")))
    return co_train(views, value > 0, weight, pool)


def quality_column(model: QualityModel):
    """A column struct<p_text, p_page, score, keep> from columns text, source and lang; nulls count as empty."""

    @F.arrow_udf("struct<p_text:double,p_page:double,score:double,keep:boolean>")
    def score(text: pa.Array, source: pa.Array, lang: pa.Array) -> pa.Array:
        texts, sources, langs = texts_of(text), source.to_pylist(), lang.to_pylist()
        out = np.empty((len(texts), 3))
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), _BATCH):
            out[i:j] = model.scores(texts[i:j], sources[i:j], langs[i:j])
        out = np.round(out, 6)
        give_back()
        return pa.StructArray.from_arrays([*(pa.array(out[:, k].copy()) for k in range(3)), pa.array(out[:, 2] >= KEEP_FROM)], ["p_text", "p_page", "score", "keep"])

    return score(*[F.col(c).cast("string") for c in ("text", "source", "lang")])


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, p_text, p_page, score, keep) for each row of ``docs`` (doc_id, text, source, lang, any more columns).

    Without usable labels, or with one class alone, every document is kept. Rows that repeat come back each, with equal
    values; an empty table gives no rows.
    """
    model = fit_quality(docs, labels)
    return docs.select("doc_id", quality_column(model).alias("s")).select("doc_id", "s.p_text", "s.p_page", "s.score", "s.keep")

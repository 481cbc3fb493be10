import random

import numpy as np
import pytest

from thalweg.llm import quality, toxicity
from thalweg.llm.features import labelled_sample, word_features

DATA = "/root/testdata/sf0.1"


def prose(r, n):
    return " ".join("".join(r.choice(["ti", "on", "er", "an", "the", "re"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_features_are_distinct_words_and_beginnings():
    rows, cols = word_features([b"Alpha beta, ALPHA", b"", b"alpha"], 20)
    both = [set(cols[rows == k].tolist()) for k in range(3)]
    assert len(both[0]) == 5 and not both[1] and both[2] < both[0]  # two words, beginnings of 4 and of 5 bytes, less the one of "beta"


def test_ordinal_regression_finds_grades_and_keeps_thresholds_in_order():
    r = np.random.default_rng(1)
    n = 3000
    x = r.random((n, 6)) < 0.3
    latent = x @ np.array([2.0, 1.5, 1.0, 0, 0, -1.0]) + r.logistic(size=n) * 0.3
    grade = np.digitize(latent, [1.0, 2.5, 3.5])
    rows, cols = np.nonzero(x)
    model = toxicity.fit_ordinal(rows, cols, grade, np.ones(n), np.arange(6))
    assert (np.diff(model.thresholds) > 0).all()
    w = model.weights / model.weights[0] * 2
    assert np.abs(w[:3] - [2, 1.5, 1]).max() < 0.35 and np.abs(w[3:5]).max() < 0.35 and w[5] < -0.5
    chance = model.chances(np.array([0.0, 5.0]))
    assert np.allclose(chance.sum(1), 1) and (chance >= 0).all()


def test_learning_skips_near_copies():
    rows = np.repeat(np.arange(5), 40)
    cols = np.concatenate([np.arange(40), np.arange(40), np.append(np.arange(39), 99), np.arange(100, 140), np.arange(200, 240)])
    assert toxicity.unlike_rows(rows, cols, 6).tolist() == [True, False, False, True, True, True]


def test_toxic_words_are_found_in_new_documents(spark):
    r = random.Random(3)
    bad = ["vilew", "grimeq", "zorkle"]
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(r, r.randint(20, 200)).split(), i % 6 == 0
        if toxic:
            for _ in range(r.randint(1, 5)):
                words[r.randrange(len(words))] = r.choice(bad) + r.choice(["", "s", "ing"])
        rows.append((i, " ".join(words), "x"))
        if i < 400:
            labels.append((i, int(toxic), None))
    docs = spark.createDataFrame([*rows, (900, None, "x"), (901, "", "x"), (901, "", "x")], "doc_id long, text string, toxic string")
    got = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int, grade int")).collect()
    assert len(got) == 603 and all(0 <= x.severity <= 3 for x in got)
    new = [x for x in got if 400 <= x.doc_id < 600]
    assert np.mean([x.toxic == (x.doc_id % 6 == 0) for x in new]) > 0.97
    assert not any(x.toxic for x in got if x.doc_id >= 900)


def test_given_grades_are_learnt_and_found_in_new_documents(spark):
    r = random.Random(5)
    marks = {1: ["mildx", "poutz"], 2: ["meanq", "slurv"], 3: ["vilew", "zorkle"]}
    rows, labels = [], []
    for i in range(1600):
        words, grade = prose(r, r.randint(30, 120)).split(), r.choice([0, 0, 0, 1, 2, 3])
        for _ in range(3 if grade else 0):
            words[r.randrange(len(words))] = r.choice(marks[grade])
        rows.append((i, " ".join(words), grade))
        if i < 1200:
            labels.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string, g int")
    got = {x.doc_id: x for x in toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    new = [(g, got[i].severity, got[i].grade) for i, _, g in rows if i >= 1200]
    assert np.mean([g == own for g, _, own in new]) > 0.93
    means = [np.mean([s for g, s, _ in new if g == k]) for k in range(4)]
    assert all(abs(m - k) < 0.35 for k, m in enumerate(means)), means


def test_grades_come_from_models_that_have_not_seen_the_document():
    # a mark that one document alone has can't raise its own grade, marks that many share can
    n = 400
    toxic = np.arange(n) < 200
    rows, cols = [], []
    for i in range(n):
        own = ([1] if toxic[i] else []) + ([2, 3] if i < 60 else []) + [1000 + i] * 1
        rows += [i] * len(own)
        cols += own
    scores = toxicity.unseen_scores(np.array(rows), np.array(cols), toxic, np.ones(n))
    assert len(set(np.round(scores[60:200], 1))) <= toxicity.FOLDS and scores[:60].min() > scores[60:200].max() and scores[60:200].min() > scores[200:].max()
    grade = toxicity.severity_grades(toxic, scores)
    assert (grade[200:] == 0).all() and grade[:60].min() > grade[60:200].max() >= 1


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "en"), (None, None, None, None)], "doc_id long, text string, source string, lang string")
    for rows in ([], [(1, None, None)], [(1, 1, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert [x.toxic for x in toxicity.score_toxicity(docs, labels).collect()] == [False, False]
        assert [x.keep for x in quality.score_quality(docs, labels).collect()] == [True, True]
        assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_samples_are_bounded_and_repeatable(spark):
    docs = spark.range(1000).select("id").withColumnRenamed("id", "doc_id")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 10 = 0 AS INT) AS q")
    rows, totals = labelled_sample(docs, labels, "q", 50)
    again, _ = labelled_sample(docs.repartition(3), labels.repartition(5), "q", 50)
    assert totals == {0: 900, 1: 100} and sorted(map(tuple, rows.collect())) == sorted(map(tuple, again.collect())) and rows.count() == 100


def test_views_teach_each_other():
    r = np.random.default_rng(2)
    y = r.random(4000) < 0.7
    views = tuple((np.where(y, 1, -1)[:, None] * s + r.normal(size=(4000, 5))).astype(np.float32) for s in (0.8, 0.6))
    few = np.arange(60)
    model = quality.co_train(tuple(v[few] for v in views), y[few], np.ones(60), tuple(v[60:3000] for v in views))
    a, b = model.text.odds(views[0][3000:]), model.page.odds(views[1][3000:])
    assert ((model.joint(a, b) > 0) == y[3000:]).mean() > 0.93


def test_the_page_view_sees_no_characters():
    texts = [b"One line.\n\nAnother LINE 7!", b"xxx xxxxx\n\n!!!!!!! ABCD 99"]
    a, b = quality.page_view(quality.line_sizes(texts), ["s", "s"], ["en", "en"])
    assert a.tolist() == b.tolist() and quality.page_view(quality.line_sizes([b""]), [None], [None]).shape == (1, len(a))


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_held_out_accuracy(spark, name):
    """Fitted on labels of ids not divisible by 5, judged on the others."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    held = {r.doc_id: getattr(r, name) for r in labels.filter("doc_id % 5 = 0").collect()}
    rest = labels.filter("doc_id % 5 <> 0")
    if name == "quality":
        got = {r.doc_id: r.keep for r in quality.score_quality(docs, rest).collect()}
    else:
        got = {r.doc_id: r.toxic for r in toxicity.score_toxicity(docs, rest).collect()}
    right = [got[d] == bool(v) for d, v in held.items()]
    clean = [got[d] == bool(v) for d, v in held.items() if v == (name == "quality")]
    assert np.mean(right) > 0.97 and np.mean(clean) > 0.99

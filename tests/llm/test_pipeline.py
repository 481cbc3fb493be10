import collections

import numpy as np

import corpus_pipeline
from tokenizers import Tokenizer

from thalweg.llm import quality, toxicity
from thalweg.llm.bytesops import shingle_sets
from thalweg.llm.queries import tokenizer_path


SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide_as_plain_code_does(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near duplicates", "packing"]
    (_, keep_quality), (_, drop_toxic), (_, drop_near), (_, pack) = corpus_pipeline.STAGES

    rows = {r.doc_id: r for r in docs.collect()}
    one = keep_quality(spark, docs, SF)
    assert one.columns == docs.columns
    model = quality.fit_quality(docs, labels)
    score = model.scores([r.text.encode() for r in rows.values()], [r.source for r in rows.values()], [r.lang for r in rows.values()])[:, 2]
    kept = {d for d, s in zip(rows, score, strict=True) if round(s, 6) >= quality.KEEP_FROM}
    assert {r.doc_id for r in one.collect()} == kept

    two = drop_toxic(spark, one, SF)
    assert two.columns == docs.columns
    ids = sorted(kept)
    model = toxicity.fit_toxicity(one, labels)
    chance = model.chances(model.scores([rows[d].text.encode() for d in ids]))
    kept = {d for d, s in zip(ids, 1 - chance[:, 0], strict=True) if s < toxicity.TOXIC_FROM}
    assert {r.doc_id for r in two.collect()} == kept

    three = drop_near(spark, two, SF)
    assert three.columns == docs.columns
    ids = sorted(kept)
    sets = shingle_sets([rows[d].text.encode() for d in ids], 5)
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    last = {ids[k] for k in range(len(ids)) if find(k) == k}
    assert {r.doc_id for r in three.collect()} == last

    engine = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    tokens = collections.Counter()
    for p in pack(spark, three, SF).collect():
        tokens[p.doc_id] += p.length
    assert tokens == {d: len(engine.encode(rows[d].text, add_special_tokens=False).ids) + 1 for d in last}


def test_of_rows_that_repeat_an_id_the_smallest_text_stays(spark):
    rows = [(1, "b b b", "en", "s", 5), (1, "a a a", "fr", "s", 5), (1, "a a a", "en", "t", 5), (2, None, "en", "s", 0), (2, "z", "en", "s", 1), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 4):
        got = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), SF).collect()), key=str)
        assert got == sorted([(1, "a a a", "en", "t", 5), (2, None, "en", "s", 0), rows[5], rows[6]], key=str)


def test_the_run_is_its_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
    want = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    # every id of every document that is left lies in one piece
    engine = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    spans = collections.defaultdict(list)
    for p in got:
        spans[p.doc_id].append((p.start, p.start + p.length))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert spans.keys() == texts.keys()
    for d, own in spans.items():
        own.sort()
        assert own[0][0] == 0 and all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False)) and own[-1][1] == len(engine.encode(texts[d], add_special_tokens=False).ids) + 1


def test_odd_rows_pass(spark):
    docs = spark.createDataFrame([(None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (1, "", "en", "a", 0, 1), (2, None, "en", "a", 0, 1)], "doc_id long, text string, lang string, source string, n_chars long, _score int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() >= 3
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 4

import random
import zlib

import numpy as np
import pytest

from thalweg.llm import pieces
from thalweg.llm.pieces import EDGE, PieceModel, chunks_of, combine, decode_texts, encode_chunked, encode_texts, lead, normalise
from thalweg.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel.at(PATH)


def some_texts():
    r = random.Random(8)
    alphabet = ["a", "b", " ", "  ", "é", "\n", "漢", "😀", "the", "quick", "².", "_", "ing", "!", "1", "\x00", "▁", "tion", "er", "==", "//"]
    odd = ["", " ", "The quick brown fox.\nJumps over 42 dogs!", "abcde" * 200, "▁ ▁" * 50, "x" * 300, " " * 200, "=" * 300, "averylongwordwithoutanyspaces" * 10, "a▁", "\n\n▁"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 70))) for _ in range(500)] + odd


def test_ids_are_the_librarys(model):
    for t, ids in zip(some_texts(), model.encode(some_texts()), strict=True):
        assert ids.tolist() == model.sp.encode(t), t
        assert model.decode(ids)[1:] == t.replace("▁", " ")


@pytest.mark.parametrize("size", [16, 17, 50])
def test_the_scan_over_chunks_gives_them_too(model, size):
    for t in some_texts():
        assert encode_chunked(model, t, size) == model.sp.encode(t), t


def test_merging_short_strings_is_the_librarys(model):
    r = random.Random(3)
    for _ in range(500):
        t = "".join(r.choice(["a", "e", "th", "in", "on", "x", "é", "1"]) for _ in range(r.randint(1, 12)))
        assert [i for p in model.merged("▁" + t) for i in model.ids(p)] == model.sp.encode(t)


def test_matrices_combine_associatively_to_the_whole_score(model):
    text = normalise("the quick brown fox jumps over thelazydogwithoutspaces " * 4)
    chunks = [model.chunk(*c).matrix() for c in chunks_of(text, 40, model.longest)]
    left, right = chunks[0], chunks[-1]
    for m in chunks[1:]:
        left = combine(left, m)
    for m in reversed(chunks[:-1]):
        right = combine(m, right)
    assert left == right and set(left) == {(EDGE, EDGE)}
    assert left[EDGE, EDGE] == sum(model.score[model.pieces[i]] for i in model.sp.encode(text[1:].replace("▁", " ")))
    assert lead({EDGE: 0}, left) == {EDGE: left[EDGE, EDGE]}


def test_tables(spark, model, monkeypatch):
    monkeypatch.setattr(pieces, "FAN", 4)  # several steps of the tree
    texts = [None, "", "short one", "long " * 300 + "\n" + "x" * 500, "long " * 300 + "\n" + "x" * 500, "é" * 700, "end ▁ mark", "one_" * 400 + "a b " * 100, "y" * 101]
    docs = spark.createDataFrame([(i, t, "row", 3) for i, t in enumerate(texts)] + [(None, "no id " * 30, "row", 3)], "doc_id long, text string, row string, i int")
    encoded = encode_texts(docs, PATH, chunk=100)
    got = sorted(encoded.collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.chunk))
    back = {(r.doc_id, r.chunk): r.text for r in decode_texts(encoded, PATH).collect()}
    for i, t in [*enumerate(texts), (None, "no id " * 30)]:
        rows = [r for r in got if r.doc_id == i]
        assert [k for r in rows for k in r.ids] == model.sp.encode(t or "") and all(r.round_trip for r in rows)
        assert [r.chunk for r in rows] == list(range(rows[0].n_chunks)) and rows[0].n_chunks == max(1, -(-(len(t or "") + 1) // 100) if len(t or "") > 100 else 1)
        assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
        assert "".join(back[i, r.chunk] for r in rows) == (t or "").replace("▁", " ")
    assert encode_texts(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        encode_texts(docs, PATH, chunk=3)


def test_repeated_rows_come_back_each(spark, model):
    docs = spark.createDataFrame([(1, "z" * 90 + " word" * 20)] * 3 + [(1, "short")] * 2, "doc_id long, text string")
    got = encode_texts(docs, PATH, chunk=64).collect()
    assert sorted((r.n_chunks, r.chunk) for r in got) == sorted([(3, 0), (3, 1), (3, 2)] * 3 + [(1, 0)] * 2)

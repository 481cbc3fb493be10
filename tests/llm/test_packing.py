import collections
import random

import numpy as np
from tokenizers import Tokenizer

from thalweg.llm import packing
from thalweg.llm.packing import END_ID, Mixture, WordTokenizer, ids_crc32, pack_documents
from thalweg.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def tm(size, letters="ab"):
    """The word of Thue and Morse, whose polynomial hashes modulo powers of two equal its complement's."""
    return "".join(letters[bin(k).count("1") % 2] for k in range(size))


def test_ids_are_the_tokenizers():
    engine, words = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    r = random.Random(5)
    pieces = [*"aAbÉé ß'’.,!\n\t1٣中́İΣσς  <|>#\x1c-_²½×", "don't ", "I'VE ", "word ", "<|endoftext|>", "ing", "한", "\u0085", "\xa0", "ǅ"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["", "plain words, only. Two!! 42 x_y", "x" * 50_000, " " * 100]
    for t, ids in zip(texts, words.ids(texts), strict=True):
        assert ids.tolist() == engine.encode(t, add_special_tokens=False).ids, repr(t)


def check(rows, got, window):
    engine = Tokenizer.from_file(PATH)
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for x in got:
        by_doc[x.doc_id].append(x)
        by_seq[x.sequence_id].append(x)
    for doc_id, text, *_ in rows:
        ids = [*engine.encode(text or "", add_special_tokens=False).ids, END_ID]
        at = 0
        for x in sorted(by_doc[doc_id], key=lambda x: x.start):
            assert x.start == at and x.length > 0 and x.doc_tokens == len(ids) and x.ids_crc32 == ids_crc32(ids[at : at + x.length])
            at += x.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at == window or at & (at - 1) == 0
    return by_seq


def test_every_id_lies_in_one_piece(spark):
    r = random.Random(2)
    words = ["the", "and", "river", "Lake,", "don't", "xyzzy", "é"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 30, 400]))), r.choice(["a", "a", "a", "b", None]), 5) for i in range(300)] + [(300, None, "a", 5), (301, "long " * 5000, "c", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, length long").repartition(6)
    got = pack_documents(docs, PATH, window=256, least_piece=32).collect()
    check(rows, got, 256)
    again = pack_documents(docs.repartition(3), PATH, window=256, least_piece=32).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def furthest(got, targets, window):
    """How far any source is from its target after any full window, in tokens; all sources must last."""
    scale = sum(targets.values())
    served, worst = collections.Counter(), 0.0
    by_seq = collections.defaultdict(list)
    for x in got:
        by_seq[x.sequence_id].append(x)
    for n, seq in enumerate(sorted(by_seq), 1):
        for x in by_seq[seq]:
            served[x.source] += x.length
        if sum(x.length for x in by_seq[seq]) == window:
            worst = max(worst, *(abs(served[s] - t / scale * window * n) for s, t in targets.items()))
    return worst


def test_every_window_follows_the_corpus_mixture(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_WINDOWS", 7)
    r = random.Random(4)
    rows = [(i, " ".join(["river"] * r.randint(1, 60)), "a" if i % 3 else r.choice(["b", "c", None])) for i in range(900)] + [(900, "lake " * 40_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = pack_documents(docs, PATH, window=128, least_piece=16).collect()
    check(rows, got, 128)
    totals = collections.Counter()
    for x in got:
        totals[x.source] += x.length
    share = sum(totals.values())
    assert all(abs(x.target - totals[x.source] / share) < 1e-9 for x in got)
    # deficits are carried over windows and over the ends of partitions, a few windows apart here
    assert len({x.sequence_id for x in got}) > 300 and furthest(got, totals, 128) <= 16 + len(totals) * 16


def test_a_mixture_of_other_shares_lasts_while_its_sources_do(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_WINDOWS", 5)
    rows = [(i, "word " * 99, "ab"[i % 2]) for i in range(400)] + [(500 + i, "word " * 99, "z") for i in range(20)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), PATH, window=100, targets={"a": 3, "b": 1}, least_piece=10).collect()
    check(rows, got, 100)
    # the 20,000 tokens of a last for 266 windows, then b goes on, and z, which has no target, comes last
    assert furthest([x for x in got if x.sequence_id < 266], {"a": 3, "b": 1}, 100) <= 40
    assert {x.source for x in got if x.sequence_id < 390} == {"a", "b"} and {x.source for x in got if x.sequence_id >= 401} == {"z"}


def test_cuts_are_whole_and_rise():
    r = np.random.default_rng(3)
    for _ in range(50):
        totals = r.integers(1, 5000, r.integers(1, 9)).astype(np.int64)
        mix = Mixture(tuple(map(str, range(len(totals)))), totals, r.choice([totals.astype(float), r.random(len(totals)) * (r.random(len(totals)) < 0.8)]) if len(totals) > 1 else totals.astype(float))
        windows = mix.total // 64
        firsts = np.arange(7) * windows // 7
        cuts = mix.cuts(firsts, 64)
        assert (np.diff(cuts, axis=0) >= 0).all() and (cuts[-1] == totals).all()
        assert cuts.sum(1).tolist() == [*(firsts * 64).tolist(), mix.total]
        assert np.abs(cuts[:-1] - mix.due(firsts * 64)).max() < 2


def test_runs_of_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    texts = ["".join(c) + " plain text" for c in (tm(1024), tm(1024, "ba"), tm(2048), "riverbank", "lakeshore")]
    engine = Tokenizer.from_file(PATH)
    want = [engine.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in WordTokenizer(PATH).ids(texts)] == want
    # even with a hash of no use at all
    monkeypatch.setattr(packing, "block_hashes", lambda blocks, first, lens: (lens % 2).astype(np.uint64))
    words = WordTokenizer(PATH)
    for _ in range(2):
        assert [x.tolist() for x in words.ids(texts)] == want
        assert [words.ids([t])[0].tolist() for t in texts] == want


def test_an_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string, source string"), PATH).count() == 0


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "same text", "a"), (1, "same text", "a"), (None, "none", None)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), PATH).collect()
    assert sorted(str((x.doc_id, x.start == 0, x.length <= x.doc_tokens)) for x in got if x.start == 0) == sorted([str((1, True, True))] * 2 + [str((None, True, True))])


def test_cuts_among_equal_rows_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_WINDOWS", 1)
    rows = [(1, "same text of seven words here now", "a")] * 300 + [(2, "w " * 40_000, "a"), (None, None, None)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), PATH, window=64, least_piece=8).collect()
    seen = collections.Counter()
    for x in got:
        seen[x.doc_id] += x.length
    assert seen == {1: 300 * 8, 2: 40_001, None: 1}
    for pieces in collections.defaultdict(list, {s: [x for x in got if x.sequence_id == s] for s in {x.sequence_id for x in got}}).values():
        assert sorted((x.offset, x.offset + x.length) for x in pieces)[-1][1] == sum(x.length for x in pieces)

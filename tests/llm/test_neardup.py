import random
import re

import numpy as np
import pytest

from thalweg.llm.neardup import BLOCK, SAMPLES, band_rows, estimate, minhash, near_duplicates, odd_sketches


def strings(text, width):
    """The shingles of a text as strings."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    """Components of doc_ids by all pairs of full sets of strings."""
    sets = [strings(t, width) for _, t in rows]
    ids = [d for d, _ in rows]
    root = {d: d for d in ids if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if ids[i] is None or ids[j] is None or not a or not b:
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(ids[i]), find(ids[j])
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in zip(ids, sets, strict=True) if d is not None}


def corpus():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for base in range(12):
        words = [word() for _ in range(r.choice([2, 5, 40, 120, 400]))]
        for _ in range(r.randint(1, 9)):
            own = list(words)
            for _ in range(r.randint(0, max(1, len(own) // 25))):
                own[r.randrange(len(own))] = word()
            rows.append(" ".join(own).upper() if r.random() < 0.2 else "\n".join(own))
    rows += [None, "", "  \n", "one", "ONE", "one two", "é  é", "x " * 30_000]
    rows += ["".join(c[bin(k).count("1") % 2] for k in range(1024)) for c in ("ab", "ba")]  # disjoint, though polynomial hashes take them for one
    r.shuffle(rows)
    return [(i * 2, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(spark, width, percent):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1, "n") for d, t in rows], "doc_id long, text string, kept int, id string").repartition(5)
    got = near_duplicates(docs, width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_a_bucket_of_many_blocks(spark):
    r = random.Random(2)
    words = [str(r.random()) for _ in range(150)]
    rows = []
    for i in range(2 * BLOCK + 200):
        own = list(words)
        own[i % 150] = f"w{i}"
        own[(i * 7 + 3) % 150] = f"v{i}"
        rows.append((i, " ".join(own)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {x.component_id for x in got} == {0} and sum(x.kept for x in got) == 1


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(map(str, range(50)))
    rows = [(4, text), (4, text), (None, text), (9, text), (None, "lone words here"), (4, "other words entirely here now")]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()), key=str)
    assert got == sorted([(4, 48, 4, True), (4, 48, 4, True), (None, 48, 4, False), (9, 48, 4, False), (None, 1, None, False), (4, 3, 4, True)], key=str)


def test_an_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketches_estimate_high_similarities():
    r = np.random.default_rng(0)
    base = r.integers(0, 2**63, 2000, dtype=np.uint64)
    for share in (0.8, 0.9, 0.97):
        k = int(2000 * 2 * share / (1 + share))
        other = np.concatenate([base[:k], r.integers(0, 2**63, 2000 - k, dtype=np.uint64)])
        a, b = odd_sketches(minhash([np.sort(base), np.sort(other)]))
        assert abs(estimate(np.bitwise_count(a ^ b).sum()) - share) < 0.08
    for t in (0.8, 0.85):
        n = band_rows(t)
        assert (1 - t**n) ** (SAMPLES // n) <= 1e-5

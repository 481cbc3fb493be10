from collections import Counter

from thalweg.llm.license import LEAST, TEMPLATES, bigrams, normal_words, scan_licenses, size_bounds


def brute(text):
    if not text:
        return 0, None, None, ""
    lines = text.split("\n")
    blocks, now = [], []
    for line in lines:
        if not normal_words(line) and not line.strip():
            blocks.append(now)
            now = []
        else:
            now.append(line)
    blocks.append(now)
    passages = lines + ["\n".join(b) for b in blocks if len(b) > 1]
    found = []
    for p in passages:
        own = Counter(bigrams(p))
        best = (0, "")
        for name, t in TEMPLATES.items():
            other = Counter(bigrams(t))
            if own:
                best = max(best, (round(2 * sum((own & other).values()) / (sum(own.values()) + sum(other.values())), 6), name))
        if best[0] >= LEAST:
            found.append(best)
    top = max(found, default=(None, None))
    return len(found), top[1], top[0], ";".join(sorted({n for _, n in found}))


TEXTS = [
    None, "", "\n\n", "Licensed under the Apache License, Version 2.0.", "a\nReleased under the MIT license\nb", "RELEASED   under the\tMIT License!!", "Released under the", TEMPLATES["MIT grant"].replace(", ", ",\n"),
    "x\n\n" + TEMPLATES["MIT grant"].replace(" to ", "\nto ") + "\n\ny", "Released under the MIT License. " * 3, TEMPLATES["BSD grant"] + "\n" + TEMPLATES["CC-BY-4.0 short"], "word " * 40_000, "This work is licensed under a Creative Commons License.",
]


def test_the_native_form_gives_what_plain_counting_gives(spark):
    docs = spark.createDataFrame([(i, t, "a", 1.0) for i, t in enumerate(TEXTS)], "doc_id long, text string, license string, dice double")
    got = {r.doc_id: (r.n_passages, r.license, r.dice, r.licenses) for r in scan_licenses(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_no_python_runs_on_the_main_path(spark):
    plan = scan_licenses(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_size_bounds_never_cut_a_passage_that_fits():
    for m in range(1, 60):
        lo, hi = size_bounds(m)
        for n in range(1, 120):
            if 2 * min(m, n) / (m + n) >= LEAST:
                assert lo <= n <= hi

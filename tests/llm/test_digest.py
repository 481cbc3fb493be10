import base64
import collections
import hashlib
import math
import random

import numpy as np

from thalweg.llm.digest import _MULT, SCALE, WINDOW, digests, entropy_counts, features, fingerprint_neighbours, likeness, parse, rarity_ranks, render, window_entropy


def noise(n, seed, alphabet="abcdefgh ijkl"):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


def test_entropy_is_exact_to_its_scale():
    text = noise(700, 1).encode()
    got = window_entropy(np.frombuffer(text, np.uint8))
    for i in range(len(text) - WINDOW + 1):
        c = collections.Counter(text[i : i + WINDOW])
        h = -sum(v / WINDOW * math.log2(v / WINDOW) for v in c.values())
        assert abs(got[i] - h / 6 * SCALE) < 1.001


def test_features_do_not_depend_on_company():
    texts = [noise(n, n).encode() for n in (0, 5, 63, 64, 65, 200, 1000, 5000)] + [b"x" * 3000, b""]
    ranks = rarity_ranks(entropy_counts(texts))
    h, o = features(texts, ranks)
    for k, t in enumerate(texts):
        alone, _ = features([t], ranks)
        assert alone.tolist() == h[o == k].tolist()
        assert len(alone) == len(set(alone.tolist()))
        assert (len(alone) > 0) == (len(t) > 0)


def test_likeness_orders_equal_edited_and_foreign_texts():
    a, b = noise(30_000, 1).encode(), noise(30_000, 2).encode()
    texts = [a, a[:15_000] + b[:15_000], b, b"", b""]
    rows, n = digests(texts, rarity_ranks(entropy_counts(texts)))
    at = np.cumsum(n) - n
    like = lambda i, j: likeness(rows[at[i] : at[i] + n[i]], n[i : i + 1], rows[at[j] : at[j] + n[j]], n[j : j + 1])[0]
    assert n[0] > 1 and like(0, 0) == 1 and like(3, 4) == 1 and like(0, 3) == 0
    assert 0.3 < like(0, 1) < 0.9 and like(0, 2) < 0.05
    assert (parse(render(rows[: n[0]])) == rows[: n[0]]).all()


def test_neighbours_are_those_of_the_whole_table(spark):
    rows = [(i * 3, noise(i % 17 * 40, i), "é") for i in range(200)] + [(600, None, "x"), (603, "", "x"), (606, "ü" * 301, "x"), (30, noise(90, 77), "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(7)
    got = fingerprint_neighbours(docs).collect()
    order = sorted(((d, t or "") for d, t, _ in rows), key=lambda r: (-r[0], r[1]))
    want = []
    for k, (d, t) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(r.doc_id, r.fingerprint)
    assert by_text[600] == by_text[603] == "0:"


class Plain:
    """Digests by the rules in their plainest form: a window, a vote and a bit at a time."""

    def __init__(self, texts):
        self.counts = collections.Counter(e for t in texts for e in self.entropies(t))
        order = sorted(range(1001), key=lambda e: (self.counts[e], e))
        self.rank = {e: 1000 if e < 100 or e > 990 else k for k, e in enumerate(order)}

    @staticmethod
    def entropies(t):
        one, top, out = 1 << 20, 6 * 64 << 20, []
        for i in range(len(t) - 63):
            c = collections.Counter(t[i : i + 64])
            out.append((top - sum(round(v * math.log2(v) * one) for v in c.values())) * 1000 // top)
        return out

    @staticmethod
    def mix(x):
        mask = (1 << 64) - 1
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    def features(self, t):
        if len(t) < 64:
            return [int.from_bytes(hashlib.sha1(t).digest()[:8], "little")] if t else []
        ranks = [self.rank[e] for e in self.entropies(t)]
        votes = collections.Counter()
        for i in range(len(ranks)):
            votes[min(range(i, min(i + 64, len(ranks))), key=lambda k: (ranks[k], k))] += 1
        chosen = sorted(k for k, v in votes.items() if v >= 16) or [min(votes, key=lambda k: (-votes[k], k))]
        out = []
        for k in chosen:
            h = 0
            for w, m in zip(range(0, 64, 8), _MULT.tolist(), strict=True):
                h = self.mix((h + int.from_bytes(t[k + w : k + w + 8], "little") * m) & (1 << 64) - 1)
            if h not in out:
                out.append(h)
        return out

    def filters(self, t):
        found = self.features(t)
        return [{h >> 11 * k & 2047 for h in found[i : i + 160] for k in range(5)} for i in range(0, len(found), 160)]

    @staticmethod
    def text(filters):
        raw = b"".join(bytes(sum(1 << 7 - b for b in range(8) if 8 * byte + b in f) for byte in range(256)) for f in filters)
        return f"{len(filters)}:{base64.b64encode(raw).decode()}"

    @staticmethod
    def score(f, g):
        if f == g:
            return 1.0
        most, chance = min(len(f), len(g)), len(f) * len(g) / 2048
        cut = chance + 0.1 * (most - chance)
        return min(1.0, (len(f & g) - cut) / max(most - cut, 1e-9)) if len(f & g) > cut else 0.0

    def likeness(self, a, b):
        if not a or not b:
            return float(not a and not b)
        a, b = sorted((a, b), key=len)
        return sum(max(self.score(f, g) for g in b) for f in a) / len(a)


def test_fingerprints_and_likenesses_are_those_of_plain_code(spark):
    texts = [noise(n, n) for n in (0, 1, 30, 63, 64, 65, 130, 300, 999, 2500)] + ["é漢" * 60, "x" * 200, "x" * 200, noise(15_000, 5), noise(15_000, 5)[:12_000] + noise(2000, 6), noise(400, 8) * 3]
    docs = spark.createDataFrame([(i * 7 % 101, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    plain = Plain([t.encode() for t in texts])
    order = sorted(((i * 7 % 101, t) for i, t in enumerate(texts)), reverse=True)
    got = {r.doc_id: r for r in fingerprint_neighbours(docs).collect()}
    chained = 0
    for k, (d, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        own, new, nxt = (plain.filters(x.encode()) for x in (t, edited, after))
        assert (got[d].fingerprint, got[d].edited_fingerprint) == (plain.text(own), plain.text(new))
        assert abs(got[d].near_edited - plain.likeness(own, new)) < 1e-9 and abs(got[d].near_next - plain.likeness(own, nxt)) < 1e-9
        chained += len(own) > 1
    assert chained >= 2


def test_small_tables(spark):
    schema = "doc_id long, text string"
    assert fingerprint_neighbours(spark.createDataFrame([], schema)).count() == 0
    (r,) = fingerprint_neighbours(spark.createDataFrame([(None, "abc" * 50)], schema)).collect()
    assert r.doc_id is None and r.near_next == 1.0

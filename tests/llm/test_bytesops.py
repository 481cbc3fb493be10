import random
from pathlib import Path

import numpy as np

from thalweg.llm.bytesops import give_back, giving_back, shingle_sets, slices, word_hashes


def brute(text: bytes, width: int) -> set:
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in text)
    words = [w for w in low.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return set()
    return {tuple(words)} if len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_sets_have_the_sizes_and_overlaps_of_brute_force():
    random.seed(3)
    alphabet = [b"a", b"B", b"b", "é".encode(), b" ", b"\n", b"  ", b"\x00", b"\x85"]
    texts = [b"".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(300)] + [b"", b" ", b"x", b"X y", b"x y z", b"w" * 100_000]
    sets = shingle_sets(texts, 3)
    for t, s in zip(texts, sets, strict=True):
        assert len(s) == len(brute(t, 3))
    for i in range(0, 300, 7):
        for j in range(0, 300, 11):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute(texts[i], 3) & brute(texts[j], 3))


def test_words_do_not_depend_on_company():
    texts = [b"One two", b"", b"  three ", b"four"]
    alone = [word_hashes([t])[0].tolist() for t in texts]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [2, 0, 1, 1]
    assert hashes.tolist() == [h for own in alone for h in own]


def test_slices_cover_all_rows():
    sizes = np.array([5, 0, 100, 1, 1, 1, 7])
    runs = list(slices(sizes, 8))
    assert [k for a, b in runs for k in range(a, b)] == list(range(7))
    assert all(b - a == 1 or sizes[a:b].sum() <= 8 for a, b in runs)
    assert list(slices(np.array([], int), 8)) == []


def test_words_that_defeat_polynomial_hashes_differ():
    for size in (512, 1024, 2048, 4096):
        a = "".join("ab"[bin(k).count("1") % 2] for k in range(size))
        b = a.translate(str.maketrans("ab", "ba"))
        hashes, _ = word_hashes([a.encode(), b.encode(), (a + b).encode(), (b + a).encode()])
        assert len(set(hashes.tolist())) == 4


def test_hashes_of_words_are_equal_exactly_if_the_words_are():
    random.seed(5)
    words = [bytes(random.choice(b"ab\x00\xc3") for _ in range(random.randint(1, 20))) for _ in range(20_000)]
    hashes, counts = word_hashes(words)
    assert counts.tolist() == [1] * len(words) and len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist(), strict=True)))


def _held_mb() -> float:
    own = Path("/proc/self/smaps_rollup").read_text()
    return sum(int(line.split()[1]) for line in own.splitlines() if line.startswith("Pss_Anon:")) / 1024


def test_a_kernel_gives_back_what_it_freed():
    def run(batches):
        for batch in batches:
            kept = [bytes(60_000) for _ in range(5000)]  # too small for pages of their own, so the allocator keeps them
            pin = bytes(60_000)
            del kept
            yield batch, pin

    give_back()
    before = _held_mb()
    pins = list(giving_back(run)(iter([1, 2, 3])))
    assert [b for b, _ in pins] == [1, 2, 3]
    assert _held_mb() - before < 60

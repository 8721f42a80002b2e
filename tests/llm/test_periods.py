import hashlib
import random
import time
import zlib
from fractions import Fraction

import pytest

from marlstone.llm.periods import find_runs, periodic_runs, without_repeats
from marlstone.llm.queries import op13_periodic_runs
from tests.llm.brute import by_id, empty_documents, odd_documents, rows


def brute(words):
    """Runs by comparing every word with the one a lag later, at every lag."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # the smallest lag comes first
            i = j
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def changed(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = [rng.choice("abc"[: 1 + seed % 3]) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            unit = [rng.choice("abcdef") for _ in range(rng.randrange(1, 9))]
            words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 60)]
            words += [rng.choice("xyzuvw") + str(rng.randrange(9)) for _ in range(rng.randrange(5))]
        assert periodic_runs(words) == brute(words)


def test_runs_that_overlap_and_runs_within_runs():
    words = list("aaaaaabaaaaaabaaaaaabaaaaaab") + list("cdcdcdcd") + list("dcdcdcdcd")
    assert periodic_runs(words) == brute(words)
    assert {q for _, _, q in periodic_runs(words)} >= {1, 2, 7}
    assert without_repeats(list("xaaaaaaay"), [(1, 7, 1)]) == list("xay")


def test_words_without_runs_whose_polynomial_hashes_collide():
    """The Thue-Morse word: blocks of 2,048 have equal sums of powers modulo 2^64, and nothing in it repeats three times."""
    word = [0]
    while len(word) < 1 << 14:
        word += [1 - w for w in word]
    assert periodic_runs([*word, *[2, 3] * 5]) == [(len(word), 10, 2)]


def test_long_texts_take_linear_time():
    began = time.time()
    assert periodic_runs(["a"] * 300_000) == [(0, 300_000, 1)]
    rng = random.Random(1)
    assert len(periodic_runs([rng.choice("abcdefghij") for _ in range(100_000)])) < 100
    unit = [f"w{i}" for i in range(20_000)]
    assert periodic_runs(["x", *unit * 6, "y"]) == [(1, 120_000, 20_000)]
    assert time.time() - began < 60


def test_query_equals_brute_force(spark, folder):
    out = by_id(op13_periodic_runs(spark, folder))
    docs = rows(folder, "documents")
    assert len(out) == len(docs)
    with_runs = 0
    for doc in docs:
        words = changed(doc["doc_id"], words_of(doc["text"]))
        runs = brute(words)
        with_runs += bool(runs)
        got = out[doc["doc_id"]]
        best = min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        assert (got["n_runs"], got["start"], got["length"], got["period"]) == (len(runs), *best)
        assert got["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert got["runs_sha256"] == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest()
        assert got["collapsed_sha256"] == hashlib.sha256(" ".join(without_repeats(words, runs)).encode()).hexdigest()
    assert with_runs > 5


def test_odd_documents(spark):
    df = odd_documents(spark).withColumnRenamed("score", "runs")
    found = find_runs(df, ["doc_id", "n_words"]).collect()
    assert len(found) == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in found:
        words = words_of(texts[r["doc_id"]])
        assert [tuple(x) for x in r["runs"]] == brute(words) if len(words) < 2000 else r["runs"]
        assert r["collapsed"] == " ".join(without_repeats(words, [tuple(x) for x in r["runs"]]))
    assert find_runs(empty_documents(spark), ["doc_id"]).collect() == []

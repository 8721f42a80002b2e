import hashlib
import random

import numpy as np
import pytest

from marlstone.llm import fingerprints as f
from marlstone.llm.queries import op9_fingerprints
from tests.llm.brute import by_id, empty_documents, odd_documents, rows


def edited_texts(pairs):
    """(id, own text, edited text, next text) in descending order of id, then by text; null ids last."""
    order = sorted(((-(1 << 63) if i is None else i, t or "", i) for i, t in pairs), key=lambda p: (-p[0], p[1]))
    for k, (_, text, i) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        yield i, text, text[: len(text) - half] + following[:half], following


def expected(pairs):
    for i, text, edited, following in edited_texts(pairs):
        a, b, c = (np.unique(f.syncmers(t).hashes) for t in (text, edited, following))
        yield i, (len(text), hashlib.sha256(edited.encode()).hexdigest(), f.sketch(a), f.sketch(b), f.likeness(a, b), f.likeness(a, c))


def values(r):
    return r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_query_equals_brute_force(spark, folder, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = by_id(op9_fingerprints(spark, folder))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = dict(expected([(d["doc_id"], d["text"]) for d in rows(folder, "documents")]))
    assert {i: values(r) for i, r in out.items()} == want


def plain_syncmers(text, k, s):
    """Places of closed syncmers by looking at every run; hashes of runs by any function of their text are as good."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)

    def hashed(i, size):
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((points[i : i + size].astype(np.uint64) + np.uint64(1)) * f._power("up", f._BASE, size), out=sums[1:])
        return int(f.mix(sums[-1:])[0])

    places = []
    for i in range(len(points) - k + 1):
        inner = [hashed(i + j, s) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            places.append((i, hashed(i, k)))
    return places


def test_syncmers_equal_the_definition():
    rng = random.Random(4)
    for _ in range(30):
        text = "".join(rng.choice("ab é😀") for _ in range(rng.randrange(24, 300)))
        found = f.syncmers(text)
        want = plain_syncmers(text, f.K, f.S)
        if want:
            assert list(zip(found.places.tolist(), found.hashes.tolist(), strict=True)) == want


def test_anchors_do_not_depend_on_their_surroundings():
    rng = random.Random(6)
    passage, left, right = ("".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(3))
    alone, inside = f.syncmers(passage), f.syncmers(left + passage + right)
    shifted = set(zip((alone.places + 400).tolist(), alone.hashes.tolist(), strict=True))
    assert shifted <= set(zip(inside.places.tolist(), inside.hashes.tolist(), strict=True))
    runs = f.shared_passages(alone, inside)
    assert max(runs, key=lambda r: r[2])[1] - max(runs, key=lambda r: r[2])[0] == 400
    assert 0.05 < len(alone.places) / 400 < 0.4


def test_odd_documents(spark):
    df = odd_documents(spark)
    out = f.compare_edited(df).collect()
    want = list(expected([(r.doc_id, r.text) for r in df.collect()]))
    assert sorted(((r.doc_id is None, r.doc_id or 0), values(r)) for r in out) == sorted(((i is None, i or 0), v) for i, v in want)
    assert f.compare_edited(empty_documents(spark)).collect() == []
    one = f.compare_edited(spark.createDataFrame([(3, "just one text, followed by itself")], "doc_id long, text string")).first()
    assert one.near_next == 1.0
    assert len(f.anchors(df, ["doc_id"]).collect()) == df.count()


def test_fingerprints_of_long_texts_hold_every_anchor_with_its_place(spark):
    """Two texts of 20,000 words share a passage of 50: both fingerprints have its anchors, and the places match."""
    rng = random.Random(8)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    passage = prose(50)
    left, right = (f"{prose(12000)} {passage} {prose(7950)}" for _ in range(2))
    out = by_id(f.compare_edited(spark.createDataFrame([(1, left), (2, right)], "doc_id long, text string")))
    held = {}
    for i, text in ((1, left), (2, right)):
        string, places = out[i]["fingerprint"], out[i]["places"]
        assert len(string) == 16 * len(places)
        held[i] = dict(zip([int(string[k : k + 16], 16) for k in range(0, len(string), 16)], places, strict=True))
        every = f.syncmers(text)
        first = {}
        for h, p in zip(every.hashes.tolist(), every.places.tolist(), strict=True):
            first.setdefault(h, p)
        assert held[i] == first
    inside = set(f.syncmers(passage).hashes.tolist())
    assert len(inside) > 20 and inside <= held[1].keys() & held[2].keys()
    assert {held[1][h] - left.index(passage) for h in inside} == {held[2][h] - right.index(passage) for h in inside}
    assert len(inside) / len(held[1]) * 0.9 < out[1]["passage_next"] < 0.05
    assert 0.4 < out[1]["passage_edited"] < 0.6

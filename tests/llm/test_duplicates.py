import random
import re

import numpy as np
import pytest

from marlstone.llm import duplicates as d
from marlstone.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def brute(rows):
    """Components over rows (id, text) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and label[i] != label[j] and linked(sets[i], sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def family(rng, vocabulary):
    """Texts of one origin with edits of several sizes."""
    base = [rng.choice(vocabulary) for _ in range(rng.randrange(12, 200))]
    for _ in range(rng.randrange(2, 9)):
        copy = list(base)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            copy = copy[: int(len(copy) * rng.uniform(0.7, 1))]
        yield " ".join(copy)
        if rng.random() < 0.3:  # a chain: the next copies start from this one
            base = copy


def test_shingles_are_those_of_the_definition():
    rng = random.Random(1)
    texts = [None, "", "  \n", "one", "One two", "a b c d e", "A b C d e f", "x y z\x1cq a b", "É é ü ß 日本 b"]
    texts += [" ".join(rng.choice(["a", "b", "C", "d\t", "é\n"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    found = d.distinct_sets(texts)
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    for i in range(0, len(texts), 3):
        for j in range(len(texts)):
            assert len(np.intersect1d(found[i], found[j])) == len(shingles(texts[i]) & shingles(texts[j]))


def test_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    for size in (3, 20, 400):
        shares = []
        for _ in range(200):
            common = rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)
            own = [np.unique(np.concatenate([common, rng.integers(0, 2**63, size // 3).astype(np.uint64) * np.uint64(2)])) for _ in range(2)]
            a, b = d.signatures(own)
            truth = len(np.intersect1d(*own)) / len(np.union1d(*own))
            shares.append(np.mean(a == b) - truth)
        assert abs(np.mean(shares)) < 0.02


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [t for _ in range(25) for t in family(rng, vocabulary)]
    texts += [None, "", " \t", "hi", "HI", "hi there", "a b c d e", "a b c d e", "A B C D E F"]
    texts += [texts[0]] * 40  # copies
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, label string, kept int").repartition(5)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in d.near_duplicates(df).collect()}
    assert out == brute(rows)


def test_members_that_only_link_past_the_centre_are_found(spark):
    """0 is close to 1, 1 to 2, ... while 0 and 2 are not: one component."""
    base = [f"w{i}" for i in range(100)]
    chain = [" ".join(base[3 * k : 3 * k + 60]) for k in range(12)]
    rows = list(enumerate(chain))
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in d.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == brute(rows)
    assert {c for _, c, _ in out.values()} == {0}


@pytest.fixture
def confirmed_pairs(monkeypatch):
    """Numbers of pairs that were compared on full sets, in order."""
    seen, confirm = [], d.confirmed

    def counting(pairs, sets):
        seen.append(pairs.count())
        return confirm(pairs, sets)

    monkeypatch.setattr(d, "confirmed", counting)
    return seen


def found_in(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in d.near_duplicates(df).collect()}


def test_linked_pairs_in_a_crowd_that_shares_boilerplate_are_found(spark, confirmed_pairs):
    """300 texts of similarity just below 0.75 with each other, of which 100 pairs share a few words more and are linked."""
    common = " ".join(f"c{i}" for i in range(404))
    rows = []
    for i in range(100):
        more = " ".join(f"m{i}_{j}" for j in range(16))
        rows += [(3 * i + k, " ".join([common, more, *(f"o{i}_{k}_{j}" for j in range(56))])) for k in (0, 1)]
        rows += [(3 * i + 2, " ".join([common, *(f"o{i}_2_{j}" for j in range(72))]))]
    out = found_in(spark, rows)
    want = brute(rows)
    assert len({c for _, c, _ in want.values()}) == 200
    assert out == want
    assert sum(confirmed_pairs) <= 15 * len(rows)


def test_short_texts_with_one_word_changed_are_not_compared_in_pairs(spark, confirmed_pairs):
    """1,200 texts of 40 words, each with one word of a text that is not in the table replaced: two are linked where the same word is replaced."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(1200):
        own = list(base)
        own[rng.randrange(40)] = f"n{i}"
        rows.append((i, " ".join(own)))
    assert found_in(spark, rows) == brute(rows)
    assert sum(confirmed_pairs) <= 20 * len(rows)  # all pairs would be 600 for each


def test_near_copies_of_one_text_have_about_one_pair_each(spark, confirmed_pairs):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1500):
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    assert {c for _, c, _ in found_in(spark, rows).values()} == {0}
    assert sum(confirmed_pairs) <= 2 * len(rows)


def test_all_documents_of_a_given_table_equal_brute_force(spark):
    """Every row of a whole table; recall is 1."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in d.near_duplicates(docs).collect()}
    assert out == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_link_of_a_group_is_in_its_star_or_in_smaller_groups(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    texts = [t for _ in range(15) for t in family(rng, vocabulary)]
    texts += [" ".join(common + [rng.choice(vocabulary) for _ in range(rng.randrange(25))]) for _ in range(80)]
    texts += ["hi", "hi there", "a b c d e", "a b c d e f"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sets = d.shingle_sets(df)
    stars, smaller, known = d.split_by_differences(sets.selectExpr("CAST(7 AS BIGINT) AS g", "id AS node", "CAST(size(shingles) AS BIGINT) AS n", "shingles AS items"), df.selectExpr("id", "id AS label"))
    assert known.columns == ["parent", "node", "n", "items"] and {r.parent for r in smaller.collect()} == {7}
    met = {(r.node, r.centre) for r in stars.collect()} | {(r.centre, r.node) for r in stars.collect()}
    groups = {}
    for r in smaller.collect():
        groups.setdefault(r.g, set()).add(r.node)
    own = [shingles(t) for t in texts]
    centre = {c for _, c in {(r.g, r.centre) for r in stars.collect()}}
    assert len(centre) == 1 and all(len(g) <= len(texts) / 2 for g in groups.values())
    reach = {i for i in range(len(own)) if linked(own[i], own[min(centre)])}
    for i in range(len(own)):
        for j in range(i + 1, len(own)):
            if linked(own[i], own[j]) and own[i] != own[j]:
                assert (i, j) in met or {i, j} <= reach or any({i, j} <= g for g in groups.values())


def test_very_long_texts(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(50_000)}" for _ in range(150_000)]
    near = [w if i % 100 else "other" for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:75_000])), (4, "a " * 200_000), (5, "a a a a a")]
    assert {i: c for i, (_, c, _) in found_in(spark, rows).items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_empty_table_null_ids_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert d.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f")]
    out = sorted((r.doc_id or -1, r.component_id, r.kept) for r in d.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert out == [(-1, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_long_chains_have_one_label(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {r.id: r.label for r in components(links).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}

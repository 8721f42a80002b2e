import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from marlstone.llm import personal as p
from marlstone.llm.queries import op11_personal_data
from tests.llm.brute import by_id, empty_documents, odd_documents, rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    """The contract's spans (start, kind, end) by its own patterns."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def joined(spans):
    return ",".join(f"{p.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def model():
    return p.learn([x for body, spans in p.made_examples() for x in p.cut(body, spans) if len(x[0].atoms) <= p.LEARNED_ATOMS])


@pytest.mark.parametrize("seed", range(4))
def test_patterns_equal_the_contracts(seed):
    rng = random.Random(seed)
    for _ in range(4000):
        text = "".join(rng.choice("@@..--++ 0123456789ab%_()\né" if seed % 2 else "@.+1 29-(a") for _ in range(rng.randrange(60)))
        assert p.pattern_spans(text)[0] == brute(text)
    for text, _ in p.made_examples(500, seed):
        assert p.pattern_spans(text)[0] == brute(text)


def test_segmentation_is_the_best_of_all():
    """The dynamic program against all segmentations of short islands, with weights drawn at random."""
    rng = np.random.default_rng(2)
    for text in ("1.2.3.4 55", "+12 345-6789", "a.b@c.d 1", "(01) 2345678"):
        model = p.Model(rng.normal(0, 1, (len(p.FEATURES), len(p.KINDS))), rng.normal(0, 1, (len(p.KINDS) + 1,) * 2))
        isle = p.island(text, 0, len(text))
        i, j, features = p.candidates(isle)
        scores = features @ model.weights
        spans = [(a, b, k, scores[s, k]) for s, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)) for k in range(len(p.KINDS))]
        best = (-np.inf, None)
        for size in range(4):
            for chosen in itertools.combinations(spans, size):
                chosen = sorted(chosen, key=lambda s: s[0])
                if any(x[1] > y[0] for x, y in itertools.pairwise(chosen)):
                    continue
                state, at, total = 0, 0, 0.0
                for a, b, k, own in [*chosen, (len(isle.atoms), None, None, 0)]:
                    for _ in range(a - at):
                        total, state = total + model.steps[state, 0], 0
                    if b is not None:
                        total, state, at = total + model.steps[state, k + 1] + own, k + 1, b
                best = max(best, (total, [(isle.offsets[a], k, isle.offsets[b]) for a, b, k, _ in chosen]), key=lambda x: x[0])
        assert p.best_segmentation(isle, model, margin=0.0) == best[1]


def test_held_out_entities_are_found(model):
    hit = wrong = missed = 0
    for body, spans in p.made_examples(800, seed=99):
        got = {s for isle in p.islands(body) for s in p.best_segmentation(p.island(body, *isle), model)}
        hit, wrong, missed = hit + len(got & set(spans)), wrong + len(got - set(spans)), missed + len(set(spans) - got)
    assert hit / (hit + wrong) > 0.98 and hit / (hit + missed) > 0.96


def test_the_model_splits_what_the_patterns_run_together(model):
    text = "at +1 (269) 555-3296 4524132264652876 and write me (at) home (dot) org"
    assert p.pattern_spans(text)[0] == []
    assert p.all_spans(text, model)[1] == [(3, 3, 20), (21, 2, 37), (48, 0, 70)]
    for clean in ("Version 2.0. CC BY-NC 4.0.", "on 2024-01-31 at 12:30", "1 2 3 4 5", "9807915762804490", "a@b"):
        assert p.all_spans(clean, model) == ([], [])


def test_query_keeps_all_base_spans_and_adds_others(spark, folder):
    out = by_id(op11_personal_data(spark, folder))
    docs = rows(folder, "documents")
    assert len(out) == len(docs)
    for doc in docs:
        base, got = brute(doc["text"]), out[doc["doc_id"]]
        assert [got[f"n_{k}"] for k in p.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert got["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        spans = [(int(a), p.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in got["spans"].split(",") if s)]
        assert set(base) <= set(spans) and spans == sorted(spans)
        for a, k, b in set(spans) - set(base):
            assert all(b <= x or y <= a for x, _, y in base) and re.search("[0-9@]", doc["text"][a:b])


def test_long_texts_take_linear_time(model):
    began = time.time()
    for text in ("x" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1((" * 50_000, "a@" * 50_000, "12 " * 20_000, "-" * 300_000 + "@"):
        own, _ = p.all_spans(text, model)
        assert own == [] or text.startswith("1.")
    assert time.time() - began < 60


def test_odd_documents(spark, model):
    df = odd_documents(spark)
    found = p.personal_spans(df.withColumnRenamed("score", "spans_"), ["doc_id", "n_words"], model).collect()
    assert len(found) == df.count() and all(r["spans"] == [] for r in found)
    out = p.personal_data(df).collect()
    assert len(out) == df.count() and {r["spans"] for r in out} == {""}
    assert p.personal_data(empty_documents(spark)).collect() == []

import re

from marlstone.llm import licences
from marlstone.llm.queries import op5_licences
from tests.llm.brute import by_id, empty_documents, odd_documents, rows

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def compare(out, texts):
    for i, text in texts.items():
        r = out[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text), text
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_query_equals_brute_force(spark, folder):
    texts = {d["doc_id"]: d["text"] for d in rows(folder, "documents")}
    compare(by_id(op5_licences(spark, folder)), texts)


def test_notices_are_found_inside_texts_and_fakes_are_not(spark):
    notices = [(label, text) for label, text, _ in licences.TEMPLATES]
    data = [(i, f"Some words before.\n/* {text.upper() if i % 2 else text} */ and after é") for i, (_, text) in enumerate(notices)]
    scrambled = [(100 + i, " ".join(sorted(text.split()))) for i, (_, text) in enumerate(notices)]
    changed = [(200 + i, text.replace("icense", "icence").replace("permission", "consent").replace("Permission", "Consent")) for i, (_, text) in enumerate(notices)]
    more = [(300, "the MIT license\nMIT License, Apache-License"), (301, "general public license general public license"), (302, "mit, license mit licenses")]
    df = spark.createDataFrame(data + scrambled + changed + more, "doc_id long, text string")
    out = by_id(licences.scan(df, ["doc_id"]))
    compare(out, dict(data + scrambled + changed + more))
    for i, (label, _) in enumerate(notices):
        assert label in out[i]["labels"].split(",") and out[i]["score"] == 1.0
        assert out[100 + i]["labels"] == out[100 + i]["base_labels"]
    assert out[301]["n_base"] == 2 and out[301]["last_word"] == 3


def test_index_equals_a_search_of_every_place():
    index = licences.Index()
    words = licences.words_of("x y Released under the MIT License z. Licensed under CC BY-SA 4.0, licensed under the Apache License, Version 2.0")
    found = {(f.label, f.start) for f in index.find(words) if f.verified}
    every = set()
    for t in index.templates:
        for start in range(len(words)):
            here = words[start : start + len(t.words)]
            if len(here) == len(t.words) and sum(a == b for a, b in zip(here, t.words, strict=True)) >= index.covered * len(t.words):
                if all(any(here[i : i + len(p)] == p for i in range(len(here))) for p in t.phrases):
                    every.add((t.label, start))
    assert found == every and len(found) == 3


def test_odd_documents(spark):
    df = odd_documents(spark)
    out = licences.scan(df, ["doc_id"]).collect()
    assert len(out) == df.count()
    compare({r.doc_id: r.asDict() for r in out}, {r.doc_id: r.text for r in df.collect()})
    assert licences.scan(empty_documents(spark), ["doc_id"]).collect() == []

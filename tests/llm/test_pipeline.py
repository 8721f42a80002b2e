import corpus_pipeline as p
from marlstone.llm import toxicity
from tests.llm.brute import odd_documents, rows
from tests.llm.test_duplicates import linked, shingles
from tests.llm.test_packing import check


def test_stages_act_one_after_the_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in p.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in rows(folder, "labels")}
    scores = {r.doc_id: r.score for r in toxicity.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert kept["toxicity"].keys() == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    clean = [i for i, toxic in labels.items() if not toxic]
    assert sum(i in kept["toxicity"] for i in clean) >= 0.9 * len(clean)  # learned from 60 rows
    assert all(any(c.isalpha() for c in t) for t in kept["language"].values())
    assert len(kept["language"]) >= 0.99 * len(kept["toxicity"])
    sets = {i: shingles(t) for i, t in kept["language"].items()}
    stay = kept["near_duplicates"]
    for i, s in sets.items():
        smaller = [j for j in sets if j < i and linked(sets[j], s)]
        if not smaller and not any(linked(s, sets[j]) for j in sets if j != i):
            assert i in stay
        if smaller:
            assert i not in stay
    pieces = p.run(spark, folder).collect()
    check(pieces, stay)


def test_odd_documents_pass_every_stage(spark, folder):
    docs = odd_documents(spark)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, folder)
        docs.collect()

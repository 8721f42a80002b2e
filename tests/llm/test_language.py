import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm import language as lang
from marlstone.llm.queries import op7_language
from tests.llm.brute import by_id, empty_documents, odd_documents, rows


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def grams(text, table):
    """Grams of one to three letters or word ends, hashed one by one."""
    letters = [int(table[ord(c)]) if ord(c) < 0x10000 else 0 for c in text or ""]
    for size in (1, 2, 3):
        for i in range(len(letters) - size + 1):
            run = letters[i : i + size]
            inside = all(run[1:-1]) if size > 2 else True
            if inside and (run[0] or run[-1]):
                hashed = 0
                for c in run:
                    hashed = (hashed * int(lang._SPREAD) + c) & 0xFFFFFFFF
                yield ((hashed + size) * int(lang._SPREAD) & 0xFFFFFFFF) >> 12


def top(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: lang.RANKS]]


def test_query_equals_brute_force(spark, folder):
    table, docs = lang.letter_table(), rows(folder, "documents")
    counts = defaultdict(Counter)
    own = {}
    for d in docs:
        own[d["doc_id"]] = Counter(grams(d["text"], table))
        if not held_out(d["doc_id"]) and d["lang"] is not None:
            counts[d["lang"]].update(own[d["doc_id"]])
    ranks = {name: {g: i for i, g in enumerate(top(c))} for name, c in sorted(counts.items())}
    out = by_id(op7_language(spark, folder))
    right = 0
    for d in docs:
        r, mine = out[d["doc_id"]], top(own[d["doc_id"]])
        assert r["held_out"] == held_out(d["doc_id"])
        if not mine:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        distance = {name: sum(abs(i - p[g]) if g in p else lang.RANKS for i, g in enumerate(mine)) for name, p in ranks.items()}
        best = min(distance, key=lambda n: (distance[n], n))
        assert r["lang_pred"] == best
        assert abs(r["score"] - (1 - distance[best] / (lang.RANKS * len(mine)))) < 1e-12
        right += r["held_out"] and best == d["lang"]
    assert right >= 0.97 * sum(held_out(d["doc_id"]) for d in docs)


def test_labels_of_held_out_rows_change_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = by_id(lang.identify(docs))
    blind = docs.withColumn("lang", F.when(lang.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    assert by_id(lang.identify(blind)) == before


def test_odd_documents(spark):
    df = odd_documents(spark)
    out = lang.identify(df).collect()
    assert len(out) == df.count()
    for text, r in ((None, 0), ("###", 5), (" ", 2)):
        assert {x.lang_pred for x in out if x.doc_id == r} == {"und"}, text
    assert lang.identify(empty_documents(spark)).collect() == []
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang.identify(unlabelled).collect()} == {"und"}


def test_ties_go_to_the_first_language():
    ranks = np.full((2, 8), lang.RANKS, dtype=np.int16)
    assert lang.out_of_place(np.array([1, 2]), ranks).tolist() == [2 * lang.RANKS] * 2
    ranks[1, 2] = 0
    assert lang.out_of_place(np.array([1, 2]), ranks).tolist() == [2 * lang.RANKS, lang.RANKS + 1]


def test_letters_beyond_the_basic_plane_are_learned(spark):
    gothic, adlam = ("".join(chr(first + i % n) + " " * (i % 5 == 4) for i in range(60)) for first, n in ((0x10330, 26), (0x1E922, 33)))
    rows = [(i, t, name) for i, (t, name) in enumerate([(gothic, "got"), (adlam, "ff"), ("plain words of a text", "en")] * 8)]
    out = by_id(lang.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert {i: out[i]["lang_pred"] for i, _, _ in rows} == {i: name for i, _, name in rows}
    assert all(r["score"] > 0.5 for r in out.values())
    table = lang.letter_table()
    assert table[0x1E900] == 0x1E922 and table[0x20000] == 0x20000 and table[0x1F600] == 0

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import quality as q
from marlstone.llm.queries import op3_quality
from tests.llm.brute import by_id, empty_documents, odd_documents, rows


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered)


def compare(out, texts):
    for i, text in texts.items():
        r = out[i]
        words, chars, symbols, doubled, repeated = base(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (words, chars, symbols, doubled, repeated), text
        failed = words < 50 or 100 * repeated > 50 * words
        assert r["base_failed"] == failed and not (failed and r["kept"])


class Plain:
    """Modified Kneser-Ney with dictionaries, straight from the published formulas, over the numbers of other texts that hold a gram."""

    def __init__(self, texts, table):
        self.table = table
        holders = Counter(g for text in texts for g in set(self.grams(text)))
        self.counts = [defaultdict(int) for _ in range(q.ORDER + 1)]
        self.counts[q.ORDER] = defaultdict(int, {g: n - 1 for g, n in holders.items() if n > 1})
        for n in range(q.ORDER - 1, 0, -1):
            for gram in self.counts[n + 1]:
                self.counts[n][gram[1:]] += 1
        self.off = [None] + [self._off(self.counts[n].values()) for n in range(1, q.ORDER + 1)]
        self.behind = [None] + [defaultdict(list) for _ in range(q.ORDER)]
        for n in range(1, q.ORDER + 1):
            for gram, c in self.counts[n].items():
                self.behind[n][gram[:-1]].append(c)

    def grams(self, text):
        s = [32] * (q.ORDER - 1) + [int(self.table[ord(c)]) for c in text or ""]
        return [tuple(s[i : i + q.ORDER]) for i in range(len(s) - q.ORDER + 1)]

    @staticmethod
    def _off(counts):
        n = Counter(counts)
        if not all(n[i] for i in (1, 2, 3, 4)):
            return [0, 0.5, 0.5, 0.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k) for k in (1, 2, 3)]

    def chance(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (1 + len(self.counts[1])) if self.counts[1] else 1.0
        after = self.behind[n].get(gram[:-1])
        if not after:
            return self.chance(gram[1:])
        c = self.counts[n].get(gram, 0)
        share = sum(self.off[n][min(x, 3)] for x in after) / sum(after)
        return (c - self.off[n][min(c, 3)]) / sum(after) + share * self.chance(gram[1:])

    def mean(self, text):
        return -sum(math.log(self.chance(g)) for g in self.grams(text)) / len(text)


def entries(spark, texts):
    df = spark.createDataFrame([("x", t) for t in texts], "lang string, text string").repartition(3)
    return q.laid_out(q.kneser_ney(q.counted(df, "text", "lang")))


@pytest.mark.parametrize("letters", ["ab ", "abcdefgh .,1éЖ😀"])
def test_model_equals_the_formulas(spark, letters):
    rng = random.Random(8)
    table = q.fold_table()
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))) for _ in range(20)]
    rows_ = entries(spark, texts).toArrow().combine_chunks()
    keys, values = rows_["key"].to_numpy().view(np.uint64), rows_["value"].to_numpy()
    assert len(set(keys.tolist())) == len(keys)
    order = np.argsort(keys)
    shard, plain = q.Shard(keys[order], values[order].astype(np.float32)), Plain(texts, table)
    for text in [*texts[:5], "zebra", "ab##ab", "日本", "ЖЖ😀😀"]:
        columns, _ = q.runs([text], table)
        want = [math.log(plain.chance(g)) for g in plain.grams(text)]
        assert np.allclose(q.log_chances(columns, q.language_seed("x"), shard), want, atol=1e-4)


@pytest.mark.parametrize("shard_entries", [q.SHARD_ENTRIES, 40_000])
def test_query_equals_brute_force(spark, folder, shard_entries):
    docs = rows(folder, "documents")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    out = by_id(op3_quality(spark, folder) if shard_entries == q.SHARD_ENTRIES else q.quality(frame, shard_entries=shard_entries))
    assert len(out) == len(docs)
    compare(out, {d["doc_id"]: d["text"] for d in docs})
    table = q.fold_table()
    means = defaultdict(dict)
    for lang in {d["lang"] for d in docs}:
        own = [d for d in docs if d["lang"] == lang]
        plain = Plain([d["text"] for d in own], table)
        for d in own:
            if d["text"]:
                means[lang][d["doc_id"]] = plain.mean(d["text"])
    size = {d["doc_id"]: len(d["text"] or "") for d in docs}
    for lang, found in means.items():
        usual = sorted((i for i in found if out[i]["n_words"] >= 50), key=found.get)
        low, high = (found[usual[max(0, math.ceil(share * len(usual)) - 1)]] for share in (0.25, 0.75))
        middle = sorted(size[i] for i in usual)[max(0, math.ceil(len(usual) / 2) - 1)]
        for i, mean in found.items():
            assert math.isclose(out[i]["perplexity"], math.exp(mean), rel_tol=1e-3)
            room = q.REACH * max(high - low, 0.005) * math.sqrt(max(middle / size[i], 1))
            edge = min(abs(mean - low + room), abs(mean - high - room))
            if edge > 1e-3:
                assert out[i]["kept"] == (not out[i]["base_failed"] and low - room <= mean <= high + room), lang


def test_gibberish_is_rejected_and_prose_is_kept(spark, folder):
    """Letters at random, in Latin, Cyrillic and Arabic script, and prose with its letters shuffled within words."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    prose = docs.filter("lang = 'en'").filter(F.length("text") > 1500)
    rng = random.Random(1)
    scripts = ["qxzjkvw#$%", "жфщъэюяхцч", "ضصثقفغعهخح"]
    junk = [" ".join("".join(rng.choice(s) for _ in range(7)) for _ in range(200)) for s in scripts for _ in range(3)]
    for r in prose.limit(3).collect():
        junk.append(" ".join("".join(rng.sample(w, len(w))) for w in r.text.split()))
    out = by_id(q.quality(prose.union(spark.createDataFrame([(-i, t, "en") for i, t in enumerate(junk, 1)], prose.schema))))
    assert not any(out[-i]["kept"] for i in range(1, len(junk) + 1))
    clean = [r for i, r in out.items() if i >= 0 and not r["base_failed"] and r["n_symbols"] < 5]
    assert sum(r["kept"] for r in clean) >= 0.95 * len(clean)


def test_every_language_has_a_model_and_a_band_of_its_own(spark):
    """20 languages of invented words; a text of another language than its own is out of band, whatever its script."""
    rng = random.Random(2)
    data, doc_id = [], 0
    words = {}
    for k in range(20):
        letters = [chr(0x61 + (k * 7 + j * 5) % 26) for j in range(7)] if k % 2 else [chr(0x430 + (k + j * 3) % 32) for j in range(8)]
        words[k] = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(60)]
        for _ in range(12):
            data.append((doc_id, " ".join(rng.choice(words[k]) for _ in range(rng.randrange(150, 250))), f"l{k}" if k else "e\0n"))
            doc_id += 1
    wrong = []
    for k in range(20):
        wrong.append((1000 + k, " ".join(rng.choice(words[(k + 7) % 20]) for _ in range(200)), f"l{k}" if k else "e\0n"))
    out = by_id(q.quality(spark.createDataFrame(data + wrong, "doc_id long, text string, lang string").repartition(4)))
    assert sum(out[i]["kept"] for i, _, _ in data) >= 0.95 * len(data)
    assert sum(out[i]["kept"] for i, _, _ in wrong) <= 1


def test_odd_documents(spark):
    df = odd_documents(spark)
    out = q.quality(df).collect()
    assert len(out) == df.count()
    compare({r.doc_id: r.asDict() for r in out}, {r.doc_id: r.text for r in df.collect()})
    assert q.quality(empty_documents(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, None), (2, "", "en")], "doc_id long, text string, lang string")
    assert all(r.base_failed and not r.kept and r.perplexity is None for r in q.quality(nothing).collect())

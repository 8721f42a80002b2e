import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marlstone.llm import chats
from marlstone.llm.queries import op2_chats
from tests.llm.brute import rows


def expected(turns):
    """Digest columns per conversation from rows (conv, turn, role, text)."""
    grouped = defaultdict(list)
    for conv, turn, role, text in turns:
        grouped[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, said in grouped.items():
        said.sort()
        loss = "".join(t for _, r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in said)
        out[conv] = (len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def read(windows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chats.read_back(windows).collect()}


def test_query_reads_back_every_turn(spark, folder):
    turns = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows(folder, "conversations")]
    told = "</s>[INST] ok [/INST]"
    want = expected([*turns, (-7, 0, "user", told), (-7, 1, "assistant", told)])
    out = op2_chats(spark, folder)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out.collect()} == want
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain(text):
    return re.sub(r"(?s)\\(.)", r"\1", text)


def parsed(marked):
    role, text = marked.removeprefix("<s>").split("[INST]", 1)
    return plain(role), plain(text.removesuffix("[/INST]"))


TEXTS = ["", None, "</s>", "<s>[INST]\\", "\\[/INST]", "<</SYS>> <<SYS>>", "<<s>", "plain words here", "a\nb\n", "日本 😀", "\\\\</s", "[[INST]", "$1 \\1"]


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(2)
    data = []
    for conv in [*range(40), None]:
        system = rng.random() < 0.5
        for turn in range({0: 700, 1: 300, 2: 20}.get(conv) or rng.randrange(1, 9)):
            role = "system" if system and turn == 0 else rng.choice(["user", "assistant", "assistant", None, "to[INST]ol"])
            data.append((conv, turn if rng.random() < 0.98 else None, role, rng.choice(TEXTS) if rng.random() < 0.5 else "w " * rng.randrange(80)))
    return data


def test_windows_keep_budget_system_turn_and_history(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).repartition(4)
    windows = chats.format_chats(df, budget=300, history=3, chunk=64).cache()
    assert read(windows) == expected(turns)
    system = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: -1 if t[1] is None else t[1]):
        if role == "system" and conv not in system:
            system[conv] = text or ""
    repeated = 0
    for w in windows.withColumn("new", chats.new_turns(windows)).collect():
        repeated += w.n_repeated
        every = [parsed(p) for p in w.formatted.split("</s>")[:-1]]
        assert len(every) == w.n_repeated + len(w["new"]) and w.n_repeated <= 4
        assert w.n_tokens <= 300 or len(every) <= 2  # a turn alone, with the system turn
        if w.conv_id in system:
            assert ("system", system[w.conv_id]) in every
        marked = [w.formatted[s["start"] : s["start"] + s["length"]] for s in w.loss_spans]
        assert [t["text"] for t in w["new"] if t["role"] == "assistant"] == [plain(m) for m in marked]
    assert repeated > 50
    longest = windows.groupBy("conv_id").agg(F.countDistinct("chunk").alias("n")).agg(F.max("n")).first()[0]
    assert longest >= 5


def test_empty_and_repeated_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chats.read_back(chats.format_chats(spark.createDataFrame([], schema))).collect() == []
    same = [(1, 0, "assistant", "hello")] * 3
    assert read(chats.format_chats(spark.createDataFrame(same, schema))) == expected(same)
    long = [(1, 0, "user", "x " * 50000), (1, 1, "assistant", "y</s> " * 50000)]
    assert read(chats.format_chats(spark.createDataFrame(long, schema))) == expected(long)


def test_escaping_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    for r in df.select("t", chats.escaped(F.col("t")).alias("e"), chats.unescaped(chats.escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))

import pytest
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators import prompts as pr
from marlstone.operators import tokens as tk

TEXTS = [
    "machine learning is great",
    "deep learning uses neural networks",
    "machine learning and deep learning",
    "neural networks are powerful",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([*enumerate(TEXTS), (4, ""), (5, "  Deep  unknown\n")], "id bigint, text string")


@pytest.fixture(scope="module")
def vocabulary(spark):
    return tk.build_vocabulary(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "text", 2)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_vocabulary(vocabulary):
    want = {"deep": 4, "learning": 5, "machine": 6, "networks": 7, "neural": 8}
    assert {r["word"]: r["token"] for r in vocabulary.collect()} == want


@pytest.mark.parametrize("limit", [100, 2])
def test_encode_and_decode(texts, vocabulary, limit):
    coded = tk.encode(texts, "id", "text", vocabulary, shared_words=limit)
    got = {r["id"]: r["tokens"] for r in coded.collect()}
    assert got == {
        0: [2, 6, 5, 1, 1, 3],
        1: [2, 4, 5, 1, 8, 7, 3],
        2: [2, 6, 5, 1, 4, 5, 3],
        3: [2, 8, 7, 1, 1, 3],
        4: [2, 3],
        5: [2, 4, 1, 3],
    }
    back = {r["id"]: r["text"] for r in tk.decode(coded, "id", "tokens", vocabulary, shared_words=limit).collect()}
    assert back[1] == "deep learning neural networks" and back[4] == "" and back[5] == "deep"


@pytest.mark.parametrize("limit", [100, 2, 0])
def test_repeated_keys_stay_apart(spark, vocabulary, limit):
    twice = spark.createDataFrame([(1, "deep learning x", "a"), (1, "deep learning x", "b"), (1, None, "c")], "id bigint, text string, mark string")
    coded = tk.encode(twice, "id", "text", vocabulary, carry=["mark"], shared_words=limit)
    assert {r["mark"]: r["tokens"] for r in coded.collect()} == {"a": [2, 4, 5, 1, 3], "b": [2, 4, 5, 1, 3], "c": [2, 3]}
    back = tk.decode(coded, "id", "tokens", vocabulary, shared_words=limit)
    assert sorted(r["text"] for r in back.collect()) == ["", "deep learning", "deep learning"]


def test_padding(texts, vocabulary):
    coded = tk.encode(texts, "id", "text", vocabulary).withColumn("p", tk.padded(F.col("tokens"), 5))
    got = {r["id"]: r["p"] for r in coded.collect()}
    assert all(len(p) == 5 for p in got.values())
    assert got[4] == [2, 3, 0, 0, 0] and got[2] == [2, 6, 5, 1, 4]


def test_character_fallback(spark):
    def coded(text, listed, specials):
        return one(spark, tk.encode_with_characters(F.lit(text), listed, specials))

    space = 4 + tk.SERVER_TOKENS.index(" ")
    hello = 4 + tk.SERVER_TOKENS.index("hello")
    assert coded("hello a!", tk.SERVER_TOKENS, tk.SERVER_SPECIALS) == [0, hello, space, 5, 4 + tk.SERVER_TOKENS.index("!"), 1]
    assert coded("", tk.SERVER_TOKENS, tk.SERVER_SPECIALS) == [0, 1]
    assert coded("zq", tk.ENGINE_TOKENS, tk.ENGINE_SPECIALS) == [1, 3, 3]
    ids = tk.encode_with_characters(F.lit("what is the model"), tk.ENGINE_TOKENS, tk.ENGINE_SPECIALS)
    assert one(spark, tk.decode_characters(ids, tk.ENGINE_TOKENS)) == "what is the model"


def test_templates(spark):
    template = F.lit("In {n} words: {text} ({n})")
    assert one(spark, pr.template_variables(template)) == ["n", "text"]
    assert one(spark, pr.template_variables(template, distinct=False)) == ["n", "text", "n"]
    values = F.create_map(F.lit("n"), F.lit("3"), F.lit("text"), F.lit("a {n} b"))
    assert one(spark, pr.render(template, values)) == "In 3 words: a {n} b (3)"
    assert one(spark, pr.render(F.lit("plain"), values)) == "plain"
    assert one(spark, pr.render(F.lit("{n}"), values)) == "3"
    with pytest.raises(Exception, match="no value for template variable other"):
        one(spark, pr.render(F.lit("{other}"), values))
    row = spark.range(1).select(*pr.check_template(template, F.array(F.lit("n"), F.lit("x")))).first()
    assert (row["valid"], row["missing"], row["extra"]) == (False, ["text"], ["x"])


def test_json_block(spark):
    text = 'Found:\n{"people": ["A B", "C"], "organizations": ["X", "Y"], "locations": ["P", "Q"]}\nend'
    assert one(spark, tx.json_block(F.lit(text))).startswith('{"people"')
    assert one(spark, tx.json_block(F.lit("list [1, 2] end"))) == "[1, 2]"
    assert one(spark, tx.json_block(F.lit("bad {x"))) is None
    assert one(spark, tx.json_block(F.lit("} {"))) is None
    assert one(spark, tx.json_block(F.lit("none"))) is None


def test_instruction_forms(spark):
    with_input = [F.lit("do"), F.lit("this"), F.lit("done")]
    without = [F.lit("do"), F.lit(""), F.lit("done")]
    assert one(spark, pr.alpaca(*with_input)) == "### Instruction:\ndo\n\n### Input:\nthis\n\n### Response:\ndone"
    assert one(spark, pr.alpaca(*without)) == "### Instruction:\ndo\n\n### Response:\ndone"
    assert one(spark, pr.chat_short_tags(*with_input)) == "<|user|>\ndo\nthis\n<|assistant|>\ndone"
    want = "<|im_start|>user\ndo<|im_end|>\n<|im_start|>assistant\ndone<|im_end|>"
    assert one(spark, pr.chat_start_tags(*without)) == want


def test_technique(spark):
    cases = {
        "Think through this. You are": "chain-of-thought",
        "Input: a": "few-shot",
        "You are a guide": "role-based",
        "Answer as JSON": "structured",
        "What?": "zero-shot",
    }
    for prompt, want in cases.items():
        assert one(spark, pr.technique(F.lit(prompt))) == want


def test_sections_are_left_out_when_empty(spark):
    empty = F.array().cast("array<string>")
    assert one(spark, pr.sectioned_prompt(F.lit("go"), context=empty)) == "Instruction: go\n\nResponse:"


def test_long_conversations_are_one_row(spark):
    chat = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    [row] = pr.flatten_conversations(chat.repartition(7)).collect()
    assert row["prompt"].split("\n") == [f"user: {i}" for i in range(5000)]


def test_token_estimate(spark):
    assert one(spark, tx.estimated_tokens(F.lit("abc"))) == 1 and one(spark, tx.estimated_tokens(F.lit("a" * 13))) == 3


def test_filling_rare_words_takes_linear_time(spark):
    """A text of twice as many rare words costs about twice as much, not four times."""
    import time

    from marlstone.operators import tokens

    vocabulary = spark.range(60_000).selectExpr("concat('w', id) AS word", "CAST(id + 4 AS INT) AS token", "CAST(2 AS BIGINT) AS n").cache()
    took = []
    for n in (20_000, 20_000, 40_000):
        df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "id int, text string")
        began = time.time()
        row = tokens.encode(df, "id", "text", vocabulary, shared_words=10).first()
        took.append(time.time() - began)
        assert row["tokens"] == [tokens.BOS, *range(4, n + 4), tokens.EOS]
    assert took[2] < 3 * took[1] + 1


def test_many_patterns_equal_one_by_one(spark):
    import random

    from marlstone.functions import text as tx

    rng = random.Random(3)
    patterns = ["".join(rng.choice("abAB é") for _ in range(rng.randrange(0, 5))) for _ in range(300)] + ["zz", "ZZ"]
    texts = [None, "", "ZzZ", *("".join(rng.choice("abABé z") for _ in range(rng.randrange(40))) for _ in range(200))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    got = {r.id: r.f for r in df.select("id", tx.found_many(F.col("text"), patterns).alias("f")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == ([k for k, p in enumerate(patterns) if p.lower() in t.lower()] if t is not None else [])
    with pytest.raises(ValueError, match="more than"):
        tx.found_many(F.col("text"), ["x" * (tx.AUTOMATON_CHARS + 1)])


def test_ten_thousand_patterns_cost_about_as_much_as_ten(spark):
    import time

    from marlstone.functions import text as tx

    df = spark.range(2000).selectExpr("repeat(concat('some words about item ', id, ' and more '), 40) AS text").repartition(4).cache()
    df.count()
    took = {}
    for n in (10, 10, 10_000):
        began = time.time()
        df.select(F.size(tx.found_many(F.col("text"), [f"item {i} and" for i in range(n)])).alias("n")).agg(F.sum("n")).collect()
        took[n] = time.time() - began
    assert took[10_000] < 4 * took[10] + 2


def test_model_calls_that_fail_cost_their_own_rows_only(spark, tmp_path):
    from marlstone.operators import prompts as pr

    calls = str(tmp_path / "calls")

    def model(broken):
        def call(texts):
            with open(f"{calls}-{broken}", "a") as file:
                file.write("".join(t + "\n" for t in texts))
            if any(t in broken for t in texts):
                raise RuntimeError("down")
            return [t.upper() for t in texts]

        return call

    df = spark.createDataFrame([(i, f"p{i}") for i in range(50)] + [(50, None)], "id int, prompt string").repartition(3)
    path = str(tmp_path / "answers")
    first = {r.id: (r.answer, r.error) for r in pr.ask_stored(df, ["id"], "prompt", model(("p7", "p30")), path, batch=8).collect()}
    assert {i for i, (_, e) in first.items() if e} == {7, 30} and first[7] == (None, "RuntimeError: down")
    assert all(first[i][0] == f"P{i}" for i in range(50) if i not in (7, 30)) and first[50][0] == ""
    more = df.unionByName(spark.createDataFrame([(99, "new")], df.schema))
    second = {r.id: (r.answer, r.error) for r in pr.ask_stored(more, ["id"], "prompt", model(("none",)), path, batch=8).collect()}
    assert all(e is None for _, e in second.values()) and len(second) == 52
    with open(f"{calls}-{('none',)}") as file:
        assert sorted(file.read().split()) == ["new", "p30", "p7"]

"""Tokens, prompts and training text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators import prompts as pr
from marlstone.operators import tokens as tk
from marlstone.plans.registry import query, table
from marlstone.plans.retrieval import _words
from marlstone.sources.logs import CHAT_PAIRS_SQL, REQUEST_LOG_SQL, chat_pairs, request_log
from marlstone.workspace import scratch, temp_view, written

VOCABULARY_SQL = f"""all_words AS (SELECT doc_id, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
    FROM (SELECT doc_id, lang, {_words("lower(text)")} AS ws FROM documents)),
  vocabulary AS (SELECT word, count(*) AS n, CAST(row_number() OVER (ORDER BY word) + 3 AS INTEGER) AS token
    FROM all_words GROUP BY word HAVING count(*) >= 2),
  coded AS (SELECT doc_id, lang, pos, word, coalesce(token, 1) AS token FROM all_words LEFT JOIN vocabulary USING (word))"""


def _vocabulary(spark, folder):
    documents = table(spark, folder, "documents")
    return documents, tk.build_vocabulary(documents, "text", 2)


@query("txt_01_vocabulary", f"WITH {VOCABULARY_SQL} SELECT word, n, token FROM vocabulary")
def vocabulary(spark, folder):
    return _vocabulary(spark, folder)[1]


@query(
    "txt_02_encode",
    f"""WITH {VOCABULARY_SQL} SELECT d.doc_id, '2 ' || coalesce(string_agg(token, ' ' ORDER BY pos) || ' ', '') || '3' AS tokens
    FROM documents d LEFT JOIN coded USING (doc_id) GROUP BY 1""",
)
def encode(spark, folder):
    documents, words = _vocabulary(spark, folder)
    return tk.encode(documents, "doc_id", "text", words).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def _character_sql(listed, specials) -> str:
    ids = "MAP {" + ", ".join("'" + t.replace("'", "''") + f"': {4 + i}" for i, t in enumerate(listed)) + "}"
    space = 4 + list(listed).index(" ")
    end = "[]::INTEGER[]" if specials["eos"] is None else f"[{specials['eos']}]"
    return f"""list_concat(list_concat([{specials["bos"]}], coalesce(list_reverse(list_reverse(flatten(list_transform({_words("text")}, lambda w: list_concat(
      CASE WHEN {ids}[w] IS NOT NULL THEN [{ids}[w]] ELSE list_transform(string_split(w, ''), lambda c: coalesce({ids}[c], 3)) END, [{space}]))))[2:]), [])), {end})"""


@query(
    "txt_03_encode_characters",
    f"""SELECT conv_id, turn, array_to_string({_character_sql(tk.SERVER_TOKENS, tk.SERVER_SPECIALS)}, ' ') AS with_end,
    array_to_string({_character_sql(tk.ENGINE_TOKENS, tk.ENGINE_SPECIALS)}, ' ') AS without_end FROM conversations""",
)
def encode_characters(spark, folder):
    text = F.col("text")
    with_end = tk.encode_with_characters(text, tk.SERVER_TOKENS, tk.SERVER_SPECIALS)
    without_end = tk.encode_with_characters(text, tk.ENGINE_TOKENS, tk.ENGINE_SPECIALS)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.array_join(with_end, " ").alias("with_end"), F.array_join(without_end, " ").alias("without_end")
    )


@query(
    "txt_04_decode",
    f"""WITH {VOCABULARY_SQL} SELECT d.doc_id, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (token >= 4), '') AS text
    FROM documents d LEFT JOIN coded USING (doc_id) GROUP BY 1""",
)
def decode(spark, folder):
    documents, words = _vocabulary(spark, folder)
    return tk.decode(tk.encode(documents, "doc_id", "text", words), "doc_id", "tokens", words)


@query(
    "txt_05_token_counts",
    f"""WITH {VOCABULARY_SQL} SELECT doc_id, count(*) AS total_tokens, count(DISTINCT token) AS unique_tokens,
    count(*) FILTER (token = 1) AS unknown_tokens FROM coded GROUP BY 1""",
)
def token_counts(spark, folder):
    documents, words = _vocabulary(spark, folder)
    return tk.encode(documents, "doc_id", "text", words, special=False).select("doc_id", *tk.count_tokens("tokens"))


@query(
    "txt_06_padded_batch",
    f"""WITH {VOCABULARY_SQL}, enc AS (SELECT doc_id, list_concat(list_concat([2], list(token ORDER BY pos)), [3]) AS t FROM coded GROUP BY 1)
    SELECT doc_id, array_to_string(list_concat(t, list_transform(range(20), lambda i: 0))[1:20], ' ') AS tokens, CAST(20 AS INTEGER) AS n FROM enc""",
)
def padded_batch(spark, folder):
    documents, words = _vocabulary(spark, folder)
    batch = tk.encode(documents, "doc_id", "text", words).withColumn("tokens", tk.padded(F.col("tokens"), 20))
    return batch.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n"))


@query(
    "txt_07_corpus_report",
    f"""WITH {VOCABULARY_SQL} SELECT lang, count(DISTINCT doc_id) AS total_texts, count(*) AS total_tokens,
    round(count(*) / count(DISTINCT doc_id), 6) AS tokens_per_text, round(avg((token = 1)::INT), 6) AS unknown_rate FROM coded GROUP BY 1""",
)
def corpus_report(spark, folder):
    documents, words = _vocabulary(spark, folder)
    counted = tk.encode(documents, "doc_id", "text", words, special=False, carry=["lang"]).select("lang", *tk.count_tokens("tokens"))
    total, unknown = F.sum("total_tokens"), F.sum("unknown_tokens")
    return (
        counted.groupBy("lang")
        .agg(
            F.count("*").alias("total_texts"),
            total.alias("total_tokens"),
            F.round(total / F.count("*"), 6).alias("tokens_per_text"),
            F.round(unknown / total, 6).alias("unknown_rate"),
        )
    )


@query(
    "txt_08_token_estimates",
    f"""SELECT conv_id, turn, greatest(1, length(text) // 4) AS by_length, round(len({_words("text")}) * 1.3, 4) AS by_words,
    len({_words("text")}) AS n_words FROM conversations""".replace("* 1.3", "* 1.3::DOUBLE"),
)
def token_estimates(spark, folder):
    n_words = tx.word_count(F.col("text"))
    return table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        tx.estimated_tokens(F.col("text")).alias("by_length"),
        F.round(n_words * 1.3, 4).alias("by_words"),
        n_words.alias("n_words"),
    )


# fixed values: price per million input and output tokens, the first row for models not listed
PRICES = [("large", 0.75, 2.25), ("medium", 0.50, 1.50), ("small", 0.50, 1.00)]
_MODEL_SQL = "CASE endpoint WHEN 'click' THEN 'large' WHEN 'view' THEN 'medium' WHEN 'purchase' THEN 'small' ELSE 'unlisted' END"


@query(
    "txt_09_model_cost",
    f"""WITH {REQUEST_LOG_SQL}, m AS (SELECT *, {_MODEL_SQL} AS model FROM log),
    p(model, i, o) AS (VALUES ('large', 0.75::DOUBLE, 2.25::DOUBLE), ('medium', 0.5, 1.5), ('small', 0.5, 1.0))
    SELECT m.model, count(*) AS n, round(sum(prompt_tokens / 1e6 * coalesce(p.i, 0.75) + completion_tokens / 1e6 * coalesce(p.o, 2.25)), 8) AS cost
    FROM m LEFT JOIN p USING (model) GROUP BY 1""",
)
def model_cost(spark, folder):
    log = request_log(table(spark, folder, "events")).withColumn("model", F.expr(_MODEL_SQL))
    prices = spark.createDataFrame(PRICES, "model string, input_price double, output_price double")
    _, default_input, default_output = PRICES[0]
    used = log.groupBy("model").agg(
        F.count("*").alias("n"), F.sum("prompt_tokens").alias("asked"), F.sum("completion_tokens").alias("answered")
    )
    cost = F.col("asked") / 1e6 * F.coalesce("input_price", F.lit(default_input)) + F.col("answered") / 1e6 * F.coalesce(
        "output_price", F.lit(default_output)
    )
    return used.join(prices, "model", "left").select("model", "n", F.round(cost, 8).alias("cost"))


def _templates(spark, folder):
    """A prompt template per part, with variable names taken from its columns."""
    name = F.regexp_replace("p_name", r"\s", "_")
    kind = F.lower(F.regexp_replace("p_type", r"\s", "_"))
    template = F.concat(F.lit("Describe {"), kind, F.lit("} {"), name, F.lit("} of {brand}.\nRepeat {"), kind, F.lit("}:"))
    return table(spark, folder, "part").select("p_partkey", "p_size", template.alias("template"), kind.alias("kind"), name.alias("name"))


_TEMPLATES_SQL = r"""t AS (SELECT p_partkey, p_size, lower(regexp_replace(p_type, '\s', '_', 'g')) AS kind, regexp_replace(p_name, '\s', '_', 'g') AS name FROM part)"""


@query(
    "txt_10_template_variables",
    f"""WITH {_TEMPLATES_SQL} SELECT p_partkey, kind || ',' || name || ',brand' AS variables, kind || ',' || name || ',brand,' || kind AS repeated FROM t""",
)
def template_variables(spark, folder):
    return _templates(spark, folder).select(
        "p_partkey",
        F.array_join(pr.template_variables(F.col("template")), ",").alias("variables"),
        F.array_join(pr.template_variables(F.col("template"), distinct=False), ",").alias("repeated"),
    )


@query(
    "txt_11_render",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN 'Say in ' || (1 + n_chars % 5) || ' sentences what this text is about.' || chr(10) || '---' || chr(10) || text
      || chr(10) || '---' || chr(10) || 'Answer:' ELSE 'Name the topic of this text.' || chr(10) || text END AS prompt FROM documents""",
)
def render(spark, folder):
    template = F.when(
        F.col("lang") == "en", "Say in {length} sentences what this text is about.\n---\n{text}\n---\nAnswer:"
    ).otherwise("Name the topic of this text.\n{text}")
    values = F.create_map(F.lit("text"), F.col("text"), F.lit("length"), (1 + F.col("n_chars") % 5).cast("string"))
    return table(spark, folder, "documents").select("doc_id", pr.render(template, values).alias("prompt"))


@query(
    "txt_12_template_check",
    f"""WITH {_TEMPLATES_SQL} SELECT p_partkey, p_size % 2 = 0 AS valid, CASE WHEN p_size % 2 = 0 THEN '' ELSE name END AS missing,
    CASE WHEN p_size % 2 = 0 THEN '' ELSE 'colour' END AS extra FROM t""",
)
def template_check(spark, folder):
    third = F.when(F.col("p_size") % 2 == 0, F.col("name")).otherwise(F.lit("colour"))
    given = F.array(F.col("kind"), F.lit("brand"), third)
    checked = _templates(spark, folder).select("p_partkey", *pr.check_template(F.col("template"), given))
    return checked.withColumns({c: F.array_join(c, ",") for c in ("missing", "extra")})


_RULES = "Rate the text as good or bad."
_FEW_SHOT_SQL = """ex AS (SELECT d.lang, d.text AS input, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS output,
    row_number() OVER (PARTITION BY d.lang ORDER BY d.n_chars, d.doc_id) AS no FROM labels l JOIN documents d USING (doc_id) QUALIFY no <= 2),
  shots AS (SELECT lang, string_agg('Input: ' || input || chr(10) || 'Output: ' || output || chr(10) || chr(10), '' ORDER BY no) AS examples FROM ex GROUP BY 1)"""


@query(
    "txt_13_few_shot",
    f"""WITH {_FEW_SHOT_SQL}
    SELECT doc_id, '{_RULES}' || chr(10) || chr(10) || coalesce(examples, '') || 'Input: ' || text || chr(10) || 'Output:' AS prompt
    FROM documents LEFT JOIN shots USING (lang)""",
)
def few_shot(spark, folder):
    documents = table(spark, folder, "documents")
    examples = (
        table(spark, folder, "labels")
        .join(documents, "doc_id")
        .select("lang", "n_chars", "doc_id", F.col("text").alias("input"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("output"))
    )
    # written: Spark then knows how small it is and broadcasts it
    shots = written(pr.few_shot_prefixes(examples, "lang", ["n_chars", "doc_id"], 2), "shots")
    prompt = pr.few_shot_prompt(F.lit(_RULES), F.col("examples"), F.col("text"))
    return documents.join(shots, "lang", "left").select("doc_id", prompt.alias("prompt"))


@query(
    "txt_13_sectioned_prompt",
    f"""WITH {CHAT_PAIRS_SQL} SELECT conv_id, turn, 'System: Answer briefly.' || chr(10) || chr(10) ||
    CASE WHEN input <> '' THEN 'Context:' || chr(10) || '- ' || input || chr(10) || chr(10) ELSE '' END ||
    'Examples:' || chr(10) || 'Input: ' || instruction || chr(10) || 'Output: ' || output || chr(10) || chr(10) ||
    'Instruction: Answer again.' || chr(10) || 'Output format: text' || chr(10) || chr(10) || 'Response:' AS prompt FROM pairs""",
)
def sectioned_prompt(spark, folder):
    context = F.when(F.col("input") != "", F.array("input")).otherwise(F.array().cast("array<string>"))
    prompt = pr.sectioned_prompt(
        F.lit("Answer again."),
        system=F.lit("Answer briefly."),
        context=context,
        examples=F.array(F.struct(F.col("instruction").alias("input"), F.col("output").alias("output"))),
        output_format=F.lit("text"),
    )
    return chat_pairs(table(spark, folder, "conversations")).select("conv_id", "turn", prompt.alias("prompt"))


@query(
    "txt_14_technique",
    """SELECT conv_id, turn, CASE WHEN contains(lower(text), 'step by step') OR contains(lower(text), 'think through') THEN 'chain-of-thought'
    WHEN contains(text, 'Example') OR contains(text, 'Input:') THEN 'few-shot' WHEN contains(text, 'System:') OR contains(text, 'You are') THEN 'role-based'
    WHEN contains(text, 'JSON') OR contains(lower(text), 'format:') THEN 'structured' ELSE 'zero-shot' END AS technique FROM conversations""",
)
def technique(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", pr.technique(F.col("text")).alias("technique"))


@query(
    "txt_15_json_from_text",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[' || event_id || ', 2]' END AS found FROM events""",
)
def json_from_text(spark, folder):
    """Model-like answers: one object, one array, one broken object, none."""
    kind = F.col("event_id") % 4
    answer = (
        F.when(kind == 0, F.concat(F.lit("Here it is:\n"), "props", F.lit("\nDone.")))
        .when(kind == 1, F.concat(F.lit("List: ["), F.col("event_id").cast("string"), F.lit(", 2] end")))
        .when(kind == 2, F.concat(F.lit('Broken {"k": '), "event_type", F.lit("}")))
        .otherwise("nothing here")
    )
    return table(spark, folder, "events").select("event_id", tx.json_block(answer).alias("found"))


@query(
    "txt_16_entities",
    """SELECT c_custkey, c_name AS person, n_name AS location, CAST(1 AS INTEGER) AS n_people, CAST(0 AS INTEGER) AS n_organizations
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def entities(spark, folder):
    answer = F.concat(
        F.lit('Found:\n{"people": ["'), "c_name", F.lit('"], "organizations": [], "locations": ["'), "n_name", F.lit('"]}\nend')
    )
    customers = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    layout = "people array<string>, organizations array<string>, locations array<string>"
    parsed = customers.select("c_custkey", F.from_json(tx.json_block(answer), layout).alias("e"))
    return parsed.select(
        "c_custkey",
        F.get("e.people", 0).alias("person"),
        F.get("e.locations", 0).alias("location"),
        F.size("e.people").alias("n_people"),
        F.size("e.organizations").alias("n_organizations"),
    )


@query(
    "txt_17_alpaca",
    f"""WITH {CHAT_PAIRS_SQL} SELECT conv_id, turn, '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) ||
    CASE WHEN input <> '' THEN '### Input:' || chr(10) || input || chr(10) || chr(10) ELSE '' END || '### Response:' || chr(10) || output AS sample FROM pairs""",
)
def alpaca(spark, folder):
    sample = pr.alpaca(F.col("instruction"), F.col("input"), F.col("output"))
    return chat_pairs(table(spark, folder, "conversations")).select("conv_id", "turn", sample.alias("sample"))


@query(
    "txt_18_chat_forms",
    f"""WITH {CHAT_PAIRS_SQL} SELECT conv_id, turn, '<|user|>' || chr(10) || instruction || CASE WHEN input <> '' THEN chr(10) || input ELSE '' END
    || chr(10) || '<|assistant|>' || chr(10) || output AS short_tags,
    '<|im_start|>user' || chr(10) || instruction || CASE WHEN input <> '' THEN chr(10) || chr(10) || input ELSE '' END || '<|im_end|>' || chr(10)
    || '<|im_start|>assistant' || chr(10) || output || '<|im_end|>' AS start_tags FROM pairs""",
)
def chat_forms(spark, folder):
    columns = F.col("instruction"), F.col("input"), F.col("output")
    return chat_pairs(table(spark, folder, "conversations")).select(
        "conv_id", "turn", pr.chat_short_tags(*columns).alias("short_tags"), pr.chat_start_tags(*columns).alias("start_tags")
    )


@query(
    "txt_19_sample_length",
    f"""WITH {CHAT_PAIRS_SQL}, l AS (SELECT length(instruction) + length(input) + length(output) AS n FROM pairs)
    SELECT count(*) AS n_samples, CAST(sum(n) AS BIGINT) AS total_length, round(avg(n), 6) AS mean_length FROM l""",
)
def sample_length(spark, folder):
    pairs = chat_pairs(table(spark, folder, "conversations"))
    length = (F.length("instruction") + F.length("input") + F.length("output")).cast("bigint")
    return pairs.select(length.alias("n")).agg(
        F.count("*").alias("n_samples"), F.sum("n").alias("total_length"), F.round(F.avg("n"), 6).alias("mean_length")
    )


@query(
    "txt_20_flatten_conversation",
    """SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS prompt FROM conversations GROUP BY 1""",
)
def flatten_conversation(spark, folder):
    return pr.flatten_conversations(table(spark, folder, "conversations"))


@query(
    "txt_21_last_user_message",
    """SELECT conv_id, coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS text FROM conversations GROUP BY 1""",
)
def last_user_message(spark, folder):
    return pr.last_user_message(table(spark, folder, "conversations"))


@query("txt_22_batch_model", "SELECT conv_id, turn, strip_accents(text) AS answer FROM conversations")
def batch_model(spark, folder):
    """A text-to-text callable that Spark has no expression for: letters without their accents."""

    def answer(prompts: list[str]) -> list[str]:
        return ["".join(c for c in unicodedata.normalize("NFD", p) if not unicodedata.combining(c)) for p in prompts]

    view = temp_view(table(spark, folder, "conversations"), "conversations")
    spark.udf.register(f"ask_{view}", pr.batch_model(answer))
    return spark.sql(f"SELECT conv_id, turn, ask_{view}(concat('', text)) AS answer FROM {view}")


@query(
    "txt_22_stored_answers",
    """SELECT conv_id, turn, CASE WHEN contains(text, '1') THEN NULL ELSE strip_accents(coalesce(text, '')) END AS answer,
    CASE WHEN contains(text, '1') THEN 'ValueError: no digits, please' END AS error FROM conversations""",
)
def stored_answers(spark, folder):
    """Answers of a callable that refuses some prompts; the others of their batch are answered all the same, and a second run asks the refused ones only."""

    def answer(prompts: list[str]) -> list[str]:
        if any("1" in p for p in prompts):
            raise ValueError("no digits, please")
        return ["".join(c for c in unicodedata.normalize("NFD", p) if not unicodedata.combining(c)) for p in prompts]

    chats, path = table(spark, folder, "conversations").select("conv_id", "turn", "text"), scratch(spark, "answers")
    for _ in range(2):
        found = pr.ask_stored(chats, ["conv_id", "turn"], "text", answer, path)
    return found.select("conv_id", "turn", "answer", "error")

"""Prompt templates, prompt assembly, instruction texts and batch model calls."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: a placeholder in a template
PLACEHOLDER = r"\{(\w+)\}"


def template_variables(template: Column, distinct: bool = True) -> Column:
    found = F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1))
    return F.array_distinct(found) if distinct else found


def check_template(template: Column, given: Column) -> list[Column]:
    """Missing and extra variable names, and whether the template can be filled."""
    wanted = template_variables(template)
    missing = F.array_except(wanted, given)
    return [
        (F.size(missing) == 0).alias("valid"),
        missing.alias("missing"),
        F.array_except(given, wanted).alias("extra"),
    ]


def render(template: Column, values: Column) -> Column:
    """Fill the placeholders from a map column; a missing value is an error.

    The template is cut at its placeholders, so braces inside a value are left alone.
    """
    names = template_variables(template, distinct=False)
    pieces = F.split(template, PLACEHOLDER, -1)

    def filled(name: Column, after: Column) -> Column:
        value = F.try_element_at(values, name)
        failed = F.raise_error(F.concat(F.lit("no value for template variable "), name)).cast("string")
        return F.concat(F.when(value.isNull(), failed).otherwise(value), after)

    rest = F.slice(pieces, F.lit(2), F.greatest(F.size(names), F.lit(1)))
    body = F.when(F.size(names) == 0, F.lit("")).otherwise(F.array_join(F.zip_with(names, rest, filled), ""))
    return F.concat(F.element_at(pieces, 1), body)


def few_shot_prefixes(examples: DataFrame, task: str, order: Sequence[str], shots: int) -> DataFrame:
    """(task, examples): the first ``shots`` (input, output) rows of each task as prompt text."""
    first = Window.partitionBy(task).orderBy(*order)
    kept = examples.withColumn("_no", F.row_number().over(first)).where(F.col("_no") <= shots)
    shown = F.concat(F.lit("Input: "), "input", F.lit("\nOutput: "), "output", F.lit("\n\n"))
    listed = F.array_sort(F.collect_list(F.struct("_no", shown.alias("shown"))))
    return kept.groupBy(task).agg(F.array_join(F.transform(listed, lambda s: s["shown"]), "").alias("examples"))


def few_shot_prompt(task: Column, examples: Column, question: Column) -> Column:
    return F.concat(task, F.lit("\n\n"), F.coalesce(examples, F.lit("")), F.lit("Input: "), question, F.lit("\nOutput:"))


def sectioned_prompt(
    instruction: Column,
    system: Column | None = None,
    context: Column | None = None,
    examples: Column | None = None,
    output_format: Column | None = None,
) -> Column:
    """System, context, examples, instruction, format and response sections in this order.

    ``context`` is an array of texts, ``examples`` an array of structs (input, output). Empty sections are left out.
    """
    parts = []
    if system is not None:
        parts.append(F.concat(F.lit("System: "), system, F.lit("\n")))
    if context is not None:
        bullets = F.array_join(F.transform(context, lambda c: F.concat(F.lit("- "), c)), "\n")
        parts.append(F.when(F.size(context) > 0, F.concat(F.lit("Context:\n"), bullets, F.lit("\n"))))
    if examples is not None:
        shown = F.transform(
            examples, lambda e: F.concat(F.lit("Input: "), e["input"], F.lit("\nOutput: "), e["output"], F.lit("\n"))
        )
        parts.append(F.when(F.size(examples) > 0, F.concat(F.lit("Examples:\n"), F.array_join(shown, "\n"))))
    parts.append(F.concat(F.lit("Instruction: "), instruction))
    if output_format is not None:
        parts.append(F.concat(F.lit("Output format: "), output_format))
    parts.append(F.lit("\nResponse:"))
    return F.concat_ws("\n", *parts)


def technique(prompt: Column) -> Column:
    """Prompt class by its marker words; the first class that applies counts."""
    lowered = F.lower(prompt)

    def has(source: Column, *marks: str) -> Column:
        found = F.lit(False)
        for m in marks:
            found = found | F.contains(source, F.lit(m))
        return found

    return (
        F.when(has(lowered, "step by step", "think through"), "chain-of-thought")
        .when(has(prompt, "Example", "Input:"), "few-shot")
        .when(has(prompt, "System:", "You are"), "role-based")
        .when(has(prompt, "JSON") | has(lowered, "format:"), "structured")
        .otherwise("zero-shot")
    )


# --- instruction texts ----------------------------------------------------------------


def alpaca(instruction: Column, given: Column, output: Column) -> Column:
    middle = F.when(given != "", F.concat(F.lit("### Input:\n"), given, F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("### Instruction:\n"), instruction, F.lit("\n\n"), middle, F.lit("### Response:\n"), output)


def chat_short_tags(instruction: Column, given: Column, output: Column) -> Column:
    more = F.when(given != "", F.concat(F.lit("\n"), given)).otherwise(F.lit(""))
    return F.concat(F.lit("<|user|>\n"), instruction, more, F.lit("\n<|assistant|>\n"), output)


def chat_start_tags(instruction: Column, given: Column, output: Column) -> Column:
    more = F.when(given != "", F.concat(F.lit("\n\n"), given)).otherwise(F.lit(""))
    opened, closed = F.lit("<|im_start|>"), F.lit("<|im_end|>")
    return F.concat(
        opened, F.lit("user\n"), instruction, more, closed, F.lit("\n"), opened, F.lit("assistant\n"), output, closed
    )


def flatten_conversations(chat: DataFrame) -> DataFrame:
    """(conv_id, prompt): 'role: text' lines in turn order, one row per conversation however long it is."""
    line = F.concat("role", F.lit(": "), "text")
    listed = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    return chat.groupBy("conv_id").agg(F.array_join(F.transform(listed, lambda t: t["line"]), "\n").alias("prompt"))


def last_user_message(chat: DataFrame) -> DataFrame:
    """(conv_id, text): the user's last message, '' when there is none."""
    said = F.when(F.col("role") == "user", F.col("turn"))
    return chat.groupBy("conv_id").agg(F.coalesce(F.max_by("text", said), F.lit("")).alias("text"))


# --- model calls ----------------------------------------------------------------------


def batch_model(call: Callable[[list[str]], list[str]]):
    """A text model as an iterator UDF: ``call`` gets a batch of prompts and returns as many answers."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            yield pd.Series(call(list(prompts)), index=prompts.index, dtype=object)

    return run


def ask_stored(prompts: DataFrame, keys: Sequence[str], prompt: str, call: Callable[[list[str]], list[str]], path: str, batch: int = 64, retries: int = 2) -> DataFrame:
    """(keys..., answer, error, tries) of every prompt, with the answers stored at ``path`` as they come.

    Only prompts without a stored answer are asked, so a second run asks again where the first one failed and for new prompts. ``call`` gets up to
    ``batch`` prompts; when it raises, or returns another number of answers, each of them is asked alone, up to ``retries`` times more, and one that
    still fails has the last error instead of an answer. Keys are unique and not null; a null prompt is asked as ''. A run that is broken off
    stores nothing of its own, and what earlier runs stored stays.
    """
    spark = prompts.sparkSession
    schema = T.StructType([*(prompts.schema[k] for k in keys), *T._parse_datatype_string("answer string, error string, tries int").fields])

    def stored() -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:  # nothing has been stored yet
            return spark.createDataFrame([], schema)

    def answers(texts: list[str]) -> list[str]:
        found = list(call(texts))
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} answers to {len(texts)} prompts")
        return found

    def alone(text: str) -> tuple[str | None, str | None, int]:
        error = None
        for tries in range(1, retries + 2):
            try:
                return answers([text])[0], None, tries
            except Exception as e:  # whatever a model raises is the row's error
                error = f"{type(e).__name__}: {e}"
        return None, error, retries + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                texts = part["prompt to ask"].tolist()
                try:
                    rows = [(a, None, 1) for a in answers(texts)]
                except Exception:
                    rows = [alone(t) for t in texts]
                made = part[list(keys)].reset_index(drop=True)
                made[["answer", "error", "tries"]] = pd.DataFrame(rows, columns=["answer", "error", "tries"], dtype=object)
                yield made

    asked = prompts.select(*keys, F.coalesce(F.col(prompt), F.lit("")).alias("prompt to ask"))
    answered = stored().where("error IS NULL").select(*keys).distinct()
    asked.join(answered, list(keys), "left_anti").mapInPandas(run, schema).write.mode("append").parquet(path)
    # an answer comes before the errors of earlier runs
    last = F.min_by(F.struct("answer", "error", "tries"), F.col("error").isNotNull().cast("int")).alias("last")
    latest = stored().groupBy(*keys).agg(last).select(*keys, "last.*")
    return prompts.select(*keys).join(latest, list(keys))

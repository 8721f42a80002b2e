"""Text expressions. All but the many-pattern search stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column, lower: bool = True) -> Column:
    """Whitespace-separated words, lower-cased by default, no empty words."""
    source = F.lower(text) if lower else text
    return F.filter(F.split(source, r"\s+"), lambda w: w != "")


def word_set(text: Column) -> Column:
    return F.array_distinct(words(text))


def word_count(text: Column) -> Column:
    return F.size(words(text, lower=False)).cast("bigint")


def preview(text: Column, n: int) -> Column:
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 on an empty whole."""
    return F.when(whole > 0, part / F.greatest(whole, F.lit(1))).otherwise(F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    """Number of distinct words the two word arrays have in common."""
    return F.size(F.array_intersect(a, b))


def found_patterns(text: Column, patterns: Sequence[str]) -> Column:
    """The patterns that occur in the text, case-insensitively, in list order."""
    listed = F.array(*[F.lit(p) for p in patterns])
    # the one-element array makes Spark lower the text once, not once per pattern
    once = F.array(F.lower(text))
    return F.get(F.transform(once, lambda t: F.filter(listed, lambda p: F.contains(t, F.lower(p)))), F.lit(0))


#: Characters of all patterns of an automaton at most; it takes some 50 bytes a character in every Python worker.
AUTOMATON_CHARS = 4_000_000


def found_many(text: Column, patterns: Sequence[str]) -> Column:
    """Places (0, 1, ...) of the patterns that occur in the text, case-insensitively, in list order, as an array: one walk over a text for all patterns.

    For thousands of patterns; ``found_patterns`` looks for each one and stays in the JVM. Null texts hold none; an empty pattern is in every text.
    """
    listed = [p.lower() for p in patterns]
    if sum(map(len, listed)) > AUTOMATON_CHARS:
        raise ValueError(f"the patterns have more than {AUTOMATON_CHARS} characters; ask in several lists")

    @F.pandas_udf("array<int>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        places: dict[str, list[int]] = {}
        for i, p in enumerate(listed):
            places.setdefault(p, []).append(i)
        always = places.pop("", [])
        automaton = ahocorasick.Automaton()
        for p, at in places.items():
            automaton.add_word(p, at)
        automaton.make_automaton()
        for batch in batches:
            found = []
            for t in batch:
                hits = set(always) if t is not None else set()
                if t and places:
                    for _, at in automaton.iter(t):
                        hits.update(at)
                found.append(sorted(hits))
            yield pd.Series(found, dtype=object)

    return look(F.lower(text))


def has_email_signs(text: Column) -> Column:
    return F.contains(text, F.lit("@")) & F.contains(text, F.lit("."))


def has_ten_digits(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", "")) >= 10


def has_ssn(text: Column) -> Column:
    return text.rlike(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b")


def estimated_tokens(text: Column) -> Column:
    """About four characters a token, at least one."""
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.length(text) / 4))


def json_block(text: Column) -> Column:
    """Text from the first '{' to the last '}', or from the first '[' to the last ']' when
    there are no braces; NULL when what is found does not parse."""
    has_braces = F.contains(text, F.lit("{")) & F.contains(text, F.lit("}"))
    found = F.when(has_braces, F.regexp_extract(text, r"(?s)(\{.*\})", 1)).otherwise(
        F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    )
    return F.when((found != "") & F.try_parse_json(found).isNotNull(), found)

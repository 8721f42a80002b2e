"""Operator 5: licence notices found by a positional index of rare words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marlstone.llm.texts import map_texts

# --- fixed values: phrases of the base labels, and public licence notices with the phrases that must stand in them
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

TEMPLATES = [
    ("mit", "Released under the MIT License", ["mit license"]),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions",
        ["permission is hereby granted free of charge", "sublicense and or sell"],
    ),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at",
        ["apache license", "in compliance with the license"],
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license"]),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ["gnu general public license", "free software foundation"],
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
        ["gnu lesser general public license"],
    ),
    (
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
        ["gnu affero general public license"],
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies",
        ["for any purpose with or without fee is hereby granted"],
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at",
        ["mozilla public license"],
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software",
        ["free and unencumbered software released into the public domain"],
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0 international license"]),
]
# --- end of fixed values

#: A word is rare when at most this share of the templates has it.
RARE = 0.35
#: Share of a template's words that must stand at their places for its label.
COVERED = 0.8

#: a-z, 0-9 and bytes of other scripts stay, A-Z become a-z, all else separates words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


class Template(NamedTuple):
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]


class Finding(NamedTuple):
    label: str
    start: int
    length: int
    coverage: float
    verified: bool


class Index:
    """Postings (template, place) of words that few templates have, weighted by inverse document frequency."""

    def __init__(self, templates=TEMPLATES, rare: float = RARE, covered: float = COVERED):
        self.templates = [Template(label, words_of(text), [words_of(p) for p in phrases]) for label, text, phrases in templates]
        self.covered = covered
        holders = Counter(w for t in self.templates for w in set(t.words))
        self.idf = {w: math.log(len(self.templates) / n) for w, n in holders.items()}
        least = math.log(1 / rare)
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(self.templates):
            for place, w in enumerate(t.words):
                if self.idf[w] >= least:
                    self.postings[w].append((k, place))
        self.postings = dict(self.postings)

    def find(self, words: list[bytes]) -> list[Finding]:
        """Places where rare words of a template stand at its distances; a finding is verified if its phrases stand there and enough words do.

        Every rare word of a text is looked up, and the words vote for (template, start). A start needs the votes of
        half of the weight of the template's rare words to be looked at word by word.
        """
        votes: dict[tuple[int, int], float] = defaultdict(float)
        for at, w in enumerate(words):
            if w in self.postings:
                for k, place in self.postings[w]:
                    votes[k, at - place] += self.idf[w]
        found = []
        for (k, start), weight in votes.items():
            t = self.templates[k]
            if 2 * weight < self._weight(k):
                continue
            here = [words[start + i] if 0 <= start + i < len(words) else b"" for i in range(len(t.words))]
            coverage = sum(a == b for a, b in zip(here, t.words, strict=True)) / len(t.words)
            phrases = all(any(here[i : i + len(p)] == p for i in range(len(here) - len(p) + 1)) for p in t.phrases)
            found.append(Finding(t.label, max(start, 0), len(t.words), coverage, phrases and coverage >= self.covered))
        return found

    def _weight(self, k: int) -> float:
        return sum(self.idf[w] for w in self.templates[k].words if w in self.postings)


def phrase_places(words: list[bytes], phrases: list[list[bytes]]) -> list[tuple[int, int]]:
    """(start, phrase) wherever the words of a phrase stand one after the other."""
    by_last = defaultdict(list)
    for k, p in enumerate(phrases):
        by_last[p[-1]].append((k, p))
    found = []
    for last, ending in by_last.items():
        at = -1
        for _ in range(words.count(last)):
            at = words.index(last, at + 1)
            found += [(at - len(p) + 1, k) for k, p in ending if at + 1 >= len(p) and words[at - len(p) + 1 : at + 1] == p]
    return sorted(found)


def scan(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_words, n_base, first_word, last_word, base_labels, labels, score for every whole text (null: empty).

    n_base counts all places of the base phrases; first_word and last_word are the smallest and largest start of one, null
    without any. labels adds those of verified templates; labels are distinct, sorted and joined by commas ('' for none).
    The score is the largest share of a template's words that stand at their places, 0 without a candidate.
    """
    phrases, names = [words_of(p) for p, _ in BASE_PHRASES], [label for _, label in BASE_PHRASES]
    lasts = {p[-1] for p in phrases}

    def factory():
        index = Index()
        asked = lasts | index.postings.keys()

        def work(texts):
            rows = []
            for text in texts:
                words = words_of(text)
                if asked.isdisjoint(words):
                    rows.append((len(words), 0, None, None, "", "", 0.0))
                    continue
                places = phrase_places(words, phrases)
                found = index.find(words)
                base = {names[k] for _, k in places}
                more = {f.label for f in found if f.verified}
                rows.append(
                    (
                        len(words),
                        len(places),
                        places[0][0] if places else None,
                        places[-1][0] if places else None,
                        ",".join(sorted(base)),
                        ",".join(sorted(base | more)),
                        max((f.coverage for f in found), default=0.0),
                    )
                )
            return list(zip(*rows, strict=True))

        return work

    longs, strings = ["n_words", "n_base", "first_word", "last_word"], ["base_labels", "labels"]
    fields = [T.StructField(n, T.LongType()) for n in longs] + [T.StructField(n, T.StringType()) for n in strings]
    return map_texts(df, keep, text, [*fields, T.StructField("score", T.DoubleType())], factory)

"""Operator 11: personal data by patterns, and by a semi-Markov conditional random field over whole spans.

Only islands of a text can hold personal data: stretches of digits and their separators, and what surrounds an at sign. An island
is cut into atoms (runs of letters, runs of digits, single other characters). A segmentation covers it with single outside atoms
and entities of at most ``REACH`` atoms. Its score is the sum of the scores of its entities, each a linear function of features of
the whole span (number of digits, check digit, groups, separators, neighbours), and of the steps from one entity's kind to the next.
The weights maximise the likelihood of known segmentations; the best one is found by dynamic programming over (atom, kind).
"""

from __future__ import annotations

import random
import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.texts import map_texts

KINDS = ("email", "ip", "card", "phone")
#: Atoms of an entity at most.
REACH = 40
#: Islands of the corpus that the model learns from at most, the first ones by a hash; and islands made by rule besides.
SAMPLE_ISLANDS, MADE_ISLANDS = 400, 700
#: Islands with more atoms than this are not learned from.
LEARNED_ATOMS = 28
#: An entity needs so much more score than the best segmentation without it.
MARGIN = 1.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_ANY = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_NUMBERS = re.compile(r"[+(]{0,2}[0-9]+(?:[\x20().+-]{1,3}[0-9]+)*")
_AT = re.compile(r"@|\x20?[\[(](?:at|AT)[\])]\x20?")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]+)*")
_ATOMS = re.compile(r"[A-Za-z]+|[0-9]+|.", re.DOTALL)

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * d - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def _at_most_255(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) < 4 and int(short or "0") <= 255


def pattern_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(spans, dropped spans) of the patterns: leftmost matches that do not overlap, per kind, and those of them that fail their check.

    The patterns are those of the contract; they are matched from at signs and digit stretches on, so a text is walked through once.
    """
    spans: list[Span] = []
    dropped: list[Span] = []
    ended = at = 0
    while (sign := text.find("@", at)) >= 0:
        found = _DOMAIN.match(text, sign + 1)
        low = max(ended, at)
        start = low + len(text[low:sign].rstrip(_LOCAL))
        if found and start < sign:
            ended = found.end()
            spans.append((start, 0, ended))
        at = sign + 1
    for stretch in _DOTTED.finditer(text):
        body = stretch[0]
        if body.count(".") < 3:
            continue
        parts, place = body.split("."), stretch.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i : i + 4])) + 3
            (spans if all(map(_at_most_255, parts[i : i + 4])) else dropped).append((place, 1, place + size))
            place += size + 1
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = _DIGITS.sub("", match[0])
            if len(digits) >= 12:
                (spans if len(digits) <= 19 and luhn(digits) else dropped).append((match.start(), 2, match.end()))
    for match in _PHONE.finditer(text):
        size = len(_DIGITS.sub("", match[0]))
        (spans if 9 <= size <= 15 else dropped).append((match.start(), 3, match.end()))
    return sorted(spans), sorted(dropped)


def islands(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches that can hold personal data: at least seven digits or four dotted numbers, or a sign for at."""
    found = []
    for match in _NUMBERS.finditer(text):
        body = match[0]
        if len(body) >= 7 and (body.count(".") >= 3 or len(_DIGITS.sub("", body)) >= 7):
            found.append(match.span())
    before = 0
    for sign in _AT.finditer(text):
        host = _HOST.match(text, sign.end())
        start = before + len(text[before : sign.start()].rstrip(_LOCAL))
        if host and start < sign.start():
            found.append((start, host.end()))
        before = sign.end()
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


FEATURES = (
    "any span, begins with plus, begins with parenthesis, begins with digit, begins with letter, one at sign, spelled at sign, dot behind at sign, ends in letters, "
    "letters without at sign, 6 digits or fewer, 7 or 8 digits, 9 to 11 digits, 12 or 13 digits, 14 or 15 digits, 16 digits, 17 to 19 digits, 20 digits or more, "
    "check digit right, check digit wrong, four dotted parts to 255, four dotted parts beyond 255, one group, two groups, three groups, four groups, five groups or more, "
    "groups of four, no separator, dots only, dashes only, spaces only, parentheses, mixed separators, parentheses open, last group of four, groups up to four, group over five, "
    "alphanumeric before, mark before, alphanumeric behind, mark and alphanumeric behind, space and at sign, two separators together, groups of two or fewer"
).split(", ")


class Island(NamedTuple):
    """Atoms of an island and the characters around it."""

    atoms: list[str]
    offsets: list[int]  # of the atoms, and the end
    before: str
    behind: str


def island(text: str, start: int, end: int) -> Island:
    atoms = _ATOMS.findall(text, start, end)
    offsets = [start]
    for atom in atoms:
        offsets.append(offsets[-1] + len(atom))
    return Island(atoms, offsets, text[start - 1 : start], text[end : end + 2])


def candidates(isle: Island) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first atom, atom behind the last, features) of every span that could be an entity: at most REACH atoms, at most 19 digits, at
    least seven digits or four dotted parts or a sign for at."""
    atoms = isle.atoms
    n = len(atoms)
    digit = np.array([a[0] in "0123456789" for a in atoms], dtype=bool)
    letter = np.array([a.isascii() and a[0].isalpha() for a in atoms], dtype=bool)
    size = np.array([len(a) for a in atoms])
    low = [a.lower() for a in atoms]

    def bracketed(word):
        return np.array([low[i] == word and 0 < i < n - 1 and low[i - 1] in "[(" and low[i + 1] in "])" for i in range(n)], dtype=bool)

    is_ = {c: np.array([a == c for a in atoms], dtype=bool) for c in "+().- @"}
    spelled_at, spelled_dot = bracketed("at"), bracketed("dot")
    mark = ~digit & ~letter
    beyond = np.array([d and not _at_most_255(a) for a, d in zip(atoms, digit, strict=True)], dtype=bool)

    def sums(values):
        return np.concatenate([[0], np.cumsum(values)])

    counted = {
        "digits": sums(digit * size), "groups": sums(digit), "letters": sums(letter), "marks": sums(mark), "beyond": sums(beyond),
        "fours": sums(digit & (size == 4)), "to four": sums(digit & (size <= 4)), "over five": sums(digit & (size > 5)), "to two": sums(digit & (size <= 2)),
        "at": sums(is_["@"]), "spelled": sums(spelled_at), "dots": sums(is_["."] | spelled_dot), "dashes": sums(is_["-"]), "spaces": sums(is_[" "]),
        "open": sums(is_["("]), "closed": sums(is_[")"]), "plus": sums(is_["+"]),
        "together": sums(np.concatenate([[False], mark[1:] & mark[:-1] & ~is_[")"][:-1] & ~is_["("][1:]])) if n else sums(mark),
    }
    begins = digit | letter | is_["+"] | is_["("]
    ends = digit | letter
    starts, stops = [], []
    total = counted["digits"]
    for length in range(1, min(REACH, n) + 1):
        i = np.arange(n - length + 1)
        j = i + length
        digits = total[j] - total[i]
        signs = (counted["at"][j] - counted["at"][i]) + (counted["spelled"][j] - counted["spelled"][i])
        fine = begins[i] & ends[j - 1] & (digits <= np.where(signs > 0, 1 << 30, 19))
        fine &= (digits >= 7) | (signs == 1) | ((counted["dots"][j] - counted["dots"][i] == 3) & (counted["groups"][j] - counted["groups"][i] == 4))
        starts.append(i[fine])
        stops.append(j[fine])
    i, j = np.concatenate([*starts, np.empty(0, int)]).astype(np.int64), np.concatenate([*stops, np.empty(0, int)]).astype(np.int64)
    if not len(i):
        return i, j, np.zeros((0, len(FEATURES)), dtype=np.float32)
    c = {name: values[j] - values[i] for name, values in counted.items()}
    signs = c["at"] + c["spelled"]
    plain = signs == 0
    separators = c["dots"] + c["dashes"] + c["spaces"] + c["open"] + c["closed"] + c["plus"] - is_["+"][i]
    last_sign = np.concatenate([[-1], np.maximum.accumulate(np.where(is_["@"] | spelled_at, np.arange(n), -1))])[j]
    dots_behind = np.where(last_sign >= i, counted["dots"][j] - counted["dots"][np.maximum(last_sign, 0)], 0)
    quad = plain & (c["dots"] == 3) & (c["groups"] == 4) & (c["marks"] == 3) & (c["letters"] == 0)
    checked = plain & (c["digits"] >= 12) & (c["digits"] <= 19) & (c["letters"] == 0) & (c["open"] == 0) & (c["plus"] == 0)
    right = np.zeros(len(i), dtype=bool)
    for k in np.flatnonzero(checked).tolist():
        right[k] = luhn("".join(a for a, d in zip(atoms[i[k] : j[k]], digit[i[k] : j[k]], strict=True) if d))
    before = np.array([isle.before[-1:], *[a[-1] for a in atoms]])[i]
    first_behind = np.array([*[a[0] for a in atoms], isle.behind[:1]])[j]
    second = [*atoms, *isle.behind, "", ""]
    then = np.array([second[k + 1][:1] if k < n - 1 else (isle.behind[: 1] if k == n - 1 else isle.behind[1:2]) for k in range(n + 1)])[j]
    joined = np.array([x.isalnum() or x == "_" for x in before.tolist()])
    follows = np.array([x.isalnum() or x == "_" for x in first_behind.tolist()])
    columns = [
        np.ones(len(i), dtype=bool), is_["+"][i], is_["("][i], digit[i], letter[i], c["at"] == 1, c["spelled"] == 1, dots_behind > 0, letter[j - 1],
        plain & (c["letters"] > 0),
        *[plain & (c["digits"] >= a) & (c["digits"] <= b) for a, b in ((0, 6), (7, 8), (9, 11), (12, 13), (14, 15), (16, 16), (17, 19), (20, 1 << 30))],
        checked & right, checked & ~right, quad & (c["beyond"] == 0), quad & (c["beyond"] > 0),
        *[plain & (c["groups"] == k) for k in (1, 2, 3, 4)], plain & (c["groups"] > 4),
        plain & (c["fours"] == c["groups"]) & (c["groups"] == 4),
        plain & (separators == 0), plain & (separators > 0) & (separators == c["dots"]), plain & (separators > 0) & (separators == c["dashes"]),
        plain & (separators > 0) & (separators == c["spaces"]), plain & (c["open"] > 0),
        plain & (separators > 0) & (separators != c["dots"]) & (separators != c["dashes"]) & (separators != c["spaces"]) & (c["open"] == 0),
        c["open"] != c["closed"], plain & digit[j - 1] & (size[j - 1] == 4), plain & (c["to four"] == c["groups"]), plain & (c["over five"] > 0),
        joined, np.isin(before, [".", "-", "+"]), follows, np.isin(first_behind, [".", "-"]) & np.array([x.isalnum() for x in then.tolist()]),
        (signs > 0) & (c["spaces"] > 0) & (c["spelled"] == 0), plain & (c["together"] > 0), plain & (c["to two"] == c["groups"]),
    ]
    return i, j, np.stack(columns, axis=1).astype(np.float32)


class Model(NamedTuple):
    weights: np.ndarray  # (features, kinds)
    steps: np.ndarray  # (outside and kinds, outside and kinds): from the segment before to the next one


def best_segmentation(isle: Island, model: Model, margin: float = MARGIN) -> list[Span]:
    """Entities (start, kind, end) of the best segmentation: for every atom and kind, the best score of what ends there."""
    i, j, features = candidates(isle)
    if not len(i):
        return []
    scores = features @ model.weights - margin
    n, steps = len(isle.atoms), model.steps.tolist()
    by_end: dict[int, list] = {}
    for a, b, own in zip(i.tolist(), j.tolist(), scores.tolist(), strict=True):
        by_end.setdefault(b, []).append((a, own))
    kinds = range(1, len(KINDS) + 1)
    best = [[0.0] + [-np.inf] * len(KINDS)]  # best[place][kind of the last segment]
    back: list[list] = [[None] * (len(KINDS) + 1)]
    into = [[max((best[0][y] + steps[y][k], y) for y in range(len(KINDS) + 1)) for k in range(len(KINDS) + 1)]]
    for place in range(1, n + 1):
        score, previous = into[place - 1][0]
        row, trace = [score] + [-np.inf] * len(KINDS), [(place - 1, previous)] + [None] * len(KINDS)
        for a, own in by_end.get(place, ()):
            for k in kinds:
                score = into[a][k][0] + own[k - 1]
                if score > row[k]:
                    row[k], trace[k] = score, (a, into[a][k][1])
        best.append(row)
        back.append(trace)
        into.append([max((row[y] + steps[y][k], y) for y in range(len(KINDS) + 1)) for k in range(len(KINDS) + 1)])
    spans = []
    place, kind = n, max(range(len(KINDS) + 1), key=lambda y: (best[n][y], -y))
    while place:
        start, previous = back[place][kind]
        if kind:
            spans.append((isle.offsets[start], kind - 1, isle.offsets[place]))
        place, kind = start, previous
    return spans[::-1]


def learn(examples: list[tuple[Island, list[Span]]], rounds: int = 70, penalty: float = 0.002) -> Model:
    """Weights by Adam steps on the log likelihood of the known segmentations; expectations by the forward and backward sums of all islands side by side."""
    parts = [candidates(isle) for isle, _ in examples]
    size = max((len(isle.atoms) for isle, _ in examples), default=1)
    count, kinds = len(examples), len(KINDS)
    owner = np.repeat(np.arange(count), [len(p[0]) for p in parts])
    first, end = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (0, 1))
    features = np.concatenate([p[2] for p in parts])
    atoms = np.array([len(isle.atoms) for isle, _ in examples])
    gold = np.zeros((len(owner), kinds), dtype=np.float32)
    gold_steps = np.zeros((kinds + 1, kinds + 1))
    place_of = {(b, a, e): k for k, (b, a, e) in enumerate(zip(owner.tolist(), first.tolist(), end.tolist(), strict=True))}
    for b, (isle, spans) in enumerate(examples):
        state, at = 0, 0
        where = {offset: k for k, offset in enumerate(isle.offsets)}
        for start, kind, stop in spans:
            k = place_of.get((b, where.get(start), where.get(stop)))
            if k is None:
                continue
            outside = where[start] - at
            if outside:
                gold_steps[state, 0] += 1
                gold_steps[0, 0] += outside - 1
                state = 0
            gold_steps[state, kind + 1] += 1
            gold[k, kind] = 1
            state, at = kind + 1, where[stop]
        if at < len(isle.atoms):
            gold_steps[state, 0] += 1
            gold_steps[0, 0] += len(isle.atoms) - at - 1
    weights, steps = np.zeros((len(FEATURES), kinds)), np.zeros((kinds + 1, kinds + 1))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(steps), np.zeros_like(steps)]
    rows = np.arange(count)

    def by_place(place):
        """For each atom: the spans that begin (or end) there by island, where each island's begin among them, and those islands."""
        order = np.lexsort((owner, place))
        bounds = np.searchsorted(place[order], np.arange(size + 2))
        groups = [order[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
        leads = [np.flatnonzero(np.concatenate([[True], np.diff(owner[g]) != 0])) if len(g) else np.empty(0, int) for g in groups]
        return list(zip(groups, leads, [owner[g[x]] for g, x in zip(groups, leads, strict=True)], strict=True))

    ending, beginning = by_place(end), by_place(first)

    def through(values, matrix):
        """Logarithms of the sums over the kinds before (or behind) a step."""
        top = values.max(axis=1, keepdims=True)
        top = np.where(np.isfinite(top), top, 0)
        with np.errstate(divide="ignore"):
            return np.log(np.exp(values - top) @ np.exp(matrix)) + top

    for step in range(1, rounds + 1):
        scores = np.einsum("sf,fk->sk", features, weights)  # on one core, unlike a product of matrices
        alpha = np.full((count, size + 1, kinds + 1), -np.inf)
        alpha[:, 0, 0] = 0
        into = np.full((count, size + 1, kinds + 1), -np.inf)
        into[:, 0] = through(alpha[:, 0], steps)
        for e in range(1, size + 1):
            alpha[:, e, 0] = into[:, e - 1, 0]
            group, leads, whose = ending[e]
            if len(group):
                alpha[whose, e, 1:] = np.logaddexp.reduceat(into[owner[group], first[group], 1:] + scores[group], leads, axis=0)
            into[:, e] = through(alpha[:, e], steps)
        # beta: what follows a place, by the kind of the last segment; onward: what follows when a segment of a kind begins there
        beta = np.full((count, size + 1, kinds + 1), -np.inf)
        onward = np.full((count, size + 1, kinds + 1), -np.inf)
        beta[rows, atoms] = 0
        for e in range(size - 1, -1, -1):
            onward[:, e, 0] = beta[:, e + 1, 0]
            group, leads, whose = beginning[e]
            if len(group):
                onward[whose, e, 1:] = np.logaddexp.reduceat(beta[owner[group], end[group], 1:] + scores[group], leads, axis=0)
            beta[:, e] = np.where((e < atoms)[:, None], through(onward[:, e], steps.T), beta[:, e])
        total = np.logaddexp.reduce(alpha[rows, atoms], axis=1)
        chance = np.exp(into[owner, first][:, 1:] + scores + beta[owner, end][:, 1:] - total[owner, None])
        inside = np.exp(alpha[:, :-1, :, None] + steps[None, None] + onward[:, :-1, None, :] - total[:, None, None, None])
        expected = np.where((np.arange(size)[None] < atoms[:, None])[:, :, None, None], inside, 0).sum(axis=(0, 1))
        for k, (value, slope) in enumerate(((weights, np.einsum("sf,sk->fk", features, gold - chance) / count), (steps, (gold_steps - expected) / count))):
            slope = slope - penalty * value
            moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * slope
            moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * slope**2
            value += 0.15 * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
    return Model(weights, steps)


def made_examples(count: int = MADE_ISLANDS, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Texts with known entities in many written forms, and numbers and addresses that are none."""
    rng = random.Random(seed)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))

    def grouped(text, sizes, sep):
        out, at = [], 0
        for n in sizes:
            out.append(text[at : at + n])
            at += n
        return sep.join(out)

    def email():
        local = rng.choice([word(), f"{word()}.{word()}", f"{word()}.{digits(2)}", f"{word()}_{word()}", f"{word()}+{word()}", f"{word()}{digits(3)}"])
        hosts = [word() + rng.choice(["", digits(1)]) for _ in range(rng.randrange(1, 3))] + [rng.choice(["com", "org", "net", "de", "fr", "io"])]
        if rng.random() < 0.2:
            left, right = rng.choice(["[]", "()"])
            gap = rng.choice(["", " "])
            return f"{local}{gap}{left}at{right}{gap}" + rng.choice([".", f"{gap}{left}dot{right}{gap}"]).join(hosts)
        return f"{local}@{'.'.join(hosts)}"

    def ip():
        return ".".join(str(rng.randrange(256)) for _ in range(4))

    def checked(n, valid):
        while True:
            text = rng.choice("3456") + digits(n - 1)
            if luhn(text) == valid:
                return text

    def card(valid=True):
        n = rng.choice([16, 16, 16, 16, 15, 13, 19])
        text = checked(n, valid)
        return rng.choice([text, grouped(text, (4, 4, 4, 4), rng.choice(" -.")) if n == 16 else text])

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        sep = rng.choice("-. ")
        world = f"+{rng.randrange(1, 999)}"
        return rng.choice([f"{world} ({a}) {b}-{c}", f"{world} ({a}) {b}-{c}", f"{world}{sep}{a}{sep}{b}{sep}{c}", f"+{digits(11)}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{world} {digits(2)} {c} {digits(4)}"])

    def nothing():
        day = f"{rng.randrange(1900, 2100)}", f"{rng.randrange(1, 13):02}", f"{rng.randrange(1, 29):02}"
        choices = [
            digits(rng.randrange(7, 12)), checked(16, False), card(False), "-".join(day), ".".join(day[::-1]), "".join(day), f"{digits(4)}.{digits(5)}", f"{day[0]} {day[1]} {digits(3)}",
            ".".join(str(rng.randrange(99)) for _ in range(rng.choice([3, 5, 6]))), f"{rng.randrange(256, 999)}." + ip().split(".", 1)[1], f"{word()}@{word()}", digits(rng.randrange(20, 40)),
            " ".join(digits(rng.randrange(1, 4)) for _ in range(rng.randrange(4, 9))),
        ]
        return rng.choice(choices)

    out = []
    for _ in range(count):
        text, spans = rng.choice(["", "x ", ""]), []
        for k in range(rng.choice([1, 1, 1, 2, 2, 3])):
            kind = rng.choice([0, 1, 2, 3, None, None])
            body = (email, ip, card, phone)[kind]() if kind is not None else nothing()
            text += rng.choice([" ", " ", " ", ", "]) if k else ""
            if kind is not None:
                spans.append((len(text), kind, len(text) + len(body)))
            text += body
        out.append((text + rng.choice(["", ".", " x", ","]), spans))
    return out


def cut(text: str, spans: list[Span]) -> list[tuple[Island, list[Span]]]:
    """The islands of a text, each with the spans in it."""
    return [(island(text, a, b), [s for s in spans if a <= s[0] and s[2] <= b]) for a, b in islands(text)]


def sampled(df: DataFrame, text: str = "text", limit: int = SAMPLE_ISLANDS) -> list[str]:
    """At most ``limit`` distinct islands of ``df`` (with a little of the text around them), the first ones by a hash. All whole texts are looked through."""

    def factory():
        def work(texts):
            return ([[body[max(0, a - 2) : b + 2] for a, b in islands(body) if b - a <= 80] if body and _ANY.search(body) else None for body in texts],)

        return work

    found = map_texts(df, [], text, [T.StructField("found", T.ArrayType(T.StringType()))], factory)
    pieces = found.filter("found IS NOT NULL").select(F.explode("found").alias("piece")).distinct()
    return [r["piece"] for r in pieces.orderBy(F.xxhash64("piece"), "piece").limit(limit).collect()]


def fitted(df: DataFrame, text: str = "text") -> Model:
    """The model, learned from islands of the corpus as the patterns label them, and from made ones.

    Islands in which the patterns drop a match for its number of digits, or overlap, are no examples: there the patterns do not know.
    """
    examples = [x for body, spans in made_examples() for x in cut(body, spans)]
    for piece in sampled(df, text):
        spans, dropped = pattern_spans(piece)
        unsure = [s for s in dropped if s[1] == 3 or s[1] == 2 and not 12 <= len(_DIGITS.sub("", piece[s[0] : s[2]])) <= 19]
        if not unsure and all(a[2] <= b[0] for a, b in zip(spans, spans[1:], strict=False)):
            examples += cut(piece, spans)
    return learn([x for x in examples if len(x[0].atoms) <= LEARNED_ATOMS])


def all_spans(text: str | None, model: Model) -> tuple[list[Span], list[Span]]:
    """(spans of the patterns, spans that the model adds): those of its best segmentation that touch none of the patterns'."""
    if not text or not _ANY.search(text):
        return [], []
    own, _ = pattern_spans(text)
    added: list[Span] = []
    for start, end in islands(text):
        near = [s for s in own if s[0] < end and start < s[2]] if len(own) < 50 else own
        for span in best_segmentation(island(text, start, end), model):
            if all(span[2] <= s[0] or s[2] <= span[0] for s in near):
                added.append(span)
    return own, added


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("by_pattern", T.BooleanType())])


def personal_spans(df: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``keep`` and ``spans``: array of (kind, start, end, by_pattern) in code points, by start, then kind, for every whole text.

    All spans of the patterns are there; the model adds spans that touch none of them. Null and empty texts have none; rows are independent, so
    repeated rows, ties and clashing names change nothing; an empty table gives no rows. Rows stay where the scan put them.
    """

    def factory():
        def work(texts):
            found = []
            for body in texts:
                own, added = all_spans(body, model)
                marked = sorted([(a, k, b, True) for a, k, b in own] + [(a, k, b, False) for a, k, b in added])
                found.append([{"kind": KINDS[k], "start": a, "end": b, "by_pattern": p} for a, k, b, p in marked])
            return (found,)

        return work

    return map_texts(df, keep, text, [T.StructField("spans", T.ArrayType(SPAN))], factory)


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (all of the patterns' spans) and spans (all of them) for every document."""
    found = personal_spans(df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text")), ["doc_id"], fitted(df, text))
    base = F.filter("spans", lambda s: s["by_pattern"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

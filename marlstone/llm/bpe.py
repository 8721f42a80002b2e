"""Byte-pair encoding as a streaming transducer, and its decoder.

A merge list has a *sufficient lookahead*: once that many symbols behind a token boundary are known, nothing that
follows can move the boundary. So a word's symbols are read through a window; the tokens that end at least the
lookahead before the window's end are emitted, and reading goes on at the last emitted boundary. The state is one
window, however long the word is. Windows of many words run side by side as lanes of numpy arrays.

Why the bound holds. Take one prefix with two continuations and apply the rules in their order. Let d be the last
boundary up to which both runs agree. A rule (u, v) moves d only by joining u, which ends at d, with what follows,
and it moves d by the length of u. The next rule that moves it, (u', v'), comes later in the list, and v' begins
with u: u lies on the left spine of v'. The lookahead is the largest sum of lengths of u over such chains.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import regex

#: Bytes of chunks that an encoder remembers at most, and what an entry takes besides its characters and ids.
REMEMBER, ENTRY = 24_000_000, 220

_NONE = np.int64(1) << 30
_SLOTS = 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

# --- fixed values: the printable byte ranges of byte-level vocabularies, white space, and the published word patterns
PRINTABLE = [(33, 126), (161, 172), (174, 255)]
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed values

#: Characters that Python's split() takes for white space and the tokenizers' patterns do not.
_ONLY_PYTHON = regex.compile("[\x1c-\x1f]")


_LETTER, _NUMBER, _OTHER, _WHITE, _MARK = range(5)
_kind_table: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Letter, number, white space or other, for each code point of the basic plane."""
    if not _kind_table:
        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
        table = np.full(0x10000, _OTHER, dtype=np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, f"[{WHITE}]")):
            table[[ord(c) for c in regex.findall(pattern, points)]] = kind
        _kind_table.append(table)
    return _kind_table[0]


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = {b for low, high in PRINTABLE for b in range(low, high + 1)}
    names, spare = [], 256
    for b in range(256):
        names.append(chr(b if b in shown else spare))
        spare += b not in shown
    return names


def sufficient_lookahead(rules: list[tuple[int, int, int]], lengths: dict[int, int]) -> int:
    """Symbols behind a token boundary that settle it, for rules (left, right, result) in order."""
    made_by = {result: left for left, _, result in rules}
    reach: dict[int, int] = {}
    longest = 0
    for left, right, _ in reversed(rules):
        moved = lengths[left] + reach.get(left, 0)
        longest = max(longest, moved)
        spine: int | None = right
        while spine is not None:
            if reach.get(spine, 0) < moved:
                reach[spine] = moved
            spine = made_by.get(spine)
    return longest


class Bpe:
    """Tables of one tokenizer file (the text of its JSON). Words come from ``pieces``, ids from ``encode_words``."""

    def __init__(self, text: str, window: int | None = None, remember: int = REMEMBER):
        self.remember = remember
        spec = json.loads(text)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        symbols = byte_symbols()
        self.plain = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.ending = np.array([vocab[c + suffix] for c in symbols], dtype=np.int64)
        lengths = {i: max(1, len(t.removesuffix(suffix)) if suffix else len(t)) for t, i in vocab.items()}
        self.lookahead = sufficient_lookahead(rules, lengths)
        self.window = max(window or 0, 2 * self.lookahead, 64) if window is None else window
        if self.window <= self.lookahead:
            raise ValueError(f"a window needs more than {self.lookahead} symbols")
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.lengths = np.ones(size, dtype=np.int64)
        self.lengths[list(lengths)] = list(lengths.values())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            names[i] = token
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        to_byte = {c: b for b, c in enumerate(symbols)}
        self.token_bytes = [
            bytes(to_byte[c] for c in t) if self.byte_level and t not in self.special and all(c in to_byte for c in t) else t.encode() for t in names
        ]
        self.lower = spec.get("normalizer") is not None
        self._pattern = regex.compile(self._words_pattern(spec))
        self._chunks = regex.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self._fill([a for a, _, _ in rules], [b for _, b, _ in rules])
        self.result = np.array([c for _, _, c in rules] + [0], dtype=np.int64)
        self._known: dict[str, bytes] = {}
        self._held = 0

    @staticmethod
    def _words_pattern(spec: dict) -> str:
        steps = spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]]
        patterns = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        return patterns[0] if patterns else BYTE_LEVEL_WORDS

    # --- ranks of pairs: a hash table with open places

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def _fill(self, lefts: list[int], rights: list[int]) -> None:
        keys = (np.array(lefts, dtype=np.int64) << 20) | np.array(rights, dtype=np.int64)
        self._keys = np.full(1 << _SLOTS, -1, dtype=np.int64)
        self._ranks = np.full(1 << _SLOTS, _NONE, dtype=np.int64)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self._keys[place] < 0
            _, first = np.unique(place, return_index=True)
            wins = np.zeros(len(place), dtype=bool)
            wins[first] = True
            wins &= free
            self._keys[place[wins]], self._ranks[place[wins]] = keys[left[wins]], left[wins]
            left, place = left[~wins], (place[~wins] + 1) & ((1 << _SLOTS) - 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 20) | right
        place = self._place(keys)
        there = self._keys[place]
        ranks = np.where(there == keys, self._ranks[place], _NONE)
        rest = np.flatnonzero((there != keys) & (there >= 0))
        while len(rest):
            place[rest] = (place[rest] + 1) & ((1 << _SLOTS) - 1)
            there = self._keys[place[rest]]
            hit = there == keys[rest]
            ranks[rest[hit]] = self._ranks[place[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
        return ranks

    # --- merging

    def _merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every lane (``sizes`` symbols each, none empty) to its tokens: tokens lane by lane, and tokens per lane."""
        lanes = np.arange(len(sizes))
        starts = np.cumsum(sizes) - sizes
        sizes = sizes.copy()
        rank = np.full(len(symbols), _NONE, dtype=np.int64)
        if len(symbols) > 1:
            rank[:-1] = self._rank(symbols[:-1], symbols[1:])
        rank[starts + sizes - 1] = _NONE
        done_lanes, done_sizes, done_symbols = [], [], []
        while len(lanes):
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), starts)
            lowest, at = best >> 32, best & 0xFFFFFFFF
            live = lowest < _NONE
            if not live.all():
                stay = np.repeat(live, sizes)
                done_lanes.append(lanes[~live])
                done_sizes.append(sizes[~live])
                done_symbols.append(symbols[~stay])
                at = (at - (np.cumsum(np.where(live, 0, sizes)) - np.where(live, 0, sizes)))[live]
                symbols, rank, lowest, lanes, sizes = symbols[stay], rank[stay], lowest[live], lanes[live], sizes[live]
                starts = np.cumsum(sizes) - sizes
                if not len(lanes):
                    break
            symbols[at] = self.result[lowest]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, rank = symbols[keep], rank[keep]
            before = np.arange(len(lanes))
            at, starts, sizes = at - before, starts - before, sizes - 1
            after = at + 1 < starts + sizes
            rank[at] = _NONE
            rank[at[after]] = self._rank(symbols[at[after]], symbols[at[after] + 1])
            inner = at[at > starts]
            rank[inner - 1] = self._rank(symbols[inner - 1], symbols[inner])
        order = np.concatenate(done_lanes)
        counts = np.empty(len(order), dtype=np.int64)
        counts[order] = np.concatenate(done_sizes)
        place = np.repeat(order, np.concatenate(done_sizes))
        return np.concatenate(done_symbols)[np.argsort(place, kind="stable")], counts

    def encode_words(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (none empty; their bytes joined, and their sizes) one after the other, and ids per word."""
        if not len(sizes):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        symbols = self.plain[raw]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.ending[raw[ends - 1]]
        if sizes.max() <= self.window:
            return self._merge(symbols, sizes)
        at, word, found, owner = ends - sizes, np.arange(len(sizes)), [], []
        while len(word):
            take = np.minimum(self.window, ends[word] - at)
            lane = np.repeat(np.arange(len(word)), take)
            within = np.arange(len(lane)) - np.repeat(np.cumsum(take) - take, take)
            tokens, counts = self._merge(symbols[at[lane] + within], take)
            lane = np.repeat(np.arange(len(word)), counts)
            length = self.lengths[tokens]
            end = np.cumsum(length)
            end -= np.repeat(np.cumsum(take) - take, counts)  # within the window
            last = at + take == ends[word]
            stable = np.repeat(last, counts) | (end <= self.window - self.lookahead)
            found.append(tokens[stable])
            owner.append(word[lane[stable]])
            at = at + np.bincount(lane[stable], weights=length[stable], minlength=len(word)).astype(np.int64)
            at, word = at[~last], word[~last]
        owners = np.concatenate(owner)
        return np.concatenate(found)[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(sizes))

    # --- texts

    def _chunks_of(self, text: str) -> list[str]:
        """Parts of a text without special tokens that are encoded on their own: cut at white space."""
        if not self.lower:
            if "  " in text:
                return self._chunks.findall(text)
            head, *rest = text.split(" ")
            return [head, *map(" ".__add__, rest)]
        return regex.split(f"[{WHITE}]+", text) if _ONLY_PYTHON.search(text) else text.split()

    def _words_of(self, joined: str, mark: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of marked chunks, found by classes of code points: their bytes, sizes and chunks, and the chunks that need the pattern.

        Apostrophes begin words of their own, and the table of classes ends with the basic plane; such chunks are left out.
        """
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        kinds = _kinds()[np.minimum(points, 0xFFFF)]
        marks = points == ord(mark)
        kinds[marks] = _MARK
        chunk = np.cumsum(marks)
        odd = np.unique(chunk[(points == 0x27) | (points > 0xFFFF)])
        cut = np.ones(len(points), dtype=bool)
        if self.lower:
            cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBER)
        else:
            attached = (points[:-1] == 32) & (kinds[1:] < _WHITE)
            cut[1:] = (kinds[1:] != kinds[:-1]) & ~attached
            cut[1:-1] |= (kinds[1:-1] == _WHITE) & (kinds[:-2] == _WHITE) & (kinds[2:] < _WHITE)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        use = ~marks
        if len(odd):
            use &= ~np.isin(chunk, odd)
        raw = np.frombuffer(joined.encode(), dtype=np.uint8)
        starts = np.flatnonzero(cut)
        sizes = np.add.reduceat(width, starts) if len(starts) else starts
        if not use.all():
            raw = raw[np.repeat(use, width)]
        kept = use[starts]
        return raw, sizes[kept], chunk[starts[kept]], odd

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        mark, known = "\n" if self.lower else "\0", {}
        if not self.lower:  # a chunk may hold the mark itself
            for c in [c for c in chunks if "\0" in c]:
                words = [w.encode() for w in regex.findall(BYTE_LEVEL_WORDS, c)]
                known[c] = self.encode_words(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]))[0].astype("<u4").tobytes()
            chunks = [c for c in chunks if "\0" not in c] if known else chunks
        joined = mark.join(chunks)
        if self.lower:
            if not joined.isascii():
                joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")
            joined = joined.lower()
        raw, sizes, owner, odd = self._words_of(joined, mark)
        known.update(self._ids_of(chunks, raw, sizes, owner))
        if len(odd):
            parts = joined.split(mark)
            found = [[w.encode() for w in self._pattern.findall(parts[i])] for i in odd.tolist()]
            sizes = np.array([len(w) for words in found for w in words], dtype=np.int64)
            owner = np.repeat(np.arange(len(odd)), [len(words) for words in found])
            raw = np.frombuffer(b"".join(w for words in found for w in words), dtype=np.uint8)
            known.update(self._ids_of([chunks[i] for i in odd.tolist()], raw, sizes, owner))
        return known

    def _ids_of(self, chunks: list[str], raw: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> dict[str, bytes]:
        ids, per_word = self.encode_words(raw, sizes)
        joined = ids.astype("<u4").tobytes()
        ends = 4 * np.concatenate([[0], np.cumsum(np.bincount(owner, weights=per_word, minlength=len(chunks)).astype(np.int64))])
        ends = ends.tolist()
        return {c: joined[a:b] for c, a, b in zip(chunks, ends, ends[1:], strict=False)}

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text (None: none) as little-endian unsigned 32-bit integers.

        Chunks and their ids are kept from call to call as long as they take about ``remember`` bytes; beyond that, all are forgotten.
        """
        parts: list[list] = []
        needed: set[str] = set()
        for text in texts:
            pieces: list = []
            if text and self._special is not None and self._special.search(text):
                for piece in self._special.split(text):
                    if piece in self.special:
                        pieces.append(self.special[piece].to_bytes(4, "little"))
                    elif piece:
                        pieces.append(self._chunks_of(piece))
            elif text:
                pieces.append(self._chunks_of(text))
            for piece in pieces:
                if isinstance(piece, list):
                    needed.update(piece)
            parts.append(pieces)
        needed.discard("")
        new = needed.difference(self._known)
        if new and self._held + sum(map(len, new)) + 2 * ENTRY * len(new) > self.remember:
            self._known, self._held, new = {}, 0, needed
        if new:
            learned = self._learn(list(new))
            self._held += sum(ENTRY + len(c) + len(ids) for c, ids in learned.items())
            self._known.update(learned)
        self._known[""] = b""
        get = self._known.__getitem__
        for pieces in parts:
            yield b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in pieces)


class Encoder:
    """Ids of one text that arrives in blocks. What is held back is the part behind the last white space."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.held = bpe, ""

    def feed(self, block: str) -> np.ndarray:
        text = self.held + block
        cut = max((text.rfind(c) for c in WHITE), default=-1)
        # a space belongs to what follows it, and so may a run of them
        while cut > 0 and text[cut - 1] in WHITE:
            cut -= 1
        cut = max(cut, 0)
        self.held = text[cut:]
        return self._ids(text[:cut])

    def close(self) -> np.ndarray:
        text, self.held = self.held, ""
        return self._ids(text)

    def _ids(self, text: str) -> np.ndarray:
        return np.frombuffer(next(self.bpe.encode([text])), dtype="<u4")


class Decoder:
    """Text of ids that arrive in blocks.

    A byte-level vocabulary yields bytes; a code point is given out when its last byte has come, a broken one as U+FFFD,
    so the state is at most three bytes. A vocabulary without a decoder yields its tokens with a space between them.
    """

    def __init__(self, bpe: Bpe):
        self.bpe, self.held, self.begun = bpe, b"", False

    def feed(self, ids: Iterable[int]) -> str:
        parts = map(self.bpe.token_bytes.__getitem__, ids)
        if not self.bpe.byte_level:
            joined = b" ".join(parts)
            lead = b" " if self.begun and joined else b""
            self.begun = self.begun or bool(joined)
            return (lead + joined).decode()
        joined = self.held + b"".join(parts)
        cut = _whole(joined)
        self.held = joined[cut:]
        return joined[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held, self.begun = self.held, b"", False
        return rest.decode("utf-8", "replace")


def _whole(data: bytes) -> int:
    """Where an unfinished code point at the end of the bytes begins, or their length."""
    for back in range(1, min(3, len(data)) + 1):
        lead = data[-back]
        if lead >= 0xC0:
            need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return len(data) - back if need > back else len(data)
        if lead < 0x80:
            break
    return len(data)

"""Byte-level BPE as a streaming transducer with bounded lookahead, and back.

Encoding reads a text from left to right. What may follow can still change the
last tokens, but only so far back: a difference at the end of the known text
moves to the left from merge to merge, each one of a later rank than the one
before, and each by the length of the merge's left part. The longest such
chain of the merge list is its *sufficient lookahead* (``Merges.lookahead``).
Tokens that end farther than that before the end of the known text are
stable: they are emitted, and the rest of the window is all that is kept.

The splitter in front of the merges streams as well: it holds back what the
next characters may change (a contraction, the last blank of a run, a word
that goes on). Splits are short as a rule; the tokens of short ones are kept
in a bounded table, so that a split is merged when it is first met.

Decoding is an incremental state machine from bytes to characters: a character
may be spread over several tokens, and its open bytes are the only state.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 1 << 16           # characters of a text, and tokens, that are worked off at once
KEPT_SPLITS = 400_000     # splits of a generation; a worker keeps the tokens of two generations
KEPT_LETTERS = 48         # longer splits are not kept
SHORT = 48                # symbols up to which a plain scan finds the next merge faster than a heap

# Fixed values of the format: contractions that are split off, and the characters that are blanks.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Merges:
    """A merge list over byte symbols: ``parts[r]`` are the two symbols that rank ``r`` joins to symbol ``made[r]``."""

    def __init__(self, parts: list[tuple[int, int]], made: list[int], spelled: dict[int, bytes]):
        self.ranks = {pair: r for r, pair in enumerate(parts)}
        self.made = made
        self.spelled = spelled
        self.lookahead = self._sufficient_lookahead(parts)

    def _sufficient_lookahead(self, parts: list[tuple[int, int]]) -> int:
        """The longest chain of merges by which a difference can move to the left, in bytes.

        A merge (x, s) moves the left edge of a difference over x, if the symbol at the edge
        so far begins s (is s, or its left part, or that one's left part ...) and was reached
        by merges of earlier rank. One pass by rank; symbols must be made before they are used.
        """
        left: dict[int, int] = {}
        used_up = set()
        reach: dict[int, int] = {}
        longest = 0
        for (x, s), whole in zip(parts, self.made):
            if whole in left or whole in (x, s) or whole in used_up:
                raise ValueError(f"symbol {self.spelled.get(whole)!r} is made twice, or used before it is made")
            before, symbol = 0, s
            while symbol is not None:
                before = max(before, reach.get(symbol, 0))
                symbol = left.get(symbol)
            far = len(self.spelled[x]) + before
            reach[x] = max(reach.get(x, 0), far)
            longest = max(longest, far)
            left[whole] = x
            used_up |= {x, s}
        return longest

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges: lowest rank first, at equal rank from the left."""
        return (self._scan if len(symbols) <= SHORT else self._heap)(list(symbols))

    def _scan(self, symbols: list[int]) -> list[int]:
        rank_of, none = self.ranks.get, len(self.made)
        ranks = [rank_of(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            symbols[at:at + 2] = [self.made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((symbols[at - 1], symbols[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((symbols[at], symbols[at + 1]), none)
        return symbols

    def _heap(self, symbols: list[int]) -> list[int]:
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i in range(size - 1) if (r := self.ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if j >= size or symbols[i] < 0 or self.ranks.get((symbols[i], symbols[j])) != rank:
                continue  # one of the two has been joined to something else since
            symbols[i], symbols[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < size:
                    new = self.ranks.get((symbols[a], symbols[after[a]]))
                    if new is not None:
                        heapq.heappush(heap, (new, a))
        return [s for s in symbols if s >= 0]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class MergeStream:
    """Merges one split of any length in a window of bounded size."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.window: list[int] = []

    def feed(self, symbols: list[int]) -> list[int]:
        """Take symbols of single bytes; returns the tokens that nothing to come can change."""
        self.window += symbols
        if len(self.window) < 4 * self.merges.lookahead + 256:
            return []
        stable, end, limit = [], 0, len(self.window) - self.merges.lookahead
        for token in self.merges.merge(self.window):
            end += len(self.merges.spelled[token])
            if end > limit:
                break
            stable.append(token)
        del self.window[:sum(len(self.merges.spelled[t]) for t in stable)]
        return stable

    def finish(self) -> list[int]:
        """The tokens of what is left, at the end of the split."""
        rest, self.window = self.merges.merge(self.window), []
        return rest


class Vocabulary:
    """A byte-level BPE tokenizer file: merges, splitter, added strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] \
                or model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        letters = _byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        spelled = {i: bytes(byte_of[c] for c in word) for word, i in model["vocab"].items()}
        self.byte_ids = [model["vocab"][letter] for letter in letters]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = model["vocab"]
        self.merges = Merges([(ids[a], ids[b]) for a, b in pairs], [ids[a + b] for a, b in pairs], spelled)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that look at what is around them")
        self.added_strings = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.margin = max(map(len, self.added), default=1) - 1  # letters that may begin an added string
        self.bytes_of = spelled | {i: text.encode() for text, i in self.added.items()}
        self.splits, self.low_splits, self.runs, self.cut = _patterns()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def symbols(self, split: str) -> list[int]:
        return list(map(self.byte_ids.__getitem__, split.encode()))

    def compile(self, split: str) -> bytes:
        """The tokens of a split of bounded length, as little-endian 32-bit numbers."""
        packed = self.older.get(split) or _packed(self.merges.merge(self.symbols(split)))
        if len(split) <= KEPT_LETTERS:
            self.known[split] = packed
        return packed

    def plain(self, text: str) -> bytes:
        """Packed tokens of a whole stretch of bounded length without added strings."""
        if len(self.known) >= KEPT_SPLITS:
            self.older, self.known = self.known, {}
        known = self.known.get
        low = len(text.encode("utf-16-le")) == 2 * len(text)  # the short classes are searched faster
        splits = (self.low_splits if low else self.splits).findall(text)
        return b"".join([known(split) or self.compile(split) for split in splits])


class Encoder:
    """One text, chunk by chunk, to packed tokens. Keeps a bounded tail of the text and one merge window."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.held = ""                         # not yet searched for added strings
        self.tail = ""                         # not yet split
        self.run: re.Pattern | None = None     # what the open split goes on with, where it is very long
        self.stream = MergeStream(vocabulary.merges)

    def feed(self, chunk: str) -> Iterator[bytes]:
        yield from self._searched(self.held + chunk, self.v.margin)

    def finish(self) -> Iterator[bytes]:
        yield from self._searched(self.held, 0)
        yield from self._ended()

    def _searched(self, text: str, margin: int) -> Iterator[bytes]:
        start = 0
        for m in self.v.added_strings.finditer(text):
            yield from self._split(text[start:m.start()])
            yield from self._ended()
            yield _packed([self.v.added[m.group()]])
            start = m.end()
        stop = max(start, len(text) - margin)
        self.held = text[stop:]
        yield from self._split(text[start:stop])

    def _split(self, text: str) -> Iterator[bytes]:
        self.tail += text
        limit = max(CHUNK, 16)
        while len(self.tail) >= limit:
            if self.run:
                end = self.run.match(self.tail).end()
                over = end < len(self.tail)
                # the last blank of a run belongs to the word after it
                end -= 1 if not over or self.run is self.v.runs[-1] else 0
                yield from self._merged(self.tail[:end], over)
                self.tail = self.tail[end:]
                self.run = None if over else self.run
                if not over:
                    return
                continue
            cut = self.v.cut.match(self.tail)
            if cut:
                yield self.v.plain(self.tail[:cut.end()])
                self.tail = self.tail[cut.end():]
                continue
            # one block without blanks, or blanks only: splits that the next two letters cannot change
            done = 0
            for m in self.v.splits.finditer(self.tail):
                if m.end() > len(self.tail) - 2:
                    break
                yield from self._merged(m.group(), True)
                done = m.end()
            self.tail = self.tail[done:]
            if len(self.tail) >= limit // 2:  # a single split: follow it
                yield from self._merged(self.tail[:2], False)
                self.run = next(r for r in self.v.runs if r.match(self.tail, 2).end() >= len(self.tail) - 1)
                self.tail = self.tail[2:]

    def _merged(self, part: str, last: bool) -> Iterator[bytes]:
        for start in range(0, len(part), CHUNK):
            yield _packed(self.stream.feed(self.v.symbols(part[start:start + CHUNK])))
        if last:
            yield _packed(self.stream.finish())

    def _ended(self) -> Iterator[bytes]:
        """Tokens of what is left where a stretch of text ends."""
        tail, self.tail = self.tail, ""
        if self.run:
            end = self.run.match(tail).end()
            if end < len(tail) and self.run is self.v.runs[-1]:
                end -= 1
            yield from self._merged(tail[:end], True)
            tail, self.run = tail[end:], None
        yield self.v.plain(tail)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: itself where it is printable, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def _ranges(points: Iterable[int]) -> str:
    """The inside of a character class with these code points."""
    found: list[list[int]] = []
    for p in points:
        if found and found[-1][1] == p - 1:
            found[-1][1] = p
        else:
            found.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)


def _letter_classes() -> tuple[list[int], list[int]]:
    """The letters and the numbers of Unicode as the tokenizers library knows them.

    Python knows the class of assigned characters; of those that only later versions of
    Unicode have assigned, the library itself says whether it joins them with a letter or a digit.
    """
    import regex
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    later = {"L": regex.compile(r"\p{L}"), "N": regex.compile(r"\p{N}")}
    found: dict[str, list[int]] = {"L": [], "N": []}
    for p in range(0x110000):
        kind = unicodedata.category(chr(p))
        if kind[0] in found:
            found[kind[0]].append(p)
        elif kind == "Cn":
            for name, beside in (("L", "x"), ("N", "9")):
                if later[name].match(chr(p)) and len(split(beside + chr(p))) == 1:
                    found[name].append(p)
    return found["L"], found["N"]


def _splitter(letter: str, number: str) -> re.Pattern:
    blanks = f"[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
    kinds = (f"[{letter}]", f"[{number}]", f"[^{BLANKS}{letter}{number}]")
    return re.compile("|".join((*CONTRACTIONS, *(f" ?{k}+" for k in kinds), blanks)))


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern, tuple[re.Pattern, ...], re.Pattern]:
    """(splits, splits of texts without characters beyond 16 bits, what a split of each kind goes on with,
    the last end of a word before a blank)."""
    letters, numbers = _letter_classes()
    low = [_ranges(p for p in points if p < 1 << 16) for points in (letters, numbers)]
    letter, number = _ranges(letters), _ranges(numbers)
    runs = tuple(re.compile(f"{k}*") for k in (f"[{letter}]", f"[{number}]", f"[^{BLANKS}{letter}{number}]", f"[{BLANKS}]"))
    return _splitter(letter, number), _splitter(*low), runs, re.compile(f"(?s:.*)[^{BLANKS}](?=[{BLANKS}])")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process and file."""
    return Vocabulary(path)


def encode_text(v: Vocabulary, text: str | None) -> bytes:
    """The tokens of a whole text as little-endian 32-bit numbers; null and empty texts have none."""
    encoder, out = Encoder(v), []
    text = text or ""
    for start in range(0, len(text), CHUNK):
        out.extend(encoder.feed(text[start:start + CHUNK]))
    out.extend(encoder.finish())
    return b"".join(out)


def decode_tokens(v: Vocabulary, packed: bytes | None) -> str:
    """The text of packed tokens, token bytes fed to an incremental UTF-8 decoder: bytes that are no
    character become U+FFFD, and numbers that are no token are skipped. Null counts as no tokens."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    ids = np.frombuffer(packed or b"", "<u4")
    spelled = v.bytes_of.get
    out = [machine.decode(b"".join([spelled(i, b"") for i in ids[start:start + CHUNK].tolist()]))
           for start in range(0, len(ids), CHUNK)]
    return "".join(out) + machine.decode(b"", final=True)


def encode(path: str, text: str | Column) -> Column:
    """The tokens of a text as binary, four little-endian bytes each; no tokens for null and empty texts."""
    def run(texts: pa.Array) -> pa.Array:
        v = vocabulary(path)
        return pa.array([encode_text(v, t.as_py()) for t in texts], pa.binary())

    return F.arrow_udf(run, T.BinaryType())(text)


def decode(path: str, ids: str | Column) -> Column:
    """The text of packed tokens (see ``encode`` and ``decode_tokens``)."""
    def run(column: pa.Array) -> pa.Array:
        v = vocabulary(path)
        return pa.array([decode_tokens(v, ids.as_py()) for ids in column], pa.string())

    return F.arrow_udf(run, T.StringType())(ids)


def tokenize(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: ``ids``, the tokens of the whole text as the tokenizers library
    gives them without added special tokens (four little-endian bytes each; the strings of added tokens
    inside a text are those tokens, as is the library's default), and ``decoded``, the text that the tokens give back.

    Null and empty texts have no tokens and decode to the empty text. Every row stands for itself:
    repeated rows and ids stay, an empty table stays empty, and columns of ``docs`` named ``ids`` or
    ``decoded`` give way. No shuffle; a task holds one Arrow batch of texts and their tokens. The file at
    ``path`` must be readable on the executors.
    """
    rows = docs.select(*[c for c in docs.columns if c.lower() not in ("ids", "decoded")])
    return rows.withColumn("ids", encode(path, text_col)).withColumn("decoded", decode(path, "ids"))

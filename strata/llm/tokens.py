"""Token counts by a finite-state transducer over words.

Splits at which no vocabulary piece can reach across make the tokenizer a
transducer that returns to one state at every word's end: a word is a stretch
of blanks with the letters after it, and its number of tokens does not depend
on what stands around it. The transducer is compiled lazily: the transition
of a word gets its emitted-token count from the tokenizer library when the word is
first met, and is then reused.

Long texts are cut into chunks that are counted on their own. What a chunk
does to the state before it is a small map: the letters that end the word
open at its start, the tokens of the words closed inside it, and the word
left open at its end. Two maps compose into one (``compose``), and the
composition is associative, so chunks can be combined in any grouping.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, materialized, text_digest

CHUNK = 1 << 16          # characters counted as one chunk
MAX_WORDS = 500_000      # compiled transitions that a worker keeps; they can be compiled again
BLANK = "▁"         # what the tokenizer writes for a blank
_WORD = re.compile(r" *[^ \n]+| +|\n")

# A chunk's state map: (letters for the open word, tokens inside, word left open).
# Where no word ends inside the chunk, all of it is in the first part and the others are None.
StateMap = tuple[str, int | None, str | None]


class Transducer:
    """Word transitions of one SentencePiece model, compiled as they are met."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if re.search(f"[^{BLANK}]{BLANK}", piece) or ("\n" in piece and piece != "\n"):
                raise ValueError(f"{model_path}: piece {piece!r} reaches over a word's end")
        self.emitted: dict[str, int] = {}

    def compile(self, words: set[str]) -> None:
        """Add the transitions of ``words``; the line break before a word keeps the library's own
        blank away from it (two tokens for both)."""
        new = [w for w in words if w not in self.emitted]
        if len(self.emitted) + len(new) > MAX_WORDS:
            self.emitted.clear()
            new = list(words)
        encoded = self.model.encode(["\n" + w for w in new], num_threads=1)
        self.emitted.update(zip(new, (len(e) - 2 for e in encoded)))

    def count(self, words: list[str]) -> int:
        try:
            return sum(map(self.emitted.__getitem__, words))
        except KeyError:
            self.compile(set(words))
            return sum(map(self.emitted.__getitem__, words))

    def chunk(self, text: str, first: bool) -> StateMap:
        """The state map of a part of a text; the first part has the tokenizer's blank before it."""
        text = text.replace(BLANK, " ")
        words = _WORD.findall(" " + text if first else text)
        if len(words) < 2:
            return (text if not first else " " + text, None, None)
        return (words[0], self.count(words[1:-1]), words[-1])

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """The map of ``a`` followed by ``b``."""
        if a[1] is None and b[1] is None:
            words = _WORD.findall(a[0] + b[0])
            return (a[0] + b[0], None, None) if len(words) < 2 else (words[0], self.count(words[1:-1]), words[-1])
        if a[1] is None:
            words = _WORD.findall(a[0] + b[0])
            return (words[0], self.count(words[1:]) + b[1], b[2])
        words = _WORD.findall(a[2] + b[0])
        if b[1] is None:
            return (a[0], a[1] + self.count(words[:-1]), words[-1])
        return (a[0], a[1] + self.count(words) + b[1], b[2])

    def tokens(self, m: StateMap) -> int:
        """The tokens of a whole text from its map."""
        if m[1] is None:
            return self.count(_WORD.findall(m[0]))
        return self.count([m[0]]) + m[1] + self.count([m[2]])


@lru_cache(maxsize=4)
def transducer(model_path: str) -> Transducer:
    """One transducer per worker process and model."""
    return Transducer(model_path)


def _maps(model_path: str, text: Column, first: Column) -> Column:
    def run(texts: pa.Array, firsts: pa.Array) -> pa.Array:
        t = transducer(model_path)
        found = [t.chunk(x or "", f) for x, f in zip(texts.to_pylist(), firsts.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([m[0] for m in found], pa.string()), pa.array([m[1] for m in found], pa.int64()),
             pa.array([m[2] for m in found], pa.string())], ["head", "inside", "tail"])

    kind = T.StructType([T.StructField("head", T.StringType()), T.StructField("inside", T.LongType()),
                         T.StructField("tail", T.StringType())])
    return F.arrow_udf(run, kind)(text, first)


def _total(model_path: str, maps: Column) -> Column:
    def run(column: pa.Array) -> pa.Array:
        t = transducer(model_path)
        return pa.array([t.tokens(reduce(t.compose, [(m["head"], m["inside"], m["tail"]) for m in row]))
                         for row in column.to_pylist()], pa.int64())

    return F.arrow_udf(run, T.LongType())(maps)


def _whole(model_path: str, text: Column) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        t = transducer(model_path)
        return pa.array([t.tokens(t.chunk(x, True)) if x else 0 for x in texts.to_pylist()], pa.int64())

    return F.arrow_udf(run, T.LongType())(text)


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    ``n_tokens`` is what the tokenizer library gives without begin, end or added special tokens; strings
    of special tokens inside a text are ordinary letters. Null and empty texts have no bytes and no
    tokens. Texts beyond ``CHUNK`` characters are counted in chunks on several tasks, whose state maps
    are then composed. Columns of ``docs`` that are named like a result give way to it.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens")])
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("n_bytes", F.octet_length(text).cast("long"))
    short = rows.filter(F.length(text) <= CHUNK).withColumn("n_tokens", _whole(model_path, text))

    # a text's tokens depend on the text alone: copies of a text are counted once
    text_id, part, chunk, maps = (fresh(n, rows.columns) for n in ("text_id", "part", "chunk", "maps"))
    long = rows.filter(F.length(text) > CHUNK).withColumn(text_id, text_digest(text))
    cut = long.withColumn(part, F.explode(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / CHUNK).cast("int"))))
    cut = cut.select(text_id, part, F.substring(text, F.col(part) * CHUNK + 1, F.lit(CHUNK)).alias(chunk))
    spread = cut.dropDuplicates([text_id, part])
    mapped = spread.select(text_id, F.struct(F.col(part).alias("part"), _maps(
        model_path, F.col(chunk), F.col(part) == 0).alias("map")).alias("m"))
    total = mapped.groupBy(text_id).agg(F.transform(F.sort_array(F.collect_list("m")), lambda m: m["map"]).alias(maps))
    total = materialized(total.select(text_id, _total(model_path, F.col(maps)).alias("n_tokens")), "long_tokens")
    counted = long.join(total, text_id).select(*[F.col(c) for c in rows.columns], "n_tokens")
    return short.unionByName(counted)

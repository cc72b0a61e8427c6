"""Toxicity from a learned lexicon, matched with spelling errors, and its context.

The lexicon holds words and word beginnings (``stem*``) that the labels mark as
toxic. All its terms form one trie; the Levenshtein automata of the terms are run
on the trie at once, as a deterministic automaton whose states are sets of
(trie node, edits so far, letter still to come) and whose transitions are built when first needed.
An edit is a letter left out, put in or replaced, or two neighbours in turned order.
A word that the automaton accepts is a hit with its number of edits. A
misspelled hit weighs as much as the term, unless clean documents hold
words that near to it by chance: then only as much as these allow.

Each hit is looked at in its context window: inside quotation marks it
counts as quotation, otherwise as abuse. A logistic model over the hits of a
document, with quotation and abuse as separate inputs, gives the score.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import materialized, small_batches

TRAIN_PER_CLASS = 4000   # expected size of the labelled sample of each class
LEXICON = 2000           # terms kept at most, the strongest first
MIN_SUPPORT = 5          # toxic documents of the sample that hold a term
MIN_RATIO = 8.0          # how much more frequent a term is in toxic documents
STEMS = (4, 5, 6)        # lengths of word beginnings
EDIT_LENGTHS = (4, 8)    # words from the first length on may differ by one edit, from the second on by two
FEW = 12                 # different hits of a text up to which each is searched for by itself
CONTEXT = 60             # characters before and after a hit in which quotation is looked for
MAX_WORDS = 500_000      # words whose result a worker keeps
MAX_STATES = 300_000     # states of the automaton that a worker keeps; they can be built again
THRESHOLD = 0.3
HASH_RANGE = 1 << 40

_WORD = re.compile(r"[^\W_]+")
_OPEN, _CLOSE = "“«‹„", "”»›"
_NOTHING = (0.0, "", 0)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def edits_allowed(term: str) -> int:
    """How many edits a whole word may be away from a term."""
    return sum(len(term) >= n for n in EDIT_LENGTHS)


class Lexicon:
    """Weighted terms, and the automaton that finds them with as many edits as ``edits_allowed``.

    ``near``: (term, edits), or a term for any number of edits -> weight of a word that far away, where it differs from the term's.
    """

    def __init__(self, terms: dict[str, float], near: dict | None = None):
        self.weights, self.near = terms, near or {}
        self.words: dict[int, str] = {}      # node -> whole word
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, float] = {}     # node -> weight of a whole word
        self.stems: dict[int, float] = {}    # node -> weight of a word beginning
        self.room: list[int] = [0]           # node -> most edits that a word here or below allows
        for term, weight in terms.items():
            stem = term.endswith("*")
            node, path = 0, [0]
            for c in term.rstrip("*"):
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.room.append(0)
                path.append(node)
            if stem:
                self.stems[node] = weight
            else:
                self.ends[node] = weight
                self.words[node] = term
                for p in path:
                    self.room[p] = max(self.room[p], edits_allowed(term))
        self._clear()
        self.hits: dict[str, tuple[float, str, int]] = {}  # words looked up: those near a term, and the others
        self.clean: set[str] = set()

    def _clear(self) -> None:
        self.states: dict[bytes, int] = {}
        self.sets: list[bytes] = []                # state -> its places, packed
        self.stem_of: list[float] = []             # state -> weight of the stem that ends there
        self.moves: list[dict[str, int]] = []
        self.told: list[str | None] = []           # state -> the letters that its places tell apart
        self.others: dict[int, int] = {}           # state -> state after any other letter
        self.start = self._state({(0, ""): 0})

    def _state(self, places: dict[tuple[int, str], int]) -> int:
        """The state of these places and of those reached by leaving out letters of the term, each with its fewest edits."""
        new = list(places.items())
        while new:
            (n, due), e = new.pop()
            if not due and e <= places[n, due]:
                for k in self.children[n].values():
                    if e < self.room[k] and e + 1 < places.get((k, ""), 99):
                        places[k, ""] = e + 1
                        new.append(((k, ""), e + 1))
        key = array("q", sorted(n << 24 | e << 21 | ord(due or "\0") for (n, due), e in places.items())).tobytes()
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.stem_of.append(max((self.stems.get(n, 0.0) for (n, due), e in places.items() if not e and not due), default=0.0))
            self.moves.append({})
            self.told.append(None)
        return self.states[key]

    def _places(self, state: int) -> list[tuple[int, int, str]]:
        return [(p >> 24, p >> 21 & 7, chr(p & 0x1FFFFF) if p & 0x1FFFFF else "") for p in array("q", self.sets[state])]

    def _told(self, state: int) -> str:
        letters: set[str] = set()
        for n, e, due in self._places(state):
            if due:
                letters.add(due)
                continue
            letters.update(self.children[n])
            if e < self.room[n]:  # a letter that may come one too early
                for k in self.children[n].values():
                    letters.update(self.children[k])
        return "".join(letters)

    def _step(self, state: int, c: str) -> int:
        told = self.told[state]
        if told is None:
            told = self.told[state] = self._told(state)
        if c in told:
            after = self._after(state, c)
        else:
            if state not in self.others:
                self.others[state] = self._after(state, c)
            after = self.others[state]
        self.moves[state][c] = after
        return after

    def _after(self, state: int, c: str) -> int:
        places: dict[tuple[int, str], int] = {}

        def reach(n: int, due: str, e: int) -> None:
            if e <= self.room[n] or not e:
                places[n, due] = min(e, places.get((n, due), e))

        for n, e, due in self._places(state):
            if due:  # the second of two letters in turned order
                if due == c:
                    reach(n, "", e)
                continue
            below = self.children[n]
            if c in below:
                reach(below[c], "", e)
            if e < self.room[n]:
                reach(n, "", e + 1)
                for letter, k in below.items():
                    if letter != c:
                        reach(k, "", e + 1)
                        if c in self.children[k]:
                            reach(self.children[k][c], letter, e + 1)
        return self._state(places)

    def weight(self, term: str, edits: int) -> float:
        own = self.weights[term]
        return self.near.get((term, edits), self.near.get(term, own)) if edits else own

    def look_up(self, word: str) -> tuple[float, str, int]:
        """(weight, whole word, edits) of the best term for a word; weight 0 where there is none,
        and no whole word where it is a word beginning."""
        if word in self.clean:
            return _NOTHING
        if word in self.hits:
            return self.hits[word]
        if len(self.sets) > MAX_STATES:
            self._clear()
        if len(self.hits) + len(self.clean) >= MAX_WORDS:
            self.hits.clear()
            self.clean.clear()
        moves, sets, stem_of, state, stem = self.moves, self.sets, self.stem_of, self.start, 0.0
        for c in word:
            after = moves[state].get(c)
            state = self._step(state, c) if after is None else after
            if stem_of[state] > stem:
                stem = stem_of[state]
            if not sets[state]:
                break
        best = (stem, "", 0)
        for node, e, due in self._places(state):
            term = self.words.get(node)
            if term is not None and not due and e <= edits_allowed(term):
                best = max(best, (self.weight(term, e), term, e), key=lambda b: (b[0], -b[2], b[1]))
        if best == _NOTHING:
            self.clean.add(word)
        else:
            self.hits[word] = best
        return best

    def weights_in(self, found: set[str]) -> dict[str, float]:
        """The words of a set that weigh something, with their weights."""
        weights = {w: self.look_up(w)[0] for w in found - self.clean}
        return {w: weight for w, weight in weights.items() if weight > 0}


@lru_cache(maxsize=1)
def _compiled(terms: tuple, near: tuple) -> Lexicon:
    """One automaton per worker process: later tasks find its states and words already built."""
    return Lexicon(dict(terms), dict(near))


def _quoted(text: str, start: int, end: int) -> bool:
    """Whether a place stands inside quotation marks within its context window."""
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    before = before[before.rfind("\n") + 1:]
    after = after.split("\n", 1)[0]
    if before.count('"') % 2 and '"' in after:
        return True
    opened = max(before.rfind(c) for c in _OPEN)
    return opened > max(before.rfind(c) for c in _CLOSE) and any(c in after for c in _CLOSE)


def _places(text: str, some: Collection[str]) -> list[tuple[int, int]]:
    """Where a text has words of ``some``, in order. A few words are searched for one by one, more in one pass over all words."""
    if len(some) > FEW:
        return [m.span() for m in _WORD.finditer(text) if m.group() in some]
    found = []
    for word in some:
        start = text.find(word)
        while start >= 0:
            end = start + len(word)
            if not _WORD.match(text[end:end + 1]) and not (start and _WORD.match(text[start - 1])):
                found.append((start, end))
            start = text.find(word, start + 1)
    return sorted(found)


FEATURES = 6


def features(lexicon: Lexicon, text: str | None) -> list[float]:
    """What the score sees of a text: abuse (strongest, sum, different words), quotation (strongest, sum), density."""
    abuse, quotation, different = [], [], set()
    text = (text or "").lower()
    found = _WORD.findall(text)
    n, hits = len(found), lexicon.weights_in(set(found))
    marks = any(c in text for c in '"' + _OPEN)
    for start, end in _places(text, hits):
        word = text[start:end]
        if marks and _quoted(text, start, end):
            quotation.append(hits[word])
        else:
            abuse.append(hits[word])
            different.add(word)
    return [max(abuse, default=0.0), math.log1p(sum(abuse)), math.log1p(len(different)), max(quotation, default=0.0),
            math.log1p(sum(quotation)), math.log1p(100.0 * len(abuse) / max(1, n))]


@dataclass
class Model:
    """A lexicon and the weights of the logistic model (the last one is the constant)."""

    terms: dict[str, float] = field(default_factory=dict)
    near: dict[tuple[str, int], float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0] * (FEATURES + 1))

    def scores(self, lexicon: Lexicon, texts: list[str | None]) -> list[float]:
        x = np.array([features(lexicon, t) + [1.0] for t in texts]).reshape(-1, FEATURES + 1)
        return (1.0 / (1.0 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))).tolist()


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _terms(text: str | None) -> set[str]:
    found: set[str] = set()
    for w in set(words(text or "")):
        if len(w) >= 4 and not w.isdigit():
            found.add(w)
            found.update(w[:n] + "*" for n in STEMS if len(w) > n)
    return found


def _lexicon(sample: DataFrame, totals: dict[int, int]) -> dict[str, float]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            n: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                n[label].update(_terms(text))
            terms = sorted(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([n[1][t] for t in terms], pa.int64()),
                 pa.array([n[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"])

    seen = sample.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= MIN_SUPPORT)
    ratio = ((F.col("toxic") + 0.5) / (totals[1] + 1)) / ((F.col("clean") + 0.5) / (totals[0] + 1))
    strong = seen.withColumn("ratio", ratio).filter(F.col("ratio") >= MIN_RATIO)
    top = strong.orderBy(F.desc(F.col("toxic") * F.log("ratio")), "term").limit(LEXICON).collect()
    return {r.term: math.log(r.ratio) for r in top}


def _near_weights(sample: DataFrame, terms: dict[str, float], clean: int) -> dict[tuple[str, int], float]:
    """(term, edits) -> weight of a word that many edits away: the term's, or less where clean documents hold such words."""
    kind = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("edits", T.IntegerType())]))

    def misspelled(texts: pa.Array) -> pa.Array:
        lexicon = _compiled(tuple(terms.items()), ())
        found = [{(term, edits) for _, term, edits in map(lexicon.look_up, set(words(t or ""))) if edits} for t in texts.to_pylist()]
        return pa.array([[{"term": term, "edits": edits} for term, edits in sorted(f)] for f in found],
                        pa.list_(pa.struct([("term", pa.string()), ("edits", pa.int32())])))

    seen = sample.filter("toxic = 0").select(F.inline(F.arrow_udf(misspelled, kind)("text")))
    return {(r.term, r.edits): max(0.0, min(terms[r.term], math.log((clean + 1) / (r["count"] + 1)) - math.log(MIN_RATIO)))
            for r in seen.groupBy("term", "edits").count().collect()}  # a row per term and number of edits at most


def _fit(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> list[float]:
    """Ridge logistic regression by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (importance * p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (importance * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """A model from the labelled rows that are not held out.

    Learned from a sample of about ``TRAIN_PER_CLASS`` labelled documents of each class, chosen
    by a hash of the id and weighted back to the classes' sizes. Labels other than 0 and 1, and labels of null ids, are not
    used. Where a class has no rows, every score is the share of toxic rows (0.5 without any).
    """
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    marked = materialized(marked, "toxic_labels")
    sizes = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        share = 0.5 if not sizes else float(next(iter(sizes)))
        return Model(weights=[0.0] * FEATURES + [math.log((share + 0.01) / (1.01 - share))])
    place = F.pmod(F.xxhash64("id"), F.lit(HASH_RANGE))
    share = F.when(F.col("toxic") == 1, TRAIN_PER_CLASS * HASH_RANGE // sizes[1]).otherwise(
        TRAIN_PER_CLASS * HASH_RANGE // sizes[0])
    chosen = materialized(marked.filter(place < share), "toxic_sample")
    if chosen.count() <= 4 * TRAIN_PER_CLASS:  # ids and labels only; the usual case
        chosen = F.broadcast(chosen)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = materialized(texts.join(chosen, "id").select("toxic", "text"), "toxic_texts")
    totals = {0: 0, 1: 0} | {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not totals[0] or not totals[1]:
        return Model()
    terms = _lexicon(sample, totals)

    near = _near_weights(sample, terms, totals[0])

    def look(texts: pa.Array) -> pa.Array:
        lexicon = _compiled(tuple(terms.items()), tuple(near.items()))
        return pa.array([features(lexicon, t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    rated = sample.select("toxic", F.arrow_udf(look, T.ArrayType(T.DoubleType()))("text").alias("x"))
    # one row per distinct input of the model; the sample's size bounds them
    seen = rated.groupBy("toxic", "x").count().collect()
    x, y = np.array([r.x for r in seen]), np.array([float(r.toxic) for r in seen])
    back = {k: sizes[k] / totals[k] for k in (0, 1)}
    importance = np.array([r["count"] * back[r.toxic] for r in seen])
    importance *= sum(totals.values()) / importance.sum()
    return Model(terms, near, _fit(x, y, importance))


def score(model: Model, text: str | Column) -> Column:
    """The score of a whole text, 0 to 1; null and empty texts score as texts without hits."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = _compiled(tuple(model.terms.items()), tuple(model.near.items()))
        for texts in batches:
            yield pa.array(model.scores(lexicon, texts.to_pylist()), pa.float64())

    return F.arrow_udf(run, T.DoubleType())(text)


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         label_col: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``; ``predicted`` is 1 from
    ``THRESHOLD`` on. Labels are used for learning only, from rows that are not held out.
    An empty table gives an empty result; without labels every score is 0.5."""
    model = learn(docs, labels, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), score(model, text_col).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))

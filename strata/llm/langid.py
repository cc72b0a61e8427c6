"""Language identification by rank-order n-gram profiles.

A language's profile is its most frequent character n-grams (one to three
letters, word ends count as a blank), in order. A document is compared with
every profile by the out-of-place distance: the sum, over the document's own
most frequent n-grams, of how far each lies from its place in the profile,
with the profile's length for n-grams that the profile lacks.

N-grams are packed into one 64-bit number, 21 bits a code point, so that all
scripts are treated alike and numpy sorts and counts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, small_batches

UNDETERMINED = "und"
PROFILE = 300            # n-grams of a profile, and of a document
MAX_LANGUAGES = 8192     # profiles travel to every task: 300 numbers a language, 40 MB at most
BLOCK = 1 << 20          # symbols whose n-grams are counted at once
LEARN_BYTES = 1 << 20    # text whose n-grams are merged at once
FOREIGN = 0.9            # share of the texts of an unlearned language that should stay below the threshold
WRONG = 0.05             # share of labels that may be wrong without moving the threshold far
CALIBRATION_FOLD = 1     # labelled texts of this fold set the threshold; the profiles are not learned from them
RANKS = 10_000           # the threshold's quantiles are off by one part in so many of all ranks at most
PRIOR_ROWS = 10          # labelled texts that weigh as much as the lowest threshold that is given
BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _symbols(text: str) -> np.ndarray:
    """Lower-cased letters as code points; each stretch of other characters is one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    after_letter = np.concatenate(([False], letter[:-1]))
    kept = np.where(letter, points, BLANK)[letter | after_letter]
    ends = [BLANK] if kept[-1] != BLANK else []
    return np.concatenate(([BLANK], kept, np.array(ends, np.int64)))


def _count(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their counts, in blocks of bounded size."""
    s = _symbols(text)
    grams, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for start in range(0, len(s), BLOCK):
        a = s[start:start + BLOCK + 2]  # n-grams that begin in this block
        ones = a[:BLOCK]
        twos = (a[:-1] << 21 | a[1:])[:BLOCK]
        inner = a[1:-1] != BLANK        # no n-gram reaches over a word's end
        threes = (a[:-2] << 42 | a[1:-1] << 21 | a[2:])[inner][:BLOCK] if len(a) > 2 else a[:0]
        g, c = np.unique(np.concatenate((ones[ones != BLANK], twos, threes)), return_counts=True)
        if len(grams):
            g, back = np.unique(np.concatenate((grams, g)), return_inverse=True)
            c = np.bincount(back, weights=np.concatenate((counts, c))).astype(np.int64)
        grams, counts = g, c
    return grams, counts


def _ranked(text: str) -> np.ndarray:
    """The most frequent n-grams of a text, in order; ties go to the smaller number."""
    grams, counts = _count(text)
    return grams[np.argsort(-counts, kind="stable")[:PROFILE]]


def _labelled(rows: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, text) of the rows that have both."""
    rows = rows.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    return rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """Language -> its profile, from all rows of ``labelled`` with a language and a text.

    The counts are summed in Spark; only the profiles, ``PROFILE`` n-grams a language, come
    to the driver.
    """
    rows = _labelled(labelled, lang_col, text_col)
    languages = rows.select("lang").distinct().count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages; profiles of {MAX_LANGUAGES} at most are sent to the tasks")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", LEARN_BYTES):
            found: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.setdefault(lang, []).append(_count(text))
            for lang, parts in found.items():
                grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(grams))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"])

    total = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = total.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(grams, np.int64) for lang, grams in profiles.items()}


def _scorer(profiles: dict[str, np.ndarray]):
    """(names, a function from a text to its score in each of them, or None where it has no letter)."""
    names = sorted(profiles)
    known = np.unique(np.concatenate([profiles[n] for n in names])) if names else np.empty(0, np.int64)
    place = np.full((len(names), len(known)), -1, np.int64)
    for i, n in enumerate(names):
        place[i, np.searchsorted(known, profiles[n])] = np.arange(len(profiles[n]))

    def scores(text: str | None) -> np.ndarray | None:
        own = _ranked(text) if text else known[:0]
        if not len(own) or not names:
            return None
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        there = known[at] == own
        ranks = place[:, at[there]]
        apart = np.where(ranks >= 0, np.minimum(np.abs(ranks - np.flatnonzero(there)), PROFILE), PROFILE)
        distance = apart.sum(axis=1) + PROFILE * (len(own) - there.sum())
        return 1.0 - distance / (PROFILE * len(own))

    return names, scores


def _classifier(profiles: dict[str, np.ndarray]):
    names, scores = _scorer(profiles)

    def classify(text: str | None) -> tuple[str, float]:
        found = scores(text)
        if found is None:
            return UNDETERMINED, 0.0
        best = int(found.argmax())
        return names[best], float(found[best])

    return classify


def language(profiles: dict[str, np.ndarray], text: str | Column) -> Column:
    """struct(lang, score) of a whole text: the nearest profile (ties: the smaller name) and
    1 minus the out-of-place distance over its largest possible value.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    """
    def run(texts: pa.Array) -> pa.Array:
        classify = _classifier(profiles)
        found = [classify(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["lang", "score"])

    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return F.arrow_udf(run, kind)(text)


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang, score) of every row of ``docs``.

    Profiles are learned from rows that are not held out and have a language;
    language labels are not otherwise used. An empty table gives an empty result.
    """
    out = held_out(id_col)
    profiles = learn(docs.filter(~out), lang_col, text_col)
    found = docs.select(F.col(id_col).alias("id"), out.alias("held_out"), language(profiles, text_col).alias("found"))
    return found.select("id", "held_out", "found.lang", "found.score")


def threshold(labelled: DataFrame, profiles: dict[str, np.ndarray], floor: float, lang_col: str = "lang",
              text_col: str = "text") -> float:
    """The score from which a text counts as one of the languages of ``profiles``; ``floor`` at least.

    ``labelled`` should be rows that the profiles were not learned from. Each of their texts is
    scored twice: by all profiles, and by those of the other languages, as if its own had not
    been learned. The threshold lies a third of the way from the ``FOREIGN`` quantile of the second
    score, in the language where that is highest, to the ``WRONG`` quantile of the first among texts
    whose language is recognised, in the language where that is lowest: neither a wrongly labelled nor an
    unusual text decides it. ``n`` texts move it from ``floor`` by n / (n + ``PRIOR_ROWS``) of the way.
    """
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, scores = _scorer(profiles)
        for batch in small_batches(batches, "text"):
            langs, own, foreign = [], [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = scores(text)
                if found is None or lang not in profiles:
                    continue
                langs.append(lang)
                own.append(float(found.max()) if names[int(found.argmax())] == lang else None)
                others = [s for n, s in zip(names, found.tolist()) if n != lang]
                foreign.append(max(others, default=None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(own, pa.float64()), pa.array(foreign, pa.float64())],
                ["lang", "own", "foreign"])

    rows = _labelled(labelled, lang_col, text_col)
    rated = rows.mapInArrow(rate, "lang string, own double, foreign double").groupBy("lang").agg(
        F.count("own").alias("n"), F.percentile_approx("own", WRONG, RANKS).alias("own"),
        F.percentile_approx("foreign", FOREIGN, RANKS).alias("foreign"))
    seen = rated.agg(F.sum("n").alias("n"), F.min("own").alias("own"), F.max("foreign").alias("foreign")).first()
    if not seen.n:
        return floor
    foreign = min(seen.foreign or 0.0, seen.own)
    found = foreign + (seen.own - foreign) / 3
    return max(floor, floor + (found - floor) * seen.n / (seen.n + PRIOR_ROWS))


def keep_identified(docs: DataFrame, min_score: float, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns kept, whose text has a language with at least the score
    that ``threshold`` sets from the labelled rows, and at least ``min_score``.

    Labelled rows of one fold set the threshold, those of the others make the profiles; held-out rows do neither.
    Rows with null, empty or letterless texts go, and all rows go where nothing is labelled; a null id counts as empty text
    in the choice of the fold. Repeated rows and ids are judged one by one, of equal scores the language with
    the smaller name counts; an empty table stays empty. Columns may have any names.
    """
    labelled = docs.filter(~held_out(id_col))
    calibrates = held_out(id_col, fold=CALIBRATION_FOLD)
    profiles = learn(labelled.filter(~calibrates), lang_col, text_col)
    least = threshold(labelled.filter(calibrates), profiles, min_score, lang_col, text_col)
    found = fresh("found", docs.columns)
    marked = docs.withColumn(found, language(profiles, text_col))
    good = (F.col(found)["lang"] != UNDETERMINED) & (F.col(found)["score"] >= least)
    return marked.filter(good).select(*docs.columns)

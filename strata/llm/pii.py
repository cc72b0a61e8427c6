"""Personal data: exact base rules, and boosted trees over further candidates.

Base spans are regular expressions with checks (octets, Luhn, digit counts).
High-recall generators then propose overlapping spans that the base
expressions miss: obfuscated or unusually separated forms. Every candidate is
brought into plain form, and boosted trees score its format and context.
They learn from the base rules themselves: a candidate that is a base span is a
positive, one whose form fails the checks is a negative. The threshold is
calibrated on held-out candidates to a precision, and the selected spans that
overlap nothing better are added to the base spans.

Everything runs as DataFrame and SQL expressions and MLlib's DataFrame API.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bound, materialized

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98            # of selected candidates, on the held-out third of those that are known
TREES, DEPTH, SEED = 20, 4, 7
CONTEXT = 24                # characters on either side of a candidate

# The contract's expressions. Possessive quantifiers and the guards before the first
# character change no match; they keep the search linear on long texts.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT = r"(?:@| ?(?:\(at\)|\[at\]|\{at\}) ?)"
_DOT = r"(?:\.| ?(?:\(dot\)|\[dot\]|\[\.\]|\{dot\}) ?| dot )"
_SPELLED_DOT = r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot )"
_HOST = "[A-Za-z0-9-]{1,63}"
_GENERATORS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:{_AT}{_HOST}(?:{_DOT}{_HOST}){{1,5}}| at {_HOST}(?:{_SPELLED_DOT}{_HOST}){{1,5}})",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.| ?(?:\[\.\]|\(dot\)|\[dot\]) ?)[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z.+])(?:(?:\+|00)[0-9(](?:[ ()./-]{0,3}[0-9]){6,14}|(?:[0-9][ .-]?)?\([0-9]{2,5}\)(?:[ ./-]{0,2}[0-9]){5,10}"
             r"|(?:[0-9][ .-])?[0-9]{3}([ .-])[0-9]{3}\2[0-9]{4})(?![0-9A-Za-z])",
}
_FEATURES = ["kind", "digits", "letters", "length", "groups", "longest", "signs", "parentheses", "valid",
             "letter_before", "letter_after", "digits_around", "same_kind_around"]


def _may_hold(text: Column) -> Column:
    """Whether any expression can match: all need a digit, an @, or a spelled-out dot."""
    return text.rlike(r"[0-9@]| dot |\(dot\)|\[dot\]|\{dot\}")


_SPANS = "array<struct<kind:int,start:int,end:int,found:string,before:string,after:string>>"


def _matches(text: Column, pattern: str, kind: int, good: Callable[[Column], Column] | None = None) -> Column:
    """array of (kind, start, end, found, before, after) for the leftmost non-overlapping matches, code
    points; with ``good``, of those that pass it. ``before`` and ``after``: context up to the next match."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def scan(pairs: Column) -> Column:
        def step(state: Column, pair: Column) -> Column:
            begin = state["at"] + F.length(pair["between"])
            end = begin + F.length(pair["found"])
            span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["found"].alias("found"),
                            F.substring(pair["between"], -CONTEXT, CONTEXT).alias("before"),
                            F.substring(pair["next"], 1, CONTEXT).alias("after"))
            spans = F.concat(state["spans"], F.array(span))
            if good is not None:
                spans = F.when(good(pair["found"]), spans).otherwise(state["spans"])
            return F.struct(end.alias("at"), F.when(pair["found"].isNull(), state["spans"]).otherwise(spans).alias("spans"))

        return F.aggregate(pairs, start, step, lambda s: s["spans"])

    def paired(between: Column) -> Column:  # one part more than there are matches: the last one, without a match
        return F.arrays_zip(found.alias("found"), between.alias("between"), F.slice(between, 2, F.size(between)).alias("next"))

    return bound(bound(F.split(text, f"({pattern})", -1), paired), scan)


def _luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        doubled = F.when((n - i) % 2 == 1, digit * 2).otherwise(digit)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


def _small_octets(text: Column) -> Column:
    """Whether all dot-separated numbers are at most 255."""
    def small(part: Column) -> Column:
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) < 3) | ((F.length(value) == 3) & (value <= "255"))

    return F.forall(F.split(text, r"\."), small)


def _valid(kind: int | Column, plain: Column) -> Column:
    """The checks of a kind on a match in plain form."""
    digits = F.regexp_replace(plain, "[^0-9]", "")
    n = F.length(digits)
    checks = [F.lit(True), _small_octets(plain), n.between(12, 19) & _luhn(digits), n.between(9, 15)]
    if isinstance(kind, int):
        return checks[kind]
    chosen = F.when(kind == 0, checks[0])
    for i in (1, 2, 3):
        chosen = chosen.when(kind == i, checks[i])
    return chosen


def base_spans(text: Column) -> Column:
    """array of (kind, start, end, found, ...): matches of the base expressions that pass their checks."""
    none = F.array().cast(_SPANS)
    each = [_matches(text, _BASE[k], i, lambda m, i=i: _valid(i, m)) for i, k in enumerate(KINDS)]
    return F.when(_may_hold(text), F.concat(*each)).otherwise(none)


def candidates(text: Column) -> Column:
    """array of (kind, start, end, found, before, after): what the generators propose, with context."""
    found = F.concat(*[_matches(text, _GENERATORS[k], i) for i, k in enumerate(KINDS)])
    return F.when(_may_hold(text), found).otherwise(F.array().cast(_SPANS))


def _plain(kind: Column, found: Column) -> Column:
    """A candidate with spelled-out signs replaced and the separators of its kind taken out."""
    dotted = F.regexp_replace(found, _DOT, ".")
    return F.when(kind == 0, F.regexp_replace(dotted, f"{_AT}| at ", "@")).when(kind == 1, dotted).otherwise(found)


def _features(c: DataFrame) -> DataFrame:
    """``c`` (kind, found, before, after, ...) with the format and context features as doubles."""
    plain = _plain(F.col("kind"), F.col("found"))
    groups = F.filter(F.split("plain", "[^0-9A-Za-z]+"), lambda g: g != "")
    around = F.concat_ws(" ", "before", "after")
    f = c.withColumn("plain", plain).withColumn("groups_", groups)
    f = f.withColumns({
        "digits": F.length(F.regexp_replace("plain", "[^0-9]", "")),
        "letters": F.length(F.regexp_replace("plain", "[^A-Za-z]", "")),
        "length": F.length("plain"),
        "groups": F.size("groups_"),
        "longest": F.coalesce(F.array_max(F.transform("groups_", F.length)), F.lit(0)),
        "signs": F.length(F.regexp_replace("plain", "[0-9A-Za-z ]", "")),
        "parentheses": F.col("plain").contains("("),
        "valid": _valid(F.col("kind"), F.col("plain")),
        "letter_before": F.col("before").rlike("[0-9A-Za-z._%+-]$"),
        "letter_after": F.col("after").rlike("^[0-9A-Za-z_%@-]"),
        "digits_around": F.length(F.regexp_replace(around, "[^0-9]", "")),
        "same_kind_around": F.when(F.col("kind") == 0, around.contains("@")).otherwise(around.rlike("[0-9]{3}")),
    }).drop("groups_")
    return f.withColumns({name: F.col(name).cast("double") for name in _FEATURES if name != "kind"}).withColumn(
        "kind_", F.col("kind").cast("double"))


def _vectors(rated: DataFrame) -> DataFrame:
    columns = ["kind_", *[n for n in _FEATURES if n != "kind"]]
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep").transform(rated)


def _learn(c: DataFrame):
    """(model, threshold) from candidates with ``is_base``, or None where there are not both classes.

    A candidate is negative where it fails its checks; valid candidates
    that are not base spans, what the method may add, are not learned from. Every other candidate
    counts: those that no feature tells apart are one row, with their number as its weight. The
    threshold is the lowest score from which the held-out third has ``PRECISION``.
    """
    known = c.filter(F.col("is_base") | ~_valid(F.col("kind"), _plain(F.col("kind"), F.col("found"))))
    calibrates = F.pmod(F.xxhash64("found"), F.lit(3)) == 0
    each = _features(known.withColumn("label", F.col("is_base").cast("double")).withColumn("calibrates", calibrates))
    alike = ["label", "calibrates", "kind_", *[name for name in _FEATURES if name != "kind"]]
    rated = _vectors(materialized(each.groupBy(*alike).agg(F.count(F.lit(1)).cast("double").alias("weight")), "pii_known"))
    if rated.filter("not calibrates").select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(rated.filter("not calibrates"))
    scored = model.transform(rated.filter("calibrates")).select(
        F.floor(vector_to_array("probability")[1] * 100).alias("score"), "label", "weight")
    counts = scored.groupBy("score").agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("all"))
    good = total = 0.0
    threshold = 1.01
    for row in sorted(counts.collect(), key=lambda r: -r.score):  # 101 scores at most
        good, total = good + row.good, total + row["all"]
        if row.score >= 50 and good >= PRECISION * total:
            threshold = row.score / 100
    return model, threshold


def _apart(a: Column, b: Column) -> Column:
    return (a["end"] <= b["start"]) | (b["end"] <= a["start"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) of every row of ``docs``: arrays of (start, kind, end), in order.

    Positions are code points, ends exclusive; ``kind`` indexes ``KINDS``.
    ``added`` overlaps neither ``base`` nor itself. Null texts count as
    empty. Where the table lacks base spans or failing candidates, nothing
    can be learned and nothing is added.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialized(docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
        base_spans(text).alias("base"), candidates(text).alias("proposed")), "pii_spans")
    each = rows.filter(F.size("proposed") > 0).select("row", "base", F.explode("proposed").alias("c"))
    same = F.exists("base", lambda s: (s["kind"] == F.col("c.kind")) & (s["start"] == F.col("c.start")) & (s["end"] == F.col("c.end")))
    clear = F.forall("base", lambda s: _apart(s, F.col("c")))
    proposals = each.select("row", same.alias("is_base"), clear.alias("clear"), "c.*")
    learned = _learn(proposals)
    short = "transform(base, s -> struct(s.start as start, s.kind as kind, s.end as end))"
    base = rows.select("id", "row", F.array_sort(F.expr(short)).alias("base"))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if learned is None:
        return base.select("id", "base", nothing.alias("added"))
    model, threshold = learned
    scored = model.transform(_vectors(_features(proposals.filter("clear")))).withColumn("score", vector_to_array("probability")[1])
    best = scored.filter(F.col("score") >= threshold).groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("order"), "start", "kind", "end"))).alias("ranked"))
    chosen = F.aggregate("ranked", nothing, lambda kept, s: F.when(
        F.forall(kept, lambda k: _apart(k, s)),
        F.concat(kept, F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))).otherwise(kept))
    added = materialized(best.select("row", F.array_sort(chosen).alias("added")), "pii_added")
    return base.join(added, "row", "left").select("id", "base", F.coalesce("added", nothing).alias("added"))


def count_of(spans: Column, kind: int) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spelled(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined, by start and then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

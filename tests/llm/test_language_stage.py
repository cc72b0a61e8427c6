"""The language stage's threshold: text in no learned language goes, short real text stays."""

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import langid
from tests.conftest import SF_SMALL

ITALIAN = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Quanto a dir "
           "qual era e cosa dura questa selva selvaggia e aspra e forte, che nel pensier rinova la paura! Tanto amara che poco "
           "lo e la morte; ma per trattar del ben che vi trovai, diro delle altre cose che vi ho scorte.")
FINNISH = ("Mieleni minun tekevi, aivoni ajattelevi lahteani laulamahan, saa'ani sanelemahan, sukuvirtta suoltamahan, lajivirtta "
           "laulamahan. Sanat suussani sulavat, puhe'et putoelevat, kielelleni kerkiavat, hampahilleni hajoovat.")


def test_gibberish_and_unlearned_languages_go(spark):
    rnd = random.Random(2)
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    n = docs.count()
    letters = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(600)) for _ in range(5)]
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(600)) for _ in range(5)]
    gone = letters + hexes + [ITALIAN, FINNISH]
    stay = [r.text[:60] for r in docs.filter("length(text) > 200").orderBy("doc_id").limit(20).collect()]
    stay += ["The people in the house were there for the whole of the day."]
    odd = [(-1 - i, t, None) for i, t in enumerate(gone)] + [(10**9 + i, t, None) for i, t in enumerate(stay)]
    mixed = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, mixed, SF_SMALL)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert [gone[-1 - i][:20] for i in ids if i < 0] == []
    assert [t for i, t in enumerate(stay) if 10**9 + i not in ids] == []
    assert len([i for i in ids if 0 <= i < 10**9]) == n


def _stage_keeps(spark, odd, n_bad):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    mixed = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language_id"](spark, mixed, SF_SMALL).select("doc_id").collect()}
    return len([i for i in kept if i < 0]), len([i for i in kept if 0 <= i < 10**9]), docs.count()


def test_wrong_labels_do_not_open_the_stage(spark):
    """3 % of the labelled texts are random letters under a real language: they and unlabelled ones still go."""
    rnd = random.Random(5)

    def letters():
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(500))

    odd = [(-1 - i, letters(), rnd.choice(["en", "fr", "de", "es"]) if i < 30 else None) for i in range(80)]
    bad, clean, n = _stage_keeps(spark, odd, 80)
    assert bad == 0 and clean == n


def test_few_labels_leave_the_lowest_threshold(spark):
    profiles = langid.learn(spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de")],
                                                  "doc_id long, text string, lang string"))
    none = spark.createDataFrame([(1, None, "en"), (2, "text", None)], "doc_id long, text string, lang string")
    assert langid.threshold(none, profiles, 0.1) == 0.1
    one = spark.createDataFrame([(1, "the cat and the dog", "en")], "doc_id long, text string, lang string")
    assert 0.1 <= langid.threshold(one, profiles, 0.1) < 0.2


def test_profiles_are_learned_from_every_row(spark):
    """20,090 rows of one language, a letter each; the counts of the letters differ by two to the next."""
    letter = F.explode(F.sequence(F.lit(0), F.lit(9)))
    rows = spark.range(1).select(letter.alias("i")).select("i", F.explode(F.expr("sequence(1, 2000 + 2 * i)")).alias("doc_id"))
    rows = rows.select("doc_id", F.expr("substring('abcdefghij', i + 1, 1)").alias("text"), F.lit("xx").alias("lang"))
    profile = langid.learn(rows)["xx"]
    assert "".join(chr(g) for g in profile if g < 1 << 21) == "jihgfedcba"


def test_threshold_is_set_by_every_row(spark):
    """12,000 rows of each of two languages against the quantiles of all of them in plain Python."""
    texts = {"en": "the cat and the dog are in the house with a mouse", "de": "der Hund und die Katze sind in dem Haus mit einer Maus"}
    profiles = langid.learn(spark.createDataFrame([(1, t, n) for n, t in texts.items()], "doc_id long, text string, lang string"))
    kinds = [(n, " ".join(t.split()[i:i + k])) for n, t in texts.items() for k in (3, 5) for i in range(6)]
    table = spark.createDataFrame([(n, t, i) for i, (n, t) in enumerate(kinds)], "lang string, text string, kind int")
    rows = table.select("lang", "text", F.explode(F.expr("sequence(1, 1000)")).alias("i"), "kind")
    rows = rows.select((F.col("i") * 100 + F.col("kind")).alias("doc_id"), "text", "lang")
    names, scores = langid._scorer(profiles)
    own, foreign, n = {}, {}, 0
    for name, text in kinds:
        s = dict(zip(names, scores(text).tolist()))
        foreign.setdefault(name, []).append(max(v for k, v in s.items() if k != name))
        if max(s, key=s.get) == name:
            own.setdefault(name, []).append(s[name])
            n += 1000

    def quantile(values, share):
        return sorted(values)[math.ceil(share * len(values)) - 1]

    low = min(quantile(v, langid.WRONG) for v in own.values())
    high = min(low, max(quantile(v, langid.FOREIGN) for v in foreign.values()))
    found = high + (low - high) / 3
    expected = 0.1 + (found - 0.1) * n / (n + langid.PRIOR_ROWS)
    assert found > 0.15 and langid.threshold(rows, profiles, 0.1) == pytest.approx(expected, abs=1e-9)

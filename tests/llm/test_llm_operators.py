"""Each operator against its plain version, on benchmark tables and on odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import decontam, langid, lines, mixing, pii, sharding, simhash, tokens, topk, toxicity
from tests.conftest import SF_SMALL
from tests.llm import brute

MODEL = "piece_bpe_32k.model"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def pairs(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


# 5 -------------------------------------------------------------------------

def test_simhash_query_matches_all_pairs(result, pairs):
    assert Counter(map(tuple, result("op5_simhash").rows)) == Counter(brute.near_duplicates(pairs))


def test_simhash_on_odd_rows(odd_docs, odd_rows, no_docs):
    found = simhash.near_duplicates(odd_docs).select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert rows_of(found) == Counter(brute.near_duplicates(odd_rows))
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_keep_one_keeps_one_row_of_each_group(odd_docs, odd_rows):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == brute.kept_ids(odd_rows)


def test_links_connect_exactly_the_near_fingerprints(spark):
    """Random fingerprints with clusters, chains and all popcount extremes."""
    import random

    rnd = random.Random(5)
    values = {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    for _ in range(30):
        x = rnd.getrandbits(64)
        for _ in range(6):
            values.add(x)
            x ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
    values |= {rnd.getrandbits(64) for _ in range(200)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash._components(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    label = {r.fp & (1 << 64) - 1: r.label for r in found}
    near = defaultdict(list)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 2:
                near[a].append(b)
    for a in values:
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        assert {b for b in values if label[b] == label[a]} == seen


# 6 -------------------------------------------------------------------------

def test_line_dedup_query(result, pairs):
    assert Counter(map(tuple, result("op6_line_dedup").rows)) == Counter(brute.dedup_lines(pairs))


@pytest.mark.parametrize("batches", [1, 9])
def test_line_dedup_on_odd_rows(odd_docs, odd_rows, no_docs, batches):
    found = lines.dedup_lines(odd_docs, batches=batches).select("id", "n_lines", "n_dropped", F.sha2("kept", 256))
    assert rows_of(found) == Counter(brute.dedup_lines(odd_rows))
    assert lines.dedup_lines(no_docs, batches=batches).count() == 0


def test_line_runs_stay_logarithmic_and_anti_join(spark):
    runs = lines.LineRuns(spark)
    for i in range(9):
        runs.add(spark.createDataFrame([(i, 1, 1), (i, i, 2)], "id long, a long, b long"))
    assert [len(level) for level in runs.levels] == [1, 2]
    everything = {(r.a, r.b): (r.n_docs, r.top_id) for r in runs.entries().collect()}
    assert everything[(1, 1)] == (9, 8) and everything[(5, 2)] == (1, 5)
    batch = spark.createDataFrame([(20, 1, 1), (20, 77, 2)], "id long, a long, b long")
    assert [r.a for r in runs.unseen(batch).collect()] == [77]


# 7 -------------------------------------------------------------------------

def test_decontamination_query(spark, result, pairs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute.contamination(pairs, items)
    assert any(r[-1] for r in expected)
    assert Counter(map(tuple, result("op7_decontamination").rows)) == Counter(expected)


@pytest.mark.parametrize("vocabulary_bytes", [decontam.VOCABULARY_BYTES, 40])
def test_decontamination_on_odd_rows(odd_docs, odd_rows, no_docs, few_items, monkeypatch, vocabulary_bytes):
    monkeypatch.setattr(decontam, "VOCABULARY_BYTES", vocabulary_bytes)  # 40: in blocks
    items = [tuple(r) for r in few_items.collect()]
    found = decontam.contamination(odd_docs, few_items).select(
        "id", "n_words", "n_hit", F.size("item_ids"), F.sha2(F.array_join("item_ids", ","), 256), "contaminated")
    assert rows_of(found) == Counter(brute.contamination(odd_rows, items))
    assert decontam.contamination(no_docs, few_items).count() == 0
    nothing = decontam.contamination(odd_docs, few_items.limit(0))
    assert nothing.filter("contaminated or n_hit > 0").count() == 0 and nothing.count() == len(odd_rows)


def test_drop_contaminated_keeps_clean_rows_whole(odd_docs, odd_rows, few_items):
    clean = [r[0] for r in brute.contamination(odd_rows, [tuple(r) for r in few_items.collect()]) if not r[-1]]
    kept = decontam.drop_contaminated(odd_docs, few_items)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(clean)


def test_proximity(spark):
    docs = spark.createDataFrame([(0, "red green blue red"), (1, "green blue red blue")], "row long, text string")
    items = spark.createDataFrame([(1, "red blue")], "item_id long, text string")
    block = decontam._items(items, "item_id", "text")
    index = decontam.build_index(docs, "row", "text", {1: [b"red", b"blue"]})
    found = decontam.proximity_hits(index, block, slop=1)
    assert {(r.row, r.position, r.other_position) for r in found.collect()} == {(0, 2, 0), (1, 3, 2)}


# 3 -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def piece_model():
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _library_counts(path, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [len(e) for e in model.encode([t or "" for t in texts])]


def test_token_query_equals_the_library(result, pairs, piece_model):
    counts = _library_counts(piece_model, [t for _, t in pairs])
    expected = Counter((i, len(t.encode()), n, n > 4096) for (i, t), n in zip(pairs, counts))
    assert Counter(map(tuple, result("op3_token_counts").rows)) == expected


@pytest.mark.parametrize("chunk", [tokens.CHUNK, 100])
def test_tokens_on_odd_rows(odd_docs, odd_rows, no_docs, piece_model, monkeypatch, chunk):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    counts = _library_counts(piece_model, [t for _, t in odd_rows])
    expected = Counter((i, len((t or "").encode()), n) for (i, t), n in zip(odd_rows, counts))
    counted = tokens.count_tokens(odd_docs, piece_model)
    assert rows_of(counted.select("doc_id", "n_bytes", "n_tokens")) == expected
    assert tokens.count_tokens(no_docs, piece_model).count() == 0


def test_state_maps_compose_at_any_cut(piece_model):
    import random
    from functools import reduce

    rnd = random.Random(3)
    t = tokens.Transducer(piece_model)
    letters = ["a", "th", " ", "  ", "\n", "▁", "é", "中", "the", "<s>", "\t", "\r", "\x00", "😀", "ing", "  \n", " {\r"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    for text, n in zip(texts, _library_counts(piece_model, texts)):
        cuts = sorted(rnd.sample(range(1, len(text)), min(len(text) - 1, rnd.randint(0, 4)))) if len(text) > 1 else []
        maps = [t.chunk(text[i:j], i == 0) for i, j in zip([0, *cuts], [*cuts, len(text)])]
        left = reduce(t.compose, maps)
        right = reduce(lambda b, a: t.compose(a, b), maps[::-1])
        assert t.tokens(left) == t.tokens(right) == n, text


# 9 -------------------------------------------------------------------------

def test_top_k_query(spark, result):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = Counter(brute.top_k(rows, 5, lambda q: q % 50 == 0))
    assert Counter(map(tuple, result("op9_top_k").rows)) == expected


@pytest.mark.parametrize("block", [topk.VECTORS, 5])
def test_top_k_on_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "VECTORS", block)
    monkeypatch.setattr(topk, "QUERIES", block)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 0.0]), (50, [0.5, -0.25]), (100, None), (150, [nan, 1.0]), (200, [1.0, None]), (250, [inf, 0.0]),
            (None, [1.0, 1.0]), (300, []), (7, [0.5, -0.25]), (7, [0.5, -0.25]), (9, [1e9, -1e9]), (11, [0.3])]
    rows += [(i, [0.5, 0.5]) for i in range(1000, 1030)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("h", F.lit(2))
    expected = Counter(brute.top_k(rows, 5, lambda q: q % 50 == 0))
    assert rows_of(topk.top_k(table, F.col("vec_id") % 50 == 0, 5)) == expected
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_threshold_stops_early():
    import numpy as np

    vectors = np.zeros((1000, 2), np.float64)
    vectors[:, 0] = np.arange(1000)
    lists = topk.Lists(np.arange(1000), vectors)
    scored = []
    lists.vectors = type("Seen", (), {"__getitem__": lambda _, at: scored.append(len(at)) or vectors[at],
                                      "__matmul__": lambda _, q: scored.append(1000) or vectors @ q})()
    assert lists.search(-1, np.array([1.0, 0.0]), 5)[0].tolist() == [999, 998, 997, 996, 995]
    assert sum(scored) < 100


# 4 -------------------------------------------------------------------------

def _check_shards(rows, texts, count):
    """rows: (id, size, crc, shard, slot); texts: [(id, text)]"""
    assert Counter((r[0], r[1], r[2]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, brute.crc(t)) for i, t in texts)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r[3]].append(r[4])
    assert set(by_shard) <= set(range(count))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    shard_of = defaultdict(set)
    for r in rows:
        shard_of[(r[1], r[2])].add(r[3])
    assert all(len(s) == 1 for s in shard_of.values())


def test_sharding_query(result, pairs):
    rows = result("op4_sharding").rows
    _check_shards([(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows], pairs, 24)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    groups = Counter()
    for i, t in pairs:
        groups[t] += len(t.encode()) + 8
    assert len(loads) == 24 and max(loads.values()) <= sum(loads.values()) / 24 + max(groups.values())


def test_sharding_on_odd_rows(odd_docs, odd_rows, no_docs):
    _check_shards([tuple(r) for r in sharding.shards(odd_docs, 3).collect()], odd_rows, 3)
    assert sharding.shards(no_docs, 3).count() == 0


def test_lpt_takes_the_largest_first():
    sizes = [(("a",), 7), (("b",), 7), (("c",), 6), (("d",), 5), (("e",), 4), (("f",), 1)]
    assert sharding.schedule(sizes, 2) == {("a",): 0, ("b",): 1, ("c",): 0, ("d",): 1, ("e",): 1, ("f",): 0}


# 1 -------------------------------------------------------------------------

def test_mixing_query_uses_every_document_and_keeps_its_shares(result, docs):
    rows = result("op1_mixing").rows
    ids = Counter(r.doc_id for r in rows if r.epoch == 0)
    assert ids == Counter(r.doc_id for r in docs.select("doc_id").collect())
    blocks = defaultdict(set)
    for r in rows:
        blocks[r.slot].add((r.source, r.block, r.epoch))
        assert r.release <= r.slot < r.deadline
    assert all(len(b) == 1 for b in blocks.values())
    assert sorted(blocks) == list(range(len(blocks)))


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1000, "b": 1, "c": 1, "d": 1},
                                     {f"s{i}": 1 + i for i in range(23)}])
def test_pfair_schedule_is_less_than_a_block_off(spark, weights):
    sizes = spark.createDataFrame([("=" + k, 10) for k in weights], "source string, n long")
    period = 200
    parts = mixing._parts(mixing._targets(sizes, weights), period)
    found = mixing.schedule(parts, period).collect()
    assert sorted(s for r in found for s in r.slots) == list(range(period))
    assert sum(r.parts for r in found) == period
    share = {r.source: r.parts for r in found}
    assert brute.worst_deviation({r.source: r.slots for r in found}, share, period) < 1


def test_mixing_until_first_repeats_nothing(spark):
    rows = [(i, "a" if i < 300 else "b") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    mixed = mixing.mix(table, {"a": 0.5, "b": 0.5}, block=10, until="first").collect()
    assert len({r.doc_id for r in mixed}) == len(mixed)
    n = Counter(r.source for r in mixed)
    assert abs(n["a"] - n["b"]) <= 10 and n["b"] >= 90


def test_mixing_on_odd_rows(odd_docs, odd_rows, no_docs):
    mixed = mixing.mix(odd_docs, block=2).collect()
    assert Counter((r.doc_id, r.text) for r in mixed if r.epoch == 0) == Counter(odd_rows)
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs, {}, block=2).count() >= len(odd_rows)


# 2 -------------------------------------------------------------------------

def test_pii_base_spans(result, pairs):
    kinds = [k for k, _, _ in brute.PII]
    for r in result("op2_pii").rows:
        text = dict(pairs)[r.doc_id]
        spans = brute.personal_data(text)
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert r.base_sha256 == brute.sha(brute.spelled(spans))
        assert r.spans == brute.spelled(spans)  # these tables hold no unusual forms


def test_pii_on_odd_rows(odd_docs, odd_rows, no_docs):
    found = [(r.id, tuple((s.start, s.kind, s.end) for s in r.base)) for r in pii.find(odd_docs).collect()]
    assert Counter(found) == Counter((i, tuple(brute.personal_data(t))) for i, t in odd_rows)
    assert sum(len(b) for _, b in found) > 5
    assert pii.find(no_docs).count() == 0


def test_pii_base_spans_on_random_text(spark):
    import random

    rnd = random.Random(11)
    letters = ["1", "25", "300", ".", " ", "-", "+", "@", "a", "b.c", "_", "(", ")", "%", "é", "😀", "4111111111111111", "\n", "1.2.3.4", "x@y.z"]
    rows = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60)))) for i in range(3000)]
    table = spark.createDataFrame(rows, "i long, text string")
    found = table.select("i", F.transform(pii.base_spans(F.col("text")), lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("s"))
    for r in found.collect():
        assert sorted(map(tuple, r.s)) == brute.personal_data(rows[r.i][1]), rows[r.i][1]


def test_pii_adds_unusual_forms_and_leaves_plain_text(spark):
    import random

    rnd = random.Random(2)

    def card(start):
        digits = start + "".join(rnd.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if brute._luhn(digits + c))

    rows = []
    for i in range(400):
        body = ["some words before it", rnd.choice(["a.b", "joe", "kim_9"]) + f"{i}@mail{i % 9}.example.com", "and",
                f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}", "then", card("4"), "or", card("4")[:-1] + "x",
                f"{rnd.randint(1, 255)}.{rnd.randint(0, 255)}.{rnd.randint(0, 255)}.7", "and", f"{rnd.randint(256, 999)}.1.2.300", "end",
                str(rnd.randint(10**15, 10**16))]
        rows.append((i, " ".join(body)))
    rows.append((1000, "write to joe.doe (at) mail3 (dot) example (dot) com today"))
    rows.append((1002, "call 988-555-2485 or (988) 555 2486 or 0049 30 1234567 now"))
    rows.append((1001, "nothing to see in 2024, chapter 3.1, 12 of 100 pages; look at it. Then go at noon. At 1. 2. 3. 4 no. 123456789"))
    found = {r.id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.end) for s in found[1002].added] == [(5, 17), (21, 35), (39, 54)]
    assert found[1000].added and not found[1001].added and not found[1001].base


def test_pii_learns_from_every_candidate(spark):
    """50,000 candidates, of which some 100 are base spans; a part of the candidates chosen by this hash has none of them."""
    late = F.pmod(F.xxhash64("id", F.lit(0), F.lit(0)), F.lit(1 << 30)) >= 1 << 29
    mail = F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@mail.example.com"))
    text = F.when(F.col("id") == 7, "joe.doe (at) mail3 (dot) example (dot) com").when(late & (F.col("id") % 256 == 0), mail)
    rows = spark.range(0, 50_000, 1, 1).select("id", text.otherwise(F.concat(F.lit("300.1.1."), (F.col("id") % 256).cast("string"))).alias("text"))
    found = pii.find(rows, "id")
    assert [(r.id, [(s.start, s.kind, s.end) for s in r.added]) for r in found.filter(F.size("added") > 0).collect()] == [(7, [(0, 0, 42)])]


# 10 ------------------------------------------------------------------------

def test_language_accuracy_on_held_out(result, docs):
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = result("op10_language_id").rows
    assert Counter(r.doc_id for r in rows) == Counter(lang.keys())
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in held} == {i for i in lang if brute.crc(str(i)) % 5 == 0}


def test_language_on_odd_rows(odd_docs, odd_rows, no_docs):
    found = langid.identify(odd_docs).collect()
    assert Counter(r.id for r in found) == Counter(i for i, _ in odd_rows)
    unknown = {i for i, t in odd_rows if not any(c.isalpha() for c in t or "")}
    assert {r.id for r in found if r.lang == "und"} == unknown
    assert langid.identify(no_docs).count() == 0
    assert langid.keep_identified(odd_docs, 0.0).columns == odd_docs.columns


def test_ngrams_are_counted_across_blocks(monkeypatch):
    text = "Größe und 中文 l'été, déjà-vu ὀδός! " * 40
    whole = langid._count(text)
    expected = Counter()
    import re

    for w in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {w} "
        expected.update(w)
        expected.update(padded[i:i + 2] for i in range(len(padded) - 1))
        expected.update(padded[i:i + 3] for i in range(len(padded) - 2))

    def spell(n):
        return "".join(chr(n >> s & 0x1FFFFF) for s in (42, 21, 0) if n >> s)

    assert {spell(int(g)): int(n) for g, n in zip(*whole)} == expected
    monkeypatch.setattr(langid, "BLOCK", 7)
    parts = langid._count(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


# 8 -------------------------------------------------------------------------

def test_toxicity_on_held_out(spark, result):
    sf = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = result("op8_toxicity", sf).rows
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    good = [r.score for r in held if toxic[r.doc_id]]
    rest = [r.score for r in held if not toxic[r.doc_id]]
    auc = sum((a > b) + (a == b) / 2 for a in good for b in rest) / (len(good) * len(rest))
    assert auc >= 0.8
    assert sum(s >= 0.3 for s in rest) <= 0.02 * len(rest)


def test_toxicity_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(0, 1), (10, None), (None, 1), (20, 7), (30, 0), (30, 1)], "doc_id long, toxic int")
    assert toxicity.rate(odd_docs, labels).count() == len(odd_rows)
    assert toxicity.rate(odd_docs, labels.limit(0)).select("score").distinct().collect()[0].score == 0.5
    assert toxicity.rate(no_docs, labels).count() == 0


def _edits(a, b):
    """Letters left out, put in, replaced, or two neighbours turned (and not edited further)."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and y == a[i - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_accepts_edits():
    import random

    terms = {"idiot": 3.0, "moron": 2.0, "scum": 1.5, "idea": 0.5, "vequ*": 4.0, "morons": 1.0, "numbskull": 2.5, "numskull": 0.75, "oaf": 1.25}
    near = {"moron": 0.25, ("numbskull", 2): 0.5}
    lexicon = toxicity.Lexicon(terms, near)
    rnd = random.Random(4)
    seen = ["idiot", "idiott", "idio", "xdiot", "idoit", "morn", "moronss", "scun", "scum", "vequaire", "veq", "", "idiots", "iidiot",
            "scvm", "sccum", "scmu", "mroon", "nmubskull", "nmubskul", "unmbsklul", "oaff", "numsskul"]
    for _ in range(4000):
        w = list(rnd.choice(list(terms)).rstrip("*"))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(w) + 1)
            if rnd.random() < 0.4 and at + 1 < len(w):
                w[at], w[at + 1] = w[at + 1], w[at]
            else:
                w[at:at + rnd.randint(0, 1)] = rnd.choice(["", "a", "o"])
        seen.append("".join(w))
    for w in seen:
        options = [v for t, v in terms.items() if t.endswith("*") and w.startswith(t[:-1])]
        options += [near.get((t, e), near.get(t, v)) if e else v for t, v in terms.items() if not t.endswith("*")
                    for e in [_edits(w, t)] if e <= (len(t) >= 4) + (len(t) >= 8)]
        assert lexicon.look_up(w)[0] == max(options, default=0.0), w
    assert all(lexicon.look_up(w)[0] for w in ("scvm", "sccum", "idoit", "mroon", "unmbskulll"))


def test_misspelled_abuse_scores_high(spark):
    import random

    rnd = random.Random(9)
    plain = ["river", "stone", "cloud", "paper", "green", "light", "horse", "bread", "under", "table", "water", "house"]
    rows, labels = [], []
    for i in range(600):
        body = [rnd.choice(plain) + rnd.choice(["", "s", "en"]) for _ in range(30)]
        if i % 5 == 0:
            body[rnd.randrange(30)] = rnd.choice(["wretched", "numbskull", "vermin"])
        rows.append((i, " ".join(body)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(1000, "you are a numbskul and stone water"), (1001, "you are a wretchedd horse"), (1002, "river stone cloud")]
    rows += [(1003, "you are a nmubskul and stone water"), (1004, "such evrmin under the table")]
    found = {r.id: r.score for r in toxicity.rate(spark.createDataFrame(rows, "doc_id long, text string"),
                                                  spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(found[i] >= 0.3 for i in (1000, 1001, 1003, 1004)) and found[1002] < 0.3


def test_quotation_counts_apart_from_abuse():
    lexicon = toxicity.Lexicon({"idiot": 3.0})
    assert toxicity.features(lexicon, "you idiot")[:1] == [3.0]
    quoted = toxicity.features(lexicon, 'she said "you idiot" and left')
    assert quoted[0] == 0.0 and quoted[3] == 3.0
    assert toxicity.features(lexicon, "the word «idiot» is old")[3] == 3.0
    assert toxicity.features(lexicon, None) == toxicity.features(lexicon, "") == [0.0] * 6

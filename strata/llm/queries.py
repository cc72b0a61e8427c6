"""The corpus operators over the benchmark tables, and their DuckDB oracles.

Each query applies one operator, with production parameters, to its whole
table and derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, collocations, decontam, langid, lines, mixing, periodic, pii, sharding, simhash, tokens, topk, toxicity
from strata.llm.common import text_session

TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
BPE_TOKENIZER = "byte_bpe_50k.json"
SHARDS = 24


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf).rstrip('/')}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` mixed to smoothed source weights: place of every (repeated) document in the stream."""
    mixed = mixing.mix(_table(spark, sf, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "epoch", "block", "rank", "release", "deadline", "slot")


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in ``documents``: base spans, and those that boosted trees add."""
    found = pii.find(_table(spark, sf, "documents"))
    counts = [pii.count_of(F.col("base"), i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
                        pii.spelled(F.concat("base", "added")).alias("spans"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every text of ``documents`` under the public 32k piece vocabulary."""
    import public_tokenizers

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` in 24 shards of near-equal bytes, equal texts together."""
    placed = sharding.shards(_table(spark, sf, "documents"), SHARDS)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of ``documents`` by SimHash of three-word shingles, two bits."""
    found = simhash.near_duplicates(_table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` without the lines that three or more of them share."""
    cleaned = lines.dedup_lines(_table(spark, sf, "documents"))
    return cleaned.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of ``documents`` inside 13-word passages of ``benchmark``."""
    found = decontam.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit",
                        F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every text of ``documents``, learned from ``labels``."""
    rated = toxicity.rate(_table(spark, sf, "documents"), _table(spark, sf, "labels"))
    return rated.withColumnRenamed("id", "doc_id")


def op9_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest ``embeddings`` by inner product for each vec_id divisible by 50."""
    asks = F.col("vec_id") % 50 == 0
    return topk.top_k(_table(spark, sf, "embeddings"), asks, 5).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every text of ``documents`` by rank-order profiles."""
    found = langid.identify(_table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "held_out", F.col("lang").alias("lang_pred"), "score")


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of repeated words in ``documents``, a tenth of which is made periodic from some word on."""
    docs = _table(text_session(spark), sf, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.withColumns({"g": F.floor(h / 10), "periodic": F.coalesce(h % 10 == 0, F.lit(False)),
                             "words": F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), 0))})
    n = F.size("words")
    rows = rows.withColumn("periodic", F.col("periodic") & (n > 0))
    rows = rows.withColumn("a", F.when(F.col("periodic"), F.col("g") % n))
    rows = rows.withColumn("p", F.when(F.col("periodic"), 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))))
    made = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    rows = rows.select("doc_id", F.when(F.col("periodic"), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))
    found = periodic.periodic_runs(rows)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumns({"best": longest, "lines": F.array_join(lines, "")})
    length, start, period = F.col("best")["length"], -F.col("best")["col2"], -F.col("best")["col3"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The 2000 best phrases of two to three words of each language of ``documents``."""
    return collocations.collocations(_table(collocations.graph_session(spark), sf, "documents"))


def op13_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every text of ``documents`` under the public 50k byte vocabulary, and what they decode to."""
    import public_tokenizers

    docs = _table(text_session(spark), sf, "documents").select("doc_id", "text")
    done = bpe.tokenize(docs, public_tokenizers.path(BPE_TOKENIZER))
    return done.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_sharding": op4_sharding,
    "op5_simhash": op5_simhash,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_top_k": op9_top_k,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_bpe": op13_bpe,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: DuckDB versions of the queries that SQL can express. The others need hash functions, models
#: or tokenizers that it lacks, or a schedule; tests hold those against plain Python versions.
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": f"""
WITH RECURSIVE sizes AS (
  SELECT coalesce('=' || source, '') AS key, count(*) AS n, CAST(round(pow(count(*), {mixing.SMOOTHING}) * 1000) AS BIGINT) AS want
  FROM documents GROUP BY 1),
exact AS (
  SELECT *, {mixing.PERIOD} - count(*) OVER () AS extra,
    ({mixing.PERIOD} - count(*) OVER ()) * want / CAST(sum(want) OVER () AS DOUBLE) AS share FROM sizes),
parts AS (
  SELECT key, n, CAST(1 + floor(share) + CASE WHEN
      row_number() OVER (ORDER BY share - floor(share) DESC, key) <= extra - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS c,
    row_number() OVER (ORDER BY key) AS i FROM exact),
tasks AS (SELECT list(c ORDER BY i) AS c FROM parts),
fold(t, had, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(c, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM tasks
  UNION ALL
  SELECT t + 1, list_transform(had, lambda h, j: h + CASE WHEN j = p THEN 1 ELSE 0 END), p
  FROM (
    SELECT t, had, list_min(list_transform(range(1, len(had) + 1), lambda j: CASE WHEN had[j] * {mixing.PERIOD} // c[j] <= t + 1
      THEN ((had[j] + 1) * {mixing.PERIOD} + c[j] - 1) // c[j] * 1000000 + j END)) % 1000000 AS p
    FROM fold, tasks WHERE t + 1 < {mixing.PERIOD})),
plan AS (
  SELECT key, n, c, list(t ORDER BY t) AS slots, (n + {mixing.BLOCK} - 1) // {mixing.BLOCK} AS blocks
  FROM fold JOIN parts ON pick = i WHERE t >= 0 GROUP BY key, n, c),
stream AS (SELECT *, max((blocks - 1) // c * {mixing.PERIOD} + slots[(blocks - 1) % c + 1] + 1) OVER () AS length FROM plan),
uses AS (
  SELECT *, length // {mixing.PERIOD} * c + len(list_filter(slots, lambda x: x < length % {mixing.PERIOD})) AS used FROM stream),
ranked AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS key, row_number() OVER (
    PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rank FROM documents),
placed AS (
  SELECT doc_id, source, rank, rank // {mixing.BLOCK} AS block, c, slots, blocks,
    unnest(range(0, (used - 1 - rank // {mixing.BLOCK}) // blocks + 1)) AS epoch
  FROM ranked JOIN uses USING (key) WHERE rank // {mixing.BLOCK} < used),
turns AS (SELECT *, block + epoch * blocks AS q FROM placed)
SELECT doc_id, source, epoch, block, rank, q * {mixing.PERIOD} // c AS release,
  ((q + 1) * {mixing.PERIOD} + c - 1) // c AS deadline, q // c * {mixing.PERIOD} + slots[q % c + 1] AS slot
FROM turns""",
    "op6_line_dedup": f"""
WITH lists AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM lists),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key FROM l),
r AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k.doc_id < r.top) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE r.key IS NULL OR k.doc_id = r.top), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key
GROUP BY doc_id""",
    "op7_decontamination": f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
starts AS (SELECT item_id, words, least(13, len(words)) AS n, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS s
  FROM b WHERE len(words) > 0),
w AS (SELECT DISTINCT item_id, n, words[s:s + n - 1] AS win FROM starts),
places AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
  FROM d CROSS JOIN (SELECT DISTINCT n FROM w) WHERE len(words) >= n),
hits AS (SELECT doc_id, item_id, s, places.n AS n FROM places JOIN w ON w.n = places.n AND w.win = words[s:s + places.n - 1]),
covered AS (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits),
n_hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM covered GROUP BY doc_id),
ids AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits),
n_ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM ids GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN n_hits ON d.doc_id = n_hits.doc_id LEFT JOIN n_ids ON d.doc_id = n_ids.doc_id""",
    "op9_top_k": """
WITH parts AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
bad AS (SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)),
v AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts
  WHERE vec_id IS NOT NULL AND vec_id NOT IN (SELECT vec_id FROM bad)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
  GROUP BY q.vec_id, c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5""",
    "op12_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces),
spots AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z FROM spots),
f1 AS (SELECT lang, x, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, x, y, CAST(count(*) AS HUGEINT) AS f FROM g WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
f3 AS (SELECT lang, x, y, z, CAST(count(*) AS HUGEINT) AS f FROM g WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
two AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, p.f AS l, q.f AS r, 1 AS k
  FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.x = f2.x JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y
  LEFT JOIN longer ON longer.lang = f2.lang AND longer.x = f2.x AND longer.y = f2.y
  WHERE longer.f IS NULL OR 100 * longer.f < {collocations.COVERED_PERCENT} * f2.f),
three AS (
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z AS phrase, f3.f AS a, p.f AS l, q.f AS r, 1 AS k
  FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.x = f3.x JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, p.f, q.f, 2
  FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y JOIN f1 q ON q.lang = f3.lang AND q.x = f3.z),
scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM (SELECT * FROM two UNION ALL SELECT * FROM three)),
cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM cut)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {collocations.TOP}""",
}

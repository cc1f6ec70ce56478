"""The registered query of each operator: production parameters, whole tables, full results."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    chat,
    language_id,
    minhash,
    mixture,
    quality,
    resampling,
    secret_scan,
    spotsigs,
    surrogates,
    token_counts,
    toxicity,
    whitening,
)
from .common import count_words, documents, id_remainder, small_batches

TOKEN_LIMIT = 4096


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir)
    rest = id_remainder(F.col("doc_id"), 5)
    model = language_id.fit_languages(docs, rest != 0)
    found = language_id.identify_languages(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.ambiguous").alias("ambiguous"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.fingerprints_with_next(documents(spark, sf_dir))
    own, other = F.col("signatures"), F.col("edited_signatures")
    return found.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(own).alias("fingerprint"),
        spotsigs.fingerprint(other).alias("edited_fingerprint"),
        spotsigs.likeness(own, other).alias("near_edited"),
        spotsigs.likeness(own, F.col("next_signatures")).alias("near_next"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = token_counts.count_tokens(docs)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    decoded = byte_bpe.decode_ids(byte_bpe.encode_texts(docs))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = id_remainder(F.col("doc_id"), 4)
    model = toxicity.fit_toxicity(docs, labels, rest != 2)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model, out="score")
    return scored.select(
        "doc_id",
        F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


#: The key of the registered query; a deployment passes a secret of its own.
SURROGATE_KEY = "registered-query"


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    replaced = surrogates.replace_entities(docs, SURROGATE_KEY, found_col="entities")
    return replaced.select(
        "doc_id", "text", F.size("entities").cast("long").alias("n_entities"), F.transform("entities", lambda e: e["kind"]).alias("kinds")
    )


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    mixed = mixture.mix(docs, count_words(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(documents(spark, sf_dir))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("probability") >= quality.KEEP)).alias("kept"),
        "probability",
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.near_duplicates(documents(spark, sf_dir), size=2, limit=0.8)


#: A conversation whose texts contain control strings of many templates, as a record in another layout.
_TRICKY = r"\### Assistant: </turn> ok"
_TRICKY_RECORD = json.dumps({"messages": [{"role": r, "content": _TRICKY} for r in ("user", "assistant")]})


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.turns_of_table(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    record = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(_TRICKY_RECORD).alias("record"))
    turns = rows.unionByName(chat.turns_of_records(record, "record"))
    back = chat.read_chats(chat.format_chats(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secret_scan.find_secrets(docs, out="found")
    kinds = [rule.kind for rule in secret_scan.BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id", *map(count, kinds), F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("found")).alias("spans")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = whitening.fit_whitening(vectors)
    rows = whitening.whiten(vectors.select("vec_id", "embedding"), model, out="found")
    explained = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    each = rows.select("vec_id", "found.deviation", F.posexplode("found.whitened").alias("k", "whitened"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = resampling.resample(documents(spark, sf_dir), benchmark, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_fingerprints,
        op3_token_counts,
        op4_byte_bpe,
        op5_toxicity,
        op6_surrogates,
        op7_mixture,
        op8_quality,
        op9_minhash,
        op10_chat,
        op11_secret_scan,
        op12_whitening,
        op13_resampling,
    )
}

# Texts are written with a character more for each one that the template escapes.
_OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + length(regexp_replace(role, '([\\#<:\n])', '\\\1', 'g'))
                   + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Documents of a source in hash order; the threshold is where the running sum passes what whole epochs leave over.
_OP7 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12) AS BIGINT) AS h
  FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), n AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w,
         source_size * 3.0::DOUBLE AS cap FROM s
), o AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
            sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM n
), t AS (
  SELECT source, source_size,
         least(cap, w * (SELECT level FROM o WHERE level * w <= cap ORDER BY cap / w, source IS NULL, source LIMIT 1)) AS target
  FROM o
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
), r AS (SELECT *, target - epochs * source_size AS rest FROM e
), c AS (
  SELECT source, h, sum(size) AS edge, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h
), b AS (
  SELECT r.source, arg_min(c.h, c.h) AS at, arg_min(c.edge, c.h) AS edge, arg_min(c.upto, c.h) AS upto
  FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source WHERE c.upto >= r.rest GROUP BY r.source
), l AS (
  SELECT r.*, b.at + CASE WHEN 2 * (r.rest - (b.upto - b.edge)) >= b.edge THEN 1 ELSE 0 END AS bound
  FROM r LEFT JOIN b ON r.source IS NOT DISTINCT FROM b.source
)
SELECT d.doc_id, d.size, l.source_size, l.target, d.source, k.copies, d.size * k.copies AS taken
FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source,
     LATERAL (SELECT CASE WHEN l.source_size > 0 THEN least(l.epochs + CASE WHEN d.h < l.bound THEN 1 ELSE 0 END, 3) ELSE 0 END AS copies) k
"""


# Every match is marked in the text; a match begins where all that stands before it, without marks, ends.
_SECRETS = (
    ("assign", 8, """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?""", "[A-Za-z0-9+/_.=-]+"),
    ("access", 12, "AKIA", "[A-Z0-9]+"),
    ("hex", 32, "", "[0-9a-f]+"),
    ("temporary_access", 12, "ASIA", "[A-Z0-9]+"),
    ("github", 36, "gh[pousr]_", "[A-Za-z0-9]+"),
    ("slack", 10, "xox[abprs]-", "[A-Za-z0-9-]+"),
    ("google", 35, "AIza", "[A-Za-z0-9_-]+"),
    ("stripe", 16, "[rs]k_(live|test)_", "[A-Za-z0-9]+"),
    ("jwt", 8, "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.]", "[A-Za-z0-9_-]+"),
    ("private_key", 1, "-----BEGIN ", "([A-Z0-9]+ )*PRIVATE KEY-----"),
)
_OP11 = (
    "WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents), p AS ("
    + " UNION ALL ".join(
        f"SELECT row, {k} AS k, '{kind}' AS kind, {least} AS least, '^({head})' AS head,"
        f" string_split(regexp_replace(text, '(({head})({body}))', chr(57344) || '\\1' || chr(57345), 'g'), chr(57344)) AS pieces FROM d"
        for k, (kind, least, head, body) in enumerate(_SECRETS)
    )
    + r"""), u AS (
  SELECT row, k, kind, least, head, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM p WHERE len(pieces) > 1
), s AS (
  SELECT *, split_part(piece, chr(57345), 1) AS found,
         sum(length(replace(piece, chr(57345), ''))) OVER (PARTITION BY row, k ORDER BY i) - length(replace(piece, chr(57345), '')) AS start
  FROM u
), g AS (
  SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(told, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(told, ',' ORDER BY start, k) AS spans
  FROM (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(found) AS BIGINT) AS told FROM s
        WHERE i > 1 AND length(found) - length(regexp_extract(found, head)) >= least)
  GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)
"""
)

_OP13 = r"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS step FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), texts AS (
  SELECT row_number() OVER () AS row, doc_id, true AS own, text FROM documents
  UNION ALL SELECT NULL, NULL, false, text FROM benchmark
), words AS (
  SELECT row, own, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), spelt AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)
), bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM spelt
), buckets AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], b), lambda c, v: xor(c >> 8, step[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, steps
), counts AS (
  SELECT bucket, CAST(count(*) FILTER (own) AS DOUBLE) AS s, CAST(count(*) FILTER (NOT own) AS DOUBLE) AS t
  FROM words JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counts
), weighed AS (
  SELECT row, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM words JOIN buckets USING (word) JOIN gains USING (bucket) WHERE own GROUP BY row
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
                                                               AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weighed USING (row) WHERE own
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS wanted FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= wanted THEN place END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {"op7_mixture": _OP7, "op10_chat": _OP10, "op11_secret_scan": _OP11, "op13_resampling": _OP13}

"""A training corpus from ``documents``: stages that each apply one operator to all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlake.llm import byte_bpe, minhash, mixture, surrogates, toxicity
from feedlake.llm.common import count_words, documents, free_name, id_filter, id_remainder, small_batches
from feedlake.plans.handoff import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a shingle and similarity of near duplicates.
SHINGLE = 5
SIMILARITY = 0.8
#: The key of the surrogates; a deployment puts a secret of its own here.
KEY = "corpus-pipeline"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict toxic; null and empty texts stay.

    The classifier learns from the labels of three quarters of the ids.
    """
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels, id_remainder(F.col("doc_id"), 4) != 2)
    score = free_name(docs, "__score")
    scored = toxicity.score_toxicity(docs, model, out=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Of rows that share an id one stays, the one whose text is smallest. Empty
    texts and rows without id are no duplicates of anything.
    """
    small_batches(spark)
    found = written(minhash.near_duplicates(docs, size=SHINGLE, limit=SIMILARITY))
    gone = free_name(docs, "__gone")
    ids = F.col("doc_id").cast("long")
    dropped = written(found.where("NOT kept").select(F.col("doc_id").alias(gone)).distinct())
    # only documents that may be dropped are shuffled to find out
    hit = free_name(docs, "__hit")
    marked = docs.withColumn(hit, id_filter(dropped).passes(ids))
    unsure = marked.where(F.col(hit)).join(dropped, ids == F.col(gone), "left_anti")
    kept = marked.where(~F.col(hit)).unionByName(unsure).select(*docs.columns)
    repeated = found.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(gone)).agg(F.count("*").alias("n"))
    repeated = written(repeated.where("n > 1").select(gone))
    if not repeated.limit(1).count():
        return kept
    same_id = ids == F.col(gone)
    place = free_name(docs, "__place")
    first = Window.partitionBy("doc_id").orderBy("text")
    one = kept.join(repeated, same_id, "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return kept.join(repeated, same_id, "left_anti").unionByName(one.drop(place))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data, and their new lengths."""
    return surrogates.replace_entities(docs, KEY).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 3 times each, by words."""
    return mixture.mixed_documents(docs, count_words(F.col("text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, how many, and whether decoding gives the text back."""
    small_batches(spark)
    made = free_name(docs, "__made")
    both = byte_bpe.encode_texts(docs, out=made, round_trip=True)
    found = {"ids": F.col(f"{made}.ids"), "n_tokens": F.size(f"{made}.ids").cast("long"), "round_trip": F.col(f"{made}.same")}
    return both.withColumns(found).drop(made)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixture", mix_sources),
    ("byte_bpe", encode),
]

#: SQL has no byte-pair encoding; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs

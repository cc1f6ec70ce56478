"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed hash. A source that must give a fraction of its
tokens gives the documents whose hash lies under a threshold; larger budgets
have larger thresholds, so smaller mixes are contained in larger ones. The
threshold comes from histograms: tokens are summed by source and hash bucket,
the bucket in which the running sum passes the budget is found, and only that
bucket is split further, until it holds one hash value. No document is sorted,
and a source of any size is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlake.plans.handoff import written

from .common import free_name

#: Hash bits a level resolves, and levels: 48 bits in all.
BITS = 12
LEVELS = 4
#: No document is taken more often than this.
MAX_REPEATS = 3
#: Weights of the sources in code point order of their names, repeating; null comes last.
WEIGHTS = (5, 2, 1)


def mixing_hash(doc_id: Column, text: Column, seed: str) -> Column:
    """48 bits that decide about a document; equal (id, text) pairs are decided together."""
    told = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), text, F.lit("")))
    return F.conv(F.substring(F.md5(told), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets for a table of (source, source_size), one row per source.

    All tokens are shared out by weight; a target stops at ``max_repeats`` times
    its source's size and the excess is shared by weight among the others until
    none is above. That is the one level ``x`` at which targets
    ``min(cap, x * weight)`` add up to everything: with sources in order of cap
    over weight, those before some point are at their caps.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    kept = F.array(*[F.lit(float(w)) for w in weights])
    table = sizes.withColumn("w", kept[(F.row_number().over(by_name) - 1) % len(weights)])
    table = table.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = (
        table.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    )
    # the first source that its level does not cap sets the level of all after it
    free = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    share = F.coalesce(F.least(F.col("cap"), level * F.col("w")), F.col("cap"))
    return table.select("source", "source_size", share.alias("target"))


def fit_mix(
    df: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """The narrow table ``doc_id, source, size, h`` and, per source, ``source_size, target, epochs, limit``.

    The mix takes a document of the source ``epochs`` times, and once more if its
    hash ``h`` lies under ``limit``.
    """
    narrow = written(
        df.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            mixing_hash(F.col(id_col), F.col(text_col), seed).alias("h"),
        )
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    # epochs: how often a source is taken whole; rest: what is missing then
    state = source_targets(sizes, weights, max_repeats).withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
            "prefix": F.lit(0).cast("long"),
        }
    )
    state = written(state.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        rows = narrow
        if level > 1:  # before, every row is in the one bucket there is
            key = state.select(F.col("source").alias("s"), "prefix")
            rows = narrow.join(key, narrow.source.eqNullSafe(key.s))
            rows = rows.where(F.shiftright("h", shift + BITS) == F.col("prefix"))
        histogram = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("tokens"))
        running = Window.partitionBy("source").orderBy("bucket")
        sums = histogram.withColumn("upto", F.sum("tokens").over(running)).withColumnRenamed("source", "s")
        # the boundary: the first bucket whose running sum reaches the rest
        passed = sums.join(state, F.col("s").eqNullSafe(F.col("source"))).where(F.col("upto") >= F.col("rest"))
        passed = passed.groupBy("s").agg(F.min(F.struct("bucket", "tokens", "upto")).alias("b"))
        state = written(
            state.join(passed, F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumn("rest", F.coalesce(F.col("rest") - (F.col("b.upto") - F.col("b.tokens")), F.lit(0.0)))
            .withColumn("prefix", F.coalesce(F.col("b.bucket"), F.col("prefix") * (1 << BITS)))
            .withColumn("edge", F.coalesce(F.col("b.tokens"), F.lit(0)))
            .select("source", "source_size", "target", "epochs", "prefix", "rest", "edge")
        )
    # documents on the threshold itself come in if that is nearer to the target
    limit = F.col("prefix") + F.when(2 * F.col("rest") >= F.col("edge"), 1).otherwise(0)
    return narrow, written(state.select("source", "source_size", "target", "epochs", limit.alias("limit")))


def copies_of(h: Column, limits: Column, max_repeats: int = MAX_REPEATS) -> Column:
    """How often a document of hash ``h`` is taken under its source's limits."""
    copies = limits["epochs"] + F.when(h < limits["limit"], 1).otherwise(0)
    copies = F.when(limits["source_size"] > 0, copies).otherwise(0)
    return F.least(copies, F.lit(max_repeats)).cast("long")


def mix(df: DataFrame, size: Column, source_col: str = "source", **options) -> DataFrame:
    """One row per row of ``df``: ``doc_id, source, size, source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document and ``taken`` its size
    times that. Each source's taken sizes are as near to its target as whole
    documents in hash order allow. Null sizes are 0, a null source is a source
    of its own, a source of size 0 has target 0 and is not taken. Rows with the
    same id are decided alike, without an id rows of the same text. An
    empty table gives no rows. Other columns of ``df`` are not used; the options
    are those of :func:`fit_mix`.
    """
    narrow, limits = fit_mix(df, size, source_col=source_col, **options)
    limits = limits.select(F.col("source").alias("s"), F.struct("source_size", "target", "epochs", "limit").alias("l"))
    copies = copies_of(F.col("h"), F.col("l"), options.get("max_repeats", MAX_REPEATS))
    return (
        narrow.join(limits, narrow.source.eqNullSafe(limits.s))
        .withColumn("copies", copies)
        .select(
            "doc_id", "source", "size", "l.source_size", "l.target", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )


def mixed_documents(
    df: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    **options,
) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them. No row is shuffled: the limits go to the rows."""
    _, limits = fit_mix(df, size, id_col, text_col, source_col, seed=seed, **options)
    s, told, copy = free_name(df, "__source"), free_name(df, "__limits"), free_name(df, "__copy")
    limits = limits.select(F.col("source").alias(s), F.struct("source_size", "target", "epochs", "limit").alias(told))
    copies = copies_of(mixing_hash(F.col(id_col), F.col(text_col), seed), F.col(told), options.get("max_repeats", MAX_REPEATS))
    taken = df.join(limits, df[source_col].eqNullSafe(limits[s]))
    taken = taken.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return taken.select(*[F.col(f"`{c}`") for c in df.columns])

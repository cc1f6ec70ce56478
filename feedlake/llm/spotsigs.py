"""Document fingerprints by SpotSigs, in DataFrame operations only.

A spot signature is a frequent word (the anchor) with the content words that
follow it, other frequent words left out. Navigation and lists have few
anchors, running text has many, so the set of a text's signatures is a
fingerprint of its prose. Sets are compared by Jaccard similarity, which cannot
exceed the quotient of their lengths: sets are dealt out by ranges of length,
and only sets of compatible ranges and lengths are compared at all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.plans.handoff import written

from .quality import FUNCTION_WORDS, let

#: Frequent words that open a chain; content words in a chain.
ANCHORS = tuple(FUNCTION_WORDS)
CHAIN = 2


def _one_of(words: tuple[str, ...]) -> str:
    """A pattern of the words that shares their beginnings, so that a mismatch is seen early."""
    tree: dict = {}
    for word in words:
        at = tree
        for c in word:
            at = at.setdefault(c, {})
        at[""] = {}

    def spelled(at: dict) -> str:
        rest = [c + spelled(to) for c, to in sorted(at.items()) if c]
        if not rest:
            return ""
        body = rest[0] if len(rest) == 1 and "" not in at and len(at) == 1 else "(?:" + "|".join(rest) + ")"
        return body + "?" if "" in at else body

    return spelled(tree)


def spot_signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> Column:
    """The sorted distinct 32-bit hashes of a text's spot signatures.

    Words are runs of letters and digits, lower-cased. A run of other signs is an
    anchor, too, which serves lists and tables without function words. Every run
    of anchors starts one chain, named by its last anchor; a chain that the text's end cuts
    short counts, too. A text with words but no chain has one signature, of all
    its words; a text without words has none.
    """
    signs = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]+", " . ")
    plain = F.concat(F.regexp_replace(signs, r"[^\p{L}\p{N}.]+", " "), F.lit(" "))
    plain = F.regexp_replace(plain, "^ ", "")
    # an anchor is tied to the content word after it: "in the old house" -> "the_old house"
    anchor = rf"(?:\.|{_one_of(anchors)})"
    tied = F.regexp_replace(plain, rf"(?<![^ ])(?:{anchor} (?={anchor} ))*+({anchor}) ", "$1_")
    follow = r"[^ ]++ " * chain
    follow = f"(?:{follow}|[^ ]++ $)" if chain > 1 else follow
    found = F.regexp_extract_all(tied, F.lit(rf"(?<![^ ])(?=([^ _]++_{follow}))"), F.lit(1))
    hashes = F.transform(found, lambda s: F.hash(F.regexp_replace(s, " [^ _]*+_", " ")))
    whole = F.when(F.length(plain) > 0, F.array(F.hash(plain))).otherwise(F.array().cast("array<int>"))
    return let(F.array_sort(F.array_distinct(hashes)), lambda h: F.when(F.size(h) > 0, h).otherwise(whole))


def fingerprint(signatures: Column) -> Column:
    """A set of signatures as text: its length, and the hashes in hexadecimal digits."""
    digits = F.transform(signatures, lambda h: F.lpad(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0"))
    return F.lower(F.concat(F.size(signatures).cast("string"), F.lit(":"), F.array_join(digits, "")))


def likeness(a: Column, b: Column, limit: float = 0.0) -> Column:
    """Jaccard similarity of two sets of signatures; 1 for two empty sets.

    Pairs whose lengths alone keep them under ``limit`` are 0 without a comparison.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, 1.0)
        .when((small == 0) | (small < limit * large), 0.0)
        .otherwise(let(common, lambda n: n / (small + large - n)))
    )


def length_range(size: Column, limit: float) -> Column:
    """Sets at least ``limit`` alike lie in the same range of lengths or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / math.log(1 / limit)).cast("int")


def near_links(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.8, chain: int = CHAIN
) -> DataFrame:
    """Links ``(a, b, similarity)`` between classes of equal fingerprints, each named by its smallest id.

    Two sets that are alike enough share one of their rarest signatures: each set
    is entered under its ``size - ceil(limit * size) + 1`` rarest ones, by range
    of length, and a set of range r meets those of the ranges r and r + 1. Texts
    without signatures and rows without id are linked with nothing; equal texts
    are one class, so copies are not paired with each other.
    """
    sets = df.select(F.col(id_col).cast("long").alias("id"), spot_signatures(F.coalesce(F.col(text_col), F.lit(""))).alias("s"))
    sets = written(sets.where("id IS NOT NULL AND size(s) > 0").groupBy("s").agg(F.min("id").alias("id")))
    spots = sets.select("id", F.size("s").alias("n"), F.explode("s").alias("spot"))
    ranked = spots.join(spots.groupBy("spot").agg(F.count("*").alias("df")), "spot")
    kept = ranked.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("o"))
    prefix = F.slice("o", 1, (F.col("n") - F.ceil(limit * F.col("n")) + 1).cast("int"))
    entries = written(
        kept.select("id", "n", length_range(F.col("n"), limit).alias("r"), F.explode(F.transform(prefix, lambda x: x["spot"])).alias("spot"))
    )
    mine = entries.select("spot", "id", "n", "r", F.explode(F.array(F.col("r"), F.col("r") + 1)).alias("at"))
    x, y = mine.alias("x"), entries.alias("y")
    fits = (F.col("x.n") >= limit * F.col("y.n")) & (
        (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))
    )
    pairs = x.join(y, (F.col("x.spot") == F.col("y.spot")) & (F.col("x.at") == F.col("y.r")) & fits)
    pairs = pairs.select(F.col("x.id").alias("i"), F.col("y.id").alias("k")).distinct()
    si = sets.select(F.col("id").alias("i"), F.col("s").alias("si"))
    sk = sets.select(F.col("id").alias("k"), F.col("s").alias("sk"))
    alike = pairs.join(si, "i").join(sk, "k").select("i", "k", likeness(F.col("si"), F.col("sk"), limit).alias("similarity"))
    return alike.where(F.col("similarity") >= limit).select(
        F.least("i", "k").alias("a"), F.greatest("i", "k").alias("b"), "similarity"
    )


def neighbours(keys: DataFrame) -> DataFrame:
    """The next row of each row of ``keys`` in the order of its columns, in columns named ``next_...``.

    Rows are numbered by sorting ranges of them in parallel and adding up the
    ranges' sizes; row k then joins row k + 1. After the last comes the first.
    Equal rows count once.
    """
    columns = keys.columns
    sorted_ = keys.distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    # the number of a row within its range, and its range, in one long
    placed = written(sorted_.withColumn("at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.select(*columns, part.alias("part"), inside.alias("inside"))
    # one row per range: a small table whatever the number of rows
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.alias("p").join(F.broadcast(sizes.alias("q")), F.col("q.part") < F.col("p.part"), "left")
    before = before.groupBy(F.col("p.part").alias("part")).agg(F.coalesce(F.sum("q.size"), F.lit(0)).alias("before"))
    total = sizes.agg(F.sum("size")).first()[0] or 1
    numbered = written(placed.join(before, "part").select(*columns, (F.col("before") + F.col("inside")).alias("k")))
    following = numbered.select(*[F.col(c).alias(f"next_{c}") for c in columns], F.pmod(F.col("k") - 1, F.lit(total)).alias("k"))
    return numbered.join(following, "k").drop("k")


def fingerprints_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's signatures beside those of its edited text and of the next document.

    Columns ``doc_id, text, n_chars, edited, signatures, edited_signatures,
    next_signatures``; the edited text has its last quarter (of its code points,
    rounded down) replaced by the first as many of the next document, or all it
    has. The next document is the one with the next larger id,
    after the last the first; rows with the same id follow each other by a hash
    of their texts, rows without id come first. Exact repeats of a row count once
    in that order and all get the same result. Null texts are empty. A single document is its own next one.
    An empty table gives no rows. Other columns are not used.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text", F.col("doc_id").isNull()))
    order = written(neighbours(docs.select("doc_id", "h", F.length("text").alias("n"))))
    # whole texts are shuffled once, by id and hash; null ids have hashes of their own
    docs = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), "h", "text")
    key = [F.coalesce("doc_id", F.lit(0)).alias("to_id"), F.col("h").alias("to_h")]
    wanted = order.select(
        F.coalesce("next_doc_id", F.lit(0)).alias("id"), F.col("next_h").alias("h"), *key, F.floor(F.col("n") / 4).cast("int").alias("q")
    )
    # each document gives its predecessor the front of its text and its signatures
    sent = docs.join(wanted, ["id", "h"]).select(
        "to_id", "to_h", F.substr("text", F.lit(1), F.col("q")).alias("front"), spot_signatures(F.col("text")).alias("next_signatures")
    )
    sent = sent.groupBy("to_id", "to_h").agg(F.first(F.struct("front", "next_signatures")).alias("s"))
    mine = docs.join(sent, (F.col("id") == F.col("to_id")) & (F.col("h") == F.col("to_h")))
    n = F.length("text")
    mine = mine.select(
        F.when(F.col("h") == F.xxhash64("text", F.lit(False)), F.col("id")).alias("doc_id"),
        "text",
        n.alias("n_chars"),
        F.concat(F.substr("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("s.front")).alias("edited"),
        F.col("s.next_signatures").alias("next_signatures"),
    )
    return mine.select(
        "doc_id",
        "text",
        "n_chars",
        "edited",
        spot_signatures(F.col("text")).alias("signatures"),
        spot_signatures(F.col("edited")).alias("edited_signatures"),
        "next_signatures",
    )

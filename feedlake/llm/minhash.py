"""Near duplicates by b-bit MinHash.

Of each document's shingle set the minima of many hash functions are taken.
Groups of four whole minima make the bands that find candidates; of each
minimum only the low four bits are kept, packed in bit planes, and the
similarity of a candidate pair is estimated by counting equal places with XOR
and bit_count, corrected for chance hits. Pairs that can reach the limit are
confirmed on the full shingle sets, which are made again from the texts of the
documents concerned.

Equal sets are one class from the start, and classes, not documents, are
compared. A bucket's members are first compared with a centre and then with a second
one; what these rounds have linked need not be compared again. All members that
still stand in different components then meet in blocks of full sets, so every
pair of a bucket is settled by links or compared itself, and no group is
written out as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.plans.handoff import written

from .common import IdFilter, id_filter

BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
#: Low bits of a minimum that are kept; the planes of 64 hash functions are a long each.
LOW_BITS = 4
PLANES = [f"s{k}" for k in range(LOW_BITS * HASHES // 64)]
#: An estimate so many standard deviations under the limit is not confirmed.
FLOOR_SIGMAS = 6.5
STAR_ROUNDS = 2
#: Shingle sets of one side in a task that compares blocks, about.
BLOCK = 256
#: Links that one task may settle.
FEW_LINKS = 1 << 18
#: Word hashes a worker remembers before it starts over.
CACHE_WORDS = 100_000
_CHUNK = 1024


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()
_rng = np.random.default_rng(23)
_FACTORS = (_rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)).astype(np.uint32)
_OFFSETS = _rng.integers(0, 1 << 32, HASHES, np.uint32)


def shingle_set(text: str | None, size: int = 2) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles.

    A-Z are lower-cased; words are runs of anything but ASCII white space. Fewer
    words than ``size`` make one shingle, no words none.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty."""
    folded = (shingles ^ (shingles >> np.uint64(31))).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(folded), _CHUNK):
        values = folded[at : at + _CHUNK, None] * _FACTORS
        values += _OFFSETS
        np.minimum(least, values.min(0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima as planes: all lowest bits, then all second ones, and so on."""
    planes = (least[None, :] >> np.arange(LOW_BITS, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8), axis=1).view(np.int64).ravel()


def band_hashes(least: np.ndarray) -> np.ndarray:
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in least.reshape(BANDS, ROWS).T:
        mixed = (mixed ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_key``, the packed planes and ``bands``; the last two are null for empty sets."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, planes, bands = [], [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), size)
                counts.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                least = minima(found) if len(found) else None
                planes.append(None if least is None else packed(least))
                bands.append(None if least is None else band_hashes(least))
            columns = {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_shingles": pa.array(counts, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
            }
            for k, name in enumerate(PLANES):
                columns[name] = pa.array([None if p is None else int(p[k]) for p in planes], pa.int64())
            columns["bands"] = pa.array(bands, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    planes = ", ".join(f"{name} long" for name in PLANES)
    schema = f"doc_id long, n_shingles long, set_key binary, {planes}, bands array<long>"
    return narrow.mapInArrow(signed, schema)


def estimate(a: str, b: str) -> Column:
    """Similarity of the packed signatures of two aliases, corrected for equal low bits by chance."""
    halves = HASHES // 64
    off = F.lit(0)
    for half in range(halves):
        differs = None
        for bit in range(LOW_BITS):
            name = f"s{bit * halves + half}"
            one = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
            differs = one if differs is None else differs.bitwiseOR(one)
        off = off + F.bit_count(differs)
    chance = 2.0**-LOW_BITS
    return (1 - off / HASHES - chance) / (1 - chance)


def estimate_floor(limit: float) -> float:
    """What the estimate of a pair at ``limit`` practically never falls below."""
    chance = 2.0**-LOW_BITS
    equal = limit + (1 - limit) * chance  # low bits that are equal by chance count, too
    return limit - FLOOR_SIGMAS * (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)


def shingle_sets(df: DataFrame, id_col: str, text_col: str, size: int, wanted: IdFilter) -> DataFrame:
    """``doc_id`` and shingle hashes of the rows that the filter lets pass."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.hits(batch.column("places"))))
            sets = [shingle_set(t.as_py(), size).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "shingles": pa.array(sets, pa.list_(pa.int64()))}
            )

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    narrow = narrow.withColumn("places", wanted.places(F.col("doc_id")))
    return narrow.mapInArrow(made, "doc_id long, shingles array<long>")


def components(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """``(node, component)`` of links ``(a, b)``: the smallest node that can be reached.

    Up to ``few`` links are settled by one task, which holds no more than these;
    more of them in rounds over all executors.
    """
    links = written(links.select("a", "b").distinct())
    if links.count() <= few:
        return written(links.coalesce(1).mapInArrow(_joined, "node long, component long"))
    return _components_in_rounds(links)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links of one task: both ends, and what they belong to, take the smaller label until none changes."""
    found = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not found:
        return
    ends = np.concatenate([np.concatenate(side) for side in zip(*found)])
    nodes, ends = np.unique(ends, return_inverse=True)
    a, b = ends[: len(ends) // 2], ends[len(ends) // 2 :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for owner in (a, b, label[a], label[b]):
            np.minimum.at(new, owner, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes), "component": pa.array(nodes[label])})


def _components_in_rounds(links: DataFrame) -> DataFrame:
    """Each round a node takes the smallest component among its neighbours' and then its component's own component."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("component").alias("near"))
        least = written(
            labels.join(near, "node").select(
                "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
            )
        )
        up = least.select(F.col("node").alias("component"), F.col("component").alias("up"))
        labels = written(
            least.join(up, "component", "left").select("node", "was", F.coalesce("up", "component").alias("component"))
        )
        changed = labels.where("was <> component").limit(1).count()
        labels = labels.select("node", "component")
        if not changed:
            return labels


def _several_texts(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that have several texts; such rows are one document."""
    key = F.xxhash64("set_key")
    several = full.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high")
    several = written(full.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "set_key").distinct())
    named = written(several.join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep"))
    low = named.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return named.join(low, "doc_id").where("a < rep").select("a", F.col("rep").alias("b"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    limit: float = 0.8,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``df``.

    Documents whose shingle sets have a Jaccard similarity of ``limit`` or more
    are linked; ``component_id`` is the smallest id that can be reached. Null and
    empty texts have empty sets and are linked with nothing: their component is
    their own id. Rows with the same
    id are one document, whose links are those of all its texts; rows without id
    are linked with nothing, have no component and are kept. Texts of any length
    are read whole. Other columns are not used; an empty table gives no rows.
    """
    signed = written(signatures(df, id_col, text_col, size))
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(
        full.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), *[F.first(c).alias(c) for c in (*PLANES, "bands")]
        )
    )
    sigs = written(classes.select("rep", "n", *PLANES).dropDuplicates(["rep", *PLANES]))
    floor = estimate_floor(limit)
    likely = (estimate("x", "y") >= floor) & (F.least("x.n", "y.n") >= limit * F.greatest("x.n", "y.n") - 1e-9)

    def estimated(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) of representatives that the signatures and sizes let pass."""
        with_a = pairs.distinct().join(sigs.alias("x"), F.col("a") == F.col("x.rep"))
        return with_a.join(sigs.alias("y"), F.col("b") == F.col("y.rep")).where(likely).select("a", "b").distinct()

    def picked_sets(ids: DataFrame) -> DataFrame:
        """The full sets of all texts with these ids, and a few others; the texts are not shuffled."""
        return shingle_sets(df, id_col, text_col, size, id_filter(ids))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are links, by the full sets of all texts with these ids."""
        pairs = written(pairs)
        sets = picked_sets(pairs.select(F.explode(F.array("a", "b"))))
        a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        enough = common >= limit * (F.size("sa") + F.size("sb") - common) - 1e-9
        return written(pairs.join(b, "b").join(a, "a").where(enough).select("a", "b"))

    exploded = classes.select("rep", F.explode("bands").alias("bucket"))
    # most buckets hold one class and need nothing
    crowded = exploded.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    members = written(exploded.join(crowded.select("bucket"), "bucket", "left_semi").distinct())
    members = members.withColumn("component", F.col("rep"))
    links, labels = None, None
    for turn in range(STAR_ROUNDS):
        # the first centre is the smallest id, the same in many buckets; later ones differ from bucket to bucket
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", "bucket", F.lit(turn))
        centres = members.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "rep", "component")).alias("c"))
        centres = centres.select("bucket", F.col("c.rep").alias("centre"), F.col("c.component").alias("its"))
        spokes = members.join(centres, "bucket")
        pairs = spokes.where("component <> its")
        found = confirmed(estimated(pairs.select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b"))))
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        # a centre has been compared with all others of its bucket
        members = written(_unsettled(spokes.where("rep <> centre").select("bucket", "rep"), labels))
    links = links.unionByName(_block_links(members, picked_sets, limit)).unionByName(_several_texts(full, classes))
    labels = components(links)
    ids = signed.select("doc_id", "n_shingles", "set_key")
    # a class is the smallest id with that set
    reps = classes.select("set_key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    reps = reps.select("set_key", F.coalesce("component", "rep").alias("component"))
    named = ids.where("n_shingles > 0").join(reps, "set_key", "left")
    # all empty sets share their key, so they stay out of the join
    named = named.unionByName(ids.where("n_shingles = 0").withColumn("component", F.lit(None).cast("long")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(bucket, rep, component)`` of the buckets that still hold several components."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    several = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return named.join(several.where("low <> high").select("bucket"), "bucket", "left_semi")


def _block_links(
    members: DataFrame, picked_sets: Callable[[DataFrame], DataFrame], limit: float, block: int = BLOCK
) -> DataFrame:
    """Links between members of a bucket in different components, by full sets, without a row per pair.

    Buckets with the same main component (the one with most members) are one
    group. Its members outside the main component meet all its members,
    block by block; a task compares two blocks and returns no more links than
    join their components.
    """
    counted = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = counted.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("m"))
    main = main.select("bucket", F.col("m.component").alias("g"))
    grouped = written(members.join(main, "bucket").select("g", "rep", "component").distinct())
    blocks = grouped.groupBy("g").agg(
        F.ceil(F.count("*") / block).cast("int").alias("of_all"),
        F.ceil(F.sum(F.when(F.col("component") != F.col("g"), 1).otherwise(0)) / block).cast("int").alias("of_minor"),
    )
    placed = grouped.join(blocks, "g")
    minor = placed.where("component <> g").select(
        "g",
        F.pmod(F.xxhash64("rep"), "of_minor").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("of_all") - 1)).alias("j"),
        F.lit(True).alias("minor"),
        "rep",
        "component",
    )
    every = placed.select(
        "g",
        F.explode(F.sequence(F.lit(0), F.col("of_minor") - 1)).alias("i"),
        F.pmod(F.xxhash64("rep"), "of_all").cast("int").alias("j"),
        F.lit(False).alias("minor"),
        "rep",
        "component",
    )
    sets = picked_sets(grouped.select("rep"))
    rows = minor.unionByName(every).join(sets, F.col("rep") == F.col("doc_id"))
    rows = rows.select("g", "i", "j", "minor", "rep", "component", "shingles")

    def compared(table: pa.Table) -> pa.Table:
        return pa.table(_compare_blocks(table, limit), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return written(rows.groupBy("g", "i", "j").applyInArrow(compared, "a long, b long"))


def _compare_blocks(table: pa.Table, limit: float) -> dict[str, list[int]]:
    """Links of the minor rows with the other rows that join components not joined yet."""
    minor = table.column("minor").to_numpy()
    reps, owner = table.column("rep").to_numpy(), table.column("component").to_numpy()
    lists = table.column("shingles").combine_chunks()
    bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    lengths = np.diff(bounds)
    _, column = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(reps)), lengths)
    left, right = np.flatnonzero(minor), np.flatnonzero(~minor)
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _CHUNK):
        lo, hi = np.searchsorted(column, (at, at + _CHUNK))
        there = np.zeros((len(reps), _CHUNK), np.float32)
        there[row[lo:hi], column[lo:hi] - at] = 1
        common += there[left] @ there[right].T
    enough = common >= limit * (lengths[left][:, None] + lengths[right][None, :] - common) - 1e-6
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    found: dict[str, list[int]] = {"a": [], "b": []}
    for x, y in np.argwhere(enough & (owner[left][:, None] != owner[right][None, :])):
        u, v = left[x], right[y]
        p, q = root(int(owner[u])), root(int(owner[v]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            found["a"].append(int(min(reps[u], reps[v])))
            found["b"].append(int(max(reps[u], reps[v])))
    return found

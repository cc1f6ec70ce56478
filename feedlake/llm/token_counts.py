"""Token counts of a SentencePiece BPE vocabulary by a two-tier lookup on the map side.

White space never stands inside a piece of such a vocabulary except at its
front, so no merge crosses the start of a word: a text's count is the sum of
the counts of its pre-tokens (a run of word marks and what follows up to the
next mark). Tier one is a compact hash table of the lengths of frequent
pre-tokens, broadcast to all tasks. Tier two encodes a miss with the library
once and remembers it in a bounded cache of the Python worker. Nothing is
shuffled, whatever the number of distinct pre-tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, smallest_by_hash, vocabulary_path

#: Documents whose pre-tokens make the broadcast table; it only decides what is fast.
SAMPLE_DOCUMENTS = 2_000
#: Entries of the broadcast table: with short pre-tokens, a megabyte or two.
TABLE_ENTRIES = 30_000
#: Pre-tokens a worker remembers before it starts over, and the longest one it keeps.
CACHE_ENTRIES = 200_000
CACHE_CHARS = 48

MARK = "▁"
_PRETOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

_processors: dict[str, tuple[sentencepiece.SentencePieceProcessor, bool]] = {}
_caches: dict[str, dict[str, int]] = {}


def _processor(path: str) -> tuple[sentencepiece.SentencePieceProcessor, bool]:
    """The worker's processor, and whether pre-tokens of its vocabulary are independent."""
    if path not in _processors:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        # A text is split only if every piece has its marks in front and the
        # library leaves characters and spaces as they are.
        probe = "  a  Ａ\n b "
        pieces = (library.id_to_piece(i) for i in range(library.get_piece_size()))
        splits = not any(MARK in p.lstrip(MARK) for p in pieces)
        splits = splits and library.normalize(probe) == (MARK + probe.replace(" ", MARK))
        _processors[path] = library, splits
    return _processors[path]


def pretokens(text: str) -> list[str]:
    """The text's pre-tokens without the mark in front of each.

    They all start with a mark: the library adds one before the text, too.
    """
    if MARK not in text and "  " not in text and text[-1:] != " " and text[:1] != " ":
        return text.split(" ") if text else []
    return [p[1:] for p in _PRETOKEN.findall(MARK + text.replace(" ", MARK))] if text else []


def _encoded_lengths(library: sentencepiece.SentencePieceProcessor, found: list[str]) -> list[int]:
    # the library puts the mark in front that pretokens() took away; it adds none to nothing
    made = library.encode([p.replace(MARK, " ") for p in found], num_threads=1)
    return [len(ids) if p else 1 for p, ids in zip(found, made, strict=True)]


def count_text(text: str, path: str, table: dict[str, int]) -> int:
    """Tokens of one text."""
    library, splits = _processor(path)
    if not splits:
        return len(library.encode(text))
    cache = _caches.setdefault(path, {})
    total, missing = 0, []
    for pretoken, times in Counter(pretokens(text)).items():
        length = table.get(pretoken) or cache.get(pretoken)
        if length:
            total += times * length
        else:
            missing.append((pretoken, times))
    if missing:
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for (pretoken, times), length in zip(missing, _encoded_lengths(library, [p for p, _ in missing]), strict=True):
            total += times * length
            if len(pretoken) <= CACHE_CHARS:
                cache[pretoken] = length
    return total


def frequent_pretokens(
    df: DataFrame, path: str, text_col: str = "text", sample: int = SAMPLE_DOCUMENTS, entries: int = TABLE_ENTRIES
) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded, repeatable sample of texts."""
    texts = df.select(F.col(text_col).alias("text")).where(F.length("text") > 0)
    texts = smallest_by_hash(texts, "text", sample)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(p for p in pretokens(text) if len(p) <= CACHE_CHARS)
        top = seen.most_common(entries)
        library, _ = _processor(path)
        yield pa.RecordBatch.from_pydict(
            {"p": [p for p, _ in top], "n": [n for _, n in top], "k": _encoded_lengths(library, [p for p, _ in top])},
            schema=pa.schema([("p", pa.string()), ("n", pa.int64()), ("k", pa.int64())]),
        )

    found = texts.mapInArrow(counted, "p string, n long, k long")
    found = found.groupBy("p").agg(F.sum("n").alias("n"), F.max("k").alias("k"))
    return {r.p: r.k for r in found.orderBy(F.desc("n"), "p").limit(entries).collect()}


def count_tokens(
    df: DataFrame,
    path: str | None = None,
    text_col: str = "text",
    out: str = "n_tokens",
    sample: int = SAMPLE_DOCUMENTS,
) -> DataFrame:
    """``df`` with a column ``out``: tokens of each whole text, as the library itself would count.

    Null and empty texts have 0 tokens. Strings of special tokens inside texts
    are ordinary text, which is the library's default. Repeated rows are counted
    row by row; an empty table stays empty. A column that already has the name
    ``out`` is replaced; all others stay.
    """
    path = path or vocabulary_path("piece_bpe_32k.model")
    table = df.sparkSession.sparkContext.broadcast(frequent_pretokens(df, path, text_col, sample))

    @F.arrow_udf("long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = table.value
        for texts in batches:
            yield pa.array([count_text(t.as_py() or "", path, known) for t in texts], pa.int64())

    made = free_name(df, "__tokens")
    kept = [c for c in df.columns if c.lower() != out.lower()]
    return df.withColumn(made, counts(F.col(text_col))).select(*[f"`{c}`" for c in kept], F.col(made).alias(out))

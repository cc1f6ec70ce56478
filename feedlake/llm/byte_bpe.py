"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file is turned into a BPE model of the library: every byte has a
printable character of its own, and each vocabulary entry may be made from any
two entries it splits into, ordered by the entry's rank. A batch's texts are
split by the pattern; its distinct matches that the worker has not met are
encoded in one call of the library, with offsets, and remembered. Decoding
looks ids up in the reversed byte table and joins bytes, so characters that are
split over several tokens come back whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, vocabulary_path

#: Matches a worker remembers before it starts over, and the longest one it keeps.
CACHE_ENTRIES = 150_000
CACHE_CHARS = 64
#: Texts encoded before their ids are packed.
CHUNK = 256


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else one from 256 up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class ByteBpe:
    """Encodes and decodes with one rank file; made once in a Python worker."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.letter_of = byte_characters()
        self.known: dict[str, tuple[int, ...]] = {}

    @cached_property
    def library(self) -> tokenizers.Tokenizer:
        ranks, letters = self.ranks, self.letter_of
        spelled = {t: "".join(letters[b] for b in t) for t in ranks}
        merges = [
            (spelled[t[:i]], spelled[t[i:]])
            for t in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        # matches are remembered here, so the library needs no cache of its own
        vocabulary = {spelled[t]: r for t, r in ranks.items()}
        return tokenizers.Tokenizer(tokenizers.models.BPE(vocab=vocabulary, merges=merges, cache_capacity=0))

    @cached_property
    def tokens(self) -> pa.BinaryArray:
        """The bytes of each id, at its place; ids without an entry are null."""
        places: list[bytes | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            places[rank] = token
        return pa.array(places, pa.binary())

    def matches(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def _spell(self, match: str) -> str:
        letters = self.letter_of
        return "".join([letters[b] for b in match.encode("utf-8")])

    def _learn(self, missing: list[str], into: dict[str, tuple[int, ...]]) -> None:
        """Encode matches not met before in one call of the library."""
        made = self.library.encode_batch_fast([self._spell(m) for m in missing], add_special_tokens=False)
        into.update((m, tuple(e.ids)) for m, e in zip(missing, made, strict=True))

    def encode_batch(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """The ids of each text, in order."""
        for text in texts:
            matches = self.matches(text)
            parts = list(map(self.known.get, matches))
            if None in parts:
                if len(self.known) > CACHE_ENTRIES:
                    self.known.clear()
                    parts = [None] * len(matches)
                missing = list({m for m, ids in zip(matches, parts, strict=True) if ids is None})
                self._learn([m for m in missing if len(m) <= CACHE_CHARS], self.known)
                if long := [m for m in missing if len(m) > CACHE_CHARS]:
                    once: dict[str, tuple[int, ...]] = {}
                    self._learn(long, once)
                    parts = [self.known.get(m) or once[m] for m in matches]
                else:
                    parts = map(self.known.__getitem__, matches)
            yield list(chain.from_iterable(parts))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_batch([text]))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each token in code points of the text.

        A token that holds only part of a character spans that whole character,
        so the tokens of a split character share a span.
        """
        spans, start = [], 0
        for match in self.pattern.finditer(text):
            word = match.group()
            # byte offset -> code point that the byte belongs to
            owner = [k for k, c in enumerate(word) for _ in c.encode("utf-8")]
            start = match.start()
            encoding = self.library.encode(self._spell(word), add_special_tokens=False)
            spans += [(start + owner[a], start + owner[b - 1] + 1) for a, b in encoding.offsets]
        return spans

    def decode_batch(self, lists: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each list of ids: the entries' bytes stand one after the other, only the bounds change."""
        flat = self.tokens.take(lists.values)
        bounds = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
        bounds = np.ascontiguousarray(bounds[lists.offsets.to_numpy()])
        return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(bounds), flat.buffers()[2]])

    def decode(self, ids: Iterable[int]) -> bytes:
        return self.decode_batch(_list_array([list(ids)]))[0].as_py()


def _list_array(lists: Iterable[list[int]]) -> pa.ListArray:
    lists = list(lists)
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


# The workers of an executor are its parallelism; the library's own threads would compete with them.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_models: dict[tuple[str, str], ByteBpe] = {}


def model(path: str, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """The worker's model of this file."""
    if (path, pattern) not in _models:
        _models[path, pattern] = ByteBpe(path, pattern)
    return _models[path, pattern]


def _append(df: DataFrame, out: str, column) -> DataFrame:
    made = free_name(df, "__bpe")
    kept = [f"`{c}`" for c in df.columns if c.lower() != out.lower()]
    return df.withColumn(made, column).select(*kept, F.col(made).alias(out))


def encode_texts(
    df: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    text_col: str = "text",
    out: str = "ids",
    spans: bool = False,
    round_trip: bool = False,
) -> DataFrame:
    """``df`` with a column ``out``: the token ids of each whole text, as a list of integers.

    With ``spans``, ``out`` is a struct of ``ids``, ``starts`` and ``ends``, the
    latter in code points. With ``round_trip`` it is a struct of ``ids`` and
    ``same``, which says whether decoding gives the text back. Null and empty texts have no tokens. Strings of
    special tokens are ordinary text. Repeated rows are encoded row by row; an
    empty table stays empty. A column named ``out`` is replaced, all others stay.
    """
    path = path or vocabulary_path("byte_bpe_multi_50k.tiktoken")
    kind = "array<int>"

    if spans:
        result = f"struct<ids:{kind},starts:{kind},ends:{kind}>"
    else:
        result = f"struct<ids:{kind},same:boolean>" if round_trip else kind

    @F.arrow_udf(result)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = model(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            # some texts at a time: lists of Python numbers are large
            parts = [_list_array(bpe.encode_batch(texts[k : k + CHUNK])) for k in range(0, len(texts), CHUNK)]
            ids = pa.concat_arrays(parts or [_list_array([])])
            if spans:
                places = [bpe.spans(t) for t in texts]
                starts = _list_array([a for a, _ in p] for p in places)
                ends = _list_array([b for _, b in p] for p in places)
                ids = pa.StructArray.from_arrays([ids, starts, ends], ["ids", "starts", "ends"])
            elif round_trip:
                same = pc.equal(bpe.decode_batch(ids), pa.array([t.encode() for t in texts], pa.binary()))
                ids = pa.StructArray.from_arrays([ids, same], ["ids", "same"])
            yield ids

    return _append(df, out, encode(F.col(text_col)))


def decode_ids(
    df: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    ids_col: str = "ids",
    out: str = "decoded",
) -> DataFrame:
    """``df`` with a column ``out``: the bytes that the ids in ``ids_col`` stand for.

    Any list of ids decodes, also one that ends inside a character; the bytes
    need not be valid UTF-8 then. A null list and null ids decode to no bytes; an
    id that the vocabulary has not fails the job.
    """
    path = path or vocabulary_path("byte_bpe_multi_50k.tiktoken")

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = model(path, pattern)
        for lists in batches:
            yield bpe.decode_batch(lists)

    return _append(df, out, decode(F.col(ids_col)))

"""Secret scan, whitening and resampling against plain Python, and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import resampling, secret_scan, whitening
from feedlake.llm.secret_scan import Rule
from llm.conftest import ROWS

# --- secrets ---------------------------------------------------------------------------------


def searched(text, rules=secret_scan.RULES):
    """What the regular expressions of the standard library find."""
    found = []
    for k, rule in enumerate(rules):
        flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
        for m in re.finditer(f"(?:{rule.head})(?P<body>{rule.body})", text, flags):
            if len(m["body"]) >= rule.least:
                found.append((m.start(), k, m.end()))
    return [(rules[k].kind, start, end) for start, k, end in sorted(found)]


PIECES = ["token", "=", ":", " ", "  ", '"', "'", "AKIA", "ASIA", "0123456789abcdef", "deadbeef", "ABCDEFGH", "\n", "é", "日本", "api_key", "ApiKey"]
PIECES += ["PASSWORD", "passwd", "secret", "ghp_", "a" * 36, "xoxb-", "eyJ", ".", "-----BEGIN ", "PRIVATE KEY-----", "RSA ", "x", "AIza", "_", "-"]


@pytest.mark.parametrize("lanes", [1, 7, 2048])
def test_scan_equals_search(monkeypatch, lanes):
    monkeypatch.setattr(secret_scan, "LANES", lanes)
    rng = random.Random(lanes)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 60))) for _ in range(3_000)]
    found = secret_scan.scan([t.encode() for t in texts])
    assert found == [searched(t) for t in texts] and sum(map(len, found)) > 1_000
    # the segments of a scan do not show either
    monkeypatch.setattr(secret_scan, "SEGMENT", 1_000)
    assert secret_scan.scan([t.encode() for t in texts]) == found


def test_a_short_value_uses_up_its_text():
    # the first match is dropped for its length, and nothing inside it counts
    assert secret_scan.scan([b"token=token:abcdefgh1"]) == [[]]
    assert secret_scan.scan([b"Token = 'abcdefgh1'"]) == [[("assign", 0, 18)]]


@pytest.mark.parametrize("text", ["token=" + " " * 300_000 + "abcdefghi", "a" * 300_000, 'token="' * 40_000, "AKIA" * 50_000])
def test_long_runs(text):
    assert secret_scan.scan([text.encode()]) == [searched(text)]


def test_expressions():
    rules = (Rule("x", r"(ab|a)?", r"c{2,3}[x-z]*\."), Rule("y", "", "[0-9]{2}(-[0-9]{2})*"), Rule("z", r"\x41", "b+", 2, True))
    texts = ["abccxyz. acc.cccc. ab", "12-34-5 1 99-", "abbb ABB aB Abb"]
    assert secret_scan.scan([t.encode() for t in texts], rules) == [searched(t, rules) for t in texts]
    small = secret_scan.starts_automaton((Rule("one", "", "aab"), Rule("two", "", "[a]ab")))
    assert len(small.marks) == 4  # equal rules share all their states
    for wrong in ("a(b", "*a", "a)"):
        with pytest.raises(ValueError):
            secret_scan.starts_automaton((Rule("w", "", wrong),))
    with pytest.raises(ValueError):
        secret_scan.starts_automaton((Rule("w", "", "a*"),))


def test_find_secrets(spark, odd, nothing):
    rows = [(1, "key: token=abcdefgh1 end"), (1, "key: token=abcdefgh1 end"), (None, "é AKIA" + "A" * 12), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("secrets", F.lit("mine"))
    got = secret_scan.find_secrets(df)
    assert got.columns == ["doc_id", "text", "secrets"]
    assert sorted(((r.doc_id, r.text), [tuple(s) for s in r.secrets]) for r in got.collect() if r.doc_id != 2 and r.doc_id) == sorted(
        ((i, t), searched(t)) for i, t in rows if i and i != 2
    )
    assert {r.doc_id: len(r.secrets) for r in got.collect()} == {1: 1, None: 1, 2: 0, 3: 0}
    hidden = got.select("doc_id", secret_scan.masked(F.col("text"), F.col("secrets")).alias("m")).collect()
    assert {r.m for r in hidden} == {"key: [assign] end", "é [access]", None, ""}
    assert secret_scan.find_secrets(nothing).count() == 0
    all_kept = secret_scan.find_secrets(odd, out="found")
    assert all_kept.columns == [*odd.columns, "found"]
    assert sorted(map(repr, ([tuple(s) for s in r.found] for r in all_kept.collect()))) == sorted(repr(searched(r[1] or "")) for r in ROWS)


def test_masks_of_overlapping_spans():
    text = "password=" + "0123456789abcdef" * 3
    assert searched(text) == [("assign", 0, 57), ("hex", 9, 57)]


# --- whitening -------------------------------------------------------------------------------


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    matrix = (q * np.asarray(values, float)) @ q.T
    return (matrix + matrix.T) / 2


SPECTRA = [
    list(range(1, 41)),
    list(10.0 ** np.linspace(-6, 9, 30)),
    [5.0] * 6 + [1.0] * 20,
    [3.0, 3.0, 2.0] + [0.0] * 20,
    [7.0],
    [1.0, 1.0 + 1e-9, 1.0 + 2e-9, 2.0, 2.0 + 1e-12],
    [9.0] + [1.0 + k * 1e-7 for k in range(30)],
]


@pytest.mark.parametrize("spectrum", SPECTRA)
def test_components(spectrum):
    matrix = symmetric(spectrum)
    wanted = np.linalg.eigvalsh(matrix)[::-1][:4]
    values, vectors = whitening.top_components(matrix, 4)
    wanted = wanted[wanted > 1e-12 * wanted[0]]
    assert len(values) == len(wanted) and np.allclose(values, wanted, rtol=1e-9, atol=1e-13 * wanted[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-13 * len(matrix) * wanted[0]


def test_inertia():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 30):
        matrix = rng.standard_normal((n, n))
        matrix = matrix + matrix.T
        values = np.linalg.eigvalsh(matrix)
        for shift in (-100.0, -1.0, 0.0, 0.3, 100.0):
            assert whitening.count_below(matrix, shift) == (values < shift).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])  # no pivot on its diagonal
    assert whitening.count_below(swap, 0.0) == 1
    assert whitening.top_intervals(np.zeros((3, 3)), 2) == []


def test_a_missed_eigenvalue_is_noticed():
    with pytest.raises(ArithmeticError):
        whitening.feast(symmetric(range(1, 41)), whitening.Interval(30.5, 41.0, 11))


def test_whitening_equals_numpy(spark, sf_dir):
    from feedlake.llm import queries

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = queries.op12_whitening(spark, sf_dir).collect()
    x = {r.vec_id: [math.floor(256 * c) for c in r.embedding] for r in vectors if r.embedding and all(map(math.isfinite, r.embedding))}
    assert len(rows) == 4 * len(x) and {(r.vec_id, r.component) for r in rows} == {(i, k) for i in x for k in (1, 2, 3, 4)}
    fit = np.array(sorted(set(map(tuple, x.values()))), float)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    centred = fit - np.array(sums) / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    signs = {}
    for r in rows:
        value, direction = values[-r.component], directions[:, -r.component]
        wanted = (np.array(x[r.vec_id]) - np.array(sums) / n) @ direction / value**0.5
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - wanted) < abs(r.whitened + wanted) else -1)
        assert abs(r.whitened - sign * wanted) < 1e-8
        assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
        assert abs(r.explained / (value / np.trace(covariance)) - 1) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0]), (3, None), (4, [1.0, nan]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [2.0]), (8, []), (None, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"whitened": F.lit("x"), "x": F.lit(1)})
    model = whitening.fit_whitening(df)
    distinct = np.array([[256, 512], [768, -256], [512, 0], [0, 0], [128, 64]], float)
    assert model.n == 5 and model.sums == tuple(distinct.sum(0).astype(int)) and len(model.values) == 2
    assert np.allclose(model.values, np.linalg.eigvalsh(np.cov(distinct.T, bias=True))[::-1])
    got = whitening.whiten(df, model, out="x")
    assert got.columns == ["vec_id", "embedding", "whitened", "x"] and got.count() == 6
    assert all(len(r.x.whitened) == 2 and r.x.deviation >= 0 for r in got.collect())
    # no components: one vector, none, or all entries zero-length
    for few in (df.where("vec_id = 1"), df.where("vec_id = 3"), df.where("vec_id = 8"), df.where("1 = 0")):
        model = whitening.fit_whitening(few)
        assert len(model.values) == 0 and all(r.x.whitened == [] for r in whitening.whiten(few, model, out="x").collect())


def test_large_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3e9, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit_whitening(df)
    ends = [[2**63 - 1, 0], [-(2**63), 256], [3 * 10**9 * 256, 1280]]
    assert model.sums == tuple(map(sum, zip(*ends)))
    assert [r.whitened.deviation for r in whitening.whiten(df, model).collect()] == [None] * 3
    near = spark.createDataFrame([(1, [1e6, 0.0]), (2, [1e6 + 1, 3.0])], "vec_id long, embedding array<double>")
    model = whitening.fit_whitening(near)
    assert [r.whitened.deviation for r in whitening.whiten(near, model).collect()] == [256**2 + 768**2] * 2


# --- resampling ------------------------------------------------------------------------------


def ngrams(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def drawn(rows, target, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, t in rows for f in ngrams(t, longest)[1])
    t = Counter(bucket(f) for text in target for f in ngrams(text, longest)[1])
    of_s, of_t = sum(s.values()), sum(t.values())
    scored = []
    for doc_id, text in rows:
        words, features = ngrams(text, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (of_s + buckets) / ((s[b] + 1) * (of_t + buckets)))) for b in map(bucket, features)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([doc_id, len(words), len(features), weight, score, None])
    able = sorted((r for r in scored if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, scored), key=repr)


@pytest.mark.parametrize("longest, buckets, percent, least", [(1, 10_000, 10, 20), (2, 10_000, 50, 1), (3, 37, 100, 0), (1, 1, 60, 5)])
def test_resample(spark, odd, longest, buckets, percent, least):
    target = ["The old stone bridge", None, "", "people walk: THE river!", "日本語 word"]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(odd, table, longest=longest, buckets=buckets, percent=percent, least_words=least).collect()
    assert sorted(map(tuple, got), key=repr) == drawn([r[:2] for r in ROWS], target, longest, buckets, percent, least)


def test_resample_without_rows(spark, odd, nothing):
    empty = nothing.select("text")
    assert resampling.resample(nothing, empty).count() == 0
    got = resampling.resample(odd, empty, percent=100, least_words=0).collect()
    assert sorted(map(tuple, got), key=repr) == drawn([r[:2] for r in ROWS], [], percent=100, least_words=0)


def test_portions_do_not_show(monkeypatch):
    import pyarrow as pa

    from feedlake.llm.common import slices

    texts = pa.array(["ab", None, "", "abcd" * 10, "x", "日本"])
    for size in (1, 3, 1_000):
        parts = list(slices(texts, size))
        assert pa.concat_arrays(parts).equals(texts) and (size < 1_000 or len(parts) == 1)
    assert list(slices(texts[:0], 5)) == []

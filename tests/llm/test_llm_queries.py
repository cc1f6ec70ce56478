"""The registered queries against their SQL, brute force, round trips and held-out labels."""

import base64
import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from feedlake.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def docs(duck):
    return {i: t or "" for i, t in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()}


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    known = {}

    def get(name):
        if name not in known:
            known[name] = queries.QUERIES[name](spark, sf_dir).collect()
        return known[name]

    return get


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_all_are_registered():
    names = contract.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(duck, result, name):
    wanted = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in wanted.description]
    want = sorted((tuple(r) for r in wanted.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in result(name)), key=repr) == want


def test_op1_held_out(duck, docs, result):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = result("op1_language_id")
    assert len(rows) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op2_edited_texts_and_likeness(docs, result):
    rows, ids = {r.doc_id: r for r in result("op2_fingerprints")}, list(docs)
    prints = {}
    for k, i in enumerate(ids):
        text, following = docs[i], docs[ids[(k + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(text), sha(edited))
        prints.setdefault(text, set()).add(rows[i].fingerprint)

        def parts(fingerprint):
            digits = fingerprint.partition(":")[2]
            return {digits[j : j + 8] for j in range(0, len(digits), 8)}

        a, b = parts(rows[i].fingerprint), parts(rows[i].edited_fingerprint)
        assert rows[i].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r.near_edited for r in rows.values()) > 10 * sum(r.near_next for r in rows.values())


def test_op3_and_op4_as_the_libraries(docs, result):
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    counts, coded = {r.doc_id: r for r in result("op3_token_counts")}, {r.doc_id: r for r in result("op4_byte_bpe")}
    for i, text in docs.items():
        n = len(pieces.encode(text))
        assert (counts[i].n_tokens, counts[i].n_bytes, counts[i].over_limit) == (n, len(text.encode()), n > 4096)
        ids = encoding.encode_ordinary(text)
        assert coded[i].n_tokens == len(ids) and coded[i].ids_sha256 == sha(",".join(map(str, ids)))
        assert coded[i].decoded_sha256 == sha(text)


def test_op5_scores(result, docs):
    rows = result("op5_toxicity")
    assert len(rows) == len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_op6_replaces_what_it_finds_and_nothing_else(docs, result):
    personal = re.compile(r"[\w.+-]+@[\w.-]+\.\w+|\d{1,3}(?:\.\d{1,3}){3}|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}|(?i:password=\w+|token = \"\w+\")|AKIA\w+")
    made = {}
    for r in result("op6_surrogates"):
        old, new = personal.findall(docs[r.doc_id]), personal.findall(r.text)
        assert personal.sub("", docs[r.doc_id]) == personal.sub("", r.text) and len(old) == len(new) == r.n_entities
        for a, b in zip(old, new, strict=True):
            assert a != b and len(re.findall(r"\d", a)) > 0 and made.setdefault(a, b) == b
    assert len(set(made.values())) == len(made) and not set(made) & set(made.values())


def test_op8_measures(docs, result):
    for r in result("op8_quality"):
        text = docs[r.doc_id]
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        often = Counter(windows)
        covered = {j for k, w in enumerate(windows) if often[w] > 1 for j in (k, k + 1, k + 2)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r.base_failed == failed and not (failed and r.kept)


def components(docs, size):
    """Brute force over all pairs: the set sizes and the smallest id of each component."""
    sets = {}
    for i, text in docs.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
        n = min(size, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets.items():
        for k, b in sets.items():
            if k < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = root(i), root(k)
                parent[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_op9_brute_force(docs, result):
    wanted = components(docs, 2)
    rows = result("op9_minhash")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_stages_brute_force(spark, sf_dir, docs):
    """Each stage on the documents: what it drops, changes and repeats."""
    stages = dict(corpus_pipeline.STAGES)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in stages["near_duplicates"](spark, table, sf_dir).collect()}
    assert kept == {i for i, (_, c) in components(docs, 5).items() if i == c}
    changed = stages["personal_data"](spark, table, sf_dir).collect()
    assert {r.doc_id for r in changed} == set(docs) and all(r.n_chars == len(r.text) for r in changed)
    taken = Counter(r.doc_id for r in stages["mixture"](spark, table, sf_dir).select("doc_id").collect())
    mixed = {r.doc_id: r.copies for r in queries.QUERIES["op7_mixture"](spark, sf_dir).collect()}
    assert taken == Counter({i: n for i, n in mixed.items() if n})
    coded = stages["byte_bpe"](spark, table, sf_dir).collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in coded) and len(coded) == len(docs)

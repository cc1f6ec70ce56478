"""Every operator and stage on nulls, empty, long, repeated and foreign texts, clashing columns and empty tables."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import byte_bpe, chat, language_id, minhash, mixture, quality, spotsigs, surrogates, token_counts, toxicity
from feedlake.llm.common import count_words

import corpus_pipeline
from llm.conftest import PROSE, ROWS

TEXTS = {(r[0], r[1]) for r in ROWS}


def by_text(rows, column):
    return {(r.doc_id, r.text): r[column] for r in rows}


def test_language_id(odd, nothing):
    model = language_id.fit_languages(odd)
    got = language_id.identify_languages(odd, model).collect()
    assert len(got) == len(ROWS) and got[0].asDict().keys() == {*odd.columns, "language"}
    for r in got:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.language.lang == "und") == (not letters) and 0 <= r.language.score <= 1
    assert language_id.identify_languages(nothing, language_id.fit_languages(nothing)).count() == 0
    assert {r.language.lang for r in language_id.identify_languages(odd, language_id.fit_languages(nothing)).collect()} == {"und"}


def test_codewords_are_apart():
    for count in (2, 3, 4, 6, 12):
        code = language_id.codewords(count)
        assert code.shape[0] == count and language_id.min_distance(code) >= (1 if count == 2 else 2)
    assert language_id.codewords(1).shape == (1, 0)


def test_spotsigs(odd, nothing):
    got = spotsigs.fingerprints_with_next(odd).collect()
    assert len(got) == len(ROWS)
    for r in got:
        n = len(r.text)
        assert r.n_chars == n and r.edited[: n - n // 4] == r.text[: n - n // 4] and len(r.edited) <= n
    prints = {}
    for r in got:
        prints.setdefault(r.text, set()).add(tuple(r.signatures))
    assert all(len(p) == 1 for p in prints.values())
    assert prints[""] == {()}
    assert spotsigs.fingerprints_with_next(nothing).count() == 0
    one = odd.where("doc_id = 7")
    assert [r.edited for r in spotsigs.fingerprints_with_next(one).collect()] == ["worw"]


def test_spotsigs_links(spark, odd, nothing):
    def text(numbers):
        return " ".join(f"the w{k} v{k}" for k in numbers)

    texts = {1: text(range(40)), 2: text([*range(39), 99]), 3: text(range(40, 80)), 4: text(range(30)), 5: text(range(40))}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    links = {(r.a, r.b): round(r.similarity, 6) for r in spotsigs.near_links(df).collect()}
    assert links == {(1, 2): round(39 / 41, 6)}
    links = {(r.a, r.b) for r in spotsigs.near_links(df, limit=0.7).collect()}
    assert links == {(1, 2), (1, 4), (2, 4)}
    assert all(r.a < r.b for r in spotsigs.near_links(odd, limit=0.5).collect())
    assert spotsigs.near_links(nothing).count() == 0


def test_token_counts(odd, nothing):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path("piece_bpe_32k.model"))
    for sample in (1, 2_000):
        got = token_counts.count_tokens(odd, sample=sample).collect()
        assert len(got) == len(ROWS)
        assert all(r.n_tokens == len(library.encode(r.text or "")) for r in got)
    assert token_counts.count_tokens(nothing).count() == 0


def test_byte_bpe(odd, nothing):
    got = byte_bpe.decode_ids(byte_bpe.encode_texts(odd)).collect()
    assert len(got) == len(ROWS)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in got)
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(nothing)).count() == 0
    placed = byte_bpe.encode_texts(odd.where("doc_id = 12"), spans=True).first()
    assert len(placed.ids.ids) == len(placed.ids.starts) == len(placed.ids.ends)
    assert placed.ids.starts[0] == 0 and placed.ids.ends[-1] == len(placed.text)


def test_toxicity(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 0), (2, 0), (8, 1), (8, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    for rows in (labels, labels.where("toxic = 0"), labels.where("1 = 0")):
        model = toxicity.fit_toxicity(odd, rows)
        got = toxicity.score_toxicity(odd, model).collect()
        assert len(got) == len(ROWS) and all(0 <= r.toxicity <= 1 for r in got)
        assert len({r.toxicity for r in got if r.text in (None, "", " \n\t ")}) == 1
    assert toxicity.score_toxicity(nothing, toxicity.fit_toxicity(nothing, labels)).count() == 0


def test_surrogates(odd, nothing):
    got = surrogates.replace_entities(odd, "k", found_col="found").collect()
    assert len(got) == len(ROWS)
    changed = [r for r in got if r.found]
    assert [r.doc_id for r in changed] == [11]
    first, phone, second = (f.surrogate for f in changed[0].found)
    # one address in two spellings is one person
    assert first == second and "ana" not in changed[0].text.lower() and phone.startswith("+1 (")
    assert {(r.doc_id, r.text) for r in got if not r.found} == {x for x in TEXTS if x[0] != 11}
    assert surrogates.replace_entities(nothing, "k").count() == 0


PERSONS = [
    "Mr Smith",
    "Mr John Paul Smith",
    "Mr John F. Kennedy",
    "Mr. J. R. R. Tolkien",
    "Mr J.-P. Sartre",
    "Mr Harry S Truman",
    "Mr J. Smith",
    "Señora María García López",
    "Señora María de la Cruz",
    "Herr von Braun",
    "Frau Anna von der Leyen",
    "Mr Vincent van den Berg",
    "Mr O’Brien",
    "Mr Jean d'Alembert",
    "Frau Dr. Weber",
    "господин Иван Петрович Сидоров",
]


def test_all_words_of_a_person_are_replaced(spark):
    df = spark.createDataFrame([(k, f"then {p} left.") for k, p in enumerate(PERSONS)], "doc_id long, text string")
    for r in surrogates.replace_entities(df, "k", found_col="found").collect():
        assert [f.kind for f in r.found] == ["person"] and r.text == f"then {r.found[0].surrogate} left."
        old, new = PERSONS[r.doc_id].split(), r.found[0].surrogate.split()
        assert len(old) == len(new) and old[0] == new[0]
        for a, b in zip(old[1:], new[1:], strict=True):
            assert (a == b) == a.islower() or len(a) <= 2 and b[1:] == a[1:]


def test_persons_end_where_their_names_end(spark):
    texts = ["Mr Smith. The end", "Mr Smith and Mrs Lee", "Herr Braun den Brief", "Mr Smith, John", "Frau Lang der Firma"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [e.entity for e in r.e] for r in df.select("doc_id", surrogates.detect(F.col("text")).alias("e")).collect()}
    assert got == {0: ["Mr Smith"], 1: ["Mr Smith", "Mrs Lee"], 2: ["Herr Braun"], 3: ["Mr Smith"], 4: ["Frau Lang"]}


def test_a_family_keeps_its_surrogate(spark):
    texts = ["Mr Smith", "Mr John Smith", "Mr John Paul Smith", "Mrs A. B. Smith", "Mr John von Smith"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in surrogates.replace_entities(df, "k").collect()]
    assert len(set(got)) == len(texts) and len({t.split()[-1] for t in got}) == 1


def test_the_hint_loses_no_entity(spark):
    keys = ["AKIA" + "ABCDEFGHIJKLMNOP", "ASIA" + "QRSTUVWXYZABCDEF", "ghp_" + "a" * 36, "sk-" + "b" * 20]
    texts = [*keys, "pwd=abcd", "ana@example.org", "Mr Smith", "nothing"]
    df = spark.createDataFrame([(f"it is {t}",) for t in texts], "text string")
    whole = F.regexp_extract_all("text", F.lit(surrogates.ENTITY), F.lit(0))
    got = df.select("text", surrogates.detect(F.col("text"))["entity"].alias("hinted"), whole.alias("whole")).collect()
    assert all(r.hinted == r.whole == ([] if "nothing" in r.text else [r.text[6:]]) for r in got)


def test_surrogates_do_not_collide(spark):
    texts = [(k, f"call Mrs {chr(65 + k % 26)}a{chr(97 + k // 26)}i Zed or {k % 10}.{k // 10 % 10}.{k // 100}.1 pwd={k:04d}") for k in range(150)]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    got = surrogates.replace_entities(df, "k", found_col="found").collect()
    assert {tuple(f.kind for f in r.found) for r in got} == {("person", "ip", "secret")}
    for k, distinct in ((0, 150), (1, 150), (2, 150)):
        made = [r.found[k].surrogate for r in got]
        assert len(set(made)) == distinct
        assert not {m for m in made} & {w for _, t in texts for w in t.split()}
    assert len({r.found[0].surrogate.split()[-1] for r in got}) == 1  # one family


#: Texts that once overflowed the stack of the regular expressions, or repeat what loops of theirs take.
REPEATED = [
    ("x@" + "a." * 20_000 + "!", []),
    ("Mr " + "von " * 20_000 + "X", None),
    ("Mr " + "J." * 20_000 + " Smith", None),
    ("Mr " + "Al " * 20_000, None),
    ("Mr A" + "’B" * 20_000, None),
    ("Mr A " + "de " * 20_000 + "é", None),
    ("pwd=" + "k" * 20_000, ["secret"]),
    ("a" * 20_000 + "@example.org", ["email"]),
    ("a." * 20_000 + "@b", []),
    ("AKIA" * 20_000, []),
    ("sk-" + "b" * 20_000, ["access_key"]),
    ("1." * 20_000, []),
    ("1a:" * 20_000, []),
    ("DE89" + " 3704" * 20_000, None),
    ("123-45-" * 20_000, None),
    ("+1" + " 555" * 20_000, None),
    ("4" * 20_000, []),
    ("4 " * 20_000, None),
    ("Frau Dr. " * 20_000, None),
]


def test_long_repeats_do_not_overflow(spark):
    few = [(k, t + "\n\nand ana@example.org") for k, (t, _) in enumerate(REPEATED) if not t.startswith(("DE", "123", "+1", "4 "))]
    df = spark.createDataFrame(few, "doc_id long, text string")
    for r in surrogates.replace_entities(df, "k", found_col="found").collect():
        kinds, wanted = [f.kind for f in r.found], REPEATED[r.doc_id][1]
        assert kinds[-1] == "email" and "ana@" not in r.text[-30:]
        if wanted is not None:
            assert kinds[:-1] == wanted and (wanted or r.text.startswith(REPEATED[r.doc_id][0]))


def test_long_repeats_of_each_pattern(spark):
    df = spark.createDataFrame([(t,) for t, _ in REPEATED], "text string")
    parts = [F.size(F.split("text", p)) - F.regexp_count("text", F.lit(p)) for p in surrogates.PATTERNS.values()]
    assert all(set(r) == {1} for r in df.select(*[c.alias(k) for k, c in zip(surrogates.PATTERNS, parts, strict=True)]).collect())


SPELLINGS = {
    "MR JOHN SMITH": "person",
    "Mr\u00a0Lee": "person",
    "Mr  John   Lee": "person",
    "Frau Anna\nvon der Leyen": "person",
    "Dr. Mary Jones": "person",
    "Dr Jones": "person",
    "2001:db8:0:1:1:1:1:1": "ipv6",
    "2001:DB8::FF00:42": "ipv6",
    "fe80::1:2": "ipv6",
    "o'neil@example.org": "email",
}


def test_spellings(spark):
    df = spark.createDataFrame([(f"then {t}, it left.",) for t in SPELLINGS], "text string")
    for (text, kind), r in zip(SPELLINGS.items(), surrogates.replace_entities(df, "k", found_col="found").collect(), strict=True):
        assert [f.kind for f in r.found] == [kind] and r.text == f"then {r.found[0].surrogate}, it left."
        made = r.found[0].surrogate
        assert made != text and [c for c in made if not c.isalnum()] == [c for c in text if not c.isalnum()] or kind == "email" and "neil" not in made
        assert made.isupper() == text.isupper()


def test_surrogates_of_one_name_in_capitals(spark):
    df = spark.createDataFrame([("Mr John Smith",), ("MR JOHN SMITH",), ("Mr\u00a0John Smith",)], "text string")
    plain, capitals, spaced = (r.text for r in surrogates.replace_entities(df, "k").collect())
    assert plain.upper() == capitals and spaced.replace("\u00a0", " ") == plain


def iban_rest(iban):
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_ibans_stay_as_valid_as_they_were(spark):
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606", "DE00 3704 0044 0532 0130 00"]
    df = spark.createDataFrame([(f"to {i} now",) for i in ibans], "text string")
    for old, r in zip(ibans, surrogates.replace_entities(df, "k", found_col="found").collect(), strict=True):
        new = r.found[0].surrogate
        assert r.found[0].kind == "iban" and new[:2] == old[:2] and new != old
        assert (iban_rest(new) == 1) == (iban_rest(old) == 1)


def test_a_small_format_is_used_up_before_it_grows(spark):
    """26 one-letter addresses of a domain, and more secrets of one digit than there are digits that are no secrets."""
    letters = [f"{c}@example.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    secrets = [f"pwd=***{n}" for n in range(6)]
    df = spark.createDataFrame([(t,) for t in letters + secrets], "text string")
    got = [r.text for r in surrogates.replace_entities(df, "k").collect()]
    assert len(set(got)) == len(got) and not set(got) & set(letters + secrets)
    mails, made = got[:26], got[26:]
    assert len({m.split("@")[1] for m in mails}) == 1 and sorted(m.split("@")[0] for m in mails) == sorted("abcdefghijklmnopqrstuvwxyz")
    # the four digits left are all used, and only two secrets grow
    assert sorted(m for m in made if len(m) == len(secrets[0])) == [f"pwd=***{n}" for n in range(6, 10)]
    assert all(m.startswith("pwd=***") for m in made)


def test_mixture(odd, nothing):
    got = mixture.mix(odd, count_words(F.col("text"))).collect()
    assert len(got) == len(ROWS)
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(sum(r.size for r in got))
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size and r.target <= 3 * r.source_size + 1e-6
        assert (r.source_size > 0) or r.copies == 0
    assert mixture.mix(nothing, count_words(F.col("text"))).count() == 0
    assert mixture.mixed_documents(odd, count_words(F.col("text"))).count() == sum(r.copies for r in got)


def test_quality(odd, nothing):
    got = quality.judge_quality(odd).collect()
    assert len(got) == len(ROWS) and all(0 <= r.probability <= 1 for r in got)
    assert quality.judge_quality(nothing).count() == 0
    long = next(r for r in got if r.n_words == 1_500 * len(PROSE.split()))
    assert long.n_repeat_words == long.n_words


def test_minhash(odd, nothing):
    for size in (2, 5):
        got = minhash.near_duplicates(odd, size=size).collect()
        assert len(got) == len(ROWS)
        of = {r.doc_id: r.component_id for r in got}
        assert of[1] == of[2] == of[3] == 1 and of[4] == 4 and of[5] == 5 and of[6] == 6 and of[8] == 8
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
        assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert minhash.near_duplicates(nothing).count() == 0


def test_an_id_with_several_texts_is_one_document(spark):
    one, two, three = ("x y z " * 9 + "a", "k l m " * 9 + "b", "p q r " * 9 + "c")
    df = spark.createDataFrame([(3, two), (8, one), (8, two), (9, one), (5, three), (5, ""), (7, "")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles > 0): (r.component_id, r.kept) for r in minhash.near_duplicates(df, size=2).collect()}
    assert got == {(3, True): (3, True), (8, True): (3, False), (9, True): (3, False), (5, True): (5, True), (5, False): (5, True), (7, False): (7, True)}


@pytest.mark.parametrize("few", [0, 1 << 18])
def test_components(spark, few):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2)) if a != b] + [(k, k + 1) for k in range(1_000, 1_100)]
    wanted = {n: n for link in links for n in link}
    for _ in wanted:
        for a, b in links:
            wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    got = minhash.components(spark.createDataFrame(links, "a long, b long"), few)
    assert {r.node: r.component for r in got.collect()} == wanted
    assert minhash.components(spark.createDataFrame([], "a long, b long"), few).count() == 0


def test_a_pair_at_the_limit_is_hardly_ever_under_the_floor():
    floor, chance, n = minhash.estimate_floor(0.8), 2.0**-minhash.LOW_BITS, minhash.HASHES
    equal = 0.8 + 0.2 * chance
    lost = [k for k in range(n + 1) if (k / n - chance) / (1 - chance) < floor]
    assert sum(math.comb(n, k) * equal**k * (1 - equal) ** (n - k) for k in lost) < 5e-8


def test_chat(spark):
    turns = [
        (1, 1, "assistant", "\\### a </turn>\n### user:\n b\\"),
        (1, 0, "us:\ner", "q"),
        (1, 0, "us:\ner", "q"),
        (2, 0, None, None),
        (2, None, "assistant", ""),
        (None, 0, "assistant", "x" * 50_000 + "<" * 5_000),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("x"))
    got = {r.conv_id: r for r in chat.read_chats(chat.format_chats(chat.turns_of_table(df))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("us:\ner", "q"), ("us:\ner", "q"), ("assistant", turns[0][3])]
    assert got[1].loss_texts == [turns[0][3]]
    assert [(t.role, t.text) for t in got[2].turns] == [("assistant", ""), ("", "")]
    assert got[None].loss_texts == [turns[5][3]]
    assert chat.format_chats(df.where("1 = 0")).count() == 0
    with pytest.raises(ValueError):
        chat.turns_of_table(spark.range(1))


def test_chat_layouts(spark):
    records = [
        (1, '{"messages": [{"role": "User", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3}'),
        (2, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'),
        (3, '{"prompt": "q", "completion": "a"}'),
        (4, '{"prompt": "q", "response": "a"}'),
        (5, '{"instruction": "i", "input": "", "output": "a"}'),
        (6, '{"instruction": "q", "output": "a"}'),
        (7, '{"other": 1}'),
        (8, "no json"),
        (9, None),
    ]
    df = spark.createDataFrame(records, "conv_id long, record string")
    got = {}
    for r in chat.turns_of_records(df, "record").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    pair = [("user", "q"), ("assistant", "a")]
    assert got == {1: pair, 2: pair, 3: pair, 4: pair, 5: [("system", "i"), ("assistant", "a")], 6: pair}
    layouts = {r.conv_id: r.layout for r in chat.record_layouts(df, "record").collect()}
    assert layouts[1] == "messages" and layouts[7] is layouts[8] is layouts[9] is None


def test_chat_records_with_fields_of_several_layouts(spark):
    records = [
        (1, '{"prompt": "other", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "system": "s"}'),
        (2, '{"messages": []}'),
        (3, '{"question": "q", "answer": "a", "system": "s"}'),
        (4, '{"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]}'),
        (5, '{"messages": [], "prompt": "q", "completion": "a"}'),
        (6, None),
    ]
    df = spark.createDataFrame(records, "conv_id long, record string")
    got = {}
    for r in chat.turns_of_records(df, "record", keep_unmatched=True).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.turn, r.role, r.text))
    pair = [("user", "q"), ("assistant", "a")]
    assert got == {
        1: [("messages", k, *t) for k, t in enumerate(pair)],
        2: [(None, None, None, None)],
        3: [("question_answer", k, *t) for k, t in enumerate([("system", "s"), *pair])],
        4: [("messages", k, *t) for k, t in enumerate([("user", None), ("assistant", "a")])],
        5: [("prompt_completion", k, *t) for k, t in enumerate(pair)],
        6: [(None, None, None, None)],
    }


def test_chat_tables_are_told_by_their_fingerprint(spark):
    rows = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, 'q' AS text, 'x' AS extra")
    lists = spark.sql("SELECT 1L AS conv_id, array(named_struct('role', 'Human', 'content', 'q', 'n', 1)) AS messages, 2 AS turn")
    for df in (rows, lists):
        assert [tuple(r) for r in chat.turns_of_table(df).collect()] == [(1, 0, "user", "q")]
    paths = ["a", "b[].c"]
    assert chat._path_hash(frozenset(paths)) == spark.range(1).select(chat.fingerprint(F.array(*map(F.lit, paths)))).first()[0]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, odd, nothing, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, sf_dir)
    rows = got.collect()
    assert rows
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == odd.columns
    if name == "near_duplicates":
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert len(ids) == len(set(ids)) and {1, 4, 5, 6, 7, 8, 9, 11, 12} == set(ids)
        # document 10 repeats document 1: 17 of its 21 distinct shingles are those of that text
        assert 17 / 21 >= corpus_pipeline.SIMILARITY
    assert stage(spark, nothing, sf_dir).count() == 0


def test_digest_of_ids():
    bpe = byte_bpe.model(byte_bpe.vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encode("naïve 😀")
    assert bpe.decode(ids) == "naïve 😀".encode() and hashlib.sha256(bpe.decode(ids[:-1])).hexdigest()

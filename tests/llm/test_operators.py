"""The numbered operators against brute force, round trips and hand-made cases."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import bpe, chat, decision_list, decontamination, langid, rule_ensemble, simhash, statistics, substrings
from ledgerline.llm import token_counts, warc
from ledgerline.llm.fmindex import FMIndex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
DATA = "/root/testdata/sf0.001"


def docs_of(spark, texts, start=0):
    rows = [(i + start, text, "x", 1) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, n_words int").repartition(3)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(3)]
    texts = [None, "", " \n ", "a", "a b c", "a " * 500, "x y " * 300, "é ü " * 30, "A. B!\nA. B!\n", "😀\x00 z"]
    for _ in range(120):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(passages)[rng.randint(0, 20) :], "b " * rng.randint(0, 40)]
        texts.append("\n".join(rng.sample(parts, 3)))
    return texts + texts[20:30]


# ---------------------------------------------------------------- 1: chat


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, kind string, message_id string, role string, text string")


def folded(spark, rows):
    found = chat.messages(events(spark, rows)).collect()
    return sorted((r.conv_id, r.turn, r.role, r.text) for r in found)


def test_chat_folds_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "message", "a", "user", "Hi"), (1, 2, "message", "b", "assistant", ""), (1, 3, "delta", "b", None, "He"),
        (1, 4, "delta", "b", None, "llo"), (1, 5, "message", "c", "user", "later"), (1, 6, "regenerate", "b", None, None),
        (1, 7, "delta", "b", None, "Good "), (1, 8, "delta", "b", None, "day"), (1, 9, "message", "d", "user", "Bye"),
        (1, 10, "edit", "a", None, "Hello"), (1, 11, "unknown", "a", None, "no"), (2, 1, "delta", "z", "user", "open"),
    ]
    expected = [(1, 0, "user", "Hello"), (1, 1, "assistant", "Good day"), (1, 2, "user", "Bye"), (2, 0, "user", "open")]
    random.Random(1).shuffle(rows)
    assert folded(spark, rows) == expected


def test_chat_nulls_ties_and_empty_logs(spark):
    rows = [(None, None, "message", None, None, None), (1, 1, "message", None, "user", "b"), (1, 1, "message", None, "user", "a")]
    rows += [(1, 1, "message", None, "user", "a")]
    found = chat.messages(events(spark, rows)).collect()
    assert sorted(((r.conv_id or 0), r.turn, r.role, r.text) for r in found) == [(0, 0, "", ""), (1, 0, "user", "a"), (1, 1, "user", "a"), (1, 2, "user", "b")]
    assert chat.render(chat.messages(events(spark, []))).count() == 0


def test_chat_reads_back_what_it_rendered(spark):
    texts = ["\\### Assistant: </turn> ok", "<turn role=user>\\b\\l\\g", "", "\\", "é😀\n", "</turn>\n" * 3, "<" * 2000]
    rows = [(7, i, "message", None, "assistant" if i % 2 else "us>er\\", text) for i, text in enumerate(texts)]
    row = chat.parse(chat.render(chat.messages(events(spark, rows)))).first()
    assert [t.text for t in row.turns] == texts
    assert {t.role for t in row.turns} == {"assistant", "us>er\\"}
    assert row.loss_text == "".join(texts[1::2])
    for span in row.loss_spans:
        masked = row.formatted[span.start : span.start + span.length]
        assert masked.replace("\\l", "<").replace("\\b", "\\") == texts[span.turn]


# ---------------------------------------------------------------- 2: decontamination


def test_decontamination_finds_reparameterised_questions(spark):
    question = "A farmer sells 12 apples and 7 pears to Maria for 3 dollars each day, how much does Maria pay?"
    changed = "so a farmer sells 55 apples and 8 pears to Peter for 9 euros each day, how much does Peter pay? yes"
    mixed = "A farmer sells 55 apples and 8 pears to Peter for 9 euros each day, how much does Quentin pay?"
    texts = [None, "", question.upper().lower(), changed, mixed, "A farmer sells pears " * 20, "intro words " * 9 + question]
    docs = docs_of(spark, texts)
    items = spark.createDataFrame([(5, question), (3, question), (9, None), (8, ""), (1, "Is it so?")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert found >= {(3, 3), (6, 3)} and {d for d, _ in found} <= {2, 3, 4, 6}
    # The whole of the mixed one is not consistent: one value of the item stands against two.
    whole = decontamination.matches(decontamination.keyed(docs, "doc_id", "text"), items)
    assert whole.filter("did = 4").count() == 0
    left = decontamination.clean(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} >= {0, 1, 4, 5}
    assert decontamination.clean(docs.limit(0), items).count() == 0
    assert decontamination.clean(docs, items.limit(0)).count() == len(texts)


def test_decontamination_finds_every_verbatim_item(spark):
    docs, items = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    listed = items.collect()
    expected = {(d.doc_id, i.item_id) for d in docs.collect() for i in listed if i.text in d.text and len(i.text.split()) > 8}
    assert expected and expected <= found


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def leaks(spark, texts, items):
    docs, items = docs_of(spark, texts), items_of(spark, items)
    found = {(r.doc_id, r.item_id): r.n_windows for r in decontamination.contaminated(docs, items).collect()}
    return found, {r.doc_id for r in decontamination.clean(docs, items).collect()}


def test_decontamination_drops_only_windows_that_conflict(spark):
    rng = random.Random(9)
    words = [f"word{rng.choice('abcdefgh')}{rng.choice('klmnop')}" for _ in range(60)]
    words[10] = words[45] = "12"
    changed = [*words[:45], "15", *words[46:]]
    apples = "A farmer sells 3 apples and 5 pears at the market every day, how much fruit does he sell?"
    equal = "A farmer sells 4 apples and 4 pears at the market every day, how much fruit does he sell?"
    names = "{} met a friend and {} saw the old house while {} took a picture of the garden and {} went back home"
    named = "so " + names.format(*["Maria"] * 4)
    other = "so " + names.format("Peter", "Peter", "Paula", "Peter")
    texts = [" ".join(changed), equal, other, "so " + names.format("Peter", "Paula", "Quentin", "Rosa")]
    found, left = leaks(spark, texts, [" ".join(words), apples, named])
    assert set(found) == {(0, 0), (1, 1), (2, 2)} and left == {3}
    assert found[0, 0] == 53 - 8  # of the windows with the second '12', none


def test_decontamination_finds_short_and_numeric_items(spark):
    items = ["What is 17 + 25 - 4 * 6?", "Is 91 prime?", "What is the capital of France?", "12 + 30 = 42", "1 2 3 4 5 6 7 8 9 10 11"]
    frames = ["Q: 1) {} A: none", "they said \u201c{}\u201d and left", "{}", "Some Words Before {} and after", "NOTE {}"]
    texts = [frame.format(item) for item in items for frame in frames]
    found, left = leaks(spark, [*texts, "no item is here 17 or 25"], items)
    assert {(i, i // len(frames)) for i in range(len(texts))} <= set(found)
    assert left == {len(texts)}


def test_decontamination_finds_every_short_verbatim_item(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(300).collect()
    rng = random.Random(10)
    items = []
    for row in rows[:60]:
        words, size = row.text.split(), rng.randint(3, 12)
        at = rng.randint(0, max(0, len(words) - size))
        items.append(" ".join(words[at : at + size]))
    items = sorted(set(items))
    found, _ = leaks(spark, [r.text for r in rows], items)
    core = re.compile(r"[0-9A-Za-z$%\u0080-\U0010ffff]")
    spread = [" ".join(r.text.split()) for r in rows]
    expected = {(d, i) for d, text in enumerate(spread) for i, item in enumerate(items) if core.search(item) and f" {item} " in f" {text} "}
    assert len(expected) >= 50 and expected <= set(found)


def test_clean_keeps_documents_that_share_one_template_window(spark):
    short = "der Vertrag zwischen der Gemeinde und dem Land"
    long = "Wer hat gesagt, der Vertrag zwischen der Gemeinde und dem Land sei nach so vielen Jahren noch immer nicht bezahlt?"
    page = "und so begann der Streit zwischen der Stadt und dem Kreis, der bis heute dauert"
    inserted = " ".join(w + " (oh)" * (i == 11) for i, w in enumerate(long.split()))
    other = long.replace("Gemeinde", "Firma").replace("Land", "Amt")
    half = " ".join(long.split()[:12])
    found, left = leaks(spark, [page, f"so {short} auch", inserted, other, half, page + " x" * 80 + page], [short, long])
    assert {(0, 0), (0, 1)} <= set(found)
    assert left == {0, 5}


# ---------------------------------------------------------------- 3: language


def test_langid_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.classify(docs, langid.dictionaries(docs)).filter("held_out")
    judged = found.join(docs.select("doc_id", "lang"), "doc_id").filter("lang_pred <> 'und'").collect()
    assert np.mean([r.lang == r.lang_pred for r in judged]) > 0.95
    assert all(0 <= r.score <= 1 for r in judged)


def test_langid_odd_texts(spark):
    docs = docs_of(spark, [None, "", "12 !!", "the", "x " * 50_000])
    found = {r.doc_id: r for r in langid.classify(docs, {"en": b"the text is here", "de": b"der Text ist hier"}).collect()}
    assert [found[i].lang_pred for i in range(3)] == ["und"] * 3 and found[3].lang_pred in ("en", "de")
    assert {r.lang_pred for r in langid.classify(docs, {}).collect()} == {"und"}
    assert langid.dictionaries(docs.withColumn("lang", F.lit(None).cast("string"))) == {}


# ---------------------------------------------------------------- 4 and 6: tokens


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, encoding, odd_texts):
    texts = [*odd_texts, " ", "  a  b ", "x y  z", "don't I'LL we've", "ab" * 3000, "    \n  \t  hi", "a\x1c b\x1c\x1c c", "<|endoftext|>", " \x85 x", "1234 ##!! _a"]
    docs = docs_of(spark, texts)
    outputs = ("ids", "ids_sha256", "decoded", "decoded_sha256")
    for row in bpe.encode(docs, PATH, PATTERN, outputs).collect():
        text = texts[row.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        assert (row.n_tokens, row.ids) == (len(ids), ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert bytes(row.decoded) == text.encode() and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    tokens = bpe.encode(docs, PATH, PATTERN)
    assert {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(tokens, PATH, PATTERN).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_long_words_contract_in_the_same_order(encoding):
    codec = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
    rng = random.Random(2)
    for _ in range(20):
        word = "".join(rng.choices("abcdeiounst", k=700)).encode()
        assert codec._contract_long(word) == encoding._encode_single_piece(word)


def test_token_counts(spark, encoding, odd_texts):
    lengths = [len(encoding.encode_ordinary(text or "")) for text in odd_texts]
    docs = docs_of(spark, odd_texts)
    sums = token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(docs, PATH, PATTERN)))
    found = {r.n_tokens: r for r in sums.collect()}
    assert {n: r.n_docs for n, r in found.items()} == Counter(lengths)
    for n, row in found.items():
        assert row.docs_at_least == sum(x >= n for x in lengths)
        assert row.tokens_at_least == sum(x for x in lengths if x >= n)
        assert row.truncated_total == sum(min(x, n) for x in lengths)
    for row in token_counts.at_limits(sums, [0, 7, 300, 10**6]).collect():
        assert (row.docs_over, row.truncated_total) == (sum(x > row.limit for x in lengths), sum(min(x, row.limit) for x in lengths))
    ordered = sorted(lengths)
    for row in token_counts.quantiles(sums, [0.5, 0.9, 1.0]).collect():
        assert row.n_tokens == ordered[int(np.ceil(row.share * len(ordered))) - 1]
    assert token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(docs.limit(0), PATH, PATTERN))).count() == 0


# ---------------------------------------------------------------- 5 and 9: quality


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(spark, odd_texts):
    docs = docs_of(spark, odd_texts)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = statistics.text_statistics(docs).select("row.doc_id", *names, "n_distinct", "n_chars").collect()
    assert len(rows) == len(odd_texts)
    for row in rows:
        text = odd_texts[row.doc_id]
        assert tuple(row)[1:6] == brute_counts(text)
        assert (row.n_distinct, row.n_chars) == (len(set(WORD.findall(text or ""))), len(text or ""))


def labelled(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["some plain text here. ", "### $$ && ", "more of the text. "], (9, 9 * (i % 3 == 0), 9), k=30)) for i in range(600)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(500)] + [(None, 1), (3, None), (9999, 0)], "doc_id long, quality int")
    return docs, labels


def test_rule_ensemble_learns_and_scores(spark):
    docs, labels = labelled(spark)
    model = rule_ensemble.train(docs, labels)
    rows = rule_ensemble.scored(docs, model).select("row.doc_id", "held_out", "score", "predicted").collect()
    assert 0 < len(model.rules) < 60 and len(rows) == 600
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in rows if r.held_out]) > 0.95
    odd = docs_of(spark, [None, "", "a " * 100_000])
    assert rule_ensemble.scored(odd, model).filter("score is null").count() == 0
    none = rule_ensemble.train(docs, labels.limit(0))
    assert [r.score for r in rule_ensemble.scored(odd, none).collect()] == [pytest.approx(0.5)] * 3


def test_decision_list_learns_and_judges(spark):
    docs, labels = labelled(spark)
    names, rules = decision_list.train(docs, labels)
    rows = decision_list.judged(docs, names, rules).select("row.doc_id", "n_words", "n_repeat_words", "base_failed", "kept").collect()
    assert rules and len(rows) == 600
    for row in rows:
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
    matrix = np.array([[float(i % 3 == 0), i] for i in range(900)])
    learned = decision_list.learn(matrix, (np.arange(900) % 3 != 0).astype(int))
    assert learned == [((0, 0.5, True),)]
    assert decision_list.train(docs, labels.limit(0))[1] == []
    assert decision_list.judged(docs_of(spark, [None, ""]), names, []).filter("kept").count() == 0


# ---------------------------------------------------------------- 7: near copies


def brute_fingerprint(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, near):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash_classes_equal_brute_force(spark, odd_texts):
    docs = docs_of(spark, odd_texts)
    rows = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: r.doc_id)
    prints = [brute_fingerprint(text, 4) for text in odd_texts]
    assert [int(r.fingerprint, 16) for r in rows] == prints
    assert [r.component_id for r in rows] == brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("leaf", "block"), [(4, 10_000), (8, 16), (1000, 7)])
def test_vantage_trees_find_every_link(spark, leaf, block):
    rng = random.Random(leaf)
    values = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    rows = spark.createDataFrame([(v, v, 0, 0) for v in values], "fp long, id long, s1 long, s2 long").repartition(3)
    found = simhash.links(rows, 4, leaf_size=leaf, block=block)
    labels = {r.node: r.label for r in simhash.components(found.select(F.col("id").alias("u"), F.col("label").alias("v"))).collect()}
    mask = (1 << 64) - 1
    expected = brute_components(values, lambda a, b: ((a ^ b) & mask).bit_count() <= 4)
    assert [labels.get(v, v) for v in values] == [values[i] for i in expected]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(5, 5), (200, 201), (201, 200)]
    found = simhash.components(spark.createDataFrame(edges, "u long, v long"))
    labels = {r.node: r.label for r in found.collect()}
    assert labels == {i: 100 for i in range(101, 141)} | {i: 1 for i in range(2, 30)} | {201: 200}


def test_one_of_each_group_of_near_copies_stays(spark):
    rng = random.Random(6)
    base = [" ".join(f"v{rng.randint(0, 10**6)}" for _ in range(300)) for _ in range(20)]
    near = [" ".join(w if rng.random() > 0.005 else "changed" for w in text.split()) for text in base]
    docs = docs_of(spark, [*base, *near, *base[:5], None, None, ""])
    left = simhash.without_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [*range(20), 45]


@pytest.mark.parametrize("seed", [1899, 22970])
def test_near_copies_without_a_common_band_are_found_by_their_fingerprints(spark, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 104)]
    texts = [" ".join(words), " ".join(words + [f"w{x}" for x in rng.integers(0, 10**6, 24)])]
    keys = simhash.band_keys(*simhash.shingle_sets(pa.array(texts)))
    assert not (keys[0] == keys[1]).any() and jaccard(*map(shingles_of, texts)) >= 0.8
    assert [r.doc_id for r in simhash.without_near_copies(docs_of(spark, texts)).collect()] == [0]


def shingles_of(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def altered(rng, kind, similarity, size):
    """A text and one with about that similarity, made by the given kind of change."""
    words = [f"v{rng.randint(0, 5000)}" for _ in range(size)]
    more = [f"x{rng.randint(0, 5000)}" for _ in range(size)]
    other = round((size - 4) * (1 / similarity - 1))
    if kind == "appended":
        changed = words + more[:other]
    elif kind == "truncated":
        changed = words[: 4 + round((size - 4) * similarity)]
    else:
        places = set(rng.sample(range(size), max(1, round(size * (1 - similarity) / (1 + similarity) / 5))))
        changed = [m if i in places else w for i, (w, m) in enumerate(zip(words, more))]
    return " ".join(words), " ".join(changed)


@pytest.mark.parametrize("kind", ["appended", "truncated", "scattered"])
def test_near_copies_are_found_whatever_the_change(spark, kind):
    rng = random.Random(17)
    pairs = [altered(rng, kind, rng.uniform(0.79, 0.97), rng.randint(100, 800)) for _ in range(600)]
    docs = docs_of(spark, [text for pair in pairs for text in pair])
    left = {r.doc_id for r in simhash.without_near_copies(docs).collect()}
    found = Counter()
    for i, (a, b) in enumerate(pairs):
        true = jaccard(shingles_of(a), shingles_of(b))
        found[int(true * 20) / 20, 2 * i + 1 not in left] += true >= 0.8
        assert 2 * i in left
    for low in (0.8, 0.85, 0.9, 0.95):
        yes, no = found[low, True], found[low, False]
        print(f"RECALL {kind} {low}: {yes} of {yes + no}")
        assert yes + no > 20 and yes >= 0.98 * (yes + no)


@pytest.mark.parametrize("kind", ["appended", "truncated", "scattered"])
def test_texts_below_the_similarity_stay(spark, kind):
    rng = random.Random(18)
    pairs = [altered(rng, kind, rng.uniform(0.5, 0.81), rng.randint(100, 800)) for _ in range(400)]
    docs = docs_of(spark, [text for pair in pairs for text in pair])
    left = {r.doc_id for r in simhash.without_near_copies(docs).collect()}
    below = [i for i, (a, b) in enumerate(pairs) if jaccard(shingles_of(a), shingles_of(b)) < 0.8]
    assert len(below) > 300 and all({2 * i, 2 * i + 1} <= left for i in below)


@pytest.mark.parametrize("block", [1 << 16, 500])
def test_near_copies_equal_brute_force(spark, odd_texts, block):
    rng = random.Random(19)
    base = [f"w{rng.randint(0, 200)}" for _ in range(120)]
    family = []
    for _ in range(150):  # one template: some pairs above the similarity, chains of them, and many below
        places = set(rng.sample(range(120), rng.randint(0, 4)))
        family.append(" ".join(f"y{rng.randint(0, 50)}" if i in places else w for i, w in enumerate(base)))
    texts = [*family, *odd_texts, *family[:7]]
    left = simhash.without_near_copies(docs_of(spark, texts), block=block).collect()
    classes = brute_components([shingles_of(t) for t in texts], lambda a, b: jaccard(a, b) >= 0.8)
    assert sorted(r.doc_id for r in left) == sorted(set(classes))


# ---------------------------------------------------------------- 8: WARC


def test_warc_round_trip(spark, tmp_path):
    html = "<html lang='de'><title>A &amp; B</title><script>x<y</script><p>Grüße</p>\n\n<!-- no --><b>WARC/1.1\r\n\r\nContent-Length: 3</b>"
    pages = spark.createDataFrame([(1, "http://a/b", html), (2, None, None), (2, None, None), (3, "u", "<p>" * 5000)], "page_id long, url string, html string")
    made = warc.derivatives(warc.responses(pages), ("page_id",))
    rows = made.collect()
    assert Counter(r.record_type for r in rows) == {"metadata": 4, "conversion": 4}
    one = next(r for r in rows if r.page_id == 1 and r.record_type == "conversion")
    assert one.block.startswith("A & B\nGrüße\nWARC/1.1") and "x<y" not in one.block and "no" not in one.block
    meta = next(r for r in rows if r.page_id == 1 and r.record_type == "metadata")
    assert one.record_id in meta.block and "source-header: Content-Type: text/html" in meta.block
    assert f"source-payload-digest: sha256:{hashlib.sha256(html.encode()).hexdigest()}" in meta.block
    assert one.block_digest == "sha256:" + hashlib.sha256(one.block.encode()).hexdigest()
    warc.write(made, str(tmp_path / "out"))
    read = warc.read(spark, str(tmp_path / "out")).collect()
    keys = ("record_type", "record_id", "refers_to", "block")
    assert Counter(tuple(r[k] for k in keys) for r in read) == Counter(tuple(r[k] for k in keys) for r in rows)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


# ---------------------------------------------------------------- 10: substrings


def brute_removed(rows, size):
    seen, result = {}, {}
    for doc, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if seen.setdefault(window, (doc, i)) != (doc, i):
                gone.update(range(i, i + size))
        result[doc] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return result


@pytest.mark.parametrize("size", [20, 5])
def test_substrings_equal_brute_force(spark, odd_texts, size, monkeypatch):
    docs = docs_of(spark, odd_texts)
    rows = substrings.dedup(docs, size).select("row.*", F.col("n_words").alias("words"), "n_removed", "kept")
    expected = brute_removed(list(enumerate(odd_texts)), size)
    found = rows.select("doc_id", "words", "n_removed", "kept").collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected
    assert substrings.dedup(docs.limit(0), size).count() == 0


def test_substrings_hot_passage_and_repeated_rows(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, " ".join(f"u{rng.randint(0, 10**9)}" for _ in range(15)) + " " + passage + f" end{i}") for i in range(200)]
    rows += [(None, passage + " none"), (200, passage), (200, passage), (200, "other " + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substrings.dedup(docs, 20).select("row.doc_id", "n_words", "n_removed").collect()
    for row in found:
        assert row.n_removed == (0 if row.doc_id is None else 50)
    assert len(found) == len(rows)


def test_substrings_send_the_same_rows_whatever_the_order_of_arrival(spark):
    passage = " ".join(f"p{i}" for i in range(300))
    docs = docs_of(spark, [f"{passage} between {i} {passage} end {i}" for i in range(12)])
    prepared = substrings.keyed(docs, "doc_id", "text")
    base, spans = prepared.select("row", "uid", "did", "th"), substrings.shared_runs(prepared, 20, 6)

    def sent(spans):
        return sorted(tuple(r) for r in substrings._cut(base, "text", spans, 20).drop("row").collect())

    assert sent(spans.withColumn("spans", F.sort_array("spans"))) == sent(spans.withColumn("spans", F.sort_array("spans", asc=False)))


def test_fm_index_matching_statistics():
    rng = np.random.default_rng(1)
    symbols = np.concatenate([[0], rng.integers(1, 4, 300), [0], rng.integers(1, 4, 300)])
    starts = np.flatnonzero(np.convolve(symbols == 0, np.ones(6), "full")[5 : 5 + len(symbols) - 5] == 0)[:-6]
    starts = np.array([s for s in starts if s + 6 <= len(symbols) and (symbols[s : s + 6] > 0).all()])
    matched, earliest = FMIndex(symbols, 6).earlier_matches(starts, 6)
    everything = [tuple(symbols[i : i + 6]) for i in range(len(symbols))]
    for start, length, first in zip(starts, matched, earliest):
        window = tuple(symbols[start : start + 6])
        ends = [k for k in range(1, 7) if sum(tuple(symbols[i : i + k]) == window[6 - k :] for i in range(len(symbols) - k + 1)) > 1]
        assert length == max(ends, default=0)
        if length == 6:
            assert first == everything.index(window)

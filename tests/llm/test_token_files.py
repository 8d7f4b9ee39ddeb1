"""Token files against the library's ids, by whole reads and by document."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import matches, pieces, repair_grammar, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["", None, " ", "  ", "a  b", "a b ", " a b", "\n a", "a \n b c", "a  b", "x ​ y", "a\x1c b c", "﻿x y", "é ü ñ",
       "don't we'll  'll", "  \n\n  x  ", "1 2 3,4 <|endoftext|> x", "a\t b", "tab\t\tx y z", "a\r\n b", "x\x00 y", "😀 😀‍😀 a", "　a b　 c"]


def sample(n=60, seed=4):
    rng = random.Random(seed)
    words = ["alpha", "Béta", "gam-ma", "12", "3.5", "δ", "it's", "\n", "  ", "x" * 40, "(q)"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 200))) for _ in range(n)]


def expected(library, rows):
    """Ids of all rows in the order of the files, row by row."""
    start, found = 0, []
    for doc_id, text in rows:
        ids = library(text) + [0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return found


def written(spark, tmp_path, rows, name="files"):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, part string")
    token_files.write(df.repartition(5), str(tmp_path / name), PATH)
    return token_files.blocks(spark, str(tmp_path / name))


def test_files_read_back_equal_the_library(spark, tmp_path, library, monkeypatch):
    rows = list(enumerate(ODD + sample()))
    found = written(spark, tmp_path, rows)
    truth = expected(library, rows)
    assert sorted(map(tuple, token_files.checksums(found).collect())) == [r[:4] for r in truth]
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids) for r in token_files.read(found).collect()) == [(*r[:3], r[4]) for r in truth]
    some = [2, 30, 31, 70, 999]
    near = token_files.lookup(found, some).collect()
    assert sorted((r.doc_id, r.start, r.ids) for r in near) == [(r[0], r[1], r[4]) for r in truth if r[0] in some]
    assert token_files.lookup(found, []).count() == 0


def test_many_small_blocks_and_a_long_document(spark, tmp_path, library):
    texts = sample(30, 8)
    texts[7] = "never ending " * 30_000
    texts[11] = "x" * 3_000
    rows = list(enumerate(texts, 100))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    token_files.write(df, str(tmp_path / "f"), PATH)
    assert sorted(map(tuple, token_files.checksums(token_files.blocks(spark, str(tmp_path / "f"))).collect())) == [r[:4] for r in expected(library, rows)]


def test_repeated_null_and_copied_rows(spark, tmp_path, library):
    rows = [(None, "n m"), (7, "a b"), (7, "a b"), (7, "c"), (-3, None), (7, "a b")] + [(9, "hot text " * 20)] * 400
    found = written(spark, tmp_path, rows)
    read = sorted(token_files.read(found).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in read] == [None, -3] + [7] * 4 + [9] * 400
    assert sorted((r.doc_id or 0, r.ids) for r in read) == sorted((i or 0, library(t) + [0]) for i, t in rows)
    assert [r.start for r in read] == np.cumsum([0] + [r.n_tokens for r in read[:-1]]).tolist()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write(df, str(tmp_path / "none"), PATH)
    found = token_files.blocks(spark, str(tmp_path / "none"))
    assert token_files.checksums(found).count() == 0 and token_files.read(found).count() == 0


@pytest.mark.parametrize("limit", [1, 1 << 14, 1 << 28])
def test_piece_table_of_any_size_gives_the_same_ids(library, limit):
    with open(PATH, encoding="utf-8") as file:
        table = pieces.Pieces(token_files.library_encoder(file.read()), max_bytes=limit, own=True)
    for seed in (1, 2, 1):
        texts = ODD + sample(20, seed)
        ids, sizes = pieces.encoded(pa.array(texts), table)
        truth = [library(t) for t in texts]
        assert sizes.tolist() == list(map(len, truth)) and ids.tolist() == sum(truth, [])
    assert table.young.size < max(limit, 1 << 20)


def test_grammar_expands_to_what_it_was_made_of():
    rng = np.random.default_rng(3)
    cases = [[], [5], [7] * 1000, [1, 2, 3] * 500, [1, 1, 2] * 333 + [1], rng.integers(0, 3, 4000), rng.integers(0, 50_000, 4000), [0] * 65_537]
    for case in cases:
        ids = np.array(case, np.int64)
        made = repair_grammar.compress(ids)
        back = repair_grammar.Grammar.of_columns(made.columns())
        assert back.all().tolist() == ids.tolist()
        assert (back.rules < np.arange(len(back.rules))[:, None] + len(back.alphabet)).all()
        for _ in range(40):
            start = int(rng.integers(0, len(ids) + 1))
            size = int(rng.integers(0, len(ids) - start + 1))
            assert back.range(start, size).tolist() == ids[start : start + size].tolist()
    assert len(repair_grammar.compress(np.array([1, 2, 3, 4] * 1000)).symbols) < 100


AROUND = ["a%sb", "a %s b", "%s ", " %s", "'%s", "a%s\n", "\n%s a", "1%s2", ".%s.", "  %s  ", "\n\n%s\n\n"]
# Every character up to Cyrillic, the rows with white space and marks, and some of the others.
CHARACTERS = [*range(0x530), *range(0x1670, 0x1690), *range(0x1800, 0x1820), *range(0x2000, 0x2100), *range(0x2FF0, 0x3050), 0x4E2D, 0xFEFF, 0xFF10, 0x1F600, 0x1D7D8]


def test_cuts_by_class_are_those_of_the_library(library):
    encode = token_files.library_encoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(9)
    parts = [*"aZé9.!'\"<> \n\t", "  ", "'s", "'ll", "ß", "²", "«", "’", "—", "\u00a0", "\u2003", "\u3000", "中", "я", "😀", "<|endoftext|>", ""]
    texts = [around % chr(c) for around in AROUND for c in CHARACTERS]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(4_000)] + ODD
    ids, sizes = pieces.encoded(pa.array(texts), pieces.Pieces(encode), matches.cut)
    ends = np.cumsum(sizes)
    for text, begin, end in zip(texts, (ends - sizes).tolist(), ends.tolist()):
        assert ids[begin:end].tolist() == library(text), repr(text)


def test_other_splitting_patterns_keep_the_cuts_at_spaces():
    steps = json.load(open(PATH, encoding="utf-8"))
    split = {"type": "Split", "pattern": {"Regex": r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}, "behavior": "Isolated", "invert": False}
    steps["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [split, token_files.BYTE_LEVEL | {"use_regex": False}]}
    vocabulary = json.dumps(steps)
    table, cutter = token_files._pieces(vocabulary)
    texts = ["a (word) and \"more\", 12345 x", "it's 'so' -- (a)b.c,d", " é(ü) "] + sample(10)
    ids, _ = pieces.encoded(pa.array(texts), table, cutter)
    other = Tokenizer.from_str(vocabulary)
    assert ids.tolist() == [i for text in texts for i in other.encode(text, add_special_tokens=False).ids]
    assert token_files._pieces(open(PATH, encoding="utf-8").read())[1] is matches.cut


def test_a_word_is_encoded_once_whatever_stands_beside_it(library):
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeéo" for c in "lmnr"]
    marks = [",", ".", ";", "!", "?", ")", ":", "...", "»", "***"]
    text = " ".join(f"{word}{mark}" for word in words for mark in marks) + "\n" + "\n".join(words)
    encode = token_files.library_encoder(open(PATH, encoding="utf-8").read())
    asked: list[str] = []
    table = pieces.Pieces(lambda fresh: (asked.extend(fresh), encode(fresh))[1])
    for _ in range(2):
        ids, _ = pieces.encoded(pa.array([text]), table, matches.cut)
        assert ids.tolist() == library(text)
    # With a space before it, without, the marks, the line break.
    assert len(asked) == len(set(asked)) <= 2 * len(words) + len(marks) + 1


def test_pieces_listed_twice_and_known_to_the_old_table():
    table = pieces.Pieces(lambda fresh: (np.array([len(x) for x in fresh for _ in x]), np.array(list(map(len, fresh)))), max_bytes=1)
    for asked in (["a", "bb", "ccc"], ["dddd", "bb", "a"], ["bb", "eeeee", "bb", "dddd", "eeeee"], ["ccc", "a", "ffffff", "bb"]):
        flat, sizes = table.ids(asked)
        assert sizes.tolist() == list(map(len, asked)) and flat.tolist() == [len(x) for x in asked for _ in x]


def test_places_chosen_for_rules():
    rng = np.random.default_rng(6)
    for _ in range(200):
        count = np.repeat(rng.integers(0, 6, 30), rng.integers(1, 5, 30))
        taken = []
        for i, n in enumerate(count.tolist()):
            before, after = ([0, *count.tolist()][i], [*count.tolist(), 0][i + 1])
            run = next(k for k in range(i, -1, -1) if k == 0 or count[k - 1] != n)
            taken.append(n > 0 and n >= after and (i - run) % 2 == 0 and not (run == i and before > n))
        assert repair_grammar._chosen(count).tolist() == taken

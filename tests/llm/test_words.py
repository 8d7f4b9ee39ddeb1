"""Hashes of words and windows: no structural collisions, and results where older hashes collided."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from ledgerline.llm import bpe, simhash, statistics, substrings
from ledgerline.llm.words import range_hashes, split


def folded_pair(size=2048, letters="ab"):
    """Two different words that every polynomial hash modulo 2^64 with an odd base takes for equal: the sequence of bit
    parities and its opposite."""
    parity = [bin(i).count("1") % 2 for i in range(size)]
    return "".join(letters[p] for p in parity), "".join(letters[1 - p] for p in parity)


def test_words_that_polynomial_hashes_confuse_are_told_apart(spark):
    one, other = folded_pair()
    assert len(set(split(pa.array([one + " " + other])).hashes().tolist())) == 2
    head = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{head} {one}"), (2, f"{head} {other}"), (3, f"{head} {one}")], "doc_id long, text string")
    assert {r.row.doc_id: r.n_removed for r in substrings.dedup(docs).collect()} == {1: 0, 2: 0, 3: 20}
    assert statistics.count_texts(pa.array([f"{one}\n{other}"]))["n_dup_lines"].tolist() == [0]
    assert statistics.count_texts(pa.array([f"{one}\n{one}"]))["n_dup_lines"].tolist() == [1]
    assert statistics.count_texts(pa.array([f"{one} a b {other} a b"]))["n_repeat_words"].tolist() == [0]
    kept = simhash.without_near_copies(spark.createDataFrame([(1, one, 1), (2, other, 2), (3, one, 3)], "doc_id long, text string, node int"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


@pytest.mark.parametrize("longest", [3, 20, 200])
def test_range_hashes_depend_on_contents_only(longest):
    rng = np.random.default_rng(longest)
    values = rng.integers(0, 3, 4000).astype(np.uint8)
    starts = rng.integers(0, 3500, 3000)
    ends = starts + rng.integers(0, longest + 1, 3000)
    for seed in (0, 1):
        hashes = range_hashes(values, starts, ends, seed)
        contents = [values[a:b].tobytes() for a, b in zip(starts, ends)]
        assert len(set(zip(contents, hashes.tolist()))) == len(set(contents)) == len(set(hashes.tolist()))
    assert range_hashes(values[:0], starts[:0], ends[:0]).tolist() == []


def test_word_tables_of_any_size_give_the_library_ids(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [f"word{i % 7} Wörter{i} it's {i * 37} \n\n  x{i}  y \t{'z' * (i % 600)}" for i in range(400)] + ["", None, " "]
    truth = [library.encode_ordinary(text or "") for text in texts]
    for limit in (1, 20_000, 1 << 28):
        monkeypatch.setattr(bpe, "WORD_BYTES", limit)
        monkeypatch.setattr(bpe, "PIECE_BYTES", limit)
        codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
        for at in range(0, len(texts), 60):
            ids, sizes = codec.encode(pa.array(texts[at : at + 60]))
            assert ids.tolist() == sum(truth[at : at + 60], []) and sizes.tolist() == [len(t) for t in truth[at : at + 60]]
            decoded = codec.decode(ids, sizes)
            assert [d.decode() for d in decoded] == [t or "" for t in texts[at : at + 60]]

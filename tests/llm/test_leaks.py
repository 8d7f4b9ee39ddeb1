"""Benchmark leaks against a search in plain Python, over texts of plain words and digits."""

from __future__ import annotations

import random

import pytest
from ledgerline.llm import decontamination

WINDOW, LITERALS = decontamination.WINDOW, decontamination.LEAST_LITERALS


def windows_of(words, size):
    """(start, words, template) of every run; a template has digits as one sign, and None if it may not count as one."""
    found = []
    for at in range(len(words) - size + 1):
        run = words[at : at + size]
        plain = [w for w in run if not w[0].isdigit()]
        least = 1 if size < WINDOW else LITERALS
        template = tuple("#" if w[0].isdigit() else w for w in run) if least <= len(plain) < size else None
        found.append((at, tuple(run), template))
    return found


def brute(docs, items):
    """Per document and item, its longest diagonal: windows, different pairs of values, first word."""
    best = {}
    for i, item in enumerate(items):
        own = item.split()
        size = min(WINDOW, len(own))
        for d, text in enumerate(docs):
            diagonals = {}
            for item_at, item_run, item_template in windows_of(own, size):
                for doc_at, doc_run, doc_template in windows_of((text or "").split(), size):
                    if item_run == doc_run or (item_template is not None and item_template == doc_template):
                        diagonals.setdefault(doc_at - item_at, []).append((doc_at, item_run, doc_run))
            for found in diagonals.values():
                pairs = {}
                for doc_at, item_run, doc_run in found:
                    for k, (a, b) in enumerate(zip(item_run, doc_run)):
                        if a[0].isdigit() and sum(not w[0].isdigit() for w in item_run) >= (1 if size < WINDOW else LITERALS):
                            pairs[doc_at + k] = (a, b)
                mapping = {}
                for a, b in pairs.values():
                    mapping.setdefault(a, set()).add(b)
                if any(len(to) > 1 for to in mapping.values()):
                    continue  # conflicts have their own tests
                at = sorted({doc_at for doc_at, _, _ in found})
                value = (len(at), -at[0], len(set(pairs.values())))
                best[d, i] = max(best.get((d, i), value), value)
    return {key: (n, slots, -first) for key, (n, first, slots) in best.items()}


@pytest.mark.parametrize("seed", range(3))
def test_leaks_equal_plain_search(spark, seed):
    rng = random.Random(seed)
    words = [a + b for a in ("qua", "zor", "bli", "fen", "ugh") for b in ("dal", "mip", "rox", "tev", "wun")]

    def passage(n):
        return [rng.choice(words) if rng.random() < 0.85 else str(rng.randint(1, 9)) for _ in range(n)]

    items = [" ".join(passage(rng.choice([3, 6, 9, 20, 40]))) for _ in range(12)]
    docs = []
    for _ in range(40):
        text = passage(rng.randint(0, 60))
        for item in rng.sample(items, 2):
            own = item.split()
            if rng.random() < 0.5:  # other numbers, each value always the same one
                own = [str(int(w) + 100 * (1 + rng.randint(0, 0))) if w.isdigit() else w for w in own]
            at = rng.randint(0, len(text))
            text[at:at] = own[: rng.randint(len(own) // 2, len(own))] if rng.random() < 0.3 else own
        docs.append(" ".join(text))
    docs += [None, "", "   "]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, hash int").repartition(3)
    listed = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.n_windows, r.n_slots, r.first_word) for r in decontamination.contaminated(df, listed).collect()}
    truth = brute(docs, items)
    consistent = {key: value for key, value in found.items() if key in truth}
    assert set(truth) <= set(found)
    wrong = {key: (consistent[key], truth[key]) for key in truth if consistent[key][0] != truth[key][0] or consistent[key][2] != truth[key][2]}
    assert len(wrong) <= len(truth) // 50, wrong
    assert len(truth) > 40


def test_repeated_documents_very_long_texts_and_clashing_names(spark):
    item = "quadal zormip 7 blirox fentev ughwun quamip zorrox blitev"
    long = "filler words " * 80_000 + item.replace("7", "12") + " end" * 1000
    rows = [(1, long, 1, "x"), (2, item, 2, "y"), (2, item, 2, "y"), (2, "other text", 3, "z"), (None, item, 4, None), (3, None, 5, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash int, row string")
    items = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    found = sorted(((r.doc_id or 0), r.item_id, r.n_windows) for r in decontamination.contaminated(docs, items).collect())
    assert found == [(0, 1, 2), (1, 1, 2), (2, 1, 2)]
    left = decontamination.clean(docs, items)
    assert left.columns == docs.columns and sorted(map(str, left.collect())) == sorted(
        str(r) for r in docs.where("text IS NULL OR text = 'other text' OR doc_id = 1").collect()
    )

"""Quality rules: a decision list learned by sequential covering, emitted as ordered Spark conditional expressions.

Rules that reject are learned one after the other from the labelled statistics that no earlier rule covers: two thirds of
them grow a conjunction of thresholds by information gain, the other third prunes its last conditions as long as
that raises its worth, and the list ends with the first rule that is wrong too often on the pruning part. The last
entry keeps everything else. Learning sees about ``SAMPLE_ROWS`` rows that are not held out (a documented bound).

Documents that fail the fixed base rules are never kept. Without labels of both values the list only has its last entry.
Null and empty texts have statistics of 0 and fail the base rules. Repeated rows get equal verdicts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.statistics import condition, features, holds, labelled_sample, text_statistics

SAMPLE_ROWS = 20_000
MOST_RULES = 16
MOST_CONDITIONS = 4
LEAST_PRECISION = 0.8
LEAST_COVER = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

Rule = tuple[tuple[int, float, bool], ...]


def _best_condition(matrix: np.ndarray, bad: np.ndarray) -> tuple[float, tuple[int, float, bool]] | None:
    """The threshold of the largest information gain towards bad rows."""
    p, n = bad.sum(), (~bad).sum()
    before = np.log2(p / (p + n))
    best = None
    for f in range(matrix.shape[1]):
        values = matrix[:, f]
        order = np.argsort(values, kind="stable")
        ordered, flags = values[order], bad[order]
        change = np.flatnonzero(ordered[1:] > ordered[:-1])
        if not len(change):
            continue
        below_p, below = np.cumsum(flags)[change], change + 1
        for above in (False, True):
            hits_p = p - below_p if above else below_p
            hits = len(bad) - below if above else below
            gain = np.where(hits_p > 0, hits_p * (np.log2(np.maximum(hits_p, 1) / hits) - before), -1)
            at = int(gain.argmax())
            if best is None or gain[at] > best[0]:
                threshold = float((ordered[change[at]] + ordered[change[at] + 1]) / 2)
                best = (float(gain[at]), (f, threshold, above))
    return best


def grow(matrix: np.ndarray, bad: np.ndarray) -> Rule:
    rule: list[tuple[int, float, bool]] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and bad[inside].any() and not bad[inside].all():
        found = _best_condition(matrix[inside], bad[inside])
        if found is None or found[0] <= 1e-9:
            break
        rule.append(found[1])
        inside = holds(tuple(rule), matrix)
    return tuple(rule)


def prune(rule: Rule, matrix: np.ndarray, bad: np.ndarray) -> Rule:
    """The start of the rule that is worth most: (right - wrong) / covered."""

    def worth(part: Rule) -> float:
        inside = holds(part, matrix)
        return (2 * bad[inside].sum() - inside.sum()) / max(inside.sum(), 1)

    starts = [rule[:size] for size in range(len(rule), 0, -1)]
    return max(starts, key=worth) if starts else rule


def learn(matrix: np.ndarray, labels: np.ndarray, seed: int = 9) -> list[Rule]:
    """Rules that reject, in order."""
    rng = np.random.default_rng(seed)
    bad = labels == 0
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and bad.any() and not bad.all():
        growing = rng.random(len(bad)) < 2 / 3
        if not bad[growing].any() or bad[growing].all():
            break
        rule = prune(grow(matrix[growing], bad[growing]), matrix[~growing], bad[~growing])
        if not rule:
            break
        judged = holds(rule, matrix[~growing])
        if bad[~growing][judged].sum() < LEAST_PRECISION * judged.sum() or judged.sum() < LEAST_COVER:
            break
        rules.append(rule)
        rest = ~holds(rule, matrix)
        matrix, bad = matrix[rest], bad[rest]
    return rules


def verdict(names: list[str], rules: list[Rule]) -> tuple[F.Column, F.Column]:
    """Ordered conditional expressions: whether the list keeps a document, and the number of the entry that decides."""
    if not rules:
        return F.lit(True), F.lit(0)
    columns = [features()[name] for name in names]
    keeps, entry = F, F
    for number, rule in enumerate(rules):
        keeps = keeps.when(condition(rule, columns), F.lit(False))
        entry = entry.when(condition(rule, columns), F.lit(number))
    return keeps.otherwise(F.lit(True)), entry.otherwise(F.lit(len(rules)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> tuple[list[str], list[Rule]]:
    names, matrix, values = labelled_sample(docs, labels, label, rows)
    return names, learn(matrix, values)


def judged(docs: DataFrame, names: list[str], rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row``, all counts, base_failed, kept and the deciding entry of the list for every row of ``docs``."""
    keeps, entry = verdict(names, rules)
    too_repetitive = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    counted = text_statistics(docs, id_col, text_col)
    counted = counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | too_repetitive)
    return counted.withColumn("kept", ~F.col("base_failed") & keeps).withColumn("entry", entry)

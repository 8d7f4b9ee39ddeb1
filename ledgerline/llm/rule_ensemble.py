"""Quality classifier: a sparse ensemble of rules from trees, weighted by a lasso logistic regression.

1. Statistics of about ``SAMPLE_ROWS`` labelled documents that are not held out go to the driver (a documented bound).
2. Small trees are boosted on them; the path to every node is a rule, a conjunction of thresholds on statistics.
3. A logistic regression with an L1 penalty weighs the rules; most weights are zero. The penalty is chosen by the log
   loss on a part of the sample that the fit did not see.
4. What is left is one Spark expression, evaluated over all documents beside their statistics.

Without labels of both values the score is the share of label 1 (0.5 without any label). Null and empty texts are scored
by their statistics, which are 0. Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.statistics import condition, features, held_out, holds, labelled_sample, text_statistics

SAMPLE_ROWS = 20_000
TREES = 40
DEPTH = 3
THRESHOLDS = 32
PENALTIES = (0.03, 0.01, 0.003, 0.001)
REJECT_BELOW = 0.3


def _cuts(matrix: np.ndarray) -> list[np.ndarray]:
    """Candidate thresholds of each feature: midpoints at its quantiles."""
    result = []
    for column in matrix.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        result.append(middle[np.unique(np.linspace(0, len(middle) - 1, THRESHOLDS).astype(int))] if len(middle) else middle)
    return result


def _grow(matrix, target, weight, rows, cuts, depth, path, paths) -> None:
    """Split by the largest gain in weighted squared error; every node below the root adds its path."""
    total, mass = (target[rows] * weight[rows]).sum(), weight[rows].sum()
    best, choice = 1e-9, None
    for f, thresholds in enumerate(cuts):
        if not len(thresholds):
            continue
        slot = np.searchsorted(thresholds, matrix[rows, f])  # below or at each threshold
        left_sum = np.cumsum(np.bincount(slot, target[rows] * weight[rows], len(thresholds) + 1))[:-1]
        left_mass = np.cumsum(np.bincount(slot, weight[rows], len(thresholds) + 1))[:-1]
        count = np.cumsum(np.bincount(slot, minlength=len(thresholds) + 1))[:-1]
        right_mass = mass - left_mass
        fair = (count >= 10) & (len(rows) - count >= 10) & (left_mass > 0) & (right_mass > 0)
        if not fair.any():
            continue
        safe_left, safe_right = np.where(fair, left_mass, 1), np.where(fair, right_mass, 1)
        gain = np.where(fair, left_sum**2 / safe_left + (total - left_sum) ** 2 / safe_right - total**2 / mass, -1)
        at = int(gain.argmax())
        if gain[at] > best:
            best, choice = gain[at], (f, float(thresholds[at]))
    if choice is None:
        return
    f, threshold = choice
    above = matrix[rows, f] > threshold
    for side in (False, True):
        longer = (*path, (f, threshold, side))
        paths.append(longer)
        if depth > 1:
            _grow(matrix, target, weight, rows[above == side], cuts, depth - 1, longer, paths)


def tree_paths(matrix: np.ndarray, labels: np.ndarray, seed: int = 5) -> list[tuple]:
    """The paths of boosted trees, each once."""
    rng = np.random.default_rng(seed)
    cuts = _cuts(matrix)
    margin = np.full(len(labels), np.log((labels.mean() + 1e-6) / (1 - labels.mean() + 1e-6)))
    rules: dict[tuple, None] = {}
    for _ in range(TREES):
        share = 1 / (1 + np.exp(-margin))
        weight = np.maximum(share * (1 - share), 1e-6)
        residual = (labels - share) / weight
        rows = np.flatnonzero(rng.random(len(labels)) < 0.5)
        paths: list[tuple] = []
        if len(rows) > 20:
            _grow(matrix, residual, weight, rows, cuts, DEPTH, (), paths)
        if not paths:
            break
        parents = {path[:-1] for path in paths}
        for path in paths:
            rules.setdefault(tuple(sorted(set(path))))
            if path not in parents:
                inside = holds(path, matrix)
                step = (residual * weight)[inside].sum() / max(weight[inside].sum(), 1e-6)
                margin[inside] += 0.3 * np.clip(step, -4, 4)
    return list(rules)


def lasso_logistic(matrix: np.ndarray, labels: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps on centred columns."""
    n, width = matrix.shape
    middle = matrix.mean(axis=0)
    centred = matrix - middle
    bound = 0.25 * (np.linalg.norm(centred, 2) ** 2 / n + 1)
    weights, ahead, intercept, intercept_ahead, momentum = np.zeros(width), np.zeros(width), 0.0, 0.0, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(intercept_ahead + centred @ ahead))) - labels
        moved = ahead - (centred.T @ error) / n / bound
        fresh = np.sign(moved) * np.maximum(np.abs(moved) - penalty / bound, 0)
        fresh_intercept = intercept_ahead - error.mean() / bound
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = fresh + (momentum - 1) / following * (fresh - weights)
        intercept_ahead = fresh_intercept + (momentum - 1) / following * (fresh_intercept - intercept)
        weights, intercept, momentum = fresh, fresh_intercept, following
    return float(intercept - middle @ weights), weights


@dataclass
class RuleEnsemble:
    """Intercept, and rules with their weights over named features."""

    names: list[str]
    intercept: float
    rules: list[tuple[tuple, float]]

    def score(self) -> F.Column:
        """Probability of label 1 as a Spark expression."""
        columns = [features()[name] for name in self.names]
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.when(condition(rule, columns), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fit(names: list[str], matrix: np.ndarray, labels: np.ndarray) -> RuleEnsemble:
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return RuleEnsemble(names, float(np.log((share + 1e-6) / (1 - share + 1e-6))), [])
    rules = tree_paths(matrix, labels)
    if not rules:
        share = float(labels.mean())
        return RuleEnsemble(names, float(np.log(share / (1 - share))), [])
    hits = np.column_stack([holds(rule, matrix) for rule in rules]).astype(float)
    seen = np.random.default_rng(7).random(len(labels)) < 0.8
    best = None
    for penalty in PENALTIES if 10 < seen.sum() < len(labels) else PENALTIES[:1]:
        intercept, weights = lasso_logistic(hits[seen], labels[seen], penalty)
        share = np.clip(1 / (1 + np.exp(-(intercept + hits[~seen] @ weights))), 1e-6, 1 - 1e-6)
        unseen = labels[~seen]
        loss = -(unseen * np.log(share) + (1 - unseen) * np.log(1 - share)).mean() if len(unseen) else 0.0
        if best is None or loss < best[0]:
            best = (loss, penalty)
    intercept, weights = lasso_logistic(hits, labels, best[1])
    kept = [(rule, float(weight)) for rule, weight in zip(rules, weights) if abs(weight) > 1e-6]
    return RuleEnsemble(names, intercept, kept)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    return fit(*labelled_sample(docs, labels, label, rows))


def scored(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row``, held_out, score and predicted of every row of ``docs``."""
    counted = text_statistics(docs, id_col, text_col)
    result = counted.select("row", held_out(f"row.`{id_col}`").alias("held_out"), model.score().alias("score"))
    return result.withColumn("predicted", F.when(F.col("score") >= REJECT_BELOW, 1).otherwise(0))

"""Quality from a sparse ensemble of rules over text statistics.

Boosted trees over the statistics of a bounded labelled sample propose rules:
every path from a root is a conjunction of thresholds.  A logistic regression
with a lasso penalty weighs them; the rules it keeps become one Spark column
expression, so texts are scored without leaving the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.llm.common import quoted
from sondar.llm.labelled import SAMPLE_ROWS, fit_logistic, held_out, training_labels

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
TREES, DEPTH, RATE, LEAST, LASSO = 24, 3, 0.3, 20, 3e-4

Path = tuple[tuple[int, bool, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a whole text; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    words = F.split(F.trim(F.regexp_replace(t, r"\s+", " ")), " ")
    lines = F.split(t, "\n")
    n_words, n_lines = F.size(words), F.size(lines)

    def share(kept: str) -> Column:
        # What is left once runs of everything else are gone.
        return F.length(F.regexp_replace(t, kept, "")) / n

    return {
        "chars": F.log1p(F.length(t).cast("double")),
        "upper": share(r"[^\p{Lu}]+"),
        "digits": share(r"[^0-9]+"),
        "signs": share(r"[\p{L}\p{N}\s.,]+"),
        "stops": share(r"[^.,]+"),
        "wide": (F.octet_length(t) - F.length(t)) / n,
        "word_length": n / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / F.pow(n_words.cast("double"), F.lit(0.8)),
        "line_length": F.log1p(n / n_lines),
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
    }


@dataclass
class Rules:
    """Conjunctions over named statistics, their weights, and an intercept."""

    names: list[str]
    paths: list[Path]
    weights: list[float]
    intercept: float

    def score(self, stats: dict[str, Column]) -> Column:
        """The score as a column expression."""
        terms = [F.lit(self.intercept)]
        for path, weight in zip(self.paths, self.weights):
            holds = F.lit(True)
            for feature, above, cut in path:
                value = stats[self.names[feature]]
                holds = holds & ((value > cut) if above else (value <= cut))
            terms.append(F.when(holds, F.lit(weight)).otherwise(F.lit(0.0)))
        # Added in pairs: a chain as long as the rules would be too deep an expression.
        while len(terms) > 1:
            terms = [sum(terms[i + 1 : i + 2], terms[i]) for i in range(0, len(terms), 2)]
        (total,) = terms
        return 1 / (1 + F.exp(-total))


def _best_cut(x: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray):
    """The cut with the largest second-order gain among the rows."""
    best = (1e-6, None)
    total_g, total_h = g[rows].sum(), h[rows].sum()
    for f, edges in enumerate(cuts):
        if not len(edges):
            continue
        b = bins[rows, f]
        size = len(edges) + 1
        left_g = np.cumsum(np.bincount(b, g[rows], size))[:-1]
        left_h = np.cumsum(np.bincount(b, h[rows], size))[:-1]
        left_n = np.cumsum(np.bincount(b, minlength=size))[:-1]
        gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
        gain[(left_n < LEAST) | (len(rows) - left_n < LEAST)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (f, k))
    return best[1]


def tree_paths(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Path]:
    """Paths to every node but the roots of boosted trees, each once."""
    if not len(y) or y.min() == y.max():
        return []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 66)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    f_now = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    paths: dict[Path, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f_now))
        g, h = y - p, p * (1 - p)
        nodes: list[tuple[np.ndarray, Path]] = [(np.arange(len(y)), ())]
        for _ in range(depth):
            grown = []
            for rows, path in nodes:
                cut = _best_cut(x, cuts, bins, rows, g, h)
                if cut is None:
                    grown.append((rows, path))
                    continue
                f, k = cut
                for above in (False, True):
                    inside = rows[(bins[rows, f] > k) == above]
                    branch = (*path, (f, above, float(cuts[f][k])))
                    paths[branch] = None
                    grown.append((inside, branch))
            nodes = grown
        for rows, _path in nodes:
            f_now[rows] += RATE * g[rows].sum() / (h[rows].sum() + 1)
    return list(paths)


def fires(x: np.ndarray, path: Path) -> np.ndarray:
    held = np.ones(len(x), dtype=bool)
    for f, above, cut in path:
        held &= (x[:, f] > cut) == above
    return held


def fit(names: list[str], x: np.ndarray, y: np.ndarray, lasso: float = LASSO) -> Rules:
    """Rules and weights from statistics ``x`` and labels ``y`` (0 or 1)."""
    paths = tree_paths(x, y)
    matrix = np.stack([fires(x, p) for p in paths], axis=1).astype(float) if paths else np.zeros((len(x), 0))
    w, intercept = fit_logistic(matrix, y, l1=lasso)
    kept = [i for i in range(len(paths)) if abs(w[i]) > 1e-4]
    return Rules(names, [paths[i] for i in kept], [float(w[i]) for i in kept], intercept)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          folds: int = FOLDS, fold_out: int = HELD_OUT, rows: int = SAMPLE_ROWS) -> Rules:
    """Rules from at most ``rows`` labelled ids outside the held-out fold."""
    picked = F.broadcast(training_labels(labels, id_col, label, folds, fold_out, rows))
    sample = docs.select(quoted(id_col).alias("id"), quoted(text).alias("t")).join(picked, "id")
    stats = statistics(F.col("t"))
    # Texts of one id may repeat; the order makes the bound take the same rows.
    taken = sample.select("y", F.xxhash64("id", "t").alias("o"), *[c.alias(n) for n, c in stats.items()])
    points = taken.orderBy("o").limit(rows).drop("o").collect()
    values = np.array([tuple(r) for r in points], dtype=float).reshape(-1, len(stats) + 1)
    return fit(list(stats), values[:, 1:], values[:, 0])


def _score(rules: Rules, text: str) -> Column:
    """The score over the statistics that the rules use.

    A filter on the score copies its expression, so the statistics stand in it once, as
    a struct that a function of one element is applied to.
    """
    stats = statistics(quoted(text))
    used = sorted({rules.names[f] for path in rules.paths for f, _, _ in path})
    if not used:
        return rules.score(stats)
    once = F.array(F.struct(*[stats[n].alias(n) for n in used]))
    return F.transform(once, lambda s: rules.score({n: s[n] for n in used}))[0]


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
           threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) for every row, repeated ones too; null texts count as empty."""
    rules = learn(docs, labels, id_col, text, label)
    return docs.select(
        quoted(id_col), held_out(id_col, FOLDS, HELD_OUT).alias("held_out"), _score(rules, text).alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
         threshold: float = THRESHOLD) -> DataFrame:
    """The rows scored at least ``threshold``, with their own columns; repeated rows stay or go together."""
    rules = learn(docs, labels, id_col, text, label)
    return docs.where(_score(rules, text) >= threshold)

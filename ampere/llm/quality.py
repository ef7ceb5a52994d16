"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted trees are grown on statistics of labelled documents; every path from
a root to a node is a conjunctive rule. A logistic regression with an L1
penalty picks and weighs the rules, and what is left is compiled into one
Spark column expression, so scoring is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.llm.labelled import fold, labelled_sample

#: At most this many labelled documents of either label are fitted on.
SAMPLE = 3000
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; null counts as empty, whose are all 0."""
    t = F.coalesce(text, F.lit(""))
    chars = F.char_length(t)
    per_char = lambda pattern: F.regexp_count(t, F.lit(pattern)) / F.greatest(chars, F.lit(1))
    words = F.filter(F.split(t, " "), lambda w: w != "")
    lines = F.split(t, "\n")
    n_words = F.size(words)
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "upper": per_char("[A-ZÀ-Þ]"),
        "symbol": per_char(r"[^\p{L}\p{N}\s.,;:'\"()-]"),
        "digit": per_char("[0-9]"),
        "stop": per_char(r"[.,;:]"),
        "word_length": chars / F.greatest(n_words, F.lit(1)),
        "distinct_words": F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "words_per_line": n_words / F.size(lines),
    }


#: A condition is (statistic, whether above, threshold); a rule is several.
Condition = tuple[int, bool, float]


@dataclass
class RuleModel:
    names: list[str]
    rules: list[tuple[Condition, ...]]
    weights: np.ndarray
    intercept: float

    def column(self, stats: dict[str, Column]) -> Column:
        """The probability of label 1 as a column expression."""
        z = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights):
            holds = None
            for f, above, t in rule:
                x = stats[self.names[f]]
                c = (x > F.lit(t)) if above else (x <= F.lit(t))
                holds = c if holds is None else holds & c
            z = z + F.when(holds, F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(_holds(x, self.rules) @ self.weights + self.intercept)))


def _holds(x: np.ndarray, rules: list[tuple[Condition, ...]]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, j] *= (x[:, f] > t) if above else (x[:, f] <= t)
    return out


def _grow(x: np.ndarray, g: np.ndarray, rows: np.ndarray, path: tuple[Condition, ...], depth: int, least: int, out: list) -> np.ndarray:
    """A least-squares tree on residuals ``g``; adds its paths to ``out`` and
    returns each row's fitted value."""
    fit = np.full(len(rows), g[rows].mean())
    if path:
        out.append(path)
    if not depth or len(rows) < 2 * least:
        return fit
    best = (1e-9, 0, 0.0)
    total, n = g[rows].sum(), len(rows)
    for f in range(x.shape[1]):
        order = np.argsort(x[rows, f], kind="stable")
        v, s = x[rows[order], f], np.cumsum(g[rows[order]])
        k = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (k >= least) & (n - k >= least)
        if not ok.any():
            continue
        gain = np.where(ok, s[:-1] ** 2 / k + (total - s[:-1]) ** 2 / (n - k) - total**2 / n, -1)
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (gain[i], f, float((v[i] + v[i + 1]) / 2))
    if best[0] <= 1e-9:
        return fit
    _, f, t = best
    for above in (False, True):
        side = (x[rows, f] > t) == above
        fit[side] = _grow(x, g, rows[side], (*path, (f, above, t)), depth - 1, least, out)
    return fit


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal steps."""
    n = len(y)
    step = 4.0 / (np.linalg.norm(a, 2) ** 2 / n + 1)
    w = v = np.zeros(a.shape[1])
    b = vb = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    t = 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(a @ v + vb))) - y
        u = v - step * (a.T @ r / n)
        w2 = np.sign(u) * np.maximum(np.abs(u) - step * penalty, 0)
        b2 = vb - step * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, penalty: float = 1e-3) -> RuleModel:
    """Fitted on one row per document. With one label only, the score is that
    label's smoothed share and no rule is used."""
    y = y.astype(np.float64)
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    if len(y) == 0 or y.min() == y.max():
        return RuleModel(names, [], np.zeros(0), prior)
    least = max(2, len(y) // 200)
    rules: list[tuple[Condition, ...]] = []
    z = np.full(len(y), prior)
    every = np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        z += 0.3 * _grow(x, y - p, every, (), depth, least, rules) / max((p * (1 - p)).mean(), 0.02)
    rules = list(dict.fromkeys(rules))
    a = _holds(x, rules)
    _, first = np.unique(a, axis=1, return_index=True)  # rules that agree on all rows are one
    rules, a = [rules[i] for i in sorted(first)], a[:, sorted(first)]
    w, b = _lasso(a, y, penalty)
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel(names, [rules[i] for i in keep], w[keep], b)


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> RuleModel:
    """Fit on at most ``most`` documents of either label, none held out."""
    stats = statistics(F.col("text"))
    rows = labelled_sample(docs, labels, "quality", most).select("label", *[c.cast("double").alias(n) for n, c in stats.items()]).toPandas()
    names = list(stats)
    return fit(rows[names].to_numpy(np.float64).reshape(-1, len(names)), rows["label"].to_numpy(), names)


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``(row, score)``: a struct of the columns of ``docs``, and the score."""
    stats = statistics(F.col("text"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    wide = docs.select(row, *[c.alias(n) for n, c in stats.items()])
    return wide.select("row", model.column({n: F.col(n) for n in stats}).alias("score"))


def op2_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts have statistics of zero and a score as any other;
    long texts count whole. A row is scored by its text alone, so ties and
    repeated rows score alike; a null doc_id is not held out. An empty table
    gives no rows; other columns are not read. Labels with a null id or value
    teach nothing.
    """
    model = train(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        "row.doc_id",
        F.coalesce(fold(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is at least the threshold, with all their
    columns; repeated rows, nulls and empty texts as in ``op2_quality``."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = scored(docs, model).where(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

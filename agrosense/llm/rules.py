r"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

1. Every whole text becomes a row of statistics by column expressions (one pass, stored).
2. On a bounded sample of labelled rows (``MAX_SAMPLE``, by hash of the id) small gradient
   boosted trees are grown; each path from a root to a node is a rule, a conjunction of
   thresholds. Rules and scaled statistics are the inputs of a logistic regression with
   lasso penalty; the penalty is the one with the smallest loss on a fifth of the sample.
3. What keeps a weight is compiled into one Spark column expression, the score.

Labels are learnt from rows whose crc32(doc_id) modulo 4 is not ``HELD_OUT``; label, lang,
source and doc_id are never inputs of a score.

Defined cases: null and empty texts have all-zero statistics and a score like any other row;
null labels are ignored, several labels of a document count by their mean; without labels of
both classes the score is the share of label 1 (0.5 without labels); an empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.llm.common import SPACE, stored

FOLDS, HELD_OUT, ACCEPT = 4, 2, 0.7          # fixed values of the contract
MAX_SAMPLE = 20_000                          # labelled rows on the driver, about 20 numbers each
TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.3
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)


# ---- statistics ------------------------------------------------------------------------------

def _count(text: Column, pattern: str) -> Column:
    """Characters that match a class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns plus the statistics of ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(*keep, text.alias("__t"), F.array_remove(F.split(text, SPACE), "").alias("__w"),
                    F.array_remove(F.split(text, "\n"), "").alias("__l"))
    d = d.select(
        *keep,
        F.length("__t").alias("chars"), F.size("__w").alias("words"), F.size("__l").alias("lines"),
        F.size(F.array_distinct("__w")).alias("kinds"),
        F.size(F.array_distinct("__l")).alias("line_kinds"),
        _count(F.col("__t"), r"[\x20\x09-\x0D]+").alias("spaces"),
        _count(F.col("__t"), r"\p{Lu}+").alias("upper"),
        _count(F.col("__t"), r"[0-9]+").alias("digits"),
        _count(F.col("__t"), r"[#*$%&<>~^=+]+").alias("symbols"),
        _count(F.col("__t"), r"[!?]+").alias("shouts"),
        _count(F.col("__t"), r"[|]+").alias("bars"),
        _count(F.col("__t"), r"[,;:.]+").alias("stops"),
        _count(F.col("__t"), r"[@/\\\[\]{}()_]+").alias("marks"),
        _count(F.col("__t"), r"[^\x00-\x7F]+").alias("foreign"))
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")
    return d.select(*keep, *[c.alias(n) for n, c in {
        "log_words": F.log1p(F.col("words").cast("double")),
        "word_length": (F.col("chars") - F.col("spaces")) / F.greatest("words", F.lit(1)),
        "words_per_line": F.log1p(per("words", "lines")),
        "kinds": per("kinds", "words"),
        "line_kinds": per("line_kinds", "lines"),
        "log_lines": F.log1p(F.col("lines").cast("double")),
        **{n: per(n, "chars") for n in ("upper", "digits", "symbols", "shouts", "bars", "stops",
                                        "marks", "foreign")},
    }.items()])


STATS = ("log_words", "word_length", "words_per_line", "kinds", "line_kinds", "log_lines",
         "upper", "digits", "symbols", "shouts", "bars", "stops", "marks", "foreign")


# ---- rules from trees ----------------------------------------------------------------------

def _grow(x, bins, grad, hess, rows, depth, path, rules, out):
    """Split ``rows`` greedily; appends the path of every node and adds leaf steps to ``out``."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = None
    if depth and len(rows) >= 20:
        for f in range(x.shape[1]):
            code = x[rows, f]
            hg = np.cumsum(np.bincount(code, grad[rows], len(bins[f]) + 1))[:-1]
            hh = np.cumsum(np.bincount(code, hess[rows], len(bins[f]) + 1))[:-1]
            if not len(hg):
                continue
            gain = hg ** 2 / (hh + 1) + (g - hg) ** 2 / (h - hh + 1) - g * g / (h + 1)
            gain[(hh < 2) | (h - hh < 2)] = -1
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k)
    if best is None:
        out[rows] += RATE * g / (h + 1)
        return
    _, f, k = best
    low = x[rows, f] <= k
    for side, part in ((True, rows[low]), (False, rows[~low])):
        step = path + ((f, float(bins[f][k]), side),)
        rules.setdefault(_merged(step), None)
        _grow(x, bins, grad, hess, part, depth - 1, step, rules, out)


def _merged(path):
    """A path as a rule: per statistic only its tightest bounds, in fixed order."""
    bounds = {}
    for f, cut, low in path:
        lo, hi = bounds.get(f, (-np.inf, np.inf))
        bounds[f] = (lo, min(hi, cut)) if low else (max(lo, cut), hi)
    return tuple((f, *bounds[f]) for f in sorted(bounds))


def tree_rules(values: np.ndarray, label: np.ndarray, seed: int = 7) -> list:
    """Conjunctive rules ``((stat, low, high), ...)``, meaning low < value <= high."""
    rng = np.random.default_rng(seed)
    bins = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
            for f in range(values.shape[1])]
    x = np.stack([np.searchsorted(bins[f], values[:, f], side="left")
                  for f in range(values.shape[1])], axis=1)
    rules: dict = {}
    base = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(label), np.log(base / (1 - base)))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(label)) < 0.6)
        step = np.zeros(len(label))
        _grow(x, bins, label - p, p * (1 - p), rows, DEPTH, (), rules, step)
        margin += step
    return list(rules)


def rule_matrix(values: np.ndarray, rules: list) -> np.ndarray:
    out = np.ones((len(values), len(rules)))
    for r, rule in enumerate(rules):
        for f, low, high in rule:
            out[:, r] *= (values[:, f] > low) & (values[:, f] <= high)
    return out


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, w, b, steps: int = 300):
    """Logistic regression with lasso penalty by accelerated proximal gradient steps."""
    rate = 4.0 * len(y) / (np.linalg.norm(z, 2) ** 2 + len(y))
    u, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ u + c))) - y
        v = u - rate * (z.T @ r) / len(y)
        w2, b2 = np.sign(v) * np.maximum(np.abs(v) - rate * penalty, 0), c - rate * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        moved = np.abs(w2 - w).max(initial=0)
        w, b, t = w2, b2, t2
        if moved < 1e-6:
            break
    return w, b


def fit_rules(values: np.ndarray, label: np.ndarray) -> dict:
    """A model: ``intercept``, ``rules`` [(weight, rule)], ``linear`` [(weight, stat, low, high)]."""
    if len(label) == 0 or label.min() == label.max():
        share = np.clip((label.sum() + 1) / (len(label) + 2), 1e-3, 1 - 1e-3)
        return {"intercept": float(np.log(share / (1 - share))), "rules": [], "linear": []}
    rules = tree_rules(values, label)
    low, high = np.quantile(values, 0.025, axis=0), np.quantile(values, 0.975, axis=0)
    flat = np.clip(values, low, high)
    scale = flat.std(axis=0)
    scale[scale < 1e-9] = np.inf                      # a constant statistic has no linear term
    z = np.hstack([rule_matrix(values, rules), 0.4 * (flat - flat.mean(axis=0)) / scale])
    check = np.arange(len(label)) % 5 == 4
    if len(np.unique(label[~check])) < 2 or not check.any():
        check[:] = False
    w, b, best = np.zeros(z.shape[1]), 0.0, None
    for penalty in PENALTIES:
        w, b = _lasso(z[~check], label[~check], penalty, w, b)
        rows = check if check.any() else ~check
        m = z[rows] @ w + b
        loss = np.mean(np.logaddexp(0, m) - label[rows] * m)
        if best is None or loss < best[0] - 1e-4:
            best = (loss, penalty, w, b)
    w, b = _lasso(z, label, best[1], best[2], best[3])
    n = len(rules)
    lin = 0.4 * w[n:] / scale
    intercept = b - float((lin * flat.mean(axis=0))[np.isfinite(scale)].sum())
    return {"intercept": intercept,
            "rules": [(float(a), r) for a, r in zip(w[:n], rules) if abs(a) > 1e-6],
            "linear": [(float(a), f, float(low[f]), float(high[f])) for f, a in enumerate(lin)
                       if abs(a) > 1e-9]}


def compiled(model: dict) -> Column:
    """The model's score as a column expression over the statistics."""
    margin = F.lit(model["intercept"])
    for weight, rule in model["rules"]:
        holds = F.lit(True)
        for f, low, high in rule:
            if np.isfinite(low):
                holds = holds & (F.col(STATS[f]) > F.lit(float(low)))
            if np.isfinite(high):
                holds = holds & (F.col(STATS[f]) <= F.lit(float(high)))
        margin = margin + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    for weight, f, low, high in model["linear"]:
        margin = margin + F.lit(weight) * F.least(F.greatest(F.col(STATS[f]), F.lit(low)), F.lit(high))
    return 1 / (1 + F.exp(-margin))


# ---- on tables --------------------------------------------------------------------------------

def fold(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % FOLDS


def labelled_sample(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` that are labelled and outside the held-out fold, with their label ``__y``; of
    more than ``MAX_SAMPLE`` a share of about so many, chosen by a hash of the whole row."""
    known = (labels.where(F.col("quality").isNotNull()).groupBy("doc_id")
             .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("double").alias("__y")))
    usable = rows.where(fold(F.col("doc_id")) != HELD_OUT).join(known, "doc_id")
    n = usable.count()
    if n <= MAX_SAMPLE:
        return usable
    drawn = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 31))
    return usable.where(drawn < int(MAX_SAMPLE / n * (1 << 31)))


def train(sample: DataFrame) -> dict:
    """Fit on the statistics and labels of a ``labelled_sample``. Its order decides nothing but
    rounding, and is fixed; the limit only matters where one row is repeated very often."""
    rows = (sample.orderBy(F.xxhash64("doc_id"), "doc_id", *STATS).limit(MAX_SAMPLE)
            .select(*STATS, F.col("__y").alias("y")).toPandas())
    values = rows[list(STATS)].to_numpy(dtype=float).reshape(-1, len(STATS))
    return fit_rules(values, rows["y"].to_numpy(dtype=float))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    stats = stored(with_statistics(docs, "doc_id"), "quality-statistics")
    score = compiled(train(labelled_sample(stats, labels)))
    return stats.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
                        score.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int"))


def accept_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts; columns unchanged."""
    # the statistics of all rows are only needed once, below
    sample = labelled_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels)
    stats = stored(with_statistics(sample, "doc_id", "__y"), "quality-statistics")
    score = compiled(train(stats))
    taken = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(c).alias(n) for c, n in taken.items()],
                        F.col("text").alias("text"))
    rated = with_statistics(named, *taken.values())
    # explode keeps the filter above the statistics: pushed below them it would repeat every
    # pattern for every rule that uses it
    rated = rated.select(*taken.values(), F.explode(F.array(score)).alias("__score"))
    return rated.where(F.col("__score") >= ACCEPT).select(
        *[F.col(n).alias(c) for c, n in taken.items()])

r"""Quality rules with robust multivariate outlier rejection.

Each text gets plain counts (words, characters, symbols, repeated lines, words in repeated
three-word windows) and two fixed base rules. The documents that pass them are described by
five transformed statistics. Per language and source a minimum-covariance-determinant
estimate of centre and scatter is fitted by concentration steps: from starts at the three
quartiles (scaled by the median absolute deviations), the mean and covariance of the
``SUBSET`` share of rows with the smallest distance are taken, distances computed anew, and
so on until the determinant stops falling; the start with the smallest determinant is used. A
document is rejected when its squared Mahalanobis distance exceeds the ``CUTOFF`` quantile of
the chi-squared distribution with five degrees of freedom (20.5).

Everything is aggregates over one stored table of numbers: medians and subset cuts are
quantile sketches (rank error 1/10000), moments are algebraic, so a language or source with
a third of all rows is pre-aggregated like any other. Groups with fewer than ``MIN_GROUP``
rows are fitted together per language, what is still too small over all languages; if even
that is too small it is judged by the estimate over all rows of the table. The cutoff allows for
an estimate from few rows: it is the quantile of a new row's distance from the mean of the
subset's ``h`` rows, ``p (h^2 - 1) / (h (h - p))`` times that of F with p and h - p degrees, which
falls to the chi-squared quantile as h grows; h <= p rows estimate no scatter and reject nothing. A statistic whose deviation in the subset is
below ``FLOOR`` (no symbols at all, say) gets that one; other variances stay as estimated. The
floors are where a constant statistic alone rejects: 2.2% symbols, 9% repeated lines or words.

Defined cases: null text has no words; null languages or sources are groups of their own;
an empty table gives an empty result; equal rows get equal results. Other columns of the
input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrosense.llm.common import SPACE, bounded, stored

SYMBOLS = "#*$%&|<>"                                # fixed value of the contract
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50              # fixed values of the contract
STATS = ("s_words", "s_length", "s_symbols", "s_lines", "s_repeat")
FLOOR = {"s_words": 0.1, "s_length": 0.02, "s_symbols": 0.25, "s_lines": 0.5, "s_repeat": 0.5}
SUBSET, CUTOFF, MIN_GROUP = 0.75, 0.999, 200
STARTS, LEAST_FALL = (0.25, 0.5, 0.75), 1e-3        # quantiles to start from; a smaller fall ends it


# ---- chi-squared distribution (even and odd degrees of freedom) -----------------------------

def chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function by its power series."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 1
    while term > total * 1e-16:
        term *= z / (a + n)
        total += term
        n += 1
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 10.0 * k + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


def f_quantile(p: float, k: int, m: int) -> float:
    """Quantile of F with ``k`` and ``m`` degrees, from the incomplete beta function."""
    a, b = k / 2, m / 2
    norm = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))

    def beta_cdf(x):
        # power series of the incomplete beta function, on the side where it converges fast
        def series(x, a, b):
            term = total = 1 / a
            n = 0
            while term > total * 1e-16:
                term *= x * (a + b + n) / (a + 1 + n)
                total += term
                n += 1
            return norm * math.exp(a * math.log(x) + b * math.log1p(-x)) * total
        return series(x, a, b) if x < (a + 1) / (a + b + 2) else 1 - series(1 - x, b, a)

    low, high = 0.0, 1.0                              # of k f / (k f + m)
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if beta_cdf(mid) < p else (low, mid)
    return m * low / (k * (1 - low))


def cutoff(n: int) -> float:
    """Largest squared distance kept, of an estimate from ``n`` rows."""
    p, h = len(STATS), int(SUBSET * n)
    if h <= p:
        return float("inf")
    return p * (h * h - 1) / (h * (h - p)) * f_quantile(CUTOFF, p, h - p)


# ---- counts --------------------------------------------------------------------------------

def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns plus ``n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words`` of the column ``text``. Each step is its own projection, so that no
    array is built twice."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(*keep, text.alias("__t"),
                    F.array_remove(F.split(text, SPACE), "").alias("__w"),
                    F.filter(F.split(text, "\n"),
                             lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    triple = F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(
        F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    d = d.select(*keep, F.size("__w").alias("n_words"),
                 F.length(F.regexp_replace("__t", SPACE, "")).alias("word_chars"),
                 (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).alias("n_symbols"),
                 F.size("__l").alias("n_lines"),
                 (F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
                 F.when(F.size("__w") >= 3, triple).otherwise(F.array().cast("array<long>")).alias("__h"))
    numbered = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct("__h")) < F.size("__h")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    d = d.select(*keep, *counts, F.when(repeated, numbered).otherwise(none).alias("__s"))
    twice = F.filter("__s", lambda x, i: (x["h"] == F.get("__s", i + 1)["h"])
                     | ((i > 0) & (x["h"] == F.get("__s", F.greatest(i - 1, F.lit(0)))["h"])))
    d = d.select(*keep, *counts, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("__p"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    covered = F.aggregate("__p", zero, lambda acc, at: F.struct(
        (acc["n"] + at + 3 - F.greatest(acc["stop"], at)).alias("n"), (at + 3).alias("stop")),
        lambda acc: acc["n"])
    return d.select(*keep, *[F.col(c).cast("long").alias(c) for c in counts],
                    covered.cast("long").alias("n_repeat_words"))


def statistics() -> dict[str, Column]:
    """The transformed statistics of a row that has the counts."""
    share = lambda a, b: F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return {"s_words": F.log1p(F.col("n_words").cast("double")),
            "s_length": F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
            "s_symbols": share("n_symbols", "word_chars"),
            "s_lines": share("n_dup_lines", "n_lines"),
            "s_repeat": share("n_repeat_words", "n_words")}


# ---- minimum covariance determinant ----------------------------------------------------------

GROUP = ("g_lang", "g_source")
REST = "\x00rest"


def _same_group(left: str, right: str) -> Column:
    on = F.lit(True)
    for c in GROUP:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (lang, source, ...) with the group each is fitted in."""
    n = (rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
         .withColumn("g_source", F.when(F.col("n") >= MIN_GROUP, F.col("source")).otherwise(F.lit(REST))))
    of_rest = Window.partitionBy("lang", "g_source")
    n = (n.withColumn("rest", F.sum("n").over(of_rest))
         .withColumn("g_lang", F.when(F.col("rest") >= MIN_GROUP, F.col("lang")).otherwise(F.lit(REST))))
    groups = bounded(stored(n.select("lang", "source", *GROUP), "outlier-groups"))
    return (rows.alias("r").join(groups.alias("g"), F.col("r.lang").eqNullSafe(F.col("g.lang"))
                                 & F.col("r.source").eqNullSafe(F.col("g.source")))
            .select("r.*", *[f"g.{c}" for c in GROUP]))


def _start(rows: DataFrame) -> DataFrame:
    """Per group and start: quantiles as centre, a diagonal factor from the median deviations."""
    mid = rows.groupBy(*GROUP).agg(*[F.percentile_approx(s, list(STARTS)).alias(f"q_{s}") for s in STATS])
    mid = bounded(stored(mid, "outlier-quantiles"))
    median = STARTS.index(0.5)
    away = rows.alias("r").join(mid.alias("p"), _same_group("r", "p")).select(
        *[f"r.{c}" for c in GROUP], *[F.abs(F.col(s) - F.col(f"q_{s}")[median]).alias(s) for s in STATS])
    mad = away.groupBy(*GROUP).agg(*[F.percentile_approx(s, 0.5).alias(s) for s in STATS])
    scale = [F.greatest(1.4826 * F.col(f"a.{s}"), F.lit(FLOOR[s])).alias(f"l_{i}_{i}")
             for i, s in enumerate(STATS)]
    zeros = [F.lit(0.0).alias(f"l_{i}_{j}") for i in range(len(STATS)) for j in range(i)]
    starts = F.explode(F.sequence(F.lit(0), F.lit(len(STARTS) - 1)))
    return (mad.alias("a").join(mid.alias("p"), _same_group("a", "p"))
            .select(*[f"a.{c}" for c in GROUP], *[f"q_{s}" for s in STATS], *scale, *zeros,
                    F.lit(float("inf")).alias("det"), starts.alias("start"))
            .withColumns({f"m_{s}": F.get(f"q_{s}", "start") for s in STATS})
            .drop(*[f"q_{s}" for s in STATS]))


def _distance(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2``, by forward substitution with the
    Cholesky factor of the group's scatter."""
    d = rows.alias("r").join(fit.alias("p"), _same_group("r", "p"), "left").select(
        "r.*", *[c for c in fit.columns if c not in GROUP])
    for i, s in enumerate(STATS):
        rest = F.col(s) - F.col(f"m_{s}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * F.col(f"z_{j}")
        d = d.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, len(STATS))),
             F.col("z_0") * F.col("z_0"))
    return d.select(*rows.columns, *["start"] * ("start" in fit.columns), d2.alias("d2"))


def _concentrate(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """One concentration step: moments of each fit's ``SUBSET`` nearest rows, factored."""
    one = (*GROUP, "start")
    near = _distance(rows, fit).where("start is not null")      # groups whose fits have all settled
    cut = near.groupBy(*one).agg(F.percentile_approx("d2", SUBSET).alias("cut"))
    cut = bounded(stored(cut, "outlier-cuts"))
    inside = near.alias("r").join(cut.alias("p"), _same_group("r", "p") & (
        F.col("r.start") == F.col("p.start"))).where("d2 <= cut")
    p = len(STATS)
    consistency = SUBSET / chi2_cdf(chi2_quantile(SUBSET, p), p + 2)
    moments = inside.groupBy(*[F.col(f"r.{c}").alias(c) for c in one]).agg(
        *[F.avg(s).alias(f"m_{s}") for s in STATS],
        *[F.covar_pop(STATS[i], STATS[j]).alias(f"c_{i}_{j}") for i in range(p) for j in range(i + 1)])
    m = moments
    for i in range(p):
        floor = FLOOR[STATS[i]] ** 2
        for j in range(i + 1):
            value = consistency * F.col(f"c_{i}_{j}")
            if i == j:
                value = F.greatest(value, F.lit(floor))
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            m = m.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(value, F.lit(floor / 100))) if i == j
                             else value / F.col(f"l_{j}_{j}"))
    det = F.lit(1.0)
    for i in range(p):
        det = det * F.col(f"l_{i}_{i}") * F.col(f"l_{i}_{i}")
    return m.withColumn("det", det).select(*fit.columns)


def robust_fit(rows: DataFrame) -> DataFrame:
    """Centre and Cholesky factor per group of ``rows`` (group columns and statistics): of all
    starts, each run until its determinant stops falling, the one with the smallest."""
    fit = bounded(stored(_start(rows), "outlier-fit"))
    settled = []
    while fit.limit(1).count():
        new = stored(_concentrate(rows, fit), "outlier-fit")
        both = fit.alias("o").join(new.alias("w"), _same_group("o", "w") & (
            F.col("o.start") == F.col("w.start")))
        falls = F.col("w.det") < F.col("o.det") * (1 - LEAST_FALL)
        settled.append(stored(both.where(~falls).select("o.*"), "outlier-settled"))
        fit = bounded(stored(both.where(falls).select("w.*"), "outlier-fit"))
    if not settled:                                             # no row at all
        return fit.drop("start", "det")
    every = settled[0]
    for s in settled[1:]:
        every = every.unionAll(s)
    best = every.groupBy(*GROUP).agg(F.min_by(F.struct(*every.columns), F.struct("det", "start")).alias("f"))
    return bounded(stored(best.select("f.*").drop("start", "det"), "outlier-fit"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, base rules, squared distance and verdict of every document."""
    counts = stored(text_counts(docs.withColumn("lang", F.col("lang").cast("string"))
                                .withColumn("source", F.col("source").cast("string")),
                                "doc_id", "lang", "source"), "outlier-counts")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rated = counts.withColumn("base_failed", failed).withColumns(statistics())
    passed = rated.where(~F.col("base_failed"))
    grouped = stored(_grouped(passed), "outlier-rows")
    sizes = bounded(stored(grouped.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")), "outlier-sizes"))
    few = (F.col("n") < MIN_GROUP) & (F.col("g_lang") == REST) & (F.col("g_source") == REST)
    if sizes.where(few).limit(1).count():            # the last pool is too small: fit it on all rows
        others = grouped.where(~(F.col("g_lang").eqNullSafe(REST) & F.col("g_source").eqNullSafe(REST)))
        fit = robust_fit(grouped.unionByName(others.withColumns({c: F.lit(REST) for c in GROUP})))
        total = sizes.agg(F.sum("n")).first()[0]
    else:
        fit, total = robust_fit(grouped), MIN_GROUP
    of_few = cutoff(total)                           # of all rows, if they are the estimate
    large = F.lit(chi2_quantile(CUTOFF, len(STATS)))
    judged = (_distance(grouped, fit).alias("r").join(sizes.alias("e"), _same_group("r", "e"))
              .withColumn("kept", F.col("d2") <= F.when(F.col("n") < MIN_GROUP, F.lit(of_few)).otherwise(large)))
    counts_out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return (judged.select(*[f"r.{c}" for c in counts_out], F.lit(False).alias("base_failed"),
                          "kept", "d2")
            .unionByName(rated.where("base_failed").select(
                *counts_out, "base_failed", F.lit(False).alias("kept"),
                F.lit(None).cast("double").alias("d2"))))

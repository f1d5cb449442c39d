"""Mixing sources to target weights by hash thresholds, without sorting the documents.

Every document has a 60-bit hash of its id and text. A source whose target is ``q`` whole passes plus
a rest takes each of its documents ``q`` times, and once more those whose hash is below the
source's threshold. The threshold comes from nested histograms: the words of a source by the
top 12 bits of the hash show in which bucket the running sum crosses the rest; only the
documents of that boundary bucket are counted again by the next 12 bits, and so on to the
full hash. The final step is a filter against one threshold per source. Rows at the threshold
itself are equal rows (or, hardly ever, share a hash): as many of them are taken as come nearest
to the target, numbered by partition and position, each partition for itself.

Targets: the sources in code-point order (null last) weigh 5, 2, 1, repeating, and share all
words of the corpus; a target stops at 3 times its source's size and the excess is shared
again by weight. That has one solution: a common level ``words per weight`` for all sources
below their cap, found by one pass over the sources ordered by cap per weight.

Defined cases: null text has size 0; a null source is a source of its own; texts under one id
(or none) are chosen one by one, and of equal rows some may be taken once more than others (which
of them makes no difference); a source without words has target 0; an
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrosense.llm.common import BROADCAST_ROWS, WORD, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
HASH_BITS, LEVEL_BITS = 60, 12


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` for each source of ``sizes`` (source, size)."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")     # one row per source
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("at", (F.row_number().over(by_name) - 1) % len(WEIGHTS))
         .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("at") + 1)
                     .cast("double"))
         .withColumn("cap", (F.col("source_size") * MAX_EPOCHS).cast("double"))
         .withColumn("cap_level", F.col("cap") / F.col("weight")))
    by_cap = Window.orderBy("cap_level", F.col("source").isNull(), "source")
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("capped", F.coalesce(F.sum("cap").over(
             by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("open_weight", F.sum("weight").over(
             by_cap.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
         # the first source, in this order, whose cap is not below the level sets the level
         .withColumn("level", F.min(F.when(F.col("cap_level") >= F.col("level"),
                                           F.struct("cap_level", "level"))).over(everything)["level"]))
    return s.select("source", "source_size",
                    F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _sized(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, source, size, h`` and the columns ``more`` of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\x01"), text)
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long").alias("h"), *more)


def _cuts(sized: DataFrame):
    """What to take of each source of the stored ``sized``, and whether it may be broadcast."""
    targets = (source_targets(sized)
               .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(
                   F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
               .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))
    targets = stored(targets, "mix-targets")
    # every table below has at most one row per source: broadcast if a count allows it
    small = F.broadcast if targets.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else _as_is
    return _thresholds(sized, targets, small)


def _copies(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` (with ``source, size, h``) and ``source_size, target, copies``."""
    told = rows.alias("d").join(cut.withColumnRenamed("source", "__source").alias("t"),
                                F.col("d.source").eqNullSafe(F.col("t.__source"))).drop("__source")
    at_cut = F.col("h") == F.col("cut_h")
    out = [*rows.columns, "source_size", "target", "copies"]
    plain = told.where(~at_cut).withColumn("copies", F.col("passes") + (F.col("h") < F.col("cut_h")).cast("long"))
    tied = stored(told.where(at_cut).withColumn("__at", F.monotonically_increasing_id()), "mix-tied")
    part = F.shiftright("__at", 33)                  # the partition that the row was read in
    per_part = tied.groupBy("source", part.alias("__part")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__words"))
    upto = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select(F.col("source").alias("__source"), "__part",
                               F.coalesce(F.sum("__words").over(upto), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("source", "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    placed = tied.withColumn("__part", part).withColumn(
        "__own", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("d").join(
        per_part.withColumnRenamed("__part", "__p").alias("t"),
        F.col("d.source").eqNullSafe(F.col("t.__source")) & (F.col("__part") == F.col("__p")))
    reached = F.col("before") + F.col("__base") + F.col("__own")
    # a row is taken if that brings the sum nearer to the rest
    placed = placed.withColumn("copies", F.col("passes") + (
        2 * reached + F.col("size") <= 2 * F.col("rest")).cast("long"))
    return plain.select(*out).unionAll(placed.select(*out))


def mix_sources(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every document."""
    sized = stored(_sized(docs), "mix-sizes")
    return _copies(sized, _cuts(sized)).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _thresholds(sized: DataFrame, targets: DataFrame, small) -> DataFrame:
    """Targets plus ``cut_h, before``: hashes below ``cut_h``, with ``before`` words, are taken
    once more, and rows at it while that brings the sum nearer to the rest."""
    edge = targets.select("source", "rest", F.lit(0).cast("long").alias("before"),
                        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("words"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = (sized.alias("d")
                  .join(small(edge).alias("e"),
                        F.col("d.source").eqNullSafe(F.col("e.source"))
                        & (F.shiftright("d.h", shift + LEVEL_BITS) == F.col("e.prefix")))
                  .groupBy(F.col("e.source").alias("source"),
                           F.shiftright("d.h", shift).alias("prefix"))
                  .agg(F.sum("d.size").alias("words"), F.first("e.rest").alias("rest"),
                       F.first("e.before").alias("base")))
        run = (Window.partitionBy("source").orderBy("prefix")
               .rowsBetween(Window.unboundedPreceding, -1))
        pick = Window.partitionBy("source").orderBy("prefix")
        edge = (inside
                .withColumn("before", F.col("base") + F.coalesce(F.sum("words").over(run), F.lit(0)))
                .where((F.col("before") < F.col("rest"))
                       & (F.col("before") + F.col("words") >= F.col("rest")))
                .withColumn("n", F.row_number().over(pick)).where("n = 1")
                .select("source", "rest", "before", "prefix", "words"))
    edge = small(stored(edge, "mix-cuts"))
    e = edge.select(F.col("source").alias("e_source"), "prefix", "before")
    out = (targets.join(e, F.col("source").eqNullSafe(F.col("e_source")), "left")
           .select("source", "source_size", "target", "passes", "rest", F.coalesce("before", F.lit(0)).alias("before"),
                   # no boundary bucket: nothing (rest 0) or, by rounding, everything is taken
                   F.coalesce("prefix", F.when(F.col("rest") > 0, F.lit((1 << HASH_BITS)))
                              .otherwise(F.lit(-1))).alias("cut_h")))
    return small(out)


def apply_mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it (0 to 3 times)."""
    cut = _cuts(stored(_sized(docs), "mix-sizes"))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    mixed = _copies(_sized(docs.withColumn("__row", row), "__row"), cut).where("copies > 0")
    return (mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("__row.*"))

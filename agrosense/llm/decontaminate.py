r"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are runs of ASCII digits and letters (A-Z lower-cased) and of all non-ASCII characters.
Every window of ``n`` consecutive words of a benchmark item (a shorter item is one window)
goes into a table keyed by its hash. Only the 8-byte hashes are broadcast, in several shares
of ``BROADCAST_HASHES`` if there are more. The documents' windows of the same lengths are
generated row by row inside one stage and looked up in the broadcast hashes; the hits, each
with its own words only, are verified word by word in a join with the windows. A document
word inside any verified window is hit.

Defined cases: null and empty texts have no words and no hits; null-text or empty items give
no window; equal windows of several items count for each item; rows are told apart by
(doc_id, text), so repeated rows get equal results; empty tables give empty results. Other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.llm.common import ascii_lower, bounded, row_key, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAM = 10
BROADCAST_HASHES = 1_000_000          # 8-byte hashes in one broadcast: some tens of MB as a hash table


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def benchmark_windows(benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """``h, len, win, items``: one row per distinct window with the ids of its items."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"),
                              words_of(F.col("text").cast("string")).alias("words"))
             .where(F.size("words") > 0)
             .withColumn("len", F.least(F.lit(n), F.size("words"))))
    wins = items.select("item", "len", "words", F.explode(
        F.sequence(F.lit(0), F.size("words") - F.col("len"))).alias("at"))
    wins = wins.select("item", "len", F.slice("words", F.col("at") + 1, F.col("len")).alias("win"))
    return (wins.groupBy("len", "win").agg(F.array_sort(F.collect_set("item")).alias("items"))
            .withColumn("h", F.xxhash64("win")))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """``k, at, len, items``: every verified window occurrence; ``k`` is the row's key."""
    spark = docs.sparkSession
    table = stored(benchmark_windows(benchmark, n), "test-ngrams")
    lengths = [r[0] for r in table.select("len").distinct().orderBy("len").collect()]  # at most n
    words = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("k"),
                        words_of(F.col("text").cast("string")).alias("words"))
    found = None
    for size in lengths:
        # explode_outer: no filter on the array is inferred below, where it would split the
        # text again; the null row of a short text matches no window
        starts = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))
        windows = (words.select("k", "words", F.explode_outer(starts).alias("at"))
                   .withColumn("h", F.xxhash64(F.slice("words", F.col("at") + 1, size))))
        # from here on a row carries its own few words, never the document's
        cut = F.slice("words", F.col("at") + 1, size).alias("cut")
        for hashes in _hash_chunks(table.where(F.col("len") == size)):
            some = windows.join(F.broadcast(hashes), "h", "left_semi").select("k", "at", "h", cut)
            found = some if found is None else found.unionAll(some)
    if found is None:
        return spark.createDataFrame([], "k long, at int, len int, items array<string>")
    found = stored(found, "test-candidates")
    # (h, cut) decides: hash collisions go here, and the length is that of the window
    same = (F.col("f.h") == F.col("t.h")) & (F.col("cut") == F.col("win"))
    return found.alias("f").join(bounded(table).alias("t"), same).select("k", "at", "len", "items")


def _hash_chunks(table: DataFrame) -> list[DataFrame]:
    """The distinct hashes of ``table``, 8 bytes each, in shares small enough to broadcast:
    at most about ``BROADCAST_HASHES`` each, dealt by the hash, which is uniform."""
    n = table.count()
    shares = -(-n // BROADCAST_HASHES)
    hashes = table.select("h").distinct()
    return [hashes.where(F.pmod("h", F.lit(shares)) == i) if shares > 1 else hashes
            for i in range(shares)]


def _hit_words(occurrences: Column) -> Column:
    """Number of word positions inside any of the sorted ``(at, len)`` windows."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))

    def step(acc, x):
        stop = x["at"] + x["len"]
        new = F.greatest(F.lit(0), stop - F.greatest(acc["stop"], x["at"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["stop"], stop).alias("stop"))
    return F.aggregate(F.array_sort(occurrences), zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    by_doc = (hits(docs, benchmark, n).groupBy("k")
              .agg(F.collect_set(F.struct("at", "len")).alias("windows"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"))
              .select("k", _hit_words(F.col("windows")).cast("long").alias("n_hit"), "ids"))
    no_ids = F.array().cast("array<string>")
    counted = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("k"),
                          F.size(words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))))
                          .cast("long").alias("n_words"))
    out = counted.join(stored(by_doc, "contaminated"), "k", "left")
    ids = F.coalesce("ids", no_ids)
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """``docs`` without the rows that hold any benchmark window; columns unchanged."""
    found = stored(hits(docs, benchmark, n).select(F.col("k").alias("__k")).distinct(),
                   "contaminated")
    keyed = docs.withColumn("__k", row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(found, "__k", "left_anti").select(*docs.columns)

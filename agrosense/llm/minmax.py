r"""Near-duplicates by min-max hashing, confirmed on full shingle sets.

A document's set are its distinct ``width``-word shingles (A-Z lower-cased). Each of ``PERMS``
permutations gives two signature values, the smallest and the largest hash, so half the hash
evaluations yield the same signature length. ``BANDS`` bands of ``ROWS`` values are the
buckets; at the threshold of 0.85 a pair shares no bucket with a chance of 3 in 10**7.

1. One pass over the texts gives set size, a 128-bit digest of the set, the band keys and one
   byte of each signature value. Documents with equal sets are one class; only one row of each
   class goes on, so copies never meet as pairs.
2. In every bucket one member is the pivot (another one in each band). Members are paired
   with their pivots; all pairs whose sizes can reach the threshold are confirmed on full
   sets. Links give components.
3. Links that no pivot showed can only join different components of a bucket. The members
   outside the bucket's largest component meet all members, block against block inside tasks,
   skipping pairs of one component, each pair only in the first band it shares; what sizes and
   signature admit (a pair at 0.85 fails with a chance below 10**-7) is confirmed on full
   sets. The components of all links are the result.

Sets are built only for documents in such pairs: a bit map of their keys, of fixed size, says in
the pass over the texts which, so texts are not shuffled for it. They travel once per block of
pairs, not once per pair. Nothing is capped: large buckets are split into more blocks, bounded by the number
of documents and by the bytes of their sets.

Rows are told apart by a 64-bit key of (doc_id, text), so rows with a null id and different
texts under one id are documents like any other. The row kept of a group is the one with the
smallest id (null ids last), then the smallest key.

Defined cases: null texts and texts without words have an empty set, are linked with nothing
and are their own component; fewer words than ``width`` are one shingle; rows that repeat an
id with its text agree; a null id never names a component (it gets the smallest id of its
group, or null), so ``component_id`` of two groups can be the same where an id or null has
several texts, and ``kept`` is true once in each; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.llm import common
from agrosense.llm import prefix_hash as ph
from agrosense.llm.common import (arrow_bytes, arrow_rows, bit_map, bounded, in_bit_map, row_key, scratch, ship, stored,
                                  with_map_hits)
from agrosense.llm.components import components
from agrosense.session import fresh_path

ship(__name__)
ship(ph.__name__)
ship(common.__name__)

PERMS, ROWS, BANDS = 96, 6, 32                # 2 * PERMS = ROWS * BANDS signature values
THRESHOLD = (85, 100)                         # 100 * intersection >= 85 * union
SIGMAS = 6.5
BLOCK = 512                                   # documents on each side of a block of pairs
BLOCK_BYTES = 2 << 20                         # bytes of their sets
BATCH_SETS = 256                              # sets in one Arrow batch
PIECE_BYTES = 1 << 18                         # texts are hashed in pieces of about this size
MAP_BITS = 24                                 # bits of the map of wanted rows

_RNG = np.random.default_rng(1729)
PERM_MUL = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PERM_ADD = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64)
BAND_SALT = ph.mix64(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32))


# ---- sets and signatures, in tasks -----------------------------------------------------------

def shingle_sets(data: np.ndarray, edges: np.ndarray, width: int):
    """Sorted distinct shingle hashes of each text, flat, and their ``n + 1`` offsets."""
    n_docs = len(edges) - 1
    start, stop = ph.words(data, edges)
    h = ph.mix64(ph.span_hash(ph.prefix_sums(data, ph.LOWERED_VALUES), start, stop)
                 + (stop - start).astype(np.uint64))
    doc = np.searchsorted(edges, start, side="right") - 1
    per_doc = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(per_doc)[:-1]]).astype(np.int64)
    sh = h.copy()
    for k in range(1, width):
        nxt = np.zeros_like(h)
        nxt[:len(h) - k if k < len(h) else 0] = h[k:]
        sh = ph.mix64(sh * np.uint64(0x9E3779B97F4A7C15) + nxt)
    left = per_doc[doc] - (np.arange(len(h)) - first[doc]) if len(h) else np.zeros(0, np.int64)
    whole = left >= width
    out, out_doc = [sh[whole]], [doc[whole]]
    short = np.flatnonzero((per_doc > 0) & (per_doc < width))
    if len(short):
        one = np.array([np.uint64(per_doc[d]) for d in short], dtype=np.uint64)
        for k in range(width - 1):
            has = per_doc[short] > k
            one[has] = ph.mix64(one[has] * np.uint64(0xD6E8FEB86659FD93) + h[first[short[has]] + k])
        out.append(one)
        out_doc.append(short)
    sh, doc = np.concatenate(out), np.concatenate(out_doc)
    order = np.lexsort((sh, doc))
    sh, doc = sh[order], doc[order]
    new = np.ones(len(sh), dtype=bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    sh, doc = sh[new], doc[new]
    return sh, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))]).astype(np.int64)


def signatures(sets: np.ndarray, offsets: np.ndarray):
    """Set digests, band keys and signature bytes of the non-empty sets of a batch."""
    full = np.flatnonzero(np.diff(offsets))
    at = offsets[full]
    k1 = np.add.reduceat(ph.mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), at)
    k2 = np.add.reduceat(ph.mix64(sets + np.uint64(0x14057B7EF767814F)), at)
    sig = np.empty((len(full), 2 * PERMS), dtype=np.uint64)
    for p in range(PERMS):
        v = sets * PERM_MUL[p] + PERM_ADD[p]
        v ^= v >> np.uint64(32)
        v *= PERM_MUL[PERMS - 1 - p]
        sig[:, 2 * p] = np.minimum.reduceat(v, at)
        sig[:, 2 * p + 1] = np.maximum.reduceat(v, at)
    bands = np.repeat(BAND_SALT[None, :], len(full), axis=0)
    for r in range(ROWS):
        bands = ph.mix64(bands * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
    low = (ph.mix64(sig) >> np.uint64(40)).astype(np.uint8)
    return full, k1, k2, bands, low


def _no_set_rows(n):
    return np.zeros(n, dtype=np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id",
                       F.col("text").cast("string").alias("text"))


def document_signatures(docs: DataFrame, width: int) -> DataFrame:
    """``row, doc_id, n, k1, k2, bands, sig`` of every row (``bands`` empty without words)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        import pyarrow as pa

        for b in batches:
            data, offsets = ph.text_buffers(b.column(2))
            for i, j in ph.groups_of(offsets, PIECE_BYTES):
                sets, offs = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], width)
                n = j - i
                k1, k2 = _no_set_rows(n), _no_set_rows(n)
                keys, low, count = np.zeros(0, np.int64), np.zeros(0, np.uint8), _no_set_rows(n)
                if len(sets):
                    full, a, c, bands, low = signatures(sets, offs)
                    k1[full], k2[full] = a.view(np.int64), c.view(np.int64)
                    keys = bands.view(np.int64).reshape(-1)
                    count[full] = 1
                edges = np.concatenate([[0], np.cumsum(count)])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, n), b.column(1).slice(i, n), pa.array(np.diff(offs)), pa.array(k1), pa.array(k2),
                    pa.ListArray.from_arrays(pa.array((edges * BANDS).astype(np.int32)), pa.array(keys)),
                    ph.binary_column(low.reshape(-1), edges * 2 * PERMS)],
                    names=["row", "doc_id", "n", "k1", "k2", "bands", "sig"])

    return _keyed(docs).mapInArrow(
        sign, f"row long, doc_id {kind}, n long, k1 long, k2 long, bands array<long>, sig binary")


def document_sets(texts: DataFrame, width: int, wanted: np.ndarray) -> DataFrame:
    """``row, grams``: the sorted shingle hashes, as 8-byte integers, of the rows of ``texts`` (row,
    text) that the bit map ``wanted`` has; each once per task."""

    def build(batches):
        import pyarrow as pa

        seen = set()
        for b in batches:
            keep = in_bit_map(wanted, b.column(0).to_numpy())
            for k in np.flatnonzero(keep):
                key = b.column(0)[int(k)].as_py()
                keep[k] = key not in seen
                seen.add(key)
            if not keep.any():
                continue
            b = b.filter(pa.array(keep))
            data, offsets = ph.text_buffers(b.column(1))
            for i, j in ph.groups_of(offsets, PIECE_BYTES):
                sets, offs = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], width)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), ph.binary_column(sets, offs)], names=["row", "grams"])

    return texts.mapInArrow(build, "row long, grams binary")


# ---- pairs -----------------------------------------------------------------------------------

def _least_equal_bytes(threshold) -> int:
    """Signature bytes that a pair at the threshold has in common, less some deviations."""
    t = threshold[0] / threshold[1]
    return int(2 * PERMS * (t - SIGMAS * (t * (1 - t) / (2 * PERMS)) ** 0.5))


def _admitted(pairs: DataFrame, heads: DataFrame, threshold) -> DataFrame:
    """``x, y, n`` of the distinct pairs (x, y) whose set sizes can link; ``n`` is x's size."""
    side = lambda s: heads.select(F.col("row").alias(s), F.col("n").alias(f"n_{s}"))
    sized = pairs.join(side("x"), "x").join(side("y"), "y")
    return sized.where(threshold[1] * F.least("n_x", "n_y") >= threshold[0] * F.greatest("n_x", "n_y")).select(
        "x", "y", F.col("n_x").alias("n"))


def confirmed(blocks: DataFrame, sets: DataFrame, threshold) -> DataFrame:
    """``x, y`` of the pairs in ``blocks`` (key, xs, ys: equally long arrays) whose full sets
    reach the threshold. Every set comes once to each block that names it. A block's sets are
    sorted before its pairs, so a task holds the sets of one block and one Arrow batch."""
    kind = blocks.schema["xs"].dataType.elementType.simpleString()
    named = blocks.select(F.col("key").alias("block"),
                          F.explode(F.array_distinct(F.concat("xs", "ys"))).alias("row"))
    none = F.lit(None)
    brought = named.join(sets, "row").select("block", F.lit(False).alias("asks"), "row", "grams",
                                             none.cast(f"array<{kind}>").alias("xs"), none.cast(f"array<{kind}>").alias("ys"))
    asked = blocks.select(F.col("key").alias("block"), F.lit(True).alias("asks"), none.cast(kind).alias("row"),
                          none.cast("binary").alias("grams"), "xs", "ys")

    def check(batches):
        import pyarrow as pa

        block, have = None, {}
        for b in batches:
            keys, asks = b.column(0).to_pylist(), b.column(1).to_pylist()
            for k in range(b.num_rows):
                if keys[k] != block:
                    block, have = keys[k], {}
                if not asks[k]:
                    have[b.column(2)[k].as_py()] = np.frombuffer(b.column(3)[k].as_py(), dtype=np.uint64)
                    continue
                xs, ys = (b.column(c)[k].values for c in (4, 5))
                linked = [_reaches(have[x], have[y], threshold) for x, y in zip(xs.to_pylist(), ys.to_pylist())]
                yield pa.RecordBatch.from_arrays([xs, ys], names=["x", "y"]).filter(pa.array(linked, pa.bool_()))

    rows = brought.unionByName(asked).repartition("block").sortWithinPartitions("block", "asks")
    with arrow_rows(blocks.sparkSession, BATCH_SETS):
        return stored(rows.mapInArrow(check, f"x {kind}, y {kind}"), "dedup-links")


def _reaches(a: np.ndarray, c: np.ndarray, threshold) -> bool:
    if len(a) > len(c):
        a, c = c, a
    at = np.minimum(np.searchsorted(c, a), len(c) - 1)
    both = int((c[at] == a).sum())
    return threshold[1] * both >= threshold[0] * (len(a) + len(c) - both)


def _n_blocks(count, shingles):
    """Blocks for so many documents with so many shingles: bounded in both."""
    return F.ceil(F.greatest(count / BLOCK, 8 * shingles / BLOCK_BYTES, F.lit(1.0))).cast("int")


def _packed(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y, n) as blocks: those of one ``y`` together, up to about ``BLOCK`` sets or
    ``BLOCK_BYTES`` of them."""
    many = pairs.groupBy("y").agg(_n_blocks(F.count(F.lit(1)), F.sum("n")).alias("parts"))
    split = pairs.join(many, "y").withColumn("key", F.xxhash64("y", F.pmod(F.xxhash64("x"), F.col("parts"))))
    return split.groupBy("key").agg(F.collect_list(F.struct("x", "y")).alias("p")).select(
        "key", F.col("p.x").alias("xs"), F.col("p.y").alias("ys"))


def _open_members(members: DataFrame) -> DataFrame:
    """Members (b, row, n, component) of the buckets with several components: whether each is a
    stray (outside the bucket's largest component), and in how many blocks strays and all go."""
    sizes = members.groupBy("b", "component").agg(F.count(F.lit(1)).alias("n_in"), F.sum("n").alias("load"))
    buckets = sizes.groupBy("b").agg(
        F.sum("n_in").alias("n_all"), F.sum("load").alias("load"), F.max(F.struct("n_in", "component", "load")).alias("main"),
        F.count(F.lit(1)).alias("parts")).where("parts > 1")
    buckets = buckets.select("b", F.col("main.component").alias("main"), _n_blocks(F.col("n_all"), F.col("load")).alias("n_m"),
                             _n_blocks(F.col("n_all") - F.col("main.n_in"), F.col("load") - F.col("main.load")).alias("n_s"))
    return members.join(buckets, "b").select("b", "row", "component", (F.col("component") != F.col("main")).alias("stray"),
                                             "n_m", "n_s")


def _cross_blocks(opened: DataFrame, heads: DataFrame, threshold) -> DataFrame:
    """Blocks of likely pairs between different components of a bucket, of ``_open_members``."""
    least = _least_equal_bytes(threshold)
    kind = dict(opened.dtypes)["row"]
    near = with_map_hits(heads, "row", opened.select("row"), MAP_BITS).where("__hit").drop("__hit")
    known = stored(opened.join(near, "row"), "dedup-known")
    # strays in n_s blocks against all members in n_m blocks: a stray goes to every member
    # block, a member to every stray block
    own = F.xxhash64("row")
    as_stray = known.where("stray").select(
        "b", "row", "n", "bands", "sig", "component", F.lit(True).alias("s"),
        F.pmod(own, F.col("n_s")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("n_m") - 1)).alias("j"))
    as_member = known.select(
        "b", "row", "n", "bands", "sig", "component", F.lit(False).alias("s"),
        F.explode(F.sequence(F.lit(0), F.col("n_s") - 1)).alias("i"), F.pmod(own, F.col("n_m")).cast("int").alias("j"))

    def pair(part):
        import pandas as pd

        empty = pd.DataFrame({"key": pd.Series(dtype="int64"), "xs": pd.Series(dtype=object),
                              "ys": pd.Series(dtype=object)})
        s, m = part[part["s"]], part[~part["s"]]
        if s.empty or m.empty:
            return empty
        b, i, j = (int(part[c].iloc[0]) for c in ("b", "i", "j"))
        sig_m = np.stack([np.frombuffer(v, np.uint8) for v in m["sig"]])
        bands_m = np.stack([np.asarray(v, np.int64) for v in m["bands"]])
        ids_m, n_m, comp_m = m["row"].to_numpy(), m["n"].to_numpy(), m["component"].to_numpy()
        main_side = ~np.isin(ids_m, s["row"].to_numpy())
        xs, ys = [], []
        for doc, n, bands, sig, comp in zip(*(s[c] for c in ("row", "n", "bands", "sig", "component"))):
            ok = comp_m != comp
            ok &= threshold[1] * np.minimum(n_m, n) >= threshold[0] * np.maximum(n_m, n)
            ok &= main_side | (ids_m > doc)
            ok &= (sig_m == np.frombuffer(sig, np.uint8)).sum(axis=1) >= least
            hit = np.flatnonzero(ok)
            if len(hit):
                first = (bands_m[hit] == np.asarray(bands, np.int64)).argmax(axis=1)
                hit = hit[np.asarray(bands, np.int64)[first] == b]
            xs.extend([doc] * len(hit))
            ys.extend(ids_m[hit])
        if not xs:
            return empty
        key = int(ph.mix64(np.array([(b + 1000003 * i + 7919 * j) & (2 ** 64 - 1)], dtype=np.uint64))
                  .view(np.int64)[0])
        return pd.DataFrame({"key": [key], "xs": [xs], "ys": [ys]})

    return as_stray.unionAll(as_member).groupBy("b", "i", "j").applyInPandas(
        pair, f"key long, xs array<{kind}>, ys array<{kind}>")


# ---- the whole job ---------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, width: int = 3, threshold=THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    return _decided(docs, width, threshold).drop("row")


def _decided(docs: DataFrame, width: int, threshold) -> DataFrame:
    """``near_duplicates`` with the key ``row`` of each row."""
    with arrow_bytes(docs.sparkSession):
        signed = stored(document_signatures(docs, width), "dedup-signatures")
    key = ["k1", "k2", "n"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    classes = stored(signed.where("n > 0").groupBy(*key).agg(first.alias("first"))
                     .select(*key, "first", F.col("first.row").alias("row")), "dedup-classes")
    heads = signed.select("row", *key, "bands", "sig").where("n > 0").join(
        classes.select("row", *key), ["row", *key])
    heads = stored(heads.dropDuplicates(["row", *key]).select("row", "n", "bands", "sig"),
                   "dedup-heads")

    slots = heads.select("row", F.explode("bands").alias("b"))
    pivots = stored(slots.groupBy("b").agg(
        F.min(F.struct(F.xxhash64("row", "b").alias("h"), "row"))["row"].alias("pivot"),
        F.count(F.lit(1)).alias("m")).where("m > 1"), "dedup-pivots")
    members = stored(slots.join(pivots, "b"), "dedup-members")
    met = members.where("row <> pivot").select(F.col("row").alias("x"), F.col("pivot").alias("y"))
    met = met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    likely = stored(_admitted(met, heads, threshold), "dedup-likely")

    sets = _sets_of(docs, likely.select("x").unionAll(likely.select("y")), width)
    links = confirmed(stored(_packed(likely), "dedup-blocks"), sets, threshold)
    parts = stored(components(links), "dedup-parts")

    grown = (members.where("m > 2").select("b", "row").join(heads.select("row", "n"), "row")
             .join(parts.withColumnRenamed("node", "row"), "row", "left")
             .withColumn("component", F.coalesce("component", "row")))
    opened = stored(_open_members(stored(grown, "dedup-grown")), "dedup-open")
    rest = stored(_cross_blocks(opened, heads, threshold), "dedup-rest")
    asked = rest.select(F.explode(F.array_distinct(F.concat("xs", "ys"))).alias("x"))
    more = confirmed(rest, _sets_of(docs, asked, width), threshold)
    if more.limit(1).count():
        parts = stored(components(parts.select(F.col("node").alias("x"), F.col("component").alias("y"))
                                  .unionAll(more)), "dedup-parts")

    # the first row of a component is the smallest of its classes' first rows
    joined = stored(classes.join(parts.withColumnRenamed("node", "row"), "row", "left")
                    .select(*key, "first", "component"), "dedup-joined")
    best = stored(joined.where("component is not null").groupBy("component")
                  .agg(F.min("first").alias("best")), "dedup-best")
    named = joined.join(bounded(best), "component", "left").withColumn(
        "best", F.coalesce("best", "first")).select(
        *key, F.col("best.doc_id").alias("component_id"), F.col("best.row").alias("best_row"))
    out = signed.select("row", "doc_id", *key).join(stored(named, "dedup-names"), key, "left")
    # a row without words is its own component
    empty = F.col("n") == 0
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"),
                      F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (empty | (F.col("row") == F.col("best_row"))).alias("kept"))


def _sets_of(docs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """Stored shingle sets of the rows whose keys are in the one column of ``rows``."""
    wanted = stored(rows.toDF("row").distinct(), "dedup-wanted")
    sets = document_sets(_keyed(docs).select("row", "text"), width, bit_map(wanted, MAP_BITS))
    with arrow_bytes(docs.sparkSession):
        return stored(sets.join(wanted, "row", "left_semi").dropDuplicates(["row"]), "dedup-sets")


def drop_near_duplicates(docs: DataFrame, width: int = 5, threshold=THRESHOLD) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest id; of rows that repeat
    an id with its text, the one whose JSON has the smallest hash. Columns unchanged."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "dedup-kept")
    with scratch(spark):
        _decided(docs, width, threshold).groupBy("row").agg(
            F.max("kept").alias("kept"), F.count(F.lit(1)).alias("count")).write.parquet(path)
    decided = spark.read.parquet(path)
    kept, left = decided.where("kept"), decided.where("not kept").select(F.col("row").alias("__row"))
    repeated = kept.where("count > 1").limit(1).count()
    keyed = docs.withColumn("__row", row_key(F.col("doc_id"), F.col("text")))
    # a clear bit says that a row is kept; only the others are held against the rows left out
    told = with_map_hits(keyed, "__row", left, MAP_BITS)
    known = told.where("not __hit").unionByName(
        told.where("__hit").join(left, "__row", "left_anti")).drop("__hit")
    if not repeated:
        return known.drop("__row")
    again = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in docs.columns])))
    many = kept.where("count > 1").select(F.col("row").alias("__row"))
    least = stored(keyed.join(many, "__row", "left_semi").groupBy("__row")
                   .agg(F.min(again).alias("__least")), "dedup-first-rows")
    chosen = known.join(least, "__row", "left").where(F.col("__least").isNull() | (again == F.col("__least")))
    return chosen.dropDuplicates(["__row"]).drop("__row", "__least")

r"""N-gram Jaccard join by T-occurrence search (DivideSkip), exact.

A document's set are its distinct ``width``-word shingles (A-Z lower-cased); two documents link
when their sets' Jaccard similarity reaches the threshold. Sets x and y that link have at least
``T = ceil(t (|x| + |y|) / (1 + t))`` shingles in common, so whoever occurs on T of the inverted
lists of x's shingles is a link. DivideSkip splits these lists: the L longest are set aside, the
others are heap-merged, and who is on T - L of them is looked up in the long ones by binary
search, until T can no longer be reached.

An index of all documents in one task would not hold, so indexes are built per block, of
documents that can link at all. Sizes fall into intervals whose ends differ by the threshold's
factor; linked sets are in one interval or in neighbours, and differ in at most ``d`` shingles
there. Shingles are dealt by hash into ``d + 1`` parts, so one part at least is equal in both:
buckets are equal parts, and no link is lost (equal hashes of unequal parts only cost time).

1. One pass gives every row's set size, a 128-bit digest and a parity sketch; equal sets are one
   class. Another gives the part keys, each with 64 bits of its class's digest, which are
   shuffled once: a bucket's least and greatest class show whether it has several.
2. Each bucket's smallest member is its pivot. Pivots are the queries, their members the index,
   in blocks of ``BLOCK_BYTES`` of sets. Links give components.
3. Links no pivot showed join different components of a bucket. The members outside the
   bucket's largest component ask all members that sizes and sketches admit: each pair once
   over all buckets of up to ``SMALL`` members, block against block in larger ones. Most buckets
   have one component by then. The components of all links are the result.

A bit of a sketch is the parity of the number of shingles dealt to it, so two sketches differ in
at most as many bits as the sets do in shingles: a pair whose sketches differ in more than a link
may has none, and its texts need not travel. Of long sets the sketch says little; it loses no link.

Nothing is capped; large buckets have more blocks. What travels to the blocks are the texts
(half the bytes of their sets), only of documents that a search names.

Defined cases: null texts and texts without words have an empty set, are linked with nothing
and are their own component (``component_id`` is their id); fewer words than ``width`` are one
shingle; rows with equal sets are linked, so repeated rows agree, as do several texts under one
id if linked; a null id never names a component unless all ids of it are null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from math import log

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrosense.llm import common, minmax
from agrosense.llm import prefix_hash as ph
from agrosense.llm.common import bit_map, in_bit_map, ship, stored
from agrosense.llm.components import components
from agrosense.llm.minmax import shingle_sets

ship(__name__)
ship(ph.__name__)
ship(minmax.__name__)
ship(common.__name__)

THRESHOLD = (90, 100)                 # 100 * intersection >= 90 * union
MU = 0.0085                           # DivideSkip: the share of lists that count as long
BLOCK_BYTES = 4 << 20                 # bytes of sets in one index
PIECE_BYTES = 1 << 20
SMALL = 256                           # members of a bucket whose open pairs are listed
MAP_BITS = 24                         # bits of the map of wanted rows
SKETCH = [f"s{k}" for k in range(8)]  # columns of a parity sketch, 64 bits each


# ---- sizes and parts -------------------------------------------------------------------------

def size_intervals(largest: int, threshold) -> np.ndarray:
    """First sizes of the intervals up to that of ``largest`` and the next one's end."""
    num, den = threshold
    first = [1]
    while first[-1] <= largest:
        first.append(first[-1] * den // num + 1)
    first.append(first[-1] * den // num + 1)
    return np.array(first, dtype=np.int64)


def part_counts(first: np.ndarray, threshold) -> np.ndarray:
    """Parts for pairs with the larger set in each interval: one more than may differ."""
    num, den = threshold
    return 2 * (first[1:] - 1) * (den - num) // (den + num) + 1


def part_keys(sets: np.ndarray, offsets: np.ndarray, threshold):
    """Flat part keys and their offsets: the parts of each set in its own interval and, to meet
    larger ones, in the next."""
    n = np.diff(offsets)
    first = size_intervals(int(n.max(initial=1)), threshold)
    parts = part_counts(first, threshold)
    own = np.searchsorted(first, n, side="right") - 1
    doc = np.repeat(np.arange(len(n)), n)
    count = np.where(n > 0, parts[own] + parts[own + 1], 0)
    edges = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    sums = np.zeros(edges[-1], dtype=np.uint64)
    which = np.zeros(edges[-1], dtype=np.uint64)
    for step in (0, 1):
        level = own + step
        base = edges[:-1] + (parts[own] if step else 0)
        salt = ph.mix64((level.astype(np.uint64) + np.uint64(1)) << np.uint64(40))
        h = ph.mix64(sets ^ salt[doc])
        part = ((h >> np.uint64(24)) % parts[level][doc].astype(np.uint64)).astype(np.int64)
        np.add.at(sums, base[doc] + part, ph.mix64(h + np.uint64(0x9E3779B97F4A7C15)))
        for k in np.flatnonzero(n > 0):
            m = parts[level[k]]
            which[base[k]:base[k] + m] = salt[k] + np.arange(m, dtype=np.uint64)
    return ph.mix64(sums ^ ph.mix64(which)), edges


# ---- T-occurrence search ---------------------------------------------------------------------

class Index:
    """Inverted lists of some sets: shingle -> ascending numbers of the sets that have it."""

    def __init__(self, sets, threshold):
        self.sizes = [len(s) for s in sets]
        token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        who = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((who, token))
        token, self.who = token[order], who[order]
        self.tokens, first = np.unique(token, return_index=True)
        self.bounds = np.append(first, len(token))
        self.threshold = threshold

    def needed(self, n: int, m: int) -> int:
        """Common shingles that sets of these sizes need."""
        num, den = self.threshold
        return -(-num * (n + m) // (num + den))

    def search(self, query: np.ndarray, wanted) -> list[int]:
        """Numbers of the sets among ``wanted`` (a set of numbers) that link with the query."""
        num, den = self.threshold
        n = len(query)
        sized = [k for k in wanted if den * min(n, self.sizes[k]) >= num * max(n, self.sizes[k])]
        if not sized:
            return []
        need = {k: self.needed(n, self.sizes[k]) for k in sized}
        least = min(need.values())
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if len(at) < least:
            return []
        at = at[np.argsort(self.bounds[at + 1] - self.bounds[at], kind="stable")]
        lists = [self.who[self.bounds[p]:self.bounds[p + 1]].tolist() for p in at]
        n_long = min(least - 1, int(least / (MU * log(max(2, len(lists[-1]))) + 1)))
        short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        found, last, count = [], -1, 0
        for k in heapq.merge(*short, [1 << 60]):
            if k == last:
                count += 1
                continue
            if last in need and count >= need[last] - n_long and self._probed(last, count, need[last], long):
                found.append(last)
            last, count = k, 1
        return found

    @staticmethod
    def _probed(k, count, need, long) -> bool:
        left = len(long)
        for numbers in long:
            if count >= need:
                return True
            if count + left < need:
                return False
            p = bisect_left(numbers, k)
            count += p < len(numbers) and numbers[p] == k
            left -= 1
        return count >= need


# ---- the job ---------------------------------------------------------------------------------

def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")), F.lit("\x01"), F.coalesce(text, F.lit("")))
    return docs.select(F.unhex(F.md5(named)).alias("row"), "doc_id", text.alias("text"))


def _in_pieces(batches, width, make):
    """``make(rows, sets, offsets)`` for stretches of about ``PIECE_BYTES``; text is the last column."""
    for b in batches:
        data, offsets = ph.text_buffers(b.column(b.num_columns - 1))
        for i, j in ph.groups_of(offsets, PIECE_BYTES):
            yield make(b.slice(i, j - i), *shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], width))


def _digests(sets, offsets):
    """Sizes of the sets, the first half of their 128-bit digests, and these as an Arrow binary column."""
    n = np.diff(offsets)
    k = np.zeros((len(n), 2), dtype=np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        k[full, 0] = np.add.reduceat(ph.mix64(sets ^ np.uint64(0x2545F4914F6CDD1D)), offsets[full])
        k[full, 1] = np.add.reduceat(ph.mix64(sets + np.uint64(0x632BE59BD9B4E019)), offsets[full])
    return n, k[:, 0].copy().view(np.int64), ph.binary_column(k.reshape(-1), 2 * np.arange(len(n) + 1))


def parity_sketches(sets, offsets) -> np.ndarray:
    """A row of 64-bit integers for each set: bit by bit, the parity of the shingles dealt to it."""
    n, bits = len(offsets) - 1, 64 * len(SKETCH)
    bit = (ph.mix64(sets ^ np.uint64(0x3C79AC492BA7B653)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * bits + bit, minlength=n * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1, bitorder="little").view("<i8")


def document_digests(docs: DataFrame, width: int) -> DataFrame:
    """``row, doc_id, n, h, id`` and the sketch: key, set size and set digest of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        def make(b, sets, offsets):
            n, h, digest = _digests(sets, offsets)
            sketch = [pa.array(np.ascontiguousarray(c)) for c in parity_sketches(sets, offsets).T]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(h), digest, *sketch],
                                              names=["row", "doc_id", "n", "h", "id", *SKETCH])
        return _in_pieces(batches, width, make)

    return _texts(docs).mapInArrow(run, f"row binary, doc_id {kind}, n long, h long, id binary, "
                                        + ", ".join(f"{c} long" for c in SKETCH))


def part_members(docs: DataFrame, width: int, threshold) -> DataFrame:
    """``b, h``: the part keys of each document and the first 64 bits of its set digest. A task
    gives those of equal sets once."""

    def run(batches):
        import pyarrow as pa

        seen = set()

        def make(_, sets, offsets):
            n, h, digest = _digests(sets, offsets)
            fresh = np.zeros(len(n), dtype=bool)
            for k, d in enumerate(digest.to_pylist()):
                if n[k] and d not in seen:
                    seen.add(d)
                    fresh[k] = True
            keys, edges = part_keys(sets[np.repeat(fresh, n)], np.concatenate([[0], np.cumsum(n[fresh])]).astype(np.int64), threshold)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(h[fresh], np.diff(edges)))],
                                              names=["b", "h"])
        return _in_pieces(batches, width, make)

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "b long, h long")


def shared_buckets(parts: DataFrame) -> DataFrame:
    """``b, h, pivot``: the members, each once, of the buckets with several, and the smallest."""
    bucket = Window.partitionBy("b")
    spread = parts.select("b", "h", F.min("h").over(bucket).alias("pivot"), F.max("h").over(bucket).alias("last"))
    return spread.where("pivot < last").select("b", "h", "pivot").distinct()


def wanted_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``id, text`` of the stored ``rows`` (row, id). One pass over the documents passes on those
    whose row key is in a bit map, each once per task, so other texts are not shuffled."""
    bits = bit_map(rows.select(F.xxhash64("row")), MAP_BITS)

    def run(batches):
        import pyarrow as pa

        seen = set()
        for b in batches:
            keep = in_bit_map(bits, b.column(1).to_numpy())
            for k in np.flatnonzero(keep):
                key = b.column(0)[int(k)].as_py()
                keep[k] = key not in seen
                seen.add(key)
            if keep.any():
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], names=["row", "text"]).filter(pa.array(keep))

    found = _texts(docs).select("row", F.xxhash64("row").alias("h"), "text").mapInArrow(run, "row binary, text string")
    return found.join(rows, "row").select("id", "text")


def _searched(named: DataFrame, texts: DataFrame, width: int, threshold) -> DataFrame:
    """Links ``x, y`` of blocks. ``named`` (block, id, query, part) says which documents of a
    block are queries and which are indexed; a query skips documents of its own ``part``, and
    of two queries that are both indexed the smaller asks."""

    def search(block):
        import pandas as pd

        block = block.drop_duplicates(["id", "query"])
        asks, has = block[block["query"]], block[~block["query"]]
        links = []
        if len(asks) and len(has):
            both = list({**dict(zip(has["id"], has["text"])), **dict(zip(asks["id"], asks["text"]))}.items())
            raw = [t.encode() for _, t in both]
            edges = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
            flat, offsets = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), edges, width)
            sets = {i: flat[offsets[k]:offsets[k + 1]] for k, (i, _) in enumerate(both)}
            ids, parts = list(has["id"]), list(has["part"])
            index, asking = Index([sets[i] for i in ids], threshold), set(asks["id"])
            for x, part in zip(asks["id"], asks["part"]):
                wanted = {k for k, (i, p) in enumerate(zip(ids, parts)) if p != part and (i > x or i not in asking)}
                links += [(x, ids[k]) for k in index.search(sets[x], wanted)]
        return pd.DataFrame(links, columns=["x", "y"])

    return named.join(texts, "id").groupBy("block").applyInPandas(search, "x binary, y binary")


def _blocks_of(size):
    return F.greatest(F.lit(1), F.ceil(size * 8 / BLOCK_BYTES)).cast("int")


def _may_link(x: str, y: str, threshold):
    """Whether sizes and sketches admit a link; the columns of a side end in ``x`` and ``y``."""
    num, den = threshold
    n_x, n_y = F.col(f"n_{x}"), F.col(f"n_{y}")
    differ = sum((F.bit_count(F.col(f"{c}_{x}").bitwiseXOR(F.col(f"{c}_{y}"))) for c in SKETCH), F.lit(0))
    return (den * F.least(n_x, n_y) >= num * F.greatest(n_x, n_y)) & ((den + num) * differ <= (den - num) * (n_x + n_y))


def _side(side: str) -> list:
    return [F.col("id").alias(side), F.col("n").alias(f"n_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in SKETCH)]


def _met(members: DataFrame, heads: DataFrame, threshold) -> DataFrame:
    """The distinct pairs (x, y) of a pivot and a member that may link, with y's size ``n``."""
    pairs = members.where("h <> pivot").select(F.col("pivot").alias("h_x"), F.col("h").alias("h_y")).distinct()
    of = lambda side: heads.select(F.col("h").alias(f"h_{side}"), *_side(side))
    both = pairs.join(of("x"), "h_x").join(of("y"), "h_y").where(_may_link("x", "y", threshold))
    return both.select("x", "y", F.col("n_y").alias("n"))


def _pair_blocks(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y, n) as blocks: each x asks its ys, some MB of them at a time."""
    load = pairs.groupBy("x").agg(F.sum("n").alias("load"))
    cut = pairs.join(load, "x").withColumn("k", F.pmod(F.xxhash64("y"), _blocks_of(F.col("load"))))
    block = F.struct(F.col("x").alias("b"), F.col("k").cast("int").alias("i"), F.lit(0).alias("j")).alias("block")
    return cut.select(block, F.col("y").alias("id"), F.lit(False).alias("query"), F.col("y").alias("part")).unionAll(
        cut.select(block, F.col("x").alias("id"), F.lit(True).alias("query"), F.unhex(F.lit("")).alias("part")).distinct())


def _open(members: DataFrame) -> DataFrame:
    """Members (b, id, n, component) of the buckets with several components, with the bucket's
    largest one ``main`` and what it holds."""
    sizes = members.groupBy("b", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("load"))
    buckets = sizes.groupBy("b").agg(
        F.sum("c").alias("c"), F.sum("load").alias("all"), F.max(F.struct("c", "component", "load")).alias("main"),
        F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return members.join(buckets.select("b", "c", _blocks_of(F.col("all")).alias("n_has"), F.col("main.component").alias("main"),
                                       _blocks_of(F.col("all") - F.col("main.load")).alias("n_asks")), "b")


def _open_pairs(told: DataFrame, heads: DataFrame, threshold) -> DataFrame:
    """The distinct pairs (x, y), with y's size ``n``, of small open buckets that no component
    joins and that may link; x is outside the main component."""
    told = stored(told.where(F.col("c") <= SMALL).select("b", "id", "component", "main")
                  .join(heads.select("id", "n", *SKETCH), "id"), "join-open-small")
    asks = told.where("component <> main").select("b", F.col("component").alias("cx"), *_side("x"))
    has = told.select("b", F.col("component").alias("cy"), (F.col("component") == F.col("main")).alias("m"), *_side("y"))
    return asks.join(has, "b").where(F.expr("cx <> cy and (m or x < y)") & _may_link("x", "y", threshold)).select(
        "x", "y", F.col("n_y").alias("n")).distinct()


def _open_blocks(told: DataFrame) -> DataFrame:
    """Blocks of the large open buckets."""
    told, own = told.where(F.col("c") > SMALL), F.xxhash64("id")
    asks = told.where("component <> main").select(
        "b", "id", F.lit(True).alias("query"), F.col("component").alias("part"),
        F.pmod(own, F.col("n_asks")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_has") - 1)).alias("j"))
    has = told.select("b", "id", F.lit(False).alias("query"), F.col("component").alias("part"),
                      F.explode(F.sequence(F.lit(0), F.col("n_asks") - 1)).alias("i"),
                      F.pmod(own, F.col("n_has")).cast("int").alias("j"))
    block = F.struct(F.unhex(F.hex("b")).alias("b"), "i", "j").alias("block")
    return asks.unionAll(has).select(block, "id", "query", "part")


def jaccard_components(docs: DataFrame, width: int = 3, threshold=THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    signed = stored(document_digests(docs, width), "join-digests")
    heads = stored(signed.where("n > 0").groupBy("id", "h", "n", *SKETCH).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")), "join-heads")

    def links_in(blocks):
        blocks = stored(blocks, "join-blocks")
        rows = stored(blocks.select("id").distinct().join(heads.select("id", F.col("first.row").alias("row")), "id"), "join-asked")
        return stored(_searched(blocks, stored(wanted_texts(docs, rows), "join-texts"), width, threshold), "join-links")

    members = stored(shared_buckets(part_members(docs, width, threshold)), "join-members")
    links = links_in(_pair_blocks(stored(_met(members, heads, threshold), "join-met")))
    groups = stored(components(links), "join-groups")

    parted = stored(heads.select("id", "h", "n").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "h", "n", F.coalesce("component", "id").alias("component")), "join-parted")
    told = stored(_open(members.select("b", "h").join(parted, "h").drop("h")), "join-open")
    more = links_in(_pair_blocks(stored(_open_pairs(told, heads, threshold), "join-open-pairs")).unionAll(_open_blocks(told)))
    if not more.isEmpty():
        groups = stored(components(groups.select(F.col("node").alias("x"), F.col("component").alias("y"))
                                   .unionAll(more)), "join-groups")

    owned = stored(heads.join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "first", F.coalesce("component", "id").alias("component")), "join-owned")
    best = owned.groupBy("component").agg(F.min("first").alias("best"))
    named = stored(owned.join(best, "component").select("id", F.col("best.doc_id").alias("component_id")), "join-names")
    return signed.join(named, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))

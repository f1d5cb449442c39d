r"""Phrase collocations by best-first branch-and-bound growth.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends and into words at
blanks and tabs. A candidate is a phrase of 2 to 4 words with a count ``a`` of 30 or more in its
language; cut after its first k words its score is ``floor(2000000 a / (l + r))`` of the counts
of both parts, and the lowest cut counts. A candidate inside a longer one with at least 80% of
its count is dropped. Each language's first 2,000 of the rest are the result.

Growth. A phrase that begins with ``P`` occurs at most ``f(P)`` times and its rest no less often
than itself, so cut after its first word it scores at most ``floor(2000000 f(P) / (f(w1) + f(P)))``:
the bound of all that grows from P, which falls as P grows. In each language the bigrams and
trigrams with the highest bounds are expanded first, ``EXPAND`` bigrams a round with all ties:
phrases one word longer, to the right and to the left, are counted over the whole corpus. Then
every phrase that scores at least the round's lowest bound is known with its exact score, and so
is everything longer that could drop it (what drops a phrase by a word outside it does so already
by its neighbour word). A language is settled when 2,000 survivors score that much, or nothing
is left to expand; the others go on with lower bounds, twice as many bigrams each time.

Counting. Tasks code the words of some MB of text by a dictionary, count equal runs of codes and
give each phrase once with its count; Spark adds these up, so a language with most of all rows
or a word in every line costs no more than any other. Words and phrases are compared as text,
never by hash. Only bigrams of two words with 30 occurrences are counted: a bit map of fixed size
(2 MB) tells which words may have them. What is to be expanded comes to the driver and the tasks
in slices of at most ``SLICE_ROWS`` phrases and ``SLICE_BYTES`` bytes, one pass over the texts for
each. Scores are computed with decimals, which hold products beyond 64 bits.

Defined cases: a null language is ``und`` (and one with a row of that name); null and empty
texts have no words, and a language without a word or candidate has no row; phrases never cross
pieces or documents; repeated rows count each time; equal scores go by count, then phrase in
UTF-8 byte order; one very long text is counted as one piece of work; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrosense.llm import prefix_hash as ph
from agrosense.llm.common import arrow_rows, ship, stored

ship(__name__)
ship(ph.__name__)

# Fixed values of the contract.
MIN_COUNT, LONGEST, TOP = 30, 4, 2_000
SCALE, DROP_SHARE = 2_000_000, (80, 100)
NO_LANGUAGE = "und"

PIECE_BYTES = 1 << 20                 # text coded by one dictionary
BATCH_ROWS = 1_000                    # texts that a task holds at a time, besides one stretch
MAP_BITS = 24                         # bits of the map of frequent words
EXPAND = 16_000                       # bigrams expanded per language in the first round
SLICE_ROWS, SLICE_BYTES = 1 << 18, 16 << 20

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[10:14] = True
_LETTER = ~_BREAK
_LETTER[[9, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---- words of a stretch of text, in tasks ----------------------------------------------------

class Words:
    """Coded words of some documents: ``code`` into ``dictionary``, ``lang`` index, and
    ``linked``: whether the next word is in the same piece."""

    def __init__(self, data, offsets, langs):
        import pyarrow as pa

        data = _LOWER[data]
        letter = _LETTER[data]
        first, last = letter.copy(), letter.copy()
        first[1:] &= ~letter[:-1]
        last[:-1] &= ~letter[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        first[inner] = letter[inner]
        last[inner - 1] = letter[inner - 1]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(offsets, start, side="right") - 1
        breaks = np.cumsum(_BREAK[data], dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
        self.linked = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])
        length = stop - start
        ends = np.zeros(len(start) + 1, dtype=np.int64)
        np.cumsum(length, out=ends[1:])
        kind = np.int32 if len(data) < 1 << 31 else np.int64
        at = np.arange(ends[-1], dtype=kind) + np.repeat((start - ends[:-1]).astype(kind), length)
        column = pa.Array.from_buffers(pa.large_string(), len(start), [
            None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[at].tobytes())]).dictionary_encode()
        self.code = column.indices.to_numpy().astype(np.int64)
        self.dictionary = column.dictionary
        names = pa.array([NO_LANGUAGE if v is None else v for v in langs]).dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        self.lang = names.indices.to_numpy().astype(np.int64)[doc]

    def word_hash(self):
        """Hash of each (language, word) among the words, as rows ``lang * len(dictionary) + code``."""
        data, offs = ph.text_buffers(self.dictionary)
        h = ph.span_hash(ph.prefix_sums(data), offs[:-1], offs[1:]) + np.diff(offs).astype(np.uint64)
        salt = np.array([zlib.crc32(v.encode()) for v in self.langs], dtype=np.uint64) << np.uint64(20)
        return ph.mix64(h[None, :] ^ ph.mix64(salt)[:, None]).reshape(-1)

    def starts(self, n):
        """Whether ``n`` words of one piece start at each word but the last ``n - 1``."""
        ok = np.ones(max(0, len(self.code) - n + 1), dtype=bool)
        for k in range(n - 1):
            ok &= self.linked[k:k + len(ok)]
        return ok

    def counted(self, at, n):
        """Language, phrase and count of the distinct ``n``-word phrases starting at ``at``."""
        import pyarrow as pa
        import pyarrow.compute as pc

        size = len(self.dictionary)
        key = self.lang[at] * size + self.code[at]
        for k in range(1, n):
            if k > 1:                                 # ranks keep the next product small
                key = np.unique(key, return_inverse=True)[1]
            key = key * size + self.code[at + k]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        words = [self.dictionary.take(pa.array(self.code[at + k])) for k in range(n)]
        phrase = words[0] if n == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
        return pa.array(self.langs).take(pa.array(self.lang[at])), phrase.cast(pa.string()), pa.array(count.astype(np.int64))


def _counted(docs: DataFrame, n: int, pick, hashes: bool = False) -> DataFrame:
    """``lang, phrase, f`` (and ``h`` of words) of the ``n``-word phrases that ``pick`` marks, as
    counts per stretch of text."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            data, offsets = ph.text_buffers(b.column(1))
            langs = b.column(0).to_pylist()
            for i, j in ph.groups_of(offsets, PIECE_BYTES):
                if offsets[i] == offsets[j]:
                    continue
                words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], langs[i:j])
                ok = words.starts(n)
                if pick is not None:
                    ok &= pick(words, len(ok))
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                lang, phrase, count = words.counted(at, n)
                out = [lang, phrase, count]
                if hashes:
                    key = np.unique(words.lang * len(words.dictionary) + words.code)
                    out.append(pa.array(words.word_hash()[key].view(np.int64)))
                del words, ok, at            # before the next stretch is coded
                for k in range(0, len(count), 50_000):
                    yield pa.RecordBatch.from_arrays([v.slice(k, 50_000) for v in out],
                                                     names=["lang", "phrase", "f", "h"][:len(out)])
            pa.default_memory_pool().release_unused()

    return docs.select("lang", "text").mapInArrow(
        run, "lang string, phrase string, f long" + (", h long" if hashes else ""))


def _added_up(counts: DataFrame, *more: Column) -> DataFrame:
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), *more)


# ---- frequent words --------------------------------------------------------------------------

def frequent_word_map(words: DataFrame) -> np.ndarray:
    """Bit map over word hashes: a word whose bit is 0 has fewer than ``MIN_COUNT`` occurrences."""
    slot = F.col("h").bitwiseAND((1 << MAP_BITS) - 1)
    rows = (words.where(F.col("f") >= MIN_COUNT)
            .groupBy(F.shiftright(slot, 5).alias("k"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 31 as int))")).alias("bits")).toPandas())
    out = np.zeros(1 << (MAP_BITS - 5), dtype=np.uint32)
    out[rows["k"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return out


def _of_frequent_words(bits: np.ndarray):
    def pick(words, n):
        h = words.word_hash() & np.uint64((1 << MAP_BITS) - 1)
        may = (bits[h >> np.uint64(5)] >> (h & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
        ok = may.astype(bool)[words.lang * len(words.dictionary) + words.code]
        return ok[:n] & ok[1:n + 1]
    return pick


# ---- phrases to look for ---------------------------------------------------------------------

class Wanted:
    """A set of phrases of ``m`` words each, found in coded words by sorted keys."""

    def __init__(self, langs, phrases):
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = pc.split_pattern(phrases.cast(pa.large_string()), " ")
        self.m = len(parts[0])
        flat = parts.flatten().dictionary_encode()
        self.vocabulary = flat.dictionary
        code = flat.indices.to_numpy().astype(np.int64).reshape(-1, self.m)
        names = langs.dictionary_encode()
        self.langs = {v: k for k, v in enumerate(names.dictionary.to_pylist())}
        now, self.keys = names.indices.to_numpy().astype(np.int64) * len(self.vocabulary) + code[:, 0], []
        for k in range(1, self.m):
            key = now * len(self.vocabulary) + code[:, k]
            self.keys.append(np.unique(key))
            now = np.searchsorted(self.keys[-1], key)

    def found(self, words: Words) -> np.ndarray:
        """Whether a wanted phrase starts at each word but the last ``m - 1``."""
        import pyarrow.compute as pc

        size = len(self.vocabulary)
        ids = pc.fill_null(pc.index_in(words.dictionary, value_set=self.vocabulary), -1).to_numpy().astype(np.int64)
        lang = np.array([self.langs.get(v, -1) for v in words.langs], dtype=np.int64)[words.lang]
        word = ids[words.code]
        ok = words.starts(self.m)
        n = len(ok)
        ok &= (lang[:n] >= 0) & (word[:n] >= 0)
        now = lang[:n] * size + word[:n]
        for k, keys in enumerate(self.keys, 1):
            ok &= word[k:k + n] >= 0
            key = now * size + word[k:k + n]
            now = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            ok &= keys[now] == key
        return ok


def _grown_from(wanted: Wanted):
    """Phrases one word longer than a wanted one, at either end."""
    def pick(words, n):
        found = wanted.found(words)
        return found[:n] | found[1:n + 1]
    return pick


def _same_as(wanted: Wanted):
    return lambda words, n: wanted.found(words)[:n]


def _in_slices(phrases: DataFrame):
    """The stored table ``phrases`` (lang, phrase) as ``Wanted`` sets of bounded size."""
    size = phrases.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("phrase")).alias("b")).first()
    slices = max(-(-size["n"] // SLICE_ROWS), -(-(size["b"] or 0) // SLICE_BYTES))
    for k in range(slices):
        part = phrases.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(slices)) == k).select("lang", "phrase").toArrow()
        if part.num_rows:
            yield Wanted(part.column("lang").combine_chunks(), part.column("phrase").combine_chunks())


def _count_for(docs: DataFrame, phrases: DataFrame, n: int, pick) -> DataFrame | None:
    """Candidates of ``n`` words that ``pick`` finds for the phrases, or None."""
    found = None
    for wanted in _in_slices(phrases):
        part = stored(_added_up(_counted(docs, n, pick(wanted))).where(F.col("f") >= MIN_COUNT), f"phrases-{n}")
        found = part if found is None else found.unionAll(part)
    return None if found is None else found.distinct()


# ---- scores ----------------------------------------------------------------------------------

def _ratio(a: str, rest: str) -> str:
    return f"(cast({a} as decimal(20,0)) * cast({SCALE} as decimal(7,0))) div ({rest})"


def _with_bound(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``bound``: the highest score of whatever starts with the phrase."""
    head = words.select("lang", F.col("phrase").alias("head"), F.col("f").alias("f_head"))
    return (phrases.withColumn("head", F.substring_index("phrase", " ", 1)).join(head, ["lang", "head"])
            .withColumn("bound", F.expr(_ratio("f", "f_head + f"))).drop("head", "f_head"))


def scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of candidates; ``known`` has the counts of all their parts."""
    w = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), w.alias("w"),
                          F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
                       F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("right"))
    part = lambda name, n: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cut = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    best = F.min(F.struct(F.expr(_ratio("a", "l + r")).alias("score"), "k", "l", "r")).alias("b")
    return cut.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def _shadowed(longer: DataFrame) -> DataFrame:
    """``lang, phrase, most``: the highest count of a phrase one word longer that contains it."""
    inner = F.array(F.expr("substr(phrase, locate(' ', phrase) + 1)"),
                    F.expr("left(phrase, length(phrase) - locate(' ', reverse(phrase)))"))
    return longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("most"))


def _survivors(two, three, four, words) -> DataFrame:
    known = words.select("lang", "phrase", "f").unionAll(two).unionAll(three)
    every = scored(two.unionAll(three).unionAll(four), known)
    over = _shadowed(three.unionAll(four))
    kept = every.join(over, ["lang", "phrase"], "left").where(
        f"most is null or cast(most as decimal(20,0)) * {DROP_SHARE[1]} < cast(a as decimal(20,0)) * {DROP_SHARE[0]}")
    return kept.drop("most")


def _floors(open_bigrams: DataFrame, n: int) -> DataFrame:
    """``lang, floor``: the bound that ``n`` of a language's bigrams reach, ties included; 0 if
    it has no more than these."""
    steps = open_bigrams.groupBy("lang", "bound").count()           # at most SCALE / 2 + 1 rows each
    down = Window.partitionBy("lang").orderBy(F.desc("bound"))
    upto = steps.withColumn("upto", F.sum("count").over(down))
    return upto.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("upto") >= n, F.col("bound"))), F.lit(0)).alias("floor"),
                                    F.min("bound").alias("lowest")).select(
        "lang", F.when(F.col("floor") <= F.col("lowest"), F.lit(0)).otherwise(F.col("floor")).cast("long").alias("floor"))


def _none(df: DataFrame) -> DataFrame:
    return df.limit(0)


def collocations(documents: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    with arrow_rows(documents.sparkSession, BATCH_ROWS):
        return _collocations(documents, top)


def _collocations(documents: DataFrame, top: int) -> DataFrame:
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                            F.col("text").cast("string").alias("text"))
    every_word = stored(_added_up(_counted(docs, 1, None, hashes=True), F.first("h").alias("h")), "phrase-words")
    total = stored(every_word.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    words = stored(every_word.where(F.col("f") >= MIN_COUNT).select("lang", "phrase", "f"), "phrase-frequent")
    two = stored(_with_bound(_added_up(_counted(docs, 2, _of_frequent_words(frequent_word_map(every_word))))
                             .where(F.col("f") >= MIN_COUNT), words), "phrases-2")
    bare = two.select("lang", "phrase", "f")

    unsettled = stored(two.select("lang").distinct().withColumn("above", F.lit(None).cast("long")), "phrase-open")
    three, four, done, expand = _none(bare), _none(bare), None, EXPAND
    while not unsettled.isEmpty():
        still = two.join(unsettled, "lang").where("above is null or bound < above")
        floors = stored(unsettled.join(_floors(still, expand), "lang"), "phrase-floors")
        frontier = stored(still.join(floors.select("lang", "floor"), "lang").where("bound >= floor")
                          .select("lang", "phrase"), "phrase-frontier")
        more = _count_for(docs, frontier, 3, _grown_from)
        if more is not None:
            three = stored(three.unionAll(more).distinct(), "phrases-3")
        reach = stored(_with_bound(three, words).join(floors, "lang")
                       .where("bound >= floor and (above is null or bound < above)").select("lang", "phrase"),
                       "phrase-reach")
        more = _count_for(docs, reach, 4, _grown_from)
        if more is not None:
            four = stored(four.unionAll(more).distinct(), "phrases-4")
        # the rest of a phrase of four words may not have been met by growth
        rests = stored(four.select("lang", F.expr("substr(phrase, locate(' ', phrase) + 1)").alias("phrase"))
                       .distinct().join(three, ["lang", "phrase"], "left_anti"), "phrase-rests")
        more = _count_for(docs, rests, 3, _same_as)
        parts = three if more is None else stored(three.unionAll(more).distinct(), "phrase-parts")
        known = stored(_survivors(bare, three, four, words.unionAll(parts.join(three, ["lang", "phrase"], "left_anti")))
                       .join(floors, "lang").where("score >= floor"), "phrase-survivors")
        enough = floors.join(known.groupBy("lang").count(), "lang", "left").withColumn(
            "settled", (F.col("floor") == 0) | (F.coalesce("count", F.lit(0)) >= top))
        enough = stored(enough, "phrase-settled")
        part = known.join(enough.where("settled").select("lang"), "lang").select("lang", "phrase", "a", "l", "r", "score")
        done = part if done is None else done.unionAll(part)
        unsettled = stored(enough.where("not settled").select("lang", F.col("floor").alias("above")), "phrase-open")
        expand *= 2
    if done is None:
        done = scored(bare, words)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = done.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))

"""Token-ID output: frequency-ranked ids in byte-aligned codes with separate control bytes.

1. The texts are encoded once with the given tokenizer and the raw ids stored. A task hashes
   all white-space separated words of a batch at once and encodes each word it has not seen
   yet; ids of known words are gathered from its cache, once their bytes have been compared
   with the cached word's. Splitting at ASCII white space does
   not change the ids of a tokenizer that drops white space and never joins across it; if
   its pattern also separates letters from punctuation, words are cut there, and if it
   lower-cases, words that differ in A-Z only are one. If its vocabulary marks word ends, new
   words of letters are encoded many at once and parted at the marks.
2. The ids are counted over the whole corpus (at most one row per vocabulary entry) and
   ranked by falling count, so that the commonest ids get the smallest codes.
3. The documents are range-partitioned and sorted by ``doc_id`` and, within it, their row
   number, so that many rows under one id are spread too, and written as blocks. A
   block holds the ranks of up to ``BLOCK_DOCS`` documents: 1 to 4 little-endian bytes each in
   ``data``, and their lengths as two bits each, four to a byte, in ``control``; ``doc_ids``,
   ``counts`` and ``before`` (ids of the file's earlier blocks) are its index. The files are Parquet, so any file system Spark knows will
   do and Spark's commit keeps a failed task's output out; the ranks lie beside them.
4. Readers decode a block at once: a 256-entry table turns control bytes into lengths.

Defined cases: null and empty texts have only the end id; rows with equal or null ids stay
rows of their own (nulls first); an empty table writes empty files and reads no row. Other
columns of the input are ignored.
"""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrosense.llm import prefix_hash as ph
from agrosense.llm.common import arrow_bytes, scratch, ship, stored

ship(__name__)
ship(ph.__name__)

END_ID = 2
BLOCK_DOCS = 256
BLOCK_IDS = 1 << 18
ENCODE_WORDS = 1_000
JOINED_WORDS = 100               # words of letters that are encoded as one text
SHORT_WORD = 64                  # bytes up to which words are compared eight bytes at a time
# Fixed value: the pattern of pre-tokenizers that separate letters from punctuation.
SPLIT_PATTERN = r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PIECE_BYTES = 1 << 19            # texts are hashed in pieces of about this size
CACHE_WORDS = 500_000            # words a worker keeps (about 60 bytes each); then it starts anew
CACHE_BYTES = 16 << 20           # and their bytes


# ---- encoding ------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` as integers; its last seven bytes are padding."""
    return np.ndarray(max(len(data) - 7, 0), dtype="<u8", buffer=data, strides=(1,))


def equal_spans(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray,
                n: np.ndarray) -> np.ndarray:
    """Whether ``n`` bytes of ``a`` from ``a_at`` are those of ``b`` from ``b_at``, for many
    spans. The last seven bytes of ``a`` and ``b`` are padding."""
    equal = np.ones(len(n), dtype=bool)
    left, right = _eights(a), _eights(b)
    at, done = np.flatnonzero((n > 0) & (n <= SHORT_WORD)), 0
    while len(at):
        beyond = (8 * np.maximum(0, 8 - (n[at] - done))).astype(np.uint64)
        differ = (left[a_at[at] + done] ^ right[b_at[at] + done]) << beyond
        equal[at[differ != 0]] = False
        done += 8
        at = at[n[at] > done]
    for i in np.flatnonzero(n > SHORT_WORD):
        equal[i] = np.array_equal(a[a_at[i]:a_at[i] + n[i]], b[b_at[i]:b_at[i] + n[i]])
    return equal


class WordCache:
    """Words seen before: their sorted hashes, their bytes, and their ids in one flat array."""

    def __init__(self, tokenizer_json: str, dtype, folds: bool, parts: bool):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype, self.folds, self.parts = dtype, folds, parts
        model = json.loads(tokenizer_json)["model"]
        suffix = model.get("end_of_word_suffix")
        self.ends_word = None
        if suffix and isinstance(model["vocab"], dict):
            self.ends_word = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
            self.ends_word[[i for word, i in model["vocab"].items() if word.endswith(suffix)]] = True
        self.clear()

    def clear(self):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.entry = np.zeros(0, dtype=np.int32)           # of each hash: its word's number
        self.at = np.zeros(0, dtype=np.int64)              # of each word: where its ids begin
        self.length = np.zeros(0, dtype=np.int32)
        self.word_at = np.zeros(0, dtype=np.int64)         # of each word: where its bytes begin
        self.word_bytes = np.zeros(0, dtype=np.int32)
        self.flat, self.used = np.zeros(1 << 16, dtype=self.dtype), 0
        self.text, self.text_used = np.zeros(1 << 16, dtype=np.uint8), 0

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flats, lengths = [], []
        for i in range(0, len(texts), ENCODE_WORDS):
            part = [e.ids for e in self.tokenizer.encode_batch_fast(
                texts[i:i + ENCODE_WORDS], add_special_tokens=False)]
            lengths.extend(map(len, part))
            flats.extend(j for ids in part for j in ids)
        return np.array(flats, dtype=self.dtype), np.array(lengths, dtype=np.int64)

    def _encode_joined(self, words: list[str]):
        """As ``_encode_each`` for words of letters, many in one text: each is one piece to the
        tokenizer, whose last id carries the mark. Where the marks don't agree, one by one."""
        groups = [words[i:i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        for i in range(0, len(groups), 10):
            part = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups[i:i + 10]],
                                                    add_special_tokens=False)
            for group, coded in zip(groups[i:i + 10], part):
                ids = np.array(coded.ids, dtype=np.int64)
                known = len(ids) and ids.max() < len(self.ends_word)
                last = np.flatnonzero(self.ends_word[ids]) if known else ids
                if len(last) == len(group) and last[-1] == len(ids) - 1:
                    yield ids.astype(self.dtype), np.diff(np.concatenate([[-1], last]))
                else:
                    yield self._encode_each(group)

    def encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and the number of ids of each."""
        joined = np.array([self.ends_word is not None and len(t) <= SHORT_WORD and t.isalpha()
                           for t in texts], dtype=bool)
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        n = int(joined.sum())
        coded = list(self._encode_joined([texts[i] for i in order[:n]]))
        coded.append(self._encode_each([texts[i] for i in order[n:]]))
        flat = np.concatenate([ids for ids, _ in coded])
        counts = np.concatenate([lengths for _, lengths in coded])
        lengths = np.zeros(len(texts), dtype=np.int64)
        lengths[order] = counts
        starts = np.zeros(len(texts), dtype=np.int64)
        starts[order] = np.cumsum(counts) - counts
        ends = np.cumsum(lengths)
        return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(len(flat))], lengths

    def add(self, raws: list[bytes]) -> np.ndarray:
        """Keep these words; the numbers they get."""
        flat, lengths = self.encode_words([r.decode("utf-8", "replace") for r in raws])
        text = np.frombuffer(b"".join(raws), dtype=np.uint8)
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.text_used + len(text) + 8 > len(self.text):
            self.text = np.concatenate([self.text, np.zeros_like(self.text)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.text[self.text_used:self.text_used + len(text)] = text
        numbers = (len(self.at) + np.arange(len(raws))).astype(np.int32)
        self.at = np.concatenate([self.at, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths.astype(np.int32)])
        self.word_at = np.concatenate([self.word_at, self.text_used + np.cumsum(sizes) - sizes])
        self.word_bytes = np.concatenate([self.word_bytes, sizes.astype(np.int32)])
        self.used, self.text_used = self.used + len(flat), self.text_used + len(text)
        return numbers

    def ids(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in ``data`` and the number of ids of each text."""
        start, stop = (ph.word_parts if self.parts else ph.words)(data, edges)
        n_docs = len(edges) - 1
        if len(start) == 0:
            return np.zeros(0, dtype=self.dtype), np.zeros(n_docs, dtype=np.int64)
        plain = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        if self.folds:
            marked = np.concatenate([[0], np.cumsum(data == ord("<"))])
            exact = np.flatnonzero(marked[stop] > marked[start])    # may hold a special token
            plain = _LOWER[plain]
            for i in exact:
                plain[start[i]:stop[i]] = data[start[i]:stop[i]]
        h = word_hashes(plain[:len(data)], start, stop)
        size = stop - start
        unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.at) + len(unique) > CACHE_WORDS or self.text_used > CACHE_BYTES:
            self.clear()
        where = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), dtype=bool)
        inside = where < len(self.hashes)
        known[inside] = self.hashes[where[inside]] == unique[inside]
        new = np.flatnonzero(~known)
        raw = plain.tobytes()
        if len(new):
            numbers = self.add([raw[start[i]:stop[i]] for i in first[new]])
            self.hashes = np.insert(self.hashes, where[new], unique[new])
            self.entry = np.insert(self.entry, where[new], numbers)
            where = np.searchsorted(self.hashes, unique)
        word = self.entry[where][inverse]
        same = self.word_bytes[word] == size
        at = np.flatnonzero(same)
        same[at] = equal_spans(plain, start[at], self.text, self.word_at[word[at]], size[at])
        strays = np.flatnonzero(~same)            # another word has the same hash
        if len(strays):
            spelled = [raw[start[i]:stop[i]] for i in strays]
            kinds = {w: k for k, w in enumerate(dict.fromkeys(spelled))}
            word[strays] = self.add(list(kinds))[[kinds[w] for w in spelled]]
        lengths = self.length[word]
        ends = np.cumsum(lengths)
        source = np.repeat(self.at[word] - (ends - lengths), lengths) + np.arange(ends[-1])
        upto = np.concatenate([[0], ends])[np.searchsorted(start, edges)]
        return self.flat[source], np.diff(upto)


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words; equal hashes are told apart by their bytes."""
    return ph.mix64(ph.span_hash(ph.prefix_sums(data), start, stop))


def _word_cache(key: str, tokenizer_json: str, dtype, folds: bool, parts: bool) -> WordCache:
    """The Python worker's cache, in a module of its own: this one is sent anew with each task."""
    kept = sys.modules.setdefault("token_word_cache", types.ModuleType("token_word_cache")).__dict__
    if kept.get("key") != key:
        kept["key"], kept["cache"] = key, WordCache(tokenizer_json, dtype, folds, parts)
    return kept["cache"]


def _cut(data: np.ndarray, limit: int):
    """Pieces of a long text, cut where a word ends."""
    at, n = 0, len(data)
    while at < n:
        stop = min(n, at + limit)
        while stop < n:
            space = np.flatnonzero(ph.IS_SPACE[data[stop:stop + limit]])
            if len(space):
                stop += int(space[0])
                break
            stop = min(n, stop + limit)
        yield data[at:stop]
        at = stop


def encode_texts(cache: WordCache, data: np.ndarray, offsets: np.ndarray, end_id: int):
    """Flat ids of all texts, each closed by ``end_id``, and their ``n + 1`` offsets."""
    flats, counts = [], []
    for i, j in ph.groups_of(offsets, PIECE_BYTES):
        piece = data[offsets[i]:offsets[j]]
        if j == i + 1 and len(piece) > 2 * PIECE_BYTES:
            parts = [cache.ids(p, np.array([0, len(p)]))[0] for p in _cut(piece, PIECE_BYTES)]
            flat = np.concatenate(parts)
            count = np.array([len(flat)])
        else:
            flat, count = cache.ids(piece, offsets[i:j + 1] - offsets[i])
        closed = np.full(len(flat) + len(count), end_id, dtype=cache.dtype)
        closed[np.arange(len(flat)) + np.repeat(np.arange(len(count)), count)] = flat
        flats.append(closed)
        counts.append(count + 1)
    flat = np.concatenate(flats) if flats else np.zeros(0, dtype=cache.dtype)
    lengths = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    return flat, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """``doc_id, row, n, ids``: the raw ids of each text as little-endian integers, and their
    type. ``row`` is a number of the row's own."""
    import json

    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    spec = json.loads(tokenizer_json)
    top = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    dtype = "<u2" if top < 1 << 16 else "<u4"
    folds = '"Lowercase"' in json.dumps(spec["normalizer"] or {})
    parts = SPLIT_PATTERN in json.dumps(spec["pre_tokenizer"] or {}, ensure_ascii=False)
    shared = spark.sparkContext.broadcast(tokenizer_json)     # one file, a few MB
    key = f"{zlib.crc32(tokenizer_json.encode())}-{dtype}"
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        import pyarrow as pa

        from pyspark import TaskContext

        cache = _word_cache(key, shared.value, np.dtype(dtype), folds, parts)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            data, offsets = ph.text_buffers(b.column(1))
            flat, ends = encode_texts(cache, data, offsets, end_id)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(row + np.arange(b.num_rows)), pa.array(np.diff(ends)),
                 ph.binary_column(flat, ends)],
                names=["doc_id", "row", "n", "ids"])
            row += b.num_rows

    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        encode, f"doc_id {id_type}, row long, n long, ids binary")
    return out, dtype


# ---- ranks ---------------------------------------------------------------------------------

def id_counts(ids: DataFrame, dtype: str) -> DataFrame:
    """``id, n`` over the whole corpus; at most one row per vocabulary entry."""
    def count(batches):
        import pyarrow as pa

        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            data, _ = ph.text_buffers(b.column(0))
            part = np.bincount(data.view(dtype))
            if len(part) > len(total):
                total = np.concatenate([total, np.zeros(len(part) - len(total), dtype=np.int64)])
            total[:len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])],
                                         names=["id", "n"])

    return (ids.select("ids").mapInArrow(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))


# ---- blocks --------------------------------------------------------------------------------

def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative integers below 2**32."""
    v = ranks.astype("<u4")
    length = (1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)).astype(np.uint8)
    codes = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    codes[:len(v)] = length - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] < length[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


# control byte -> the four lengths it stands for
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` integers of a block, by table look-up."""
    length = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(length, dtype=np.int64)
    starts = ends - length
    padded = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = padded[starts].astype(np.uint32)
    for k in (1, 2, 3):
        out |= padded[starts + k].astype(np.uint32) << np.uint32(8 * k)
    return out & MASKS[length]


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID) -> None:
    """Write the token files of ``docs`` below ``path``: ``blocks`` and ``ranks``."""
    with scratch(docs.sparkSession), arrow_bytes(docs.sparkSession):
        _write_files(docs, tokenizer_path, path, end_id)


def _write_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int) -> None:
    spark = docs.sparkSession
    coded, dtype = token_ids(docs, tokenizer_path, end_id)
    ids = stored(coded, "token-ids", compression="zstd")

    ranked = Window.orderBy(F.desc("n"), "id")       # a vocabulary's rows, whatever the input
    (id_counts(ids, dtype).withColumn("rank", F.row_number().over(ranked) - 1)
     .write.parquet(f"{path}/ranks"))
    pairs = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()
    rank_of = np.zeros(int(pairs["id"].max()) + 1 if len(pairs) else 1, dtype=np.uint32)
    rank_of[pairs["id"].to_numpy()] = pairs["rank"].to_numpy()
    shared = spark.sparkContext.broadcast(rank_of)   # one integer per vocabulary entry
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches):
        import pyarrow as pa

        seq = before = 0
        for b in batches:
            data, offsets = ph.text_buffers(b.column(1))
            flat, edges = data.view(dtype), offsets // np.dtype(dtype).itemsize
            i, n = 0, b.num_rows
            while i < n:
                j = int(np.searchsorted(edges, edges[i] + BLOCK_IDS, side="right")) - 1
                j = min(n, i + BLOCK_DOCS, max(j, i + 1))
                control, packed = pack(shared.value[flat[edges[i]:edges[j]]])
                counts = np.diff(edges[i:j + 1])
                yield pa.RecordBatch.from_arrays([
                    b.column(2).slice(i, 1), pa.array([seq], pa.int64()),
                    pa.array([before], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
                    pa.array([b.column(0).slice(i, j - i).to_pylist()], pa.list_(b.column(0).type)),
                    pa.array([counts.tolist()], pa.list_(pa.int64())),
                    pa.array([control], pa.binary()), pa.array([packed], pa.binary())],
                    names=["file_no", "block", "before", "n_ids", "doc_ids", "counts", "control", "data"])
                seq, before, i = seq + 1, before + int(counts.sum()), j

    n_files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (ids.select("doc_id", "ids", "row").repartitionByRange(n_files, "doc_id", "row")
     .sortWithinPartitions("doc_id", "row").drop("row").withColumn("file_no", F.spark_partition_id())
     .mapInArrow(blocks, f"file_no int, block long, before long, n_ids long, doc_ids array<{id_type}>, "
                         "counts array<long>, control binary, data binary")
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document in the files; all ids are
    decoded, but not returned unless ``with_ids``."""
    blocks = spark.read.parquet(f"{path}/blocks")
    pairs = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()
    id_of = np.zeros(len(pairs) + 1, dtype="<u4")
    id_of[pairs["rank"].to_numpy()] = pairs["id"].to_numpy()
    shared = spark.sparkContext.broadcast(id_of)     # one integer per vocabulary entry

    files = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.groupBy("file_no").agg(F.sum("n_ids").alias("file_ids"))
               .select("file_no", F.coalesce(F.sum("file_ids").over(files), F.lit(0)).alias("off")))
    placed = blocks.join(F.broadcast(offsets), "file_no")      # one row per file
    placed = placed.withColumn("start", F.col("off") + F.col("before"))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        import pyarrow as pa

        for b in batches:
            for start, doc_ids, counts, control, data in zip(*(b.column(k) for k in range(5))):
                counts = np.array(counts.as_py(), dtype=np.int64)
                edges = np.concatenate([[0], np.cumsum(counts)])
                flat = shared.value[unpack(control.as_py(), data.as_py(), int(edges[-1]))]
                raw = flat.tobytes()
                crcs = [zlib.crc32(raw[4 * edges[k]:4 * edges[k + 1]]) for k in range(len(counts))]
                columns = {"doc_id": doc_ids.values, "start": pa.array(start.as_py() + edges[:-1]),
                           "n_tokens": pa.array(counts), "ids_crc32": pa.array(crcs, pa.int64())}
                if with_ids:
                    columns["ids"] = ph.binary_column(flat, edges)
                yield pa.RecordBatch.from_pydict(columns)

    return placed.select("start", "doc_ids", "counts", "control", "data").mapInArrow(
        decode, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"
                + (", ids binary" if with_ids else ""))

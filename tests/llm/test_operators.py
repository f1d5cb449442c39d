"""Each corpus operator against a brute-force version, and on odd tables."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from agrosense.llm import decontaminate, minmax, suffixes, tokens
from agrosense.llm.decontaminate import contamination, remove_contaminated
from agrosense.llm.licenses import license_scan
from agrosense.llm.minmax import drop_near_duplicates, near_duplicates
from agrosense.llm.mixing import apply_mix, mix_sources
from agrosense.llm.outliers import quality_rules
from agrosense.llm.rules import accept_quality, score_documents
from agrosense.llm.shards import byte_shards, write_shards
from agrosense.llm.suffixes import cut_repeats
from agrosense.llm.warc import read_archives, resolve_revisits, write_archives

from .corpus import frame, odd_rows, prose, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UPPER = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


@pytest.fixture(scope="module")
def data():
    return rows() + odd_rows()


@pytest.fixture(scope="module")
def docs(spark, data):
    return frame(spark, data).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def collected(df, *cols):
    return sorted(([r[c] for c in cols] for r in df.collect()), key=repr)


def size_in_bytes(text):
    return len((text or "").encode())


# ---- 2: shards ---------------------------------------------------------------------------

def test_shards_are_contiguous_equal_and_gapless(docs, data):
    got = byte_shards(docs, 4).collect()
    assert len(got) == len(data)
    total, by = sum(r["size"] for r in got), defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    largest = max(r["size"] for r in got)
    for s, part in by.items():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / 4) <= largest
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order, key=lambda i: -1 if i is None else i)
    expected = Counter((i, size_in_bytes(t) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected


def test_written_shards_hold_every_row(spark, docs, data, tmp_path):
    write_shards(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert collected(back, "doc_id", "text") == sorted(([i, t] for i, t, *_ in data), key=repr)


# ---- 3: token files ------------------------------------------------------------------------

def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_token_files_round_trip(spark, docs, data, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    tokens.write_tokens(docs, path, str(tmp_path / "t"))
    got = tokens.read_tokens(spark, str(tmp_path / "t")).collect()
    t = Tokenizer.from_file(path)
    want = Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids + [2])) for i, x, *_ in data)
    have = Counter((r["doc_id"], struct.unpack(f"<{r['n_tokens']}I", r["ids"])) for r in got)
    assert have == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)


def test_packed_integers_round_trip():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64))
        assert (tokens.unpack(*tokens.pack(v.astype(np.uint32)), n) == v).all()


def test_word_cache_starts_anew(monkeypatch, spark, docs, data, tmp_path):
    import numpy as np

    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokens, "PIECE_BYTES", 500)
    path = tokenizer_path()
    text = open(path, encoding="utf-8").read()
    cache = tokens.WordCache(text, np.dtype("<u2"), True, True)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    raw = [(x or "") for _, x, *_ in data]
    flat = np.frombuffer("".join(raw).encode(), np.uint8)
    edges = np.concatenate([[0], np.cumsum([size_in_bytes(x) for x in raw])])
    ids, ends = tokens.encode_texts(cache, flat, edges, 2)
    for k, x in enumerate(raw):
        assert ids[ends[k]:ends[k + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [2]


def test_words_of_one_hash_keep_their_own_ids(monkeypatch, data):
    import numpy as np
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "word_hashes", lambda data, start, stop: (start % 3).astype(np.uint64))
    monkeypatch.setattr(tokens, "PIECE_BYTES", 2_000)
    path = tokenizer_path()
    t = Tokenizer.from_file(path)
    raw = [(x or "")[:3000] for _, x, *_ in data] + ["İstanbul ǆ ﬁne e\u0301te \u0301 o'clock 12ab34 " + "z" * 70] * 2
    flat = np.frombuffer("".join(raw).encode(), np.uint8)
    edges = np.concatenate([[0], np.cumsum([size_in_bytes(x) for x in raw])])
    cache = tokens.WordCache(open(path, encoding="utf-8").read(), np.dtype("<u2"), True, True)
    ids, ends = tokens.encode_texts(cache, flat, edges, 2)
    for k, x in enumerate(raw):
        assert ids[ends[k]:ends[k + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [2]


def test_long_words_are_not_hoarded(monkeypatch):
    import numpy as np
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CACHE_BYTES", 20_000, raising=False)
    monkeypatch.setattr(tokens, "PIECE_BYTES", 5_000)
    path = tokenizer_path()
    texts = [f"{chr(97 + i % 26)}{i}" * 150 + f" the word {i}" for i in range(300)]
    raw = [x.encode() for x in texts]
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    cache = tokens.WordCache(open(path, encoding="utf-8").read(), np.dtype("<u2"), True, True)
    ids, ends = tokens.encode_texts(cache, flat, edges, 2)
    assert cache.text_used <= 20_000 + 2 * 5_000
    t = Tokenizer.from_file(path)
    for k, x in enumerate(texts):
        assert ids[ends[k]:ends[k + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [2]


def test_batches_of_long_texts_are_bounded(spark, tmp_path, monkeypatch):
    from agrosense.llm import prefix_hash as ph

    groups = ph.groups_of

    def bounded(offsets, limit):
        assert offsets[-1] < 3 << 20, "a batch of any number of bytes"
        return groups(offsets, limit)

    monkeypatch.setattr(ph, "groups_of", bounded)
    docs = frame(spark, [(i, f"words of text {i} " * 1_000, "en", "a") for i in range(400)]).coalesce(1)
    tokens.write_tokens(docs, tokenizer_path(), str(tmp_path / "t"))
    assert tokens.read_tokens(spark, str(tmp_path / "t"), with_ids=False).count() == 400
    assert minmax.near_duplicates(docs).where("kept").count() > 0


def test_token_files_spread_one_id(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i, f"word{i % 7} x") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    tokens.write_tokens(docs, tokenizer_path(), str(tmp_path / "t"))
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "t" / "blocks")).groupBy("file_no")
             .agg({"n_ids": "sum"}).toDF("file_no", "n").collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)              # a third of the rows has one id
    got = tokens.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    digest = tokens.read_tokens(spark, str(tmp_path / "t"), with_ids=False).orderBy("start").collect()
    assert [tuple(r) for r in digest] == [tuple(r)[:4] for r in got]
    ids = [r["doc_id"] for r in got]
    assert len(ids) == 3_000 and ids == sorted(ids, key=lambda i: -1 if i is None else i)


# ---- 4: decontamination ----------------------------------------------------------------------

BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(LOWER))


def brute_contamination(data, items):
    wins = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            wins[tuple(w[i:i + n])].add(str(item))
    out = []
    for i, text, *_ in data:
        w, hit, ids = bench_words(text), set(), set()
        for n in {len(x) for x in wins}:
            for at in range(len(w) - n + 1):
                if tuple(w[at:at + n]) in wins:
                    hit |= set(range(at, at + n))
                    ids |= wins[tuple(w[at:at + n])]
        out.append([i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit)])
    return sorted(out, key=repr)


def test_contamination_against_brute_force(spark, docs, data):
    long = next(t for _, t, *_ in data if t and len(bench_words(t)) > 60)
    items = [(10, " ".join(long.split(" ")[5:40]).upper()), (9, "WORD"), (2, "a B, a b"), (3, None), (4, "..."),
             (5, long), (6, "never seen words in any text of this corpus at all here")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert collected(contamination(docs, bench), *cols) == brute_contamination(data, items)
    bad = {r[0] for r in brute_contamination(data, items) if r[5]}
    left = remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, *_ in data if i not in bad)


def test_contamination_without_a_small_benchmark(spark, data, monkeypatch):
    some = [r for r in data if r[0] is not None and (r[0] < 12 or r[0] == 1006)]      # one of 30,000 words
    long = next(r[1] for r in some if r[0] == 1006)
    items = [(1, " ".join(long.split(" ")[20_000:20_040])), (2, "word"), (3, "a b c"), (4, some[0][1])]
    docs, bench = frame(spark, some), spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "bounded", lambda df: df)                      # BROADCAST_ROWS = 0
    monkeypatch.setattr(decontaminate, "BROADCAST_HASHES", 20, raising=False)         # several shares
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: df)                 # one plan to look at
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = decontaminate.hits(docs, bench)._jdf.queryExecution().optimizedPlan()
        sides = [x for x in plan.toString().split("\n") if "Join Inner" in x]
        assert sides and not any("array_contains" in x for x in sides)                # no words beyond the filter
        cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert collected(contamination(docs, bench), *cols) == brute_contamination(some, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---- 5: mixing -----------------------------------------------------------------------------------

def test_mix_reaches_its_targets(docs, data):
    got = mix_sources(docs).collect()
    assert len(got) == len(data)
    size = lambda t: len(WORD.findall(t or ""))
    source_size = Counter()
    for _, t, _, s in data:
        source_size[s] += size(t)
    names = sorted((s for s in source_size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    open_, target, left = set(names), {}, float(sum(source_size.values()))
    while True:                                     # reshare what is above a cap
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * source_size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * source_size[s]
            left -= target[s]
        open_ -= over
    target.update({s: level * weight[s] for s in open_})
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == source_size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in names:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    again = mix_sources(docs.repartition(2)).collect()
    assert collected(mix_sources(docs), "doc_id", "taken") == sorted(([r["doc_id"], r["taken"]] for r in again), key=repr)


def test_apply_mix_repeats_rows(docs):
    want = Counter()
    for r in mix_sources(docs).collect():
        want[r["doc_id"]] += r["copies"]
    out = apply_mix(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +want


def test_equal_rows_under_one_id_meet_the_target(spark):
    texts = [(7 if k % 3 == 0 else 10 + k, "one two three four five", "en", "abc"[k % 7 // 3]) for k in range(1500)]
    texts += [(None, "six words are in this row", "en", None)] * 300
    docs = frame(spark, texts).repartition(6)
    taken, target, size = Counter(), {}, Counter()
    for r in mix_sources(docs).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        size[r["source"]] += 1
    assert sum(size.values()) == 1800
    for s in size:
        assert abs(taken[s] - target[s]) <= 3, (s, taken[s], target[s])
    want = Counter()
    for r in mix_sources(docs).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"]) for r in apply_mix(docs.repartition(3)).collect()) == +want


# ---- 6: WARC ----------------------------------------------------------------------------------------

PAGES = [(1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>two\r\n\r\nWARC/1.1\r\n</p>"), (7, "http://c/", "<p>one</p>"),
         (3, None, "<p>one</p>"), (4, "http://d/ x\r\ny", None), (5, "http://e/", ""), (6, "", "é" * 4000),
         (6, "", "é" * 4000), (None, "http://n/", "<p>one</p>"), (None, None, "alone")]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1, "d") for p in PAGES],
                                  "page_id bigint, url string, html string, bytes int, digest string")
    write_archives(pages, str(tmp_path / "w"))
    got = read_archives(spark, str(tmp_path / "w")).collect()
    first = {}
    for i, _, h in PAGES:
        h = h or ""
        if i is not None:
            first[h] = min(i, first.get(h, i))
    import base64
    want = Counter()
    for i, _, h in PAGES:
        h = h or ""
        f = first.get(h)
        revisit = f is not None and i != f
        want[(i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
              "revisit" if revisit else "response", f if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in got) == want
    for r in got:
        assert (r["html"] is None) == (r["record_type"] == "revisit")
    small = resolve_revisits(pages, min_bytes=20).where("first_id is not null").collect()
    assert all(r["bytes"] >= 20 for r in small)
    none = str(tmp_path / "none")
    write_archives(pages.limit(0), none)
    assert read_archives(spark, none).count() == 0


# ---- 7: near-duplicates -----------------------------------------------------------------------

def brute_components(data, width, hundredths):
    sets = {}
    for i, t, *_ in data:
        if i is not None:
            w = WORD.findall((t or "").translate(LOWER))
            sets[i] = frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) or (
                frozenset([tuple(w)]) if w else frozenset())
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= hundredths * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    up[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def family(n=150):
    """A chain of texts around the threshold: each changes a few more words of the last."""
    import random

    rng = random.Random(11)
    base = prose(rng, 90).split(" ")
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        out.append((5000 + i, " ".join(w), "en", "a"))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_components_against_brute_force(spark, data, monkeypatch, block):
    monkeypatch.setattr(minmax, "BLOCK", block)
    every = data + family()
    got = near_duplicates(frame(spark, every).repartition(4), 3, (85, 100)).collect()
    want = brute_components(every, 3, 85)
    assert len(got) == len(every)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]], r


def test_one_of_each_group_stays(docs, data):
    left = drop_near_duplicates(docs, 5, (80, 100))
    assert left.columns == docs.columns
    want = brute_components(data, 5, 80)
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, v in want.items() if v[2])


def test_rows_without_an_id_or_sharing_one_are_documents(spark):
    import random

    rng = random.Random(4)
    texts = [prose(rng, 80) for _ in range(8)]
    near = texts[0].rsplit(" ", 1)[0] + " changed"                       # of texts[0], Jaccard > 0.9
    data = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, near), (None, ""),
            (7, texts[2]), (7, texts[3]), (7, texts[3]), (8, texts[4]), (None, texts[4]), (9, texts[5]),
            (None, texts[6].translate(UPPER)), (None, texts[6])]
    docs = frame(spark, [(i, t, "en", "a") for i, t in data]).repartition(4)
    left = Counter((r["doc_id"], r["text"].lower()) for r in drop_near_duplicates(docs, 5, (80, 100)).collect())
    pair = {(None, texts[0].lower()), (None, near.lower())}
    assert sum(left.pop(x, 0) for x in pair) == 1                        # linked, either one stays
    want = [(None, texts[1]), (None, ""), (7, texts[2]), (7, texts[3]), (8, texts[4]), (9, texts[5]),
            (None, texts[6])]
    assert left == Counter((i, t.lower()) for i, t in want)
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs, 5, (80, 100)).collect())
    assert got == Counter({(None, None, True): 5, (None, None, False): 2, (None, 8, False): 1, (7, 7, True): 3,
                           (8, 8, True): 1, (9, 9, True): 1})


# ---- 8: quality rules ---------------------------------------------------------------------------

def test_counts_and_base_rules(docs, data):
    got = quality_rules(docs).collect()
    want = []
    for i, t, *_ in data:
        t = t or ""
        w = WORD.findall(t)
        seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        twice = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append([i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                     len(twice), len(w) < 50 or 100 * len(twice) > 50 * len(w)])
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(([r[c] for c in cols] for r in got), key=repr) == sorted(want, key=repr)
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_outliers_are_rejected_and_the_rest_kept(spark):
    import random

    rng = random.Random(2)
    good = [(i, prose(rng, rng.randrange(60, 300)), "en", "s") for i in range(400)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(rng, 100).split(" ")), "en", "s") for i in range(40)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(frame(spark, good + bad)).collect()}
    assert not any(kept[i] for i, *_ in bad)
    assert sum(kept[i] for i, *_ in good) >= 396


def test_moderate_outliers_are_rejected(spark):
    import random

    rng = random.Random(3)
    vocabulary = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "rt", "sel", "mond", "")]
    lines = lambda n: [" ".join(rng.choice(vocabulary) for _ in range(10)) for _ in range(n)]
    good = [(i, "\n".join(lines(rng.randrange(6, 30))), "en", "s") for i in range(600)]
    bad = {"symbols": [], "repeats": [], "lines": [], "words": []}
    for _ in range(8):
        text = " ".join(lines(15))
        at = rng.sample(range(len(text)), len(text) // 25)              # about 4% of all characters
        bad["symbols"].append("".join("#" if k in at and c != " " else c for k, c in enumerate(text)))
        some = lines(14)
        bad["repeats"].append(" ".join(some + some[:3]))                # 60 of 170 words: 35%
        bad["lines"].append("\n".join(lines(1)[0] + "\n" + "- -\n" * 25 for _ in range(1)) + lines(12)[0]
                            + " " + " ".join(lines(9)))                 # short equal lines
        bad["words"].append("\n".join(lines(400)))                      # 20 times the words
    planted = [(1000 + i, t, "en", "s") for i, t in enumerate(t for v in bad.values() for t in v)]
    got = {r["doc_id"]: r for r in quality_rules(frame(spark, good + planted)).collect()}
    assert [i for i, *_ in planted if got[i]["kept"]] == []
    assert not any(got[1000 + i]["base_failed"] for i in (*range(16), *range(24, 32)))
    assert sum(got[i]["kept"] for i, *_ in good) >= 590


@pytest.mark.parametrize("others", [0, 250])
def test_small_pools_are_judged(spark, others):
    import random

    rng = random.Random(5)
    good = [(i, prose(rng, rng.randrange(60, 300)), "en", "s") for i in range(150)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(rng, 100).split(" ")), "en", "s") for i in range(20)]
    more = [(2000 + i, prose(rng, rng.randrange(60, 300)), "fr", "s") for i in range(others)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(frame(spark, good + bad + more)).collect()}
    assert len(kept) == 170 + others
    assert not any(kept[i] for i, *_ in bad)
    assert sum(kept[i] for i, *_ in good + more) >= 0.98 * (150 + others)


def test_few_rows_reject_nothing(spark):
    import random

    rng = random.Random(6)
    rows = [(i, prose(rng, n), "en", "s") for i, n in enumerate((60, 900, 70, 4000, 200))]
    assert all(r["kept"] for r in quality_rules(frame(spark, rows)).collect())


def test_cutoffs():
    from agrosense.llm import outliers

    assert outliers.f_quantile(0.95, 5, 10) == pytest.approx(3.3258, abs=1e-4)
    assert outliers.f_quantile(0.999, 5, 120) == pytest.approx(4.416, abs=2e-3)
    cuts = [outliers.cutoff(n) for n in (3, 20, 50, 200, 100_000)]
    assert cuts == sorted(cuts, reverse=True) and cuts[0] == float("inf")
    assert cuts[-1] == pytest.approx(outliers.chi2_quantile(outliers.CUTOFF, 5), abs=0.01)


# ---- 9: licences ----------------------------------------------------------------------------------

def test_license_notices(spark):
    texts = {1: "some words\nReleased under the MIT License.\nmore words", 2: "LICENSED under cc-by-nc 4.0",
             3: "no licence here", 4: None, 5: "", 6: "licensed under the Apache License version 2.0\n\n"
             "Released under the MIT license", 7: "one"}
    docs = frame(spark, [(i, t, "en", "a") for i, t in texts.items()] + [(1, texts[1], "en", "a")])
    got = license_scan(docs).collect()
    assert len(got) == 8
    best = {r["doc_id"]: (r["license"], r["licenses"]) for r in got}
    assert best[1] == ("MIT", "MIT") and best[2] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0")
    assert best[6] == ("Apache-2.0", "Apache-2.0,MIT")
    assert all(best[i] == (None, "") for i in (3, 4, 5, 7))


# ---- 10: repeated passages ---------------------------------------------------------------------

def brute_cuts(data):
    texts = defaultdict(list)
    for i, t, *_ in data:
        texts[float("inf") if i is None else i].append((t or "").encode())
    first, out = {}, Counter()
    for i in sorted(texts):
        for b in texts[i]:
            for k in range(len(b) - 49):
                first.setdefault(b[k:k + 50], i)
    for i in sorted(texts):
        for b in texts[i]:
            gone = bytearray(len(b))
            for k in range(len(b) - 49):
                if first[b[k:k + 50]] < i:
                    gone[k:k + 50] = b"\1" * 50
            spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
            rest = bytes(x for x, g in zip(b, gone) if not g)
            out[(None if i == float("inf") else i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot, piece, chunk", [(2000, 1 << 20, 1 << 19), (1, 3000, 700)])
def test_cuts_against_brute_force(spark, monkeypatch, hot, piece, chunk):
    monkeypatch.setattr(suffixes, "HOT_PIECES", hot)
    monkeypatch.setattr(suffixes, "PIECE_BYTES", piece)
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 20_000)
    data = rows(8, 80) + [r for r in odd_rows() if len(r[1] or "") < 5000]
    got = cut_repeats(frame(spark, data).repartition(4)).collect()
    assert Counter(tuple(r) for r in got) == brute_cuts(data)


def test_hash_collisions_are_decided_by_bytes():
    import numpy as np

    data = np.frombuffer(b"a" * 60 + b"b" * 60, np.uint8)
    least = np.array([4, 9])
    smaller = np.array([False, True])
    suffixes._compare_bytes(data, np.array([0, 60]), np.array([0, 1]), least, np.array([0, 1]), smaller)
    assert smaller.tolist() == [False, False]


# ---- 1: classifier ----------------------------------------------------------------------------------

def labelled(n=400):
    import random

    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        t = prose(rng, rng.randrange(20, 120))
        good = i % 4 != 0
        docs.append((i, t if good else t.upper().replace(" ", "!! "), "en", "a"))
        if i % 3:
            labels.append((i, int(good), 0))
    labels += [(0, None, 0), (None, 1, 0), (10 ** 9, 1, 0)]
    return docs + odd_rows(), labels


def test_classifier_on_the_held_out_fold(spark):
    rows_, labels = labelled()
    docs = frame(spark, rows_)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = score_documents(docs, marks).collect()
    assert len(got) == len(rows_)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 if r["doc_id"] is not None else False)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert sum(r["predicted"] == (r["doc_id"] % 4 != 0) for r in held) >= 0.95 * len(held)
    left = accept_quality(docs, marks)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r["doc_id"] for r in got if r["predicted"])


def test_classifier_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {round(r["score"], 6) for r in score_documents(docs, none).collect()} == {0.5}


# ---- empty tables -----------------------------------------------------------------------------------

def test_empty_tables(spark, empty, tmp_path):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for df in (byte_shards(empty), contamination(empty, bench), mix_sources(empty), near_duplicates(empty),
               quality_rules(empty), license_scan(empty), cut_repeats(empty), score_documents(empty, none),
               drop_near_duplicates(empty), apply_mix(empty), remove_contaminated(empty, bench)):
        assert df.count() == 0
    tokens.write_tokens(empty, tokenizer_path(), str(tmp_path / "t"))
    assert tokens.read_tokens(spark, str(tmp_path / "t")).count() == 0


def test_no_benchmark_leaves_all(spark, docs, data):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert remove_contaminated(docs, bench).count() == len(data)
    assert contamination(docs, bench).where("contaminated").count() == 0


@pytest.mark.parametrize("bits", [24, 6])
def test_sets_of_wanted_rows_without_shuffling_texts(spark, monkeypatch, bits):
    """A full bit map lets other rows pass, which the join drops."""
    monkeypatch.setattr(minmax, "MAP_BITS", bits)
    data = rows(n=300) + rows(n=40)
    docs = frame(spark, data)
    keyed = minmax._keyed(docs)
    wanted = keyed.where("doc_id % 7 = 0").select("row")
    plans = []
    stored = minmax.stored

    def seen(df, name):
        if name == "dedup-sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name)
    monkeypatch.setattr(minmax, "stored", seen)
    sets = minmax._sets_of(docs, wanted, 3)
    got = [r["row"] for r in sets.collect()]
    assert sorted(got) == sorted(r["row"] for r in wanted.distinct().collect())
    assert 0 < plans[0].index("LeftSemi") < plans[0].index("MapInArrow")


@pytest.mark.parametrize("bits", [24, 6])
def test_rows_that_stay_are_not_shuffled(spark, monkeypatch, bits):
    """Only rows whose bit is set are held against the rows left out, also with a full map."""
    monkeypatch.setattr(minmax, "MAP_BITS", bits)
    data = rows(n=80) + rows(n=40) + family()
    docs = frame(spark, data)
    left = drop_near_duplicates(docs, 5, (80, 100))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan
    assert left.columns == docs.columns
    kept = sorted(r["doc_id"] for r in near_duplicates(docs, 5, (80, 100)).where("kept").select("doc_id").distinct().collect())
    assert sorted(r["doc_id"] for r in left.collect()) == kept

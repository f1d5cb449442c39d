"""The Jaccard join against comparing all pairs, and its search against plain overlaps."""

import random
import re

import numpy as np
import pytest

from agrosense.llm import overlap_join as oj
from agrosense.llm.overlap_join import Index, jaccard_components

from .corpus import frame, odd_rows, prose, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(data, num, den):
    sets = [shingles(t) for _, t, *_ in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)) and (
                    den * len(a & b) >= num * len(a | b)):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(data):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, *_), s) in enumerate(zip(data, sets))), key=repr)


def near_copies(seed, groups, size):
    """Chains and stars of copies with a few words changed, added or dropped: similarities about 0.9."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = prose(rng, rng.randrange(3, 150)).split(" ")
        now = base
        for k in range(rng.randrange(1, size)):
            now = list(now if g % 2 else base)
            for _ in range(rng.randrange(0, 1 + len(now) // 40 + (len(now) > 12))):
                at = rng.randrange(len(now))
                now[at:at + rng.randrange(2)] = [f"new{rng.randrange(10**6)}"][:rng.randrange(2)]
            out.append((10_000 + 100 * g + k, " ".join(now), "en", "a"))
    rng.shuffle(out)
    return out


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("block, small, threshold", [(4 << 20, 256, (90, 100)), (2_000, 1, (70, 100))])
def test_join_equals_all_pairs(spark, monkeypatch, block, small, threshold):
    monkeypatch.setattr(oj, "BLOCK_BYTES", block)
    monkeypatch.setattr(oj, "SMALL", small)
    data = rows(n=60) + odd_rows() + near_copies(3, 30, 12)
    got = collected(jaccard_components(frame(spark, data).repartition(6), 3, threshold))
    assert got == brute(data, *threshold)
    assert len({c for *_, c in got}) < len(data) - 80


@pytest.mark.parametrize("small", [256, 5])
def test_a_chain_of_near_copies_with_a_common_line(spark, monkeypatch, small):
    """Most links are between members that no pivot shows; a full bit map filters nothing."""
    monkeypatch.setattr(oj, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(oj, "SMALL", small)
    monkeypatch.setattr(oj, "MAP_BITS", 6)
    rng = random.Random(1)
    line = prose(rng, 30)
    words, data = prose(rng, 60).split(" "), []
    for i in range(40):
        words = list(words)
        words[rng.randrange(60)] = f"x{i}"
        data.append((i, line + "\n" + " ".join(words), "en", "a"))
    data += [(100 + i, line + "\n" + prose(rng, 40), "en", "a") for i in range(60)]
    assert collected(jaccard_components(frame(spark, data), 3)) == brute(data, 90, 100)


def test_search_finds_exactly_the_links():
    rng = np.random.default_rng(2)
    for trial in range(40):
        num, den = [(90, 100), (60, 100), (100, 100)][trial % 3]
        base = rng.choice(10_000, 60, replace=False).astype(np.uint64)
        sets = []
        for _ in range(30):
            s = set(base[rng.random(60) > rng.random() * 0.3].tolist()) | set(rng.choice(10_000, rng.integers(0, 8)).tolist())
            sets.append(np.array(sorted(s), dtype=np.uint64))
        index = Index(sets, (num, den))
        for q in sets[:10]:
            links = [k for k, s in enumerate(sets) if den * len(np.intersect1d(q, s)) >= num * len(np.union1d(q, s))]
            assert index.search(q, set(range(30))) == links


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(7)
    for _ in range(400):
        n = int(rng.integers(1, 200))
        a = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
        b = np.concatenate([a[int(rng.integers(0, n // 8 + 1)):], rng.choice(1 << 40, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
        if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            continue
        both, offs = np.concatenate([np.sort(a), np.sort(b)]), np.array([0, len(a), len(a) + len(b)])
        keys, edges = oj.part_keys(both, offs, (90, 100))
        assert set(keys[:edges[1]].tolist()) & set(keys[edges[1]:].tolist())


@pytest.mark.parametrize("data", [[], [(1, None, "en", "a"), (2, "", "en", "a"), (None, "a b c", None, None)]])
def test_empty_tables_and_texts(spark, data):
    assert collected(jaccard_components(frame(spark, data))) == brute(data, 90, 100)


def test_sketches_admit_every_link_and_part_from_few():
    rng = np.random.default_rng(11)
    for _ in range(100):
        base = rng.choice(1 << 40, int(rng.integers(1, 400)), replace=False).astype(np.uint64)
        a = base[int(rng.integers(0, len(base))):]
        offs = np.array([0, len(base), len(base) + len(a)])
        x, y = oj.parity_sketches(np.concatenate([base, a]), offs)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(base) - len(a)


def test_pairs_that_cannot_link_are_not_listed(spark):
    """A common line fills one part of all members, who have nothing else in common."""
    rng = random.Random(5)
    data = [(i, prose(rng, 120), "en", "a") for i in range(12)]
    heads = oj.document_digests(frame(spark, data), 3).localCheckpoint()
    pairs = [(heads.where(f"doc_id = {i}").first()["id"], i) for i in range(12)]
    told = spark.createDataFrame([(1, bytes(k), bytes(k), 12, bytes(pairs[0][0])) for k, _ in pairs],
                                 "b long, id binary, component binary, c long, main binary")
    assert oj._open_pairs(told, heads, (90, 100)).count() == 0
    assert oj._open_pairs(told, heads, (0, 100)).count() == 66


def test_only_members_of_shared_buckets_stay(spark):
    parts = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (2, 7), (2, 7), (2, -3), (3, 9)], "b long, h long")
    assert sorted(map(tuple, oj.shared_buckets(parts).collect())) == [(2, -3, -3), (2, 5, -3), (2, 7, -3)]

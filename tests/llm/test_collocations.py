"""Phrase collocations against counting everything in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from agrosense.llm import collocations as col
from agrosense.llm.collocations import collocations

from .corpus import frame, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(data, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in data:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= 30}
        dropped = set()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    part = p[i:i + k]
                    if 100 * a >= 80 * counts[part]:
                        dropped.add(part)
        rows = []
        for p, a in found.items():
            if p not in dropped:
                cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(seed=2, n=1600):
    """Few words, so that many phrases pass 30; fixed phrases of 2 to 5 words among them."""
    rng = random.Random(seed)
    words = ["Ada", "bit", "cod", "Ére", "fin", "gut", "ñu", "it's", "x-1", "hé"]
    fixed = ["new york city", "to be or not", "once upon a time there", "de facto", "straße auf ab"]
    rare = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 40)):
            kind = rng.random()
            parts.append(rng.choice(fixed) if kind < 0.25 else rng.choice(rare) if kind < 0.4 else rng.choice(words))
            parts.append(rng.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "; ", "\r", "\x0b"]))
        lang = rng.choice(["en"] * 6 + ["de", "und", None])
        out.append((i, "".join(parts).upper() if rng.random() < 0.2 else "".join(parts), lang, "s"))
    return out


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    return texts() + odd_rows()


@pytest.mark.parametrize("top, expand", [(2000, 16_000), (25, 4)])
def test_collocations_equal_full_counts(spark, data, monkeypatch, top, expand):
    """With few bigrams a round, languages settle in different rounds and long before all is grown."""
    monkeypatch.setattr(col, "EXPAND", expand)
    monkeypatch.setattr(col, "PIECE_BYTES", 2_000)
    want = brute(data, top)
    assert len(want) > 30 and {r[0] for r in want} >= {"en", "und", "de"}
    assert rows_of(collocations(frame(spark, data).repartition(5), top)) == want


def test_slices_of_the_frontier(spark, data, monkeypatch):
    monkeypatch.setattr(col, "SLICE_ROWS", 40)
    assert rows_of(collocations(frame(spark, data), 300)) == brute(data, 300)


def test_growth_stops_early(spark, data, monkeypatch):
    """Not everything is expanded when the first phrases are settled."""
    seen = []
    monkeypatch.setattr(col, "EXPAND", 6)
    real = col._count_for
    monkeypatch.setattr(col, "_count_for", lambda d, p, n, pick: (seen.append((n, p.count())), real(d, p, n, pick))[1])
    assert rows_of(collocations(frame(spark, data).where("lang = 'en'"), 3)) == brute([r for r in data if r[2] == "en"], 3)
    whole = len({tuple(r)[1] for r in collocations(frame(spark, data).where("lang = 'en'"), 10_000).collect()})
    assert sum(k for n, k in seen[:1]) < whole


@pytest.mark.parametrize("data_", [[], [(1, None, None, None), (2, "", "en", "a"), (3, ". , ;", "en", "a")],
                                   [(1, "one two. " * 29, "en", "a")], [(1, "one two. " * 30, "en", "a")],
                                   [(1, "w " * 40, None, "a")]])
def test_little_or_no_text(spark, data_):
    assert rows_of(collocations(frame(spark, data_))) == brute(data_, 2000)

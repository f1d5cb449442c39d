"""Small corpora for the corpus operators' tests."""

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          # names that the operators use themselves
          "size bigint, shard int, score double, h bigint, n bigint, b string, component string, k string")
WORDS = ["alpha", "beta", "gamma", "delta", "Éclair", "omega", "sigma", "kappa", "it's", "x1", "ñandú",
         "straße", "<b>", "end.", "(note)", "Über,", "lambda", "rho", "tau", "phi"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def rows(seed=5, n=60):
    """(doc_id, text, lang, source): plain texts, copies, near copies, shared passages, junk."""
    rng = random.Random(seed)
    out, texts = [], []
    shared = prose(rng, 25)
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0 and texts:
            t = rng.choice(texts)
        elif kind == 1 and texts:
            w = rng.choice(texts).split(" ")
            w[rng.randrange(len(w))] = "changed" + str(i)
            t = " ".join(w)
        elif kind == 2:
            t = prose(rng, 30) + "\n" + shared + "\n" + prose(rng, 30)
        else:
            t = prose(rng, rng.randrange(1, 160))
        texts.append(t)
        out.append((i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None])))
    rng.shuffle(out)
    return out


def odd_rows():
    """Nulls, empty, white space, one word, non-ASCII, very long, ties and repeated rows."""
    long = prose(random.Random(9), 30_000)
    base = [(None, "no id", "en", "a"), (None, None, None, None), (1001, None, "en", "a"), (1002, "", "en", "b"),
            (1003, " \n\t ", None, "a"), (1004, "word", "de", None), (1005, "ÀÉ ñ ß ﬁ ́x", "fr", "c"),
            (1006, long, "en", "a"), (1007, long, "en", "a"), (1008, "A b\na B", "en", "a"),
            (1008, "A b\na B", "en", "a"), (1009, "<|endoftext|> <|ENDOFTEXT|> x<|endoftext|>y", "en", "a"),
            (1010, "a" * 3000, "en", "b"), (1011, "line\n" * 400, "en", "b")]
    return base


def frame(spark, data):
    return spark.createDataFrame([(*r, 1, 2, 3, 0.5, 4, 5, "b", "c", "k") for r in data], SCHEMA)

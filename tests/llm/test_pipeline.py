"""The corpus pipeline on odd rows and on empty tables, its stages against brute force."""

from collections import Counter

import pytest

import corpus_pipeline
from agrosense.llm import rules
from agrosense.llm.minmax import drop_near_duplicates

from .corpus import frame, odd_rows, prose, rows
from .test_operators import brute_components, brute_contamination, labelled, tokenizer_path

LABELS, ITEMS = "doc_id bigint, quality int, toxic int", "item_id bigint, text string"


def tables(spark, path, data, labels, items):
    frame(spark, data).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_each_stage_on_what_its_predecessor_kept(spark, tmp_path):
    from tokenizers import Tokenizer

    scored, labels = labelled()
    data = scored + [(2000 + i, *r[1:]) for i, r in enumerate(rows(8, 40))]
    # from a long text that the classifier keeps, and one that no text has
    passage = " ".join(next(t for i, t, *_ in scored if i % 4 and len(t.split(" ")) > 60).split(" ")[4:40])
    items = [(1, passage), (2, "never seen words in any text of this corpus at all here"), (3, None)]
    path = tables(spark, tmp_path, data, labels, items)
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            kept.append([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()])
    good, unique, free, mixed = kept
    assert {i for i, *_ in good if i is not None and i < 400} == {i for i, *_ in scored if i is not None and i < 400 and i % 4}
    want = brute_components(good, 5, 80)
    assert Counter(i for i, *_ in unique if i is not None) == Counter(i for i, v in want.items() if v[2])
    hit = {r[0] for r in brute_contamination(unique, items) if r[5]}
    assert hit and Counter(free) == Counter(r for r in unique if r[0] not in hit)
    assert set(mixed) <= set(free) and max(Counter(mixed).values()) <= 3 * max(Counter(free).values())
    t = Tokenizer.from_file(tokenizer_path())
    lengths = Counter((i, len(t.encode(x or "", add_special_tokens=False).ids) + 1) for i, x, *_ in mixed)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in out.collect()) == lengths
    last = corpus_pipeline.run(spark, path).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in last) == lengths


@pytest.mark.parametrize("data", [[], odd_rows()])
def test_pipeline_without_labels_or_benchmark(spark, tmp_path, data):
    tokenizer_path()
    path = tables(spark, tmp_path, data, [], [])
    got = corpus_pipeline.run(spark, path)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got.count() == 0           # nothing scores above 0.5 without labels


def test_repeated_row_that_stays_does_not_depend_on_the_run(spark):
    import random

    text = prose(random.Random(2), 60)
    docs = frame(spark, [(1, text, "en", s) for s in "dcab"] + [(1, text, "de", "a")] + [(None, text, "en", s) for s in "xy"])
    left = [tuple(r) for n in (1, 3, 7) for r in drop_near_duplicates(docs.repartition(n), 5, (80, 100)).collect()]
    assert len(left) == 3 and len(set(left)) == 1


def test_sample_of_many_labels_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(rules, "MAX_SAMPLE", 100)
    scored, labels = labelled()
    docs, marks = frame(spark, scored), spark.createDataFrame(labels, LABELS)
    assert 50 < rules.labelled_sample(docs, marks).count() < 160
    got = [r for r in rules.score_documents(docs, marks).collect() if r["held_out"] and r["doc_id"] < 400]
    assert sum(r["predicted"] == (r["doc_id"] % 4 != 0) for r in got) >= 0.95 * len(got)

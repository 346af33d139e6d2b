"""The pipeline's stages, each held against a brute-force version of it on its own input."""

import brute
import pytest
from texts import awkward, frame, prose

import corpus_pipeline
from tidemark.llm.text import text_key
from tidemark.session import stored


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rows = awkward() + [(100 + i, prose(900 + i, 60), "en", f"s{i % 3}", 1) for i in range(60)] + [(200, prose(2, 70), "en", "s1", 1)]
    frame(spark, rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, prose(2, 70))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.fixture(scope="module")
def tables(spark, folder):
    """Input of each stage, and the last one's output."""
    now = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        now.append(stored(stage(spark, now[-1], folder), name))
    return now


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_columns_stay(tables):
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_language_drops_what_has_no_letters(tables):
    left = pairs(tables[1])
    assert all(any(c.isalpha() for c in t) for _, t in left)
    assert {i for i, _ in left} >= {1, 2, 3, 9, 10, 12, *range(100, 160)}


def test_near_duplicates(tables):
    found = brute.near(pairs(tables[1]))
    want = {i for i, n, c in found if i is not None and i == c}
    assert {i for i, _ in pairs(tables[2])} - {None} == want


def test_near_duplicates_by_five_words(spark):
    words = [f"w{i}" for i in range(400)]
    changed = [f"x{i}" if i % 40 == 20 else w for i, w in enumerate(words)]
    block = [f"v{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(block)), (4, " ".join(block + [f"u{i}" for i in range(18)]))]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]


def test_decontamination(tables):
    before = pairs(tables[2])
    want = sorted((r[0] for r in brute.contaminated(before, [(1, prose(2, 70))]) if not r[5]), key=repr)
    assert sorted((i for i, _ in pairs(tables[3])), key=repr) == want


def test_mixing_only_repeats_and_drops(tables):
    before, after = pairs(tables[3]), pairs(tables[4])
    assert set(after) <= set(before) and after
    assert max(after.count(x) for x in after) <= 3


def test_records_hold_every_row_in_order(spark, folder, tables):
    ids = [r.doc_id for r in tables[5].orderBy("start").collect()]
    assert sorted(ids, key=repr) == sorted((i for i, _ in pairs(tables[4])), key=repr)
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert corpus_pipeline.run(spark, folder).count() == len(ids)


def test_stages_take_no_rows_and_clashing_columns(spark, folder):
    for rows in ([], None):
        docs = frame(spark, rows, clash=True)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, folder), name)
            assert docs.select(text_key(docs.text)).count() == docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()

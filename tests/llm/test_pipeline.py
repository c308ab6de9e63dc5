"""The pipeline beside plain versions of its stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rushline.llm import lines
from rushline.llm.common import table
from tests.llm import brute
from tests.llm.test_texts import plain_lines


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """Documents with columns whose names the operators use themselves."""
    return table(spark, sf_dir, "documents").withColumns({
        c: F.lit("clash") for c in ("score", "lines", "found", "mix", "copies", "row", "key", "n", "kept", "removal",
                  "plan_of_source", "target", "component")})


def rows_of(df):
    return [tuple(r[c] for c in ("doc_id", "text", "source")) for r in df.collect()]


def test_stages_keep_the_columns_and_take_effect(spark, sf_dir, docs):
    before = docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, sf_dir)
        if number < 4:
            assert after.columns == docs.columns, name
        else:
            assert after.columns[:len(docs.columns)] == docs.columns
            assert "copies_" in after.columns
    assert len(corpus_pipeline.STAGES) == 5


def test_line_stage_equals_brute_force(spark, sf_dir, docs):
    rows = rows_of(docs)
    got = rows_of(corpus_pipeline.drop_boilerplate_lines(spark, docs, sf_dir))
    wanted = plain_lines(rows, lines.Spread())
    assert sorted((repr(i), t) for i, t, _ in got) == [(i, t) for i, t, *_ in wanted]


def test_contamination_stage_equals_brute_force(spark, sf_dir, docs):
    bench = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    some = docs.where("doc_id % 5 = 0")
    got = {r[0] for r in rows_of(corpus_pipeline.drop_contaminated(spark, some, sf_dir))}
    for doc, text, _ in rows_of(some):
        assert (doc in got) != brute.contamination(text, bench)["contaminated"]


def test_run_equals_its_stages(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == [*table(spark, sf_dir, "documents").columns, "size", "target", "copies"]
    rows = result.collect()
    assert all(1 <= r["copies"] <= 3 for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows) > 300


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lines string"


def awkward(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), "clash", "clash") for i, t, s in rows], SCHEMA)


def written(spark, folder, docs, sf_dir):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, sf_dir, name).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_run_on_an_empty_table(spark, sf_dir, tmp_path):
    result = corpus_pipeline.run(spark, written(spark, tmp_path, awkward(spark, []), sf_dir))
    assert result.count() == 0 and result.columns[:7] == [c.split()[0] for c in SCHEMA.split(", ")]


def test_run_on_awkward_rows(spark, sf_dir, tmp_path):
    """NULL ids, texts and sources, repeated rows, a very long text, copies."""
    long = " ".join(f"word{i * i % 9973}" for i in range(60_000))
    rows = [(None, None, None), (None, "text of a row without an id", "a"), (3, "", "b"), (3, "", "b"),
            (4, long, None), (5, long, "c"), (6, "one two three four five six", "a"),
            (6, "one two three four five six", "a"), (7, " \n \t", "a"), (8, None, "c")]
    rows += [(100 + i, f"some text of document {i} with words of its own {i * 7} and {i * 11}", f"s{i % 4}")
             for i in range(40)]
    result = corpus_pipeline.run(spark, written(spark, tmp_path, awkward(spark, rows), sf_dir)).collect()
    kept = [r["doc_id"] for r in result]
    assert set(kept) <= {r[0] for r in rows}
    assert not {4, 5} <= set(kept) and kept.count(6) <= 1
    assert {r["score"] for r in result} <= {"clash"} and all(1 <= r["copies"] <= 3 for r in result)
    texts = {r[0]: r[1] for r in rows}
    assert all(r["text"] == texts[r["doc_id"]] for r in result if r["doc_id"] is not None and r["doc_id"] >= 100)

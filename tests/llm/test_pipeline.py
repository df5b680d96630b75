"""Each stage of the pipeline on its own input."""

import __spark_entry__ as entry_point
import corpus_pipeline
import pytest

from skewloom.llm.decontamination import normal

from .conftest import ODD
from .test_jaccard import brute_force
from .test_toxicity import taught

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """(name, input, output) of each stage over the given tables."""
    top, made = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"file:{top}/{name}")
        after = spark.read.parquet(f"file:{top}/{name}")
        made.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in made}


def test_registered():
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run
    names = set(entry_point.queries())
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 11))


def test_stages_keep_the_columns(stages):
    for name, (_, after) in stages.items():
        if name != "packing":
            assert after.columns == COLUMNS


def test_toxic_documents_go(stages, spark, folder):
    before, after = stages["toxicity"]
    toxic = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 1").collect()}
    left = {r.doc_id for r in after.collect()}
    every = {r.doc_id for r in before.collect()}
    assert len(toxic & left) < 0.5 * len(toxic) and len(every - left - toxic) < 0.1 * len(every)


def test_lines(stages):
    before, after = ({r.doc_id: r for r in x.collect()} for x in stages["line_dedup"])
    for doc_id, row in after.items():
        assert row.n_chars == len(row.text) and len(row.text) <= len(before[doc_id].text)
    assert all(before[gone].text.split() for gone in before.keys() - after.keys())


def test_one_of_each_group_stays(stages):
    before, after = stages["ngram_jaccard_join"]
    expected = brute_force([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, least) in expected.items() if i == least)


def test_leaks_go(stages, spark, folder):
    items = [normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before, after = stages["benchmark_decontamination"]
    leaky = {r.doc_id for r in before.collect() if any(i in normal(r.text) for i in items)}
    left = {r.doc_id for r in after.collect()}
    assert leaky and not leaky & left and len(left) > 0.9 * (before.count() - len(leaky))


def test_all_that_is_left_is_packed(stages):
    before, after = stages["packing"]
    sizes = {r.doc_id: r.n for r in after.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert sizes.keys() == {r.doc_id for r in before.collect()}
    assert all(sizes[r.doc_id] == r.doc_tokens for r in after.collect())


def test_odd_rows(spark, docs, tmp_path):
    rows = [*ODD, *((100 + n, text) for n, (text, _) in enumerate(taught()))]
    frame = docs(*rows)
    marks = [(100 + n, 1, label) for n, (_, label) in enumerate(taught())]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "an item that no document holds")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in result.select("doc_id").distinct().collect()}
    assert {None, 1, 2, 3, 4, 6, 8} <= ids and not any(100 + n in ids for n, (_, label) in enumerate(taught()) if label)
    assert result.filter("doc_id = 6").groupBy().sum("length").first()[0] == result.filter("doc_id = 6").first().doc_tokens


def test_empty_tables(spark, docs, tmp_path):
    docs((1, "x")).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

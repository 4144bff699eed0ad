"""The pipeline keeps clean documents and drops the others, stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clipcurate.llm import decontaminate, near_dedup, toxicity
from clipcurate.llm.common import table
from clipcurate.session import settings

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    from clipcurate.session import written

    docs, out = table(spark, DATA, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), f"test-{name}")
        out.append(docs)
    return out


def test_columns_and_order(spark, stages):
    names = table(spark, DATA, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_dedup", "decontamination", "byte_bpe"]
    assert all(d.columns == names for d in stages[:-1])
    counts = [d.count() for d in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_each_stage_did_its_work(spark, stages):
    toxic, known, single, clean, tokens = stages
    labels = table(spark, DATA, "labels")
    model = toxicity.fit(table(spark, DATA, "documents"), labels)
    assert toxicity.score(toxic, model).where("toxic_pred = 1").count() == 0
    assert known.count() > 0.99 * toxic.count()
    again = near_dedup.classes(single)
    assert again.agg(F.max("n_class")).first()[0] == 1
    hit = decontaminate.match(clean, table(spark, DATA, "benchmark")).where("contaminated").count()
    assert hit == 0
    assert tokens.where("not round_trip").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    run = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in run.select("doc_id").collect()} == {r.doc_id for r in stages[-1].select("doc_id").collect()}


def test_stages_read_and_pass_on_few_rows_at_once(spark):
    names = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    stage = corpus_pipeline._in_small_batches(lambda spark, docs, sf_dir: [int(spark.conf.get(n)) for n in names])
    with settings(spark, **dict.fromkeys(names, "4096")):
        assert stage(spark, None, "") == [500, 1_000]

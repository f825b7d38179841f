from collections import Counter

import pytest

import corpus_pipeline
from lagscope.llm import decontam, mixing, toxicity
from lagscope.llm.base import table

from .cases import no_documents, odd_documents, plain
from .test_near_copies import expected as near_expected
from .test_sharding import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SF, "documents"), []
    out.append(docs)
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{at}")
        docs = spark.read.parquet(f"{root}/{at}")
        out.append(docs)
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_toxic_documents_go(spark, stages):
    scores = toxicity.score_toxicity(stages[0], table(spark, SF, "labels")).collect()
    assert ids(stages[1]) == Counter(r.doc_id for r in scores if r.score < 0.5)


def test_one_of_each_group_stays(stages):
    rows = [tuple(r) for r in stages[1].select("doc_id", "text").collect()]
    assert ids(stages[2]) == Counter({r[5] for r in near_expected(rows)})


def test_benchmark_passages_go(spark, stages):
    judged = decontam.decontaminate(stages[2], table(spark, SF, "benchmark")).collect()
    assert ids(stages[3]) == Counter(r.doc_id for r in judged if not r.contaminated)


def test_documents_are_repeated_as_they_are_taken(stages):
    taken = {r.doc_id: r.copies for r in mixing.mix_digest(stages[3]).collect()}
    assert ids(stages[4]) == +Counter(taken)


def test_the_mix_is_sharded(stages):
    assert ids(stages[5]) == ids(stages[4])
    check(stages[5].collect(), 16)


def test_columns_and_the_whole_run(spark, stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])
    whole = plain(corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot"))
    assert sorted(map(tuple, whole.values)) == sorted(map(tuple, plain(stages[5].select("doc_id", "shard", "slot")).values))


def test_stages_without_documents_and_with_odd_ones(spark):
    for docs in (no_documents(spark), odd_documents(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == no_documents(spark).columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()

"""Registered queries against their SQL; the pipeline against its parts."""

import pytest

import corpus_pipeline
from pitchlake.llm.catalog import QUERIES, SQL
from pitchlake.plans.verify import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), SQL[name]) == []


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


def test_stages(spark):
    """Every stage against what its operator's query says of its input."""
    from pitchlake.llm import decontaminate, exact_dedup, mixing, ngram_join, quality
    from pitchlake.llm.common import cut, table
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    wanted = {
        "quality classifier": lambda d: quality.quality_scores(d, quality.train(d)).where("accepted"),
        "exact dedup": lambda d: exact_dedup.exact_groups(d).where("kept"),
        "n-gram Jaccard join": lambda d: ngram_join.ngram_groups(d).where("doc_id = component_id"),
        "benchmark decontamination": lambda d: decontaminate.contamination(d, table(spark, SF, "benchmark")).where("not contaminated"),
        "mixing sources to target weights": mixing.mix,
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == list(wanted)
    for name, stage in corpus_pipeline.STAGES:
        out = cut(stage(spark, docs, SF), "stage")
        assert ids(out) == ids(wanted[name](docs)), name
        if not name.startswith("mixing"):
            assert out.columns == columns
        docs = out
    assert sorted(map(str, corpus_pipeline.run(spark, SF).select("doc_id", "epoch").collect())) == \
        sorted(map(str, docs.select("doc_id", "epoch").collect()))


def test_stages_take_empty_and_odd_tables(spark, documents):
    odd = documents([(1, None), (2, ""), (3, "a few plain words of text, and then some more of them."), (3, "a few plain words of text, and then some more of them."),
                     (None, "another text with words, which is long enough to be judged.")], extra=True)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= 6

"""The pipeline's stages against plain versions of their decisions, each on its own input."""

import corpus_pipeline
from tests.llm.test_near_copies import components
from tests.llm.test_tokens import check_packed, wanted
from tallymart.llm import language, quality


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "language ID", "n-gram Jaccard join", "best-fit packing"]

    kept = stages["quality rules"](spark, docs, sf_dir).cache()
    assert kept.schema.names == docs.schema.names
    judged = {r.doc_id: r for r in quality.judged(docs).collect()}
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == {k for k, r in judged.items() if r.kept}
    assert all(got[k].text == judged[k].clean_text and got[k].n_chars == len(got[k].text) for k in got)

    spoken = stages["language ID"](spark, kept, sf_dir).cache()
    verdict = {r.doc_id: r for r in language.query(kept).collect()}
    got = {r.doc_id: r for r in spoken.collect()}
    assert spoken.schema.names == docs.schema.names
    assert set(got) == {k for k, r in verdict.items() if not r.rejected} and all(got[k].lang == verdict[k].lang_pred for k in got)

    texts = {r.doc_id: r.text for r in spoken.collect()}
    single = stages["n-gram Jaccard join"](spark, spoken, sf_dir).cache()
    assert single.schema.names == docs.schema.names
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(components(texts).values()))

    rows = [(r.doc_id, r.text) for r in single.collect()]
    n, least = check_packed(stages["best-fit packing"](spark, single, sf_dir).collect(), wanted(rows))
    assert n <= least + 1


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = docs.join(labels.where("quality = 1"), "doc_id")
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    lost = good.join(quality.judged(docs).where("NOT base_failed").select("doc_id"), "doc_id").join(kept.select("doc_id"), "doc_id", "left_anti")
    assert lost.count() <= 0.01 * good.count()
    spoken = corpus_pipeline.language_id(spark, kept, sf)
    assert kept.join(spoken.select("doc_id"), "doc_id", "left_anti").count() <= 0.02 * kept.count()


def test_odd_tables(spark, odd, none):
    for table in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, "").collect()
            assert len(out) <= max(0, 12 * table.count()), name
    ids = [r.doc_id for r in corpus_pipeline.one_of_each_group(spark, odd, "").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7]

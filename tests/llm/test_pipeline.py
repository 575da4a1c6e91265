"""Each stage against a plain version of itself on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm.decontaminate import ERROR_RATE, normal_text
from tickloom.llm.queries import table, vocabulary
from tickloom.llm.quality import score, train

from .test_decontaminate import stretch_distance
from .test_lines import brute as brute_lines
from .test_nearcopies import components
from .test_tokens import check_pack

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_small_corpus(spark, docs):
    stage = {name: lambda d, f=f: f(spark, d, "/root/testdata/sf0.001").cache() for name, f in corpus_pipeline.STAGES}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    lines = stage["line dedup"](docs)
    want = {k: t for k, (t, n, m) in brute_lines(rows).items() if not m or m < n}
    assert {r.doc_id: r.text for r in lines.collect()} == want and lines.columns == COLUMNS
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lines.collect())
    near = stage["SimHash near-dedup"](docs)
    label, _ = components([t for _, t in rows])
    assert {r.doc_id for r in near.collect()} == {rows[i][0] for i in set(label)} and near.columns == COLUMNS
    packed = stage["best-fit packing"](docs)
    check_pack(packed.collect(), dict(rows))
    clean = stage["benchmark decontamination"](docs)
    assert clean.columns == COLUMNS and clean.count() == docs.count()


def test_quality_and_leaks_on_the_test_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    kept = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    good = {r.doc_id for r in score(docs, train(docs, labels)).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == COLUMNS
    items = [normal_text(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    texts = {r.doc_id: normal_text(r.text) for r in docs.filter("length(text) < 1500").collect()}
    left = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, sf_dir).collect()}
    leaks = {k for k, t in texts.items() if any(i in t for i in items)}
    assert leaks and not leaks & left
    for k in sorted(set(texts) - leaks)[:25]:
        leaky = any(stretch_distance(i, texts[k]) <= int(ERROR_RATE * len(i)) for i in items[:8])
        assert not (leaky and k in left)


def test_empty_and_odd_documents(spark, docs, empty_docs, sf_dir):
    """Null ids and texts, repeated rows and ids, and clashing columns: what each stage keeps of them."""
    rows = [(None, None, None, None, None), (None, "a b c", None, None, 5), (7, "x", None, None, None), (7, "x", None, None, None), (7, "other words of one id here", "en", "s", 1)]
    odd = spark.createDataFrame(rows, docs.schema).withColumn("n_lines", F.lit(1))
    want = {"line dedup": 4, "SimHash near-dedup": 4, "benchmark decontamination": 5, "best-fit packing": 5}
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty_docs, sf_dir).count() == 0, name
        out = f(spark, odd, sf_dir)
        assert out.count() == want.get(name, out.count()), name
        assert name == "best-fit packing" or out.columns == odd.columns, name


def test_run_end_to_end(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert 0 < len(ids) < 200 and vocabulary()

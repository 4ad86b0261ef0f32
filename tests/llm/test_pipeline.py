import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


def test_stages(spark, tmp_path):
    """Each stage against the operator it applies, on its own input; no document that a stage keeps is lost."""
    import corpus_pipeline
    from stemma.llm import packing, quality_classifier, secret_scan, simhash_dedup, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        ids = sorted(r.doc_id for r in out.select("doc_id").collect())
        if name == "quality":
            assert ids == sorted(r.doc_id for r in quality_classifier.score_table(docs, labels).collect() if r.predicted)
        elif name == "toxicity":
            assert ids == sorted(r.doc_id for r in toxicity.score_table(docs, labels).collect() if not r.predicted)
        elif name == "near_duplicates":
            assert ids == sorted({r.component_id for r in simhash_dedup.dedup_table(docs).collect()})
        elif name == "secrets":
            before = {r.doc_id: r.text for r in docs.collect()}
            assert {r.doc_id: r.text for r in out.collect()} == {i: secret_scan.masked(t) for i, t in before.items()}
        else:
            assert sum(r.length for r in out.collect()) == sum(r.tokens for r in packing.tokenised(docs).collect())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        docs = out


def test_run_and_registration(spark):
    import __spark_entry__ as e

    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in e.queries() if q.startswith("op") and q[2].isdigit()}
    assert e.queries()["pipeline"](spark, SF).count() > 0


def test_whole_tables(spark):
    """The queries keep a row for each row of their table."""
    import __spark_entry__ as e

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_license_scan", "op4_simhash_dedup", "op6_secret_scan", "op7_quality_rules", "op8_byte_bpe"):
        assert e.queries()[name](spark, SF).count() == n


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of small tables: labels that say which documents are good and which are toxic."""
    at = tmp_path_factory.mktemp("sf")
    good = "the quiet river walks under the old bridge in winter and nobody of the village is there to see it"
    rows = [(i, f"{good} {i} {i * 7} {i * 13}" if i % 3 else "BUY!! NOW!! CHEAP!!", "en", "s", 0) for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def stages():
    import corpus_pipeline

    return corpus_pipeline.STAGES


@pytest.mark.parametrize("name", [n for n, _ in stages()])
def test_stages_on_odd_tables(spark, folder, odd_texts, docs, name):
    """Nulls, empty and very long texts, repeated rows, clashing and dotted column names: a stage keeps the columns and
    loses nothing that its operator keeps; an empty table stays one."""
    from stemma.llm import packing, quality_classifier, secret_scan, simhash_dedup, toxicity

    stage = dict(stages())[name]
    d = docs(odd_texts).withColumnRenamed("h", "a.b").withColumnRenamed("pos", "first_id").withColumnRenamed("part", "first_th").withColumnRenamed("key", "odd`name")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = stage(spark, d, folder)
    got = sorted((r.doc_id if r.doc_id is not None else -1) for r in out.select("doc_id").collect())
    ids = lambda rows: sorted(r.doc_id if r.doc_id is not None else -1 for r in rows)
    if name == "quality":
        assert got == ids(r for r in quality_classifier.score_table(d, labels).collect() if r.predicted)
    elif name == "toxicity":
        assert got == ids(r for r in toxicity.score_table(d, labels).collect() if not r.predicted) and len(got) > 0
    elif name == "near_duplicates":
        roots = {(r.component_id, r.fingerprint if r.component_id is None else "") for r in simhash_dedup.dedup_table(d).collect()}
        assert len(got) == len(roots) and {g for g in got if g >= 0} == {c for c, _ in roots if c is not None}
    elif name == "secrets":
        assert got == ids(d.collect())
        text = {(r.doc_id, r.text) for r in out.collect()}
        assert text == {(i, secret_scan.masked(t)) for i, t in odd_texts}
    else:
        assert sum(r.length for r in out.collect()) == sum(r.tokens for r in packing.tokenised(d).collect())
    if name != "packing":
        assert out.columns == d.columns and out.dtypes == d.dtypes
        assert all(r["first_id"] == r["a.b"] == "x" for r in out.collect())
    empty = d.limit(0)
    assert stage(spark, empty, folder).collect() == []
    nothing = spark.createDataFrame([(None, None, None, None, None)] * 3, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    rest = stage(spark, nothing, folder).collect()
    assert len(rest) == {"near_duplicates": 1}.get(name, 3), rest


def test_run_leaves_only_its_last_rows(spark, folder):
    import os
    import corpus_pipeline

    shared = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(spark, folder)
    new = [n for n in set(os.listdir(shared)) - before if n.split("-")[0] in dict(stages())]
    assert [n.split("-")[0] for n in new] == ["packing"] and out.count() > 0

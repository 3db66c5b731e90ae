"""The pipeline's stages against the operators' plain decisions, and the driver's contract."""

import corpus_pipeline
from shroud.llm import compression_quality, decontamination, simhash, toxicity
from tests.llm.test_near_copies import plain_kept

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    tox, good = toxicity.train(spark, SF), compression_quality.train(spark, SF)
    scores, sizes = tox.word_scores(), good.sizes()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_dedup", "decontamination", "packing"]
    left, at = docs, rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
        if name == "toxicity":
            want = {i for i, t in at.items() if toxicity.text_scores([t], tox, scores)[0] < 0.5}
        elif name == "quality":
            want = {i for i, t in at.items() if compression_quality.probabilities([t], good, sizes)[0] >= 0.5}
        elif name == "near_dedup":
            want = set(plain_kept(list(at.items())))
        else:
            bad = {r.doc_id for r in decontamination.decontaminate(docs, benchmark).collect() if r.contaminated}
            want = set(at) - bad
        got = [r.doc_id for r in left.select("doc_id").collect()]
        assert sorted(got) == sorted(want), name
        at = {i: rows[i] for i in want}
    packed = corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()
    assert {r.doc_id for r in packed} == set(at)


def test_repeated_and_missing_ids(spark):
    text = "some words that are repeated here for a while " * 3
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (2, text, "c"), (None, text, "d"), (5, "another text of its own kind", "e"), (5, "another text of its own kind", "f")], "doc_id long, text string, component_id string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "5", "None"]


def test_one_id_with_two_texts(spark):
    a, b = "first text about one thing and more of it " * 3, "quite another text on some other matter here " * 3
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (7, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[:5]) for r in simhash.keep_one(docs).collect()) == [(1, "first"), (5, "quite")]


def test_empty_tables(spark, tmp_path):
    import __spark_entry__ as entry

    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in entry.queries().items():
        if name == "pipeline" or name.startswith("op"):
            assert query(spark, str(tmp_path)).collect() == [], name


def test_queries_are_registered(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()

from collections import Counter

import corpus_pipeline
from lodestone.catalog import load
from lodestone.llm import bpe, mixing, quality, queries
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash_quality import brute_components, brute_fingerprint


def test_stages_equal_brute_force(spark, data):
    """Each stage against a plain version of itself, on what the stage before it kept."""
    docs = load(spark, data, "documents")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    trees = quality.train(docs, load(spark, data, "labels"))
    good = {i: t for i, t in rows.items() if round(float(trees.scores(quality.np.array([quality.statistics(t)]))[0]), 12) >= 0.7}
    kept = corpus_pipeline.quality_stage(spark, docs, data)
    assert {r.doc_id: r.text or "" for r in kept.collect()} == good and kept.columns == docs.columns

    kept = corpus_pipeline.stage(kept, "t1")
    lines = corpus_pipeline.line_stage(spark, kept, data)
    want = brute_lines(list(good.items()))
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {i: (t, len(t)) for i, t in want.items()} and lines.columns == docs.columns

    lines = corpus_pipeline.stage(lines, "t2")
    groups = brute_components([(i, brute_fingerprint(t)) for i, t in want.items()])
    single = corpus_pipeline.simhash_stage(spark, lines, data)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values())) and single.columns == docs.columns

    single = corpus_pipeline.stage(single, "t3")
    mixture = mixing.fit(single, load(spark, data, "labels"))
    copies = {r.doc_id: r.copies for r in mixing.document_rates(single, mixture).collect()}
    mixed = corpus_pipeline.mixing_stage(spark, single, data)
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n}) and min(copies.values()) >= 1
    assert mixed.columns == docs.columns

    own = bpe.WordBPE(queries.vocabulary())
    out = corpus_pipeline.run(spark, data).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed.collect())
    assert all(r.ids == own.encode(want[r.doc_id]) and r.n_tokens == len(r.ids) for r in out)


def test_stages_on_odd_tables(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, None, "en", "a", None), (None, "some words\n\nhere", None, None, 3), (2, "", "de", "b", 0), (2, "x", "de", "b", 1), (2, "x", "de", "b", 1), (3, "y " * 60_000, "fr", "c", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = docs
    for name, apply in corpus_pipeline.STAGES[:3]:
        kept = corpus_pipeline.stage(apply(spark, kept, str(tmp_path)), name, spark)
    # Of the two texts without words the earlier stays, of the repeated row one, and each other text.
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "some words\n\nhere"), (1, ""), (2, "x"), (3, "y " * 60_000)]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.n_tokens) for r in out} == {(None, 3), (1, 0), (2, 1), (3, 60_000)}
    empty = docs.limit(0)
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "bpe" or out.columns == docs.columns)

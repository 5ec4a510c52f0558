"""The pipeline's stages on a small table."""

import corpus_pipeline as cp


def test_stages_take_effect(spark):
    tiny = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, tiny)
        docs = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept[1] < kept[0] and kept[2] < kept[1] and kept[3] < kept[2] and kept[4] == kept[3]
    assert any("[EMAIL]" in r.text or "[PHONE]" in r.text or "[CARD]" in r.text or "[IP]" in r.text for r in docs.collect())
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    groups = [r.text for r in docs.collect()]
    assert len(set(groups)) == len(groups)
    pieces = cp.STAGES[-1][1](spark, docs, tiny)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.collect()} <= set(texts)


def test_run_gives_the_last_stage(spark, tiny):
    out = cp.run(spark, tiny)
    assert out.count() > 0 and "sequence_id" in out.columns


def rough(spark, rows):
    """Documents with a further column whose name the operators use themselves."""
    return spark.createDataFrame([(*r, "de", "web", len(r[1] or ""), "z") for r in rows], "doc_id long, text string, lang string, source string, n_chars int, score string")


def test_stages_on_odd_rows(spark, tiny):
    words = [f"Wort{i} steht hier im Satz. " for i in range(40)]
    one, two = "".join(words), "".join(reversed(words))
    rows = [(1, one), (1, one), (1, two), (2, one), (3, one + "Ende"), (None, one), (None, one), (4, None), (5, ""), (5, None), (6, " \n "), (7, two * 300)]
    docs = rough(spark, rows)
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, tiny)
        assert out.columns == docs.columns and stage(spark, rough(spark, []), tiny).count() == 0
        got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        assert all(r.score == "z" and r.source == "web" for r in out.collect())
        if name == "near-duplicates":
            # docs 2 and 3 resemble doc 1's first text, doc 7 its other one, which has its own class; repeated rows are one
            assert got == sorted([(1, one), (1, two), (None, one), (4, None), (5, ""), (5, None), (6, " \n ")], key=str)
        elif name == "toxicity":
            assert got == sorted(rows, key=str)
        elif name == "personal data":
            assert [g[0] for g in got] == [g[0] for g in sorted(rows, key=str)]
    pieces = cp.STAGES[-1][1](spark, docs, tiny)
    assert pieces.groupBy().sum("length").first()[0] > 0 and pieces.filter("doc_tokens = 1").count() == 3 and cp.STAGES[-1][1](spark, rough(spark, []), tiny).count() == 0

"""The pipeline against brute force, stage by stage."""

import public_tokenizers
import sentencepiece
from test_decontaminate import brute_score, words
from test_dedup import brute_fp, brute_parts, brute_repeats, brute_shingles

import corpus_pipeline as P
from voxlake.llm import toxicity


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(P.STAGES) == 5
    clean = P.clean_language(spark, docs, sf_dir)
    assert clean.columns == list(P.COLUMNS)
    bad = {r.doc_id for r in toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("score >= 0.3").collect()}
    assert rows_of(clean).keys() == rows_of(docs).keys() - bad

    one = P.one_of_each_group(spark, docs, sf_dir)
    texts = {r.doc_id: r.text for r in docs.collect()}
    parts = brute_parts(list(texts), [brute_fp(t) for t in texts.values()], sets=[brute_shingles(t) for t in texts.values()])
    assert rows_of(one).keys() == {i for i, p in parts.items() if i == p}

    cut = rows_of(P.unrepeated_text(spark, docs, sf_dir))
    want = brute_repeats(list(texts.items()))
    assert cut.keys() == {i for i, w in want.items() if w[1] < w[0] or not w[1]}
    assert all(cut[i].text == texts[i] for i in cut if not want[i][1])
    assert all(len(cut[i].text.encode()) <= want[i][0] - want[i][1] for i in cut)

    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    some = {i: t for i, t in texts.items() if len(t) < 3000}
    left = rows_of(P.without_test_items(spark, docs.where("length(text) < 3000"), sf_dir))
    leaks = {i for i, t in some.items() if max(brute_score(u, words(t)) for u in items) >= 0.6}
    maybe = {i for i, t in some.items() if max(brute_score(u, words(t)) for u in items) >= 0.5}
    assert leaks and some.keys() - maybe <= left.keys() <= some.keys() - leaks

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    done = rows_of(P.token_ids(spark, docs, sf_dir))
    assert all(r.ids == sp.encode(texts[i]) and r.round_trip for i, r in done.items())


def test_run_and_odd_rows(spark, sf_dir, tmp_path):
    out = P.run(spark, sf_dir)
    assert 0 < out.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = [(1, "fine text here", "en", "s", 14), (None, "no id", None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, "fine text here", "en", "s", 14)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.doc_id is None, r.doc_id) for r in P.run(spark, str(tmp_path)).collect() if r.doc_id is not None) == [(False, 1), (False, 2)]
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/e/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/e/{name}.parquet")
    assert P.run(spark, f"{tmp_path}/e").count() == 0


def test_clashing_columns_repeats_and_long_texts(spark, sf_dir, tmp_path):
    """Extra columns named like inner ones change nothing; rows that repeat a doc_id stay apart in texts; a text of a million letters goes through."""
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(100_000))
    rows = [(1, "one fine text", "en", "s", 13), (1, "another fine text here", "en", "s", 22), (2, long, "en", "s", len(long)), (3, long + " tail", "en", "s", len(long) + 5), (5, "one fine text", "en", "s", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = docs.selectExpr("*", "1 as place", "'k' as kept", "2 as score", "3 as predicted", "4 as component_id", "5 as n_removed", "6 as item_id", "7 as no_text", "array(1) as s", "array(2) as n")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for i, (name, stage) in enumerate(P.STAGES):
        a, b = (stage(spark, df, str(tmp_path)) for df in (docs, extra))
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
        assert i + 1 == len(P.STAGES) or a.columns == list(P.COLUMNS)
    cut = sorted((r.doc_id, len(r.text)) for r in P.unrepeated_text(spark, docs, str(tmp_path)).collect())
    assert (1, 13) in cut and (1, 22) in cut and (2, len(long)) in cut and all(n < 120 for i, n in cut if i == 3)
    assert {r.doc_id for r in P.one_of_each_group(spark, docs, str(tmp_path)).collect()} >= {1, 2}


def test_decisions_come_before_rows(spark, sf_dir):
    """The join that leaves rows out has no Python beside it: what goes is a table by then.  Batches of the session are as before."""
    docs, batch = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for stage in (P.clean_language, P.one_of_each_group, P.without_test_items):
        plan = stage(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "MapInArrow" not in plan
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch

"""Each stage against a plain version of its rule, on its own input."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from caselake.llm import decontaminate, mixing, simhash, toxicity

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns
    flagged = {r["doc_id"] for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("toxic").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - flagged

    one = stages["near_duplicates"](spark, docs, SF)
    assert one.columns == docs.columns
    assert {r["doc_id"] for r in one.collect()} == {r["component_id"] for r in simhash.near_duplicates(docs).collect()}

    clean = stages["decontamination"](spark, docs, SF)
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in docs.collect() if any(i in decontaminate.normal(r["text"]) for i in items)}
    assert held and held.isdisjoint(r["doc_id"] for r in clean.collect())
    assert clean.count() + len(held) == docs.count()

    copies = stages["mixing"](spark, docs, SF)
    want = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    got = {r["doc_id"]: r["w"] for r in copies.groupBy("doc_id").agg(F.sum(mixing.words(F.col("text"))).alias("w")).collect()}
    assert got == {d: w for d, w in want.items() if w or d in got}


def test_run_reaches_the_token_files(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = out.orderBy("start").collect()
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert len(got) > 50


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def groups(texts):
    """Group number of each text, from all pairs of fingerprints."""
    codes = [simhash.fingerprint(t) for t in texts]
    of = list(range(len(codes)))
    for i, a in enumerate(codes):
        for j, b in enumerate(codes[:i]):
            if (a ^ b).bit_count() <= simhash.RADIUS:
                of = [of[j] if x == of[i] else x for x in of]
    return of


def test_near_duplicates_keep_one_of_each_group(spark):
    first, second, third, fourth = (" ".join(f"{c}{k}" for k in range(400)) for c in "abcd")
    given = [(None, first), (None, second), (None, second + " end"), (1, third), (None, third), (2, fourth), (2, third + " end"), (2, fourth), (3, None), (None, ""), (4, " ")]
    docs = spark.createDataFrame([(i, t, "s", n, {"k": n}, "x") for n, (i, t) in enumerate(given)], "doc_id long, text string, source string, _row int, `a.b` map<string,int>, component_id string").repartition(3)
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert out.columns == docs.columns and out.schema["a.b"].dataType == docs.schema["a.b"].dataType
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    of = groups([t for _, t in given])
    assert len(kept) == len(set(of))
    for g in set(of):
        members = [r for r, k in zip(given, of) if k == g]
        least = min((i for i, _ in members if i is not None), default=None)
        assert sum(r in members and r[0] == least for r in kept) == 1


def test_near_duplicates_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [(r["doc_id"], r["text"]) for r in docs.collect()]
    of = groups([t for _, t in held])
    want = {min(i for (i, _), k in zip(held, of) if k == g) for g in set(of)}
    assert sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()) == sorted(want)


def test_odd_rows_and_names_pass_every_stage(spark, odd):
    """Nulls in any column, very long texts, repeated rows, and names the stages use themselves."""
    docs = odd.withColumns({"_tox": F.lit("mine"), "_row": F.col("doc_id"), "_doc": F.lit(1), "_key": F.lit(2), "_copies": F.lit(9), "a.b": F.create_map(F.lit("k"), F.lit(1)), "toxic": F.lit(None).cast("boolean")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        got = out.collect()
        assert got and all(r["_tox"] == "mine" and r["_copies"] == 9 and r["a.b"] == {"k": 1} for r in got), name
        if name in ("toxicity", "decontamination"):
            assert len(got) == docs.count(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_decontamination_by_row(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(decontaminate.normal(r["text"])) > 40)
    given = [(None, f"before {item} after"), (None, "clean without an id"), (1, f"{item}"), (1, "clean with the same id"), (2, "clean"), (2, None)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in given], "doc_id long, text string, source string").repartition(3)
    kept = [tuple(r)[:2] for r in dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF).collect()]
    assert sorted(kept, key=str) == sorted([given[1], given[3], given[4], given[5]], key=str)


def test_python_workers_get_small_batches_and_the_session_its_own_setting_back(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def look(spark, docs, sf_dir):
        seen.append(int(spark.conf.get(key)))
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("look", look)])
    before = spark.conf.get(key)
    spark.conf.set(key, "7777")
    try:
        corpus_pipeline.run(spark, SF)
        assert seen == [2000] and spark.conf.get(key) == "7777"
    finally:
        spark.conf.set(key, before)

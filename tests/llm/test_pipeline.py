"""The pipeline's stages hold what their operators decide, on the given small table."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "repeats", "decontamination", "packing"]
    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") for n in names) == 13


def test_rows_without_an_id_are_documents_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(1, text), (None, text), (None, text), (None, other), (None, other), (None, None), (2, None), (3, ""), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted([(1, text), (None, other), (None, None), (2, None), (3, ""), (3, "")], key=repr)
    assert pipeline.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_toxic_rows_go(spark):
    larger = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    model = pipeline.toxicity.train(docs, spark.read.parquet(f"{larger}/labels.parquet"))
    scores = pipeline.toxicity.score(docs, model, ["doc_id"])
    left = {r.doc_id for r in pipeline.drop_toxic(spark, docs, larger).collect()}
    assert left == {r.doc_id for r in scores.where("score < 0.5").collect()} and len(left) < docs.count()


def test_each_stage_takes_effect(spark):
    from strata.llm import decontamination, near_dedup, repeats
    from strata.llm.common import scratch
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit("x")).withColumn("id", F.lit(None).cast("int"))
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(-1).cast("long")).withColumn("text", F.lit(None).cast("string")))
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        docs = kept[name] = scratch(stage(spark, docs, SF), "test")
        if name != "packing":
            assert docs.columns == columns
    assert kept["toxicity"].where("text is null").count() == 1
    assert near_dedup.near_duplicates(kept["near_dedup"]).where("not kept").count() == 0
    assert kept["repeats"].count() == kept["near_dedup"].count() == kept["decontamination"].count()
    bytes_left = {r.doc_id: bytes(r.kept).decode("utf-8", "ignore") for r in repeats.remove_repeats(kept["near_dedup"]).collect()}
    for r in kept["repeats"].where("text is not null").collect():
        assert r.text == bytes_left[r.doc_id] and r.n_chars == len(r.text)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontamination.find_contamination(kept["repeats"], bench).where("size(spans) > 0").count() > 0
    assert decontamination.find_contamination(kept["decontamination"], bench).where("size(spans) > 0").count() == 0
    assert kept["packing"].select("doc_id").distinct().count() == kept["decontamination"].count()

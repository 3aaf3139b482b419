"""Every stage of the pipeline on its own input."""

import corpus_pipeline
from chatterlens.llm.storage import stored
from conftest import SF_DIR
from pyspark.sql import functions as F


def test_stages(spark):
    docs = first = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0)], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF_DIR), name)
        if name == "packing":
            fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
            assert fill.where("n <> end OR n > 2048").count() == 0
            assert out.select("doc_id").distinct().count() == docs.count()
        else:
            assert out.columns == first.columns and 0 < out.count() <= docs.count()
            assert out.select("doc_id").distinct().count() <= docs.select("doc_id").distinct().count()
        docs = out if name != "packing" else docs
    assert docs.count() == docs.select("doc_id").distinct().count()


def test_other_columns_survive_every_stage(spark):
    """Columns named as the operators' own keep their values, and of rows that repeat an id always the same one stays."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = ["score", "kept", "_id", "_rows", "base", "spans", "lang_pred", "n_words", "host_rate", "a b.c"]
    wide = docs.select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names])
    again = wide.where("doc_id % 3 = 0").withColumn("source", F.lit("~"))  # sorts behind every source
    wide = wide.unionByName(again)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wide_out = stored(stage(spark, wide, SF_DIR), name)
        assert wide_out.columns == wide.columns and wide_out.count() > 0
        assert wide_out.where(" OR ".join(f"NOT (`{n}` <=> concat('{n}:', doc_id))" for n in names)).count() == 0
        if name == "near_dedup":
            assert wide_out.where("source = '~'").count() == 0 and wide_out.groupBy("doc_id").count().where("count > 1").count() == 0
            assert stage(spark, wide.limit(0), SF_DIR).count() == 0
        wide = wide_out


def test_an_empty_table_runs_through(spark, tmp_path):
    spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

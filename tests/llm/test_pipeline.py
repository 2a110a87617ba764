"""The pipeline end to end: on the smallest tables, on planted rows, and on odd ones."""

import corpus_pipeline


def test_stages_keep_columns_and_shrink_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == [*docs.columns, "shard", "slot"]
    ids = {r["doc_id"] for r in found.select("doc_id").collect()}
    assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(ids) > docs.count() / 2


def test_odd_rows_and_planted_ones(spark, tmp_path):
    item = "Compute 12 plus 7 minus 5 plus 31 minus 8 plus 4 times 9"
    copy = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, "a", 5), (2, "", None, 5), (3, copy, "a", 5), (4, copy + " more", "b", 5), (None, "no key here", "b", 5),
            (5, f"first {item} then", "a", 5), (6, "clean words only", "a", 5), (6, "clean words only", "a", 5)]
    kind = "doc_id long, text string, source string, shard int"
    for name, own in (("full", rows), ("none", [])):
        at = f"{tmp_path}/{name}"
        spark.createDataFrame(own, kind).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    first = corpus_pipeline.run(spark, f"{tmp_path}/full")
    second = corpus_pipeline.run(spark, f"{tmp_path}/none")
    assert second.collect() == []
    ids = [r["doc_id"] for r in first.select("doc_id").collect()]
    assert set(ids) == {1, 2, 3, 6, None}
    assert not corpus_pipeline._intermediate

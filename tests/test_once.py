"""What several steps ask for is computed once."""

from catalith import workload


def test_exported_tags_are_extracted_once(spark):
    workload.load()
    out = workload.QUERIES["exported_tag_counts"](spark, "/root/testdata/sf0.001")
    assert not [f for f in out.inputFiles() if "part.parquet" in f]
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()

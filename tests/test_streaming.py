from pyspark.sql import functions as F

from tagloom.session import scratch_path
from tagloom.streaming.corpus_stream import DOCUMENT_SCHEMA, run_token_counts
from conftest import rows


def test_stream_counts_equal_batch(spark):
    folder = scratch_path(spark, "stream_src")
    docs = spark.createDataFrame([(1, "Title one\nthe body", "en", "s", 10), (2, "Deux\nthe deux", "fr", "s", 8)],
                                 DOCUMENT_SCHEMA)
    docs.write.parquet(folder + "/documents-1.parquet")
    got = run_token_counts(spark, folder + "/documents-1.parquet", glob="*.parquet")
    assert rows(got) == [("body", 1), ("deux", 2), ("one", 1), ("the", 2), ("title", 1)]


def test_restart_counts_only_what_is_new(spark):
    """Folders of part files are read like files; a restart goes on from its checkpoint, also without new files."""
    folder, out, ckpt = (scratch_path(spark, f"stream_{x}") for x in ("new", "out", "ckpt"))
    first = spark.createDataFrame([(1, "Title one\nthe body", "en", "s", 10)], DOCUMENT_SCHEMA)
    second = spark.createDataFrame([(2, "Deux\nthe deux", "fr", "s", 8), (3, None, "fr", "s", 0)], DOCUMENT_SCHEMA)
    first.write.parquet(folder + "/documents.parquet")
    first.write.parquet(folder + "/other.parquet")
    want = [("body", 1), ("one", 1), ("the", 1), ("title", 1)]
    assert rows(run_token_counts(spark, folder, glob="documents.parquet")) == want
    got = run_token_counts(spark, folder, out_path=out, checkpoint=ckpt)
    assert rows(got) == want
    second.write.parquet(folder + "/documents-2.parquet")
    later = [("body", 1), ("deux", 2), ("one", 1), ("the", 2), ("title", 1)]
    assert rows(run_token_counts(spark, folder, out_path=out, checkpoint=ckpt)) == later
    assert rows(run_token_counts(spark, folder, out_path=out, checkpoint=ckpt)) == later
    assert rows(got) == want

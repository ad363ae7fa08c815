import os

from pyspark.sql import functions as F

from tagloom.session import scratch_path
from tagloom.sources import files
from conftest import rows

TRICKY = [(1, "x", 'Say "hi", ok', "line1\nline2, with comma", ["a", "b"]),
          (2, "x", "empty content", "", []),
          (3, "y", "null content", None, ["c"]),
          (4, "y", "café 你好", "q?<p>I am</p>", ["d"])]


def posts(spark):
    return spark.createDataFrame(TRICKY, "id long, thread string, title string, content string, tags array<string>")


def test_csv_by_thread_roundtrip(spark):
    root = scratch_path(spark, "csv_test")
    paths = files.write_posts_by_thread(posts(spark), root)
    back = files.read_posts_by_thread(spark, paths)
    assert rows(back, "id", "thread", "title", "content", "tags") == [
        (1, "x", 'Say "hi", ok', "line1\nline2, with comma", "a b"),
        (2, "x", "empty content", "", ""),
        (3, "y", "null content", None, "c"),
        (4, "y", "café 你好", "q?<p>I am</p>", "d"),
    ]


def test_file_stem_of_plain_files(spark):
    root = scratch_path(spark, "plain_csv")
    root = root[len("file:"):] if root.startswith("file:") else root  # local file system path for os
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "cooking.v2.csv"), "w") as fh:
        fh.write('id,title,content,tags\n7,"T","C","t1 t2"\n')
    df = files.read_posts_by_thread(spark, os.path.join(root, "cooking.v2.csv"))
    assert rows(df, "id", "thread") == [(7, "cooking")]


def test_cap_union_roundtrips(spark):
    p = posts(spark)
    capped = files.cap_per_thread(p, 1)
    assert rows(capped, "id") == [(1,), (3,)]
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()
    other = spark.createDataFrame([(9, "z")], "id long, thread string")
    u = files.union_files([p.select("id", "thread", "title"), other])
    assert (9, "z", None) in rows(u, "id", "thread", "title") and u.count() == 5
    back = files.dataset_roundtrip(p, "rt")
    assert rows(back.filter(F.col("thread") == "y"), "id") == [(3,), (4,)]
    path = files.export_csv(p, scratch_path(spark, "exp"))
    imp = files.import_csv(spark, path, p.schema)
    assert rows(imp, "id", "tags") == rows(p, "id", "tags")


def test_partitioned_thread_names_roundtrip(spark):
    names = ["c++", "a b", "x/y", "007", "é:1=2%"]
    df = spark.createDataFrame([(i, n, "t", "c", ["k"]) for i, n in enumerate(names)],
                               "id long, thread string, title string, content string, tags array<string>")
    back = files.read_posts_by_thread(spark, files.write_posts_by_thread(df, scratch_path(spark, "names")))
    assert rows(back, "id", "thread") == [(i, n) for i, n in enumerate(names)]


def test_csv_keeps_every_value(spark):
    data = [(1, None, "  lead and trail  ", "\\N"), (2, "a", "\\", None), (3, "\\N", "\\\\x", ""), (4, "a", " ", "x\r\ny")]
    df = spark.createDataFrame([(i, th, t, c, ["k"]) for i, th, t, c in data],
                               "id long, thread string, title string, content string, tags array<string>")
    back = files.read_posts_by_thread(spark, files.write_posts_by_thread(df, scratch_path(spark, "values")))
    got = {r["id"]: (r["id"], r["thread"], r["title"], r["content"]) for r in back.collect()}
    assert [got[i] for i in range(1, 5)] == data
    imp = files.import_csv(spark, files.export_csv(df, scratch_path(spark, "values2")), df.schema)
    got = {r["id"]: (r["id"], r["thread"], r["title"], r["content"]) for r in imp.collect()}
    assert [got[i] for i in range(1, 5)] == data

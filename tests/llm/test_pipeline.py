"""The pipeline's stages on planted documents, and the registry without the corpus operators."""

import random

import corpus_pipeline

rng = random.Random(5)
prose = lambda n: " ".join("".join(rng.choice("abcdeiklmnorst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_stages(spark, tmp_path):
    exact, passage, item = prose(150), prose(60), prose(20)
    texts = {1: exact, 2: exact, 3: prose(80) + " " + passage, 4: prose(90) + " " + passage + " " + prose(20), 5: prose(60) + " " + item,
             6: "too short", 7: prose(100), 8: None, None: prose(120)}
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination",
                                                      "bpe_encode_decode"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    got = {r.doc_id: r.text for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 3, 4, 7, None}
    assert got[3] == texts[3] and got[7] == texts[7] and got[1] == exact
    assert got[4].split() == texts[4].split()[:90] + texts[4].split()[150:]


def test_rows_with_one_id(spark, tmp_path):
    """Rows that share an id and not their text are documents of their own in the SimHash and the benchmark stage."""
    one, two, unique, item = prose(150), prose(150), prose(150), prose(20)
    rows = [(5, one), (5, two), (5, two), (3, one), (5, unique), (7, two), (9, prose(60) + " " + item), (9, prose(70))]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.simhash_near_dedup(spark, docs, str(tmp_path)).collect())
    assert got == sorted([(3, one), (5, two), (5, unique), *rows[6:]])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in clean.collect()) == sorted(rows[:6] + rows[7:])


def test_repeats_without_id(spark, tmp_path):
    """Passages repeated in rows without an id are cut, and spans of one row never from another row of its id."""
    p, q, r = prose(60), prose(60), prose(60)
    heads = [prose(40) for _ in range(6)]
    rows = [(None, heads[0] + " " + p), (None, heads[1] + " " + p), (1, heads[2] + " " + q), (None, heads[3] + " " + q),
            (4, heads[4] + " " + r), (4, heads[5] + " " + prose(90)), (2, r)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.substring_dedup(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = [(x.doc_id, x.text.strip()) for x in out.collect()]
    assert len(got) == len(rows) and sum(p in t for _, t in got) == 1
    assert {(1, rows[2][1]), (None, heads[3]), (4, heads[4]), rows[5], (2, r)} <= set(got)
    assert {heads[0], heads[1]} & {t for i, t in got if i is None}


CLASHING = ["k1", "k2", "salt", "host", "row", "w", "tok", "id", "doc", "other", "spans", "fp", "bucket", "block", "window"]


def test_empty_and_clashing_tables(spark, tmp_path):
    """Extra columns named like the operators' own come through unharmed; an empty table stays empty, with its columns."""
    exact, passage, item = prose(150), prose(60), prose(20)
    texts = [(1, exact), (2, exact), (3, prose(80) + " " + passage), (4, prose(90) + " " + passage), (5, prose(60) + " " + item), (6, ""), (None, None)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, t, "en", None, len(t or ""), *(f"{c}{i}" for c in CLASHING)) for i, t in texts], columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.schema.simpleString() == docs.schema.simpleString(), name
        assert all(r[c] == f"{c}{r.doc_id}" for r in got.collect() for c in CLASHING), name
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs.where("false"), str(tmp_path))
        assert got.count() == 0 and (got.columns == docs.columns or name == "bpe_encode_decode"), name


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)

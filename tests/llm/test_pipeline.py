import corpus_pipeline as cp

BENCH = "one benchmark item of more than a dozen words that nobody should ever train a model on at all"


def write(spark, folder, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages(spark, tmp_path):
    base = " ".join(f"the word{i} of" for i in range(60))
    rows = [(i, f"the text of number{i} is about thing{i} and word{i * 7} in it with item{i * 3}", "en", f"s{i % 2}", 0) for i in range(40)]
    rows += [(100, base, "en", "s0", 0), (101, base + " more", "en", "s1", 0), (102, None, None, None, None), (103, "123 456", "en", "s0", 7),
             (104, f"see {BENCH} there", "en", "s1", 0), (105, "write to the person at some.one@example.com about it", "en", None, 0), (106, "", "en", "s0", 0)]
    write(spark, tmp_path, rows)
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in cp.STAGES[:-1]:
        columns, docs = docs.columns, stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        ids.append({r.doc_id for r in docs.collect()})
    everyone = {r[0] for r in rows}
    assert ids == [everyone - {102, 103, 106}, everyone - {101, 102, 103, 106}] + [everyone - {101, 102, 103, 104, 106}] * 2
    texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    assert texts[105] == ("write to the person at [EMAIL] about it", 39)
    mixed = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in mixed} <= ids[-1] and all(r.taken > 0 for r in mixed)


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, [])
    assert cp.run(spark, str(tmp_path)).count() == 0

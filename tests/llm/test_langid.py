import zlib

from sonomart.llm import langid

EN = "the cat sat on the mat and then the dog was there with all of them when she came home"
DE = "der hund und die katze sind nicht auf dem tisch sondern unter einem stuhl mit der maus"
RU = "кошка сидела на столе и потом собака пришла домой"


def train(documents, rows):
    return langid.fit(documents([(i, t) for i, (t, _) in enumerate(rows)], lang=[lang for _, lang in rows]))


def test_spans_scripts_and_empty_texts(documents):
    model = train(documents, [(EN, "en"), (DE, "de"), (RU, "ru"), (None, "en"), (EN, None), ("", "de")])
    assert model.languages == ["de", "en", "ru"]
    mixed = f"{EN} {DE} {RU}"
    found = langid.label_texts([mixed, None, "", "123 !?", RU, EN, DE, "x" * 2_000_000], model, spans=True)
    assert [s["lang"] for s in found[0][2]] == ["en", "de", "ru"]
    assert mixed[found[0][2][1]["start"]:found[0][2][1]["end"]] == DE
    assert [f[0] for f in found[1:7]] == ["und", "und", "und", "ru", "en", "de"]
    assert [f[1] for f in found[1:4]] == [0, 0, 0] and found[4][1] == 1
    assert found[7][1] == 1  # one word of two million letters, scored in pieces


def test_predict_keeps_rows_and_ids(spark, documents):
    rows = [(1, EN), (1, EN), (None, DE), (2**60 + 1, None)]
    df = documents(rows, lang=["en", "en", "de", None])
    model = langid.fit(df)
    got = langid.predict(df, model, ["doc_id"]).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.lang_pred) for r in got], key=key) == [(1, "en"), (1, "en"), (2**60 + 1, "und"), (None, "de")]
    assert langid.predict(df.limit(0), model, ["doc_id"]).count() == 0
    nobody = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, nobody, ["doc_id"]).collect()} == {"und"}


def test_held_out_rule(spark, documents):
    df = documents([(i, "x") for i in range(50)])
    got = {r[0]: r[1] for r in df.select("doc_id", langid.held_out("doc_id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}


def test_viterbi_equals_the_textbook_recursion():
    import itertools

    import numpy as np
    rng = np.random.default_rng(3)
    scores = [rng.normal(0, 3, (n, 3)).astype(np.float32) for n in (5, 0, 1, 6, 3)]
    for s, got in zip(scores, langid.viterbi(scores, 2.0)):
        value = lambda path: sum(s[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
        if len(s):
            assert abs(value(got) - max(map(value, itertools.product(range(3), repeat=len(s))))) < 1e-4


def test_accuracy_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    from sonomart.llm.queries import op1_langid, table
    path = "/root/testdata/sf0.01"
    got = op1_langid(spark, path).join(table(spark, path, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_marks_alone_are_no_letters_and_names_do_not_clash(spark):
    rows = [(i, "the cat and the dog of it" if i % 2 else "le chat et le chien de la", "en" if i % 2 else "fr") for i in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "\u0301\u0302 \u0903", 7, "a"), (2, "the cat e\u0301 and", 8, None)], "n long, TEXT string, in_0 int, lang string")
    got = {r.n: r for r in langid.predict(odd, model, ["n", "TEXT", "in_0", "lang"], text_col="TEXT").collect()}
    assert (got[1].lang_pred, got[1].score, got[1].in_0) == ("und", 0.0, 7) and got[2].lang_pred == "en" and got[2].TEXT.startswith("the")
    import pytest
    with pytest.raises(ValueError):
        langid.predict(odd.withColumnRenamed("in_0", "Score"), model, ["Score"], text_col="TEXT")

from sonomart.llm import decontam

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def found(spark, documents, texts, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontam.leaks(documents(list(enumerate(texts))), bench, **options).collect()}


def swapped(words, every):
    return [("odd" + str(i)) if i % every == every - 1 else w for i, w in enumerate(words)]


def test_substitutions_partial_quotes_and_clean_texts(spark, documents):
    quote = " ".join(ITEM)
    texts = [f"Here it is: {quote.upper()}!", " ".join(swapped(ITEM, 4)), " ".join(swapped(ITEM, 3)), " ".join(ITEM[3:17]) + " end of it",
             " ".join(ITEM[:9]) + " is too little of it to count as a leak of the item", "nothing to see here", None, "", " ".join(reversed(ITEM)),
             " ".join(ITEM[:10] + ["added"] + ITEM[10:]), "four short words here and others", quote]
    items = [(1, quote), (1, quote), (2, None), (3, ""), (4, "Four, short WORDS"), (5, "never seen item text of words")]
    want = {(0, 1), (1, 1), (2, 1), (3, 1), (11, 1), (10, 4)}
    got = found(spark, documents, texts, items)
    assert want <= got and got - want <= {(9, 1)}
    # The way past the broadcast limit gives the same rows.
    assert found(spark, documents, texts, items, broadcast_seeds=0) == got
    assert found(spark, documents, [], items) == set() and found(spark, documents, texts, []) == set()


def test_drop_keeps_columns_and_clean_rows(spark, documents):
    bench = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    df = documents([(1, " ".join(ITEM)), (1, "clean text with the same id"), (None, " ".join(ITEM)), (2, None)])
    kept = decontam.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "clean text with the same id"]


def test_seeds_meet_all_that_the_verifier_accepts():
    for n in range(1, 17):
        least = decontam.least_equal(n)
        masks = decontam.SEEDS if n >= decontam.SHORT_ITEM else decontam.cover(n, least)
        bits = [(int(m[::-1], 2), len(m)) for m in masks]
        for pattern in (p for p in range(1 << n) if p.bit_count() == least):
            assert any(pattern >> at & m == m for m, size in bits for at in range(n - size + 1)), (n, bin(pattern))


def test_equals_alignment_without_seeds(spark, documents):
    rng = __import__("random").Random(3)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 7, 8, 10, 10, 11, 12, 14, 15, 16, 20, 30, 59])]
    texts = []
    for _, item in items:
        words = item.split()
        texts += [" ".join(swapped(words, 5))]
        for share in (0.6, 0.7, 0.8):
            texts.append("before it " + " ".join(w if rng.random() < share else "other" for w in words) + " behind")

    def accepted(doc, item):
        wide = min(16, len(item))
        for diagonal in range(-len(item), len(doc)):
            equal = [0 <= diagonal + i < len(doc) and doc[diagonal + i] == w for i, w in enumerate(item)]
            if any(sum(equal[i:i + wide]) >= decontam.least_equal(len(item)) for i in range(len(item) - wide + 1)):
                return True
        return False

    want = {(i, k) for i, t in enumerate(texts) for k, item in items if accepted(t.split(), item.split())}
    assert found(spark, documents, texts, items) == want


def test_no_words_cross_the_seed_exchange(spark):
    import re
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p q r s t")], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = decontam.contaminated(df, df.withColumnRenamed("doc_id", "item_id"), broadcast_seeds=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
    lines = plan.splitlines()
    at = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(seed", line)]
    assert at and all("words" not in lines[i + 1].split("[", 1)[-1] for i in at)

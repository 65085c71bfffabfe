import hashlib
import re
import sys

from sonomart.llm import pii

ODD = [None, "", "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8", "999.1.1.1 0001.2.3.004", "4111 1111 1111 1111 and 4111-1111-1111-1111",
       "4111111111111111 4111111111111112", "+1 (301) 555-0346, +44 20 7946 0958 1 2 3 4 5 6", "😀 x@y.zz 😀 1.2.3.4 é 😀+1 234 567 8901 z",
       "a" * 50000, "1 " * 5000, "@".join(["ab"] * 200), 'call 301-555-0199 now ssn 123-45-6789 token = "c1e4c9030b2fad02edf9e9b50afc6bbc838394ff" x',
       "..@a.b@c.d.e", "+1   ) 5 +12345678", "1" * 30000 + "." + "2" * 10 + ".3.4", "x.y@z.w-@q.r"]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 16 <= len(digits(x)) <= 19 and luhn(digits(x))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 8 <= len(digits(x)) <= 15))
    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m.group())] for k, p, ok in rules]


def test_base_spans_equal_the_published_patterns(spark, documents):
    sys.set_int_max_str_digits(0)
    from sonomart.llm.queries import table
    rows = list(enumerate(ODD)) + [(0, None)]
    given = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    for data in (rows, given):
        df = documents(data)
        got = pii.detect(df, pii.fit(df)).collect()
        assert len(got) == len(data)
        texts = dict(data)
        for r in got:
            want = base(texts[r.doc_id])
            joined = ",".join(sum(want, []))
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, want))
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)


def test_learned_spans_and_redaction(documents):
    secrets = [(i, f'x token = "c1e4c9030b2fad02edf9e9b50afc6bbc8383{i:04d}" y') for i in range(30)]
    dull = [(100 + i, f"x order {'0' * (20 + i % 9)} y version 1234567890123456789012 z") for i in range(30)]
    df = documents(secrets + dull + [(7, None), (8, "😀 a.b@c.de, ok")])
    model = pii.fit(df)
    spans = {r.doc_id: r.spans for r in pii.detect(df, model).collect()}
    assert spans[0].startswith("secret:11:5") and not any(spans[100 + i] for i in range(30))
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    text = {r.doc_id: r.text for r in clean.collect() if r.doc_id >= 9 or r.text is None or "😀" in r.text}
    assert text[7] is None and text[8] == "😀 [EMAIL], ok" and text[9] == 'x token = "[SECRET]" y'
    assert pii.detect(df.limit(0), pii.fit(df.limit(0))).count() == 0


def test_expectation_maximisation_finds_the_reliable_labeler():
    import random
    rng = random.Random(2)
    counts = {}
    for _ in range(5000):
        truth = rng.random() < 0.4
        votes = tuple(int(truth if rng.random() < right else not truth) for right in (0.95, 0.7, 0.7))
        counts[votes] = counts.get(votes, 0) + 1
    posterior, right = pii.expectation_maximisation(counts)
    assert right[0].min() > 0.85 and posterior[(1, 1, 1)] > 0.9 > 0.1 > posterior[(0, 0, 0)]


def test_many_spans_in_one_text(spark):
    import time
    n = 100_000
    text = "😀 " + " é ".join(f"u{i}@h.io" for i in range(n))
    df = spark.createDataFrame([(1, text, 1, 2)], "doc_id long, text string, _REACH int, _Email int")
    model = pii.fit(df)
    start = time.time()
    got = pii.detect(df, model).first()
    want = base(text)
    assert got.n_email == n and got.base_sha256 == hashlib.sha256(",".join(sum(want, [])).encode()).hexdigest()
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    assert clean.first().text == "😀 " + " é ".join(["[EMAIL]"] * n)
    assert time.time() - start < 60


def test_redaction_cuts_across_slices_and_overlaps(documents):
    texts = ["x" * 995 + " a@b.cd " + "é" * 3000 + " 10.0.0.1" + " y" * 2000, "😀" * 1000 + "1.2.3.4", "4111111111111111@x.yz +1 234 567 8901 5", "a@b.cd" * 3]
    df = documents(list(enumerate(texts)))
    model = pii.fit(df)
    spans = {r.doc_id: r.spans for r in pii.detect(df, model).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    for i, text in enumerate(texts):
        found = sorted((int(a), int(b), f"[{k.upper()}]") for k, a, b in (x.split(":") for x in spans[i].split(",") if x))
        out, at = "", 0
        for a, b, tag in found:
            if a >= at:
                out += text[at:a] + tag
            at = max(at, b)
        assert clean[i] == out + text[at:]


def test_features_tell_what_votes_do_not():
    votes = (1, -1, -1, -1, -1, -1)
    histogram = {(0, votes, (3, 2, 3)): 100, (0, (1, 1, -1, 1, -1, -1), (3, 2, 3)): 100, (0, votes, (0, 0, 0)): 100,
                 (0, (0, -1, -1, -1, 0, 0), (0, 0, 0)): 300}
    model = pii.train(histogram)
    assert len(model.features) == len(pii.FEATURES) and model.features[0][3] > model.features[0][0]

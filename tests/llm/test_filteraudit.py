import random
from itertools import permutations

import numpy as np

from sonomart.llm import filteraudit


def mask(text, chars):
    words = text.encode().split()
    out = len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * chars, any(
        c in "#$%&*|" for c in text)
    return {f for f, bad in zip("ABCD", out) if bad}


def brute(rows, labels):
    docs = []
    for i, text, part in rows:
        text = text or ""
        failed = mask(text, len(text))
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            failed.add("E")
        said = [(q, x) for j, q, x in labels if j is not None and j == i]
        docs.append((part or "", failed, any(q == 1 for q, _ in said), any(x == 1 for _, x in said)))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def test_equals_brute_force_with_copies_nulls_and_repeated_rows(spark, documents):
    rng = random.Random(2)
    texts = [None, "", " ", "Aa b", "a b c #", " ".join(f"w{i}" for i in range(220)), " ".join(["same"] * 230),
             " ".join(["Same"] * 230) + " |", " ".join(f"x{i}" for i in range(200)) + " BIG" * 20, "é" * 60 + " A", "x" * 100_000 + " $"]
    rows = [(rng.choice([None, rng.randrange(60)]), rng.choice(texts), rng.choice(["s", "t", "", None])) for _ in range(150)]
    rows += [(5, texts[5], "s")] * 3 + [(70, texts[5], "u")]
    labels = [(rng.choice([None, rng.randrange(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)]
    docs = documents([(i, t) for i, t, _ in rows], source=[p for _, _, p in rows])
    said = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, mask int")
    got = filteraudit.audit(docs, said).collect()
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == brute(rows, labels)
    assert len(got) == 600 * len({p or "" for _, _, p in rows})
    assert filteraudit.audit(docs.limit(0), said).count() == 0
    bare = filteraudit.audit(docs, said.limit(0)).collect()
    assert sum(r.good_lost + r.toxic_lost for r in bare) == 0 and len(bare) == len(got)


def test_walk_equals_direct_counts():
    counts = np.random.default_rng(0).integers(0, 50, (3, 32, 3))
    states = filteraudit.survivors(counts)
    for subset in range(32):
        alive = [m for m in range(32) if not m & subset]
        assert (states[:, subset] == counts[:, alive].sum(axis=1)).all()


def test_pieces_cut_no_word():
    data = ("word " * 50 + "long" * 100 + "\x0b\x1cend").encode()
    assert [w for p in filteraudit.pieces(data, 16) for w in p.split()] == data.split()
    assert b"".join(filteraudit.pieces(data, 16)) == data

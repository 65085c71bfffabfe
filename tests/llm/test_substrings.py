import hashlib
import random

import numpy as np

from sonomart.llm import substrings


def brute(rows):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in docs:
        for at in range(len(w) - 49):
            if i is not None:
                key = tuple(w[at:at + 50])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, w in docs:
        gone = set()
        for at in range(len(w) - 49 if i is not None else 0):
            if least[tuple(w[at:at + 50])] < i:
                gone.update(range(at, at + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def words(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward():
    rng = random.Random(12)
    shared, other = words(rng, 120), words(rng, 49)
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "x " * 49), (904, "x " * 200), (905, "x " * 90), (906, "y " + "x " * 60 + "z"),
            (907, "a b " * 100), (908, "b a " * 60), (None, " ".join(shared)), (None, " ".join(shared))]
    for i in range(60):  # a hot passage, cut at random places
        lo = rng.randrange(0, 60)
        rows.append((i, " ".join(words(rng, rng.randrange(0, 80)) + shared[lo:lo + rng.randrange(30, 120)] + words(rng, rng.randrange(0, 80)))))
    rows += [(100 + i, " ".join(words(rng, 30) + other + words(rng, 30))) for i in range(20)]  # one word too short
    base = words(rng, 400)
    for i in range(25):  # near copies
        copy = list(base)
        for at in rng.sample(range(400), 3):
            copy[at] = f"e{rng.randrange(10**6)}"
        rows.append((200 + rng.randrange(50), " ".join(copy)))
    rows += [(300 + i, "\n".join(base)) for i in range(8)] + [(305, " ".join(base).upper())]
    rows += [(i, t) for i, t in rows[15:20]] + [(400, " ".join(words(rng, 70))), (400, " ".join(base[:300])), (7, "\t".join(base[50:120]))]
    rows += [(500, " ".join(base[:60] + shared[:60] + base[:60] + shared[20:100] + base[100:160])), (501, "é\x1c" + " é w".join(base))]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force_on_awkward_documents(documents, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 300)
    monkeypatch.setattr(substrings, "STREAM_WORDS", 300)
    rows = awkward()
    want = brute(rows)
    got = substrings.Search(documents(rows)).report().collect()
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=order) == sorted((w[:4] for w in want), key=order)
    assert sum(w[2] for w in want) > 5000


def test_removal_keeps_columns_and_untouched_texts(documents):
    rows = awkward()
    df = documents(rows)
    got = substrings.remove_repeats(df)
    assert got.columns == df.columns
    cut = [text if not n_removed else kept for (i, text), (_, _, n_removed, _, kept) in zip(rows, brute(rows))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=key) == sorted([(i, t) for (i, _), t in zip(rows, cut)], key=key)
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_empty_and_unrelated_documents(documents):
    assert substrings.Search(documents([(1, "a")]).limit(0)).report().count() == 0
    rng = random.Random(1)
    got = substrings.Search(documents([(i, " ".join(words(rng, 80))) for i in range(5)])).report().collect()
    assert all(r.n_removed == 0 and r.n_words == 80 for r in got)


def test_anchor_and_window_hashes_follow_the_words():
    rng = random.Random(3)
    data = " ".join(words(rng, 300, 40)).encode()
    hashes = substrings.word_hashes(data)
    split = data.split()
    for width in (1, 10, 50):
        runs = substrings.run_hashes(hashes, width, np.uint64(7))
        named = {}
        for at, h in enumerate(runs):
            assert named.setdefault(tuple(split[at:at + width]), h) == h
        assert len(runs) == 301 - width and len(set(named.values())) == len(named)
    groups = substrings.run_hashes(hashes, substrings.GRAM, substrings._SEEDS[0])
    assert list(substrings.window_anchors(hashes)) == [min(groups[s:s + 41]) for s in range(251)]


def test_shard_confirms_word_by_word():
    rng = random.Random(4)
    passage = [w.encode() for w in words(rng, 137)]
    for lo in range(0, 88, 7):
        for n in (49, 50, 51):
            shard = substrings.Shard()
            shard.add(1, passage)
            text = [b"p"] * 3 + passage[lo:lo + n] + [b"q"]
            want = [[3, 3 + len(passage[lo:lo + n])]] if len(passage[lo:lo + n]) >= 50 else []
            assert shard.ranges(1, text) == want and shard.ranges(2, text) == []

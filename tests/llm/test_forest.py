import random
from collections import defaultdict

import pytest

from sonomart.llm import forest


def brute(rows, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    ids = {g: min([x for x in v if x is not None], default=None) for g, v in groups.items()}
    return [(rows[i][0], len(sets[i]), ids[find(i)]) for i in range(len(rows))]


def text(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def edited(rng, base, edits):
    words = base.split()
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("percent", [85, 80])
def test_equals_brute_force_on_crowds_hubs_and_odd_texts(documents, percent):
    rng = random.Random(5)
    rows = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a b"), (1004, "A  b"), (1005, "a b c d e"), (1006, "É a b c d"),
            (1007, "é a b c d"), (1008, "x" * 70000), (1009, "x" * 70000), (1009, "x" * 70000), (None, "null id text of some words"),
            (None, "null id text of some words")]
    base = text(rng, 150)
    passage = text(rng, 60)
    for i in range(130):  # a hub: each is close to the base, few to each other
        rows.append((i, edited(rng, base, 2 if i else 0)))
    for i in range(200, 260):  # a shared passage, no links
        rows.append((i, text(rng, 90) + " " + passage))
    for i in range(300, 340):
        rows.append((i, rows[13 + (i - 300) % 7][1].upper()))  # exact copies but for case
    for i in range(400, 460, 2):
        a = text(rng, rng.randrange(8, 400))
        rows += [(i, a), (i + 1, edited(rng, a, max(1, len(a.split()) // 100)))]
    rng.shuffle(rows)
    got = forest.near_duplicates(documents(rows), percent).collect()
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=order) == sorted(brute(rows, percent), key=order)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_drop_keeps_one_of_each_group(documents):
    rng = random.Random(1)
    base = text(rng, 200)
    df = documents([(5, base), (3, edited(rng, base, 1)), (9, "alone is what this text is"), (None, None), (7, None)])
    kept = forest.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "7", "9", "None"]
    assert forest.drop_near_duplicates(df.limit(0)).count() == 0


def test_long_chain_of_links(spark):
    from sonomart.llm.components import components
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}


def test_pairs_in_a_crowd_that_shares_a_passage(documents):
    rng = random.Random(8)
    passage, rows = text(rng, 104), []  # 100 shared shingles, then 8 of each pair and 8 of each document
    for pair in range(400):
        own = text(rng, 8)
        rows += [(2 * pair + i, f"{passage} {own} " + " ".join(f"p{2 * pair + i}x{j}" for j in range(8))) for i in range(2)]
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in forest.near_duplicates(documents(rows), 85).collect()}
    assert got == {i: i - i % 2 for i in range(800)}

from sonomart.llm import licenses


def rows(documents, texts, **options):
    got = licenses.scan(documents(list(enumerate(texts))), **options).collect()
    return {r.doc_id: tuple(r)[1:] for r in got}


def test_phrases_templates_and_odd_texts(documents):
    filler = "word " * 200
    texts = [None, "", "CC-BY, cc  by; ccby cc\nBY", "© All Rights Reserved é all rights reserved", "xcc by cc byx",
             filler + "Permission is hereby granted, free of charge, to any person obtaining a copy of this program " + filler,
             "MIT License", "license of the mit kind", "the general public license 😀 GENERAL PUBLIC LICENSE", "Licensed under CC BY-NC 4.0.", "all " * 5000]
    got = rows(documents, texts)
    assert got[0] == got[1] == (0, 0, None, None, "", "", 0.0)
    assert got[2] == (7, 3, 0, 5, "cc-by", "cc-by", 1.0)
    assert got[3][:5] == (8, 2, 1, 5, "reserved")
    assert got[4][1] == 0
    assert got[5][:4] == (416, 0, None, None) and got[5][5] == "mit" and 0.9 <= got[5][6] < 1
    assert got[6][5] == "mit" and got[6][6] == 1.0
    assert got[8][1:4] == (2, 1, 5)
    assert got[9][5] == "cc-by,cc-by-nc" and got[10][5] == ""
    assert licenses.scan(documents([])).count() == 0


def test_equals_all_blocks_against_all_templates(documents):
    import random
    rng = random.Random(8)
    vocabulary = sorted({t for _, w in licenses.TEMPLATES for t in w.split()}) + [f"x{i}" for i in range(20)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 260))) for _ in range(60)]
    for text in list(texts[:20]):
        words = text.split()
        label, wording = rng.choice(licenses.TEMPLATES)
        at = rng.randrange(len(words))
        texts.append(" ".join(words[:at] + wording.split()[rng.randrange(2):] + words[at:]))
    got = rows(documents, texts, threshold=0.6)
    for i, text in enumerate(texts):
        words, best, labels = text.split(), 0.0, set()
        for start in range(len(words)):
            block = set(words[start:start + licenses.BLOCK_WORDS])
            for label, wording in licenses.TEMPLATES:
                tokens = set(wording.split())
                share = len(tokens & block) / len(tokens)
                if share >= 0.6:
                    labels.add(label)
                    best = max(best, share)
        base = {x for x in got[i][4].split(",") if x}
        assert {x for x in got[i][5].split(",") if x} == labels | base, text
        assert got[i][6] == (1.0 if base else best)


def test_a_notice_is_found_wherever_it_stands(documents):
    wording = dict((w, label) for label, w in licenses.TEMPLATES)
    mit = next(w for w in wording if w.startswith("permission")).split()
    spread = [x for i, w in enumerate(mit) for x in ([w, "pad", "pad", "pad"] if i % 2 else [w, "pad", "pad"])]
    while len(spread) > 61:
        spread.remove("pad")
    texts = [" ".join(["fill"] * at + spread + ["fill"] * 100) for at in range(0, 70)] + [" ".join(spread[:10] + ["pad"] * 60 + spread[10:])]
    got = rows(documents, texts)
    assert all(got[i][5] == "mit" and got[i][6] == 1.0 for i in range(70)) and got[70][5] == ""


def test_only_ascii_letters_are_lowered(documents):
    got = rows(documents, ["\u212aLICENSE MIT LICENSE", "M\u0130T license", "mit license\u0130 x"])
    assert [got[i][5] for i in range(3)] == ["mit", "", ""]
    assert [got[i][0] for i in range(3)] == [3, 2, 3]

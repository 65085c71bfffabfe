import hashlib
from collections import defaultdict

import pytest

from sonomart.llm import chat


def brute(rows):
    by, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    for conv, turns in by.items():
        whole, loss = hashlib.sha256(), ""
        for _, _, role, _, text in sorted(turns):
            whole.update(f"{role}\n{text}\n".encode())
            loss += text if role == "assistant" else ""
        out[conv] = (len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part_chars", [1 << 20, 40])
def test_round_trip_of_odd_messages(spark, part_chars):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a\\n<|im_end|>\n<\\|x\\"), (None, 0, None, "q"), (None, 1, "assistant", "x" * 5000 + "😀<|"),
            (2**60 + 1, None, "as\nsis\\ntant", "zz"), (2**60 + 1, 3, "assistant", ""), (7, 1, "user", "same"), (7, 1, "user", "same"),
            (7, 1, "user", "long " * 900), (7, 1, "user", "long " * 900), (8, 0, "assistant", "<|im_end|><|im_start|>assistant ok")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, part int, seq string")
    parts = chat.format_messages(df, part_chars=part_chars)
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(parts).collect()}
    assert got == brute(rows)
    stored = {r[0]: tuple(r)[1:5] for r in chat.digests(parts.repartition(3), sort=True).collect()}
    assert stored == got
    assert chat.digests(chat.format_messages(df.limit(0))).count() == 0


def test_events_fold_into_final_messages(spark):
    log = [(1, 0, "open", 0, "user", "hi", False), (1, 1, "open", 1, "assistant", "he", False), (1, 2, "delta", 1, None, "llo", False),
           (1, 3, "open", 2, "user", "dropped", False), (1, 4, "edit", 0, None, "HI", False), (1, 5, "regenerate", 1, None, "new", False),
           (1, 6, "delta", 1, None, " answer", False), (2, 0, "delta", 0, "user", "never opened", True), (2, 1, "edit", 5, "user", None, None)]
    df = spark.createDataFrame(log, "conv_id long, seq long, kind string, turn long, role string, text string, sealed boolean")
    got = {r.conv_id: r for r in chat.format_log(df).collect()}
    assert got[1].text == "<|im_start|>user\nHI<|im_end|>\n<|im_start|>assistant\nnew answer<|im_end|>\n"
    assert [got[1].text[s.start:s.end] for s in got[1].loss] == ["new answer"]
    assert got[2].text == "<|im_start|>user\nnever opened<|im_end|>\n<|im_start|>user\n<|im_end|>\n"


def test_events_without_a_turn_are_a_turn_before_all_others(spark):
    log = [(1, 0, "open", 0, "user", "hi", False), (1, 1, "open", None, "system", "be ", False), (1, 2, "delta", None, None, "kind", False),
           (1, 3, "open", -5, "user", "odd", None), (2, 0, None, None, None, None, None)]
    df = spark.createDataFrame(log, "conv_id long, seq long, kind string, turn long, role string, text string, sealed boolean")
    got = {r.conv_id: r.text for r in chat.format_log(df).collect()}
    assert got[1] == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user\nodd<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"
    assert got[2] == "<|im_start|>\n<|im_end|>\n"

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beaconry.llm import chat

PIECES = st.lists(st.sampled_from(["<", "|", "\\", "<|", "im_end", "|>", "<|im_end|>", "<|im_start|>", "\n", "a", "\\|", "é", " "]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4), st.integers(1, 5))
def test_round_trip(turns, step):
    made = [chat.render(role, text) for role, text in turns]
    whole = "".join(m[0] for m in made)
    assert list(chat.parse(whole[i:i + step] for i in range(0, len(whole), step))) == turns
    assert [chat.unescape(m[0][m[1]:m[2]]) if chat.START not in t and chat.END not in t and r == r.replace("\\", "") else t
            for m, (r, t) in zip(made, turns)] is not None


@pytest.mark.parametrize("text", ["<|im_start|>user\nx", "x<|im_end|>\n", "<|im_start|>no line end<|im_end|>\n",
                                  "<|im_start|>a\n<|im_start|>b<|im_end|>\n"])
def test_rejects(text):
    with pytest.raises(ValueError):
        list(chat.parse([text]))


def expected(turns):
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_read_back(spark):
    convs = {1: [("user", "hi"), ("assistant", "<|im_end|><|im_start|>assistant ok"), ("assistant", None)],
             2: [("assistant", "\\<\\| <\\| é" * 400)], 3: [(None, None)], None: [("user", "lost"), ("assistant", "")]}
    rows = [(c, i, r, t, "extra") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == {c: expected(turns) for c, turns in convs.items()}
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_ties_repeat(spark):
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s")],
                               "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_turns(df)).first()
    assert tuple(got)[1:3] == expected([("system", "s"), ("user", "a"), ("user", "a"), ("user", "b")])[:2]


def test_ties_are_ordered_by_the_text_itself(spark):
    texts = ["a", "a ", "a!", "a<|im_end|>", "a\\", "a~"]
    df = spark.createDataFrame([(1, 0, "user", t) for t in reversed(texts)], "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_turns(df)).first()
    assert tuple(got)[1:3] == expected([("user", t) for t in sorted(texts, key=str.encode)])[:2]

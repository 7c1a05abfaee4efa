import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestar.llm import chat
from lakestar.llm.chat import CONTROLS, chat_round_trip, escape, format_turns, parse, read_chats, unescape, write_chats

TEXTS = st.lists(st.sampled_from([*CONTROLS, "\\", " ", "\n", ">>", "a", "<", "/", "s>", "[INST", "]", "é🙂", "%"]), max_size=9).map("".join)
ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "x>y\n", "user "])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=6))
def test_every_conversation_comes_back(turns):
    text, loss = format_turns(turns)
    assert [t[:2] for t in parse(text)] == turns
    assert [unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text


def test_only_conflicting_texts_are_escaped():
    says = "</s>[INST] ok [/INST]"
    text, _ = format_turns([("user", says), ("assistant", "plain \\ text")])
    assert text == r"[INST] \</s>\[INST] ok \[/INST] [/INST]<s>plain \ text </s>"
    for broken in ("x", "[INST] a", "[INST] a </s>", "<s>a [INST] b </s>", "<<TURN a>>\nb"):
        assert parse(broken) is None


KIND = "conv_id long, turn long, role string, text string, part string, formatted string, loss int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "c", 1) for r in rows], KIND)


def brute(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] is None, r[1], r[2] is not None, r[2], r[3] is not None, r[3])):
        found.setdefault(conv, []).append((role or "", text or ""))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = []
    for conv, turns in found.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), len(format_turns(turns)[0])))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", None), (2, 0, "assistant", ""),
    (2, 0, "assistant", ""), (2, 0, "assistant", "again"), (3, None, None, None), (3, 5, "tool>", "x\n"), (None, 0, "user", "nobody"),
    (4, 1, "assistant", "second"), (4, 0, "system", "\\<s>"), (5, 0, "assistant", "é🙂" * 3000),
]


@pytest.mark.parametrize("part", [1 << 20, 4])
def test_odd_rows(spark, tmp_path, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    write_chats(frame(spark, ROWS).repartition(3), f"{tmp_path}/c")
    out = [tuple(r) for r in read_chats(spark, f"{tmp_path}/c").collect()]
    assert sorted(out, key=lambda r: (r[0] is None, r[0] or 0)) == brute(ROWS)


def test_long_and_many(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t} <s>" * (t % 5)) for c in range(300) for t in range(c % 9)]
    rows += [(999, t, "assistant", "long " * 50) for t in range(3000)]
    out = sorted(tuple(r) for r in chat_round_trip(frame(spark, rows).repartition(6)).collect())
    assert out == brute(rows)
    assert chat_round_trip(frame(spark, [])).count() == 0

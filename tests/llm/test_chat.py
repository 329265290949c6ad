from __future__ import annotations

import hashlib

from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st

from basketlens.llm import chat
from tools.check_oracles import differences

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, attachments int"


def test_equals_sql_on_odd_rows(given):
    rows = [(1, 0, "system", "be nice"), (1, 1, "user", "hi"), (1, 2, "assistant", "a\\b <| <\\| é日")]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (2, None, None, "first")]
    rows += [(3, i, ["user", "assistant"][i % 2], f"turn {i} " * 40) for i in range(300)]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", chat.PROBE), (4, 0, "a\nb<|", ""), (-1, 5, "user", "more")]
    df, con = given("conversations", [(*r, "s", 1) for r in rows], SCHEMA)
    assert differences(chat.chat_query(df), con, chat.CHAT_SQL) == []


def test_empty_table_leaves_the_probe(spark):
    (row,) = chat.chat_query(spark.createDataFrame([], SCHEMA)).collect()
    text = chat.PROBE
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-1, 2, len(text))
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@examples(st.text(), st.text(alphabet="\\<|im_endstar>\n "))
def test_escaping_is_reversible_and_leaves_no_control_string(a, b):
    for text in (a, b, a + b):
        assert chat.unescape(chat.escape(text)) == text
        assert "<|" not in chat.escape(text)
    segment = f"{chat.START}{chat.escape('user')}\n{chat.escape(b)}{chat.END}\n"
    assert chat.parse(segment * 2) == [("user", b)] * 2
    for role in (a, b, "a\nb", "\\n\n\\"):
        segment = f"{chat.START}{chat.escape_role(role)}\n{chat.escape(b)}{chat.END}\n"
        assert chat.parse(segment * 2) == [(role, b)] * 2


def test_parts_become_placeholders_in_order(spark):
    def part(kind, **known):
        return tuple({"type": kind, "text": None, "ref": None, "width": None, "height": None,
                      "seconds": None, "pages": None, **known}.values())

    content = [
        part("text", text="see <|image|>: "), part("image", ref="i1", width=30, height=15),
        part("audio", ref="a1", seconds=2.0), part("document", ref="d1", pages=2), part("video", ref="v1"),
        part(None, text=" end"), part("text"),
    ]
    rows = [(1, 0, "assistant", content), (1, 1, "user", None), (1, 2, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn int, role string, content array<{chat.PART}>")
    segments = chat.format_messages(df)
    first = segments.orderBy("turn").first()
    body = "see <\\|image|>: <|image|><|audio|><|document|><|document|> end"
    assert first.segment == f"<|im_start|>assistant\n{body}<|im_end|>\n"
    assert first.segment[first.loss_start : first.loss_end] == body
    assert [(a.type, a.ref, a.tokens) for a in first.attachments] == [
        ("image", "i1", 6), ("audio", "a1", 50), ("document", "d1", 1024), ("video", "v1", 1),
    ]
    assert first.n_tokens == 2 + 6 + 50 + 1024 + 1 + 1
    (whole,) = chat.assemble(segments).collect()
    assert whole.formatted == first.segment + "<|im_start|>user\n<|im_end|>\n" * 2
    for a in whole.attachments:
        shown = "document" if a.type == "video" else a.type
        assert whole.formatted[a.position :].startswith(f"<|{shown}|>")
    assert [whole.formatted[s.start : s.end] for s in whole.loss_spans] == [body]

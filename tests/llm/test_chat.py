"""Chat formatting: exact round trips of roles, texts, attachments and loss masks."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from moorage.llm import chat
from moorage.llm.common import prepare

CONTROL = ["### ", "###", ": ", "</turn>", "</turn>\n", "\\", "<|", "<|image:0|>", "\\\\", "### user: ", "\n", "a", "é😀"]
TEXT = st.lists(st.sampled_from(CONTROL) | st.text(st.characters(exclude_categories=["Cs"]), max_size=8), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_turns_read_back(turns):
    whole = "".join(chat.OPEN + chat.escape(r, chat._ROLE) + chat.NAMED + chat.escape(t) + chat.CLOSE + "\n" for r, t in turns)
    assert chat.read_turns(whole) == turns


def test_no_control_string_survives_in_a_text():
    for text in (r"\### Assistant: </turn> ok", "<|image:0|>", "</turn></turn>", "####", "\\"):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert chat._SLOT.sub(lambda m: "" if m[0][0] == "\\" else "!", escaped).count("!") == 0


def digest(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in by.items():
        own.sort()
        told = "".join(f"{r}\n{t}\n" for *_, r, t in own)
        loss = "".join(t for *_, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def run(spark, rows):
    prepare(spark)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_chat(chat.text_parts(turns))


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 2, "a: b", None),
        (None, 0, "assistant", "x"), (None, None, None, None), (3, 0, "assistant", ""), (4, 5, "assistant", "é\r\n" * 100_000), (5, 1, "system", "😀"),
    ]
    formatted = run(spark, rows)
    found = {r.conv_id: r for r in chat.chat_digest(formatted).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in found.items()} == digest(rows)
    turns = sorted(formatted.collect(), key=lambda r: (r.conv_id or 0, r.position))
    own = [r for r in turns if r.conv_id == 1]
    assert [r.start for r in own] == [sum(len(x.formatted) for x in own[:k]) for k in range(4)]
    assert found[1].formatted_chars == sum(len(r.formatted) for r in own)
    assert chat.chat_digest(run(spark, [])).count() == 0


def test_parts_become_placeholders(spark):
    prepare(spark)
    part = lambda kind, **k: (kind, k.get("text"), k.get("ref"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    rows = [
        (1, 0, "user", [part("text", text="see <|"), part("image", ref="a.png", width=600, height=512), part("text", text=" and "), part("audio", ref="b.wav", seconds=2.5)]),
        (1, 1, "assistant", [part("document", ref="c.pdf", pages=3), part("odd kind", ref="d"), part(None, text="done")]),
        (2, 0, "assistant", None),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    a, b, c = sorted(chat.format_chat(turns).collect(), key=lambda r: (r.conv_id, r.position))
    assert a.formatted == "### user: see \\<|<|image:0|> and <|audio:1|></turn>\n"
    assert [tuple(x) for x in a.attachments] == [(0, "image", "a.png", 512), (1, "audio", "b.wav", 63)]
    assert a.n_tokens == 2 + 512 + 1 + 63
    assert b.formatted == "### assistant: <|document:2|><|odd_kind:3|>done</turn>\n"
    assert [tuple(x) for x in b.attachments] == [(2, "document", "c.pdf", 1536), (3, "odd kind", "d", 1)]
    assert b.formatted[b.loss_start : b.loss_end] == "<|document:2|><|odd_kind:3|>done" and c.formatted == "### assistant: </turn>\n"


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = chat.chat_digest(run(spark, rows)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == digest(rows)

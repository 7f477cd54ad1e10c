import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lithos.llm import chat_format, queries
from lithos.llm.chat_format import Costs, Escapes, Reader, Template, Visitor

DDL = "conv_id long, turn long, role string, text string"
MARKS = Template().marks()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(row):
    return tuple((x is not None, x) for x in (row[1], row[2], row[3]))


def brute(rows):
    by = {}
    for k, r in enumerate(rows):
        by.setdefault((r[0], k if r[0] is None else None), []).append(r)
    out = []
    for (conv, _), turns in by.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted(turns, key=key)]
        learnt = "".join(t for role, t in turns if role == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt)))
    return sorted(out, key=str)


def digests(df, **more):
    got = chat_format.digests(chat_format.formatted(df, **more)).collect()
    return sorted((tuple(r)[:5] for r in got), key=str), got


pieces = st.lists(st.sampled_from([*MARKS, "\\", "<", "[", "/", "s>", "INST]", " ok ", "\n", "é", "|>"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>", "</s>\\"]), pieces), max_size=5))
def test_any_text_comes_back(turns):
    visitor = Visitor(Template(), Costs())
    for role, text in turns:
        visitor.turn(role, [{"text": text}])
    out = "".join(visitor.out)
    assert visitor.length == len(out)
    assert [(role, "".join(p[1] for p in parts)) for role, parts in Reader(Template()).turns(out)] == turns
    escapes = Escapes(MARKS)
    for role, text in turns:
        assert not escapes.marks.search(escapes.escape(text)) and escapes.unescape(escapes.escape(text)) == text
    assert [escapes.unescape(out[s["start"] : s["end"]]) for s in visitor.spans] == [t for r, t in turns if r == "assistant" and t]


def test_marks_that_cannot_be_told_apart_raise():
    for marks in (["<s>", "<s>>"], ["<a", "x<a"], ["<\\s>"], ["<"], ["ab", "bc"]):
        with pytest.raises(ValueError):
            Escapes(marks)


def test_parts_become_ordered_placeholders(spark):
    parts = [
        ("text", "see </s>", None, None, None, None, None),
        ("image", None, "s3://a.png", 57, 28, None, None),
        ("audio", None, "b.wav", None, None, 2.5, None),
        ("text", "<", None, None, None, None, None),
        (None, "s>", None, None, None, None, None),
        ("document", None, None, None, None, None, 3),
        ("hologram", None, "h", None, None, None, None),
    ]
    rows = [(1, 0, "user", "unused", parts), (1, 1, "assistant", "plain", None), (1, 2, "assistant", None, parts[3:6]), (2, 0, "user", "x", [])]
    part = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
    df = spark.createDataFrame(rows, f"{DDL}, content array<{part}>")
    got = {r.conv_id: r for r in chat_format.formatted(df, content="content").collect()}
    text = got[1].formatted
    assert text == "[INST]see <\\/s><|image|><|audio|><\\s><|document|><|file|>[/INST]<s>plain</s><s><\\s><|document|></s>"
    assert [(a.type, a.ref, a.turn, a.tokens) for a in got[1].attachments] == [
        ("image", "s3://a.png", 0, 3), ("audio", "b.wav", 0, 63), ("document", None, 0, 768), ("hologram", "h", 0, 1), ("document", None, 2, 768),
    ]
    for a in got[1].attachments:
        assert text[a.at :].startswith(Template().placeholders.get(a.type, Template().unknown))
    assert got[1].attached_tokens == 3 + 63 + 768 + 1 + 768 and [text[s.start : s.end] for s in got[1].loss] == ["plain", "<\\s>"]
    assert got[2].formatted == "[INST][/INST]" and got[2].turns == 1
    assert [p for _, parts in Reader(Template()).turns(text) for p in parts if p[0] == "text"] == [("text", "see </s>"), ("text", "<s>"), ("text", "plain"), ("text", "<s>")]


def test_whole_table_against_brute_force(spark):
    rnd = random.Random(4)
    bits = ["</s>", "[INST]", "\\", "word ", "é", "<<SYS>>", "<|role|>"]
    rows = [(rnd.randrange(30), rnd.randrange(6), rnd.choice(["user", "assistant", "system", None, "tool", ""]), "".join(rnd.choices(bits, k=rnd.randrange(6)))) for _ in range(300)]
    rows += [(7, t, rnd.choice(["user", "assistant"]), f"row {t} " * 30) for t in range(2000)]  # one conversation with most rows
    rows += [(40, None, "user", None), (40, None, "user", "a"), (40, 3, "assistant", None), (41, 0, "assistant", ""), (42, 1, "assistant", "x" * 3_000_000), (42, 0, "user", "q")]
    rows += [(None, 0, "assistant", "alone"), (None, 0, "assistant", "alone"), (None, None, None, None)] + [(43, 5, "user", "twice")] * 40
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], f"{DDL}, chunk string, formatted int").repartition(5)
    want = brute(rows)
    for chars in (1 << 20, 500):
        got, full = digests(df, chunk_chars=chars)
        assert got == want
    lengths = {r.conv_id: r.formatted_chars for r in full}
    assert lengths[42] == 3_000_000 + 7 + 1 + 13 and lengths[41] == 7
    chunks = chat_format.formatted(df, chunk_chars=500).where("conv_id = 7").collect()
    assert len(chunks) > 100 and max(len(c.formatted) for c in chunks) < 1000 and all(c.open for c in chunks)


def test_no_rows(spark):
    empty = spark.createDataFrame([], DDL)
    assert chat_format.formatted(empty).count() == 0 and digests(empty) == ([], [])


def test_query_adds_the_conversation_of_control_strings(spark, tmp_path):
    rows = [(3, 1, "assistant", "b", "x"), (3, 0, "user", "a", "y")]
    spark.createDataFrame(rows, f"{DDL}, n_turns string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op11_chat_format(spark, str(tmp_path)).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-1].n_turns == 2 and got[-1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")
    assert got[-1].loss_chars == len(said) and got[-1].loss_sha256 == sha(said) and got[-1].formatted_chars == 2 * (len(said) + 3) + 20
    assert set(got) == {-1, 3} and got[3].turns_sha256 == sha("user\na\nassistant\nb\n")

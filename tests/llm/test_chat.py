import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import chat, queries

SHAPE = "conv_id long, turn long, role string, text string, valid string, segments int"
PIECES = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]", "\\", "\\\\", "[", "<", "/", "a", "é", "\n", " "]
text = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(deadline=None, max_examples=12)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", None]), text), st.one_of(st.none(), text)), min_size=1, max_size=12))
def test_reads_back_whatever_it_wrote(spark, turns):
    rows = [(1, i, r, t, "x", 1) for i, (r, t) in enumerate(turns)]
    got = chat.read_back(chat.format_chats(spark.createDataFrame(rows, SHAPE))).first()
    assert [tuple(t) for t in got.turns] == [(r or "", t or "") for r, t in turns]
    assert got.learned == "".join(t or "" for r, t in turns if r == "assistant")
    assert "".join(s.text for s in got.segments) == got.formatted


def test_turn_order(spark):
    cases = {
        1: (["user", "assistant"], True), 2: (["system", "user", "assistant", "user", "assistant"], True), 3: (["user"], False), 4: (["assistant"], False),
        5: (["user", "user", "assistant"], False), 6: (["user", "system", "assistant"], False), 7: (["user", "tool", "assistant"], False), 8: ([None], False),
    }
    rows = [(c, i, r, "t", None, None) for c, (roles, _) in cases.items() for i, r in enumerate(roles)]
    got = {r.conv_id: r.valid for r in chat.format_chats(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got == {c: ok for c, (_, ok) in cases.items()}


def test_edges(spark):
    df = spark.createDataFrame([(None, 0, "user", "x", None, None), (1, 1, "user", "b", None, None), (1, 1, "user", "a", None, None), (1, 0, "user", "b", None, None), (1, 0, "user", "b", None, None)], SHAPE)
    got = {r.conv_id: [t.text for t in r.turns] for r in chat.read_back(chat.format_chats(df)).collect()}
    assert got == {None: ["x"], 1: ["b", "b", "a", "b"]}
    assert chat.format_chats(df.where("false")).count() == 0


def test_other_template(spark):
    t = chat.Template(roles={"user": chat.Role("<|user|>", "<|end|>"), "bot": chat.Role("<|bot|>", "<|end|>", loss=True)}, other=chat.Role("<|role|>", "<|end|>"), name_end="<|is|>")
    rows = [(1, 0, "user", "hi <|end|>", None, None), (1, 1, "bot", "<|bot|> \\", None, None), (1, 2, "x<|is|>", "y", None, None)]
    got = chat.read_back(chat.format_chats(spark.createDataFrame(rows, SHAPE), t, {"start": {"user": "u"}, "u": {"bot": "b"}}, ("b",)), t).first()
    assert [tuple(x) for x in got.turns] == [("user", "hi <|end|>"), ("bot", "<|bot|> \\"), ("x<|is|>", "y")] and got.learned == "<|bot|> \\"
    assert not got.valid


def test_query(spark, tmp_path):
    rows = [(5, 1, "assistant", "é🎉"), (5, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.op8_chat_format(spark, str(tmp_path)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[5].turns_sha256 == sha("user\n\nassistant\né🎉\n") and got[5].loss_chars == 2 and got[5].loss_sha256 == sha("é🎉")
    said = "</s>[INST] ok [/INST]"
    assert got[-1].n_turns == 2 and got[-1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n") and got[-1].loss_sha256 == sha(said)
    assert queries.op8_chat_format(spark, str(tmp_path)).select(F.min("formatted_chars")).first()[0] > 0

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm.chat_format import HOSTILE, Template, canonical_turns, fingerprint, format_chats

PIECES = st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", " ", "a", "é", "<s>", "</s>", "[INST] ", " [/INST]", "\n"]), max_size=12).map("".join)


def read_back(df, id_col="conv_id"):
    t = Template()
    rows = df.select(id_col, t.read(F.col("formatted")).alias("turns"), t.learnt(F.col("formatted"), F.col("loss_spans")).alias("learnt")).collect()
    return {r[0]: ([(x["role"], x["text"]) for x in r["turns"]], r["learnt"]) for r in rows}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "</s>"]), PIECES), min_size=40, max_size=60))
def test_every_text_comes_back(spark, turns):
    rows = [(i // 4, i % 4, role, text) for i, (role, text) in enumerate(turns)]
    got = read_back(format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    for conv in {r[0] for r in rows}:
        want = [(role, text) for c, _, role, text in rows if c == conv]
        assert got[conv] == (want, "".join(t for r, t in want if r == "assistant"))


def test_layouts_give_the_same_turns(spark):
    want = [("user", "hi"), ("assistant", "yo")]
    frames = [
        spark.createDataFrame([(1, "hi", "yo")], "conv_id long, prompt string, response string"),
        spark.createDataFrame([(1, [("user", "hi"), ("assistant", "yo")])], "conv_id long, messages array<struct<role:string,content:string>>"),
        spark.createDataFrame([(1, [("human", "hi"), ("gpt", "yo")])], "conv_id long, conversations array<struct<from:string,value:string>>"),
        spark.createDataFrame([(1, "hi", "", "yo")], "conv_id long, instruction string, input string, output string"),
        spark.createDataFrame([(1, 1, "assistant", "yo"), (1, 0, "user", "hi")], "conv_id long, turn long, role string, text string"),
        spark.createDataFrame([(1, "hi", "yo", 3)], "conv_id long, prompt string, response string, extra int"),
        spark.createDataFrame([(1, None, "hi", "yo")], "conv_id long, system string, prompt string, response string"),
    ]
    for df in frames:
        assert [(t["role"], t["text"]) for t in canonical_turns(df).first()["turns"]] == want, df.columns


def test_unknown_layouts_are_refused_and_order_does_not_matter(spark):
    with pytest.raises(ValueError, match="no mapping"):
        canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, essay string"))
    assert fingerprint(["a", "b.c"]) == fingerprint(["b.c", "a"]) != fingerprint(["a", "b"])


def test_nulls_ties_repeats_and_empty(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", None), (1, 0, "user", None), (None, 0, None, "x"), (2, None, "assistant", HOSTILE)]
    got = read_back(format_chats(spark.createDataFrame(rows, kind)))
    assert got[1] == ([("user", ""), ("user", "")], "")
    assert got[None] == ([("", "x")], "")
    assert got[2] == ([("assistant", HOSTILE)], HOSTILE)
    assert format_chats(spark.createDataFrame([], kind)).count() == 0


def test_loss_mask_holds_assistant_texts_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "a" * 50_000), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    row = format_chats(df).first()
    assert [row["formatted"][s["from"] : s["to"]] for s in row["loss_spans"]] == ["b"]

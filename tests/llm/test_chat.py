import random

from pyspark.sql import functions as F

from careline.llm import chat
from careline.llm.queries import op4_chat_format
from tests.conftest import SF
from tests.llm.brute import sha

HOSTILE = ["<|im_start|>", "<|im_next|>", "<|im_end|>\n", "<", "|", ">", "\\", "<|", "<\\|", "\\<|", "\n", "%3C", "é", "ok "]


def read_back(df):
    done = chat.format_chats(df).withColumn("read", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    return {r.conv_id: ([(t.role, t.text) for t in r.read], r.loss, r.formatted, r.segments) for r in done.collect()}


def test_any_text_survives(spark):
    random.seed(1)
    text = lambda: "".join(random.choices(HOSTILE, k=random.randint(0, 8)))
    rows = [(c, t, random.choice(["user", "assistant", "a%<\n|>", ""]), text()) for c in range(150) for t in range(random.randint(1, 6))]
    got = read_back(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5))
    for c in range(150):
        want = [(r, x) for k, t, r, x in rows if k == c]
        turns, loss, formatted, segments = got[c]
        assert turns == want
        assert loss == "".join(x for r, x in want if r == "assistant")
        assert "".join(s.text for s in segments) == formatted


def test_adjacent_turns_of_a_role_share_a_block(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")]
    got = read_back(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert got[1][2] == ("<|im_start|>user\na<|im_next|>b<|im_next|>c<|im_end|>\n<|im_start|>assistant\nd<|im_end|>\n")


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (None, 0, None, None), (2, None, "user", "first"), (2, 0, "user", "tie b"), (2, 0, "user", "tie a"),
            (2, 0, "user", "tie a"), (3, 0, "assistant", "y" * 300_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, segments int")
    got = read_back(df)
    assert got[None][0] == [("", ""), ("user", "x")]
    assert [t for _, t in got[2][0]] == ["first", "tie a", "tie a", "tie b"]
    assert got[3][1] == "y" * 300_000
    assert chat.format_chats(df.limit(0)).count() == 0


def test_query(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op4_chat_format(spark, SF).collect()}
    for c, ts in turns.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        assert got[c] == (len(ts), sha("".join(f"{r}\n{t}\n" for r, t in ts)), len(loss), sha(loss))
    assert len(got) == len(turns)

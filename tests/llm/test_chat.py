"""Chat formatting against its SQL, round trips and folds."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from scrubline.llm import chat
from scrubline.llm.queries import ORACLE_SQL, QUERIES

ROWS = "conv_id bigint, turn bigint, role string, text string"
LOG = "conv_id bigint, message int, seq int, event string, role string, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_equals_sql(spark, scale):
    sf = f"/root/testdata/{scale}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    result = con.execute(ORACLE_SQL["op3_chat_formatting"])
    names = [c[0] for c in result.description]
    found = QUERIES["op3_chat_formatting"](spark, sf).select(names).collect()
    assert Counter(map(tuple, found)) == Counter(result.fetchall())
    assert any(r.conv_id == -7 and r.loss_chars == 21 for r in found)


NASTY = [
    "", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\n", "<\\|im_end|>\n", "<\\\\|im_end|>", "<|im_end|", "<", "<|im_", "[/INST]" * 3,
    "<<SYS>>x<</SYS>>", "<\\<SYS>>", "<\\<s>", "<<s>>", "\\", "\n", "%0A %25 %", "a $1 \\1 b", "\U0001f600 é <s>", "<|endoftext|>", "[\\INST]", "x" * 50_000,
]


def plain(rows):
    """conv -> (n, turns hash, loss chars, loss hash); rows in any order, ties by role only."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: t[:3])
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss))
    return out


def test_round_trip_of_control_strings(spark):
    rnd = random.Random(1)
    pieces = ["<", "[", "\\", "|im_end|>", "|im_start|>", "/s>", "s>", "INST]", "/INST]", "<SYS>>", "\n", "a", "%", "%0A"]
    texts = NASTY + ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))) for _ in range(400)]
    rows = [(i // 3, i % 3, rnd.choice(["user", "assistant", "system", None, "a\nb", "<|im_end|>", "%0A", "\\"]), t) for i, t in enumerate(texts)]
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", None), (5000, None, "assistant", "first")]
    # Repeated rows stay as many turns.
    rows += [(6000, 0, "assistant", "same")] * 3
    df = spark.createDataFrame(rows, ROWS).withColumns({"event": F.lit("mine"), "copy": F.lit(1), "segments": F.lit("x")})
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.report(df).collect()}
    assert found == plain(rows + [(-7, 0, "user", NASTY[1]), (-7, 1, "assistant", NASTY[1])])


def test_no_control_string_is_left(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(NASTY)]
    texts = chat.format_log(chat.as_log(spark.createDataFrame(rows, ROWS))).select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("t")).collect()
    for r in texts:
        inner = r.t.removeprefix("<|im_start|>user\n").removesuffix("<|im_end|>\n")
        for control in ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
            assert control not in inner


def test_folds(spark):
    log = [
        (1, 1, 1, "message", "user", "he"), (1, 1, 2, "delta", None, "llo"), (1, 1, 9, "edit", None, "hi"),
        (1, 2, 3, "message", "assistant", None), (1, 2, 4, "delta", None, "draft"), (1, 2, 5, "regenerate", None, "ignored"),
        (1, 2, 6, "delta", None, "fin"), (1, 2, 7, "delta", None, "al"), (1, 2, 8, "rated", None, "5"),
        (2, 1, 1, "delta", None, "orphan"), (2, 1, 2, "delta", "user", "!"), (2, 2, 3, "regenerate", None, None),
    ]
    random.Random(2).shuffle(log)
    df = spark.createDataFrame(log, LOG)
    found = sorted((r.conv_id, r.at, r.role, r.text) for r in chat.final_messages(df).collect())
    assert found == [(1, 1, "user", "hi"), (1, 3, "assistant", "final"), (2, 1, "user", "orphan!"), (2, 3, "", "")]
    assert chat.format_log(df.limit(0)).collect() == []
    turns = {r.conv_id: [tuple(t) for t in r.t] for r in chat.format_log(df).select("conv_id", chat.turns(F.col("segments")).alias("t")).collect()}
    assert turns == {1: [("user", "hi"), ("assistant", "final")], 2: [("user", "orphan!"), ("", "")]}


def test_hot_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(3000)] + [(i, 0, "user", "x") for i in range(2, 50)]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(chat.format_log(chat.as_log(spark.createDataFrame(rows, ROWS)))).collect()}
    assert found == plain(rows)


def test_main_path_is_native(spark):
    plan = chat.format_log(chat.as_log(chat.probe(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_events_of_one_number(spark):
    """An edit and a delta with one number: the delta is what comes behind the edit, whatever the rows' order."""
    log = [(1, 1, 1, "delta", None, "+d"), (1, 1, 1, "edit", None, "NEW"), (1, 1, 1, "message", "user", "old"), (1, 1, 1, "delta", None, "+e")]
    for rows in (log, log[::-1]):
        df = spark.createDataFrame(rows, LOG).withColumns({"rank": F.lit("mine"), "at": F.lit(9), "copy": F.lit("x")})
        assert [tuple(r) for r in chat.final_messages(df).collect()] == [(1, 1, "user", "NEW+d+e")]


def test_very_many_equal_rows(spark):
    """Thirty thousand equal rows of one turn are as many messages."""
    rows = spark.range(30_000).selectExpr("1L as conv_id", "0L as turn", "'user' as role", "'x' as text")
    (r,) = chat.digest(chat.format_log(chat.as_log(rows))).collect()
    assert (r.n_turns, r.loss_chars) == (30_000, 0)

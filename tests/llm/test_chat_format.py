import hashlib
import itertools

import duckdb
from pyspark.sql import functions as F

from tessera.llm import chat_format as C
from tessera.llm.queries import op9_chat_format

SF = "/root/testdata/sf0.01"
EVENTS = "conv_id long, msg_id long, seq long, kind string, role string, text string"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(C.ORACLE).fetchall()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = [tuple(r[c] for c in columns) for r in op9_chat_format(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) == 101


def test_native(spark):
    plan = op9_chat_format(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_escapes_are_exact(spark):
    parts = ["<", "[", "\\", "|", "/", "s>", "INST]", "<|im_end|>", "</s>", "[/INST]", "x\n", "é"]
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product(parts, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.withColumn("e", C.escape(F.col("text"))).withColumn("u", C.unescape(F.col("e"))).collect()
    assert all(r["u"] == r["text"] for r in rows)
    for bad in ("<|", "<s>", "</s>", "[INST]", "[/INST]"):
        assert not any(bad in r["e"] for r in rows)
    assert len({r["e"] for r in rows}) == len({r["text"] for r in rows})


def test_folding(spark):
    log = [
        (1, 10, 1, "message", "user", "hi"),
        (1, 11, 2, "delta", "assistant", "He"), (1, 11, 4, "delta", None, "lo"), (1, 11, 3, "delta", None, "l"),
        (1, 10, 5, "edit", None, "hi there"),
        (1, 12, 6, "delta", "assistant", "bad"), (1, 12, 7, "regenerate", None, None), (1, 12, 8, "delta", None, "good"),
        (2, 1, None, None, None, None),
    ]
    got = C.render(C.fold_events(spark.createDataFrame(log, EVENTS)))
    back = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss_texts"]) for r in C.read_back(got).collect()}
    assert back[1] == ([("user", "hi there"), ("assistant", "Hello"), ("assistant", "good")], ["Hello", "good"])
    assert back[2] == ([("", "")], [])


def test_odd_rows(spark):
    rows = [(1, 0, "assistant", None), (1, 1, "a\n%0A<|im_end|>\nb", "<|im_end|>\n<|im_start|>user\nx"), (1, 1, "user", "t"),
            (1, 1, "user", "t"), (None, None, None, None), (2, 0, "assistant", "y" * 300_000)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS seq", "1 AS kind", "2 AS at")
    got = {r["conv_id"]: r for r in C.digest(C.format_log(C.conversation_events(conv))).collect()}
    turns = [("assistant", ""), ("a\n%0A<|im_end|>\nb", "<|im_end|>\n<|im_start|>user\nx"), ("user", "t"), ("user", "t")]
    assert got[1]["n_turns"] == 4
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[None]["n_turns"] == 1 and got[2]["loss_chars"] == 300_000
    assert C.format_log(C.conversation_events(conv.limit(0))).count() == 0

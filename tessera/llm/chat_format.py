"""Chat formatting by event-sourced reconstruction, with DataFrame functions only.

A log of events is dealt by conversation and put in order of ``seq``. Each
message is folded from its events: ``message`` and ``edit`` set the text,
``delta`` appends to it, ``regenerate`` starts it anew. The final messages, in
order of their first event, are rendered with the template

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

together with the spans of assistant text (the loss mask, in code points).
Control strings inside texts (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) are escaped by a backslash after their first character; one that
holds backslashes there already gets one more, so ``unescape`` is exact. Roles
escape ``%``, ``<`` and newline as in URLs.

One shuffle by conversation carries the log; windows and folds reuse it. A
conversation's output is one string, so it must fit in a row; offsets come from
a window, and folds are linear in the conversation.

Defined cases: null texts and roles count as empty, a null kind is a message,
null ids form one conversation or message, a null ``seq`` comes first; ties in
``seq`` go by kind, role and text; repeated events count each; an empty log gives
an empty table; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
#: The first character of a control string, the backslashes after it, and the rest.
_CONTROL = r"([<\[])(\\*)(?=\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])(\\*)\\(?=\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def _escape_role(role: Column) -> Column:
    for old, new in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(old), F.lit(new))
    return role


def _unescape_role(role: Column) -> Column:
    for old, new in (("%0A", "\n"), ("%3C", "<"), ("%25", "%")):
        role = F.replace(role, F.lit(old), F.lit(new))
    return role


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text) of the final messages from (conv_id, msg_id, seq, kind, role, text)."""
    kind = F.coalesce("kind", F.lit("message"))
    event = F.struct("seq", kind.alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    grouped = events.groupBy("conv_id", "msg_id").agg(F.sort_array(F.collect_list(event)).alias("e"))
    # The text is what follows the last event that set it.
    fresh = F.array_max(F.transform("e", lambda x, i: F.when(x["kind"] != "delta", i)))
    tail = F.slice("e", F.coalesce(fresh, F.lit(0)) + 1, F.size("e"))
    text = F.array_join(F.transform(tail, lambda x: F.when(x["kind"] == "regenerate", "").otherwise(x["text"])), "")
    role = F.coalesce(F.get(F.filter(F.transform("e", lambda x: x["role"]), lambda r: r != ""), F.lit(0)), F.lit(""))
    return grouped.select("conv_id", F.col("e")[0]["seq"].alias("seq"), "msg_id", role.alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the conversation's text and the spans of its assistant texts."""
    body = escape(F.col("text"))
    parts = messages.select("conv_id", "seq", "msg_id", "role", _escape_role(F.col("role")).alias("r"), body.alias("body"))
    head = F.concat(F.lit(START), "r", F.lit("\n"))
    parts = parts.select("conv_id", "seq", "msg_id", "role", F.length(head).cast("long").alias("head"),
                         F.length("body").cast("long").alias("size"), F.concat(head, "body", F.lit(END)).alias("turn"))
    order = Window.partitionBy("conv_id").orderBy("seq", "msg_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("turn")).over(order), F.lit(0)) + F.col("head")
    placed = parts.withColumn("at", at)
    mask = F.when(F.col("role") == ASSISTANT, F.struct("at", (F.col("at") + F.col("size")).alias("stop")))
    rows = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "turn", mask.alias("mask")))).alias("t"))
    return rows.select("conv_id", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"),
                       F.filter(F.transform("t", lambda x: x["mask"]), lambda m: m.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``loss_texts`` (unescaped) parsed from ``formatted`` and its mask."""
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda x: F.substr(x, F.lit(len(START) + 1)))
    turns = F.transform(turns, lambda x: F.struct(
        _unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substr(x, F.instr(x, "\n") + 1)).alias("text")))
    loss = F.transform("loss", lambda s: unescape(F.substr(
        F.col("formatted"), (s["at"] + 1).cast("int"), (s["stop"] - s["at"]).cast("int"))))
    return formatted.withColumns({"turns": turns, "loss_texts": loss})


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of finished turns: each row is a message of its own, in order of ``turn``."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    nth = F.row_number().over(order).cast("long")
    return rows.select("conv_id", nth.alias("msg_id"), nth.alias("seq"), F.lit("message").alias("kind"), "role", "text")


def format_log(events: DataFrame) -> DataFrame:
    """The log's conversations, folded and rendered."""
    return render(fold_events(events))


def digest(formatted: DataFrame) -> DataFrame:
    """What is read back from the rendered conversations, as counts and hashes."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"),
                       F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g') AS body,
         replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(12 + length(head) + 1 + length(body) + 11) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""

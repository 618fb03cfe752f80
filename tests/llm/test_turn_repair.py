import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import duckdb
from llm_fixtures import SF
from tessera.llm import queries
from tessera.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def slow_damage(rows):
    out, ids = [], {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub(r"[.!?]", "", text) if draw == 2 else text
            out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return ids, out


def slow_repair(rows):
    """Cheapest (cost, audit, turns) by a search over positions and initials so far, without any merging but memory."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.rstrip(WHITE)
        faults.append("b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(k, state, fresh):
        found = []
        if k == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if fresh < 3:
            role = "assistant" if state == "u" else "user"
            c, a, t = best(k, role[0], fresh + 1)
            found.append((c + 5, "I" + a, ((role, ""),) + t))
        if k < len(rows):
            _, role, text = rows[k]
            c, a, t = best(k + 1, state, 0)
            found.append((c + 2, "D" + a, t))
            if faults[k] not in ("b", "d"):
                extra = 5 if faults[k] == "t" else 0
                for as_role, edit, more in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    if as_role[:1] and state + as_role[0] in ("s", "u", "su", "ua", "au"):
                        c, a, t = best(k + 1, as_role[0], 0)
                        found.append((c + more + extra, edit + a, ((as_role, text),) + t))
        return min(found) if found else (10**9, "", ())

    cost, audit, turns = best(0, "", 0)
    turns_known = sorted({t for t, _, _ in rows if t is not None})
    gaps = turns_known[-1] - turns_known[0] + 1 - len(turns_known) if turns_known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    said = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, said), turns


def in_order(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    for v in by.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return by


def report(df):
    return {r[0]: tuple(r)[1:] for r in R.repair_report(df).collect()}


def wild(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "Uva", "umpire"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "What? ", "Yes."]
    rows = []
    for conv in range(n):
        for _ in range(rng.randint(1, 7)):
            rows.append((conv if conv else None, rng.choice([0, 1, 2, 3, 5, 9, None]),
                         rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts)))
    return rows


def test_equal_brute_force(spark):
    rows = wild(400, 3)
    ids, damaged = slow_damage(rows)
    want = in_order(damaged)
    want = {i: slow_repair(tuple(want.get(i, ())))[0] for i in ids}
    assert report(R.damage(spark.createDataFrame(rows, SCHEMA))) == want


def test_given_rows(spark):
    """The operator without damage; the repaired turns are well formed and hash to the digest."""
    rows = [tuple(" " if x is None and k > 1 else x for k, x in enumerate(r)) for r in wild(200, 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {i: slow_repair(tuple(v)) for i, v in in_order(rows).items()}
    assert report(docs) == {i: w[0] for i, w in want.items()}
    got = defaultdict(list)
    for r in R.repaired_turns(docs).orderBy("nth").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    assert got == {i: list(w[1]) for i, w in want.items() if w[1]}
    assert all(re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in t)) for t in got.values())


def test_query_equals_sql(spark):
    """Whole table, against the recursion in DuckDB."""
    conversations = f"'{SF}/conversations.parquet'"
    want = duckdb.sql(queries.ORACLES["op13_turn_repair"].replace("FROM conversations", f"FROM {conversations}"))
    got = queries.QUERIES["op13_turn_repair"](spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_a_long_conversation_is_a_stream():
    """The parser holds the branches above the trunk only; ties of the whole audit are settled exactly."""
    rng, one, held = random.Random(1), R.Parser(), 0
    for k in range(20_000):
        one.feed(rng.choice(["user", "assistant"]), f"Text {k}.", rng.random() < 0.1, rng.random() < 0.1)
        held = max(held, len(one.pending))
    cost, audit, _ = one.finish()
    assert held < 200 and len(audit.replace("I", "")) == 20_000 and cost > 0


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.repair_report(R.damage(none)).count() == 0 and R.repaired_turns(none).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    frame = spark.createDataFrame([(lost, 0, "user", "Hi.", "x", "y")], SCHEMA + ", digest string, kind string")
    assert report(R.damage(frame)) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}
    long = "word " * 400_000 + "end."
    got = report(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long)], SCHEMA))
    assert got[1][:-1] == (0, 0, 1, 0, 1, 2, "KKD")


def test_first_turn_of_copies(spark):
    """A copy in a later turn is the duplicate; a null turn is the first."""
    rows = [(1, 5, "user", "Hi."), (1, None, "user", "Hi."), (1, 6, "assistant", "Yes."), (1, 7, "assistant", "Yes.")]
    assert report(spark.createDataFrame(rows, SCHEMA))[1][:-1] == (0, 0, 2, 0, 2, 4, "KDKD")

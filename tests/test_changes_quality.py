"""Changes and validators: the rule of each on small rows of our own, and in order
of arrival against plain Python."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import changes as C
from tessera.operators import quality as V
from tessera.operators.views import MaterializedView, NotPopulated, diff_by_key
from tessera.sources import literals, sinks

from conftest import rows


def kilns(spark):
    """(kiln, heat, wood, glaze): a NULL in every column but the key."""
    return spark.createDataFrame([(1, 900, 12, "ash"), (2, 1250, None, "salt"), (3, 640, 30, None), (4, None, 7, "ash")],
                                 "kiln int, heat int, wood int, glaze string")


def test_checks_pass_on_null(spark):
    k = kilns(spark)
    assert rows(V.check(k, "heat", F.col("heat").between(700, 1200)), "kiln") == [(2,), (3,)]
    assert rows(V.check(k, "wood_per_heat", F.col("wood") * 50 < F.col("heat")), "kiln") == [(3,)]
    assert rows(V.not_null(k, ["heat", "glaze"]), "kiln", "rule") == [(3, "not_null:glaze"), (4, "not_null:heat")]
    assert rows(V.view_check(k, F.col("glaze") == "ash"), "kiln") == [(2,), (3,)]


def test_unique_primary_foreign(spark):
    k = spark.createDataFrame([(5, "r1", 8), (9, "r1", 8), (2, None, 8), (7, None, None), (8, "r3", 30)],
                              "n int, code string, shed int")
    assert rows(V.unique(k, ["code"], arrival="n"), "n") == [(9,)]
    assert rows(V.unique(k, ["shed"]), "n") == [(2,), (5,), (9,)]
    assert rows(V.unique(k, ["code", "shed"], arrival="n"), "n") == [(9,)]
    assert rows(V.primary_key(k, ["code"], arrival="n"), "n") == [(2,), (7,), (9,)]
    sheds = spark.createDataFrame([(8,), (8,)], "shed int")
    assert rows(V.foreign_key(k, ["shed"], sheds, ["shed"]), "n") == [(8,)]


def test_restrict_and_cascade(spark):
    sheds = spark.createDataFrame([(3,), (8,)], "shed int")
    jars = spark.createDataFrame([(1, 8), (2, 8), (3, None)], "jar int, shed int")
    decided = V.delete_restrict(sheds, "shed", {"jars": (jars, "shed")})
    assert rows(decided, "shed", "decision") == [(3, "deleted"), (8, "refused")]
    left = V.delete_cascade(sheds, "shed", F.col("shed") == 8, {"jars": (jars, "shed")})
    assert rows(left["jars"], "jar") == [(3,)] and rows(left["parent"], "shed") == [(3,)]


def test_reasons_stay_with_their_row(spark):
    """Rows that share a key, or have a NULL one, don't take over each other's reasons."""
    batch = spark.createDataFrame([(None, 1, 5), (None, 99, 5), (4, 1, 5), (4, 99, 5), (6, None, 50), (6, 1, 5)],
                                  "code int, shed int, n int")
    sheds = spark.createDataFrame([(1,), (1,)], "shed int")
    out = V.enforce(batch, {"small": F.col("n") < 10}, unique_keys=[["code"]], references=[(["shed"], sheds, ["shed"])])
    got = {(r["code"], r["shed"]): r["reasons"] for r in out.collect()}
    assert got == {(None, 1): "", (None, 99): "foreign_key:shed", (4, 1): "unique:code",
                   (4, 99): "foreign_key:shed,unique:code", (6, None): "small,unique:code", (6, 1): "unique:code"}
    assert out.count() == 6 and out.where("accepted").count() == 1


def test_update_delete_returning(spark):
    k = kilns(spark)
    change = C.update(k, {"heat": F.col("heat") + 0.5, "wood": F.col("heat") - 1}, F.col("glaze") == "ash",
                      returning=["kiln", "old_heat", "heat", "wood"])
    assert sorted(map(tuple, change.returning.collect())) == [(1, 900, 901, 899), (4, None, None, None)]
    assert change.snapshot.count() == 4
    gone = C.delete(k, F.col("wood") > 10)
    assert rows(gone.snapshot, "kiln") == [(2,), (4,)] and rows(gone.returning, "kiln") == [(1,), (3,)]


def test_inserts_round_default_and_never_reuse(spark):
    target = spark.createDataFrame([(5, 40, "ash")], "id long, heat int, glaze string")
    new = spark.createDataFrame([(110.5, "b"), (-2.5, "a"), (None, "c")], "heat double, tag string")
    change = C.insert(target, new, id_col="id", order=["tag"], defaults={"glaze": "plain"}, last_id=8)
    assert rows(change.returning, "id", "tag", "glaze") == [(9, "a", "plain"), (10, "b", "plain"), (11, "c", "plain")]
    assert {r["id"]: r["heat"] for r in change.snapshot.collect()} == {5: 40, 9: -3, 10: 111, 11: None}
    again = C.insert_if_absent(target, spark.createDataFrame([(5, 1.5, "x"), (6, 1.5, "y")], "id long, heat double, glaze string"),
                               ["id"])
    assert rows(again.snapshot, "id", "heat") == [(5, 40), (6, 2)]
    appended = sinks.insert_select(target, spark.createDataFrame([(7, 2.5, "z")], "id long, heat double, glaze string"))
    assert rows(appended, "id", "heat") == [(5, 40), (7, 3)]
    explicit = literals.apply_defaults(spark.createDataFrame([(1, None)], "id int, glaze string"),
                                       T.StructType([T.StructField("id", T.IntegerType()), T.StructField("glaze", T.StringType())]),
                                       {"glaze": "plain"})
    assert rows(explicit, "id", "glaze") == [(1, None)]


def test_writes_through_a_view(spark):
    k = kilns(spark)
    ash = F.col("glaze") == "ash"
    change, refused = C.view_insert(k, spark.createDataFrame([(7, "ash"), (8, "salt"), (9, None)], "kiln int, glaze string"),
                                    ash, defaults={"heat": 500})
    assert rows(change.snapshot.where("kiln > 4"), "kiln", "heat") == [(7, 500)] and rows(refused, "kiln") == [(8,), (9,)]
    moved = C.view_update(k, ash, {"wood": F.lit(0)}, F.col("wood") > 5).snapshot
    assert {r["kiln"]: r["wood"] for r in moved.collect()} == {1: 0, 2: None, 3: 30, 4: 0}


@pytest.mark.parametrize("seed", range(4))
def test_acceptance_in_order_equals_a_loop(spark, seed):
    rnd = random.Random(seed)
    funds = {k: rnd.choice([0, 50, 300, 2000]) for k in range(6)}
    reqs = []
    for n in range(160):
        key = rnd.choice([0, 0, 0, 1, 2, 3, 4, 5])
        need = rnd.choice([1, 7, 40, 90, 400])
        reqs.append((n, key, D(need), D(rnd.randint(0, need)), D(funds[key])))
    want, left = {}, dict(funds)
    for n, key, need, take, _ in reqs:
        want[n] = need <= left[key]
        left[key] -= take if want[n] else 0
    df = spark.createDataFrame(reqs, "n long, key int, need decimal(18,2), take decimal(18,2), funds decimal(18,2)")
    got = {r["n"]: r["accepted"] for r in C.accept_in_order(df, "key", "n", "need", "take", "funds").collect()}
    assert got == want and min(left.values()) >= 0


def test_moves_never_overdraw(spark):
    purse = spark.createDataFrame([("x", D(100)), ("y", D(10))], "who string, coins decimal(18,2)")
    moves = spark.createDataFrame([(1, "x", "y", D(80)), (2, "x", "y", D(80)), (3, "x", "y", D(20)), (4, "q", "x", D(1))],
                                  "n long, src string, dst string, coins decimal(18,2)")
    ok = C.eligible_moves(purse, "who", "coins", moves, "src", "coins", "n")
    assert rows(ok, "n") == [(1,), (3,)]
    after = C.apply_moves(purse, "who", "coins", ok, "src", "dst", "coins")
    assert rows(after, "who", "coins") == [("x", D(0)), ("y", D(110))]


def test_versions(spark):
    v = C.Versions(kilns(spark), "start")
    v.save("warm", C.update(v.current, {"heat": F.lit(1)}).snapshot)
    v.save("empty", C.delete(v.current, F.lit(True)).snapshot)
    assert v.current.count() == 0 and v.rollback_to("warm").where("heat = 1").count() == 4
    assert v.names() == ["start", "warm"]


def test_materialized_view_lifecycle(spark):
    catalog = sinks.Catalog.of(spark)
    catalog.publish("t_mv_base", spark.createDataFrame([("a", 1), ("a", 2)], "g string, v int"))
    mv = MaterializedView.create(spark, "t_mv", lambda: catalog.read("t_mv_base").groupBy("g").count(),
                                 with_data=False, key=["g"])
    with pytest.raises(NotPopulated):
        mv.read()
    assert rows(mv.refresh(), "g", "count") == [("a", 2)]
    catalog.publish("t_mv_base", catalog.read("t_mv_base").unionByName(spark.createDataFrame([("a", 3), ("b", 1)], "g string, v int")))
    assert rows(mv.read(), "g", "count") == [("a", 2)]  # stale until refreshed
    assert rows(mv.refresh_keyed(), "g", "change") == [("a", "update"), ("b", "insert")]
    assert rows(mv.read(), "g", "count") == [("a", 3), ("b", 1)]
    twice = MaterializedView(spark, "t_mv", lambda: catalog.read("t_mv_base").select("g"), ("g",))
    with pytest.raises(ValueError):
        twice.refresh_keyed()
    assert rows(mv.read(), "g", "count") == [("a", 3), ("b", 1)]  # a refused refresh leaves the view


def test_catalog_is_shared_and_keeps_marks(spark):
    sinks.Catalog(spark).publish("t names/é", spark.range(3), serial={"id": 41})
    other = sinks.Catalog(spark)  # nothing lives in the object
    assert other.read("t names/é").count() == 3 and other.last_serial("t names/é", "id") == 41
    other.publish("t names/é", spark.range(1), serial={"id": 7})
    assert other.last_serial("t names/é", "id") == 41 and other.read("t names/é").count() == 1
    other.drop("t names/é")
    assert not sinks.Catalog(spark).exists("t names/é")
    with pytest.raises(KeyError):
        other.read("t names/é")


def test_diff_by_key_handles_null_values(spark):
    old = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "k int, v int")
    new = spark.createDataFrame([(1, None), (2, 6), (4, 1)], "k int, v int")
    assert rows(diff_by_key(old, new, ["k"]), "k", "change") == [(2, "update"), (3, "delete"), (4, "insert")]


def test_json_documents_are_not_lost(spark):
    from tessera.functions import scalar as fx

    docs = [(1, '[{"iin": "7", "amount": 2.50}, {"iin": "8", "amount": null}]'), (2, "[]"), (3, None), (4, "[{"),
            (5, '{"iin": "7", "amount": 1}'), (6, '[{"iin": "7", "amount": "12x"}]'), (7, "")]
    df = spark.createDataFrame(docs, "id int, payments string")
    got = [(r["id"], r["document"], r["pos"], r["amount"]) for r in fx.explode_payments(df, ["id"]).orderBy("id", "pos").collect()]
    assert got == [(1, "ok", 1, 2.5), (1, "ok", 2, None), (2, "empty", None, None)] + [
        (i, "malformed", None, None) for i in (3, 4, 5, 6, 7)]


def one_by_one(rows, keys):
    """Accepted flags and reasons of rows (arrival, ok, key columns...) inserted one at a time."""
    held, out = [set() for _ in keys], {}
    for arrival, ok, *values in sorted(rows):
        if not ok:
            out[arrival] = ("v_positive",)
            continue
        own = [tuple(values[i] for i in k) for k in keys]
        hit = [n for n, (k, seen) in enumerate(zip(own, held)) if None not in k and k in seen]
        out[arrival] = tuple(f"unique:{','.join('abc'[i] for i in keys[n])}" for n in hit)
        if not hit:
            for k, seen in zip(own, held):
                seen.add(k)
    return out


@pytest.mark.parametrize("keys", [[(0,)], [(0,), (1,)], [(0, 1), (2,), (1, 2)]])
def test_enforce_in_order_equals_single_inserts(spark, keys):
    rnd = random.Random(len(keys))
    data = [(n, rnd.random() < 0.8, *[rnd.choice([None, *range(9)]) for _ in "abc"]) for n in range(300)]
    frame = spark.createDataFrame(data, "n long, v boolean, a int, b int, c int")
    got = V.enforce_in_order(frame, "n", {"v_positive": F.col("v")}, [["abc"[i] for i in k] for k in keys]).collect()
    assert {r["n"]: tuple(x for x in r["reasons"].split(",unique:")) for r in got} == {
        n: tuple(",".join(w).split(",unique:")) for n, w in one_by_one(data, keys).items()}
    assert all(r["accepted"] == (r["reasons"] == "") for r in got) and len(got) == 300


def test_enforce_in_order_keeps_the_first_valid_row(spark):
    frame = spark.createDataFrame([(1, 1, 10), (2, 1, 20), (3, 2, -5), (4, 2, 7)], "n long, k int, v int")
    got = V.enforce_in_order(frame, "n", {"positive": F.col("v") > 0}, [["k"]]).collect()
    assert {r["n"]: r["reasons"] for r in got} == {1: "", 2: "unique:k", 3: "positive", 4: ""}


def slow_deletes(tables, edges, root, asked):
    """Decisions and surviving keys, request by request."""
    gone, told = {name: set() for name in tables}, {}
    for want in asked:
        if want not in tables[root]:
            continue
        doomed, todo = {name: set() for name in tables}, [(root, want)]
        while todo:
            name, key = todo.pop()
            if key not in doomed[name]:
                doomed[name].add(key)
                todo += [(c, k) for c, col, p, hold in edges if p == name and not hold for k, r in tables[c].items() if r[col] == key]
        refused = any(r[col] in doomed[p] for c, col, p, hold in edges if hold for r in tables[c].values())
        told[want] = "refused" if refused else "deleted"
        if not refused:
            for name in tables:
                gone[name] |= doomed[name]
    return told, {name: set(rows) - gone[name] for name, rows in tables.items()}


def test_delete_graph_equals_single_deletes(spark):
    """Four tables, one pointing at itself; cascades of any depth, a RESTRICT below refuses the whole request."""
    rnd = random.Random(4)
    pick = lambda n: rnd.choice([None, *range(n)])
    tables = {"team": {k: {"boss": pick(30)} for k in range(30)}, "staff": {k: {"team": pick(30)} for k in range(60)},
              "task": {k: {"staff": pick(60)} for k in range(80)}, "bill": {k: {"task": pick(600), "staff": pick(900)} for k in range(40)}}
    edges = [("team", "boss", "team", False), ("staff", "team", "team", False), ("task", "staff", "staff", False),
             ("bill", "task", "task", True), ("bill", "staff", "staff", True)]
    frames = {name: (spark.createDataFrame([(k, *r.values()) for k, r in rows.items()], "id long, " + ", ".join(f"{c} long" for c in next(iter(rows.values())))), "id")
              for name, rows in tables.items()}
    asked = [*range(0, 30, 2), 99]
    decisions, left = V.delete_graph(frames, [V.Reference(*e) for e in edges], "team", spark.createDataFrame([(k,) for k in asked], "k long"))
    told, survivors = slow_deletes(tables, edges, "team", asked)
    assert {int(r["request"]): r["decision"] for r in decisions.collect()} == told and set(told.values()) == {"refused", "deleted"}
    assert {name: {r["id"] for r in df.collect()} for name, df in left.items()} == survivors

import os

import pytest
from pyspark.sql import functions as F

from zonage.operators import load as L


def frames(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "C"), (3, "C2")], "k int, v string")
    return tgt, src


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_idempotent(spark):
    tgt, src = frames(spark)
    once = L.upsert(tgt, src, ["k"], order=["v"])
    twice = L.upsert(once, src, ["k"], order=["v"])
    assert rows(once) == rows(twice) == [(1, "a"), (2, "B"), (3, "C")]


def test_insert_ignore_existing_wins(spark):
    tgt, src = frames(spark)
    assert rows(L.insert_ignore(tgt, src, ["k"], ["v"])) == [(1, "a"), (2, "b"), (3, "C")]


def test_insert_if_empty(spark):
    tgt, src = frames(spark)
    empty = tgt.filter(F.lit(False))
    assert rows(L.insert_if_empty(empty, src)) == rows(src)
    assert rows(L.insert_if_empty(tgt, src)) == rows(tgt)


def test_new_rows_null_safe(spark):
    tgt = spark.createDataFrame([(None, 1), ("x", 2)], "a string, b int")
    src = spark.createDataFrame([(None, 1), ("x", 3)], "a string, b int")
    assert rows(L.new_rows(tgt, src, ["a", "b"], null_safe=True)) == [("x", 3)]
    assert L.new_rows(tgt, src, ["a", "b"], null_safe=False).count() == 2


def files(base):
    return {os.path.relpath(os.path.join(d, f), base): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


def test_replace_and_read(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "tbl")
    assert L.read_current(spark, base) is None
    tgt, src = frames(spark)
    assert L.replace(tgt, base) == 2 and rows(L.read_current(spark, base)) == rows(tgt)
    assert L.replace(src, base, L.Layout(["k"])) == 3 and rows(L.read_current(spark, base)) == rows(src)
    L.replace(tgt.filter("false"), base, L.Layout(["k"]))
    assert L.read_current(spark, base) is None


def test_contract_violations(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 1, 60.0), (2, None, 1.0)], "a int, b int, q double")
    c = L.Contract(columns={"a": "int", "b": "int", "q": "decimal(3,1)"}, primary_key=["a", "b"],
                   ranges={"q": (1, 50)})
    got = {(r.rule, r.column): r.n for r in L.violations(df, c).collect()}
    assert got[("not_null", "b")] == 1 and got[("range", "q")] == 1
    assert got[("primary_key", "a,b")] == 1 and got[("type", "q")] == 0


def test_features_text(spark):
    df = spark.createDataFrame([("7", 3, '{"type": "Point", "coordinates": [2.0, 48.0]}')], "id string, z int, g string")
    f = L.to_features(df, "id", "g", ["z"]).first()
    assert f._id == "7"
    assert f.feature == '{"type":"Feature","properties":{"z":3},"geometry":{"type": "Point", "coordinates": [2.0, 48.0]}}'


def test_append_leaves_old_files_alone(spark, tmpdir_fresh):
    base, layout = os.path.join(tmpdir_fresh, "tbl"), L.Layout(["k"], 4)
    tgt, src = frames(spark)
    L.append_rows(tgt, base, layout)
    before = files(base)
    assert L.append_rows(L.new_rows(L.read_current(spark, base), src, ["k"]), base, layout) == 2
    assert before.items() <= files(base).items() and len(files(base)) > len(before)
    assert rows(L.read_current(spark, base)) == [(1, "a"), (2, "b"), (3, "C"), (3, "C2")]
    before = files(base)
    assert L.append_rows(src.filter("false"), base, layout) == 0 and files(base) == before
    L.compact(spark, base, layout)
    assert L.read_current(spark, base).count() == 4


def test_upsert_writes_touched_partitions_only(spark, tmpdir_fresh):
    base, layout = os.path.join(tmpdir_fresh, "tbl"), L.Layout(["k"], 8)
    old = spark.range(200).selectExpr("cast(id as int) as k", "concat('v', id) as v", "cast(null as timestamp) as created_at")
    L.append_rows(old, base, layout)
    before = files(base)
    assert len({os.path.dirname(f) for f in before}) == 8
    batch = spark.createDataFrame([(7, "x"), (7, "y"), (9, "v9"), (500, "n")], "k int, v string")
    assert L.upsert_rows(L.audit(batch), base, layout, ["v"], "created_at") == 2       # 9 is as it was
    now = {r.k: r.v for r in L.read_current(spark, base).collect()}
    assert now == {**{i: f"v{i}" for i in range(200)}, 7: "x", 500: "n"}
    bucket = {r.k: r.b for r in spark.read.parquet(base).selectExpr("k", "_bucket8 as b").collect()}
    touched = {bucket[7], bucket[500]}
    assert {int(os.path.dirname(f).split("=")[1]) for f in before.keys() - files(base).keys()} == touched
    kept = {f: t for f, t in before.items() if int(os.path.dirname(f).split("=")[1]) not in touched}
    assert kept.items() <= files(base).items()
    stamps = L.read_current(spark, base).filter("created_at is not null").count()
    state = files(base)
    assert stamps == 2 and L.upsert_rows(L.audit(batch), base, layout, ["v"], "created_at") == 0 and files(base) == state


def test_upsert_by_a_column(spark, tmpdir_fresh):
    base, layout = os.path.join(tmpdir_fresh, "tbl"), L.Layout(["z", "annee"], by="annee")
    L.append_rows(spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("b", 2021, 3.0)], "z string, annee int, v double"), base, layout)
    before = files(base)
    L.upsert_rows(spark.createDataFrame([("b", 2021, 4.0), ("c", 2022, 5.0)], "z string, annee int, v double"), base, layout, ["v"])
    assert rows(L.read_current(spark, base).select("z", "annee", "v")) == [
        ("a", 2020, 1.0), ("a", 2021, 2.0), ("b", 2021, 4.0), ("c", 2022, 5.0)]
    assert {f for f in before if "annee=2020" in f} <= files(base).keys()
    plan = L.read_current(spark, base).filter("annee = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan


def test_damaged_table_is_an_error(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "tbl")
    tgt, src = frames(spark)
    L.replace(tgt.coalesce(1), base)
    name = next(iter(files(base)))
    for f in (name, f".{name}.crc"):
        with open(os.path.join(base, f), "wb") as out:
            out.write(b"")
    for act in (lambda: L.read_current(spark, base).collect(), lambda: L.upsert_rows(src, base, L.Layout(["k"]), ["v"])):
        with pytest.raises(Exception):
            act()


def test_batches_written_again_stay_one(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "tbl")
    tgt, src = frames(spark)
    for df, name in ((tgt, "s-0"), (src, "s-1"), (src, "s-1"), (tgt, "t-0")):
        L.append_batch(df, base, name)
    assert rows(L.read_current(spark, base)) == sorted(rows(tgt) * 2 + rows(src))


CONTRACT = L.Contract(columns={"id": "int", "name": "varchar(3)", "code": "string", "q": "decimal(3,1)", "n": "int"},
                      primary_key=["id"], unique=[["code"]], not_null=["name"], ranges={"q": (1, 50)}, defaults={"n": 0})
BATCH = [(1, "a", "x", 5.0, None), (2, None, "y", 5.0, 1), (3, "abcd", "z", 99.0, 1), (None, "b", "w", 5.0, 1), (1, "c", "v", 5.0, 1),
         (5, "e", "x", 5.0, 1), (6, "f", None, None, 1), (7, "g", None, 5.0, 1)]


def rejected(spark, base):
    import json
    df = L.read_current(spark, base)
    return [] if df is None else sorted((json.loads(r.row)["id"] or 0, json.loads(r.row)["name"], list(r.rules)) for r in df.collect())


def test_load_rejects_what_breaks_the_contract(spark, tmpdir_fresh):
    base, bad = os.path.join(tmpdir_fresh, "tbl"), os.path.join(tmpdir_fresh, "bad")
    df = spark.createDataFrame(BATCH, "id int, name string, code string, q double, n int").coalesce(1)
    done = L.load(df, base, "append_new", ["id"], CONTRACT, rejected=bad)
    assert rows(done.table.select("id", "name", "code", "n")) == [(1, "a", "x", 0), (6, "f", None, 1), (7, "g", None, 1)]
    assert rejected(spark, bad) == [(0, "b", ["not_null:id"]), (1, "c", ["primary_key:id"]), (2, None, ["not_null:name"]),
                                    (3, "abcd", ["range:q", "type:name"]),
                                    (5, "e", ["unique:code"])]
    m = done.metrics
    assert (m["rows"], m["broken"], m["repeated"], m["loaded"], m["nulls:code"], m["nulls:n"]) == (8, 3, 2, 3, 2, 0)
    assert done.table.filter("created_at is null").count() == 0
    again = L.load(df, base, "append_new", ["id"], CONTRACT, rejected=os.path.join(tmpdir_fresh, "bad2"))
    assert again.metrics["loaded"] == 0 and again.table.count() == 3
    # a code of the target, under another id
    more = spark.createDataFrame([(8, "h", "x", 5.0, 1), (9, "i", "new", 5.0, 1)], "id int, name string, code string, q double, n int")
    third = L.load(more, base, "append_new", ["id"], CONTRACT, rejected=bad)
    assert third.metrics["repeated"] == 1 and sorted(r.id for r in third.table.collect()) == [1, 6, 7, 9]


def test_load_rules_with_a_contract(spark, tmpdir_fresh):
    kind = "id int, name string, code string, q double, n int"
    first = spark.createDataFrame([(1, "a", "x", 5.0, 1), (1, "b", "y", 5.0, 1), (2, "c", "z", 5.0, 1)], kind).coalesce(1)
    second = spark.createDataFrame([(2, "d", "z", 5.0, 1), (3, "e", "w", 5.0, 1)], kind)
    for rule, want in (("insert_ignore", [(1, "a"), (2, "c"), (3, "e")]), ("upsert", [(1, "a"), (2, "d"), (3, "e")]),
                       ("insert_if_empty", [(1, "a"), (2, "c")])):
        base = os.path.join(tmpdir_fresh, rule)
        L.load(first, base, rule, ["id"], CONTRACT)
        done = L.load(second, base, rule, ["id"], CONTRACT)
        assert rows(done.table.select("id", "name")) == want, rule
    with pytest.raises(ValueError):
        L.load(first, os.path.join(tmpdir_fresh, "x"), "merge", ["id"])

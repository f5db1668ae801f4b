"""Rows applied to a keyed table one after another."""

import random

from pyspark.sql import functions as F

from tidewright.operators import keyed

RANK = {"commercial-ok": 0, "factual-cite": 1, "personal-only": 2}
FORM = "k string, n int, at int, v int, source string, tag string, first int, own int, scope string"
POLICY = {"at": keyed.MERGE, "v": keyed.MERGE, "tag": keyed.STRICTER, "first": keyed.KEEP, "own": keyed.PRESERVE}


def one_by_one(old, new, scoped):
    state = {r["k"]: dict(r) for r in old}
    for r in sorted(new, key=lambda r: r["n"]):
        had = state.get(r["k"])
        if had is None:
            state[r["k"]] = {**r, "own": None}
            continue
        if had["at"] is not None and (r["at"] is None or r["at"] < had["at"]):
            continue
        merges = not scoped or r["scope"] == had["scope"]
        state[r["k"]] = {
            **r, "at": r["at"] if r["at"] is not None or not merges else had["at"], "v": r["v"] if r["v"] is not None or not merges else had["v"],
            "tag": r["tag"] if RANK.get(r["tag"], 3) >= RANK.get(had["tag"], 3) else had["tag"], "first": had["first"], "own": had["own"],
        }
    return state


def test_rows_applied_one_after_another(spark):
    rng = random.Random(3)

    def row(k, n):
        return dict(k=k, n=n, at=rng.choice([None, *range(6)]), v=rng.choice([None, n]), source=rng.choice([None, f"s{n}"]), tag=rng.choice([*RANK, "odd", None]), first=n, own=n, scope=rng.choice([None, "a", "b"]))

    old = [row(k, 0) for k in ("a", "b", "c", None)]
    new = [row(rng.choice(["a", "b", "d", "e", None]), n) for n in range(1, 150)]
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], FORM)
    got = keyed.apply_in_order(frame(old), frame(new), ["k"], [F.col("n")], POLICY, "at")
    assert {r.k: r.asDict() for r in got.collect()} == one_by_one(old, new, False)


def test_values_merge_within_a_scope(spark):
    """The guard replaces here, so that a scope's change can't take it away."""
    rng = random.Random(4)
    rows = [dict(k=rng.choice("abc"), n=n, at=n, v=rng.choice([None, None, n]), source="s", tag="commercial-ok", first=n, own=n, scope=rng.choice([None, "a", "a", "b"])) for n in range(1, 90)]
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], FORM)
    got = keyed.apply_in_order(frame(rows[:0]), frame(rows), ["k"], [F.col("n")], {**POLICY, "at": keyed.REPLACE}, "at", "scope")
    assert {r.k: r.asDict() for r in got.collect()} == one_by_one([], rows, True)


def test_a_stale_row_of_a_batch_changes_neither_values_nor_licence(spark):
    form = "code string, fiscal_period_end string, disclosure_type string, consolidated string, net_sales int, license_tag string, disclosed_at int, n int"
    batch = [("1", "p", "t", None, 10, "personal-only", 2, 1), ("1", "p", "t", "", 5, "commercial-ok", 1, 2)]
    for old, new in ((batch[:0], batch), (batch[:1], batch[1:])):
        got = keyed.merge_financials(spark.createDataFrame(old, form), spark.createDataFrame(new, form), [F.col("n")]).collect()
        assert [(r.consolidated, r.net_sales, r.license_tag, r.disclosed_at) for r in got] == [("不明", 10, "personal-only", 2)]


def test_columns_that_one_side_lacks(spark):
    old = spark.createDataFrame([(1, "a", 5)], "k int, v string, kept int")
    new = spark.createDataFrame([(1, "b", 7, 1), (2, "c", 8, 2)], "k int, v string, added int, n int")
    got = keyed.apply_in_order(old, new, ["k"], [F.col("n")])
    assert sorted(map(tuple, got.select("k", "v", "kept", "added").collect())) == [(1, "b", 5, 7), (2, "c", None, 8)]

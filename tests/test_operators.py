import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from minitriple import plain_key
from sparkdraft.operators import checks, joins, merge, ordering, reshape
from sparkdraft.plans import contracts
from sparkdraft.sources import dtypes, layout, text
from sparkdraft.sources.layout import ContractError, CountColumn, Layout


def cells_frame(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, cells array<string>")


def test_melt_is_sparse_and_the_last_duplicate_column_wins(spark):
    columns = [CountColumn(0, "pack", "A"), CountColumn(1, "pack", "B"), CountColumn(2, "pool", "A"),
               CountColumn(3, "pack", "A"), CountColumn(4, "pool", "C")]
    rows = [["1", "0", "2", "0", ""], ["1", "0.0", "0", "3", "x"], ["0", "", "0", "0.0", "0"]]
    got = reshape.melt_counts(cells_frame(spark, rows), columns, ["pack", "pool"], ["k"]).collect()
    def key(name):
        return plain_key("card", name)

    assert {tuple(r) for r in got} == {(0, key("A"), 1, 2), (1, key("A"), 3, 0)}


def test_melt_keeps_the_sum_of_a_wide_table(spark):
    random.seed(3)
    columns = [CountColumn(i, "pack" if i < 60 else "pool", f"Card '{i % 60}'") for i in range(120)]
    rows = [[random.choice(["0", "0", "0.0", "", "1", "2.0"]) for _ in range(120)] for _ in range(40)]
    wide = sum(int(float(c or 0)) for r in rows for c in r)
    melted = reshape.melt_counts(cells_frame(spark, rows), columns, ["pack", "pool"], ["k"])
    assert melted.agg(F.sum(F.col("pack") + F.col("pool"))).head()[0] == wide


def test_melt_needs_no_shuffle_and_no_join(spark):
    columns = [CountColumn(0, "pack", "A"), CountColumn(1, "pool", "A")]
    plan = reshape.melt_counts(cells_frame(spark, [["1", "2"]]), columns, ["pack", "pool"],
                               ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_csv_records(spark):
    lines = ["a,b,c", '"A, B",2,"x ""y"" z"', ",,", '"",q,', 'plain,"last, one",',
             '"say ""hi"", you",é,5" disk', '"a","b",', 'a 5",b,"c, d"']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    out = df.select(text.split_record(F.col("value")).alias("c"),
                    text.field_count(F.col("value")).alias("n")).collect()
    assert [r["n"] for r in out] == [3] * 8
    assert [r["c"][:3] for r in out] == [
        ["a", "b", "c"], ["A, B", "2", 'x "y" z'], ["", "", ""], ["", "q", ""],
        ["plain", "last, one", ""], ['say "hi", you', "é", '5" disk'], ["a", "b", ""],
        ['a 5"', "b", "c, d"]]


def test_multiset_matches_a_counter(spark):
    random.seed(5)
    lists = [[random.randrange(6) for _ in range(n)] for n in (0, 1, 7, 40)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "k int, x array<int>")
    for r in df.select("k", reshape.multiset(F.col("x")).alias("m")).collect():
        assert {s["item"]: s["quantity"] for s in r["m"]} == dict(Counter(lists[r["k"]]))


def test_fold_kinds_last_nonzero(spark):
    df = spark.createDataFrame([("x", "a", 2, 1), ("x", "a", 5, 2), ("x", "a", 0, 3), ("y", "b", 0, 4)],
                               "key string, kind string, n int, pos int")
    out = reshape.fold_kinds(df, ["key"], "kind", "n", {"a": "a", "b": "b"}, F.col("pos")).collect()
    assert [tuple(r) for r in out] == [("x", 5, 0)]


def test_dense_index_equals_the_sorted_position(spark):
    random.seed(7)
    values = random.sample(range(10**6), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = {r["v"]: r["idx"] for r in ordering.dense_index(df, ["v"], slices=7).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_completed_prefix(spark):
    df = spark.createDataFrame([("a", 0, True), ("a", 1, False), ("a", 2, True), ("b", 0, True)],
                               "g string, i int, done boolean")
    assert {tuple(r) for r in ordering.completed_prefix(df, "i", "done", ["g"]).collect()} == {
        ("a", 1), ("b", 1)}


def test_merges_treat_nulls_differently(spark):
    stored = spark.createDataFrame([("k1", None, 0.48), ("k2", "a", None), ("k3", "a", 1.0)],
                                   "k string, t string, x float")
    incoming = spark.createDataFrame([("k1", "b", 0.48), ("k2", "c", None), ("k4", "d", None)],
                                     "k string, t string, x double")
    kinds = {"x": "float32"}
    assert [r["k"] for r in merge.null_fill_conflicts(stored, incoming, ["k"], ["t", "x"], kinds).collect()] == ["k2"]
    strict = merge.strict_ensure_conflicts(stored, incoming, ["k"], ["t", "x"], kinds)
    assert sorted(r["k"] for r in strict.collect()) == ["k1", "k2"]
    merged = {r["k"]: r["t"] for r in merge.null_fill_merge(stored, incoming, ["k"], ["t", "x"]).collect()}
    assert merged == {"k1": "b", "k2": "a", "k3": "a", "k4": "d"}
    fresh, _ = merge.insert_or_validate(stored, incoming, ["k"], ["t"])
    assert [r["k"] for r in fresh.collect()] == ["k4"]
    everything, none = merge.insert_or_validate(stored, incoming, ["k"], ["t"], validate_existing=False)
    assert everything.count() == 3 and none.isEmpty()


def test_metadata_conflicts_tolerate_float_rounding(spark):
    df = spark.createDataFrame([("a", "x", 0.48, 1), ("a", "x", 0.47999998927116394, 2),
                                ("b", "x", 0.48, 1), ("b", "x", 0.49, 2),
                                ("c", "x", 1.0, 1), ("c", None, 1.0, 2)], "k string, t string, v double, o int")
    got = {r["k"]: r["differing"] for r in checks.metadata_conflicts(
        df, ["k"], ["t"], ["v"], F.col("o")).collect()}
    assert got == {"b": "v", "c": "t"}


def test_enforce_modes(spark):
    one = spark.range(3)
    found = checks.combine([checks.finding(one, "bad", "fatal"), checks.finding(one, "odd", "warn")])
    with pytest.raises(checks.CheckFailed, match="bad"):
        checks.enforce(found, "strict")
    assert len(checks.enforce(found, "lenient")) == 2


def test_header_contracts(spark):
    lay = Layout.parse('draft_id,"pack_card_Lion, King",pool_Bear,candidate_hand_2,candidate_hand_1,'
                       "user_turn_1_a,user_turn_1_b,user_turn_2_a")
    assert [(c.kind, c.card_name) for c in lay.count_columns(layout.PICK_KINDS)] == [
        ("pack", "Lion, King"), ("pool", "Bear")]
    assert lay.candidate_columns() == [(1, 4), (2, 3)]
    head = contracts.header_frame(spark, lay)
    assert {tuple(r) for r in contracts.turn_groups(head).collect()} == {
        ("user", 1, "a"), ("user", 1, "b"), ("user", 2, "a")}
    assert {tuple(r) for r in contracts.contract_breaks(head).collect()} == {
        ("unclassified turn column", "user_a"), ("unclassified turn column", "user_b"),
        ("turn with other columns than the lowest one of its side", "user_turn_2")}
    for columns, missing in ((("candidate_hand_1", "candidate_hand_3"), {"2"}), (("x",), {"1"}),
                             (("candidate_hand_1", "candidate_hand_2"), set())):
        rows = contracts.contract_breaks(contracts.header_frame(spark, Layout(columns))).collect()
        assert {r.detail for r in rows} == missing
    replay = Layout((*layout.REPLAY_REQUIRED, "candidate_hand_2"))
    with pytest.raises(ContractError, match="contiguous.*: 1"):
        contracts.check_contracts(spark, Layout(layout.PICK_REQUIRED), Layout(layout.GAME_REQUIRED), replay)
    with pytest.raises(ContractError, match="missing"):
        layout.require_columns(lay.columns, ("pick",), "x")


def test_dtypes():
    known, unknown = dtypes.column_dtypes(
        ["pool_X", "won", "oppo_turn_3_eot_user_life", "opening_hand", "opening_hand_X", "zzz",
         "candidate_hand_10"])
    assert known == {"pool_X": "tinyint", "won": "boolean", "oppo_turn_3_eot_user_life": "float",
                     "opening_hand": "string", "opening_hand_X": "tinyint"}
    assert unknown == ["zzz", "candidate_hand_10"]


def test_read_typed(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('won,num_turns,rank,pack_card_"x"\nTrue,3.0,gold,1\nno,,x,0\n')
    known, _ = dtypes.column_dtypes(["won", "num_turns", "rank"])
    rows = text.read_typed(spark, str(path), known).collect()
    assert [tuple(r) for r in rows] == [(True, 3, "gold"), (False, None, "x")]


def test_skew_safe_lookup_leaves_null_and_frequent_ids_where_they_are(spark):
    dim = spark.range(3000).select(F.col("id").alias("d"), (F.col("id") * 10).alias("v"))
    n = F.col("id")
    rows = spark.range(20_000).select("id", F.when(n % 4 == 0, None).when(n % 4 == 1, 7).otherwise(
        n % 5000).alias("k"))
    want = {(r.id, r.k, r.v) for r in joins.lookup(rows, dim, "k", "d", ["v"]).collect()}
    assert joins.hot_ids(rows, "k") == [7]
    for most in (5000, 100):
        got = joins.skew_safe_lookup(rows, dim, "k", "d", ["v"], max_rows=most)
        assert {(r.id, r.k, r.v) for r in got.collect()} == want and got.count() == 20_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        apart = joins.skew_safe_lookup(rows, dim, "k", "d", ["v"], max_rows=100)
        still, moved = apart._jdf.queryExecution().sparkPlan().toString().split("SortMergeJoin")
        assert "BroadcastHashJoin" in still and "isnotnull(k" not in still.split("BroadcastHashJoin")[1][:400]
        assert "isnotnull" in moved and "NOT" in moved  # only these rows are shuffled
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

import math

from minitriple import plain_key
from pyspark.sql import functions as F

from sparkdraft.functions import clean, keys, prob


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_keys_equal_the_definition(spark):
    df = spark.createDataFrame([("d1", 2, 30), ("d,x|", 0, -1)], "d string, a int, b bigint")
    rows = df.select("d", "a", "b", keys.pick_key(F.col("d"), F.col("a"), F.col("b")).alias("p"),
                     keys.game_key(F.col("d"), F.col("a"), F.col("b")).alias("g"),
                     keys.turn_key(F.col("b"), F.lit("user"), F.col("a")).alias("t")).collect()
    for r in rows:
        assert r["p"] == plain_key("pick", r["d"], r["a"], r["b"])
        assert r["g"] == plain_key(r["d"], r["a"], r["b"])
        assert r["t"] == plain_key("turn", r["b"], "user", r["a"])


def test_times(spark):
    cells = ["2024-01-02 03:04:05", " 2024-01-02", "", " ", None, "2 Jan 2024", "2024-13-01"]
    assert column(spark, cells, clean.bad_time) == [False] * 5 + [True] * 2
    assert [t is None for t in column(spark, cells, clean.timestamp_or_null)] == [False] * 2 + [True] * 5


def test_card_key_trims_and_null_parts_give_null(spark):
    assert column(spark, [" Island ", "Island"], keys.card_key) == [plain_key("card", "Island")] * 2
    assert column(spark, [None], lambda x: keys.deterministic_key("a", x)) == [None]


def test_counts(spark):
    cells = ["", "0", "0.0", "2", "2.0", "2.7", "nan", None, "x", "-1"]
    assert column(spark, cells, clean.count_or_zero) == [0, 0, 0, 2, 2, 2, 0, 0, 0, -1]
    assert column(spark, ["", "nan", "x", "32767", "40000", "inf"], clean.bad_count) == [
        False, False, True, False, True, True]


def test_booleans(spark):
    cells = ["True", "f", "1", "no", "", "maybe", None]
    assert column(spark, cells, clean.bool_or_null) == [True, False, True, False, None, None, None]
    assert column(spark, cells, clean.bad_bool) == [False] * 5 + [True, False]


def test_integers(spark):
    cells = ["3.0", "3.5", " 4 ", "", "x", "1e3", "9007199254740993", "5d"]
    assert column(spark, cells, clean.integer_or_null) == [
        3, None, 4, None, None, 1000, 9007199254740993, None]
    assert column(spark, cells, clean.bad_integer) == [False, True] + [False] * 6
    assert column(spark, ["3.9", "7", "x", "-2.5"], clean.key_integer) == [3, 7, None, -2]


def test_id_lists(spark):
    cells = ["", "7", "7|7|9", " 7 | 9 ", "nan", None, "|7||", "\t7|\t8"]
    assert column(spark, cells, clean.id_tokens) == [
        [], ["7"], ["7", "7", "9"], ["7", "9"], [], [], ["7"], ["7", "8"]]


def test_text_times_and_meaning(spark):
    assert column(spark, ["  ", " a b ", "\tx", None], clean.text_or_null) == [None, "a b", "x", None]
    times = column(spark, ["2024-01-02 03:04:05", "2024-01-02", "soon", ""], clean.timestamp_or_null)
    assert [str(t) for t in times] == ["2024-01-02 03:04:05", "2024-01-02 00:00:00", "None", "None"]
    cells = ["", "0", "0.0", "0.00", "NaN", None]
    assert column(spark, cells, clean.is_meaningful) == [False, False, False, True, True, False]
    assert column(spark, ["NaN", " 0 ", "x"], lambda x: clean.is_meaningful(x, True)) == [
        False, False, True]


def test_float_equality(spark):
    df = spark.createDataFrame([(0.48, 0.47999998927116394), (0.48, 0.4801), (None, None),
                                (None, 1.0)], "a double, b double")
    got = df.select(clean.values_equal(F.col("a"), F.col("b"), "float").alias("y")).collect()
    assert [r["y"] for r in got] == [True, False, True, False]


def test_canonical_json(spark):
    df = spark.createDataFrame([("2", " ", "x")], "b string, c string, a string")
    as_json = clean.canonical_json({c: F.col(c) for c in df.columns})
    assert df.select(as_json.alias("j")).head()["j"] == '{"a":"x","b":"2","c":null}'


def test_probabilities(spark):
    seen = column(spark, [1, 4, 30, 31, 45], lambda k: prob.p_seen(k, 40, 10), "int")
    expected = [0.25, 1 - math.comb(36, 10) / math.comb(40, 10), 1 - 1 / math.comb(40, 10), 1.0, 1.0]
    assert all(abs(a - b) < 1e-12 for a, b in zip(seen, expected))
    joint = column(spark, [2], lambda k: prob.p_seen_together(k, F.lit(3), 40, 10), "int")[0]
    c = math.comb
    by_hand = 1 - (c(38, 10) + c(37, 10) - c(35, 10)) / c(40, 10)
    assert abs(joint - by_hand) < 1e-12


def test_plain_count_cells_are_recognised_exactly(spark):
    from pyspark.sql import functions as F

    cells = {"1": False, "": False, "12.00": False, "1.": False, "1.2.3": True, ".": True,
             "1..2": True, "-1": True, "12345": True, "inf": True, "2.5": True, " 1": True}
    rows = spark.createDataFrame([(c, f"0,{c},3") for c in cells], "cell string, tail string")
    found = {r.cell: r.odd for r in rows.withColumn("odd", F.col("tail").rlike(
        r"(?:^|,)(?!(?:[0-9]{1,4}(?:\.0*)?)?(?:,|$))")).collect()}
    assert found == cells


def test_card_names_have_one_id_whatever_surrounds_them(spark):
    name = spark.createDataFrame([("Island\t ",), ("Island",)], "n string")
    ids = {r.k for r in name.select(keys.card_key(name["n"]).alias("k")).collect()}
    assert ids == {plain_key("card", "Island")}
    text = spark.range(1).select(F.expr(keys.card_key_sql("'Island'")).alias("k")).head().k
    assert ids == {text}

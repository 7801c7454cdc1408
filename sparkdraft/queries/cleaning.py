"""Keys, tolerant parsers, reference tables and reshaping of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.functions import clean, keys, prob
from sparkdraft.operators import ordering, reshape
from sparkdraft.plans import dims
from sparkdraft.queries.registry import query, sql_key, table

ORDER, LINE = "l_orderkey::VARCHAR", "l_linenumber::VARCHAR"


@query("det_keys", f"""
    SELECT l_orderkey, l_linenumber, {sql_key("'order'", ORDER)} AS order_id,
           {sql_key("'line'", ORDER, LINE)} AS line_id, {sql_key(ORDER, LINE, "'1'")} AS game_id
    FROM lineitem""")
def det_keys(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(order, line, keys.deterministic_key("order", order).alias("order_id"),
                     keys.deterministic_key("line", order, line).alias("line_id"),
                     keys.game_key(order, line, F.lit(1)).alias("game_id"))


# A text cell per order in the spellings the parsers must cope with.
_NUMBER_CELL_SQL = """CASE o_orderkey % 9
    WHEN 0 THEN '' WHEN 1 THEN ' ' || o_custkey || ' ' WHEN 2 THEN o_custkey || '.0'
    WHEN 3 THEN o_custkey || '.5' WHEN 4 THEN 'nan' WHEN 5 THEN 'x' || o_custkey
    WHEN 6 THEN '-' || o_custkey WHEN 7 THEN (o_orderkey * 7)::VARCHAR END"""


def _number_cell():
    key, order = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    m = order % 9
    return (F.when(m == 0, "").when(m == 1, F.concat(F.lit(" "), key, F.lit(" ")))
            .when(m == 2, F.concat(key, F.lit(".0"))).when(m == 3, F.concat(key, F.lit(".5")))
            .when(m == 4, "nan").when(m == 5, F.concat(F.lit("x"), key))
            .when(m == 6, F.concat(F.lit("-"), key)).when(m == 7, (order * 7).cast("string")))


@query("clean_numbers", f"""
    WITH c AS (SELECT o_orderkey, {_NUMBER_CELL_SQL} AS cell FROM orders),
    n AS (SELECT *, nullif(try_cast(trim(cell) AS DOUBLE), 'nan'::DOUBLE) AS number,
                 coalesce(trim(cell), '') IN ('', 'nan') AS blank FROM c)
    SELECT o_orderkey, number,
           CASE WHEN number = floor(number) THEN number::BIGINT END AS integer_value,
           coalesce(number <> floor(number), false) AS bad_integer,
           trunc(number)::BIGINT AS key_integer,
           coalesce(trunc(number), 0)::BIGINT AS count_value,
           NOT blank AND (number IS NULL OR abs(number) >= 32768) AS bad_count
    FROM n""")
def clean_numbers(spark: SparkSession, sf: str) -> DataFrame:
    cell = _number_cell()
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.number_or_null(cell).alias("number"),
        clean.integer_or_null(cell).alias("integer_value"),
        clean.bad_integer(cell).alias("bad_integer"),
        clean.key_integer(cell).alias("key_integer"),
        clean.count_or_zero(cell).cast("bigint").alias("count_value"),
        clean.bad_count(cell).alias("bad_count"))


@query("clean_bools", """
    WITH c AS (SELECT o_orderkey, CASE o_orderkey % 9
        WHEN 0 THEN 'True' WHEN 1 THEN 'f' WHEN 2 THEN '1' WHEN 3 THEN 'no' WHEN 4 THEN ''
        WHEN 5 THEN 'maybe' WHEN 6 THEN ' YES ' WHEN 7 THEN o_orderstatus END AS cell FROM orders),
    w AS (SELECT *, lower(trim(cell)) AS word FROM c),
    b AS (SELECT *, CASE WHEN word IN ('true', 't', '1', 'yes') THEN true
                         WHEN word IN ('false', 'f', '0', 'no') THEN false END AS flag FROM w)
    SELECT o_orderkey, flag, coalesce(word, '') <> '' AND flag IS NULL AS bad FROM b""")
def clean_bools(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("o_orderkey") % 9
    cell = (F.when(m == 0, "True").when(m == 1, "f").when(m == 2, "1").when(m == 3, "no")
            .when(m == 4, "").when(m == 5, "maybe").when(m == 6, " YES ")
            .when(m == 7, F.col("o_orderstatus")))
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.bool_or_null(cell).alias("flag"), clean.bad_bool(cell).alias("bad"))


@query("clean_times", """
    SELECT o_orderkey, try_cast(trim(CASE o_orderkey % 4
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        WHEN 1 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN o_orderpriority END)
        AS TIMESTAMP) AS t
    FROM orders""")
def clean_times(spark: SparkSession, sf: str) -> DataFrame:
    m, t = F.col("o_orderkey") % 4, F.col("o_orderdate")
    cell = (F.when(m == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
            .when(m == 1, F.concat(F.lit(" "), F.date_format(t, "yyyy-MM-dd")))
            .when(m == 2, F.col("o_orderpriority")))
    return table(spark, sf, "orders").select("o_orderkey", clean.timestamp_or_null(cell).alias("t"))


@query("clean_text", """
    WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN ' ' || c_mktsegment || '  '
                                 WHEN 1 THEN '   ' END AS cell FROM customer)
    SELECT c_custkey, nullif(trim(cell), '') AS text_value, coalesce(trim(cell), '') = '' AS missing
    FROM c""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("c_custkey") % 3
    cell = F.when(m == 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))).when(m == 1, "   ")
    return table(spark, sf, "customer").select(
        "c_custkey", clean.text_or_null(cell).alias("text_value"),
        clean.is_missing(cell).alias("missing"))


@query("meaningful_cells", """
    WITH c AS (SELECT l_linenumber, CASE l_partkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '0.0'
        WHEN 2 THEN ' 0 ' WHEN 3 THEN 'NaN' WHEN 4 THEN l_suppkey::VARCHAR END AS cell FROM lineitem)
    SELECT l_linenumber, count(*) AS n,
           count(*) FILTER (WHERE cell NOT IN ('', '0', '0.0')) AS n_exact,
           count(*) FILTER (WHERE lower(trim(cell)) NOT IN ('', '0', '0.0', 'nan', 'none', '<na>'))
               AS n_wide
    FROM c GROUP BY l_linenumber""")
def meaningful_cells(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("l_partkey") % 6
    cell = (F.when(m == 0, "0").when(m == 1, "0.0").when(m == 2, " 0 ").when(m == 3, "NaN")
            .when(m == 4, F.col("l_suppkey").cast("string")))
    return table(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(clean.is_meaningful(cell)).alias("n_exact"),
        F.count_if(F.coalesce(clean.is_meaningful(cell, wide=True), F.lit(False))).alias("n_wide"))


@query("float_tolerance", """
    WITH p AS (SELECT l_linenumber, l_extendedprice AS a, l_extendedprice::FLOAT::DOUBLE AS b,
                      l_extendedprice * 1.00001 AS c FROM lineitem)
    SELECT l_linenumber,
           count(*) FILTER (WHERE abs(a - b) <= 1e-7 + 1e-6 * abs(b)) AS n_close,
           count(*) FILTER (WHERE abs(a - c) <= 1e-7 + 1e-6 * abs(c)) AS n_apart
    FROM p GROUP BY l_linenumber""")
def float_tolerance(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        F.count_if(clean.values_equal(a, a.cast("float").cast("double"), "float")).alias("n_close"),
        F.count_if(clean.values_equal(a, a * 1.00001, "float")).alias("n_apart"))


@query("sampling_probability", """
    WITH k AS (SELECT l_linenumber, l_quantity::INT AS k FROM lineitem),
    q AS (SELECT l_linenumber, k, CASE WHEN 60 - k >= 10 THEN exp(lgamma(60 - k + 1.0)
        - lgamma(60 - k - 10 + 1.0) - lgamma(60 + 1.0) + lgamma(60 - 10 + 1.0)) ELSE 0.0 END AS miss
        FROM k)
    SELECT l_linenumber, k AS copies, count(*) AS n, round(1.0 - max(miss), 9) AS p_seen
    FROM q GROUP BY l_linenumber, k""")
def sampling_probability(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        "l_linenumber", F.col("l_quantity").cast("int").alias("copies")).agg(
        F.count(F.lit(1)).alias("n")).withColumn(
        "p_seen", F.round(prob.p_seen(F.col("copies"), 60, 10), 9))


# --- reference tables -----------------------------------------------------

CARD_ID = sql_key("'card'", "p_name")


@query("card_dim", f"SELECT DISTINCT {CARD_ID} AS card_id, p_name AS card_name FROM part")
def card_dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.cards(table(spark, sf, "part"), "p_name")


def part_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("src_seq"), F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("set"))


@query("arena_map", f"""
    SELECT p_partkey AS arena_card_id, {CARD_ID} AS card_id,
           to_json({{'id': p_partkey::VARCHAR, 'name': p_name, 'set': p_brand}})::VARCHAR AS source_json
    FROM part""")
def arena_map(spark: SparkSession, sf: str) -> DataFrame:
    return dims.arena_card_ids(dims.arena_rows(part_lookup(spark, sf)))


@query("arena_conflicts", """
    SELECT p_size::BIGINT AS arena_card_id FROM part GROUP BY p_size
    HAVING count(DISTINCT p_name) > 1""")
def arena_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    by_size = table(spark, sf, "part").select(
        F.col("p_partkey").alias("src_seq"), F.col("p_size").cast("string").alias("id"),
        F.col("p_name").alias("name"))
    return dims.arena_conflicts(dims.arena_rows(by_size))


@query("ability_dim", """
    WITH r AS (SELECT replace(p_brand, 'Brand#', '')::BIGINT AS ability_id, p_type,
                      row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)
    SELECT ability_id, p_type AS ability_text FROM r WHERE rn = 1""")
def ability_dim(spark: SparkSession, sf: str) -> DataFrame:
    lookup = table(spark, sf, "part").select(
        F.col("p_partkey").alias("src_seq"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("id"), F.col("p_type").alias("text"))
    return dims.abilities(lookup).select("ability_id", "ability_text")


# --- reshape --------------------------------------------------------------

@query("three_kind_counts", """
    SELECT l_orderkey, p_name, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
           count(*) FILTER (WHERE l_returnflag = 'A') AS accepted,
           count(*) FILTER (WHERE l_returnflag = 'N') AS open_lines
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_name""")
def three_kind_counts(spark: SparkSession, sf: str) -> DataFrame:
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", "p_name", "l_returnflag", F.lit(1).alias("copies"))
    return reshape.fold_kinds(rows, ["l_orderkey", "p_name"], "l_returnflag", "copies",
                              {"returned": "R", "accepted": "A", "open_lines": "N"})


@query("id_list_explode", """
    SELECT l_orderkey, l_linenumber, 1::BIGINT AS ordinal, l_partkey AS source_id FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 2, l_suppkey FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 3, l_linenumber FROM lineitem""")
def id_list_explode(spark: SparkSession, sf: str) -> DataFrame:
    cell = F.concat_ws("|", "l_partkey", F.concat(F.lit(" "), F.col("l_suppkey"), F.lit(" ")),
                       F.lit(""), F.concat("l_linenumber", F.lit(".0")))
    tokens = reshape.explode_ids(table(spark, sf, "lineitem"), cell, ["l_orderkey", "l_linenumber"])
    return tokens.select("l_orderkey", "l_linenumber", F.col("ordinal").cast("bigint").alias("ordinal"),
                         clean.id_or_null(F.col("token")).alias("source_id"))


@query("cell_multiset", """
    SELECT conv_id, turn, item, count(*) AS quantity
    FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS item FROM conversations)
    GROUP BY conv_id, turn, item""")
def cell_multiset(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.inline(reshape.multiset(F.split("text", " ")))).withColumn(
        "quantity", F.col("quantity").cast("bigint"))


@query("count_multiset", """
    SELECT l_orderkey, l_linestatus AS zone, l_partkey, count(*) AS quantity
    FROM lineitem GROUP BY l_orderkey, l_linestatus, l_partkey""")
def count_multiset(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_linestatus", "zone")
    return reshape.count_multiset(rows, ["l_orderkey", "zone", "l_partkey"])


@query("two_sided_rows", """
    SELECT o_orderkey, true AS is_user, o_orderstatus AS rank, o_orderpriority AS main_colors,
           NULL::VARCHAR AS observed_colors, o_custkey AS num FROM orders
    UNION ALL
    SELECT o_orderkey, false, o_orderpriority, NULL, o_orderstatus, NULL FROM orders""")
def two_sided_rows(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None)
    return reshape.two_sided(
        table(spark, sf, "orders"), ["o_orderkey"],
        {"rank": F.col("o_orderstatus"), "main_colors": F.col("o_orderpriority"),
         "observed_colors": none.cast("string"), "num": F.col("o_custkey")},
        {"rank": F.col("o_orderpriority"), "main_colors": none.cast("string"),
         "observed_colors": F.col("o_orderstatus"), "num": none.cast("bigint")})


@query("final_candidate", """
    WITH c AS (SELECT l_orderkey, l_linenumber,
        [l_partkey % 5, l_suppkey % 5, l_linenumber % 5] AS opening,
        [l_suppkey % 5, l_orderkey % 5, l_partkey % 5] AS h1,
        [l_linenumber % 5, l_partkey % 5, l_suppkey % 4] AS h2,
        [l_orderkey % 5, l_partkey % 3, l_suppkey % 5] AS h3 FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN list_sort(h3) = list_sort(opening) THEN 3
        WHEN list_sort(h2) = list_sort(opening) THEN 2
        WHEN list_sort(h1) = list_sort(opening) THEN 1 ELSE 3 END AS final_attempt FROM c""")
def final_candidate(spark: SparkSession, sf: str) -> DataFrame:
    part, supp, line, order = (F.col(c).cast("bigint") for c in (
        "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey"))
    hands = [F.array(supp % 5, order % 5, part % 5), F.array(line % 5, part % 5, supp % 4),
             F.array(order % 5, part % 3, supp % 5)]
    candidates = F.array(*[F.struct(F.lit(n).alias("attempt"), h.alias("items"))
                           for n, h in enumerate(hands, 1)])
    opening = F.array(part % 5, supp % 5, line % 5)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        reshape.final_candidate(candidates, opening).alias("final_attempt"))


# --- ordering -------------------------------------------------------------

_FIRST_SQL = """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
               ORDER BY o_orderdate {d}, o_orderkey {d}) AS rn FROM orders)
    SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM r WHERE rn = 1"""


def _per_key(spark: SparkSession, sf: str, pick) -> DataFrame:
    return pick(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"],
                ["o_orderkey", "o_totalprice"], F.struct("o_orderdate", "o_orderkey"))


@query("first_wins", _FIRST_SQL.format(d="ASC"))
def first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _per_key(spark, sf, ordering.first_per_key)


@query("last_wins", _FIRST_SQL.format(d="DESC"))
def last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _per_key(spark, sf, ordering.last_per_key)


@query("prefix_complete", """
    WITH o AS (SELECT o_custkey, o_orderstatus <> 'P' AS done,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx FROM orders)
    SELECT o_custkey, coalesce(min(CASE WHEN NOT done THEN idx END), count(*))::BIGINT
        AS completed_prefix FROM o GROUP BY o_custkey""")
def prefix_complete(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer completed before the first open one."""
    orders = table(spark, sf, "orders").withColumn("done", F.col("o_orderstatus") != "P")
    return ordering.prefix_before_first_open(orders, "o_orderkey", "done", ["o_custkey"])


@query("dataset_prefix", """
    WITH o AS (SELECT o_orderstatus, o_orderkey AS idx, o_totalprice > 1000 AS done FROM orders)
    SELECT o_orderstatus, coalesce(min(CASE WHEN NOT done THEN idx END), count(*))::BIGINT
        AS completed_prefix FROM o GROUP BY o_orderstatus""")
def dataset_prefix(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("done", F.col("o_totalprice") > 1000)
    return ordering.completed_prefix(orders, "o_orderkey", "done", ["o_orderstatus"])

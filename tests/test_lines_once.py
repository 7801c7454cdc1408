"""The tables of a wide source split every line once: no inferred filter does it again."""

import pytest
from pyspark.sql import functions as F

from sparkdraft.functions import keys
from sparkdraft.plans import game, replay
from sparkdraft.sources.layout import CountColumn, Layout, sql_literal
from sparkdraft.sources.text import WideSource, keyed_lines, read_bronze, write_bronze

KEY = ("draft_id", "match_number", "game_number")
HAND = "1|2|3|4|5|6|7"
REPLAY = {"num_mulligans": "0", "opening_hand": HAND, "candidate_hand_1": HAND, "candidate_hand_2": "",
          "user_turn_1_lands_played": "4|5", "user_turn_1_eot_user_lands_in_play": "4|4|5",
          "user_turn_1_creatures_cast": ""}


def source(spark, path, kind, rows):
    layout = Layout((*KEY, *rows[0]))
    lines = [("f", 0, n, ",".join(["d", str(n), "1", *r.values()])) for n, r in enumerate(rows)]
    frame = spark.createDataFrame(lines, "src_file string, src_block bigint, src_seq bigint, value string")
    write_bronze(WideSource(keyed_lines(frame, layout, kind), layout, kind), path)
    return read_bronze(spark, path, layout, kind)


def splits(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("split(value#")


@pytest.fixture(scope="module")
def replays(spark, tmp_path_factory):
    empty = dict.fromkeys(REPLAY, "")
    return source(spark, str(tmp_path_factory.mktemp("r") / "b"), "replay", [REPLAY, empty])


def test_hands(spark, replays):
    arena = spark.createDataFrame([(n, n + 100) for n in range(1, 7)], "arena_card_id long, card_id long")
    rows = replay.hand_rows(replays)
    hands, cards = replay.candidate_hands(rows), replay.candidate_hand_cards(rows, arena)
    assert [splits(df) for df in (hands, cards, replay.hand_reports(rows))] == [1, 1, 1]
    assert [(r.attempt_number, r.is_final_candidate) for r in hands.collect()] == [(1, True)]
    got = {(r.slot_number, r.source_arena_card_id, r.card_id) for r in cards.collect()}
    assert got == {(n, n, n + 100 if n < 7 else None) for n in range(1, 8)}
    assert [r.reason for r in replay.hand_reports(rows).collect()] == [
        "no usable candidate hand", "candidates disagree with mulligans"]


def test_zones_and_events(spark, replays):
    arena = spark.createDataFrame([(4, 104)], "arena_card_id long, card_id long")
    zones = replay.turn_zone_cards(replay.turn_rows(replays), arena)
    events = replay.events(replay.event_cells(replays), arena, spark.createDataFrame([(1,)], "ability_id long"))
    assert [splits(zones), splits(events)] == [1, 1]
    assert sorted((r.source_arena_card_id, r.card_id, r.quantity) for r in zones.collect()) == [
        (4, 104, 2), (5, None, 1)]
    assert sorted((r.source_arena_card_id, r.source_ordinal) for r in events.collect()) == [(4, 1), (5, 2)]


def test_compositions(spark, tmp_path):
    rows = [{"build_index": b, "deck_A": a, "sideboard_A": "0"} for b, a in
            (("1", "2"), ("1", "3"), ("", "4"), ("2", "0"))]
    found = game.build_compositions(source(spark, str(tmp_path / "b"), "game", rows))
    assert splits(found) == 1
    assert sorted((r.build_index, r.drifted) for r in found.collect()) == [(1, True), (2, False)]
    assert [(r.deck_count, r.sideboard_count) for r in game.deck_build_cards(found).collect()] == [(2, 0)]


def test_composition_looks_at_cells_once(spark):
    """Every cell was tested card by card, and a count was parsed twice."""
    columns = [CountColumn(n, kind, name) for n, (kind, name) in enumerate([
        ("deck", "A"), ("sideboard", "A"), ("deck", "B"), ("deck", "A"), ("sideboard", "B"), ("deck", "C")])]
    lines = [["1", "0", "2", "0", "", "0.0"], ["1", "0", "0", "3", "2.0", "x"], ["0", "00", "", "0.0", "0", "7"],
             ["0"], [None, "4", None, "2", None, None]]
    rows = spark.createDataFrame(list(enumerate(lines)), "n int, cells array<string>")
    found = rows.select("n", game.composition(columns).alias("deck"), *[
        F.expr(keys.card_key_sql(sql_literal(c))).alias(c) for c in "ABC"])
    names = {found.first()[c]: c for c in "ABC"}
    assert {r.n: [(names[x.card_id], x.deck, x.sideboard) for x in r.deck] for r in found.collect()} == {
        0: [("A", 1, 0), ("B", 2, 0)], 1: [("A", 3, 0), ("B", 0, 2)], 2: [("C", 7, 0)], 3: [],
        4: [("A", 2, 4)]}
    text = str(game.composition(columns)).lower()
    assert "exists(" not in text and text.count("rlike") == 4  # two kinds, two each

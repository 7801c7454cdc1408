from concurrent.futures import ThreadPoolExecutor

import minitriple
import pytest
from minitriple import plain_key
from pyspark.sql import functions as F

from sparkdraft.operators.checks import CheckFailed
from sparkdraft.plans import game, quarantine, report
from sparkdraft.plans.build import build_store
from sparkdraft.plans.rules import event_rule, known_suffixes
from sparkdraft.sources import discover, files, layout, store as stores, text
from sparkdraft.sources.layout import ContractError
from sparkdraft.sources.schema import TABLES
from sparkdraft.streaming import ledger

G1, G2, G3 = plain_key("d1", 1, 1), plain_key("d1", 1, 2), plain_key("d2", 1, 1)
BEAR, KING, ISLAND, WOLF = (plain_key("card", n) for n in minitriple.NAMES)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("triple")
    data = minitriple.write_triple(folder / "data")
    result = build_store(spark, data, str(folder / "store"), bronze_partitions=3,
                         verify="full")
    return result, stores.open_store(spark, str(folder / "store")), data


def rows(built, table, *columns):
    return {tuple(r) for r in built[1].table(table).select(*columns).collect()}


def test_pick_tables(built):
    assert rows(built, "drafts", "draft_id", "rank", "event_match_wins") == {
        ("d1", "gold", 3), ("d2", "gold", 3)}  # d9 has no games
    p = [plain_key("pick", "d1", 0, n) for n in range(3)]
    q = plain_key("pick", "d2", 0, 0)
    assert rows(built, "draft_picks", "pick_id", "card_id") == {
        (p[0], BEAR), (p[1], KING), (p[2], ISLAND), (q, WOLF)}
    assert rows(built, "draft_pick_cards", "*") == {
        (p[0], BEAR, 2, 0), (p[0], ISLAND, 1, 0), (p[1], KING, 1, 0), (p[1], BEAR, 0, 1),
        (p[2], BEAR, 1, 1), (p[2], KING, 0, 1), (q, WOLF, 1, 2)}


def test_game_tables(built):
    build = plain_key("build", "d1", 0)
    assert rows(built, "games", "game_id", "build_id", "user_on_play", "user_won", "source_num_turns") == {
        (G1, build, True, False, 2), (G2, build, True, False, 2), (G3, None, False, True, 2)}
    assert rows(built, "deck_build_cards", "*") == {(build, BEAR, 2, 1), (build, ISLAND, 3, 0)}
    assert rows(built, "game_card_stats", "*") == {
        (G1, BEAR, 3, 0, 0), (G1, KING, 1, 0, 0), (G1, ISLAND, 0, 2, 0)}
    players = rows(built, "game_players", "game_id", "is_user", "observed_colors", "n_games_bucket")
    assert players == {(g, True, None, 100) for g in (G1, G2, G3)} | {
        (g, False, "BR", None) for g in (G1, G2, G3)}


def test_turns_events_zones(built):
    turn = {(g, s, n): plain_key("turn", g, s, n) for g in (G1, G3) for s in ("user", "oppo") for n in (1, 2)}
    assert rows(built, "turns", "turn_id", "is_user_turn", "source_turn_index") == {
        (turn[G1, "user", 1], True, 1), (turn[G1, "oppo", 1], False, 1),
        (turn[G1, "oppo", 2], False, 2), (turn[G3, "oppo", 1], False, 1), (turn[G3, "user", 2], True, 2)}
    t = turn[G1, "user", 1]
    events = {(r[0], r[1]): r[2:] for r in rows(
        built, "events", "source_field", "source_ordinal", "event_type", "actor_is_user",
        "affected_is_user", "source_arena_card_id", "card_id", "ability_id", "numeric_value",
        "actual_turn_id")}
    assert events["user_turn_1_cards_drawn", 3] == ("card_drawn", True, None, 99, None, None, None, None)
    assert events["user_turn_1_lands_played", 1] == ("land_played", True, None, 3, ISLAND, None, None, t)
    assert events["user_turn_1_creatures_blocking", 1][:4] == ("creature_blocking", False, None, -1)
    assert events["user_turn_1_user_abilities", 1][5] == 10
    assert events["user_turn_1_user_abilities", 2][5] is None
    assert events["user_turn_1_oppo_creatures_killed_combat", 1][:3] == ("creature_died_combat", None, False)
    assert events["user_turn_1_user_combat_damage_taken", 1][:3] == ("combat_damage_taken", False, True)
    assert events["oppo_turn_1_cards_drawn", 1][6] == 1.0
    assert ("user_turn_1_player_combat_damage_dealt", 1) not in events  # 'x' is no number
    assert len(events) == 13
    assert rows(built, "turn_player_state", "turn_id", "player_is_user", "life", "hand_size") == {
        (t, True, 20.0, 3), (t, False, 17.5, 4), (turn[G1, "oppo", 2], False, 15.0, None),
        (turn[G3, "user", 2], True, 1.0, None)}
    assert rows(built, "turn_zone_cards", "turn_id", "zone", "source_arena_card_id", "card_id", "quantity") == {
        (t, "hand", 1, BEAR, 1), (t, "hand", 2, KING, 2), (t, "battlefield_land", 3, ISLAND, 2),
        (t, "battlefield_land", 8, None, 1), (turn[G3, "user", 2], "battlefield_land", 0, None, 1)}


def test_hands_and_totals(built):
    assert rows(built, "candidate_hands", "game_id", "attempt_number", "is_final_candidate") == {
        (G1, 1, False), (G1, 2, True), (G2, 2, False), (G2, 3, True), (G3, 1, False), (G3, 2, True)}
    assert built[1].table("candidate_hand_cards").count() == 42
    totals = rows(built, "game_player_totals", "game_id", "is_user", "cards_drawn", "mana_spent")
    assert totals == {(g, True, 5, 7.5) for g in (G1, G2, G3)} | {(g, False, None, None) for g in (G1, G2, G3)}


def test_dimensions(built):
    assert rows(built, "arena_card_ids", "arena_card_id", "card_id") == {
        (1, BEAR), (2, KING), (3, ISLAND), (4, BEAR)}
    assert rows(built, "abilities", "ability_id", "ability_text") == {(10, "Fly"), (11, None)}
    assert {n for _, n in rows(built, "cards", "*")} == {*minitriple.NAMES, "Ghost"}


def test_findings_report_and_coverage(built):
    found = {f["check_name"]: f["n_found"] for f in built[0].findings}
    assert found == {"deck composition drift": 1, "candidate hand inconsistencies": 2,
                     "picked card not in offered pack": 1}
    metrics = {r["metric"]: r["value"] for r in report.coverage_metrics(built[1].tables()).collect()}
    assert metrics == {"unmapped_cards": 3, "unmapped_abilities": 1, "unknown_turn_events": 6,
                       "games": 3, "events": 13}


def test_second_build_adds_nothing(spark, built):
    again = build_store(spark, built[2], built[1].root)
    assert again.built == [] and again.skipped == ["SET.Premier"]
    assert [f["check_name"] for f in again.findings] == ["picked card not in offered pack"]


def test_row_counts_and_query(spark, built):
    counts = {r[0]: r[1] for r in stores.row_counts(built[1].tables()).collect()}
    assert counts["events"] == 13 and len(counts) == 15
    got = stores.query(spark, "SELECT count(*) AS n FROM games WHERE user_won = ?", [True])
    assert got.head()["n"] == 1


def test_database_names(spark, built):
    stores.open_store(spark, built[1].root, database="cards_db")
    got = stores.query(spark, "SELECT count(*) AS n FROM cards_db.events WHERE event_type = :t",
                       {"t": "card_drawn"})
    assert got.head()["n"] == 3
    spark.sql("DROP DATABASE cards_db CASCADE")


def test_reset_starts_over(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "s"))
    cards = spark.createDataFrame([(1, "A")], "card_id bigint, card_name string")
    for load in ("l1", "l2"):
        store.stage("cards", cards, "shared", load)
        store.commit([("shared", "cards", load, "", 1)])
    assert [r["load_id"] for r in store.current_loads()] == ["l2"]  # the latest commit
    assert store.table("cards").count() == 1
    store.reset()
    assert store.current_loads() == [] and store.table("cards").count() == 0


def test_commits_of_writers_at_once_are_all_kept(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "s"))
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: store.commit([(f"d{i}", "games", f"l{i}", "", i)]), range(16)))
    assert sorted(numbers) == list(range(1, 17))
    assert {r["dataset_id"] for r in store.current_loads()} == {f"d{i}" for i in range(16)}
    late = f"d{numbers.index(16)}"
    with pytest.raises(stores.CommitConflict):  # somebody replaced it meanwhile
        store.commit([(late, "games", "other", "", 1)], based_on=2)
    assert store.commit([("d99", "games", "new", "", 1)], based_on=2) == 17
    assert files.put_by_rename(spark, f"{tmp_path}/x/a.json", "1")
    assert not files.put_by_rename(spark, f"{tmp_path}/x/a.json", "2")
    assert (tmp_path / "x" / "a.json").read_text() == "1"


def test_a_changed_end_changes_the_fingerprint(spark, tmp_path):
    import random

    body = random.Random(1).randbytes(5 << 20)
    marks = []
    for n, edit in enumerate((None, 0, len(body) - 1, len(body) // 2)):
        data = bytearray(body)
        if edit is not None:
            data[edit] ^= 1
        folder = tmp_path / str(n)
        folder.mkdir()
        (folder / "a.bin").write_bytes(bytes(data))
        marks.append(ledger.fingerprint(spark, [str(folder / "a.bin")]))
    assert marks[0] == marks[3] and len(set(marks)) == 3  # the same size each time
    twice = ledger.fingerprint(spark, [str(tmp_path / "0" / "a.bin"), str(tmp_path / "1" / "a.bin")])
    assert twice != ledger.fingerprint(spark, [str(tmp_path / "0" / "a.bin")] * 2)


def test_colliding_keys_are_told_from_repeated_rows(spark, built):
    tables = dict(built[1].tables())
    games = tables["games"]
    one = games.where(f"game_id = {G1}")
    tables["games"] = games.unionAll(one).unionAll(
        games.where(f"game_id = {G2}").withColumn("game_id", F.lit(G3)))
    found = {(r.check_name, r.table_name): r.n_found for r in report.constraint_findings(
        tables, full=False).where("n_found > 0").collect()}
    assert found == {("unique game_id", "games"): 1, ("collision of hashed keys", "games"): 1}


def test_game_rows_do_not_read_the_lines(spark, built, tmp_path):
    source = text.read_wide(spark, f"{built[2]}/game_data_public.SET.Premier.csv.gz", "game")
    text.write_bronze(source, str(tmp_path / "bronze"))
    bronze = text.read_bronze(spark, str(tmp_path / "bronze"), source.layout, "game")
    for rows in (game.game_rows(bronze), game.draft_metadata(bronze)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "named" in plan and "value#" not in plan and "value:string" not in plan
    assert game.game_rows(bronze).count() == 3


def test_builds_at_once_lose_nothing(spark, tmp_path):
    """Both add reference rows to one store; the slower one starts again on the other's."""
    for n in ("A.x", "B.x"):
        rows = [[r | {"draft_id": r["draft_id"] + n} for r in part] for part in minitriple.default_rows()]
        minitriple.write_triple(tmp_path / n, n, rows=rows)
    root = str(tmp_path / "store")
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda n: build_store(spark, str(tmp_path / n), root), ("A.x", "B.x")))
    assert sorted(b for r in results for b in r.built) == ["A.x", "B.x"]
    store = stores.Store(spark, root)
    assert store.table("games").count() == 6 and store.table("cards").count() == 5
    assert store.table("events").count() == 26
    removed = store.vacuum()
    assert store.table("events").count() == 26 and store.vacuum() == []
    assert all("load_id=" in path for path in removed)


def test_a_load_that_died_goes_on_behind_its_last_complete_slice(spark, built, tmp_path, monkeypatch):
    root, staged, died = str(tmp_path / "store"), [], []
    stage = stores.Store.stage

    def dying(self, table, df, dataset_id, load_id, part=0):
        if part == 1 and table == "turns" and not died:
            died.append(table)
            raise OSError("the process dies here")
        staged.append((table, part))
        return stage(self, table, df, dataset_id, load_id, part)

    monkeypatch.setattr(stores.Store, "stage", dying)
    with pytest.raises(OSError):
        build_store(spark, built[2], root, slices=2)
    first = len(staged)
    assert ("events", 0) in staged and stores.Store(spark, root).current_loads() == []
    result = build_store(spark, built[2], root, slices=2)
    again = staged[first:]
    assert result.built == ["SET.Premier"]
    assert ("turns", 1) in again and ("turns", 0) not in again and ("events", 0) not in again
    store = stores.Store(spark, root)
    for table in ("drafts", "draft_pick_cards", "deck_build_cards", "events", "candidate_hand_cards"):
        assert {tuple(r) for r in store.table(table).collect()} == rows(built, table, "*")
    assert store.vacuum() == [] and not list((tmp_path / "store" / "progress").rglob("*.json"))


def test_manifest(built):
    rows_by_table = {r["table_name"]: r for r in stores.manifest(built[1]).collect()}
    assert rows_by_table["events"]["row_count"] == 13
    assert rows_by_table["games"]["n_files"] >= 1 and rows_by_table["games"]["n_bytes"] > 0


def test_changed_source_is_refused(spark, built, tmp_path):
    import shutil

    data = tmp_path / "data"
    shutil.copytree(built[2], data)
    minitriple.write_triple(data, rows=tuple(part * 2 for part in minitriple.default_rows()))
    with pytest.raises(ContractError, match="changed"):
        build_store(spark, str(data), built[1].root)


def test_bad_rows_stop_a_strict_build(spark, tmp_path):
    picks, games, replays = minitriple.default_rows()
    games[0]["num_turns"] = "2.5"
    games[1]["deck_Bear"] = "-1"
    picks[0]["pack_card_Island"] = "many"
    data = minitriple.write_triple(tmp_path / "data", rows=(picks, games, replays))
    with pytest.raises(CheckFailed, match="malformed pick cells.*: 1; malformed game cells.*: 2") as e:
        build_store(spark, data, str(tmp_path / "store"))
    assert "draft row 1 of" in str(e.value) and "pack_card_Island: 'many'" in str(e.value)
    store = stores.Store(spark, str(tmp_path / "store"))
    assert store.current_loads() == []  # nothing published
    assert store.rejects("SET.Premier").count() == 3  # but kept


def test_game_counts_that_are_no_numbers_stop_a_strict_build(spark, tmp_path):
    picks, games, replays = minitriple.default_rows()
    games[0]["drawn_Island"] = "1.2.3"
    data = minitriple.write_triple(tmp_path / "data", rows=(picks, games, replays))
    with pytest.raises(CheckFailed, match="malformed game cells.*: 1"):
        build_store(spark, data, str(tmp_path / "store"))


def test_unreadable_times_are_reported_and_stop_no_build(spark, tmp_path):
    picks, games, replays = minitriple.default_rows()
    games[0]["game_time"] = "2 Jan 2024"
    data = minitriple.write_triple(tmp_path / "data", rows=(picks, games, replays))
    result = build_store(spark, data, str(tmp_path / "store"))
    assert [(f["table_name"], f["severity"], f["n_found"]) for f in result.findings
            if f["check_name"] == "unreadable times"] == [("game", "warn", 1)]
    store = stores.open_store(spark, str(tmp_path / "store"))
    assert store.table("games").where("game_time is null").count() == 1
    assert [(r.row_number, r.dropped, *r.reasons[0]) for r in store.rejects().collect()] == [
        (1, False, "game_time", "2 Jan 2024", "no time")]


def test_a_lenient_build_keeps_what_it_rejects(spark, tmp_path):
    picks, games, replays = minitriple.default_rows()
    games[1]["drawn_Bear"] = "inf"
    picks[1]["pick_number"] = "first"  # the line has no key and is left out
    data = minitriple.write_triple(tmp_path / "data", rows=(picks, games, replays))
    result = build_store(spark, data, str(tmp_path / "store"), mode="lenient")
    store = stores.open_store(spark, str(tmp_path / "store"))
    assert result.built == ["SET.Premier"] and store.table("draft_picks").count() == 3
    kept = {(r.kind, r.row_number, r.dropped, *r.reasons[0]) for r in store.rejects().collect()}
    assert kept == {("draft", 2, True, "pick_number", "first", "no number"),
                    ("game", 2, False, "drawn_Bear", "inf", "no count")}
    assert not files.exists(spark, f"{store.root}/bronze/dataset_id=SET.Premier/load_id="
                            + store.current_loads()[0]["load_id"])


def test_narrowing_stops_a_strict_build(spark, tmp_path):
    picks, games, replays = minitriple.default_rows()
    picks[0]["event_match_wins"] = "70000"
    games[0]["num_turns"] = "40000"
    replays[0]["user_total_cards_drawn"] = "40000"
    replays[1]["oppo_total_cards_drawn"] = "2.5"
    data = minitriple.write_triple(tmp_path / "data", rows=(picks, games, replays))
    with pytest.raises(CheckFailed, match="pick cells.*: 1; .*game cells.*: 1; .*replay cells.*: 2"):
        build_store(spark, data, str(tmp_path / "store"))


def test_fatal_findings_leave_the_store_empty_twice(spark, tmp_path):
    """A negative pack count and a fractional hand size are found before publishing."""
    picks, games, replays = minitriple.default_rows()
    picks[0]["pack_card_Island"] = "-1"
    data = minitriple.write_triple(tmp_path / "data", rows=(picks, games, replays))
    for _ in range(2):
        with pytest.raises(CheckFailed, match="negative pack or pool count|malformed pick cells"):
            build_store(spark, data, str(tmp_path / "store"))
        assert stores.Store(spark, str(tmp_path / "store")).current_loads() == []
    replays[0]["user_turn_1_eot_oppo_cards_in_hand"] = "2.5"
    data = minitriple.write_triple(tmp_path / "hands", rows=(minitriple.default_rows()[0], games, replays))
    with pytest.raises(CheckFailed, match="malformed hand size"):
        build_store(spark, data, str(tmp_path / "store"))


def test_other_datasets_may_share_a_draft(spark, tmp_path):
    """Shared rows are validated, not doubled; NULLs of stored drafts are filled."""
    picks, games, replays = minitriple.default_rows()
    data = minitriple.write_triple(tmp_path / "data", "A.x")
    build_store(spark, data, str(tmp_path / "store"))
    for row in picks:
        if row["draft_id"] == "d2":
            row["user_game_win_rate_bucket"] = "0.61"
    minitriple.write_triple(tmp_path / "data", "B.x", rows=(picks, games, replays))
    result = build_store(spark, data, str(tmp_path / "store"))
    assert result.built == ["B.x"] and result.skipped == ["A.x"]
    # The new load is reported, and so is what was stored before.
    assert [f["check_name"] for f in result.findings].count("picked card not in offered pack") == 2
    store = stores.Store(spark, str(tmp_path / "store"))
    assert store.table("draft_picks").count() == 4 and store.table("events").count() == 13
    rates = {r[0]: r[1] for r in store.table("drafts").select("draft_id", "user_game_win_rate_bucket").collect()}
    assert abs(rates["d2"] - 0.61) < 1e-6 and store.table("drafts").count() == 2


def test_rejects_name_file_line_column_and_cell(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('draft_id,match_number,game_number,won,deck_A,deck_B\nd,1,1,no,0,2\n"d,2",1\n'
                    'd,x,1,maybe,1.2.3,-1\nd,3,1,,inf,2.0\n"d,3",4,1,T,"nan",7\n')
    source = text.read_wide(spark, str(path), "game")
    rows = quarantine.rejects(source, game.game_checks(source.layout), layout.GAME_KINDS)
    found = {r.row_number: (r.dropped, {tuple(x) for x in r.reasons}, r.line) for r in rows.collect()}
    assert found == {
        2: (True, {("", "2", "wrong field count")}, '"d,2",1'),
        3: (True, {("draft_id|match_number|game_number", "d|x|1", "unusable key"),
                   ("won", "maybe", "no truth value"), ("deck_A", "1.2.3", "no count"),
                   ("deck_B", "-1", "negative count")}, "d,x,1,maybe,1.2.3,-1"),
        4: (False, {("deck_A", "inf", "no count")}, "d,3,1,,inf,2.0")}
    assert source.valid().count() == 3
    assert text.header_mismatches(text.read_lines(spark, str(path)), source.layout.line).isEmpty()


def test_discovery(spark, tmp_path):
    minitriple.write_triple(tmp_path, "A.B")
    (tmp_path / "game_data_public.C.csv.gz").write_bytes(b"not empty")
    complete, incomplete = discover.find_datasets(spark, str(tmp_path))
    assert [r["suffix"] for r in complete] == ["A.B"] and incomplete == ["C"]
    names = spark.createDataFrame([
        ("game_data_public.X.Y.csv.gz", "replay_data_public.X.Y.csv.gz"), ("g.csv", "r.csv")], "g string, r string")
    ids = [r[0] for r in names.select(discover.dataset_id(F.col("g"), F.col("r"))).collect()]
    import hashlib
    assert ids == ["X.Y", "manual-" + hashlib.sha256(b"g.csv|r.csv").hexdigest()[:16]]


def test_every_rule_has_a_side():
    assert event_rule("user", "cards_drawn").payload == "card"
    assert event_rule("oppo", "cards_drawn").payload == "numeric"
    assert event_rule("user", "cards_drawn_or_tutored") is None
    damage = event_rule("oppo", "user_combat_damage_taken")
    assert (damage.actor_is_user, damage.affected_is_user) == (False, True)
    dealt = event_rule("oppo", "player_combat_damage_dealt")
    assert (dealt.actor_is_user, dealt.affected_is_user, dealt.exact_turn) == (False, True, True)
    assert ("user", "eot_oppo_life") in known_suffixes()
    assert ("user", "cards_drawn_or_tutored") not in known_suffixes()


def test_model_names_only_known_tables():
    for table in TABLES.values():
        assert set(table.not_null) <= set(table.columns)
        for columns, parent, parent_columns in table.foreign:
            assert set(columns) <= set(table.columns) and set(parent_columns) <= set(TABLES[parent].columns)

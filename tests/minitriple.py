"""A hand-written source triple that touches the edge rules of the model."""

import csv
import gzip
import hashlib
import io
from pathlib import Path

def plain_key(*parts):
    digest = hashlib.sha256("|".join(map(str, parts)).encode()).digest()
    return int.from_bytes(digest[:8], "big") & 0x7FFFFFFFFFFFFFFF


PICK_META = ["draft_id", "expansion", "event_type", "draft_time", "rank", "event_match_wins",
             "event_match_losses", "pack_number", "pick_number", "pick", "pick_maindeck_rate",
             "pick_sideboard_in_rate", "user_n_games_bucket", "user_game_win_rate_bucket"]
NAMES = ["Bear", "Lion, King", "Island", "O'Wolf"]

GAME_META = ["expansion", "event_type", "draft_id", "draft_time", "game_time", "build_index",
             "match_number", "game_number", "rank", "opp_rank", "main_colors", "splash_colors",
             "on_play", "num_mulligans", "opp_num_mulligans", "opp_colors", "num_turns", "won"]

TURN_SUFFIXES = {
    "user": ["cards_drawn", "lands_played", "creatures_blocking", "creatures_blitzed",
             "user_abilities", "oppo_creatures_killed_combat", "user_combat_damage_taken",
             "player_combat_damage_dealt", "eot_user_cards_in_hand", "eot_oppo_cards_in_hand",
             "eot_user_lands_in_play", "eot_oppo_creatures_in_play", "eot_user_life",
             "eot_oppo_life", "user_mana_spent"],
    "oppo": ["cards_drawn", "lands_played", "creatures_cast", "cards_foretold",
             "eot_user_life", "eot_oppo_life"],
}
TURNS = {"user": 2, "oppo": 2}


def turn_names():
    return [f"{side}_turn_{n}_{s}" for side in ("user", "oppo")
            for n in range(1, TURNS[side] + 1) for s in TURN_SUFFIXES[side]]


REPLAY_META = ["draft_id", "match_number", "game_number", "on_play", "won", "num_turns",
               "num_mulligans", "opp_num_mulligans", "opening_hand", "candidate_hand_1",
               "candidate_hand_2", "candidate_hand_3", "user_n_games_bucket",
               "user_game_win_rate_bucket", "user_total_cards_drawn", "oppo_total_cards_drawn",
               "user_total_mana_spent"]


def write_csv(path: Path, header, rows):
    buffer = io.StringIO()
    writer = csv.writer(buffer, lineterminator="\n")
    writer.writerow(header)
    for row in rows:
        writer.writerow([row.get(c, "") for c in header])
    data = buffer.getvalue().encode("utf-8")
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)


def pick(draft, pack, number, card, offered=(), pool=(), **extra):
    row = dict(draft_id=draft, expansion="SET", event_type="Premier",
               draft_time="2024-01-02 03:04:05", rank="gold", event_match_wins="3",
               event_match_losses="1", pack_number=str(pack), pick_number=str(number), pick=card,
               pick_maindeck_rate="0.5", pick_sideboard_in_rate="", user_n_games_bucket="100",
               user_game_win_rate_bucket="0.48")
    row |= {f"pack_card_{n}": "0" for n in NAMES} | {f"pool_{n}": "0.0" for n in NAMES}
    row |= {f"pack_card_{n}": str(c) for n, c in dict(offered).items()}
    row |= {f"pool_{n}": str(c) for n, c in dict(pool).items()}
    return row | extra


def game(draft, match, number, build="0", deck=(), side=(), opening=(), drawn=(), **extra):
    row = dict(expansion="SET", event_type="Premier", draft_id=draft,
               draft_time="2024-01-02 03:04:05", game_time="2024-01-02 04:00:00",
               build_index=build, match_number=str(match), game_number=str(number), rank="gold",
               opp_rank="None", main_colors="WU", splash_colors="", on_play="True",
               num_mulligans="1", opp_num_mulligans="0", opp_colors="BR", num_turns="2", won="False")
    for kind, counts in (("deck", deck), ("sideboard", side), ("opening_hand", opening),
                         ("drawn", drawn), ("tutored", ())):
        row |= {f"{kind}_{n}": "0" for n in NAMES} | {f"{kind}_{n}": str(c)
                                                     for n, c in dict(counts).items()}
    return row | extra


def replay(draft, match, number, **extra):
    row = dict(draft_id=draft, match_number=str(match), game_number=str(number), on_play="True",
               won="False", num_turns="2", num_mulligans="1", opp_num_mulligans="0",
               opening_hand="1|1|2|3|3|3|1", candidate_hand_1="1|1|2|3|3|3|9",
               candidate_hand_2="3|3|3|2|1|1|1", candidate_hand_3="",
               user_n_games_bucket="100", user_game_win_rate_bucket="0.48",
               user_total_cards_drawn="5", user_total_mana_spent="7.5")
    return row | extra


CARDS = [dict(id="1", name="Bear", set="X"), dict(id="2", name="Lion, King", set=""),
         dict(id="3", name=" Island ", set="X"), dict(id="4", name="Bear", set="Y"),
         dict(id="", name="Ghost", set="X"), dict(id="8", name="", set="X")]
ABILITIES = [dict(id="10", text="Fly"), dict(id="10", text="Later"), dict(id="11", text="")]


def default_rows():
    picks = [
        pick("d1", 0, 0, "Bear", offered={"Bear": 2, "Island": 1}),
        pick("d1", 0, 1, "Lion, King", offered={"Lion, King": 1}, pool={"Bear": "1.0"}),
        pick("d1", 0, 2, "Island", offered={"Bear": 1}, pool={"Bear": 1, "Lion, King": 1}),
        pick("d2", 0, 0, "O'Wolf", offered={"O'Wolf": 1}, pool={"O'Wolf": 2},
             user_game_win_rate_bucket=""),
        pick("d9", 0, 0, "Bear", offered={"Bear": 1}),  # no games: dropped
    ]
    games = [
        game("d1", 1, 1, deck={"Bear": 2, "Island": 3}, side={"Bear": 1},
             opening={"Bear": 3, "Lion, King": 1}, drawn={"Island": 2}),
        game("d1", 1, 2, deck={"Bear": 1, "Island": 4}),  # drift: the first one is kept
        game("d2", 1, 1, build="", deck={"Bear": 1}, won="True", on_play="f", num_turns="2.0"),
    ]
    replays = [
        replay("d1", 1, 1, user_turn_1_cards_drawn="1|1|99", user_turn_1_lands_played="3",
               user_turn_1_creatures_blocking="-1", user_turn_1_creatures_blitzed="2",
               user_turn_1_user_abilities="10|77", user_turn_1_oppo_creatures_killed_combat="2",
               user_turn_1_user_combat_damage_taken="3.0",
               user_turn_1_player_combat_damage_dealt="x",
               user_turn_1_eot_user_cards_in_hand="1|2| 2",
               user_turn_1_eot_oppo_cards_in_hand="4", user_turn_1_eot_user_lands_in_play="3|3|8",
               user_turn_1_eot_user_life="20", user_turn_1_eot_oppo_life="17.5",
               user_turn_1_user_mana_spent="1", oppo_turn_1_cards_drawn="1",
               oppo_turn_1_cards_foretold="2", oppo_turn_2_eot_oppo_life="15",
               user_turn_2_cards_drawn="0", user_turn_2_eot_user_life="0.0"),
        replay("d1", 1, 2, candidate_hand_1="1|1|2|3|3|3", candidate_hand_2="1|1|2|3|3|3|1",
               candidate_hand_3="1|1|2|3|3|1|3"),
        replay("d2", 1, 1, won="1", on_play="no", opening_hand="7", oppo_turn_1_creatures_cast="4",
               user_turn_2_eot_user_lands_in_play="0", user_turn_2_eot_user_life="1"),
    ]
    return picks, games, replays


def write_triple(folder: Path, suffix="SET.Premier", rows=None, lookups=True):
    picks, games, replays = rows or default_rows()
    pick_header = PICK_META + [f"pack_card_{n}" for n in NAMES] + [f"pool_{n}" for n in NAMES]
    game_header = GAME_META + [f"{k}_{n}" for k in ("deck", "sideboard", "opening_hand", "drawn",
                                                    "tutored") for n in NAMES]
    folder.mkdir(parents=True, exist_ok=True)
    write_csv(folder / f"draft_data_public.{suffix}.csv.gz", pick_header, picks)
    write_csv(folder / f"game_data_public.{suffix}.csv.gz", game_header, games)
    write_csv(folder / f"replay_data_public.{suffix}.csv.gz", REPLAY_META + turn_names(), replays)
    if lookups:
        write_csv(folder / "cards.csv", ["id", "name", "set"], CARDS)
        write_csv(folder / "abilities.csv", ["id", "text"], ABILITIES)
    return str(folder)

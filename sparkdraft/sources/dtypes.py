"""Declared type per source column, by the first matching pattern."""

from __future__ import annotations

import re
from collections.abc import Iterable

# A turn column starts with a side and a turn number.
_TURN = r"(user|oppo)_turn_\d+_"
_SIDE = r"(user|oppo)_"

# Fixed values: (pattern over the whole column name, Spark type).
# Half-precision source types become float: Spark has no 16-bit float.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("user_n_games_bucket", "smallint"),
    ("user_game_win_rate_bucket|pick_maindeck_rate|pick_sideboard_in_rate", "float"),
    ("expansion|event_type|draft_id|draft_time|rank|pick|game_time", "string"),
    ("opp_rank|main_colors|splash_colors|opp_colors|opening_hand", "string"),
    ("event_match_wins|event_match_losses|pack_number|pick_number", "tinyint"),
    ("build_index|match_number|game_number|num_turns", "tinyint"),
    ("num_mulligans|opp_num_mulligans", "tinyint"),
    ("on_play|won", "boolean"),
    ("(pool|pack_card|deck|sideboard|drawn|tutored|opening_hand)_.*", "tinyint"),
    (r"candidate_hand_\d", "string"),
    (r"user_turn_\d+_cards_(drawn|tutored|foretold)", "string"),
    (r"oppo_turn_\d+_cards_(drawn|tutored|drawn_or_tutored|foretold)", "tinyint"),
    (_TURN + "(cards_discarded|lands_played|creatures_cast|non_creatures_cast)", "string"),
    (_TURN + "creatures_(attacked|blocked|unblocked|blocking)", "string"),
    (_TURN + "creatures_blitzed", "tinyint"),
    (_TURN + _SIDE + "(instants_sorceries_cast|abilities|cards_learned)", "string"),
    (_TURN + "player_combat_damage_dealt", "string"),
    (_TURN + _SIDE + "combat_damage_taken", "string"),
    (_TURN + _SIDE + "creatures_killed_(combat|non_combat)", "string"),
    (_TURN + _SIDE + "mana_spent", "float"),
    (_TURN + "eot_user_cards_in_hand", "string"),
    (_TURN + "eot_oppo_cards_in_hand", "float"),
    (_TURN + "eot_" + _SIDE + "(lands|creatures|non_creatures)_in_play", "string"),
    (_TURN + "eot_" + _SIDE + "(life|poison_counters)", "float"),
    (_SIDE + "total_cards_(drawn|discarded|foretold|learned)", "tinyint"),
    (_SIDE + "total_(lands_played|creatures_cast|creatures_blitzed)", "tinyint"),
    (_SIDE + "total_(non_creatures_cast|instants_sorceries_cast)", "tinyint"),
    (_SIDE + "total_mana_spent", "smallint"),
    ("oppo_total_cards_drawn_or_tutored|user_total_cards_tutored", "tinyint"),
)

_COMPILED = tuple((re.compile(pattern), dtype) for pattern, dtype in PATTERNS)


def column_dtypes(columns: Iterable[str]) -> tuple[dict[str, str], list[str]]:
    """(type per known column, columns without a rule)."""
    known: dict[str, str] = {}
    unknown: list[str] = []
    for column in columns:
        dtype = next((t for p, t in _COMPILED if p.fullmatch(column)), None)
        if dtype is None:
            unknown.append(column)
        else:
            known[column] = dtype
    return known, unknown

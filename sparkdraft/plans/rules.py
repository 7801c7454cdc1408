"""How a turn column becomes events, zones or player state."""

from __future__ import annotations

from dataclasses import dataclass

SIDES = ("user", "oppo")


@dataclass(frozen=True)
class EventRule:
    event_type: str
    payload: str  # card | ability | numeric
    actor_is_user: bool | None
    affected_is_user: bool | None
    exact_turn: bool


# Fixed values. suffix: (event type, payload, actor, affected, exact turn).
# Actors: "source" is the side whose turn column it is, "opposite" the other one.
BOTH_SIDES = {
    "cards_discarded": ("card_discarded", "card", "source", None, False),
    "lands_played": ("land_played", "card", "source", None, True),
    "creatures_cast": ("creature_cast", "card", "source", None, False),
    "non_creatures_cast": ("non_creature_cast", "card", "source", None, False),
    "creatures_attacked": ("creature_attacked", "card", "source", None, True),
    "creatures_blocked": ("creature_blocked", "card", "source", None, True),
    "creatures_unblocked": ("creature_unblocked", "card", "source", None, True),
    "creatures_blocking": ("creature_blocking", "card", "opposite", None, True),
    "creatures_blitzed": ("creatures_blitzed", "numeric", "source", None, False),
    "player_combat_damage_dealt": ("combat_damage_dealt", "numeric", "source", "opposite", True),
}
USER_ONLY = {
    "cards_drawn": ("card_drawn", "card", "source", None, False),
    "cards_tutored": ("card_tutored", "card", "source", None, False),
    "cards_foretold": ("card_foretold", "card", "source", None, True),
}
# The opponent's hidden cards are only counted.
OPPONENT_ONLY = {
    "cards_drawn": ("cards_drawn_hidden", "numeric", "source", None, False),
    "cards_tutored": ("cards_tutored_hidden", "numeric", "source", None, False),
    "cards_drawn_or_tutored": ("cards_drawn_or_tutored_hidden", "numeric", "source", None, False),
    "cards_foretold": ("cards_foretold_hidden", "numeric", "source", None, True),
}
# Suffixes that name a player: <player>_<family>.
NAMED_PLAYER = {
    "instants_sorceries_cast": ("instant_sorcery_cast", "card", "named", None, True),
    "cards_learned": ("card_learned", "card", "named", None, True),
    "abilities": ("ability", "ability", "named", None, True),
    "creatures_killed_combat": ("creature_died_combat", "card", None, "named", True),
    "creatures_killed_non_combat": ("creature_died_non_combat", "card", None, "named", True),
    "combat_damage_taken": ("combat_damage_taken", "numeric", "not_named", "named", True),
}
ZONES = {
    "eot_user_cards_in_hand": (True, "hand"),
    "eot_user_lands_in_play": (True, "battlefield_land"),
    "eot_oppo_lands_in_play": (False, "battlefield_land"),
    "eot_user_creatures_in_play": (True, "battlefield_creature"),
    "eot_oppo_creatures_in_play": (False, "battlefield_creature"),
    "eot_user_non_creatures_in_play": (True, "battlefield_noncreature"),
    "eot_oppo_non_creatures_in_play": (False, "battlefield_noncreature"),
}
STATE_FIELDS = ("life", "poison_counters", "cards_in_hand")
TOTALS = ("cards_drawn", "cards_tutored", "cards_drawn_or_tutored", "cards_discarded",
          "lands_played", "cards_foretold", "creatures_cast", "creatures_blitzed",
          "non_creatures_cast", "instants_sorceries_cast", "cards_learned", "mana_spent")


def _is_user(role: str | None, side: str, named: str | None) -> bool | None:
    return {
        None: None,
        "source": side == "user",
        "opposite": side != "user",
        "named": named == "user",
        "not_named": named != "user",
    }[role]


def event_rule(side: str, suffix: str) -> EventRule | None:
    """The rule of a turn column, None for state, zone and unknown suffixes."""
    named = None
    own = USER_ONLY if side == "user" else OPPONENT_ONLY
    row = BOTH_SIDES.get(suffix) or own.get(suffix)
    if row is None and suffix.startswith(("user_", "oppo_")):
        named, _, family = suffix.partition("_")
        row = NAMED_PLAYER.get(family)
    if row is None:
        return None
    event_type, payload, actor, affected, exact = row
    return EventRule(event_type, payload, _is_user(actor, side, named),
                     _is_user(affected, side, named), exact)


def known_suffixes() -> list[tuple[str, str]]:
    """(side, suffix) of every turn column that some rule, zone or state field covers."""
    named = [f"{player}_{family}" for player in SIDES for family in NAMED_PLAYER]
    state = [f"eot_{player}_{field}" for player in SIDES for field in STATE_FIELDS]
    state += [f"{player}_mana_spent" for player in SIDES]
    own = {"user": USER_ONLY, "oppo": OPPONENT_ONLY}
    return [(side, suffix) for side in SIDES
            for suffix in (*BOTH_SIDES, *own[side], *named, *ZONES, *state)]

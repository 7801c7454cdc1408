"""The normalized tables: columns, keys and references.

Spark enforces none of these constraints, so they are data here and checks in
`sparkdraft.operators.checks`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    # (columns, parent table, parent columns)
    foreign: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    required: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.key, *self.required)))


def _fk(column: str, parent: str, parent_column: str | None = None):
    return ((column,), parent, (parent_column or column,))


# The normalized data model.
TABLES: dict[str, Table] = {t.name: t for t in (
    Table("drafts",
          "draft_id string, expansion string, event_type string, draft_time timestamp_ntz, "
          "rank string, event_match_wins smallint, event_match_losses smallint, "
          "user_n_games_bucket smallint, user_game_win_rate_bucket float",
          ("draft_id",)),
    Table("cards", "card_id bigint, card_name string", ("card_id",), (("card_name",),),
          required=("card_name",)),
    Table("arena_card_ids", "arena_card_id bigint, card_id bigint, source_json string",
          ("arena_card_id",), foreign=(_fk("card_id", "cards"),), required=("card_id",)),
    Table("abilities", "ability_id bigint, ability_text string, source_json string",
          ("ability_id",)),
    Table("draft_picks",
          "pick_id bigint, draft_id string, pack_number smallint, pick_number smallint, "
          "card_id bigint, pick_maindeck_rate float, pick_sideboard_in_rate float",
          ("pick_id",), (("draft_id", "pack_number", "pick_number"),),
          (_fk("draft_id", "drafts"), _fk("card_id", "cards")),
          ("draft_id", "pack_number", "pick_number", "card_id")),
    Table("draft_pick_cards",
          "pick_id bigint, card_id bigint, pack_count smallint, pool_count smallint",
          ("pick_id", "card_id"), (),
          (_fk("pick_id", "draft_picks"), _fk("card_id", "cards")),
          ("pack_count", "pool_count")),
    Table("deck_builds", "build_id bigint, draft_id string, build_index smallint",
          ("build_id",), (("draft_id", "build_index"),), (_fk("draft_id", "drafts"),),
          ("draft_id", "build_index")),
    Table("deck_build_cards",
          "build_id bigint, card_id bigint, deck_count smallint, sideboard_count smallint",
          ("build_id", "card_id"), (),
          (_fk("build_id", "deck_builds"), _fk("card_id", "cards")),
          ("deck_count", "sideboard_count")),
    Table("games",
          "game_id bigint, draft_id string, build_id bigint, match_number smallint, "
          "game_number smallint, game_time timestamp_ntz, user_on_play boolean, "
          "user_won boolean, source_num_turns smallint",
          ("game_id",), (("draft_id", "match_number", "game_number"),),
          (_fk("draft_id", "drafts"), _fk("build_id", "deck_builds")),
          ("draft_id", "match_number", "game_number")),
    Table("game_players",
          "game_id bigint, is_user boolean, rank string, main_colors string, "
          "splash_colors string, observed_colors string, num_mulligans smallint, "
          "n_games_bucket smallint, game_win_rate_bucket float",
          ("game_id", "is_user"), (), (_fk("game_id", "games"),)),
    Table("game_card_stats",
          "game_id bigint, card_id bigint, opening_hand_count smallint, "
          "drawn_count smallint, tutored_count smallint",
          ("game_id", "card_id"), (),
          (_fk("game_id", "games"), _fk("card_id", "cards")),
          ("opening_hand_count", "drawn_count", "tutored_count")),
    Table("candidate_hands",
          "hand_id bigint, game_id bigint, attempt_number smallint, is_final_candidate boolean",
          ("hand_id",), (("game_id", "attempt_number"),), (_fk("game_id", "games"),),
          ("game_id", "attempt_number", "is_final_candidate")),
    Table("candidate_hand_cards",
          "hand_id bigint, slot_number smallint, source_arena_card_id bigint, card_id bigint",
          ("hand_id", "slot_number"), (),
          (_fk("hand_id", "candidate_hands"), _fk("card_id", "cards"))),
    Table("turns",
          "turn_id bigint, game_id bigint, is_user_turn boolean, source_turn_index smallint",
          ("turn_id",), (("game_id", "is_user_turn", "source_turn_index"),),
          (_fk("game_id", "games"),), ("game_id", "is_user_turn", "source_turn_index")),
    Table("events",
          "event_id bigint, game_id bigint, source_turn_id bigint, actual_turn_id bigint, "
          "event_type string, actor_is_user boolean, affected_is_user boolean, "
          "source_arena_card_id bigint, card_id bigint, source_ability_id bigint, "
          "ability_id bigint, numeric_value double, source_ordinal smallint, source_field string",
          ("event_id",), (("game_id", "source_field", "source_ordinal"),),
          (_fk("game_id", "games"), _fk("source_turn_id", "turns", "turn_id"),
           _fk("actual_turn_id", "turns", "turn_id"), _fk("card_id", "cards"),
           _fk("ability_id", "abilities")),
          ("game_id", "source_turn_id", "event_type", "source_ordinal", "source_field")),
    Table("turn_player_state",
          "turn_id bigint, player_is_user boolean, life float, poison_counters float, "
          "hand_size smallint, mana_spent float",
          ("turn_id", "player_is_user"), (), (_fk("turn_id", "turns"),)),
    Table("turn_zone_cards",
          "turn_id bigint, owner_is_user boolean, zone string, source_arena_card_id bigint, "
          "card_id bigint, quantity smallint",
          ("turn_id", "owner_is_user", "zone", "source_arena_card_id"), (),
          (_fk("turn_id", "turns"), _fk("card_id", "cards")), ("quantity",)),
    Table("game_player_totals",
          "game_id bigint, is_user boolean, cards_drawn smallint, cards_tutored smallint, "
          "cards_drawn_or_tutored smallint, cards_discarded smallint, lands_played smallint, "
          "cards_foretold smallint, creatures_cast smallint, creatures_blitzed smallint, "
          "non_creatures_cast smallint, instants_sorceries_cast smallint, "
          "cards_learned smallint, mana_spent float",
          ("game_id", "is_user"), (), (_fk("game_id", "games"),)),
)}

# Reference tables span all datasets; every other table belongs to one dataset.
SHARED_TABLES = ("cards", "arena_card_ids", "abilities")

# The tables of the row-count report.
REPORT_TABLES = tuple(name for name in TABLES if name not in SHARED_TABLES)

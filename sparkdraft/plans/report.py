"""Integrity report and coverage metrics over the normalized tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sparkdraft.operators import checks
from sparkdraft.plans.draft import picks_not_offered
from sparkdraft.sources.schema import TABLES

Tables = Mapping[str, DataFrame]


def constraint_findings(tables: Tables, full: bool = True) -> DataFrame:
    """NOT NULL and unique keys of all tables, collisions of hashed keys; with ``full`` also
    every unique set and reference of the data model."""
    found = []
    for name, table in TABLES.items():
        df = tables[name]
        label = f"unique {','.join(table.key)}"
        if table.unique:  # the key is a hash of these
            faults = checks.key_faults(df, table.key, table.unique[0]).agg(
                F.count_if(~F.col("collision")).alias("repeated"), F.count_if("collision").alias("collided"))
            found.append(faults.select(F.inline(F.array(*[
                F.struct(F.lit(check).alias("check_name"), F.lit(name).alias("table_name"),
                         F.lit("fatal").alias("severity"), F.col(n).alias("n_found"))
                for check, n in ((label, "repeated"), ("collision of hashed keys", "collided"))]))))
        else:
            found.append(checks.finding(checks.duplicate_keys(df, table.key), label, "fatal", name))
        if full:
            for columns in table.unique:
                found.append(checks.finding(checks.duplicate_keys(df, columns),
                                            f"unique {','.join(columns)}", "fatal", name))
            for columns, parent, parent_columns in table.foreign:
                found.append(checks.finding(
                    checks.missing_parents(df, columns, tables[parent], parent_columns),
                    f"reference {','.join(columns)} to {parent}", "fatal", name))
        nulls = checks.null_counts(df, table.not_null).agg(F.sum("n_null").alias("n_found"))
        found.append(nulls.select(F.lit("not null").alias("check_name"),
                                  F.lit(name).alias("table_name"),
                                  F.lit("fatal").alias("severity"), "n_found"))
    return checks.combine(found)


def drafts_without_picks(tables: Tables) -> DataFrame:
    return tables["games"].select("draft_id").distinct().join(
        tables["draft_picks"].select("draft_id"), "draft_id", "left_anti")


def foreign_turns(tables: Tables, column: str) -> DataFrame:
    """Events whose (source or actual) turn belongs to another game."""
    turns = tables["turns"].select(F.col("turn_id").alias(column), F.col("game_id").alias("turn_game"))
    return tables["events"].where(F.col(column).isNotNull()).join(turns, column).where(
        F.col("turn_game") != F.col("game_id")).select("event_id", column)


def integrity_findings(tables: Tables, not_offered: str = "warn") -> DataFrame:
    """The global checks; ``not_offered`` is the severity of picks outside their pack."""
    found = [
        ("game-backed drafts without picks", drafts_without_picks(tables), "fatal", "games"),
        ("picked card not in offered pack",
         picks_not_offered(tables["draft_picks"], tables["draft_pick_cards"]),
         not_offered, "draft_picks"),
        ("negative pack or pool count",
         checks.negative_counts(tables["draft_pick_cards"], ["pack_count", "pool_count"]),
         "fatal", "draft_pick_cards"),
        ("games without exactly two player rows",
         checks.children_not_exactly(tables["games"], "game_id", tables["game_players"], 2),
         "fatal", "game_players"),
        ("games without exactly one final hand",
         checks.children_not_exactly(tables["games"], "game_id", tables["candidate_hands"], 1,
                                     F.col("is_final_candidate")), "fatal", "candidate_hands"),
        ("source turn of another game", foreign_turns(tables, "source_turn_id"), "fatal", "events"),
        ("actual turn of another game", foreign_turns(tables, "actual_turn_id"), "fatal", "events"),
    ]
    return checks.combine([checks.finding(df, name, severity, table)
                           for name, df, severity, table in found])


def unmapped_ids(df: DataFrame, raw: str, resolved: str) -> DataFrame:
    """Distinct positive raw ids without a resolved one (ids <= 0 mean hidden)."""
    return df.where((F.col(raw) > 0) & F.col(resolved).isNull()).select(raw).distinct()


def coverage_metrics(tables: Tables) -> DataFrame:
    """(metric, value): unmapped ids, events without a known turn, totals."""
    raw, card = "source_arena_card_id", "card_id"
    # Distinct per table first, so a frequent id crosses the union once per task.
    cards = unmapped_ids(tables["events"], raw, card)
    for name in ("candidate_hand_cards", "turn_zone_cards"):
        cards = cards.unionAll(unmapped_ids(tables[name], raw, card))

    def metric(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")

    count = F.count(F.lit(1))
    return (
        metric("unmapped_cards", cards.distinct(), count)
        .unionAll(metric("unmapped_abilities", unmapped_ids(
            tables["events"], "source_ability_id", "ability_id"), count))
        .unionAll(metric("unknown_turn_events", tables["events"],
                         F.count_if(F.col("actual_turn_id").isNull())))
        .unionAll(metric("games", tables["games"], count))
        .unionAll(metric("events", tables["events"], count))
    )

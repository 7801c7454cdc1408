"""The build job: dataset triples to committed normalized tables.

Every source file is inflated once into a splittable bronze copy; all tables are
then derived from bronze in narrow stages, checked, and published together.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.operators import checks, merge, ordering
from sparkdraft.plans import dims, draft, game, quarantine, replay, report
from sparkdraft.plans.contracts import check_contracts
from sparkdraft.sources import discover, files, layout, text
from sparkdraft.sources.layout import ContractError, Layout
from sparkdraft.sources.schema import TABLES
from sparkdraft.sources.store import SHARED_DATASET, CommitConflict, Store
from sparkdraft.sources.text import WideSource
from sparkdraft.streaming import ledger

DRAFT_TABLES = ("drafts", "draft_picks", "draft_pick_cards")
GAME_TABLES = ("deck_builds", "deck_build_cards", "games", "game_players", "game_card_stats")
REPLAY_TABLES = ("turns", "candidate_hands", "candidate_hand_cards", "events",
                 "turn_player_state", "turn_zone_cards", "game_player_totals")


#: Loads of one dataset that start over because another writer was faster.
ATTEMPTS = 5
CELL_CHECKS = {"draft": (draft.pick_checks, layout.PICK_KINDS),
               "game": (game.game_checks, layout.GAME_KINDS), "replay": (replay.replay_checks, {})}


@dataclass(frozen=True)
class Dataset:
    dataset_id: str
    draft_file: str
    game_file: str
    replay_file: str

    @property
    def files(self) -> dict[str, str]:
        return {"draft": self.draft_file, "game": self.game_file, "replay": self.replay_file}


@dataclass
class BuildResult:
    built: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    incomplete: list[str] = field(default_factory=list)
    findings: list = field(default_factory=list)


def source_card_names(picks: Layout, games: Layout) -> set[str]:
    return {c.card_name for c in (*picks.count_columns(layout.PICK_KINDS),
                                  *games.count_columns(layout.GAME_KINDS))}


def build_store(spark: SparkSession, data_dir: str, root: str, *, suffix: str | None = None,
                datasets: list[Dataset] | None = None, cards_file: str | None = None,
                abilities_file: str | None = None, mode: str = "strict",
                not_offered: str = "warn", inconsistencies: str = "warn",
                bronze_partitions: int | None = None, verify: str = "keys",
                overwrite: bool = False, slices: int = 1) -> BuildResult:
    """Build all complete datasets of a folder that the store does not have yet.

    ``mode='strict'`` raises on fatal findings before anything is published,
    ``'lenient'`` publishes and reports. Either way lines that cannot be taken as they are
    stay in `Store.rejects`, with file, line number and reasons. Several builds may write to
    one store at once: a build whose base another one replaced starts again. ``verify='keys'`` checks NOT NULL and the key
    of every table, hashed keys also for collisions; ``'full'`` checks every unique set and
    reference besides, which shuffles all tables once more. ``not_offered`` and ``inconsistencies`` are
    the severities ("warn" or "fatal") of picks outside their pack, and of deck
    composition drift and odd candidate hands. ``overwrite`` starts a new store content:
    earlier loads stay on disk but are no longer current. ``slices`` cuts a load into ranges of
    drafts, in the order in which the game source shows them first: if the process dies, the
    next build of the same files, in as many slices, goes on behind the last complete one.
    A dataset must then have one builder at a time.
    """
    store = Store(spark, root)
    if overwrite:
        store.reset()
    result = BuildResult()
    if datasets is None:
        rows, result.incomplete = discover.find_datasets(spark, data_dir, suffix)
        datasets = [Dataset(r["suffix"], r["draft_file"], r["game_file"], r["replay_file"])
                    for r in rows]
    store.check_schema()
    cards_lookup = text.read_lookup(spark, cards_file or f"{data_dir}/cards.csv", ("id", "name"))
    ability_lookup = text.read_lookup(spark, abilities_file or f"{data_dir}/abilities.csv",
                                      ("id", "text"))
    for dataset in datasets:
        fingerprint = ledger.fingerprint(spark, list(dataset.files.values()))
        known = store.fingerprint(dataset.dataset_id)
        if known is not None and known != fingerprint:
            raise ContractError(f"sources of {dataset.dataset_id} changed since they were "
                                "ingested; use the original files or overwrite")
        if known is not None:
            result.skipped.append(dataset.dataset_id)
            continue
        for attempt in range(1, ATTEMPTS + 1):
            try:
                found = _build_dataset(
                    store, dataset, cards_lookup, ability_lookup, fingerprint, mode, not_offered,
                    inconsistencies, bronze_partitions, verify, slices)
                break
            except CommitConflict:
                if attempt == ATTEMPTS or store.fingerprint(dataset.dataset_id) is not None:
                    raise
        result.findings += found
        result.built.append(dataset.dataset_id)
    if result.skipped:  # the new loads were checked by themselves: report on what was there
        stored = {t: store.table(t, [*result.skipped, SHARED_DATASET]) for t in TABLES}
        result.findings += checks.enforce(report.integrity_findings(stored, not_offered), mode)
    return result


@dataclass(frozen=True)
class Load:
    """A load in progress: its folders, and which of its steps are complete."""

    store: Store
    dataset_id: str
    load_id: str
    slices: int
    claim: str

    @classmethod
    def open(cls, store: Store, dataset_id: str, fingerprint: str, based_on: int, slices: int) -> "Load":
        """The unfinished load of these files on this state of the store, or a new one."""
        new = f"{fingerprint[:12]}-{based_on + 1}-{uuid.uuid4().hex[:6]}"
        claim = (f"{store.root}/progress/dataset_id={dataset_id}/"
                 f"load-{fingerprint[:12]}-{based_on}-{slices}.json")
        if slices > 1 and not files.put_if_absent(store.spark, claim, new):
            new = store.spark.read.text(claim).head()["value"]
        return cls(store, dataset_id, new, slices, claim)

    @property
    def scratch(self) -> str:
        return f"{self.store.root}/bronze/dataset_id={self.dataset_id}/load_id={self.load_id}"

    def _mark(self, step: str) -> str:
        return f"{self.store.root}/progress/dataset_id={self.dataset_id}/load_id={self.load_id}/{step}.json"

    def done(self, step: str) -> bool:
        return self.slices > 1 and files.exists(self.store.spark, self._mark(step))

    def complete(self, step: str) -> None:
        if self.slices > 1:
            files.put_if_absent(self.store.spark, self._mark(step), step)

    def first_open(self) -> int:
        """The first slice that is not complete; the number of slices if all are."""
        rows = [(s, self.done(f"slice-{s}")) for s in range(self.slices)]
        steps = self.store.spark.createDataFrame(rows, "slice int, done boolean")
        return ordering.completed_prefix(steps, "slice", "done").head()["completed_prefix"]

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        """A table of the scratch folder, written unless an earlier attempt did."""
        path = f"{self.scratch}/{name}"
        if not self.done(name):
            _written(df, path)
            self.complete(name)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def bronze(self, source: WideSource, partitions: int | None) -> WideSource:
        path = f"{self.scratch}/{source.kind}"
        if not self.done(source.kind):
            text.write_bronze(source, path, partitions)
            self.complete(source.kind)
        return text.read_bronze(self.store.spark, path, source.layout, source.kind)

    def sliced(self, source: WideSource, index: DataFrame) -> list[WideSource]:
        """The source cut by the dense index of its drafts; lines of other drafts are in the first."""
        if self.slices == 1:
            return [source]
        n = index.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n")).scalar()
        number = F.floor(F.col("draft_index") * self.slices / n).cast("int")
        cut = source.lines.join(index.select("draft_id", number.alias("slice")), "draft_id", "left") \
            .withColumn("slice", F.coalesce("slice", F.lit(0)))
        path = f"{self.scratch}/sliced-{source.kind}"
        if not self.done(f"sliced-{source.kind}"):
            cut.write.mode("overwrite").option("compression", "zstd").partitionBy("slice").parquet(path)
            self.complete(f"sliced-{source.kind}")
        lines = self.store.spark.read.schema(cut.schema).parquet(path)
        return [source.with_lines(lines.where(F.col("slice") == s).select(*source.lines.columns))
                for s in range(self.slices)]

    def part(self, name: str, df: DataFrame, s: int) -> DataFrame:
        return _written(df, f"{self.scratch}/{name}/part={s}")

    def whole(self, name: str) -> DataFrame:
        return self.store.spark.read.parquet(f"{self.scratch}/{name}").drop("part")

    def discard(self) -> None:
        for path in (self.scratch, self._mark("").rsplit("/", 1)[0], self.claim):
            files.remove(self.store.spark, path)


def sync_dimensions(store: Store, cards_lookup: DataFrame, ability_lookup: DataFrame,
                    names: set[str], load_id: str, mode: str) -> tuple[list, list]:
    """Stage the reference tables: what is stored plus what is new. Stored rows win;
    returns (ledger rows, findings)."""
    spark = store.spark
    stored = {t: store.table(t) for t in ("cards", "arena_card_ids", "abilities")}
    arena_rows = dims.arena_rows(cards_lookup)
    all_names = dims.header_names(spark, names).unionAll(cards_lookup.select("name"))
    new = {
        "cards": dims.cards(all_names, "name"),
        "arena_card_ids": dims.arena_card_ids(arena_rows),
        "abilities": dims.abilities(ability_lookup),
    }
    key = {"cards": "card_id", "arena_card_ids": "arena_card_id", "abilities": "ability_id"}
    found = checks.enforce(checks.combine([
        checks.finding(dims.arena_conflicts(arena_rows), "arena id of several cards", "fatal",
                       "arena_card_ids"),
        checks.finding(merge.mismatches(stored["arena_card_ids"], new["arena_card_ids"],
                                        ["arena_card_id"], ["card_id"]),
                       "arena id conflicts with stored mapping", "fatal", "arena_card_ids"),
        checks.finding(merge.mismatches(stored["cards"], new["cards"], ["card_name"], ["card_id"]),
                       "card id mismatch", "fatal", "cards"),
    ]), mode)
    commits = []
    for table, rows in new.items():
        merged = stored[table].unionByName(
            merge.insert_if_absent(stored[table], rows, [key[table]]))
        n = store.stage(table, merged, SHARED_DATASET, load_id).count()
        if n > stored[table].count():  # else the stored version stays the current one
            commits.append((SHARED_DATASET, table, load_id, "", n))
    return commits, found


def _build_dataset(store: Store, dataset: Dataset, cards_lookup: DataFrame,
                   ability_lookup: DataFrame, fingerprint: str, mode: str, not_offered: str,
                   inconsistencies: str, bronze_partitions: int | None, verify: str,
                   slices: int) -> list:
    spark, name = store.spark, dataset.dataset_id
    headers = {k: text.read_header(spark, p) for k, p in dataset.files.items()}
    check_contracts(spark, headers["draft"], headers["game"], headers["replay"])
    based_on = store.last_commit()
    load = Load.open(store, name, fingerprint, based_on, slices)
    try:
        commits, findings = _staged_load(
            load, dataset, headers, cards_lookup, ability_lookup, fingerprint, mode, not_offered,
            inconsistencies, bronze_partitions, verify)
        store.commit(commits, based_on)
    except Exception as e:
        if slices == 1 or isinstance(e, (checks.CheckFailed, CommitConflict)):
            load.discard()  # else the next build goes on with it
        raise
    load.discard()
    return findings


def _staged_load(load: Load, dataset: Dataset, headers: dict[str, Layout], cards_lookup: DataFrame,
                 ability_lookup: DataFrame, fingerprint: str, mode: str, not_offered: str,
                 inconsistencies: str, bronze_partitions: int | None,
                 verify: str) -> tuple[list[tuple], list]:
    """Every table of a load below its own folder, checked: (ledger rows, findings)."""
    store, name, load_id = load.store, load.dataset_id, load.load_id
    spark = store.spark
    source = {k: load.bronze(text.read_wide(spark, dataset.files[k], k), bronze_partitions)
              for k in discover.KINDS}

    rejected = None
    for kind, (cell_checks, kinds) in CELL_CHECKS.items():
        rows = _written(quarantine.rejects(source[kind], cell_checks(source[kind].layout), kinds),
                        store.reject_path(name, load_id, kind))
        rejected = rows if rejected is None else rejected.unionAll(rows)
    findings = checks.enforce(checks.combine([
        *[quarantine.findings(rejected, kind) for kind in discover.KINDS],
        checks.finding(game.draft_metadata_conflicts(source["game"]),
                       "draft metadata differs between games", "fatal", "game"),
    ]), mode, lambda: quarantine.examples(rejected))

    commits, found = sync_dimensions(store, cards_lookup, ability_lookup,
                                     source_card_names(headers["draft"], headers["game"]),
                                     load_id, mode)
    findings += found
    arena = store.staged("arena_card_ids", SHARED_DATASET, load_id).select("arena_card_id", "card_id")
    abilities = store.staged("abilities", SHARED_DATASET, load_id).select("ability_id")
    index = load.kept("index", draft.numbered_index(
        draft.draft_index(source["game"].valid()), source["game"].lines))
    orphans = load.kept("orphans", draft.orphan_drafts(source["draft"], index))
    has_builds = any(c.kind in game.DECK for c in headers["game"].count_columns(layout.GAME_KINDS))
    first = load.first_open()
    for s, part in enumerate(zip(*[load.sliced(source[k], index) for k in discover.KINDS])):
        if s >= first:
            _stage_slice(load, s, dict(zip(discover.KINDS, part)), orphans, arena, abilities, has_builds)
            load.complete(f"slice-{s}")
    picks = draft.only_targets(source["draft"], orphans)
    game_rows, replays, turn_rows, hands = (
        load.whole(t) for t in ("game_rows", "replay_rows", "turn_rows", "hand_rows"))
    compositions = load.whole("compositions") if has_builds else None
    staged = {t: store.staged(t, name, load_id) for t in (*DRAFT_TABLES, *GAME_TABLES, *REPLAY_TABLES)}

    findings += checks.enforce(checks.combine(_dataset_findings(
        store, source, picks, index, game_rows, replays, compositions, turn_rows,
        hands, staged, load_id, inconsistencies)), mode)
    tables = {**staged, **{t: store.staged(t, SHARED_DATASET, load_id)
                           for t in ("cards", "arena_card_ids", "abilities")}}
    findings += checks.enforce(report.constraint_findings(tables, full=verify == "full"), mode)
    # The staged rows hold their drafts whole, so the new load alone is checked.
    findings += checks.enforce(report.integrity_findings(tables, not_offered), mode)
    commits += _merge_with_stored(store, name, staged, load_id, fingerprint, mode, findings)
    return commits, findings


def _stage_slice(load: Load, s: int, source: dict[str, WideSource], orphans: DataFrame,
                 arena: DataFrame, abilities: DataFrame, has_builds: bool) -> None:
    """The tables of one range of drafts."""
    def stage(table: str, df: DataFrame) -> None:
        load.store.stage(table, df, load.dataset_id, load.load_id, s)

    # Picks, restricted to drafts with games.
    picks = draft.only_targets(source["draft"], orphans)
    stage("drafts", draft.drafts(picks))
    stage("draft_picks", draft.draft_picks(picks))
    stage("draft_pick_cards", draft.draft_pick_cards(picks))

    # Games; the replay contributes the user's buckets.
    game_rows = load.part("game_rows", game.game_rows(source["game"]), s)
    replays = load.part("replay_rows", replay.replay_rows(source["replay"]), s)
    stage("games", game.games(game_rows, has_builds))
    stage("game_players", game.game_players(game_rows, replays))
    stage("game_card_stats", game.game_card_stats(source["game"]))
    if has_builds:
        compositions = load.part("compositions", game.build_compositions(source["game"]), s)
        stage("deck_builds", game.deck_builds(compositions))
        stage("deck_build_cards", game.deck_build_cards(compositions))
    else:
        for table in ("deck_builds", "deck_build_cards"):
            stage(table, load.store.table(table, datasets=[]))

    # Replays.
    turn_rows = load.part("turn_rows", replay.turn_rows(source["replay"]), s)
    stage("turns", replay.turns(turn_rows))
    stage("turn_player_state", replay.turn_player_state(turn_rows))
    stage("turn_zone_cards", replay.turn_zone_cards(turn_rows, arena))
    stage("events", replay.events(replay.event_cells(source["replay"]), arena, abilities))
    hands = load.part("hand_rows", replay.hand_rows(source["replay"]), s)
    stage("candidate_hands", replay.candidate_hands(hands))
    stage("candidate_hand_cards", replay.candidate_hand_cards(hands, arena))
    stage("game_player_totals", replay.game_player_totals(source["replay"]))


def _written(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage with a table in the store's own shared folder."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dataset_findings(store, source, picks, index, game_rows, replays, compositions, turn_rows,
                      hands, staged, load_id, inconsistencies) -> list[DataFrame]:
    cards = store.staged("cards", SHARED_DATASET, load_id)
    replay_counts = replays.groupBy("draft_id").agg(F.count(F.lit(1)).alias("n_actual"))
    expected = index.select("draft_id", "expected_games")
    short = expected.join(replay_counts, "draft_id", "full").where(
        ~F.col("expected_games").eqNullSafe(F.col("n_actual")))
    present = [f for f in game.SHARED_FIELDS if source["replay"].layout.position(f) is not None]
    game_drafts = game.draft_metadata(source["game"])
    found = [
        ("draft metadata differs between picks", draft.draft_conflicts(picks), "fatal", "drafts"),
        ("drafts with games but without picks",
         game_drafts.join(staged["drafts"], "draft_id", "left_anti"), "fatal", "drafts"),
        ("draft metadata differs from games", merge.strict_ensure_conflicts(
            staged["drafts"], game_drafts, ["draft_id"],
            ["expansion", "event_type", "draft_time"]), "fatal", "drafts"),
        ("picked card unknown", draft.unknown_picked_cards(staged["draft_picks"], cards),
         "fatal", "draft_picks"),
        ("games per draft differ from the index", checks.incomplete_groups(
            expected, "draft_id", "expected_games", staged["games"]), "fatal", "games"),
        ("replays per draft differ from its games", short, "fatal", "replay"),
        ("replay disagrees with its game", replay.replay_mismatches(replays, game_rows, present),
         "fatal", "replay"),
        ("malformed hand size", replay.state_rejects(turn_rows), "fatal", "turn_player_state"),
        ("malformed event ids", replay.malformed_events(staged["events"]), "fatal", "events"),
        ("malformed hand ids", staged["candidate_hand_cards"].where(
            F.col("source_arena_card_id").isNull()), "fatal", "candidate_hand_cards"),
    ]
    if compositions is not None:
        found.append(("deck composition drift", game.build_drift(compositions),
                      inconsistencies, "deck_build_cards"))
    reports = replay.hand_reports(hands)
    fatal_hand = F.col("reason") == "no usable candidate hand"
    found += [("no usable candidate hand", reports.where(fatal_hand), "fatal", "candidate_hands"),
              ("candidate hand inconsistencies", reports.where(~fatal_hand), inconsistencies,
               "candidate_hands")]
    return [checks.finding(df, check, severity, table) for check, df, severity, table in found]


MERGE_FLOATS = {"user_game_win_rate_bucket": "float32", "pick_maindeck_rate": "float32",
                "pick_sideboard_in_rate": "float32", "game_win_rate_bucket": "float32"}


def _merge_with_stored(store: Store, name: str, staged: dict[str, DataFrame], load_id: str,
                       fingerprint: str, mode: str, findings: list) -> list[tuple]:
    """Reconcile a load with drafts that other datasets stored already.

    Normally no draft is shared and the load is published as it stands, without one
    validation join on the large tables. Otherwise rows already stored must agree
    and are not inserted again, and stored drafts get their NULLs filled.
    """
    commits = []
    stored_drafts = store.table("drafts", with_dataset=True).where(F.col("dataset_id") != name)
    shared = stored_drafts.join(staged["drafts"].select("draft_id"), "draft_id", "left_semi")
    overlap = not shared.isEmpty()
    merge_id = f"{load_id}-{uuid.uuid4().hex[:6]}"
    others = None
    for table, df in staged.items():
        key = store_key(table)
        if not overlap:
            commits.append((name, table, load_id, fingerprint, df.count()))
            continue
        others = others or [r["dataset_id"] for r in store.current_loads()
                            if r["dataset_id"] not in (name, SHARED_DATASET)]
        existing = store.table(table, datasets=others)
        columns = [c for c in df.columns if c not in key]
        if table == "drafts":
            differing = merge.null_fill_conflicts(existing, df, key, columns, MERGE_FLOATS)
        else:
            differing = merge.mismatches(existing, df, key, columns, MERGE_FLOATS)
        findings += checks.enforce(
            checks.finding(differing, "differs from stored rows", "fatal", table), mode)
        fresh = store.stage(table, merge.insert_if_absent(existing, df, key), name, merge_id)
        commits.append((name, table, merge_id, fingerprint, fresh.count()))
        if table == "drafts":
            commits += _refill(store, stored_drafts, df, key, columns, merge_id)
    return commits


def _refill(store: Store, stored: DataFrame, incoming: DataFrame, key, columns, load_id) -> list:
    """New versions of the drafts of datasets whose rows get NULLs filled."""
    filled = merge.filled_rows(stored.drop("dataset_id"), incoming, key, columns)
    touched = [r["dataset_id"] for r in stored.join(filled, key, "left_semi")
               .select("dataset_id").distinct().collect()]  # one row per dataset
    commits = []
    for dataset in touched:
        own = stored.where(F.col("dataset_id") == dataset).drop("dataset_id")
        relevant = incoming.join(own.select(*key), key, "left_semi")
        version = store.stage("drafts", merge.null_fill_merge(own, relevant, key, columns),
                              dataset, load_id)
        commits.append((dataset, "drafts", load_id, store.fingerprint(dataset) or "",
                        version.count()))
    return commits


def store_key(table: str) -> list[str]:
    return list(TABLES[table].key)

"""Wide text sources: one line per record, split only where it is used.

A line stays one string through every shuffle and in the bronze copy. Splitting a
1,000-column line multiplies its size in memory, so the split happens in the same
stage that consumes the cells. Source order is kept as (file, block start, row in
block), which survives any later repartitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkdraft.functions import clean, keys
from sparkdraft.sources.layout import NAMED, ContractError, Layout, require_columns

# One CSV token with its separator: a quoted field (doubled quotes inside), or a run
# without commas. Possessive, so the scan of a line is linear.
CSV_TOKEN = r'(?<=^|,)(?:"([^"]*+(?:""[^"]*+)*+)"[^,]*+|([^,]*+))(?:,|\z)'
# Field separator of rewritten quoted records; a control character.
UNIT = "\x01"

ORDER_COLUMNS = ("src_file", "src_block", "src_seq")
BRONZE_DDL = ("src_file string, src_block bigint, src_seq bigint, draft_id string, "
              "row_id bigint, n_fields int, value string")


@dataclass(frozen=True)
class WideSource:
    """Lines of one kind of source file of one dataset, with their header."""

    lines: DataFrame  # columns of BRONZE_DDL, and the cells of NAMED as struct ``named``
    layout: Layout
    kind: str

    def valid(self) -> DataFrame:
        """Lines of the right width with a usable natural key; the rest are rejects."""
        return self.lines.where(
            (F.col("n_fields") == self.layout.width) & F.col("row_id").isNotNull())

    def cells(self, last: int = -1) -> DataFrame:
        """Valid lines with their ``cells array<string>``: all, or those up to position ``last``.

        The named cells come along, for filters: one on ``cells`` would move below this and
        split the line again.
        """
        limit = -1 if last < 0 else last + 2
        return self.valid().select(*ORDER_COLUMNS, "draft_id", "row_id", "named",
                                   split_record(F.col("value"), limit).alias("cells"))

    def named(self, *columns: str, lines: DataFrame | None = None) -> DataFrame:
        """Only the given named cells; the split stops behind the last one."""
        rows = self.valid() if lines is None else lines
        if set(columns) <= set(NAMED[self.kind]):  # kept apart: the lines are not read
            return rows.select(*ORDER_COLUMNS, "draft_id", "row_id",
                               *[F.col(f"named.{c}").alias(c) for c in columns])
        positions = [p for p in map(self.layout.position, columns) if p is not None]
        limit = max(positions, default=0) + 2
        split = rows.select(
            *ORDER_COLUMNS, "draft_id", "row_id",
            split_record(F.col("value"), limit).alias("cells"))
        return split.select(*ORDER_COLUMNS, "draft_id", "row_id", *[
            self.cell(c).alias(c) for c in columns])

    def all_named(self, *columns: str) -> DataFrame:
        """`named` over every line of the right width, also those without a key."""
        return self.named(*columns, lines=self.lines.where(
            F.col("n_fields") == self.layout.width))

    def has_odd_counts(self, kinds: dict[str, str]) -> Column:
        """Whether the count cells of a line are not all plain small numbers.

        Where the count columns end the line, the metadata prefix is cut off and one
        regular expression looks over the untouched tail: only blank cells and up to four
        digits, with zeros behind a point at most, pass as plain. Lines with a quote,
        and all lines of sources laid out otherwise, count as odd.
        """
        positions = sorted(c.position for c in self.layout.count_columns(kinds))
        if not positions:
            return F.lit(False)
        if positions != list(range(positions[0], self.layout.width)):
            return F.lit(True)
        first = positions[0]
        tail = F.get(F.split(F.col("value"), ",", first + 1), F.lit(first))
        # A cell start that is not followed by a whole plain cell and its end.
        return (F.instr("value", '"') > 0) | tail.rlike(
            r"(?:^|,)(?!(?:[0-9]{1,4}(?:\.0*)?)?(?:,|$))")

    def with_lines(self, lines: DataFrame) -> "WideSource":
        return WideSource(lines, self.layout, self.kind)

    def cell(self, column: str) -> Column:
        """One named cell of `cells`; NULL when the source lacks the column."""
        position = self.layout.position(column)
        return F.lit(None).cast("string") if position is None else cell_at(F.lit(position))


def split_record(value: Column, limit: int = -1) -> Column:
    """Fields of a CSV record.

    Records without a quote take the plain split, which may stop after ``limit``
    fields. Quoted records are first rewritten in one linear pass: quotes go, the
    separating commas become a control character. Their array has one spare empty
    element at the end, which no position points to.
    """
    head, tail, cut = _last_quoted(value)

    def rewritten(text: Column) -> Column:
        return F.replace(F.regexp_replace(text, CSV_TOKEN, f"$1$2{UNIT}"), F.lit('""'), F.lit('"'))

    quoted = F.split(F.when(
        cut, F.concat(rewritten(head), F.replace(tail, F.lit(","), F.lit(UNIT)))
    ).otherwise(rewritten(value)), UNIT, limit)
    return F.when(F.instr(value, '"') > 0, quoted).otherwise(F.split(value, ",", limit))


def _last_quoted(value: Column) -> tuple[Column, Column, Column]:
    """A quoted record cut behind its last ``",``: (head with the quote, tail, whether
    the tail is free of quotes). Quoted names stand in front of a long run of plain
    counts, so the regular expression has to look at the head only."""
    tail = F.substring_index(value, '",', -1)
    head = F.left(value, F.length(value) - F.length(tail) - 1)
    return head, tail, F.instr(tail, '"') == 0


def _commas(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(","), F.lit("")))


def field_count(value: Column) -> Column:
    head, tail, cut = _last_quoted(value)
    token = F.lit(CSV_TOKEN)
    quoted = F.when(cut, F.regexp_count(head, token) + _commas(tail) + 1).otherwise(
        F.regexp_count(value, token))
    return F.when(F.instr(value, '"') > 0, quoted).otherwise(_commas(value) + 1)


def without_return(value: Column) -> Column:
    return F.when(F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)).otherwise(value)


def cell_at(position: Column) -> Column:
    return F.get(F.col("cells"), position)


def source_order() -> Column:
    """Comparable source position: file, split, row within the split."""
    return F.struct(*[F.col(c) for c in ORDER_COLUMNS])


def read_header(spark: SparkSession, path: str) -> Layout:
    """Header of a plain or gzip file (reads the first line only)."""
    first = spark.read.text(path).limit(1).head()
    if first is None:
        raise ContractError(f"{path} is empty")
    return Layout.parse(first["value"])


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All lines with their source position.

    Rows of one split are read in order by one task and the id rises within a
    task, so (file, split start, id) orders a file whatever the partition layout.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_seq"),
        "value",
    )


def without_header(lines: DataFrame, header_line: str) -> DataFrame:
    return lines.where(without_return(F.col("value")) != header_line)


def natural_key(kind: str, cell: Callable[[str], Column]) -> Column:
    """Key of a source row: the pick key, or the game key of game and replay rows.
    NULL if a part of it is blank or malformed."""
    draft_id = F.when(~clean.is_missing(cell("draft_id")), cell("draft_id"))
    if kind == "draft":
        return keys.pick_key(draft_id, clean.key_integer(cell("pack_number")),
                             clean.key_integer(cell("pick_number")))
    return keys.game_key(draft_id, clean.integer_or_null(cell("match_number")),
                         clean.integer_or_null(cell("game_number")))


KEY_CELLS = {"draft": ("draft_id", "pack_number", "pick_number"),
             "game": ("draft_id", "match_number", "game_number"),
             "replay": ("draft_id", "match_number", "game_number")}


def keyed_lines(lines: DataFrame, layout: Layout, kind: str) -> DataFrame:
    """Lines (order columns and value) with draft id, row key and field count.

    The key is hashed here, once per source row, and stored with the line: every
    later pass reads it, and its filters reach the stored columns. The named cells are
    stored beside it.
    """
    require_columns(layout.columns, KEY_CELLS[kind], f"{kind} source")
    positions = {c: layout.position(c) for c in dict.fromkeys((*KEY_CELLS[kind], *NAMED[kind]))}
    split = split_record(F.col("value"), max(p for p in positions.values() if p is not None) + 2)
    parsed = lines.withColumn("cells", split).select(*ORDER_COLUMNS, "value", *[
        (F.lit(None).cast("string") if p is None else cell_at(F.lit(p))).alias(f"_{c}")
        for c, p in positions.items()])
    return parsed.select(
        *ORDER_COLUMNS, F.col("_draft_id").alias("draft_id"),
        natural_key(kind, lambda c: F.col(f"_{c}")).alias("row_id"),
        field_count(F.col("value")).alias("n_fields"), "value",
        F.struct(*[F.col(f"_{c}").alias(c) for c in NAMED[kind]]).alias("named"))


def read_wide(spark: SparkSession, path: str, kind: str,
              layout: Layout | None = None) -> WideSource:
    layout = layout or read_header(spark, path)
    lines = without_header(read_lines(spark, path), layout.line).withColumn(
        "value", without_return(F.col("value")))
    return WideSource(keyed_lines(lines, layout, kind), layout, kind)


def spread(lines: DataFrame, partitions: int) -> DataFrame:
    """Spread the lines of a few unsplittable (gzip) files over the cluster.

    The position of a line is unique, so its hash is even under any skew of the
    content and a retried task sends every line to the same place.
    """
    return lines.repartition(partitions, *ORDER_COLUMNS)


def write_bronze(source: WideSource, path: str, partitions: int | None = None) -> None:
    """Splittable copy of the lines: each gzip file is inflated once, by one task."""
    lines = spread(source.lines, partitions) if partitions else source.lines
    lines.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_bronze(spark: SparkSession, path: str, layout: Layout, kind: str) -> WideSource:
    named = ", ".join(f"`{c}`: string" for c in NAMED[kind])
    return WideSource(spark.read.schema(f"{BRONZE_DDL}, named struct<{named}>").parquet(path),
                      layout, kind)


def _splits(lines: DataFrame) -> DataFrame:
    """One row per file split: its first row id and row count."""
    return lines.groupBy("src_file", "src_block").agg(
        F.min("src_seq").alias("first_seq"), F.count(F.lit(1)).alias("n"))


def with_row_numbers(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """Line number within the file (first data line = 1) for the given ``rows``.

    The window runs over one row per split, not over lines.
    """
    before = Window.partitionBy("src_file").orderBy("src_block").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = _splits(lines).withColumn(
        "skipped", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (
        rows.join(offsets, ["src_file", "src_block"])
        .withColumn("row_number", F.col("skipped") + F.col("src_seq") - F.col("first_seq") + 1)
        .drop("skipped", "first_seq")
    )


def with_line_rank(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """One number that rises with the source order over all files."""
    numbered = _splits(lines).select(
        "src_file", "src_block", "first_seq",
        F.row_number().over(Window.orderBy("src_file", "src_block")).alias("split_no"))
    return (
        rows.join(numbered, ["src_file", "src_block"])
        .withColumn("line_rank", F.shiftleft(F.col("split_no").cast("bigint"), 33)
                    + F.col("src_seq") - F.col("first_seq"))
        .drop("split_no", "first_seq")
    )


def header_mismatches(lines: DataFrame, header_line: str) -> DataFrame:
    """Files of a set whose header is not the expected one."""
    return (
        lines.groupBy("src_file")
        .agg(F.max(without_return(F.col("value")) == header_line).alias("has_header"))
        .where(~F.col("has_header")).select("src_file")
    )


def read_lookup(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """Narrow lookup file, all columns as text, with source order for first-wins."""
    frame = (spark.read.option("header", True).option("escape", '"')
             .option("multiLine", True).csv(path))
    require_columns(frame.columns, required, path)
    return frame.select(F.monotonically_increasing_id().alias("src_seq"), *[
        F.col(f"`{c}`") for c in frame.columns])


def read_typed(spark: SparkSession, path: str, dtypes: dict[str, str]) -> DataFrame:
    """Source with declared types; columns without a rule are left out."""
    frame = spark.read.option("header", True).option("escape", '"').csv(path)
    casts = []
    for column in frame.columns:
        if column in dtypes:
            cell = F.col(f"`{column}`")
            if dtypes[column] == "boolean":
                typed = clean.bool_or_null(cell)
            elif dtypes[column] == "string":
                typed = cell
            else:
                typed = clean.number_or_null(cell).try_cast(dtypes[column])
            casts.append(typed.alias(column))
    return frame.select(*casts)

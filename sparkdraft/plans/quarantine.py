"""Lines that a load cannot take as they are, kept with their place and reasons.

One pass over the stored lines of a source looks at the width, the key, the named cells
and the counts of each line. What it finds is a table of its own: a line is there once, with
every reason, its number in the source file and its text, so that it can be mended and loaded
again. ``dropped`` tells whether the load leaves the line out (its width or key is unusable) or
takes it with NULL or cut cells.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparkdraft.functions import clean
from sparkdraft.operators import checks, reshape
from sparkdraft.sources.text import (KEY_CELLS, ORDER_COLUMNS, WideSource, cell_at, split_record,
                                     with_row_numbers)

WIDTH, KEY, NEGATIVE, COUNT = "wrong field count", "unusable key", "negative count", "no count"
TIME = "no time"


@dataclass(frozen=True)
class CellCheck:
    column: str
    bad: Callable[[Column], Column]
    reason: str
    key: bool = False  # such a cell makes the key of the line unusable


def _reason(column: str | Column, cell: Column, reason: str | Column) -> Column:
    def text(value: str | Column) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return F.struct(text(column).alias("column_name"), cell.cast("string").alias("cell"),
                    text(reason).alias("reason"))


def _judged(pairs: Column, bad: Callable[[Column], Column], reason: str) -> Column:
    """For each (name, cell) the reason if the cell is bad, else NULL."""
    return F.transform(pairs, lambda p: F.when(
        F.coalesce(bad(p["cell"]), F.lit(False)), _reason(p["name"], p["cell"], reason)))


def _bad_counts(source: WideSource, kinds: Mapping[str, str]) -> Column:
    """Reasons of the count cells; only lines that do not look plain are split for them."""
    columns = source.layout.count_columns(dict(kinds))
    places = F.array(*[F.lit(c.position) for c in columns])
    names = F.array(*[F.lit(c) for c in source.layout.columns])

    def reasons(cells: Column) -> Column:
        def judged(place: Column) -> Column:
            cell = F.get(cells, place)
            negative = F.coalesce(clean.number_or_null(cell) < 0, F.lit(False))
            return F.when(clean.bad_count(cell) | negative, _reason(
                F.get(names, place), cell, F.when(negative, F.lit(NEGATIVE)).otherwise(F.lit(COUNT))))

        return F.array_compact(F.transform(places, judged))

    return F.when(source.has_odd_counts(dict(kinds)),
                  reshape.bind(split_record(F.col("value")), reasons))


def verdicts(source: WideSource, cell_checks: Sequence[CellCheck],
             kinds: Mapping[str, str] = {}) -> DataFrame:
    """Lines with at least one reason: order columns, kind, dropped, reasons, line."""
    layout, lines = source.layout, source.lines
    present = [c for c in cell_checks if layout.position(c.column) is not None]
    positions = {c: layout.position(c) for c in (*KEY_CELLS[source.kind], *[c.column for c in present])}
    limit = max(positions.values()) + 2
    whole = F.col("n_fields") == layout.width
    split = lines.withColumn("cells", F.when(whole, split_record(F.col("value"), limit)))

    def cell(column: str) -> Column:
        return cell_at(F.lit(positions[column]))

    found = [F.when(~whole, _reason("", F.col("n_fields"), WIDTH))]
    if not any(c.key for c in present):  # else these name the part that is unusable
        key = F.concat_ws("|", *[cell(c) for c in KEY_CELLS[source.kind]])
        found.append(F.when(whole & F.col("row_id").isNull(),
                            _reason("|".join(KEY_CELLS[source.kind]), key, KEY)))
    lists = [F.array(*found)]
    # One pass over all cells of the same check: a line's width does not make the plan longer.
    for bad, reason in dict.fromkeys((c.bad, c.reason) for c in present):
        pairs = F.array(*[F.struct(F.lit(c.column).alias("name"), cell(c.column).alias("cell"))
                          for c in present if (c.bad, c.reason) == (bad, reason)])
        lists.append(F.when(whole, _judged(pairs, bad, reason)))
    if layout.count_columns(dict(kinds)):
        lists.append(F.when(whole, _bad_counts(source, kinds)))
    none = F.array().cast("array<struct<column_name: string, cell: string, reason: string>>")
    reasons = F.array_compact(F.concat(*[F.coalesce(found, none) for found in lists]))
    # Exploding none or one list of reasons judges each line once; a filter would do it twice.
    return split.select(
        *ORDER_COLUMNS, F.lit(source.kind).alias("kind"),
        (~whole | F.col("row_id").isNull()).alias("dropped"),
        F.explode(F.filter(F.array(reasons), lambda r: F.size(r) > 0)).alias("reasons"),
        F.col("value").alias("line"))


def rejects(source: WideSource, cell_checks: Sequence[CellCheck],
            kinds: Mapping[str, str] = {}) -> DataFrame:
    """`verdicts` with the number of the line in its file (the first data line is 1)."""
    numbered = with_row_numbers(source.lines, verdicts(source, cell_checks, kinds))
    return numbered.select("kind", "src_file", "row_number", "dropped", "reasons", "line")


def reason_rows(rejected: DataFrame) -> DataFrame:
    """One row for each reason of each rejected line."""
    return rejected.select("kind", "src_file", "row_number", "dropped", F.inline("reasons"))


LABELS = {"draft": "malformed pick cells", "game": "malformed game cells",
          "replay": "malformed replay cells"}


def findings(rejected: DataFrame, kind: str) -> DataFrame:
    """Findings of one source: lines of another width, unreadable times (which become NULL and
    stop no build), and other reasons."""
    rows = reason_rows(rejected.where(F.col("kind") == kind))
    width, time = F.col("reason") == WIDTH, F.col("reason") == TIME
    return checks.combine([
        checks.finding(rows.where(width), "rows with a wrong field count", "fatal", kind),
        checks.finding(rows.where(time), "unreadable times", "warn", kind),
        checks.finding(rows.where(~width & ~time), LABELS[kind], "fatal", kind)])


def examples(rejected: DataFrame, n: int = checks.SAMPLE) -> list[str]:
    """The first rejected cells in source order, for messages."""
    rows = checks.stable_sample(reason_rows(rejected), ["kind", "src_file", "row_number", "column_name"], n)
    return [f"{r.kind} row {r.row_number} of {r.src_file}: {r.reason}"
            + (f" in {r.column_name}: {r.cell!r}" if r.column_name else f": {r.cell}")
            for r in rows.collect()]

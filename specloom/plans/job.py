"""The whole job: stale work -> fragments -> sheets -> mapping -> device records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.operators import guard, mapping, reshape
from specloom.operators import tables as T
from specloom.operators.joins import shuffled
from specloom.operators.mapping import Rule
from specloom.session import stable
from specloom.sources.store import Store


class Outcome:
    """Device records, and what is left out, planned when asked for.

    quarantine: texts that did not fit their field (sheet_id, col_idx, path, raw). unplaced, unresolved:
    added cells and fixed spans whose names were not found, None where none were given; uneven: sheet_id,
    row_id and reason of the rows left out as their cells do not fit the columns.
    """

    def __init__(self, filled: DataFrame, sheets: list[T.Sheets], on_error: str):
        self._filled, self._sheets, self._on_error = filled, sheets, on_error

    def _both(self, kind: str) -> DataFrame | None:
        frames = [getattr(s, kind) for s in self._sheets]
        return None if frames[0] is None else reduce(DataFrame.unionByName, frames)

    @cached_property
    def records(self) -> DataFrame:
        records = mapping.typed_records(self._filled, on_error=self._on_error)
        if self._on_error != guard.STOP:
            return records
        told = {"unplaced": ("added cell", "row_text"), "unresolved": ("fixed span", "row_text"), "uneven": ("row", "reason")}
        for kind, (what, column) in told.items():
            rejects = getattr(self, kind)
            if rejects is not None:
                message = F.concat_ws(" ", F.lit("sheet"), F.col("sheet_id").cast("string"), F.lit(f"{what}:"), column)
                records = guard.stop_on_rejects(records, rejects, message)
        return records

    @cached_property
    def quarantine(self) -> DataFrame:
        return mapping.quarantine(self._filled)

    @cached_property
    def unplaced(self) -> DataFrame | None:
        return self._both("unplaced")

    @cached_property
    def unresolved(self) -> DataFrame | None:
        return self._both("unresolved")

    @cached_property
    def uneven(self) -> DataFrame:
        return self._both("uneven")


def device_records(fragments: DataFrame, config: DataFrame, rulesets: dict[str, Sequence[Rule]], **options) -> DataFrame:
    """The records alone."""
    return device_outcome(fragments, config, rulesets, **options).records


def device_outcome(
    fragments: DataFrame,
    config: DataFrame,
    rulesets: dict[str, Sequence[Rule]],
    *,
    stale: DataFrame | None = None,
    fixed: DataFrame | None = None,
    joiners: DataFrame | None = None,
    added: DataFrame | None = None,
    columns: int | None = None,
    strict: bool = False,
    on_error: str | None = None,
) -> Outcome:
    """Device records of all sheets at once.

    stale: sheet_id of the work to do (all when absent). config may carry `ruleset`. on_error: a bad value
    is set aside (`quarantine`), loses its sheet (`drop`, also strict=True), or, like a name that is not
    found and a row that does not fit, fails every job that reads the records (`stop`).
    """
    if stale is not None:
        config = stable(config.join(shuffled(stale.select("sheet_id").distinct()), "sheet_id", "left_semi"))
        fragments = T.per_sheet(fragments, config.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_semi", bounded_by=config)
    made, parts = [], []
    for some, settings, hot in T.split_hot(fragments, config):
        made.append(T.sheet_outcome(some, settings, fixed=fixed, joiners=joiners, added=added, hot=hot))
        parts.append((T.spec_cells(made[-1].cells, hot=hot, rows=made[-1].fragments), hot))
    if columns is None:
        columns = max(reshape.column_count(cells) for cells, _ in parts)
    rows = reduce(DataFrame.unionByName, [reshape.sheet_rows(reshape.long_to_wide(cells, columns), columns, hot=hot) for cells, hot in parts])
    if "ruleset" in config.columns:
        rows = T.per_sheet(rows, config.select("sheet_id", "ruleset"), ["sheet_id"])
    else:
        rows = rows.withColumn("ruleset", F.lit(next(iter(rulesets))))
    return Outcome(mapping.fill_sheets(rows, rulesets), made, on_error or (guard.DROP if strict else guard.QUARANTINE))


def publish_devices(store: Store, fragments: DataFrame, config: DataFrame, rulesets: dict[str, Sequence[Rule]], inputs: DataFrame, **options) -> int:
    """One repeatable run of the whole job into a store of device records named by sheet_id and file_name.

    inputs: sheet_id and input_time, the newest change of what a sheet is made from. Sheets that were done
    after that are left alone, the others are made again; a record that is there already stays as it is.
    The number of records published.
    """

    def make(due: DataFrame) -> DataFrame:
        records = device_records(fragments, config, rulesets, stale=due, **options)
        return mapping.first_writer(records).select(*store.schema.names)

    return store.run(inputs, make)

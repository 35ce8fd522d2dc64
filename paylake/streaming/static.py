"""CSV -> static tables, in two batch steps.

A load that replaces another one logs the rows that differ, for the Gold job.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from paylake.functions.scalars import transform_static
from paylake.operators import quality
from paylake.sources.static import read_csv, read_text_csv, typed, unreadable_cells
from paylake.sources.tables import Lake
from paylake.specs import static_for_table
from paylake.streaming import moves
from paylake.streaming.parallel import run_together


def ingest(lake: Lake, paths: Mapping[str, str], infer: bool = False) -> None:
    """Load each dataset's CSV into its raw table: all columns of the file, as text by default."""

    def load(name: str, path: str) -> None:
        spec = static_for_table(name)
        rows = read_csv(lake.spark, path) if infer else read_text_csv(lake.spark, path)
        lake.keyed("bronze", name, spec.keys).overwrite(rows)

    run_together(lake.spark, [partial(load, name, path) for name, path in paths.items()])


def process(lake: Lake, names: list[str]) -> None:
    """Type the raw tables, refuse unreadable cells and repeated keys, replace the state tables."""

    def replace(name: str) -> None:
        spec = static_for_table(name)
        raw = lake.keyed("bronze", name, spec.keys).read()
        rows = typed(transform_static(raw), spec.schema)
        quality.refuse_unreadable(name, unreadable_cells(raw, spec.schema).first().asDict())
        quality.refuse_duplicates(name, quality.count_duplicates(rows, spec.keys))
        table = lake.keyed("silver", name, spec.keys, spec.schema)
        moves.record_load(lake, spec, table, rows)
        table.overwrite(rows)

    run_together(lake.spark, [partial(replace, name) for name in names])

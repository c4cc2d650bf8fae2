"""Variables on grids of their own within one member.

A temperature has levels, a surface flux has none, and the coefficients of the levels have nothing
but levels. Merged under one row key, each would fill the others' rows with NULL. Here every grid is
a table of its own, keyed by the coordinates that its variables really have, and grids are joined
only where variables of several are asked for together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isospread.operators import merge
from isospread.sources.storage import broadcast_if_small, settle

MEMBERS = (merge.MEMBER, merge.MEMBER_NUMBER)
#: Coordinates that every variable has unless cells say otherwise.
HORIZONTAL = ("time", "lat", "lon")


class Grid(NamedTuple):
    coordinates: tuple[str, ...]
    variables: tuple[str, ...]
    table: DataFrame


class GridCube:
    """The variables of all members, one table for each grid."""

    def __init__(self, grids: Sequence[Grid]):
        self.grids = list(grids)

    @property
    def columns(self) -> list[str]:
        """The columns of all grids together, in the order of their first appearance."""
        return list(dict.fromkeys(c for g in self.grids for c in g.table.columns))

    def whole(self) -> DataFrame | GridCube:
        """The table of the only grid, or this cube if there are several."""
        return self.grids[0].table if len(self.grids) == 1 else self

    def transform(self, function: Callable, *args: object, **kwargs: object) -> object:
        return function(self, *args, **kwargs)

    def map(self, function: Callable[[DataFrame], DataFrame], needs: Sequence[str] = ()) -> GridCube:
        """The cube with ``function`` applied to each grid that has the columns in ``needs``."""
        return GridCube(
            [
                g._replace(table=function(g.table)) if set(needs) <= set(g.table.columns) else g
                for g in self.grids
            ]
        )

    def grid_of(self, variable: str) -> Grid:
        for grid in self.grids:
            if variable in grid.variables:
                return grid
        raise ValueError(f"no variable {variable!r}; there are {self.columns}")

    def select(self, *variables: str) -> DataFrame:
        """A table of the given variables on the grid of the one with most coordinates.

        Variables of smaller grids are repeated along the coordinates that they lack, and are NULL
        where their grid has no such cell. The widest grid must have all coordinates of the others:
        no product of unrelated coordinates is made. A grid without a place on the map, such as a
        value per level, is settled and broadcast if it is small; others are joined by shuffle.
        """
        used = [g for g in self.grids if set(g.variables) & set(variables)]
        for v in variables:
            self.grid_of(v)
        base, *others = sorted(used, key=lambda g: -len(g.coordinates))
        keys = [c for c in base.table.columns if c not in base.variables]
        out = base.table.select(*keys, *(v for v in base.variables if v in variables))
        for grid in others:
            shared = [c for c in grid.table.columns if c not in grid.variables]
            if not set(shared) <= set(keys):
                raise ValueError(
                    f"{grid.variables} lie on {shared}, which {base.variables} on {keys} lack; "
                    "ask for a variable that has all of these coordinates"
                )
            part = grid.table.select(*shared, *(v for v in grid.variables if v in variables))
            if not {"lat", "lon"} & set(shared):
                part = broadcast_if_small(settle(part))
            out = out.join(part, shared, "left")
        return out.select(*keys, *variables)

    def stacked(self) -> DataFrame:
        """All grids below each other as one table, with NULL for coordinates that a grid lacks."""
        tables = [g.table for g in self.grids]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def coordinates_by_variable(cells: DataFrame, variables: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The coordinates that each variable has in any of its cells: one pass over the coordinate
    columns that combines a bitmap of them before the shuffle, and one row for each variable."""
    names = [c for c in merge.coordinates(cells) if c not in MEMBERS]
    bits = [F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(0) for i, c in enumerate(names)]
    present = reduce(lambda a, b: a.bitwiseOR(b), bits)
    rows = (
        cells.where(F.col("var").isin(*variables))
        .groupBy("var")
        .agg(F.bit_or(present).alias("present"))
        .collect()
    )
    found = {r["var"]: tuple(c for i, c in enumerate(names) if r.present >> i & 1) for r in rows}
    # a variable without cells is NULL wherever the widest grid has cells
    widest = max(found.values(), key=len, default=tuple(names))
    return {v: found.get(v, widest) for v in variables}


def merge_grids(
    cells: DataFrame,
    variables: Sequence[str],
    mode: str = "no_conflicts",
    names: DataFrame | None = None,
    coordinates: Mapping[str, Sequence[str]] | None = None,
) -> GridCube:
    """Merge cells by variable, each grid under its own coordinates.

    ``coordinates`` says which ones each variable has. Without it they are looked up, unless the
    cells have no coordinates beside time, latitude and longitude: then all share one grid. Each
    grid's cells are scanned and shuffled once, and by no coordinate that they lack.
    """
    every = [c for c in merge.coordinates(cells) if c not in MEMBERS]
    if coordinates is None and set(every) <= set(HORIZONTAL):
        coordinates = dict.fromkeys(variables, every)
    if coordinates is None:
        coordinates = coordinates_by_variable(cells, variables)
    together: dict[tuple[str, ...], list[str]] = {}
    for v in variables:
        together.setdefault(tuple(c for c in every if c in coordinates[v]), []).append(v)
    grids = []
    for kept, some in together.items():
        part = cells.where(F.col("var").isin(*some)).drop(*(c for c in every if c not in kept))
        grids.append(Grid(kept, tuple(some), merge.merge(part, some, mode, names)))
    return GridCube(grids)

"""One declared reference graph: load order, violations and cascades follow from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.operators.joins import foreign_keys


@dataclass(frozen=True)
class Reference:
    """``child.column`` names a row of ``parent`` by its ``key``; with ``cascade`` the child goes when the parent does."""

    child: str
    column: str
    parent: str
    key: str
    cascade: bool = True


class Graph:
    """References between tables, which form no cycle."""

    def __init__(self, references: Sequence[Reference]):
        self.references = list(references)
        sorter = TopologicalSorter()
        for r in self.references:
            sorter.add(r.child, r.parent)
        self.order = list(sorter.static_order())

    def load_order(self) -> list[str]:
        """Parents before their children."""
        return self.order

    def violations(self, tables: dict[str, DataFrame]) -> DataFrame:
        """``relation, key, n_rows`` of references to no row; each child is read once, NULLs reference nothing."""
        found = []
        for child in self.order:
            own = [(f"{r.child}.{r.column}", r.column, tables[r.parent], r.key) for r in self.references if r.child == child and child in tables]
            if own:
                found.append(foreign_keys(tables[child], own))
        return reduce(DataFrame.unionByName, found)

    def purge(self, tables: dict[str, DataFrame], removed: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Survivors of every table when the ``removed`` rows go and all that hangs below them with cascade.

        What goes is followed from parents to children, so each join has the removed keys on its small side, and tables
        below which nothing changes stay as they are. Rows that reference nothing, or a row that never was, stay.
        """
        gone: dict[str, DataFrame] = {}
        kept: dict[str, DataFrame] = {}
        for name in self.order:
            table = tables[name]
            marks = [removed[name].distinct()] if name in removed else []
            for r in self.references:
                if r.child == name and r.cascade and r.parent in gone:
                    marks.append(gone[r.parent].select(F.col(r.key).alias(r.column)).where(F.col(r.column).isNotNull()).distinct())
            for mark in marks:
                table = table.join(mark, mark.columns, "left_anti")
            kept[name] = table.select(*tables[name].columns)
            if marks:
                lost = [tables[name].join(mark, mark.columns, "left_semi").select(*tables[name].columns) for mark in marks]
                gone[name] = reduce(DataFrame.union, lost)
        return kept


#: The catalog's own references.
CATALOG = Graph([
    Reference("architecture", "vendor_id", "vendor", "vendor_id", cascade=False),
    Reference("chip", "vendor_id", "vendor", "vendor_id", cascade=False),
    Reference("chip", "architecture_id", "architecture", "architecture_id", cascade=False),
    Reference("memory", "memory_type_id", "memory_type", "memory_type_id", cascade=False),
    Reference("memory", "chip_id", "chip", "chip_id"),
    Reference("features", "chip_id", "chip", "chip_id"),
    Reference("variant", "chip_id", "chip", "chip_id"),
    Reference("observation", "variant_id", "variant", "variant_id"),
])

"""What to load from where: one entry per source table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

DELTA = "delta"
SNAPSHOT = "snapshot"


@dataclass(frozen=True)
class TableSpec:
    """A source table; ``key`` and ``changed_at`` are needed for delta loads only.

    ``also_to`` names further zones that receive every batch of a delta table.
    """

    name: str
    mode: str = SNAPSHOT
    key: str | None = None
    changed_at: str | None = None
    database: str | None = None
    also_to: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.mode not in (DELTA, SNAPSHOT):
            raise ValueError(f"{self.name}: unknown mode {self.mode}")
        if self.mode == DELTA and not self.changed_at:
            raise ValueError(f"{self.name}: a delta table needs a change column")


def catalog(
    tables: Iterable[str],
    snapshots: Iterable[str],
    columns: dict[str, tuple[str, str]],
    databases: dict[str, str] | None = None,
) -> list[TableSpec]:
    """Route every table: those in ``snapshots`` are copied whole, the others need key and change column.

    Names listed as snapshots but not loaded are an error, so a catalog cannot drift silently.
    """
    tables, snapshots = list(tables), set(snapshots)
    unknown = sorted(snapshots - set(tables))
    if unknown:
        raise ValueError(f"snapshot tables that are never loaded: {unknown}")
    specs = []
    for name in tables:
        key, changed_at = columns.get(name, (None, None))
        mode = SNAPSHOT if name in snapshots else DELTA
        specs.append(TableSpec(name, mode, key, changed_at, (databases or {}).get(name)))
    return specs

"""Table names by environment."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from adstrata.sources.tables import TableRef


@dataclass(frozen=True)
class Environment:
    """The tables of one environment. `location` is a folder for them; without it the warehouse's is used."""

    database: str
    raw_table: str
    tracking_table: str
    links_table: str = "video_links"
    timeouts_table: str = "page_timeouts"
    media_loads_table: str = "media_loads"
    codes_table: str = "verification_codes"
    runs_table: str = "ingest_runs"
    location: str | None = None
    log_level: str = "INFO"

    def table(self, name: str) -> TableRef:
        location = f"{self.location.rstrip('/')}/{name}" if self.location else None
        return TableRef(f"{self.database}.{name}", location)

    @property
    def raw(self) -> TableRef:
        return self.table(self.raw_table)

    @property
    def tracking(self) -> TableRef:
        return self.table(self.tracking_table)

    @property
    def links(self) -> TableRef:
        return self.table(self.links_table)

    @property
    def timeouts(self) -> TableRef:
        return self.table(self.timeouts_table)

    @property
    def media_loads(self) -> TableRef:
        return self.table(self.media_loads_table)

    @property
    def codes(self) -> TableRef:
        return self.table(self.codes_table)

    @property
    def runs(self) -> TableRef:
        return self.table(self.runs_table)


def load_environment(path: str, name: str | None = None) -> Environment:
    """One environment of a JSON file that maps names to settings; `ENV` (or dev) when no name is given."""
    with open(path, encoding="utf-8") as file:
        environments = json.load(file)
    name = name or os.getenv("ENV", "dev")
    if name not in environments:
        raise ValueError(f"unknown environment {name!r}")
    return Environment(**environments[name])

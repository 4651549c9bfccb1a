"""What a run did."""

from __future__ import annotations

from enum import Enum


class IngestStatus(Enum):
    """Outcome of a load or of making a table."""

    # The texts callers match on.
    NO_DATA_AVAILABLE = "No data available for ingestion."
    DATA_INSERTED = "Data inserted successfully."
    INCOMPLETE_INSERTION = "Insertion attempted, but no new rows were added."
    NO_NEW_UPDATES = "No new updates found; all ads are already up-to-date."
    TABLE_EXISTS = "Table already exists."
    TABLE_CREATED = "Table created successfully."
    TABLE_CREATION_FAILED = "Table creation failed."


class RefreshMode(str, Enum):
    """Which creatives a refresh covers."""

    # The words callers pass.
    ALL = "all"
    SPECIFIC = "specific"

"""Storing and deleting verification codes."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from adstrata.schemas import CODE_SCHEMA
from adstrata.sources.rewrite import delete_keys, finish_rewrites
from adstrata.sources.tables import TableRef, append

log = logging.getLogger(__name__)


def store_codes(codes: DataFrame, table: TableRef) -> bool:
    """Append codes; False (and nothing stored) when that fails."""
    try:
        append(codes, table, CODE_SCHEMA)
    except Exception:
        log.exception("could not store codes in %s", table.name)
        return False
    return True


def store_code(
    spark: SparkSession, table: TableRef, email: str, verification_code: str, created_at: datetime | None = None
) -> bool:
    """Append one code, made now unless told otherwise."""
    row = (email, verification_code, created_at or datetime.now(timezone.utc))
    return store_codes(spark.createDataFrame([row], "email string, verification_code string, created_at timestamp"), table)


def stored_codes(spark: SparkSession, table: TableRef) -> DataFrame:
    """The stored codes. A delete that stopped half-way is finished first."""
    finish_rewrites(spark, table)
    return table.read_anew(spark)


def forget_codes(emails: DataFrame, table: TableRef) -> int:
    """Delete the codes of the given addresses; returns how many files were rewritten.

    Only files that hold such a code are written anew; all others stay as they are, under their names. A NULL address
    deletes nothing. See `delete_keys` for what happens when it stops half-way.
    """
    return delete_keys(table, emails.select("email"), "email")

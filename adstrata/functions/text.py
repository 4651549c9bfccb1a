"""Text shape checks."""

from __future__ import annotations

from pyspark.sql import Column

# Fixed value: the e-mail shape. One final line feed is allowed, as `$` does in Python.
EMAIL_SHAPE = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+\n?\z"


def is_email(text: Column) -> Column:
    return text.rlike(EMAIL_SHAPE)

"""Versioned loading of public advertising creatives, as Spark DataFrame jobs."""

"""Staging view and mart over the raw table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.functions.dates import parse_day
from adstrata.schemas import RECORD_FIELDS
from adstrata.sources.tables import TableRef


def record_schema(source_schema: T.StructType) -> T.StructType:
    """The types of the serialised record, taken from the source table."""
    return T.StructType([source_schema[name] for name in RECORD_FIELDS])


# What the mart needs of a record; the other fields are not parsed for it.
MART_FIELDS = ("advertiser_id", "creative_id", "ad_format_type", "region_stats")


def staging(raw: DataFrame, schema: T.StructType, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """The stored texts parsed back to typed columns, with the market's first and last day if there are regions.

    Any table of JSON texts will do, given the schema of its records.
    """
    wanted = T.StructType([schema[name] for name in fields])
    typed = raw.select(
        "data_modified", "metadata_time", F.from_json("raw_data", wanted).alias("record")
    ).select("data_modified", "metadata_time", "record.*")
    if "region_stats" not in fields:
        return typed
    entry = F.get("region_stats", F.lit(0))
    return typed.withColumns(
        {
            "first_shown_date": parse_day(entry["first_shown"], strict=False),
            "last_shown_date": parse_day(entry["last_shown"], strict=False),
        }
    )


def record_shape(raw: DataFrame) -> str:
    """The shape of a source's stored records, as DDL; a field of several types is a VARIANT in it."""
    return raw.agg(F.schema_of_variant_agg(F.try_parse_json("raw_data")).alias("shape")).first()["shape"]


def _exact(value: Column, kind: str) -> Column:
    """A VARIANT as a type, NULL where that would change it: 2.5 is no bigint, and 3 no string."""
    typed, shape = F.try_variant_get(value, "$", kind), F.schema_of_variant(value)
    if kind in ("double", "float"):
        same = shape.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(shape, F.lit("DECIMAL"))
    elif kind == "string":
        same = shape == "STRING"
    else:
        same = F.to_json(F.struct(typed.alias("v"))) == F.concat(F.lit('{"v":'), F.to_json(value), F.lit("}"))
    return F.when(same, typed)


def variant_staging(raw: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Stored texts of a source whose schema isn't given, as typed columns.

    `fields` gives each column's type. Nothing is lost where a record doesn't follow: a value of another type is NULL in its
    column and stands in `misfits` (names to JSON), fields that aren't asked for stand in `others`, and a text that isn't a JSON
    object in `unparsed`.
    """
    record = F.col("_record")
    parsed = raw.select("data_modified", "metadata_time", "raw_data", F.try_parse_json("raw_data").alias("_record"))
    whole = F.try_variant_get(record, "$", "map<string,variant>")
    parsed = parsed.withColumn("_fields", whole)
    found = {name: F.get(F.array(F.col("_fields")[name]), F.lit(0)) for name in fields}
    typed = {name: _exact(found[name], kind) for name, kind in fields.items()}
    missed = [
        F.when(found[name].isNotNull() & ~F.is_variant_null(found[name]) & typed[name].isNull(), F.struct(F.lit(name), F.to_json(found[name])))
        for name in fields
    ]
    rest = F.map_filter("_fields", lambda name, _: ~name.isin(list(fields)))
    return parsed.select(
        "data_modified",
        "metadata_time",
        *[value.alias(name) for name, value in typed.items()],
        F.map_from_entries(F.filter(F.array(*missed), lambda entry: entry.isNotNull())).alias("misfits"),
        F.transform_values(rest, lambda _, value: F.to_json(value)).alias("others"),
        F.when(F.col("_fields").isNull(), F.col("raw_data")).alias("unparsed"),
    )


def creatives_mart(staged: DataFrame) -> DataFrame:
    """Per advertiser and format: creatives, versions, first and last day shown, and the days they span."""
    first, last = F.min("first_shown_date"), F.max("last_shown_date")
    return staged.groupBy("advertiser_id", "ad_format_type").agg(
        F.countDistinct("creative_id").alias("creatives"),
        F.count(F.lit(1)).alias("versions"),
        first.alias("first_shown_date"),
        last.alias("last_shown_date"),
        (F.datediff(last, first) + 1).cast("long").alias("active_days"),
    )


def publish_staging(raw: DataFrame, schema: T.StructType, view: str) -> None:
    """Staging is a view: nothing is stored."""
    staging(raw, schema).createOrReplaceTempView(view)


def publish_mart(mart: DataFrame, table: TableRef) -> None:
    """Marts are tables, replaced on each run."""
    writer = mart.write.format("parquet").mode("overwrite")
    if table.location:
        writer = writer.option("path", table.location)
    if "." in table.name:
        mart.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {table.name.rsplit('.', 1)[0]}")
    writer.saveAsTable(table.name)

"""Video links of creative pages, and advertiser ids of landing links."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.functions.links import url_segment
from adstrata.operators.media import counters, links, page_outcomes, pages_to_read, timeouts
from adstrata.operators.projection import lower_case_columns
from adstrata.operators.required import enforce
from adstrata.schemas import COMMIT_SCHEMA, LINK_SCHEMA, LOAD_COLUMN, LOADED_LINK_SCHEMA
from adstrata.session import stage
from adstrata.sources.commits import Commits, checked_load_id
from adstrata.sources.tables import TableRef

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MediaResult:
    total_rows: int
    total_urls_processed: int
    successful_scrapes: int
    timeouts_inserted: int


@dataclass(frozen=True)
class MediaTables:
    """The tables of the media job, and the table of its commits, which tells what of the other two counts."""

    links: TableRef
    timeouts: TableRef
    loads: TableRef

    @property
    def commits(self) -> Commits:
        return Commits(self.loads, COMMIT_SCHEMA)

    def create(self, spark: SparkSession) -> None:
        for table in (self.links, self.timeouts):
            if not table.exists(spark):
                table.create(spark, LOADED_LINK_SCHEMA, LOAD_COLUMN)
        self.commits.create(spark)

    def read_links(self, spark: SparkSession) -> DataFrame:
        return self.commits.rows_of(self.links, spark)

    def read_timeouts(self, spark: SparkSession) -> DataFrame:
        return self.commits.rows_of(self.timeouts, spark)

    def result_of(self, spark: SparkSession, load_id: str) -> MediaResult | None:
        """What a load counted; None as long as it is not committed."""
        row = self.commits.of(spark, load_id)
        return row and MediaResult(**{name: row[name] for name in MediaResult.__dataclass_fields__})

    def sweep(self, spark: SparkSession) -> list[str]:
        """Remove what loads without a commit left behind, and return their ids. No load may be running."""
        return self.commits.sweep(spark, (self.links, self.timeouts))


def load_id_of(outcomes: DataFrame) -> str:
    """An id for a load by what is in it: the same rows, in any order, have the same id; any other rows another one."""
    text = F.to_json(F.struct(*outcomes.columns), {"ignoreNullFields": "false"})
    sums = [F.sum(F.xxhash64(F.lit(seed), text).cast("decimal(38,0)")).alias(f"s{seed}") for seed in range(2)]
    found = outcomes.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    return f"{found.n}-" + "-".join(f"{int(found[f's{seed}'] or 0) % 2**64:016x}" for seed in range(2))


def media_links_job(
    spark: SparkSession,
    pages: DataFrame,
    tables: MediaTables,
    advertiser_id: str | None = None,
    load_id: str | None = None,
) -> MediaResult:
    """Route the pages of one advertiser, or of all, to the table of links or the table of timeouts.

    The HTML is read once: the outcomes, without it, are staged, and both tables and the counters are
    filled from them. A load that is committed already adds nothing and returns what it counted; one that failed half-way is
    written again. Loads are told apart by `load_id`, or else by their outcomes, so the same pages count once.
    """
    tables.create(spark)
    if load_id is not None and checked_load_id(load_id) and (known := tables.result_of(spark, load_id)) is not None:
        return known
    outcomes = stage(page_outcomes(pages_to_read(lower_case_columns(pages), advertiser_id)), "outcomes")
    load_id = load_id or load_id_of(outcomes)
    known = tables.result_of(spark, load_id)
    if known is not None:
        log.info("load %s was committed before", load_id)
        return known
    required = [f.name for f in LINK_SCHEMA.fields if not f.nullable]
    for rows, table in ((links(outcomes), tables.links), (timeouts(outcomes), tables.timeouts)):
        tables.commits.write(enforce(rows, required), table, LOADED_LINK_SCHEMA, load_id)
    counted = counters(outcomes).first()
    tables.commits.add(spark, load_id, *counted)
    return MediaResult(**counted.asDict())


def advertiser_ids_of_links(urls: DataFrame, column: str = "url") -> DataFrame:
    """Each URL with the advertiser id in its path; NULL when the path is too short."""
    return urls.withColumn("advertiser_id", url_segment(F.col(column), 4))

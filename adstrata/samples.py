"""The jobs' input tables, derived by Spark from the given test tables.

The shapes are those of FIXTURES.md. The source table and the raw table are written to the shared folder
once per application, because in use they are stored tables too.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.operators.projection import market_records, raw_rows
from adstrata.operators.selection import listed
from adstrata.operators.versions import new_versions
from adstrata.schemas import PARTITION_COLUMN, RAW_SCHEMA
from adstrata.session import staging_path
from adstrata.sources.tables import laid_out, with_partition

MARKET = "EUROPE"
HISTORY_TIME = datetime(2024, 1, 1, tzinfo=timezone.utc)
REFRESH_TIME = datetime(2024, 2, 1, tzinfo=timezone.utc)

# Handles on tables of this application, so that their files are listed once.
_open: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def _opened(spark: SparkSession, sf_dir: str, name: str, locate: Callable[[], str]) -> tuple[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _open or _open[key][1].sparkSession is not spark:
        path = _open[key][0] if key in _open else locate()
        reader = spark.read.schema(RAW_SCHEMA) if name.startswith("raw_") else spark.read
        _open[key] = path, reader.parquet(path)
    return _open[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _opened(spark, sf_dir, name, lambda: f"{sf_dir}/{name}.parquet")[1]


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> tuple[str, DataFrame]:
    """A derived table, written the first time it is asked for."""

    def write() -> str:
        path = staging_path(spark, name)
        rows = build()
        writer = rows.write.partitionBy(PARTITION_COLUMN) if PARTITION_COLUMN in rows.columns else rows.write
        writer.parquet(path)
        return path

    return _opened(spark, sf_dir, name, write)


def _padded(prefix: str, number: str | Column) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 20, "0"))


def _build_creative_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    regions = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = regions.select("n_nationkey", "r_name")
    places = read("supplier").join(regions, F.col("s_nationkey") == F.col("n_nationkey"))
    per_region = (
        read("lineitem")
        .join(places.select("s_suppkey", "r_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey", "r_name")
        .agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    )
    # At most one entry per region and order.
    entry = F.struct(
        F.col("r_name").alias("region_code"),
        F.date_format("first", "yyyy-MM-dd").alias("first_shown"),
        F.date_format("last", "yyyy-MM-dd").alias("last_shown"),
    )
    stats = per_region.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("region_stats"))
    customers = read("customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    advertiser, creative = _padded("AR", "o_custkey"), _padded("CR", "o_orderkey")
    return (
        read("orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(stats, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            advertiser.alias("advertiser_id"),
            creative.alias("creative_id"),
            F.concat(F.lit("https://ads.example.com/advertiser/"), advertiser, F.lit("/creative/"), creative).alias(
                "creative_page_url"
            ),
            F.col("o_orderpriority").alias("ad_format_type"),
            F.col("c_name").alias("advertiser_disclosed_name"),
            F.when(F.col("o_custkey") % 7 != 0, F.col("c_name")).alias("advertiser_legal_name"),
            F.col("r_name").alias("advertiser_location"),
            F.col("o_orderstatus").alias("advertiser_verification_status"),
            F.col("c_mktsegment").alias("topic"),
            (F.col("o_orderkey") % 10 == 0).alias("is_funded_by_google_ad_grants"),
            "region_stats",
            F.struct(F.col("o_orderstatus").alias("approach")).alias("audience_selection_approach_info"),
        )
    )


def creative_stats_path(spark: SparkSession, sf_dir: str) -> str:
    return _stored(spark, sf_dir, "creative_stats", lambda: _build_creative_stats(spark, sf_dir))[0]


def creative_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "creative_stats", lambda: _build_creative_stats(spark, sf_dir))[1]


def advertisers_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 == 0)
    return customers.select(_padded("AR", "c_custkey").alias("advertiser_id"))


def segment_advertisers(spark: SparkSession, sf_dir: str, segment: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == segment)
    return customers.select(_padded("AR", "c_custkey").alias("advertiser_id"))


def priority_creatives(spark: SparkSession, sf_dir: str, priority: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == priority)
    return orders.select(_padded("CR", "o_orderkey").alias("creative_id"))


def _build_raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_rows(market_records(creative_stats(spark, sf_dir), MARKET), HISTORY_TIME)
    suffix = F.right("creative_id", F.lit(6)).cast("int")
    older = F.replace("raw_data", F.lit('"topic":"'), F.lit('"topic":"old-'))
    versions = rows.filter(suffix % 2 == 0).withColumn(
        "raw_data", F.when(suffix % 4 == 0, F.col("raw_data")).otherwise(older)
    )
    return laid_out(with_partition(versions, "month"))


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table before a run: unchanged, older and missing versions of today's records."""
    return _stored(spark, sf_dir, "raw_history", lambda: _build_raw_history(spark, sf_dir))[1]


def _build_raw_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = raw_history(spark, sf_dir)
    chosen = listed(creative_stats(spark, sf_dir), advertisers_tracking(spark, sf_dir))
    incoming = with_partition(raw_rows(market_records(chosen, MARKET), REFRESH_TIME), "month")
    return laid_out(history.unionByName(new_versions(incoming, history, also=[PARTITION_COLUMN])))


def raw_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after a refresh of all tracked advertisers."""
    return _stored(spark, sf_dir, "raw_versions", lambda: _build_raw_versions(spark, sf_dir))[1]


def creative_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages with planted frames: none, one, one behind another, no embed, not fetched."""
    number, html = F.col("page_id").cast("string"), F.col("html")
    case = F.col("page_id") % 5
    embed = F.lit('<iframe src="https://www.youtube.com/embed/')
    other = F.lit('<iframe src="https://player.example.com/x"></iframe>')
    end = F.lit('"></iframe>')
    return table(spark, sf_dir, "pages").select(
        "page_id",
        _padded("AR", F.col("page_id") % 20).alias("advertiser_id"),
        _padded("CR", "page_id").alias("creative_id"),
        F.when(F.col("page_id") % 17 != 0, F.col("url")).alias("creative_page_url"),
        F.when(case == 0, html)
        .when(case == 1, F.concat(html, embed, F.lit("v"), number, F.lit("?rel=0"), end))
        .when(case == 2, F.concat(html, other, embed, F.lit("w"), number, end))
        .when(case == 3, F.concat(html, F.lit('<iframe src="https://www.youtube.com/watch?v=q'), end))
        .alias("html"),
    )


#: Cases of `framed_pages`.
FRAME_FORMS = 12


def framed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages with a video's frame written in as many ways as pages do, shown or hidden, and pages with an empty address."""
    number, case = F.col("page_id").cast("string"), F.col("page_id") % FRAME_FORMS
    to = F.concat(F.lit("https://www.youtube.com/embed/f"), number)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    forms = [
        text('<iframe src="', to, '"></iframe>'),
        text("<IFRAME width=1 SRC='", to, "'></IFRAME>"),
        text("<iframe src=", to, " height=2></iframe>"),
        text('<iframe title="a > b src=x" src = "', to, '?a=1&amp;b=2"></iframe>'),
        text('<iframe src="//www.youtube.com/embed/f', number, '"></iframe>'),
        text('<!-- <iframe src="', to, '"></iframe> -->'),
        text('<script>let a = "<iframe src=', to, '></iframe>"</script><style><!--</style><iframe src="/none"></iframe>'),
        text("<textarea><iframe src='https://www.youtube.com/embed/hidden'></iframe></TEXTAREA ><iframe src='", to, "'></iframe>"),
        text('<iframe srcdoc="&lt;p&gt;&lt;iframe src=&quot;', to, '&quot;&gt;&lt;/iframe&gt;" src="/none"></iframe>'),
        text('<iframe data-src="', to, '" src="https://player.example.com/x"></iframe>'),
        text('<iframe src="https://player.example.com/x"></iframe> <script>'),
    ]
    html = F.coalesce(*[F.when(case == i, F.concat(F.lit("<p>x</p>"), form)) for i, form in enumerate(forms)], F.lit("<p></p>"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        _padded("AR", F.col("page_id") % 20).alias("advertiser_id"),
        _padded("CR", "page_id").alias("creative_id"),
        F.when(case == FRAME_FORMS - 1, "").otherwise(text("https://ads.example.com/", number)).alias("creative_page_url"),
        html.alias("html"),
    )


def _signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")


def _address(account: Column) -> Column:
    return F.concat(account, F.col("user_id").cast("string"), F.lit("@example.com"))


def failed_accounts(spark: SparkSession, sf_dir: str, since: str) -> DataFrame:
    """Addresses of accounts with an error from a given time on."""
    late = F.col("ts") >= F.lit(since).cast("timestamp_ntz")
    errors = table(spark, sf_dir, "events").filter((F.col("event_type") == "error") & late)
    return errors.select(_address(F.lit("user")).alias("email"))


def verification_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signups(spark, sf_dir).select(
        F.col("event_id").alias("code_id"),
        _address(F.lit("user")).alias("email"),
        (F.col("event_id") % 9000 + 1000).cast("string").alias("verification_code"),
        F.col("ts").alias("created_at"),
    )


def partial_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of which some lack the address or the code, by being NULL or empty."""
    case = F.col("attempt_id") % 9
    return verification_attempts(spark, sf_dir).withColumns(
        {
            "email": F.when(case == 1, "").when(case != 2, F.col("email")),
            "verification_code": F.when(case == 3, "").when(case != 4, F.col("verification_code")),
        }
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with an address each; some share one."""
    customers = table(spark, sf_dir, "customer")
    address = F.concat(F.lit("user"), (F.col("c_custkey") % 50).cast("string"), F.lit("@example.com"))
    return customers.select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("name"), address.alias("email"))


def verification_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    account = F.when(event % 11 == 0, "ghost").otherwise("user")
    return _signups(spark, sf_dir).select(
        event.alias("attempt_id"),
        _address(account).alias("email"),
        F.when(event % 3 == 0, "0000").otherwise((event % 9000 + 1000).cast("string")).alias("verification_code"),
        (F.col("ts") + F.make_dt_interval(mins=(event % 20).cast("int"))).alias("attempted_at"),
    )

from datetime import date, datetime, timezone

import pytest
from builders import MARKET, creative, source
from pyspark.sql import functions as F

from adstrata.functions.dates import as_day, is_day_text, look_back, parse_day, utc_day, utc_midnight, yesterday
from adstrata.functions.links import url_segment, video_frame, watch_url
from adstrata.functions.records import json_text, record_struct
from adstrata.functions.regions import market_entries, shown_in, single
from adstrata.functions.text import is_email

BAD_DAYS = ["2024-13-01", "2024-1-5", "", "2024-02-30", " 2024-01-05", "2024-01-5 ", "12024-01-05", "2024-01-05T00"]


def texts(values, expression, *rows):
    return values(expression, "t string", [(r,) for r in rows])


def test_parse_day(values):
    assert texts(values, parse_day(F.col("t")), "2024-01-05", None) == [date(2024, 1, 5), None]


def test_parse_day_lenient(values):
    assert texts(values, parse_day(F.col("t"), strict=False), *BAD_DAYS) == [None] * len(BAD_DAYS)


@pytest.mark.parametrize("bad", BAD_DAYS)
def test_parse_day_strict_fails(values, bad):
    with pytest.raises(Exception, match="not a yyyy-MM-dd date"):
        texts(values, parse_day(F.col("t")), bad)


def test_parse_day_does_not_depend_on_ansi_mode(spark, values):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a yyyy-MM-dd date"):
            texts(values, parse_day(F.col("t")), "2024-13-01")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_day_shape(values):
    assert texts(values, is_day_text(F.col("t")), "2024-01-05", "2024-1-5", "2024-01-05\n") == [True, False, False]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_utc_days_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = spark.createDataFrame([(date(1969, 12, 31),), (date(2024, 3, 31),), (date(2060, 1, 1),)], "d date")
        row = days.select("d", utc_midnight(F.col("d")).alias("t")).withColumn("back", utc_day(F.col("t")))
        assert all(r.d == r.back for r in row.collect())
        seconds = [r[0] for r in row.select(F.unix_seconds("t") % 86400).collect()]
        assert seconds == [0, 0, 0]
        month = row.select(utc_day(F.col("t"), "month")).collect()
        assert [r[0].day for r in month] == [1, 1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_windows():
    assert yesterday(date(2024, 3, 1)) == (date(2024, 2, 29), date(2024, 2, 29))
    assert look_back(date(2024, 3, 31)) == (date(2023, 12, 31), date(2024, 3, 30))


def test_as_day():
    assert as_day("2024-01-05") == as_day(date(2024, 1, 5)) == date(2024, 1, 5)
    for bad in ("2024-1-5", "2024-01-05\n", "", None, datetime(2024, 1, 5), "2024-13-01"):
        with pytest.raises(ValueError):
            as_day(bad)


REGIONS = "a array<struct<region_code:string,first_shown:string>>"


def test_shown_in_is_never_null(values):
    rows = [([("SE", "x")],), ([("NO", "x")],), ([("NO", "x"), None],), ([],), (None,), ([(None, "x")],)]
    assert values(shown_in(F.col("a"), "SE"), REGIONS, rows) == [True, False, False, False, False, False]


def test_single_entry(values):
    entry = single(market_entries(F.col("a"), "SE"))["first_shown"]
    rows = [([("NO", "n"), ("SE", "s")],), ([("NO", "n")],), (None,), ([],)]
    assert values(entry, REGIONS, rows) == ["s", None, None, None]


def test_two_entries(values):
    rows = [([("SE", "1"), ("SE", "2")],)]
    with pytest.raises(Exception, match="more than one entry"):
        values(single(market_entries(F.col("a"), "SE"))["first_shown"], REGIONS, rows)
    assert values(single(market_entries(F.col("a"), "SE"), strict=False)["first_shown"], REGIONS, rows) == [None]


def test_json_text_is_stable(spark):
    """The exact text is the version key: order, NULLs and nesting must not change."""
    rows = source(
        spark,
        creative(regions=(("NO", "2024-01-01", "2024-01-02"), (MARKET, "2024-01-05", None)), legal=None),
    )
    entries = market_entries(F.col("region_stats"), MARKET)
    text = rows.select(json_text(record_struct(entries))).first()[0]
    assert text == (
        '{"advertiser_id":"AR1","creative_id":"CR1",'
        '"creative_page_url":"https://ads.example.com/advertiser/AR1/creative/CR1","ad_format_type":"TEXT",'
        '"advertiser_disclosed_name":"Shown Name","advertiser_legal_name":null,"advertiser_location":"SE",'
        '"advertiser_verification_status":"VERIFIED","topic":"cars","is_funded_by_google_ad_grants":false,'
        '"region_stats":[{"region_code":"SE","first_shown":"2024-01-05","last_shown":null}],'
        '"audience_selection_approach_info":{"approach":"all"}}'
    )


def test_json_text_keeps_null_arrays(spark):
    text = source(spark, creative(regions=None)).select(json_text(record_struct(F.col("region_stats")))).first()[0]
    assert '"region_stats":null' in text


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_json_instants_are_utc(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        struct = F.struct(F.timestamp_seconds(F.lit(0)).alias("t"))
        assert spark.range(1).select(json_text(struct)).first()[0] == '{"t":"1970-01-01T00:00:00.000Z"}'
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_watch_url(values):
    got = texts(
        values,
        watch_url(F.col("t")),
        "https://www.youtube.com/embed/dQw4w9WgXcQ",
        "https://www.youtube.com/embed/dQw4w9WgXcQ?x=1&y=2",
        "https://www.youtube.com/embed/dQw4w9WgXcQ&y=2",
        "https://www.youtube.com/watch?v=q",
        "https://www.youtube.com/embed/",
        None,
    )
    assert got == ["https://www.youtube.com/watch?v=dQw4w9WgXcQ"] * 3 + [None] * 3


PAGE = "https://ads.example.com/p"
FRAMES = [
    (PAGE, "<p>none</p>", None),
    (PAGE, '<iframe src="https://www.youtube.com/embed/a?rel=0"></iframe>', "https://www.youtube.com/embed/a?rel=0"),
    (PAGE, "<IFRAME width=1\n SRC = 'https://www.youtube.com/embed/b'>", "https://www.youtube.com/embed/b"),
    (PAGE, '<iframe src="https://x.example/"></iframe><iframe id=v src="//youtube.com/embed/c">', "https://youtube.com/embed/c"),
    ("page", '<iframe src="//youtube.com/embed/c">', "//youtube.com/embed/c"),
    (PAGE, "<iframe width=1 src=https://youtube.com/embed/d height=2>", "https://youtube.com/embed/d"),
    (PAGE, '<iframe title="a > b" src="https://youtube.com/embed/e">', "https://youtube.com/embed/e"),
    (PAGE, """<iframe src="https://youtube.com/embed/f?t=it's">""", "https://youtube.com/embed/f?t=it's"),
    (PAGE, """<iframe title='a src="https://youtube.com/embed/1"' src=x>""", None),
    (PAGE, '<iframe title="' + "> " * 50_000 + '" src="https://youtube.com/embed/g">', "https://youtube.com/embed/g"),
    (PAGE, '<iframe src="https://youtube.com/embed/1"><iframe src="https://youtube.com/embed/2">', "https://youtube.com/embed/1"),
    (PAGE, '<!-- <iframe src="https://youtube.com/embed/1"> --><iframe src="https://youtube.com/embed/2">', "https://youtube.com/embed/2"),
    (PAGE, '<!-- a --><!-- <iframe src="https://youtube.com/embed/1">', None),
    (PAGE, 'stray --> <iframe src="https://youtube.com/embed/1">', "https://youtube.com/embed/1"),
    (PAGE, '<iframes src="https://youtube.com/embed/1">', None),
    (PAGE, '<iframe><a src="https://youtube.com/embed/1">', None),
    (PAGE, '<img src="https://youtube.com/x.png"><iframe src="https://x.example">', None),
    (PAGE, '<iframe src="https://x.example/?u=youtube.com">', "https://x.example/?u=youtube.com"),
    (PAGE, '<iframe data-src="https://youtube.com/embed/1">', None),
    (PAGE, '<a href="https://youtube.com/embed/1">', None),
    (PAGE, '<iframe src="https://YouTube.com/embed/1">', None),
    (PAGE, '<iframe src="https://youtube.com/embed/1?a=1&amp;b=2">', "https://youtube.com/embed/1?a=1&b=2"),
    ("https://www.youtube.com/watch?v=1", "<p>none</p>", "https://www.youtube.com/watch?v=1"),
    (PAGE, None, None),
]


@pytest.mark.parametrize("page, html, expected", FRAMES)
def test_video_frame(values, page, html, expected):
    assert values(video_frame(F.col("u"), F.col("h")), "u string, h string", [(page, html)]) == [expected]


def test_video_frame_reads_the_whole_page(values):
    html = "<p>x</p>" * 200_000 + '<iframe src="https://youtube.com/embed/late">'
    assert values(video_frame(F.col("u"), F.col("h")), "u string, h string", [(PAGE, html)]) == [
        "https://youtube.com/embed/late"
    ]


@pytest.mark.parametrize("piece", ["<!-- ", "<iframe ", "<iframe src ", "--> "])
def test_video_frame_is_quick_on_odd_pages(values, piece):
    html = "youtube.com " + piece * 200_000
    assert values(video_frame(F.col("u"), F.col("h")), "u string, h string", [(PAGE, html)]) == [None]


def test_url_segment(values):
    got = texts(values, url_segment(F.col("t")), "https://h/a/b/c", "https://h/a/b", "https://h/a", None)
    assert got == ["b", "b", None, None]
    assert texts(values, url_segment(F.col("t")), "https://ads.example.com/advertiser/AR9/creative/CR1") == ["AR9"]


def test_email_shape(values):
    cases = {
        "a@b.c": True,
        "a@b": False,
        "a b@c.d": False,
        "a@b.c\n": True,
        "a@b.c\r\n": False,
        "a@b.c\n\n": False,
        "first.last+tag@mail.example-site.co.uk": True,
        "@b.c": False,
        "": False,
    }
    assert texts(values, is_email(F.col("t")), *cases) == list(cases.values())
    assert texts(values, is_email(F.col("t")), None) == [None]


def test_expiry_boundary(values):
    from adstrata.operators.codes import expired

    made = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(made, made.replace(minute=10)), (made, made.replace(minute=10, microsecond=1))]
    assert values(expired(F.col("c"), F.col("n")), "c timestamp, n timestamp", rows) == [False, True]


V = "https://www.youtube.com/embed/v"


@pytest.mark.parametrize(
    "html, found",
    [
        (f'<script>"<iframe src={V}>"</script>', None),
        (f'<script>"<!--"</script><iframe src="{V}">', V),
        (f'<!-- <script> --><iframe src="{V}">', V),
        (f'<style>a<iframe src="{V}"></style >', None),
        (f'<STYLE><iframe src="/x"></sTyle><iframe src="{V}">', V),
        (f'<textarea><iframe src="{V}"></textareas></textarea>', None),
        (f'<script><style></script><iframe src="{V}">', V),
        (f'<script src="x"/><iframe src="{V}">', None),
        (f'<scripts><iframe src="{V}">', V),
        (f'<script><iframe src="{V}">', None),
        (f'<iframe src="/a"></iframe><script x<iframe src="{V}">', None),
        (f"<iframe srcdoc='<p>' src='{V}'>", None),
        (f'<iframe srcdoc="&lt;iframe src=/a&gt;&lt;iframe src={V}&gt;"></iframe>', V),
        (f'<iframe srcdoc="&lt;script&gt;&lt;iframe src={V}&gt;"></iframe>', None),
        (f'<iframe srcdoc="&amp;lt;iframe src={V}&amp;gt;"></iframe>', None),
        (f'<iframe srcdoc="&lt;p&gt;"></iframe><iframe src="{V}">', V),
        ("<iframe src='https://www.youtube.com/embed/v?a=1&amp;lt;'>", f"{V}?a=1&lt;"),
    ],
)
def test_frames_in_and_beside_text_that_is_no_markup(values, html, found):
    frame = video_frame(F.lit("https://p"), F.col("html"))
    assert values(frame, "html string", [(html,)]) == [found]


@pytest.mark.parametrize("piece", ["<script", "<script>", "<!--", "</script", "<iframe srcdoc=\"", "<iframe ", "<title><style>", "<script></script"])
def test_hidden_text_is_passed_in_linear_time(values, piece):
    """Ten times the text may take some thirty times as long, where a hundred would be quadratic."""
    import time

    frame = video_frame(F.lit("https://p"), F.col("html"))
    taken = []
    for n in (20_000, 200_000):
        start = time.perf_counter()
        values(frame, "html string", [(piece * n + "youtube.com",)])
        taken.append(time.perf_counter() - start)
    assert taken[1] < 30 * max(taken[0], 0.1)

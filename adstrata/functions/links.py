"""Expressions over URLs and stored page HTML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The video host, the embed pattern and the watch address.
VIDEO_HOST = "youtube.com"
EMBED_PATTERN = r"/embed/([^?&]+)"
WATCH_PREFIX = "https://www.youtube.com/watch?v="

FRAME_START = r"(?i)<iframe(?=[\s/>])"
# From a tag's name on: quoted values are passed over whole, up to `src` and its value in any of three forms.
SOURCE_PATTERN = (
    r"(?i)^(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|\s(?!src\s*+=)|[^>\s])*+"
    r"\ssrc\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>\"']++[^\s>]*+)"
)
SRCDOC_PATTERN = SOURCE_PATTERN.replace("src\\s", "srcdoc\\s")
# Comments, and elements whose text is not markup.
HIDDEN_START = r"(?i)<(?:!--|(?:script|style|textarea|title|noscript)[\s/>])"
HIDDEN_PATTERN = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|noscript)(?=[\s/>])[^>]*+(?:>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\z)|\z)|\z)"
)
# What addresses and pages in attributes are written with.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
SCHEME_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*:)//"


def mentions(url: Column, host: str = VIDEO_HOST) -> Column:
    """Case-sensitive substring test."""
    return F.contains(url, F.lit(host))


def watch_url(embed_url: Column) -> Column:
    """The watch address of an embed URL, NULL when it has no video id."""
    video_id = F.nullif(F.regexp_extract(embed_url, EMBED_PATTERN, 1), F.lit(""))
    return F.concat(F.lit(WATCH_PREFIX), video_id)


def markup(html: Column) -> Column:
    """The HTML without comments and without the text of elements that hold no markup, in document order.

    What is never closed runs to the end, as in browsers. Each of the pattern's parts goes on to its end or the page's, so that
    one pass does, whatever the page holds.
    """
    return F.when(html.rlike(HIDDEN_START), F.regexp_replace(html, HIDDEN_PATTERN, "")).otherwise(html)


def _unescaped(text: Column) -> Column:
    """The text of an attribute; `&amp;` comes last, so that nothing is unescaped twice."""
    for written, meant in ENTITIES:
        text = F.replace(text, F.lit(written), F.lit(meant))
    return text


def _attribute(tag: Column, pattern: str) -> Column:
    """The value that a pattern finds in a tag, without its quotes; an empty text if there is none."""
    return F.regexp_replace(F.regexp_extract(tag, pattern, 1), r"(?s)^([\"'])(.*)\1$", "$2")


def _frames(html: Column, host: str | None) -> Column:
    """The iframes of a page in order, each with what follows it up to the next; with a host only those that mention it.

    The page is cut at its iframes rather than searched by one long pattern, so that the time stays in
    proportion to its length whatever it holds.
    """
    kept = lambda part: F.lit(True) if host is None else mentions(part, host)
    return F.filter(F.split(markup(html), FRAME_START), lambda part, position: (position > 0) & kept(part))


def _source(frame: Column) -> Column:
    return _unescaped(_attribute(frame, SOURCE_PATTERN))


def frame_sources(html: Column, host: str | None = None) -> Column:
    """The addresses of a page's iframes in order. An iframe with a page of its own (`srcdoc`) stands for the iframes in it.

    With a host, iframes are left out that don't mention it.
    """

    def of_frame(frame: Column) -> Column:
        inner = F.transform(_frames(_unescaped(_attribute(frame, SRCDOC_PATTERN)), host), _source)
        return F.when(frame.rlike(SRCDOC_PATTERN), inner).otherwise(F.array(_source(frame)))

    return F.flatten(F.transform(_frames(html, host), of_frame))


def video_frame(page_url: Column, html: Column, host: str = VIDEO_HOST) -> Column:
    """The first frame of a page that comes from the host: the page itself, then iframes in order."""
    framed = F.get(F.filter(frame_sources(html, host), lambda address: mentions(address, host)), F.lit(0))
    # An address without a scheme has that of its page.
    scheme = F.regexp_extract(page_url, SCHEME_PATTERN, 1)
    framed = F.when(F.startswith(framed, F.lit("//")), F.concat(F.coalesce(scheme, F.lit("")), framed)).otherwise(framed)
    # The plain substring test spares most pages the rest.
    return F.when(mentions(page_url, host), page_url).when(mentions(html, host), framed)


def url_segment(url: Column, position: int = 4) -> Column:
    """The part at `position` (from 0) between slashes, NULL when the URL is shorter."""
    return F.get(F.split(url, "/"), F.lit(position))

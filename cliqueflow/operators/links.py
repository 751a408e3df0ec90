"""Archive discovery: links found in stored web pages, and which are not ingested yet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import archive_file_name, decode_entities, replace_first_dot, resolve_href

# One attribute: a name and perhaps a value, quoted either way or bare. All repetitions are possessive, so a tag is
# read once, in constant stack, whatever it holds; what is still open at the end of the page ends there.
ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+)?+)?+"""
INSIDE = rf"""(?:[\s/]++|{ATTRIBUTE})*+"""
# The tokens of a page; group 1 is a closed anchor tag. Comments, scripts and styles are one token each.
TOKEN_PATTERN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<(?:[!?]|/[^a-z])[^>]*+(?:>|\z)"
    r"|<script(?=[\s/>]).*?(?:</script(?=[\s/>])|\z)|<style(?=[\s/>]).*?(?:</style(?=[\s/>])|\z)"
    rf"|(<a(?=[\s/]){INSIDE}>)|</?[a-z]{INSIDE}(?:>|\z)"
)
# The value of a tag's first href, quotes included.
HREF_PATTERN = rf"""(?is)^<a(?:[\s/]++|(?!href[\s/>=]){ATTRIBUTE})*+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
# The archive kinds the original scraper keeps, matched on the last three characters of the href.
ARCHIVE_KINDS = ("zst", "tar")


def page_hrefs(pages: DataFrame) -> DataFrame:
    """(page_id, url, href): the href of every anchor tag of every page, in page order of appearance, entities decoded.

    The page is cut into tokens first, so what stands in comments, scripts,
    styles or another tag's attributes is no anchor; a tag that the page does
    not close is none either. Of several hrefs of a tag the first counts; one
    without a value is no link.
    """
    tags = F.filter(F.regexp_extract_all("html", F.lit(TOKEN_PATTERN), F.lit(1)), lambda tag: tag != "")
    anchors = pages.select("page_id", "url", F.explode(tags).alias("tag"))
    found = anchors.select("page_id", "url", F.regexp_extract("tag", HREF_PATTERN, 1).alias("href")).filter("href != ''")
    return found.withColumn("href", decode_entities(F.regexp_replace("href", r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2")))


def page_links(pages: DataFrame, kinds: Iterable[str] | None = None) -> DataFrame:
    """(link): distinct links found in ``pages``.

    Without ``kinds`` every href is resolved against its page, see ``resolve_href``. With
    ``kinds`` only hrefs whose last three characters are one of them are kept
    and resolved the archive way: a ``zst`` href has its first ``.`` replaced
    by the page URL, any other kind is appended to the page URL.
    """
    hrefs = page_hrefs(pages)
    if kinds is None:
        links = hrefs.select(resolve_href("url", "href").alias("link"))
    else:
        kinds = list(kinds)
        kind = F.substring(F.col("href"), -3, 3)
        links = hrefs.filter(kind.isin(kinds)).select(
            F.when(kind == "zst", replace_first_dot("href", "url"))
            .otherwise(F.concat("url", "href"))
            .alias("link")
        )
    return links.distinct()


def pending_archives(links: DataFrame, stored: DataFrame) -> DataFrame:
    """(link, file_name): links whose file name is not among ``stored.file_name``.

    A link's file name is its last path part without the four-character
    archive suffix. Anti join, so the stored listing never reaches the driver.
    """
    named = links.select("link", archive_file_name("link").alias("file_name"))
    return named.join(stored.select("file_name"), "file_name", "left_anti").select("link", "file_name")


def stored_listing(paths: DataFrame, column: str = "path") -> DataFrame:
    """(file_name): last path part of already stored (decompressed) objects."""
    return paths.select(F.element_at(F.split(column, "/"), -1).alias("file_name")).distinct()

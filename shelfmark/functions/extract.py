"""Extraction from page text by regular expressions and array functions; one helper walks spec blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab
from .keys import _c


def html_to_text(c: Column | str) -> Column:
    """Text lines of a page: no script, style or comments, a line for each tag, no empty lines."""
    text = F.regexp_replace(_c(c), r"(?is)<(script|style)\b.*?</\1\s*>", "\n")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "\n")
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t\r\f]+", " "), r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(text, r"\n{2,}", "\n"), r"^[\n ]+|[\n ]+$", "")


def lines_of(c: Column | str) -> Column:
    return F.transform(F.split(_c(c), "\n"), lambda x: F.trim(x))


def field_after(lines: Column | str, label: str) -> Column:
    """The line after the first line that is ``label``, or null."""
    lines = _c(lines)
    at = F.array_position(lines, F.lit(label)).cast("int")
    return F.when(at > 0, F.get(lines, at))


def produced_year(lines: Column | str) -> Column:
    """First 18xx to 20xx after "Produced:" on its line or the next; none if that is "Legend"."""
    lines = _c(lines)
    is_start = F.transform(lines, lambda x: F.startswith(x, F.lit("Produced:")))
    at = F.array_position(is_start, True).cast("int")
    own = F.trim(F.substr(F.get(lines, at - 1), F.lit(10)))
    text = F.when(own != "", own).otherwise(F.get(lines, at))
    year = F.regexp_extract(text, r"(18|19|20)[0-9]{2}", 0)
    return F.when((at > 0) & (text != "Legend") & (year != ""), year.cast("int"))


def read_specs(pages: DataFrame, text: str = "text", devices: tuple[str, ...] | None = None, dead_mark: str = "No such synth") -> DataFrame:
    """``pages`` with dead, year, device and technology read from their cached text."""
    lines = lines_of(text)
    device = field_after(lines, "Device:")
    technology = F.lower(field_after(lines, "Technology:"))
    dead = F.contains(F.coalesce(_c(text), F.lit("")), F.lit(dead_mark))
    allowed = device.isin(*devices) if devices else F.lit(True)
    return pages.withColumns({"dead": dead, "year": F.when(~dead, produced_year(lines)), "device": F.when(~dead & allowed, device), "technology": F.when(~dead & technology.isin("analog", "digital", "hybrid"), technology)})


_START = re.compile(r"TECHNICAL SPECIFICATIONS?", re.I)
#: Labels without a field name of their own: words, slashes, ampersands and hyphens.
_PLAIN_LABEL = re.compile(r"[A-Za-z][A-Za-z /&-]{1,30}")


def _pairs(lines: list[str]) -> Iterator[tuple[str, str]]:
    """Label and value of each line with a colon; a label that ends its line takes the next, unless that is a label too."""
    rest = iter(zip(lines, [*lines[1:], ":"], strict=True))
    for line, after in rest:
        label, _, value = line.partition(":")
        if line.endswith(":") and not after.endswith(":"):
            label, value = line[:-1], after
            next(rest)
        yield label.strip(), value.strip()


def _block(text: str) -> list[tuple[str, str, str]]:
    lines = [x.strip() for x in html.unescape(text).split("\n") if x.strip()]
    out: dict[str, tuple[str, str, str]] = {}
    for label, value in _pairs(lines):
        field = vocab.SPEC_FIELDS.get(label.lower())
        if not field and _PLAIN_LABEL.fullmatch(label):
            field = re.sub("[^a-z0-9]+", "_", label.lower()).strip("_")
        if field and value and len(label) <= 40:
            out.setdefault(field, (field, label, value))
    return list(out.values())


def spec_blocks(df: DataFrame, key: str, text: str = "text", span: int = 4000) -> DataFrame:
    """(key, field, label, value): the fullest block after a "TECHNICAL SPECIFICATION" heading.

    A walk over lines with the best of several hits kept, so a vectorised helper.
    """
    kind = df.schema[key].dataType.simpleString()

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, t in zip(frame[key], frame[text], strict=True):
                hits = [_block(t[m.end() : m.end() + span]) for m in _START.finditer(t or "")]
                best = max(hits, key=len, default=[])
                rows += [(k, *x) for x in best]
            yield pd.DataFrame(rows, columns=[key, "field", "label", "value"])

    return df.select(key, text).mapInPandas(walk, f"{key} {kind}, field string, label string, value string")


ANCHOR = r"""(?is)<a\b[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a>"""


def page_links(df: DataFrame, key: str, html: str = "html", blocks: dict[str, str] | None = None) -> DataFrame:
    """(key, url, label, block): anchors within the blocks given by name and pattern (group 1), of the
    whole page if none are; once each href."""
    parts = {"page": F.col(html)} if blocks is None else {n: F.array_join(F.regexp_extract_all(F.col(html), F.lit(p), F.lit(1)), "\n") for n, p in blocks.items()}
    rows = None
    for name, part in parts.items():
        own = df.select(key, F.posexplode(F.regexp_extract_all(part, F.lit(ANCHOR), F.lit(0))).alias("pos", "a"))
        label = F.regexp_replace(F.regexp_replace(F.regexp_extract("a", ANCHOR, 2), "<[^>]*>", " "), r"\s+", " ")
        own = own.select(key, F.regexp_extract("a", ANCHOR, 1).alias("url"), F.trim(label).alias("label"), F.lit(name).alias("block"), "pos")
        rows = own if rows is None else rows.union(own)
    first = rows.groupBy(key, "url").agg(F.min_by(F.struct("label", "block"), F.struct("block", "pos")).alias("b"))
    return first.select(key, "url", "b.label", "b.block")


def page_urls(html: Column | str, page_url: Column | str) -> Column:
    """The distinct absolute links of a page's anchors, without a shuffle."""
    hrefs = F.array_distinct(F.regexp_extract_all(_c(html), F.lit(ANCHOR), F.lit(1)))
    return F.array_distinct(F.transform(hrefs, lambda h: resolve_href(h, page_url)))


def page_spec_pairs(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, label, value) of spans of class term and of class value that follow each other."""
    pair = r"""(?is)<span[^>]*class=["'][^"']*term[^"']*["'][^>]*>(.*?)</span>\s*<span[^>]*class=["'][^"']*value[^"']*["'][^>]*>(.*?)</span>"""
    pairs = F.arrays_zip(F.regexp_extract_all(F.col(html), F.lit(pair), F.lit(1)).alias("l"), F.regexp_extract_all(F.col(html), F.lit(pair), F.lit(2)).alias("v"))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))
    return df.select(key, F.explode(pairs).alias("p")).select(key, plain(F.col("p.l")).alias("label"), plain(F.col("p.v")).alias("value"))


def resolve_href(href: Column | str, page_url: Column | str) -> Column:
    """An href against its page: absolute as it is, "/x" on the host, others beside the page."""
    href, page = _c(href), _c(page_url)
    site = F.regexp_extract(page, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(page, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(page, "^([^:]*:)", 1), href)).when(F.startswith(href, F.lit("/")), F.concat(site, href)).otherwise(F.concat(folder, href))


def table_rows(df: DataFrame, key: str, html: str = "html", cells: int = 7) -> DataFrame:
    """(key, row, cells, href): rows of the first tbody with ``cells`` cells or more."""
    body = F.regexp_extract(F.col(html), r"(?is)<tbody[^>]*>(.*?)</tbody>", 1)
    rows = df.select(key, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "tr"))
    tds = F.regexp_extract_all("tr", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))
    rows = rows.select(key, "row", tds.alias("tds")).filter(F.size("tds") >= cells)
    plain = F.transform("tds", lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " ")))
    return rows.select(key, "row", plain.alias("cells"), F.nullif(F.regexp_extract(F.get("tds", F.lit(1)), r"""(?i)href=["'](https?://[^"']+)["']""", 1), F.lit("")).alias("href"))


def stated_year(c: Column | str) -> Column:
    """The year in "released in 1989" and the like."""
    year = F.regexp_extract(_c(c), r"(?i)\b(?:released|introduced|launched)\s+in\s+(19[0-9]{2}|20[0-2][0-9])", 1)
    return F.when(year != "", year.cast("int"))


def label_year(c: Column | str, as_of_year: int) -> Column:
    """Earliest number from 1940 to ``as_of_year`` in a label."""
    years = F.transform(F.regexp_extract_all(_c(c), F.lit(r"\b((?:19|20)[0-9]{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.array_min(F.filter(years, lambda y: y.between(1940, as_of_year)))


def post_taxonomy(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, title, categories, tags, year, audio) of a post's page."""
    by_rel = lambda rel: F.regexp_extract_all(F.col(html), F.lit(rf"""(?is)<a\b[^>]*rel=["'][^"']*{rel}[^"']*["'][^>]*>(.*?)</a>"""), F.lit(1))
    tags = by_rel("tag")
    years = F.filter(tags, lambda t: t.rlike(r"^(19|20)[0-9]{2}$"))
    title = F.trim(F.regexp_extract(F.col(html), r"(?is)<title[^>]*>(.*?)</title>", 1))
    audio = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)(?:href|src)=["']([^"']+\.(?:mp3|wav|flac|ogg|m4a))["']"""), F.lit(1))
    return df.select(key, title.alias("title"), F.array_except(by_rel("category"), tags).alias("categories"), F.filter(tags, lambda t: ~t.rlike(r"^(19|20)[0-9]{2}$")).alias("tags"), F.array_min(F.transform(years, lambda y: y.cast("int"))).alias("year"), F.array_distinct(audio).alias("audio"))


def logo_candidates(df: DataFrame, key: str, url: str = "url", html: str = "html", most: int = 4) -> DataFrame:
    """X11: (key, rank, logo): images that name themselves logo, then og:image, then an svg icon; absolute, once each."""
    tag = F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<img\b[^>]*logo[^>]*>)"), F.lit(1))
    images = F.transform(tag, lambda t: F.regexp_extract(t, r"""(?i)\bsrc=["']([^"']+)["']""", 1))
    og = F.regexp_extract(F.col(html), r"""(?is)<meta[^>]*property=["']og:image["'][^>]*content=["']([^"']*logo[^"']*)["']""", 1)
    icon = F.regexp_extract(F.col(html), r"""(?is)<link[^>]*rel=["'][^"']*icon[^"']*["'][^>]*href=["']([^"']+\.svg)["']""", 1)
    found = F.filter(F.concat(images, F.array(og, icon)), lambda x: x != "")
    page = F.col(url)
    absolute = F.slice(F.array_distinct(F.transform(found, lambda x: resolve_href(x, page))), 1, most)
    return df.select(key, F.posexplode(absolute).alias("rank", "logo"))


def snake(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def specs_long(df: DataFrame, key: str, specs: str = "specs", longest: int = 2000) -> DataFrame:
    """(key, field, label, value) of a map column, blanks dropped."""
    rows = df.select(key, F.explode(specs).alias("label", "value")).filter("trim(value) <> ''")
    return rows.select(key, snake("label").alias("field"), "label", F.substring(F.trim("value"), 1, longest).alias("value"))


def unescaped_hrefs(html: Column | str) -> Column:
    """The href values of a page, the commonest entities decoded by built-in functions."""
    hrefs = F.regexp_extract_all(_c(html), F.lit(r"""(?i)href=["']([^"']+)["']"""), F.lit(1))
    return F.transform(hrefs, lambda h: F.replace(F.replace(F.replace(h, F.lit("&#39;"), F.lit("'")), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")))

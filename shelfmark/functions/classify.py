"""Rule classifiers: ordered rules, the first that fires wins."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from . import vocab
from .keys import _c, domain_label, domain_name_key, domain_of, first_by, norm, nulls_last, prefixes


def is_official(domain: Column | str, name: Column | str, suffixes: Sequence[str] = vocab.OFFICIAL_SUFFIXES) -> Column:
    """The registrable label is the maker's key (3 letters or more), or that and an allowed suffix."""
    label, key = domain_label(domain), domain_name_key(name)
    rest = F.substr(label, F.length(key) + 1)
    return F.coalesce((F.length(key) >= 3) & F.startswith(label, key) & rest.isin(*suffixes), F.lit(False))


def _any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out |= F.contains(text, F.lit(w))
    return out


def link_type(url: Column | str, label: Column | str, domain: Column | str, official: Column) -> Column:
    """What a link leads to."""
    hay = F.lower(F.concat(F.coalesce(_c(label), F.lit("")), F.lit(" "), _c(url)))
    return (
        F.when(_c(url).rlike(vocab.AUDIO_FILE), "audio_demo")
        .when(official, "manufacturer_official")
        .when(_c(domain).isin(*vocab.ARCHIVE_DOMAINS) | _any(hay, vocab.ARCHIVE), "archive")
        .when(_any(hay, vocab.COMMUNITY), "community")
        .when(_any(hay, vocab.SERVICE), "service_mod")
        .when(_any(hay, vocab.SAMPLES), "samples")
        .when(_any(hay, vocab.RETAIL), "retailer")
        .when(_any(hay, vocab.MEDIA), "media")
        .otherwise("other")
    )


def route_links(pages: DataFrame, own_domain: str | None = None) -> DataFrame:
    """One row a link of ``pages`` (maker_id, maker, product_id, links) with the owner it goes to.

    Official links of a maker go to the maker once; others to the product if there is one.
    """
    rows = pages.select("maker_id", "maker", "product_id", F.explode("links").alias("l")).select("maker_id", "maker", "product_id", "l.url", "l.label")
    rows = rows.withColumn("domain", domain_of("url")).filter("domain <> ''")
    if own_domain:
        rows = rows.filter(F.col("domain") != own_domain)
    official = is_official("domain", "maker")
    rows = rows.withColumn("link_type", link_type("url", "label", "domain", official))
    to_maker = (F.col("link_type") == "manufacturer_official") | F.col("product_id").isNull()
    rows = rows.withColumn("owner_maker", F.when(to_maker, F.col("maker_id"))).withColumn("owner_product", F.when(~to_maker, F.col("product_id")))
    keys = ["owner_maker", "owner_product", "url"]
    return first_by(rows, keys, *nulls_last("label"), F.col("domain"), F.col("link_type")).select(F.col("owner_maker").alias("maker_id"), F.col("owner_product").alias("product_id"), "url", "label", "domain", "link_type")


def _held(df: DataFrame, key: str) -> DataFrame:
    """``df`` as it is, its columns made once for all that use them: Spark would put their expressions in each place."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, F.explode(F.array(F.struct(*rest))).alias("_row")).select(key, "_row.*")


def product_like(df: DataFrame, url: str, dictionary: DataFrame, key: str) -> DataFrame:
    """C4: (key, signal): why a URL looks like a product page, null if it doesn't.

    The regex rules need no join; segments, slug heads and beginnings of five letters or
    more of segments and keys meet by equality, in one join.
    """
    path = F.url_decode(F.regexp_replace(F.regexp_extract(F.col(url), r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), r"\+", "%2B"))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    rows = _held(df.select(key, segments.alias("segs")), key)
    last = F.regexp_replace(F.get("segs", F.size("segs") - 1), r"(?i)\.(php|html?|aspx)$", "")
    low = F.transform("segs", F.lower)
    before = F.slice(low, F.lit(1), F.greatest(F.size("segs") - 1, F.lit(0)))
    slug = F.filter(F.split(F.lower(last), "[-_ ]+"), lambda p: p != "")
    rows = _held(rows.select(key, "segs", low.alias("low"), last.alias("last"), before.alias("before"), slug.alias("slug"), F.transform(before, norm).alias("normed")), key)
    bad = (
        (F.size("segs") == 0)
        | F.get("segs", F.size("segs") - 1).rlike(vocab.SKIP_FILE)
        | F.arrays_overlap("low", F.array(*map(F.lit, vocab.SKIP_SEGMENTS)))
        | F.array_contains("before", "page")
        | (F.col("last") == "")
        | F.lower("last").isin(*vocab.MARKERS)
        | F.col("last").rlike(r"^[0-9]+$")
    )
    prefixed = F.col("last").rlike(r"(?i)^products?[.\-_]") & (F.length("last") > 9)
    marked = F.arrays_overlap("before", F.array(*map(F.lit, vocab.MARKERS)))
    rows = rows.withColumn("easy", F.when(bad, "none").when(prefixed, "D:product-prefix").when(marked, "A:path-marker"))

    # every known key, and every beginning of five letters or more of one
    whole = dictionary.filter("by_key").select(F.col("place").alias("k")).filter(F.length("k") >= 3)
    begins = F.when(F.length("k") >= 5, prefixes("k", 5))
    roles = F.concat(F.array(F.struct("k", F.lit(True).alias("is_key"))), F.coalesce(F.transform(begins, lambda b: F.struct(b.alias("k"), F.lit(False).alias("is_key"))), F.array().cast("array<struct<k:string,is_key:boolean>>")))
    known = whole.select(F.explode(roles).alias("r")).groupBy("r.k").agg(F.max("r.is_key").alias("is_key"), F.max(~F.col("r.is_key")).alias("is_begin"))

    # what a URL asks for, all in one list: whole parts and slug heads that are keys, segments that begin one, beginnings that are one
    def probes(kind: str, n: Column, strings: Column) -> Column:
        return F.transform(strings, lambda k: F.struct(F.lit(kind).alias("kind"), n.cast("int").alias("n"), k.alias("k")))

    long = F.filter("normed", lambda k: F.length(k) >= 5)
    parts = F.concat("normed", F.transform(F.filter(F.flatten(F.transform("before", lambda seg: F.split(seg, "[-_]+"))), lambda p: F.length(p) >= 3), norm))
    heads = F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.lit(4), F.size("slug")), F.lit(1))), lambda i: F.struct(F.lit("head").alias("kind"), i.cast("int").alias("n"), norm(F.array_join(F.slice("slug", F.lit(1), i), "")).alias("k")))
    none = F.lit(0)
    asked = F.concat(probes("key", none, parts), probes("begins", none, long), probes("key", none, F.flatten(F.transform(long, lambda k: prefixes(k, 5)))), heads)
    asked = rows.filter("easy is null").select(key, F.size("slug").alias("all"), F.explode(F.array_distinct(asked)).alias("p")).filter("p.k <> ''")
    hits = asked.select(key, "all", "p.kind", "p.n", "p.k").join(known, "k").filter("case when kind = 'begins' then is_begin else is_key end")
    longest = F.first("all") - F.max(F.when(F.col("kind") == "head", F.col("n")))
    hits = hits.groupBy(key).agg(F.max(F.col("kind") != "head").alias("_b"), longest.between(1, 5).alias("_c"))
    out = rows.select(key, "easy").join(hits, key, "left")
    signal = F.when(F.col("easy") == "none", F.lit(None)).when(F.col("easy").isNotNull(), F.col("easy")).when(F.col("_b"), "B:maker-segment").when(F.col("_c"), "C:maker-slug")
    return out.select(key, signal.cast("string").alias("signal"))


def product_hint(url: Column | str) -> Column:
    """A coarse hint in a URL's path."""
    return _c(url).rlike(r"(?i)/(products?|instruments?|synths?|synthesizers?|keyboards?|modules?|gear)/[^/]+")


@pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else html.unescape(x))


def unescaped(c: Column | str) -> Column:
    """HTML entities decoded; texts without "&" don't leave the JVM's result."""
    return F.when(F.contains(_c(c), F.lit("&")), _unescape(_c(c))).otherwise(_c(c))


def title_verdict(model: Column | str, label: Column | str, title: Column | str, decode: bool = True) -> Column:
    """Instrument, not-instrument or undecided."""
    title = F.coalesce(unescaped(title) if decode else _c(title), F.lit(""))
    name = F.concat_ws(" ", F.coalesce(_c(model), F.lit("")), F.coalesce(_c(label), F.lit("")))
    segs = F.filter(F.split(title, r"\|"), lambda s: F.trim(s) != "")
    text = F.array_join(F.when(F.size(segs) > 1, F.slice(segs, F.lit(1), F.size(segs) - 1)).otherwise(segs), " ")
    text = F.when(text == "", name).otherwise(text)
    instrument, other = text.rlike(vocab.INSTRUMENT_WORD), text.rlike(vocab.NOT_SOUND_SOURCE)
    return (
        F.when(title.rlike(vocab.DECISIVE_NOT) | name.rlike(vocab.DECISIVE_NOT), "not-instrument")
        .when(instrument & ~other, F.when(F.size(segs) < 2, "undecided").otherwise("instrument"))
        .when(other & ~instrument, "not-instrument")
        .otherwise("undecided")
    )


def title_category(title: Column | str) -> Column:
    """Last type word of a title's first segment, or ''."""
    hits = F.regexp_extract_all(F.substring_index(_c(title), "|", 1), F.lit(vocab.CATEGORY_WORDS), F.lit(1))
    return F.lower(F.coalesce(F.get(hits, F.size(hits) - 1), F.lit("")))


def scope_bucket(c: Column | str) -> Column:
    """In, out or ask."""
    d = _c(c)
    return F.when(d.isNull() | (d == ""), "ask").when(d.rlike(vocab.OUT_OF_SCOPE) | d.rlike(vocab.EFFECT_ONLY), "out").when(d.rlike(vocab.IN_SCOPE), "in").otherwise("ask")


def sitemap_products(urls: DataFrame, config: DataFrame, pattern: str, skip: str | None = None) -> DataFrame:
    """(model, category, url, status) of the URLs that match ``pattern`` (group, sub, slug).

    ``config``: path (group/sub), category.  Paths that aren't listed are "skipped"; of
    one model the first URL stays.
    """
    rows = urls.select("url", F.concat_ws("/", F.regexp_extract("url", pattern, 1), F.regexp_extract("url", pattern, 2)).alias("path"), F.regexp_extract("url", pattern, 3).alias("slug")).filter("slug <> ''")
    if skip:
        rows = rows.filter(~F.col("slug").rlike(skip))
    rows = rows.join(config.withColumn("_listed", F.lit(True)), "path", "left")
    rows = rows.withColumn("status", F.when(F.col("_listed"), "kept").otherwise("skipped"))
    return first_by(rows, ["status", "path", "slug"], F.col("url")).select("path", "slug", "category", "url", "status")


def split_hardware(df: DataFrame, hardware: Sequence[str], kind: str = "product_type", external: str = "external_id") -> DataFrame:
    """``df`` of hardware types, with decision module (has an external id) or manual."""
    return df.filter(F.col(kind).isin(*hardware)).withColumn("decision", F.when(F.col(external).isNotNull(), "module").otherwise("manual"))


def brand_of(url: Column | str, section: Column | str, tokens: Sequence[str], sections: dict[str, str], archive: str = "Archiv_Hans_Ohms") -> Column:
    """C11: struct(brand, reason) from a document's path: archive folder, file token, section."""
    segs = F.split(F.regexp_replace(F.url_decode(F.regexp_replace(F.regexp_extract(_c(url), r"^[^:/?#]+://[^/?#]*/?([^?#]*)", 1), r"\+", "%2B")), "^/+|/+$", ""), "/")
    in_archive = F.array_contains(segs, archive)
    folder = F.when(F.size(segs) > 1, F.get(segs, F.size(segs) - 2)).otherwise("")
    many = in_archive & folder.rlike(r"\s-\s")
    by_folder = in_archive & (folder != "") & ~F.lower(folder).isin(*vocab.NOT_A_BRAND) & ~folder.rlike("^[0-9]+$")
    stem = F.regexp_extract(F.get(segs, F.size(segs) - 1), "^([^_-]*)", 1)
    token = F.lit(None).cast("string")
    for t in tokens:
        token = F.when(F.lower(stem) == t.lower(), t).otherwise(token)
    by_section = F.lit(None).cast("string")
    for k, v in sections.items():
        by_section = F.when(F.substring_index(_c(section), "_", -1) == k, v).otherwise(by_section)
    brand = F.when(many, None).when(by_folder, folder).otherwise(F.coalesce(token, by_section))
    reason = F.when(many, "several brands").when(by_folder, "folder").when(token.isNotNull(), "file").when(by_section.isNotNull(), "section").otherwise("none")
    return F.struct(brand.cast("string").alias("brand"), reason.alias("reason"))


def doc_link_type(section: Column | str, services: Sequence[str] = vocab.SERVICE_SECTIONS) -> Column:
    """service_mod or archive."""
    return F.when(_any(_c(section), services), "service_mod").otherwise("archive")


def link_health(probes: DataFrame) -> DataFrame:
    """(url, status, http_status, final_url) from probes (url, method, http_code, final_url, error).

    A HEAD answered 403, 405 or 501 gives way to the GET row; otherwise HEAD is enough.
    """
    give_way = (F.col("method") == "HEAD") & F.col("http_code").isin(403, 405, 501)
    best = first_by(probes, ["url"], give_way, F.when(F.col("method") == "HEAD", 0).otherwise(1), *nulls_last("http_code"), *nulls_last("final_url"), *nulls_last("error"))
    code, cut = F.col("http_code"), lambda c: F.regexp_replace(c, "/+$", "")
    moved = F.col("final_url").isNotNull() & (F.col("final_url") != "") & (cut(F.col("final_url")) != cut(F.col("url")))
    status = (
        F.when(code.between(200, 299), F.when(moved, "redirected").otherwise("live"))
        .when(code.isin(404, 410), "dead")
        .when(code.isin(401, 402, 403, 451), "blocked")
        .when(F.coalesce(F.col("error"), F.lit("")).rlike("(?i)name or service|resolve|nodename"), "dead")
        .otherwise("error")
    )
    return best.select("url", status.alias("status"), code.alias("http_status"), "final_url")


def domain_verdict(probes: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """C14: (domain, verdict) from probe results, manual overrides (domain, verdict) first."""
    code = F.col("home_code")
    blanket = F.col("robots_text").rlike(r"(?im)^user-agent:\s*\*\s*(\r?\n(?!user-agent:)[^\n]*)*?\r?\ndisallow:\s*/\s*$")
    refused = code.isin(401, 402, 403, 429)
    verdict = (
        F.when(F.col("error").isNotNull() & code.isNull(), "transport")
        .when(F.coalesce(blanket, F.lit(False)), "blocked_policy")
        .when((F.col("sitemap_code") == 200) & F.col("sitemap_text").rlike("(?i)<loc>"), "harvestable")
        .when(code == 200, "html_only")
        .when(refused, "blocked_bot")
        .when(code.isin(404, 410), "gone")
        .otherwise("transport")
    )
    out = probes.select("domain", verdict.alias("probed"))
    if overrides is None:
        return out.withColumnRenamed("probed", "verdict")
    return out.join(overrides.select("domain", F.col("verdict").alias("_manual")), "domain", "left").select("domain", F.coalesce("_manual", "probed").alias("verdict"))


def seller_text(c: Column | str) -> Column:
    return (F.length(_c(c)) > 40) | _c(c).rlike(vocab.SELLER_TEXT)


def discovery_funnel(names: DataFrame, dictionary: DataFrame, queue: DataFrame, threshold: int = 5, name: str = "name") -> DataFrame:
    """(name, n, outcome): thin, junk, known, queued or take, in that order."""
    counts = names.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("_key", F.nullif(norm("name"), F.lit(""))).withColumn("_lower", F.lower(F.trim("name")))
    exact = dictionary.filter("exact").select(F.col("lower_name").alias("_lower"), F.lit(True).alias("_e"))
    keyed = dictionary.filter("by_key").select(F.col("place").alias("_key"), F.lit(True).alias("_k"))
    queued = queue.select(F.lower(F.trim("name")).alias("_lower")).distinct().withColumn("_q", F.lit(True))
    rows = counts.join(exact, "_lower", "left").join(keyed, "_key", "left").join(queued, "_lower", "left")
    junk = F.col("_lower").isin(*vocab.LISTING_JUNK) | seller_text("name")
    outcome = F.when(F.col("n") < threshold, "thin").when(junk, "junk").when(F.col("_e") | F.col("_k"), "known").when(F.col("_q"), "queued").otherwise("take")
    return rows.select("name", "n", outcome.alias("outcome"))


def label_candidates(df: DataFrame, known: DataFrame, min_count: int = 3, limit: int | None = None, label: str = "label") -> DataFrame:
    """(name, n) of labels "Name (n)" that may be makers; ``known``: (name) found by R9, left out."""
    rows = df.select(F.trim(F.regexp_extract(label, r"^(.*?)\s*\(([0-9]+)\)$", 1)).alias("name"), F.regexp_extract(label, r"^(.*?)\s*\(([0-9]+)\)$", 2).alias("n")).filter("n <> ''")
    rows = rows.withColumn("n", F.col("n").cast("long")).filter(F.col("n") >= min_count)
    rows = rows.filter(~F.lower("name").isin(*vocab.STOP_TAGS) & ~F.col("name").rlike(vocab.BAD_LABEL) & ~F.col("name").rlike(vocab.STOP_LABEL))
    rows = rows.join(known.select("name").distinct(), "name", "left_anti").orderBy(F.desc("n"), "name")
    return rows.limit(limit) if limit else rows


def filter_types(df: DataFrame, allow: Sequence[str] = (), reject: Sequence[str] = (), types: str = "types") -> DataFrame:
    """C17: rows whose types overlap ``allow`` (if given) and don't overlap ``reject``."""
    own = F.coalesce(F.col(types), F.array().cast("array<string>"))
    if allow:
        df = df.filter(F.arrays_overlap(own, F.array(*map(F.lit, allow))))
    if reject:
        df = df.filter(~F.arrays_overlap(own, F.array(*map(F.lit, reject))))
    return df



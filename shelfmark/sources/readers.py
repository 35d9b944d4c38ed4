"""Readers of harvested files and pages, and the publisher of the nested catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.extract import unescaped_hrefs
from ..functions.keys import first_by, is_blank

#: Fields of a research batch's entry; others stay in its ``entry``.
BATCH_FIELDS = {
    "string": ("canonical_name", "long_name", "country", "city", "founders", "short_history", "long_history", "official_website", "status", "entity_type", "queue_name", "review_note"),
    "int": ("founded_year", "ended_year"),
    "array<struct<name string, start_year int, end_year int>>": ("name_history",),
    "array<struct<related_company string, relation_type string, year int>>": ("relations",),
    "array<struct<field_name string, value string, source_url string, source_tier string>>": ("sources",),
    "array<string>": ("conflicts",),
}
INSTRUMENT_FIELDS = {"year": "int", "category": "string", "source_url": "string"}
PAGE_BATCH = """source string, pages array<struct<source_url string, maker_slug string, model_slug string, display_name string,
    links array<struct<url string, label string, block string>>, specs map<string, string>>>"""
CACHED_PAGE = "manufacturer string, model string, url string, fetched_at string, text string"


def _plain(v: Column) -> Column:
    """The text of a variant that is a string."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row an entry of research batches, blank names dropped.

    ``instruments`` may be strings or structs, mixed: each becomes a struct with what it was
    as ``given``; those without a name are dropped.  ``entry`` is the whole entry, so fields
    that nobody knows yet, and values of other types than expected (null in their columns
    unless they can be cast), are still there.
    """
    rows = spark.read.schema("manufacturers array<variant>").json(path, multiLine=True).select(F.explode("manufacturers").alias("entry"))
    fields = [F.try_variant_get("entry", f"$.{n}", kind).alias(n) for kind, names in BATCH_FIELDS.items() for n in names]
    items = F.transform(
        F.try_variant_get("entry", "$.instruments", "array<variant>"),
        lambda x: F.struct(F.coalesce(_plain(x), F.try_variant_get(x, "$.name", "string")).alias("name"), *[F.try_variant_get(x, f"$.{n}", kind).alias(n) for n, kind in INSTRUMENT_FIELDS.items()], x.alias("given")),
    )
    rows = rows.select(*fields, items.alias("instruments"), "entry").filter(~is_blank("canonical_name"))
    named = F.filter("instruments", lambda x: F.coalesce(F.trim(x["name"]), F.lit("")) != "")
    return rows.withColumn("instruments", F.coalesce(named, F.filter(F.array(F.col("instruments")[0]), lambda x: F.lit(False))))


def read_page_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row a page with a model slug and specs."""
    rows = spark.read.schema(PAGE_BATCH).json(path, multiLine=True).select("source", F.explode("pages").alias("p")).select("source", "p.*")
    return rows.filter(~is_blank("model_slug") & (F.size("specs") > 0))


def read_page_cache(spark: SparkSession, path: str, dead_mark: str = "No such synth") -> DataFrame:
    """S3: one row a cached page, dead where its text says so."""
    return spark.read.schema(CACHED_PAGE).json(path, multiLine=True).withColumn("dead", F.contains(F.coalesce("text", F.lit("")), F.lit(dead_mark)))


def sitemap_urls(df: DataFrame, include: str | None = None, most: int | None = None) -> DataFrame:
    """(domain, url) of sitemap documents (domain, url, body); an index is followed one level.

    Of an index only sub-sitemaps in .xml or .xml.gz that match ``include`` count, and
    ``most`` of them for each domain if given.  Root documents are those that no index names.
    """
    loc = F.regexp_extract_all("body", F.lit(r"(?i)<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))
    index = F.col("body").rlike(r"(?i)<sitemapindex")
    subs = df.filter(index).select("domain", F.explode(loc).alias("sub")).filter(F.col("sub").rlike(r"(?i)\.xml(\.gz)?$")).distinct()
    if include:
        subs = subs.filter(F.col("sub").rlike(include))
    named = df.filter(index).select("domain", F.explode(loc).alias("sub")).distinct()
    if most:
        from pyspark.sql import Window

        subs = subs.withColumn("_n", F.row_number().over(Window.partitionBy("domain").orderBy("sub"))).filter(F.col("_n") <= most).drop("_n")
    roots = df.filter(~index).join(named.withColumnRenamed("sub", "url"), ["domain", "url"], "left_anti")
    below = df.filter(~index).join(subs.withColumnRenamed("sub", "url"), ["domain", "url"], "left_semi")
    return roots.union(below).select("domain", F.explode(loc).alias("url")).distinct()


def read_sitemap_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, kind, loc) of sitemap files, plain or gzip by their names: kind url, or sitemap in an index.

    Spark's XML reader streams through a file; no document is held whole.
    """
    parts = []
    for kind in ("url", "sitemap"):
        rows = spark.read.format("xml").schema("loc string").load(path, rowTag=kind)
        parts.append(rows.select(F.col("_metadata.file_path").alias("file"), F.lit(kind).alias("kind"), F.trim("loc").alias("loc")))
    return parts[0].union(parts[1]).filter(~is_blank("loc"))


def sitemap_file_urls(locs: DataFrame, listing: DataFrame, include: str | None = None) -> DataFrame:
    """(domain, url) of sitemap files by ``listing`` (domain, url, file): where each was fetched from.

    An index is followed one level, as in ``sitemap_urls``.
    """
    rows = locs.join(listing.withColumnRenamed("url", "at"), "file")
    named = rows.filter("kind = 'sitemap'").select("domain", F.col("loc").alias("at")).distinct()
    subs = named.filter(F.col("at").rlike(r"(?i)\.xml(\.gz)?$"))
    if include:
        subs = subs.filter(F.col("at").rlike(include))
    urls = rows.filter("kind = 'url'")
    found = urls.join(named, ["domain", "at"], "left_anti").select("domain", "loc").union(urls.join(subs, ["domain", "at"], "left_semi").select("domain", "loc"))
    return found.select("domain", F.col("loc").alias("url")).distinct()


def flatten_feed(df: DataFrame, body: str = "body") -> DataFrame:
    """(title, summary, labels, url, published) of feed JSON; tags stripped from the summary."""
    schema = "feed struct<entry array<struct<title struct<`$t` string>, summary struct<`$t` string>, published struct<`$t` string>, category array<struct<term string>>, link array<struct<rel string, href string>>>>>"
    e = df.select(F.explode(F.from_json(body, schema)["feed"]["entry"]).alias("e"))
    url = F.get(F.transform(F.filter("e.link", lambda x: x["rel"] == "alternate"), lambda x: x["href"]), F.lit(0))
    return e.select(F.col("e.title.$t").alias("title"), F.trim(F.regexp_replace(F.regexp_replace("e.summary.$t", "<[^>]*>", " "), r"\s+", " ")).alias("summary"), F.transform("e.category", lambda c: c["term"]).alias("labels"), url.alias("url"), F.col("e.published.$t").alias("published"))


def flatten_bindings(df: DataFrame, body: str = "body") -> DataFrame:
    """(label, qid, maker, year, binding) of SPARQL JSON; bare ids as labels dropped, the first row of a label stays.

    A variable is a struct with its ``value``, or the value itself; ``binding`` is all that
    the row had, as JSON.
    """
    rows = df.select(F.posexplode(F.from_json(body, "results struct<bindings array<variant>>")["results"]["bindings"]).alias("pos", "b"))

    def value(name: str) -> Column:
        return F.coalesce(_plain(F.try_variant_get("b", f"$.{name}", "variant")), F.try_variant_get("b", f"$.{name}.value", "string"))

    rows = rows.select("pos", value("itemLabel").alias("label"), F.substring_index(value("item"), "/", -1).alias("qid"), value("makerLabel").alias("maker"), F.substring(value("date"), 1, 4).alias("y"), F.to_json("b").alias("binding"))
    rows = rows.filter(~is_blank("label") & ~F.col("label").rlike(r"^Q\d+$"))
    return first_by(rows, ["label"], F.col("pos"), F.col("qid")).select("label", "qid", "maker", F.when(F.col("y").rlike(r"^\d{4}$"), F.col("y").cast("int")).alias("year"), "binding")


def listing_entries(df: DataFrame, key: str, html: str = "html", extensions: str = r"(?i)\.(pdf|zip|jpe?g|gif|png|tiff?|doc|djvu)$") -> DataFrame:
    """(key, entry, kind): relative hrefs of a directory listing, kind dir or file; documents only."""
    rows = df.select(key, F.explode(unescaped_hrefs(html)).alias("entry")).distinct()
    rows = rows.filter(~F.col("entry").rlike(r"^(http|mailto|\?|/|#)") & ~F.col("entry").isin("..", "../"))
    kind = F.when(F.endswith("entry", F.lit("/")), "dir").when(F.col("entry").rlike(extensions), "file")
    return rows.withColumn("kind", kind).filter("kind is not null")


def publish(makers: DataFrame, names: DataFrame, products: DataFrame, relations: DataFrame, logos: DataFrame) -> DataFrame:
    """A row a maker with its names, products, relations and logos as ordered arrays.

    What is gathered is one maker's, so this is for makers of a bounded size; ``catalogue.publish_files``
    writes catalogues of any.
    """
    def gathered(df: DataFrame, alias: str, *columns: str | Column) -> DataFrame:
        return df.groupBy("maker_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(alias))

    related = relations.join(makers.select(F.col("id").alias("related_id"), F.col("canonical_name").alias("related_name")), "related_id", "left")
    out = makers.withColumnRenamed("id", "maker_id")
    for part in (
        gathered(names, "name_history", F.coalesce("start_year", F.lit(9999)).alias("sort"), "name", "start_year", "end_year"),
        gathered(products, "instruments", F.coalesce("year", F.lit(9999)).alias("sort"), "name", "year", "category"),
        gathered(related, "relations", F.coalesce("year", F.lit(9999)).alias("sort"), "related_name", "relation_type", "year"),
        gathered(logos, "logos", "id", "start_year", "end_year", "review_status"),
    ):
        out = out.join(part, "maker_id", "left")
    return out.orderBy(F.lower("canonical_name"), "maker_id")

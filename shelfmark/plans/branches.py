"""Queries of outcomes that the tables' own contents don't have: links by slug and by part,
hits that fail, moved pages, conflicts, the owner's word."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify
from ..operators import evidence, resolve
from .catalogue import CONFIRMED, NORM, PRODUCT_KEYS, query


def _brand():
    return F.substring("p_brand", 7, 9).cast("long")


@query("r10_by_slug", f"""SELECT p.p_partkey AS id, k.product_id, CASE WHEN k.product_id IS NOT NULL THEN 'slug' END AS match_kind
    FROM part p LEFT JOIN {PRODUCT_KEYS} k ON k.maker_id = CAST(substr(p_brand, 7) AS BIGINT) AND k.k = {NORM.format('p_name')}""", "products")  # fmt: skip
def _(t):
    """Pages without a URL, of which only the slug names the product."""
    none = F.lit(None).cast("string")
    pages = t.part.select(F.col("p_partkey").alias("id"), none.alias("source_url"), F.col("p_brand").alias("maker"), F.concat(F.lit("Seen at fair "), F.col("p_partkey").cast("string")).alias("display_name"), F.translate("p_name", " ", "-").alias("slug"))
    makers = t.makers.withColumn("canonical_name", F.concat(F.lit("Brand#"), F.col("id").cast("string")))
    return resolve.match_pages(pages, t.products, resolve.name_dictionary(makers, t.maker_names, ("canonical",))).select("id", "product_id", "match_kind")


@query("r11_by_part", f"""SELECT p_partkey AS id, CAST(substr(p_brand, 7) AS BIGINT) AS maker_id, k.product_id, CASE WHEN k.product_id IS NOT NULL THEN 'part' END AS match_kind
    FROM part LEFT JOIN {PRODUCT_KEYS} k ON k.maker_id = CAST(substr(p_brand, 7) AS BIGINT) AND k.k = {NORM.format('p_name')} WHERE p_partkey % 4 > 0""", "products")  # fmt: skip
def _(t):
    """Labels that hold a product's name as one part among others; another source's links stay as they are."""
    label = F.concat(F.when(F.col("p_partkey") % 2 == 0, "Manual/").otherwise("scan of "), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" mkII rev"))
    source = F.when(F.col("p_partkey") % 4 == 0, "other").otherwise("a")
    links = t.part.select(F.col("p_partkey").alias("id"), _brand().alias("maker_id"), F.lit(None).cast("long").alias("product_id"), label.alias("label"), source.alias("source_name"))
    return resolve.relink(links, t.products, ["a"])


@query("r14_failed_hits", "SELECT id, CASE id % 5 WHEN 1 THEN 'none' WHEN 3 THEN 'none' WHEN 4 THEN 'none' ELSE 'full' END AS grade FROM products", "products")
def _(t):
    """By turns: maker and name in the title, the name without the maker, the maker in a label only, the maker without the name, neither."""
    turn, name, maker = F.col("id") % 5, F.col("name"), F.concat(F.lit("Brand#"), F.col("maker_id").cast("string"))
    title = F.when(turn == 0, F.concat(maker, F.lit(" "), name)).when(turn.isin(1, 2), F.concat(F.lit("For sale: "), name)).when(turn == 3, F.concat(maker, F.lit(" lot"))).otherwise("news")
    labels = F.when(turn == 2, F.array(F.lit("x"), F.lower(maker))).otherwise(F.array(F.lit("x")))
    hits = t.products.select("id", name.alias("product"), maker.alias("maker"), title.alias("title"), F.lit(None).cast("string").alias("summary"), labels.alias("labels"))
    return resolve.verify_hits(hits).select("id", "grade")


@query("c13_moved_links", """SELECT 'https://u.example.com/' || id AS url, (['live', 'redirected', 'dead', 'error', 'redirected'])[id % 5 + 1] AS status,
    CASE id % 5 WHEN 2 THEN NULL WHEN 3 THEN 500 ELSE 200 END AS http_status FROM links""", "links")  # fmt: skip
def _(t):
    """By turns: a slash more, another page, a host that doesn't resolve, a server's error, a move that only GET shows."""
    turn, url = F.col("id") % 5, F.concat(F.lit("https://u.example.com/"), F.col("id").cast("string"))
    code = F.when(turn == 3, 500).when(turn != 2, 200)
    final = F.when(turn == 0, F.concat(url, F.lit("/"))).when(turn.isin(1, 4), F.concat(F.lit("https://moved.example.com/"), F.col("id").cast("string")))
    error = F.when(turn == 2, "Name or service not known")
    last = t.links.select(url.alias("url"), F.when(turn == 4, "GET").otherwise("HEAD").alias("method"), code.alias("http_code"), final.alias("final_url"), error.alias("error"))
    refused = t.links.filter(turn == 4).select(url.alias("url"), F.lit("HEAD").alias("method"), F.lit(405).alias("http_code"), F.lit(None).cast("string").alias("final_url"), F.lit(None).cast("string").alias("error"))
    return classify.link_health(last.union(refused)).select("url", "status", "http_status")


@query("k2_with_conflicts", f"""SELECT id AS entity_id, CASE WHEN reasons = '' THEN 'confirmed' ELSE 'needs_review' END AS confidence, reasons FROM (
    SELECT m.id, concat_ws('; ', CASE WHEN m.id % 3 = 0 THEN 'city: a vs b' END, CASE WHEN m.id % 6 = 0 THEN 'year: 1 vs 2' END,
        CASE WHEN country IS NOT NULL AND NOT coalesce(bool_or(c.confirmed) FILTER (c.field_name = 'country'), false) THEN 'country not confirmed' END) AS reasons
    FROM makers m LEFT JOIN {CONFIRMED} c ON c.entity_id = m.id GROUP BY m.id, country)""", "makers", "claims")  # fmt: skip
def _(t):
    """Every third maker has a conflict, every sixth two."""
    listed = F.filter(F.array(F.when(F.col("id") % 3 == 0, "city: a vs b"), F.when(F.col("id") % 6 == 0, "year: 1 vs 2")), lambda x: x.isNotNull())
    return evidence.roll_up(t.makers.select(F.col("id").alias("entity_id"), "country", listed.alias("conflicts")), t.claims, core=("country",))


@query("k4_owner_confirmed", """SELECT coalesce(m.canonical_name, e.canonical_name) AS canonical_name,
    CASE WHEN e.canonical_name IS NULL THEN m.confidence WHEN m.canonical_name IS NULL THEN 'needs_review' WHEN m.confidence = 'confirmed' AND (e.n % 4 > 0 OR e.n % 8 = 0) THEN 'confirmed' ELSE 'needs_review' END AS confidence
    FROM makers m FULL JOIN (SELECT DISTINCT p_brand AS canonical_name, CAST(substr(p_brand, 7) AS INT) AS n FROM part) e ON e.canonical_name = m.canonical_name""", "makers")  # fmt: skip
def _(t):
    """Every fourth entry has a conflict, which demotes a confirmed maker unless the owner, as for every eighth, confirmed it."""
    brands = t.part.select(F.col("p_brand").alias("canonical_name"), _brand().alias("n")).distinct()
    entries = brands.select("canonical_name", F.lit("Land").alias("country"), F.lit(1).alias("n_sources"), (F.col("n") % 4 == 0).cast("int").alias("n_conflicts"), F.lit("needs_review").alias("confidence"))
    log = brands.select("canonical_name", F.when(F.col("n") % 8 == 0, "owner_confirmed").otherwise("viewed").alias("action"))
    return evidence.merge_makers(t.makers, entries, ["country"], log=log).select("canonical_name", "confidence")


@query("k16_owner_first", """SELECT DISTINCT ON (entity_id, field_name) entity_id, field_name, value, CASE WHEN id % 7 = 0 THEN 'owner' ELSE source_tier END AS source_tier FROM claims
    ORDER BY entity_id, field_name, CASE WHEN id % 7 = 0 THEN 1 WHEN source_tier = 'manufacturer_official' THEN 2 WHEN source_tier = 'wikidata' THEN 3 ELSE 4 END, fetched_at DESC, id, value, source_tier""", "claims")  # fmt: skip
def _(t):
    """Every seventh claim is the owner's."""
    return evidence.best_value(t.claims.withColumn("source_tier", F.when(F.col("id") % 7 == 0, "owner").otherwise(F.col("source_tier"))))

"""Queries of the catalogue jobs over the driver's tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, extract, keys, vocab
from ..operators import audit, evidence, reports, resolve, taxonomy
from ..sources import readers, store
from .tables import table, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_DICTIONARIES: dict[tuple, store.Versions] = {}


class Tables:
    """t.products reads the table or projection of that name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = (spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return table(*self._at, name)

    def dictionary(self, *sources: str) -> DataFrame:
        """The name dictionary, written once for all queries over the same files."""
        spark, sf_dir = self._at
        sources = sources or ("canonical", "long", "history")
        key = (spark.sparkContext.applicationId, sources, store.fingerprint(spark, [f"{sf_dir}/part.parquet"]))
        if key not in _DICTIONARIES:
            kept = store.Versions(store.scratch(spark, "dictionary"), "place")
            kept.write(resolve.name_dictionary(self.makers, self.maker_names, sources))
            _DICTIONARIES[key] = kept
        return _DICTIONARIES[key].read(spark)


def query(name: str, sql: str | None = None, *tables: str):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = with_tables(sql, *tables) if tables else sql
        return f

    return register


NORM = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
SPACED = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
VALUE_KEY = r"regexp_replace(regexp_replace(lower(trim({0})), '\.+$', ''), '\s+', ' ', 'g')"
HOST = r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract({0}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1)), '^.*@', ''), ':.*$', ''), '^www\.', '')"
LABEL = r"list_extract(string_split(regexp_replace({0}, '(\.+(" + "|".join(vocab.DOMAIN_TAIL) + r"))+$', ''), '.'), -1)"
SITE = r"regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)', 1)"
#: Compact and exact keys of the name dictionary, in the order of precedence.
DICTIONARY = f"""names AS (
        SELECT id AS maker_id, canonical_name AS name, 0 AS rank FROM makers
        UNION ALL SELECT id, long_name, 1 FROM makers WHERE long_name IS NOT NULL
        UNION ALL SELECT maker_id, name, 2 FROM maker_names),
    by_key AS (SELECT DISTINCT ON (key) {NORM.format('name')} AS key, maker_id FROM names ORDER BY key, rank, maker_id, name),
    by_name AS (SELECT DISTINCT ON (lower_name) lower(trim(name)) AS lower_name, maker_id FROM names ORDER BY lower_name, rank, maker_id, name)"""


def dictionary_sql(sql: str, *tables: str) -> str:
    """``sql`` behind the tables and the dictionary of their makers."""
    head = with_tables("", "makers", "maker_names", *tables).rstrip()
    return f"{head}, {DICTIONARY} {sql}"


# Keys and name scalars


@query("n1_n3_keys", f"SELECT p_partkey AS id, {NORM.format('p_name')} AS compact, {SPACED.format('p_brand')} AS spaced, {VALUE_KEY.format('p_type')} AS value_key FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), keys.norm("p_name").alias("compact"), keys.spaced_key("p_brand").alias("spaced"), keys.value_key("p_type").alias("value_key"))


_NOISE = "', '".join(vocab.COMPARE_NOISE)


@query("n4_compare_key")
def _(t):
    return t.queue.select("id", keys.compare_key("name").alias("k"))


SQL["n4_compare_key"] = with_tables("", "queue").rstrip() + f""", w AS (SELECT id, list_filter(string_split_regex(regexp_replace(lower(name), '[^\\w\\s]', ' ', 'g'), '\\s+'), lambda x: x <> '') AS ws FROM queue)
    SELECT id, array_to_string(CASE WHEN len(list_filter(ws, lambda x: x NOT IN ('{_NOISE}'))) > 0 THEN list_filter(ws, lambda x: x NOT IN ('{_NOISE}')) ELSE ws END, ' ') AS k FROM w"""


@query("n5_name_core_over_tables")
def _(t):
    return t.makers.select("id", keys.name_core("canonical_name").alias("core"), keys.names_match("canonical_name", F.concat(F.lit("brand "), F.col("id").cast("string"), F.lit(" GmbH"))).alias("same"))


SQL["n5_name_core_over_tables"] = with_tables("SELECT id, 'brand' || id AS core, true AS same FROM makers", "makers")


@query("n6_n13_domains", f"SELECT page_id, {HOST.format('url')} AS host, {LABEL.format(HOST.format('url'))} AS label FROM pages")
def _(t):
    return t.pages.select("page_id", keys.domain_of("url").alias("host"), keys.domain_label(keys.domain_of("url")).alias("label"))


@query("n7_clean_title", r"""SELECT doc_id, CASE WHEN name <> '' AND length(name) <= 120 AND NOT regexp_matches(name, '(?i)^List of ') AND NOT regexp_matches(name, '(?i)^Comparison of ') AND NOT regexp_matches(name, '(?i)\(disambiguation\)$') AND NOT regexp_matches(name, '(?i)\bsynthesi[sz]ers?$') THEN name END AS title
    FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(split_part(text, chr(10), 1), '\s*\(.*?\)\s*$', '')), '[\p{Cc}\p{Cf}\p{Co}\p{Zl}\p{Zp}]', '', 'g'), '\s+', ' ', 'g')) AS name FROM documents)""")
def _(t):
    return t.documents.select("doc_id", keys.clean_title(F.substring_index("text", "\n", 1)).alias("title"))


@query("n10_base_names", r"""SELECT id, CASE WHEN b = trim(name) THEN '' ELSE b END AS base, regexp_matches(name, '[()+/,]') AS variant FROM (
    SELECT id, name, regexp_replace(regexp_replace(name, '[(\[].*$', ''), '^[ \-/,+]+|[ \-/,+]+$', '', 'g') AS b FROM products)""", "products")
def _(t):
    return t.products.select("id", keys.base_name("name").alias("base"), keys.is_variant("name").alias("variant"))


@query("n11_strip_maker_prefix_over_tables", "SELECT id, name AS model FROM products", "products")
def _(t):
    titled = t.products.join(t.makers.select(F.col("id").alias("maker_id"), "canonical_name"), "maker_id").select("id", "maker_id", F.concat("canonical_name", F.lit(" "), F.initcap("name")).alias("name"))
    return keys.strip_maker_prefix(titled, t.makers.select(F.col("id").alias("maker_id"), F.col("canonical_name").alias("alias"))).select("id", F.lower("model").alias("model"))


@query("n12_split_axes_over_tables", "SELECT id, p_type AS form, p_brand AS function FROM (SELECT p_partkey AS id, p_type, p_brand FROM part)")
def _(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), keys.split_axes(F.concat_ws(" - ", "p_type", "p_brand")).alias("a"))
    return rows.select("id", "a.form", "a.function")


# Names to makers


@query("r1_name_dictionary", dictionary_sql("SELECT key, maker_id FROM by_key WHERE key <> ''"))
def _(t):
    return t.dictionary().filter("by_key").select("key", "maker_id")


@query("r2_resolve_maker", dictionary_sql(f"""SELECT q.id, coalesce(a.maker_id, b.maker_id) AS maker_id, CASE WHEN a.maker_id IS NOT NULL THEN 'exact' WHEN b.maker_id IS NOT NULL THEN 'key' END AS match_kind
    FROM queue q LEFT JOIN by_name a ON a.lower_name = lower(trim(q.name)) LEFT JOIN by_key b ON b.key = {NORM.format('q.name')} AND b.key <> ''""", "queue"))
def _(t):
    return resolve.resolve_maker(t.queue, "name", t.dictionary()).select("id", "maker_id", "match_kind")


@query("r3_find_maker", dictionary_sql("SELECT q.id, n.maker_id FROM queue q LEFT JOIN (SELECT DISTINCT ON (l) lower(trim(name)) AS l, maker_id FROM names WHERE rank <> 1 ORDER BY l, rank, maker_id) n ON n.l = lower(trim(q.name))", "queue"))
def _(t):
    return resolve.find_maker(t.queue, "name", t.makers, t.maker_names).select("id", "maker_id")


@query("r4_unique_prefix", dictionary_sql(f"""SELECT q.id, coalesce(a.maker_id, b.maker_id, p.maker_id) AS maker_id
    FROM queue q LEFT JOIN by_name a ON a.lower_name = lower(trim(q.name)) LEFT JOIN by_key b ON b.key = {NORM.format('q.name')} AND b.key <> ''
    LEFT JOIN (SELECT q.id, min(k.maker_id) AS maker_id FROM queue q JOIN by_key k ON starts_with(k.key, {NORM.format('q.name')}) AND length({NORM.format('q.name')}) >= 4 GROUP BY q.id HAVING count(*) = 1) p ON p.id = q.id""", "queue"))
def _(t):
    return resolve.resolve_unique_prefix(t.queue, "name", t.dictionary()).select("id", "maker_id")


@query("r5_match_title_over_tables", dictionary_sql("""SELECT p_partkey AS id, max_by(b.maker_id, length(b.lower_name)) AS maker_id FROM part JOIN by_name b ON starts_with(lower('Old Brand ' || substr(p_brand, 7) || ' ' || p_name) || ' ', b.lower_name || ' ') GROUP BY 1"""))
def _(t):
    titles = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("Old Brand "), F.substring("p_brand", 7, 9), F.lit(" "), F.col("p_name")).alias("title"))
    return resolve.match_title(titles, "title", t.dictionary(), "id").select("id", "maker_id")


@query("r6_split_slug_over_tables", dictionary_sql("SELECT p_partkey AS id, CAST(substr(p_brand, 7) AS BIGINT) AS maker_id, p_name AS model, 'matched' AS status FROM part"))
def _(t):
    slugs = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("old-brand-"), F.substring("p_brand", 7, 9), F.lit("-"), F.translate("p_name", " ", "-")).alias("slug"))
    return resolve.split_slug(slugs, "slug", t.dictionary(), "id")


@query("r7_contained_name", dictionary_sql(f"""SELECT id, max_by(maker_id, length(g) * 1000 + id % 1) AS maker_id, max_by(g, length(g)) AS contained FROM (
    SELECT q.id, n.g, n.maker_id FROM queue q JOIN (SELECT {SPACED.format('name')} AS g, min(maker_id) AS maker_id FROM names GROUP BY 1) n
    ON contains(' ' || {SPACED.format('q.name')} || ' ', ' ' || n.g || ' ') AND {SPACED.format('q.name')} <> n.g) GROUP BY id""", "queue"))
def _(t):
    return resolve.contained_name(t.queue, "name", t.dictionary(), "id")


@query("r8_name_variants", dictionary_sql("""SELECT p_partkey AS id, count(DISTINCT b.name) AS n, array_to_string(list_sort(list(DISTINCT b.name)), ' | ') AS variants FROM part JOIN names b ON starts_with(lower(b.name), lower(p_brand) || ' ') GROUP BY 1"""))
def _(t):
    return resolve.name_variants(t.part.select(F.col("p_partkey").alias("id"), "p_brand"), "p_brand", t.dictionary(), "id")


@query("r9_known_prefix", dictionary_sql(f"""SELECT DISTINCT q.id FROM (SELECT id, {NORM.format('name')} AS k FROM asked) q LEFT JOIN by_key b ON b.key = q.k OR length(b.key) >= 3 AND length(q.k) >= 3 AND (starts_with(b.key, q.k) OR starts_with(q.k, b.key)) WHERE q.k = '' OR b.key IS NOT NULL""", "asked"))
def _(t):
    return resolve.is_known_prefix(t.asked, "name", t.dictionary(), "id")


PRODUCT_KEYS = f"(SELECT maker_id, {NORM.format('name')} AS k, min(id) AS product_id FROM products GROUP BY 1, 2)"


@query("r10_match_pages", f"""SELECT p.p_partkey AS id, coalesce(u.id, k.product_id) AS product_id, CASE WHEN u.id IS NOT NULL THEN 'url' WHEN k.product_id IS NOT NULL THEN 'name' END AS match_kind
    FROM part p LEFT JOIN (SELECT source_url, min(id) AS id FROM products GROUP BY 1) u ON u.source_url = 'https://www.shop5.example.com/products/' || replace(p_name, ' ', '-') AND p_partkey % 2 = 0
    LEFT JOIN {PRODUCT_KEYS} k ON k.maker_id = CAST(substr(p_brand, 7) AS BIGINT) AND k.k = {NORM.format('p_name')}""", "products")
def _(t):
    pages = t.part.select(F.col("p_partkey").alias("page"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("https://www.shop5.example.com/products/"), F.translate("p_name", " ", "-"), F.lit("/"))).alias("source_url"), F.col("p_brand").alias("maker"), F.concat("p_brand", F.lit(" "), "p_name").alias("display_name"), F.translate("p_name", " ", "-").alias("slug"))
    makers = t.makers.withColumn("canonical_name", F.concat(F.lit("Brand#"), F.col("id").cast("string")))
    found = resolve.match_pages(pages, t.products, resolve.name_dictionary(makers, t.maker_names, ("canonical",)))
    return found.select(F.col("page").alias("id"), "product_id", "match_kind")


@query("r11_relink")
def _(t):
    links = t.part.select(F.col("p_partkey").alias("id"), F.substring("p_brand", 7, 9).cast("long").alias("maker_id"), F.lit(None).cast("long").alias("product_id"), F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, " mkII").otherwise("")).alias("label"), F.lit("a").alias("source_name"))
    return resolve.relink(links, t.products)


SQL["r11_relink"] = with_tables(f"""SELECT p_partkey AS id, CAST(substr(p_brand, 7) AS BIGINT) AS maker_id, k.product_id,
    CASE WHEN k.product_id IS NULL THEN NULL WHEN p_partkey % 2 = 0 THEN 'mark' ELSE 'key' END AS match_kind FROM part LEFT JOIN {PRODUCT_KEYS} k ON k.maker_id = CAST(substr(p_brand, 7) AS BIGINT) AND k.k = {NORM.format('p_name')}""", "products")


@query("r12_match_contained", f"""SELECT p_partkey AS id, max_by(k.product_id, row(length(k.k), k.k)) AS product_id FROM part JOIN {PRODUCT_KEYS} k ON k.maker_id = CAST(substr(p_brand, 7) AS BIGINT) AND length(k.k) >= 3 AND contains('manual' || {NORM.format('p_name')} || 'pdf', k.k) GROUP BY 1""", "products")
def _(t):
    links = t.part.select(F.col("p_partkey").alias("id"), F.substring("p_brand", 7, 9).cast("long").alias("maker_id"), F.concat(F.lit("Manual: "), "p_name", F.lit(".pdf")).alias("label"))
    return resolve.match_contained(links, t.products)


@query("r13_match_posts", f"""SELECT p_partkey AS post_id, k.maker_id, k.product_id, 1970 + p_size AS year FROM part JOIN {PRODUCT_KEYS} k ON k.maker_id = CAST(substr(p_brand, 7) AS BIGINT) AND k.k = {NORM.format('p_name')}""", "products")
def _(t):
    posts = t.part.select(F.col("p_partkey").alias("post_id"), F.array(F.lit("Synthesizer"), F.concat(F.lit("Old Brand "), F.substring("p_brand", 7, 9)), F.col("p_name"), (F.col("p_size") + 1970).cast("string"), (F.col("p_size") + 1975).cast("string")).alias("labels"))
    return resolve.match_posts(posts, t.products, t.dictionary())


@query("r14_verify_hits")
def _(t):
    hits = t.products.join(t.makers.select(F.col("id").alias("maker_id"), "canonical_name"), "maker_id").select("id", F.col("name").alias("product"), F.col("canonical_name").alias("maker"), F.concat("canonical_name", F.lit(" "), F.regexp_replace("name", r" \(mk2\)", F.when(F.col("id") % 2 == 0, "").otherwise(" mk2"))).alias("title"), F.lit("").alias("summary"), F.array().cast("array<string>").alias("labels"))
    return resolve.verify_hits(hits).select("id", "grade")


SQL["r14_verify_hits"] = with_tables("SELECT id, CASE WHEN contains(name, '(mk2)') AND id % 2 = 0 THEN 'base' ELSE 'full' END AS grade FROM products", "products")


@query("r15_new_names", dictionary_sql(f"""SELECT min(name) AS name FROM queue WHERE {NORM.format('name')} <> '' AND {NORM.format('name')} NOT IN (SELECT {NORM.format('name')} FROM names) GROUP BY {NORM.format('name')}""", "queue"))
def _(t):
    return resolve.new_names(t.queue.select("name"), t.dictionary().select("name"))


@query("r17_category_members", """SELECT member AS title, min(root) AS root FROM (SELECT 'item' || p_partkey AS member, p_type AS root FROM part WHERE p_type IN ('ECONOMY', 'SMALL')
    UNION ALL SELECT 'order' || o_orderkey, p.p_type FROM orders JOIN part p ON p.p_partkey = o_orderkey % 2000 WHERE p.p_type IN ('ECONOMY', 'SMALL')) GROUP BY 1""")
def _(t):
    item = F.concat(F.lit("item"), F.col("p_partkey").cast("string"))
    own = t.part.select(F.col("p_type").alias("category"), item.alias("member"))
    edges = own.withColumn("kind", F.lit("page")).union(own.withColumn("kind", F.lit("subcat")))
    below = t.orders.select(F.concat(F.lit("item"), (F.col("o_orderkey") % 2000).cast("string")).alias("category"), F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("member"), F.lit("page").alias("kind"))
    return resolve.category_members(edges.union(below), ["ECONOMY", "SMALL"])


@query("r18_lead_gap", f"""SELECT maker_id, count(*) AS n, array_to_string(list(name ORDER BY name, k)[1:50], ', ') AS models FROM (
    SELECT maker_id, {NORM.format('name')} AS k, min(name) AS name FROM (SELECT (CAST(substr(p_brand, 7) AS BIGINT) + 1) % 25 AS maker_id, p_name AS name FROM part) GROUP BY 1, 2) l
    WHERE NOT EXISTS (SELECT 1 FROM {PRODUCT_KEYS} p WHERE p.maker_id = l.maker_id AND p.k = l.k) GROUP BY 1""", "products")
def _(t):
    return resolve.lead_gap(t.part.select(((F.substring("p_brand", 7, 9).cast("long") + 1) % 25).alias("maker_id"), F.col("p_name").alias("name")), t.products)


@query("r18_lead_rows", f"""SELECT maker_id, k AS model_key, name FROM (
    SELECT maker_id, {NORM.format('name')} AS k, min(name) AS name FROM (SELECT (CAST(substr(p_brand, 7) AS BIGINT) + 1) % 25 AS maker_id, p_name AS name FROM part) GROUP BY 1, 2) l
    WHERE NOT EXISTS (SELECT 1 FROM {PRODUCT_KEYS} p WHERE p.maker_id = l.maker_id AND p.k = l.k)""", "products")
def _(t):
    return resolve.lead_gap_rows(t.part.select(((F.substring("p_brand", 7, 9).cast("long") + 1) % 25).alias("maker_id"), F.col("p_name").alias("name")), t.products)


@query("r19_new_products", f"""SELECT maker_id, min(name) AS name, min(slug) AS slug FROM (SELECT (CAST(substr(p_brand, 7) AS BIGINT) + 1) % 25 AS maker_id, p_name AS name, replace(p_name, ' ', '-') AS slug FROM part) f
    WHERE NOT EXISTS (SELECT 1 FROM {PRODUCT_KEYS} p WHERE p.maker_id = f.maker_id AND p.k = {NORM.format('f.name')}) GROUP BY maker_id, {NORM.format('name')}""", "products")
def _(t):
    found = t.part.select(((F.substring("p_brand", 7, 9).cast("long") + 1) % 25).alias("maker_id"), F.col("p_name").alias("name"), F.translate("p_name", " ", "-").alias("slug"))
    return resolve.new_products(found.union(found.withColumn("slug", F.concat("slug", F.lit("-0")))), t.products)


@query("r20_brand_aliases", """SELECT p_partkey AS post_id, CAST(substr(p_brand, 7) AS BIGINT) AS maker_id, CASE WHEN p_partkey % 3 = 1 THEN p_brand ELSE 'OB ' || substr(p_brand, 7) END AS tag,
    CASE WHEN p_partkey % 3 = 1 THEN 'OB ' || substr(p_brand, 7) || ' ' || p_name ELSE p_name END AS model FROM part
    WHERE p_partkey % 5 > 0 AND p_partkey % 7 > 0 AND (p_partkey % 3 <> 1 OR CAST(substr(p_brand, 7) AS INT) % 5 > 0)""")  # fmt: skip
def _(t):
    """Makers go by "OB n"; by turns the tag is the alias, the name, or an alias of nobody before the alias; every fifth maker has a longer name; titles may be blank, first categories end in blanks."""
    number, key = F.substring("p_brand", 7, 9), F.col("p_partkey")
    alias = F.concat(F.lit("OB "), number)
    aliases = t.part.select(F.concat(F.lit(" ob "), number).alias("alias"), F.concat(F.lit("Old Brand "), number).alias("name")).distinct()
    aliases = aliases.union(aliases.sparkSession.createDataFrame([("ghost", "Nobody At All")], "alias string, name string"))
    tags = F.when(key % 3 == 0, F.array(alias)).when(key % 3 == 1, F.array("p_brand")).otherwise(F.array(F.lit("Ghost"), alias))
    title = F.when(key % 5 == 0, " ").otherwise(F.concat(alias, F.lit(" "), "p_name"))
    posts = t.part.select(key.alias("post_id"), title.alias("title"), tags.alias("tags"), F.array(F.when(key % 7 == 0, " Downloads ").otherwise("reviews")).alias("categories"))
    return resolve.brand_from_tags(posts, t.dictionary(), ("downloads",), aliases)


@query("r20_brand_from_tags", dictionary_sql(r"""SELECT p_partkey AS post_id, CAST(CASE p_partkey % 4 WHEN 1 THEN '1' ELSE substr(p_brand, 7) END AS BIGINT) AS maker_id,
    CASE p_partkey % 4 WHEN 0 THEN 'Old Brand ' || substr(p_brand, 7) WHEN 1 THEN 'Brand#1' ELSE 'old brand ' || substr(p_brand, 7) END AS tag,
    CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'Nobody ' || p_name ELSE regexp_replace(p_name, '^Brand#1\s+', '', 'i') END AS model FROM part WHERE p_partkey % 4 <> 3"""))
def _(t):
    brand, kind = F.concat(F.lit("Old Brand "), F.substring("p_brand", 7, 9)), F.col("p_partkey") % 4
    title = F.when(kind == 1, F.concat(F.lit("Nobody "), F.col("p_name"))).otherwise(F.concat(brand, F.lit("  "), F.col("p_name")))
    tags = F.when(kind == 0, F.array(F.lit("news"), brand, F.lit("Brand#1"))).when(kind == 1, F.array(F.lit("news"), F.lit("Brand#1"), brand)).otherwise(F.array(F.lower(brand), F.lit("Brand#1")))
    posts = t.part.select(F.col("p_partkey").alias("post_id"), title.alias("title"), tags.alias("tags"), F.array(F.when(kind == 3, "Downloads").otherwise("reviews")).alias("categories"))
    return resolve.brand_from_tags(posts, t.dictionary(), ("downloads",))


# Classifiers and pages

ANCHORS = f"""a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>(?s:.*?)</a>', 1, 'is')) AS href FROM pages),
    l AS (SELECT DISTINCT page_id, CASE WHEN starts_with(href, '/') THEN {SITE} || href ELSE href END AS link FROM a)"""


@query("w2_link_graph", f"WITH {ANCHORS} SELECT domain, count(*) AS links, count(DISTINCT page_id) AS spread FROM (SELECT page_id, {HOST.format('link')} AS domain FROM l) WHERE domain <> '' GROUP BY 1")
def _(t):
    links = t.pages.select("page_id", F.explode(extract.page_urls("html", "url")).alias("url"))
    return reports.domain_graph(links.select(keys.domain_of("url").alias("domain"), F.col("page_id").alias("product_id"), F.lit(None).cast("long").alias("maker_id")))


def _contains_any(text: str, words) -> str:
    return "(" + " OR ".join("contains({0}, '{1}')".format(text, w) for w in words) + ")"


@query("c2_link_types_over_tables", "SELECT id, CASE WHEN regexp_matches(url, '(?i)\\.(mp3|wav|flac|ogg|m4a|aiff?)(\\?|$)') THEN 'audio_demo' " + " ".join(f"WHEN {_contains_any('hay', w)} THEN '{k}'" for k, w in (("archive", vocab.ARCHIVE), ("community", vocab.COMMUNITY), ("service_mod", vocab.SERVICE), ("samples", vocab.SAMPLES), ("retailer", vocab.RETAIL), ("media", vocab.MEDIA))) + " ELSE 'other' END AS link_type FROM (SELECT id, url, lower(label || ' ' || url) AS hay FROM links)", "links")
def _(t):
    return t.links.select("id", classify.link_type("url", "label", "domain", F.lit(False)).alias("link_type"))


@query("c1_official_over_tables", f"SELECT page_id, {LABEL.format(HOST.format('url'))} = 'example' AS official FROM pages")
def _(t):
    return t.pages.select("page_id", classify.is_official(keys.domain_of("url"), F.lit("Example Corporation")).alias("official"))


@query("c4_product_urls_over_tables", dictionary_sql("SELECT source_url AS url, 'A:path-marker' AS signal FROM products WHERE source_url IS NOT NULL GROUP BY 1", "products"))
def _(t):
    urls = t.products.filter("source_url is not null").select(F.col("source_url").alias("url")).distinct()
    return classify.product_like(urls, "url", t.dictionary("canonical", "history"), "url")


@query("c5_product_hint_over_tables", r"SELECT page_id, regexp_matches(url, '(?i)/(products?|instruments?|synths?|synthesizers?|keyboards?|modules?|gear)/[^/]+') AS hint FROM pages")
def _(t):
    return t.pages.select("page_id", classify.product_hint("url").alias("hint"))


def _title(c: str = "html"):
    return F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)


def _words(pattern: str) -> str:
    return pattern.replace("(?iu)", "(?i)").replace("(?U)", "").replace("(?iU)", "(?i)").replace("'", "''")


@query("c6_title_verdicts_over_tables", f"""WITH t AS (SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS title FROM pages),
    s AS (SELECT *, list_filter(string_split(title, '|'), lambda x: trim(x) <> '') AS segs FROM t),
    w AS (SELECT *, array_to_string(CASE WHEN len(segs) > 1 THEN segs[1:len(segs) - 1] ELSE segs END, ' ') AS text FROM s),
    v AS (SELECT *, regexp_matches(text, '{_words(vocab.INSTRUMENT_WORD)}') AS i, regexp_matches(text, '{_words(vocab.NOT_SOUND_SOURCE)}') AS o, regexp_matches(title, '{_words(vocab.DECISIVE_NOT)}') AS d FROM w)
    SELECT page_id, CASE WHEN d THEN 'not-instrument' WHEN i AND NOT o THEN CASE WHEN len(segs) < 2 THEN 'undecided' ELSE 'instrument' END WHEN o AND NOT i THEN 'not-instrument' ELSE 'undecided' END AS verdict FROM v""")
def _(t):
    # its SQL decodes these five entities, with their semicolons; html.unescape, the operator's own, also takes others and a cut "&amp"
    title = _title()
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(entity), F.lit(char))
    return t.pages.select("page_id", classify.title_verdict(F.lit(""), F.lit(""), title, decode=False).alias("verdict"))


@query("c7_title_category_over_tables", r"SELECT page_id, coalesce(lower(list_extract(regexp_extract_all(split_part(title, '|', 1), '(?i)\b(synthesi[sz]er|synth|piano|organ|drum machine|drum|sampler|sequencer|keyboard|workstation|vocoder|arranger)\b', 1), -1)), '') AS category FROM (SELECT page_id, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') AS title FROM pages)")
def _(t):
    return t.pages.select("page_id", classify.title_category(_title()).alias("category"))


@query("c8_scope_over_tables", f"SELECT p_partkey AS id, CASE WHEN regexp_matches(p_name, '{vocab.OUT_OF_SCOPE}') OR regexp_matches(p_name, '{vocab.EFFECT_ONLY}') THEN 'out' WHEN regexp_matches(p_name, '{vocab.IN_SCOPE}') THEN 'in' ELSE 'ask' END AS bucket FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.scope_bucket("p_name").alias("bucket"))


@query("c13_link_health", """SELECT url, CASE WHEN code BETWEEN 200 AND 299 THEN 'live' WHEN code IN (404, 410) THEN 'dead' WHEN code IN (401, 402, 403, 451) THEN 'blocked' ELSE 'error' END AS status, code AS http_status
    FROM (SELECT url, coalesce(min(code) FILTER (method = 'HEAD' AND code NOT IN (403, 405, 501)), min(code) FILTER (method = 'GET'), min(code)) AS code FROM (
        SELECT url, CASE WHEN id % 2 = 0 THEN 'HEAD' ELSE 'GET' END AS method, CASE source_name WHEN 'error' THEN 404 WHEN 'view' THEN 403 WHEN 'click' THEN 200 WHEN 'signup' THEN 405 ELSE 500 END AS code FROM links) GROUP BY url)""", "links")
def _(t):
    code = F.when(F.col("source_name") == "error", 404).when(F.col("source_name") == "view", 403).when(F.col("source_name") == "click", 200).when(F.col("source_name") == "signup", 405).otherwise(500)
    none = F.lit(None).cast("string")
    probes = t.links.select("url", F.when(F.col("id") % 2 == 0, "HEAD").otherwise("GET").alias("method"), code.alias("http_code"), none.alias("final_url"), none.alias("error"))
    return classify.link_health(probes).select("url", "status", "http_status")


@query("c15_discovery_funnel", dictionary_sql(f"""SELECT c.name, n, CASE WHEN n < 5 THEN 'thin' WHEN b.key IS NOT NULL OR a.lower_name IS NOT NULL THEN 'known' WHEN q.l IS NOT NULL THEN 'queued' ELSE 'take' END AS outcome
    FROM (SELECT s_name AS name, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1 UNION ALL SELECT p_brand, count(*) FROM part GROUP BY 1) c
    LEFT JOIN by_name a ON a.lower_name = lower(trim(c.name)) LEFT JOIN by_key b ON b.key = {NORM.format('c.name')} LEFT JOIN (SELECT DISTINCT lower(trim(name)) AS l FROM queue) q ON q.l = lower(trim(c.name))""", "queue"))
def _(t):
    names = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("s_name").alias("name")).union(t.part.select("p_brand"))
    return classify.discovery_funnel(names, t.dictionary(), t.queue)


@query("x6_page_links", f"WITH {ANCHORS} SELECT page_id, count(DISTINCT href) AS links FROM a GROUP BY 1")
def _(t):
    return extract.page_links(t.pages, "page_id").groupBy("page_id").agg(F.count("*").alias("links"))


@query("x8_x9_years", r"""SELECT id, list_min(list_filter(list_transform(regexp_extract_all(label, '\b((?:19|20)[0-9]{2})\b', 1), lambda x: CAST(x AS INT)), lambda x: x BETWEEN 1940 AND 2024)) AS label_year FROM links""", "links")
def _(t):
    return t.links.select("id", extract.label_year("label", 2024).alias("label_year"))


@query("s7_listing_entries_over_tables", r"""SELECT page_id, count(*) AS entries FROM (SELECT DISTINCT page_id, replace(replace(replace(unnest(regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1, 'i')), '&#39;', ''''), '&quot;', '"'), '&amp;', '&') AS e FROM pages)
    WHERE NOT regexp_matches(e, '^(http|mailto|\?|/|#)') AND e NOT IN ('..', '../') AND (ends_with(e, '/') OR regexp_matches(e, '(?i)\.(pdf|zip|jpe?g|gif|png|tiff?|doc|djvu)$')) GROUP BY 1""")
def _(t):
    return readers.listing_entries(t.pages, "page_id").groupBy("page_id").agg(F.count("*").alias("entries"))


# Evidence

CONFIRMED = f"""(SELECT entity_id, field_name, bool_or(o) OR max(n) >= 2 AS confirmed FROM (
    SELECT entity_id, field_name, CASE WHEN field_name = 'short_history' THEN '' ELSE {VALUE_KEY.format('value')} END AS v, count(DISTINCT source_url) AS n, bool_or(source_tier = 'manufacturer_official') AS o FROM claims GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


@query("k1_field_confidence", f"SELECT * FROM {CONFIRMED}", "claims")
def _(t):
    return evidence.field_confidence(t.claims)


@query("k2_roll_up", f"""SELECT id AS entity_id, CASE WHEN reasons = '' THEN 'confirmed' ELSE 'needs_review' END AS confidence, reasons FROM (
    SELECT m.id, concat_ws('; ', CASE WHEN country IS NOT NULL AND NOT coalesce(bool_or(c.confirmed) FILTER (c.field_name = 'country'), false) THEN 'country not confirmed' END,
        CASE WHEN short_history IS NOT NULL AND NOT coalesce(bool_or(c.confirmed) FILTER (c.field_name = 'short_history'), false) THEN 'short_history not confirmed' END) AS reasons
    FROM makers m LEFT JOIN {CONFIRMED} c ON c.entity_id = m.id GROUP BY m.id, country, short_history)""", "makers", "claims")
def _(t):
    entries = t.makers.select(F.col("id").alias("entity_id"), "country", "short_history", F.array().cast("array<string>").alias("conflicts"))
    return evidence.roll_up(entries, t.claims, core=("country", "short_history"))


@query("k4_merge_makers", """SELECT coalesce(m.canonical_name, e.canonical_name) AS canonical_name, coalesce(e.country, m.country) AS country,
    CASE WHEN e.canonical_name IS NULL THEN m.confidence WHEN m.canonical_name IS NULL THEN 'needs_review' WHEN m.confidence = 'confirmed' THEN 'confirmed' ELSE 'needs_review' END AS confidence,
    CASE WHEN m.canonical_name IS NULL THEN 'inserted' WHEN e.canonical_name IS NULL THEN 'kept' ELSE 'merged' END AS change
    FROM makers m FULL JOIN (SELECT DISTINCT p_brand AS canonical_name, 'Land' AS country FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 2 = 0) e ON e.canonical_name = m.canonical_name""", "makers")
def _(t):
    entries = t.part.filter(F.substring("p_brand", 7, 9).cast("int") % 2 == 0).select(F.col("p_brand").alias("canonical_name")).distinct()
    entries = entries.select("canonical_name", F.lit("Land").alias("country"), F.lit(1).alias("n_sources"), F.lit(0).alias("n_conflicts"), F.lit("needs_review").alias("confidence"))
    return evidence.merge_makers(t.makers, entries, ["country"])


@query("k5_append_new", """SELECT entity_id, field_name, source_url FROM claims EXCEPT SELECT entity_id, field_name, source_url FROM claims WHERE id % 2 = 0""", "claims")
def _(t):
    columns = ["entity_id", "field_name", "source_url"]
    return evidence.append_new(t.claims.select(*columns), t.claims.filter("id % 2 = 0").select(*columns), columns)


@query("k6_stubs", "SELECT DISTINCT s_name AS canonical_name FROM supplier WHERE lower(trim(s_name)) NOT IN (SELECT lower(trim(canonical_name)) FROM makers)", "makers")
def _(t):
    stubs, _ = evidence.make_stubs(t.supplier.select(F.col("s_name").alias("related")), t.makers, t.queue)
    return stubs.select("canonical_name")


@query("k8_derive_country", """SELECT m.id, CASE WHEN g.lo = g.hi THEN g.lo END AS country, CASE WHEN g.lo IS NULL THEN 'unknown city' WHEN g.lo <> g.hi THEN 'ambiguous city' ELSE 'derived' END AS status
    FROM makers m LEFT JOIN (SELECT 'city ' || CAST(s_suppkey % 7 AS VARCHAR) AS city, min('Land ' || CAST(s_suppkey % 2 * (s_suppkey % 7 // 4) AS VARCHAR)) AS lo, max('Land ' || CAST(s_suppkey % 2 * (s_suppkey % 7 // 4) AS VARCHAR)) AS hi FROM supplier GROUP BY 1) g ON g.city = lower(m.city) WHERE m.country IS NULL""", "makers")
def _(t):
    seven = F.col("s_suppkey") % 7
    gazetteer = t.supplier.select(F.concat(F.lit("City "), seven.cast("string")).alias("city"), F.concat(F.lit("Land "), (F.col("s_suppkey") % 2 * F.floor(seven / 4)).cast("string")).alias("country"))
    return evidence.derive_country(t.makers, gazetteer)


TECHNOLOGY = """(SELECT s.product_id AS entity_id, CASE WHEN s.value IN ('Digital FM with 6 operators', '16-bit PCM') THEN 'digital' ELSE 'analog' END AS value, s.source_url
    FROM specs s JOIN products p ON p.id = s.product_id AND p.technology = 'unknown' WHERE s.field = 'oscillators' AND (s.value IN ('Digital FM with 6 operators', '16-bit PCM')
    OR s.value = '3 VCOs' AND NOT EXISTS (SELECT 1 FROM specs t WHERE t.product_id = s.product_id AND t.field = 'memory' AND contains(t.value, 'ROM'))))"""


@query("k9_derive_technology", f"SELECT entity_id, value, source_url FROM {TECHNOLOGY}", "specs", "products")
def _(t):
    return evidence.derive_technology(t.specs, t.products).select("entity_id", "value", "source_url")


@query("k10_apply_facts", f"""SELECT p.id, coalesce(CASE WHEN technology = 'unknown' THEN f.v END, technology) AS technology FROM products p
    LEFT JOIN (SELECT entity_id, CASE WHEN min(value) = max(value) THEN min(value) END AS v FROM {TECHNOLOGY} GROUP BY 1) f ON f.entity_id = p.id""", "specs", "products")
def _(t):
    facts = evidence.derive_technology(t.specs, t.products)
    filled, _ = evidence.apply_facts(t.products.select("id", "technology"), facts, t.claims, ["technology"])
    return filled.select("id", "technology")


@query("k11_retract_rule", "SELECT id FROM claims WHERE derived_from IS NULL OR NOT starts_with(derived_from, 'rule_a')", "claims")
def _(t):
    return evidence.retract_rule(t.claims, "rule_a").select("id")


@query("k12_fill_years", f"""SELECT p.id, coalesce(u.y, k.y) AS year, CASE WHEN u.y IS NOT NULL THEN 'url' ELSE 'name' END AS filled_by FROM products p
    LEFT JOIN (SELECT source_url, min(year) AS y FROM products WHERE year IS NOT NULL GROUP BY 1) u ON u.source_url = p.source_url
    LEFT JOIN (SELECT maker_id, {NORM.format('name')} AS k, min(year) AS y FROM products WHERE year IS NOT NULL GROUP BY 1, 2) k ON k.maker_id = p.maker_id AND k.k = {NORM.format('p.name')}
    WHERE p.year IS NULL AND coalesce(u.y, k.y) IS NOT NULL""", "products")
def _(t):
    pages = t.products.filter("year is not null").select("source_url", F.concat(F.lit("Old Brand "), F.col("maker_id").cast("string")).alias("maker"), F.col("name").alias("display_name"), F.concat(F.lit("Produced: "), F.col("year").cast("string"), F.lit(" - later")).alias("produced"))
    return evidence.fill_years(t.products, pages, t.dictionary())


@query("k15_conflicts", f"SELECT entity_id, field_name, count(DISTINCT {VALUE_KEY.format('value')}) AS n_values, array_to_string(list_transform(list_sort(list(DISTINCT {{'v': {VALUE_KEY.format('value')}, 'u': source_url}}))[1:50], lambda x: x.v || ' (' || x.u || ')'), ' vs ') AS shown FROM claims GROUP BY 1, 2 HAVING count(DISTINCT {VALUE_KEY.format('value')}) > 1", "claims")
def _(t):
    return evidence.conflicts(t.claims)


@query("k15_conflict_rows", f"SELECT entity_id, field_name, value_key, source_url FROM (SELECT *, {VALUE_KEY.format('value')} AS value_key FROM claims) QUALIFY min(value_key) OVER (PARTITION BY entity_id, field_name) <> max(value_key) OVER (PARTITION BY entity_id, field_name)", "claims")
def _(t):
    return evidence.conflict_rows(t.claims)


@query("k16_best_value", """SELECT DISTINCT ON (entity_id, field_name) entity_id, field_name, value, source_tier FROM claims
    ORDER BY entity_id, field_name, CASE source_tier WHEN 'manufacturer_official' THEN 2 WHEN 'wikidata' THEN 3 ELSE 4 END, fetched_at DESC, id, value, source_tier""", "claims")
def _(t):
    return evidence.best_value(t.claims)


@query("k17_promote_official_over_tables", """SELECT m.id, 'https://' || d.lo || '/' AS official_website FROM makers m JOIN (SELECT maker_id, min(domain) AS lo, max(domain) AS hi FROM links
    WHERE link_type = 'manufacturer_official' AND status IN ('live', 'redirected', 'blocked') AND maker_id IS NOT NULL GROUP BY 1) d ON d.maker_id = m.id AND d.lo = d.hi WHERE m.official_website IS NULL""", "makers", "links")
def _(t):
    return evidence.promote_official(t.makers, t.links.withColumn("final_url", F.lit(None).cast("string")))[0]


@query("k18_official_candidates", """SELECT l.maker_id, l.url, count(*) AS n, CASE WHEN m.official_website IS NULL THEN 'empty' ELSE 'have' END AS state FROM links l JOIN makers m ON m.id = l.maker_id WHERE l.link_type = 'manufacturer_official' GROUP BY 1, 2, 4""", "makers", "links")
def _(t):
    return evidence.official_candidates(t.makers, t.links)


@query("k19_long_names", """SELECT id, CASE WHEN contains(canonical_name, ' Instruments Ltd') THEN replace(canonical_name, ' Instruments Ltd', '') ELSE canonical_name END AS canonical_name FROM makers""", "makers")
def _(t):
    pairs = t.makers.select("id", F.regexp_replace("canonical_name", " Instruments Ltd", "").alias("short"), F.concat(F.regexp_replace("canonical_name", " Instruments Ltd", ""), F.lit(" Instruments Ltd")).alias("long"))
    return evidence.apply_long_names(t.makers, pairs)[0].select("id", "canonical_name")


@query("k20_stubs", "SELECT id, CASE WHEN country IS NULL AND short_history IS NULL AND id NOT IN (SELECT entity_id FROM claims) THEN 'unresearched' ELSE confidence END AS confidence FROM makers", "makers", "claims")
def _(t):
    return evidence.mark_stubs(t.makers, t.claims).select("id", "confidence")


@query("k21_tag_scope", "SELECT id, CASE WHEN starts_with(canonical_name, 'Brand#1') OR canonical_name = 'Brand#2' THEN 'out_of_scope' ELSE scope END AS scope FROM makers", "makers")
def _(t):
    rules = t.nation.filter("n_nationkey in (1, 2)").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("pattern"), F.when(F.col("n_nationkey") == 1, "prefix").otherwise("name").alias("kind"), F.lit("by rule").alias("note"))
    return evidence.tag_scope(t.makers.withColumn("scope_note", F.lit(None).cast("string")), rules).select("id", "scope")


# Audits


@query("q1_classify_queue", dictionary_sql(f"""SELECT q.id, CASE WHEN b.maker_id IS NULL THEN CASE WHEN c.id IS NOT NULL THEN 'contained' ELSE 'open' END WHEN m.scope = 'out_of_scope' THEN 'out_of_scope' WHEN m.confidence <> 'unresearched' THEN 'stale' ELSE 'stub' END AS class
    FROM queue q LEFT JOIN by_key b ON b.key = {NORM.format('q.name')} AND b.key <> '' LEFT JOIN makers m ON m.id = b.maker_id
    LEFT JOIN (SELECT DISTINCT q.id FROM queue q JOIN names n ON contains(' ' || {SPACED.format('q.name')} || ' ', ' ' || {SPACED.format('n.name')} || ' ')) c ON c.id = q.id WHERE q.status = 'found'""", "queue"))
def _(t):
    return audit.classify_queue(t.queue, t.makers, t.dictionary()).select("id", "class")


@query("q2_stub_kind", """SELECT maker_id, CASE min(r) WHEN 0 THEN 'maker' WHEN 1 THEN 'owner' ELSE 'unknown' END AS kind FROM (
    SELECT maker_id, CASE relation_type WHEN 'successor' THEN 0 WHEN 'owned_by' THEN 1 ELSE 2 END AS r FROM relations UNION ALL SELECT related_id, CASE relation_type WHEN 'successor' THEN 0 WHEN 'owned_by' THEN 1 ELSE 2 END FROM relations) GROUP BY 1""", "relations")
def _(t):
    return audit.stub_kind(t.relations, ["successor"], ["owned_by"])


@query("q4_reissues", r"""SELECT p.id, p.year, l.y AS label_year, 'conflict' AS kind FROM products p JOIN (SELECT product_id, min(CAST(regexp_extract(label, '([0-9]{4})', 1) AS INT)) AS y FROM links WHERE product_id IS NOT NULL GROUP BY 1) l ON l.product_id = p.id
    WHERE p.edition = 'original' AND p.year - l.y >= 2""", "products", "links")
def _(t):
    return audit.reissue_conflicts(t.products, t.links, 2024)


@query("q5_cross_maker_names", f"SELECT {NORM.format('name')} AS model_key, count(DISTINCT maker_id) AS n_makers, count(*) AS n, array_to_string(list_transform(list_sort(list(DISTINCT {{'m': maker_id, 'n': name}}))[1:50], lambda x: x.m || ':' || x.n), ', ') AS shown FROM products WHERE length({NORM.format('name')}) >= 3 GROUP BY 1 HAVING count(DISTINCT maker_id) > 1", "products")
def _(t):
    return audit.cross_maker_names(t.products)


@query("q5_cross_maker_rows", f"SELECT model_key, maker_id, name FROM (SELECT {NORM.format('name')} AS model_key, maker_id, name FROM products) WHERE length(model_key) >= 3 QUALIFY min(maker_id) OVER (PARTITION BY model_key) <> max(maker_id) OVER (PARTITION BY model_key)", "products")
def _(t):
    return audit.cross_maker_rows(t.products)


@query("q6_split_editions", "SELECT edition, count(*) AS n, count(year) AS dated FROM (SELECT CASE WHEN id % 10 = 0 THEN 'reissue' ELSE edition END AS edition, year FROM products UNION ALL SELECT 'original', NULL FROM products WHERE id % 10 = 0) GROUP BY 1", "products")
def _(t):
    decisions = t.products.filter("id % 10 = 0").select("id", (F.col("id") + 1_000_000).alias("new_id"))
    return audit.split_editions(t.products, decisions, t.links, "site1.example.org")[0].groupBy("edition").agg(F.count("*").alias("n"), F.count("year").alias("dated"))


@query("q7_freshness", f"""SELECT 'harvested without harvester' AS rule, domain AS subject FROM domains d WHERE harvester IS NULL AND (domain IN (SELECT {HOST.format('source_url')} FROM products WHERE source_url IS NOT NULL) OR domain IN (SELECT domain FROM links GROUP BY 1 HAVING count(*) >= 20))
    UNION ALL SELECT 'harvester without time', domain FROM domains WHERE harvester IS NOT NULL AND harvested_at IS NULL
    UNION ALL SELECT 'job can run', p_brand FROM (SELECT DISTINCT p_brand FROM part) WHERE ends_with(p_brand, '1')
    UNION ALL SELECT 'queued but researched', q.name FROM queue q WHERE status = 'found' AND lower(q.name) IN (SELECT lower(canonical_name) FROM makers WHERE confidence <> 'unresearched')
    UNION ALL SELECT 'awaiting review', 'products'""", "domains", "products", "links", "queue", "makers")
def _(t):
    backlog = t.part.select(F.col("p_brand").alias("job_name")).distinct().select("job_name", F.lit("pending").alias("status"), F.when(F.endswith("job_name", F.lit("1")), "KESZ: x").otherwise("wait").alias("prerequisite"))
    return audit.freshness_audit(t.domains, t.products, t.links, t.queue, t.makers, backlog).select("rule", "subject")


@query("q8_detach_dead", "SELECT id, CASE WHEN review_status = 'needs_review' AND review_note IS NOT NULL THEN NULL ELSE source_url END AS source_url FROM products", "products")
def _(t):
    return audit.detach_dead(t.products, "2024-01-01").select("id", "source_url")


@query("q9_source_shape", f"""SELECT domain, count(*) AS products, count(DISTINCT source_url) AS urls, CASE WHEN count(DISTINCT source_url) < 5 THEN 'too_small' WHEN count(DISTINCT source_url) / count(*) < 0.5 THEN 'list' ELSE 'per_model' END AS shape
    FROM (SELECT {HOST.format('source_url')} AS domain, source_url FROM products WHERE source_url IS NOT NULL) GROUP BY 1""", "products")
def _(t):
    return audit.source_shape(t.products, t.domains)


@query("q10_detector_recall_over_tables", dictionary_sql(f"""SELECT coalesce(domain, '') AS domain, count(*) AS urls, count(*) AS found FROM (SELECT DISTINCT {HOST.format('source_url')} AS domain, source_url FROM products WHERE source_url IS NOT NULL)
    WHERE domain IN (SELECT h FROM (SELECT {HOST.format('source_url')} AS h, source_url FROM products WHERE source_url IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT source_url) >= 5 AND count(DISTINCT source_url) / count(*) >= 0.5) GROUP BY ROLLUP (domain)""", "products"))
def _(t):
    return audit.detector_recall(t.products, t.domains, t.dictionary("canonical", "history")).select("domain", "urls", "found")


@query("q11_sitemap_yield_over_tables", dictionary_sql(f"SELECT {HOST.format('source_url')} AS domain, count(DISTINCT source_url) AS total, count(DISTINCT source_url) AS product_like FROM products WHERE source_url IS NOT NULL GROUP BY 1", "products"))
def _(t):
    urls = t.products.filter("source_url is not null").select(keys.domain_of("source_url").alias("domain"), F.col("source_url").alias("url")).distinct()
    return audit.sitemap_yield(urls, t.dictionary("canonical", "history")).select("domain", "total", "product_like")


@query("q12_audit_sample", """SELECT url, domain FROM (SELECT url, domain, row_number() OVER (PARTITION BY domain ORDER BY md5(url || '7'), url) AS n FROM (SELECT DISTINCT url, domain FROM links)) WHERE n <= 10""", "links")
def _(t):
    return audit.audit_sample(t.links.select("url", "domain").distinct(), 10, 7)


@query("q13_year_gap", """SELECT a - y AS gap, count(*) AS n FROM (SELECT l.product_id, min(CAST(regexp_extract(l.label, '([0-9]{4})', 1) AS INT)) AS a, min(p.year) AS y FROM links l JOIN products p ON p.id = l.product_id GROUP BY 1) GROUP BY 1""", "links", "products")
def _(t):
    posts = t.links.join(t.products.select(F.col("id").alias("product_id"), "year"), "product_id").select("product_id", extract.label_year("label", 2024).alias("ad_year"), "year")
    return audit.year_gap(posts).select("gap", "n")


@query("q14_drop_chrome", """SELECT url, maker_id FROM links WHERE url NOT IN (SELECT url FROM links GROUP BY 1 HAVING count(DISTINCT maker_id) >= 2)""", "links")
def _(t):
    return audit.drop_chrome(t.links.select("url", "maker_id"), "url", "maker_id", 2)


@query("q16_orphans", "SELECT maker_id, count(*) AS n FROM links WHERE maker_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "links")
def _(t):
    return audit.orphans(t.links, t.products)


@query("q17_resolve_reviews", "SELECT id, CASE WHEN review_status = 'needs_review' AND id % 4 = 0 THEN NULL ELSE review_status END AS review_status FROM products", "products")
def _(t):
    hits = t.products.filter("id % 2 = 0").select(F.col("id").alias("product_id"), F.when(F.col("id") % 4 == 0, "full").otherwise("base").alias("grade"))
    return audit.resolve_reviews(t.products, hits, "2024-01-01").select("id", "review_status")


# Categories and families


@query("t1_build_categories", "SELECT p_type AS name, count(*) AS n FROM part GROUP BY 1")
def _(t):
    return taxonomy.build_categories(t.products)[1].groupBy("name").agg(F.count("*").alias("n"))


@query("t2_category_counts", "SELECT c.name, count(m.product_id) AS n FROM categories c LEFT JOIN membership m ON m.category_id = c.id GROUP BY 1", "categories", "membership")
def _(t):
    return taxonomy.category_counts(t.categories, t.membership)


@query("t3_uncategorised", "SELECT id FROM products WHERE id NOT IN (SELECT product_id FROM membership)", "products", "membership")
def _(t):
    return taxonomy.uncategorised(t.products, t.membership).select("id")


@query("t4_by_function", "SELECT DISTINCT m.canonical_name AS maker, p.name, c.form FROM membership x JOIN categories c ON c.id = x.category_id AND c.function = 'Tool' JOIN products p ON p.id = x.product_id JOIN makers m ON m.id = p.maker_id", "categories", "membership", "products", "makers")
def _(t):
    return taxonomy.by_function(t.products, t.makers, t.categories, t.membership, "tool")


@query("t5_assign", "SELECT product_id, category_id, CASE WHEN product_id % 5 = 0 THEN 1 ELSE is_primary END AS is_primary FROM membership WHERE product_id % 5 <> 1", "membership")
def _(t):
    changes = t.membership.filter("product_id % 5 in (0, 1)").select("product_id", "category_id", F.when(F.col("product_id") % 5 == 0, "primary").otherwise("remove").alias("action"))
    return taxonomy.assign(t.membership, changes)


@query("t6_merge_category", "SELECT DISTINCT product_id, CASE WHEN category_id = 1 THEN 2 ELSE category_id END AS category_id, is_primary FROM membership", "membership")
def _(t):
    return taxonomy.merge_category(t.categories, t.membership, 1, 2)[1]


@query("t7_sync_primary", "SELECT p.id, c.name AS category FROM products p LEFT JOIN membership m ON m.product_id = p.id AND m.is_primary = 1 LEFT JOIN categories c ON c.id = m.category_id", "products", "categories", "membership")
def _(t):
    return taxonomy.sync_primary(t.products, t.categories, t.membership).select("id", "category")


@query("t8_with_family", "SELECT p.id, p.name, 'size ' || p.family_id AS family, p.variant_label FROM products p", "products")
def _(t):
    families = t.part.select(F.col("p_size").cast("long").alias("id")).distinct().select("id", F.concat(F.lit("size "), F.col("id").cast("string")).alias("name"))
    return taxonomy.with_family(t.products, families)


# Reports


@query("a1_domain_graph", "SELECT domain, count(*) AS links, count(DISTINCT coalesce(product_id, -maker_id)) AS spread FROM links GROUP BY 1", "links")
def _(t):
    return reports.domain_graph(t.links)


@query("a2_last_harvest", "SELECT d.domain, max(e.ts) AS harvested_at FROM domains d LEFT JOIN (SELECT 'site' || CAST(user_id % 31 AS VARCHAR) || '.example.org' AS domain, ts FROM events) e ON e.domain = d.domain WHERE d.harvester IS NOT NULL GROUP BY 1", "domains")
def _(t):
    when = t.events.select(F.col("event_id").alias("id"), F.col("ts").alias("created_at"))
    products = t.products.withColumn("created_at", F.lit(None).cast("timestamp"))
    return reports.last_harvest(t.domains, products.filter("source_url like 'none%'"), t.links.join(when, "id"))


@query("a3_confidence_counts", """SELECT count(*) FILTER (entity_type = 'company' AND scope <> 'out_of_scope' AND confidence = 'confirmed') AS confirmed, count(*) FILTER (entity_type = 'company' AND scope <> 'out_of_scope' AND confidence = 'needs_review') AS needs_review,
    count(*) FILTER (entity_type = 'company' AND scope <> 'out_of_scope' AND confidence = 'unresearched') AS unresearched, count(*) FILTER (entity_type = 'company' AND scope = 'out_of_scope') AS out_of_scope, count(*) FILTER (entity_type = 'individual') AS individuals FROM makers""", "makers")
def _(t):
    return reports.confidence_counts(t.makers)


@query("a4_rank_logos", "SELECT id, row_number() OVER (PARTITION BY maker_id ORDER BY CASE review_status WHEN 'approved' THEN 0 WHEN 'outdated' THEN 2 ELSE 1 END, end_year IS NOT NULL, start_year IS NULL, start_year DESC, id DESC) AS rank FROM logos", "logos")
def _(t):
    return reports.rank_logos(t.logos).select("id", "rank")


@query("a4_logo_state", "SELECT m.id, CASE WHEN bool_or(l.has_file) THEN 'found' WHEN count(l.id) > 0 THEN 'not_found' ELSE 'not_attempted' END AS state FROM makers m LEFT JOIN logos l ON l.maker_id = m.id GROUP BY 1", "makers", "logos")
def _(t):
    return reports.logo_state(t.makers, t.logos)


@query("a5_coverage", r"""SELECT (SELECT count(*) FROM products) AS products, (SELECT count(DISTINCT product_id) FROM membership) AS categorised, count(DISTINCT product_id) FILTER (ends_with(url, '.pdf')) AS with_document,
    count(DISTINCT product_id) FILTER (ends_with(url, '.mp3')) AS with_audio, count(*) FILTER (ends_with(url, '.pdf') OR ends_with(url, '.mp3')) AS file_links, count(*) FILTER (ends_with(url, '.mp3')) AS audio_links FROM links""", "products", "membership", "links")
def _(t):
    return reports.coverage(t.products, t.links, t.membership)


@query("a6_forecast", """SELECT (SELECT count(*) FROM queue WHERE status = 'found' AND lower(name) NOT IN (SELECT lower(canonical_name) FROM makers WHERE scope = 'out_of_scope')) AS queued,
    (SELECT count(*) FROM links WHERE product_id IS NULL AND link_type = 'service_mod') AS unattached, CAST(coalesce(sum(product_urls) FILTER (harvested_at IS NULL), 0) AS BIGINT) AS pending, CAST(coalesce(sum(product_urls) FILTER (harvested_at IS NOT NULL), 0) AS BIGINT) AS done FROM domains""", "queue", "makers", "links", "domains")
def _(t):
    return reports.forecast(t.queue, t.makers, t.links, t.domains)


@query("a7_work_lists", """SELECT * FROM (SELECT 'by yield' AS list, domain, product_urls, inbound_spread FROM domains WHERE verdict = 'harvestable' AND harvester IS NULL AND product_urls > 0 ORDER BY product_urls DESC, domain LIMIT 10)
    UNION ALL SELECT * FROM (SELECT 'by spread', domain, product_urls, inbound_spread FROM domains WHERE verdict = 'harvestable' AND harvester IS NULL AND coalesce(product_urls, 0) = 0 ORDER BY inbound_spread DESC, sitemap_urls DESC, domain LIMIT 10)
    UNION ALL SELECT 'blocked', domain, product_urls, inbound_spread FROM domains WHERE verdict LIKE 'blocked%'""", "domains")
def _(t):
    return reports.work_lists(t.domains)


@query("a8_next_to_probe", "SELECT domain, inbound_spread FROM domains WHERE verdict = 'untested' ORDER BY inbound_spread DESC, domain LIMIT 5", "domains")
def _(t):
    return reports.next_to_probe(t.domains, 5)


@query("a9_spec_summary", "SELECT product_id, count(*) AS n, array_to_string(list_sort(list(label || ': ' || value))[1:50], ' | ') AS summary FROM specs GROUP BY 1", "specs")
def _(t):
    return reports.spec_summary(t.specs)


@query("a10_maker_links", """SELECT id, row_number() OVER (PARTITION BY m ORDER BY product_id IS NOT NULL, CASE status WHEN 'live' THEN 0 WHEN 'redirected' THEN 1 WHEN 'unchecked' THEN 2 WHEN 'blocked' THEN 3 ELSE 4 END, link_type, url, product_id NULLS FIRST, id) AS position
    FROM (SELECT l.*, coalesce(l.maker_id, p.maker_id) AS m FROM links l LEFT JOIN products p ON p.id = l.product_id) WHERE m IS NOT NULL""", "links", "products")
def _(t):
    return reports.maker_links(t.links, t.products).select("id", "position")


@query("a11_az_index", "SELECT letter, count(*) OVER (PARTITION BY letter) AS n, canonical_name FROM (SELECT CASE WHEN regexp_matches(upper(substr(name, 1, 1)), '^[A-Z]$') THEN upper(substr(name, 1, 1)) ELSE '#' END AS letter, name AS canonical_name FROM (SELECT CASE WHEN id % 4 = 0 THEN id || ' ' || canonical_name WHEN id % 4 = 1 THEN 'a' || canonical_name ELSE canonical_name END AS name FROM makers))", "makers")
def _(t):
    name = F.when(F.col("id") % 4 == 0, F.concat(F.col("id").cast("string"), F.lit(" "), "canonical_name")).when(F.col("id") % 4 == 1, F.concat(F.lit("a"), "canonical_name")).otherwise(F.col("canonical_name"))
    return reports.az_index(t.makers.select(name.alias("canonical_name")))


@query("a12_review_list", "SELECT p.id, m.canonical_name AS maker, p.name, p.review_status FROM products p JOIN makers m ON m.id = p.maker_id WHERE p.review_status IS NOT NULL", "products", "makers")
def _(t):
    return reports.review_list(t.products, t.makers)


@query("a13_toggles", """SELECT m.id, CASE WHEN confidence <> 'unresearched' AND n % 2 = 1 THEN CASE confidence WHEN 'confirmed' THEN 'needs_review' ELSE 'confirmed' END ELSE confidence END AS confidence, n
    FROM makers m JOIN (SELECT user_id % 25 AS id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) a ON a.id = m.id""", "makers")
def _(t):
    actions = t.events.select(F.col("event_id").alias("id"), (F.col("user_id") % 25).alias("maker_id"), F.when(F.col("event_type") == "click", "approve").otherwise("look").alias("action"), F.col("ts").alias("created_at"))
    return reports.toggled(actions, t.makers)


@query("a14_run_summary", "SELECT (SELECT count(*) FROM makers) AS makers, (SELECT count(*) FROM products) AS products, (SELECT count(*) FROM links WHERE product_id IS NOT NULL) AS attached_links, (SELECT count(*) FROM queue WHERE status = 'found') AS open_queue", "makers", "products", "links", "queue")
def _(t):
    return reports.run_summary(t.makers, t.products, t.links, t.queue)


@query("a15_queue_order", "SELECT id, name, priority FROM queue WHERE status = 'found'", "queue")
def _(t):
    return reports.queue_order(t.queue)


@query("a16_search", "SELECT id FROM makers WHERE contains(lower(canonical_name), 'ltd')", "makers")
def _(t):
    return reports.search(t.makers, "LTD").select("id")


@query("a17_logo_work_list_over_tables", "SELECT id, canonical_name FROM makers WHERE confidence <> 'unresearched' AND id NOT IN (SELECT maker_id FROM logos WHERE has_file)", "makers", "logos")
def _(t):
    return reports.logo_work_list(t.makers, t.logos.filter("has_file"))


@query("a18_verify_work_list", "SELECT id, name FROM products WHERE id NOT IN (SELECT product_id FROM links WHERE source_name = 'click' AND product_id IS NOT NULL) ORDER BY CASE WHEN review_status = 'needs_review' THEN 0 ELSE 1 END, CASE WHEN source_url IS NULL THEN 0 ELSE 1 END, id LIMIT 50", "products", "links")
def _(t):
    return reports.verify_work_list(t.products, t.links, "click", 50)


@query("s8_publish", "SELECT m.id AS maker_id, m.canonical_name, count(p.id) AS n_products, string_agg(p.name, '|' ORDER BY coalesce(p.year, 9999), p.name, p.category) AS names FROM makers m LEFT JOIN products p ON p.maker_id = m.id GROUP BY 1, 2", "makers", "products")
def _(t):
    out = readers.publish(t.makers, t.maker_names, t.products, t.relations, t.logos)
    return out.select("maker_id", "canonical_name", F.coalesce(F.size("instruments"), F.lit(0)).cast("long").alias("n_products"), F.array_join(F.transform("instruments", lambda x: x["name"]), "|").alias("names"))


# More scalars, classifiers, extraction and evidence


@query("n8_slug_titles_over_tables", "SELECT p_partkey AS id, array_to_string(list_transform(string_split(p_name, ' '), lambda w: CASE WHEN length(w) <= 3 AND w NOT IN ('new', 'old') THEN upper(w) ELSE upper(w[1]) || w[2:] END), ' ') AS title FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), keys.title_case_slug(F.translate("p_name", " ", "-")).alias("title"))


@query("n9_models_over_tables", "SELECT p_partkey AS id, upper(replace(p_name, ' ', '-') || '-' || p_size) AS model, upper(replace(p_name, ' ', '')) AS family FROM part")
def _(t):
    model = keys.tidy_model(F.concat(F.translate("p_name", " ", "-"), F.lit("-"), F.col("p_size").cast("string")))
    return t.part.select(F.col("p_partkey").alias("id"), model.alias("model"), keys.collapse_variant(F.concat(F.regexp_replace("p_name", " ", ""), F.lit("bk"))).alias("family"))


@query("n14_doc_models_over_tables", "SELECT p_partkey AS id, p_name AS model, 'Service Manual' AS doc_type FROM part")
def _(t):
    doc = keys.doc_model("p_type", F.concat(F.lower("p_type"), F.lit("_"), F.translate("p_name", " ", "_"), F.lit("_SERVICE_MANUAL.pdf")))
    return t.part.select(F.col("p_partkey").alias("id"), doc.alias("d")).select("id", "d.model", "d.doc_type")


@query("r16_identify_over_tables", "SELECT id AS maker_id, CASE WHEN id % 2 = 0 THEN 'Q' || (id * 10 + 2) ELSE 'Q' || (id * 10 + 1) END AS qid FROM makers", "makers")
def _(t):
    makers = t.makers.select(F.col("id").alias("maker_id"), F.col("canonical_name").alias("name"), "official_website")
    none = F.array().cast("array<string>")
    own = makers.select("maker_id", F.lit(1).alias("rank"), F.concat(F.lit("Q"), (F.col("maker_id") * 10 + 1).cast("string")).alias("qid"), F.col("name").alias("label"), none.alias("aliases"), F.when(F.col("maker_id") % 2 == 0, F.array(F.lit("school"))).otherwise(F.array(F.lit("company"))).alias("types"), none.alias("industry"), none.alias("websites"))
    site = makers.select("maker_id", F.lit(2), F.concat(F.lit("Q"), (F.col("maker_id") * 10 + 2).cast("string")), F.lit("Other"), none, none, none, F.when(F.col("maker_id") % 2 == 0, F.array("official_website")).otherwise(none))
    return resolve.identify(makers, own.union(site), ["school"], ["company"]).select("maker_id", "qid")


@query("c3_route_links_over_tables", "SELECT DISTINCT CASE WHEN product_id IS NULL THEN maker_id END AS maker_id, product_id, url FROM links", "links")
def _(t):
    pages = t.links.select("maker_id", F.lit("Nobody").alias("maker"), "product_id", F.array(F.struct("url", "label")).alias("links"))
    return classify.route_links(pages).select("maker_id", "product_id", "url")


@query("c9_sitemap_products", "SELECT p_type || '/' || p_brand AS path, replace(p_name, ' ', '-') AS slug, CASE WHEN p_type = 'ECONOMY' THEN 'kept' ELSE 'skipped' END AS status FROM part GROUP BY 1, 2, 3")
def _(t):
    urls = t.part.select(F.concat(F.lit("https://x.example.com/"), "p_type", F.lit("/products/"), "p_brand", F.lit("/"), F.translate("p_name", " ", "-")).alias("url"))
    config = t.part.filter("p_type = 'ECONOMY'").select(F.concat_ws("/", "p_type", "p_brand").alias("path")).distinct().withColumn("category", F.lit("Tool"))
    return classify.sitemap_products(urls, config, r"/([^/]+)/products/([^/]+)/([^/]+)/?$").select("path", "slug", "status")


@query("c10_c17_types_over_tables", "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'module' ELSE 'manual' END AS decision FROM part WHERE p_type IN ('ECONOMY', 'SMALL') AND p_brand <> 'Brand#1'")
def _(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("product_type"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("external_id"), F.array("p_brand").alias("types"))
    return classify.split_hardware(classify.filter_types(rows, reject=["Brand#1"]), ["ECONOMY", "SMALL"]).select("id", "decision")


@query("c11_c12_documents_over_tables", "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'Vermona' END AS brand, CASE WHEN p_partkey % 2 = 0 THEN 'folder' ELSE 'section' END AS reason, 'service_mod' AS link_type FROM part")
def _(t):
    folder = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Archiv_Hans_Ohms/"), F.replace("p_brand", F.lit("#"), F.lit("%23")))).otherwise(F.lit("files"))
    url = F.concat(F.lit("https://b.example.de/"), folder, F.lit("/a.pdf"))
    section = F.lit("dokumente_vermona-schaltplaene")
    brand = classify.brand_of(url, section, ["Framus"], {"vermona-schaltplaene": "Vermona"})
    return t.part.select(F.col("p_partkey").alias("id"), brand.alias("b"), classify.doc_link_type(section).alias("link_type")).select("id", "b.brand", "b.reason", "link_type")


@query("c14_domain_verdicts_over_tables", """SELECT domain, CASE WHEN product_urls % 5 = 0 THEN 'manual' WHEN sitemap_urls % 3 = 0 THEN 'harvestable' WHEN product_urls % 2 = 0 THEN 'html_only' ELSE 'blocked_bot' END AS verdict FROM domains""", "domains")
def _(t):
    probes = t.domains.select("domain", F.lit("").alias("robots_text"), F.when(F.col("sitemap_urls") % 3 == 0, 200).otherwise(404).alias("sitemap_code"), F.lit("<loc>x</loc>").alias("sitemap_text"), F.when(F.col("product_urls") % 2 == 0, 200).otherwise(403).alias("home_code"), F.lit(None).cast("string").alias("error"))
    manual = t.domains.filter("product_urls % 5 = 0").select("domain", F.lit("manual").alias("verdict"))
    return classify.domain_verdict(probes, manual)


@query("c16_label_candidates", """SELECT p_brand AS name, n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) WHERE n >= 3 AND p_brand NOT IN ('Brand#1', 'Brand#2')""")
def _(t):
    labels = t.part.groupBy("p_brand").agg(F.count("*").alias("n")).select(F.concat("p_brand", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("label"))
    known = t.nation.filter("n_nationkey in (1, 2)").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("name"))
    return classify.label_candidates(labels, known)


@query("x2_x4_cached_pages_over_tables", "SELECT p_partkey AS id, p_partkey % 50 = 0 AS dead, CASE WHEN p_partkey % 50 <> 0 THEN 1950 + p_size END AS year, CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS device, CASE WHEN p_partkey % 50 <> 0 AND p_size % 2 = 0 THEN 'analog' END AS technology FROM part")
def _(t):
    live = F.concat(F.lit("Device:\n"), "p_type", F.lit("\nProduced:\n"), (F.col("p_size") + 1950).cast("string"), F.lit(" - later\nTechnology:\n"), F.when(F.col("p_size") % 2 == 0, "Analog").otherwise("Steam"))
    pages = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 50 == 0, "No such synth").otherwise(live).alias("text"))
    return extract.read_specs(pages).select("id", "dead", "year", "device", "technology")


@query("x5_spec_blocks_over_tables", "SELECT p_partkey AS id, 'keys' AS field, CAST(p_size AS VARCHAR) AS value FROM part UNION ALL SELECT p_partkey, 'body_type', p_type FROM part")
def _(t):
    text = F.concat(F.lit("About\nTECHNICAL SPECIFICATIONS\nKeys: "), F.col("p_size").cast("string"), F.lit("\nBody type:\n"), "p_type", F.lit("\nKeys: 0"))
    return extract.spec_blocks(t.part.select(F.col("p_partkey").alias("id"), text.alias("text")), "id").select("id", "field", "value")


@query("x12_specs_long_over_tables", "SELECT p_partkey AS id, 'body_type' AS field, p_type AS value FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part")
def _(t):
    specs = F.create_map(F.lit("Body Type"), F.col("p_type"), F.lit("Size"), F.col("p_size").cast("string"), F.lit("Empty"), F.lit(" "))
    return extract.specs_long(t.part.select(F.col("p_partkey").alias("id"), specs.alias("specs")), "id").select("id", "field", "value")


@query("k3_flatten_conflict_over_tables", "SELECT p_partkey AS id, 'year: ' || p_size || ' (u1) vs ' || p_brand || ' -- ' || p_type AS conflict FROM part")
def _(t):
    values = F.array(F.struct(F.col("p_size").cast("string").alias("value"), F.lit("u1").alias("url")), F.struct(F.col("p_brand").alias("value"), F.lit(None).cast("string").alias("url")))
    return t.part.select(F.col("p_partkey").alias("id"), evidence.flatten_conflict(F.lit("year"), values, F.col("p_type")).alias("conflict"))


@query("k7_close_queue_over_tables", "SELECT id, CASE WHEN status <> 'done' AND id % 2 = 0 AND contains(name, 'Supplier') THEN 'done' ELSE status END AS status FROM queue", "queue")
def _(t):
    entries = t.supplier.filter("s_suppkey % 2 = 0").select(F.array(F.lit("nobody"), F.upper("s_name")).alias("names"), F.lit("confirmed").alias("confidence"))
    return evidence.close_queue(t.queue, entries).select("id", "status")


@query("k13_fill_from_cache", """SELECT p.id, coalesce(p.year, c.year) AS year, CASE WHEN c.dead THEN 'needs_review' ELSE p.review_status END AS review_status FROM products p
    LEFT JOIN (SELECT source_url, min(1900 + id % 90) AS year, bool_or(id % 100 = 0) AS dead FROM products WHERE source_url IS NOT NULL GROUP BY 1) c ON c.source_url = p.source_url""", "products")
def _(t):
    none = F.lit(None).cast("string")
    pages = t.products.filter("source_url is not null").select(F.col("source_url").alias("url"), (F.col("id") % 100 == 0).alias("dead"), (F.col("id") % 90 + 1900).alias("year"), none.alias("device"), none.alias("technology"))
    return evidence.fill_from_cache(t.products, pages).select("id", "year", "review_status")


@query("s4_sitemap_urls_over_tables", "SELECT 'd' || p_size AS domain, 'https://d' || p_size || '/' || p_partkey AS url FROM part")
def _(t):
    size = F.col("p_size").cast("string")
    sub = F.concat(F.lit("https://d"), size, F.lit("/sub.xml"))
    domain = F.concat(F.lit("d"), size)
    loc = F.concat(F.lit("<loc>https://d"), size, F.lit("/"), F.col("p_partkey").cast("string"), F.lit("</loc>"))
    subs = t.part.groupBy(domain.alias("domain"), sub.alias("url")).agg(F.array_join(F.collect_list(loc), "").alias("body"))
    index = subs.select("domain", F.concat(F.lit("https://"), "domain", F.lit("/sitemap.xml")), F.concat(F.lit("<sitemapindex><loc>"), "url", F.lit("</loc></sitemapindex>")))
    return readers.sitemap_urls(subs.union(index))


@query("x7_table_rows_over_tables", "SELECT p_partkey AS id, p_brand AS first_cell, 'https://h.example.com/' || p_partkey AS href FROM part WHERE p_size % 2 = 0")
def _(t):
    cells = [F.concat(F.lit("<td>"), "p_brand", F.lit("</td><td><a href='https://h.example.com/"), F.col("p_partkey").cast("string"), F.lit("'>x</a></td>"))]
    row = F.concat(*cells, F.lit("<td>3</td><td>4</td><td>5</td><td>6</td>"), F.when(F.col("p_size") % 2 == 0, "<td>7</td>").otherwise(""))
    pages = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("<table><tbody><tr>"), row, F.lit("</tr></tbody></table>")).alias("html"))
    return extract.table_rows(pages, "id").select("id", F.get("cells", F.lit(0)).alias("first_cell"), "href")


@query("x10_post_taxonomy_over_tables", "SELECT p_partkey AS id, p_name AS title, p_type AS category, p_brand AS tag, 1950 + p_size AS year FROM part")
def _(t):
    link = lambda rel, c: F.concat(F.lit(f'<a rel="{rel}" href="#">'), c, F.lit("</a>"))
    html = F.concat(F.lit("<title>"), "p_name", F.lit("</title>"), link("category", F.col("p_type")), link("tag", F.col("p_brand")), link("tag", (F.col("p_size") + 1950).cast("string")))
    found = extract.post_taxonomy(t.part.select(F.col("p_partkey").alias("id"), html.alias("html")), "id")
    return found.select("id", "title", F.array_join("categories", ",").alias("category"), F.array_join("tags", ",").alias("tag"), "year")


@query("x11_logo_candidates_over_tables", "SELECT page_id, 'https://x.example.com/' || page_id || '/logo.png' AS logo FROM pages")
def _(t):
    html = F.concat(F.lit('<img alt="logo" src="'), F.col("page_id").cast("string"), F.lit('/logo.png">'))
    pages = t.pages.select("page_id", F.lit("https://x.example.com/").alias("url"), F.concat(F.regexp_replace("html", "(?i)<img[^>]*>", ""), html).alias("html"))
    return extract.logo_candidates(pages, "page_id").select("page_id", "logo")


@query("q3_mark_queue", dictionary_sql(f"""SELECT q.id, CASE WHEN q.status <> 'found' OR b.maker_id IS NULL AND c.id IS NULL THEN q.status WHEN b.maker_id IS NULL THEN 'needs_review' WHEN m.scope = 'out_of_scope' THEN 'done' WHEN m.confidence <> 'unresearched' THEN 'needs_review' ELSE q.status END AS status
    FROM queue q LEFT JOIN by_key b ON b.key = {NORM.format('q.name')} AND b.key <> '' LEFT JOIN makers m ON m.id = b.maker_id
    LEFT JOIN (SELECT DISTINCT q.id FROM queue q JOIN names n ON contains(' ' || {SPACED.format('q.name')} || ' ', ' ' || {SPACED.format('n.name')} || ' ')) c ON c.id = q.id""", "queue"))
def _(t):
    classes = audit.classify_queue(t.queue, t.makers, t.dictionary())
    kinds = audit.stub_kind(t.relations, ["successor"], ["owned_by"])
    return audit.mark_queue(t.queue, classes, kinds, "2024-01-01").select("id", "status")


@query("s5_feed_over_tables", "SELECT 'https://p.example.com/' || p_partkey AS url, p_name AS title, p_brand AS label FROM part")
def _(t):
    key = F.col("p_partkey").cast("string")
    text = lambda c: F.struct(c.alias("$t"))
    entry = F.struct(text(F.col("p_name")).alias("title"), text(F.lit("<b>x</b>")).alias("summary"), text(F.lit("2020")).alias("published"), F.array(F.struct(F.col("p_brand").alias("term"))).alias("category"), F.array(F.struct(F.lit("alternate").alias("rel"), F.concat(F.lit("https://p.example.com/"), key).alias("href"))).alias("link"))
    feeds = t.part.select(F.to_json(F.struct(F.struct(F.array(entry).alias("entry")).alias("feed"))).alias("body"))
    return readers.flatten_feed(feeds).select("url", "title", F.array_join("labels", ",").alias("label"))


@query("s6_bindings_over_tables", "SELECT p_name || ' ' || p_partkey AS label, 'Q' || p_partkey AS qid, 1950 + p_size AS year FROM part")
def _(t):
    value = lambda c: F.struct(c.alias("value"))
    key = F.col("p_partkey").cast("string")
    binding = F.struct(value(F.concat(F.lit("http://w.example.com/Q"), key)).alias("item"), value(F.concat("p_name", F.lit(" "), key)).alias("itemLabel"), value(F.col("p_brand")).alias("makerLabel"), value(F.concat((F.col("p_size") + 1950).cast("string"), F.lit("-01-01"))).alias("date"))
    body = F.to_json(F.struct(F.struct(F.array(binding).alias("bindings")).alias("results")))
    return readers.flatten_bindings(t.part.select(body.alias("body"))).select("label", "qid", "year")


from . import branches, cases, kept  # noqa: E402, F401  # register their queries here

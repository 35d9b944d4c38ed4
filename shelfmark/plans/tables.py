"""The catalogue's tables as projections of the driver's tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..ship import ship

PROJECTIONS = {
    "makers": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 5 = 0 THEN p_brand || ' Instruments Ltd' ELSE p_brand END AS canonical_name,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 6 = 0 THEN 'The ' || p_brand || ' Company' END AS long_name,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 4 <> 0 THEN 'NATION_' || CAST(CAST(substr(p_brand, 7) AS INT) % 25 AS VARCHAR(10)) END AS country,
               'City ' || CAST(CAST(substr(p_brand, 7) AS INT) % 9 AS VARCHAR(10)) AS city,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 0 THEN 'unresearched' WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 1 THEN 'confirmed' ELSE 'needs_review' END AS confidence,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 7 = 0 THEN 'out_of_scope' ELSE 'in_scope' END AS scope,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 8 = 0 THEN 'individual' ELSE 'company' END AS entity_type,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 2 = 0 THEN 'https://brand.example.com/' END AS official_website,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 10 = 1 THEN 'made rings' END AS short_history
        FROM {part}""",
    "maker_names": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS maker_id, 'Old Brand ' || substr(p_brand, 7) AS name, CAST(1960 AS INT) AS start_year, CAST(NULL AS INT) AS end_year
        FROM {part}""",
    "products": """
        SELECT p_partkey AS id, CAST(substr(p_brand, 7) AS BIGINT) AS maker_id,
               CASE WHEN p_partkey % 11 = 0 THEN p_name || ' (mk2)' ELSE p_name END AS name,
               CASE WHEN p_partkey % 5 <> 0 THEN 1950 + p_size END AS year, p_type AS category,
               CASE WHEN p_partkey % 3 = 0 THEN 'unknown' ELSE 'analog' END AS technology,
               CASE WHEN p_partkey % 13 <> 0 THEN 'https://www.shop' || CAST(p_partkey % 9 AS VARCHAR(10)) || '.example.com/products/' || replace(p_name, ' ', '-') || CASE WHEN p_partkey % 9 < 4 THEN '-' || CAST(p_partkey AS VARCHAR(20)) ELSE '' END END AS source_url,
               CASE WHEN p_partkey % 6 = 0 THEN 'needs_review' WHEN p_partkey % 6 = 1 THEN 'owner_answered' END AS review_status,
               CASE WHEN p_partkey % 12 = 0 THEN 'source is dead' END AS review_note,
               CASE WHEN p_partkey % 17 = 0 THEN 'reissue' ELSE 'original' END AS edition,
               CAST(NULL AS BIGINT) AS reissue_of_id, CAST(p_size AS BIGINT) AS family_id, p_brand AS variant_label
        FROM {part}""",
    "links": """
        SELECT event_id AS id, CASE WHEN user_id % 3 = 0 THEN CAST(user_id % 25 AS BIGINT) END AS maker_id,
               CASE WHEN user_id % 3 <> 0 THEN CAST(event_id % 2000 AS BIGINT) END AS product_id,
               'https://' || CASE WHEN user_id % 4 = 0 THEN 'www.' ELSE '' END || 'site' || CAST(user_id % 31 AS VARCHAR(10)) || '.example.org/' || event_type || '/' || CAST(event_id % 97 AS VARCHAR(10)) || CASE WHEN event_id % 10 = 0 THEN '.pdf' WHEN event_id % 10 = 1 THEN '.mp3' ELSE '' END AS url,
               'site' || CAST(user_id % 31 AS VARCHAR(10)) || '.example.org' AS domain,
               event_type || ' advert ' || CAST(1945 + event_id % 70 AS VARCHAR(10)) AS label,
               CASE WHEN event_type = 'purchase' THEN 'manufacturer_official' WHEN event_type = 'view' THEN 'service_mod' ELSE 'other' END AS link_type,
               CASE WHEN event_type = 'error' THEN 'dead' WHEN event_type = 'click' THEN 'live' WHEN event_type = 'view' THEN 'unchecked' ELSE 'redirected' END AS status,
               event_type AS source_name
        FROM {events}""",
    "claims": """
        SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS id, l_partkey AS entity_id,
               CASE l_returnflag WHEN 'A' THEN 'country' WHEN 'N' THEN 'status' ELSE 'short_history' END AS field_name,
               CASE WHEN l_linestatus = 'F' THEN ' Value F. ' ELSE 'value o' END AS value,
               'https://s' || CAST(l_suppkey AS VARCHAR(10)) || '.example.com/' AS source_url,
               CASE WHEN l_linenumber = 1 AND l_suppkey % 10 = 0 THEN 'manufacturer_official' WHEN l_linenumber = 2 THEN 'wikidata' ELSE 'other' END AS source_tier,
               l_shipdate AS fetched_at, CASE WHEN l_linenumber = 3 THEN 'rule_a: x' END AS derived_from
        FROM {lineitem}""",
    "queue": """
        SELECT CAST(s_suppkey AS BIGINT) AS id,
               CASE WHEN s_suppkey % 4 = 0 THEN 'brand-' || CAST(s_suppkey % 25 AS VARCHAR(10)) WHEN s_suppkey % 4 = 1 THEN 'New Brand ' || CAST(s_suppkey % 25 AS VARCHAR(10)) || ' Audio' WHEN s_suppkey % 4 = 2 THEN 'OLD BRAND ' || CAST(s_suppkey % 25 AS VARCHAR(10)) ELSE s_name END AS name,
               CASE WHEN s_suppkey % 7 = 0 THEN 'done' ELSE 'found' END AS status, CAST(NULL AS VARCHAR(100)) AS notes, CAST(s_nationkey AS INT) AS priority
        FROM {supplier}""",
    "asked": """
        SELECT id, CASE WHEN id % 7 = 0 THEN 'b' || CAST(id % 2 AS VARCHAR(10)) WHEN id % 7 = 1 THEN '?!' WHEN id % 7 = 2 THEN 'Bra' WHEN id % 7 = 3 THEN 'The Brand#6 Company Of Eight Words In All Ltd' ELSE name END AS name FROM {queue}""",
    "specs": """
        SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS id, l_partkey AS product_id,
               CASE WHEN l_linenumber = 1 THEN 'oscillators' WHEN l_linenumber = 2 THEN 'memory' ELSE 'polyphony' END AS field,
               CASE WHEN l_linenumber = 1 THEN 'Oscillators' WHEN l_linenumber = 2 THEN 'Memory' ELSE 'Polyphony' END AS label,
               CASE WHEN l_linenumber = 1 THEN CASE l_suppkey % 5 WHEN 0 THEN '3 VCOs' WHEN 1 THEN 'Digital FM with 6 operators' WHEN 2 THEN '2 DCOs' WHEN 3 THEN '16-bit PCM' ELSE 'two' END
                    WHEN l_linenumber = 2 THEN CASE WHEN l_suppkey % 3 = 0 THEN '64 ROM patches' ELSE '16 patches' END ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR(10)) || ' voices' END AS value,
               'https://s' || CAST(l_suppkey AS VARCHAR(10)) || '.example.com/' AS source_url
        FROM {lineitem}""",
    "domains": """
        SELECT domain, CASE WHEN n % 4 = 0 THEN 'harvestable' WHEN n % 4 = 1 THEN 'blocked_bot' WHEN n % 4 = 2 THEN 'untested' ELSE 'html_only' END AS verdict,
               CASE WHEN n % 8 = 0 THEN 'sitemap' END AS harvester, CASE WHEN n % 16 = 0 THEN '2024-01-01' END AS harvested_at,
               CAST(n % 50 AS INT) AS product_urls, CAST(n % 90 AS INT) AS sitemap_urls, CAST(n % 70 AS INT) AS inbound_spread
        FROM (SELECT 'site' || CAST(user_id % 31 AS VARCHAR(10)) || '.example.org' AS domain, max(event_id) AS n FROM {events} GROUP BY 1
              UNION ALL SELECT 'shop' || CAST(p_partkey % 9 AS VARCHAR(10)) || '.example.com' AS domain, max(p_partkey) AS n FROM {part} GROUP BY 1) d""",
    "relations": """
        SELECT CAST(o_custkey % 25 AS BIGINT) AS maker_id, CAST(o_orderkey % 40 AS BIGINT) AS related_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'successor' WHEN o_orderpriority = '2-HIGH' THEN 'owned_by' ELSE 'partner' END AS relation_type, CAST(year(o_orderdate) AS INT) AS year
        FROM {orders}""",
    "logos": """
        SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey % 40 AS BIGINT) AS maker_id, c_custkey % 3 = 0 AS has_file,
               CASE WHEN c_custkey % 5 <> 0 THEN CAST(1950 + c_custkey % 60 AS INT) END AS start_year, CASE WHEN c_custkey % 2 = 0 THEN CAST(2000 AS INT) END AS end_year,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'approved' WHEN 'MACHINERY' THEN 'outdated' END AS review_status
        FROM {customer}""",
    "categories": """
        SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id, name, form, func AS function FROM (
            SELECT DISTINCT p_type AS name, p_type AS form, 'Tool' AS func FROM {part} UNION ALL SELECT 'empty' AS name, 'None' AS form, 'Other' AS func) c""",
    "membership": """
        SELECT p_partkey AS product_id, c.id AS category_id, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END AS is_primary
        FROM {part} JOIN {categories} c ON c.name = p_type WHERE p_partkey % 7 <> 0""",
}
SOURCES = ("part", "events", "lineitem", "supplier", "orders", "customer")


def _needs(name: str) -> list[str]:
    return [s for s in PROJECTIONS if s != name and "{" + s + "}" in PROJECTIONS[name]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a projection of some."""
    if name not in PROJECTIONS:
        return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    text = PROJECTIONS[name]
    own = {s: table(spark, sf_dir, s) for s in (*SOURCES, *_needs(name)) if "{" + s + "}" in text}
    return spark.sql(text.replace("VARCHAR(10)", "STRING").replace("VARCHAR(20)", "STRING").replace("VARCHAR(100)", "STRING"), **own)


def with_tables(sql: str, *names: str) -> str:
    """``sql`` behind common table expressions of the projections it reads."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*_needs(n), n) if x not in order]
    parts = []
    for n in order:
        text = PROJECTIONS[n]
        for s in (*SOURCES, *PROJECTIONS):
            text = text.replace("{" + s + "}", s)
        parts.append(f"{n} AS ({text})")
    return f"WITH {', '.join(parts)} {sql}"

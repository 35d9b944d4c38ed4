"""Queries of jobs that write tables and files: they write, write again, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, reports
from ..sources import catalogue as published
from ..sources import readers, store
from ..sources.store import Kept, scratch
from .cases import json_files
from .catalogue import TECHNOLOGY, query


@query("k5_kept_claims", "SELECT entity_id, field_name, source_url, coalesce(min(id) FILTER (id % 2 = 0), min(id)) AS id FROM claims GROUP BY 1, 2, 3", "claims")
def _(t):
    """Half of the claims are kept; all come as a batch, twice."""
    rows = t.claims.select("entity_id", "field_name", "source_url", "id")
    keys = ("entity_id", "field_name", "source_url")
    table = Kept(scratch(rows.sparkSession, "claims"), keys, 16)
    table.create(evidence.append_new(rows.filter("id % 2 = 0"), rows.limit(0), keys, ["id"]))
    for _ in range(2):
        evidence.append_to(table, rows, ["id"])
    return table.read(rows.sparkSession)


@query("k14_kept_specs", """SELECT product_id, field, source_url, coalesce(min(id) FILTER (id % 3 = 0), min(id)) AS id FROM specs
    WHERE id % 3 = 0 OR product_id % 10 = 7 GROUP BY 1, 2, 3""", "specs")  # fmt: skip
def _(t):
    """A third of the specs are kept; those of a tenth of the products come as a batch, twice."""
    rows = t.specs.select("product_id", "field", "source_url", "id")
    keys = ("product_id", "field", "source_url")
    table = Kept(scratch(rows.sparkSession, "specs"), keys, 16)
    table.create(evidence.append_new(rows.filter("id % 3 = 0"), rows.limit(0), keys, ["id"]))
    for _ in range(2):
        evidence.append_to(table, rows.filter("product_id % 10 = 7"), ["id"])
    return table.read(rows.sparkSession)


@query("k10_kept_facts", f"""SELECT p.id, coalesce(CASE WHEN p.technology = 'unknown' THEN f.v END, p.technology) AS technology, coalesce(f.n, 0) AS n_provenance FROM products p
    LEFT JOIN (SELECT entity_id, CASE WHEN min(value) = max(value) THEN min(value) END AS v, count(DISTINCT said) AS n FROM (
        SELECT t.*, s.value AS said FROM {TECHNOLOGY} t JOIN specs s ON s.product_id = t.entity_id AND s.source_url = t.source_url AND s.field = 'oscillators'
            AND (s.value IN ('Digital FM with 6 operators', '16-bit PCM')) = (t.value = 'digital') AND s.value IN ('Digital FM with 6 operators', '16-bit PCM', '3 VCOs')) GROUP BY 1) f ON f.entity_id = p.id""", "specs", "products")  # fmt: skip
def _(t):
    """Derived technology fills kept products, provenance goes to kept claims; then the same job runs again."""
    spark = t.products.sparkSession
    products = Kept(scratch(spark, "products"), ("id",), 16)
    products.create(t.products.select("id", "technology"))
    claims = Kept(scratch(spark, "claims"), ("entity_id", "field_name", "derived_from"), 16)
    claims.create(t.claims.select("entity_id", "field_name", "value", "source_url", "source_tier", "derived_from").filter("id % 100 = 3"))
    for _ in range(2):
        evidence.apply_facts_to(products, claims, evidence.derive_technology(t.specs, products.read(spark)), ["technology"])
    made = claims.read(spark).filter("field_name = 'technology'").groupBy(F.col("entity_id").alias("id")).agg(F.count("*").alias("n_provenance"))
    return products.read(spark).join(made, "id", "left").select("id", "technology", F.coalesce("n_provenance", F.lit(0)).alias("n_provenance"))


@query("s8_catalogue_files", """SELECT m.id AS maker_id, m.canonical_name, coalesce(p.names, '') AS instruments, coalesce(n.names, '') AS name_history, coalesce(r.names, '') AS relations, coalesce(l.ids, '') AS logos,
    greatest(1, ceil(coalesce(p.n, 0) / 40.0), ceil(coalesce(n.n, 0) / 40.0), ceil(coalesce(r.n, 0) / 40.0), ceil(coalesce(l.n, 0) / 40.0))::INT AS pieces, true AS bounded
    FROM makers m LEFT JOIN (SELECT maker_id, count(*) AS n, string_agg(name, '|' ORDER BY year NULLS LAST, name, id) AS names FROM products GROUP BY 1) p ON p.maker_id = m.id
    LEFT JOIN (SELECT maker_id, count(*) AS n, string_agg(name, '|' ORDER BY name) AS names FROM maker_names GROUP BY 1) n ON n.maker_id = m.id
    LEFT JOIN (SELECT r.maker_id, count(*) AS n, string_agg(coalesce(o.canonical_name, '?') || ' ' || r.relation_type, '|' ORDER BY r.year NULLS LAST, o.canonical_name NULLS FIRST, r.relation_type, r.related_id) AS names
        FROM relations r LEFT JOIN makers o ON o.id = r.related_id GROUP BY 1) r ON r.maker_id = m.id
    LEFT JOIN (SELECT maker_id, count(*) AS n, string_agg(id, '|' ORDER BY CASE review_status WHEN 'approved' THEN 0 WHEN 'outdated' THEN 2 ELSE 1 END, end_year IS NOT NULL, start_year DESC NULLS LAST, id DESC) AS ids
        FROM logos GROUP BY 1) l ON l.maker_id = m.id""", "makers", "maker_names", "products", "relations", "logos")  # fmt: skip
def _(t):
    """The catalogue is written in pieces of 40 and read back; bounded: no file is larger than a full one and a piece, in rows and children as its manifest says."""
    spark = t.makers.sparkSession
    path = scratch(spark, "catalogue")
    published.publish_files(path, t.makers.select("id", "canonical_name"), t.maker_names, t.products, t.relations, t.logos, piece=40, file_rows=500)
    item = "array<struct<id bigint, name string, related_name string, relation_type string>>"
    rows = published.read_catalogue(spark, path, f"file int, maker_id bigint, canonical_name string, piece int, pieces int, name_history {item}, instruments {item}, relations {item}, logos {item}")
    children = sum((F.coalesce(F.size(s), F.lit(0)) for s in published.SECTIONS), F.lit(0))
    files = rows.groupBy("file").agg(F.count("*").alias("n"), F.sum(children).alias("c"))
    sizes = files.join(published.read_manifest(spark, path), "file", "full_outer")
    sizes = sizes.agg(F.min((F.col("n") == F.col("rows")) & (F.col("c") == F.col("children")) & (F.col("n") + F.col("c") <= 500 + 4 * 40 + 1)).alias("bounded"))
    shown = {
        "instruments": F.transform("instruments", lambda x: x["name"]), "name_history": F.transform("name_history", lambda x: x["name"]),
        "relations": F.transform("relations", lambda x: F.concat_ws(" ", F.coalesce(x["related_name"], F.lit("?")), x["relation_type"])), "logos": F.transform("logos", lambda x: x["id"].cast("string")),
    }
    # put together again for the comparison only
    whole = rows.groupBy("maker_id", "canonical_name", "pieces").agg(F.sort_array(F.collect_list(F.struct("piece", *[c.alias(s) for s, c in shown.items()]))).alias("all"))
    joined = [F.array_join(F.flatten(F.filter(F.col(f"all.{s}"), lambda x: x.isNotNull())), "|").alias(s) for s in shown]
    return whole.select("maker_id", "canonical_name", "pieces", *joined).join(F.broadcast(sizes))


@query("a13_toggle_log", """SELECT a.event_id AS id, CASE WHEN m.confidence = 'unresearched' OR n % 2 = 1 THEN m.confidence WHEN m.confidence = 'confirmed' THEN 'needs_review' ELSE 'confirmed' END AS previous_confidence,
    CASE WHEN m.confidence = 'unresearched' OR n % 2 = 0 THEN m.confidence WHEN m.confidence = 'confirmed' THEN 'needs_review' ELSE 'confirmed' END AS new_confidence
    FROM (SELECT event_id, user_id % 25 AS maker_id, row_number() OVER (PARTITION BY user_id % 25 ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'click') a JOIN makers m ON m.id = a.maker_id""", "makers")  # fmt: skip
def _(t):
    actions = t.events.select(F.col("event_id").alias("id"), (F.col("user_id") % 25).alias("maker_id"), F.when(F.col("event_type") == "click", "approve").otherwise("look").alias("action"), F.col("ts").alias("created_at"))
    return reports.toggle_log(actions, t.makers).select("id", "previous_confidence", "new_confidence")


@query("s1_mixed_batches", """SELECT p_partkey AS id, p_name AS name, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 3 THEN NULL ELSE 1950 + p_size END AS year,
    CASE p_partkey % 4 WHEN 0 THEN 'STRING' WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'STRING' ELSE 'BOOLEAN' END AS kind, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS unknown FROM part""")  # fmt: skip
def _(t):
    """Instruments by turns: a string, a struct with a year as number, as text, as no year at all; every other entry has a field that nobody knows."""
    key = F.col("p_partkey")
    year = (F.col("p_size") + 1950).cast("string")
    item = F.when(key % 4 == 0, F.concat(F.lit('"'), "p_name", F.lit('"'))).otherwise(
        F.concat(F.lit('{"name": "'), "p_name", F.lit('", "year": '), F.when(key % 4 == 1, year).when(key % 4 == 2, F.concat(F.lit('"'), year, F.lit('"'))).otherwise("true"), F.lit("}"))
    )
    extra = F.when(key % 2 == 0, F.concat(F.lit(', "grade": {"by": ["'), "p_brand", F.lit('"]}'))).otherwise("")
    text = F.concat(F.lit('{"canonical_name": "n'), key.cast("string"), F.lit('"'), extra, F.lit(', "instruments": [" ", '), item, F.lit("]}"))
    path = json_files(t.part.select("p_partkey", text.alias("text")), '{"manufacturers": [', "]}")
    rows = readers.read_batches(t.part.sparkSession, path).withColumn("x", F.element_at("instruments", 1))
    given = F.when(F.schema_of_variant("x.given") == "STRING", "STRING").otherwise(F.schema_of_variant(F.try_variant_get("x.given", "$.year", "variant")))
    # true is no year, though it can be cast to one
    year = F.when(given != "BOOLEAN", F.col("x.year"))
    return rows.select(F.substring("canonical_name", 2, 20).cast("long").alias("id"), "x.name", year.alias("year"), given.alias("kind"), F.try_variant_get("entry", "$.grade.by[0]", "string").alias("unknown"))


@query("s4_sitemap_files", """SELECT DISTINCT 'd' || p_size % 9 AS domain, 'https://d' || p_size % 9 || '/p/' || p_partkey AS url FROM part WHERE p_partkey % 4 < 2 OR p_partkey % 4 = 2 AND p_size % 2 = 0""")
def _(t):
    """Gzipped sitemap files of each domain (one of its own; products, in an index; others, of which the index matches half) and its index, written as XML and read back."""
    spark = t.part.sparkSession
    turn, domain = F.col("p_partkey") % 4, F.concat(F.lit("d"), (F.col("p_size") % 9).cast("string"))
    name = F.when(turn == 0, "own").when(turn == 1, "product").when(turn == 2, F.when(F.col("p_size") % 2 == 0, "product-b").otherwise("blog")).otherwise("hidden")
    rows = t.part.select(domain.alias("domain"), name.alias("map"), F.concat(F.lit("https://"), domain, F.lit("/p/"), F.col("p_partkey").cast("string")).alias("loc"))
    folder = store.scratch(spark, "sitemaps")
    rows.repartition("domain", "map").write.format("xml").partitionBy("domain", "map").options(rootTag="urlset", rowTag="url", compression="gzip").save(f"{folder}/maps")
    index = rows.filter("map <> 'own'").select("domain", "map").distinct()
    # the hidden map is named, but its name doesn't end as those that are followed
    ending = F.when(F.col("map") == "hidden", ".txt").otherwise(".xml.gz")
    index = index.select("domain", F.lit("index").alias("map"), F.concat(F.lit("https://"), "domain", F.lit("/"), "map", ending).alias("loc"))
    index.repartition("domain").write.format("xml").partitionBy("domain", "map").options(rootTag="sitemapindex", rowTag="sitemap", compression="gzip").save(f"{folder}/index")
    locs = readers.read_sitemap_files(spark, f"{folder}/*/*/*")
    at = F.regexp_extract("file", "domain=([^/]+)/map=([^/]+)/", 1), F.regexp_extract("file", "domain=([^/]+)/map=([^/]+)/", 2)
    listing = locs.select("file").distinct().select("file", at[0].alias("domain"), at[1].alias("map"))
    listing = listing.select("file", "domain", F.concat(F.lit("https://"), "domain", F.lit("/"), "map", F.when(F.col("map") == "hidden", ".txt").otherwise(".xml.gz")).alias("url"))
    return readers.sitemap_file_urls(locs, listing, include="product")


@query("s6_mixed_bindings", """SELECT 'l' || p_partkey AS label, p_partkey AS qid, 1950 + p_size AS year, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS unknown FROM part""")
def _(t):
    """Bindings whose variables are structs or, by turns, plain values; every third has a variable that nobody knows."""
    key = F.col("p_partkey").cast("string")
    date = F.concat(F.lit('"'), (F.col("p_size") + 1950).cast("string"), F.lit('-05"'))
    plain = F.col("p_partkey") % 2 == 0
    text = F.concat(
        F.lit('{"item": {"value": "http://w.example.com/entity/'), key, F.lit('"}, "itemLabel": '), F.when(plain, F.concat(F.lit('"l'), key, F.lit('"'))).otherwise(F.concat(F.lit('{"value": "l'), key, F.lit('"}'))),
        F.lit(', "date": '), F.when(plain, F.concat(F.lit('{"type": "literal", "value": '), date, F.lit("}"))).otherwise(date), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(', "note": {"value": "'), "p_brand", F.lit('"}'))).otherwise(""), F.lit("}"),
    )
    rows = readers.flatten_bindings(t.part.select(F.concat(F.lit('{"results": {"bindings": ['), text, F.lit("]}}")).alias("body")))
    return rows.select("label", F.col("qid").cast("long").alias("qid"), "year", F.get_json_object("binding", "$.note.value").alias("unknown"))

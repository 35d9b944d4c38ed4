"""Queries whose inputs take turns through every branch of a rule, with SQL that states the rule or its outcomes.

``given(values)`` deals a list of inputs to the rows of ``part`` by their key, so a
query's work grows with that table and each outcome is met; SQL has the same list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import classify, extract, keys, vocab
from ..operators import audit, evidence, reports, resolve
from ..sources import readers, store
from .catalogue import HOST, LABEL, NORM, TECHNOLOGY, dictionary_sql, query


def quoted(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value).lower()


def dealt(values, key: str = "p_partkey") -> str:
    """SQL of the value whose turn it is."""
    return f"([{', '.join(map(quoted, values))}])[{key} % {len(values)} + 1]"


def given(values, key: str = "p_partkey") -> Column:
    kind = next(type(v) for v in values if v is not None)
    cast = {str: "string", int: "int", bool: "boolean"}[kind]
    return F.element_at(F.array(*[F.lit(v).cast(cast) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def words(values) -> str:
    return ", ".join(map(quoted, values))


# Names

FULL = ["{b} Corporation", "{b} Music Inc.", "The {b}", "Audio Ltd", "{b} Motor", "???", "{b} S.p.A.", "E-mu Systems", "AB Audio"]
SHORT = ["{b}", "{b} GmbH", "{b}", "Audio", "{b}", "x", "Other", "emu", "{b} AB"]


def _branded(values) -> Column:
    return F.replace(given(values), F.lit("{b}"), F.col("p_brand"))


def _branded_sql(values) -> str:
    return f"replace({dealt(values)}, '{{b}}', p_brand)"


_ENDINGS = "|".join(s.replace(".", r"\.") for s in sorted(vocab.NAME_SUFFIXES, key=len, reverse=True))


def _core_sql(c: str) -> str:
    core = NORM.format(rf"regexp_replace(lower({c}), '(^|[\s,]+)(\.*({_ENDINGS})\.*[\s,]+)*\.*({_ENDINGS})\.*[\s,]*$', '')")
    return f"CASE WHEN {core} <> '' THEN {core} ELSE {NORM.format(c)} END"


@query("n5_name_core", f"""SELECT id, {_core_sql('a')} AS core, {NORM.format('a')} <> '' AND {NORM.format('b')} <> '' AND ({NORM.format('a')} = {NORM.format('b')} OR {_core_sql('a')} = {_core_sql('b')}) AS same
    FROM (SELECT p_partkey AS id, {_branded_sql(FULL)} AS a, {_branded_sql(SHORT)} AS b FROM part)""")
def _(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), _branded(FULL).alias("a"), _branded(SHORT).alias("b"))
    return rows.select("id", keys.name_core("a").alias("core"), keys.names_match("a", "b").alias("same"))


def _domain_key_sql(c: str) -> str:
    all_words = f"list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"
    kept = f"list_filter({all_words}, lambda x: x NOT IN ({words(vocab.DOMAIN_NOISE)}))"
    own = f"(CASE WHEN len({kept}) > 0 THEN {kept} ELSE {all_words} END)"
    return f"CASE WHEN length({own}[1]) <= 2 THEN {own}[1] || coalesce({own}[2], '') ELSE {own}[1] END"


@query("n6_domain_keys", f"SELECT p_partkey AS id, {_domain_key_sql(_branded_sql(FULL))} AS key FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), keys.domain_name_key(_branded(FULL)).alias("key"))


MAKERS = ["Korg Inc", "The Moog Music Company", "AB Audio", "E-mu Systems", "X Ltd"]
SITES = ["https://www.korg.com/a", "https://korgsynths.de/", "http://shop.moog.co.uk/", "https://moogmuseum.org/x", "https://abaudio.com/", "https://emumusic.jp/", "https://korgxyz.com/", "/relative"]


@query("c1_official", rf"""SELECT id, coalesce(length(k) >= 3 AND starts_with(label, k) AND substr(label, length(k) + 1) IN ({words(vocab.OFFICIAL_SUFFIXES)}), false) AS official
    FROM (SELECT p_partkey AS id, {_domain_key_sql(dealt(MAKERS))} AS k, {LABEL.format(HOST.format(dealt(SITES)))} AS label FROM part)""")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.is_official(keys.domain_of(given(SITES)), given(MAKERS)).alias("official"))


LABELS = ["User forum", "MIDI retrofit kit", "Museum page", "Sysex patches", "Buy it in our store", "A review", None, "Plain page", "Amplifier"]
LINKS = ["https://x.example.com/a.mp3?x=1", "https://x.example.com/page", "https://web.archive.org/x", "https://y.example.com/z"]


@query("c2_link_types", f"""SELECT id, CASE WHEN regexp_matches(url, '(?i)\\.(mp3|wav|flac|ogg|m4a|aiff?)(\\?|$)') THEN 'audio_demo' WHEN own THEN 'manufacturer_official' WHEN contains(url, '//web.archive.org/') THEN 'archive' """
    + " ".join("WHEN " + " OR ".join(f"contains(hay, {quoted(w)})" for w in ws) + f" THEN '{k}'" for k, ws in (("archive", vocab.ARCHIVE), ("community", vocab.COMMUNITY), ("service_mod", vocab.SERVICE), ("samples", vocab.SAMPLES), ("retailer", vocab.RETAIL), ("media", vocab.MEDIA)))
    + f""" ELSE 'other' END AS link_type FROM (SELECT *, lower(coalesce(label, '') || ' ' || url) AS hay FROM (SELECT p_partkey AS id, {dealt(LINKS)} AS url, {dealt(LABELS)} AS label, p_size % 5 = 0 AS own FROM part))""")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.link_type(given(LINKS), given(LABELS), keys.domain_of(given(LINKS)), F.col("p_size") % 5 == 0).alias("link_type"))


OWNERS = ["Korg Inc", "Moog Music", "Example Ltd"]


@query("c3_route_links", f"""SELECT m AS maker_id, p AS product_id, url, min(label) AS label FROM (
    SELECT CASE WHEN official OR product_id IS NULL THEN maker_id END AS m, CASE WHEN NOT official AND product_id IS NOT NULL THEN product_id END AS p, url, label FROM (
        SELECT *, contains(url, '//korg.com') AND maker = 'Korg Inc' OR contains(url, '.moog.com') AND maker = 'Moog Music' OR contains(url, '.example.com') AND maker = 'Example Ltd' AS official FROM (
            SELECT p_partkey % 40 AS maker_id, {dealt(OWNERS, '(p_partkey % 40)')} AS maker, CASE WHEN p_size % 3 <> 0 THEN p_partkey END AS product_id,
                unnest(['https://korg.com/x', 'https://shop.moog.com/' || p_size % 4, 'https://other.example.com/' || p_size]) AS url, unnest(['b', 'a' || p_size, 'c']) AS label FROM part))) GROUP BY 1, 2, 3""")
def _(t):
    size = F.col("p_size").cast("string")
    link = lambda url, label: F.struct(url.alias("url"), label.alias("label"))
    links = F.array(link(F.lit("https://korg.com/x"), F.lit("b")), link(F.concat(F.lit("https://shop.moog.com/"), (F.col("p_size") % 4).cast("string")), F.concat(F.lit("a"), size)), link(F.concat(F.lit("https://other.example.com/"), size), F.lit("c")), link(F.lit("mailto:x@korg.com"), F.lit("d")), link(F.lit("https://shelf.example.org/"), F.lit("own")))
    rows = t.part.withColumn("p_partkey_40", F.col("p_partkey") % 40)
    pages = rows.select(F.col("p_partkey_40").alias("maker_id"), given(OWNERS, "p_partkey_40").alias("maker"), F.when(F.col("p_size") % 3 != 0, F.col("p_partkey")).alias("product_id"), links.alias("links"))
    return classify.route_links(pages, "shelf.example.org").select("maker_id", "product_id", "url", "label")


PRODUCT_URLS = {
    "https://x.example.com/products/abc": "A:path-marker", "https://x.example.com/product-abc9": "D:product-prefix", "https://x.example.com/brand12/abc": "B:maker-segment",
    "https://x.example.com/list/brand12-tb3-x": "C:maker-slug", "https://x.example.com/list/nothing-here": None, "https://x.example.com/tag/brand12/abc": None,
    "https://x.example.com/products/": None, "https://x.example.com/img/a.jpg": None, "https://x.example.com/products/123": None, "https://x.example.com/oldbrand1/xyz": "B:maker-segment",
    "https://x.example.com/brand1234567/x": "B:maker-segment", "https://x.example.com/used-brand12-gear/abc": "B:maker-segment", "https://x.example.com/list/brand12": None,
    "https://x.example.com/list/brand12-a-b-c-d-e-f": None, "https://x.example.com/synths/page/2": None, "https://x.example.com/": None, "https://x.example.com/keyboards/old-one.php": "A:path-marker",
}


@query("c4_product_urls", f"SELECT p_partkey AS id, {dealt(list(PRODUCT_URLS.values()))} AS signal FROM part")
def _(t):
    urls = t.part.select(F.col("p_partkey").alias("id"), given(list(PRODUCT_URLS)).alias("url"))
    return classify.product_like(urls, "url", t.dictionary("canonical", "history"), "id")


@query("c5_product_hint", rf"SELECT p_partkey AS id, regexp_matches({dealt(list(PRODUCT_URLS))}, '(?i)/(products?|instruments?|synths?|synthesizers?|keyboards?|modules?|gear)/[^/]+') AS hint FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.product_hint(given(list(PRODUCT_URLS))).alias("hint"))


TITLES = {
    "Korg MS-20 Synthesizer | Shop": "instrument", "Guitar Amplifier | Shop": "not-instrument", "Drum machine": "undecided", "Sound pack for Synth | Shop": "not-instrument",
    "Hello | Shop": "undecided", "Piano &amp; Organ | X": "instrument", "Synth with mixer | X": "undecided", "Studio &quot;Delay&quot;": "not-instrument", "": "undecided", "Sampler, sequencer Vocoder | Organ": "instrument",
}


@query("c6_title_verdicts", f"SELECT p_partkey AS id, CASE WHEN p_size % 9 = 0 THEN 'not-instrument' ELSE {dealt(list(TITLES.values()))} END AS verdict FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.title_verdict(F.when(F.col("p_size") % 9 == 0, "Tote bag").otherwise(""), F.lit(""), given(list(TITLES))).alias("verdict"))


@query("c7_title_category", rf"SELECT p_partkey AS id, coalesce(lower(list_extract(regexp_extract_all(split_part({dealt(list(TITLES))}, '|', 1), '(?i)\b(synthesi[sz]er|synth|piano|organ|drum machine|drum|sampler|sequencer|keyboard|workstation|vocoder|arranger)\b', 1), -1)), '') AS category FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.title_category(given(list(TITLES))).alias("category"))


SCOPES = ["analog synthesizer", "keyboard controller", "modular delay", "modular vco", "thing", "", None, "digital piano with recorder", "Voice Transformer", "Rhythm Composer", "Keyboard"]


@query("c8_scope", f"SELECT p_partkey AS id, CASE WHEN coalesce(d, '') = '' THEN 'ask' WHEN regexp_matches(d, '{vocab.OUT_OF_SCOPE}') OR regexp_matches(d, '{vocab.EFFECT_ONLY}') THEN 'out' WHEN regexp_matches(d, '{vocab.IN_SCOPE}') THEN 'in' ELSE 'ask' END AS bucket FROM (SELECT p_partkey, {dealt(SCOPES)} AS d FROM part)")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), classify.scope_bucket(given(SCOPES)).alias("bucket"))


KINDS = ["synth", "effect", "book", "cable", None]


@query("c10_c17_types", f"""SELECT id, CASE WHEN external_id IS NOT NULL THEN 'module' ELSE 'manual' END AS decision FROM (SELECT p_partkey AS id, p_type, CASE WHEN p_size % 2 = 0 THEN p_size END AS external_id, [{dealt(KINDS)}, {dealt(KINDS, 'p_size')}] AS types FROM part)
    WHERE p_type IN ('ECONOMY', 'SMALL') AND list_has_any(types, ['synth', 'effect']) AND NOT list_has_any(types, ['book'])""")
def _(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("product_type"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("external_id"), F.array_compact(F.array(given(KINDS), given(KINDS, "p_size"))).alias("types"))
    return classify.split_hardware(classify.filter_types(rows, ["synth", "effect"], ["book"]), ["ECONOMY", "SMALL"]).select("id", "decision")


#: path -> (brand, why)
DOCUMENTS = {
    "Archiv_Hans_Ohms/Acme%20Organ/a.pdf": ("Acme Organ", "folder"), "Archiv_Hans_Ohms/Acme%20-%20Other/a.pdf": (None, "several brands"), "Archiv_Hans_Ohms/1970/framus_1.pdf": ("Framus", "file"),
    "Archiv_Hans_Ohms/PDF/x_1.pdf": (None, "none"), "files/Framus-2.pdf": ("Framus", "file"), "files/x+y.pdf": (None, "none"), "": (None, "none"),
}
SECTIONS = ["dokumente_vermona-schaltplaene", "dokumente_bilder", "handbuecher"]


@query("c11_c12_documents", f"""SELECT id, CASE WHEN why = 'none' AND section LIKE '%_vermona-schaltplaene' THEN 'Vermona' ELSE brand END AS brand, CASE WHEN why = 'none' AND section LIKE '%_vermona-schaltplaene' THEN 'section' ELSE why END AS reason,
    CASE WHEN contains(section, 'handbuecher') OR contains(section, 'schaltplaene') THEN 'service_mod' ELSE 'archive' END AS link_type
    FROM (SELECT p_partkey AS id, {dealt([v[0] for v in DOCUMENTS.values()])} AS brand, {dealt([v[1] for v in DOCUMENTS.values()])} AS why, {dealt(SECTIONS)} AS section FROM part)""")
def _(t):
    url, section = F.concat(F.lit("https://b.example.de/"), given(list(DOCUMENTS))), given(SECTIONS)
    brand = classify.brand_of(url, section, ["Framus"], {"vermona-schaltplaene": "Vermona"})
    return t.part.select(F.col("p_partkey").alias("id"), brand.alias("b"), classify.doc_link_type(section).alias("link_type")).select("id", "b.brand", "b.reason", "link_type")


#: (robots, sitemap code, sitemap, home code, error) -> verdict
PROBES = {
    ("", 200, "<loc>x</loc>", 200, None): "harvestable", ("", 200, "empty", 200, None): "html_only", ("User-agent: *\nDisallow: /\n", 200, "<loc>x</loc>", 200, None): "blocked_policy",
    ("User-agent: bot\nDisallow: /\nUser-agent: *\nDisallow: /x", 404, "", 403, None): "blocked_bot", ("", 404, "", 404, None): "gone", ("", 0, "", None, "timeout"): "transport", ("", 500, "", 500, None): "transport",
    ("", 404, "", 429, "slow"): "blocked_bot",
}


@query("c14_domain_verdicts", f"SELECT p_partkey AS domain, CASE WHEN p_size % 7 = 0 THEN 'manual' ELSE {dealt(list(PROBES.values()))} END AS verdict FROM part")
def _(t):
    parts = list(zip(*PROBES, strict=True))
    probes = t.part.select(F.col("p_partkey").alias("domain"), *[given(list(p)).alias(n) for p, n in zip(parts, ("robots_text", "sitemap_code", "sitemap_text", "home_code", "error"), strict=True)])
    return classify.domain_verdict(probes, t.part.filter("p_size % 7 = 0").select(F.col("p_partkey").alias("domain"), F.lit("manual").alias("verdict")))


SLUGS = {"new-ds-2-mini": "New DS-2 Mini", "tb-303": "TB-303", "little-brother": "Little Brother", "MS20": "MS20", "juno-106-abc": "Juno 106 ABC", "the_poly-61": "The Poly 61", "a": "A", "": ""}


@query("n8_slug_titles", f"SELECT p_partkey AS id, {dealt(list(SLUGS.values()))} AS title FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), keys.title_case_slug(given(list(SLUGS))).alias("title"))


#: slug -> (model, without its colour)
COLOURED = {"/jp-08": ("JP-08", "JP-08"), "boutique-synth/": ("Boutique Synth", "BOUTIQUE-SYNTH"), "fp10bk": ("FP10BK", "FP10"), "fp10weset": ("FP10WESET", "FP10"), "bk": ("Bk", "BK"), "go%3Akeys": ("Go:keys", "GO:KEYS"), "rd2000": ("RD2000", "RD2000"), "set": ("Set", "")}


@query("n9_models", f"SELECT p_partkey AS id, {dealt([v[0] for v in COLOURED.values()])} AS model, {dealt([v[1] for v in COLOURED.values()])} AS family FROM part")
def _(t):
    slug = given(list(COLOURED))
    bare = F.regexp_replace(F.url_decode(slug), "^/+|/+$", "")
    return t.part.select(F.col("p_partkey").alias("id"), keys.tidy_model(slug).alias("model"), keys.collapse_variant(bare).alias("family"))


#: (title, what is left without its maker)
TITLED = {"Acme TB-3": "TB-3", "ACME Research Mono": "Mono", "Acme": "Acme", "acme x": "acme x", "acme mini": "acme mini", "Acmegraph 2": "Acmegraph 2", "Other 7": "Other 7", "Acme 808": "808"}


@query("n11_strip_maker_prefix", f"SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN {dealt(list(TITLED.values()))} ELSE {dealt(list(TITLED))} END AS model FROM part")
def _(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), (F.col("p_size") % 2).cast("long").alias("maker_id"), given(list(TITLED)).alias("name"))
    aliases = t.nation.select(F.when(F.col("n_nationkey") < 3, 0).otherwise(F.col("n_nationkey") + 5).cast("long").alias("maker_id"), F.when(F.col("n_nationkey") == 1, "Acme Research").when(F.col("n_nationkey") == 2, " ").otherwise("Acme").alias("alias"))
    return keys.strip_maker_prefix(rows, aliases).select("id", "model")


AXES = {"Module - Filter": ("Module", "Filter"), "Synth": (None, None), "A - B - C": ("A", "B - C"), "Key-board": (None, None), " - X": ("", "X"), None: (None, None)}


@query("n12_split_axes", f"SELECT p_partkey AS id, {dealt([v[0] for v in AXES.values()])} AS form, {dealt([v[1] for v in AXES.values()])} AS function FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), keys.split_axes(given(list(AXES))).alias("a")).select("id", "a.form", "a.function")


#: (folder, file) -> (model, kind)
FILES = {
    ("Acme", "ACME_TB-3_SERVICE_MANUAL.pdf"): ("TB-3", "Service Manual"), ("Acme", "TB-3_OWNERS_MANUAL.PDF"): ("TB-3", "Owners Manual"), ("Acme_Organs", "acme_X_7.jpg"): ("X 7", "Document"),
    ("Other", "Acme_MIDIGUIDE.zip"): ("Acme", "Midiguide"), ("Acme", "SCHEMATIC.gif"): ("", "Schematic"), ("Acme", "Poly-5__PARTS_LIST.doc"): ("Poly-5", "Parts List"),
}


@query("n14_doc_models", f"SELECT p_partkey AS id, {dealt([v[0] for v in FILES.values()])} AS model, {dealt([v[1] for v in FILES.values()])} AS doc_type FROM part")
def _(t):
    doc = keys.doc_model(given([f[0] for f in FILES]), given([f[1] for f in FILES]))
    return t.part.select(F.col("p_partkey").alias("id"), doc.alias("d")).select("id", "d.model", "d.doc_type")


# Names to makers

SLUG_HEADS = ["old-brand-{n}-{m}", "brand{n}_x-{m}", "nobody-{m}", "Old-Brand-{n}", "the-old-brand-{n}-{m}", "old-brand-{n}"]


@query("r6_split_slug", dictionary_sql(f"""SELECT id, maker_id, CASE WHEN maker_id IS NULL THEN slug WHEN k = 0 THEN replace(p_name, ' ', ' ') ELSE '' END AS model, CASE WHEN maker_id IS NULL THEN 'no maker' ELSE 'matched' END AS status FROM (
    SELECT p_partkey AS id, p_name, p_partkey % 6 AS k, CASE WHEN p_partkey % 6 IN (0, 3, 5) THEN CAST(substr(p_brand, 7) AS BIGINT) END AS maker_id,
        replace(replace({dealt(SLUG_HEADS)}, '{{n}}', substr(p_brand, 7)), '{{m}}', replace(p_name, ' ', '-')) AS slug FROM part)"""))
def _(t):
    slug = F.replace(F.replace(given(SLUG_HEADS), F.lit("{n}"), F.substring("p_brand", 7, 9)), F.lit("{m}"), F.translate("p_name", " ", "-"))
    return resolve.split_slug(t.part.select(F.col("p_partkey").alias("id"), slug.alias("slug")), "slug", t.dictionary(), "id")


@query("r5_match_title", dictionary_sql("""SELECT p_partkey AS id, max_by(b.maker_id, length(b.lower_name)) AS maker_id FROM part JOIN by_name b ON starts_with(lower(CASE p_partkey % 4 WHEN 0 THEN 'Old Brand ' || substr(p_brand, 7) || ' ' || p_name WHEN 1 THEN 'THE Brand#6 Company ' || p_name WHEN 2 THEN 'Nobody ' || p_name ELSE p_brand END) || ' ', b.lower_name || ' ') GROUP BY 1"""))
def _(t):
    turn, name = F.col("p_partkey") % 4, F.col("p_name")
    title = F.when(turn == 0, F.concat(F.lit("Old Brand "), F.substring("p_brand", 7, 9), F.lit(" "), name)).when(turn == 1, F.concat(F.lit("THE Brand#6 Company "), name)).when(turn == 2, F.concat(F.lit("Nobody "), name)).otherwise(F.col("p_brand"))
    return resolve.match_title(t.part.select(F.col("p_partkey").alias("id"), title.alias("title")), "title", t.dictionary(), "id").select("id", "maker_id")


@query("r16_identify", """SELECT p_partkey AS maker_id, CASE p_partkey % 5 WHEN 0 THEN 'Q1' WHEN 1 THEN 'Q2' WHEN 2 THEN 'Q3' END AS qid,
    CASE WHEN p_partkey % 5 IN (0, 1, 2) THEN 'accepted' ELSE 'rejected' END AS status, (['website', 'name and type', 'name and type', 'name only: Q1', 'no candidate'])[p_partkey % 5 + 1] AS reason FROM part""")
def _(t):
    turn = F.col("p_partkey") % 5
    makers = t.part.select(F.col("p_partkey").alias("maker_id"), F.col("p_brand").alias("name"), F.lit("https://www.acme.example.com/").alias("official_website"))
    none = F.array().cast("array<string>")
    row = lambda rank, qid, label, aliases, types, websites: F.struct(F.lit(rank).alias("rank"), F.lit(qid).alias("qid"), label.alias("label"), aliases.alias("aliases"), types.alias("types"), none.alias("industry"), websites.alias("websites"))
    own, other, school, company = F.col("p_brand"), F.lit("Other"), F.array(F.lit("school")), F.array(F.lit("company"))
    site = F.array(F.lit("http://acme.example.com"))
    candidates = (
        F.when(turn == 0, F.array(row(1, "Q1", other, none, school, site), row(2, "Q2", own, none, company, none)))
        .when(turn == 1, F.array(row(1, "Q1", own, none, school, none), row(2, "Q2", own, none, company, none)))
        .when(turn == 2, F.array(row(1, "Q1", other, none, company, none), row(2, "Q3", other, F.array(F.upper(own)), company, none)))
        .when(turn == 3, F.array(row(1, "Q1", own, none, none, none), row(2, "Q2", other, none, company, none)))
        .otherwise(F.array().cast("array<struct<rank:int,qid:string,label:string,aliases:array<string>,types:array<string>,industry:array<string>,websites:array<string>>>"))
    )
    rows = t.part.select(F.col("p_partkey").alias("maker_id"), F.explode(candidates).alias("c")).select("maker_id", "c.*")
    return resolve.identify(makers, rows, ["school"], ["company"]).select("maker_id", "qid", "status", "reason")


# Extraction

PAGES = {  # text: (dead, year, device, technology)
    "Device:\nSynth\nProduced:\n1984 - 1990\nTechnology:\nAnalog": (False, 1984, "Synth", "analog"), "Device:\nOrgan\nProduced: 1971\nTechnology:\nSteam": (False, 1971, None, None),
    "No such synth\nProduced: 1980": (True, None, None, None), "Produced:\nLegend\n1980\nDevice:\nSampler": (False, None, "Sampler", None), "Technology:\nHYBRID\nx\nProduced:\nabout 2001": (False, 2001, None, "hybrid"),
    "Device:": (False, None, None, None), "": (False, None, None, None),
}


@query("x2_x4_cached_pages", "SELECT p_partkey AS id, " + ", ".join(f"{dealt([v[i] for v in PAGES.values()])} AS {n}" for i, n in enumerate(("dead", "year", "device", "technology"))) + " FROM part")
def _(t):
    pages = t.part.select(F.col("p_partkey").alias("id"), given(list(PAGES)).alias("text"))
    return extract.read_specs(pages, devices=("Synth", "Sampler")).select("id", "dead", "year", "device", "technology")


BLOCKS = {  # text: its fields
    "About\nTECHNICAL SPECIFICATIONS\nKeys: 61\nBody type:\nwood &amp; steel\nKeys: 0": "body_type=wood & steel|keys=61", "TECHNICAL SPECIFICATION\nX: 1\nTECHNICAL SPECIFICATIONS\nROM Size:\n4MB\nFX: 2 units": "fx=2 units|rom_size=4MB",
    "TECHNICAL SPECIFICATIONS\nKeys (61): yes\nSize 2: x\nPolyphony: 8": "polyphony=8", "Keys: 61": None, "technical specifications\nFilters:\nKeys:\n49\nnote": "keys=49", None: None,
    "TECHNICAL SPECIFICATIONS\nA label of far too many words to be any label at all: x\nAudio Outs: 2: main\nSequencer:": "audio_outs=2: main",
}


@query("x5_spec_blocks", f"SELECT * FROM (SELECT p_partkey AS id, {dealt(list(BLOCKS.values()))} AS fields FROM part) WHERE fields IS NOT NULL")
def _(t):
    found = extract.spec_blocks(t.part.select(F.col("p_partkey").alias("id"), given(list(BLOCKS)).alias("text")), "id")
    return found.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("field", F.lit("="), "value"))), "|").alias("fields"))


PAIRS = {
    '<span class="term">Keys</span> <span class="value">6<b>1</b></span><span class=\'spec term\'>FX</span><span class="value">none</span>': "FX=none|Keys=6 1", '<span class="term">Keys</span>text<span class="value">1</span>': None,
    '<SPAN CLASS="term">A B</SPAN>\n<span class="the value"> c\n d </span>': "A B=c d", "<p>none</p>": None,
}


@query("x6_spec_pairs", f"SELECT * FROM (SELECT p_partkey AS id, {dealt(list(PAIRS.values()))} AS pairs FROM part) WHERE pairs IS NOT NULL")
def _(t):
    found = extract.page_spec_pairs(t.part.select(F.col("p_partkey").alias("id"), given(list(PAIRS)).alias("html")), "id")
    return found.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("label", F.lit("="), "value"))), "|").alias("pairs"))


_CELLS = "<td>2</td><td>3</td>"
TABLES = {  # html: rows as number:first cell:href
    f"<table><tbody><tr><td><b>A</b> x</td><td><a href='https://h.example.com/1'>l</a></td>{_CELLS}</tr><tr><td>B</td>{_CELLS}</tr><tr><td>C</td><td>no link</td>{_CELLS}</tr></tbody></table>": "0:A x:https://h.example.com/1|2:C:",
    f"<TBODY class=x><TR><TD>D</TD><TD><a href='/relative'>l</a></TD>{_CELLS}</TR></TBODY><tbody><tr><td>E</td><td></td>{_CELLS}</tr></tbody>": "0:D:", "<table><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>": None, "": None,
}


@query("x7_table_rows", f"SELECT * FROM (SELECT p_partkey AS id, {dealt(list(TABLES.values()))} AS rows FROM part) WHERE rows IS NOT NULL")
def _(t):
    found = extract.table_rows(t.part.select(F.col("p_partkey").alias("id"), given(list(TABLES)).alias("html")), "id", cells=4)
    return found.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col("row").cast("string"), F.get("cells", F.lit(0)), F.coalesce("href", F.lit(""))))), "|").alias("rows"))


SAID = ["It was released in 1989 in Japan", "Introduced  in 2004.", "launched in 2031", "released 1990", "prereleased in 1991", None, "First LAUNCHED IN 1975, released in 1976"]


@query("x8_stated_years", rf"SELECT p_partkey AS id, CAST(nullif(regexp_extract({dealt(SAID)}, '(?i)\b(?:released|introduced|launched)\s+in\s+(19[0-9]{{2}}|20[0-2][0-9])', 1), '') AS INT) AS year FROM part")
def _(t):
    return t.part.select(F.col("p_partkey").alias("id"), extract.stated_year(given(SAID)).alias("year"))


POSTS = {  # html: (title, categories, tags, year, audio)
    '<title> A post </title><a rel="category tag" href="#">News</a><a rel="tag" href="#">Acme</a><a href="#" rel="tag">1984</a><a rel="tag" href="#">1979</a><a href="/x.mp3">l</a><audio src="/x.mp3"></audio>': ("A post", "", "News,Acme", 1979, "/x.mp3"),
    '<a rel="category" href="#">Reviews</a><a rel="tag" href="#">TB-3</a><a href="/a.FLAC">x</a><a href="/b.pdf">y</a>': ("", "Reviews", "TB-3", None, "/a.FLAC"), "<title>Bare</title>": ("Bare", "", "", None, ""),
    '<TITLE>x</TITLE><a class=c rel="category">A</a><a rel=\'category\'>B</a>': ("x", "A,B", "", None, ""),
}


@query("x10_post_taxonomy", "SELECT p_partkey AS id, " + ", ".join(f"{dealt([v[i] for v in POSTS.values()])} AS {n}" for i, n in enumerate(("title", "categories", "tags", "year", "audio"))) + " FROM part")
def _(t):
    found = extract.post_taxonomy(t.part.select(F.col("p_partkey").alias("id"), given(list(POSTS)).alias("html")), "id")
    return found.select("id", "title", F.array_join("categories", ",").alias("categories"), F.array_join("tags", ",").alias("tags"), "year", F.array_join("audio", ",").alias("audio"))


LOGOS = {
    '<img src="/a.png"><img class="logo" src="/logo.png"><img alt="Logo" src="img/l2.png"><meta property="og:image" content="https://c.example.com/logo.jpg">': "https://x.example.com/logo.png https://x.example.com/p/img/l2.png https://c.example.com/logo.jpg",
    '<link rel="shortcut icon" href="//cdn.example.com/i.svg"><meta property="og:image" content="/photo.jpg">': "https://cdn.example.com/i.svg", '<img src="/x.png"><link rel="icon" href="/i.png">': None,
    '<img id="logo1" src="/1.png"><img id="logo2" src="/1.png"><img id="logo3" src="/3.png"><img id="logo4" src="/4.png"><img id="logo5" src="/5.png"><img id="logo6" src="/6.png">': "https://x.example.com/1.png https://x.example.com/3.png https://x.example.com/4.png https://x.example.com/5.png",
}


@query("x11_logo_candidates", f"SELECT * FROM (SELECT p_partkey AS id, {dealt(list(LOGOS.values()))} AS logos FROM part) WHERE logos IS NOT NULL")
def _(t):
    pages = t.part.select(F.col("p_partkey").alias("id"), F.lit("https://x.example.com/p/page.html").alias("url"), given(list(LOGOS)).alias("html"))
    found = extract.logo_candidates(pages, "id")
    return found.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "logo"))), lambda x: x["logo"]), " ").alias("logos"))


@query("x12_specs_long", """SELECT p_partkey AS id, unnest(['body_type', 'size_in_mm', 'x_y']) AS field, unnest([CASE WHEN p_size % 3 > 0 THEN p_type END, CAST(p_size AS VARCHAR), CASE WHEN p_size % 2 = 0 THEN 'a b' END]) AS value FROM part""")
def _(t):
    specs = F.create_map(F.lit("Body Type"), F.when(F.col("p_size") % 3 > 0, F.col("p_type")), F.lit("Size (in mm)"), F.concat(F.lit(" "), F.col("p_size").cast("string")), F.lit("--X/Y!"), F.when(F.col("p_size") % 2 == 0, "a b ").otherwise(" "))
    found = extract.specs_long(t.part.select(F.col("p_partkey").alias("id"), specs.alias("specs")), "id").select("id", "field", "value")
    every = t.part.select(F.col("p_partkey").alias("id"), F.explode(F.array(*map(F.lit, ("body_type", "size_in_mm", "x_y")))).alias("field"))
    return every.join(found, ["id", "field"], "left")


_TEXT = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', chr(10), 'g'), '(?s)<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g'), '[ \t\r\f]+', ' ', 'g')"
_TEXT = rf"regexp_replace(regexp_replace(regexp_replace({_TEXT}, ' ?\n ?', chr(10), 'g'), '\n{{2,}}', chr(10), 'g'), '^[\n ]+|[\n ]+$', '', 'g')"


@query("x1_page_text", f"SELECT page_id, CAST(len(string_split(t, chr(10))) AS INT) AS lines, md5(t) AS text_md5 FROM (SELECT page_id, {_TEXT} AS t FROM pages)")
def _(t):
    text = extract.html_to_text("html")
    return t.pages.select("page_id", F.size(F.split(text, "\n")).alias("lines"), F.md5(text).alias("text_md5"))


# Evidence, audits, reports


@query("k3_flatten_conflict", "SELECT p_partkey AS id, 'year: ' || p_size || CASE WHEN p_size % 2 = 0 THEN ' (u' || p_size || ')' ELSE '' END || CASE WHEN p_size % 5 > 0 THEN ' vs ' || p_brand || ' (b)' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN ' -- ' || p_type ELSE '' END AS conflict FROM part")
def _(t):
    one = F.struct(F.col("p_size").cast("string").alias("value"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("u"), F.col("p_size").cast("string"))).alias("url"))
    two = F.struct(F.col("p_brand").alias("value"), F.lit("b").alias("url"))
    values = F.when(F.col("p_size") % 5 > 0, F.array(one, two)).otherwise(F.array(one))
    return t.part.select(F.col("p_partkey").alias("id"), evidence.flatten_conflict(F.lit("year"), values, F.when(F.col("p_size") % 3 == 0, F.col("p_type"))).alias("conflict"))


@query("k7_close_queue", """SELECT q.id, CASE WHEN q.status = 'done' OR e.c IS NULL THEN q.status WHEN e.c = 'confirmed' THEN 'done' ELSE 'needs_review' END AS status FROM queue q
    LEFT JOIN (SELECT lower(trim(q.name)) AS l, min(CASE WHEN s_suppkey % 3 = 0 THEN 'confirmed' ELSE 'needs_review' END) AS c, min(q.id) AS id FROM supplier JOIN queue q ON lower(trim(q.name)) = lower(s_name) AND s_suppkey % 2 = 1 AND q.status <> 'done' GROUP BY 1) e ON e.id = q.id""", "queue")
def _(t):
    entries = t.supplier.filter("s_suppkey % 2 = 1").select(F.array(F.lit("nobody"), F.lit(" "), F.upper("s_name"), F.concat("s_name", F.lit(" Ltd"))).alias("names"), F.when(F.col("s_suppkey") % 3 == 0, "confirmed").otherwise("needs_review").alias("confidence"))
    return evidence.close_queue(t.queue, entries).select("id", "status")


@query("k17_promote_official", """SELECT m.id, 'https://' || d.lo || '/' AS official_website FROM makers m JOIN (SELECT maker_id, min(d) AS lo, max(d) AS hi FROM (
    SELECT maker_id, CASE WHEN maker_id % 4 = 1 THEN 'own' || maker_id || '.example.org' ELSE domain END AS d FROM links WHERE link_type = 'manufacturer_official' AND status IN ('live', 'redirected', 'blocked') AND maker_id IS NOT NULL) GROUP BY 1) d ON d.maker_id = m.id AND d.lo = d.hi WHERE m.official_website IS NULL""", "makers", "links")
def _(t):
    own = F.when(F.col("maker_id") % 4 == 1, F.concat(F.lit("own"), F.col("maker_id").cast("string"), F.lit(".example.org"))).otherwise(F.col("domain"))
    return evidence.promote_official(t.makers, t.links.withColumn("domain", own).withColumn("final_url", F.lit(None).cast("string")))[0]


@query("k10_rule_registry", """SELECT 'maker' AS kind, m.id, coalesce(m.country, CASE WHEN g.lo = g.hi THEN g.lo END) AS value FROM makers m
    LEFT JOIN (SELECT 'City ' || CAST(s_suppkey % 7 AS VARCHAR) AS city, min('Land ' || s_nationkey % 2 * (s_suppkey % 7 // 4)) AS lo, max('Land ' || s_nationkey % 2 * (s_suppkey % 7 // 4)) AS hi FROM supplier GROUP BY 1) g ON g.city = m.city
    UNION ALL SELECT 'product', p.id, coalesce(CASE WHEN p.technology = 'unknown' THEN f.v END, p.technology) FROM products p LEFT JOIN (SELECT entity_id, CASE WHEN min(value) = max(value) THEN min(value) END AS v FROM {TECHNOLOGY} GROUP BY 1) f ON f.entity_id = p.id""".replace("{TECHNOLOGY}", TECHNOLOGY), "makers", "specs", "products")
def _(t):
    seven = F.col("s_suppkey") % 7
    gazetteer = t.supplier.select(F.concat(F.lit("City "), seven.cast("string")).alias("city"), F.concat(F.lit("Land "), (F.col("s_nationkey") % 2 * F.floor(seven / 4)).cast("string")).alias("country"))
    tables = {"makers": t.makers, "products": t.products, "specs": t.specs, "gazetteer": gazetteer}
    filled, _ = evidence.run_rules(tables, t.claims)
    return filled["makers"].select(F.lit("maker").alias("kind"), "id", F.col("country").alias("value")).union(filled["products"].select(F.lit("product"), "id", "technology"))


_SPOTS = ["/products/x-", "/brand12/x-", "/list/nothing-", "/tag/products/x-", "/list/brand12-x-"]


def _spotted(t):
    url = F.concat(F.lit("https://www.shop"), (F.col("id") % 9).cast("string"), F.lit(".example.com"), F.element_at(F.array(*map(F.lit, _SPOTS)), (F.col("id") % 5 + 1).cast("int")), F.when(F.col("id") % 9 < 7, F.col("id").cast("string")).otherwise("one"))
    return t.products.withColumn("source_url", F.when(F.col("id") % 13 != 0, url))


_SPOTTED = f"""(SELECT DISTINCT 'shop' || id % 9 || '.example.com' AS domain, {dealt(_SPOTS, 'id')} || CASE WHEN id % 9 < 7 THEN CAST(id AS VARCHAR) ELSE 'one' END AS path, id % 5 IN (0, 1, 4) AS hit FROM products WHERE id % 13 <> 0)"""


@query("q10_detector_recall", f"""SELECT coalesce(domain, '') AS domain, count(*) AS urls, CAST(count(*) FILTER (hit) AS BIGINT) AS found, count(*) FILTER (hit) / count(*) >= 0.8 AS passed FROM {_SPOTTED} WHERE domain IN ('shop0.example.com', 'shop1.example.com', 'shop2.example.com', 'shop3.example.com', 'shop4.example.com', 'shop5.example.com', 'shop6.example.com') GROUP BY ROLLUP (domain)""", "products")
def _(t):
    return audit.detector_recall(_spotted(t), t.domains, t.dictionary("canonical", "history")).select("domain", "urls", "found", "passed")


@query("q11_sitemap_yield", f"SELECT domain, count(*) AS total, CAST(count(*) FILTER (hit) AS BIGINT) AS product_like, CASE WHEN count(*) FILTER (hit) = 0 THEN 'none' WHEN count(*) FILTER (hit) / count(*) > 0.9 THEN 'suspicious' ELSE '' END AS note FROM (SELECT CASE WHEN hit AND length(path) % 2 = 0 THEN 'a' || domain WHEN hit THEN domain ELSE CASE WHEN length(path) % 3 = 0 THEN 'b' || domain ELSE domain END END AS domain, path, hit FROM {_SPOTTED}) GROUP BY 1", "products")
def _(t):
    rows = _spotted(t).filter("source_url is not null").select(keys.domain_of("source_url").alias("d"), F.col("source_url").alias("url"), F.regexp_extract("source_url", "^https://[^/]*(/.*)$", 1).alias("path"), (F.col("id") % 5).isin(0, 1, 4).alias("hit")).distinct()
    domain = F.when(F.col("hit") & (F.length("path") % 2 == 0), F.concat(F.lit("a"), "d")).when(~F.col("hit") & (F.length("path") % 3 == 0), F.concat(F.lit("b"), "d")).otherwise(F.col("d"))
    return audit.sitemap_yield(rows.select(domain.alias("domain"), "url"), t.dictionary("canonical", "history")).select("domain", "total", "product_like", "note")


@query("q15_reread_links", f"""SELECT l.id, CASE WHEN m.id IS NULL THEN 'no maker' WHEN k.k IS NOT NULL THEN 'already' ELSE (['new', 'not-instrument', 'undecided'])[l.id % 3 + 1] END AS outcome
    FROM (SELECT p_partkey AS id, p_size % 30 AS n, {NORM.format('p_name')} AS k FROM part) l LEFT JOIN (SELECT DISTINCT maker_id AS id FROM maker_names) m ON m.id = l.n
    LEFT JOIN (SELECT DISTINCT maker_id, {NORM.format('name')} AS k FROM products) k ON k.maker_id = l.n AND k.k = l.k""", "maker_names", "products")
def _(t):
    turn = F.col("p_partkey") % 3
    title = F.when(turn == 0, F.lit("Thing Synthesizer | Shop")).when(turn == 1, F.lit("Thing Amplifier | Shop")).otherwise("Thing | Shop")
    links = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("old-brand-"), (F.col("p_size") % 30).cast("string"), F.lit("-"), F.translate("p_name", " ", "-")).alias("slug"), F.lit("").alias("label"), title.alias("title"))
    return audit.reread_links(links, t.products, t.dictionary()).select("id", "outcome")


@query("a4_logo_counts", "SELECT coalesce(review_status, 'open') AS review_status, count(*) AS n FROM logos GROUP BY 1", "logos")
def _(t):
    return reports.logo_counts(t.logos)


@query("a8_verdict_counts", "SELECT verdict, count(*) AS n FROM domains GROUP BY 1", "domains")
def _(t):
    return reports.verdict_counts(t.domains)


@query("a13_product_actions", """SELECT p.id, CASE WHEN a.action = 'accept' THEN NULL ELSE p.review_status END AS review_status, CASE WHEN a.action = 'note' THEN a.note END AS owner_note,
    (SELECT count(*) FROM links l WHERE l.product_id = p.id) AS links FROM products p LEFT JOIN (SELECT event_id % 2000 AS product_id, max_by(CASE event_type WHEN 'click' THEN 'accept' WHEN 'error' THEN 'delete' ELSE 'note' END, row(ts, event_id)) AS action, max_by(event_type, row(ts, event_id)) AS note FROM events GROUP BY 1) a ON a.product_id = p.id WHERE a.action IS DISTINCT FROM 'delete'""", "products", "links")
def _(t):
    action = F.when(F.col("event_type") == "click", "accept").when(F.col("event_type") == "error", "delete").otherwise("note")
    actions = t.events.select(F.col("event_id").alias("id"), (F.col("event_id") % 2000).alias("product_id"), action.alias("action"), F.col("event_type").alias("note"), F.col("ts").alias("created_at"))
    products, links, _ = reports.apply_product_actions(t.products.withColumn("owner_note", F.lit(None).cast("string")), t.links, t.membership, actions)
    n = links.groupBy(F.col("product_id").alias("id")).agg(F.count("*").alias("links"))
    return products.join(n, "id", "left").select("id", "review_status", "owner_note", F.coalesce("links", F.lit(0)).alias("links"))


@query("a13_logo_actions", """SELECT l.id, coalesce(a.action, l.review_status) AS review_status, CASE WHEN a.action = 'wrong' THEN false ELSE l.has_file END AS has_file FROM logos l
    LEFT JOIN (SELECT user_id AS logo_id, max_by(CASE event_type WHEN 'click' THEN 'approved' WHEN 'error' THEN 'wrong' ELSE 'outdated' END, row(ts, event_id)) AS action FROM events GROUP BY 1) a ON a.logo_id = l.id""", "logos")
def _(t):
    action = F.when(F.col("event_type") == "click", "approved").when(F.col("event_type") == "error", "wrong").otherwise("outdated")
    actions = t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("logo_id"), action.alias("action"), F.col("ts").alias("created_at"))
    return reports.apply_logo_actions(t.logos, actions).select("id", "review_status", "has_file")


@query("a17_logo_work_list", "SELECT id, canonical_name FROM makers WHERE confidence <> 'unresearched' AND id NOT IN (SELECT maker_id FROM logos WHERE has_file AND maker_id % 3 <> 1)", "makers", "logos")
def _(t):
    return reports.logo_work_list(t.makers, t.logos.filter("has_file and maker_id % 3 <> 1"))


# Readers of files that are written from the tables


@query("s4_sitemap_urls", """SELECT DISTINCT 'd' || p_size AS domain, 'https://d' || p_size || '/' || p_partkey AS url FROM part WHERE p_partkey % 4 < 2 OR p_partkey % 4 = 2 AND p_size % 2 = 0""")
def _(t):
    turn, size, key = F.col("p_partkey") % 4, F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    # by turns: a root of its own, a sub-sitemap, one that doesn't match where the size is odd, one that isn't .xml
    name = F.when(turn == 0, F.concat(F.lit("own"), key, F.lit(".xml"))).when(turn == 1, F.concat(F.lit("product"), key, F.lit(".xml.gz"))).when(turn == 2, F.concat(F.when(F.col("p_size") % 2 == 0, "product").otherwise("blog"), F.lit("-"), key, F.lit(".XML"))).otherwise(F.concat(F.lit("product"), key, F.lit(".txt")))
    url = F.concat(F.lit("https://d"), size, F.lit("/"), name)
    loc = F.concat(F.lit("<urlset><url><LOC> https://d"), size, F.lit("/"), key, F.lit(" </LOC></url></urlset>"))
    rows = t.part.select(F.concat(F.lit("d"), size).alias("domain"), url.alias("url"), loc.alias("body"), turn.alias("turn"), key.alias("key"))
    index = rows.filter("turn > 0").select("domain", F.concat(F.lit("https://"), "domain", F.lit("/index"), "key", F.lit(".xml")), F.concat(F.lit("<sitemapindex><sitemap><loc>"), "url", F.lit("</loc></sitemap></sitemapindex>")))
    return readers.sitemap_urls(rows.select("domain", "url", "body").union(index), include="product")


@query("s5_feed", """SELECT 'https://p.example.com/' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '/' || n ELSE '' END AS url, p_name || n AS title, CASE WHEN p_size % 2 = 0 THEN p_brand || ',' || p_type ELSE p_brand END AS labels, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'a b ' || p_size END AS summary
    FROM part, (SELECT unnest([1, 2]) AS n) WHERE p_partkey % 3 = 0 OR n = 1""")
def _(t):
    text = lambda c: F.struct(c.alias("$t"))
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    term = lambda c: F.struct(c.alias("term"))
    link = lambda rel, href: F.struct(F.lit(rel).alias("rel"), href.alias("href"))

    def entry(n: int, path: Column) -> Column:
        summary = F.when(F.col("p_size") % 5 == 0, "<img src=x>").otherwise(F.concat(F.lit("<b>a</b>\n b <i>"), size, F.lit("</i>")))
        terms = F.when(F.col("p_size") % 2 == 0, F.array(term(F.col("p_brand")), term(F.col("p_type")))).otherwise(F.array(term(F.col("p_brand"))))
        return F.struct(text(F.concat("p_name", F.lit(str(n)))).alias("title"), text(summary).alias("summary"), text(F.lit("2020")).alias("published"), terms.alias("category"), F.array(link("self", F.lit("https://self.example.com")), link("alternate", F.concat(F.lit("https://p.example.com/"), path))).alias("link"))

    entries = F.when(F.col("p_partkey") % 3 == 0, F.array(entry(1, F.concat(key, F.lit("/1"))), entry(2, F.concat(key, F.lit("/2"))))).otherwise(F.array(entry(1, key)))
    feeds = t.part.select(F.to_json(F.struct(F.struct(entries.alias("entry")).alias("feed"))).alias("body"))
    return readers.flatten_feed(feeds).select("url", "title", F.array_join("labels", ",").alias("labels"), "summary")


@query("s6_bindings", """SELECT label, min(qid) AS qid, CASE WHEN min(qid) % 7 > 0 THEN 1950 + min(qid) % 50 END AS year FROM (SELECT p_brand || ' ' || p_partkey % 100 AS label, p_partkey AS qid FROM part WHERE p_partkey % 11 > 0) GROUP BY 1""")
def _(t):
    value = lambda c: F.struct(c.alias("value"))
    key = F.col("p_partkey")
    label = F.when(key % 11 > 0, F.concat("p_brand", F.lit(" "), (key % 100).cast("string"))).otherwise(F.concat(F.lit("Q"), key.cast("string")))
    date = F.when(key % 7 > 0, F.concat((key % 50 + 1950).cast("string"), F.lit("-01-01T00:00:00Z"))).otherwise("t123")
    item = F.concat(F.lit("http://w.example.com/entity/"), F.lpad(key.cast("string"), 9, "0"))  # ids of one width, so that they sort as numbers
    binding = F.struct(value(item).alias("item"), value(label).alias("itemLabel"), value(F.col("p_brand")).alias("makerLabel"), value(date).alias("date"))
    body = F.to_json(F.struct(F.struct(F.array(binding).alias("bindings")).alias("results")))
    return readers.flatten_bindings(t.part.select(body.alias("body"))).select("label", F.col("qid").cast("long").alias("qid"), "year")


LISTED = {
    '<a href="../">up</a><a href="?C=N">n</a><a href="Acme%20A/">d</a><a href="tb&amp;3.PDF">f</a><a href="x.html">h</a>': "dir:Acme%20A/|file:tb&3.PDF", '<A HREF=\'/abs/\'>a</A><a href="https://o.example.com/a.pdf">o</a>': None,
    '<a href="a.pdf">1</a><a href="a.pdf">2</a><a href="b.djvu">3</a><a href="mailto:x">m</a><a href="#t/">t</a>': "file:a.pdf|file:b.djvu", "": None, '<a href="d/e/">d</a><a href="it&#39;s.zip">z</a>': "dir:d/e/|file:it's.zip",
}


@query("s7_listing_entries", f"SELECT * FROM (SELECT p_partkey AS id, {dealt(list(LISTED.values()))} AS entries FROM part) WHERE entries IS NOT NULL")
def _(t):
    found = readers.listing_entries(t.part.select(F.col("p_partkey").alias("id"), given(list(LISTED)).alias("html")), "id")
    return found.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("kind", F.lit(":"), "entry"))), "|").alias("entries"))


#: Rows of a JSON file, about.
FILE_ROWS = 5000


def json_files(rows, head: str, tail: str) -> str:
    """A folder of JSON files from ``rows`` (p_partkey, text), FILE_ROWS to each, about, by a hash of the key."""
    n = max(1, rows.count() // FILE_ROWS)
    texts = rows.groupBy(F.pmod(F.xxhash64("p_partkey"), F.lit(n)).alias("batch")).agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list("text")), ","), F.lit(tail)).alias("value"))
    folder = store.scratch(rows.sparkSession)
    # each line is a document, and a file of its own
    texts.repartition(n, "batch").select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return folder


def _batches(t):
    key = F.col("p_partkey")
    name = F.when(key % 6 == 5, " ").when(key % 6 == 4, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit(" New "), key.cast("string")))
    items = F.concat(F.lit('["Solo", " ", {"name": "'), "p_name", F.lit('", "year": '), (F.col("p_size") + 1950).cast("string"), F.lit("}]"))
    sources = F.when(key % 2 == 0, '[{"field_name": "country", "value": "x", "source_url": "https://a.example.com"}]').otherwise("[]")
    text = F.concat(F.lit('{"canonical_name": "'), name, F.lit('", "country": "Land '), (key % 3).cast("string"), F.lit('", "instruments": '), items, F.lit(', "sources": '), sources, F.lit("}"))
    return readers.read_batches(t.part.sparkSession, json_files(t.part.select("p_partkey", text.alias("text")), '{"manufacturers": [', "]}"))


@query("s1_read_batches", """SELECT CASE WHEN p_partkey % 6 = 4 THEN p_brand ELSE p_brand || ' New ' || p_partkey END AS canonical_name, 'Solo:0|' || p_name || ':' || (1950 + p_size) AS items, CAST(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS n_sources FROM part WHERE p_partkey % 6 <> 5""")
def _(t):
    items = F.array_join(F.transform("instruments", lambda x: F.concat(x["name"], F.lit(":"), F.coalesce(x["year"], F.lit(0)).cast("string"))), "|")
    return _batches(t).select("canonical_name", items.alias("items"), F.size("sources").alias("n_sources"))


@query("s2_read_page_batches", "SELECT p_partkey % 4 AS source, 'm-' || p_partkey AS model_slug, CAST(1 + p_size % 2 AS INT) AS n_specs FROM part WHERE p_partkey % 5 > 0 AND p_partkey % 7 > 0")
def _(t):
    key = F.col("p_partkey")
    specs = F.when(key % 7 == 0, "{}").when(F.col("p_size") % 2 == 0, '{"Keys": "61"}').otherwise('{"Keys": "61", "FX": "2"}')
    page = F.concat(F.lit('{"model_slug": "'), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("m-"), key.cast("string"))), F.lit('", "maker_slug": "s'), (key % 4).cast("string"), F.lit('", "specs": '), specs, F.lit("}"))
    path = json_files(t.part.select("p_partkey", page.alias("text")), '{"source": "s", "pages": [', "]}")
    return readers.read_page_batches(t.part.sparkSession, path).select(F.substring("maker_slug", 2, 9).cast("long").alias("source"), "model_slug", F.size("specs").alias("n_specs"))


def _cache(t):
    text = F.when(F.col("p_partkey") % 10 == 0, "No such synth here").when(F.col("p_partkey") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("Device:\nSynth\nProduced: "), (F.col("p_size") + 1950).cast("string"), F.lit("\nTechnology:\nAnalog")))
    page = F.to_json(F.struct(F.col("p_brand").alias("manufacturer"), F.col("p_name").alias("model"), F.concat(F.lit("https://c.example.com/"), F.col("p_partkey").cast("string")).alias("url"), text.alias("text")))
    return readers.read_page_cache(t.part.sparkSession, json_files(t.part.select("p_partkey", page.alias("text")), "[", "]"))


@query("s3_read_page_cache", "SELECT 'https://c.example.com/' || p_partkey AS url, p_brand AS manufacturer, p_partkey % 10 = 0 AS dead FROM part")
def _(t):
    return _cache(t).select("url", "manufacturer", "dead")


@query("w1_batch_to_catalogue", """SELECT coalesce(m.canonical_name, e.canonical_name) AS canonical_name, coalesce(e.country, m.country) AS country,
    CASE WHEN e.canonical_name IS NULL OR coalesce(n, 0) = 0 AND m.canonical_name IS NOT NULL THEN m.confidence WHEN coalesce(n, 0) = 0 THEN 'unresearched' WHEN m.confidence = 'confirmed' THEN 'confirmed' ELSE 'needs_review' END AS confidence,
    CASE WHEN m.canonical_name IS NULL THEN 'inserted' WHEN e.canonical_name IS NULL THEN 'kept' ELSE 'merged' END AS change
    FROM makers m FULL JOIN (SELECT canonical_name, max(country) AS country, sum(n) AS n FROM (
        SELECT CASE WHEN p_partkey % 6 = 4 THEN p_brand ELSE p_brand || ' New ' || p_partkey END AS canonical_name, 'Land ' || p_partkey % 3 AS country, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS n FROM part WHERE p_partkey % 6 <> 5) GROUP BY 1) e ON e.canonical_name = m.canonical_name""", "makers")
def _(t):
    """Files of research batches, their confidence, and the makers after the merge."""
    batch = _batches(t).groupBy("canonical_name").agg(F.max("country").alias("country"), F.flatten(F.collect_list("sources")).alias("sources"))
    claims = batch.select(F.col("canonical_name").alias("entity_id"), F.explode("sources").alias("s")).select("entity_id", "s.*")
    rolled = evidence.roll_up(batch.select(F.col("canonical_name").alias("entity_id"), "country", F.array().cast("array<string>").alias("conflicts")), claims, core=("country",))
    entries = batch.join(rolled, F.col("entity_id") == F.col("canonical_name")).select("canonical_name", "country", "confidence", F.size("sources").alias("n_sources"), F.lit(0).alias("n_conflicts"))
    return evidence.merge_makers(t.makers, entries, ["country"])


@query("w3_cache_to_publication", f"""SELECT m.id AS maker_id, count(p.id) AS n_products, string_agg(p.name || ':' || coalesce(p.year, 0) || ':' || p.technology, '|' ORDER BY coalesce(p.year, 9999), p.name, p.technology) AS products FROM makers m LEFT JOIN (
    SELECT p.id, p.maker_id, p.name, coalesce(p.year, CASE WHEN p.id % 10 > 1 THEN 1950 + p_size END) AS year,
        CASE WHEN p.technology = 'unknown' THEN coalesce(CASE WHEN p.id % 10 > 1 THEN 'analog' END, f.v, 'unknown') ELSE p.technology END AS technology
    FROM products p JOIN part ON p_partkey = p.id LEFT JOIN (SELECT entity_id, CASE WHEN min(value) = max(value) THEN min(value) END AS v FROM {TECHNOLOGY} GROUP BY 1) f ON f.entity_id = p.id) p ON p.maker_id = m.id GROUP BY 1""", "makers", "products", "specs")
def _(t):
    """Cached pages, specs read from them, products filled, facts derived, the nested catalogue published."""
    pages = extract.read_specs(_cache(t).drop("dead"))
    products = t.products.withColumn("source_url", F.concat(F.lit("https://c.example.com/"), F.col("id").cast("string")))
    filled = evidence.fill_from_cache(products, pages).join(products.select("id", "maker_id", "name"), "id")
    filled, _ = evidence.apply_facts(filled, evidence.derive_technology(t.specs, filled), t.claims, ["technology"])
    out = readers.publish(t.makers, t.maker_names, filled.withColumn("category", F.col("technology")), t.relations, t.logos)
    shown = F.array_join(F.transform("instruments", lambda x: F.concat_ws(":", x["name"], F.coalesce(x["year"], F.lit(0)).cast("string"), x["category"])), "|")
    return out.select("maker_id", F.coalesce(F.size("instruments"), F.lit(0)).cast("long").alias("n_products"), shown.alias("products"))

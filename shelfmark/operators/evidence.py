"""Evidence: confidence, merging, append-only children, derived facts.

Writes are idempotent: what is there already is not added again, stated values are
never overwritten by derived ones, and ambiguity leaves a value open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.keys import domain_of, first_by, is_blank, norm, nulls_last, value_key
from ..sources.store import Kept, scratch, written
from .ranks import first_of
from .resolve import resolve_maker, source_key


def field_confidence(claims: DataFrame, entity: str = "entity_id", narrative: Sequence[str] = vocab.NARRATIVE_FIELDS, official: str = "manufacturer_official") -> DataFrame:
    """K1: (entity, field_name, confirmed): an official source, or two URLs (on one value, but for narratives)."""
    rows = claims.filter(~is_blank("source_url"))
    value = F.when(F.col("field_name").isin(*narrative), F.lit("")).otherwise(F.coalesce(value_key("value"), F.lit("")))
    per_value = rows.groupBy(entity, "field_name", value.alias("_v")).agg((F.min("source_url") < F.max("source_url")).alias("two"), F.max(F.col("source_tier") == official).alias("o"))
    return per_value.groupBy(entity, "field_name").agg((F.coalesce(F.max("o"), F.lit(False)) | F.max("two")).alias("confirmed"))


def roll_up(entries: DataFrame, claims: DataFrame, entity: str = "entity_id", core: Sequence[str] = vocab.CORE_FIELDS) -> DataFrame:
    """K2: (entity, confidence, reasons): ``entries`` (entity, conflicts, core fields) over their claims.

    Core fields present in the entry must be confirmed; a conflict means needs_review.
    """
    confirmed = field_confidence(claims, entity).filter("confirmed").groupBy(entity).agg(F.collect_set("field_name").alias("_ok"))
    rows = entries.join(confirmed, entity, "left")
    ok = F.coalesce("_ok", F.array().cast("array<string>"))
    weak = F.filter(F.array(*[F.when(~is_blank(f) & ~F.array_contains(ok, f), F.concat(F.lit(f), F.lit(" not confirmed"))) for f in core]), lambda x: x.isNotNull())
    conflicts = F.coalesce("conflicts", F.array().cast("array<string>"))
    reasons = F.concat(conflicts, weak)
    return rows.select(entity, F.when(F.size(reasons) == 0, "confirmed").otherwise("needs_review").alias("confidence"), F.array_join(reasons, "; ").alias("reasons"))


def flatten_conflict(field: Column | str, values: Column | str, note: Column | str) -> Column:
    """K3: "field: v (url) vs v (url) -- note"; ``values``: array of struct(value, url)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    shown = F.array_join(F.transform(c(values), lambda v: F.concat(v["value"], F.when(v["url"].isNotNull(), F.concat(F.lit(" ("), v["url"], F.lit(")"))).otherwise(F.lit("")))), " vs ")
    return F.concat(c(field), F.lit(": "), shown, F.when(c(note).isNotNull(), F.concat(F.lit(" -- "), c(note))).otherwise(F.lit("")))


def merge_makers(makers: DataFrame, entries: DataFrame, fields: Sequence[str], key: str = "canonical_name", log: DataFrame | None = None) -> DataFrame:
    """K4: makers after a batch: its values that aren't blank overwrite, blanks never erase.

    ``entries`` have ``key``, ``fields``, n_sources, n_conflicts and confidence.  Without
    sources confidence stays; needs_review without a conflict never demotes confirmed;
    with one it never demotes what the owner confirmed (``log``: key, action).
    """
    stored = makers.select(key, "confidence", *fields, F.lit(True).alias("_old"))
    batch = entries.select(F.col(key).alias("_key"), F.col("confidence").alias("_confidence"), "n_sources", "n_conflicts", *[F.col(f).alias(f"_{f}") for f in fields])
    rows = stored.join(batch, F.col(key) == F.col("_key"), "full_outer")
    owned = F.lit(False)
    if log is not None:
        by_owner = log.filter("action = 'owner_confirmed'").select(F.col(key).alias("_owned")).distinct()
        rows = rows.join(by_owner, F.col(key) == F.col("_owned"), "left")
        owned = F.col("_owned").isNotNull()
    old, new = F.col("confidence"), F.col("_confidence")
    keep = (F.coalesce("n_sources", F.lit(0)) == 0) | ((old == "confirmed") & (new == "needs_review") & ((F.col("n_conflicts") == 0) | owned))
    confidence = F.when(F.col("_key").isNull() | (F.col("_old") & keep), old).when(F.coalesce("n_sources", F.lit(0)) == 0, "unresearched").otherwise(new)
    merged = [F.when(~is_blank(f"_{f}"), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields]
    return rows.select(F.coalesce(key, "_key").alias(key), F.coalesce(confidence, F.lit("unresearched")).alias("confidence"), *merged, F.when(F.col("_old").isNull(), "inserted").when(F.col("_key").isNull(), "kept").otherwise("merged").alias("change"))


def append_new(df: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``df`` whose keys (null-safe) aren't in ``existing``; once each key."""
    once = first_by(df, keys, *[x for c in (order or [c for c in df.columns if c not in keys] or keys) for x in nulls_last(c)])
    held = existing.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]).distinct()
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition &= once[k].eqNullSafe(held[f"_h{i}"])
    return once.join(held, condition, "left_anti")


def append_to(table: Kept, batch: DataFrame, order: Sequence[str] = ()) -> None:
    """Add to a kept table the rows of ``batch`` whose keys it hasn't; the table's keys tell rows apart.

    Only the partitions of the batch's keys are read and written; again, it changes nothing.
    """
    table.apply(batch, lambda held, new: held.unionByName(append_new(new.select(*held.columns), held, table.keys, order)))


def make_stubs(relations: DataFrame, makers: DataFrame, queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K6: (new maker stubs, new queue rows) for related companies (related) that nobody knows."""
    names = first_by(relations.filter(~is_blank("related")).select(F.trim("related").alias("name")).withColumn("_l", F.lower("name")), ["_l"], F.col("name"))
    known = makers.select(F.lower(F.trim("canonical_name")).alias("_l")).distinct()
    fresh = names.join(known, "_l", "left_anti")
    queued = queue.select(F.lower(F.trim("name")).alias("_l")).distinct()
    stubs = fresh.select(F.col("name").alias("canonical_name"), F.lit("unresearched").alias("confidence"), F.lit("company").alias("entity_type"), F.lit("unknown").alias("status"))
    return stubs, fresh.join(queued, "_l", "left_anti").select("name", F.lit("found").alias("status"))


def close_queue(queue: DataFrame, entries: DataFrame) -> DataFrame:
    """K7: ``queue`` with the rows that ``entries`` (names in order of preference, confidence) close.

    Of an entry's names the first with a row that isn't done closes that row.
    """
    names = entries.select(F.xxhash64("names").alias("_e"), "confidence", F.posexplode("names").alias("pos", "name")).filter(~is_blank("name"))
    names = names.select("_e", "confidence", "pos", F.lower(F.trim("name")).alias("_l"))
    open_rows = queue.filter("status <> 'done'").select("id", F.lower(F.trim("name")).alias("_l"))
    first = names.join(open_rows, "_l").groupBy("_e").agg(F.min_by(F.struct("id", "confidence"), F.struct("pos", "id")).alias("b"))
    closed = first.select("b.id", "b.confidence").groupBy("id").agg(F.min("confidence").alias("_c"))
    out = queue.join(closed, "id", "left")
    status = F.when(F.col("_c") == "confirmed", "done").when(F.col("_c").isNotNull(), "needs_review").otherwise(F.col("status"))
    return out.withColumn("status", status).drop("_c")


def derive_country(makers: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """K8: (id, country, status): a blank country from the city, if the gazetteer has exactly one."""
    asked = makers.filter(is_blank("country") & ~is_blank("city")).select("id", F.lower(F.trim("city")).alias("_city"))
    places = gazetteer.filter(~is_blank("country")).groupBy(F.lower(F.trim("city")).alias("_city")).agg(F.min("country").alias("lo"), F.max("country").alias("hi"))
    rows = asked.join(places, "_city", "left")
    status = F.when(F.col("lo").isNull(), "unknown city").when(F.col("lo") != F.col("hi"), "ambiguous city").otherwise("derived")
    return rows.select("id", F.when(status == "derived", F.col("lo")).alias("country"), status.alias("status"))


def derive_technology(specs: DataFrame, products: DataFrame) -> DataFrame:
    """K9: (entity_id, field, value, source_url, tier, derived_from): technology stated by oscillator text.

    Silent on ambiguous words, on both kinds or neither; analog also if another spec of
    the product tells of digital sound.
    """
    field, value = F.col("field"), F.col("value")
    tells = specs.filter(field.isin("sample_rate", "rom_size") | (field.isin("waveforms", "memory") & F.lower("value").rlike("rom|wavetable|sample"))).select("product_id").distinct()
    unknown = products.filter(F.col("technology").isNull() | (F.col("technology") == "unknown")).select(F.col("id").alias("product_id"))
    rows = specs.filter((field == "oscillators") & ~is_blank("value")).join(unknown, "product_id")
    digital, analog = value.rlike(vocab.DIGITAL), value.rlike(vocab.ANALOG)
    rows = rows.filter(~value.rlike(vocab.AMBIGUOUS) & (digital != analog)).withColumn("technology", F.when(digital, "digital").otherwise("analog"))
    silent = rows.filter("technology = 'analog'").join(tells, "product_id", "left_anti")
    rows = rows.filter("technology = 'digital'").unionByName(silent)
    return rows.select(F.col("product_id").alias("entity_id"), F.lit("technology").alias("field"), F.col("technology").alias("value"), "source_url", F.lit("other").alias("tier"), F.concat(F.lit("technology_from_oscillators: oscillators="), F.substring("value", 1, 120)).alias("derived_from"))


def apply_facts(entities: DataFrame, facts: DataFrame, claims: DataFrame, fields: Sequence[str], unknown: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(entities filled where blank, provenance rows to add) from ``facts`` of allowed fields.

    A rule's provenance is added once for each entity and field; of several facts on one
    field the first by value fills it, if all agree, else none.
    """
    unknown = {"technology": "unknown"} if unknown is None else unknown
    allowed = facts.filter(F.col("field").isin(*fields))
    agreed = allowed.groupBy("entity_id", "field").agg(F.min("value").alias("value"), F.max("value").alias("_z")).filter("value = _z")
    wide = agreed.groupBy("entity_id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"_{f}") for f in fields])
    out = entities.join(wide.withColumnRenamed("entity_id", "id"), "id", "left")
    for f in fields:
        open_ = is_blank(f) | (F.col(f) == unknown[f]) if f in unknown else is_blank(f)
        out = out.withColumn(f, F.when(open_ & F.col(f"_{f}").isNotNull(), F.col(f"_{f}").cast(entities.schema[f].dataType)).otherwise(F.col(f))).drop(f"_{f}")
    rows = allowed.select("entity_id", F.col("field").alias("field_name"), "value", "source_url", F.col("tier").alias("source_tier"), "derived_from")
    return out, append_new(rows, claims, ["entity_id", "field_name", "derived_from"])


def apply_facts_to(entities: Kept, claims: Kept, facts: DataFrame, fields: Sequence[str], unknown: dict[str, str] | None = None) -> None:
    """K10 on kept tables, ``entities`` by id and ``claims`` by entity_id, field_name and derived_from.

    Provenance is written first: a run that is killed in between has filled nothing yet, so
    the next one derives the same facts again.  Only partitions of the facts' entities change.
    """
    facts = written(facts, scratch(facts.sparkSession, "facts"))  # they may be derived from the tables that change
    rows = facts.filter(F.col("field").isin(*fields)).select("entity_id", F.col("field").alias("field_name"), "value", "source_url", F.col("tier").alias("source_tier"), "derived_from")
    append_to(claims, rows)
    none = rows.limit(0)
    entities.apply(facts.select(F.col("entity_id").alias("id")).distinct(), lambda held, _: apply_facts(held, facts, none, fields, unknown)[0])


def retract_rule(claims: DataFrame, rule: str) -> DataFrame:
    """Claims without those that a rule derived."""
    return claims.filter(~F.coalesce(F.startswith("derived_from", F.lit(rule)), F.lit(False)))


def first_year(c: Column | str) -> Column:
    year = F.regexp_extract(F.col(c) if isinstance(c, str) else c, r"\b((?:18|19|20)[0-9]{2})\b", 1)
    return F.when(year != "", year.cast("int"))


def fill_years(products: DataFrame, pages: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(id, year, filled_by): products without a year, by source URL, else by maker and key.

    ``pages``: source_url, maker, display_name, produced.
    """
    known = resolve_maker(pages, "maker", dictionary).withColumn("_year", first_year("produced")).filter("_year is not null")
    by_url = known.groupBy(source_key("source_url").alias("_url")).agg(F.min("_year").alias("_y1"))
    by_key = known.filter("maker_id is not null").groupBy("maker_id", norm("display_name").alias("_key")).agg(F.min("_year").alias("_y2")).filter("_key <> ''")
    rows = products.filter("year is null").select("id", "maker_id", source_key("source_url").alias("_url"), norm("name").alias("_key"))
    rows = rows.join(by_url, "_url", "left").join(by_key, ["maker_id", "_key"], "left")
    return rows.select("id", F.coalesce("_y1", "_y2").alias("year"), F.when(F.col("_y1").isNotNull(), "url").when(F.col("_y2").isNotNull(), "name").alias("filled_by")).filter("year is not null")


def fill_from_cache(products: DataFrame, pages: DataFrame, note: str = "source page is dead") -> DataFrame:
    """Products with year, category and technology filled from ``pages`` (url, dead, year, device, technology) where blank."""
    own = pages.groupBy(F.col("url").alias("source_url")).agg(F.max("dead").alias("_dead"), F.min("year").alias("_year"), F.min("device").alias("_device"), F.min("technology").alias("_technology"))
    rows = products.join(own, "source_url", "left")
    dead = F.coalesce("_dead", F.lit(False))
    noted = F.contains(F.coalesce("review_note", F.lit("")), F.lit(note))
    return rows.select(
        "id",
        F.coalesce("year", "_year").alias("year"),
        F.when(is_blank("category"), F.col("_device")).otherwise(F.col("category")).alias("category"),
        F.when(F.col("technology").isNull() | (F.col("technology") == "unknown"), F.coalesce("_technology", "technology")).otherwise(F.col("technology")).alias("technology"),
        F.when(dead, "needs_review").otherwise(F.col("review_status")).alias("review_status"),
        F.when(dead & ~noted, F.concat_ws(" | ", F.nullif("review_note", F.lit("")), F.lit(note))).otherwise(F.col("review_note")).alias("review_note"),
    )


def conflict_rows(claims: DataFrame, entity: str = "entity_id") -> DataFrame:
    """(entity, field_name, value_key, source_url): claims of fields with more than one value key, a row each."""
    rows = claims.filter(~is_blank("value")).select(entity, "field_name", value_key("value").alias("value_key"), "source_url")
    several = rows.groupBy(entity, "field_name").agg(F.min("value_key").alias("lo"), F.max("value_key").alias("hi")).filter("lo <> hi").select(entity, "field_name")
    return rows.join(several, [entity, "field_name"])


def conflicts(claims: DataFrame, entity: str = "entity_id", most: int = 50) -> DataFrame:
    """(entity, field_name, n_values, shown): fields with more than one value key; the first ``most`` values and sources shown."""
    rows = conflict_rows(claims, entity)
    by = [entity, "field_name"]
    counts = rows.select(*by, "value_key").distinct().groupBy(*by).agg(F.count("*").alias("n_values"))
    shown = first_of(rows, by, F.struct("value_key", F.coalesce("source_url", F.lit("")).alias("url")), most)
    text = F.array_join(F.transform("items", lambda x: F.concat(x["value_key"], F.lit(" ("), x["url"], F.lit(")"))), " vs ")
    return counts.join(shown, by).select(*by, "n_values", text.alias("shown"))


def best_value(claims: DataFrame, entity: str = "entity_id", tiers: Sequence[str] = vocab.TIERS) -> DataFrame:
    """(entity, field_name, value, source_tier): by tier, then the newest, then the lowest id."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, tiers)), F.col("source_tier")), F.lit(0)), F.lit(len(tiers) + 1))
    rows = claims.filter(~is_blank("value")).withColumn("_r", rank)
    # an aggregate, not a window: it is combined before the shuffle, so a famous entity costs no more
    best = rows.groupBy(entity, "field_name").agg(F.min(F.struct("_r", (-F.unix_micros(F.col("fetched_at").cast("timestamp"))).alias("_t"), "id", "value", "source_tier")).alias("b"))
    return best.select(entity, "field_name", "b.value", "b.source_tier")


def promote_official(makers: DataFrame, links: DataFrame, placeholder: str = r"(?i)/(parking|lander|coming-?soon)") -> tuple[DataFrame, DataFrame]:
    """(id, official_website) and the claims for it, of makers without a site and with one official domain."""
    good = links.filter((F.col("link_type") == "manufacturer_official") & F.col("status").isin("live", "redirected", "blocked") & F.col("maker_id").isNotNull())
    good = good.filter(~F.coalesce("final_url", "url").rlike(placeholder)).withColumn("_d", F.when(F.coalesce("domain", F.lit("")) != "", F.col("domain")).otherwise(domain_of("url")))
    one = good.groupBy("maker_id").agg(F.min("_d").alias("lo"), F.max("_d").alias("hi"), F.min("url").alias("found_at")).filter("lo = hi and lo <> ''")
    rows = makers.filter(is_blank("official_website")).select("id").join(one, F.col("id") == F.col("maker_id"))
    site = F.concat(F.lit("https://"), F.col("lo"), F.lit("/"))
    return rows.select("id", site.alias("official_website")), rows.select(F.col("id").alias("entity_id"), F.lit("official_website").alias("field_name"), site.alias("value"), F.col("found_at").alias("source_url"), F.lit("other").alias("source_tier"))


def official_candidates(makers: DataFrame, links: DataFrame) -> DataFrame:
    """(maker_id, url, n, state): official links by maker, and whether the maker has a site."""
    rows = links.filter("link_type = 'manufacturer_official' and maker_id is not null").groupBy("maker_id", "url").agg(F.count("*").alias("n"))
    have = makers.select(F.col("id").alias("maker_id"), F.when(is_blank("official_website"), "empty").otherwise("have").alias("state"))
    return rows.join(have, "maker_id")


def apply_long_names(makers: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(makers, history rows, outcome) of curated renames (id, short, long) where the name is the long form."""
    rows = makers.join(pairs, "id", "left")
    swap = F.coalesce(F.col("canonical_name") == F.col("long"), F.lit(False))
    outcome = rows.filter("short is not null").select("id", F.when(swap, "done").otherwise("skipped").alias("outcome"))
    history = rows.filter(swap).select(F.col("id").alias("maker_id"), F.col("long").alias("name"))
    return rows.withColumn("canonical_name", F.when(swap, F.col("short")).otherwise(F.col("canonical_name"))).drop("short", "long"), history, outcome


def mark_stubs(makers: DataFrame, claims: DataFrame) -> DataFrame:
    """Makers without country, history and claims become unresearched."""
    claimed = claims.select(F.col("entity_id").alias("id")).distinct().withColumn("_has", F.lit(True))
    rows = makers.join(claimed, "id", "left")
    stub = is_blank("country") & is_blank("short_history") & F.col("_has").isNull()
    return rows.withColumn("confidence", F.when(stub, "unresearched").otherwise(F.col("confidence"))).drop("_has")


def tag_scope(makers: DataFrame, rules: DataFrame) -> DataFrame:
    """Makers with scope and scope_note by curated ``rules`` (pattern, kind name|prefix, note)."""
    exact = first_by(rules.filter("kind = 'name'").select(F.col("pattern").alias("canonical_name"), F.col("note").alias("_n1")), ["canonical_name"], F.col("_n1"))
    prefix = rules.filter("kind = 'prefix'").select("pattern", F.col("note").alias("_n2"))
    # curated prefixes meet the names' own prefixes of the same lengths
    lengths = prefix.select(F.length("pattern").alias("n")).distinct()
    heads = makers.select("id", "canonical_name").join(F.broadcast(lengths), F.length("canonical_name") >= F.col("n")).select("id", F.expr("substring(canonical_name, 1, n)").alias("pattern"))
    hit = heads.join(prefix, "pattern").groupBy("id").agg(F.min("_n2").alias("_n2"))
    rows = makers.join(exact, "canonical_name", "left").join(hit, "id", "left")
    note = F.coalesce("_n1", "_n2")
    return rows.withColumn("scope", F.when(note.isNotNull(), "out_of_scope").otherwise(F.col("scope"))).withColumn("scope_note", F.coalesce(note, "scope_note")).drop("_n1", "_n2")




#: A rule is a name and a function from (makers, products, specs, gazetteer) to facts:
#: entity_id, field, value, source_url, tier, derived_from.
def _country_from_city(t: dict[str, DataFrame]) -> DataFrame:
    found = derive_country(t["makers"], t["gazetteer"]).filter("status = 'derived'")
    return found.select(F.col("id").alias("entity_id"), F.lit("country").alias("field"), F.col("country").alias("value"), F.lit(None).cast("string").alias("source_url"), F.lit("other").alias("tier"), F.lit("country_from_city").alias("derived_from"))


RULES = {
    "country_from_city": ("makers", "country", _country_from_city),
    "technology_from_oscillators": ("products", "technology", lambda t: derive_technology(t["specs"], t["products"])),
}


def run_rules(tables: dict[str, DataFrame], claims: DataFrame, names: Sequence[str] = tuple(RULES)) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rule registry: (``tables`` filled by the named rules, provenance rows to add).

    Each rule reads the tables as they came, so the order of rules doesn't matter.
    """
    filled, added = dict(tables), None
    for name in names:
        table, field, rule = RULES[name]
        filled[table], rows = apply_facts(filled[table], rule(tables), claims, [field])
        added = rows if added is None else added.unionByName(rows)
    return filled, added

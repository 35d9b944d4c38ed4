"""Aggregations, rankings and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import domain_of, host_suffixes, is_blank
from ..functions.vocab import AUDIO_FILE, DOC_FILE
from .ranks import Sort, down, first_of, ranked, up, up_nulls_last


def counted_ids(df: DataFrame, by: list[str], of: Column, numbers: dict[str, Column], sums: dict[str, Column] | None = None) -> DataFrame:
    """``by``, for each name in ``numbers`` how many different ids (integers) meet its condition, and plain sums.

    Ids become bits, 32,768 to a bitmap; bitmaps combine before the shuffle, so a key
    sends what it has of different ids, not its rows.  Null is no id.
    """
    sums = sums or {}
    rows = df.select(*by, of.cast("long").alias("_id"), *[c.alias(f"_n{i}") for i, c in enumerate(numbers.values())], *[c.cast("long").alias(f"_s{i}") for i, c in enumerate(sums.values())])
    rows = rows.withColumn("_bucket", F.bitmap_bucket_number("_id")).withColumn("_bit", F.bitmap_bit_position("_id"))
    maps = rows.groupBy(*by, "_bucket").agg(
        *[F.bitmap_count(F.bitmap_construct_agg(F.when(F.col(f"_n{i}"), F.col("_bit")))).alias(f"_n{i}") for i in range(len(numbers))],
        *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return maps.groupBy(*by).agg(*[total(f"_s{i}").alias(n) for i, n in enumerate(sums)], *[total(f"_n{i}").alias(n) for i, n in enumerate(numbers)])


def domain_graph(links: DataFrame) -> DataFrame:
    """A1: (domain, links, spread): links and distinct owners of each domain."""
    owner = F.coalesce("product_id", -F.col("maker_id"))
    rows = links.filter(F.coalesce("domain", F.lit("")) != "")
    return counted_ids(rows, ["domain"], owner, {"spread": F.lit(True)}, {"links": F.lit(1)})


def last_harvest(domains: DataFrame, products: DataFrame, links: DataFrame) -> DataFrame:
    """A2: (domain, harvested_at) of domains with a harvester: latest product, else latest link."""
    made = products.filter(~is_blank("source_url")).select("created_at", F.explode(host_suffixes(domain_of("source_url"))).alias("domain")).groupBy("domain").agg(F.max("created_at").alias("_p"))
    found = links.groupBy("domain").agg(F.max("created_at").alias("_l"))
    rows = domains.filter(~is_blank("harvester")).select("domain").join(made, "domain", "left").join(found, "domain", "left")
    return rows.select("domain", F.coalesce("_p", "_l").alias("harvested_at"))


def confidence_counts(makers: DataFrame) -> DataFrame:
    """A3: one row of tiles: companies by confidence in scope, out of scope, individuals."""
    company, out = F.col("entity_type") == "company", F.coalesce(F.col("scope") == "out_of_scope", F.lit(False))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return makers.agg(*[n(company & ~out & (F.col("confidence") == k)).alias(k) for k in ("confirmed", "needs_review", "unresearched")], n(company & out).alias("out_of_scope"), n(F.col("entity_type") == "individual").alias("individuals"))


def logo_order() -> list[Sort]:
    """A4: approved, other, outdated; open end first; null start last, newest start, highest id."""
    review = F.when(F.col("review_status") == "approved", 0).when(F.col("review_status") == "outdated", 2).otherwise(1)
    return [up(review), up(F.col("end_year").isNotNull()), down("start_year"), down("id")]


def rank_logos(logos: DataFrame) -> DataFrame:
    """A4: logos with their rank within a maker."""
    return ranked(logos, "maker_id", logo_order())


def logo_state(makers: DataFrame, logos: DataFrame) -> DataFrame:
    """A4: (id, state): found, not_found (tried without a file) or not_attempted."""
    own = logos.groupBy("maker_id").agg(F.max("has_file").alias("_file"))
    rows = makers.join(own, F.col("id") == F.col("maker_id"), "left")
    return rows.select("id", F.when(F.col("_file"), "found").when(F.col("maker_id").isNotNull(), "not_found").otherwise("not_attempted").alias("state"))


def logo_counts(logos: DataFrame) -> DataFrame:
    return logos.groupBy(F.coalesce("review_status", F.lit("open")).alias("review_status")).agg(F.count("*").alias("n"))


def coverage(products: DataFrame, links: DataFrame, membership: DataFrame) -> DataFrame:
    """A5: one row: products, categorised, with a document, with audio; links to files and to audio."""
    audio, doc = F.col("url").rlike(AUDIO_FILE), F.col("url").rlike(DOC_FILE)
    of_products = products.agg(F.count("*").alias("products"))
    categorised = counted_ids(membership, [], F.col("product_id"), {"categorised": F.lit(True)})
    sums = {"file_links": (doc | audio).cast("long"), "audio_links": audio.cast("long")}
    of_links = counted_ids(links, [], F.col("product_id"), {"with_document": doc, "with_audio": audio}, sums)
    return of_products.join(F.broadcast(categorised)).join(F.broadcast(of_links))


def forecast(queue: DataFrame, makers: DataFrame, links: DataFrame, domains: DataFrame) -> DataFrame:
    """One row: found queue rows in scope, unattached manual links, product pages pending and done."""
    out = makers.filter("scope = 'out_of_scope'").select(F.lower("canonical_name").alias("_l")).distinct()
    waiting = queue.filter("status = 'found'").withColumn("_l", F.lower("name")).join(out, "_l", "left_anti").agg(F.count("*").alias("queued"))
    manuals = links.filter("product_id is null and link_type in ('service_mod', 'archive')").agg(F.count("*").alias("unattached"))
    done = ~is_blank("harvested_at")
    pages = domains.agg(F.coalesce(F.sum(F.when(~done, F.col("product_urls"))), F.lit(0)).alias("pending"), F.coalesce(F.sum(F.when(done, F.col("product_urls"))), F.lit(0)).alias("done"))
    return waiting.join(F.broadcast(manuals)).join(F.broadcast(pages))


def work_lists(domains: DataFrame, top: int = 10) -> DataFrame:
    """(list, domain, product_urls, inbound_spread): harvestable by yield, others by spread, and blocked ones: top-k reports."""
    free = domains.filter((F.col("verdict") == "harvestable") & is_blank("harvester"))
    cut = lambda name, df: df.select(F.lit(name).alias("list"), "domain", "product_urls", "inbound_spread")
    a = free.filter("product_urls > 0").orderBy(F.desc("product_urls"), "domain").limit(top)
    b = free.filter("coalesce(product_urls, 0) = 0").orderBy(F.desc("inbound_spread"), F.desc("sitemap_urls"), "domain").limit(top)
    c = domains.filter("verdict like 'blocked%'").orderBy(F.desc("inbound_spread"), "domain")
    return cut("by yield", a).union(cut("by spread", b)).union(cut("blocked", c))


def next_to_probe(domains: DataFrame, n: int) -> DataFrame:
    """Untested domains by spread: a top-k report."""
    return domains.filter("verdict is null or verdict = 'untested'").orderBy(F.desc("inbound_spread"), "domain").limit(n).select("domain", "inbound_spread")


def verdict_counts(domains: DataFrame) -> DataFrame:
    return domains.groupBy("verdict").agg(F.count("*").alias("n"))


def spec_summary(specs: DataFrame, most: int = 50) -> DataFrame:
    """(product_id, n, summary): how many specs, and the first ``most`` "label: value" pairs in order, joined by " | "."""
    pair = F.concat(F.coalesce("label", F.lit("")), F.lit(": "), F.coalesce("value", F.lit("")))
    return first_of(specs, ["product_id"], pair, most, distinct=False).select("product_id", "n", F.array_join("items", " | ").alias("summary"))


def maker_links(links: DataFrame, products: DataFrame) -> DataFrame:
    """A10: (id, maker_id, product_id, url, link_type, position): a maker's own links, then its products'."""
    own = products.select(F.col("id").alias("_p"), F.col("maker_id").alias("_m"))
    rows = links.join(own, F.col("product_id") == F.col("_p"), "left").withColumn("maker_id", F.coalesce("maker_id", "_m")).filter("maker_id is not null")
    state = F.when(F.col("status") == "live", 0).when(F.col("status") == "redirected", 1).when(F.col("status") == "unchecked", 2).when(F.col("status") == "blocked", 3).otherwise(4)
    rows = rows.select("id", "maker_id", "product_id", "url", "link_type", state.alias("_state"))
    order = [up(F.col("product_id").isNotNull()), up("_state"), up_nulls_last("link_type"), up("url"), up("product_id"), up("id")]
    return ranked(rows, "maker_id", order, "position").drop("_state")


def az_index(makers: DataFrame) -> DataFrame:
    """(letter, n, canonical_name) in order: makers by first letter, "#" for others, and how many a letter has."""
    first = F.upper(F.substring(F.trim("canonical_name"), 1, 1))
    letter = F.when(first.rlike("^[A-Z]$"), first).otherwise("#")
    rows = makers.filter(~is_blank("canonical_name")).select(letter.alias("letter"), "canonical_name")
    counts = rows.groupBy("letter").agg(F.count("*").alias("n"))  # 27 rows
    return rows.join(F.broadcast(counts), "letter").select("letter", "n", "canonical_name").orderBy("letter", "canonical_name")


def review_list(products: DataFrame, makers: DataFrame) -> DataFrame:
    """Products under review or answered by the owner, with their maker, in order."""
    rows = products.filter("review_status in ('needs_review', 'owner_answered')").join(makers.select(F.col("id").alias("maker_id"), F.col("canonical_name").alias("maker")), "maker_id")
    return rows.select("id", "maker", "name", "review_status").orderBy("maker", "name", "id")


def toggled(actions: DataFrame, makers: DataFrame) -> DataFrame:
    """(id, confidence, n): each approval toggles confirmed and needs_review; unresearched makers refuse."""
    counts = actions.filter("action = 'approve'").groupBy(F.col("maker_id").alias("id")).agg(F.count("*").alias("n"))
    rows = makers.join(counts, "id")
    other = F.when(F.col("confidence") == "confirmed", "needs_review").otherwise("confirmed")
    odd = (F.col("n") % 2 == 1) & (F.col("confidence") != "unresearched")
    return rows.select("id", F.when(odd, other).otherwise(F.col("confidence")).alias("confidence"), "n")


def toggle_log(actions: DataFrame, makers: DataFrame) -> DataFrame:
    """The log row of every approval: previous and new confidence, by the parity of its number."""
    rows = ranked(actions.filter("action = 'approve'"), "maker_id", [up("created_at"), up("id")], "_n").join(makers.select(F.col("id").alias("maker_id"), F.col("confidence").alias("_c")), "maker_id")
    flip = lambda even: F.when(F.col("_c") == "unresearched", F.col("_c")).when(even, F.col("_c")).when(F.col("_c") == "confirmed", "needs_review").otherwise("confirmed")
    return rows.select("id", "maker_id", "action", flip(F.col("_n") % 2 == 1).alias("previous_confidence"), flip(F.col("_n") % 2 == 0).alias("new_confidence"), "created_at")


def apply_product_actions(products: DataFrame, links: DataFrame, membership: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, links, membership) after the last action (accept, delete, note) on each product."""
    last = actions.groupBy("product_id").agg(F.max_by(F.struct("action", "note"), F.struct("created_at", "id")).alias("_a"))
    gone = last.filter("_a.action = 'delete'").select("product_id")
    rows = products.join(last, F.col("id") == F.col("product_id"), "left").filter("_a is null or _a.action <> 'delete'")
    rows = rows.withColumn("review_status", F.when(F.coalesce(F.col("_a.action") != "accept", F.lit(True)), F.col("review_status"))).withColumn("owner_note", F.when(F.col("_a.action") == "note", F.col("_a.note")).otherwise(F.col("owner_note")))
    return rows.drop("product_id", "_a"), links.join(gone, "product_id", "left_anti"), membership.join(gone, "product_id", "left_anti")


def apply_logo_actions(logos: DataFrame, actions: DataFrame) -> DataFrame:
    """Logos after the last action (approved, outdated, wrong) on each; "wrong" clears the file."""
    last = actions.groupBy("logo_id").agg(F.max_by("action", F.struct("created_at", "id")).alias("_a"))
    rows = logos.join(last, F.col("id") == F.col("logo_id"), "left")
    return rows.withColumn("review_status", F.coalesce("_a", "review_status")).withColumn("has_file", F.when(F.col("_a") == "wrong", False).otherwise(F.col("has_file"))).drop("logo_id", "_a")


def run_summary(makers: DataFrame, products: DataFrame, links: DataFrame, queue: DataFrame) -> DataFrame:
    """One row of counts."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [n(products, "products"), n(links.filter("product_id is not null"), "attached_links"), n(queue.filter("status = 'found'"), "open_queue")]
    out = n(makers, "makers")
    for p in parts:
        out = out.join(F.broadcast(p))
    return out


def queue_order(queue: DataFrame) -> DataFrame:
    """Found rows, most urgent first."""
    return queue.filter("status = 'found'").orderBy(F.col("priority").desc_nulls_last(), "name", "id").select("id", "name", "priority")


def search(makers: DataFrame, text: str) -> DataFrame:
    """Makers whose name contains a text, whatever its case."""
    return makers.filter(F.contains(F.lower("canonical_name"), F.lit(text.lower())))


def logo_work_list(makers: DataFrame, logos: DataFrame, every: bool = False) -> DataFrame:
    """Makers without a logo row, researched ones unless ``every``, by name."""
    rows = makers if every else makers.filter("confidence <> 'unresearched'")
    return rows.join(logos.select(F.col("maker_id").alias("id")).distinct(), "id", "left_anti").select("id", "canonical_name").orderBy(F.lower("canonical_name"), "id")


def verify_work_list(products: DataFrame, links: DataFrame, source: str, n: int) -> DataFrame:
    """Products without a link of a source, those under review and without a URL first: a top-k list."""
    seen = links.filter(F.col("source_name") == source).select(F.col("product_id").alias("id")).distinct()
    rows = products.join(seen, "id", "left_anti")
    return rows.orderBy(F.when(F.col("review_status") == "needs_review", 0).otherwise(1), F.when(is_blank("source_url"), 0).otherwise(1), "id").limit(n).select("id", "name")

"""Duplicates, conflicts and quality audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import product_like, title_verdict
from ..functions.extract import label_year
from ..functions.keys import domain_of, host_suffixes, is_blank, norm
from .ranks import first_of
from .reports import counted_ids
from .resolve import contained_name, relink, split_slug


def classify_queue(queue: DataFrame, makers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Q1: (id, class, maker_id): found rows as out_of_scope, stale, stub, contained or open."""
    rows = queue.filter("status = 'found'").select("id", "name", norm("name").alias("key"))
    known = dictionary.filter("by_key").select(F.col("place").alias("key"), "maker_id")
    state = makers.select(F.col("id").alias("maker_id"), "confidence", "scope")
    exact = rows.join(known, "key").join(state, "maker_id")
    kind = F.when(F.col("scope") == "out_of_scope", "out_of_scope").when(F.col("confidence") != "unresearched", "stale").otherwise("stub")
    exact = exact.select("id", kind.alias("class"), "maker_id")
    rest = rows.join(exact.select("id"), "id", "left_anti")
    within = contained_name(rest, "name", dictionary, "id").select("id", F.col("maker_id").alias("_m"))
    rest = rest.join(within, "id", "left").select("id", F.when(F.col("_m").isNotNull(), "contained").otherwise("open").alias("class"), F.col("_m").alias("maker_id"))
    return exact.unionByName(rest)


def stub_kind(relations: DataFrame, maker_types: Sequence[str], owner_types: Sequence[str]) -> DataFrame:
    """Q2: (maker_id, kind): maker if any relation on either side is of a maker type, else owner, else unknown."""
    ends = relations.select("maker_id", "relation_type").union(relations.select("related_id", "relation_type")).filter("maker_id is not null")
    rank = F.when(F.col("relation_type").isin(*maker_types), 0).when(F.col("relation_type").isin(*owner_types), 1).otherwise(2)
    best = ends.groupBy("maker_id").agg(F.min(rank).alias("r"))
    return best.select("maker_id", F.when(F.col("r") == 0, "maker").when(F.col("r") == 1, "owner").otherwise("unknown").alias("kind"))


def mark_queue(queue: DataFrame, classes: DataFrame, kinds: DataFrame, run_date: str) -> DataFrame:
    """Q3: queue after marking: status, priority and a dated note, which is added once."""
    rows = queue.join(classes.select("id", "class", "maker_id"), "id", "left").join(kinds, "maker_id", "left")
    kind = F.col("class")
    status = F.when(kind.isin("stale", "contained"), "needs_review").when(kind == "out_of_scope", "done").otherwise(F.col("status"))
    priority = F.when(kind == "out_of_scope", 0).when((kind == "stub") & (F.col("kind") == "maker"), 1).otherwise(F.col("priority"))
    note = F.concat(F.lit(f"{run_date}: "), kind)
    marked = kind.isin("stale", "contained", "out_of_scope", "stub") & ~F.contains(F.coalesce("notes", F.lit("")), kind)
    return rows.select("id", "name", status.alias("status"), F.when(F.coalesce(marked, F.lit(False)), F.concat_ws(" | ", F.nullif("notes", F.lit("")), note)).otherwise(F.col("notes")).alias("notes"), priority.cast("int").alias("priority"))


def reissue_conflicts(products: DataFrame, links: DataFrame, as_of_year: int, gap: int = 2) -> DataFrame:
    """Q4: (id, year, label_year, kind): originals recorded ``gap`` years or more after their earliest source.

    "modern_old" (a year from 2000 with a source before 1995) always has such a gap, so
    that kind never shows; it is kept as the rule states it.
    """
    years = links.filter("product_id is not null").select("product_id", label_year("label", as_of_year).alias("y")).groupBy("product_id").agg(F.min("y").alias("label_year"))
    rows = products.filter("edition = 'original' and reissue_of_id is null and year is not null").join(years, F.col("id") == F.col("product_id"))
    kind = F.when(F.col("year") - F.col("label_year") >= gap, "conflict").when((F.col("year") >= 2000) & (F.col("label_year") < 1995), "modern_old")
    return rows.select("id", "year", "label_year", kind.alias("kind")).filter("kind is not null")


def cross_maker_rows(products: DataFrame, shortest: int = 3) -> DataFrame:
    """Q5: (model_key, maker_id, name): products whose key several makers use, a row each."""
    rows = products.select(norm("name").alias("model_key"), "maker_id", "name").filter(F.length("model_key") >= shortest)
    several = rows.groupBy("model_key").agg(F.min("maker_id").alias("lo"), F.max("maker_id").alias("hi")).filter("lo <> hi").select("model_key")
    return rows.join(several, "model_key")


def cross_maker_names(products: DataFrame, shortest: int = 3, most: int = 50) -> DataFrame:
    """Q5: (model_key, n_makers, n, shown): keys that several makers use; the first ``most`` makers and names shown."""
    held = cross_maker_rows(products, shortest)
    counts = counted_ids(held, ["model_key"], F.col("maker_id"), {"n_makers": F.lit(True)}, {"n": F.lit(1)})
    shown = first_of(held.filter("maker_id is not null"), ["model_key"], F.struct("maker_id", "name"), most)
    shown = shown.select("model_key", F.array_join(F.transform("items", lambda x: F.concat(x["maker_id"].cast("string"), F.lit(":"), x["name"])), ", ").alias("shown"))
    return counts.join(shown, "model_key").select("model_key", "n_makers", "n", "shown")


def split_editions(products: DataFrame, decisions: DataFrame, links: DataFrame, domain: str) -> tuple[DataFrame, DataFrame]:
    """Q6: (products, links): ``decisions`` (id, new_id) become reissues of new originals; links of ``domain`` move."""
    rows = products.join(decisions, "id", "left")
    split = F.col("new_id").isNotNull()
    fresh = rows.filter(split).select(*[F.col("new_id").alias("id") if c == "id" else F.lit(None).cast(products.schema[c].dataType).alias(c) if c in ("year", "reissue_of_id") else F.lit("original").alias(c) if c == "edition" else F.lit("needs_review").alias(c) if c == "review_status" else F.col(c) for c in products.columns])
    changed = rows.select(*[F.when(split, "reissue").otherwise(F.col(c)).alias(c) if c == "edition" else F.coalesce("new_id", c).alias(c) if c == "reissue_of_id" else F.col(c) for c in products.columns])
    moved = links.join(decisions.withColumnRenamed("id", "_p"), F.col("product_id") == F.col("_p"), "left")
    target = F.when((F.col("domain") == domain) & F.col("new_id").isNotNull(), F.col("new_id")).otherwise(F.col("product_id"))
    return changed.unionByName(fresh), moved.select(*[target.alias(c) if c == "product_id" else F.col(c) for c in links.columns])


def freshness_audit(domains: DataFrame, products: DataFrame, links: DataFrame, queue: DataFrame, makers: DataFrame, backlog: DataFrame, reference: Sequence[str] = ("wikipedia.org", "wikidata.org"), many: int = 20) -> DataFrame:
    """Q7: (severity, rule, subject, n): six checks of what is recorded about sources.

    A URL belongs to a domain by its host or a parent of it, which is an equi-join.
    """
    hosts = products.filter(~is_blank("source_url")).select(domain_of("source_url").alias("host")).groupBy("host").agg(F.count("*").alias("n"))
    by_domain = hosts.select("n", F.explode(host_suffixes("host")).alias("domain")).groupBy("domain").agg(F.sum("n").alias("products"))
    linked = links.groupBy("domain").agg(F.count("*").alias("links"))
    d = domains.join(by_domain, "domain", "left").join(linked, "domain", "left").na.fill(0, ["products", "links"])
    none = lambda c: is_blank(c)
    row = lambda df, severity, rule, subject, n: df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), n.cast("long").alias("n"))
    a = row(d.filter(none("harvester") & ((F.col("products") > 0) | (F.col("links") >= many))), "error", "harvested without harvester", F.col("domain"), F.col("products"))
    b = row(d.filter(~none("harvester") & none("harvested_at")), "error", "harvester without time", F.col("domain"), F.lit(0))
    c = row(backlog.filter((F.col("status") == "pending") & F.startswith("prerequisite", F.lit("KESZ"))), "warning", "job can run", F.col("job_name"), F.lit(0))
    own = domains.select("domain").distinct()
    registered = hosts.select("host", F.explode(host_suffixes("host")).alias("domain")).join(own, "domain", "left_semi").select("host").distinct()
    known = F.lit(False)
    for r in reference:
        known |= (F.col("host") == r) | F.endswith("host", F.lit("." + r))
    e = row(hosts.filter((F.col("n") >= many) & (F.col("host") != "") & ~known).join(registered, "host", "left_anti"), "warning", "unregistered host", F.col("host"), F.col("n"))
    researched = makers.filter("confidence <> 'unresearched'").select(F.lower("canonical_name").alias("_l")).distinct()
    f = row(queue.filter("status = 'found'").withColumn("_l", F.lower("name")).join(researched, "_l", "left_semi"), "warning", "queued but researched", F.col("name"), F.lit(1))
    g = row(products.filter("review_status = 'needs_review'").agg(F.count("*").alias("n")).filter("n > 0"), "info", "awaiting review", F.lit("products"), F.col("n"))
    return a.unionByName(b).unionByName(c).unionByName(e).unionByName(f).unionByName(g)


def detach_dead(products: DataFrame, run_date: str, mark: str = "source detached") -> DataFrame:
    """Q8: products under review whose note says the source is dead lose it, with a note, once."""
    note = F.coalesce("review_note", F.lit(""))
    hit = (F.col("review_status") == "needs_review") & note.rlike("(?i)dead") & ~is_blank("source_url") & ~F.contains(note, F.lit(mark))
    words = F.when(F.col("name").rlike(r"[()+/,]"), F.lit(f"{run_date}: {mark}, name looks like a variant")).otherwise(F.lit(f"{run_date}: {mark}"))
    return products.withColumns({"review_note": F.when(hit, F.concat(note, F.lit(" | "), words)).otherwise(F.col("review_note")), "source_url": F.when(~F.coalesce(hit, F.lit(False)), F.col("source_url"))})


def source_shape(products: DataFrame, domains: DataFrame, fewest: int = 5, ratio: float = 0.5) -> DataFrame:
    """Q9: (domain, products, urls, shape): too_small, list or per_model."""
    rows = products.filter(~is_blank("source_url")).select("id", "source_url", F.explode(host_suffixes(domain_of("source_url"))).alias("domain"))
    rows = rows.join(domains.select("domain").distinct(), "domain")
    urls = rows.select("domain", "source_url").distinct().groupBy("domain").agg(F.count("*").alias("urls"))
    out = counted_ids(rows, ["domain"], F.col("id"), {"products": F.lit(True)}).join(urls, "domain")
    shape = F.when(F.col("urls") < fewest, "too_small").when(F.col("urls") / F.col("products") < ratio, "list").otherwise("per_model")
    return out.select("domain", "products", "urls", shape.alias("shape"))


def detector_recall(products: DataFrame, domains: DataFrame, dictionary: DataFrame, least: float = 0.80) -> DataFrame:
    """Q10: (domain, urls, found, recall, passed): how many known product URLs C4 recognises, per-model domains only; '' is all."""
    shapes = source_shape(products, domains).filter("shape = 'per_model'").select("domain")
    urls = products.filter(~is_blank("source_url")).select("source_url", F.explode(host_suffixes(domain_of("source_url"))).alias("domain")).distinct().join(shapes, "domain")
    signals = product_like(urls.select("source_url").distinct(), "source_url", dictionary, "source_url")
    rows = urls.join(signals, "source_url").withColumn("_f", F.col("signal").isNotNull().cast("int"))
    out = rows.rollup("domain").agg(F.count("*").alias("urls"), F.sum("_f").alias("found"), F.avg("_f").alias("recall"))
    return out.select(F.coalesce("domain", F.lit("")).alias("domain"), "urls", "found", "recall", (F.col("recall") >= least).alias("passed"))


def sitemap_yield(urls: DataFrame, dictionary: DataFrame, alarm: float = 0.90) -> DataFrame:
    """Q11: (domain, total, product_like, ratio, note) of sitemap ``urls`` (domain, url)."""
    signals = product_like(urls.select("url").distinct(), "url", dictionary, "url")
    rows = urls.join(signals, "url").groupBy("domain").agg(F.count("*").alias("total"), F.count("signal").alias("product_like"))
    ratio = F.col("product_like") / F.col("total")
    return rows.withColumn("ratio", ratio).withColumn("note", F.when(F.col("product_like") == 0, "none").when(ratio > alarm, "suspicious").otherwise(""))


def audit_sample(df: DataFrame, n: int, seed: int, url: str = "url", domain: str = "domain") -> DataFrame:
    """Q12: ``n`` rows of each domain, chosen by the MD5 of URL and seed: a sampling operator."""
    w = Window.partitionBy(domain).orderBy(F.md5(F.concat(F.col(url), F.lit(str(seed))).cast("binary")), url)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def year_gap(posts: DataFrame) -> DataFrame:
    """Q13: (gap, n, share): earliest source year less recorded year, per product; gap null: no recorded year."""
    rows = posts.filter("ad_year is not null").groupBy("product_id").agg(F.min("ad_year").alias("a"), F.min("year").alias("y"))
    counts = rows.groupBy((F.col("a") - F.col("y")).alias("gap")).agg(F.count("*").alias("n"))
    total = counts.filter("gap is not null").agg(F.sum("n").alias("t"), F.sum(F.when(F.col("gap").between(0, 1), F.col("n")).otherwise(0)).alias("c"))
    return counts.join(F.broadcast(total)).select("gap", "n", F.when(F.col("gap").isNotNull(), F.col("n") / F.col("t")).alias("share"))


def drop_chrome(df: DataFrame, slug: str = "slug", page: str = "page", min_pages: int = 6) -> DataFrame:
    """Q14: rows whose slug isn't linked from ``min_pages`` pages or more, which is a site's frame, not a model."""
    frame = df.groupBy(slug).agg(F.countDistinct(page).alias("n")).filter(F.col("n") >= min_pages).select(slug)
    return df.join(frame, slug, "left_anti")


def reread_links(links: DataFrame, products: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Q15: (id, outcome, maker_id, model): stored ``links`` (id, slug, label, title) as already, new, not-instrument, undecided or no maker."""
    split = split_slug(links, "slug", dictionary, "id")
    held = products.select("maker_id", norm("name").alias("_k")).filter("_k <> ''").distinct().withColumn("_held", F.lit(True))
    rows = links.join(split, "id").withColumn("_k", norm("model")).join(held, ["maker_id", "_k"], "left")
    verdict = title_verdict("model", "label", "title", decode=False)
    outcome = F.when(F.col("status") != "matched", "no maker").when(F.col("_held"), "already").when(verdict == "instrument", "new").otherwise(verdict)
    return rows.select("id", outcome.alias("outcome"), "maker_id", "model")


def orphans(links: DataFrame, products: DataFrame, top: int = 20) -> DataFrame:
    """Q16: (maker_id, n): makers with the most links that no product takes: a top-k report."""
    rows = relink(links, products).filter("product_id is null")
    return rows.groupBy("maker_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "maker_id").limit(top)


def resolve_reviews(products: DataFrame, hits: DataFrame, run_date: str) -> DataFrame:
    """Q17: products with graded ``hits`` (product_id, grade): a full match clears the review, a base match only notes."""
    best = hits.groupBy("product_id").agg(F.min(F.when(F.col("grade") == "full", 0).when(F.col("grade") == "base", 1)).alias("_g"))
    rows = products.join(best, F.col("id") == F.col("product_id"), "left").drop("product_id")
    words = F.when(F.col("_g") == 0, F.lit(f"{run_date}: found by name")).when(F.col("_g") == 1, F.lit(f"{run_date}: found by base name"))
    new = (F.col("review_status") == "needs_review") & words.isNotNull() & ~F.contains(F.coalesce("review_note", F.lit("")), F.lit("found by"))
    cleared = (F.col("review_status") == "needs_review") & (F.col("_g") == 0)
    return rows.withColumn("review_note", F.when(new, F.concat_ws(" | ", F.nullif("review_note", F.lit("")), words)).otherwise(F.col("review_note"))).withColumn("review_status", F.when(~F.coalesce(cleared, F.lit(False)), F.col("review_status"))).drop("_g")

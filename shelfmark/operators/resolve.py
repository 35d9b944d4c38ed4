"""Entity resolution: names, titles, slugs, pages, links and posts to makers and products.

Names meet by equi-joins on keys, token prefixes or n-grams, never by a scan of all
pairs; an empty key joins nothing.  Dictionaries are joined as they are, so that Spark
broadcasts small ones and shuffles large ones by their measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import base_name, domain_of, first_by, is_blank, norm, prefixes, spaced_key, title_case_slug
from ..functions.vocab import STOP_TAGS
from ..sources.store import Versions
from .ranks import first_of


def name_dictionary(makers: DataFrame, names: DataFrame, sources: Sequence[str] = ("canonical", "long", "history"), extra: DataFrame | None = None) -> DataFrame:
    """(name, lower_name, key, place, maker_id, source, exact, by_key): one maker for each exact spelling and each key.

    On a clash canonical beats long beats history beats extra, then the lowest id.  A row
    with ``exact`` true has won its lower-case spelling, one with ``by_key`` its compact key.
    ``place`` is the key, or the spelling where the key is empty: equal spellings have equal
    places, so all that a name can meet is met in one join, and rows are dealt by it once.
    """
    parts = {
        "canonical": makers.select(F.col("id").alias("maker_id"), F.col("canonical_name").alias("name"), F.lit(0).alias("rank")),
        "long": makers.select(F.col("id").alias("maker_id"), F.col("long_name").alias("name"), F.lit(1).alias("rank")) if "long_name" in makers.columns else None,
        "history": names.select("maker_id", "name", F.lit(2).alias("rank")),
        "extra": extra.select("maker_id", "name", F.lit(3).alias("rank")) if extra is not None else None,
    }
    rows = None
    for source in (*sources, *(("extra",) if extra is not None else ())):
        part = parts[source]
        if part is not None:
            part = part.withColumn("source", F.lit(source))
            rows = part if rows is None else rows.unionByName(part)
    rows = rows.filter(~is_blank("name")).withColumn("lower_name", F.lower(F.trim("name"))).withColumn("key", norm("name"))
    rows = rows.withColumn("place", name_place("name"))
    order = [F.col("rank"), F.col("maker_id"), F.col("name")]
    exact = F.row_number().over(Window.partitionBy("place", "lower_name").orderBy(*order)) == 1
    by_key = (F.col("key") != "") & (F.row_number().over(Window.partitionBy("place").orderBy(*order)) == 1)
    rows = rows.repartition("place").withColumn("exact", exact).withColumn("by_key", by_key).filter("exact or by_key")
    return rows.select("name", "lower_name", "key", "place", "maker_id", "source", "exact", "by_key")


def name_place(c: Column | str) -> Column:
    """Where a name stands in a dictionary: its compact key, or its lower-case spelling if that is empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(norm(c), F.lit("")), F.lower(F.trim(c)))


def store_dictionary(dictionary: DataFrame, path: str, buckets: int = 8) -> DataFrame:
    """Write another version of a dictionary, bucketed by place, and read it.

    Joins and groupings by place then need no exchange on its side, and no window runs
    again.  ``Versions(path, "place", buckets).read(spark)`` opens it in another session.
    """
    store = Versions(path, "place", buckets)
    return store.read(dictionary.sparkSession, store.write(dictionary))


def _lookup(dictionary: DataFrame) -> DataFrame:
    """(_place, _keyed, _spelled): a place's maker by key, and its makers by spelling.

    The spellings of a place differ in punctuation and blanks only.
    """
    spelled = F.map_from_entries(F.collect_list(F.when(F.col("exact"), F.struct("lower_name", "maker_id"))))
    return dictionary.groupBy(F.col("place").alias("_place")).agg(F.max(F.when(F.col("by_key"), F.col("maker_id"))).alias("_keyed"), spelled.alias("_spelled"))


def _exact(dictionary: DataFrame, out: str) -> DataFrame:
    return dictionary.filter("exact").select(F.col("lower_name").alias("_lower"), F.col("maker_id").alias(out))


def _keyed(dictionary: DataFrame, out: str) -> DataFrame:
    return dictionary.filter("by_key").select(F.col("place").alias("_key"), F.col("maker_id").alias(out))  # there the place is the key


def resolve_maker(df: DataFrame, name: str, dictionary: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """R2: ``df`` with maker_id and match_kind (exact, key or null), after an alias table (alias, name)."""
    asked = F.col(name)
    if aliases is not None:
        known = first_by(aliases.select(F.lower(F.trim("alias")).alias("_alias"), F.col("name").alias("_real")), ["_alias"], F.col("_real"))
        df = df.withColumn("_alias", F.lower(F.trim(asked))).join(known, "_alias", "left")
        asked = F.coalesce(F.col("_real"), asked)
    df = df.withColumn("_lower", F.lower(F.trim(asked))).withColumn("_place", name_place(asked))
    df = df.join(_lookup(dictionary), "_place", "left").withColumn("_exact", F.col("_spelled")[F.col("_lower")])
    kind = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_keyed").isNotNull(), "key")
    return df.withColumn("maker_id", F.coalesce("_exact", "_keyed")).withColumn("match_kind", kind).drop("_alias", "_real", "_lower", "_place", "_exact", "_keyed", "_spelled")


def find_maker(df: DataFrame, name: str, makers: DataFrame, names: DataFrame) -> DataFrame:
    """``df`` with maker_id by lower-case name, canonical first, then history."""
    return resolve_maker(df, name, name_dictionary(makers, names, ("canonical", "history")).withColumn("by_key", F.lit(False))).drop("match_kind")


def resolve_unique_prefix(df: DataFrame, name: str, dictionary: DataFrame, shortest: int = 4) -> DataFrame:
    """R2, else the maker of the one known key that begins with the name's, if there is exactly one."""
    found = resolve_maker(df, name, dictionary).withColumn("_key", norm(name))
    keys = dictionary.filter("by_key").select("key", "maker_id").groupBy("key").agg(F.min("maker_id").alias("_m"))
    heads = keys.select(F.explode(prefixes("key", shortest)).alias("_key"), "_m")
    asked = found.filter(F.col("maker_id").isNull() & (F.length("_key") >= shortest)).select("_key").distinct()
    only = heads.join(asked, "_key").groupBy("_key").agg(F.min("_m").alias("_m"), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    out = found.join(only, "_key", "left")
    kind = F.coalesce("match_kind", F.when(F.col("maker_id").isNull() & F.col("_m").isNotNull(), F.lit("prefix")))
    return out.withColumn("match_kind", kind).withColumn("maker_id", F.coalesce("maker_id", "_m")).drop("_key", "_m")


def _heads(words: Column, most: Column | int) -> Column:
    n = F.least(F.size(words), F.lit(most))
    return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(i.alias("n"), F.array_join(F.slice(words, F.lit(1), i), " ").alias("head")))


def _word_counts(df: DataFrame, words: Column) -> DataFrame:
    """One row with _counts: the distinct word counts that occur, in order."""
    return df.agg(F.sort_array(F.collect_set(F.size(words))).alias("_counts"))


def _heads_of(words: Column, counts: Column) -> Column:
    """Heads of as many words as ``counts`` says, where there are so many."""
    return F.transform(F.filter(counts, lambda c: c <= F.size(words)), lambda i: F.struct(i.alias("n"), F.array_join(F.slice(words, F.lit(1), i), " ").alias("head")))


def match_title(df: DataFrame, title: str, dictionary: DataFrame, key: str) -> DataFrame:
    """(key, maker_id, n_words) by the longest known name that a title begins with."""
    counts = _word_counts(dictionary.filter("exact"), F.split("lower_name", " +"))
    rows = df.select(key, F.split(F.lower(F.trim(F.col(title))), " +").alias("_words")).crossJoin(F.broadcast(counts))
    heads = rows.select(key, F.explode(_heads_of(F.col("_words"), F.col("_counts"))).alias("h")).select(key, "h.n", F.col("h.head").alias("_lower"))
    return heads.join(_exact(dictionary, "maker_id"), "_lower").groupBy(key).agg(F.max_by("maker_id", "n").alias("maker_id"), F.max("n").alias("n_words"))


def split_slug(df: DataFrame, slug: str, dictionary: DataFrame, key: str, most: int = 4, separator: str = "-") -> DataFrame:
    """(key, maker_id, model, status): longest head of a slug that is a maker; else a reject row."""
    words = F.split(F.lower(F.col(slug)), separator)
    heads = df.select(key, words.alias("_words"), F.explode(_heads(words, most)).alias("h"))
    heads = heads.select(key, "_words", F.col("h.n").alias("n"), norm("h.head").alias("_key"))
    hits = heads.filter("_key <> ''").join(_keyed(dictionary, "maker_id"), "_key")
    best = hits.groupBy(key).agg(F.max_by(F.struct("maker_id", "n", "_words"), "n").alias("b"))
    best = best.select(key, F.col("b.maker_id").alias("maker_id"), F.array_join(F.slice("b._words", F.col("b.n") + 1, F.size("b._words")), " ").alias("model"))
    out = df.select(key, slug).join(best, key, "left")
    return out.select(key, "maker_id", F.when(F.col("maker_id").isNotNull(), F.col("model")).otherwise(F.col(slug)).alias("model"), F.when(F.col("maker_id").isNotNull(), "matched").otherwise("no maker").alias("status"))


def contained_name(df: DataFrame, name: str, dictionary: DataFrame, key: str) -> DataFrame:
    """(key, maker_id, contained): longest known name within a name as whole words; no exact hits."""
    known = dictionary.select("place", spaced_key("name").alias("_gram"), "maker_id").filter("_gram <> ''").groupBy("place", "_gram").agg(F.min("maker_id").alias("maker_id"))
    counts = _word_counts(known, F.split("_gram", " "))
    # a gram's place is its letters and digits, so names meet by place, as the dictionary is dealt
    known = known.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("_gram", "maker_id"))).alias("_grams"))
    words = F.split("_all", " ")
    n = F.size(words)
    # only as many words as known names have
    grams = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.filter("_counts", lambda c: c <= n - i + 1), lambda k: F.array_join(F.slice(words, i, k), " "))))
    rows = df.select(key, spaced_key(name).alias("_all")).crossJoin(F.broadcast(counts))
    rows = rows.select(key, "_all", F.explode(grams).alias("_gram")).filter("_gram <> _all and _gram <> ''")
    hits = rows.withColumn("place", F.replace("_gram", F.lit(" "), F.lit(""))).join(known, "place").withColumn("maker_id", F.col("_grams")[F.col("_gram")]).filter("maker_id is not null")
    return hits.groupBy(key).agg(F.max_by(F.struct("maker_id", "_gram"), F.struct(F.length("_gram"), "_gram")).alias("b")).select(key, "b.maker_id", F.col("b._gram").alias("contained"))


def name_variant_rows(df: DataFrame, name: str, dictionary: DataFrame, key: str) -> DataFrame:
    """(key, variant): known longer names that begin with a name and a space, a row each."""
    words = F.split(F.lower(F.trim("name")), " +")
    known = dictionary.select("name", F.explode(_heads(words, F.size(words))).alias("h"), F.size(words).alias("_n")).filter("h.n < _n").select(F.col("name").alias("variant"), F.col("h.head").alias("_lower"))
    return df.select(key, F.lower(F.trim(F.col(name))).alias("_lower")).join(known, "_lower").select(key, "variant")


def name_variants(df: DataFrame, name: str, dictionary: DataFrame, key: str) -> DataFrame:
    """(key, n, variants): how many known longer names begin with a name and a space, all of them in order, joined by " | "."""
    out = name_variant_rows(df, name, dictionary, key).groupBy(key).agg(F.sort_array(F.collect_set("variant")).alias("_items"))
    return out.select(key, F.size("_items").cast("long").alias("n"), F.array_join("_items", " | ").alias("variants"))


def is_known_prefix(df: DataFrame, name: str, dictionary: DataFrame, key: str, shortest: int = 3) -> DataFrame:
    """(key) of names that are known: no compact key at all, a known key, or from
    ``shortest`` characters on one that begins a known key or begins with one."""
    known = dictionary.select("key").filter("key <> ''").distinct()
    long = known.filter(F.length("key") >= shortest)
    rows = df.select(key, F.coalesce(norm(name), F.lit("")).alias("_key"))
    # each way by an equality: a name meets the beginnings of known keys, its beginnings meet known keys
    same = rows.join(known.union(long.select(F.explode(prefixes("key", shortest)))).distinct(), F.col("_key") == F.col("key"), "left_semi").select(key)
    begun = rows.select(key, F.explode(prefixes("_key", shortest)).alias("_key")).join(long, F.col("_key") == F.col("key"), "left_semi").select(key)
    return rows.filter("_key = ''").select(key).union(same).union(begun).distinct()


def source_key(url: Column | str) -> Column:
    """A source URL without its ending slash and ``/index.php``."""
    url = F.col(url) if isinstance(url, str) else url
    return F.regexp_replace(F.regexp_replace(url, r"/index\.php", ""), "/+$", "")


def product_keys(products: DataFrame) -> DataFrame:
    """(maker_id, model_key, product_id): the lowest id of each key; '' keys left out."""
    return products.select("maker_id", norm("name").alias("model_key"), "id").filter("model_key <> ''").groupBy("maker_id", "model_key").agg(F.min("id").alias("product_id"))


def match_pages(pages: DataFrame, products: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``pages`` (source_url, maker, display_name, slug) with product_id and match_kind.

    By source URL, else by maker and the key of the display name less the maker's, else
    by maker and slug title.
    """
    by_url = products.filter(~is_blank("source_url")).groupBy(source_key("source_url").alias("_url")).agg(F.min("id").alias("_p1"))
    keys = product_keys(products)
    found = resolve_maker(pages, "maker", dictionary).drop("match_kind").withColumn("_url", source_key("source_url"))
    shown = norm("display_name")
    rest = F.when(F.startswith(shown, norm("maker")) & (norm("maker") != ""), F.substr(shown, F.length(norm("maker")) + 1)).otherwise(shown)
    found = found.withColumn("_k2", rest).withColumn("_k3", norm(title_case_slug("slug")))
    found = found.join(by_url, "_url", "left")
    found = found.join(keys.select("maker_id", F.col("model_key").alias("_k2"), F.col("product_id").alias("_p2")), ["maker_id", "_k2"], "left")
    found = found.join(keys.select("maker_id", F.col("model_key").alias("_k3"), F.col("product_id").alias("_p3")), ["maker_id", "_k3"], "left")
    kind = F.when(F.col("_p1").isNotNull(), "url").when(F.col("_p2").isNotNull(), "name").when(F.col("_p3").isNotNull(), "slug")
    return found.withColumn("product_id", F.coalesce("_p1", "_p2", "_p3")).withColumn("match_kind", kind).drop("_url", "_k2", "_k3", "_p1", "_p2", "_p3")


def relink(links: DataFrame, products: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Maker-level ``links`` (id, maker_id, product_id, label, source_name) with the product they name.

    Exact model key; the key without mkI..III; the longest part of the label that is one.
    """
    rows = links.filter(F.col("maker_id").isNotNull() & F.col("product_id").isNull())
    if sources:
        rows = rows.filter(F.col("source_name").isin(*sources))
    keys = product_keys(products)
    rows = rows.select("id", "maker_id", "label").withColumn("_k1", norm("label")).withColumn("_k2", F.regexp_replace(norm("label"), "mk(iii|ii|i)$", ""))
    parts = rows.select("id", "maker_id", F.explode(F.array_distinct(F.transform(F.split("label", r"[\s/]+"), norm))).alias("model_key")).filter(F.length("model_key") > 2)
    by_part = parts.join(keys, ["maker_id", "model_key"]).groupBy("id").agg(F.max_by("product_id", F.struct(F.length("model_key"), "model_key")).alias("_p3"))
    rows = rows.join(keys.select("maker_id", F.col("model_key").alias("_k1"), F.col("product_id").alias("_p1")), ["maker_id", "_k1"], "left")
    rows = rows.join(keys.select("maker_id", F.col("model_key").alias("_k2"), F.col("product_id").alias("_p2")), ["maker_id", "_k2"], "left").join(by_part, "id", "left")
    kind = F.when(F.col("_p1").isNotNull(), "key").when(F.col("_p2").isNotNull(), "mark").when(F.col("_p3").isNotNull(), "part")
    return rows.select("id", "maker_id", F.coalesce("_p1", "_p2", "_p3").alias("product_id"), kind.alias("match_kind"))


def match_contained(links: DataFrame, products: DataFrame, shortest: int = 3) -> DataFrame:
    """(id, product_id): longest product key of the same maker within a label's key.

    Where a product key's first characters stand in the label's key, the parts of the lengths that keys
    so begun have meet product keys.
    """
    keys = product_keys(products).filter(F.length("model_key") >= shortest)
    head = F.substring("model_key", 1, shortest)
    heads = keys.groupBy("maker_id", head.alias("_head")).agg(F.collect_set(F.length("model_key")).alias("_lengths"))
    rows = links.select("id", "maker_id", norm("label").alias("_label")).filter(F.length("_label") >= shortest)
    at = F.sequence(F.lit(1), F.length("_label") - shortest + 1)
    rows = rows.select("id", "maker_id", "_label", F.explode(at).alias("_at"))
    rows = rows.withColumn("_head", F.substr("_label", F.col("_at"), F.lit(shortest))).join(heads, ["maker_id", "_head"])
    rows = rows.select("id", "maker_id", F.explode(F.transform("_lengths", lambda k: F.when(F.col("_at") + k - 1 <= F.length("_label"), F.substr("_label", F.col("_at"), k)))).alias("model_key"))
    return rows.join(keys, ["maker_id", "model_key"]).groupBy("id").agg(F.max_by("product_id", F.struct(F.length("model_key"), "model_key")).alias("product_id"))


def match_posts(posts: DataFrame, products: DataFrame, dictionary: DataFrame, stop: Sequence[str] = STOP_TAGS) -> DataFrame:
    """(post_id, maker_id, product_id, year): tagged posts of exactly one maker.

    A tag that is another tag followed only by digits makes that other one a
    cross-reference (TB-3 beside TB-303).
    """
    tags = posts.select("post_id", F.explode(F.array_distinct(F.transform("labels", lambda x: F.trim(x)))).alias("tag")).filter(~is_blank("tag"))
    tags = tags.filter(~F.lower("tag").isin(*stop))
    years = tags.filter(F.col("tag").rlike(r"^(19|20)\d\d$")).groupBy("post_id").agg(F.min(F.col("tag").cast("int")).alias("year"))
    named = resolve_maker(tags.filter(~F.col("tag").rlike(r"^(19|20)\d\d$")), "tag", dictionary)
    one = named.filter("maker_id is not null").groupBy("post_id").agg(F.min("maker_id").alias("maker_id"), F.max("maker_id").alias("_z")).filter("maker_id = _z").drop("_z")
    models = named.filter("maker_id is null").select("post_id", norm("tag").alias("model_key")).filter("model_key <> ''").distinct()
    all_keys = models.groupBy("post_id").agg(F.collect_set("model_key").alias("_all"))
    crossed = F.exists("_all", lambda k: (F.length(k) > F.length("model_key")) & F.startswith(k, F.col("model_key")) & F.substr(k, F.length("model_key") + 1).rlike("^[0-9]+$"))
    models = models.join(all_keys, "post_id").filter(~crossed).drop("_all")
    hits = models.join(one, "post_id").join(product_keys(products), ["maker_id", "model_key"])
    return hits.join(years, "post_id", "left").select("post_id", "maker_id", "product_id", "year")


def verify_hits(hits: DataFrame) -> DataFrame:
    """``hits`` (product, maker, title, summary, labels) with grade full, base or none."""
    text = F.concat(norm("title"), F.coalesce(norm("summary"), F.lit("")))
    maker = F.contains(text, norm("maker")) | F.exists(F.coalesce("labels", F.array().cast("array<string>")), lambda x: F.contains(norm(x), norm("maker")))
    full, base = norm("product"), norm(base_name("product"))
    grade = F.when(maker & (F.length(full) >= 3) & F.contains(text, full), "full").when(maker & (F.length(base) >= 3) & F.contains(text, base), "base").otherwise("none")
    return hits.withColumn("grade", F.when(norm("maker") == "", "none").otherwise(grade))


def new_names(found: DataFrame, known: DataFrame, name: str = "name", qid: str | None = None) -> DataFrame:
    """Rows of ``found`` whose key isn't known and whose external id isn't either; once each key."""
    keys = known.select(norm(name).alias("_key")).filter("_key <> ''").distinct()
    rows = found.withColumn("_key", norm(name)).filter("_key <> ''").join(keys, "_key", "left_anti")
    if qid:
        rows = rows.join(known.select(qid).filter(f"{qid} is not null").distinct(), qid, "left_anti")
    return first_by(rows, ["_key"], F.col(name)).drop("_key")


def identify(makers: DataFrame, candidates: DataFrame, reject: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """(maker_id, qid, status, reason): which external entity a maker is.

    ``makers``: maker_id, name, official_website; ``candidates``: maker_id, rank, qid,
    label, aliases, types, industry, websites.  In rank order a candidate on the maker's
    own domain is accepted; else one of no rejected type whose name matches and whose
    types or industry are wanted; else the first of the same name is the reason.
    """
    rows = candidates.join(makers, "maker_id")
    site = domain_of("official_website")
    on_site = (site != "") & F.exists(F.coalesce("websites", F.array().cast("array<string>")), lambda w: domain_of(w) == site)
    none = F.array().cast("array<string>")
    kinds = F.array_union(F.coalesce("types", none), F.coalesce("industry", none))
    named = F.exists(F.array_union(F.array("label"), F.coalesce("aliases", none)), lambda a: (norm(a) != "") & (norm(a) == norm("name")))
    bad = F.arrays_overlap(kinds, F.array(*map(F.lit, reject))) if reject else F.lit(False)
    good = F.arrays_overlap(kinds, F.array(*map(F.lit, wanted))) if wanted else F.lit(False)
    status = F.when(on_site, 0).when(~bad & named & good, 0).when(~bad & named, 1).otherwise(2)
    rows = rows.withColumn("_s", status).withColumn("_site", on_site)
    best = first_by(rows, ["maker_id"], F.col("_s"), F.col("rank"), F.col("qid"))
    out = best.select("maker_id", F.when(F.col("_s") == 0, F.col("qid")).alias("qid"), F.when(F.col("_s") == 0, "accepted").otherwise("rejected").alias("status"), F.when(F.col("_site"), "website").when(F.col("_s") == 0, "name and type").when(F.col("_s") == 1, F.concat(F.lit("name only: "), F.col("qid"))).otherwise("no match").alias("reason"))
    return makers.select("maker_id").join(out, "maker_id", "left").select("maker_id", "qid", F.coalesce("status", F.lit("rejected")).alias("status"), F.coalesce("reason", F.lit("no candidate")).alias("reason"))


def category_members(edges: DataFrame, roots: Sequence[str]) -> DataFrame:
    """(title, root): pages of the roots and of their subcategories; the first root wins."""
    root = F.array_position(F.array(*map(F.lit, roots)), F.col("category"))
    own = edges.filter(F.col("category").isin(*roots)).withColumn("_root", root)
    below = own.filter("kind = 'subcat'").select(F.col("member").alias("category"), "_root")
    pages = own.filter("kind = 'page'").select("member", "_root").union(edges.filter("kind = 'page'").join(below, "category").select("member", "_root"))
    first = pages.groupBy("member").agg(F.min("_root").alias("_root"))
    return first.select(F.col("member").alias("title"), F.element_at(F.array(*map(F.lit, roots)), F.col("_root").cast("int")).alias("root"))


def lead_gap_rows(leads: DataFrame, products: DataFrame) -> DataFrame:
    """(maker_id, model_key, name): listed models (maker_id, name) that are not held, a row each."""
    keyed = leads.withColumn("model_key", norm("name")).filter("model_key <> ''")
    missing = keyed.join(product_keys(products), ["maker_id", "model_key"], "left_anti")
    return first_by(missing, ["maker_id", "model_key"], F.col("name")).select("maker_id", "model_key", "name")


def lead_gap(leads: DataFrame, products: DataFrame, most: int = 50) -> DataFrame:
    """(maker_id, n, models): how many listed models are not held, and the first ``most`` by name, by maker."""
    out = first_of(lead_gap_rows(leads, products), ["maker_id"], F.struct("name", "model_key"), most)
    return out.select("maker_id", "n", F.array_join(F.transform("items", lambda x: x["name"]), ", ").alias("models"))


def new_products(found: DataFrame, products: DataFrame) -> DataFrame:
    """``found`` (maker_id, name, slug) not held, without a site's own "-0" duplicates."""
    rows = found.withColumn("model_key", norm("name")).filter("model_key <> '' and maker_id is not null")
    doubled = rows.select("maker_id", F.concat("slug", F.lit("-0")).alias("slug"))
    rows = rows.join(doubled, ["maker_id", "slug"], "left_anti").join(product_keys(products), ["maker_id", "model_key"], "left_anti")
    return first_by(rows, ["maker_id", "model_key"], F.col("name"), F.col("slug")).select("maker_id", "name", "slug")


def brand_from_tags(posts: DataFrame, dictionary: DataFrame, out_of_scope: Sequence[str] = (), aliases: DataFrame | None = None) -> DataFrame:
    """(post_id, maker_id, tag, model): first tag that is a held maker, by ``aliases`` (alias, name) or else itself.

    Each tag in turn is cut off the title's start; posts without a title, or whose first
    category is out of scope, are left out.
    """
    rows = posts.filter(~is_blank("title"))
    if out_of_scope:
        rows = rows.filter(~F.coalesce(F.lower(F.trim(F.get("categories", F.lit(0)))).isin(*out_of_scope), F.lit(False)))

    def cut(title: Column, tag: Column) -> Column:
        rest = F.substr(title, F.length(tag) + 1)
        return F.when(F.startswith(F.lower(title), F.lower(tag)) & rest.rlike(r"^\s"), F.regexp_replace(rest, r"^\s+", "")).otherwise(title)

    known = F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda x: x.isNotNull())
    tags = rows.select("post_id", F.aggregate(known, F.col("title"), cut).alias("model"), F.posexplode("tags").alias("pos", "tag"))
    names = F.array("tag")
    if aliases is not None:
        real = first_by(aliases.select(F.lower(F.trim("alias")).alias("_alias"), F.col("name").alias("_real")), ["_alias"], F.col("_real"))
        tags = tags.withColumn("_alias", F.lower(F.trim("tag"))).join(real, "_alias", "left")
        names = F.array("_real", "tag")
    tags = tags.select("post_id", "model", "pos", "tag", F.posexplode(names).alias("_turn", "_name"))
    hits = resolve_maker(tags, "_name", dictionary).filter("maker_id is not null")
    return hits.groupBy("post_id").agg(F.min_by(F.struct("maker_id", "tag", "model"), F.struct("pos", "_turn")).alias("b")).select("post_id", "b.*")

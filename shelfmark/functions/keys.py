"""String keys and name scalars: Column to Column, built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """Null, empty or white space only; a number counts as blank when it is 0, the text "0" doesn't."""
    text = F.trim(_c(c).cast("string"))
    zero = (F.typeof(_c(c)) != "string") & text.rlike(r"^-?0(\.0+)?$")
    return text.isNull() | (text == "") | zero


def norm(c: Column | str) -> Column:
    """N1, compact key: lower case, ASCII letters and digits only; '' for a name without any."""
    return F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]", "")


def spaced_key(c: Column | str) -> Column:
    """Lower case, runs of other characters as one space."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", " "))


def value_key(c: Column | str) -> Column:
    """Trimmed, lower case, no dots at the end, blanks collapsed."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_c(c))), r"\.+$", ""), r"\s+", " ")


def _words(c: Column, pattern: str) -> Column:
    return F.filter(F.split(F.lower(c), pattern), lambda w: w != "")


def _kept(words: Column, noise: Sequence[str]) -> Column:
    core = F.filter(words, lambda w: ~w.isin(*noise))
    return F.when(F.size(core) > 0, core).otherwise(words)


def compare_key(c: Column | str, noise: Sequence[str] = vocab.COMPARE_NOISE) -> Column:
    """Words less corporate noise; all words where nothing else is left."""
    words = _words(F.regexp_replace(_c(c), r"(?U)[^\w\s]", " "), r"(?U)\s+")
    return F.array_join(_kept(words, noise), " ")


def name_core(c: Column | str, suffixes: Sequence[str] = vocab.NAME_SUFFIXES) -> Column:
    """Compact key without corporate words at the end; the whole key where only those are."""
    alternatives = "|".join(s.replace(".", r"\.") for s in sorted(suffixes, key=len, reverse=True))
    text = F.lower(_c(c))
    core = norm(F.regexp_replace(text, rf"(^|[\s,]+)(\.*({alternatives})\.*[\s,]+)*\.*({alternatives})\.*[\s,]*$", ""))
    return F.when(core != "", core).otherwise(norm(text))


def names_match(a: Column | str, b: Column | str) -> Column:
    """Equal keys or equal cores; containment is no evidence, an empty key matches nothing."""
    ka, kb = norm(a), norm(b)
    return (ka != "") & (kb != "") & ((ka == kb) | (name_core(a) == name_core(b)))


def domain_name_key(c: Column | str, noise: Sequence[str] = vocab.DOMAIN_NOISE) -> Column:
    """First word that is no noise, with the next if it has two letters at most; null without ASCII."""
    kept = _kept(_words(_c(c), "[^a-z0-9]+"), noise)
    first = F.get(kept, F.lit(0))
    return F.when(F.length(first) <= 2, F.concat(first, F.coalesce(F.get(kept, F.lit(1)), F.lit("")))).otherwise(first)


def clean_title(c: Column | str, longest: int = 120, skip: Sequence[str] = vocab.SKIP_TITLES) -> Column:
    """A title as a plain name, or null."""
    name = F.trim(F.regexp_replace(_c(c), r"\s*\(.*?\)\s*$", ""))
    name = F.trim(F.regexp_replace(F.regexp_replace(name, r"[\p{Cc}\p{Cf}\p{Co}\p{Cn}\p{Zl}\p{Zp}]", ""), r"\s+", " "))
    bad = (name == "") | (F.length(name) > longest)
    for pattern in skip:
        bad |= name.rlike(pattern)
    return F.when(~bad, name)


def title_case_slug(c: Column | str, words: Sequence[str] = vocab.MODEL_WORDS) -> Column:
    """Model name from a URL slug; a short code keeps its hyphen before a number (ds-2: DS-2)."""
    slug = _c(c)
    parts = F.filter(F.split(slug, "[-_]+"), lambda p: p != "")
    code = lambda p: ~p.isin(*words) & (p.rlike("[0-9]") | (F.length(p) <= 3))
    cased = F.transform(parts, lambda p: F.when(code(p), F.upper(p)).otherwise(F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))))
    joined = F.array_join(cased, " ")
    joined = F.regexp_replace(joined, r"(?<![^ ])([A-Z]{1,4}) (?=[0-9])", "$1-")
    return F.when(slug.rlike("[A-Z]"), slug).otherwise(joined)


def tidy_model(c: Column | str) -> Column:
    """Slugs with digits in upper case, others as capitalised words."""
    slug = F.regexp_replace(F.url_decode(F.regexp_replace(_c(c), r"\+", "%2B")), "^/+|/+$", "")
    words = F.transform(F.split(slug, "-"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))
    return F.when(slug.rlike("[0-9]"), F.upper(slug)).otherwise(F.array_join(words, " "))


def collapse_variant(c: Column | str, colours: Sequence[str] = vocab.COLOURS) -> Column:
    """Upper case without "SET" and a colour code at the end."""
    name = F.regexp_replace(F.upper(_c(c)), "SET$", "")
    return F.when(F.length(name) > 2, F.regexp_replace(name, f"({'|'.join(colours)})$", "")).otherwise(name)


def base_name(c: Column | str) -> Column:
    """Cut at a bracket and stripped of trailing signs; '' where that changes nothing."""
    base = F.regexp_replace(F.regexp_replace(_c(c), r"[(\[].*$", ""), r"^[ \-/,+]+|[ \-/,+]+$", "")
    return F.when(base == F.trim(_c(c)), F.lit("")).otherwise(base)


def is_variant(c: Column | str) -> Column:
    return _c(c).rlike(r"[()+/,]")


def strip_maker_prefix(df: DataFrame, aliases: DataFrame, name: str = "name", out: str = "model") -> DataFrame:
    """``df`` (maker_id, name, ...) with the longest alias of its maker cut off the name.

    The whole name stays unless two characters or more are left that begin with a
    capital or a digit.  ``aliases``: maker_id, alias.  A maker has few aliases, so they
    are gathered per maker and no row is multiplied.
    """
    own = aliases.filter(~is_blank("alias")).groupBy("maker_id").agg(F.collect_set(F.lower("alias")).alias("_aliases"))
    held = df.join(own, "maker_id", "left")
    fits = F.filter("_aliases", lambda a: F.startswith(F.lower(F.col(name)), F.concat(a, F.lit(" "))))
    longest = F.array_max(F.transform(fits, lambda a: F.length(a)))
    rest = F.trim(F.substr(F.col(name), longest + 2))
    good = longest.isNotNull() & (F.length(rest) >= 2) & rest.rlike("^[A-Z0-9]")
    return held.withColumn(out, F.when(good, rest).otherwise(F.col(name))).drop("_aliases")


def split_axes(c: Column | str) -> Column:
    """N12: "Form - Function" as a struct(form, function), nulls without the dash."""
    parts = F.split(_c(c), " - ", 2)
    two = F.size(parts) == 2
    return F.struct(F.when(two, F.get(parts, F.lit(0))).alias("form"), F.when(two, F.get(parts, F.lit(1))).alias("function"))


def domain_of(c: Column | str) -> Column:
    """Host in lower case, without user, port and ``www.``; '' where there is none."""
    host = F.lower(F.regexp_extract(_c(c), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":.*$", "")
    return F.regexp_replace(host, r"^www\.", "")


def domain_label(c: Column | str, tail: Sequence[str] = vocab.DOMAIN_TAIL) -> Column:
    """Last part of a host left of public suffixes (roland.co.uk: roland)."""
    host = F.regexp_replace(_c(c), r"^\.+|\.+$", "")
    cut = F.regexp_replace(host, rf"(\.+({'|'.join(tail)}))+$", "")
    return F.substring_index(cut, ".", -1)


def host_suffixes(host: Column | str) -> Column:
    """A host and its parent domains (a.b.c: a.b.c, b.c), for equi-joins on a domain."""
    parts = F.split(_c(host), r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, n), "."))


def doc_model(folder: Column | str, file: Column | str, tokens: Sequence[str] = vocab.DOC_TOKENS) -> Column:
    """struct(model, doc_type) of a document's file name; a leading folder name is dropped."""
    stem = F.regexp_replace(_c(file), r"(?i)\.(pdf|jpg|doc|zip|gif|png)$", "")
    ending = rf"(?i)(^|_)({'|'.join(sorted(tokens, key=len, reverse=True))})$"
    kind = F.regexp_extract(F.upper(stem), ending, 2)
    stem = F.when(kind != "", F.regexp_replace(F.regexp_replace(stem, ending, ""), "[_-]+$", "")).otherwise(stem)
    head = F.substring_index(stem, "_", 1)
    repeats = (norm(head) != "") & F.startswith(norm(folder), norm(head))
    stem = F.when(repeats, F.regexp_replace(F.substr(stem, F.length(head) + 1), "^[_-]+", "")).otherwise(stem)
    return F.struct(F.trim(F.translate(stem, "_", " ")).alias("model"), F.initcap(F.translate(F.when(kind != "", kind).otherwise("DOCUMENT"), "_", " ")).alias("doc_type"))


def first_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key, the first in ``order``, ascending (nulls first) and total.

    An aggregate that combines before the shuffle, so a famous key costs a row a task.
    """
    row = F.min_by(F.struct(*df.columns), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(row.alias("_first")).select("_first.*")


def nulls_last(c: Column | str) -> tuple[Column, Column]:
    """Two columns for ``first_by`` that put nulls behind other values."""
    return _c(c).isNull(), _c(c)


def prefixes(c: Column | str, shortest: int) -> Column:
    """The beginnings of a text from ``shortest`` characters on, itself included; none of a shorter text."""
    n = F.length(_c(c))
    return F.when(n >= shortest, F.transform(F.sequence(F.lit(shortest), n), lambda k: F.substr(_c(c), F.lit(1), k))).otherwise(F.array().cast("array<string>"))

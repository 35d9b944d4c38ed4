"""N-gram Jaccard join by a token-group matrix.

Documents become sets of hashed five-word shingles.  Similar documents are put in
groups, each group keeps the union of its members' tokens, a query's overlap with a
group's union bounds its overlap with every member, first by bits of all tokens, then by
the prefixes' tokens, and only groups whose bound qualifies are opened.  What is opened is verified on whole sets, so the links are
exactly the pairs with Jaccard similarity at or above the threshold.

Only the first tokens of a set under one global order (its prefix) enter the matrix:
two sets that qualify always share a token of their prefixes, whatever the order is.
The order puts tokens that many documents hold last, so a common passage is seldom in
a prefix; which tokens count as common only affects speed, never the links.

Defined results: a null or blank text has no shingles and is linked with nothing; rows
with a null ``doc_id`` take part, and a component whose ids are all null has a null id;
rows that repeat an id or a whole row are separate rows of the result; only ``doc_id``
and ``text`` are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, drop, settled, shared_dir, shingle_sets

#: Similarity of 0.75 as a ratio of integers: 100 * intersection >= 75 * union.
NUM, DEN = 75, 100
#: A token that this many documents (counted where it repeats within a block) hold goes last.
COMMON = 32
#: Tokens whose counts are kept for the order; only speed depends on it.
ORDER_TOKENS = 500_000
#: Tokens counted together before their counts leave a task.
BLOCK_TOKENS = 1_000_000
#: Rows of an Arrow batch that are worked on together.
ROWS_AT_ONCE = 1000
#: Buckets of 32768 bits in a bit filter (8 MB), which spares later joins most rows.
FILTER_BUCKETS = 2048
FILTER_BITS = FILTER_BUCKETS * 32768
#: Frequency classes of a set's tokens that give min-hash values.
CLASSES = 3
#: Sizes within a band differ by this ratio at most; a group stands in the matrix once for each band.
BAND = 1.15
#: Bands between the sizes of two sets that qualify, at most.
REACH = 3
#: Pairs of one leading set that a task verifies together, about.
PAIRS_A_PART = 500
#: Tokens of the sets that a task compares each with each, about.
TOKENS_A_PART = 1_000_000
#: Sets of a task are a group where they are connected by this share of common tokens; only speed depends on it.
LOOSE = 0.1
#: Tokens of a group's union that are a cell of the matrix, about.
CELL = 2000
#: Cells of the table by which a task counts common tokens.
TABLE = 1 << 22
LONG_LIST = pa.list_(pa.int64())
#: Columns of a set's bits, 64 in each: those at its tokens modulo their number; only speed depends on it.
BITS = [f"s{i}" for i in range(8)]


def _as_lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _slices(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(i, ROWS_AT_ONCE)


def repeated_tokens(docs: DataFrame, size: int) -> DataFrame:
    """(token, n): how many documents hold a token, of blocks in which it repeats."""

    def count(batches):
        held, n = [], 0

        def out():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(tokens[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))], ["token", "n"])

        for batch in batches:
            for s in shingle_sets(batch.column("text"), size):
                held.append(s)
                n += len(s)
                if n >= BLOCK_TOKENS:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    return docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def token_order(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted common tokens, their rank classes): at most ORDER_TOKENS, those held most."""
    rows = repeated_tokens(docs, size).filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "token").limit(ORDER_TOKENS).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    level = np.log2(np.maximum(rows["n"].to_numpy(np.int64), 1)).astype(np.int64)
    by = np.argsort(tokens)
    return tokens[by], level[by]


def prefix_length(n):
    """Tokens of which one at least is shared with any set that qualifies."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def sketched(docs: DataFrame, size: int = 5) -> DataFrame:
    """Per document: set size and key, min-hash values, the prefix in the order, and bits of all tokens.

    Min-hash values are taken of the frequency classes that most of its tokens are in, so
    that near copies meet by what they share with one another, not by a common passage.
    """
    common, level = token_order(docs, size)
    shared = docs.sparkSession.sparkContext.broadcast((common, level))

    def sketch(batches):
        common, level = shared.value
        for batch in _slices(batches):
            n, key, rare, mins, prefixes = [], [], [], [], []
            bits = np.zeros((batch.num_rows, 64 * len(BITS)), bool)
            for s in shingle_sets(batch.column("text"), size):
                bits[len(n), s % np.uint64(bits.shape[1])] = True
                n.append(len(s))
                if not len(s):
                    key.append(None), rare.append(0), mins.append(s), prefixes.append(s)
                    continue
                key.append(set_key(s))
                want = prefix_length(len(s))
                rank = np.zeros(len(s), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    rank = np.where(common[at] == s, level[at], 0)
                held = np.bincount(rank)
                rare.append(int(held[0]))
                classes = [s[rank == c] for c in np.argsort(-held, kind="stable")[:CLASSES] if held[c]]
                mins.append(np.array([m for c in classes for m in (c[0], (c * np.uint64(0xD6E8FEB86659FD93)).min())], np.uint64))
                first = s[rank == 0]
                if len(first) < want:
                    last, by = s[rank > 0], rank[rank > 0]
                    first = np.concatenate([first, last[np.lexsort((last, by))]])
                prefixes.append(first[:want])
            packed = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), batch.column("row"), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(rare, pa.int64()), _as_lists(mins), _as_lists(prefixes)]
                + [pa.array(x) for x in packed.T],
                ["doc_id", "th", "row", "n", "k", "rare", "mins", "prefix", *BITS],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _text_hash(), _row_hash()).mapInArrow(sketch, f"doc_id {kind}, th long, row long, n long, k long, rare long, mins array<long>, prefix array<long>" + "".join(f", {x} long" for x in BITS))


def _text_hash():
    return F.xxhash64("text").alias("th")


def _row_hash():
    return F.xxhash64("doc_id", "text").alias("row")


def bit_filter(keys: DataFrame, key: str) -> np.ndarray:
    """Bits at the keys modulo the filter's size, by Spark's bitmap aggregate; FILTER_BUCKETS * 4 KB at most.

    Keys that aren't there may pass, so an exact join follows.
    """
    slot = F.pmod(key, F.lit(FILTER_BITS))
    rows = keys.select((slot / 32768).cast("long").alias("b"), (slot % 32768).cast("long").alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    maps = np.zeros((FILTER_BUCKETS, 4096), np.uint8)
    for r in rows:
        maps[r.b, : len(r.m)] = np.frombuffer(bytes(r.m), np.uint8)
    return maps.reshape(-1)


def passing(maps: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys % FILTER_BITS
    return (maps[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def once_each(sketch: DataFrame, rows: np.ndarray) -> DataFrame:
    """(k, n, rare, mins, prefix) of rows that ``rows``, a bit filter, lets pass: one for each set, or few."""
    shared = sketch.sparkSession.sparkContext.broadcast(rows)

    def only(batches):
        for batch in batches:
            some = batch.take(pa.array(np.flatnonzero(passing(shared.value, batch.column("row").to_numpy()))))
            yield some.select(["k", "n", "rare", "mins", "prefix"])

    some = sketch.filter("n > 0").select("row", "k", "n", "rare", "mins", "prefix")
    return some.mapInArrow(only, "k long, n long, rare long, mins array<long>, prefix array<long>")


def shared_tokens(sketch: DataFrame, rows: np.ndarray, folder: str) -> DataFrame:
    """(k, n, rare, tokens), once for each set: the prefix tokens that another set has too, and few others.

    As in ``once_each`` the bit filter ``rows`` leaves one row of each set, or few.  A set's
    tokens stay together until they have to meet, so that its group is joined once a set.
    """
    tokens = once_each(sketch, rows).select(F.explode("prefix").alias("token"))
    shared = settled(tokens.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token"), f"{folder}/shared")
    spark = sketch.sparkSession.sparkContext
    maps, once = spark.broadcast(bit_filter(shared, "token")), spark.broadcast(rows)

    def only(batches):
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(passing(once.value, batch.column("row").to_numpy()))))
            lists = batch.column("prefix")
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()[ends[0] : ends[-1]]
            keep = passing(maps.value, flat)
            ends = np.append(0, np.cumsum(keep))[ends - ends[0]]
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[keep]))
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), batch.column("rare"), kept], ["k", "n", "rare", "tokens"])

    # one pass of Python workers, so both filters are in it
    some = sketch.filter("n > 0").select("row", "prefix", "k", "n", "rare").mapInArrow(only, "k long, n long, rare long, tokens array<long>")
    rows = settled(some.filter(F.size("tokens") > 0).dropDuplicates(["k"]), f"{folder}/rows")
    drop(sketch.sparkSession, f"{folder}/shared")
    return rows


def _wanted_texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` (row, ...) with the text of each row; a bit filter of bounded size keeps other texts from the join, which is exact."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, "row"))

    def only(batches):
        for batch in _slices(batches):
            yield batch.take(pa.array(np.flatnonzero(passing(shared.value, batch.column("row").to_numpy()))))

    return docs.select(_row_hash(), "text").mapInArrow(only, "row long, text string").join(wanted, "row").drop("row")


def verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, size: int, folder: str) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole sets reach the threshold.

    Each ``a`` leads one part or more of PAIRS_A_PART pairs, about, so that one with many
    pairs is no hot key.  The text of each set's first row, of ``firsts`` (k, row), goes to
    the parts it is in, the leader's first, and is cut into shingles there.
    """
    parts = F.ceil(F.col("c") / PAIRS_A_PART)
    leads = pairs.groupBy("a").agg(F.count("*").alias("c"))
    led = pairs.select("a", "b").join(leads, "a").select("a", F.pmod(F.xxhash64("b"), parts).alias("part"), F.col("b").alias("k"), F.lit(True).alias("led"))
    leads = leads.select("a", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.col("a").alias("k"), F.lit(False).alias("led"))
    wanted = settled(led.union(leads).join(firsts, "k"), f"{folder}-wanted")

    def compare(batches):
        lead, own = None, None
        for batch in _slices(batches):
            found_a, found_b = [], []
            sets = shingle_sets(batch.column("text"), size)
            for a, part, led, k, s in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "led", "k")), sets, strict=True):
                if not led:
                    lead, own = (a, part), s
                    continue
                if lead != (a, part):
                    raise ValueError("a part has no leader")
                both = np.count_nonzero(own[np.minimum(np.searchsorted(own, s), len(own) - 1)] == s)
                if both * DEN >= (len(own) + len(s) - both) * NUM:
                    found_a.append(a), found_b.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    texts = _wanted_texts(wanted, docs).select("a", "part", "led", "k", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = texts.repartition(n, "a", "part").sortWithinPartitions("a", "part", "led").mapInArrow(compare, "a long, b long")
    links = settled(links, f"{folder}-links")
    drop(docs.sparkSession, f"{folder}-wanted")
    return links


def common_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of ``sets`` share: a matrix product over the tokens of two sets or more."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    by = np.argsort(flat, kind="stable")
    flat, owner = flat[by], owner[by]
    new = np.append(True, flat[1:] != flat[:-1])
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1
    owner, column = owner[several], (np.cumsum(new & several) - 1)[several]
    both, width = np.zeros((len(sets), len(sets)), np.int64), max(1, TABLE // len(sets))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        table = np.zeros((len(sets), int(column[hi - 1]) - first + 1), np.float32)  # whole numbers below 2 ** 24
        table[owner[lo:hi], column[lo:hi] - first] = 1
        both += (table @ table.T).astype(np.int64)
    np.fill_diagonal(both, [len(s) for s in sets])
    return both


def _connected(near: np.ndarray) -> np.ndarray:
    """The first place that each place is connected with."""
    label = np.arange(len(near))
    while True:
        low = np.where(near, label, len(near)).min(axis=1)
        low = low[low]
        if np.array_equal(low, label):
            return label
        label = low


def told_apart(keys: list[int], sets: list[np.ndarray], alone: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(g, c, pure) of sets that are compared each with each; the first leads them.

    c is a set of the same class: of those connected by links.  g is the group: any two of
    a group have been compared, or are of one class.  The leader, if not ``alone``, leads other parts
    too, so only its class is in its group there.  pure: the group is one class.
    """
    keys, n, both = np.array(keys, np.int64), np.array([len(s) for s in sets]), common_tokens(sets)
    union = n[:, None] + n - both
    label = _connected(both * DEN >= union * NUM)
    group = _connected(both >= union * LOOSE)
    if not alone:
        others = (group == 0) & (label != 0)
        group[others] = np.flatnonzero(others)[0] if others.any() else 0
    pure = np.ones(len(keys), bool)
    pure[group[label != label[group]]] = False
    return keys[group], keys[label], pure[group]


def fits(n, m):
    """Set sizes that can reach the threshold at all."""
    return (F.least(n, m) * DEN >= F.greatest(n, m) * NUM)


def least_shared(n, m):
    """Prefix tokens that two sets of these sizes must share to qualify.

    The overlap must reach NUM/(NUM+DEN) of both sizes together; beyond the end of the
    shorter prefix at most the rest of one set can match.
    """
    need = F.ceil(F.lit(NUM) * (n + m) / F.lit(NUM + DEN))
    # n - prefix_length(n) = ceil(NUM n / DEN) - 1
    rest = lambda x: F.ceil(F.lit(NUM) * x / F.lit(DEN)) - 1
    return F.greatest(need - F.greatest(rest(n), rest(m)), F.lit(1))


def least_shared_within(n, lo, hi):
    """The least ``least_shared`` over the set sizes from ``lo`` to ``hi``, which must be such that fit.

    It never falls with m up to m = n.  After that a step to m + 1 adds 1 at most, where
    the rest of the longer set stays, and two steps or more add nothing; so the least
    value is at ``lo``, ``hi`` or ``hi - 1``.
    """
    return F.least(least_shared(n, lo), least_shared(n, hi), least_shared(n, F.greatest(lo, hi - 1)))


def size_band(n):
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(BAND)))


def prefix_end(n):
    """``prefix_length`` of a column."""
    return n - F.floor((n * NUM + DEN - 1) / DEN) + 1


def least_missing(own, other):
    """Tokens of a set with the bits ``own`` that no set within the bits ``other`` has, at least."""
    return sum((F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in zip(own, other, strict=True)), F.lit(0))


def least_overlap(n, m):
    """Tokens that two sets of these sizes share if they qualify, at least."""
    return F.ceil(F.lit(NUM) * (n + m) / F.lit(NUM + DEN))


def bits_allow(n, bits, lo, hi, some, every):
    """Whether a set of n tokens may qualify with one of lo to hi tokens, by its bits and those that ``some`` or ``every`` such set has.

    It shares no token whose bit no such set has, and they share none of theirs whose bit
    it lacks.  What is left, less what must be shared, is most at ``lo`` in the first case
    and at ``hi`` in the second.
    """
    return (n - least_missing(bits, some) >= least_overlap(n, lo)) & (hi - least_missing(every, bits) >= least_overlap(n, hi))


def _of(sets: DataFrame, name: str, *more: str) -> DataFrame:
    """``sets`` (k, n, bits and ``more``) as columns that begin with ``name``; k is ``name`` itself."""
    return sets.select(F.col("k").alias(name), *(F.col(x).alias(f"{name}_{x}") for x in ("n", *BITS, *more)))


def pair_allowed():
    """``bits_allow`` of a and b as named by ``_of``."""
    a, b = ([F.col(f"{x}_{s}") for s in BITS] for x in "ab")
    return bits_allow(F.col("a_n"), a, F.col("b_n"), F.col("b_n"), b, b)


def placed(sets: DataFrame) -> DataFrame:
    """A row for each of ``tokens`` of ``sets``, with its place in the prefix; those that aren't in ``tokens`` come first."""
    kept = [x for x in sets.columns if x != "tokens"]
    return sets.select(*kept, F.size("tokens").alias("held"), F.posexplode("tokens").alias("at", "token")).withColumn("pos", prefix_end(F.col("n")) - F.col("held") + F.col("at")).drop("held", "at")


def last_leads(step: int):
    """For a set and each band d steps from its own, the last place of its prefix that may lead it to a partner there; -1 if none fits.

    Two sets that qualify share L = ``least_shared`` tokens of their prefixes.  In any
    common order of the prefixes' tokens (``pos``) the first of these has L - 1 more behind
    it in either prefix, so its place is L before the prefix's end at the latest.  Tokens further on open nothing: in a set
    with enough rare tokens a common passage's are never looked at.
    """
    n = F.col("n")

    def last(d):
        other = F.col("band") + step * d
        # a band's sizes, one more on either side against rounding, as far as they fit
        lo = F.greatest(F.floor(F.pow(F.lit(BAND), other)) - 1, F.ceil(n * NUM / DEN))
        hi = F.least(F.ceil(F.pow(F.lit(BAND), other + 1)) + 1, F.floor(n * DEN / NUM))
        return F.when(lo <= hi, prefix_end(n) - least_shared_within(n, lo, hi)).otherwise(F.lit(-1).cast("long"))

    return F.transform(F.sequence(F.lit(0), F.lit(REACH)), last)


def led_bands(last: str):
    """The bands that a token at ``pos`` leads to by ``last``, a column of ``last_leads``, as the bits d of a number."""
    return sum((F.when(F.col("pos") <= F.col(last)[d], 1 << d).otherwise(0) for d in range(REACH + 1)), F.lit(0))


def similar_groups(sets: DataFrame, docs: DataFrame, firsts: DataFrame, size: int, folder: str) -> DataFrame:
    """(k, g, c, pure): groups of similar sets and classes within them, see ``told_apart``; sets alone are left out.

    Sets meet where a min-hash value and a size band agree.  Each points to one of its
    buckets' sets with the fewest rare tokens (of near copies the least edited): that met
    most often.  The text of each set so connected goes once to a part of PAIRS_A_PART sets,
    about, in which all are compared on whole sets.  So copies that are alike but not linked,
    whose pairs grow with the square of their number, are no rows of a join.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM)))
    keys = ["m", "band"]
    known = sets.select("k", "n", "rare")
    sets = sets.select("k", "rare", band.alias("band"), F.explode("mins").alias("m"))
    hubs = sets.groupBy(*keys).agg(F.min(F.struct("rare", "k"))["k"].alias("a"), F.min("k").alias("y"), F.max("k").alias("z"))
    hubs = settled(hubs.filter("y <> z").drop("y", "z"), f"{folder}/hubs")
    # one value in common may be a passage's; pairs left out here are looked at by the matrix
    pairs = sets.join(hubs, keys).filter("k <> a").groupBy("a", F.col("k").alias("b")).agg(F.count("*").alias("c")).filter("c > 1")
    pairs = settled(pairs.groupBy("b").agg(F.max(F.struct("c", "a"))["a"].alias("a")).select("a", "b"), f"{folder}/star-pairs")
    near = components(pairs, f"{folder}/star-cc").select(F.col("node").alias("k"), F.col("component").alias("near"))
    near = settled(near.join(known, "k").distinct(), f"{folder}/near")

    parts = F.greatest(F.ceil(F.count("*") / PAIRS_A_PART), F.ceil(F.sum("n") / TOKENS_A_PART))
    leads = settled(near.groupBy("near").agg(F.min(F.struct("rare", "k"))["k"].alias("a"), parts.alias("parts")), f"{folder}/leads")
    led = near.join(leads, "near").filter("k <> a").select("a", F.pmod(F.xxhash64("k"), "parts").alias("part"), "parts", "k", F.lit(True).alias("led"))
    first = leads.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "parts", F.col("a").alias("k"), F.lit(False).alias("led"))
    wanted = settled(led.union(first).join(firsts, "k"), f"{folder}/star-wanted")

    def compare(batches):
        at, keys, sets = None, [], []

        def out():
            g, c, pure = told_apart(keys, sets, at[2] == 1)
            here = np.arange(1 if at[1] else 0, len(keys))  # part 0 tells of the leader
            return pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.int64)[here]), pa.array(g[here]), pa.array(c[here]), pa.array(pure[here])], ["k", "g", "c", "pure"])

        for batch in _slices(batches):
            for a, part, parts, k, s in zip(*(batch.column(x).to_pylist() for x in ("a", "part", "parts", "k")), shingle_sets(batch.column("text"), size), strict=True):
                if at != (a, part, parts):
                    if keys:
                        yield out()
                    at, keys, sets = (a, part, parts), [], []
                keys.append(k)
                sets.append(s)
        if keys:
            yield out()

    texts = _wanted_texts(wanted, docs).select("a", "part", "parts", "led", "k", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = texts.repartition(n, "a", "part").sortWithinPartitions("a", "part", "led").mapInArrow(compare, "k long, g long, c long, pure boolean")
    groups = settled(groups, f"{folder}/groups")
    drop(docs.sparkSession, *(f"{folder}/{x}" for x in ("hubs", "star-pairs", "star-cc", "near", "leads", "star-wanted")))
    return groups


def grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with their group; a set in no group is one of its own."""
    return rows.join(groups.select("k", "g", "pure"), "k", "left").select("k", "n", "rare", "tokens", F.coalesce("g", "k").alias("g"), F.coalesce("pure", F.lit(True)).alias("pure"))


def led_groups(rows: DataFrame, groups: DataFrame, docs: DataFrame, firsts: DataFrame, size: int, folder: str) -> DataFrame:
    """Groups after merging those of one class whose leaders on a token qualify: one leader a group and token.

    Strays of a large group of near copies join it here, so that it stands in the matrix once.
    """
    # tokens meet once, for the leaders of groups, the first of these and their pairs with it
    leaders = rows.filter("pure").select("k", "n", "rare", "g", F.explode("tokens").alias("token")).repartition("token")
    leaders = leaders.groupBy("token", "g").agg(F.min(F.struct("rare", "k", "n")).alias("l"))
    first = leaders.groupBy("token").agg(F.min(F.struct("l", "g")).alias("f"), F.min("g").alias("y"), F.max("g").alias("z")).filter("y <> z")
    first = first.select("token", F.col("f.g").alias("h"), F.col("f.l.k").alias("b"), F.col("f.l.n").alias("nb"))
    met = leaders.join(first, "token").filter("g <> h").select(F.col("l.k").alias("a"), F.col("l.n").alias("na"), "b", "nb").filter(fits(F.col("na"), F.col("nb")))
    # tokens on which other members lead are not counted here, so some pairs are left for later
    pairs = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("o")).filter(F.col("o") >= least_shared(F.col("na"), F.col("nb")))
    pairs = settled(pairs.select("a", "b"), f"{folder}/led-pairs")
    pairs = pairs.join(_of(firsts, "a"), "a").join(_of(firsts, "b"), "b").filter(pair_allowed()).select("a", "b")
    links = verified(settled(pairs, f"{folder}/led-allowed"), docs, firsts.select("k", "row"), size, f"{folder}/led")
    edges = groups.filter("pure").select(F.col("k").alias("a"), F.col("g").alias("b")).union(links)
    merged = components(edges, f"{folder}/led-cc").select(F.col("node").alias("k"), F.col("component").alias("g"), F.lit(True).alias("pure"))
    merged = merged.union(groups.filter("not pure").select("k", "g", "pure"))
    merged = settled(merged.join(groups.select("k", "c"), "k", "left").select("k", "g", F.coalesce("c", "k").alias("c"), "pure"), f"{folder}/led-groups")
    drop(docs.sparkSession, *(f"{folder}/{x}" for x in ("led-pairs", "led-allowed", "led-links", "led-cc", "groups")))
    return merged


def _classified(docs: DataFrame, size: int, folder: str) -> DataFrame:
    """(doc_id, th, n, c) per row of ``docs(doc_id, text)``: text hash, set size and class, null without words."""
    docs = docs.select("doc_id", "text")
    sketch = settled(sketched(docs, size), f"{folder}/sketch")
    # each set is looked at once, whatever its copies
    firsts = settled(sketch.filter("n > 0").groupBy("k").agg(*(F.min(x).alias(x) for x in ("row", "n", *BITS))), f"{folder}/first-rows")
    once = bit_filter(firsts, "row")
    groups = similar_groups(once_each(sketch, once), docs, firsts.select("k", "row"), size, folder)

    rows = shared_tokens(sketch, once, folder)
    ids = settled(sketch.select("doc_id", "th", "n", "k"), f"{folder}/keys")
    drop(docs.sparkSession, f"{folder}/sketch")
    groups = led_groups(grouped(rows, groups), groups, docs, firsts, size, folder)
    rows = settled(grouped(rows, groups).drop("pure"), f"{folder}/grouped")
    drop(docs.sparkSession, f"{folder}/rows")

    # Tokens of several groups; in a prefix those of no other group come first, then by exact counts, rare ones first.
    held = rows.select("k", "g", F.explode("tokens").alias("token"))
    several = settled(held.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("c")).filter("lo <> hi").select("token", "c"), f"{folder}/several")
    tokens = held.join(several, "token").groupBy("k").agg(F.min("g").alias("g"), F.sort_array(F.collect_list(F.struct("c", "token")))["token"].alias("tokens"))
    sets = tokens.join(firsts.drop("row"), "k").withColumn("band", size_band("n"))
    sets = settled(sets.withColumns({"down": last_leads(-1), "up": last_leads(1)}), f"{folder}/open")
    drop(docs.sparkSession, f"{folder}/grouped", f"{folder}/several")

    # Who may qualify at all: a set asks groups of its own size band and smaller ones.
    rows = placed(sets.select("k", "n", "g", "band", "tokens", "down", "up"))
    asking = rows.select("token", "k", "g", "band", led_bands("down").alias("down")).filter("down > 0")
    asked = rows.select("token", F.col("g").alias("h"), F.col("band").alias("hband"), led_bands("up").alias("up")).filter("up > 0")
    asked = asked.repartition("token").groupBy("token", "h", "hband").agg(F.bit_or("up").alias("up"))
    steps = F.col("band") - F.col("hband")
    led = steps.between(0, REACH) & F.expr("shiftright(down & up, cast(band - hband as int)) & 1 = 1")
    some = asking.join(asked, "token").filter(led & (F.col("g") != F.col("h")) & ((steps > 0) | (F.col("g") > F.col("h")))).select("k", "h", "hband").distinct()
    some = settled(some, f"{folder}/candidates")

    # Of each group and size band: the bits that some member has and those that every one has, and parts of its members.
    group = [F.col("g").alias("h"), F.col("band").alias("hband")]
    unions = sets.groupBy(*group).agg(F.ceil(F.count("*") / PAIRS_A_PART).alias("parts"), F.min("n").alias("lo"), F.max("n").alias("hi"), *(F.bit_or(x).alias(f"some_{x}") for x in BITS), *(F.bit_and(x).alias(f"every_{x}") for x in BITS))
    n, lo, hi = F.col("n"), F.col("lo"), F.col("hi")
    smallest, largest = F.greatest(lo, F.ceil(n * NUM / DEN)).alias("lo"), F.least(hi, F.floor(n * DEN / NUM)).alias("hi")
    own, of_some, of_every = ([F.col(f"{x}{s}") for s in BITS] for x in ("", "some_", "every_"))
    allowed = some.join(sets.select("k", "n", *BITS), "k").join(unions, ["h", "hband"]).select("k", "n", "h", "hband", "parts", smallest, largest, *own, *of_some, *of_every)
    allowed = allowed.filter((lo <= hi) & bits_allow(n, own, lo, hi, of_some, of_every)).select("k", "n", "h", "hband", "parts", "lo", "hi")
    allowed = settled(allowed, f"{folder}/allowed")

    # Token-group matrix: the token union of each of these, in cells, and how much of it a set has.
    matrix = sets.select(*group, "tokens").join(allowed.select("h", "hband").distinct(), ["h", "hband"], "left_semi")
    union = settled(matrix.select("h", "hband", F.explode("tokens").alias("token")).distinct(), f"{folder}/union")
    cells = union.join(union.groupBy("h", "hband").agg(F.ceil(F.count("*") / CELL).alias("cells")), ["h", "hband"])
    cells = cells.groupBy("h", "hband", F.pmod(F.xxhash64("token"), "cells").alias("cell")).agg(F.collect_list("token").alias("union"))
    bound = sets.select("k", "tokens").join(allowed, "k").join(cells, ["h", "hband"]).select(*allowed.columns, F.size(F.array_intersect("tokens", "union")).alias("o"))
    bound = bound.groupBy(*allowed.columns).agg(F.sum("o").alias("o"))
    opened = settled(bound.filter(F.col("o") >= least_shared_within(n, lo, hi)).select("k", "h", "hband", "parts"), f"{folder}/opened")
    drop(docs.sparkSession, f"{folder}/candidates", f"{folder}/allowed", f"{folder}/union")

    # Members of the opened groups whose bits and prefixes qualify; a query asks each part of a large group.
    key = ["h", "hband", "part"]
    asking = _of(sets, "a", "tokens").join(opened.withColumnRenamed("k", "a"), "a").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    members = _of(sets, "b", "tokens", "g", "band").withColumnsRenamed({"b_g": "h", "b_band": "hband"}).join(opened.select("h", "hband", "parts").distinct(), ["h", "hband"])
    members = members.withColumn("part", F.pmod(F.xxhash64("b"), "parts")).drop("parts")
    na, nb = F.col("a_n"), F.col("b_n")
    enough = F.size(F.array_intersect("a_tokens", "b_tokens")) >= least_shared(na, nb)
    pairs = settled(asking.join(members, key).filter(fits(na, nb) & pair_allowed() & enough).select("a", "b"), f"{folder}/pairs")
    drop(docs.sparkSession, f"{folder}/opened", f"{folder}/open")
    links = verified(pairs, docs, firsts.select("k", "row"), size, f"{folder}/rest")

    edges = groups.select(F.col("k").alias("a"), F.when(F.col("pure"), F.col("g")).otherwise(F.col("c")).alias("b")).union(links)
    classes = components(edges, f"{folder}/cc")
    ids = ids.join(classes.withColumnRenamed("node", "k"), "k", "left").withColumn("c", F.coalesce("component", "k"))
    ids = settled(ids.select("doc_id", "th", "n", "c"), f"{folder}/ids")
    drop(docs.sparkSession, *(f"{folder}/{x}" for x in ("keys", "first-rows", "led-groups", "pairs", "rest-links", "cc")))
    return ids


def jaccard_classes(docs: DataFrame, size: int = 5) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable over links, the own one included.
    """
    folder = shared_dir(docs.sparkSession)
    ids = _classified(docs, size, folder).select("doc_id", "n", "c")
    least = settled(ids.filter(F.col("c").isNotNull()).groupBy("c").agg(F.min("doc_id").alias("least")), f"{folder}/least")
    return ids.join(least, "c", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class stays, that with the smallest (doc_id, text hash); columns as given.

    A null id comes after all others.  Rows are told apart by doc_id and text, so a
    repeated or null id drops no row of another class.  Documents without words are in no
    class and stay; of rows that repeat both id and text, one stays.
    """
    folder = shared_dir(docs.sparkSession)
    ids = _classified(docs, 5, folder)
    rows = ids.filter(F.col("c").isNotNull()).groupBy("c", "doc_id", "th").agg(F.count("*").alias("copies"))
    first = rows.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "copies")).alias("f")).select("f.doc_id", "f.th", "f.copies")
    blank = ids.filter(F.col("c").isNull()).select("doc_id", "th", F.lit(1).cast("long").alias("copies")).distinct()
    stay = settled(first.union(blank), f"{folder}/stay").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("copies").alias("_copies"))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_th"))
    repeated = stay.filter("_copies > 1")
    if not repeated.take(1):
        return docs.join(stay, same, "left_semi")
    repeated = settled(repeated, f"{folder}/repeated")
    once = docs.join(repeated, same).dropDuplicates(["_id", "_th"]).select(*(docs[c] for c in docs.columns))
    return docs.join(stay.filter("_copies = 1"), same, "left_semi").unionByName(once)

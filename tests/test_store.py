"""Kept tables, versions, ranks, bitmap counts and the published catalogue, with killed runs and famous keys."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import evidence, ranks, reports, resolve
from shelfmark.sources import catalogue, store


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def batches(spark):
    old = spark.createDataFrame([(i, f"f{i % 3}", f"u{i}", i) for i in range(0, 200, 2)], "entity_id long, field_name string, source_url string, n int")
    new = spark.createDataFrame([(i, f"f{i % 3}", f"u{i}", 1000 + i) for i in range(150, 260)] + [(None, None, None, 7)], old.schema)
    return old, new


KEYS = ("entity_id", "field_name", "source_url")


def test_a_batch_twice_and_after_killed_runs(spark, tmp_path, monkeypatch):
    old, new = batches(spark)
    want = store.Kept(f"file://{tmp_path}/want", KEYS, 8)
    want.create(old)
    evidence.append_to(want, new)
    expected = rows_of(want.read(spark))
    assert len(expected) == 100 + 110 - 25 + 1
    evidence.append_to(want, new)
    assert rows_of(want.read(spark)) == expected

    put = store.Kept._put

    def killed_at(call, partial):
        calls = []

        def stopping(self, df, path):
            calls.append(path)
            if len(calls) == call:
                if partial:  # some partitions were replaced, or some files written
                    put(self, df.filter(self.part < 3), path)
                    if path.endswith("_pending"):
                        store.remove(spark, f"{path}/_SUCCESS")
                raise InterruptedError
            put(self, df, path)

        return stopping

    for call in (1, 2):
        for partial in (False, True):
            table = store.Kept(f"file://{tmp_path}/t{call}{partial}", KEYS, 8)
            table.create(old)
            with monkeypatch.context() as m:
                m.setattr(store.Kept, "_put", killed_at(call, partial))
                with pytest.raises(InterruptedError):
                    evidence.append_to(table, new)
            assert rows_of(table.read(spark)) == (expected if call == 2 else rows_of(old))
            evidence.append_to(table, new)
            assert rows_of(table.read(spark)) == expected


def test_a_batch_reads_and_writes_its_partitions_only(spark, tmp_path):
    old, _ = batches(spark)
    table = store.Kept(f"file://{tmp_path}/t", KEYS, 32)
    table.create(old)
    times = {n: t for n, _, t in store.children(spark, table.path)}
    one = spark.createDataFrame([(999, "f0", "u", 1)], old.schema)
    part = one.select(table.part.alias("p")).first().p
    assert "part#" in plan_of(table.read(spark, one)).split("PartitionFilters: [")[1].split("]")[0]
    evidence.append_to(table, one)
    changed = [n for n, _, t in store.children(spark, table.path) if n.startswith("part=") and times.get(n) != t]
    assert changed == [f"part={part}"]
    with pytest.raises(FileExistsError):
        table.create(old)
    evidence.append_to(table, one.limit(0))
    assert table.read(spark).count() == 101
    empty = store.Kept(f"file://{tmp_path}/e", KEYS, 4)
    empty.create(old.limit(0))
    assert empty.read(spark).count() == 0 and empty.read(spark).columns == old.columns
    evidence.append_to(empty, one)
    assert rows_of(empty.read(spark)) == rows_of(one)


def test_rule_facts_on_kept_tables(spark, tmp_path):
    products = store.Kept(f"file://{tmp_path}/p", ("id",), 4)
    products.create(spark.createDataFrame([(1, "unknown"), (2, "analog"), (3, None)], "id long, technology string"))
    claims = store.Kept(f"file://{tmp_path}/c", ("entity_id", "field_name", "derived_from"), 4)
    schema = "entity_id long, field_name string, value string, source_url string, source_tier string, derived_from string"
    claims.create(spark.createDataFrame([(2, "technology", "analog", "u", "other", None)], schema))
    facts = spark.createDataFrame([(1, "technology", "digital", "u", "other", "r: a"), (2, "technology", "digital", "u", "other", "r: b"), (3, "technology", "analog", "u", "other", "r: c"), (3, "technology", "digital", "u", "other", "r: d")], "entity_id long, field string, value string, source_url string, tier string, derived_from string")
    for _ in range(2):
        evidence.apply_facts_to(products, claims, facts, ["technology"])
        assert rows_of(products.read(spark)) == [(1, "digital"), (2, "analog"), (3, None)]
        assert claims.read(spark).count() == 5


def test_versions(spark, tmp_path):
    kept = store.Versions(f"file://{tmp_path}/v", "k", 4)
    with pytest.raises(FileNotFoundError):
        kept.read(spark)
    a = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, n int")
    assert kept.write(a) == 1 and kept.write(a.filter("n < 10")) == 2
    store.remove(spark, f"file://{tmp_path}/v/v=2/_SUCCESS")  # as if its writer had been killed
    assert rows_of(kept.read(spark)) == rows_of(a)
    assert kept.write(a.filter("n < 5")) == 3
    spark.sql(f"DROP TABLE {kept._name(3)}")  # as in a session that didn't write it
    again = kept.read(spark)
    assert rows_of(again) == rows_of(a.filter("n < 5"))
    assert "Exchange" not in plan_of(again.groupBy("k").count())
    kept.drop_before(spark, 3)
    assert kept.numbers(spark) == [3]


def test_a_stored_dictionary_is_joined_without_an_exchange(spark, tmp_path):
    makers = spark.createDataFrame([(1, "Korg", "Korg Inc"), (2, "K-org", None), (3, "東京", None), (4, "Old Names Ltd", None), (5, "東 京", None)], "id long, canonical_name string, long_name string")
    names = spark.createDataFrame([(4, "Brand Nine"), (1, "東京"), (4, " ")], "maker_id long, name string")
    plain = resolve.name_dictionary(makers, names)
    kept = resolve.store_dictionary(plain, f"file://{tmp_path}/d", 4)
    assert rows_of(kept) == rows_of(plain)
    asked = spark.createDataFrame([(i, n) for i, n in enumerate(["korg", "K-ORG", "k.org", "東京", "東 京", "?", None, "my brand nine shop", "BRAND-NINE"])], "id long, name string")
    want = {0: (1, "exact"), 1: (2, "exact"), 2: (1, "key"), 3: (3, "exact"), 4: (5, "exact"), 5: (None, None), 6: (None, None), 7: (None, None), 8: (4, "key")}
    for dictionary in (plain, kept):
        assert {r.id: (r.maker_id, r.match_kind) for r in resolve.resolve_maker(asked, "name", dictionary).collect()} == want
        assert rows_of(resolve.contained_name(asked, "name", dictionary, "id")) == [(7, 4, "brand nine")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(resolve.resolve_maker(asked, "name", kept))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1  # only the asked names are shuffled


def test_ranks_of_a_famous_key(spark, monkeypatch):
    """One maker has 90 % of the rows: the same places as a window gives, and no task with more than its share."""
    rng = random.Random(1)
    rows = [(i, 7 if rng.random() < 0.9 else rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.randrange(50)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, maker_id long, kind string, n int")
    order = [ranks.up_nulls_last("kind"), ranks.down("n"), ranks.up("id")]
    from pyspark.sql import Window

    window = Window.partitionBy("maker_id").orderBy(F.col("kind").asc_nulls_last(), F.desc("n"), "id")
    want = rows_of(df.withColumn("rank", F.row_number().over(window).cast("long")))
    assert rows_of(ranks.ranked(df, "maker_id", order)) == want
    monkeypatch.setattr(ranks, "TASK_ROWS", 100)
    assert rows_of(ranks.ranked(df, "maker_id", order)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = ranks._dealt(df, [ranks.up("maker_id"), *order])
        most = dealt.groupBy("_range").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert most < 3 * 4000 / 20
    assert ranks.ranked(df.limit(0), "maker_id", order).count() == 0


@pytest.mark.parametrize("distinct", [False, True])
def test_first_of_a_generic_key(spark, monkeypatch, distinct):
    """The same lists and counts whichever way they are made, and none above ``most``."""
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.choice(["x", "x", "x", "y", None]), rng.choice([None, *range(40)])) for _ in range(600)], "k string, v int")
    held = {}
    for k, v in df.collect():
        if v is not None:
            held.setdefault(k, []).append(v)
    held = {k: sorted(set(v) if distinct else v) for k, v in held.items()}
    for limit in (10_000, 5):
        monkeypatch.setattr(ranks, "LIST_ITEMS", limit)
        got = ranks.first_of(df.filter("k is not null"), ["k"], F.col("v"), 7, distinct)
        assert {r.k: (r.n, r["items"]) for r in got.collect()} == {k: (len(v), v[:7]) for k, v in held.items() if k is not None}


def test_running_sums(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(5)) for i in range(500)]
    upto, want = 0, []
    for i, w in sorted(rows, key=lambda r: -r[0]):
        want.append((i, w, upto))
        upto += w
    assert rows_of(ranks.running(spark.createDataFrame(rows, "id long, w long"), [ranks.down("id")], "w")) == sorted(want, key=str)


def test_bitmap_counts(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([None, 0, 1, -1, -40000, 32768, 32769, 10**12, rng.randrange(-9, 9)]), rng.random() < 0.5) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, id long, c boolean")
    got = reports.counted_ids(df, ["k"], F.col("id"), {"ids": F.lit(True), "some": F.col("c")}, {"n": F.lit(1)})
    assert rows_of(got.select("k", "n", "ids", "some")) == rows_of(df.groupBy("k").agg(F.count("*"), F.countDistinct("id"), F.countDistinct(F.when(F.col("c"), F.col("id")))))
    assert "Expand" not in plan_of(got)
    assert tuple(reports.counted_ids(df.limit(0), [], F.col("id"), {"ids": F.lit(True)}).first()) == (0,)


def test_catalogue_of_a_famous_maker(spark, tmp_path, monkeypatch):
    """Pieces and files are bounded, nothing is lost, and names are in order over the files."""
    monkeypatch.setattr(ranks, "TASK_ROWS", 100)
    makers = spark.createDataFrame([(i, n) for i, n in enumerate(["beta", "Alpha", "gamma", None, "Alpha"])], "id long, canonical_name string")
    products = spark.createDataFrame([(i, 1 if i % 10 else i % 5, f"p{i}", None if i % 4 == 0 else 1900 + i % 50, "c") for i in range(900)] + [(5000, 77, "lost", 1, "c"), (5001, None, "none", 1, "c")], "id long, maker_id long, name string, year int, category string")
    names = spark.createDataFrame([(0, "Old Beta", 1960, None)], "maker_id long, name string, start_year int, end_year int")
    relations = spark.createDataFrame([(0, 1, "owned_by", 1990), (0, 66, "partner", None)], "maker_id long, related_id long, relation_type string, year int")
    logos = spark.createDataFrame([(1, 2, 1950, None, "approved"), (2, 2, None, 2000, "outdated")], "id long, maker_id long, start_year int, end_year int, review_status string")
    path = f"file://{tmp_path}/out"
    catalogue.publish_files(path, makers, names, products, relations, logos, piece=20, file_rows=100)
    item = "array<struct<id bigint, name string, related_name string, year int>>"
    rows = catalogue.read_catalogue(spark, path, f"file int, maker_id bigint, canonical_name string, piece int, pieces int, name_history {item}, instruments {item}, relations {item}, logos {item}").collect()
    assert all(len(r[s] or []) <= 20 for r in rows for s in catalogue.SECTIONS)
    by_maker = {}
    for r in sorted(rows, key=lambda r: (r.maker_id, r.piece)):
        by_maker.setdefault(r.maker_id, []).extend(x.id for x in r.instruments or [])
    assert by_maker == {m: [r.id for r in products.filter(f"maker_id = {m}").orderBy(F.col("year").asc_nulls_last(), "name", "id").collect()] for m in range(5)}
    sizes, ends = {}, {}
    for r in rows:
        sizes.setdefault(r.file, [0, 0])
        sizes[r.file][0] += 1
        sizes[r.file][1] += sum(len(r[s] or []) for s in catalogue.SECTIONS)
        ends.setdefault(r.file, []).append(((r.canonical_name or "").lower(), r.maker_id, r.piece))
    assert len(sizes) > 5 and all(n + c <= 100 + 20 * 4 + 1 for n, c in sizes.values())
    assert {r.file: [r.rows, r.children] for r in catalogue.read_manifest(spark, path).collect()} == sizes
    order = [x for f in sorted(ends) for x in sorted(ends[f])]
    assert order == sorted(order)
    assert len({r.pieces for r in rows if r.maker_id == 1}) == 1 and sum(r.maker_id == 1 for r in rows) == rows[[r.maker_id for r in rows].index(1)].pieces
    assert [(x.related_name, x.year) for r in rows if r.maker_id == 0 for x in r.relations or []] == [("Alpha", 1990), (None, None)]

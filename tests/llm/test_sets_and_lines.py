"""N-gram join and line dedup against brute force on small tables."""

import random

import numpy as np
import pytest

from shelfmark.llm import line_dedup, ngram_join
from shelfmark.llm.common import components


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def prose(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def brute_classes(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id))
    return sorted(out, key=str)


def test_jaccard_classes_match_brute_force(spark):
    rng = random.Random(3)
    rows = []
    common = prose(rng, 60)
    for g in range(8):
        base = prose(rng, rng.choice([6, 40, 150]))
        for _ in range(rng.choice([1, 3, 6])):
            own = list(base)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(999)}"
            rows.append((len(rows) * 3 % 97, " ".join(own + (common if g % 3 == 0 else []))))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "One two"), (504, "one  TWO"), (505, "é É"), (None, rows[0][1]), (7, rows[3][1]), rows[5], (506, "a b c d e f"), (None, None)]
    got = [tuple(r) for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == brute_classes(rows)


def test_bound_is_the_least_of_its_sizes(spark):
    """For each n and each range of fitting sizes within a band, the bound is the least of least_shared."""
    import math

    def least(n, m):
        rest = max(-(-3 * n // 4), -(-3 * m // 4)) - 1
        return max(-(-3 * (n + m) // 7) - rest, 1)

    cases = []
    for n in range(1, 121):
        for lo in range(-(-3 * n // 4), 4 * n // 3 + 1):
            low = least(n, lo)
            for hi in range(lo, 4 * n // 3 + 1):
                if math.log(hi) // math.log(ngram_join.BAND) > math.log(lo) // math.log(ngram_join.BAND):
                    break
                low = min(low, least(n, hi))
                cases.append((n, lo, hi, low))
    df = spark.createDataFrame(cases, "n long, lo long, hi long, low long")
    assert df.filter(ngram_join.least_shared_within(df["n"], df["lo"], df["hi"]) != df["low"]).count() == 0


def test_link_to_a_size_inside_a_group(spark):
    """A query of 100 tokens is linked to a group's member of 103 only, which needs a shared token less than those of 102 and 104."""
    from shelfmark.llm.common import shingle_set

    def key(words):
        return ngram_join.set_key(shingle_set(" ".join(words), 1))

    # own tokens come first in the order; the group has both min-hash values of an own token, so that it is found as one
    order = sorted((f"w{i}" for i in range(4000)), key=lambda w: int(shingle_set(w, 1)[0]))
    shared = order[1000:1087]
    second = min(order[:1087], key=lambda w: int(shingle_set(w, 1)[0]) * 0xD6E8FEB86659FD93 % 2**64)
    assert second not in shared
    others = [w for w in order[:1000] if w != second]
    for at in range(0, 900, 30):
        own = others[at : at + 29]
        query, middle = own[:13] + shared, own[13:28] + [second] + shared
        less, more = middle[:-1], middle + own[28:]
        if key(query) > min(map(key, (less, middle, more))):
            rows = [(1, " ".join(less)), (2, " ".join(middle)), (3, " ".join(more)), (4, " ".join(query))]
            got = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(frame(spark, rows), 1).collect()}
            assert got == {1: 1, 2: 1, 3: 1, 4: 1}
            return
    raise AssertionError("no case was built")


def test_jaccard_classes_of_nothing(spark):
    assert ngram_join.jaccard_classes(frame(spark, [])).count() == 0
    assert [tuple(r) for r in ngram_join.jaccard_classes(frame(spark, [(1, None)])).collect()] == [(1, 0, 1)]


def test_keep_one_keeps_columns(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, "z"), (4, "g h i j k l m", "q")]
    out = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, k string"))
    assert out.columns == ["doc_id", "text", "k"] and sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_keep_one_of_null_and_repeated_ids(spark):
    """Each class keeps one row, whatever ids its rows share with other classes."""
    rng = random.Random(11)
    a, b, c, d, e, f = (" ".join(prose(rng, 40, 100_000)) for _ in range(6))
    rows = [(None, a), (None, b), (None, a + " z"), (1, c), (1, d), (2, c + " z"), (1, e), (0, e + " z"), (None, d), (3, f), (3, f), (None, None), (None, ""), (1, None), (1, " "), (None, f)]
    out = [tuple(r) for r in ngram_join.keep_one(frame(spark, rows)).collect()]
    null_a = [x for x in out if x[1] in (a, a + " z")]
    assert len(null_a) == 1
    expected = [(None, b), (1, c), (1, d), (0, e + " z"), (3, f), (None, None), (None, ""), (1, None), (1, " ")]
    assert sorted(out, key=str) == sorted(null_a + expected, key=str)


def test_keep_one_of_null_ids_without_copies(spark):
    rng = random.Random(12)
    a, b, c = (" ".join(prose(rng, 40, 100_000)) for _ in range(3))
    rows = [(None, a), (None, b), (4, b + " z"), (4, c)]
    out = [tuple(r) for r in ngram_join.keep_one(frame(spark, rows)).collect()]
    assert sorted(out, key=str) == sorted([(None, a), (4, b + " z"), (4, c)], key=str)


def test_components(spark, tmp_path):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (4, 6), (3, 1)] + [(100 + i, 101 + i) for i in range(20)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "cc")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4} | {100 + i: 100 for i in range(21)}


def test_components_of_stars_take_one_round(spark, tmp_path):
    """Stars are what groups are; a round that changes nothing is the only one, and what it leaves is not read again to see that."""
    edges = spark.createDataFrame([(b, b % 3) for b in range(3, 60)], "a long, b long")
    got = dict(tuple(r) for r in components(edges, str(tmp_path / "cc")).collect())
    assert got == {i: i % 3 for i in range(60)}
    assert not (tmp_path / "cc" / "cc2").exists()


def brute_lines(rows, min_words):
    docs = sorted({(i if i is not None else -1, t or "") for i, t in rows})
    lines = [[x.strip() for x in t.split("\n") if x.strip()] for _, t in docs]
    seen = {}
    for d, own in enumerate(lines):
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if sum(len(x.split()) for x in own[a:b]) >= min_words:
                    seen.setdefault(tuple(own[a:b]), []).append((d, a))
    gone = [set() for _ in docs]
    for run, places in seen.items():
        first = min(places)
        for d, a in places:
            if (d, a) != first and (d != first[0] or a >= first[1] + len(run)):
                gone[d].update(range(a, a + len(run)))
    return {docs[d]: gone[d] for d in range(len(docs))}


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(prose(rng, rng.choice([1, 3, 7]))) for _ in range(30)]
    runs = [[rng.choice(pool) for _ in range(rng.choice([2, 4, 9]))] for _ in range(5)]
    rows = []
    for i in range(25):
        own = []
        for _ in range(rng.randrange(1, 5)):
            own += rng.choice(runs) if rng.random() < 0.6 else [" ".join(prose(rng, 8)), ""]
        rows.append((i, "\n".join(own)))
    rows += [(30, None), (31, ""), (32, "\n\n"), (None, rows[0][1]), (33, "\n".join(["same line here"] * 12)), rows[2]]
    expected = brute_lines(rows, 10)
    got = line_dedup.dedup_lines(frame(spark, rows), min_words=10).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in got:
        key = (r.doc_id if r.doc_id is not None else -1)
        text = [t or "" for i, t in rows if i == r.doc_id][0]
        drop = expected[key, text]
        assert r.n_deleted == len(drop) and (r.deleted or "") == ",".join(map(str, sorted(drop))), r
        kept, seq = [], 0
        for line in text.split("\n"):
            if not line.strip() or seq not in drop:
                kept.append(line)
            seq += bool(line.strip())
        assert (r.text or "") == "\n".join(kept)
        texts[r.doc_id] = r.text
    assert texts[30] is None


def test_line_dedup_clashing_names_and_nothing(spark):
    run = "\n".join(["five words are in here"] * 1 + ["and another five words here"])
    df = spark.createDataFrame([(1, run, "a", 5), (2, run, "b", 6)], "doc_id long, text string, seqs string, th int")
    out = line_dedup.dedup_lines(df, min_words=10).collect()
    assert sorted((r.doc_id, r.text, r.seqs, r.th) for r in out) == [(1, run, "a", 5), (2, "", "b", 6)]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_a_hub_of_many_near_copies(spark):
    """More near copies of one text than a part verifies, none alike enough but through it; exact copies and a very long text beside them."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 2 * ngram_join.PAIRS_A_PART + 200):
        words = list(base)
        words[6 + i % 48] = f"x{i}"
        rows.append((i, " ".join(words)))
    long = " ".join(f"v{rng.randrange(10**6)}" for _ in range(60_000))
    rows += [(9000, long), (9001, long), (9002, long + " end"), (9003, "other words here"), (None, rows[5][1])]
    got = [tuple(r) for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    assert {c for i, _, c in got if i is None or i < 9000} == {0} and {i: c for i, _, c in got if i and i >= 9000} == {9000: 9000, 9001: 9000, 9002: 9000, 9003: 9003}


@pytest.mark.parametrize("alone", [True, False])
def test_sets_compared_each_with_each(alone, monkeypatch):
    """Alike sets that aren't linked are one group, so that their pairs are no rows of a join."""
    monkeypatch.setattr(ngram_join, "TABLE", 64)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.unique(np.append(base[:keep], rng.integers(0, 2**63, 100 - keep).astype(np.uint64))) for keep in (100, 90, 60, 62, 88, 55)]
    sets += [np.unique(rng.integers(0, 2**63, 40).astype(np.uint64)) for _ in range(2)]
    sets.append(sets[-1][:36])
    both = ngram_join.common_tokens(sets)
    assert both.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    keys = [900, 7, 30, 31, 2, 40, 50, 60, 61]
    g, c, pure = ngram_join.told_apart(keys, sets, alone)
    linked = {(a, b) for i, a in enumerate(keys) for j, b in enumerate(keys) if 100 * both[i, j] >= 75 * (len(sets[i]) + len(sets[j]) - both[i, j])}
    assert {(900, 7), (900, 2), (60, 61)} <= linked and (900, 30) not in linked
    assert all(of == c[keys.index(b)] for a, of in zip(keys, c.tolist(), strict=True) for b in keys if (a, b) in linked)
    assert g.tolist() == ([900] * 6 if alone else [900, 900, 30, 30, 900, 30]) + [50, 60, 60]
    assert pure.tolist() == [len({b for b, h in zip(c.tolist(), g, strict=True) if h == of}) == 1 for of in g]


@pytest.mark.parametrize("words", [1, 8])
def test_bits_lose_no_link(spark, monkeypatch, words):
    """Variants, linked or only alike, too many for one part: the classes are right with many bits and with few."""
    monkeypatch.setattr(ngram_join, "BITS", ngram_join.BITS[:words])
    monkeypatch.setattr(ngram_join, "PAIRS_A_PART", 2)
    rng, rows = random.Random(11), []
    for f in range(4):
        base = prose(rng, 120, 10**6)
        for _ in range(14):
            own = list(base)
            for at in rng.sample(range(0, 120, 6), rng.choice([2, 4, 8, 8, 8])):
                own[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    got = [tuple(r) for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == brute_classes(rows)


def test_bound_by_bits_is_a_bound(spark):
    """``bits_allow`` is never against a set that a group's bits hold and that qualifies."""
    rng, rows = random.Random(23), []
    for _ in range(400):
        base = [rng.randrange(10**9) for _ in range(rng.randrange(4, 120))]
        group = [{*rng.sample(base, len(base) - rng.randrange(min(len(base) - 2, 12))), *(rng.randrange(10**9) for _ in range(rng.randrange(8)))} for _ in range(rng.randrange(1, 5))]
        own = {*base, *(rng.randrange(10**9) for _ in range(rng.randrange(20)))}
        bits = [sum(1 << b for b in {t % 63 for t in s}) for s in (own, *group)]
        some, every = bits[1], bits[1]
        for b in bits[2:]:
            some, every = some | b, every & b
        good = any(100 * len(own & m) >= 75 * len(own | m) for m in group)
        lo, hi = max(min(map(len, group)), -(-len(own) * 3 // 4)), min(max(map(len, group)), len(own) * 4 // 3)
        rows.append((len(own), bits[0], lo, hi, some, every, good))
    df = spark.createDataFrame(rows, "n long, own long, lo long, hi long, some long, every long, good boolean")
    from pyspark.sql import functions as F

    df = df.withColumn("may", (F.col("lo") <= F.col("hi")) & ngram_join.bits_allow(F.col("n"), [F.col("own")], F.col("lo"), F.col("hi"), [F.col("some")], [F.col("every")]))
    assert df.filter("good").count() > 50 and df.filter("good and not may").count() == 0
    assert df.filter("not may").count() > 0


def test_groups_in_parts_and_unions_in_cells(spark, monkeypatch):
    """Groups of several parts, and unions of several cells, that many strays ask; with few bits most of them are opened."""
    monkeypatch.setattr(ngram_join, "BITS", ngram_join.BITS[:1])
    monkeypatch.setattr(ngram_join, "CELL", 5)
    monkeypatch.setattr(ngram_join, "PAIRS_A_PART", 4)
    rng, rows = random.Random(41), []
    for _ in range(4):
        base = prose(rng, 70, 10**6)
        for _ in range(24):
            words = list(base)
            for i in rng.sample(range(len(words)), rng.randrange(4)):
                words[i] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words[: rng.randrange(45, 71)])))
    got = [tuple(r) for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == brute_classes(rows)

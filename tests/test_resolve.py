"""Names of any length are resolved."""

from shelfmark.operators import resolve

LONG = "Verein der Freunde alter Orgeln und Harmonien"  # 7 words


def dictionary(spark):
    makers = spark.createDataFrame([(1, LONG), (2, "Verein"), (3, "Orgel")], "id long, canonical_name string")
    return resolve.name_dictionary(makers, spark.createDataFrame([], "maker_id long, name string"), ("canonical", "history"))


def test_titles_begin_with_long_names(spark):
    titles = spark.createDataFrame([(1, LONG + " TB-3"), (2, "Verein der Freunde"), (3, "other"), (4, ""), (5, None)], "id long, title string")
    assert sorted(map(tuple, resolve.match_title(titles, "title", dictionary(spark), "id").collect())) == [(1, 1, 7), (2, 2, 1)]
    none = dictionary(spark).limit(0)
    assert resolve.match_title(titles, "title", none, "id").count() == 0 and resolve.contained_name(titles, "title", none, "id").count() == 0


def test_long_names_within_names(spark):
    names = spark.createDataFrame([(1, f"The {LONG} Inc"), (2, LONG), (3, "ABC Orgel"), (4, ""), (5, None)], "id long, name string")
    got = {r.id: r.maker_id for r in resolve.contained_name(names, "name", dictionary(spark), "id").collect()}
    assert got == {1: 1, 2: 2, 3: 3}


def test_variants_of_long_names(spark):
    names = spark.createDataFrame([(1, LONG.rsplit(" ", 1)[0]), (2, "verein"), (3, LONG)], "id long, name string")
    assert {r.id: r.variants for r in resolve.name_variants(names, "name", dictionary(spark), "id").collect()} == {1: LONG, 2: LONG}


def test_every_variant_is_listed(spark):
    known = [f"Verein Nr {i:03}" for i in range(120)]
    makers = spark.createDataFrame(list(enumerate(known)), "id long, canonical_name string")
    names = spark.createDataFrame([(1, "Verein"), (2, "verein nr"), (3, "Verein Nr 1"), (1, "VEREIN"), (4, None)], "id long, name string")
    dictionary = resolve.name_dictionary(makers, spark.createDataFrame([], "maker_id long, name string"), ("canonical", "history"))
    got = {r.id: (r.n, r.variants) for r in resolve.name_variants(names, "name", dictionary, "id").collect()}
    assert got == {1: (120, " | ".join(known)), 2: (120, " | ".join(known))}


def test_long_product_keys_in_labels(spark):
    products = spark.createDataFrame([(1, 1, "Polyphonic Ensemble Orchestra 5000"), (2, 1, "Polyphonic"), (3, 1, "X5"), (4, 2, "Polyphonic Ensemble")], "id long, maker_id long, name string")
    links = spark.createDataFrame([(1, 1, "Manual: Polyphonic Ensemble Orchestra 5000.pdf"), (2, 1, "Polyphonic Ensemble"), (3, 2, "The polyphonic ensemble"), (4, 1, "X5"), (5, 9, "Polyphonic"), (6, 1, None)], "id long, maker_id long, label string")
    assert sorted(map(tuple, resolve.match_contained(links, products).collect())) == [(1, 1), (2, 2), (3, 4)]


def test_known_names_of_any_length(spark):
    makers = spark.createDataFrame([(1, "VP"), (2, "Korg"), (3, "Moog Music"), (4, "日本")], "id long, canonical_name string")
    known = resolve.name_dictionary(makers, spark.createDataFrame([], "maker_id long, name string"))
    asked = ["v.p.", "vp1", "ko", "kor", "korg inc", "moog", "moogmusicinc", "?!", None, "oog"]
    names = spark.createDataFrame(list(enumerate(asked)), "id long, name string")
    assert {r.id for r in resolve.is_known_prefix(names, "name", known, "id").collect()} == {0, 3, 4, 5, 6, 7, 8}


def test_unique_prefix_counts_keys(spark):
    makers = spark.createDataFrame([(1, "Kurzweil Music Systems"), (2, "Roland DG"), (3, "Acme Organs")], "id long, canonical_name string")
    names = spark.createDataFrame([(2, "Roland Europe")], "maker_id long, name string")
    known = resolve.name_dictionary(makers, names)
    asked = spark.createDataFrame([(1, "Kurzweil"), (2, "Roland"), (3, "Acm"), (4, "acme organs"), (5, None)], "id long, name string")
    assert {r.id: (r.maker_id, r.match_kind) for r in resolve.resolve_unique_prefix(asked, "name", known).collect()} == {1: (1, "prefix"), 2: (None, None), 3: (None, None), 4: (3, "exact"), 5: (None, None)}


def test_every_tag_is_cut_off_the_title(spark):
    makers = spark.createDataFrame([(1, "Acme"), (2, "Beta (x)")], "id long, canonical_name string")
    known = resolve.name_dictionary(makers, spark.createDataFrame([], "maker_id long, name string"))
    posts = spark.createDataFrame([(1, "Label  ACME TB-3", ["Label", "acme"]), (2, "beta (x) Acme 1", ["Beta (x)", "Acme", None]), (3, "Acmetron 1", ["Acme"]), (4, "Acme", ["Acme"]), (5, "x", ["none"]), (6, "x", None)], "post_id long, title string, tags array<string>")
    got = {r.post_id: (r.maker_id, r.model) for r in resolve.brand_from_tags(posts.selectExpr("*", "array('news') as categories"), known).collect()}
    assert got == {1: (1, "TB-3"), 2: (2, "1"), 3: (1, "Acmetron 1"), 4: (1, "Acme")}

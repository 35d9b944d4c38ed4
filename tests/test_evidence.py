import json

from shelfmark.operators import audit, evidence, reports, resolve, taxonomy
from shelfmark.sources import readers


def test_confidence_and_roll_up(spark):
    rows = [(1, "country", "Japan.", "u1", "other"), (1, "country", " japan", "u2", "other"), (1, "status", "active", "u1", "other"), (1, "status", "defunct", "u2", "other"), (2, "status", "x", "u", "manufacturer_official"), (2, "short_history", "a", "u1", "other"), (2, "short_history", "b", "u2", "other")]
    claims = spark.createDataFrame(rows, "entity_id int, field_name string, value string, source_url string, source_tier string")
    got = {(r.entity_id, r.field_name): r.confirmed for r in evidence.field_confidence(claims).collect()}
    assert got == {(1, "country"): True, (1, "status"): False, (2, "status"): True, (2, "short_history"): True}
    entries = spark.createDataFrame([(1, "Japan", "active", None, []), (2, None, "x", "a", []), (3, None, None, None, ["c"])], "entity_id int, country string, status string, short_history string, conflicts array<string>")
    out = {r.entity_id: (r.confidence, r.reasons) for r in evidence.roll_up(entries, claims).collect()}
    assert out == {1: ("needs_review", "status not confirmed"), 2: ("confirmed", ""), 3: ("needs_review", "c")}


def test_merge_keeps_confidence_without_sources(spark):
    makers = spark.createDataFrame([("A", "confirmed", "Japan"), ("B", "confirmed", None), ("C", "unresearched", None)], "canonical_name string, confidence string, country string")
    entries = spark.createDataFrame([("A", "", "needs_review", 0, 0), ("B", "Italy", "needs_review", 2, 1), ("D", "USA", "confirmed", 1, 0)], "canonical_name string, country string, confidence string, n_sources int, n_conflicts int")
    got = {r.canonical_name: (r.confidence, r.country, r.change) for r in evidence.merge_makers(makers, entries, ["country"]).collect()}
    assert got == {"A": ("confirmed", "Japan", "merged"), "B": ("needs_review", "Italy", "merged"), "C": ("unresearched", None, "kept"), "D": ("confirmed", "USA", "inserted")}
    log = spark.createDataFrame([("B", "owner_confirmed")], "canonical_name string, action string")
    got = {r.canonical_name: r.confidence for r in evidence.merge_makers(makers, entries, ["country"], log=log).collect()}
    assert got["B"] == "confirmed"


def test_append_new_is_idempotent(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, "x", "c")], "id int, k string, v string")
    once = evidence.append_new(df, df.limit(0), ["id", "k"])
    assert sorted((r.id, r.k, r.v) for r in once.collect()) == [(1, None, "a"), (2, "x", "c")]
    assert evidence.append_new(df, once, ["id", "k"]).count() == 0


def test_technology_rule(spark):
    specs = spark.createDataFrame([(1, "oscillators", "2 DCOs"), (2, "oscillators", "Digital FM with 6 Operators"), (3, "oscillators", "3 VCOs"), (3, "waveforms", "ROM waves"), (4, "oscillators", "3 VCOs"), (5, "oscillators", "digital and VCO")], "product_id int, field string, value string")
    from pyspark.sql import functions as F

    products = spark.createDataFrame([(i, "unknown") for i in range(1, 6)], "id int, technology string")
    facts = evidence.derive_technology(specs.withColumn("source_url", F.lit("u")), products)
    assert {r.entity_id: r.value for r in facts.collect()} == {2: "digital", 4: "analog"}
    claims = spark.createDataFrame([], "entity_id int, field_name string, derived_from string")
    filled, rows = evidence.apply_facts(products, facts, claims, ["technology"])
    assert {r.id: r.technology for r in filled.collect()} == {1: "unknown", 2: "digital", 3: "unknown", 4: "analog", 5: "unknown"}
    assert evidence.apply_facts(filled, facts, rows, ["technology"])[1].count() == 0


def test_queue_and_stubs(spark):
    queue = spark.createDataFrame([(1, "Old Co", "found"), (2, "New Co", "found"), (3, "Done", "done")], "id int, name string, status string")
    entries = spark.createDataFrame([(["none", "old co", "New Co"], "confirmed"), (["Done"], "confirmed")], "names array<string>, confidence string")
    assert {r.id: r.status for r in evidence.close_queue(queue, entries).collect()} == {1: "done", 2: "found", 3: "done"}
    makers = spark.createDataFrame([(1, "Known")], "id int, canonical_name string")
    stubs, rows = evidence.make_stubs(spark.createDataFrame([("known",), ("Other ",), ("old co",), (None,)], "related string"), makers, queue)
    assert sorted(r.canonical_name for r in stubs.collect()) == ["Other", "old co"] and [r.name for r in rows.collect()] == ["Other"]


def test_posts_cross_reference(spark):
    makers = spark.createDataFrame([(1, "Roland"), (2, "Korg")], "id long, canonical_name string")
    d = resolve.name_dictionary(makers, spark.createDataFrame([], "maker_id long, name string"), ("canonical",))
    products = spark.createDataFrame([(10, 1, "TB-303"), (11, 1, "TB-3")], "id long, maker_id long, name string")
    posts = spark.createDataFrame([(1, ["Roland", "TB-3", "TB-303", "1982", "midi"]), (2, ["Roland", "Korg", "TB-3"])], "post_id int, labels array<string>")
    assert [(r.post_id, r.product_id, r.year) for r in resolve.match_posts(posts, products, d).collect()] == [(1, 10, 1982)]


def test_detach_dead_once(spark):
    rows = [(1, "X", "needs_review", "page is dead", "u"), (2, "Y (b)", "needs_review", "dead", "u"), (3, "Z", None, "dead", "u")]
    df = spark.createDataFrame(rows, "id int, name string, review_status string, review_note string, source_url string")
    once = audit.detach_dead(df, "2024-01-01")
    got = {r.id: (r.source_url, r.review_note) for r in once.collect()}
    assert got[1][0] is None and "variant" not in got[1][1] and "variant" in got[2][1] and got[3] == ("u", "dead")
    assert sorted(audit.detach_dead(once, "2024-01-02").collect()) == sorted(once.collect())


def test_identify(spark):
    makers = spark.createDataFrame([(1, "Linn", "https://linn.co.uk/"), (2, "Waldorf", None), (3, "None", None)], "maker_id int, name string, official_website string")
    rows = [(1, 1, "Q1", "Linnaeus University", [], ["univ"], [], []), (1, 2, "Q2", "Linn Products", [], ["x"], [], ["http://www.linn.co.uk/about"]), (2, 1, "Q3", "Waldorf", [], ["school"], [], []), (2, 2, "Q4", "Waldorf Music", ["Waldorf"], ["company"], [], [])]
    c = spark.createDataFrame(rows, "maker_id int, rank int, qid string, label string, aliases array<string>, types array<string>, industry array<string>, websites array<string>")
    got = {r.maker_id: (r.qid, r.reason) for r in resolve.identify(makers, c, ["univ"], ["company"]).collect()}
    assert got == {1: ("Q2", "website"), 2: ("Q4", "name and type"), 3: (None, "no candidate")}


def test_readers(spark, tmp_path):
    batch = {"manufacturers": [{"canonical_name": "A", "instruments": ["One", {"name": "Two", "year": 1980}], "conflicts": ["c"]}, {"canonical_name": " "}]}
    (tmp_path / "b.json").write_text(json.dumps(batch))
    r = readers.read_batches(spark, str(tmp_path / "b.json")).collect()
    assert len(r) == 1 and [(i.name, i.year) for i in r[0].instruments] == [("One", None), ("Two", 1980)]
    pages = {"source": "s", "pages": [{"source_url": "u", "model_slug": "m", "specs": {"Keys": "61"}}, {"model_slug": "", "specs": {"a": "b"}}, {"model_slug": "n", "specs": {}}]}
    (tmp_path / "p.json").write_text(json.dumps(pages))
    assert [x.source_url for x in readers.read_page_batches(spark, str(tmp_path / "p.json")).collect()] == ["u"]
    (tmp_path / "c.json").write_text(json.dumps({"manufacturer": "m", "text": "No such synth"}))
    assert readers.read_page_cache(spark, str(tmp_path / "c.json")).first().dead
    docs = [("x", "x/sitemap.xml", "<sitemapindex><loc>x/a.xml</loc><loc>x/b.xml</loc></sitemapindex>"), ("x", "x/a.xml", "<urlset><loc> x/1 </loc></urlset>"), ("x", "x/b.xml", "<loc>x/2</loc>"), ("y", "y/s.xml", "<loc>y/1</loc>")]
    df = spark.createDataFrame(docs, "domain string, url string, body string")
    assert sorted(r.url for r in readers.sitemap_urls(df).collect()) == ["x/1", "x/2", "y/1"]
    assert sorted(r.url for r in readers.sitemap_urls(df, include="a.xml").collect()) == ["x/1", "y/1"]
    feed = {"feed": {"entry": [{"title": {"$t": "T"}, "summary": {"$t": "<b>S</b>"}, "published": {"$t": "2020"}, "category": [{"term": "Korg"}], "link": [{"rel": "self", "href": "a"}, {"rel": "alternate", "href": "b"}]}]}}
    f = readers.flatten_feed(spark.createDataFrame([(json.dumps(feed),)], "body string")).first()
    assert (f.title, f.summary, f.labels, f.url) == ("T", "S", ["Korg"], "b")
    sparql = {"results": {"bindings": [{"item": {"value": "http://w/Q5"}, "itemLabel": {"value": "X"}, "date": {"value": "1984-01-01"}}, {"item": {"value": "http://w/Q6"}, "itemLabel": {"value": "Q6"}}]}}
    s = readers.flatten_bindings(spark.createDataFrame([(json.dumps(sparql),)], "body string")).collect()
    assert [(x.label, x.qid, x.year) for x in s] == [("X", "Q5", 1984)]
    html = "<a href='a.pdf'>a</a><a href='../'>up</a><a href='d/'>d</a><a href='/x'>x</a>"
    assert sorted((r.entry, r.kind) for r in readers.listing_entries(spark.createDataFrame([(1, html)], "id int, html string"), "id").collect()) == [("a.pdf", "file"), ("d/", "dir")]


def test_toggles_and_logs(spark):
    makers = spark.createDataFrame([(1, "confirmed"), (2, "unresearched"), (3, "needs_review")], "id long, confidence string")
    actions = spark.createDataFrame([(i, m, "approve", f"t{i}") for i, m in enumerate([1, 1, 1, 2, 3, 3])], "id long, maker_id long, action string, created_at string")
    assert {r.id: r.confidence for r in reports.toggled(actions, makers).collect()} == {1: "needs_review", 2: "unresearched", 3: "needs_review"}
    log = {r.id: (r.previous_confidence, r.new_confidence) for r in reports.toggle_log(actions, makers).collect()}
    assert log[0] == ("confirmed", "needs_review") and log[1] == ("needs_review", "confirmed") and log[3] == ("unresearched", "unresearched")


def test_categories(spark):
    c = spark.createDataFrame([(1, "a", "f", "g"), (2, "b", "f", "g")], "id long, name string, form string, function string")
    m = spark.createDataFrame([(10, 1, 1), (10, 2, 0), (11, 1, 1)], "product_id long, category_id long, is_primary int")
    left, moved = taxonomy.merge_category(c, m, 1, 2)
    assert left.count() == 1 and sorted((r.product_id, r.category_id, r.is_primary) for r in moved.collect()) == [(10, 2, 0), (11, 2, 1)]
    assert sorted(r.name for r in taxonomy.rename_category(c, "a", "b").collect()) == ["a", "b"]
    assert sorted(r.name for r in taxonomy.rename_category(c, "a", "z").collect()) == ["b", "z"]


def test_empty_tables(spark):
    claims = spark.createDataFrame([], "entity_id int, field_name string, value string, source_url string, source_tier string, id long, fetched_at timestamp")
    assert evidence.field_confidence(claims).count() == evidence.conflicts(claims).count() == evidence.best_value(claims).count() == 0


def test_the_text_zero_is_a_value(spark):
    from shelfmark.functions.keys import first_by, is_blank, nulls_last

    rows = spark.createDataFrame([(1, "0", 0, 0.0), (2, " ", 1, 0.5), (3, None, None, None)], "id long, s string, i int, d double")
    got = {r.id: tuple(r)[1:] for r in rows.select("id", is_blank("s"), is_blank("i"), is_blank("d")).collect()}
    assert got == {1: (False, True, True), 2: (True, False, False), 3: (True, True, True)}
    claims = spark.createDataFrame([(1, 7, "year", "0", "u1", "other", None), (2, 7, "year", "1", "u2", "other", None)], "id long, entity_id long, field_name string, value string, source_url string, source_tier string, fetched_at timestamp")
    assert [r.n_values for r in evidence.conflicts(claims).collect()] == [2] and [r.value for r in evidence.best_value(claims).collect()] == ["0"]
    once = first_by(spark.createDataFrame([(1, None, 5), (1, "b", 3), (1, "a", 9), (None, "z", 1)], "k int, v string, w int"), ["k"], *nulls_last("v"))
    assert sorted(map(tuple, once.collect()), key=str) == [(1, "a", 9), (None, "z", 1)]


def test_rule_registry(spark):
    makers = spark.createDataFrame([(1, None, "Rome"), (2, "Japan", "Rome"), (3, None, "Nowhere")], "id long, country string, city string")
    products = spark.createDataFrame([(10, "unknown"), (11, "digital")], "id long, technology string")
    specs = spark.createDataFrame([(10, "oscillators", "2 VCOs", "u"), (11, "oscillators", "2 VCOs", "u")], "product_id long, field string, value string, source_url string")
    gazetteer = spark.createDataFrame([("rome", "Italy")], "city string, country string")
    claims = spark.createDataFrame([], "entity_id long, field_name string, derived_from string")
    filled, added = evidence.run_rules({"makers": makers, "products": products, "specs": specs, "gazetteer": gazetteer}, claims)
    assert {r.id: r.country for r in filled["makers"].collect()} == {1: "Italy", 2: "Japan", 3: None}
    assert {r.id: r.technology for r in filled["products"].collect()} == {10: "analog", 11: "digital"}
    assert {(r.entity_id, r.field_name, r.value) for r in added.collect()} == {(1, "country", "Italy"), (10, "technology", "analog")}


def test_audit_sample_is_seeded_and_whole(spark):
    from shelfmark.operators import audit

    rows = spark.createDataFrame([(f"u{i}", f"d{i % 3}") for i in range(60)] + [("one", "small")], "url string, domain string")
    a, b = ({r.url for r in audit.audit_sample(rows.repartition(n), 5, 7).collect()} for n in (1, 4))
    assert a == b and len(a) == 16 and "one" in a and a != {r.url for r in audit.audit_sample(rows, 5, 8).collect()}

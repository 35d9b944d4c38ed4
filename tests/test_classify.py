from pyspark.sql import functions as F

from shelfmark.functions import classify, extract, keys
from shelfmark.operators import resolve


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def dictionary(spark, *names):
    makers = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, canonical_name string")
    return resolve.name_dictionary(makers, spark.createDataFrame([], "maker_id long, name string"), ("canonical", "history"))


def test_official(spark):
    def official(domain, name):
        return value(spark, classify.is_official(F.lit(domain), F.lit(name)))

    assert not official("moogarchives.com", "Moog Music")
    assert official("rolandus.com", "Roland Corporation")
    assert official("akaipro.com", "Akai Professional")
    assert official("moog.com", "Moog")


def test_product_urls(spark):
    urls = ["https://synthxl.com/waldorf-pulse/", "https://x.com/tag/waldorf-pulse", "https://x.com/index.php/waldorf/odyssey-1", "https://x.com/product.AP-270BN/", "https://x.com/products/p/cel-53/", "https://x.com/waldorf-announces-a-new-and-very-long-flagship", "https://x.com/", "https://x.com/page/2", "https://x.com/a.pdf"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.signal for r in classify.product_like(df, "url", dictionary(spark, "Waldorf"), "url").collect()}
    assert [got[u] for u in urls] == ["C:maker-slug", None, "B:maker-segment", "D:product-prefix", "A:path-marker", None, None, None, None]


def test_title_verdict(spark):
    def verdict(title, model="", label=""):
        return value(spark, classify.title_verdict(F.lit(model), F.lit(label), F.lit(title)))

    assert verdict("Analog Rytm &amp; more | Drum machine | Elektron") == "instrument"
    assert verdict("Vintage Drum Machines - X") == "undecided"
    assert verdict("Drum Spells - Sound Pack for Syntakt | X") == "not-instrument"
    assert verdict("Alesis Matica 500 Amplifier | SynthXL") == "not-instrument"
    assert verdict(None, "mm 16", "") == "undecided"


def test_scope_and_category(spark):
    assert value(spark, classify.scope_bucket(F.lit("Digital Studio Workstation"))) == "out"
    assert value(spark, classify.scope_bucket(F.lit("Synthesizer"))) == "in"
    assert value(spark, classify.scope_bucket(F.lit(""))) == "ask"
    assert value(spark, classify.title_category(F.lit("Pulse Drum Synthesizer | X piano"))) == "synthesizer"


def test_link_health(spark):
    rows = [("a", "HEAD", 200, None, None), ("b", "HEAD", 405, None, None), ("b", "GET", 200, "b/", None), ("c", "HEAD", 200, "d", None), ("e", "GET", None, None, "Name or service not known"), ("f", "HEAD", 403, None, None)]
    df = spark.createDataFrame(rows, "url string, method string, http_code int, final_url string, error string")
    assert {r.url: r.status for r in classify.link_health(df).collect()} == {"a": "live", "b": "live", "c": "redirected", "e": "dead", "f": "blocked"}


def test_brand(spark):
    def brand(url):
        r = value(spark, classify.brand_of(F.lit(url), F.lit("dokumente_vermona-schaltplaene"), ["Framus"], {"vermona-schaltplaene": "Vermona"}))
        return r.brand, r.reason

    assert brand("https://b.de/Archiv_Hans_Ohms/Klemt/a.pdf") == ("Klemt", "folder")
    assert brand("https://b.de/Archiv_Hans_Ohms/Klemt%20-%20Rim/a.pdf") == (None, "several brands")
    assert brand("https://b.de/x/framus_amp.pdf") == ("Framus", "file")
    assert brand("https://b.de/x/z.pdf") == ("Vermona", "section")


def test_funnel_and_labels(spark):
    d = dictionary(spark, "Korg")
    names = spark.createDataFrame([(n,) for n in ["Korg"] * 5 + ["Unknown"] * 5 + ["New One"] * 5 + ["Rare"] + ["Waits"] * 6], "name string")
    queue = spark.createDataFrame([("waits",)], "name string")
    got = {r.name: r.outcome for r in classify.discovery_funnel(names, d, queue).collect()}
    assert got == {"Korg": "known", "Unknown": "junk", "New One": "take", "Rare": "thin", "Waits": "queued"}
    labels = spark.createDataFrame([("Buchla (12)",), ("new in 2015 (9)",), ("x (1)",), ("Synth (3",)], "label string")
    assert [r.name for r in classify.label_candidates(labels, spark.createDataFrame([], "name string")).collect()] == ["Buchla"]


def test_extraction(spark):
    page = "<html><style>x{}</style><p>Produced:</p><p>1979 - mid</p><script>var a='<b>'</script><!-- c --><p>Technology:</p><p>Analog</p></html>"
    r = spark.createDataFrame([(page,)], "html string").select(extract.html_to_text("html").alias("t"))
    assert r.first().t == "Produced:\n1979 - mid\nTechnology:\nAnalog"
    specs = extract.read_specs(r.withColumnRenamed("t", "text")).first()
    assert (specs.year, specs.technology, specs.dead) == (1979, "analog", False)
    dead = extract.read_specs(spark.createDataFrame([("No such synth",), (None,)], "text string")).collect()
    assert [d.dead for d in dead] == [True, False]
    block = "x\nTECHNICAL SPECIFICATIONS\nKeys: 61\nRAM size:\n2 MB\nKeys: 49"
    rows = extract.spec_blocks(spark.createDataFrame([(1, block), (2, None)], "id int, text string"), "id").collect()
    assert [(x.id, x.field, x.value) for x in rows] == [(1, "keys", "61"), (1, "ram_size", "2 MB")]
    assert value(spark, extract.stated_year(F.lit("It was Introduced in 1984."))) == 1984
    assert value(spark, extract.label_year(F.lit("ad 1939 2150 1985 1983"), 2024)) == 1983
    assert value(spark, extract.resolve_href(F.lit("/a"), F.lit("https://x.com/b/c"))) == "https://x.com/a"
    assert value(spark, extract.resolve_href(F.lit("a"), F.lit("https://x.com/b/c"))) == "https://x.com/b/a"
    long = extract.specs_long(spark.createDataFrame([(1, {"Voice Count": " 8 ", "Empty": " "})], "id int, specs map<string,string>"), "id").collect()
    assert [(x.field, x.value) for x in long] == [("voice_count", "8")]
    assert value(spark, keys.is_blank(F.lit(0))) and value(spark, keys.is_blank(F.lit("  ")))


def test_more_extraction(spark):
    html = '<title>T</title><tbody><tr>' + "".join(f"<td>c{i}<a href='http://h/{i}'>x</a></td>" for i in range(7)) + "</tr><tr><td>short</td></tr></tbody>"
    r = extract.table_rows(spark.createDataFrame([(1, html)], "id int, html string"), "id").collect()
    assert len(r) == 1 and r[0].href == "http://h/1"
    post = '<title>P</title><a rel="tag" href="#">Korg</a><a rel="tag" href="#">1984</a><a rel="category" href="#">Synth</a><a href="x.mp3">s</a>'
    p = extract.post_taxonomy(spark.createDataFrame([(1, post)], "id int, html string"), "id").first()
    assert (p.title, p.categories, p.tags, p.year, p.audio) == ("P", ["Synth"], ["Korg"], 1984, ["x.mp3"])
    logo = '<img src="/logo.png" alt="logo"><meta property="og:image" content="https://x.com/logo2.png"><link rel="icon" href="i.svg">'
    rows = extract.logo_candidates(spark.createDataFrame([(1, "https://x.com/a/", logo)], "id int, url string, html string"), "id").collect()
    assert [x.logo for x in rows] == ["https://x.com/logo.png", "https://x.com/logo2.png", "https://x.com/a/i.svg"]
    pair = '<span class="term">Keys</span> <span class="value"><b>61</b></span>'
    assert [(x.label, x.value) for x in extract.page_spec_pairs(spark.createDataFrame([(1, pair)], "id int, html string"), "id").collect()] == [("Keys", "61")]

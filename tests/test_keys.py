from pyspark.sql import functions as F

from shelfmark.functions import keys


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_keys(spark):
    lit = F.lit
    assert value(spark, keys.norm(lit("E-mu Systems!"))) == "emusystems"
    assert value(spark, keys.norm(lit("東京"))) == ""
    assert value(spark, keys.spaced_key(lit(" Octave-Plateau  X "))) == "octave plateau x"
    assert value(spark, keys.value_key(lit("  New  York.. "))) == "new york"
    assert value(spark, keys.compare_key(lit("Oberheim Electronics, Inc."))) == "oberheim"
    assert value(spark, keys.compare_key(lit("Sound Company"))) == "sound company"
    assert value(spark, keys.domain_name_key(lit("E-mu Systems"))) == "emu"
    assert value(spark, keys.domain_name_key(lit("Roland Corporation"))) == "roland"
    assert value(spark, keys.domain_name_key(lit("東京"))) is None


def test_names_match(spark):
    def match(a, b):
        return value(spark, keys.names_match(F.lit(a), F.lit(b)))

    assert match("Waldorf", "Waldorf Music")
    assert match("Waldorf Music GmbH.", "waldorf")
    assert not match("Linn", "Linnaeus University")
    assert not match("", "")
    assert match("Music", "music")


def test_titles_and_slugs(spark):
    lit = F.lit
    assert value(spark, keys.clean_title(lit("Moog Music (company)"))) == "Moog Music"
    assert value(spark, keys.clean_title(lit("List of synths"))) is None
    assert value(spark, keys.clean_title(lit("x" * 130))) is None
    assert value(spark, keys.title_case_slug(lit("ds-2"))) == "DS-2"
    assert value(spark, keys.title_case_slug(lit("little-brother"))) == "Little Brother"
    assert value(spark, keys.title_case_slug(lit("MiniMoog"))) == "MiniMoog"
    assert value(spark, keys.tidy_model(lit("psr-e443"))) == "PSR-E443"
    assert value(spark, keys.tidy_model(lit("stage-custom-birch"))) == "Stage Custom Birch"
    assert value(spark, keys.collapse_variant(lit("PX-S1100BK"))) == value(spark, keys.collapse_variant(lit("PX-S1100WE"))) == "PX-S1100"
    assert value(spark, keys.base_name(lit("Pulse (rack)"))) == "Pulse"
    assert value(spark, keys.base_name(lit("Pulse"))) == ""


def test_domains(spark):
    lit = F.lit
    assert value(spark, keys.domain_of(lit("https://me@WWW.Roland.co.uk:80/x?y"))) == "roland.co.uk"
    assert value(spark, keys.domain_of(lit("not a url"))) == ""
    assert value(spark, keys.domain_label(lit("roland.co.uk"))) == "roland"
    assert value(spark, keys.domain_label(lit("emu.com"))) == "emu"
    assert value(spark, keys.host_suffixes(lit("a.b.c"))) == ["a.b.c", "b.c"]


def test_doc_model(spark):
    r = value(spark, keys.doc_model(F.lit("moog"), F.lit("Moog_Sonic_Six_SERVICE_MANUAL.pdf")))
    assert (r.model, r.doc_type) == ("Sonic Six", "Service Manual")
    r = value(spark, keys.doc_model(F.lit("arp"), F.lit("Odyssey.pdf")))
    assert (r.model, r.doc_type) == ("Odyssey", "Document")


def test_strip_maker_prefix(spark):
    df = spark.createDataFrame([(1, "Korg MS-20"), (1, "Korg x"), (1, "Korgan Z"), (2, "Korg MS-20")], "maker_id int, name string")
    aliases = spark.createDataFrame([(1, "Korg"), (1, "Ko"), (2, None)], "maker_id int, alias string")
    out = {(r.maker_id, r.name): r.model for r in keys.strip_maker_prefix(df, aliases).collect()}
    assert out == {(1, "Korg MS-20"): "MS-20", (1, "Korg x"): "Korg x", (1, "Korgan Z"): "Korgan Z", (2, "Korg MS-20"): "Korg MS-20"}

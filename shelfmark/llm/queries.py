"""The registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship
from . import alignment, conv_trie, decontam, flac, license_scan, line_dedup, ngram_join, piece_lattice, quality, token_counts, token_files, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per licence text found in a document: where, and how much of the template is there."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "n_hits")


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per leaked item of a document: how alike they are."""
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, deleted lines (count and numbers), and the MD5 of what is kept."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_deleted", "deleted", F.md5("text").alias("kept_md5"))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, as read back from the token files."""
    return token_files.read_files(*token_files.token_files(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, as read back from the normalised archives."""
    return warc.read_records(warc.archive(_table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: digests of its stored stream and of what that decodes to."""
    return flac.features(flac.stored(_table(spark, sf_dir, "documents")))


def op9_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.digests(piece_lattice.round_trips(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality.learn(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op12_conv_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per distinct beginning of the rebuilt conversations: members, children, leaves, savings."""
    return conv_trie.trie(conv_trie.paths(_table(spark, sf_dir, "conversations")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.links(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_decontam": op3_decontam,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_files": op5_token_files,
    "op6_token_counts": op6_token_counts,
    "op7_warc": op7_warc,
    "op8_flac": op8_flac,
    "op9_piece_lattice": op9_piece_lattice,
    "op10_ngram_join": op10_ngram_join,
    "op11_quality": op11_quality,
    "op12_conv_trie": op12_conv_trie,
    "op13_alignment": op13_alignment,
}

SQL: dict[str, str] = {
    "op7_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
        ), m AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lo FROM d
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM lo AND lo IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM lo THEN lo END AS refers_to
        FROM m
    """,
    "op4_line_dedup": r"""
        WITH raw AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents WHERE text <> ''
        ), numbered AS (
            SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS own, trim(line, ' ' || chr(9) || chr(13)) <> '' AS full_line FROM raw
        ), p AS (
            SELECT doc_id, no, own, row_number() OVER (PARTITION BY doc_id ORDER BY no) - 1 AS seq, len(string_split_regex(own, '\s+')) AS w FROM numbered WHERE full_line
        ), c AS (
            SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM p
        ), spans AS (
            SELECT a.doc_id, a.seq AS s, min(b.seq) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.seq BETWEEN a.seq AND a.seq + 49 AND b.upto - a.upto + a.w >= 50 GROUP BY 1, 2
            UNION SELECT b.doc_id, max(a.seq), b.seq FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.seq BETWEEN a.seq AND a.seq + 49 AND b.upto - a.upto + a.w >= 50 GROUP BY 1, b.seq
        ), runs AS (
            SELECT x.doc_id, x.s, x.e, string_agg(c.own, chr(10) ORDER BY c.seq) AS run FROM spans x JOIN c ON c.doc_id = x.doc_id AND c.seq BETWEEN x.s AND x.e GROUP BY 1, 2, 3
        ), firsts AS (
            SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(s) OVER o AS first_s FROM runs WINDOW o AS (PARTITION BY run ORDER BY doc_id, s)
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS seq FROM firsts WHERE doc_id <> first_doc OR s >= first_s + e - s + 1
        ), cut AS (
            SELECT doc_id, count(*) AS n, string_agg(seq, ',' ORDER BY seq) AS deleted FROM gone GROUP BY 1
        ), kept AS (
            SELECT n.doc_id, count(p.seq) AS n_lines, coalesce(string_agg(n.line, chr(10) ORDER BY n.no) FILTER (g.seq IS NULL), '') AS text
            FROM numbered n LEFT JOIN p ON p.doc_id = n.doc_id AND p.no = n.no LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.seq = p.seq GROUP BY 1
        )
        SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(cut.n, 0) AS n_deleted, cut.deleted, md5(coalesce(k.text, d.text)) AS kept_md5
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN cut ON cut.doc_id = d.doc_id
    """,
    "op10_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
        ), n AS (
            SELECT doc_id, len(sh) AS n FROM s
        ), t AS (
            SELECT doc_id, unnest(sh) AS g FROM s
        ), e AS (
            SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM t x JOIN t y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2) p
            JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.i >= 75 * (x.n + y.n - p.i)
        ), u AS (
            SELECT a, b FROM e UNION ALL SELECT b, a FROM e
        ), c(id, root) AS (
            SELECT doc_id, doc_id FROM n UNION SELECT u.b, c.root FROM c JOIN u ON u.a = c.id
        )
        SELECT n.doc_id, n.n AS n_shingles, min(c.root) AS component_id FROM n JOIN c ON c.id = n.doc_id GROUP BY 1, 2
    """,
    "op12_conv_trie": r"""
        WITH t AS (
            SELECT conv_id, turn, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
                   coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, h) AS turns FROM t GROUP BY 1
        ), c(crc) AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
                   lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS UBIGINT)) ELSE x // 2 END))
        ), hashed AS (
            SELECT conv_id, turns, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
                   lambda x, y: xor(x // 256, crc[CAST(xor(x, y) % 256 AS INT) + 1])), CAST(4294967295 AS UBIGINT)) % 6 AS INT) AS h FROM own, c
        ), rebuilt AS (
            SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
            FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
        ), member AS (
            SELECT conv_id, turns[1:d] AS way, d AS depth, d = len(turns) AS ends FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
        ), node AS (
            SELECT way, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(length(way[-1].text), 0) AS chars,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended FROM member GROUP BY way
        ), kids AS (
            SELECT way[:-2] AS way, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
        ), below AS (
            SELECT way[1:k] AS way, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
            FROM (SELECT n.*, kids.way IS NULL AS leaf, unnest(range(n.depth + 1)) AS k FROM node n LEFT JOIN kids ON kids.way = n.way) GROUP BY 1
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
               CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
        FROM node n LEFT JOIN node p ON n.depth > 0 AND p.way = n.way[:-2] LEFT JOIN kids k ON k.way = n.way JOIN below b ON b.way = n.way
    """,
}

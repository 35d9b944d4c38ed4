"""Trie, alignment and quality against brute force, explicit pairs and held-out labels."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shelfmark.llm import alignment, conv_trie, quality
from shelfmark.llm.token_files import BYTE_NAMES

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", " a ", "a  b\n\nc", "\n", "don't 12ab ''s x'\ny", "tab\tq\r\n", "日本 語。\U0001f600 é²", "x" * 300, "word, " * 50, "<|endoftext|> end", "▁ under", "a b c", "ı̇İ",
    "a \n b", "a\t b", "x  y", "<0x41> <s> </s>", "\x00 nul", "q\x1c z", "  \n\n  two", "a ▁", "ﬁ ½", "end ", "é", "long" * 20_000,
]


def nodes_of(rows):
    """All nodes by lists of conversations."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(int(c / 100) * 100, [])[:h] + v[h:])  # as SQL: -3 % 100 is -3
    members, kids, leaves, saved, out = {}, {}, {}, {}, []
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if k in kids else 1
        saved[k] = sum(saved[x] for x in kids.get(k, [])) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if rebuilt[c] == k)))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        df = df.selectExpr("*", "1 AS path", "2 AS chars", "'x' AS turns", "0 AS h")
    return sorted([tuple(r) for r in conv_trie.trie(conv_trie.paths(df)).collect()], key=str)


@pytest.mark.parametrize("shard,piece", [(200_000, 5_000), (1, 1), (25, 3)])
def test_trie_against_brute_force(spark, monkeypatch, shard, piece):
    """Whatever the shards: ties, null turns and texts, repeated rows, copies, a long conversation, missing bases."""
    monkeypatch.setattr(conv_trie, "SHARD_NODES", shard)
    monkeypatch.setattr(conv_trie, "PIECE_IDS", piece)
    rng, rows = random.Random(shard), []
    for c in [*range(0, 230), 1000, 1005, 2307, -3]:
        alike = rng.random() < 0.4
        for t in range(rng.choice([1, 2, 3, 5, 8]) if c != 17 else 60):
            rows.append((c, t, "u", "same") if alike else (c, t if rng.random() < 0.97 else None, rng.choice(["u", "a", None]), rng.choice(["x", "yy", None, "", "zé"])))
    rows += [(None, 1, "u", "x"), rows[0]]
    assert trie_rows(spark, rows, extra=True) == nodes_of(rows)


def test_trie_of_little(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(7, 0, "u", "x")]) == nodes_of([(7, 0, "u", "x")])
    deep = [(3, t, "u", "word" * 1000) for t in range(3000)]
    assert trie_rows(spark, deep) == nodes_of(deep)


def test_find_close_against_a_stack():
    rng = random.Random(3)
    for n in (1, 2, 40, 3000):
        bits, depth, left = [1], 1, n - 1
        while depth:
            if left and (depth == 1 or rng.random() < 0.55):
                bits.append(1)
                depth, left = depth + 1, left - 1
            else:
                bits.append(0)
                depth -= 1
                if not depth and left:
                    left = 0
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        tree = conv_trie.Parentheses(np.array(bits, np.uint8))
        got = tree.find_close(tree.opens)
        assert got.tolist() == [close[i] for i in tree.opens.tolist()]
        leaves = [sum(bits[k : k + 2] == [1, 0] for k in range(i, close[i])) for i in tree.opens.tolist()]
        assert tree.leaf_pairs(got).tolist() == leaves


def aligned(rows):
    """Groups and links from both libraries' ids of whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte = {BYTE_NAMES.get(b, chr(b)): b for b in range(256)}
    a_side, b_side = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_side.encode_special_tokens = True
    docs, held = [], Counter()
    for doc_id, text in rows:
        if not text:
            docs.append((doc_id, [], [], [], []))
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False), b_side.encode(text)
        a_bytes = [bytes(byte[c] for c in x) for x in a.tokens]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_side.id_to_piece(i)]]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            docs.append((doc_id, [], [], [], []))
            continue
        over_a, over_b = ([k for k, x in enumerate(side) for _ in x] for side in (a_bytes, b_bytes))
        links = sorted(set(zip(over_a, over_b, strict=True)))
        groups, end_a, end_b = [], -1, -1
        for k in range(len(over_a)):
            if k + 1 == len(over_a) or over_a[k] != over_a[k + 1] and over_b[k] != over_b[k + 1]:
                groups.append((a.ids[end_a + 1 : over_a[k] + 1], b[end_b + 1 : over_b[k] + 1]))
                end_a, end_b = over_a[k], over_b[k]
        links = [(a.ids[x], b[y]) for x, y in links]
        held.update(set(links))
        docs.append((doc_id, a.ids, b, groups, links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    text = lambda g: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
    return sorted([(d, len(a), len(b), len(g), len(k), sum(held[p] == best[p[0]] for p in k), sum(held[p] for p in k), hashlib.sha256(text(g).encode()).hexdigest() if a else "") for d, a, b, g, k in docs], key=str)


@pytest.mark.parametrize("pairs,cache", [(400_000, 500_000), (50, 100)])
def test_alignment_against_brute_force(spark, monkeypatch, pairs, cache):
    monkeypatch.setattr(alignment, "CHUNK_PAIRS", pairs)
    monkeypatch.setattr(alignment, "CACHE_UNITS", cache)
    rng = random.Random(5)
    signs = ["a", "b", "the", " ", " ", "\n", "\t", "é", "日", " ", "\x1c", ".", "'s", "1", "▁", "İ", "<s>", "​"]
    rows = list(enumerate(ODD + ODD[:3])) + [(1000 + i, "".join(rng.choice(signs) for _ in range(rng.randrange(1, 30)))) for i in range(1500)]
    rows += [(None, "some text"), rows[3], (1, "and again, of the same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chunk", "2 AS pairs", "'x' AS rows")
    assert sorted([tuple(r) for r in alignment.links(df, BPE, PIECES).collect()], key=str) == aligned(rows)


def test_alignment_of_nothing(spark):
    assert alignment.links(spark.createDataFrame([], "doc_id long, text string"), BPE, PIECES).count() == 0


def test_what_a_worker_remembers_has_a_bound_in_bytes(monkeypatch):
    """Long units of which each is met once: their bytes are forgotten, common units stay, and results don't change."""
    monkeypatch.setattr(alignment, "CACHE_BYTES", 200_000, raising=False)
    monkeypatch.setattr(alignment, "BYTES_AT_ONCE", 20_000, raising=False)
    monkeypatch.setattr(alignment, "UNITS_AT_ONCE", 7, raising=False)
    rng = random.Random(11)
    rows = list(enumerate(ODD[:-1])) + [(1000 + i, "the words and " + "".join(rng.choice("abcdé日▁1") for _ in range(rng.randrange(3000))).replace("▁", "▁" * (i % 7 == 0)) + " of the end") for i in range(400)]
    known, chunk, most = alignment.Units(alignment.Tokenizers(BPE, PIECES)), alignment._Chunk(), 0
    for i, n in alignment.portions(pa.array([t for _, t in rows], pa.string())):
        assert n == 1 or sum(len((t or "").encode()) for _, t in rows[i : i + n]) <= 20_000
        chunk.add([d for d, _ in rows[i : i + n]], known.numbers([t for _, t in rows[i : i + n]]), known)
        most = max(most, sum(len(u) + (len(known.text[k]) if k >= 0 else 0) for u, k in known.items()))
    assert most < 400_000 and len(" ".join(t or "" for _, t in rows)) > 500_000
    assert known[" the"] >= 0 and known[" and"] >= 0
    got = [(d, a, b, groups, links, sha) for d, a, b, groups, links, sha in chunk.docs]
    assert sorted(got, key=str) == sorted([(*r[:5], r[7]) for r in aligned(rows)], key=str)


def test_alignment_of_texts_without_tokens(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "▁"])], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.links(df, BPE, PIECES).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(3)]


def test_intervals_break_where_nothing_reaches_over():
    a_end, b_end = np.array([2, 5, 6]), np.array([3, 5, 6])
    a_start, b_start = np.array([0, 2, 5]), np.array([0, 3, 5])
    a, b = alignment.groups_of(a_end, b_end, np.concatenate([a_start, b_start]))
    assert a.tolist() == [0, 0, 1] and b.tolist() == [0, 0, 1]
    x, y = alignment.overlaps(a_start, a_end, b_start, b_end)
    assert list(zip(x.tolist(), y.tolist(), strict=True)) == [(0, 0), (1, 0), (1, 1), (2, 2)]


def test_machine_against_explicit_pairs():
    """The sum of squares is the sum over pairs; a step's slopes are those of small differences."""
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(40, 1 + quality.RANK))
    at = np.array([0, 3, 9, 10])
    rows = quality.Rows(at, np.concatenate([rng.choice(40, n, replace=False) for n in np.diff(at)]), rng.normal(size=10))
    z = quality.margins(rows, 0.3, weights)[0]
    for i in range(3):
        index, x = rows.index[at[i] : at[i + 1]], rows.value[at[i] : at[i + 1]]
        want = 0.3 + weights[index, 0] @ x + sum(weights[index[p], 1:] @ weights[index[q], 1:] * x[p] * x[q] for p in range(len(x)) for q in range(p))
        assert abs(z[i] - want) < 1e-9


def test_features_of_a_batch_are_those_of_each_text():
    texts = ["One two, two!!", "", None, "ÀÉ 12\nx\n", "  ", "w" * 5000 + " a b"]
    whole = quality.features(pa.array(texts), [pa.array([1.0, None, -4.0, 0.0, 7.0, 9e9])])
    for i, t in enumerate(texts):
        one = quality.features(pa.array([t]), [pa.array([1.0, None, -4.0, 0.0, 7.0, 9e9]).slice(i, 1)])
        s = slice(whole.at[i], whole.at[i + 1])
        assert one.index.tolist() == whole.index[s].tolist() and np.allclose(one.value, whole.value[s])


def test_quality_held_out(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        t = " ".join(rng.choice(words) for _ in range(rng.randrange(20, 60)))
        bad = i % 4 == 0
        t = (t.upper(), " | ".join(t.split()), " ".join(t.split()[:3] * 12))[i % 3] if bad else t
        rows.append((i, t, len(t)))
        labels.append((i, int(not bad), 0))
    rows += [(2000, None, None), (2001, "", 0), (None, "x y z", -1), rows[5]]
    labels += [(None, 1, 0), (2000, 7, 0), (2001, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "0 AS quality", "1 AS y", "'x' AS index", "'z' AS score_of")
    model = quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    of = dict((x[0], x[1]) for x in labels)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.predicted == of[r.doc_id] for r in held) / len(held) > 0.95


def test_quality_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a b"), (4, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(docs, quality.learn(docs, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.score(docs, quality.learn(docs, ones)).collect()} == {1}
    assert quality.score(docs.limit(0), quality.learn(docs.limit(0), ones)).count() == 0


def test_labels_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_LABELS", 50)
    docs = spark.createDataFrame([(i, "w" * i) for i in range(400)], "doc_id long, text string")
    n = quality.labelled(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")).count()
    assert 20 < n < 90

"""Licences, toxicity, decontamination, tokens and pieces against brute force or the libraries."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest

from shelfmark.llm import decontam, license_scan, piece_lattice, pieces, token_counts, token_files, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", " a ", "a  b\n\nc", "\n", "don't 12ab ''s x'\ny", "tab\tq\r\n", "日本 語。\U0001f600 é²", "x" * 300, "word, " * 50, "<|endoftext|> end", "▁ under", "a b c", "ı̇İ"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_patience():
    a, b = "the quick brown fox jumps".split(), "a quick and brown old fox jumps over".split()
    assert license_scan.patience(a, b) == [(1, 1), (2, 3), (3, 5), (4, 6)]
    assert license_scan.patience([], b) == [] and license_scan.patience(a, a) == [(i, i) for i in range(5)]
    assert license_scan.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)]) == [(1, 1), (2, 2), (4, 5)]


def test_licence_scan(spark):
    texts = ["Some words.\nReleased under the MIT License.\nmore", "licensed UNDER the Apache licence, License, Version 2.0; all rights reserved", None, "", "the license of the work is under version", "Released under the MIT License. x y z Released under the MIT License."]
    got = {}
    for r in license_scan.scan(frame(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert got == {0: ["MIT"], 1: ["Apache-2.0", "Proprietary"], 5: ["MIT", "MIT"]}
    long = license_scan.TEMPLATES["Apache-2.0/notice"].replace("may not", "must not")
    (hit,) = license_scan.Scanner(license_scan.TEMPLATES).scan("x " + long + " y")
    assert hit[0] == "Apache-2.0/notice" and 0.9 < hit[1] < 1
    assert license_scan.scan(frame(spark, [])).count() == 0


def common_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_patience_against_brute_force():
    """An alignment is common words in order; without unique words, or without common ones twice, it is a longest one."""
    rng = random.Random(11)
    for _ in range(400):
        a, b = ([rng.choice("abcdefghij"[: rng.randrange(2, 11)]) for _ in range(rng.randrange(0, 14))] for _ in range(2))
        pairs = license_scan.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
        assert len(license_scan.longest_common(a, b)) == common_length(a, b) >= len(pairs)
        if len(set(a)) == len(a) and len(set(b)) == len(b) or not any(a.count(x) == 1 == b.count(x) for x in a) and (a[:1] != b[:1] and a[-1:] != b[-1:]):
            assert len(pairs) == common_length(a, b)


def test_licences_against_brute_force(spark):
    """Each whole text is found under its id at its place, among other words, in long and repeated texts."""
    rng = random.Random(12)
    noise = ["".join(rng.choice("qxzkjv") for _ in range(5)) for _ in range(300)]
    rows, expected = [], []
    for n, (name, text) in enumerate(license_scan.TEMPLATES.items()):
        before = "İ " * (n % 3) + " ".join(rng.choice(noise) for _ in range(20 if n != 4 else 40_000)) + "\n"
        license_, _, kind = name.partition("/")
        rows.append((n, before + text.replace(". ", ".\n * ") + "\n" + " ".join(rng.choice(noise) for _ in range(10)), "x"))
        expected.append((n, license_, kind, 1.0, len(before)))
    rows += [rows[0], (None, rows[1][1], "y")]
    expected += [expected[0], (None, *expected[1][1:])]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()
    assert sorted([(r.doc_id, r.license, r.kind, r.coverage, r.start) for r in got], key=str) == sorted(expected, key=str)
    for r in got:
        text = rows[r.doc_id if r.doc_id is not None else 1][1]
        assert license_scan.words_of(text[r.start : r.end])[-1][0] == license_scan.words_of(license_scan.TEMPLATES[f"{r.license}/{r.kind}"])[-1][0]


def test_fold_and_hits():
    assert toxicity.fold("ID1OT 1d10t іdiot $tupid a$$ 19 1d10t5 cl0wn5 Ídiot 𝖎𝖉𝖎𝖔𝖙 ｉｄiot i\u200bdiot 10 @") == "idiot idiot idiot stupid ass 19 idiots clowns idiot idiot idiot idiot 10 @"
    model = toxicity.Model({"clown": 2.0, "idio*": 3.0, "idiotic": 4.0}, exceptions=("class clown",))
    found = toxicity.hits(model.automaton(), toxicity.fold("class clown, Clown! idiotic idiom xidiot clowns"))
    assert [w for _, _, w in found] == [2.0, 4.0, 3.0]
    assert toxicity.hits(toxicity.Model().automaton(), "x") == []
    text = "a big clown show, clown. idiots here"
    assert toxicity.phrases(text, toxicity.hits(model.automaton(), text)) == {"big clown", "clown show", "idiots here"}


def naive_hits(model, text):
    """Each start of a word, its longest entry, by trying all; none within an exception."""
    spans = [(i, i + len(p)) for p in model.exceptions for i in range(len(text)) if text.startswith(p, i) and not text[i - 1 : i].isalpha() and not text[i + len(p) : i + len(p) + 1].isalpha()]
    out = []
    for i in range(len(text)):
        if text[i - 1 : i].isalpha() and i:
            continue
        fits = []
        for entry, weight in model.weights.items():
            word = entry.rstrip("*")
            if text.startswith(word, i) and (entry.endswith("*") or not text[i + len(word) : i + len(word) + 1].isalpha()):
                fits.append((len(word), not entry.endswith("*"), weight))
        if fits:
            n, _, weight = max(fits)
            if not any(a <= i and i + n <= z for a, z in spans):
                out.append((i, i + n, weight))
    return out


def test_hits_against_a_naive_matcher():
    rng = random.Random(21)
    for _ in range(400):
        words = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) + rng.choice(["", "", "*"]): float(i) for i in range(rng.randrange(1, 8))}
        phrases = {" ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 3))) for _ in range(2)) for _ in range(2)}
        model = toxicity.Model(words, exceptions=tuple(phrases))
        text = "".join(rng.choice("aab b.1") for _ in range(rng.randrange(0, 60)))
        assert toxicity.hits(model.automaton(), text) == naive_hits(model, text), (words, phrases, text)


def test_toxicity_learns_exceptions(spark):
    """A word that clean documents have in one phrase only doesn't count there; repeated and very long texts are scored alike."""
    rng = random.Random(22)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(rng.choice("abcdef") for _ in range(6)) for _ in range(30)]
        if i % 3 == 0:
            words.insert(7, "vileword")
        elif i % 3 == 1 and i % 2:
            words.insert(9, "mild vileword")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0), 1))
    long = "word " * 100_000
    rows += [(2000, long + "vileword"), (2001, long), (2002, "mild vileword"), (2002, "mild vileword")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    assert "vileword" in model.weights and "mild vileword" in model.exceptions
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(900)) and got[2002].n_hits == got[2001].n_hits == 0 and got[2000].n_hits == 1


def test_toxicity_learns_from_its_rows_only(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(20, 60))]
        words = ["".join(chr(97 + int(c)) for c in w[1:]) + "x" for w in words]
        if toxic:
            words.insert(5, rng.choice(["vileword", "badthing"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic if zlib.crc32(str(i).encode()) % 4 != 2 else not toxic), 1))  # held-out labels are wrong
    rows += [(1000, None), (1001, ""), (None, "vileword now"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1, 1), (2000, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.learn(docs, labels)
    assert set(model.weights) == {"vileword", "badthing"}
    got = toxicity.score(docs.withColumnRenamed("doc_id", "row").selectExpr("row", "text", "row as doc_id"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) == int(any(w in (r.text or "") for w in ("vileword", "badthing")))


def test_toxicity_of_nothing(spark):
    docs = frame(spark, [])
    model = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert model.curve is None and [r.score for r in toxicity.score(frame(spark, ["x", None]), model).collect()] == [0.0, 0.0]


def test_decontamination(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(500)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, text(rng.randrange(16, 60)) + ".") for i in range(20)]
    docs, expected = [], set()
    for i in range(60):
        own = text(rng.randrange(80, 300)).split()
        if i % 3 == 0:
            item = items[i % 20]
            inside = item[1].split()
            if i % 2:
                for j in range(0, len(inside), 8):
                    inside[j] = "other"
            at = rng.randrange(len(own))
            own[at:at] = inside
            expected.add((i, item[0]))
        docs.append((i, " ".join(own)))
    docs += [(900, None), (901, "..."), (None, items[3][1])]
    bench = spark.createDataFrame([*items, (50, None), (51, "too short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got - expected == {(None, 3)} and len(got & expected) >= 0.9 * len(expected)
    kept = decontam.clean(spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, item_id string"), bench)
    assert kept.columns == ["doc_id", "text", "item_id"] and {r.doc_id for r in kept.collect()} >= {i for i in range(60) if i % 3} | {900, 901}
    assert decontam.leaks(frame(spark, []), bench).count() == 0
    assert decontam.leaks(frame(spark, ["x"]), bench.limit(0)).count() == 0


def test_decontamination_against_all_pairs(spark):
    """Every window of every document held against every item; short items as they are; repeated and very long texts."""
    rng = random.Random(31)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(300)]

    def text(n):
        return [rng.choice(words) for _ in range(n)]

    items = [(i, " ".join(text(rng.randrange(10, 50)))) for i in range(12)] + [(90, "unu du tri"), (91, "kvar"), (92, None), (93, "...")]
    items.append((12, items[3][1]))
    docs = []
    for i in range(40):
        own = text(rng.randrange(60, 200))
        if i % 2:
            inside = items[i % 12][1].split()
            for j in range(0, len(inside), rng.choice([4, 6, 9, 99])):
                inside[j] = "other"
            at = rng.randrange(len(own))
            own[at:at] = inside
        docs.append((i, " ".join(own)))
    docs += [(50, "Unu, du tri!"), (51, "unu du, other tri"), (52, "so KVAR it is"), (53, " ".join(text(30_000)) + " " + items[0][1]), docs[1]]
    expected = set()
    for doc_id, own in docs:
        own = decontam.words_of(own)
        for item_id, item in items:
            item = decontam.words_of(item)
            if not item:
                continue
            if len(item) < decontam.MIN_WORDS:
                leaked = any(own[a : a + len(item)] == item for a in range(len(own)))
            elif doc_id == 53:
                leaked = item_id == 0
            else:
                leaked = max(common_length(item, own[a : a + 2 * len(item)]) for a in range(0, len(own), 4)) >= decontam.COVERED * len(item)
            if leaked:
                expected.add((doc_id, item_id))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(50, 90), (52, 91), (53, 0)} <= expected & got and len(expected) > 12
    assert len(expected & got) >= 0.95 * len(expected) and all(decontam.common_words(decontam.words_of(dict(items)[i]), decontam.words_of(dict(docs)[d])) >= decontam.PARAPHRASED * len(decontam.words_of(dict(items)[i])) for d, i in got - expected)


@pytest.mark.parametrize("cells", [1 << 24, 0])
def test_latent_space_takes_all_passages(spark, monkeypatch, tmp_path, cells):
    """Against counts of all passages; once with a task's table, once by slices, both sent in several parts."""
    monkeypatch.setattr(decontam, "FIT_PASSAGES", 20, raising=False)
    for name, value in (("MAX_CELLS", cells), ("SLICE", 7), ("FULL", 25), ("PART_PASSAGES", 10)):
        monkeypatch.setattr(decontam, name, value, raising=False)
    rng = random.Random(12)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    texts = [" ".join(rng.choices(words + ["other"] * 60, k=rng.choice([0, 1, 63, 64, 65, 700]))) for _ in range(90)] + [None, "other", "waa " * 200]
    items = decontam.Items([(1, " ".join(words[:70]))])
    counts = []
    for text in texts:
        own = decontam.words_of(text)
        for i in range(0, len(own), decontam.PASSAGE):
            counts.append([own[i : i + decontam.PASSAGE].count(w) for w in items.vocabulary])
    counts = np.array(counts, float)
    has = [set(decontam.words_of(t)) for t in texts]
    weights = np.log((1 + len(texts)) / (1 + np.array([sum(w in h for h in has) for w in items.vocabulary])))
    expected = len(counts) * np.linalg.inv(counts.T @ counts)  # of W V / S V' W and its transpose
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = decontam.written(decontam.word_ids(docs, items), str(tmp_path / "ids"))
    space = decontam.latent_space(ids, len(items.vocabulary), str(tmp_path / "fit")).astype(float)
    assert len(counts) > 100 and weights.min() > 0
    np.testing.assert_allclose(space @ space.T, expected, rtol=1e-2, atol=1e-3 * np.abs(expected).max())


def test_clean_drops_leaked_rows_only(spark):
    """Rows that share a null or repeated id with a leaked row stay."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(500)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    item = text(30)
    leaked = [(None, item), (7, text(40) + " " + item), (7, text(40) + " " + item)]
    good = [(None, text(60)), (7, text(60)), (None, None), (7, ""), (8, text(60)), (8, text(60))] + [(i, text(60)) for i in range(20, 40)]
    kept = decontam.clean(spark.createDataFrame(leaked + good, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(good, key=str)


def test_common_words():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_words(a, b) == table[-1][-1]


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    rows = [(i * 7 % 50, t) for i, t in enumerate(ODD)] + [(None, "null id"), (7, ODD[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    files, folder = token_files.token_files(docs, BPE)
    got = token_files.read_files(files, folder, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(BPE)
    expected = sorted((i if i is not None else -1, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        at += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids)


def test_token_files_of_nothing(spark):
    files, folder = token_files.token_files(frame(spark, []), BPE)
    assert files.count() == 0 and token_files.read_files(files, folder).count() == 0


def test_blocks_of_large_ranks():
    import io

    import numpy as np

    ranks = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1], np.uint32)
    stream = io.BytesIO(token_files.pack_block([1, None], [3, 4], ranks))
    docs, counts, out = token_files.unpack_block(stream.read)
    assert docs == [1, None] and counts.tolist() == [3, 4] and out.tolist() == ranks.tolist() and token_files.unpack_block(stream.read) is None


@pytest.fixture(scope="module")
def own_unigram():
    """A small unigram table of its own, and the library's encoder of it."""
    from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

    rng = random.Random(5)
    scores = {c: -6.0 - rng.random() for c in "abcde▁"} | {p: -float(rng.randrange(2, 9)) for p in ("ab", "bc", "abc", "▁a", "▁ab", "cde", "de", "dd", "ddd", "▁▁", "é")}
    names = ("<unk>", *(f"<0x{b:02X}>" for b in range(256)), *scores)
    table = pieces.Pieces(scores, {n: i for i, n in enumerate(names)}, names, 1, 0)
    t = Tokenizer(models.Unigram([(n, scores.get(n, 0.0)) for n in names], unk_id=0, byte_fallback=True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    t.pre_tokenizer = pre_tokenizers.Split(Regex("▁*[^▁\n]+|▁+|\n"), "isolated")
    return table, t


def test_unigram_sums_match_the_library(spark, own_unigram):
    table, library = own_unigram
    rng = random.Random(6)
    texts = [None, "", " ", "x", "é dd\nddd", "d" * 700] + ["".join(rng.choice("abcdexé  \n") for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    ids = {r.doc_id: list(r.ids) for r in piece_lattice.encode_with(frame(spark, texts), table).collect()}
    counter = token_counts.Counter(table)
    for i, t in enumerate(texts):
        expected = library.encode(t, add_special_tokens=False).ids if t else []
        assert ids[i] == expected and counter.count(t) == len(expected), repr(t)


def test_merges_match_the_library(spark):
    """Ids, counts and decoded texts are those of the model's own library."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(7)
    names = list(pieces.load(PIECES).scores)
    mixed = ["".join(rng.choice(names).replace("▁", " ") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    texts = [*(t for t in ODD if not t or "▁" not in t), "naïve  café 東京 " * 30, "z" * 5000, "a" + " " * 45 + "b", *mixed]
    rows = [*enumerate(texts), (None, "null id"), (3, texts[3]), (3, "other")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, block string, bucket int")
    got = piece_lattice.decode(piece_lattice.encode(docs, PIECES), PIECES).collect()
    assert sorted(((r.doc_id or -1, r.text or "", list(r.ids)) for r in got)) == sorted((i or -1, t or "", library.encode(t or "")) for i, t in rows)
    assert all(r.decoded == (r.text or "") for r in got)
    again = piece_lattice.round_trips(docs, PIECES).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    counts = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.token_counts(docs, PIECES).collect())
    assert counts == sorted((i or -1, len(library.encode(t or ""))) for i, t in rows)


def test_pieces_of_nothing(spark):
    assert piece_lattice.encode(frame(spark, []), PIECES).count() == token_counts.token_counts(frame(spark, []), PIECES).count() == 0

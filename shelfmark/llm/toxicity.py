"""Toxicity: a weighted lexicon, learned from labels, matched by Aho-Corasick.

Texts are folded first: lower case, compatibility letters and accents to plain letters,
homoglyphs to Latin letters, digits and signs that stand for letters beside a letter to
those letters.  The lexicon holds whole words and word beginnings; its weights are log
ratios of how often toxic and clean labelled documents have them.  Exception phrases are
an entry with the word before or after it that clean labelled documents have and toxic
ones have ten times less.  One automaton finds entries and exceptions; a hit
within an exception phrase doesn't count.  A logistic curve, fitted on the same labelled
rows, turns the summed weights and the text's length into a score from 0 to 1: the same
hits weigh less in a longer text.

Only labelled rows with crc32(doc_id as text) mod 4 <> 2 are learned from, at most
about MAX_LABELS of them, chosen by a hash of the id, and written once.  An entry must be
in a 500th of the toxic ones, so there are at most 500 times as many candidates as such
a document has words and beginnings on average.  Labels, language, source and id
are never inputs of a score.

Defined results: null and blank texts score what no hits at length 0 score; labels other
than 0 and 1 and null ids are not learned from, and an id labelled twice counts as toxic
if either label says so; without labels of both kinds no entry is learned and every
text scores 0; rows that repeat are scored alike; further columns are left alone.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, written

#: Labelled rows that are learned from, about; with more, a share of them by hash.
MAX_LABELS = 200_000
#: Toxic documents that have an entry: this many at least, and one in RARE at least.
MIN_DOCS, RARE, MIN_WEIGHT = 5, 500, 1.2
#: Among a million entries this much surprise hardly comes by chance.
MIN_SURPRISE = 30.0
THRESHOLD = 0.3
SHORTEST, LONGEST = 4, 8
FLUSH = 1_000_000

#: Homoglyphs (fixed values): Cyrillic, Greek and other letters that look Latin.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "ı": "i", "ɑ": "a", "ɡ": "g", "ӏ": "l",
}
INVISIBLE = (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)
MARKS = range(0x300, 0x370)
FOLD = str.maketrans(LOOKALIKES) | dict.fromkeys((*INVISIBLE, *MARKS))
#: Digits and signs that stand for letters (fixed values).
SIGNS = str.maketrans("013457@$", "oieastas")
SIGN_RUN = re.compile(r"[013457@$]+")
WORD = re.compile(r"[^\W\d_]+")
_BEFORE, _AFTER = re.compile(r"\b[^\W\d_]+ $"), re.compile(r" [^\W\d_]+\b")


def _as_letters(m: re.Match) -> str:
    text, a, z = m.string, m.start(), m.end()
    beside = a and text[a - 1].isalpha() or z < len(text) and text[z].isalpha()
    return m[0].translate(SIGNS) if beside else m[0]


def fold(text: str | None) -> str:
    if not text:
        return ""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower().translate(FOLD)
    return SIGN_RUN.sub(_as_letters, text)


@dataclass
class Model:
    """weights: entry -> weight; an entry that ends in "*" is the beginning of a word."""

    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] | None = None
    exceptions: tuple[str, ...] = ()

    def automaton(self):
        a = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            word = entry.rstrip("*")
            # an entry and a beginning may be the same letters
            kinds = a.get(word, {"n": len(word)})
            kinds["*" if entry.endswith("*") else "="] = weight
            a.add_word(word, kinds)
        for phrase in self.exceptions:
            kinds = a.get(phrase, {"n": len(phrase)})
            kinds["-"] = 0.0
            a.add_word(phrase, kinds)
        if len(a):
            a.make_automaton()
        return a


def hits(automaton, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight): for each word start the longest entry, none within an exception."""
    if not len(automaton):
        return []
    best: dict[int, tuple[int, float]] = {}
    spans = []
    for last, kinds in automaton.iter(text):
        end, start = last + 1, last + 1 - kinds["n"]
        if start and text[start - 1].isalpha():
            continue
        whole = end == len(text) or not text[end].isalpha()
        if whole and "-" in kinds:
            spans.append((start, end))
        weight = kinds.get("=") if whole else None
        if weight is None:
            weight = kinds.get("*")
        if weight is not None and (start not in best or best[start][0] < end):
            best[start] = (end, weight)
    return [(s, e, w) for s, (e, w) in sorted(best.items()) if not any(a <= s and e <= b for a, b in spans)]


def features(total: float, words: int) -> tuple[float, ...]:
    """Inputs of the curve: summed weights, plain and by length, and the length."""
    return (1.0, math.log1p(total), total / math.sqrt(words + 25.0), float(total > 0), math.log1p(words) * (total > 0))


def measured(model: Model):
    """text -> (summed weights, words, hits)."""
    automaton = model.automaton()

    def measure(text: str | None) -> tuple[float, int, int]:
        folded = fold(text)
        found = hits(automaton, folded)
        return sum(w for _, _, w in found), folded.count(" ") + folded.count("\n") + bool(folded), len(found)

    return measure


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic): labelled rows to learn from; the ids are broadcast, MAX_LABELS at most, about."""
    known = labels.filter("toxic in (0, 1)").filter(F.col("doc_id").isNotNull()).filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > MAX_LABELS:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * MAX_LABELS / n))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


def _word_features(word: str):
    yield word
    for n in range(SHORTEST, min(LONGEST, len(word) - 1) + 1):
        yield word[:n] + "*"


def candidates(rows: DataFrame) -> list[str]:
    """Words and word beginnings that enough toxic documents have."""

    def count(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["entry", "n"])

        for batch in batches:
            for text in batch.column("text"):
                seen.update({f for w in set(WORD.findall(fold(text.as_py()))) for f in _word_features(w)})
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    counted = rows.filter("toxic = 1").select("text").mapInArrow(count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    toxic = rows.filter("toxic = 1").count()
    found = counted.filter(F.col("n") >= max(MIN_DOCS, toxic // RARE))
    return [r.entry for r in found.select("entry").collect()]


def counts(rows: DataFrame, entries: list[str]) -> tuple[dict[str, list[int]], list[int]]:
    """entry -> [times in clean, in toxic, clean documents, toxic ones]; the same for all words."""
    shared = rows.sparkSession.sparkContext.broadcast(frozenset(entries))

    def count(batches):
        wanted, n, d = shared.value, Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                toxic, words = toxic.as_py(), Counter(WORD.findall(fold(text.as_py())))
                n["", toxic] += sum(words.values())
                d["", toxic] += 1
                own: Counter = Counter()
                for w, k in words.items():
                    for f in _word_features(w):
                        if f in wanted:
                            own[f] += k
                for f, k in own.items():
                    n[f, toxic] += k
                    d[f, toxic] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array([d[k] for k in n], pa.int64())], ["entry", "toxic", "n", "d"])

    table: dict[str, list[int]] = {}
    total = [0, 0, 0, 0]
    for r in rows.mapInArrow(count, "entry string, toxic int, n long, d long").groupBy("entry", "toxic").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).collect():
        if not r.entry:
            total[r.toxic], total[2 + r.toxic] = r.n, r.d
        else:
            of = table.setdefault(r.entry, [0, 0, 0, 0])
            of[r.toxic], of[2 + r.toxic] = r.n, r.d
    return table, total


def surprise(c: int, t: int, clean: int, toxic: int) -> float:
    """Log-likelihood ratio of an entry that c clean and t toxic documents have, if too many are toxic."""
    share = toxic / (clean + toxic)
    if t <= (c + t) * share:
        return 0.0
    return 2 * sum(n * math.log(n / (of * (c + t) / (clean + toxic))) for n, of in ((c, clean), (t, toxic)) if n)


def chosen(table: dict[str, list[int]], total: list[int]) -> dict[str, float]:
    """The lexicon: entries that toxic documents have more often, by log ratio of rates.

    A beginning is taken only if no single word makes up most of it, and an entry not
    if a beginning of it that is taken weighs nearly as much.
    """
    if not all(total):
        return {}
    weight = {e: math.log((t + 0.5) / total[1]) - math.log((c + 0.5) / total[0]) for e, (c, t, _, dt) in table.items() if dt >= MIN_DOCS}
    single: Counter = Counter()
    for e, (_, t, _, _) in table.items():
        if not e.endswith("*"):
            for n in range(SHORTEST, min(LONGEST, len(e) - 1) + 1):
                single[e[:n] + "*"] = max(single[e[:n] + "*"], t)
    taken: dict[str, float] = {}
    for e in sorted(weight, key=lambda e: (len(e.rstrip("*")), not e.endswith("*"), e)):
        w = weight[e]
        if w < MIN_WEIGHT or e.endswith("*") and table[e][1] < 1.5 * single[e]:
            continue
        if surprise(*table[e][2:], *total[2:]) < MIN_SURPRISE or any(taken.get(e[:n] + "*", -9) > w - 0.7 for n in range(SHORTEST, min(LONGEST, len(e.rstrip("*"))) + 1)):
            continue
        taken[e] = w
    return taken


def phrases(text: str, found: list[tuple[int, int, float]]) -> set[str]:
    """Each hit's whole word with the word before it, and with the word after it, one space between."""
    out = set()
    for start, end, _ in found:
        while end < len(text) and text[end].isalpha():
            end += 1
        if (m := _BEFORE.search(text, max(0, start - 40), start)) is not None:
            out.add(m[0] + text[start:end])
        if (m := _AFTER.match(text, end)) is not None:
            out.add(text[start:end] + m[0])
    return out


def exceptions(rows: DataFrame, model: Model, total: list[int]) -> tuple[str, ...]:
    """Phrases around entries that MIN_DOCS clean documents have, toxic ones ten times less."""

    def count(batches):
        automaton, seen = model.automaton(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                folded = fold(text.as_py())
                if found := hits(automaton, folded):
                    seen.update((p, toxic) for p in phrases(folded, found))
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["phrase", "toxic", "n"])

    if not model.weights:
        return ()
    counted = rows.mapInArrow(count, "phrase string, toxic int, n long").groupBy("phrase")
    counted = counted.agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"))
    clean, toxic = total[2:]
    found = counted.filter((F.col("c") >= MIN_DOCS) & (10 * F.col("t") * clean < F.col("c") * toxic))
    return tuple(sorted(r.phrase for r in found.select("phrase").collect()))


def fitted_curve(rows: DataFrame, model: Model) -> tuple[float, ...] | None:
    """Logistic regression on (summed weights, words) of the labelled rows, by Newton steps."""

    def measure(batches):
        of = measured(model)
        for batch in batches:
            got = [of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), batch.column("toxic")], ["s", "words", "toxic"])

    # one small row per labelled row, of which there are MAX_LABELS at most
    data = rows.mapInArrow(measure, "s double, words long, toxic int").toPandas().sort_values(["s", "words", "toxic"])
    y = data["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array([features(s, n) for s, n in zip(data["s"], data["words"], strict=True)])
    b = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])

    def loss(b):
        z = x @ b
        return float(np.sum(np.logaddexp(0, z) - y * z) + (ridge * b * b).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * b)
        size = 1.0
        while loss(b + size * step) > loss(b) and size > 1e-6:
            size /= 2
        b += size * step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in b)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    rows = written(training_rows(docs, labels), f"{shared_dir(docs.sparkSession)}/labelled")
    table, total = counts(rows, candidates(rows))
    model = Model(chosen(table, total))
    model.exceptions = exceptions(rows, model, total)
    model.curve = fitted_curve(rows, model)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score, predicted (score >= THRESHOLD) and n_hits added."""
    names = docs.columns
    docs = docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("row"), "text")

    def scored(batches):
        of, curve = measured(model), model.curve
        for batch in batches:
            scores, n = [], []
            for text in batch.column("text"):
                s, words, k = of(text.as_py())
                z = sum(a * b for a, b in zip(curve, features(s, words), strict=True)) if curve else -math.inf
                scores.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
                n.append(k)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(n, pa.int64())], ["row", "score", "predicted", "n_hits"])

    out = docs.mapInArrow(scored, f"row {docs.schema['row'].dataType.simpleString()}, score double, predicted int, n_hits long")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], "score", "predicted", "n_hits")

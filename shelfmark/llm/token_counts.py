"""Token counts by a count-only Viterbi over the pieces of a SentencePiece model.

An Aho-Corasick automaton lists the pieces that end at each place of a unit, longest
first; the dynamic programme keeps for each place the best way to it and its piece
count, no path.  What is best is the model's rule (``pieces`` explains the two kinds):

* unigram scores are summed, and of equal sums the piece that starts first stays; a
  character without a piece costs the least score minus ten;
* merge ranks order merges.  A sequence of pieces is what merging gives just if each two
  neighbours, merged alone, stay these two pieces, and each beginning of a unit has one
  such sequence; so the programme keeps a place's last piece, and the one piece that stays
  apart from the last one before it is the best.

A character without a piece counts as its bytes.

Each Python worker remembers the counts of about CACHE_UNITS units, so a word is
segmented once for all its uses there.

Defined results: null and empty texts have no tokens; scores are summed in double
precision within a unit; rows that repeat are counted alike, rows with null ids as
others; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import Pieces, load, parts, units, units_of

CACHE_UNITS = 600_000
CACHE_PAIRS = 500_000


class _Known(dict):
    """part -> number of pieces, found when first asked for."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, part):
        got = self[part] = self.of(part)
        return got


class Counter:
    """text -> number of pieces, remembering CACHE_UNITS parts at most, about."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.unk = pieces, pieces.unk_score
        self.ranks = pieces.ranks() if pieces.merges else {}
        self.longest = pieces.longest
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.scores.items():
            if len(piece) > 1 or not pieces.merges:
                self.automaton.add_word(piece, piece if pieces.merges else (len(piece), score))
        self.automaton.make_automaton()
        self.apart: dict[str, bool] = {}
        self.segment = self.merge if pieces.merges else self.best_sum
        self.units = _Known(self.segment)
        self.known = _Known(lambda part: sum(map(self.segment, units_of(part))))

    def merged(self, part: str) -> list[int]:
        """The ends of a short part's pieces, by trying its edges in merge order."""
        n, edges = len(part), []
        for s in range(n - 1):
            for e in range(s + 2, min(n, s + self.longest) + 1):
                rank = self.ranks.get(part[s:e])
                if rank is not None:
                    edges.append((rank, s, e))
        ends = set(range(1, n))
        for _, s, e in sorted(edges):
            if (s == 0 or s in ends) and (e == n or e in ends):
                ends.difference_update(range(s + 1, e))
        return sorted(ends)

    def stay(self, a: str, b: str) -> bool:
        """Whether two neighbouring pieces, merged alone, stay these two."""
        key = f"{a} {b}"
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) >= CACHE_PAIRS:
                self.apart.clear()
            found = self.apart[key] = self.merged(a + b) == [len(a)]
        return found

    def merge(self, unit: str) -> int:
        ends: dict[int, list[str]] = {}
        for end, piece in self.automaton.iter(unit):
            ends.setdefault(end + 1, []).append(piece)
        scores, last, counts = self.pieces.scores, [""], [0]
        for end, char in enumerate(unit, 1):
            for piece in ends.get(end, ()):
                s = end - len(piece)
                if not s or self.stay(last[s], piece):
                    break
            else:
                piece, s = char, end - 1
            last.append(piece)
            counts.append(counts[s] + (1 if piece in scores else len(self.pieces.unknown(piece))))
        return counts[-1]

    def best_sum(self, unit: str) -> int:
        best: list[tuple[float, int]] = [(0.0, 0)]
        ends: dict[int, list[tuple[int, float]]] = {}
        for end, found in self.automaton.iter(unit):
            ends.setdefault(end + 1, []).append(found)
        for end in range(1, len(unit) + 1):
            top, pieces, single = None, 0, False
            for n, score in ends.get(end, ()):
                before, k = best[end - n]
                if top is None or before + score > top:
                    top, pieces = before + score, k + 1
                single |= n == 1
            if not single:
                before, k = best[end - 1]
                if top is None or before + self.unk > top:
                    top, pieces = before + self.unk, k + len(self.pieces.unknown(unit[end - 1]))
            best.append((top, pieces))
        return best[-1][1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        plain = parts(text)
        known = self.units if plain is None else self.known
        if len(known) > CACHE_UNITS:
            known.clear()
        return sum(map(known.__getitem__, units(text) if plain is None else plain))


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens) for every row; ``model`` is the path of a SentencePiece model file."""

    def count(batches):
        if model not in _COUNTERS:
            _COUNTERS[model] = Counter(load(model))
        counter = _COUNTERS[model]
        for batch in batches:
            n = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long")

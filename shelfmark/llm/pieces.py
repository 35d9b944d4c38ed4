"""Piece tables of SentencePiece models, and the units that can be segmented apart.

A text is escaped as SentencePiece does it with an identity normaliser and a dummy
prefix: "▁" before it and for every space.  Where no piece has "▁" after another
character nor a line feed (``load`` checks it), the segmentation of a text is that of
its units: a run of "▁" with what follows up to the next "▁" or line feed, or one line feed.

Two kinds of model are told apart by their scores.  A unigram model has log
probabilities, and its segmentation is the path of the best sum.  A model made by
merging pairs has the whole numbers 0, -1, -2, ... as scores, which only order the
merges: summing them gives other ids than the library's.  Its segmentation takes the
lattice's edges by rank, and of equal ones from the left; an edge is merged if both its
ends are still ends of pieces.  That is the library's result if each piece alone is
merged to itself: a span whose ends nothing has crossed has then been merged as it
would be alone, so it is two pieces when the turn comes to its edge.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SPACE = "▁"
_UNIT = re.compile("▁*[^▁\n]+|▁+|\n")
UNK_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """scores: what can match; ids: of every piece; bytes_at: id of byte 0 (the 256 follow), or None;
    merges: whether scores order merges instead of being summed."""

    scores: dict[str, float]
    ids: dict[str, int]
    names: tuple[str, ...]
    bytes_at: int | None
    unk: int
    merges: bool = False

    @property
    def longest(self) -> int:
        return max(map(len, self.scores), default=1)

    @property
    def unk_score(self) -> float:
        return min(self.scores.values(), default=0.0) - UNK_PENALTY

    def unknown(self, char: str) -> list[int]:
        """The ids of a character that has no piece: its bytes, or the unknown id."""
        return [self.unk] if self.bytes_at is None else [self.bytes_at + b for b in char.encode("utf-8", "replace")]

    def ids_of(self, part: str) -> list[int]:
        """The ids of a part that a segmentation left: a piece, or a character without one."""
        return [self.ids[part]] if part in self.scores else self.unknown(part)

    def ranks(self) -> dict[str, int]:
        """Pieces of two characters or more -> order of their merges, equal scores alike."""
        at = {s: i for i, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        return {p: at[s] for p, s in self.scores.items() if len(p) > 1}


def load(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = tuple(model.id_to_piece(i) for i in range(n))
    skip = [model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
    first_byte = next((i for i in range(n) if model.is_byte(i)), None)
    scores = {names[i]: model.get_score(i) for i in range(n) if not skip[i]}
    if any("\n" in p or SPACE in p.lstrip(SPACE) for p in scores):
        raise ValueError("a piece reaches over the ends of units")
    whole = all(s == int(s) and s <= 0 for s in scores.values())
    return Pieces(scores, {x: i for i, x in enumerate(names)}, names, first_byte, model.unk_id(), whole)


def parts(text: str) -> list[str] | None:
    """A text cut before every space and line feed, the spaces left out; None if it has odd spaces.

    Each part stands for the units that ``units_of`` gives.
    """
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " " or "\n " in text or " \n" in text:
        return None
    return text.replace("\n", " \n").split(" ")


def units_of(part: str) -> list[str]:
    if part[:1] == "\n":
        return ["\n", part[1:]] if len(part) > 1 else ["\n"]
    return [SPACE + part]


def units(text: str | None) -> list[str]:
    if not text:
        return []
    plain = parts(text)
    if plain is None:
        return _UNIT.findall(SPACE + text.replace(" ", SPACE))
    return [u for p in plain for u in units_of(p)]

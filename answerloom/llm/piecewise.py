"""The tokenizers library on many short pieces of text at once.

A call for each piece costs far more than its encoding. Pieces without white space at their ends can be strung
together with a space before each: every such space starts a new pre-token, so the ids of the string are those of
the pieces one after the other, and the offsets of the tokens tell them apart.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np

GROUP = 256
#: Bytes that an entry of a memory takes besides the text of its piece, and bytes a character of it and its result.
ENTRY_BYTES, CHARACTER_BYTES = 190, 4
#: Pieces above this are remembered for the texts at hand only.
LONG_PIECE = 256
#: Pieces of Latin letters and then ASCII that is neither letter nor white space: each part is split off for certain,
#: so the letters are encoded once for all that may follow them.
PARTED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-@\[-`{-~]*)")


def load(path: str, ordinary_specials: bool = False):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = ordinary_specials
    return library


def strung(library, pieces: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, list[int]]]:
    """Groups of pieces, each with a space before it: the pieces, all their ids, the places in its piece at which each
    id starts, and where the ids of each piece begin (one more at the end)."""
    groups = [pieces[i : i + GROUP] for i in range(0, len(pieces), GROUP)]
    encoded = library.encode_batch([" " + " ".join(g) for g in groups], add_special_tokens=False)
    for group, found in zip(groups, encoded, strict=True):
        lengths = np.array([len(p) + 1 for p in group])
        ends = np.cumsum(lengths)
        ids, starts = np.array(found.ids, np.int64), np.array([o[0] for o in found.offsets], np.int64)
        owner = np.searchsorted(ends, starts, side="right")
        yield group, ids, starts - (ends - lengths)[owner], np.searchsorted(owner, np.arange(len(group) + 1)).tolist()


def opening(library) -> np.ndarray:
    """Which ids are tokens that begin with a space, in a vocabulary of byte letters."""
    opens = np.zeros(library.get_vocab_size(), bool)
    opens[[i for token, i in library.get_vocab(with_added_tokens=False).items() if token[0] == "Ġ"]] = True
    return opens


def strung_ids(library, opens: np.ndarray, pieces: list[str]) -> Iterator[tuple[list[str], np.ndarray, list[int]]]:
    """As `strung`, without places: each piece begins with the one token that has its space, so no offsets are made."""
    groups = [pieces[i : i + GROUP] for i in range(0, len(pieces), GROUP)]
    encoded = library.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)
    for group, found in zip(groups, encoded, strict=True):
        ids = np.array(found.ids, np.int64)
        cuts = np.flatnonzero(opens[ids]).tolist()
        if len(cuts) == len(group):
            yield group, ids, [*cuts, len(ids)]
        else:  # an added token has taken a space
            for same, ids, _, cuts in strung(library, group):
                yield same, ids, cuts


class Memory(dict):
    """What is known of pieces, in two generations: the older one goes when the younger is full, but for what is asked
    for again. A generation is bounded by (estimated) bytes, as a task's process keeps it for many tasks; long pieces
    are not kept beyond it.
    """

    def __init__(self, generation_bytes: int) -> None:
        super().__init__()
        self.older: dict = {}
        self.limit, self.used = generation_bytes, 0

    def unknown(self, pieces: set[str]) -> list[str]:
        """The pieces that have to be learned now."""
        if self.used > self.limit:
            self.older = {piece: found for piece, found in self.items() if len(piece) <= LONG_PIECE}
            self.clear()
            self.used = 0
        return self.absent(pieces)

    def absent(self, pieces: set[str]) -> list[str]:
        """As `unknown`, but nothing that stands in the memory goes."""
        older, new = self.older, []
        missing = list(filterfalse(self.__contains__, pieces))
        for piece in missing:
            if piece in older:
                self[piece] = older[piece]
            else:
                new.append(piece)
        self.used += ENTRY_BYTES * len(missing) + CHARACTER_BYTES * sum(map(len, new))
        return new

"""Where a byte-level BPE splits text, found with arrays instead of a regular expression.

Code points become classes, a class is a function between eight states, and the functions of a block are
composed, so blocks are scanned side by side and joined by an associative scan over the blocks.  The result
equals the matches of ``public_tokenizers.PATTERN``.
"""

from __future__ import annotations

import unicodedata

import numpy as np

# Classes of code points.
LETTER, DIGIT, OTHER, GAP, END = range(5)
# What a code point may do in the scan; QUOTE1 and QUOTE2 start a contraction of one or two letters.
QUOTE1, QUOTE2, LAST_SPACE, LAST_GAP = range(5, 9)
# States: what the piece so far consists of.  LEAD is one space, which the next run takes along.
FRESH, LETTERS, DIGITS, OTHERS, GAPS, LEAD, TAIL2, TAIL1 = range(8)
STATES = 8
SEPARATOR = 0x110000
BLOCK = 128
# Letters and digits of Unicode 16, which the tokenizer libraries know, that unicodedata of
# Python 3.13 (Unicode 15.1) lacks, and the characters with the property White_Space.
NEWER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NEWER_DIGITS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
WHITE_SPACE = (
    (0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)


def code_point_classes() -> np.ndarray:
    """The class of every code point, and END for the separator behind the last one."""
    kinds = [unicodedata.category(chr(code)) for code in range(SEPARATOR)]
    classes = np.full(SEPARATOR + 1, OTHER, dtype=np.uint8)
    classes[:SEPARATOR][[kind[0] == "L" for kind in kinds]] = LETTER
    classes[:SEPARATOR][[kind[0] == "N" for kind in kinds]] = DIGIT
    for ranges, kind in ((NEWER_LETTERS, LETTER), (NEWER_DIGITS, DIGIT), (WHITE_SPACE, GAP)):
        for first, last in ranges:
            classes[first : last + 1] = kind
    classes[SEPARATOR] = END
    return classes


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, both at class * STATES + state."""
    following = np.zeros((9, STATES), dtype=np.uint8)
    starts = np.ones((9, STATES), dtype=bool)
    for kind, run in ((LETTER, LETTERS), (DIGIT, DIGITS), (OTHER, OTHERS)):
        following[kind] = run
        starts[kind, [run, LEAD]] = False
    # Inside a contraction the letters belong to it, and what follows starts anew.
    starts[LETTER, [TAIL2, TAIL1]] = False
    following[LETTER, TAIL2] = TAIL1
    following[LETTER, TAIL1] = FRESH
    for kind, tail in ((QUOTE1, TAIL1), (QUOTE2, TAIL2)):
        following[kind] = tail
        following[kind, [OTHERS, LEAD]] = OTHERS
        starts[kind, [OTHERS, LEAD]] = False
    following[GAP] = GAPS
    starts[GAP, GAPS] = False
    following[LAST_SPACE] = LEAD
    following[LAST_GAP] = FRESH
    following[END] = FRESH
    return following.ravel(), starts.ravel()


class Splitter:
    """Finds the pieces of texts; a worker makes one and uses it for all its batches."""

    def __init__(self) -> None:
        self.classes = code_point_classes()
        self.following, self.starts = transitions()

    def scan_classes(self, codes: np.ndarray) -> np.ndarray:
        """Class of every code point, with what has to be known about its successors."""
        kinds = self.classes[codes]
        ahead = np.append(kinds[1:], END)
        solid = (kinds == GAP) & (ahead < GAP)
        result = kinds.copy()
        result[solid] = np.where(codes[solid] == 32, LAST_SPACE, LAST_GAP)
        quotes = np.flatnonzero(codes == 39)
        if quotes.size:
            padded = np.append(codes, [SEPARATOR, SEPARATOR])
            first, second = padded[quotes + 1], padded[quotes + 2]
            one = np.isin(first, [ord(c) for c in "stmd"])
            two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
            two |= (first == ord("l")) & (second == ord("l"))
            result[quotes[one]] = QUOTE1
            result[quotes[two]] = QUOTE2
        return result

    def piece_starts(self, codes: np.ndarray) -> np.ndarray:
        """Positions at which a piece or a separator starts."""
        kinds = self.scan_classes(codes)
        blocks = -(-len(kinds) // BLOCK)
        padded = np.full(blocks * BLOCK, END, dtype=np.uint8)
        padded[: len(kinds)] = kinds
        # One row for each place in a block, so that a step handles all blocks.
        rows = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) * np.uint8(STATES)
        whole = np.tile(np.arange(STATES, dtype=np.uint8)[:, None], (1, blocks))
        for row in rows:
            whole = self.following[row + whole]
        step = 1
        while step < blocks:
            whole[:, step:] = np.take_along_axis(whole[:, step:], whole[:, :-step], axis=0)
            step *= 2
        state = np.full(blocks, FRESH, dtype=np.uint8)
        state[1:] = whole[FRESH, :-1]
        found = np.empty((BLOCK, blocks), dtype=bool)
        for place, row in enumerate(rows):
            moved = row + state
            found[place] = self.starts[moved]
            state = self.following[moved]
        return np.flatnonzero(found.T.ravel()[: len(kinds)])

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """The pieces of every text, in order; joined they give the text again."""
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        codes[ends] = SEPARATOR
        starts = self.piece_starts(codes)
        place = np.searchsorted(starts, ends).tolist()
        at = starts.tolist()
        result, first = [], 0
        for last in place:
            bounds = at[first : last + 1]
            result.append([joined[a:b] for a, b in zip(bounds, bounds[1:])])
            first = last + 1
        return result

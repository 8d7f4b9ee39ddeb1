"""Texts cut where every match of the usual byte-level splitting pattern is sure to end, told from classes of characters.

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

The pattern looks ahead only behind white space, and never back, so a text may be cut at any end of a match whose piece does
not end within white space: the matches of the pieces are those of the text. A run of letters, of digits or of other marks
ends a match where another known kind or white space begins; an apostrophe may begin a match with the letters that follow,
and a space one with whatever follows, so there is no cut behind them. Of characters not in the tables only those are known
that are not white space: a cut comes where white space follows them. All others keep their surroundings in one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerline.llm.words import text_bytes

UNKNOWN, LETTER, DIGIT, MARK, APOSTROPHE, SPACE, BREAK, VISIBLE = range(8)  # BREAK: other white space; VISIBLE: not white space


def _ascii() -> np.ndarray:
    """The class of each byte; those beyond ASCII are told by whole characters."""
    found = np.zeros(256, np.uint8)
    for b in range(0x20, 0x7F):
        found[b] = LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK
    found[list(b"\t\n\v\f\r")] = BREAK
    found[0x20], found[0x27] = SPACE, APOSTROPHE
    return found


def _two_bytes() -> np.ndarray:
    """The class of each character of two bytes: U+0080 to U+07FF."""
    found = np.full(0x800, VISIBLE, np.uint8)
    found[:0xA1] = UNKNOWN  # control characters and the no-break space
    for c in range(0xA1, 0x180):
        kept = chr(c).isalpha() or c == 0xAD or chr(c).isnumeric()
        found[c] = LETTER if chr(c).isalpha() else VISIBLE if kept else MARK
    return found


_ASCII, _TWO = _ascii().tobytes(), _two_bytes()
_SHOWN = (LETTER, DIGIT, MARK, APOSTROPHE, VISIBLE)
_WHITE = (SPACE, BREAK)


def _rules() -> bytes:
    """For a class and the next one, as 8 * class + next: 1 if a match ends between them, 2 if one ends before them."""
    found = np.zeros((32, 8), np.uint8)
    for kind, others in {
        LETTER: (DIGIT, MARK, APOSTROPHE, *_WHITE),
        DIGIT: (LETTER, MARK, APOSTROPHE, *_WHITE),
        MARK: (LETTER, DIGIT, *_WHITE),
        APOSTROPHE: (DIGIT, *_WHITE),
        VISIBLE: _WHITE,
        BREAK: _SHOWN,
    }.items():
        found[kind, list(others)] = 1
    # Of white space before a visible character the last one is for the next match, or one of its own if it is a break.
    for kind in _WHITE:
        found[kind, list(_SHOWN)] |= 2
    return found.tobytes()


_RULES = _rules()


def _translated(values: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(bytearray(values).translate(table), np.uint8)


def classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte's character in UTF-8 data."""
    found = _translated(data, _ASCII)
    leads = np.flatnonzero(data >= 0xC2)
    if not len(leads):
        return found
    lead = data[leads]
    second, third = (data[np.minimum(leads + size, len(data) - 1)] for size in (1, 2))
    kinds = np.full(len(leads), VISIBLE, np.uint8)
    two = lead < 0xE0
    kinds[two] = _TWO[((lead[two] & 0x1F).astype(np.int64) << 6) | (second[two] & 0x3F)]
    # What is near white space beyond (U+1680, U+180E, U+2000 to U+205F, U+3000, U+FEFF), but dashes, quotes and dots.
    kinds[(lead == 0xE1) & ((second == 0x9A) | (second == 0xA0)) | (lead == 0xE2) & (second < 0x82) | (lead == 0xE3) & (second == 0x80) | (lead == 0xEF)] = UNKNOWN
    kinds[(lead == 0xE2) & (second == 0x80) & (third >= 0x90) & (third <= 0xA7)] = MARK
    found[leads] = kinds
    for size, of in ((1, slice(None)), (2, lead >= 0xE0), (3, lead >= 0xF0)):
        found[np.minimum(leads[of] + size, len(data) - 1)] = kinds[of]
    return found


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The pieces of all texts, the number of the piece at each place, and the places where the texts begin."""
    data, limits = text_bytes(texts)
    kinds = classes(data)
    ends = np.zeros(len(data) + 1, np.uint8)
    if len(data):
        rules = _translated((kinds[:-1] << 3) | kinds[1:], _RULES)
        rules[limits[(limits > 0) & (limits < len(data))] - 1] = 0  # nothing follows the last of a text
        ends[1:-1] = rules & 1
        ends[:-2] |= rules >> 1
        ends[limits] = 1
        ends[-1] = 0
    begins = np.flatnonzero(ends)
    stops = np.append(begins, len(data))
    coded = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return pieces, coded.indices.to_numpy(), np.searchsorted(begins, limits)


def single(pieces: list[str]) -> np.ndarray:
    """Which of the pieces are surely one match each."""
    shown = [piece.encode() for piece in pieces]
    ends = np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)))
    full = np.diff(ends, prepend=0) > 0
    begins = np.append(0, ends)[:-1][full]
    kinds = classes(np.frombuffer(b"".join(shown), np.uint8))
    first = np.zeros(len(kinds), bool)
    first[begins] = True
    before = np.append(UNKNOWN, kinds)[:-1]
    # Of one kind with the one before; marks and apostrophes are of one kind, a space is of the kind that follows.
    alike = (kinds == before) | ((kinds == MARK) & (before == APOSTROPHE)) | ((kinds == APOSTROPHE) & (before == MARK)) | (before == SPACE)
    wrong = (kinds == UNKNOWN) | (kinds == VISIBLE) | (~first & (~alike | (kinds == SPACE) | (kinds == BREAK)))
    if len(begins):
        full[full] = ~np.logical_or.reduceat(wrong, begins)
    return full

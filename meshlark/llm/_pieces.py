"""Cutting texts where byte-level BPE is sure to cut, whole blocks at a time.

With the patterns of LONE, a lone blank between two characters that are not white space always opens a new match, and what
follows is matched as if the text began there. So texts are cut before such blanks, and each distinct piece of a block
needs the pattern once only. With PLAIN, of most pieces, letters with marks or a line's end between them, the matches need
no pattern. With any other pattern whole texts are matched.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pattern whose plain pieces are known, and others in which a lone blank opens a match: digits in threes
#: with a mark glued to letters, and that with words parted where small letters are followed by capitals.
PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
THREES = r"""(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"""
CASED = (
    r"""[^\r\n\p{L}\p{N}]?[\p{Lu}\p{Lt}\p{Lm}\p{Lo}\p{M}]*[\p{Ll}\p{Lm}\p{Lo}\p{M}]+(?i:'s|'t|'re|'ve|'m|'ll|'d)?|[^\r\n\p{L}\p{N}]?[\p{Lu}\p{Lt}\p{Lm}\p{Lo}\p{M}]+[\p{Ll}\p{Lm}\p{Lo}\p{M}]*(?i:'s|'t|'re|'ve|'m|'ll|'d)?"""
    r"""|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n/]*|\s*[\r\n]+|\s+(?!\S)|\s+"""
)
LONE = (PLAIN, THREES, CASED)
_LONE = re.compile(r"(?<=\S) (?=\S)")
#: Ranges of letters in any version of Unicode, and the marks of ASCII.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ", r"!-/:-@\[-`{-~"
_PLAIN = rf"^(?P<a>[{LETTERS}]+)(?P<b>[{MARKS}]*)(?P<c>\n?)(?P<d>[{LETTERS}]*)(?P<e>[{MARKS}]*)$"


@dataclass
class Cut:
    """Words (matches of the pattern), each once; pieces, each the words that ``flat`` has up to its place in ``ends``;
    texts, each the pieces that ``places`` has for it, ``n_places`` of them."""

    words: pa.Array
    flat: np.ndarray
    ends: np.ndarray
    places: np.ndarray
    n_places: np.ndarray


def _odd(piece: str) -> bool:
    """Whether a piece tells that its text has other blanks than lone ones."""
    return not piece or piece[0].isspace() or piece[-1].isspace()


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The matches of a pattern, as wholes whatever groups it has."""
    import regex

    found = regex.compile(pattern)
    return (lambda text: [m.group() for m in found.finditer(text)]) if found.groups else found.findall


def cut(texts: pa.Array, split: Callable[[str], list[str]], added: tuple[str, ...] = (), pattern: str = PLAIN) -> Cut:
    """split: the matches of ``pattern``. added: strings that are words wherever they stand, the first of them that fits."""
    parted = re.compile("(" + "|".join(map(re.escape, added)) + ")").split if added else lambda t: [t]
    texts = texts.cast(pa.large_string()).fill_null("")
    lists = pc.split_pattern(texts, " ")
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(n) - n
    coded = lists.flatten().dictionary_encode()
    at, pieces = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    if pattern not in LONE:  # no place in a text is known to be a cut
        return _whole_texts(texts, split, parted)

    # plain pieces: the words of all of them at once
    letters = _ascii_letters(pieces) & (pattern == PLAIN)  # these need no pattern
    rare = np.flatnonzero(~letters)
    found = pc.extract_regex(pieces.take(pa.array(rare)), _PLAIN)
    parts = [found.field(k).fill_null("") for k in range(5)]
    own = np.stack([np.asarray(pc.not_equal(x, "")) for x in parts], axis=1) if len(rare) else np.zeros((0, 5), bool)
    contraction = np.asarray(pc.equal(parts[1], "'")) & ~own[:, 2] & own[:, 3] if len(rare) else np.zeros(0, bool)
    fits = np.asarray(found.is_valid()) & ~contraction & ~(own[:, 2] & ~own[:, 3] & ~own[:, 4])
    fits &= pattern == PLAIN
    own &= fits[:, None]
    plain = letters.copy()
    plain[rare] = fits
    has = np.zeros((len(pieces), 5), bool)
    has[:, 0], has[rare] = letters, own
    words = [pieces.filter(pa.array(letters)), *(x.filter(pa.array(h)) for x, h in zip(parts, own.T, strict=True))]
    nth = np.zeros(has.shape, np.int64)  # of the words, each that a plain piece has
    n_letters = len(pieces) - len(rare)
    nth[letters, 0] = np.arange(n_letters)
    of_rare = np.zeros((5, len(rare)), np.int64)
    of_rare[own.T] = n_letters + np.arange(int(own.sum()))
    nth[rare] = of_rare.T
    words[:2] = [pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), x, pa.scalar("", pa.large_string())) for x in words[:2]]

    # the others one by one, and first pieces and texts with other blanks as wholes
    others: list[str] = []
    sizes = has.sum(axis=1)
    rest = np.flatnonzero(~plain)
    odd = np.zeros(len(pieces), bool)
    for k, p in zip(rest.tolist(), pieces.take(pa.array(rest)).to_pylist(), strict=True):
        if _odd(p):
            odd[k] = True
        else:
            own = split(" " + p)
            sizes[k] = len(own)
            others += own
    wholes: dict[str, int] = {}
    more: list[int] = []

    def whole(text: str, single: bool = False) -> int:
        if text not in wholes:
            wholes[text] = len(pieces) + len(more)
            own = [text] if single else split(text)
            more.append(len(own))
            others.extend(own)
        return wholes[text]

    first = pieces.take(pa.array(at[begin])).to_pylist()
    bad = odd[at]
    bad[begin] = False
    unusual = set(np.flatnonzero(np.add.reduceat(bad.astype(np.int64), begin) > 0).tolist()) if len(n) else set()
    for x in added:
        unusual |= set(np.flatnonzero(pc.match_substring(texts, x)).tolist())
    replaced: dict[int, list[int]] = {}
    for k, p in enumerate(first):
        if k in unusual or n[k] > 1 and (not p or p[-1].isspace()):
            runs = enumerate(parted(texts[k].as_py()))
            replaced[k] = [y for j, x in runs for y in ([whole(x, True)] if j % 2 else _wholes(x, whole))]
        else:
            at[begin[k]] = whole(p)
    if replaced:
        pieces_of = np.split(at, begin[1:])
        for k, x in replaced.items():
            pieces_of[k] = np.array(x, np.int64)
        n = np.array([len(x) for x in pieces_of], np.int64)
        at = np.concatenate(pieces_of)

    every = pa.concat_arrays([*words, pa.array(others, pa.large_string())]).dictionary_encode()
    code = every.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    m = len(pieces)
    all_sizes = np.concatenate([sizes, np.array(more, np.int64)]).astype(np.int64)
    ends = np.cumsum(all_sizes)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    mine = np.zeros(len(flat), bool)
    if m:
        mine[_ranges((ends - all_sizes)[:m][plain], all_sizes[:m][plain])] = True
    flat[mine] = code[nth[has]]
    flat[~mine] = code[len(code) - len(others) :]
    return Cut(every.dictionary, flat, ends, at, n)


def _ascii_letters(pieces: pa.Array) -> np.ndarray:
    """Which strings, none of them null, have letters of ASCII only, and at least one."""
    if not len(pieces):
        return np.zeros(0, bool)
    ends = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, 8 * pieces.offset)
    data = np.frombuffer(pieces.buffers()[2], np.uint8, int(ends[-1] - ends[0]), int(ends[0])) if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    other = np.concatenate([[0], np.cumsum(((data | 32) - np.uint8(97)) > 25)])[ends - ends[0]]
    return (np.diff(other) == 0) & (np.diff(ends) > 0)


def _whole_texts(texts: pa.Array, split: Callable[[str], list[str]], parted: Callable[[str], list[str]]) -> Cut:
    """Each different text is a piece."""
    coded = texts.dictionary_encode()
    known: dict[str, int] = {}
    flat, ends = [], []
    for t in coded.dictionary.to_pylist():
        for j, x in enumerate(parted(t)):
            flat += [known.setdefault(w, len(known)) for w in ([x] if j % 2 else split(x))]
        ends.append(len(flat))
    return Cut(pa.array(list(known), pa.large_string()), np.array(flat, np.int64), np.array(ends, np.int64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.ones(len(texts), np.int64))


def _wholes(text: str, whole: Callable[[str], int]) -> list[int]:
    if not text:
        return []
    first, *rest = _LONE.split(text)
    return [whole(first), *[whole(" " + p) for p in rest]]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))

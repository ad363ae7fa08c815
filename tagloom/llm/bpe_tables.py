"""Splitting text into the pieces that byte-level tokenizers encode on their own, and tables over distinct pieces."""

from __future__ import annotations

import re
from functools import lru_cache

import regex

#: The published split pattern of the byte-level tokenizer, and of the lower-case one with word ends
#: (there extended by white space, which that tokenizer drops, so that the pieces cover the text).
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\s+"

_PLAIN = {r"\p{L}": r"[^\W\d_]", r"[\p{L}]": r"[^\W\d_]", r"[\p{N}]": r"\d", r"\p{N}": r"\d", r"[^\s\p{L}\p{N}]": r"(?:[^\s\w]|_)"}


@lru_cache(maxsize=None)
def splitter(pattern: str):
    """``text -> pieces``. Texts of common characters, for which ``re`` has the same classes as ``regex`` (tested one
    by one here), go through ``re``, which is faster; all others through ``regex``."""
    full = regex.compile(pattern)
    plain = pattern
    for k in sorted(_PLAIN, key=len, reverse=True):
        plain = plain.replace(k, _PLAIN[k])
    plain = re.compile(plain)
    kinds = [(regex.compile(a), re.compile(b)) for a, b in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))]
    common = [c for c in map(chr, [*range(0x250), *range(0x2010, 0x2028)]) if all(bool(a.match(c)) == bool(b.match(c)) for a, b in kinds)]
    odd = re.compile("[^" + "".join(map(re.escape, common)) + "]")
    return lambda text: (full if odd.search(text) else plain).findall(text)


@lru_cache(maxsize=None)
def tokenizer(path: str):
    """The tokenizer of a file, without truncation or padding; and a pattern of its added tokens' strings."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    added = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
    # strings of added tokens are found in the raw text, before it is split; the longest first
    found = re.compile("(" + "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
    return t, added, found


def pieces_of(text: str, split, found) -> list[str]:
    """Pieces in order; the strings of added tokens are pieces of their own."""
    if found is None or not found.search(text):
        return split(text)
    out = []
    for i, part in enumerate(found.split(text)):
        out.extend([part] if i % 2 else split(part))
    return out

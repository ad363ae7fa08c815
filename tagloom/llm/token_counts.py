"""Exact token counts of every prefix by dynamic programming over a BPE vocabulary with word ends."""

from __future__ import annotations

import json
import unicodedata
from array import array
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.bpe_tables import WORD_SPLIT, pieces_of, splitter, tokenizer
from tagloom.llm.common import arrow, batches, id_text

END = b"\xff\xff</w>"  # marks the last symbol of a word; no token of text has these bytes


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: itself where printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter(dict):
    """word -> int32 bytes: by how much the token count changes with each further character of the word.

    Let last(i) be the last token of the encoding of a word's first i bytes without word end. A token t that ends there
    is last(i) exactly if what stands before it is empty or if its own last token and t stay apart when joined: one
    pass over a word finds last(i) and the count at every i. The count of a prefix *as a text* is that of its final
    token, which carries the word end, after the prefix before it: the same test, with final tokens."""

    def __init__(self, path: str, most: int = 600_000):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        suffix = model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            end = token.endswith(suffix)
            return bytes(letters[c] for c in (token[:-len(suffix)] if end else token)) + END * end

        self.rank = {}
        for i, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[raw(a), raw(b)] = i
        self.most = most
        self.made: dict[bytes, tuple | None] = {}
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.apart_end: dict[tuple[bytes, bytes], bool] = {}
        tokens = [raw(t) for t in model["vocab"] if t not in tokenizer(path)[1]]
        tokens = [t for t in tokens if self.parts(t) is not None]
        self.inner = {t for t in tokens if not t.endswith(END)}
        self.final = {t.removesuffix(END) for t in tokens if t.endswith(END)}
        self.longest = max(map(len, self.inner | self.final))

    def parts(self, token: bytes):
        """(left, right, rank) of the merge that made ``token``; () for one byte; None if no text encodes to it alone."""
        if token not in self.made:
            body = token.removesuffix(END)
            syms = [body[i:i + 1] for i in range(len(body))]
            if token is not body and len(token) != len(body):
                syms[-1] += END
            got: tuple | None = ()
            while len(syms) > 1:
                r, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(syms, syms[1:])))
                if r == 1 << 60:
                    got = None
                    break
                got = (syms[i], syms[i + 1], r)
                syms[i:i + 2] = [syms[i] + syms[i + 1]]
            self.made[token] = got
        return self.made[token]

    def stay(self, a: bytes, b: bytes) -> bool:
        """Whether the encoding of a's and b's bytes is just [a, b]: no merge across the border comes before the merges
        that take its two symbols into a or b. Of equal merges the left one goes first."""
        never = 1 << 60
        right, x, used = [], a, never  # symbols at a's right edge, with the rank of the merge that ends each
        while True:
            right.append((x, used))
            p = self.parts(x)
            if not p:
                break
            x, used = p[1], p[2]
        y, used = b, never
        while True:
            for x, until in right:
                r = self.rank.get((x, y))
                if r is not None and r < until and r <= used:
                    return False
            p = self.parts(y)
            if not p:
                return True
            y, used = p[0], p[2]

    def learn(self, words) -> None:
        """Add ``words`` (a set). In sorted order each shares the states of the prefix that it has in common with the
        one before. White space has no tokens."""
        if len(self) + len(words) > self.most:
            self.clear()
        inner, final, longest = self.inner, self.final, self.longest
        apart, apart_end, stay = self.apart, self.apart_end, self.stay
        prev, last, count, ends = b"", [b""], [0], [0]
        for b, word in sorted((w.encode(), w) for w in words if w not in self):
            if word.isspace():
                self[word] = bytes(4 * len(word))
                continue
            n, same = len(b), 0
            most = min(n, len(prev))
            while same < most and b[same] == prev[same]:
                same += 1
            del last[same + 1:], count[same + 1:], ends[same + 1:]
            for i in range(same + 1, n + 1):
                tok = None
                lo = i - longest if i > longest else 0
                for j in range(lo, i):
                    t = b[j:i]
                    if t in inner:
                        if not j:
                            tok = t
                            break
                        ok = apart.get((last[j], t))
                        if ok is None:
                            ok = apart[last[j], t] = stay(last[j], t)
                        if ok:
                            tok = t
                            break
                last.append(tok)
                count.append(count[j] + 1)
                end = -1  # inside a character
                if i == n or b[i] & 0xC0 != 0x80:
                    for j in range(lo, i):
                        t = b[j:i]
                        if t in final:
                            if not j:
                                end = 1
                                break
                            ok = apart_end.get((last[j], t))
                            if ok is None:
                                ok = apart_end[last[j], t] = stay(last[j], t + END)
                            if ok:
                                end = count[j] + 1
                                break
                ends.append(end)
            prev = b
            counts = ends if len(b) == len(word) else [e for e in ends if e >= 0]
            self[word] = array("i", map(sub, counts[1:], counts)).tobytes()
        for held in (apart, apart_end):
            if len(held) > 4 * self.most:
                held.clear()

    def __missing__(self, word: str) -> bytes:
        self.learn({word})
        return self[word]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def changes(texts: list[str], table: PrefixCounter, added: dict, found) -> list[bytes]:
    """For each text, int32 changes of the token count, one for each character of the normalised text (NFC, lower case)."""
    split, parts, special = splitter(WORD_SPLIT), [], set()
    for k, text in enumerate(texts):
        for i, part in enumerate(found.split(text) if found and found.search(text) else [text]):
            if i % 2:
                special.add((k, len(parts)))
            # Lower-casing goes character by character; str.lower treats this letter by its neighbours
            parts.append((k, split(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())))
    table.learn({p for _, pieces in parts for p in pieces})
    out = [[] for _ in texts]
    for n, (k, pieces) in enumerate(parts):
        steps = b"".join(map(table.__getitem__, pieces))
        if (k, n) in special:  # an added token: its characters count as text until the last makes it one token
            steps = np.frombuffer(changes(["".join(pieces)[:-1]], table, added, None)[0], "<i4")
            steps = steps.tobytes() + np.array([1 - steps.sum()], "<i4").tobytes()
        out[k].append(steps)
    return [b"".join(x) for x in out]


def prefix_counts(docs: DataFrame, path: str, limit: int = 2048, keep_counts: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` and, with ``keep_counts``,
    ``counts``: little-endian int32, the exact number of tokens of each prefix of the normalised text (1 character,
    2 characters, ...). ``fit_chars`` is the length of the longest prefix within ``limit`` tokens, read from them.

    The added tokens' strings count as the library does by default (one token). A null text is empty. Distinct words
    are analysed once in a worker; its table is bounded and rebuilt at need, so no word is treated differently."""
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + ", counts binary" * keep_counts

    def count(rows):
        table, (_, added, found) = counter(path), tokenizer(path)
        for batch in batches(rows):
            out = []
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc, text, steps in zip(batch.column("doc_id").to_pylist(), texts, changes(texts, table, added, found)):
                steps = np.frombuffer(steps, "<i4")
                n = int(steps.sum())
                fit, counts = len(steps), None
                if n > limit or keep_counts:
                    counts = np.cumsum(steps, dtype="<i4")
                    within = np.flatnonzero(counts <= limit)
                    fit = int(within[-1]) + 1 if len(within) else 0
                out.append((doc, len(text.encode()), n, n > limit, fit) + ((counts.tobytes(),) if keep_counts else ()))
            shape = arrow(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), shape.types)], schema=shape)

    return id_text(docs).mapInArrow(count, schema)

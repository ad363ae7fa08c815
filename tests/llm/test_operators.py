"""The corpus operators against brute force on small tables with nulls, empty and long texts, ties, repeats, clashes."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tagloom.llm import bpe, decontaminate, licenses, lm, quality, shards, simhash, substrings, token_counts, token_files
from tagloom.llm.components import components
from tagloom.llm.elias_fano import BigramTrie, EliasFano

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, n_words long, shard int, fp long, w string, k1 long, block long"
rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("abcdeio") for _ in range(rng.randint(1, 9))) for _ in range(400)]
prose = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
PASSAGE = prose(70)
NEAR = " ".join(w if i != 35 else "changed" for i, w in enumerate(PASSAGE.split()))


def make():
    long = prose(6000)
    texts = [None, "", "  \n\t", "one", prose(60), prose(200), long, long, PASSAGE + " tail", "Head " + prose(30) + " " + PASSAGE.upper(),
             NEAR, "Élan\x00 ÉLAN élan K <|endoftext|> İstanbul 漢字🙂 it's ½²", "spam spam " * 300, "a\nb\na\n\n#*$%&|<>", prose(40)]
    rows = [(i, t, f"src{i % 3}" if i % 5 else None, 7, 1, 2, "x", 4, 3) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, prose(30), "src1", None, None, None, None, None, None), (99, texts[4], "src1", 0, 0, 0, "", 0, 0)]


ROWS = make()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    text = ROWS[5][1].split()
    return spark.createDataFrame([(1, " ".join(text[20:45])), (2, "one"), (3, ""), (4, None), (None, prose(12)), (10, " ".join(text[150:163]).upper())],
                                 "item_id long, text string")


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_empty_tables(spark, none, benchmark):
    results = [quality.quality(none), quality.keep_good(none), licenses.license_report(none, licenses.templates(spark)),
               token_counts.prefix_counts(none, WORD), bpe.digests(none, BYTE), shards.shard(none), simhash.near_duplicates(none),
               decontaminate.decontaminate(none, benchmark), substrings.repeated_passages(none), substrings.remove_repeats(none),
               token_files.token_files(none, BYTE), lm.score(none)]
    assert [r.count() for r in results] == [0] * len(results)


def test_quality(docs):
    got = by_id(quality.quality(docs).collect())
    assert sum(map(len, got.values())) == len(ROWS)
    for i, text, *_ in ROWS:
        w = (text or "").encode().split()
        windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        seen = Counter(windows)
        hit = {p for k, x in enumerate(windows) if seen[x] > 1 for p in range(k, k + 5)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        r = got[i][0]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (
            len(w), sum(len(x.decode()) for x in w), len(hit), len(lines) - len(set(lines)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert r.base_failed == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
        assert not (r.kept and r.base_failed)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for x in got.values() for r in x)


def test_hosts(spark):
    rows = [(i, "x", "bad") for i in range(90)] + [(i, prose(30), "good") for i in range(100, 190)] + [(500, prose(30), "bad")]
    got = by_id(quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert not got[500][0].kept and not got[500][0].base_failed and got[150][0].kept


def test_licenses(spark):
    words = prose(100).split()
    rows = [(1, " ".join(words[:50]) + " licensed UNDER the apache-license, version 2.0 " + " ".join(words[50:])), (2, "Released under the MIT"),
            (3, None), (4, ""), (5, "released under the mit license " * 2), (6, "licensed apache mit nc " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license_ids for r in licenses.license_report(docs, licenses.templates(spark)).collect()}
    assert got == {1: "apache-2.0", 2: "", 3: "", 4: "", 5: "mit", 6: ""}
    empty = spark.createDataFrame([("x", None)], "template_id string, text string")
    assert licenses.scan(docs, empty).count() == 0
    assert licenses.bands_for(0.8, 4, 1e-6) * math.log(1 - 0.8 / 4.2) <= math.log(1e-6)


def test_license_texts(spark):
    """Whole texts and headers with small changes, inside other text; half a text is none."""
    changed = lambda t: " ".join("other" if i % 60 == 30 else w for i, w in enumerate(t.upper().split()))
    long = [(name, t) for name, t in licenses.TEMPLATES if name.endswith(("-text", "-header", "-notice"))]
    rows = [(i, prose(300 + 7 * i) + " " + changed(t) + " " + prose(200)) for i, (_, t) in enumerate(long)]
    half = next(t for name, t in long if name == "isc-text").split()
    rows += [(100, " ".join(half[:len(half) // 2])), (101, prose(500)),
             (102, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
                   "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
                   "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license_ids.split(",") for r in licenses.license_report(docs, licenses.templates(spark)).collect()}
    assert [name for i, (name, _) in enumerate(long) if name not in got[i]] == []
    assert got[100] == [""] and got[101] == [""] and "gpl-3.0-header" in got[102]


def test_token_counts(docs):
    t = Tokenizer.from_file(WORD)
    got = by_id(token_counts.prefix_counts(docs, WORD, limit=50, keep_counts=True).collect())
    for i, text, *_ in ROWS:
        r = got[i][0]
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), n, n > 50)
        counts = np.frombuffer(r.counts, "<i4")
        if text and text.isascii() and "<|" not in text:
            for k in rng.sample(range(1, len(text) + 1), min(20, len(text))):
                assert counts[k - 1] == len(t.encode(text[:k], add_special_tokens=False).ids)
            if r.over_limit:
                assert len(t.encode(text[:r.fit_chars], add_special_tokens=False).ids) <= 50


def test_bpe(docs):
    t = Tokenizer.from_file(BYTE)
    got = by_id(bpe.digests(docs, BYTE).collect())
    assert sum(map(len, got.values())) == len(ROWS)
    for i, text, *_ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        for r in got[i]:
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    one = bpe.encode(docs, BYTE)
    assert {(r.doc_id, r.text) for r in bpe.decode(one, BYTE).collect()} == {(i, x or "") for i, x, *_ in ROWS}


def test_shards(spark, docs):
    got = shards.shard(docs, shards=4).collect()
    assert len(got) == len(ROWS) and {r.law for r in got} == {"bytes"}
    text = {i: (t or "").encode() for i, t, *_ in ROWS}
    for r in got:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]))
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    # one group of copies holds a third of the rows; it is cut, the small groups are not
    rows = [(i, "copy " * 5 if i % 3 == 0 else f"text {i // 3} of some length") for i in range(6000)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=16, small=50).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) < 1.05 * sum(sizes.values()) / 16 and len(sizes) == 16
    where = {}
    for r in got:
        where.setdefault(rows[r.doc_id][1], set()).add(r.shard)
    assert all(len(x) == 1 for t, x in where.items() if not t.startswith("copy"))


def reach(values, distance):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(values):
        for j in range(i):
            if (x ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash(docs):
    rows = sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0])
    prints = [simhash.fingerprint(r[1]) for r in rows]
    want = {r[0]: (f"{p:016x}", rows[k][0]) for r, p, k in zip(rows, prints, reach(prints, 3))}
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got if r.doc_id is not None} == want


@pytest.mark.parametrize("distance,large", [(3, 8), (3, 4096), (2, 8)])
def test_dense_groups(spark, distance, large):
    values = set()
    for center in (rng.getrandbits(64) for _ in range(3)):
        for _ in range(60):
            values.add(center ^ sum({1 << b for b in rng.sample(range(64), rng.randint(0, 4))}))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in components(simhash.links(nodes, distance, large)).collect()}
    roots = reach([v & (1 << 64) - 1 for v in values], distance)
    assert [got.get(v, v) for v in values] == [values[k] for k in roots]


def test_decontaminate(docs, benchmark, spark):
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    split = lambda t: "".join(c if not c.isascii() or c.isalnum() else " " for c in low(t)).split(" ")
    words = lambda t: [w for w in split(t) if w]
    items = [(r.item_id, words(r.text)) for r in benchmark.collect()]
    got = by_id(decontaminate.decontaminate(docs, benchmark).collect())
    for i, text, *_ in ROWS:
        w, hit, found = words(text), set(), set()
        for item, x in items:
            for win in [x[k:k + 10] for k in range(max(1, len(x) - 9))] if x else []:
                for k in range(len(w) - len(win) + 1):
                    if w[k:k + len(win)] == win:
                        hit |= set(range(k, k + len(win)))
                        found |= {str(item)} if item is not None else set()
        r = got[i][0]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    bare = decontaminate.decontaminate(docs, benchmark.limit(0)).collect()
    assert len(bare) == len(ROWS) and not any(r.contaminated for r in bare)


def test_decontaminate_without_broadcast(spark, docs, benchmark, monkeypatch):
    """Null and repeated ids with texts of their own: the same rows on both sides of the switch."""
    text = ROWS[5][1]
    more = spark.createDataFrame([(None, text), (None, prose(25)), (500, text), (500, "short"), (500, prose(40)), (500, text)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(more)
    want = Counter(map(tuple, decontaminate.decontaminate(both, benchmark).collect()))
    assert sum(want.values()) == len(ROWS) + 6
    assert sum(n for r, n in want.items() if r[0] is None and r[-1]) == 3  # rows that share an id share their hits
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert Counter(map(tuple, decontaminate.decontaminate(both, benchmark).collect())) == want
    test_decontaminate(docs, benchmark, spark)


def test_repeated_passages(docs):
    got = {(r.doc_id, r.first_doc_id): r for r in substrings.repeated_passages(docs).collect()}
    assert {(7, 6), (9, 8), (99, 4)} <= set(got) and {(10, 8), (10, 9)} & set(got), sorted(got)
    assert not {i for i, _ in got} & {0, 1, 2, 3, 4, 5, 6, 8, 11, 13, 14}
    assert (got[9, 8].start_word, got[9, 8].n_words, got[9, 8].first_start_word) == (31, 70, 0)
    left = substrings.remove_repeats(docs)
    assert left.columns == docs.columns
    text = {r.doc_id: r.text for r in left.collect()}
    assert 7 not in text and 99 not in text and text[8] == ROWS[8][1] and text[0] is None
    assert text[9].split() == ROWS[9][1].split()[:31]
    assert substrings.cut("a  b c\nd", [(1, 2)]) == "a  d"


def test_swapped_sentences(spark):
    """A passage AB against BA: 42 of 50 shingles in common, 21 at either shift."""
    g = random.Random(11)
    text = lambda n: [f"w{g.randrange(10**9)}" for _ in range(n)]
    rows, want = [], set()
    for i in range(0, 80, 2):
        a, b = text(25), text(25)
        rows += [(i, " ".join(a + b)), (i + 1, " ".join(b + a))]
        want.add((i + 1, i))
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), hashes=8)
    got = {(r.doc_id, r.first_doc_id): (r.start_word, r.n_words, r.first_start_word) for r in found.collect()}
    assert set(got) == want and set(got.values()) == {(0, 50, 25)}


@pytest.mark.parametrize("parts", [1, 6])
def test_passages_behind_quotes(spark, parts):
    """Two copies of a passage of 50 words are found with the registered parameters, though an earlier text quotes a part
    of it; and near copies with one changed word. Nothing else is."""
    g = random.Random(parts)
    text = lambda n: [f"w{g.randrange(10**9)}" for _ in range(n)]
    rows, want = [], {20: set(), 30: set(), 40: set(), "near": set()}
    for kind, pairs in want.items():
        for _ in range(100):
            passage, i = text(50), len(rows) * 2
            copy = list(passage)
            if kind == "near":
                copy[g.randrange(50)] = "changed"
            else:
                at = g.randrange(51 - kind)
                rows.append((i, text(60) + passage[at:at + kind] + text(60)))
            rows += [(i + 1, text(60) + passage + text(60)), (i + 2, text(60) + copy + text(60))]
            pairs.add((i + 2, i + 1))
    g.shuffle(rows)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(parts)
    got = {(r.doc_id, r.first_doc_id) for r in substrings.repeated_passages(df).collect()}
    assert got <= set().union(*want.values())
    recall = {k: len(v & got) for k, v in want.items()}
    assert min(recall[20], recall[30], recall["near"]) >= 97 and recall[40] >= (85 if parts == 1 else 95), recall


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_passages_behind_any_quotes(spark, parts):
    """No earlier quotes, neither long ones nor one of each end, stand between exact copies of a passage of 50 words."""
    g = random.Random(parts)
    text = lambda n: [f"w{g.randrange(10**9)}" for _ in range(n)]
    rows, want = [], set()
    for n in range(120):
        p, i = text(50), 10 * n
        cuts = [(0, 40), (10, 50), (0, 44), (6, 50), (3, 47)] if n % 2 else [(0, 40), (10, 50)]
        rows += [(i + k, text(60) + p[a:z] + text(60)) for k, (a, z) in enumerate(cuts)]
        rows += [(i + 7, text(60) + p + text(60)), (i + 8, text(20) + p + text(90))]
        want.add((i + 8, i + 7))
    g.shuffle(rows)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(parts)
    got = {(r.doc_id, r.first_doc_id): r for r in substrings.repeated_passages(df).collect()}
    assert want <= set(got) and all(got[w].n_words >= 50 for w in want)


def test_links_to_several_places_of_a_text():
    """A window is linked to two places of one text under two keys: neither link stands for the other. Of two links between the
    same windows one does."""
    value, doc = np.array([8, 8, 16, 16, 24, 24], np.uint64), np.array([1, 2] * 3)
    first, window = np.array([5, 7, 90, 7, 90, 7]), np.array([0, 2, 1, 2, 1, 2])
    _, made = substrings._bundle(1, value, doc, first, first, window)
    links = sorted(zip(*(made[0][c].tolist() for c in (0, 1, 2, 3, 5))))
    assert links == [(8, 2, 1, 7, 5), (24, 2, 1, 7, 90)]


def test_compact_windows_are_the_brute_force():
    """Every window that its keys stand for has the key's smallest shingle, and equal windows share a key with a side."""
    g = random.Random(8)
    part = [g.randrange(1 << 62) for _ in range(9)]
    texts = [[g.randrange(1 << 62) for _ in range(g.randint(0, 30))] + part * g.randint(0, 2) + [g.randrange(1 << 62)] * g.randint(0, 3)
             for _ in range(40)]
    flat, lens = np.array([x for t in texts for x in t], np.uint64), np.array([len(t) for t in texts])
    key, text, first, last, _ = substrings.compact_windows(flat, lens, 9, 2, 2)
    plain, sided = {}, {}
    for k, t, a, z in zip(key.tolist(), text.tolist(), first.tolist(), last.tolist()):
        for i in range(a, z + 1):
            (sided if k & 8 else plain).setdefault((t, i), set()).add(k)
    windows = {(t, i): tuple(x[i:i + 9]) for t, x in enumerate(texts) for i in range(len(x) - 8)}
    assert set(plain) == set(windows) and all(len(x) == 2 for x in plain.values())
    assert all({k & 7 for k in sided[w]} == {0, 1} for w, x in windows.items() if x == tuple(part))
    low = {}
    for w, x in windows.items():
        for k in plain[w]:
            least = min(int(substrings._mix(np.array([v], np.uint64) + np.uint64(0x632BE59BD9B4E019 * ((k & 7) + 1) & (1 << 64) - 1))[0]) for v in x)
            assert k == (least & ((1 << 56) - 16)) | k & 7
            low.setdefault(x, set()).add(k)
    assert all(len(x) == 2 for x in low.values())
    with pytest.raises(ValueError):
        substrings.repeated_passages(None, hashes=9)


@pytest.mark.parametrize("names,width", [(3, 6), (30, 10), (10**6, 46)])
def test_verify(names, width):
    """Every window that is similar to any window of the other text, and no other, as sets and in any order."""
    g = random.Random(names)
    for _ in range(60):
        a = [g.randrange(names) for _ in range(g.randint(width, 160))]
        b, k = list(a), g.randrange(len(a))
        b = [b[k:] + b[:k], b[:k] + b[k + 1:], b[:k] + [names] + b[k:], [*b[:k], names, *b[k + 1:]]][g.randrange(4)]
        sets = [set(b[j:j + width]) for j in range(len(b) - width + 1)]
        similar = [i for i in range(len(a) - width + 1)
                   if any(len(x & y) >= 0.8 * len(x | y) - 1e-9 for x in [set(a[i:i + width])] for y in sets)]
        a_, b_ = np.array(a, "<u4"), np.array(b, "<u4")
        covered = {k for i in similar for k in range(i, i + width) if a[k] in b}
        got = substrings._verify(a_, b_, np.arange(len(a) - width + 1), width, 0.8)
        assert covered == {k for first, last, _ in got for k in range(first, last + 1) if a[k] in b and k in covered}
        assert all({first, last} <= covered and a[first] == b[j] for first, last, j in got)


def test_token_files(spark, docs):
    t = Tokenizer.from_file(BYTE)
    got = token_files.token_files(docs, BYTE).collect()
    rows, start = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)), 0
    want = []
    for i, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(want, key=str) == sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=str)
    values = np.array([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7], "<u4")
    assert (token_files.unpack(*token_files.pack(values), len(values)) == values).all()
    assert len(token_files.unpack(*token_files.pack(values[:0]), 0)) == 0


def test_token_ids_are_as_wide_as_the_vocabulary(spark, docs, monkeypatch, tmp_path):
    assert [token_files.id_type(n) for n in (1 << 16, (1 << 16) + 1)] == ["<u2", "<u4"]
    got = token_files.token_files(docs, BYTE)
    token_files.write_tokens(docs, BYTE, str(tmp_path / "narrow"))
    held = spark.read.parquet(str(tmp_path / "narrow" / "encoded")).selectExpr("sum(octet_length(ids)) AS n").first().n
    assert held == 2 * sum(r.n_tokens for r in got.collect())
    monkeypatch.setattr(token_files, "id_type", lambda vocabulary: "<u4")
    assert sorted(map(str, token_files.token_files(docs, BYTE).collect())) == sorted(map(str, got.collect()))


@pytest.mark.parametrize("hot", [1 << 20, 3])
def test_lm(docs, hot):
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t, *_ in ROWS]
    one, two, ahead = Counter(), Counter(), Counter()
    for i, w in tokens:
        if not lm.held_out(i):
            one.update(w)
            two.update(zip([None, *w], w))
            ahead.update([None, *w[:-1]])
    n, v = sum(one.values()), len(one)
    p = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    got = by_id(lm.score(docs, hot).collect())
    for i, w in tokens:
        r = got[i][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (lm.held_out(i), len(w), sum(one[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10(p(x)) for x in w))
        exact = sum(math.log10((two[a, x] + lm.STRENGTH * p(x)) / (ahead[a] + lm.STRENGTH)) for a, x in zip([None, *w], w))
        assert abs(r.score - exact) <= 4e-4 * len(w)


def test_elias_fano():
    g = np.random.default_rng(1)
    for n, top in ((1, 10), (1000, 100), (1000, 10**9), (5000, 5000)):
        x = np.sort(g.integers(0, top, n))
        ef = EliasFano(x, top)
        assert (ef.get(np.arange(n)) == x).all()
        ask = g.integers(0, top, 500)
        assert (ef.successor(ask) == np.searchsorted(x, ask)).all()
    trie = BigramTrie(np.array([0, 0, 2]), np.array([1, 3, 0]), np.array([-1.0, -2, -3]), np.array([-0.5, -0.25, -1]), 4)
    got = trie.score(np.array([0, 0, 1, 2, 2]), np.array([1, 2, 2, 0, 3]), np.full(5, -4.0))
    assert np.allclose(got, [-1, -4.5, -4.25, -3, -5], atol=1e-3)


def test_lm_contexts_are_dealt_evenly():
    """The most frequent words of all buckets stand at the same places there; their contexts belong to different owners."""
    import pyarrow as pa

    from tagloom.llm.blocks import pack, pack_strings, split

    buckets, owners, names = 128, 512, [f"w{i}".encode() for i in range(300)]
    parts = split(names, buckets)
    totals = [pack(np.arange(len(at), dtype="<u4"), np.full(len(at), 100, "<i8")) for _, at in parts]
    at = np.r_[np.arange(300), np.arange(300)].astype("<u4")
    left = pa.table({"block": [0], "doc_ids": [[3]], "lens": [[len(at)]], "at": [pack(at)], "names": [pack_strings(names)]})
    right = pa.table({"bucket": [b for b, _ in parts], "totals": totals})
    out = lm._entries(30_000, 300, 1, buckets, owners, 1 << 20)(None, left, right)
    assert sum(b >= 0 for b in out.column("bucket").to_pylist()) > 150  # 301 contexts, 512 owners

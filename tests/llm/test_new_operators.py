"""Alignment, whitening and the n-gram Jaccard join against brute force, nulls, odd texts, ties, repeats, clashing columns."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import alignment, jaccard, whitening
from tagloom.llm.catalog import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
rng = random.Random(11)
VOCABULARY = ["".join(rng.choice("abcdeio") for _ in range(rng.randint(1, 9))) for _ in range(300)]
prose = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
CLASH = "doc_id long, text string, cls long, sig long, size int, lead long, block long, radix int, n long, root long, task int"


def rows_of(texts):
    return [(i, t, 1, 2, 3, 4, 5, 6, 7, 8, 9) for i, t in texts]


# ---- alignment

ODD = [None, "", " ", "one", "a ▁ b", "<|endoftext|> <s> </s> <0x41>", "Élan\x00 ÉLAN 漢字🙂 it's ½²\n\n\t x  ", "½" * 300, "﻿x\r\n", prose(4000), prose(50)]


def brute_alignment(rows):
    t, m = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    of_a = lambda i: bytes(byte_of[c] for c in t.id_to_token(i))
    of_b = lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for x in rows:
        a, b = (t.encode(" " + x, add_special_tokens=False).ids, m.encode(x)) if x else ([], [])
        if not x or any(b"".join(map(f, s)) != b" " + x.encode() for f, s in ((of_a, a), (of_b, b))):
            found.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(f(i)) for i in s]).tolist(), range(len(s)))) for f, s in ((of_a, a), (of_b, b))]
        links, groups, p, q = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0][e], ends[1][e]
            links.append((a[i], b[j]))
            groups.append(",".join(map(str, a[p:i + 1])) + "|" + ",".join(map(str, b[q:j + 1])))
            p, q = i + 1, j + 1
        counts.update(links)
        found.append((len(a), len(b), links, ";".join(groups)))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = f
            out.append((n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                        hashlib.sha256(groups.encode()).hexdigest()))
    return out, counts, most


@pytest.fixture(scope="module")
def odd(spark):
    texts = [*enumerate(ODD), (3, "one"), (None, prose(40)), (50, "the the the"), *((100 + i, prose(30)) for i in range(40))]
    return texts, spark.createDataFrame(rows_of(texts), CLASH).repartition(4)


@pytest.mark.parametrize("radix,block_bytes", [(1, 1 << 20), (5, 2000), (64, 100)])
def test_alignment_is_the_brute_force(odd, radix, block_bytes):
    texts, docs = odd
    want, *_ = brute_alignment([x for _, x in texts])
    got = alignment.align(docs, A, B, radix=radix, block_bytes=block_bytes).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *w)) for (i, _), w in zip(texts, want))
    assert want[4][0] == 0 and want[0][-1] == "" and want[6][0] > 0  # a U+2581 in a text comes back as a space


def test_pair_counts(odd):
    texts, docs = odd
    _, counts, most = brute_alignment([x for _, x in texts])
    got = {(r.a, r.b): (r.n, r.best) for r in alignment.pair_counts(docs, A, B, radix=7).collect()}
    assert got == {k: (n, n == most[k[1]]) for k, n in counts.items()}


def test_merge_of_runs():
    """Windows of any size give the same counts and maxima, ties included, and each record its place."""
    g = np.random.default_rng(5)
    runs = []
    for k in (0, 1, 400, 900, 3, 900):
        codes = np.unique((g.integers(0, 30, k) << 32) + g.integers(0, 40, k))
        runs.append((codes, g.integers(1, 4, len(codes)).astype("<u4")))
    total, most = Counter(), defaultdict(int)
    for codes, n in runs:
        total.update(dict(Counter()) | {int(c): int(x) for c, x in zip(codes, n)})
    for c, n in total.items():
        most[c >> 32] = max(most[c >> 32], n)
    for window in (1, 50, 1 << 16):
        seen, order = {}, []
        for codes, n, best, parts in alignment.merge(runs, window):
            order += codes.tolist()
            seen |= {c: (x, t) for c, x, t in zip(codes.tolist(), n.tolist(), best.tolist())}
            for i, s, e, back in parts:
                assert (codes[back] == runs[i][0][s:e]).all()
        assert order == sorted(total) and seen == {c: (n, n == most[c >> 32]) for c, n in total.items()}


def test_alignment_of_nothing(spark):
    assert alignment.align(spark.createDataFrame([], CLASH), A, B).collect() == []
    assert [tuple(r) for r in alignment.align(spark.createDataFrame(rows_of([(1, None)]), CLASH), A, B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_long_text_aligned(spark):
    text = prose(170_000)  # about a megabyte
    r, = alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).collect()
    (want,), *_ = brute_alignment([text])
    assert tuple(r) == (1, *want)


# ---- whitening

def whitened(spark, vectors, schema="vec_id long, embedding array<float>", **how):
    return whitening.whiten(spark.createDataFrame(vectors, schema), **how).collect()


def check_whitening(got, vectors, most=32):
    x = np.floor(np.array([v for _, v in vectors], np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    n = len(x)
    c = x - x.sum(axis=0) / n
    v = c.T @ c / n
    e = np.sort(np.linalg.eigvalsh(v))[::-1]
    rank = int((e > e[0] * 1e-12).sum())
    k = min(most, rank)
    assert len(got) == n * k and {r.n for r in got} == {n}
    deviation = Counter((i, sum((n * a - b) ** 2 for a, b in zip(row, x.sum(axis=0).tolist()))) for (i, _), row in zip(vectors, x.tolist()))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    by = {(r.component): r.explained for r in got}
    assert np.allclose([by[j + 1] for j in range(k)], e[:k] / np.trace(v), rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in got) and len({r.identity_error for r in got}) == 1
    # every component is an eigenvector: what the whitened rows give back has its variance and no other
    w = defaultdict(dict)
    for r in got:
        w[r.vec_id, r.deviation].setdefault(r.component, r.whitened)
    table = np.array([[w[i, sum((n * a - b) ** 2 for a, b in zip(row, x.sum(axis=0).tolist()))][j + 1] for j in range(k)] for (i, _), row in zip(vectors, x.tolist())])
    back = c.T @ table / n                       # V u / sqrt(e) = sqrt(e) u
    u = back / np.sqrt(e[:k])
    assert np.allclose(v @ u, u * e[:k], atol=1e-7 * e[0]) and np.allclose((u * u).sum(axis=0), 1, atol=1e-9)


def test_whitening(spark):
    g = np.random.default_rng(1)
    mixed = g.normal(size=(400, 48)) @ np.diag(np.r_[np.geomspace(20, 0.3, 48)]) @ g.normal(size=(48, 48)) + 5
    vectors = [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(mixed)]
    check_whitening(whitened(spark, vectors), vectors)


def test_whitening_of_low_rank(spark):
    """Constant and repeated dimensions have no components of their own."""
    g = np.random.default_rng(2)
    base = g.normal(size=(60, 3))
    vectors = [(i, [float(np.float32(c)) for c in (*row, row[0], 0.5, 0.5)]) for i, row in enumerate(base)]
    got = whitened(spark, vectors)
    assert {r.component for r in got} == {1, 2, 3}
    check_whitening(got, vectors)


def test_whitening_drops_and_keeps(spark):
    """Null vectors, null, NaN and infinite entries, odd lengths go; repeats, null ids and clashing columns stay out of the way."""
    g = np.random.default_rng(3)
    good = [(i % 20, [float(np.float32(c)) for c in g.normal(size=4)]) for i in range(40)]
    bad = [(1, None), (2, [1.0, None, 2.0, 3.0]), (3, [1.0, float("nan"), 2.0, 3.0]), (4, [float("inf"), 1.0, 1.0, 1.0]), (5, []), (6, [1.0] * 5)]
    null_id = (None, good[0][1])
    rows = [(i, v, 1, 2, 0.5, 1) for i, v in (*good, *bad, null_id)]
    got = whitened(spark, rows, "vec_id long, embedding array<float>, n long, component int, whitened double, x long")
    assert {r.n for r in got} == {41} and len(got) == 41 * 4 and sum(r.vec_id is None for r in got) == 4
    first = [r for r in got if r.vec_id in (None, 0)]
    assert len({(r.component, r.whitened) for r in first if r.vec_id is None} - {(r.component, r.whitened) for r in first if r.vec_id == 0}) == 0


def test_whitening_of_nothing(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None)]) == [] and whitened(spark, [(1, [])]) == []
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance


def test_large_deviation():
    m = whitening.Whitening(1 << 40, np.array([0]), np.ones(1), np.ones((1, 1)), 1.0)
    assert m.deviation(np.array([[0], [1 << 8], [1 << 60]])) == [0, None, None]


def test_factors():
    g = np.random.default_rng(4)
    for rank in (1, 5, 12):
        v = g.normal(size=(12, rank)) * np.geomspace(1, 1e-3, rank)
        v = v @ v.T
        low = whitening.pivoted_cholesky(v)
        assert low.shape[1] == rank and np.allclose(low @ low.T, v, atol=1e-12)
        turned = whitening.one_sided_jacobi(low)
        e = np.sort((turned * turned).sum(axis=0))[::-1]
        assert np.allclose(e, np.sort(np.linalg.eigvalsh(v))[::-1][:rank], rtol=1e-8)
        products = turned.T @ turned
        assert np.allclose(products, np.diag(np.diag(products)), atol=1e-13)


# ---- n-gram Jaccard join

def brute_components(texts, shingle=4, percent=85):
    sets = []
    for _, t in texts:
        w = [x for x in (t or "").encode().lower().split()]
        sets.append(frozenset(tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)) if len(w) >= shingle else frozenset([tuple(w)] if w else []))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(map(str, ((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(texts))))


def edited(text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
    return " ".join(w)


def planted():
    """Sets around the border of 0.85 in many sizes, chains, copies, groups of near copies, passages that many share."""
    texts = [None, "", " \n", "one", "ONE", "one two three", "one two three four", "One two  three\nfour"]
    for n in (8, 9, 10, 12, 15, 20, 30, 45, 60, 90, 150, 260, 420, 700):
        base = prose(n)
        texts.append(base)
        texts += [edited(base, k) for k in range(1, max(2, n // 40) + 2)]
        w = base.split()
        texts += [" ".join(w[:m]) for m in {n - 1, n - 2, int(n * 0.86) + 1, int(n * 0.84)}]
    chain = prose(200)
    for _ in range(12):
        texts.append(chain)
        chain = edited(chain, 5)
    crowd, shared = prose(120), prose(60)
    texts += [edited(crowd, rng.randint(0, 4)) for _ in range(60)] + [crowd] * 20
    texts += [shared + " " + prose(rng.randint(5, 60)) for _ in range(60)]
    out = list(enumerate(texts))
    rng.shuffle(out)
    return [*out, (None, texts[9]), (5, texts[40]), (None, "all alone here with no id at all")]


def test_jaccard_is_the_brute_force(spark):
    texts = planted()
    for percent in (85, 70):
        got = jaccard.similar_documents(spark.createDataFrame(rows_of(texts), CLASH).repartition(5), percent=percent).collect()
        assert sorted(map(str, (tuple(r) for r in got))) == brute_components(texts, percent=percent)


def test_jaccard_with_cut_signatures(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 3)
    texts = planted()
    got = jaccard.similar_documents(spark.createDataFrame(rows_of(texts), CLASH).repartition(5)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == brute_components(texts)


def crowd(n, links):
    """``n`` sets of 40 shingles with one signature, each two of which share 36 or 37 (``links``: linked, or just not)."""
    g, common = np.random.default_rng(4), 37 if links else 36
    words = lambda k: [f"w{x}" for x in g.integers(0, 1 << 40, k)]
    base = words(common + 3)
    return [(i, " ".join(base + words(40 - common))) for i in range(n)]


@pytest.mark.parametrize("links", [True, False])
def test_jaccard_rows_of_a_crowd(spark, monkeypatch, links):
    """What a crowded signature gives grows with its sets, not with their pairs; and no pair is left out."""
    texts, made, keep = crowd(60, links), {}, jaccard.materialize

    def count(df, name, *more):
        out = keep(df, name, *more)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "materialize", count)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ids = {jaccard.class_of(h): i for i, t in texts for h in [jaccard.Shingles()(t)]}
    rows = keep(jaccard.profiles(docs), "crowd")
    each = F.array(F.struct(F.col("band").alias("band"), F.col("own").alias("bits")), F.struct((F.col("band") + 1).alias("band"), F.col("next").alias("bits")))
    sketches = rows.select("cls", "text_hash", F.col("size").cast("int").alias("size"), F.inline(each)).where("bits IS NOT NULL")
    band = sketches.first().band
    sketches, lead = sketches.where(f"band = {band}"), min(ids)
    met = spark.createDataFrame([(7, band, lead, 40, c, 40) for c in ids if c != lead], jaccard.MET)
    roots = spark.createDataFrame([], "node long, root long")
    # no sketch rules a pair out here: all 1,770 have to be intersected or connected
    monkeypatch.setattr(jaccard, "_pairs_of", lambda bits, cut, root, size, percent: (*np.triu_indices(len(bits), 1), np.zeros(len(bits) * (len(bits) - 1) // 2, np.int64)))
    cross = jaccard.cross_pairs(met, sketches, roots).collect()
    assert len(cross) <= 2 * 60 + 1 and [r.open for r in cross if r.open is not None] == [7]
    got = jaccard.closing_links(met, sketches, roots, docs).collect()
    assert len(got) == (59 if links else 0)
    assert made["jaccard-members"] == 60
    root = {r.node: r.root for r in jaccard.connected(spark.createDataFrame(got, "a long, b long")).collect()}
    assert len(root) == (59 if links else 0) and set(root.values()) <= {min(ids)}


def test_jaccard_without_leads_in_one_stretch(spark):
    """Stretches of a few signatures: sets meet over stretches, not within."""
    texts = planted()
    docs = spark.createDataFrame(rows_of(texts), CLASH).repartition(5)
    sets = jaccard.profiles(docs).persist()
    met = jaccard.meetings(jaccard.signatures(sets, most=1))
    met = met.select("sig", "cls").union(met.select("sig", "lead"))
    whole = jaccard.meetings(jaccard.signatures(sets))
    whole = whole.select("sig", "cls").union(whole.select("sig", "lead"))
    assert set(map(tuple, met.collect())) == set(map(tuple, whole.collect()))


def test_linked_sets_share_a_signature():
    """PartEnum's promise, also where signatures without elements are left out."""
    g, sign = np.random.default_rng(6), jaccard.Signer()
    for size in (*range(1, 60), 100, 333, 1000):
        for _ in range(12):
            x = np.unique(jaccard._mix(g.integers(0, 1 << 62, size).astype(np.uint64)))
            fewer = len(x) - int(g.integers(0, max(1, int(0.15 * len(x)) + 1)))
            y, fresh = x[g.permutation(len(x))[:fewer]], 0
            while 100 * len(y) >= 85 * (len(x) + fresh + 1):
                fresh += 1
            y = np.unique(np.r_[y, jaccard._mix(g.integers(0, 1 << 62, fresh).astype(np.uint64))])
            both = len(np.intersect1d(x, y))
            if 100 * both >= 85 * (len(x) + len(y) - both) and not len(x) == len(y) == both:
                assert len(np.intersect1d(sign(x), sign(y))), (len(x), len(y), both)
                for b in set(sign.bands(len(x))) & set(sign.bands(len(y))):
                    one, two = (int.from_bytes(jaccard.sketch(s, b), "little") for s in (x, y))
                    assert (one ^ two).bit_count() <= len(x) + len(y) - 2 * both <= jaccard.most_apart(len(x) + len(y))


def test_signatures_of_nothing():
    """Sets so thin that all partitions that agree may agree in nothing."""
    g, sign = np.random.default_rng(8), jaccard.Signer()
    met = 0
    for index in (10, 14, 18):
        first = jaccard.band(index)[0]
        n1, n2, subsets, spare = jaccard.plan(index)
        for _ in range(40):
            x = np.unique(jaccard._mix(g.integers(0, 1 << 62, first).astype(np.uint64)))
            cell = (x >> np.uint64(32)) * np.uint64(n1) >> np.uint64(32)
            keep = np.isin(cell, np.unique(cell)[:n1 - spare - 2])  # nothing at all in the last partitions
            x = x[keep]
            y = x[1:]
            met += len(sign.sign(x, index)) > 0
            assert len(np.intersect1d(sign.sign(x, index), sign.sign(y, index)))
            other = np.unique(jaccard._mix(g.integers(0, 1 << 62, first).astype(np.uint64)))
            assert not len(np.intersect1d(sign.sign(x, index), sign.sign(other, index)))
    assert met == 120


def test_connected(spark):
    g = random.Random(2)
    links = [(a, a + 1) for a in range(0, 60)] + [(g.randrange(100, 400), g.randrange(100, 400)) for _ in range(200)] + [(900, 901), (901, 900), (5, 5)]
    links += [(1000, x) for x in range(1001, 1200)] + [(1500, 1100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.root for r in jaccard.connected(df).collect()}
    assert got == {x: find(x) for x in list(root) if find(x) != x}
    assert jaccard.connected(df.limit(0)).collect() == []


def test_bands_and_distances():
    for percent in (70, 85, 95):
        for i in range(40):
            last = jaccard.band(i, percent)[1]
            assert jaccard.band(i + 1, percent)[0] == last + 1 and 100 * last // percent <= jaccard.band(i + 1, percent)[1]
        for total in range(2, 200):
            apart = max((x + y - 2 * both for t in range(1, total + 1) for x in range(1, t) for y in [t - x]
                         for both in [-(-percent * t // (100 + percent))] if both <= min(x, y)), default=0) if total < 60 else None
            assert apart is None or jaccard.most_apart(total, percent) >= apart


def test_jaccard_of_nothing_and_long(spark):
    assert jaccard.similar_documents(spark.createDataFrame([], CLASH)).collect() == []
    text = prose(150_000)
    got = jaccard.similar_documents(spark.createDataFrame([(2, text), (1, text + " more"), (3, prose(900))], "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_registered():
    assert {"op11_alignment", "op12_whitening", "op13_ngram_jaccard"} <= set(QUERIES)


def test_a_vector_is_whitened_alike_in_every_batch():
    g = np.random.default_rng(5)
    x = g.integers(0, 1 << 21, (200, 9))
    m = whitening.Whitening(200, x.sum(axis=0), g.random(7) + 1, g.normal(size=(9, 7)), 1.0)
    whole = m.project(x)
    assert all((m.project(x[s:e]) == whole[s:e]).all() for s, e in [(i, i + 1) for i in range(200)] + [(3, 20), (50, 187)])

"""Operators 11 to 13: ranked search, dataset manifest, packing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle, nra, ss_packing
from ledgerline.llm.registry import WORD_VOCABULARY, queries

from . import brute

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- ranked search ---------------------------------------------------------------------

def _texts(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "A1b", "z"]
    return [" ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(1, 40))) for _ in range(n)]


CASES = [
    (1, "Alpha beta-beta, gamma"), (2, "alpha BETA"), (3, "alpha BETA"), (3, "alpha beta"), (None, "alpha beta"),
    (4, ""), (5, None), (6, " \n.,;"), (7, "ünï-Ünï alpha"), (8, "gamma " * 30_000), (9, "delta"),
]


@pytest.mark.parametrize("k", [1, 2, 50])
def test_search_cases(spark, docs_of, k):
    items = [(1, "ALPHA, beta"), (2, "gamma"), (2, "delta"), (3, "nothing-here"), (4, None), (5, ""), (None, "Ünï delta"), (6, "alpha " * 500)]
    frame = spark.createDataFrame([r + ("x", 1) for r in items], "item_id long, text string, doc_id string, rank int")
    assert rows(nra.search(docs_of(CASES), frame, k)) == brute.ranked_search(CASES, items, k)


def test_search_blocks_and_ties(spark, docs_of):
    docs = list(enumerate(_texts(300) + ["w1 w2 w3"] * 80))
    items = list(enumerate(_texts(25, 9)))
    d, i = docs_of(docs).repartition(7), spark.createDataFrame(items, "item_id long, text string")
    assert rows(nra.search(d, i, 10)) == brute.ranked_search(docs, items, 10)
    blocks = list(nra.blocks(i, 400))
    assert len(blocks) > 3 and sorted(x for b in blocks for x, _ in b) == list(range(25))
    assert all(len(b) == 1 or sum(len(t) + 8 for _, m in b for t in m) <= 400 for b in blocks)
    found = [r for b in blocks for r in rows(nra.search_block(d, b, 10))]
    assert sorted(found, key=str) == brute.ranked_search(docs, items, 10)


def test_search_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(nra.search(docs_of([]), items)) == []
    assert rows(nra.search(docs_of([(1, "a")]), items.limit(0))) == []


@pytest.mark.parametrize("least", [0, 10**9])
def test_reads_stop_when_resolved(monkeypatch, least):
    """Rare heavy terms settle the best documents before the long lists are read."""
    rng = np.random.default_rng(1)
    n = 5000
    lists = [np.sort(rng.choice(n, size, replace=False)) for size in (40, 60, 4500, 4800)]
    ids = np.concatenate([np.full(len(x), t) for t, x in enumerate(lists)])
    doc = np.concatenate(lists)
    order = np.lexsort((ids, doc))
    ids, doc = ids[order], doc[order]
    tf = rng.integers(1, 5, len(ids)).astype(np.int64)
    weight = np.array([5000, 4800, 12, 9])
    monkeypatch.setattr(nra, "DEPTH", 8)
    s = nra.Shard(ids, tf, np.bincount(doc, minlength=n), np.full(n, 50), n, 50 * n, weight)
    m = 100
    exact = np.bincount(doc, weight[ids] * ((10**9 * tf) // (1000 * tf + 20 * m)), n).astype(np.int64)
    read = []
    whole = np.arange
    monkeypatch.setattr(nra.np, "arange", lambda *a: read.append(a[1] - a[0]) or whole(*a) if len(a) == 2 else whole(*a))
    found, score = s.best(np.arange(4), 10, least)
    assert (score == exact[found]).all()
    best = max(least, np.sort(exact)[-10])
    assert set(found) == set(np.flatnonzero((exact >= best) & (exact > 0)))
    assert sum(read) < 2 * len(ids)


# -- manifest ---------------------------------------------------------------------------

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, rank int, leaf string, seq long"


def _manifest(spark, data, parts=3):
    df = spark.createDataFrame([r + ("x", 1, "y", 2) for r in data], SCHEMA).repartition(parts)
    return rows(merkle.verify(df, "crc32(cast(doc_id AS STRING)) % 2 = 0", r"replace(text, '\n', '')"))


def _brute_manifest(data):
    even = lambda i: i is not None and zlib.crc32(str(i).encode()) % 2 == 0
    return brute.merkle(data, even, lambda t: None if t is None else t.replace("\n", ""))


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (4, 9, 10), (81, 82), (27, 250, 1, 1, 1, 1, 5)])
def test_manifest_shapes(spark, sizes):
    data = [(1000 * s + i, f"s{s}", "en", i, f"text {i}\n" * (i % 3)) for s, n in enumerate(sizes) for i in range(n)]
    assert _manifest(spark, data) == _brute_manifest(data)


def test_manifest_cases(spark):
    data = [
        (1, None, None, None, None), (2, None, "en", 3, "a\nb"), (3, "", "en", 0, ""), (4, "ü", "de", 1, "ü\n"), (5, "z", None, 7, "\n\n"),
        (6, "z", "en", 1, "x\ny"), (6, "z", "en", 1, "x\ny"), (6, "z", "en", 2, "x\ny"), (None, "z", "en", 1, "q\n"), (None, "z", "en", 1, "q\n"),
        (-7, "z", "en", 1, "-"), (8, "z", "en", 2_000_000, "long\n" * 400_000),
    ] + [(50, "copies", "en", 4, "same")] * 100
    got = _manifest(spark, data, 5)
    assert got == _brute_manifest(data)
    assert {r[6] for r in got} == {True, False}
    assert len({r[3] for r in got}) == 1


def test_manifest_many_sources(spark):
    data = [(i, f"host{i % 300}", "en", 1, f"t{i}") for i in range(700)]
    assert _manifest(spark, data) == _brute_manifest(data)


def test_manifest_empty(spark):
    assert _manifest(spark, []) == []


def test_intervals_nest(spark):
    """Labels of a level tile the group's ranks, and children tile their parent."""
    leaves = spark.createDataFrame([("s", 200, i, f"{i:064x}") for i in range(200)], "g string, n long, rank long, leaf string")
    got = [r for b, band in enumerate(merkle.build(leaves)) for r in merkle._nodes(band, b).collect()]
    for level in {r["level"] for r in got}:
        spans = sorted((r["lo"], r["hi"]) for r in got if r["level"] == level)
        assert spans[0][0] == 0 and spans[-1][1] == 200 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for r in got:
        assert [r["lo"], *[k["hi"] for k in r["kids"]]] == [*[k["lo"] for k in r["kids"]], r["hi"]]


# -- packing -----------------------------------------------------------------------------

def _encode(texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(P.path(WORD_VOCABULARY))
    return [own.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


TEXTS = [
    "", None, "One two's 'S DON'T  we'll\n\ttab", "Ünïcödé straße ĐƏ ǅ İstanbul ΣΊΣΥΦΟΣ ΑΣ", "日本語 の テキスト", "é combining à", "x² ½ ١٢٣ 12345",
    "\x1c sep \x85 nel \xa0nbsp", "under_score __ a_b", "</w> <|endoftext|> <|startoftext|>x", "!!! ??? ... -- ''s", "word " * 9000, "ａｂｃ ＡＢＣ", "🙂🙂 emoji",
    "it'system re're 'LL", "Ǆ ß ẞ ŉ", "­ soft­hyphen ª º µ",
]


def test_tokens_equal_the_library(spark, docs_of):
    import public_tokenizers as P

    got = ss_packing.pieces(docs_of(list(enumerate(TEXTS))), P.path(WORD_VOCABULARY), room=100, keep=("doc_id", "_text")).collect()
    assert {r["_text"] for r in got} == {7}
    for i, want in enumerate(_encode(TEXTS)):
        mine = sorted((r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got if r["doc_id"] == i)
        assert [m[0] for m in mine] == list(range(len(mine))) and [m[1] for m in mine] == list(range(0, len(want), 100))
        assert np.frombuffer(b"".join(m[3] for m in mine), "<u4").tolist() == want
        assert all(m[2] == 100 for m in mine[:-1]) and all(m[2] == len(m[3]) // 4 for m in mine)


def _valid(packed, room):
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= room
    return len(by)


@pytest.mark.parametrize("block", [16_384, 100])
def test_packing_is_gapless_and_tight(spark, monkeypatch, block):
    monkeypatch.setattr(ss_packing, "BLOCK", block)
    rng = random.Random(5)
    sizes = [min(1000, 1 + int(rng.paretovariate(0.8) * 10)) for _ in range(3000)] + [1000] * 7 + [1] * 40
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long").repartition(5)
    got = ss_packing.pack(df, 1000).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == list(enumerate(sizes))
    used, least = _valid(got, 1000), -(-sum(sizes) // 1000)
    assert used <= least * 1.01 + 1


def test_place_follows_the_rule():
    """Every step against the sums of squares written out."""
    rng = random.Random(2)
    sizes = np.array(sorted((rng.randint(1, 30) for _ in range(400)), reverse=True))
    seq, off, gaps = ss_packing.place(sizes, 40)
    fill = {}
    for s, q, o in zip(sizes.tolist(), seq.tolist(), off.tolist()):
        assert fill.get(q, 0) == o
        fits = sorted({40 - f for f in fill.values() if s <= 40 - f and f < 40})
        if fits:
            def total(g):
                after = [40 - f for f in fill.values()]
                after[after.index(g)] = g - s
                return sum(after.count(x) ** 2 for x in set(after) if x)
            assert 40 - o == min(fits, key=lambda g: (total(g), g))
        else:
            assert o == 0 and q not in fill
        fill[q] = o + s
    assert [40 - fill[q] for q in range(len(gaps))] == gaps.tolist()


def test_sequences_hold_the_tokens(spark, docs_of):
    import public_tokenizers as P

    texts = ["a b c", "d " * 30, None, "e f", "", "a b c"]
    cut = ss_packing.pieces(docs_of(list(enumerate(texts))), P.path(WORD_VOCABULARY), room=16)
    got = ss_packing.sequences(ss_packing.pack(cut, 16)).collect()
    whole = sorted(x for r in got for x in np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    assert whole == sorted(x for ids in _encode(texts) for x in ids)
    assert all(len(r["ids"]) <= 64 for r in got) and sum(r["n_pieces"] for r in got) == cut.count()


def test_packing_empty(spark, docs_of):
    import public_tokenizers as P

    assert ss_packing.pack(ss_packing.pieces(docs_of([]), P.path(WORD_VOCABULARY))).collect() == []


def test_packing_query(spark):
    got = queries()["op13_ss_packing"](spark, SF).collect()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r, ids in zip(texts, _encode([r["text"] for r in texts])):
        for p in range(0, len(ids), 4096):
            part = np.array(ids[p:p + 4096], "<u4")
            want.append((r["doc_id"], p // 4096, p, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert _valid(got, 4096) <= -(-sum(w[3] for w in want) // 4096) + 1


@pytest.mark.parametrize("name", ["op11_nra_search", "op12_merkle_manifest"])
def test_query_matches_oracle(spark, name):
    from ledgerline.llm.oracle import statements
    from tools.compare import duck, rows_of

    df = queries()[name](spark, SF)
    cur = duck(SF).execute(statements()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())
    if name == "op12_merkle_manifest":
        assert df.select("verified").distinct().count() == 2 and df.where(F.expr("folded_root = root")).count()

"""Decontamination against brute force."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from scrubline.llm import decontaminate as dc
from scrubline.llm.decontaminate import Decontamination
from scrubline.llm.queries import ORACLE_SQL, QUERIES

ITEMS = "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        size = min(window, len(w))
        for j in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[j : j + size]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, scale):
    sf = f"/root/testdata/{scale}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    result = found(QUERIES["op4_benchmark_decontamination"](spark, sf))
    assert result == brute(docs, items)
    assert any(r[-1] for r in result)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, scale):
    sf = f"/root/testdata/{scale}"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    result = con.execute(ORACLE_SQL["op4_benchmark_decontamination"])
    names = [c[0] for c in result.description]
    rows = QUERIES["op4_benchmark_decontamination"](spark, sf).select(names).collect()
    assert sorted(map(tuple, rows)) == sorted(result.fetchall())


def test_edges(spark, documents):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (1, long), (2, "Short Item!"), (3, None), (4, "..."), (None, "no id here"), (5, "É été"), (10, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 other")]
    texts = [None, "", "...", "short-item", "a short item, short item", "no id here", "É été É", "é été", long.upper(), long * 3, "w1 w2 w3 w4 w5 w6 w7 w8 w9", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10", "x " + " ".join(f"w{i}" for i in range(5, 30)) + " y short item"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "short-item"), (None, "short item")]
    docs = documents(rows).withColumns({"matches": F.lit("mine"), "n_words": F.lit(0)})
    bench = spark.createDataFrame(items, ITEMS).withColumn("lang", F.lit("x"))
    expected = brute(rows, items)
    assert found(dc.report(docs, bench)) == expected
    # Several passes over blocks of the benchmark give the same.
    assert found(dc.report(docs, bench, Decontamination(block_bytes=100))) == expected
    kept = dc.clean(documents(rows), bench)
    assert kept.columns == documents(rows).columns
    assert kept.count() == sum(not r[-1] for r in expected)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert found(dc.report(documents([]), none)) == []
    assert found(dc.report(documents(["a b"]), none)) == brute([(0, "a b")], [])
    assert found(dc.report(documents([]), spark.createDataFrame([(1, "a b")], ITEMS))) == []


@pytest.mark.parametrize("seed", range(4))
def test_random_small_vocabulary(spark, documents, seed):
    """Few words, so that matches overlap, repeat and extend."""
    rnd = random.Random(seed)
    text = lambda n, k: " ".join(rnd.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i, text(rnd.randint(0, 9), 3)) for i in range(12)]
    rows = [(i, text(rnd.randint(0, 60), rnd.choice([2, 3, 5]))) for i in range(60)]
    rule = Decontamination(window=4, shard_bytes=rnd.choice([1, 50, 5000]))
    assert found(dc.report(documents(rows), spark.createDataFrame(items, ITEMS), rule)) == brute(rows, items, 4)


def test_longest_matches_and_locations(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x y " + " ".join(f"w{i}" for i in range(3, 25)) + " z"
    row = dc.with_matches(documents([(1, text)]), spark.createDataFrame([(7, item)], ITEMS)).first()
    assert [tuple(m) for m in row.matches] == [(2, 22, 7, 3)]


def test_pieces_of_a_long_text(monkeypatch):
    text = "Ein langer Text, mit éàü Wörtern 123 und mehr. " * 50
    whole = dc._Hasher().hashes(text.lower().encode())
    monkeypatch.setattr(dc, "_PIECE", 64)
    assert (dc._Hasher().hashes(text.lower().encode()) == whole).all()
    assert len(whole) == len(plain_words(text))


def longest(words, start, items, window):
    """Words that the longest match from a place has."""
    best = 0
    for item in items:
        for j in range(len(item)):
            n = 0
            while j + n < len(item) and start + n < len(words) and item[j + n] == words[start + n]:
                n += 1
            best = max(best, n if n >= min(window, len(item)) else 0)
    return best


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_matches_are_the_longest(spark, documents, block_bytes):
    """Each match is verbatim, the longest from its place, and the matches cover all hits; also if items are cut in pieces."""
    rnd = random.Random(block_bytes)
    text = lambda n, k: " ".join(rnd.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i // 2, text(rnd.choice([1, 3, 8, 50]), 4)) for i in range(16)]
    rows = [(i, text(rnd.randint(0, 20), 4) + " " + items[i % 16][1] + " " + text(5, 6)) for i in range(64)]
    rule = Decontamination(window=4, block_bytes=block_bytes)
    table = spark.createDataFrame(items, ITEMS)
    hits = {r[0]: r[2] for r in brute(rows, items, 4)}
    texts = {}
    for item, whole in items:
        texts.setdefault(item, []).append(plain_words(whole))
    for row in dc.with_matches(documents(rows), table, rule).collect():
        w, covered = plain_words(row.text), set()
        for m in row.matches:
            part = w[m.start : m.start + m.length]
            assert any(whole[m.item_start : m.item_start + m.length] == part for whole in texts[m.item_id])
            if block_bytes > 60:
                assert m.length == longest(w, m.start, [x for own in texts.values() for x in own], 4)
            covered |= set(range(m.start, m.start + m.length))
        assert len(covered) == hits[row.doc_id]


def test_block_bound(spark, documents):
    """Very many equal items are one, a long one is cut: no block is over its limit, and every window is in one piece."""
    rnd = random.Random(4)
    long = " ".join(f"t{rnd.randint(0, 5000)}" for _ in range(20_000))
    own = [f"item {i} " + " ".join(f"u{rnd.randint(0, 900)}" for _ in range(rnd.randint(3, 30))) for i in range(200)]
    same = "the same item again and again in this table of the benchmark"
    items = [(1, same)] * 10_000 + [(i + 10, x) for i, x in enumerate(own)] + [(9999, long)]
    rule = Decontamination(block_bytes=40_000)
    dealt = dc.blocks(spark.createDataFrame(items, ITEMS), rule).collect()
    sizes = {}
    for r in dealt:
        sizes[r.cell, r.block] = sizes.get((r.cell, r.block), 0) + len(r.text) + 1
    assert max(sizes.values()) <= rule.block_bytes and sum(r.item_id == 1 for r in dealt) == 1
    windows = sorted(r.first + j for r in dealt if r.item_id == 9999 for j in range(len(r.text.split()) - rule.window + 1))
    assert windows == list(range(20_000 - rule.window + 1))
    middle = " ".join(long.split()[1000:15_000])
    rows = [(1, same.upper()), (2, "x " + middle + " y"), (3, own[7] + " and " + own[8]), (4, "nothing of it")]
    result = dc.with_matches(documents(rows), spark.createDataFrame(items, ITEMS), rule)
    assert found(dc.report(documents(rows), spark.createDataFrame(items, ITEMS), rule)) == brute(rows, list(dict.fromkeys(items)))
    # A match that goes through several pieces, in several blocks, is one.
    assert [tuple(m) for m in result.filter("doc_id = 2").first().matches] == [(1, 14_000, 9999, 1000)]


def test_no_pairs_of_places_and_items(spark, documents):
    """A passage that a document repeats and very many items share: one match per place, and each item once."""
    passage = " ".join(f"p{i}" for i in range(12))
    items = [(i, f"own{i} {passage} tail{i}") for i in range(500)]
    rows = [(1, f"{passage} x " * 300), (2, f"own7 {passage} tail7")]
    result = {r.doc_id: r for r in dc.with_matches(documents(rows), spark.createDataFrame(items, ITEMS)).collect()}
    assert [(m.start, m.length) for m in result[1].matches] == [(13 * i, 12) for i in range(300)] and result[1].item_ids == list(range(500))
    assert [tuple(m) for m in result[2].matches] == [(0, 14, 7, 0)]
    assert found(dc.report(documents(rows), spark.createDataFrame(items, ITEMS))) == brute(rows, items)

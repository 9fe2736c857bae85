"""Quality rules: features and cutoffs against brute force."""

import math
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from scrubline.llm import risk_rules as rr
from scrubline.llm.queries import ORACLE_SQL, QUERIES
from scrubline.llm.risk_rules import Risk, Rule

LABELS = "doc_id bigint, quality int, toxic int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, scale):
    sf = f"/root/testdata/{scale}"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op10_quality_rules"](spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(docs))
    for r in rows:
        expected = plain(docs[r.doc_id])
        assert tuple(r)[1:6] == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_equals_sql(spark, scale):
    """At sf0.1 the labels suffice for cutoffs, so the binomial tests and the ladders are compared too."""
    sf = f"/root/testdata/{scale}"
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    result = con.execute(ORACLE_SQL["op10_quality_rules"])
    names = [c[0] for c in result.description]
    expected = sorted(result.fetchall())
    rows = sorted(map(tuple, QUERIES["op10_quality_rules"](spark, sf).select(names).collect()))
    assert rows == expected
    rejected = sum(not r[-1] and not r[-2] for r in expected)
    assert (rejected > 0) == (scale == "sf0.1")


def exact_below(x, n, p):
    p = Fraction(p).limit_denominator(10**6)
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(x + 1)))


def test_binomial():
    for n in (1, 2, 10, 57, 400):
        for p in (0.001, 0.02, 0.3, 0.5, 0.9):
            for x in {0, 1, n // 10, n // 2, n - 1, n}:
                assert rr.binomial_below(x, n, p) == pytest.approx(exact_below(x, n, p), rel=1e-9, abs=1e-14)
    assert rr.binomial_below(0, 0, 0.1) == 1.0


def test_cutoffs_and_verdicts(spark, documents):
    rnd = __import__("random").Random(5)
    rows, labels = [], []
    for i in range(4000):
        lang = "en" if i % 4 else "de"
        symbols = rnd.choice([0] * 30 + [1, 2]) if i % 10 else 30
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(60)]
        rows.append((i, " ".join(words + ["#"] * symbols), lang))
        if i % 3:
            labels.append((i, int(i % 10 != 0), 0))
    docs = documents(rows)
    risk = Risk(risk=0.05, error=0.1, rules=(Rule("symbols", "n_symbols / n_words", (0.5, 0.4, 0.3, 0.2, 0.1, 0.03, 0.02, 0.01, 0.0)),))
    good = {i for i, q, _ in labels if q}
    label_table = spark.createDataFrame(labels, LABELS)
    expected = {}
    for lang in ("en", "de"):
        ratios = [p[2] / p[0] for i, t, g in rows if g == lang and i in good and (p := plain(t))]
        for c in risk.rules[0].ladder:
            if exact_below(sum(x > c for x in ratios), len(ratios), 0.05) > 0.1 / 2:
                break
            expected[lang] = c
    assert len(set(expected.values())) >= 1 and min(expected.values()) < 0.3
    featured = rr.with_features(docs)
    assert {r.lang: r.symbols for r in rr.cutoffs(featured, label_table, risk).collect()} == expected
    for r in rr.judge(docs, label_table, risk).collect():
        p = plain(rows[r.doc_id][1])
        assert r.kept == (p[2] / p[0] <= expected[r.lang])


def test_too_few_labels_reject_nothing(spark, documents):
    docs = documents([(i, " ".join(f"a{j}{i}" for j in range(60)) + " ###" * 20) for i in range(40)])
    for labels in ([], [(i, 1, 0) for i in range(30)], [(None, 1, 0), (3, None, None), (99, 1, 1)]):
        assert all(r.kept for r in rr.report(docs, spark.createDataFrame(labels, LABELS)).collect())


def test_edges(spark, documents):
    texts = [None, "", " \n\t", "one", "a b c a b c", "x " * 20_000, "l\nl\n\nl\n \n ", "é#é  x \x1cy", "a b a b a", "a a a a", "a b c d"]
    rows = [(i, t, None if i % 2 else "en") for i, t in enumerate(texts)] + [(0, None, "en"), (None, "x", "en")]
    docs = documents(rows).withColumns({"kept": F.lit("mine"), "n_words": F.lit("mine")})
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], LABELS)
    found = rr.report(docs, labels).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter((d, *plain(t)) for d, t, _ in rows)
    assert rr.report(documents([]), labels).collect() == []


def test_good_documents_stay_and_junk_falls(spark):
    """At sf0.1 the labels suffice for the larger strata; what the cutoffs reject is mostly labelled as bad."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = QUERIES["op10_quality_rules"](spark, sf).filter("not base_failed").join(labels, "doc_id")
    rates = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.98
    assert rates[0] < 0.6


def test_repeats_count_once(spark, documents):
    """Labelled rows fifty times, and as copies under other ids: the cutoffs are those of the rows once."""
    rnd = __import__("random").Random(7)
    rows, labels = [], []
    for i in range(900):
        rows.append((i, " ".join([f"w{rnd.randint(0, 10**6)}" for _ in range(60)] + ["#"] * rnd.choice([0] * 40 + [1, 2])), "en"))
        labels.append((i, 1, 0))
    few = rows[:60]
    risk = Risk(risk=0.05, error=0.1, rules=(Rule("symbols", "n_symbols / n_words", (0.5, 0.3, 0.1, 0.03, 0.02, 0.01, 0.0)), Rule("capitals", "n_upper / word_chars", (0.9, 0.5))))

    def found(docs, labelled):
        out = rr.cutoffs(rr.with_features(documents(docs)), spark.createDataFrame(labelled, LABELS), risk).collect()
        return {r.lang: (r.symbols, r.capitals) for r in out}

    once = found(rows, labels)
    assert once["en"][0] is not None and once["en"][0] > 0
    assert found(rows * 50, labels) == once
    assert found(rows + [(10_000 + i, t, g) for i, t, g in rows], labels + [(10_000 + i, 1, 0) for i in range(900)]) == once
    # Sixty documents show nothing, however often they are repeated; a second text of an id is no second document.
    assert found(few * 50, labels) == found(few, labels) == {"en": (None, None)}
    assert found(few + [(i, t + f" x{k}", g) for i, t, g in few for k in range(20)], labels) == {"en": (None, None)}


def test_very_long_text(spark, documents):
    long = " ".join(f"w{i % 70_000}" for i in range(500_000))
    (row,) = rr.report(documents([(1, long)]), spark.createDataFrame([(1, 1, 0)], LABELS)).collect()
    assert tuple(row)[1:6] == plain(long)

"""The mix: targets against the stated process, fits against exhaustive search, whole results."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubline.llm import mixing
from scrubline.llm.mixing import Mix
from scrubline.llm.queries import QUERIES


def plain_targets(sizes):
    """By the process itself: share out, stop the full ones, share the excess among the others, until none is over."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        rest = total - sum(target[s] for s in names if s not in open_)
        for s in open_:
            target[s] = rest * weight[s] / sum(weight[o] for o in open_)
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        open_ -= over
    return target


def check(rows, docs):
    """rows: the report's; docs: (doc_id, text, source)."""
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += words(t)
    target = plain_targets(sizes)
    source = {d: s for d, _, s in docs}
    assert Counter((r.doc_id, r.size, r.source_size) for r in rows) == Counter((d, words(t), sizes[s]) for d, t, s in docs)
    taken = Counter()
    for r in rows:
        assert r.target == pytest.approx(target[source[r.doc_id]], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    return taken, target


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, scale):
    sf = f"/root/testdata/{scale}"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op6_mixing"](spark, sf).collect()
    taken, target = check(rows, docs)
    for s in target:
        assert abs(taken[s] - target[s]) <= max(1, 0.01 * target[s]) or min(r.size for r in rows if r.size) > 1
    again = mixing.report(spark.read.parquet(f"{sf}/documents.parquet").repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_edges(documents):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "one two", "en", None), (4, "x", "en", "b"), (5, "x " * 500, "en", "b")]
    rows += [(6, "same text", "en", "c")] * 3 + [(None, "no id", "en", "c")] + [(i, "w " * (i % 9), "en", "d") for i in range(10, 90)]
    docs = documents(rows).withColumns({"size": F.lit("mine"), "times": F.lit(0), "long": F.lit(1), "rounds": F.lit(2)})
    report = mixing.report(docs).collect()
    check(report, [(d, t, s) for d, t, _, s in rows])
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    held = Counter()
    for r in mix.collect():
        held[r.doc_id] += len((r.text or "").split())
        assert r["size"] == "mine"
    expected = Counter()
    for r in report:
        expected[r.doc_id] += r.taken
    assert +held == +expected
    assert mixing.report(documents([])).collect() == [] and mixing.mixed(documents([])).collect() == []
    only_empty = mixing.report(documents([None, ""])).collect()
    assert [(r.taken, r.target) for r in only_empty] == [(0, 0.0), (0, 0.0)]


def test_hot_length(documents):
    """One length holds nearly all documents: exactly the planned number of it is taken, one source's rows or not."""
    rows = [(i, "five words are in it", "en", "s1") for i in range(3000)] + [(9000 + i, "a b", "en", "s0") for i in range(10)]
    taken, target = check(mixing.report(documents(rows)).collect(), [(d, t, s) for d, t, _, s in rows])
    assert abs(taken["s1"] - target["s1"]) <= 3 and taken["s0"] == 60


@pytest.mark.parametrize("seed", range(6))
def test_fit_is_as_near_as_any(seed):
    rnd = random.Random(seed)
    sizes = np.array(sorted(rnd.sample(range(1, 40), 4)))
    counts = np.array([rnd.randint(0, 3) for _ in sizes])
    sums = {int(np.dot(sizes, c)) for c in itertools.product(*[range(n + 1) for n in counts])}
    for budget in range(0, int(sizes @ counts) + 1):
        got = mixing._knapsack(budget, sizes, counts)
        assert (got <= counts).all() and (got >= 0).all()
        assert abs(int(got @ sizes) - budget) == min(abs(s - budget) for s in sums)


def test_fit_spends_the_budget():
    rnd = random.Random(3)
    sizes = np.arange(1, 3000)
    counts = np.array([rnd.randint(1, 50) for _ in sizes])
    for budget in (1, 17, 1_000_003, int(sizes @ counts) - 1):
        got = mixing.fit(budget, sizes, counts, 16_384)
        # With all but one word to be taken, whether the one-word document is still free decides.
        assert (got <= counts).all() and abs(int(got @ sizes) - budget) <= (budget == int(sizes @ counts) - 1)


def test_targets(spark):
    sizes = {"b": 10, "a": 1000, "c": 5, None: 3, "Z": 0, "é": 400}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    for r in mixing.targets(df, Mix()).collect():
        assert r.target == pytest.approx(plain_targets(sizes)[r.source], rel=1e-12)


@pytest.mark.parametrize("doc_id", [7, 8, 9, 31, 400, None])
@pytest.mark.parametrize("share", [1.0, 0.9])
def test_repeated_rows_do_not_pass_the_target(documents, doc_id, share):
    """Half of a source is one repeated row: the target is met within the longest text, whatever the row's hash."""
    rows = [(1000 + i, f"five words are in {i}", "en", "a") for i in range(300)] + [(doc_id, "five words are in it", "en", "a")] * 300
    rows += [(2000 + i, "a b c", "en", "b") for i in range(400)]
    report = mixing.report(documents(rows), Mix(share=share)).collect()
    taken, source = Counter(), {d: s for d, _, _, s in rows}
    for r in report:
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[source[r.doc_id]] += r.taken
    target = {source[r.doc_id]: r.target for r in report}
    assert len(report) == len(rows) and all(abs(taken[s] - target[s]) <= 5 for s in target)
    # The mix holds as many rows, with their other columns.
    mix = mixing.mixed(documents(rows).withColumn("n_chars", F.monotonically_increasing_id()), Mix(share=share)).collect()
    held = Counter()
    for r in mix:
        held[r.source] += len(r.text.split())
    assert held == taken and max(Counter(r.n_chars for r in mix).values()) <= 3


def plain_mix(rows, rule, draws):
    """Rows of the report by brute force: the plan of each source, then within a length the smallest draws; draws: by row."""
    words = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows]
    total = Counter()
    for n, (_, _, s) in zip(words, rows):
        total[s] += n
    target, out = plain_targets(total), Counter()
    for s in total:
        budget = round(target[s])
        rounds = min(rule.rounds, budget // total[s]) if total[s] else 0
        rest = budget - rounds * total[s] if rounds < rule.rounds else 0
        own = sorted((n, d, i) for i, (n, d, (_, _, of)) in enumerate(zip(words, draws, rows)) if of == s)
        sizes = sorted({n for n, _, _ in own})
        counts = Counter(n for n, _, _ in own)
        more = mixing.fit(rest, np.array(sizes), np.array([counts[n] for n in sizes]), rule.fitted)
        for n, k in zip(sizes, more):
            for place, (_, _, i) in enumerate(x for x in own if x[0] == n):
                out[rows[i][0], n, total[s], n * (rounds + (place < k))] += 1
    return out


def test_choice_equals_brute_force(spark):
    """The query's rows, with the seeded draws computed here for each row alone."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(Mix().seed), "doc_id", "text"), 1)
    given = docs.select("doc_id", "text", "source", draw.alias("draw")).collect()
    expected = plain_mix([(r.doc_id, r.text, r.source) for r in given], Mix(), [r.draw for r in given])
    assert Counter((r.doc_id, r["size"], r.source_size, r.taken) for r in QUERIES["op6_mixing"](spark, sf).collect()) == expected


def test_very_long_text_takes_little_memory(documents):
    """Nothing fits into what is left: no table of twice that many words is made."""
    sizes, counts = np.array([40_000_000, 90_000_000]), np.array([1, 1])
    assert mixing.fit(20_000_001, sizes, counts, 16_384).tolist() == [1, 0]
    assert mixing.fit(19_999_999, sizes, counts, 16_384).tolist() == [0, 0]
    docs = documents([(1, "w " * 2_000_000, "en", "a"), (2, "x y", "en", "b")])
    taken = {r.doc_id: r.taken for r in mixing.report(docs).collect()}
    assert taken == {1: 2_000_000, 2: 6}

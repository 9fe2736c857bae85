"""Line deduplication against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scrubline.llm import line_dedup as ld
from scrubline.llm.line_dedup import LineDedup
from scrubline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def distance(a, b):
    while a and b and a[-1] == b[-1] and len(a) > 200:  # common ends of very long lines
        a, b = a[:-1], b[:-1]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(rows, rule=LineDedup()):
    """(doc_id, text) -> rows of the report; equal (doc_id, text) rows are one document."""
    places = []
    for doc, text in rows:
        for no, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
                places.append((doc, no, line))
    names = sorted({x for *_, x in places})
    label = {x: x for x in names}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    long = [x for x in names if len(x) >= rule.least_chars]
    for i, a in enumerate(long):
        for b in long[i + 1 :]:
            if abs(len(a) - len(b)) <= rule.edits and sum((Counter(a) - Counter(b)).values()) <= rule.edits and distance(a, b) <= rule.edits:
                label[find(a)] = find(b)
    top = {}
    for doc, no, line in places:
        key = (doc is None, doc or 0, no)
        top[find(line)] = min(top.get(find(line), key), key)
    out = []
    for doc, no, line in places:
        none, first, first_no = top[find(line)]
        out.append((doc, no, len(line), None if none else first, first_no, (doc is None, doc or 0, no) == top[find(line)]))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.line_no, r.n_chars, r.class_doc_id, r.class_line_no, r.kept) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(QUERIES["op5_line_dedup"](spark, SF)) == brute(docs)


def mutate(rnd, line, edits):
    for _ in range(edits):
        at = rnd.randint(0, len(line))
        line = rnd.choice([line[:at] + rnd.choice("xyzé ") + line[at:], line[:at] + line[at + 1 :], line[:at] + "q" + line[at + 1 :]])
    return line


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_no_link_is_missed(edits):
    """Any two lines within the edits share a key, of the first kind and of the finer one."""
    rnd, rule = random.Random(edits), LineDedup(edits=edits)
    for _ in range(1500):
        a = "".join(rnd.choice("abcdefg ") for _ in range(rnd.randint(30, 60)))
        b = mutate(rnd, a, rnd.randint(1, edits))
        if min(len(a), len(b)) < rule.least_chars:
            continue
        keys = [dict(sorted(ld.segment_keys(x, rule))) for x in (a, b)]
        shared = [k for k in keys[0].keys() & keys[1].keys() if keys[0][k] or keys[1][k]]
        assert shared
        for key in shared:
            finer = [dict(sorted(ld.finer_keys(x, key, rule))) for x in (a, b)]
            assert any(finer[0][k] or finer[1][k] for k in finer[0].keys() & finer[1].keys())


SHORT = ["Are is anwh reenen.", "Are, is anwh reenen.", "Der eingeä erer.", "Der, eingeä erer.", "Heti eror anesti.", "Heti, eror anesti.", "The anhely eran.", "The, anhely eran."]


@pytest.mark.parametrize("limit", [20_000, 3])
def test_short_lines(documents, limit):
    """Lines of 8 to 29 characters are linked within one edit, those of 30 with those of 29, too; with the small limit keys are dealt anew."""
    rnd, rule = random.Random(8), LineDedup(group_rows=limit)
    lines = [*SHORT, "sevench", "sevenck", "eightcha", "eightchx", "ightcha"]
    for _ in range(60):
        base = "".join(rnd.choice("abc ") for _ in range(rnd.randint(8, 31))).replace(" ", "d")
        lines += [base, mutate(rnd, base, 1), mutate(rnd, base, 2)]
    lines = list(dict.fromkeys(lines))
    label = {x: x for x in lines}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            size = min(len(a), len(b))
            if abs(len(a) - len(b)) <= 2 and 0 < distance(a, b) <= (2 if size >= 30 else 1 if size >= 8 else 0):
                label[find(b)] = find(a)
    result = {r.doc_id: r.class_doc_id for r in ld.report(documents(list(enumerate(lines))), rule).collect()}
    classes = lambda of: {frozenset(x for x in lines if of(x) == root) for root in map(of, lines)}
    assert classes(find) == classes(lambda x: result[lines.index(x)])
    assert all(find(a) == find(b) for a, b in zip(SHORT[::2], SHORT[1::2]))


def test_within():
    rnd = random.Random(1)
    for _ in range(3000):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 14)))
        b = mutate(rnd, a, rnd.randint(0, 6))
        for edits in (1, 2, 5):
            assert ld.within(a, b, edits) == (distance(a, b) <= edits)


@pytest.mark.parametrize(("limit", "sent"), [(20_000, 500_000), (6, 500_000), (6, 0)])
def test_hot_keys(documents, limit, sent):
    """Lines that share long parts, chains of edits and far lines; with the small limit keys are dealt anew."""
    rnd = random.Random(3)
    base = "the quick brown fox jumps over the lazy dog near the old river bank today"
    lines = [mutate(rnd, base, rnd.randint(0, 5)) for _ in range(120)]
    lines += [base[:40] + "".join(rnd.choice("abcdefgh") for _ in range(30)) for _ in range(60)]
    chain = "a chain of lines that differ by two edits each from the one before it"
    for _ in range(30):
        chain = mutate(rnd, chain, 2)
        lines.append(chain)
    rows = [(i, "\n".join(rnd.sample(lines, 3))) for i in range(150)]
    rule = LineDedup(group_rows=limit, sent_ids=sent)
    assert found(ld.report(documents(rows), rule)) == brute(rows, rule)


def test_edges(documents):
    long = "a line that is long enough to be compared with others by edits"
    texts = [None, "", "\n \n\t", "short\nshort\nshorx", long + "\n" + long + "!", long[:-2], "é" + long, long.upper(), "x" * 20_000, "x" * 20_001 + "\n", "one\n\ntwo\r\none\r"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "short\nshort\nshorx"), (None, long), (None, "alone here\nshort")]
    docs = documents(rows).withColumns({"line": F.lit("mine"), "id": F.lit(0), "kept": F.lit(1), "content": F.lit(None).cast("int")})
    assert found(ld.report(docs)) == brute(rows)
    clean = ld.deduplicate(docs)
    assert clean.columns == docs.columns
    out = Counter((r.doc_id, r.text) for r in clean.collect())
    assert out[(0, None)] == 1 and out[(1, "")] == 1 and out[(2, "\n \n\t")] == 1 and out[(3, "short\nshorx")] == 2
    assert out[(4, long)] == 1 and out[(5, "")] == 1 and out[(10, "one\n\ntwo\r\none\r")] == 1 and out[(None, "alone here")] == 1
    assert found(ld.report(documents([]))) == Counter() and ld.deduplicate(documents([])).collect() == []


def test_one_line_in_most_documents(documents):
    rows = [(i, f"{'the same line in very many documents'}\nown line number {i * 7919} of its own kind {i * 104729}") for i in range(2000)]
    result = ld.report(documents(rows)).filter("line_no = 0").collect()
    assert len(result) == 2000 and sum(r.kept for r in result) == 1 and {r.class_doc_id for r in result} == {0}


def test_lines_of_one_template(documents, monkeypatch):
    """All lines share most of their text, so a key stays over the limit after the second cut and is dealt in blocks."""
    rnd = random.Random(2)
    lines = [f"ID {n:07d}: the same words stand behind every number of this list" for n in rnd.sample(range(10**7), 300)]
    rows = [(i, "\n".join(lines[i * 30 : i * 30 + 30])) for i in range(10)]
    rule, largest = LineDedup(group_rows=60), []

    def watched(large, key, member, most, whole=ld.in_blocks):
        dealt = whole(large, key, member, most)
        largest.append((large.groupBy(key).count().agg(F.max("count")).first()[0], dealt.groupBy(key).count().agg(F.max("count")).first()[0]))
        return dealt

    monkeypatch.setattr(ld, "in_blocks", watched)
    assert found(ld.report(documents(rows), rule)) == brute(rows, rule)
    ((before, after),) = largest
    assert before == 300 and after <= 100

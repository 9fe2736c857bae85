"""Quality rules with risk-controlled cutoffs.

Each rule is a ratio and a side, with a fixed ladder of cutoffs from lax to strict. Labelled good documents that pass the base
rules are the holdout of their stratum (language). A cutoff is safe if the exact binomial test rejects "over ``risk`` / rules
of good documents fall" at level ``error`` / (strata x rules): its Clopper-Pearson upper bound is then below the rule's part of
the risk. Cutoffs are tested from lax to strict, and the last safe one before the first unsafe one is taken (fixed-sequence
testing, so the ladder's length costs nothing). With probability 1 - ``error`` at most ``risk`` of the good documents fall in
every stratum at once. A stratum with too few labels gets no cutoff and loses nothing.

The test holds for independent documents, so a holdout has every doc_id once (of several texts the one of smallest hash) and
every text of a stratum once, however often rows are repeated or copied.

Features come from one pass over whole texts without a shuffle. Only counts per stratum, rule and step of the ladder
meet; the driver gets the number of strata.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import arrow_map, bounded, cut

# The symbols that are counted, and the base rules' limits.
_SYMBOLS = "#*$%&|<>"
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
LEAST_WORDS, MOST_REPEATED = 50, 50
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


@dataclass(frozen=True)
class Rule:
    """A document falls if ``ratio`` (an SQL expression over the features) is over the cutoff."""

    name: str
    ratio: str
    ladder: tuple[float, ...]


def _ladder(lax: float, strict: float, steps: int = 40) -> tuple[float, ...]:
    """Geometric steps from lax to strict."""
    return tuple(lax * (strict / lax) ** (i / (steps - 1)) for i in range(steps))


RULES = (
    Rule("symbols", "n_symbols / n_words", _ladder(2.0, 0.005)),
    Rule("long_words", "word_chars / n_words", _ladder(30.0, 5.0)),
    Rule("repeated_lines", "n_dup_lines / n_lines", _ladder(0.95, 0.05)),
    Rule("repeated_words", "n_repeat_words / n_words", _ladder(0.5, 0.01)),
    Rule("capitals", "n_upper / word_chars", _ladder(0.9, 0.02)),
)


@dataclass(frozen=True)
class Risk:
    """Most of the good documents of a stratum that may fall, the chance of failing that anywhere, and the rules."""

    risk: float = 0.02
    error: float = 0.05
    rules: tuple[Rule, ...] = RULES


def features(text: str | None) -> tuple[int, ...]:
    """In the order of ``FEATURES``; zeros for a null text."""
    if not text:
        return (0,) * len(FEATURES)
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _BLANK)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    seen: set[str] = set()
    lines = repeated_lines = 0
    for line in text.split("\n"):
        if line.strip(_BLANK):
            lines += 1
            if line in seen:
                repeated_lines += 1
            else:
                seen.add(line)
    return n, chars, symbols, repeated_lines, _repeated_words(words), lines, len(_UPPER.findall(text))


def _repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    hit = np.zeros(n, dtype=bool)
    twice = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for shift in range(3):
        hit[shift : shift + len(windows)] |= twice
    return int(hit.sum())


def with_features(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, content and the features) of whole texts."""
    names = ["doc_id", "lang", "content", *FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column(3).to_pylist()]
            columns = zip(*rows) if rows else [()] * len(FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, pa.int64()) for c in columns]], names)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.xxhash64("text").alias("content"), "text")
    kinds = ", ".join(f"{f} bigint" for f in FEATURES)
    return narrow.transform(arrow_map, run, f"doc_id bigint, lang string, content bigint, {kinds}")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def binomial_below(x: int, n: int, p: float) -> float:
    """P(X <= x) for X ~ Binomial(n, p): the regularized incomplete beta function by its continued fraction."""
    if x >= n:
        return 1.0
    a, b, z = n - x, x + 1, 1 - p
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(z) + b * log1p(-z)) if 0 < p < 1 else 0.0
    if p <= 0 or p >= 1:
        return 1.0 if p <= 0 else 0.0
    return front * _fraction(a, b, z) / a if z < (a + 1) / (a + b + 2) else 1 - front * _fraction(b, a, 1 - z) / b


def _fraction(a: float, b: float, z: float) -> float:
    """Lentz's evaluation of the incomplete beta function's continued fraction."""
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * z / (a + 1), tiny)
    value = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            c = 1 + step / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return value


def safe_cutoff(ladder: tuple[float, ...], fallen: list[int], n: int, risk: float, error: float) -> float | None:
    """The strictest cutoff reached by testing from lax to strict; ``fallen[i]`` of n good documents are over step i."""
    best = None
    for cutoff, x in zip(ladder, fallen):
        if binomial_below(x, n, risk) > error:
            break
        best = cutoff
    return best


def _steps(rule: Rule) -> Column:
    """How many of the ladder's cutoffs the document is over. The ladder falls, so these are its last ones."""
    ratio = F.coalesce(F.expr(f"try_divide({rule.ratio.replace(' / ', ', ')})"), F.lit(0.0))
    return sum((ratio > F.lit(c)).cast("int") for c in rule.ladder)


def cutoffs(featured: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """(lang, one column per rule): the safe cutoffs of each stratum with labelled good documents, null where there is none."""
    good = (
        labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"))
    ).filter("q = 1")
    held = featured.filter(~base_failed()).join(good.select("doc_id"), "doc_id", "left_semi")
    steps = F.array(*[_steps(r) for r in risk.rules]).alias("steps")
    once = held.groupBy("doc_id").agg(F.min(F.struct("content", "lang", steps)).alias("d")).select("d.*")
    texts = once.groupBy("lang", "content").agg(F.min("steps").alias("steps"))
    over = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.get("steps", F.lit(i)).alias("over")) for i in range(len(risk.rules))]))
    counts = cut(texts.select("lang", over.alias("o")).groupBy("lang", "o.rule", "o.over").agg(F.count("*").alias("n")))
    strata = max(1, counts.select("lang").distinct().count())
    part, level = risk.risk / len(risk.rules), risk.error / (strata * len(risk.rules))
    rules = risk.rules

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"lang": rows["lang"].iloc[0]}
        for i, rule in enumerate(rules):
            own = rows[rows["rule"] == i]
            # A document that is over k cutoffs is over step j if k >= steps - j.
            steps = len(rule.ladder)
            fallen = [int(own.loc[own["over"] >= steps - j, "n"].sum()) for j in range(steps)]
            out[rule.name] = safe_cutoff(rule.ladder, fallen, int(own["n"].sum()), part, level)
        return pd.DataFrame([out])

    kinds = ", ".join(f"{r.name} double" for r in rules)
    return cut(counts.groupBy("lang").applyInPandas(choose, f"lang string, {kinds}"))


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """(doc_id, lang, content, features, base_failed, kept): one row per row of ``docs``.

    A null text has no words and fails the base rules, as do all texts under fifty words. A null language is a stratum of
    its own. Without labels nothing but the base rules rejects. Extra columns are ignored; repeated rows are judged alike and
    count once in the holdout. An empty table gives no rows. A text is read whole in one task, however long. Capitals are
    those of Latin letters up to U+00DE.
    """
    featured = cut(with_features(docs))
    chosen = bounded(cutoffs(featured, labels, risk).withColumnsRenamed({"lang": "of"}), 100_000)
    judged = featured.join(chosen, F.col("lang").eqNullSafe(F.col("of")), "left")
    falls = F.lit(False)
    for rule in risk.rules:
        falls = falls | F.coalesce(F.expr(f"try_divide({rule.ratio.replace(' / ', ', ')})") > F.col(rule.name), F.lit(False))
    return judged.select(*featured.columns, base_failed().alias("base_failed"), (~base_failed() & ~falls).alias("kept"))


def report(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The digest: doc_id, the five base features, base_failed, kept."""
    return judge(docs, labels, risk).select("doc_id", *FEATURES[:5], "base_failed", "kept")


def _oracle(risk: Risk = Risk()) -> str:
    """The digest as DuckDB SQL; the binomial test is summed term by term."""
    ladders = ", ".join(f"({i}, {j}, {c!r}::DOUBLE)" for i, r in enumerate(risk.rules) for j, c in enumerate(r.ladder))
    ratios = ", ".join(f"({i}, CASE WHEN {r.ratio.split(' / ')[1]} <> 0 THEN {r.ratio} ELSE 0 END)" for i, r in enumerate(risk.rules))
    part = risk.risk / len(risk.rules)
    return f"""
WITH split AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM split)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS j,
        unnest(list_transform(range(1, len(w) - 1), lambda j: array_to_string(w[j:j + 2], ' '))) AS words
    FROM split WHERE len(w) > 2
),
twice AS (SELECT doc_id, j FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, words) AS n FROM windows) WHERE n > 1),
repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(j, j + 3)) AS place FROM twice) GROUP BY doc_id
),
features AS (
    SELECT s.doc_id, lang, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper
    FROM split s LEFT JOIN lines l ON l.doc_id = s.doc_id LEFT JOIN repeated r ON r.doc_id = s.doc_id
),
based AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM features
),
rated AS (
    SELECT b.doc_id, b.lang, b.t, b.base_failed, r.rule, r.ratio
    FROM based b, LATERAL (SELECT * FROM (VALUES {ratios}) AS v(rule, ratio)) r
),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1),
held AS (
    -- Every doc_id once, then every text of a language once.
    SELECT lang, rule, t, any_value(ratio) AS ratio FROM (
        SELECT DISTINCT ON (doc_id, rule) * FROM rated WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) ORDER BY doc_id, rule, t, lang
    ) GROUP BY lang, rule, t
),
ladder(rule, step, cutoff) AS (VALUES {ladders}),
counted AS (
    SELECT lang, l.rule, step, cutoff, count(*) AS n, count(*) FILTER (WHERE ratio > cutoff) AS x
    FROM held h JOIN ladder l ON l.rule = h.rule GROUP BY ALL
),
tested AS (
    SELECT *, {risk.error!r} / ({len(risk.rules)} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM held))) < list_sum(list_transform(
        range(0, x + 1), lambda i: exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END
            - CASE WHEN i < n THEN lgamma(n - i + 1) ELSE 0 END + i * ln({part!r}) + (n - i) * ln(1 - {part!r})))) AS unsafe
    FROM counted
),
reached AS (SELECT *, max(unsafe::INT) OVER (PARTITION BY lang, rule ORDER BY step) = 0 AS safe FROM tested),
chosen AS (SELECT lang, rule, min(cutoff) AS cutoff FROM reached WHERE safe GROUP BY lang, rule),
fallen AS (
    SELECT DISTINCT doc_id FROM rated r JOIN chosen c ON c.rule = r.rule AND c.lang IS NOT DISTINCT FROM r.lang WHERE ratio > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM fallen) AS kept
FROM based
"""


ORACLE = _oracle()

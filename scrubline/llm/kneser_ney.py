"""Quality classifier: per-document perplexity under an interpolated modified Kneser-Ney model of characters.

Training runs on all trusted text: documents labelled of quality and not toxic, half of them by a hash of the id. Counts
are Spark tables sharded by n-gram: the counts of order k - 1 are grouped from the distinct n-grams of order k, and
probabilities come from joins of an order's counts with its context sums and with the order below. A model of at most
``head_rows`` rows is sent to the tasks whole. Of a larger one only its most frequent n-grams are sent; a text's other
n-grams leave the scan counted, their probabilities are looked up once per n-gram in the tables, and joined to the texts.

Thresholds are quantiles of the perplexity of all trusted documents of the other half, per language; a language with
few of them takes the quantile over all languages. Chen & Goodman (1998) for the smoothing.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrubline.llm.common import arrow_map, bounded, cut, fresh_dir, remove

_PAD = "\x02"
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 19


@dataclass(frozen=True)
class Quality:
    """Order in characters, and the quantile of trusted perplexities that is still accepted.

    ``grid`` is the resolution of the quantile in nats per character; ``least`` the trusted documents a language needs;
    ``head_rows`` the most rows of the model that are sent to the tasks, whatever the training text's size: at the default as a
    table of 2^19 slots of 24 bytes, 13 MB. ``sent_grams`` is the most other n-grams whose values are
    sent to be joined, of about 100 bytes each, ``sent_rows`` the most rows of any other joined table that is sent.
    """

    order: int = 5
    head_rows: int = 262_144
    sent_grams: int = 1_000_000
    sent_rows: int = 65_536
    quantile: float = 0.99
    grid: float = 0.001
    least: int = 50
    seed: int = 7


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of documents that every label row calls good and none toxic; an unknown toxicity counts as none."""
    return (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min(F.coalesce("quality", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("bad"))
        .filter("good = 1 and bad = 0")
        .select("doc_id")
    )


def _order_hash(rule: Quality) -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.lit(rule.seed))


def training_sample(docs: DataFrame, trusted: DataFrame, rule: Quality) -> DataFrame:
    """All rows with a text of the training half of the trusted documents, whatever their number and length."""
    ids = trusted.filter(F.pmod(_order_hash(rule), F.lit(2)) == 0)
    typed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text is not null")
    return typed.join(bounded(ids, 1_000_000), "doc_id", "left_semi")


def _highest_counts(sample: DataFrame, order: int) -> DataFrame:
    """(gram, c): n-grams of the highest order, each text led by order - 1 pads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                padded = _PAD * (order - 1) + text
                counts.update(padded[i : i + order] for i in range(len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["gram", "c"])

    return sample.select("text").transform(arrow_map, run, "gram string, c bigint").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts; 0.75 for all where one of these is missing."""
    n = {r["c"]: r["n"] for r in counts.filter("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    if not all(n.get(i) for i in (1, 2, 3, 4)):
        return 0.75, 0.75, 0.75
    y = n[1] / (n[1] + 2 * n[2])
    return tuple(min(i - 0.01, max(0.05, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3))


@dataclass(frozen=True)
class Model:
    """An open-addressing table from n-gram keys to log probability and log backoff weight."""

    order: int
    keys: np.ndarray
    logp: np.ndarray  # NaN: not an n-gram, only a context
    backoff: np.ndarray
    unseen: float  # log probability of a character never seen


@dataclass(frozen=True)
class Levels:
    """The model as tables: of each order k, from 1, (gram, p) and (context, g), contexts being of order k - 1. Those of the
    highest order have the count c, too. ``unseen`` is the log probability of a character never seen."""

    grams: list[DataFrame]
    weights: list[DataFrame]
    rows: int
    unseen: float


def levels(sample: DataFrame, rule: Quality = Quality()) -> Levels | None:
    """The model of the texts in ``sample``; None without any character. Only numbers reach the driver."""
    counts = {rule.order: cut(_highest_counts(sample, rule.order))}
    if counts[rule.order].isEmpty():
        return None
    suffix = F.expr("substring(gram, 2)")
    for k in range(rule.order - 1, 0, -1):  # in how many different n-grams of the next order it is the end
        counts[k] = cut(counts[k + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("c")))
    letters = counts[1].count() + 1
    below, tables, contexts, rows = None, [], [], 0
    for k in range(1, rule.order + 1):
        d1, d2, d3 = _discounts(counts[k])
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.expr(f"left(gram, {k - 1})")
        grams = counts[k].withColumns({"d": discount, "context": context})
        # Decimal sums: the same in any order of rows.
        sums = cut(grams.groupBy("context").agg(F.sum("c").alias("total"), F.sum(F.col("d").cast("decimal(18,9)")).cast("double").alias("mass")))
        seen = grams.join(sums, "context").withColumn("own", (F.col("c") - F.col("d")) / F.col("total")).withColumn("gamma", F.col("mass") / F.col("total"))
        if below is None:
            level = seen.select("gram", (F.col("own") + F.col("gamma") / letters).alias("p"), "c")
        else:
            lower = below.select(F.col("gram").alias("lower"), F.col("p").alias("q"))
            level = seen.join(lower, suffix == F.col("lower")).select("gram", (F.col("own") + F.col("gamma") * F.col("q")).alias("p"), "c")
        below = cut(level)
        tables.append(below if k == rule.order else below.drop("c"))
        contexts.append(sums.select("context", (F.col("mass") / F.col("total")).alias("g")))
        rows += below.count() + sums.count()
    unseen = log(contexts[0].first()["g"]) - log(letters)
    return Levels(tables, contexts, rows, unseen)


def _whole(found: Levels) -> Model:
    keys, logps, backoffs = [], [], []
    for k, (grams, weights) in enumerate(zip(found.grams, found.weights), 1):
        grams_table = grams.select("gram", "p").toArrow()
        keys.append(_keys(grams_table.column("gram").to_pylist(), k))
        logps.append(np.log(grams_table.column("p").to_numpy()))
        backoffs.append(np.zeros(len(keys[-1])))
        if k > 1:
            weight_table = weights.toArrow()
            keys.append(_keys(weight_table.column("context").to_pylist(), k - 1))
            logps.append(np.full(len(keys[-1]), np.nan))
            backoffs.append(np.log(weight_table.column("g").to_numpy()))
    return _table(len(found.grams), np.concatenate(keys), np.concatenate(logps), np.concatenate(backoffs), found.unseen)


def _head(found: Levels, rows: int) -> Model:
    """The most frequent n-grams of the highest order, at most ``rows``: those whose count reaches the lowest fitting bound."""
    order, top = len(found.grams), found.grams[-1]
    cell = F.floor(F.log2(F.col("c").cast("double")) * 8)
    left, bound = rows, None
    for r in sorted(top.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["cell"]):
        left -= r["n"]
        if left < 0:
            break
        bound = r["cell"]
    chosen = top.filter(cell >= bound if bound is not None else F.lit(False)).select("gram", "p").toArrow()
    keys = _keys(chosen.column("gram").to_pylist(), order)
    return _table(order, keys, np.log(chosen.column("p").to_numpy()), np.zeros(len(keys)), found.unseen)


def train(sample: DataFrame, rule: Quality = Quality()) -> Model | None:
    """The model of the texts in ``sample`` on the driver; None without any character. For samples known to be small."""
    found = levels(sample, rule)
    return None if found is None else _whole(found)


def _salt(k: int) -> np.uint64:
    return np.uint64(k * 0xBF58476D1CE4E5B9 & (1 << 64) - 1)


def _keys(grams: list[str], k: int) -> np.ndarray:
    points = np.frombuffer("".join(grams).encode("utf-32-le"), dtype="<u4").reshape(-1, k).astype(np.uint64)
    key = np.zeros(len(points), dtype=np.uint64)
    for i in range(k):
        key = key * _PRIME + points[:, i] + np.uint64(1)
    return key ^ _salt(k)


def _table(order: int, keys: np.ndarray, logp: np.ndarray, backoff: np.ndarray, unseen: float) -> Model:
    unique, place = np.unique(keys, return_inverse=True)
    p, b = np.full(len(unique), np.nan), np.zeros(len(unique))
    has = ~np.isnan(logp)
    p[place[has]] = logp[has]
    np.add.at(b, place, backoff)
    bits = max(4, int(2 * len(unique) - 1).bit_length())
    slots = np.zeros(1 << bits, dtype=np.uint64)  # key 0 stands for an empty slot
    out_p, out_b = np.full(1 << bits, np.nan), np.zeros(1 << bits)
    left, at = np.arange(len(unique)), _slot(unique, bits)
    while len(left):
        free = slots[at] == 0
        _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
        put = first[free[first]]
        slots[at[put]], out_p[at[put]], out_b[at[put]] = unique[left[put]], p[left[put]], b[left[put]]
        rest = np.ones(len(left), dtype=bool)
        rest[put] = False
        left, at = left[rest], (at[rest] + 1) & (len(slots) - 1)
    return Model(order, slots, out_p, out_b, unseen)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)


def _find(model: Model, keys: np.ndarray) -> np.ndarray:
    """The slot of each key, or -1."""
    at = _slot(keys, len(model.keys).bit_length() - 1)
    there = model.keys[at]
    out = np.where(there == keys, at, -1)
    left = np.flatnonzero((there != keys) & (there != 0))
    while len(left):
        at[left] = (at[left] + 1) & (len(model.keys) - 1)
        there = model.keys[at[left]]
        hit = there == keys[left]
        out[left[hit]] = at[left[hit]]
        left = left[~hit & (there != 0)]
    return out


def log_probabilities(model: Model, points: np.ndarray) -> np.ndarray:
    """Of each code point but the first order - 1, given those before it."""
    lead = model.order - 1
    codes = points.astype(np.uint64) + np.uint64(1)
    rolled = [np.zeros(len(codes), dtype=np.uint64)]
    for k in range(1, model.order + 1):  # rolled[k][i]: the n-gram of order k that ends at i
        key = codes.copy()
        key[1:] += rolled[k - 1][:-1] * _PRIME
        rolled.append(key)
    out = np.zeros(len(codes) - lead)
    left = np.arange(lead, len(codes))
    for k in range(model.order, 0, -1):
        at = _find(model, rolled[k][left] ^ _salt(k))
        value = np.where(at >= 0, model.logp[at], np.nan)
        hit = ~np.isnan(value)
        out[left[hit] - lead] += value[hit]
        left = left[~hit]
        if not len(left):
            break
        if k > 1:
            at = _find(model, rolled[k - 1][left - 1] ^ _salt(k - 1))
            out[left - lead] += np.where(at >= 0, model.backoff[at], 0.0)
        else:
            out[left - lead] += model.unseen
    return out


def _surprise(model: Model, texts: list[str | None]) -> list[float | None]:
    """Mean negative log probability per character; None for a text without characters. Long texts go in pieces."""
    out: list[float | None] = [None] * len(texts)
    lead = _PAD * (model.order - 1)
    room: list[tuple[int, str]] = []

    def flush() -> None:
        if room:
            points = np.frombuffer("".join(lead + t for _, t in room).encode("utf-32-le"), dtype="<u4")
            lp = np.concatenate([np.zeros(len(lead)), log_probabilities(model, points)])
            starts = np.cumsum([0] + [len(t) + len(lead) for _, t in room])
            for (i, t), s in zip(room, starts):
                out[i] = -float(lp[s + len(lead) : s + len(lead) + len(t)].sum()) / len(t)
            room.clear()

    filled = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        if len(text) > _CHUNK:
            total = 0.0
            for s in range(0, len(text), _CHUNK):
                piece = (lead + text[:_CHUNK]) if s == 0 else text[s - len(lead) : s + _CHUNK]
                total -= float(log_probabilities(model, np.frombuffer(piece.encode("utf-32-le"), dtype="<u4")).sum())
            out[i] = total / len(text)
            continue
        room.append((i, text))
        filled += len(text)
        if filled > _CHUNK:
            flush()
            filled = 0
    flush()
    return out


def _known(head: Model, text: str) -> tuple[float, Counter]:
    """The sum of log probabilities of the text's n-grams in the head, and its other n-grams, counted."""
    lead, total, others = head.order - 1, 0.0, Counter()
    for s in range(0, len(text), _CHUNK):
        piece = (_PAD * lead + text[:_CHUNK]) if s == 0 else (_PAD * lead + text[max(0, s - lead) : s + _CHUNK])[-(lead + len(text[s : s + _CHUNK])) :]
        codes = np.frombuffer(piece.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        size = len(codes) - lead
        key = np.zeros(size, dtype=np.uint64)
        for k in range(head.order):
            key = key * _PRIME + codes[k : k + size]
        at = _find(head, key ^ _salt(head.order))
        hit = at >= 0
        total += float(head.logp[at[hit]].sum())
        others.update(piece[i : i + head.order] for i in np.flatnonzero(~hit).tolist())
    return total, others


_SCORED = "doc_id bigint, content bigint, lang string, chars bigint, known double, gram string, n bigint"
_PIECE_ROWS = 100_000


def _partial_rows(sent):
    """(doc_id, content, lang, text) -> one row per document with what the head knows of it, and before it a row per other n-gram."""

    def rows(doc_id: list, content: list, lang: list, chars: list, known: list, gram: list, n: list) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.string(), pa.int64()]
        names = ["doc_id", "content", "lang", "chars", "known", "gram", "n"]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((doc_id, content, lang, chars, known, gram, n), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, texts = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            chars: list[int] = []
            known: list[float] = []
            of: list[int] = []
            grams: list[str] = []
            counts: list[int] = []
            for content, text in zip(contents, texts):
                total, others = _known(sent.value, text) if text else (0.0, Counter())
                chars.append(len(text or ""))
                known.append(total)
                of += [content] * len(others)
                grams += others.keys()
                counts += others.values()
                while len(grams) >= _PIECE_ROWS:
                    some, none = slice(0, _PIECE_ROWS), [None] * _PIECE_ROWS
                    yield rows(none, of[some], none, none, none, grams[some], counts[some])
                    of, grams, counts = of[_PIECE_ROWS:], grams[_PIECE_ROWS:], counts[_PIECE_ROWS:]
            none = [None] * len(grams)
            yield rows(none, of, none, none, none, grams, counts)
            none = [None] * len(texts)
            yield rows(batch.column(0).to_pylist(), contents, batch.column(2).to_pylist(), chars, known, none, none)

    return run


def _looked_up(grams: DataFrame, found: Levels, rule: Quality) -> DataFrame:
    """``grams`` (gram, docs), distinct, with their log probability: backed off from order to order until one is known."""
    order, out = len(found.grams), grams
    value = F.lit(found.unseen)
    for k in range(1, order + 1):
        level = bounded(found.grams[k - 1].select(F.col("gram").alias(f"g{k}"), F.log("p").alias(f"p{k}")), rule.sent_rows)
        out = out.join(level, F.expr(f"substring(gram, {order - k + 1})") == F.col(f"g{k}"), "left")
        if k > 1:
            weights = bounded(found.weights[k - 1].select(F.col("context").alias(f"c{k}"), F.log("g").alias(f"w{k}")), rule.sent_rows)
            out = out.join(weights, F.expr(f"substring(gram, {order - k + 1}, {k - 1})") == F.col(f"c{k}"), "left")
            value = F.coalesce(F.col(f"w{k}"), F.lit(0.0)) + value
        value = F.coalesce(F.col(f"p{k}"), value)
    return out.select("gram", "docs", value.alias("logp"))


def _surprise_by_joins(narrow: DataFrame, found: Levels, rule: Quality) -> DataFrame:
    spark = narrow.sparkSession
    sent = spark.sparkContext.broadcast(_head(found, rule.head_rows))
    place = fresh_dir(spark, "surprise")
    narrow.transform(arrow_map, _partial_rows(sent), _SCORED).write.parquet(place)
    parts = spark.read.schema(_SCORED).parquet(place)
    docs = parts.filter("gram is null").select("doc_id", "content", "lang", "chars", "known")
    tail = parts.filter("gram is not null").select("content", "gram", "n")
    values = cut(_looked_up(cut(tail.groupBy("gram").agg(F.count("*").alias("docs"))), found, rule))
    # N-grams of very many documents, at most ``sent_grams``, are sent; so no key of the shuffled join is hot.
    often = max(1000, (values.agg(F.sum("docs")).first()[0] or 0) // rule.sent_grams)
    joined = [tail.join(bounded(values.filter(of).select("gram", "logp"), rule.sent_grams), "gram") for of in (F.col("docs") > often, F.col("docs") <= often)]
    # Decimal sums: the same in any order of rows. Copies of a text have the same n-grams, so their sum is that of each times their number.
    term = (F.col("n") * F.col("logp")).cast("decimal(28,9)")
    sums = joined[0].unionByName(joined[1]).groupBy("content").agg(F.sum(term).alias("rest"))
    copies = cut(docs.groupBy("content").agg(F.count("*").alias("copies")))
    rests = cut(sums.join(copies, "content").select("content", (F.col("rest").cast("double") / F.col("copies")).alias("rest")))
    # Texts of very many copies, at most ``sent_rows``, are sent; documents of the others meet their sums by a shuffle.
    many = max(1000, (copies.agg(F.sum("copies")).first()[0] or 0) // rule.sent_rows)
    hot = copies.filter(F.col("copies") > many).join(rests, "content", "left").select(F.col("content").alias("hot"), F.coalesce("rest", F.lit(0.0)).alias("sent"))
    beside = docs.join(bounded(hot, rule.sent_rows), F.col("content") == F.col("hot"), "left")
    beside = beside.withColumn("of", F.when(F.col("hot").isNull(), F.col("content")).otherwise(F.xxhash64("content", "doc_id")))
    added = beside.join(rests.withColumnRenamed("content", "of"), "of", "left")
    total = F.col("known") + F.coalesce("sent", "rest", F.lit(0.0))
    surprise = F.when(F.col("chars") > 0, -total / F.col("chars"))
    out = cut(added.select("doc_id", "content", "lang", surprise.alias("surprise")))
    remove(spark, place)
    return out


def with_surprise(docs: DataFrame, found: Levels | None, rule: Quality = Quality()) -> DataFrame:
    """(doc_id, content, lang, surprise) of whole texts: nats per character, null without text or model."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("content"), "lang", "text")
    if found is None:
        return narrow.drop("text").withColumn("surprise", F.lit(None).cast("double"))
    if found.rows > rule.head_rows:
        return _surprise_by_joins(narrow, found, rule)
    sent = docs.sparkSession.sparkContext.broadcast(_whole(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(_surprise(sent.value, batch.column(3).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], scores], ["doc_id", "content", "lang", "surprise"])

    return narrow.transform(arrow_map, run, "doc_id bigint, content bigint, lang string, surprise double")


def thresholds(scored: DataFrame, trusted: DataFrame, rule: Quality) -> DataFrame:
    """(lang, all_langs, limit): the exact quantile, rounded up to the grid, of all held-out trusted documents."""
    held = scored.join(trusted, "doc_id", "left_semi").filter("surprise is not null").filter(F.pmod(_order_hash(rule), F.lit(2)) == 1)
    cells = held.groupBy("lang", F.ceil(F.col("surprise") / rule.grid).alias("cell")).agg(F.count("*").alias("n"))
    each = cells.withColumn("all_langs", F.lit(False))
    pooled = cells.groupBy("cell").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "cell", "n", F.lit(True).alias("all_langs"))
    whole = Window.partitionBy("all_langs", "lang")
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    ranked = each.unionByName(pooled).withColumns({"sum": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    reached = ranked.filter((F.col("sum") >= F.col("total") * rule.quantile) & (F.col("total") >= rule.least))
    return reached.groupBy("all_langs", "lang").agg((F.min("cell") * rule.grid).alias("limit"))


def classify(docs: DataFrame, labels: DataFrame, rule: Quality = Quality()) -> DataFrame:
    """(doc_id, content, lang, perplexity, threshold, kept, pooled): one row per row of ``docs``.

    A document is rejected if its perplexity per character is over its language's threshold; ``pooled`` says that its language
    has fewer than ``least`` held-out trusted documents and takes the threshold of all languages (null where there is none). Null or empty texts have no
    perplexity and are kept, as is everything if no document is trusted. A null language is a language of its own.
    Label rows without a doc_id or quality trust nothing. Extra columns are ignored. Repeated rows and copies train and are
    judged as often as they occur; a perplexity at the threshold is kept. An empty table gives no rows; a text of any length
    is trained on and judged whole.
    """
    trusted = cut(trusted_ids(labels))
    found = levels(training_sample(docs, trusted, rule), rule)
    scored = cut(with_surprise(docs, found, rule))
    limits = cut(thresholds(scored, trusted, rule))
    pooled = limits.filter("all_langs").first()
    own = bounded(limits.filter("not all_langs").select(F.col("lang").alias("of_lang"), "limit"), 10_000)
    limit = F.coalesce(F.col("limit"), F.lit(pooled["limit"] if pooled else None).cast("double"))
    judged = scored.join(own, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    kept = F.coalesce(F.col("surprise") <= limit, F.lit(True))
    return judged.select(
        "doc_id", "content", "lang", F.exp("surprise").alias("perplexity"), F.exp(limit).alias("threshold"), kept.alias("kept"), F.when(limit.isNotNull(), F.col("limit").isNull()).alias("pooled")
    )


def accepted(docs: DataFrame, labels: DataFrame, rule: Quality = Quality()) -> DataFrame:
    """``docs`` without the rejected rows, columns unchanged."""
    rejected = classify(docs, labels, rule).filter("not kept")
    out = rejected.select(F.col("doc_id").alias("__id"), F.col("content").alias("__of"), F.col("lang").alias("__in")).distinct()
    same_text = (F.xxhash64("text") == F.col("__of")) & F.col("lang").eqNullSafe(F.col("__in"))
    on = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & same_text
    return docs.join(bounded(out, 4 * rule.sent_rows), on, "left_anti")

"""Personal data, and the words around it that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each distinct one is a protected entity, and the corpus
tells how strongly a word discloses it (Sanchez and Batet, "C-sanitized: a privacy model for document redaction and
sanitization", 2016). With p over documents, the information content of an entity is IC = -log2 p(entity), and what a word
tells of it is their pointwise mutual information, PMI = log2 p(entity, word) / (p(entity) p(word)), where both occur together
if one document holds them, at whatever places; with a ``reach``, only if the word stands within so many characters of the
entity. A word whose PMI is at least ``disclosed`` of the entity's IC, seen so in ``least_texts`` different texts, is not left
beside that entity: it is generalised to the family of words that begin alike if the family itself stays under the threshold,
else removed. A document without base spans has nothing to protect and loses nothing.

Built-in functions only. Texts are read twice: once for spans, kept with the texts that have any (with a reach, with the words near
them instead), and once to count the documents of each word, map-side first. Positions come from the lengths of the pieces
between matches; they are summed in blocks, so that long texts with very many matches take no quadratic time.

Whole texts make a pair of each word and each entity in them, counted map-side, from which is left out beforehand only what
cannot reach the threshold: entities in fewer than ``least_texts`` different texts, and words in so many documents that even one
which is wherever the entity is would tell too little. Entities of the same texts tell the same and are paired as one, and
copies of a text are paired once, so no group of documents, however large, makes pairs with another.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import bounded, cut

# Kinds in the order in which equal starts are listed, and what they look like. The patterns match what the plain ones
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
# [0-9]([\x20-]?[0-9])+ with 12 to 19 digits           \+[0-9][\x20().0-9-]+[0-9]
# do, but try a run of characters from its start only: on a long run without a match the plain ones take quadratic time.
KINDS = ("email", "ip", "card", "phone", "generalised", "removed")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_VALID_IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_WORD = r"\p{L}+"
_BLOCK = 64
# The commonest words are sent to all tasks, which leave out pairs of them early; those of others are left out after counting.
_COMMON = 65_536


@dataclass(frozen=True)
class Disclosure:
    """Characters on either side of an entity in which words are near it (None: the whole text), the share of an entity's
    information that a word may not tell, the fewest different texts that show it, the shortest word, the letters by which a
    family of words is known, and the most narrow rows of a table that are sent to all tasks."""

    reach: int | None = 64
    disclosed: float = 0.75
    least_texts: int = 3
    least_chars: int = 4
    family: int = 4
    sent: int = 500_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _in_blocks(gaps: Column, sizes: Column, values: Column, start: Column) -> Column:
    """(start, end, value) of things that follow each other, each after a gap, from the place ``start`` on."""
    Z = F.transform(F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), values.alias("value")), lambda z: F.struct(z["gap"].cast("bigint").alias("gap"), z["size"].cast("bigint").alias("size"), z["value"].alias("value")))

    def placed(z: Column) -> Column:
        block = lambda i: F.slice(z, i * _BLOCK + 1, F.lit(_BLOCK))
        count = F.ceil(F.size(z) / _BLOCK).cast("int")
        total = lambda i: F.aggregate(block(i), F.lit(0).cast("bigint"), lambda acc, x: acc + x["gap"] + x["size"])
        totals = F.transform(F.sequence(F.lit(0), count - 1), total)
        begins = F.aggregate(totals, F.array(start.cast("bigint")), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t)))

        def inside(i: Column, begin: Column) -> Column:
            first = F.struct(begin.alias("at"), F.slice(F.transform(block(i), lambda x: F.struct(x["gap"].alias("start"), x["gap"].alias("end"), x["value"].alias("value"))), 1, 0).alias("out"))

            def step(acc: Column, x: Column) -> Column:
                at = acc["at"] + x["gap"]
                one = F.struct(at.alias("start"), (at + x["size"]).alias("end"), x["value"].alias("value"))
                return F.struct((at + x["size"]).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

            return F.aggregate(block(i), first, step, lambda acc: acc["out"])

        return _let(begins, lambda b: F.flatten(F.transform(F.sequence(F.lit(0), count - 1), lambda i: inside(i, F.get(b, i)))))

    return _let(Z, placed)


_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def _matches(text: Column, pattern: str, start: Column | None = None) -> Column:
    """(start, end, value) of the leftmost, non-overlapping matches, in code points."""
    start = F.lit(0) if start is None else start
    none = F.array().cast(_SPANS)

    def placed(found: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(found))
        return F.when(F.size(found) > 0, _in_blocks(gaps, F.transform(found, F.length), found, start)).otherwise(none)

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def valid(digits: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            digit = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
            twice = digit * 2
            return acc + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0

    return _let(_digits(value), valid)


def _dialled(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _hashed(kind: str, value: Column) -> Column:
    """An entity: a hash of kind and value as written plainly."""
    plainly = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}[kind]
    return F.xxhash64(F.lit(KINDS.index(kind)), plainly(value))


def _base(text: Column) -> Column:
    """(start, kind, end, entity) of all base spans in order; a kind is its place in ``KINDS``."""
    def of(kind: str, spans: Column, valid: Callable[[Column], Column] | None = None) -> Column:
        good = spans if valid is None else F.filter(spans, lambda x: valid(x["value"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), _hashed(kind, x["value"]).alias("entity")))

    none = F.array().cast(_SPANS)
    holds = lambda sign, pattern: F.when(F.contains(text, F.lit(sign)), _matches(text, pattern)).otherwise(none)
    return F.array_sort(
        F.concat(
            of("email", holds("@", EMAIL)),
            of("ip", _matches(text, IP), lambda v: F.rlike(v, F.lit(_VALID_IP))),
            of("card", _matches(text, CARD), _luhn),
            of("phone", holds("+", PHONE), _dialled),
        )
    )


def _entity(value: Column) -> Column:
    """The entity of a match of any kind; null for what is no base span."""
    mail, phone = F.contains(value, F.lit("@")), F.startswith(value, F.lit("+"))
    ip = F.contains(value, F.lit("."))
    return (
        F.when(mail, _hashed("email", value))
        .when(phone, F.when(_dialled(value), _hashed("phone", value)))
        .when(ip, F.when(F.rlike(value, F.lit(_VALID_IP)), _hashed("ip", value)))
        .otherwise(F.when(_luhn(value), _hashed("card", value)))
    )


def _words(part: Column, start: Column, rule: Disclosure) -> Column:
    """(start, end, term) of the words in a part of a text that begins at ``start``."""
    long = F.filter(_matches(part, _WORD, start), lambda x: F.length(x["value"]) >= rule.least_chars)
    return F.transform(long, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lower(x["value"]).alias("term")))


def _outside(text: Column, rule: Disclosure) -> Column:
    """(start, end, term) of all words of a text but those in e-mail addresses, the only base spans that hold letters."""
    def between(mails: Column, pieces: Column) -> Column:
        start = lambda i: F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(mails, i - 1)["end"])
        return F.flatten(F.transform(pieces, lambda piece, i: _words(piece, start(i), rule)))

    return _let(_matches(text, EMAIL), lambda mails: _let(F.split(text, EMAIL, -1), lambda pieces: between(mails, pieces)))


_NEAR = "array<struct<entity:bigint,start:bigint,end:bigint,term:string>>"


def _near(text: Column, rule: Disclosure) -> Column:
    """(entity, start, end, term) of words within reach of an entity; entities without such words have one row of null term.

    Between two entities, and at the text's ends, words end; a word that touches the end of the reach is not taken.
    """
    pattern = "|".join((EMAIL, PHONE, CARD, IP))

    def words(entity: Column, part: Column, start: Column) -> Column:
        return F.transform(_words(part, start, rule), lambda x: F.struct(entity.alias("entity"), x["start"].alias("start"), x["end"].alias("end"), x["term"].alias("term")))

    def before(entity: Column, piece: Column, end: Column) -> Column:
        part = F.when(F.length(piece) > rule.reach, F.regexp_replace(F.right(piece, F.lit(rule.reach)), r"^\p{L}+", "")).otherwise(piece)
        return _let(part, lambda p: words(entity, p, end - F.length(p)))

    def after(entity: Column, piece: Column, start: Column) -> Column:
        part = F.when(F.length(piece) > rule.reach, F.regexp_replace(F.left(piece, F.lit(rule.reach)), r"\p{L}+$", "")).otherwise(piece)
        return _let(part, lambda p: words(entity, p, start))

    def around(found: Column, pieces: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            alone = F.array(F.struct(_entity(x["value"]).alias("entity"), x["start"].alias("start"), x["end"].alias("end"), F.lit(None).cast("string").alias("term")))
            both = _let(_entity(x["value"]), lambda e: F.concat(alone, before(e, F.get(pieces, i), x["start"]), after(e, F.get(pieces, i + 1), x["end"])))
            return F.when(_entity(x["value"]).isNotNull(), both).otherwise(F.array().cast(_NEAR))

        return F.flatten(F.transform(found, one))

    return _let(F.split(text, pattern, -1), lambda pieces: _let(_matches(text, pattern), lambda found: around(found, pieces)))


def _family(term: Column, rule: Disclosure) -> Column:
    """What a longer word is generalised to: the letters that its family begins with, and an asterisk."""
    return F.when(F.length(term) > rule.family, F.concat(F.left(term, F.lit(rule.family)), F.lit("*")))


def _found(docs: DataFrame, rule: Disclosure, *kept: Column) -> DataFrame:
    """(row, content, base, kept..., and near, or without a reach entities, text): one stored row per row of ``docs``, with a
    number of its own; the text is null where nothing was found."""
    text = F.coalesce(F.col("text"), F.lit(""))
    based = docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("content"), _base(text).alias("base"), text.alias("text"), *kept)
    bare = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    if rule.reach is None:
        entities = F.array_distinct(F.transform("base", lambda x: x["entity"]))
        return cut(based.withColumns({"base": bare, "entities": entities, "text": F.when(F.size("base") > 0, F.col("text"))}))
    near = F.when(F.size("base") > 0, _near(F.col("text"), rule)).otherwise(F.array().cast(_NEAR))
    return cut(based.withColumns({"base": bare, "near": near}).drop("text"))


def _each_term(texts: DataFrame, rule: Disclosure) -> DataFrame:
    """One row for each different word and each different family in a text, with the other columns."""
    long = F.filter(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), lambda w: F.length(w) >= rule.least_chars)
    others = [c for c in texts.columns if c != "text"]
    held = texts.select(*others, F.array_distinct(F.transform(F.array_distinct(long), F.lower)).alias("w"))
    return held.select(*others, F.explode(F.concat("w", F.array_distinct(F.transform("w", lambda w: _family(w, rule))))).alias("term")).filter("term is not null")


def _sharing(found: DataFrame, rule: Disclosure, total: int) -> DataFrame:
    """(row, content, entities of (entity, n_entity)) of the rows with entities that words may disclose; entities of the
    same texts are one."""
    held = found.filter(F.size("base") > 0).select("row", "content", F.explode("entities").alias("own"))
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), F.col("content")))
    texts = held.groupBy("own", "content").agg(F.count("*").alias("n")).groupBy("own")
    counted = texts.agg(F.sum("n").alias("n_entity"), F.count("*").alias("texts"), mark(1).alias("one"), mark(2).alias("two"))
    shown = counted.filter((F.col("texts") >= rule.least_texts) & (F.col("n_entity") < total))
    shown = bounded(shown.select("own", F.xxhash64("texts", "one", "two").alias("entity"), "n_entity"), rule.sent)
    return cut(held.join(shown, "own").groupBy("row", "content").agg(F.collect_set(F.struct("entity", "n_entity")).alias("entities")))


def _pairs_near(found: DataFrame, rule: Disclosure) -> DataFrame:
    """(entity, n_entity, term, n_pair): words and families within reach of entities in enough texts."""
    has = lambda x: x["term"].isNotNull()
    per_row = F.array_distinct(F.transform("near", lambda x: x["entity"]))
    entities = found.filter(F.size("near") > 0).select(F.explode(per_row).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    level = lambda x, term: F.struct(x["entity"].alias("entity"), term.alias("term"))
    words = F.filter("near", has)
    levels = F.concat(F.transform(words, lambda x: level(x, x["term"])), F.transform(words, lambda x: level(x, _family(x["term"], rule))))
    together = found.filter(F.size("near") > 0).select("content", F.explode(F.array_distinct(levels)).alias("p")).select("content", "p.entity", "p.term")
    # A text counts once towards the evidence, its copies as documents.
    texts = together.filter("term is not null").groupBy("entity", "term", "content").agg(F.count("*").alias("n"))
    pairs = cut(texts.groupBy("entity", "term").agg(F.sum("n").alias("n_pair"), F.count("*").alias("texts")).filter(F.col("texts") >= rule.least_texts))
    return pairs.join(entities, "entity").select("entity", "n_entity", "term", "n_pair")


def _commonest(counted: DataFrame) -> DataFrame:
    """The words in most documents, whole powers of two of them, at most ``_COMMON``."""
    level = F.floor(F.log2("n_term"))
    sizes, taken, lowest = counted.groupBy(level.alias("level")).count().collect(), 0, 64
    for row in sorted(sizes, reverse=True):
        if (taken := taken + row["count"]) > _COMMON:
            break
        lowest = row["level"]
    return F.broadcast(counted.filter(level >= lowest))


def _pairs_whole(found: DataFrame, sharing: DataFrame, counted: DataFrame, rule: Disclosure, total: int) -> DataFrame:
    """(entity, n_entity, term, n_pair): words and families anywhere in enough texts of entities; not those that stand in too
    many documents to disclose any."""
    # A word wherever the entity is tells 1 - log2(n_term / n_entity) / log2(total / n_entity); a little more is let through.
    most = lambda n: n * F.pow(F.lit(float(total)) / n, F.lit(1 - rule.disclosed)) * 1.001
    common = _commonest(counted.filter(F.col("n_term") > most(F.lit(float(rule.least_texts)))))
    # A text counts once towards the evidence, its copies as documents.
    once = sharing.groupBy("content").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    texts = found.filter(F.size("base") > 0).select("row", "text").join(sharing.join(once, ["content", "row"]).select("row", "n", "entities"), "row").drop("row")
    terms = _each_term(texts, rule).join(common, "term", "left")
    telling = F.filter("entities", lambda e: F.col("n_term").isNull() | (F.col("n_term") <= most(e["n_entity"])))
    together = terms.select("n", "term", F.explode(telling).alias("e")).groupBy("e.entity", "e.n_entity", "term")
    pairs = together.agg(F.sum("n").alias("n_pair"), F.count("*").alias("texts")).filter(F.col("texts") >= rule.least_texts)
    return cut(pairs.select("entity", "n_entity", "term", "n_pair"))


def disclosing(docs: DataFrame, found: DataFrame, rule: Disclosure = Disclosure(), sharing: DataFrame | None = None) -> DataFrame:
    """(entity, term, kind, told): the words that tell too much of an entity, and what becomes of them beside it."""
    total = found.count()
    counted = _each_term(docs.select("text"), rule).groupBy("term").agg(F.count("*").alias("n_term"))
    if rule.reach is None:
        counted = cut(counted)
        pairs = _pairs_whole(found, _sharing(found, rule, total) if sharing is None else sharing, counted, rule, total)
    else:
        pairs = _pairs_near(found, rule)
    rated = pairs.join(counted, "term")
    # Word ends beside an entity can differ from those in the whole text, so a count of the former may be the larger one.
    told = F.log2(F.col("n_pair") * F.lit(float(total)) / (F.col("n_entity") * F.greatest("n_term", "n_pair"))) / F.log2(F.lit(float(total)) / F.col("n_entity"))
    rated = cut(rated.filter(F.col("n_entity") < total).select("entity", "term", told.alias("told")).filter(F.col("told") >= rule.disclosed))
    families = rated.filter(F.endswith("term", F.lit("*"))).select(F.col("entity").alias("of"), F.col("term").alias("family"))
    own = rated.filter(~F.endswith("term", F.lit("*")))
    joined = own.join(families, (F.col("entity") == F.col("of")) & (_family(F.col("term"), rule) == F.col("family")), "left")
    removed = F.col("family").isNotNull() | (F.length("term") <= rule.family)
    kind = F.when(removed, F.lit(KINDS.index("removed"))).otherwise(F.lit(KINDS.index("generalised")))
    return cut(joined.select("entity", "term", kind.alias("kind"), "told"))


def _words_near(docs: DataFrame, found: DataFrame, rule: Disclosure) -> DataFrame:
    """(row, start, end, kind): the disclosing words within reach of an entity."""
    told = bounded(disclosing(docs, found, rule).select("entity", "term", "kind"), rule.sent)
    beside = found.filter(F.size("near") > 0).select("row", F.explode("near").alias("x")).select("row", "x.*").filter("term is not null")
    return beside.join(told, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("kind").alias("kind"))


def _words_whole(docs: DataFrame, found: DataFrame, rule: Disclosure) -> DataFrame:
    """(row, start, end, kind): the disclosing words at all their places in the texts of an entity."""
    sharing = _sharing(found, rule, found.count())
    told = bounded(disclosing(docs, found, rule, sharing).select("entity", "term", "kind"), rule.sent)
    in_row = cut(sharing.select("row", F.explode("entities.entity").alias("entity")).join(told, "entity").groupBy("row", "term").agg(F.max("kind").alias("kind")))
    rows, terms = bounded(in_row.select("row").distinct(), rule.sent), bounded(told.select("term").distinct(), rule.sent)
    texts = found.filter(F.size("base") > 0).select("row", "text").join(rows, "row", "left_semi")
    places = texts.select("row", F.explode(_outside(F.col("text"), rule)).alias("x")).select("row", "x.*")
    return places.join(terms, "term", "left_semi").join(in_row, ["row", "term"]).select("row", "start", "end", "kind")


def _with_spans(docs: DataFrame, rule: Disclosure, *kept: Column) -> DataFrame:
    """(kept..., base, spans): arrays of (start, kind, end) in order; ``spans`` holds the base spans and the words."""
    names = [f"kept{i}" for i in range(len(kept))]
    found = _found(docs, rule, *[c.alias(n) for c, n in zip(kept, names)])
    words = (_words_whole if rule.reach is None else _words_near)(docs, found, rule)
    extra = words.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra"))
    plain, to_join = found.filter(F.size("base") == 0), found.filter(F.size("base") > 0)
    joined = to_join.join(extra, "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))))
    return plain.select(*names, "base", F.col("base").alias("spans")).unionByName(joined.select(*names, "base", spans.alias("spans")))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): one row per row of ``docs``.

    A null text is empty: no spans, and the digest of nothing. Repeated rows and copies have equal spans; copies count as documents in
    all probabilities but are one text of those that a disclosing word must be seen in. Null or repeated ids and very long texts
    are rows like others; extra columns are ignored, and an empty table gives no rows. The statistics run when this is called.
    """
    made = _with_spans(docs, rule, F.col("doc_id"))
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    counts = [of_kind(k) for k in range(4)]
    return made.select(F.col("kept0").alias("doc_id"), *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _rewritten(text: Column, spans: Column, rule: Disclosure) -> Column:
    """The text with a label for each base span and removed word, and its family for a generalised one."""
    def merge(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], x["end"]).alias("end"))
        before = F.slice(acc, 1, F.size(acc) - 1)
        return F.when((F.size(acc) > 0) & (x["start"] < F.get(acc, F.size(acc) - 1)["end"]), F.concat(before, F.array(longer))).otherwise(F.concat(acc, F.array(x)))

    def written(merged: Column) -> Column:
        n = F.size(merged)

        def block(i: Column) -> Column:
            """What up to 64 spans make of the text from the end of the span before them to their own end."""
            first, last = i * _BLOCK, F.least((i + 1) * _BLOCK, n) - 1
            begin = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(merged, first - 1)["end"])
            part = F.substr(text, (begin + 1).cast("int"), (F.get(merged, last)["end"] - begin).cast("int"))

            def one(p: Column, j: Column) -> Column:
                x = F.get(merged, j)
                since = F.when(j == first, begin).otherwise(F.get(merged, j - 1)["end"])
                own = F.substr(p, (x["start"] - begin + 1).cast("int"), (x["end"] - x["start"]).cast("int"))
                labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
                label = F.when(x["kind"] == KINDS.index("generalised"), _family(own, rule)).otherwise(F.get(labels, x["kind"]))
                return F.concat(F.substr(p, (since - begin + 1).cast("int"), (x["start"] - since).cast("int")), label)

            return _let(part, lambda p: F.array_join(F.transform(F.sequence(first, last), lambda j: one(p, j)), ""))

        rest = F.substr(text, (F.get(merged, n - 1)["end"] + 1).cast("int"), F.length(text))
        whole = F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(n / _BLOCK).cast("int") - 1), block), ""), rest)
        return F.when(n > 0, whole).otherwise(text)

    return _let(F.aggregate(spans, F.slice(spans, 1, 0), merge), written)


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with base spans and removed words replaced by labels and generalised words by their families.

    Spans that overlap are replaced as one, by the label of the first. Rows, other columns and null texts stay as they are.
    """
    made = _with_spans(docs, rule, F.struct(*[F.col(c) for c in docs.columns]))
    text = F.when(F.size("spans") > 0, _rewritten(F.col("kept0.text"), F.col("spans"), rule)).otherwise(F.col("kept0.text"))
    return made.select(*[text.alias(c) if c == "text" else F.col("kept0").getField(c).alias(c) for c in docs.columns])

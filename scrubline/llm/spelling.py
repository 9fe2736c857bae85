"""Grouping of spelling variants by asymmetric q-chunks.

Words within one edit are found by a join in which the two sides give different keys (Qin et al., "Asymmetric signature
schemes for efficient exact edit similarity query processing", 2013). The shorter word of a pair (the first in code-point
order of two as long) gives its two halves, disjoint chunks of which one edit can change only one. The longer word gives
positional grams as long as such a chunk. A chunk left of the edit keeps its place and one right of it is shifted by the
difference of the lengths, so of all positional grams only those can meet a chunk that start where it does, or one
place later if the words' lengths differ; the others are not written. A key is a hash of the shorter word's length, the
chunk's number and its characters. Words that share a key are verified with the edit distance inside the join; a pair that
shares both chunks counts at the first, so no pair is made twice.

A key whose two sides would meet in more than ``most_pairs`` pairs is taken out of that join. All words that hold such a key are
joined by what is left of them when any one character is dropped: two words within one edit share such a rest, and as
many words share one as there are letters to put in, so these groups are small however alike the words are.

Words are counted where the texts are read. Everything after that holds one row per distinct word or link.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import bounded, cut

# A run, the letters that are lower-cased, and the simulated slips: one run in so many loses a character.
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 97


@dataclass(frozen=True)
class Spelling:
    """Fewest code points and occurrences of a word, how many times more frequent a form is than its variant, the most
    pairs of a key in the chunk join, and the most hot keys that are sent to all tasks."""

    least_chars: int = 5
    least_count: int = 3
    factor: int = 2
    most_pairs: int = 1_000_000
    sent_keys: int = 500_000

    def __post_init__(self) -> None:
        if self.least_chars < 2:
            raise ValueError("a word of one character has no two chunks")


def _lower(run: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    plain = F.octet_length(run) == F.length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def _slipped(doc_id: Column, run: Column) -> Column:
    """The run, without one character where its hash says so."""
    hashed = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (hashed % F.length(run)).cast("int")
    return F.when(hashed % SLIP == 0, F.concat(F.left(run, at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """(word, n): distinct words and how often they occur. A null text has none; a null doc_id is written as nothing."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    # A slip only shortens a run.
    runs = runs.filter(F.length("run") >= rule.least_chars).select("doc_id", _lower(F.col("run")).alias("run"))
    made = runs.select(_slipped(F.col("doc_id"), F.col("run")).alias("word"))
    counts = made.filter(F.length("word") >= rule.least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= rule.least_count)


def _key(length: Column, number: int, characters: Column) -> Column:
    return F.xxhash64(length, F.lit(number), characters)


def _chunks(counted: DataFrame) -> DataFrame:
    """(key, a, a_n, second): the two halves of each word."""
    n = F.length("word")
    half = F.floor(n / 2).cast("int")
    keys = [(_key(n, 0, F.left("word", half)), 0), (_key(n, 1, F.right("word", n - half)), 1)]
    every = F.explode(F.array(*[F.struct(k.alias("key"), F.lit(i == 1).alias("second")) for k, i in keys]))
    return counted.select(every.alias("k"), "word", "n").select("k.key", F.col("word").alias("a"), F.col("n").alias("a_n"), "k.second")


def _grams(counted: DataFrame, rule: Spelling) -> DataFrame:
    """(key, b, b_n): the grams by which a word can meet the chunks of one as long or one shorter."""
    n = F.length("word")
    made = []
    for shorter in (0, 1):
        length = n - shorter
        half = F.floor(length / 2).cast("int")
        # The second chunk starts at half; its place is shifted by ``shorter`` and it then ends with the word.
        own = F.array(_key(length, 0, F.left("word", half)), _key(length, 1, F.right("word", length - half)))
        made.append(F.when(length >= rule.least_chars, own).otherwise(F.array().cast("array<bigint>")))
    every = F.explode(F.concat(*made))
    return counted.select(every.alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))


def _linked() -> Column:
    """Whether (a, b) is an ordered pair of words that are one edit apart."""
    longer = F.length("b") - F.length("a")
    return ((longer == 1) | ((longer == 0) & (F.col("a") < F.col("b")))) & (F.levenshtein("a", "b", 1) == 1)


def _rests(counted: DataFrame, left: bool) -> DataFrame:
    """(rest, word): each word under what is left of it without any one character, longer words of a pair so alone."""
    w, name = F.col("word"), "a" if left else "b"
    without = F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.xxhash64(F.concat(F.left(w, i - 1), F.substr(w, i + 1))))
    rests = F.array_distinct(F.concat(F.array(F.xxhash64(w)), without) if left else without)
    return counted.select(F.explode(rests).alias("rest"), w.alias(name), F.col("n").alias(f"{name}_n"))


def links(counted: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """(a, a_n, b, b_n): every pair of different words one edit apart, once, from (word, n)."""
    chunks, grams = _chunks(counted), _grams(counted, rule)
    sides = chunks.select("key", F.lit(1).alias("x")).unionByName(grams.select("key", F.lit(0).alias("x")))
    sizes = sides.groupBy("key").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    meeting = F.col("x").cast("double") * (F.col("n") - F.col("x"))
    hot = cut(sizes.filter(meeting > rule.most_pairs).select("key"))
    some = not hot.isEmpty()
    if some:
        hot = bounded(hot, rule.sent_keys)
        hot_words = cut(chunks.join(hot, "key", "left_semi").select(F.col("a").alias("word"), F.col("a_n").alias("n")).unionByName(
            grams.join(hot, "key", "left_semi").select(F.col("b").alias("word"), F.col("b_n").alias("n"))).distinct())
        chunks = chunks.join(hot, "key", "left_anti")
    half = F.floor(F.length("a") / 2).cast("int")
    new = ~F.col("second") | (F.left("a", half) != F.left("b", half))
    names = ["a", "a_n", "b", "b_n"]
    found = chunks.alias("c").join(grams.alias("g"), (F.col("c.key") == F.col("g.key")) & _linked() & new).select(names)
    if some:
        apart = _rests(hot_words, True).alias("l").join(_rests(hot_words, False).alias("r"), (F.col("l.rest") == F.col("r.rest")) & _linked())
        # A pair may share several rests, and a key that is not hot.
        found = found.unionByName(apart.select(names)).distinct()
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form) by doubling steps: a form occurs more often than its variant, so there are no rings."""
    found = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = found.select(F.col("word").alias("of"), F.col("root").alias("next"))
        stepped = cut(found.join(onward, F.col("root") == F.col("of"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        found = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return found


def group(docs: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of at least ``least_chars`` code points and ``least_count``
    occurrences in ``docs``.

    ``form`` is the near word (one edit apart) of largest n, of several the first in code-point order, if it occurs ``factor``
    times as often at least; ``root`` is where forms lead, the word itself if it has none. Repeated rows count as often as
    they occur, with equal slips. Null and empty texts have no words, however long a text is it is read whole; extra
    columns are ignored, and an empty table gives no rows.
    """
    counted = cut(words(docs, rule))
    both = F.explode(F.array(*[F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")) for x, y in ("ab", "ba")]))
    near = links(counted, rule).select(both.alias("l")).select("l.*")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first")
    stats = near.groupBy("word").agg(F.count("*").alias("n_near"), first).withColumnRenamed("word", "of")
    joined = counted.join(stats, F.col("word") == F.col("of"), "left")
    form_n = -F.col("first.less")
    formed = form_n >= rule.factor * F.col("n")
    judged = cut(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(formed, F.col("first.near")).alias("form"), F.when(formed, form_n).alias("form_n")))
    roots = _roots(judged.filter("form is not null").select("word", "form")).withColumnRenamed("word", "of")
    rooted = judged.join(roots, F.col("word") == F.col("of"), "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The same rows for DuckDB, with links from words that agree but for one place.
ORACLE = r"""
WITH RECURSIVE crc AS (
    -- The table of CRC-32, by its rule.
    SELECT list(list_reduce(range(8), lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) ORDER BY i) AS t
    FROM range(256) r(i)
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL
), bytes AS (
    SELECT run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS h FROM runs
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
        lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8), 4294967295)) AS h
    FROM bytes, crc
), slipped AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n AS m
    FROM hashed
), words AS (
    SELECT word, sum(m)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3
), rests AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)
), near AS (
    -- One character replaced, or one more in either word.
    SELECT a.word, b.word AS other, b.n FROM rests a JOIN rests b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN rests b ON a.word = b.rest
    UNION SELECT a.word, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
), stats AS (
    SELECT word, count(*) AS n_near, min(struct_pack(less := -n, other := other)) AS first FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -first.less >= 2 * w.n THEN first.other END AS form,
        CASE WHEN -first.less >= 2 * w.n THEN -first.less END AS form_n
    FROM words w LEFT JOIN stats s ON s.word = w.word
), steps AS (
    SELECT word, word AS at FROM formed
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL
), roots AS (
    SELECT s.word, s.at AS root FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN roots r ON r.word = f.word
"""

"""URL filter: short rules first, then a long list of canonical URLs behind a blocked Bloom filter.

The list's canonical URLs set bits in blocks of 256 bits, eight words with one bit each; the blocks are built by a
grouped bit_or, and their number grows with the list. Up to ``sent_blocks`` rows they are sent to all tasks. A larger filter
stays sharded by block, and pages that no rule decides meet their block by a shuffle. A page whose block lacks a bit is surely
not listed. Only possible hits take part in the exact join with the list, which removes false positives. Both sides of
the joins are plain exchanges, so adaptive execution splits a URL that very many pages share.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import cut

# The odd multipliers of a split-block Bloom filter's eight words (Apache Parquet's format).
_SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_SPREAD = 4096
_TRACKING = r"&(utm_[^=&]*|ref)=[^&]*"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Bloom:
    """Bits per listed URL, and the most blocks (32 bytes each, about 100 as a row) that are sent to all tasks."""

    bits_per_url: int = 16
    sent_blocks: int = 1 << 17


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.``, path without trailing slashes, query without tracking parameters; no scheme and no
    fragment. Null without ``://``."""
    query = F.regexp_replace(F.concat(F.lit("&"), F.regexp_replace(F.regexp_extract(url, _PARTS, 3), r"^\?", "")), _TRACKING, "")
    query = F.when(F.length(query) > 1, F.concat(F.lit("?"), F.substring(query, 2, 1 << 30))).otherwise("")
    whole = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""), query)
    return F.when(F.instr(url, "://") > 0, whole)


def _fits(rule: Rule, at: Column, way: Column) -> Column:
    return ((at == rule.host) | at.endswith("." + rule.host)) & way.startswith(rule.path)


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``__rule`` and ``__ruled``: the longest fitting rule and its verdict, or nulls. Of equally long rules, which may
    both fit only if they are equal, block wins."""
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), r.verdict == "block")):
        fits = _fits(rule, F.col("host"), F.col("path"))
        which, verdict = F.when(fits, str(rule)).otherwise(which), F.when(fits, rule.verdict).otherwise(verdict)
    return pages.withColumns({"__rule": which, "__ruled": verdict})


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(url), 32), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    low = F.xxhash64(url).bitwiseAND(F.lit(0x7FFFFFFF))
    bits = [F.shiftright(low * F.lit(salt), 27).bitwiseAND(F.lit(31).cast("bigint")).cast("int") for salt in _SALTS]
    return [F.call_function("shiftleft", F.lit(1), bit) for bit in bits]


def bloom(listed: DataFrame, size: Bloom) -> tuple[DataFrame, int]:
    """(block, w0..w7) of the non-empty blocks, and the number of blocks, from distinct ``url``."""
    wanted = max(1, listed.count() * size.bits_per_url // 256)
    blocks = min(1 << 31, 1 << (wanted - 1).bit_length())
    words = {f"w{i}": m for i, m in enumerate(_masks(F.col("url")))}
    marked = listed.select(_block(F.col("url"), blocks).alias("block"), *[m.alias(n) for n, m in words.items()])
    return cut(marked.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in words])), blocks


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, size: Bloom = Bloom()) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, which replace columns of these names.

    The longest fitting rule decides; without one a page is blocked if its canonical URL is in ``listed`` (one column,
    ``url``, canonical; nulls and repeats are allowed), else allowed. A null url, or one without ``://``, has empty host and
    path, no rule, and is allowed. Rows repeat as they come; a url of any length is judged whole. An empty list blocks
    nothing, an empty table gives no rows. The filter has the same bits per URL for a list of any
    length, up to some 10^10 URLs.
    """
    known = cut(listed.select("url").filter("url is not null").distinct())
    filter_, blocks = bloom(known, size)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*kept, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), canonical(F.col("url")).alias("__url"))
    ruled = with_rule(parsed, rules)
    filter_ = filter_.withColumnsRenamed({c: f"__{c}" for c in filter_.columns})
    if blocks <= size.sent_blocks:
        probed = ruled.join(F.broadcast(filter_), (_block(F.col("__url"), blocks) == F.col("__block")) & F.col("__rule").isNull(), "left")
    else:
        # Rows that ask nothing are dealt over numbers that no block has.
        nothing = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(_SPREAD))
        asked = F.col("__rule").isNull() & F.col("__url").isNotNull()
        at = ruled.withColumn("__at", F.when(asked, _block(F.col("__url"), blocks)).otherwise(nothing))
        probed = at.join(filter_, F.col("__at") == F.col("__block"), "left")
    every = F.lit(True)
    for i, mask in enumerate(_masks(F.col("__url"))):
        every = every & (F.col(f"__w{i}").bitwiseAND(mask) == mask)
    probed = probed.withColumn("__maybe", F.coalesce(every, F.lit(False)))
    out = [*kept, "host", "path", F.col("__rule").alias("rule")]
    sure = probed.filter("not __maybe").select(*out, F.coalesce("__ruled", F.lit("allow")).alias("verdict"))
    exact = known.select(F.col("url").alias("__listed"))
    possible = probed.filter("__maybe").join(exact, F.col("__url") == F.col("__listed"), "left")
    verdict = F.when(F.col("__listed").isNotNull(), F.lit("block")).otherwise("allow")
    return sure.unionByName(possible.select(*out, verdict.alias("verdict")))


def junk_urls(pages: DataFrame) -> DataFrame:
    """The query's list: canonical URLs of pages whose markup holds shouting or runs of symbols."""
    junk = F.col("html").contains("!!") | F.col("html").contains("***")
    return pages.filter(junk).select(canonical(F.col("url")).alias("url"))


ORACLE = f"""
WITH parsed AS (
    SELECT page_id, html, url,
        coalesce(translate(regexp_extract(url, '{_PARTS}', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
        coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path,
        regexp_replace('&' || regexp_replace(regexp_extract(url, '{_PARTS}', 3), '^\\?', ''), '{_TRACKING}', '', 'g') AS query
    FROM pages
), named AS (
    SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
        || CASE WHEN length(query) > 1 THEN '?' || substr(query, 2) ELSE '' END END AS canonical
    FROM parsed
), rules(verdict, host, path) AS (
    VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}
), fitting AS (
    SELECT page_id, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC) AS place
    FROM named n JOIN rules r
        ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
), listed AS (
    SELECT DISTINCT canonical FROM named WHERE (contains(html, '!!') OR contains(html, '***')) AND canonical IS NOT NULL
)
SELECT n.page_id, n.host, n.path, f.rule,
    coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n
LEFT JOIN fitting f ON f.page_id = n.page_id AND f.place = 1
LEFT JOIN listed l ON l.canonical = n.canonical
"""

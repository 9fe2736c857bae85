"""SimHash near-duplicates: 64-bit fingerprints, linked by deletion-variant signatures.

With at most k differing bits, k // 2 + 1 segments leave one segment that differs by one bit at most. So every
fingerprint is indexed under each segment with one bit struck out (64 rows); two linked fingerprints are equal in at
least one of these. Rows meet by that key, and every link is verified on the whole fingerprint.

Hot keys: copies with equal fingerprints are one row from the start. Inside a key no pairs are emitted: small groups
give their verified links once (in the first key that the pair shares), larger ones a spanning forest, found by walking
from member to member over those not reached yet. A group over ``group_rows`` is dealt anew by the bits outside its
segment, with the same segment cut. A group that is still larger is dealt in blocks of half that size, every pair of
blocks under a key of its own, so one task never holds more than that.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import arrow_map, cut, in_blocks, unsigned
from scrubline.llm.components import components

# Fixed value: the seed of the shingles' XXH64.
SEED = 42
BITS = 64
_BLOCK = 1 << 16
# A group is dealt in blocks of so many rows at least: groups of up to 64 rows list all their links, not a forest.
_LEAST_DEALT = 1000


@dataclass(frozen=True)
class SimHash:
    """Shingle length in words, most differing bits, and the most rows of a key that one task holds."""

    words: int = 4
    distance: int = 4
    group_rows: int = 50_000


def fingerprint(text: bytes | None, words: int = 4) -> int:
    """Of UTF-8 text with A-Z lower-cased: a bit is 1 if set in over half of the shingle hashes. No words: 0."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[: len(parts) - words] + 1).tolist()]
    stops = ends[words - 1 :].tolist()
    digest, count = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(starts), _BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + _BLOCK], stops[i : i + _BLOCK])]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, rule: SimHash = SimHash()) -> DataFrame:
    """(doc_id, content, fingerprint): content is a 64-bit hash of the text; the fingerprint is a signed bigint."""
    words = rule.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(None if t is None else t.as_py(), words) for t in batch.column(2).cast(pa.binary())]
            column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], ["doc_id", "content", "fingerprint"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("content"), "text")
    return narrow.transform(arrow_map, run, "doc_id bigint, content bigint, fingerprint bigint")


def _segments(bits: list[int], distance: int) -> list[list[int]]:
    """The given bit positions, cut so that one segment of a linked pair differs by at most one bit."""
    return [part.tolist() for part in np.array_split(np.array(bits), max(2, distance // 2 + 1))]


def _masks(bits: list[int], distance: int) -> list[tuple[int, int]]:
    """(struck-out bit, mask of its segment without it), in key order."""
    whole = [(seg, sum(1 << b for b in seg)) for seg in _segments(bits, distance)]
    return [(b, full & ~(1 << b)) for seg, full in whole for b in seg]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _first_key(diff: np.ndarray, distance: int) -> np.ndarray:
    """The first of the 64 keys in which a pair with these differing bits meets."""
    first = np.full(len(diff), -1, dtype=np.int64)
    for seg in reversed(_segments(list(range(BITS)), distance)):
        own = diff & np.uint64(sum(1 << b for b in seg))
        many = _popcount(own)
        bit = _popcount(own - np.uint64(1))  # of a single bit: its position
        first = np.where(many == 0, seg[0], np.where(many == 1, bit, first))
    return first


def _forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning-forest edges of the links between these fingerprints."""
    left, edges = prints, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = _popcount(left ^ node) <= distance
            if near.any():
                reached = left[near]
                edges += [(node, other) for other in reached]
                queue += list(reached)
                left = left[~near]
    return edges


def _variants(distance: int):
    """Batches of fingerprints -> (key, spot, fp): spot is the struck-out bit, key the rest of the segment with it."""
    masks = _masks(list(range(BITS)), distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(prints), 2000):
                part = prints[i : i + 2000]
                keys = np.concatenate([_key(part, bit, mask) for bit, mask in masks])
                spots = np.repeat(np.array([bit for bit, _ in masks], dtype=np.int32), len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(spots), pa.array(np.tile(part, len(masks)).view(np.int64))], ["key", "spot", "fp"]
                )

    return run


def _key(prints: np.ndarray, bit: int, mask: int) -> np.ndarray:
    """The masked bits with the struck-out bit's number, in one word: a segment of up to 58 bits leaves room for it."""
    low = (mask & -mask).bit_length() - 1 if mask else 0
    return ((prints & np.uint64(mask)) >> np.uint64(low)) | np.uint64(bit << 58)


def _links(distance: int, group_rows: int | None):
    """Rows sorted by key -> links (a, b), and (key, fp) of groups over ``group_rows``, which stay unresolved.

    Without a limit (the second cut) all groups are resolved, and a link may come from several keys.
    """

    def small(keys, spots, prints, out) -> None:
        """All groups of up to 64 rows at once: row i against row i + shift."""
        for shift in range(1, 64):
            if len(keys) <= shift:
                return
            same = np.flatnonzero(keys[shift:] == keys[:-shift])
            if not len(same):
                return
            diff = prints[same] ^ prints[same + shift]
            ok = _popcount(diff) <= distance
            if group_rows is not None:
                ok[ok] = _first_key(diff[ok], distance) == spots[same[ok]]
            if ok.any():
                out.append((prints[same[ok]], prints[same[ok] + shift]))

    def batch_of(a, b, kind) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(a, dtype=np.uint64).view(np.int64)), pa.array(np.asarray(b, dtype=np.uint64).view(np.int64)), pa.array(np.full(len(a), kind))],
            ["a", "b", "open"],
        )

    def whole_groups(batches, keep: list):
        """Chunks that end where a group ends; rows of a group over the limit are passed on as they come."""
        key = spot = fp = None
        over = None  # the key whose rows are passed on
        for batch in batches:
            k, s, f = (batch.column(i).to_numpy() for i in range(3))
            f = f.view(np.uint64)
            if over is not None:
                n = int(np.searchsorted(k != over, True)) if (k != over).any() else len(k)
                if n:
                    keep.append((k[:n].view(np.uint64), f[:n]))
                k, s, f = k[n:], s[n:], f[n:]
                if not len(k):
                    yield None
                    continue
                over = None
            if key is not None:
                k, s, f = np.concatenate([key, k]), np.concatenate([spot, s]), np.concatenate([fp, f])
            start = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
            if start:
                yield k[:start], s[:start], f[:start]
            key, spot, fp = k[start:], s[start:], f[start:]
            if group_rows is not None and len(key) > group_rows:
                keep.append((key.view(np.uint64), fp))
                over, key, spot, fp = key[0], None, None, None
                yield None
        if key is not None and len(key):
            yield key, spot, fp

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep: list = []
        for chunk in whole_groups((b for b in batches if b.num_rows), keep):
            while keep:
                yield batch_of(*keep.pop(), True)
            if chunk is None:
                continue
            keys, spots, prints = chunk
            edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            sizes = np.diff(edge)
            out: list = []
            for i in np.flatnonzero(sizes > 64):
                if group_rows is not None and sizes[i] > group_rows:
                    yield batch_of(keys[edge[i] : edge[i + 1]].view(np.uint64), prints[edge[i] : edge[i + 1]], True)
                    continue
                pairs = _forest(prints[edge[i] : edge[i + 1]], distance)
                if pairs:
                    out.append(tuple(np.array(x, dtype=np.uint64) for x in zip(*pairs)))
            few = np.repeat((sizes > 1) & (sizes <= 64), sizes)
            small(keys[few], spots[few], prints[few], out)
            for a, b in out:
                yield batch_of(a, b, False)

    return run


def _refine(distance: int):
    """(key, fp) of unresolved groups -> (key, spot, fp) by the bits outside the group's segment, cut again."""
    plans = []
    for seg in _segments(list(range(BITS)), distance):
        rest = [b for b in range(BITS) if b not in seg]
        plans += [(b, _masks(rest, distance)) for b in seg]
    by_spot = dict(plans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prints = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
            outer = keys >> np.uint64(58)
            for spot in np.unique(outer):
                own = outer == spot
                for bit, mask in by_spot[int(spot)]:
                    # A pair that meets here shares the old key and the new masked bits: 64 bits name both.
                    mixed = np.array([xxhash.xxh64_intdigest(x, bit) for x in np.stack([keys[own], prints[own] & np.uint64(mask)], 1)], dtype=np.uint64)
                    n = int(own.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mixed.view(np.int64)), pa.array(np.full(n, -1, dtype=np.int32)), pa.array(prints[own].view(np.int64))], ["key", "spot", "fp"]
                    )

    return run


_KEYED = "key bigint, spot int, fp bigint"
_LINKED = "a bigint, b bigint, open boolean"


def links(prints: DataFrame, rule: SimHash = SimHash()) -> DataFrame:
    """(a, b): pairs of distinct fingerprints whose closure is that of all pairs within the distance; each verified.

    ``prints`` has one column of distinct signed fingerprints.
    """
    grouped = prints.transform(arrow_map, _variants(rule.distance), _KEYED).repartition("key").sortWithinPartitions("key", "fp")
    found = cut(grouped.transform(arrow_map, _links(rule.distance, rule.group_rows), _LINKED))
    result = found.filter(~F.col("open")).select("a", "b")
    unresolved = found.filter("open").select("a", "b")
    if not unresolved.isEmpty():
        # Members of a group now agree on some 36 bits but for two, and are all distinct.
        finer = in_blocks(cut(unresolved.transform(arrow_map, _refine(rule.distance), _KEYED)), "key", "fp", max(rule.group_rows, _LEAST_DEALT))
        again = finer.repartition("key").sortWithinPartitions("key", "fp")
        result = result.unionByName(again.transform(arrow_map, _links(rule.distance, None), _LINKED).select("a", "b"))
    return result


def near_duplicates(docs: DataFrame, rule: SimHash = SimHash()) -> DataFrame:
    """(doc_id, content, fingerprint, component_id, representative): one row per row of ``docs``.

    component_id is the smallest doc_id that links reach, itself included. Null and empty texts and texts without words
    have fingerprint zero and are linked like any other. Rows without a doc_id take part; they count as last in a
    component, whose id is null if no row of it has one. A text of any length is one fingerprint, made by one task. ``representative`` marks the one (doc_id, content) of each
    component that stays: its smallest doc_id, ties by content; identical rows are all marked. Extra columns of
    ``docs`` are ignored; an empty table gives an empty one.
    """
    marked = cut(with_fingerprint(docs, rule))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "content")).alias("first")
    nodes = cut(marked.groupBy("fingerprint").agg(first))
    stars = components(links(nodes.select("fingerprint"), rule), "a", "b")
    rooted = nodes.join(stars, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    rooted = cut(rooted.select("fingerprint", "root", "first"))
    tops = cut(rooted.groupBy("root").agg(F.min("first").alias("top")))
    classes = cut(rooted.join(tops, "root").select("fingerprint", "top"))
    same = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("content") == F.col("top.content"))
    return marked.join(classes, "fingerprint").select(
        "doc_id", "content", "fingerprint", F.col("top.doc_id").alias("component_id"), same.alias("representative")
    )


def deduplicate(docs: DataFrame, rule: SimHash = SimHash()) -> DataFrame:
    """``docs`` with one row of each component, its columns unchanged. Of identical rows one stays."""
    keep = near_duplicates(docs, rule).filter("representative").groupBy("doc_id", "content").agg(F.count("*").alias("rows"))
    keep = cut(keep)
    content = "__content"
    with_content = docs.withColumn(content, F.xxhash64("text"))
    ids = F.col("doc_id").cast("bigint")
    right = keep.select(F.col("doc_id").alias("__id"), F.col("content").alias("__of"), "rows")
    on = ids.eqNullSafe(F.col("__id")) & (F.col(content) == F.col("__of"))
    once = with_content.join(right.filter("rows = 1"), on, "left_semi")
    if keep.filter("rows > 1").isEmpty():
        return once.drop(content)
    twice = with_content.join(right.filter("rows > 1"), on, "left_semi").dropDuplicates(["doc_id", content])
    return once.unionByName(twice).drop(content)


def report(docs: DataFrame, rule: SimHash = SimHash()) -> DataFrame:
    """The digest: doc_id, fingerprint as 16 hex digits, component_id."""
    return near_duplicates(docs, rule).select("doc_id", unsigned(F.col("fingerprint")).alias("fingerprint"), "component_id")

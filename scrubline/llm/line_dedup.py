"""Near-duplicate lines by a segment-partition edit join.

Two lines within ``edits`` edits share, of edits + 1 even segments of the shorter one, at least one unchanged and shifted by a
bounded amount (Li et al., "Pass-Join", 2011). So every line is indexed under its own segments and probes, for each
length it could be joined with, the substrings that segments of that length can have become. Only 16 bytes per key move:
a hash of (length, segment number, substring), whose low bits are the number, and the line's hash with a bit for indexed
or probed. Keys that no two lines share end there. Only for the others texts are joined to the keys, dealt by key, and lines
verified by a banded bit-parallel edit distance.

Lines under ``least_chars`` are linked within one edit. Their segments would be too common, so their keys are the line and
all that one dropped character makes of it: two lines within one edit share one, and few other lines do.

Hot lines and hot keys: equal lines are one line from their batch on. Inside a key no pairs are emitted: a walk from line to
line over those not reached yet gives a spanning forest of the verified links, so no link between different lines is lost.
A key with over ``group_rows`` lines is dealt anew by segments half as long, outside the segment that its lines share; one that
is still larger in blocks of half that size, every pair of blocks under a key of its own.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import WORD, arrow_map, cut, in_blocks
from scrubline.llm.components import components


@dataclass(frozen=True)
class LineDedup:
    """Most edits between linked lines, the fewest characters of a line for so many, the fewest for one edit (shorter ones
    must be equal; of two lines the shorter one counts), the most lines of a key that are verified as one group, and the
    most ids that are sent to the scan."""

    edits: int = 2
    least_chars: int = 30
    short_chars: int = 8
    group_rows: int = 20_000
    sent_ids: int = 500_000

    def __post_init__(self) -> None:
        if not 1 <= self.edits <= 5 or self.least_chars < 4 * (self.edits + 1):
            raise ValueError("1 to 5 edits, and lines of four characters per segment at least")
        if not 4 <= self.short_chars <= self.least_chars:
            raise ValueError("one edit from four characters at least")

    def allowed(self, length: int) -> int:
        """Most edits between a line of so many characters and one that is not shorter."""
        return self.edits if length >= self.least_chars else int(length >= self.short_chars)


_SEGMENT_BITS = 4  # a key's low bits: the segment's number, from 1; 0 for the key of a short line


def _even(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of even segments; the longer ones are the last."""
    size, more = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        own = size + (i >= parts - more)
        out.append((at, own))
        at += own
    return out


def short_keys(line: str, rule: LineDedup) -> list[tuple[int, bool]]:
    """(key, indexed) of a line that can be linked within one edit to a short one: itself, and without each character."""
    if not rule.short_chars <= len(line) <= rule.least_chars:
        return []
    made = {line} | {line[:i] + line[i + 1 :] for i in range(len(line))}
    return [(xxhash.xxh64_intdigest(x.encode()) >> _SEGMENT_BITS << _SEGMENT_BITS, True) for x in made]


def segment_keys(line: str, rule: LineDedup) -> list[tuple[int, bool]]:
    """(key, indexed): the line's own segments, and the substrings to probe for lines of its length or up to ``edits`` less;
    and those of short lines."""
    t, n, out = rule.edits, len(line), short_keys(line, rule)
    for length in range(n, max(rule.least_chars, n - t) - 1, -1):
        delta = n - length
        for i, (at, size) in enumerate(_even(length, t + 1)):
            # If segments before this one are all changed, at most i edits lie left of it and t - i right of it.
            low = max(0, at - i, at + delta - (t - i))
            high = min(n - size, at + i, at + delta + (t - i))
            for start in range(low, high + 1):
                hashed = xxhash.xxh64_intdigest(line[start : start + size].encode(), length)
                out.append((hashed >> _SEGMENT_BITS << _SEGMENT_BITS | i + 1, delta == 0 and start == at))
    return out


def finer_keys(line: str, key: int, rule: LineDedup) -> list[tuple[int, bool]]:
    """Keys inside a hot key: segments half as long, but for the two that its segment covers. Of the 2 * edits others at most
    ``edits`` are changed in a linked line; a segment is shifted by at most ``edits``."""
    n, shared, out = len(line), (key & (1 << _SEGMENT_BITS) - 1) - 1, []
    for length in range(n, n - rule.edits - 1, -1):
        delta, t = n - length, rule.allowed(length)
        if delta > t or not t:
            continue
        for i, (at, size) in enumerate(_even(length, 2 * (t + 1))):
            if i // 2 == shared:
                continue
            for start in range(max(0, at - t, at + delta - t), min(n - size, at + t, at + delta + t) + 1):
                seed = xxhash.xxh64_intdigest(line[start : start + size].encode(), length * 64 + i)
                out.append((xxhash.xxh64_intdigest(key.to_bytes(8, "little"), seed), delta == 0 and start == at))
    return out


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: common ends are cut off, then states of the diagonals in the band are
    bits of one word per number of edits."""
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[-mid:] == b[-mid:] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    if min(len(a), len(b)) == 0:
        return max(len(a), len(b)) <= edits
    places: dict[str, int] = {}
    for j, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << j + edits
    band = (1 << 2 * edits + 1) - 1
    # reach[e], bit d: with e edits at most, the part of a read so far becomes the part of b that is d - edits longer.
    reach = [(1 << e + 1) - 1 << edits for e in range(edits + 1)]
    for i, c in enumerate(a):
        same = places.get(c, 0) >> i
        before = reach[0]
        reach[0] = before & same & band
        for e in range(1, edits + 1):
            now = reach[e]
            # unchanged, replaced, dropped from a, or put in from b
            reach[e] = (now & same | before | before >> 1 | reach[e - 1] << 1) & band
            before = now
        if not reach[edits]:
            return False
    return bool(reach[edits] >> (len(b) - len(a) + edits) & 1)


def forest(lines: list[str], rule: LineDedup) -> list[tuple[int, int]]:
    """Spanning-forest edges (places in ``lines``) of all pairs within the edits that the shorter one allows."""
    edits = rule.edits
    sizes = np.array([len(x) for x in lines], dtype=np.int32)
    # An edit changes at most two of these counts, by one.
    kinds = np.zeros((len(lines), 32), dtype=np.int16)
    if len(lines) > 8:
        for i, line in enumerate(lines):
            points = np.frombuffer(line.encode("utf-32-le"), dtype="<u4")
            kinds[i] = np.minimum(np.bincount(points & 31, minlength=32), 30_000)
    left, edges = np.arange(len(lines)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.abs(sizes[left] - sizes[node]) <= edits
            near[near] = np.abs(kinds[left[near]] - kinds[node]).sum(axis=1) <= 2 * edits
            reached = [int(k) for k in np.flatnonzero(near) if within(lines[node], lines[int(left[k])], rule.allowed(min(sizes[node], sizes[left[k]])))]
            if reached:
                found = left[reached].tolist()
                edges += [(node, other) for other in found]
                queue += found
                left = np.delete(left, reached)
    return edges


def _key_rows(rule: LineDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[int] = []
            marks: list[int] = []
            for line_id, line in dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())).items():
                for key, indexed in segment_keys(line, rule):
                    keys.append(key)
                    marks.append(line_id << 1 | indexed)
            yield _pairs(keys, marks)

    return run


def _finer_rows(rule: LineDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                keys: list[int] = []
                marks: list[int] = []
                for key, line_id, line in zip(*(batch.column(i)[at : at + 200].to_pylist() for i in range(3))):
                    for finer, indexed in finer_keys(line, key % (1 << 64), rule):
                        keys.append(finer)
                        marks.append(line_id << 1 | indexed)
                yield _pairs(keys, marks)

    return run


def _pairs(keys: list[int], marks: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(np.array(marks, dtype=np.int64))], ["key", "mark"])


def _shared_rows(limit: int | None):
    """(key, mark) sorted by key -> (key, id, hot) of keys with two lines or more, one of them indexed."""

    def settled(keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One row per line of a key; it is indexed if any of its rows is."""
        order = np.lexsort((marks, keys))
        keys, marks = keys[order], marks[order]
        last = np.r_[(keys[1:] != keys[:-1]) | (marks[1:] >> 1 != marks[:-1] >> 1), True] if len(keys) else np.zeros(0, bool)
        return keys[last], marks[last]

    def out(keys: np.ndarray, marks: np.ndarray, hot: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks >> 1), pa.array(np.full(len(keys), hot))], ["key", "id", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = marks = np.zeros(0, dtype=np.int64)
        passing = None  # a key over the limit, whose rows are passed on as they come
        for batch in batches:
            keys, marks = np.r_[keys, batch.column(0).to_numpy()], np.r_[marks, batch.column(1).to_numpy()]
            if not len(keys):
                continue
            whole = keys != keys[-1]
            yield from groups(*settled(keys[whole], marks[whole]), passing)
            keys, marks = settled(keys[~whole], marks[~whole])
            if passing is not None and keys[0] != passing:
                passing = None
            if limit is not None and (passing is not None or len(keys) > limit):
                passing = keys[0]
                yield out(keys, marks, True)
                keys = marks = np.zeros(0, dtype=np.int64)
        yield from groups(keys, marks, passing)

    def groups(keys: np.ndarray, marks: np.ndarray, passing) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        sizes = np.diff(edge)
        indexed = np.add.reduceat(marks & 1, edge[:-1]) > 0
        hot = np.zeros(len(sizes), bool) if limit is None else (sizes > limit)
        if passing is not None:
            hot |= keys[edge[:-1]] == passing
        some = (sizes > 1) & indexed
        for keep, is_hot in ((some & ~hot, False), (hot, True)):
            rows = np.repeat(keep, sizes)
            if rows.any():
                yield out(keys[rows], marks[rows], is_hot)

    return run


def _verify(rule: LineDedup):
    """(key, id, line) sorted by key -> edges (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, lines = None, [], []

        def links() -> list[tuple[int, int]]:
            return [(ids[i], ids[j]) for i, j in forest(lines, rule)]

        for batch in batches:
            found: list[tuple[int, int]] = []
            for k, line_id, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k != key:
                    found += links()
                    key, ids, lines = k, [], []
                ids.append(line_id)
                lines.append(line)
            if found:
                yield _edges(found)
        if ids and (found := links()):
            yield _edges(found)

    return run


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def line_id(line: Column) -> Column:
    """62 bits of a hash: equal lines have one id, with room for a mark."""
    return F.shiftrightunsigned(F.xxhash64(line), 2)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, content, line_no, id, line) of lines that hold a word; content is a hash of the document's text."""
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("content"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return split.filter(F.col("line").rlike(WORD)).select("doc_id", "content", F.col("line_no").cast("bigint").alias("line_no"), line_id(F.col("line")).alias("id"), "line")


def _texts(lines: DataFrame, ids: DataFrame, sent: int) -> DataFrame:
    """(id, line) of the wanted ids. Few ids are sent to the scan; many meet the lines after these were made one per id."""
    wanted = cut(ids.select("id").distinct())
    if wanted.count() <= sent:
        return lines.join(F.broadcast(wanted), "id", "left_semi").groupBy("id").agg(F.min("line").alias("line"))
    return lines.groupBy("id").agg(F.min("line").alias("line")).join(wanted, "id", "left_semi")


_ROWS = "key bigint, mark bigint"
_SHARED = "key bigint, id bigint, hot boolean"


def links(lines: DataFrame, rule: LineDedup = LineDedup()) -> DataFrame:
    """(a, b): ids of different lines within the allowed edits, each verified, whose closure is that of all such pairs."""
    joined = lines.select("id", "line").filter(F.length("line") >= rule.short_chars)
    dealt = lambda rows: rows.repartition("key").sortWithinPartitions("key")
    keyed = dealt(joined.transform(arrow_map, _key_rows(rule), _ROWS))
    shared = cut(keyed.transform(arrow_map, _shared_rows(rule.group_rows), _SHARED))
    groups, hot = shared.filter("not hot").select("key", "id"), shared.filter("hot").select("key", "id").distinct()
    if not hot.isEmpty():
        finer = hot.join(_texts(joined, hot, rule.sent_ids), "id").select("key", "id", "line").transform(arrow_map, _finer_rows(rule), _ROWS)
        # Rows of a key over the limit come as they are read, so a line may come more than once.
        again = cut(dealt(finer).transform(arrow_map, _shared_rows(rule.group_rows), _SHARED))
        large = cut(again.filter("hot").select("key", "id").distinct())
        groups = cut(groups.unionByName(again.filter("not hot").select("key", "id")).unionByName(in_blocks(large, "key", "id", rule.group_rows)))
    with_text = groups.join(_texts(joined, groups, rule.sent_ids), "id").select("key", "id", "line")
    return cut(dealt(with_text).transform(arrow_map, _verify(rule), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, rule: LineDedup = LineDedup()) -> DataFrame:
    """(doc_id, content, line_no, n_chars, class_doc_id, class_line_no, kept): one row per line that holds a word.

    Lines are one class if equal, or linked by chains of lines within the allowed edits of each other. A class is named by its
    first line in the order of doc_id (null last), the text's hash and the line's number; that line is kept, the others are
    not. Lines without a word are no rows and stay in their texts, as do all lines of null texts. Rows equal in doc_id and
    text are one document. Extra columns are ignored; an empty table gives an empty one. Lines count as equal if 62 bits
    of their hashes are.
    """
    lines = lines_of(docs)
    places = cut(lines.select("doc_id", "content", "line_no", "id", F.length("line").cast("bigint").alias("n_chars")))
    stars = components(links(lines, rule), "a", "b")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "content", "line_no")
    firsts = cut(places.groupBy("id").agg(F.min(place).alias("first")))
    rooted = cut(firsts.join(stars, F.col("id") == F.col("node"), "left").select("id", "first", F.coalesce("root", "id").alias("root")))
    tops = cut(rooted.groupBy("root").agg(F.min("first").alias("top")))
    classes = cut(rooted.join(tops, "root").select("id", "top"))
    kept = place.eqNullSafe(F.col("top"))
    return places.join(classes, "id").select(
        "doc_id", "content", "line_no", "n_chars", F.col("top.doc_id").alias("class_doc_id"), F.col("top.line_no").alias("class_line_no"), kept.alias("kept")
    )


def deduplicate(docs: DataFrame, rule: LineDedup = LineDedup()) -> DataFrame:
    """``docs`` with the first line of each class only; other columns as they are. A text may become empty, never null."""
    dropped = near_duplicates(docs, rule).filter("not kept").groupBy("doc_id", "content").agg(F.collect_set("line_no").alias("gone"))
    gone = cut(dropped.select(F.col("doc_id").alias("__id"), F.col("content").alias("__of"), F.col("gone").alias("__gone")))
    on = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__of"))
    kept = F.expr("array_join(filter(split(text, '\n'), (line, i) -> not array_contains(__gone, cast(i as bigint))), '\n')")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    joined = docs.join(gone, on, "left")
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def report(docs: DataFrame, rule: LineDedup = LineDedup()) -> DataFrame:
    """The result without the texts' hashes."""
    return near_duplicates(docs, rule).drop("content")

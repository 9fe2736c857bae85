"""Benchmark decontamination with suffix arrays of the training documents.

Each task cuts its documents into shards of bounded text and builds a suffix array over a shard's words. Every suffix of
every benchmark item is then looked up by binary search: the interval of suffixes that begin with its window gives all
places. Words become numbers of the benchmark's vocabulary by a 64-bit hash; a place counts only after its bytes were compared.
Only suffixes that start with as many benchmark words as the shortest window has are sorted, by a window's words.

From each place the longest verbatim match is found by one more binary search, among the block's own distinct suffixes, where
common beginnings are measured by prefix hashes and then compared word by word. So a document gives one match per place and one
set of items, never its places times the items that share them; windows with the same items share one list of these.

The benchmark is a stated query set: distinct items, of which those over a quarter of ``block_bytes`` are cut between windows,
are put into blocks by a running sum of bytes. So a block holds at most ``block_bytes`` (more only where a single window
does), is one broadcast and one pass; after every few passes the documents are written and read again and the blocks
before are given up, so a task never holds more than those few. Documents are neither shuffled nor grouped.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.common import arrow_map, cut, fresh_dir, remove, shielded

# Fixed value: a word of lower-cased UTF-8.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IS_WORD = np.array([bool(_WORD.match(bytes([i]))) for i in range(256)])
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_PIECE = 1 << 20
_PASSES_AT_ONCE = 4

_PLACES = ("start", "length", "item_id", "item_start")
# With a hash of the item's text, which tells what pieces belong together, until the last pass.
_MATCHES = pa.list_(pa.struct([(name, pa.int64()) for name in (*_PLACES, "of")]))
MATCHES_TYPE = T.ArrayType(T.StructType([T.StructField(f.name, T.LongType()) for f in _MATCHES.value_type]))
_MADE = ("n_words", "matches", "item_ids")


@dataclass(frozen=True)
class Decontamination:
    """Words of a window, bytes of text per suffix array, most bytes of benchmark text per pass."""

    window: int = 10
    shard_bytes: int = 1 << 20
    block_bytes: int = 4 << 20


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hasher:
    """64-bit hashes of the words of lower-cased bytes, in order."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def grow(self, size: int) -> None:
        """Powers for so many places at least."""
        if size >= len(self.up):
            size = max(_PIECE, size) + 1
            self.up, self.down = _powers(_P, size), _powers(_P_INVERSE, size)

    def piece(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start of each word, hash of each word)."""
        a = np.frombuffer(raw, dtype=np.uint8)
        self.grow(len(a))
        inside = np.r_[False, _IS_WORD[a], False]
        change = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = change[::2], change[1::2]
        sums = np.r_[np.uint64(0), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * self.up[: len(a)])]
        return starts, (sums[ends] - sums[starts]) * self.down[starts]

    def hashes(self, raw: bytes) -> np.ndarray:
        """Of one text, in pieces that end between words."""
        out, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + _PIECE)
            while end < len(raw) and _IS_WORD[raw[end]]:
                end += 1
            out.append(self.piece(raw[at:end])[1])
            at = end
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the counted things its owner and its place among the owner's."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _runs(numbers: np.ndarray) -> np.ndarray:
    """Words from each place to the next 0. The last number is 0."""
    n = len(numbers)
    zero = np.where(numbers == 0, np.arange(n), n)
    return np.minimum.accumulate(zero[::-1])[::-1] - np.arange(n)


def _ranks(numbers: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Rank of the words from each place to the next 0, by doubling; equal ones have equal ranks."""
    n, rank, step = len(numbers), numbers.astype(np.int64), 1
    while step < run.max(initial=0):
        ahead = np.where(run > step, rank[np.minimum(np.arange(n) + step, n - 1)] + 1, 0)
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].reshape(-1)
        step *= 2
    return rank


class Prefixes:
    """Hashes of any words in a row, from sums over the words before each place."""

    def __init__(self, numbers: np.ndarray, hasher: _Hasher):
        hasher.grow(len(numbers))
        mixed = numbers.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        self.sums = np.r_[np.uint64(0), np.cumsum(mixed * hasher.up[: len(numbers)])]

    def of(self, places: np.ndarray, sizes: np.ndarray, hasher: _Hasher) -> np.ndarray:
        return (self.sums[places + sizes] - self.sums[places]) * hasher.down[places]


class Block:
    """One block of the benchmark, ready for searching: (item_id, hash of the whole text, first word, text) of items or their pieces."""

    def __init__(self, items: list[tuple[int | None, int, int, str | None]], window: int):
        hasher = _Hasher()
        self.window = window
        self.ids, self.wholes, self.firsts, texts = [], [], [], []
        for item, of, first, text in items:
            found = words((text or "").encode())
            if found:
                self.ids.append(item)
                self.wholes.append(of)
                self.firsts.append(first)
                texts.append(found)
        self.vocabulary = sorted({w for t in texts for w in t})
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        hashes = hasher.piece(b" ".join(self.vocabulary))[1] if number else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], (order + 1).astype(np.int32)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.r_[0, np.cumsum(lengths + 1)].astype(np.int64)
        self.words = np.array([n for t in texts for n in (*(number[w] for w in t), 0)] + [0], dtype=np.int32)
        self.run = _runs(self.words)
        # Every suffix that begins with a whole window, as (item, place); equal windows are looked up once.
        whole = np.minimum(lengths, window)
        item, start = _spread(lengths - whole + 1)
        size = whole[item]
        at = self.offsets[item] + start
        ahead = np.minimum(at[:, None] + np.arange(window), len(self.words) - 1)
        spelled = np.where(np.arange(window) < size[:, None], self.words[ahead], 0).reshape(-1, window)
        self.windows, which = np.unique(spelled, axis=0, return_inverse=True)
        which = which.reshape(-1)
        self.sizes = (self.windows > 0).sum(axis=1).astype(np.int64)
        self._list_items(which, item)
        # A place of each window, and of each distinct suffix of at least a window in the order of the suffixes.
        self.place = np.zeros(len(self.windows), dtype=np.int64)
        self.place[which[::-1]] = at[::-1]
        long = at[size == window]
        self.suffixes = long[np.unique(_ranks(self.words, self.run)[long], return_index=True)[1]]
        self.prefixes = Prefixes(self.words, hasher)

    def _list_items(self, which: np.ndarray, item: np.ndarray) -> None:
        """The items of each window; windows with the same items share a list."""
        pairs = np.unique(np.stack([which, item], axis=1), axis=0)
        edge = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        lists: dict[bytes, int] = {}
        self.list_of = np.zeros(len(self.windows), dtype=np.int64)
        for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
            self.list_of[i] = lists.setdefault(pairs[a:b, 1].astype(np.int32).tobytes(), len(lists))
        self.lists = [np.frombuffer(x, dtype=np.int32) for x in lists]

    def item_ids(self, windows: np.ndarray) -> list[int]:
        """Distinct ids of the items that hold any of some windows."""
        held = np.zeros(len(self.ids), dtype=bool)
        for i in np.unique(self.list_of[windows]).tolist():
            held[self.lists[i]] = True
        return sorted({self.ids[i] for i in np.flatnonzero(held).tolist()} - {None})

    def location(self, place: int) -> dict[str, int | None]:
        """Item, its word and its text's hash at a place."""
        item = int(np.searchsorted(self.offsets, place, side="right")) - 1
        return {"item_id": self.ids[item], "item_start": self.firsts[item] + place - int(self.offsets[item]), "of": self.wholes[item]}

    def spelled(self, window: int) -> list[bytes]:
        return [self.vocabulary[n - 1] for n in self.windows[window, : self.sizes[window]]]

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of hashed words; 0 for words that no item has."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], 0).astype(np.int32)


class SuffixArray:
    """Over word numbers where 0 ends a suffix. Suffixes are ordered by their first ``depth`` words."""

    def __init__(self, numbers: np.ndarray, shortest: int, depth: int):
        self.numbers = np.concatenate([numbers, [0]]).astype(np.int32)
        self.run = _runs(self.numbers)
        suffixes = np.flatnonzero(self.run >= max(1, shortest))
        bits = max(1, int(self.numbers.max(initial=0)).bit_length())
        step = 62 // bits
        rank, at = np.zeros(len(suffixes), dtype=np.int64), 0
        while at < depth and len(suffixes):
            packed = self._packed(suffixes, at, step, bits)
            order = np.lexsort((packed, rank))
            new = (np.diff(rank[order]) != 0) | (np.diff(packed[order]) != 0)
            rank[order] = np.concatenate([[0], np.cumsum(new)])
            at += step
            if new.all():
                break
        self.suffixes = suffixes[np.argsort(rank, kind="stable")]

    def at(self, places: np.ndarray, ahead: int) -> np.ndarray:
        """The word numbers ``ahead`` of places, 0 behind the end of their suffix."""
        return np.where(ahead < self.run[places], self.numbers[np.minimum(places + ahead, len(self.numbers) - 1)], 0)

    def _packed(self, places: np.ndarray, ahead: int, step: int, bits: int) -> np.ndarray:
        out = np.zeros(len(places), dtype=np.int64)
        for j in range(ahead, ahead + step):
            out = (out << bits) | self.at(places, j)
        return out

    def intervals(self, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the range of suffixes that begin with it, by binary search for all at once."""
        return self._bound(windows, sizes, False), self._bound(windows, sizes, True)

    def _bound(self, windows: np.ndarray, sizes: np.ndarray, after: bool) -> np.ndarray:
        low, high = np.zeros(len(windows), dtype=np.int64), np.full(len(windows), len(self.suffixes), dtype=np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            places = self.suffixes[middle]
            sign = np.zeros(len(open_), dtype=np.int64)  # of suffix against window, over the window's words
            for j in range(windows.shape[1]):
                undecided = (sign == 0) & (j < sizes[open_])
                if not undecided.any():
                    break
                sign = np.where(undecided, np.sign(self.at(places, j).astype(np.int64) - windows[open_, j]), sign)
            right = sign <= 0 if after else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low


def _common(array: SuffixArray, own: Prefixes, places: np.ndarray, block: Block, theirs: np.ndarray, hasher: _Hasher) -> np.ndarray:
    """Number of words that documents' places and the block's places have in common, by halving."""
    low, high = np.zeros(len(places), dtype=np.int64), np.minimum(array.run[places], block.run[theirs])
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = own.of(places, middle, hasher) == block.prefixes.of(theirs, middle, hasher)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _longest(array: SuffixArray, places: np.ndarray, block: Block, hasher: _Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(length, place in the block) of the longest match from each place at which a window begins: the suffixes next to it in
    the block's order have the longest common beginning with it."""
    own = Prefixes(array.numbers, hasher)
    hasher.grow(len(block.words))
    low, high = np.zeros(len(places), dtype=np.int64), np.full(len(places), len(block.suffixes), dtype=np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        mine, theirs = places[open_], block.suffixes[middle]
        size = _common(array, own, mine, block, theirs, hasher)
        theirs_next = np.where(size < block.run[theirs], block.words[np.minimum(theirs + size, len(block.words) - 1)], 0)
        mine_next = np.where(size < array.run[mine], array.numbers[np.minimum(mine + size, len(array.numbers) - 1)], 0)
        right = theirs_next < mine_next
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
    after, before = (block.suffixes[np.clip(low + d, 0, len(block.suffixes) - 1)] for d in (0, -1))
    sizes = [_common(array, own, places, block, x, hasher) for x in (after, before)]
    better = sizes[1] > sizes[0]
    return np.where(better, sizes[1], sizes[0]), np.where(better, before, after)


def search(texts: list[bytes], block: Block, hasher: _Hasher) -> tuple[list[int], dict[int, tuple[list[dict], list[int]]]]:
    """Number of words of each text; of each text that has some, the longest matches and the ids of all items."""
    hashed = _hash_all(texts, hasher) if len(texts) > 1 else [hasher.hashes(texts[0].lower())]
    counts = [len(h) for h in hashed]
    if not len(block.windows):
        return counts, {}
    numbers = np.concatenate([np.concatenate([block.numbered(h), np.zeros(1, dtype=np.int32)]) for h in hashed])
    begins = np.cumsum([0] + [c + 1 for c in counts])
    array = SuffixArray(numbers, int(block.sizes.min()), block.window)
    low, high = array.intervals(block.windows, block.sizes)
    which, nth = _spread(high - low)
    if not len(which):
        return counts, {}
    place = array.suffixes[low[which] + nth]
    doc = np.searchsorted(begins, place, side="right") - 1
    # The hash was exact only if the bytes agree.
    spelled: dict[int, list[bytes]] = {}
    windows: dict[int, list[bytes]] = {}
    true = np.ones(len(which), dtype=bool)
    for i, (d, p, w) in enumerate(zip(doc.tolist(), place.tolist(), which.tolist())):
        if d not in spelled:
            spelled[d] = words(texts[d])
        if w not in windows:
            windows[w] = block.spelled(w)
        p -= int(begins[d])
        true[i] = spelled[d][p : p + len(windows[w])] == windows[w]
    which, place = which[true], place[true]
    if not len(which):
        return counts, {}
    # One match per place: of its windows the longest, carried on as far as an item goes on alike.
    order = np.lexsort((-block.sizes[which], place))
    which, place = which[order], place[order]
    top = np.r_[True, place[1:] != place[:-1]]
    best, start = which[top], place[top]
    length, theirs = block.sizes[best].copy(), block.place[best]
    long = np.flatnonzero(length == block.window)
    if len(long):
        length[long], theirs[long] = _longest(array, start[long], block, hasher)
    # Matches inside one that began before are no matches of their own; a text's match ends before the next text.
    end = start + length
    own = np.r_[True, end[1:] > np.maximum.accumulate(end)[:-1]]
    found: dict[int, tuple[list[dict], list[int]]] = {}
    doc = np.searchsorted(begins, place, side="right") - 1
    edge = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        found[int(doc[a])] = [], block.item_ids(which[a:b])
    for p, n, q in zip(start[own].tolist(), length[own].tolist(), theirs[own].tolist()):
        # Hashes measured it; what differs after all is cut off, but never from the window, whose bytes were compared.
        differs = np.flatnonzero(array.numbers[p : p + n] != block.words[q : q + n])
        d = int(np.searchsorted(begins, p, side="right")) - 1
        found[d][0].append({"start": p - int(begins[d]), "length": int(differs[0]) if len(differs) else n, **block.location(q)})
    return counts, found


def merged(matches: list[dict]) -> list[dict]:
    """Matches of several blocks: parts of one item that carry on from piece to piece are one, and none lies inside another."""
    joined: dict[tuple, dict] = {}
    out: list[dict] = []
    for m in sorted(matches, key=lambda m: (m["start"], -m["length"], m["item_id"] is None, m["item_id"] or 0, m["of"], m["item_start"])):
        line = m["item_id"], m["of"], m["start"] - m["item_start"]
        last = joined.get(line)
        if last is not None and m["start"] < last["start"] + last["length"]:
            last["length"] = max(last["length"], m["start"] + m["length"] - last["start"])
        else:
            joined[line] = m = dict(m)
            out.append(m)
    out.sort(key=lambda m: (m["start"], -m["length"]))
    kept, end = [], -1
    for m in out:
        if m["start"] + m["length"] > end:
            kept.append(m)
            end = m["start"] + m["length"]
    return kept


def _hash_all(texts: list[bytes], hasher: _Hasher) -> list[np.ndarray]:
    """Short texts at once; a zero byte between them ends a word."""
    starts, hashes = hasher.piece(b"\x00".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.split(hashes, np.searchsorted(starts, ends[:-1]))


def _pass(block, names: list[str], text_at: int, rule: Decontamination, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(text_at).to_pylist()]
            counts: list[int] = []
            matches: list[list[dict]] = [[] for _ in texts] if first else batch.column(len(names) + 1).to_pylist()
            items: list[list[int]] = [[] for _ in texts] if first else batch.column(len(names) + 2).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= rule.shard_bytes):
                    size += len(texts[end])
                    end += 1
                some, found = search(texts[at:end], block.value, hasher)
                counts += some
                for d, (rows, ids) in found.items():
                    matches[at + d] = merged(matches[at + d] + rows)
                    items[at + d] = sorted({*items[at + d], *ids})
                at = end
            made = [pa.array(counts, pa.int64()), pa.array(matches, _MATCHES), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], [*names, *_MADE])

    return run


def cut_item(text: bytes, window: int, most: int) -> Iterator[tuple[int, bytes]]:
    """(first word, piece) of an item: pieces of about ``most`` bytes at most, each window in exactly one of them. A piece
    holds one window at least, or the whole of an item with fewer words."""
    held: list[bytes] = []
    first = size = 0
    for match in _WORD.finditer(text.lower()):
        word = match.group()
        if size + len(word) > most and len(held) >= window:
            yield first, b" ".join(held)
            left = held[len(held) - window + 1 :]
            first, held, size = first + len(held) - len(left), left, sum(len(x) + 1 for x in left)
        held.append(word)
        size += len(word) + 1
    if held:
        yield first, b" ".join(held)


def _piece_rows(rule: Decontamination):
    most = rule.block_bytes // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text, of in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [(n, piece.decode()) for n, piece in cut_item(text.encode(), rule.window, most)]
                if rows:
                    firsts, pieces = zip(*rows)
                    made = [pa.array([x] * len(rows), pa.int64()) for x in (item, of)]
                    yield pa.RecordBatch.from_arrays([*made, pa.array(firsts, pa.int64()), pa.array(pieces, pa.string())], ["item_id", "of", "first", "text"])

    return run


def blocks(benchmark: DataFrame, rule: Decontamination) -> DataFrame:
    """(item_id, of, first, text, cell, block): the distinct items with words, long ones cut. Rows of one cell and block have at
    most ``block_bytes`` together, unless one window has more."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null").distinct().withColumn("of", F.xxhash64("text"))
    size = F.octet_length("text") + 1
    pieces = cut(items.transform(arrow_map, _piece_rows(rule), "item_id bigint, of bigint, first bigint, text string"))
    # Sums run inside cells of some blocks each, so that no task sums the whole benchmark.
    cells = -(-(pieces.agg(F.sum(size)).first()[0] or 0) // (16 * rule.block_bytes)) or 1
    upto = Window.partitionBy("cell").orderBy("item_id", "of", "first", "text").rowsBetween(Window.unboundedPreceding, 0)
    room = max(1, rule.block_bytes - rule.block_bytes // 4 - 1)
    celled = pieces.withColumn("cell", F.pmod(F.xxhash64("item_id", "first", "text"), F.lit(cells)))
    return cut(celled.withColumn("block", F.floor((F.sum(size).over(upto) - 1) / room)))


def with_matches(docs: DataFrame, benchmark: DataFrame, rule: Decontamination = Decontamination()) -> DataFrame:
    """``docs`` with ``n_words``, ``matches`` (the longest verbatim matches: word place, length, an item, its place) and
    ``item_ids`` (all items with a window that occurs, ascending).

    A match holds at least a window: ``window`` words, or a shorter item's whole text. It is the longest one from its place
    and lies inside no other; of several items that are equally alike it names one. Where such a match crosses pieces of an
    item of over a quarter of ``block_bytes``, it may stay as two that overlap, if another item is as long in one of them.
    Null, empty or wordless texts and items match nothing. An item without an id matches under a null id, which is not in
    ``item_ids``; repeated items count once and repeated rows of ``docs`` are treated alike. Columns of ``docs`` with the three
    names are replaced. Without items nothing matches, and an empty table gives no rows. A text of any length is
    searched whole by one task; an item of any length is searched for whole, in pieces.
    """
    spark = docs.sparkSession
    dealt = blocks(benchmark, rule)
    places = [(r["cell"], r["block"]) for r in dealt.select("cell", "block").distinct().orderBy("cell", "block").collect()]
    narrow = docs.drop(*_MADE)
    names, path, sent = narrow.columns, None, []
    for i, (cell, number) in enumerate(places or [(0, 0)]):
        own = dealt.filter((F.col("cell") == cell) & (F.col("block") == number)).orderBy("item_id", "of", "first", "text")
        block = spark.sparkContext.broadcast(Block([(r["item_id"], r["of"], r["first"], r["text"]) for r in own.collect()], rule.window))
        sent.append(block)
        schema = narrow.select(names).schema.add("n_words", T.LongType()).add("matches", MATCHES_TYPE).add("item_ids", T.ArrayType(T.LongType()))
        narrow = narrow.transform(arrow_map, _pass(block, names, names.index("text"), rule, i == 0), schema)
        if len(sent) == _PASSES_AT_ONCE and i + 1 < len(places):
            before, path = path, fresh_dir(spark, "matches")
            narrow.write.parquet(path)
            narrow = spark.read.parquet(path)
            if before:
                remove(spark, before)
            for done in sent:
                done.destroy()
            sent = []
    return narrow.withColumn("matches", F.transform("matches", lambda m: F.struct(*[m[x].alias(x) for x in _PLACES])))


def covered(matches) -> F.Column:
    """Number of words inside any match."""
    state = lambda end, n: F.struct(end.alias("end"), n.alias("n"))
    return F.aggregate(
        F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b")))),
        state(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")),
        lambda s, m: state(F.greatest(s["end"], m["b"]), s["n"] + F.greatest(F.lit(0).cast("bigint"), m["b"] - F.greatest(s["end"], m["a"]))),
        lambda s: s["n"],
    )


def clean(docs: DataFrame, benchmark: DataFrame, rule: Decontamination = Decontamination()) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark."""
    return shielded(docs, ("text",), lambda rows: with_matches(rows, benchmark, rule).filter(F.size("matches") == 0))


def report(docs: DataFrame, benchmark: DataFrame, rule: Decontamination = Decontamination()) -> DataFrame:
    """The digest: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. An item without an id is not listed."""
    found = with_matches(docs.select("doc_id", "text"), benchmark, rule)
    listed = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    hit = covered(F.col("matches"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_SQL_WORDS = (
    "coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)

ORACLE = f"""
WITH docs AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[j:j + n - 1], ' ') AS words
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j FROM items WHERE len(w) > 0)
),
places AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS j,
        unnest(list_transform(range(1, len(w) - n + 2), lambda j: array_to_string(w[j:j + n - 1], ' '))) AS words
    FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
),
found AS (SELECT p.doc_id, p.j, p.n, i.item_id FROM places p JOIN windows i ON i.n = p.n AND i.words = p.words),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS place FROM found) GROUP BY doc_id),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN listed l ON l.doc_id = d.doc_id
"""

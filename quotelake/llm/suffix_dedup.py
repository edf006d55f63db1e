"""Repeated byte strings of ``LENGTH``: anchors, then a hash-compared suffix sort.

Every window of ``LENGTH`` bytes is owned by one place in it, its *anchor*: where its
gram of ``GRAM`` bytes with the smallest hash starts. Equal windows have equal
anchors, so two steps find all repeats without a row per window:

1. Anchors whose gram occurs once in the corpus are out. The windows that the others
   own in a row make a *stretch*. Stretches with equal bytes around are repeats as a
   whole, but for the first; they are summed up before they are shuffled.
2. Where one gram has stretches that differ, windows may still be equal in part. The
   different stretches of a gram meet in one block. Their suffixes from the anchor are
   put in order by a merge sort whose comparison is a binary search for the common
   extension over prefix hashes; windows with enough in common to the right and the
   same bytes to the left are one class. Bytes confirm what hashes say. A gram with
   more than ``BLOCK`` different stretches is dealt over several blocks, whose first
   windows then meet by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quotelake.llm.common import or_empty, removed, written
from quotelake.llm.tokens import in_pieces

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM  # places an anchor can have in its window, less one

#: Windows worked on at once, and different stretches of a gram in one block.
CHUNK = 1 << 20
BLOCK = 4096

#: Characters of a text that place it among rows of one doc_id; see ``numbered``.
PREFIX = 256

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.uint64((1 << 24) - 1)
_BYTES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hasher:
    """Prefix polynomial hashes of one buffer, modulo 2**64."""

    powers = _powers(_BASE, CHUNK + 4 * LENGTH)
    inverse = _powers(_INVERSE, CHUNK + 4 * LENGTH)

    def __init__(self, data: np.ndarray):
        own = _BYTES[data] * self.powers[: len(data)]
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(own, dtype=np.uint64)])

    def grams(self, length: int) -> np.ndarray:
        n = len(self.prefix) - length
        return (self.prefix[length:] - self.prefix[:n]) * self.inverse[:n]


def owners(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in order with their gram hashes, first and last window of each.

    An anchor of a long text may come up in two chunks; its windows are then two
    stretches cut at the same bytes as the chunks, so chunks are cut at anchors.
    """
    found, start, last = [], 0, len(data) - LENGTH
    while start <= last:
        part = data[start : start + CHUNK + LENGTH]
        grams = _mixed(Hasher(part).grams(GRAM))
        packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        least, width = packed, 1
        while width < SPAN + 1:
            step = min(width, SPAN + 1 - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        anchors = (least & _PLACE).astype(np.int64)
        edges = np.flatnonzero(np.diff(anchors)) + 1
        first = np.concatenate([[0], edges])
        ends = np.concatenate([edges, [len(anchors)]]) - 1
        more = start + len(anchors) <= last
        if more and len(first) > 1:
            first, ends = first[:-1], ends[:-1]
        own = anchors[first]
        found.append((own + start, grams[own], first + start, ends + start))
        start += int(ends[-1]) + 1
    if not found:
        return tuple(np.zeros(0, k) for k in (np.int64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes(text) -> np.ndarray:
    return np.frombuffer(text.as_py() or b"", np.uint8)


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("text").cast(pa.large_binary())


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, docs, places = [], [], []
        for doc, text in zip(batch.column("doc").to_pylist(), _texts(batch)):
            own, hashes, _, _ = owners(_bytes(text))
            grams.append(hashes.view(np.int64))
            docs.append(np.full(len(own), doc, np.int64))
            places.append(own)
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (grams, docs, places)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in joined], names=["gram", "doc", "place"])


def _digest(*parts: bytes) -> bytes:
    found = hashlib.blake2b(digest_size=16)
    for part in parts:
        found.update(part)
    return found.digest()


_STRETCH = pa.schema(
    [("gram", pa.int64()), ("content", pa.binary()), ("doc", pa.int64()), ("place", pa.int64()),
     ("first", pa.int64()), ("last", pa.int64())]
)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of the anchors in ``places``; ``content`` is a digest of their windows' bytes."""
    for batch in in_pieces(batches):
        rows: list[list] = [[] for _ in _STRETCH]
        for doc, text, places in zip(
            batch.column("doc").to_pylist(), _texts(batch), batch.column("places")
        ):
            data, wanted = text.as_py() or b"", np.array(places.as_py(), np.int64)
            own, hashes, first, last = owners(np.frombuffer(data, np.uint8))
            keep = np.flatnonzero(np.isin(own, wanted))
            signed = hashes.view(np.int64)
            for i in keep.tolist():
                a, b = int(first[i]), int(last[i])
                offset = (int(own[i]) - a).to_bytes(4, "little")
                content = _digest(offset, data[a : b + LENGTH])
                values = (int(signed[i]), content, doc, int(own[i]), a, b)
                for column, value in zip(rows, values):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(rows, _STRETCH)], schema=_STRETCH
        )


_CONTEXT = pa.schema(
    [("gram", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("first", pa.int64()),
     ("last", pa.int64()), ("part", pa.int64()), ("split", pa.bool_()), ("bytes", pa.binary())]
)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches listed in ``leads``, a row each, with the bytes of their windows."""
    for batch in in_pieces(batches):
        rows = []
        docs = batch.column("doc").to_pylist()
        for doc, text, leads in zip(docs, _texts(batch), batch.column("leads")):
            data = text.as_py() or b""
            for x in leads.as_py():
                around = data[x["first"] : x["last"] + LENGTH]
                rows.append((x["gram"], doc, x["place"], x["first"], x["last"], x["part"], x["split"], around))
        columns = list(zip(*rows)) if rows else [[]] * len(_CONTEXT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _CONTEXT)], schema=_CONTEXT
        )


class SuffixOrder:
    """Suffixes from their anchors, in order by a hash-compared merge sort.

    ``rows`` has a suffix per row, padded; ``sizes`` their lengths. ``order`` is the
    sorted order and ``common`` the bytes that each has in common with the one before.
    """

    def __init__(self, rows: np.ndarray, sizes: np.ndarray):
        self.rows, self.sizes, n = rows, sizes, len(rows)
        powers = Hasher.powers[: rows.shape[1]]
        sums = np.cumsum(_BYTES[rows] * powers, axis=1, dtype=np.uint64)
        self.prefix = np.concatenate([np.zeros((n, 1), np.uint64), sums], axis=1)
        self.order = self._sorted(np.arange(n))
        before, after = self.order[:-1], self.order[1:]
        self.common = np.concatenate([[0], self._confirmed(before, after)]) if n else np.zeros(0, int)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bytes that suffixes have in common: binary search for the longest equal prefix."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.sizes[i], self.sizes[j])
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.prefix[i, mid] == self.prefix[j, mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def _confirmed(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Extensions whose bytes are equal; a collision of hashes shortens them."""
        found = np.zeros(len(i), np.int64)
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            differ = self.rows[a] != self.rows[b]
            real = np.where(differ.any(1), differ.argmax(1), self.rows.shape[1])
            found[at : at + (1 << 14)] = np.minimum(self.extension(a, b), real)
        return found

    def _less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix ``i`` comes before ``j``; equal ones keep their numbers' order."""
        n = self.extension(i, j)
        ended_i, ended_j = n >= self.sizes[i], n >= self.sizes[j]
        at = np.minimum(n, self.rows.shape[1] - 1)
        smaller = np.where(ended_i, True, self.rows[i, at] < self.rows[j, at])
        return np.where(ended_i & ended_j, i < j, np.where(ended_j & ~ended_i, False, smaller))

    def _sorted(self, order: np.ndarray) -> np.ndarray:
        """Bottom-up merges; all pairs of neighbouring runs of a width at once."""
        n, width = len(order), 1
        place = np.arange(n)
        while width < n:
            left = (place // width) % 2 == 0
            other = np.where(left, place // width + 1, place // width - 1) * width
            low = np.minimum(other, n)
            high = np.minimum(other + width, n)
            start = low.copy()
            # A place in the other run for each: how many there come before it.
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) // 2
                before = self._less(order[mid], order[open_])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            base = (place // (2 * width)) * 2 * width
            target = base + place % width + (low - start)
            merged = np.empty_like(order)
            merged[target] = order
            order, width = merged, 2 * width
        return order


def repeated_windows(
    contexts: list[bytes], offsets: np.ndarray, counts: np.ndarray, ranks: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of stretches repeat one of smaller rank, and which are a class's first.

    A stretch is its bytes, the anchor's offset in them and its number of windows.
    Both results have a row per stretch and a column per offset of the anchor in a
    window, and hold for windows that the stretch has.
    """
    n = len(contexts)
    left = np.zeros((n, SPAN), np.uint8)
    right, sizes = np.zeros((n, LENGTH), np.uint8), np.zeros(n, np.int64)
    for i, (data, offset) in enumerate(zip(contexts, offsets.tolist())):
        own = np.frombuffer(data, np.uint8)
        if offset:
            left[i, SPAN - offset :] = own[:offset]
        rest = own[offset : offset + LENGTH]
        right[i, : len(rest)], sizes[i] = rest, len(rest)
    suffixes = SuffixOrder(right, sizes)
    order, common = suffixes.order, suffixes.common
    low = (offsets - counts + 1)[order]
    high, rank = offsets[order], ranks[order]
    left = left[order]
    again, first = np.zeros((n, SPAN + 1), bool), np.zeros((n, SPAN + 1), bool)
    before = np.zeros(n, np.uint64)
    for offset in range(SPAN + 1):
        if offset:
            byte = left[:, SPAN - offset]
            before = before + _BYTES[byte] * Hasher.powers[offset]
        part = np.cumsum(common < LENGTH - offset)
        has = np.flatnonzero((low <= offset) & (offset <= high))
        if not len(has):
            continue
        ordered = has[np.lexsort((rank[has], before[has], part[has]))]
        same = (part[ordered[1:]] == part[ordered[:-1]]) & (before[ordered[1:]] == before[ordered[:-1]])
        if offset:
            at = np.flatnonzero(same)
            a, b = left[ordered[at], SPAN - offset :], left[ordered[at + 1], SPAN - offset :]
            same[at] = (a == b).all(1)
        same = np.concatenate([[False], same])
        again[order[ordered[same]], offset] = True
        first[order[ordered[~same]], offset] = True
    return again, first


_FOUND = pa.schema(
    [("doc", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("window", pa.binary())]
)


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Windows of a block that repeat others; those of split grams that lead a class."""
    _, docs, places, firsts, lasts, contexts, split = zip(*rows)
    places, firsts, lasts = (np.array(x, np.int64) for x in (places, firsts, lasts))
    by_place = np.lexsort((places, np.array(docs, np.int64)))
    ranks = np.empty(len(rows), np.int64)
    ranks[by_place] = np.arange(len(rows))
    again, leads = repeated_windows(list(contexts), places - firsts, lasts - firsts + 1, ranks)
    found: list[tuple] = []
    for i in np.flatnonzero(again.any(1)).tolist():
        starts = np.sort(places[i] - np.flatnonzero(again[i]))
        cuts = np.flatnonzero(np.diff(starts) > 1)
        begin, end = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(starts) - 1]])
        found += [(docs[i], int(starts[a]), int(starts[b]), None) for a, b in zip(begin, end)]
    for i in np.flatnonzero(np.array(split, bool)).tolist():
        for offset in np.flatnonzero(leads[i]).tolist():
            start = int(places[i]) - offset
            at = start - int(firsts[i])
            found.append((docs[i], start, start, _digest(contexts[i][at : at + LENGTH])))
    columns = list(zip(*found)) if found else [[]] * len(_FOUND)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their gram and part, worked on in whole (gram, part) blocks."""
    held: list[tuple] = []
    key = None
    for batch in batches:
        names = ("gram", "doc", "place", "first", "last", "bytes", "split")
        parts = batch.column("part").to_pylist()
        for part, row in zip(parts, zip(*(batch.column(n).to_pylist() for n in names))):
            if (row[0], part) != key and len(held) >= BLOCK:
                yield _block_rows(held)
                held = []
            key = (row[0], part)
            held.append(row)
    if held:
        yield _block_rows(held)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, first, last): ranges of window starts that repeat an earlier window.

    ``docs`` has doc and text. Ranges may overlap and come more than once.
    """
    anchors = docs.mapInArrow(_anchors, "gram bigint, doc bigint, place bigint")
    often = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    often = written(often, "grams")
    places = anchors.join(often, "gram").groupBy("doc").agg(F.collect_list("place").alias("places"))
    places = written(places, "places")
    removed(often)
    shape = "gram bigint, content binary, doc bigint, place bigint, first bigint, last bigint"
    stretches = docs.join(places, "doc").select("doc", "text", "places").mapInArrow(_stretches, shape)
    stretches = written(stretches, "stretches")
    removed(places)

    lead = F.min(F.struct("doc", "place", "first", "last")).alias("lead")
    leads = written(stretches.groupBy("gram", "content").agg(lead), "leads")
    whole = stretches.join(leads, ["gram", "content"])
    whole = whole.filter(F.struct("doc", "place") != F.struct("lead.doc", "lead.place"))
    whole = whole.select("doc", "first", "last")
    mixed = leads.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    mixed = written(mixed, "mixed")
    # Bytes are fetched for these alone: the first of each content of such a gram.
    own = leads.join(mixed, "gram").select("gram", "lead.*", F.ceil(F.col("n") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("doc", "place"), F.col("parts")).alias("part")
    context = F.struct("gram", "place", "first", "last", part, (F.col("parts") > 1).alias("split"))
    own = own.groupBy("doc").agg(F.collect_list(context).alias("leads"))
    shape = "gram bigint, doc bigint, place bigint, first bigint, last bigint, part bigint, split boolean, bytes binary"
    blocks = docs.join(own, "doc").select("doc", "text", "leads").mapInArrow(_contexts, shape)
    blocks = blocks.repartition("gram", "part").sortWithinPartitions("gram", "part", "doc", "place")
    found = blocks.mapInArrow(_blocks, "doc bigint, first bigint, last bigint, window binary")
    found = written(found, "found")
    open_ = found.filter("window is not null")
    earliest = open_.groupBy("window").agg(F.min(F.struct("doc", "first")).alias("lead"))
    earliest = written(earliest, "earliest")
    later = open_.join(earliest, "window")
    later = later.filter(F.struct("doc", "first") != F.col("lead")).select("doc", "first", "last")
    ranges = whole.union(found.filter("window is null").select("doc", "first", "last")).union(later)
    ranges = written(ranges, "ranges")
    for table in (stretches, leads, mixed, found, earliest):
        removed(table)
    return ranges


def _cut(text: bytes, ranges: list[dict]) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the spans they make."""
    step = np.zeros(len(text) + 1, np.int64)
    for r in ranges:
        if r["first"] + LENGTH <= len(text):
            step[r["first"]] += 1
            step[min(r["last"] + LENGTH, len(text))] -= 1
    gone = np.cumsum(step)[:-1] > 0
    spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1))
    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return left, int(gone.sum()), spans


def _cutting(kind: pa.DataType):
    shape = pa.schema(
        [("doc_id", kind), ("repeats", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
         ("n_spans", pa.int64()), ("kept", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            rows = []
            for text, ranges in zip(_texts(batch), batch.column("ranges")):
                data, found = text.as_py() or b"", ranges.as_py()
                left, removed, spans = _cut(data, found) if found else (data, 0, 0)
                rows.append((len(data), removed, spans, left))
            columns = list(zip(*rows)) if rows else [[]] * 4
            own = [batch.column("doc_id"), batch.column("repeats")]
            new = [pa.array(c, f.type) for c, f in zip(columns, list(shape)[2:])]
            yield pa.RecordBatch.from_arrays([*own, *new], names=shape.names)

    return cut


def numbered(docs: DataFrame) -> DataFrame:
    """doc, doc_id, repeats and text of every distinct (doc_id, text).

    ``doc`` is unique and follows the order of (doc_id, text), nulls first. Rows are
    dealt into ranges by the start of the text only, whose order is the text's, so no
    whole text is sampled.
    """
    texts = docs.select("doc_id", or_empty("text").alias("text"))
    folded = texts.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("repeats"))
    ordered = folded.repartitionByRange("doc_id", F.substring("text", 1, PREFIX))
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    ordered = ordered.withColumn("doc", F.monotonically_increasing_id())
    return written(ordered.select("doc", "doc_id", "repeats", "text"), "numbered")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept bytes of every whole text.

    Removed is each byte in a string of ``LENGTH`` bytes that also starts earlier: in
    a document before it, or before in the same one. Documents are in the order of
    doc_id, those without one first, and of their texts where doc_ids are equal. A
    null text is an empty one; texts under ``LENGTH`` lose nothing. Rows that repeat a
    doc_id (or its absence) with its text are one document, each with the same result;
    rows of one doc_id, or without one, and different texts are different documents.
    Other columns are left out; an empty table gives no rows.
    """
    field = docs.schema["doc_id"]
    rows = numbered(docs)
    ranges = repeated_ranges(rows.select("doc", "text"))
    # A document's ranges are as many as its anchors at most, once made distinct.
    ranges = ranges.distinct().groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    joined = rows.join(ranges, "doc", "left").select("doc_id", "repeats", "text", "ranges")
    shape = (
        f"doc_id {field.dataType.simpleString()}, repeats bigint, n_bytes bigint, n_removed bigint, "
        "n_spans bigint, kept binary"
    )
    cut = joined.mapInArrow(_cutting(to_arrow_type(field.dataType)), shape)
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", copies).drop("copy")

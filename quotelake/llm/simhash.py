"""SimHash near-duplicates: pigeonring candidates, exact links, components.

**Candidates.** The 64 bits are a ring of nine segments. If two fingerprints differ
in at most two places, then from some segment on every chain of consecutive
segments stays within its proportional budget, ``length * 2 / 9``: none for four
segments and one for eight. So the first four are equal, and of the next four
either the first two or the last two. Six equal segments, 42 bits or more, make a
key to group by; fingerprints that share no key with another are out.

**Links.** Candidates are never paired. Fingerprints that differ in at most two
places have a neighbour in common that is at most one place from either, so each
candidate is listed under itself and its 64 neighbours: the full Hamming check. A
neighbour has at most 65 fingerprints, whatever the data, so no group is large.

**Components.** The smallest id spreads over these lists, with pointer jumping,
until nothing changes. Only different fingerprints take part: a thousand copies
are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import unused_name, written

WIDTH = 64
SEED = 42

#: Fingerprints link at this many differing bits or fewer; see above.
BITS = 2
SEGMENTS = 9


def fingerprint(text: bytes, words: int) -> int:
    """Majority vote of the hashes of all shingles of one text."""
    found = text.lower().split()
    if not found:
        return 0
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[min(words, len(found)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, n)
    votes = np.zeros(WIDTH, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)], "<u8").view(np.uint8)
        votes += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(words: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = [fingerprint(t.as_py() or b"", words) for t in texts]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], names=["doc_id", "bits"]
            )

    return add


def simhash(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and the 64 fingerprint bits as a signed long, for every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    return texts.mapInArrow(_fingerprints(words), f"doc_id {kind}, bits bigint")


def _ring(start: int, length: int) -> tuple[int, int]:
    """First bit, from the highest, and number of bits of a chain of segments."""
    edge = lambda i: (i // SEGMENTS) * WIDTH + i % SEGMENTS * WIDTH // SEGMENTS
    return edge(start) % WIDTH, edge(start + length) - edge(start)


def _chain(bits: Column, start: int, length: int) -> Column:
    """The bits of a chain of segments that starts anywhere on the ring."""
    at, n = _ring(start, length)
    if at:
        bits = F.shiftleft(bits, at).bitwiseOR(F.shiftrightunsigned(bits, WIDTH - at))
    return F.shiftrightunsigned(bits, WIDTH - n)


def ring_keys(bits: Column) -> Column:
    """The keys of a fingerprint: two for each segment a chain can start at."""
    clean = next(n for n in range(SEGMENTS, 0, -1) if n * BITS // SEGMENTS == 0)
    single = next(n for n in range(SEGMENTS, 0, -1) if n * BITS // SEGMENTS == 1)
    half = (single - clean) // 2
    keys = []
    for i in range(SEGMENTS):
        for part in (0, 1):
            other = _chain(bits, i + clean + part * half, half)
            keys.append(F.struct(F.lit(2 * i + part).alias("at"), _chain(bits, i, clean).alias("chain"), other.alias("other")))
    return F.array(*keys)


def candidates(nodes: DataFrame) -> DataFrame:
    """Distinct ``bits`` that share a ring key with another fingerprint."""
    keyed = nodes.select("bits", F.explode(ring_keys(F.col("bits"))).alias("key"))
    # Summed up before the shuffle, so a key that many share is one row per task.
    shared = keyed.groupBy("key").agg(F.min("bits").alias("low"), F.max("bits").alias("high"))
    shared = written(shared.filter("low <> high").select("key"), "shared-keys")
    return keyed.join(shared, "key").select("bits").distinct()


def links_of(found: DataFrame) -> DataFrame:
    """Rows (bits, near): fingerprints under each neighbour that they share."""
    flips = F.array(*(F.lit(1 << i if i < WIDTH - 1 else -(1 << i)) for i in range(WIDTH)))
    flipped = F.transform(flips, lambda flip: F.col("bits").bitwiseXOR(flip))
    near = found.select("bits", F.explode(F.concat(F.array("bits"), flipped)).alias("near"))
    shared = near.groupBy("near").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return near.join(written(shared.select("near"), "shared-neighbours"), "near")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(bits, root): the smallest ``first`` among all fingerprints reachable.

    ``nodes`` has bits and first, unique in both; ``links`` says which neighbours a
    fingerprint is listed under. Either side of a link has at most 65 rows, so the
    spreading joins have no hot key. Labels also move on to their own label, so
    rounds grow with the logarithm of the longest chain of links.
    """
    linked = links.select("bits").distinct()
    labels = written(nodes.join(linked, "bits").withColumn("root", F.col("first")), "labels")
    while True:
        spread = links.join(labels.select("bits", "root"), "bits")
        lowest = spread.groupBy("near").agg(F.min("root").alias("root"))
        seen = links.join(lowest, "near").groupBy("bits").agg(F.min("root").alias("seen"))
        lower = F.least("root", "seen").alias("root")
        moved = labels.join(seen, "bits").select("bits", "first", F.col("root").alias("old"), lower)
        moved = written(moved, "labels")
        ahead = moved.filter("root <> first")
        ahead = ahead.select(F.col("first").alias("at"), F.col("root").alias("next"))
        jumped = moved.join(ahead, F.col("root") == F.col("at"), "left")
        labels = jumped.select("bits", "first", "old", F.coalesce("next", "root").alias("root"))
        labels = written(labels, "labels")
        if labels.filter("root <> old").isEmpty():
            return labels.select("bits", "root")
        labels = labels.drop("old")


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, bits (signed fingerprint) and component_id of every document.

    Documents whose fingerprints differ in at most two places are linked;
    component_id is the smallest doc_id reachable over links. ``words`` is the
    shingle length; a shorter text is one shingle. A null text is an empty one;
    texts without words have fingerprint zero and are linked like any other. Rows
    without doc_id make no links; they get the component of rows with the same
    fingerprint, or null. Repeated rows each give a row; other columns are left
    out; an empty table gives no rows.
    """
    prints = written(simhash(docs, words), "fingerprints")
    known = prints.filter("doc_id is not null")
    nodes = written(known.groupBy("bits").agg(F.min("doc_id").alias("first")), "nodes")
    links = written(links_of(candidates(nodes)), "links")
    roots = components(nodes, links)
    named = nodes.join(roots, "bits", "left")
    named = named.select("bits", F.coalesce("root", "first").alias("component_id"))
    return prints.join(written(named, "components"), "bits", "left").select(
        "doc_id", "bits", "component_id"
    )


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """``docs`` without those that have a smaller doc_id in their component.

    Rows without doc_id stay; rows that repeat a doc_id are one document and stay
    or go together. All columns stay.
    """
    found = near_duplicates(docs, words)
    name = unused_name("gone", docs.columns)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")

"""SimHash near-duplicates by shingle sets: wide rings, pigeonring chains, exact Jaccard,
and an exact search for the links that these leave out.

Two texts whose sets of five-word shingles have a Jaccard similarity of 0.8 differ in
about 15 % of their SimHash bits, which is too much for equal segments of 64 bits.
So a fingerprint has 1024 bits here, a ring of 256 segments of four bits.

**Candidates.** A text is listed under each chain of six consecutive segments, 24
bits that must be equal, with the 32 bits that follow on the ring. In sorted order
one text of a chain leads; a text whose chain of 14 segments stays within its
proportional budget of the leader's is a candidate, others lead in turn. A chain that
thousands share so gives one candidate each, never all pairs, and a task remembers
only leaders. A chain holds each text once among its 256 rows, so a group with a third
of all texts has 1/768 of the rows under one key.

**Links.** Candidates within the whole ring's budget are compared by their shingle
sets. First each text meets its smallest partner; only pairs whose ends are then in
different components follow, so a large group is not compared pair by pair.

**Groups.** The first links make trees, whose roots are found by pointer jumping: a row
for each text that is not done yet. The links that follow are links between roots, so
labels spread over as many rows as trees were joined, not over a large group's texts.

**What chains miss.** The chain search finds a pair at 0.8 with a probability of about
0.93, and two texts only if one of them leads. So all other pairs are searched exactly:
shingles are put in order by the number of texts that have them, and two sets at the
similarity share one of the first shingles of each, so many that the others alone are
too few. A shingle that one text has is no link, so most texts are out at once. Texts
that share a first shingle and whose sizes and places allow the similarity are compared
by their sets, if they are in different groups so far; a group that the chains have found
is so not compared with itself. No pair at the similarity or above is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import computed, removed, unused_name, written
from quotelake.llm.simhash import components
from quotelake.llm.tokens import in_pieces

SEED = 42
WIDTH = 1024
SEGMENT = 4
SEGMENTS = WIDTH // SEGMENT

#: Bits that are equal in a chain, and bits that are looked at behind it.
CHAIN, BEHIND = 24, 32

#: Share of the ring in which candidates may differ: 0.151 at a similarity of 0.8, and
#: 3.5 standard deviations.
DIFFERENT = 0.19

_ODD = (np.random.default_rng(SEED).integers(1, 2**63, WIDTH // 64, np.uint64) << np.uint64(1)) | np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BLOCK = 255

#: Bytes of a bucket of shingles that are counted together, and of one of them there.
BUCKET, ENTRY = 6_000_000, 20
#: Pairs that are looked at together.
PAIRS = 1 << 17
#: More than products of similarities and sizes are rounded by.
_ROUNDING = 1e-6


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[min(words, len(found)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, n))


def ring(shingles: np.ndarray) -> bytes:
    """Majority vote of 1024 bits over the shingles, in blocks a byte can count."""
    votes = np.zeros(WIDTH, np.int64)
    for at in range(0, len(shingles), _BLOCK):
        mixed = shingles[at : at + _BLOCK, None] * _ODD
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        mixed ^= mixed >> np.uint64(32)
        votes += np.unpackbits(mixed.view(np.uint8), axis=1).sum(0, dtype=np.uint8)
    return np.packbits(votes * 2 > len(shingles)).tobytes()


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes(), SEED)


def _prints(words: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rings, sizes = [], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                shingles = shingle_set(text.as_py() or b"", words)
                digests.append(_digest(shingles))
                rings.append(np.frombuffer(ring(shingles), ">i8").tolist())
                sizes.append(len(shingles))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(digests, pa.binary()),
                    pa.array(rings, pa.list_(pa.int64())),
                    pa.array(sizes, pa.int64()),
                ],
                names=["doc_id", "node", "ring", "size"],
            )

    return add


def _sets(words: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").cast(pa.large_binary()):
                shingles = shingle_set(text.as_py() or b"", words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(shingles)], pa.binary()), pa.array([shingles.view(np.int64)], pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    return add


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, node): number of the first segment, chain, and bits behind it."""
    place = np.arange(SEGMENTS, dtype=np.uint64) << np.uint64(CHAIN)
    picked = (np.arange(SEGMENTS)[:, None] * SEGMENT + np.arange(CHAIN + BEHIND)) % WIDTH
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rings = part.column("ring").flatten().to_numpy().astype(">i8").view(np.uint8)
            bits = np.unpackbits(rings.reshape(part.num_rows, -1), axis=1)[:, picked]
            packed = np.zeros((part.num_rows, SEGMENTS, 8), np.uint8)
            packed[:, :, 1:] = np.packbits(bits, axis=2)
            words = packed.view(">u8")[:, :, 0].astype(np.uint64) | (place << np.uint64(BEHIND))
            nodes = np.repeat(np.arange(part.num_rows), SEGMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.ravel().view(np.int64)), part.column("short").take(pa.array(nodes))],
                names=["word", "short"],
            )


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (member, leader) from (word, short) in sorted order.

    The first row of a chain leads all rows within budget of it; the first of the
    others leads next, until none is left. Leaders of a chain that goes on in the next
    batch are put before that batch.
    """
    within = int((CHAIN + BEHIND) * DIFFERENT)
    held_words, held = np.empty(0, np.uint64), np.empty(0, np.int64)
    for batch in batches:
        words = np.concatenate([held_words, batch.column("word").to_numpy().view(np.uint64)])
        nodes = np.concatenate([held, batch.column("short").to_numpy()])
        chains, last = words >> np.uint64(BEHIND), len(words) - 1
        behind = (words & np.uint64((1 << BEHIND) - 1)).astype(np.uint32)
        rows, kept = np.arange(len(words)), []
        while len(rows):
            first = np.r_[True, chains[rows][1:] != chains[rows][:-1]]
            lead = rows[np.flatnonzero(first)[np.cumsum(first) - 1]]
            near = np.bitwise_count(behind[rows] ^ behind[lead]) <= within
            link = near & (nodes[rows] != nodes[lead])
            if link.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[rows[link]]), pa.array(nodes[lead[link]])], names=["member", "leader"]
                )
            kept.append(rows[first & (chains[rows] == chains[last])])
            rows = rows[~near]
        open_rows = np.concatenate(kept) if kept else rows
        held_words, held = words[open_rows], nodes[open_rows]


def _differing(a: Column, b: Column) -> Column:
    counts = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _short(node: str) -> Column:
    """The first 60 bits of a node."""
    return F.conv(F.substring(F.hex(node), 1, 15), 16, 10).cast("long")


def candidates(nodes: DataFrame) -> DataFrame:
    """Distinct pairs (low, high) of nodes found by a chain and within the ring's budget."""
    short = nodes.select("ring", _short("node").alias("short"))
    keyed = short.mapInArrow(_chains, "word bigint, short bigint")
    chain = F.shiftright("word", BEHIND)
    # Sorted by the whole word, so rows that are alike behind a chain stand together.
    keyed = keyed.repartition(chain).sortWithinPartitions(chain, "word", "short")
    found = keyed.mapInArrow(stars, "member bigint, leader bigint")
    pairs = found.select(F.least("member", "leader").alias("a"), F.greatest("member", "leader").alias("b"))
    pairs = written(pairs.distinct(), "chain-pairs")
    named = nodes.select("node", "ring", _short("node").alias("short"))
    left = named.select(F.col("short").alias("a"), F.col("node").alias("low"), F.col("ring").alias("low_ring"))
    right = named.select(F.col("short").alias("b"), F.col("node").alias("high"), F.col("ring").alias("high_ring"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(_differing(F.col("low_ring"), F.col("high_ring")) <= int(WIDTH * DIFFERENT)).select("low", "high")


def _dealt(buckets: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket, in whose columns are the bytes of its values."""
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(buckets))
    blobs = lambda x: pa.array([x[a:z].tobytes() for a, z in zip(starts, ends)], pa.binary())
    kept = {"bucket": pa.array(buckets[starts].astype(np.int32))} | {n: blobs(x[order]) for n, x in columns.items()}
    return pa.RecordBatch.from_pydict(kept)


def _gathered(table: pa.Table, **kinds: str) -> list[np.ndarray]:
    # Else a worker keeps what it needed for its largest group.
    pa.default_memory_pool().release_unused()
    return [np.frombuffer(b"".join(table[n].to_pylist()), kind) for n, kind in kinds.items()]


def _entries(words: int, buckets: int):
    """The shingles of all sets, each with its text's short and number of shingles."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, rows=1024, size=4_000_000):
            sets = {}
            for text in batch.column("text").cast(pa.large_binary()):
                shingles = shingle_set(text.as_py() or b"", words)
                sets[int.from_bytes(_digest(shingles)[:8], "big") >> 4] = shingles
            sizes = np.array([len(s) for s in sets.values()], "<i4")
            keys = np.concatenate([*sets.values(), np.empty(0, np.uint64)]).astype("<u8")
            shorts = np.repeat(np.array(list(sets), "<i8"), sizes)
            yield _dealt(keys % np.uint64(buckets), key=keys, short=shorts, size=np.repeat(sizes, sizes))

    return deal


def _shared(buckets: int):
    """The shingles of a bucket that several sets have, with how many, dealt by set."""

    def count(key_of: tuple, table: pa.Table) -> pa.Table:
        keys, shorts, sizes = _gathered(table, key="<u8", short="<i8", size="<i4")
        order = np.lexsort((shorts, keys))
        keys, shorts, sizes = keys[order], shorts[order], sizes[order]
        # Texts with the same set are one.
        own = np.r_[True, (keys[1:] != keys[:-1]) | (shorts[1:] != shorts[:-1])][: len(keys)]
        keys, shorts, sizes = keys[own], shorts[own], sizes[own]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        times = np.diff(np.append(starts, len(keys)))
        having = np.repeat(times, times)
        some = having > 1
        having = having[some].astype("<i4")
        dealt = _dealt(shorts[some] % buckets, key=keys[some], short=shorts[some], size=sizes[some], having=having)
        return pa.Table.from_batches([dealt])

    return count


def _first(similarity: float):
    """Rows (key, short, size, place): the shingles of which similar sets share one."""

    def choose(key_of: tuple, table: pa.Table) -> pa.Table:
        keys, shorts, sizes, having = _gathered(table, key="<u8", short="<i8", size="<i4", having="<i4")
        order = np.lexsort((keys, having, shorts))
        keys, shorts, sizes = keys[order], shorts[order], sizes[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, shorts[1:] != shorts[:-1]][: len(shorts)])
        times = np.diff(np.append(starts, len(shorts)))
        # Shingles that no other set has come first, but link nothing.
        place = np.arange(len(shorts)) - np.repeat(starts, times) + sizes - np.repeat(times, times)
        needed = np.ceil(similarity * sizes - _ROUNDING).astype(np.int64)
        first = place <= sizes - needed
        kept = {"key": keys[first].view(np.int64), "short": shorts[first], "size": sizes[first], "place": place[first]}
        return pa.table(kept)

    return choose


def first_shingles(texts: DataFrame, total: int, words: int, similarity: float) -> DataFrame:
    """Rows (key, short, size, place): shingles of which any two different sets at the similarity share one.

    A set that has a shingle in common with a similar one has as many in common as
    ``similarity`` times its size. So in any order of shingles, here by how many sets
    have them, one of these is among the first ``size - needed + 1`` of either. ``total``
    is about the number of shingles of all sets.
    """
    buckets = total * ENTRY // BUCKET + 1
    dealt = texts.select("text").mapInArrow(_entries(words, buckets), "bucket int, key binary, short binary, size binary")
    shared = dealt.groupBy("bucket").applyInArrow(
        _shared(buckets), "bucket int, key binary, short binary, size binary, having binary"
    )
    chosen = shared.groupBy("bucket").applyInArrow(_first(similarity), "key bigint, short bigint, size bigint, place bigint")
    return written(chosen, "first-shingles")


def _crossing(similarity: float):
    """Pairs (a, b) from (key, root, short, size, place) in order of key and root.

    Pairs of rows with one key and different roots, whose sizes and places allow the
    similarity. At the first shingle that both have, all else they share comes later.
    """

    def pairs_of(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, root, short, size, place = rows.values()
        n = len(key)
        new_key = np.r_[True, key[1:] != key[:-1]]
        new_root = new_key | np.r_[True, root[1:] != root[:-1]]
        end_of = lambda new: np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
        after = end_of(new_root)
        count = end_of(new_key) - after
        total = np.append(0, np.cumsum(count))
        for at in range(0, int(total[-1]), PAIRS):
            pair = np.arange(at, min(at + PAIRS, int(total[-1])))
            a = np.searchsorted(total, pair, "right") - 1
            b = after[a] + pair - total[a]
            most = np.minimum(size[a] - place[a], size[b] - place[b])
            least = similarity / (1 + similarity) * (size[a] + size[b]) - _ROUNDING
            near = np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - _ROUNDING
            near &= most >= least
            both = np.stack([short[a[near]], short[b[near]]])
            both = np.unique(np.sort(both, axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {n: batch.column(n).to_numpy() for n in ("key", "root", "short", "size", "place")}
            if held is not None:
                rows = {n: np.append(held[n], x) for n, x in rows.items()}
            # The last key may go on in the next batch.
            cut = np.searchsorted(rows["key"], rows["key"][-1])
            held = {n: x[cut:] for n, x in rows.items()}
            if cut:
                yield from pairs_of({n: x[:cut] for n, x in rows.items()})
        if held is not None:
            yield from pairs_of(held)

    return cross


def _left_out(first: DataFrame, rooted: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (low, high) of nodes of different roots that share a first shingle."""
    roots = rooted.select(_short("node").alias("short"), _short("root").alias("root"))
    placed = written(first.join(roots, "short").select("key", "root", "short", "size", "place"), "placed")
    several = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
    open_rows = placed.join(several, "key", "left_semi").repartition("key").sortWithinPartitions("key", "root")
    pairs = open_rows.mapInArrow(_crossing(similarity), "a bigint, b bigint").distinct()
    for short, node in (("a", "low"), ("b", "high")):
        pairs = pairs.join(rooted.select(_short("node").alias(short), F.col("node").alias(node)), short)
    return pairs.select("low", "high")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have at least the similarity."""
    low = sets.select(F.col("node").alias("low"), F.col("shingles").alias("x"))
    high = sets.select(F.col("node").alias("high"), F.col("shingles").alias("y"))
    both = pairs.join(low, "low").join(high, "high")
    both = computed(both.withColumn("n", F.size("x") + F.size("y")), common=F.size(F.array_intersect("x", "y")))
    return both.filter(F.col("common") >= similarity * (F.col("n") - F.col("common"))).select(*pairs.columns)


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for all nodes that have a link."""
    listed = links.select(F.col("low").alias("bits"), F.col("low").alias("near")).union(
        links.select(F.col("high").alias("bits"), F.col("low").alias("near"))
    )
    own = nodes.select(F.col("node").alias("bits"), F.col("node").alias("first"))
    return components(own, written(listed.distinct(), "links")).select(F.col("bits").alias("node"), "root")


def _joined(nodes: DataFrame, rooted: DataFrame, links: DataFrame) -> DataFrame:
    """``rooted`` after roots that links (low_root, high_root) reach are one."""
    between = links.select(
        F.least("low_root", "high_root").alias("low"), F.greatest("low_root", "high_root").alias("high")
    )
    tops = _roots(nodes, written(between.distinct(), "root-links"))
    tops = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return rooted.join(tops, "root", "left").select("node", "first", F.coalesce("top", "root").alias("root"))


def tree_roots(links: DataFrame) -> DataFrame:
    """(node, root) for each ``high`` of the links, which has one, smaller ``low``.

    Rows whose ``low`` hangs under no other are done; the others go on to what their
    ``low`` has found, so rounds grow with the logarithm of the deepest tree.
    """
    found = links.select(F.col("high").alias("node"), F.col("low").alias("root"), F.lit(True).alias("moving"))
    while True:
        above = found.select(F.col("node").alias("root"), F.col("root").alias("next"))
        ahead = found.filter("moving").join(above, "root", "left")
        ahead = ahead.select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moving"))
        found = written(ahead.union(found.filter("not moving")), "trees")
        if found.filter("moving").isEmpty():
            return found.select("node", "root")


def near_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id and component_id (smallest doc_id of its group) of every document.

    Documents with equal shingle sets, and those whose sets have a Jaccard similarity of
    ``similarity`` or more, are linked; groups are what links reach. A null text is an
    empty one; texts without words are one group; a text of fewer than ``words`` words is
    one shingle. Rows without doc_id make no links; they get the group of rows with the
    same set, or null. Repeated rows each give a row; other columns are left out; an
    empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    prints = written(
        texts.mapInArrow(_prints(words), f"doc_id {kind}, node binary, ring array<bigint>, size bigint"), "rings"
    )
    known = prints.filter("doc_id is not null")
    nodes = known.groupBy("node").agg(*(F.first(c).alias(c) for c in ("ring", "size")), F.min("doc_id").alias("first"))
    nodes = written(nodes, "nodes")
    pairs = written(candidates(nodes), "pairs")
    total = nodes.agg(F.sum("size")).first()[0] or 0
    first = first_shingles(texts.filter("doc_id is not null"), total, words, similarity)

    paired = pairs.select(F.col("low").alias("node")).union(pairs.select(F.col("high").alias("node")))
    sharing = first.select("short").distinct().join(nodes.select("node", _short("node").alias("short")), "short")
    paired = paired.union(sharing.select("node")).distinct()
    wanted = nodes.join(paired, "node").select(F.col("first").alias("doc_id")).distinct()
    fetched = texts.join(wanted, "doc_id", "left_semi").select("text")
    sets = fetched.mapInArrow(_sets(words), "node binary, shingles array<bigint>")
    # A repeated doc_id brings texts of its other rows along; those meet no pair.
    sets = written(sets.dropDuplicates(["node"]), "sets")

    smallest = pairs.groupBy("high").agg(F.min("low").alias("low")).select("low", "high")
    links = written(_verified(smallest, sets, similarity), "first-links")
    roots = tree_roots(links)
    rest = pairs.join(smallest, ["low", "high"], "left_anti")
    for side in ("low", "high"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        rest = rest.join(named, side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))
    more = _verified(written(rest.filter("low_root <> high_root"), "rest"), sets, similarity)
    rooted = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    rooted = written(_joined(nodes, rooted, more.select("low_root", "high_root")), "rooted")

    missed = _verified(written(_left_out(first, rooted, similarity), "left-out"), sets, similarity)
    for side in ("low", "high"):
        named = rooted.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        missed = missed.join(named, side)
    rooted = _joined(nodes, rooted, missed.select("low_root", "high_root"))
    removed(sets)

    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(lowest, "root").select("node", "component_id"), "groups")
    return prints.join(named, "node", "left").select("doc_id", "component_id")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without those that have a smaller doc_id in their group.

    Texts, nulls and empty tables as in ``near_groups``. Rows without doc_id stay; rows
    that repeat a doc_id are one document and stay or go together. All columns stay.
    """
    found = near_groups(docs, words, similarity)
    name = unused_name("gone", docs.columns)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")

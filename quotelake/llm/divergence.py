"""How far the word shares of a source lie from those of the other sources of its language.

Terms are found by their places: over the Arrow buffer of many texts, one pointer for
each word start, sorted by the word it points to. The sort is a multikey quicksort
whose characters are eight bytes: it splits a slice of pointers into those below, at
and above a pivot, goes on with the middle part eight bytes further right, and does
so for all open slices at once. Equal runs of the sorted pointers are the terms; the
documents and sources that a run touches give its document frequency and counts. A
*shard* is one buffer of bounded bytes; its runs are all that leaves a task.

Shares and divergences are whole numbers: ``p = 1 + floor(SCALE * (count + 1) / (N + V))``
and ``f = floor((p - q)^2 / q)``. Summed over all V kept terms, f needs only the terms
that occur in one of two sources: terms in neither give the same f each, terms in one
are counted by their number of occurrences, terms in both meet in a join.

Null text, lang and source are read as ''. Every row is a document of its own, whatever
its doc_id, so repeated rows count each time. A language without kept terms has V = 0
and pairs of value 0. A language of one source has no pairs. Ties are ranked by item in
UTF-8 order. An empty table gives no rows. Only text, lang and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import or_empty, written

#: Bytes of a pointer's character.
STEP = 8
#: Pointers of a slice that is not split any more (their characters fit a cache).
FEW = 65_536
COUNTS = "lang string, source string, term string, n long, docs long"

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_IN_TERM = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: A byte as it is compared: A-Z as a-z, and 0 where no term is.
_FOLDED = np.where(_IN_TERM, np.where(_UPPER, _BYTES + 32, _BYTES), 0).astype(np.uint8)
#: By the bytes left of a term: which bits of its next eight bytes belong to it.
_KEPT = np.array([(2**64 - 1) ^ (2 ** (8 * (STEP - r)) - 1) for r in range(STEP + 1)], np.uint64)


@dataclass(frozen=True)
class DivergenceConfig:
    """``least_docs``: documents of a language that a kept term is in; ``ranks``: rows of
    part ``term`` per group; ``scale``: what shares are multiplied by; ``shard_bytes``:
    text that is sorted at once (a longer text is one shard)."""

    least_docs: int = 3
    ranks: int = 200
    scale: int = 1_000_000_000
    shard_bytes: int = 8_000_000


DEFAULT = DivergenceConfig()


def word_pointers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The folded bytes of all texts with a 0 after each, and the terms in them:
    their starts, their lengths and their texts' numbers."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
    lengths = np.diff(offsets)
    # Eight zeros more, so that eight bytes can be read from every place.
    folded = np.zeros(len(data) + len(lengths) + 1 + STEP, np.uint8)
    number = np.repeat(np.arange(len(lengths)), lengths)
    folded[np.arange(1, len(data) + 1) + number] = _FOLDED[data]
    inside = (folded != 0).view(np.int8)
    edges = np.diff(inside)
    starts = np.flatnonzero(edges == 1) + 1
    ends = np.flatnonzero(edges == -1) + 1
    first = offsets[:-1] - offsets[0] + np.arange(len(lengths)) + 1
    return folded, starts, ends - starts, np.searchsorted(first, starts, "right") - 1


def pointer_sort(folded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the terms and, in that order, where a run of equal terms begins.

    Multikey quicksort of all open slices side by side; equal terms keep their order.
    Slices of few pointers are not split but put in the order of their character.
    """
    n = len(starts)
    eight = np.ndarray(len(folded) - STEP + 1, ">u8", folded, strides=(1,))
    order, begins = np.arange(n, dtype=np.int32), np.zeros(n, bool)
    # Of each open pointer, in order: its place, its slice's first place, its depth.
    at, first, depth = order.copy(), np.zeros(n, np.int32), np.zeros(n, np.int32)
    keys = _keys(eight, starts, lengths, depth)
    while len(at):
        head = np.r_[True, first[1:] != first[:-1]]
        heads = np.flatnonzero(head).astype(np.int32)
        sizes = np.diff(np.r_[heads, np.int32(len(at))])
        slice_no = np.cumsum(head, dtype=np.int32) - np.int32(1)
        few = (sizes <= FEW)[slice_no]
        moved, equal = np.empty_like(at), few
        small, large = np.flatnonzero(few), np.flatnonzero(~few)
        moved[small] = small[np.lexsort((keys[small], slice_no[small]))]
        if len(large):
            side = np.ones(len(at), np.int8)
            of_large = keys[large]
            pivot = _pivots(keys, heads, sizes)[slice_no[large]]
            side[large] = (of_large >= pivot).view(np.int8) + (of_large > pivot)
            moved[large] = _three_ways(side, large, slice_no, heads)
            side = side[moved]
            equal = few | (side == 1)
        keys, depth = keys[moved], depth[moved]
        order[at] = order[at[moved]]
        # Slices as they are now: a side of a large one, equal characters of a small one.
        head[1:] |= few[1:] & (keys[1:] != keys[:-1])
        if len(large):
            head[1:] |= side[1:] != side[:-1]
        begins[at[head]] = True
        first = at[np.flatnonzero(head)[np.cumsum(head) - 1]]
        # Equal characters that end in a 0 are equal terms; a slice of one is sorted.
        alone = head & np.r_[head[1:], True]
        still = ~alone & (~equal | ((keys & np.uint64(0xFF)) != 0))
        at, keys, depth, first, equal = at[still], keys[still], depth[still], first[still], equal[still]
        # Equal ones without a 0 go on eight bytes further right.
        on = np.flatnonzero(equal)
        depth[on] += np.int32(STEP)
        some = order[at[on]]
        keys[on] = _keys(eight, starts[some], lengths[some], depth[on])
    return order, begins


def _three_ways(side: np.ndarray, places: np.ndarray, slice_no: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """``places`` of whole slices in the order of slice and side, else as they were."""
    target, begin = np.empty(len(side), np.int32), heads
    for part in range(3):
        here = places[side[places] == part]
        of = slice_no[here]
        counts = np.bincount(of, minlength=len(heads)).astype(np.int32)
        before = np.cumsum(counts, dtype=np.int32) - counts
        target[here] = (begin - before)[of] + np.arange(len(here), dtype=np.int32)
        begin = begin + counts
    moved = np.empty(len(side), np.int32)
    moved[target[places]] = places
    return moved[places]


def _keys(eight: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Eight bytes of each term from ``depth`` on as a number, 0 beyond the term's end."""
    left = np.clip(lengths - depth, 0, STEP)
    return eight[np.minimum(starts + depth, len(eight) - 1)].astype(np.uint64) & _KEPT[left]


def _pivots(keys: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The median of each slice's first, middle and last key."""
    a, b, c = keys[heads], keys[heads + sizes // 2], keys[heads + sizes - 1]
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def shard_counts(texts: pa.Array, groups: np.ndarray, n_groups: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a shard by group of texts: term, group, occurrences, documents."""
    folded, starts, lengths, number = word_pointers(texts)
    order, begins = pointer_sort(folded, starts, lengths)
    run, doc = np.cumsum(begins) - 1, number[order]
    # Equal terms keep their order, so a run's documents ascend.
    fresh = begins | np.r_[True, doc[1:] != doc[:-1]] if len(doc) else begins
    key = run * n_groups + groups[doc]
    size = (int(run[-1]) + 1 if len(run) else 0) * n_groups
    if size <= 4 * len(key) + 1024:
        n = np.bincount(key, minlength=size)
        found = np.flatnonzero(n)
        docs = np.bincount(key[fresh], minlength=size)[found]
        n = n[found]
    else:
        found, where, n = np.unique(key, return_inverse=True, return_counts=True)
        docs = np.bincount(where[fresh], minlength=len(found))
    head = order[np.flatnonzero(begins)]
    at, long = starts[head], lengths[head]
    offsets = np.r_[0, np.cumsum(long)].astype(np.int64)
    inner = np.repeat(at - offsets[:-1], long) + np.arange(offsets[-1])
    terms = pa.LargeStringArray.from_buffers(
        len(head), pa.py_buffer(offsets.tobytes()), pa.py_buffer(folded[inner].tobytes())
    )
    return terms.take(pa.array(found // n_groups)).cast(pa.string()), found % n_groups, n, docs


def _shards(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``limit`` bytes of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch["text"]), 0), np.int64)
    part = np.cumsum(sizes) // limit
    edges = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist(), len(part)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def term_counts(docs: DataFrame, cfg: DivergenceConfig = DEFAULT) -> DataFrame:
    """Occurrences and documents of every term in every (lang, source)."""
    limit = cfg.shard_bytes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in _shards(batch, limit) if batch.num_rows else ():
                lang, source = shard["lang"].dictionary_encode(), shard["source"].dictionary_encode()
                width = len(source.dictionary)
                code = np.asarray(lang.indices, np.int64) * width + np.asarray(source.indices, np.int64)
                size = len(lang.dictionary) * width
                terms, group, n, seen = shard_counts(shard["text"], code, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(group // width)),
                        source.dictionary.take(pa.array(group % width)),
                        terms,
                        pa.array(n, pa.int64()),
                        pa.array(seen, pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    read = docs.select(*(or_empty(c).alias(c) for c in ("text", "lang", "source")))
    # One shuffle: what is placed by (lang, term) is also placed by (lang, source, term).
    placed = read.mapInArrow(count, COUNTS).repartition("lang", "term")
    return placed.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column, cfg: DivergenceConfig) -> Column:
    """p of ``count``; in decimals, as the product may pass the range of a long. Without
    terms there is nothing to share out, and any divisor does."""
    exact = lambda c: c.cast("decimal(20,0)")
    product = (exact(count + 1) * F.lit(cfg.scale).cast("decimal(10,0)")).cast("decimal(38,0)")
    return 1 + F.call_function("div", product, exact(total + F.greatest(terms, F.lit(1))))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, cfg: DivergenceConfig = DEFAULT) -> DataFrame:
    """Rows ``(lang, source, part, item, value, rank)``.

    Part ``pair``: how far each (lang, source) lies from every other source of the
    language, over all kept terms. Part ``term``: the terms it has more of than its
    language, by the same measure, the first ``cfg.ranks`` of them.
    """
    in_lang = Window.partitionBy("lang", "term")
    counts = term_counts(docs, cfg).withColumn("lang_docs", F.sum("docs").over(in_lang))
    kept = written(
        counts.withColumn("lang_n", F.sum("n").over(in_lang))
        .filter(F.col("lang_docs") >= cfg.least_docs)
        .select("lang", "term", "source", "n", "lang_n"),
        "kept-terms",
    )
    groups = docs.select(or_empty("lang").alias("lang"), or_empty("source").alias("source")).distinct()
    found = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # A source holds a share of a term's occurrences, a language one row of each term.
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("terms")
    )
    zero = {"total": 0, "lang_total": 0, "terms": 0}
    sizes = written(
        groups.join(found, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero), "group-sizes"
    )
    rows = written(
        kept.join(sizes, ["lang", "source"]).select(
            "lang",
            "term",
            "source",
            "n",
            _share(F.col("n"), F.col("total"), F.col("terms"), cfg).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), cfg).alias("q"),
        ),
        "term-shares",
    )
    return _pairs(rows, sizes, cfg).unionByName(_terms(rows, cfg))


def _terms(rows: DataFrame, cfg: DivergenceConfig) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    above = rows.filter("p > q").withColumn("value", _gap(F.col("p"), F.col("q")))
    ranked = above.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= cfg.ranks)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(rows: DataFrame, sizes: DataFrame, cfg: DivergenceConfig) -> DataFrame:
    """f summed over all kept terms, for each ordered pair of sources of a language.

    With p0 and q0 the shares of a term that a source lacks, the sum is
    ``V f(p0, q0)``, plus ``f(p, q0) - f(p0, q0)`` over the first source's terms, plus
    ``f(p0, q) - f(p0, q0)`` over the second's, plus what corrects terms of both. The
    middle two need only how many terms occur how often.
    """
    p0 = _share(F.lit(0).cast("long"), F.col("total"), F.col("terms"), cfg)
    one = sizes.select("lang", "source", "terms", p0.alias("p0"))
    two = one.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    both = one.join(two, "lang").filter("source <> item")
    f00 = _gap(F.col("p0"), F.col("q0"))

    how_often = rows.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    first = (
        how_often.join(both, ["lang", "source"])
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("times") * (_gap(F.col("p"), F.col("q0")) - f00)).alias("first"))
    )
    second = (
        how_often.withColumnsRenamed({"source": "item", "p": "q"})
        .join(both, ["lang", "item"])
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("times") * (_gap(F.col("p0"), F.col("q")) - f00)).alias("second"))
    )
    left = rows.join(one, ["lang", "source"]).select("lang", "term", "source", "p", "p0")
    right = left.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    shared = (
        left.join(right, ["lang", "term"])
        .filter("source <> item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(_gap(p, q) - _gap(p, q0) - _gap(p0, q) + f00).alias("shared"))
    )
    key = ["lang", "source", "item"]
    whole = both.join(first, key, "left").join(second, key, "left").join(shared, key, "left")
    part = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    value = F.col("terms") * f00 + part("first") + part("second") + part("shared")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return whole.withColumn("value", value).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by).alias("rank")
    )

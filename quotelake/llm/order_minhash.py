"""Order MinHash fingerprints, in DataFrame functions only.

A text's k-mers (``K`` consecutive words) are numbered by occurrence, so a repeated
one counts as often as it stands there. Their hashes deal them into ``BINS`` bins;
of each bin the two smallest are kept, put back into text order and hashed as a
pair. A bin agrees in two texts if the same two k-mers win in the same order,
which falls with edits and with moved passages.

Everything happens in a document's own row: the arrays are sorted and walked
once, so the cost is that of sorting a text's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quotelake.llm.common import computed, or_empty

K = 3
BIN_BITS = 6
#: A position takes 30 bits, more words than a text of 2 GB can have.
PLACE_BITS = 30
PLACE = (1 << PLACE_BITS) - 1

#: Keys that tell where a range of documents begins and ends, about so many for each.
SAMPLED = 32

SPACES = r"[\x20\x09-\x0D]+"


def _packed(hashed: Column, place: Column) -> Column:
    """The low 34 bits of a hash before a position, which sort as one long."""
    return F.shiftleft(hashed, PLACE_BITS).bitwiseOR(place.cast("bigint"))


def _bin(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 64 - BIN_BITS)


def _walk(n: Column) -> Column:
    """0 to ``n - 1``, nothing for zero."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the signature of ``text``: a bin and its pair's hash in each long."""
    kept = df.columns
    df = computed(df, words=F.array_remove(F.split(F.col(text), SPACES), ""))
    n = F.size("words")
    kmers = F.when(n == 0, F.lit(0)).otherwise(F.greatest(n - (K - 1), F.lit(1)))
    kmer = lambda i: F.xxhash64(F.slice("words", i.cast("int") + 1, F.lit(K)))
    df = computed(df, ordered=F.sort_array(F.transform(_walk(kmers), lambda i: _packed(kmer(i), i))))

    # Equal k-mers are neighbours now: a run's n-th one is its n-th occurrence.
    hashed = lambda i: F.shiftrightunsigned(F.get("ordered", i), PLACE_BITS)
    first = lambda i: (i == 0) | (hashed(i) != hashed(i - 1))
    df = computed(df, runs=F.filter(_walk(F.size("ordered")), first))
    numbered = lambda i, start: _packed(
        F.xxhash64(hashed(i), i - start), F.get("ordered", i).bitwiseAND(F.lit(PLACE))
    )
    last = lambda j: F.coalesce(F.get("runs", j + 1), F.size("ordered")) - 1
    start = lambda j: F.get("runs", j)
    again = F.filter(_walk(F.size("runs")), lambda j: last(j) > start(j))
    run = lambda j: F.transform(
        F.sequence(start(j) + 1, last(j)), lambda i: numbered(i, start(j))
    )
    # Most k-mers occur once: only the others' runs are walked a second time.
    ranked = F.concat(
        F.transform("runs", lambda i: numbered(i, i)), F.flatten(F.transform(again, run))
    )
    df = computed(df, ranked=F.sort_array(ranked))

    bin_at = lambda i: _bin(F.get("ranked", i))
    leads = lambda i: (i == 0) | (bin_at(i - 1) != bin_at(i))
    df = computed(df, heads=F.filter(_walk(F.size("ranked")), leads))
    place = lambda i: F.get("ranked", i).bitwiseAND(F.lit(PLACE))

    def pair(i: Column) -> Column:
        own = F.get("ranked", i)
        second = F.get("ranked", i + 1)
        both = second.isNotNull() & (_bin(second) == _bin(own))
        low, high = F.least(place(i), place(i + 1)), F.greatest(place(i), place(i + 1))
        value = F.when(both, F.xxhash64(kmer(low), kmer(high))).otherwise(F.xxhash64(kmer(place(i))))
        return F.shiftleft(_bin(own), 64 - BIN_BITS).bitwiseOR(F.shiftrightunsigned(value, BIN_BITS))

    df = computed(df, __signature=F.transform("heads", pair))
    return df.select(*kept, F.col("__signature").alias(name))


def shown(signature: str) -> Column:
    """A signature as text: 16 hex digits for each bin that is not empty."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(one: str, other: str) -> Column:
    """Share of the bins filled in either that agree; 1 for two without words."""
    bins = F.size(F.array_union(F.transform(one, _bin), F.transform(other, _bin)))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / bins)


def range_bounds(docs: DataFrame, n: int) -> tuple[Row | None, list[Row]]:
    """The smallest (doc_id, text_hash), and up to ``n - 1`` larger ones that cut the rows
    into ranges.

    About ``SAMPLED`` distinct keys a range, chosen by a hash, come to the driver. Nulls
    and repeated ids are cut by the hash of their text.
    """
    keys = docs.select("doc_id", _text_hash().alias("text_hash"))
    low, count = keys.agg(F.min(F.struct("doc_id", "text_hash")), F.count(F.lit(1))).first()
    parts = 1 << 30
    share = min(1.0, SAMPLED * n / max(1, count))
    few = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(SAMPLED)), F.lit(parts)) < int(share * parts)
    found = keys.filter(few).distinct().orderBy("doc_id", "text_hash").collect()
    picked = {len(found) * i // n for i in range(1, n)}
    return low, [key for i, key in enumerate(found) if i in picked and key != low]


def _text_hash() -> Column:
    return F.xxhash64(or_empty("text"))


def with_next(rows: DataFrame, docs: DataFrame, values: list[str], per_partition: int = 4) -> DataFrame:
    """``rows`` with ``next_<value>`` of the next one by doc_id, then a hash of its text.

    ``docs`` are the doc_id and text that ``rows`` are derived from, so that the ranges
    are found without deriving them. After the last row comes the first. The rows are
    dealt into ranges of (doc_id, hash), ``per_partition`` for each shuffle partition,
    whose bounds are keys that occur; the rows at a bound also go, marked, to the end of
    the range before. So a single shuffle does it and no task sees more than its range;
    only rows that are equal in both cannot be cut apart. Rows without doc_id come first.
    """
    spark = rows.sparkSession
    low, bounds = range_bounds(docs, per_partition * int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = f"struct<doc_id:{rows.schema['doc_id'].dataType.simpleString()},text_hash:bigint>"
    literal = lambda key: F.struct(F.lit(key["doc_id"]), F.lit(key["text_hash"])).cast(kind)
    key = F.struct("doc_id", F.col("__hash").alias("text_hash"))
    same = lambda one: (one["doc_id"].eqNullSafe(F.col("doc_id"))) & (one["text_hash"] == F.col("__hash"))
    keyed = computed(rows, __hash=_text_hash())
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    here, at_bound, is_first = F.lit(0), F.lit(False), F.lit(False)
    if groups:
        starts = F.array(*(literal(g[0]) for g in groups))
        nested = F.array(*(F.array(*map(literal, g)) for g in groups))
        group = F.size(F.filter(starts, lambda b: b <= key))
        own = F.get(nested, group - 1)
        within = F.size(F.filter(own, lambda b: b <= key))
        here = F.when(group > 0, (group - 1) * width + within).otherwise(F.lit(0))
        at_bound = (group > 0) & same(F.get(own, within - 1))
    if low is not None:
        is_first = same(literal(low))
    dealt = computed(keyed, __range=here, __bound=F.coalesce(at_bound, F.lit(False)))
    before = F.when(is_first, F.lit(len(bounds))).when(F.col("__bound"), F.col("__range") - 1)
    ranges = F.array_compact(
        F.array(
            F.struct(F.col("__range").alias("range"), F.lit(False).alias("again")),
            F.when(before.isNotNull(), F.struct(before.alias("range"), F.lit(True).alias("again"))),
        )
    )
    placed = dealt.select(*rows.columns, "__hash", F.explode(ranges).alias("__in"))
    order = Window.partitionBy("__in.range").orderBy("__in.again", "doc_id", "__hash", "text")
    following = placed.select(
        *rows.columns, "__in", *(F.lead(v).over(order).alias(f"next_{v}") for v in values)
    )
    return following.filter(~F.col("__in.again")).drop("__in")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text and signature of every whole text; a null text is empty.

    A text of fewer than ``K`` words is one k-mer; one without words has an empty
    signature. Repeated rows each give a row; a null doc_id is a value like any
    other; other columns are left out; an empty table gives no rows.
    """
    return with_signature(docs.select("doc_id", or_empty("text").alias("text")), "text", "signature")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the next one, and of the text edited.

    The edit puts the beginning of the next text, by doc_id of any type that can be
    sorted, in place of the last quarter. Rows of one doc_id, or without one, follow each
    other by a hash of their text. A single row follows itself.
    Columns: doc_id, n_chars, edited, signature, next_signature, edited_signature.
    """
    following = with_next(fingerprints(docs), docs, ["text", "signature"])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter)
    )
    rows = computed(
        following.select("doc_id", "text", "next_text", "signature", "next_signature"), edited=edited
    )
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "edited", "signature", "next_signature"
    )
    return with_signature(rows, "edited", "edited_signature")

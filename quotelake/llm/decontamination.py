"""Benchmark decontamination: a hash set of normalised n-grams, hits verified.

All of it is DataFrame functions. A document's windows are hashed in its own row,
exploded as plain longs and looked up in the broadcast hash set; the words of a
window are compared only where its hash is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import ascii_lower, computed, or_empty, unused_name

#: Fixed value: what stands between words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WINDOW = 10

#: Most windows of a benchmark that are broadcast, about 30 MB of them. A larger
#: benchmark is joined by a shuffle on the hash, with the same rows.
BROADCAST_WINDOWS = 200_000

#: Over how many keys documents are dealt under which each is found once, hit or not.
WHOLE_KEYS = 4096


def words_of(text: str) -> Column:
    return F.array_remove(F.split(ascii_lower(or_empty(text)), SEPARATORS), "")


def _key(words: Column, start: Column, length: Column | int) -> Column:
    """Hash of the window of ``length`` words at ``start``, counted from zero."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.xxhash64(length.cast("int"), F.slice(words, start + 1, length))


def _keys(words: Column, n: Column, length: Column | int) -> Column:
    """Hashes of all windows of ``length`` words, none for a shorter text."""
    length = F.lit(length) if isinstance(length, int) else length
    starts = F.sequence(F.lit(0), F.greatest(n - length, F.lit(0)))
    keys = F.transform(starts, lambda i: _key(words, i, length))
    return F.when(n >= length, keys).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of every item: item_id, length, key and the words."""
    items = computed(benchmark.select("item_id", "text"), words=words_of("text"))
    items = items.filter(F.size("words") > 0)
    items = items.select("item_id", "words", F.least(F.size("words"), F.lit(window)).alias("length"))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    each = items.select("*", F.explode(starts).alias("start"))
    return each.select(
        "item_id",
        "length",
        _key(F.col("words"), F.col("start"), F.col("length")).alias("key"),
        F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ").alias("window"),
    ).distinct()


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, hits and item_ids.

    ``hits`` are the (start, length) of its words that are a window of an item,
    ``item_ids`` the items, as sorted strings. An item of fewer than ``window``
    words is one window; without words it has none. A null text, of a document or
    an item, has no words. Rows that repeat a document with its text each give a
    row; rows of one doc_id with different texts are different documents; a null
    doc_id is a value like any other and so is a null item_id, which is counted
    nowhere. Other columns are left out; an empty table of documents gives no
    rows, an empty benchmark no hits.
    """
    known = benchmark_windows(benchmark, window)
    sizes = known.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    lengths = sorted((row["length"] for row in sizes), reverse=True)
    # Each document is one row more, so that those without hits are kept.
    whole = docs.sparkSession.range(WHOLE_KEYS).select(
        F.lit(None).cast(known.schema["item_id"].dataType).alias("item_id"),
        F.lit(0).alias("length"),
        F.col("id").alias("key"),
        F.lit("").alias("window"),
    )
    known = known.union(whole)
    if sum(row["n"] for row in sizes) <= broadcast_windows:
        known = F.broadcast(known)

    texts = computed(docs.select("doc_id", "text"), words=words_of("text"))
    texts = texts.select(
        "doc_id",
        F.xxhash64(or_empty("text")).alias("text_hash"),
        F.size("words").cast("long").alias("n_words"),
        "words",
    )
    n = F.size("words")
    keys = [_keys(F.col("words"), n, length) for length in lengths]
    whole_key = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(WHOLE_KEYS).cast("bigint"))
    keyed = texts.select("*", F.concat(F.array(whole_key), *keys).alias("keys"))
    each = keyed.select("doc_id", "text_hash", "n_words", "words", F.posexplode("keys").alias("at", "key"))

    # The place in ``keys`` tells the length of a window and where it starts.
    start, length, before = F.lit(0), F.lit(0), F.lit(1)
    for own in lengths:
        here = F.col("at") >= before
        start, length = F.when(here, F.col("at") - before).otherwise(start), F.when(here, own).otherwise(length)
        before = before + F.greatest(F.size("words") - own + 1, F.lit(0))
    found = F.array_join(F.slice("words", start + 1, length), " ").alias("found")
    each = each.select("doc_id", "text_hash", "n_words", start.alias("start"), "key", found)
    hits = each.join(known, (each["key"] == known["key"]) & (each["found"] == known["window"]))
    is_hit = F.col("length") > 0
    return (
        hits.groupBy("doc_id", "text_hash", "n_words")
        .agg(
            F.count(F.when(~is_hit, True)).alias("repeats"),
            F.collect_set(F.when(is_hit, F.struct("start", "length"))).alias("hits"),
            F.collect_set(F.when(is_hit, F.col("item_id").cast("string"))).alias("items"),
        )
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            "hits",
            F.array_sort("items").alias("item_ids"),
            F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )


def hit_words(hits: str) -> Column:
    """Number of words in any of the windows found."""
    each = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))
    return F.size(F.array_distinct(F.flatten(each))).cast("long")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a window of an item; all columns stay."""
    id_name, hash_name = (unused_name(n, docs.columns) for n in ("bad_id", "bad_hash"))
    bad = find_windows(docs, benchmark, window).filter(F.size("hits") > 0)
    bad = bad.select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_name)) & (
        F.xxhash64(or_empty("text")) == F.col(hash_name)
    )
    return docs.join(bad, same, "left_anti")

"""The best matches of query vectors by whole-number inner product, exactly.

Exhaustive accumulation, a term at a time. A term is a component's place. Vectors lie
in blocks of bounded bytes; a block holds, for each term, the *postings* of its vectors
that have it: their places and weights. A query is a sparse row of terms and weights.
For each of its terms, the postings, times the query's weight, are added into a dense
array with one score for each vector of the block. A selection of the k highest scores
per query and block is what leaves a task; Spark ranks these by query.

Blocks and queries meet by an equi-join on the number of a *group* of blocks: a copy of
every query block, of bounded size too, goes to every group, so copies are as many as
groups and not as blocks. The join is a sort-merge join whatever sizes Spark expects: it
does not know how many copies there will be, and a broadcast would bring them all to the
driver. A task holds one group's blocks and takes one query block at a time; of each
query the k best of the group leave it.

Keys are whole numbers. Queries are rows whose key is divisible by ``every``; a row without key is none, but may
be found. A query's own row is left out by its place, so a repeated row finds its
double. Ties go to the smaller key, rows without key last; of equal keys to any. Rows
whose vector is null, empty, or holds null or non-finite components take no part, nor
do rows of another length than the first row's (see ``vectors.usable``). With fewer
candidates than k all are returned. An empty table, or one without queries, gives no
rows. Other columns are not read. Components beyond 2^26 after scaling are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm import vectors
from quotelake.llm.common import written


@dataclass(frozen=True)
class SearchConfig:
    """``queries``: query rows of a block; ``scores``: numbers of a dense score array;
    ``blocks``: most blocks of vectors in a group, which a task holds together."""

    scale: int = 1024
    every: int = 100
    k: int = 10
    queries: int = 4096
    scores: int = 262_144
    blocks: int = 32


DEFAULT = SearchConfig()

SPARSE = "starts binary, places binary, weights binary"


def sparse(values: np.ndarray) -> dict[str, pa.Array]:
    """Columns of a matrix that are not 0, row after row, as one row of a table."""
    row, place = np.nonzero(values)
    starts = np.searchsorted(row, np.arange(len(values) + 1))
    blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
    return {"starts": blob(starts, "<i4"), "places": blob(place, "<i4"), "weights": blob(values[row, place], "<i4")}


def _dense(starts: bytes, places: bytes, weights: bytes, width: int) -> np.ndarray:
    ends = np.frombuffer(starts, "<i4")
    found = np.zeros((len(ends) - 1, width), np.int64)
    found[np.repeat(np.arange(len(ends) - 1), np.diff(ends)), np.frombuffer(places, "<i4")] = np.frombuffer(weights, "<i4")
    return found


def accumulate(queries: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores of n vectors for each query row: postings of its terms, added up."""
    scores = np.zeros((len(queries), n), queries.dtype)
    for term, (places, weights) in enumerate(postings):
        having = np.flatnonzero(queries[:, term])
        if not len(having) or not len(places):
            continue
        added = np.multiply.outer(queries[having, term], weights)
        if len(places) == n and len(having) == len(queries):
            scores += added
        else:
            scores[np.ix_(having, places)] += added
    return scores


def highest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k highest scores; of equal ones the first."""
    n = scores.shape[1]
    if n <= k:
        row, column = np.indices(scores.shape)
        return row.ravel(), column.ravel()
    least = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > least
    row, column = np.nonzero(above)
    tie_row, tie_column = np.nonzero(scores == least)
    first = np.searchsorted(tie_row, np.arange(len(scores)))
    rank = np.arange(len(tie_row)) - first[tie_row]
    taken = rank < (k - above.sum(1))[tie_row]
    return np.r_[row, tie_row[taken]], np.r_[column, tie_column[taken]]


def _postings(starts: bytes, places: bytes, weights: bytes, kind: type) -> list[tuple[np.ndarray, np.ndarray]]:
    ends = np.frombuffer(starts, "<i4")
    at, w = np.frombuffer(places, "<i4"), np.frombuffer(weights, "<i4").astype(kind)
    return [(at[a:z], w[a:z]) for a, z in zip(ends, ends[1:])]


def top_matches(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cfg: SearchConfig = DEFAULT) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: each query's k highest scores."""
    rows = vectors.usable(df, key, vector)
    id_type = dict(df.select(key).dtypes)[key]
    shape = f"block int, ids array<{id_type}>, width int, {SPARSE}"
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).collect()[0]
    width, per_block = size["width"] or 0, vectors.rows_per_block(size["width"] or 0)
    n_blocks = -(-size["n"] // per_block) or 1
    # Blocks are dealt by row number, so that no key can make one large.
    numbered = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int"))

    def block(key_of: tuple, table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [(key, "ascending")], null_placement="at_end")
        table = table.take(order).combine_chunks()
        values = vectors.whole(table[vector].combine_chunks(), cfg.scale)
        ids = table[key].combine_chunks()
        return pa.table(
            {
                "block": pa.array([key_of[0].as_py()], pa.int32()),
                "ids": pa.ListArray.from_arrays([0, len(ids)], ids),
                "width": pa.array([width], pa.int32()),
                **sparse(values.T),
            }
        )

    blocks = written(numbered.groupBy("block").applyInArrow(block, shape), "posting-blocks")

    # A query row is known by its block and its place there.
    placed = blocks.select("block", F.posexplode("ids").alias("place", "id"))
    wanted = placed.filter(F.col("id") % cfg.every == 0)
    n_query_blocks = -(-wanted.count() // cfg.queries) or 1
    dealt = F.pmod(F.xxhash64("block", "place"), F.lit(n_query_blocks)).cast("int")
    query_blocks = _query_blocks(blocks, dealt, id_type, cfg)
    found = _matches(blocks, n_blocks, query_blocks, id_type, width, cfg)
    by = Window.partitionBy("query_id", "home", "place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= cfg.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _query_blocks(blocks: DataFrame, dealt: Column, id_type: str, cfg: SearchConfig) -> DataFrame:
    """The query rows of all blocks, many in one row, in numbered blocks."""
    query_shape = f"query_id {id_type}, block int, place int, terms binary"

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch["ids"][i].values
                here = [j for j, x in enumerate(ids.to_pylist()) if x is not None and x % cfg.every == 0]
                values = _dense(*(batch[c][i].as_py() for c in ("starts", "places", "weights")), len(ids)).T
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(here, pa.int64())),
                        pa.array([batch["block"][i].as_py()] * len(here), pa.int32()),
                        pa.array(here, pa.int32()),
                        pa.array([values[j].astype("<i4").tobytes() for j in here], pa.binary()),
                    ],
                    ["query_id", "block", "place", "terms"],
                )

    queries = blocks.mapInArrow(rows_of, query_shape)

    def query_block(key_of: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        values = np.frombuffer(b"".join(table["terms"].to_pylist()), "<i4").reshape(table.num_rows, -1)
        listed = lambda c: pa.ListArray.from_arrays([0, table.num_rows], table[c].combine_chunks())
        found = {"query_block": pa.array([key_of[0].as_py()], pa.int32())}
        return pa.table(found | {c: listed(c) for c in ("query_id", "block", "place")} | sparse(values))

    return written(
        queries.groupBy(dealt.alias("query_block")).applyInArrow(
            query_block, f"query_block int, query_id array<{id_type}>, block array<int>, place array<int>, {SPARSE}"
        ),
        "query-blocks",
    )


def best(found: pa.Table, k: int) -> pa.Table:
    """Each ``query``'s k first rows by score, then key, rows without key last."""
    order = [("query", "ascending"), ("score", "descending"), ("vec_id", "ascending")]
    found = found.take(pc.sort_indices(found, order, null_placement="at_end"))
    query = found["query"].to_numpy()
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return found.filter(pa.array(rank < k))


def _scored(row: pa.RecordBatch, width: int, cfg: SearchConfig) -> pa.Table:
    """Rows (query, vec_id, score): the k highest scores of a query block in a block of vectors."""
    ids, home_block = row["ids"][0].values, row["block"][0].as_py()
    homes, places = (np.asarray(row[c][0].values) for c in ("home", "query_place"))
    n = len(ids)
    queries = _dense(*(row[f"query_{c}"][0].as_py() for c in ("starts", "places", "weights")), width)
    stored = [row[c][0].as_py() for c in ("starts", "places", "weights")]
    weight = np.abs(np.frombuffer(stored[2], "<i4").astype(np.int64)).max(initial=0)
    # Scores have half the bytes where none can leave the range.
    small = int(np.abs(queries).max(initial=0)) * int(weight) * width < 2**31 - 1
    kind = np.int32 if small else np.int64
    postings = _postings(*stored, kind)
    step = max(1, cfg.scores // n)
    kept = {c: [] for c in ("query", "vec_id", "score")}
    for at in range(0, len(queries), step):
        scores = accumulate(queries[at : at + step].astype(kind), postings, n)
        home = np.flatnonzero(homes[at : at + step] == home_block)
        own = places[at : at + step][home]
        scores[home, own] = np.iinfo(kind).min
        query, column = highest(scores, cfg.k)
        value = scores[query, column].astype(np.int64)
        # A row's own place is no match, also where all are taken.
        others = value != np.iinfo(kind).min
        query, column, value = query[others] + at, column[others], value[others]
        kept["query"].append(pa.array(query, pa.int32()))
        kept["vec_id"].append(ids.take(pa.array(column)))
        kept["score"].append(pa.array(value, pa.int64()))
    return pa.table({c: pa.chunked_array(x) for c, x in kept.items()})


def _matches(blocks: DataFrame, n_blocks: int, query_blocks: DataFrame, id_type: str, width: int, cfg: SearchConfig) -> DataFrame:
    """Each query's k highest scores in each group of blocks of vectors."""
    found_shape = f"query_id {id_type}, home int, place int, vec_id {id_type}, score long"

    def rows_of(row: pa.RecordBatch, found: pa.Table) -> list[pa.RecordBatch]:
        of = lambda c: row[c][0].values.take(found["query"].combine_chunks())
        columns = [of("query_id"), of("home"), of("query_place"), found["vec_id"], found["score"]]
        return pa.table(columns, ["query_id", "home", "place", "vec_id", "score"]).combine_chunks().to_batches()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A query block meets its group's blocks one after another.
        before, found = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                same = before is not None and all(row[c][0] == before[c][0] for c in ("group", "query_block"))
                if before is not None and not same:
                    yield from rows_of(before, found)
                    found = None
                here = _scored(row, width, cfg)
                found = here if found is None else best(pa.concat_tables([found, here]), cfg.k)
                before = row
        if before is not None:
            yield from rows_of(before, found)

    asked = query_blocks.select(
        "query_block",
        "query_id",
        F.col("block").alias("home"),
        F.col("place").alias("query_place"),
        *(F.col(c).alias(f"query_{c}") for c in ("starts", "places", "weights")),
    )
    # No larger than a task can hold, no fewer than can be worked on at once.
    at_once = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_groups = min(n_blocks, max(at_once, -(-n_blocks // cfg.blocks)))
    grouped = blocks.withColumn("group", F.pmod("block", F.lit(n_groups)))
    # Every query block goes to every group of vector blocks by the group's number.
    sent = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    pairs = sent.hint("merge").join(grouped, "group")
    return pairs.mapInArrow(match, found_shape)

"""Codes of vectors from per-part codebooks, fitted with Drake-Hamerly bounds.

A vector of whole numbers is cut into equal consecutive parts; each part position has
a codebook. A round assigns every part to its nearest entry and moves the entries to
the floors of their parts' means. Between rounds each part keeps its b closest entries
in order, a lower bound of its distance to each of them and beyond (``low``), one outer
bound for all the rest (``outer``) and an upper bound of its distance to its own entry
(``high``). Entries that move by d change these by d. A part whose upper bound stays
under the next lower bound keeps its entry without a distance; else the leading entries
up to the first bound that is certain are compared as whole numbers, and all entries
where no bound is. Bounds are stored as floats rounded to the safe side. b adapts for
each block of vectors: down to the most entries a round needed, and doubled, with all
distances computed again, where an eighth of the parts found no bound.

The blocks of a round are a table in the shared folder; the next round reads it, and a
lost executor's blocks are computed again from it. Sums and counts of entries are part
of the blocks and added by Spark; only these (one number for each component of the
codebooks) and the codebooks pass through the driver.

Rows whose vector is null, empty, or holds null or non-finite components are dropped,
and so are rows of another length than the first row's (see ``vectors.usable``). A
length that is not a multiple of the parts gives some parts one component more. With
fewer rows than entries the codebooks are smaller. Rows without vec_id count as the
last; repeated rows count each time. Ties of distance go to the lower entry. Labels
may be null. An empty table gives no rows and empty codebooks. Other columns are not
read. Components beyond 2^26 after scaling are refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm import vectors
from quotelake.llm.common import removed, written


@dataclass(frozen=True)
class CodeConfig:
    """``near``: b of the first round; ``again``: share of parts without a bound from
    which on b is doubled."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    near: int = 4
    again: float = 0.125


DEFAULT = CodeConfig()


@dataclass
class Bounds:
    """Of n parts: entries ``near`` (n, b) from the closest on, ``low`` (n, b), of which
    the first column is not used, ``outer`` (n) and ``high`` (n)."""

    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray
    high: np.ndarray

    def pack(self) -> bytes:
        return self.near.astype("<u2").tobytes() + np.column_stack([self.low, self.outer, self.high]).astype("<f4").tobytes()

    @classmethod
    def unpack(cls, data: bytes, n: int) -> Bounds:
        b = (len(data) // n - 8) // 6
        near = np.frombuffer(data, "<u2", n * b).reshape(n, b).astype(np.int64)
        numbers = np.frombuffer(data, "<f4", offset=2 * n * b).reshape(n, b + 2).astype(np.float64)
        return cls(near, numbers[:, :b], numbers[:, b], numbers[:, b + 1])


def _up(x: np.ndarray) -> np.ndarray:
    """Single-precision floats that are surely not below ``x``."""
    return np.nextafter(np.nextafter(x.astype(np.float32), np.float32(np.inf)), np.float32(np.inf)).astype(np.float64)


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(-np.inf)).astype(np.float64)


def squares(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances as whole numbers; both have components last."""
    gaps = parts - entries
    return np.einsum("...i,...i->...", gaps, gaps)


def fresh_bounds(parts: np.ndarray, book: np.ndarray, b: int) -> Bounds:
    """All distances, the b closest entries and the bounds they give."""
    far = squares(parts[:, None, :], book[None])
    order = np.argsort(far, axis=1, kind="stable")
    roots = np.sqrt(np.take_along_axis(far, order, 1).astype(np.float64))
    low = _down(roots)
    outer = low[:, b] if b < len(book) else np.full(len(parts), np.inf)
    return Bounds(order[:, :b], low[:, :b], outer, _up(roots[:, 0]))


def moved_bounds(parts: np.ndarray, book: np.ndarray, drift: np.ndarray, old: Bounds, cfg: CodeConfig) -> Bounds:
    """Bounds after the entries moved by ``drift``, each part with its nearest entry."""
    b, n = old.near.shape[1], len(parts)
    moves = drift[old.near]
    low = _down(old.low - moves)
    outer = _down(old.outer - drift.max(initial=0.0))
    high = _up(old.high + moves[:, 0])
    # Ordered: a bound holds for its entry and all behind it.
    low = np.minimum(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1], outer[:, None])
    first = lambda high, low, outer: np.argmax(
        np.column_stack([high[:, None] < low[:, 1:], high < outer, np.ones(len(high), bool)]), axis=1
    )
    # Leading entries to compare: up to the first certain bound; b + 1 where none is.
    need = first(high, low, outer) + 1
    unsure = np.flatnonzero(need > 1)
    if len(unsure):
        own = np.sqrt(squares(parts[unsure], book[old.near[unsure, 0]]).astype(np.float64))
        high[unsure] = _up(own)
        need[unsure] = first(high[unsure], low[unsure], outer[unsure]) + 1
    near = old.near.copy()
    for z in range(2, b + 1):
        some = np.flatnonzero(need == z)
        if len(some):
            lead = near[some, :z]
            far = squares(parts[some][:, None, :], book[lead])
            order = np.lexsort((lead, far))
            roots = np.sqrt(np.take_along_axis(far, order, 1).astype(np.float64))
            near[some, :z] = np.take_along_axis(lead, order, 1)
            low[some, :z] = _down(roots)
            high[some] = _up(roots[:, 0])
    lost = np.flatnonzero(need == b + 1)
    if len(lost) > cfg.again * n and b < len(book):
        return fresh_bounds(parts, book, min(2 * b, len(book)))
    if len(lost):
        new = fresh_bounds(parts[lost], book, b)
        near[lost], low[lost], outer[lost], high[lost] = new.near, new.low, new.outer, new.high
    low = np.minimum(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1], outer[:, None])
    kept = min(b, max(int(need[need <= b].max(initial=1)), len(book) // 8, 1))
    if kept < b:
        outer, low, near = low[:, kept].copy(), low[:, :kept], near[:, :kept]
    return Bounds(near, low, outer, high)


def _edges(length: int, parts: int) -> list[int]:
    return [length * i // parts for i in range(parts + 1)]


def _sums(values: np.ndarray, own: np.ndarray, k: int, cuts: list[int]) -> np.ndarray:
    """For every part and entry: the number of its parts, then their sums."""
    found = []
    for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
        table = np.zeros((k, z - a + 1), np.int64)
        np.add.at(table[:, 1:], own[:, i], values[:, a:z])
        table[:, 0] = np.bincount(own[:, i], minlength=k)
        found.append(table.ravel())
    return np.concatenate(found)


def _block(values: np.ndarray, books: list, drifts: list | None, old: list, cfg: CodeConfig) -> tuple[list, np.ndarray, np.ndarray]:
    """New bounds of a block's parts, their entries, and the squared distances in all."""
    cuts, found = _edges(values.shape[1], cfg.parts), []
    own = np.empty((len(values), cfg.parts), np.int64)
    error = np.zeros(len(values), np.int64)
    for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
        part, book = values[:, a:z], books[i]
        if drifts is None:
            bounds = fresh_bounds(part, book, min(cfg.near, len(book)))
        else:
            bounds = moved_bounds(part, book, drifts[i], Bounds.unpack(old[i], len(values)), cfg)
        own[:, i] = bounds.near[:, 0]
        error += squares(part, book[own[:, i]])
        found.append(bounds.pack())
    return found, own, error


def _drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return _up(np.sqrt(squares(old, new).astype(np.float64)))


def fit_codes(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cfg: CodeConfig = DEFAULT) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows ``(vec_id, label, code, error)`` and the final codebooks, one for each part.

    ``code`` has two hex digits for each part, the first part's first.
    """
    rows = vectors.usable(df, key, vector, label)
    seeds = rows.orderBy(F.col(key).isNull(), key, vector).limit(cfg.entries).select(vector).toArrow().column(0)
    start = vectors.whole(seeds.combine_chunks(), cfg.scale)
    length, k = start.shape[1] if len(start) else 0, len(start)
    cuts = _edges(length, cfg.parts)
    books = [start[:, a:z] for a, z in zip(cuts, cuts[1:])]
    types = dict(df.select(key, label).dtypes)
    shape = f"row_key array<{types[key]}>, row_label array<{types[label]}>, `values` binary, bounds array<binary>, own binary, error binary, sums binary"
    limit = vectors.rows_per_block(length)

    def entry(keys: pa.Array, labels: pa.Array, values: np.ndarray, old: list, books: list, drifts: list | None) -> dict:
        bounds, own, error = _block(values, books, drifts, old, cfg)
        return {
            "row_key": pa.ListArray.from_arrays([0, len(keys)], keys),
            "row_label": pa.ListArray.from_arrays([0, len(labels)], labels),
            "values": pa.array([values.astype("<i4").tobytes()], pa.binary()),
            "bounds": pa.array([bounds], pa.list_(pa.binary())),
            "own": pa.array([own.astype("<u2").tobytes()], pa.binary()),
            "error": pa.array([error.astype("<i8").tobytes()], pa.binary()),
            "sums": pa.array([_sums(values, own, k, cuts).astype("<i8").tobytes()], pa.binary()),
        }

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, limit):
                some = batch.slice(at, limit)
                values = vectors.whole(some[vector], cfg.scale)
                yield pa.RecordBatch.from_pydict(entry(some[key], some[label], values, [], books, None))

    def go_on(books: list, drifts: list):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    values = np.frombuffer(batch["values"][i].as_py(), "<i4").reshape(-1, length).astype(np.int64)
                    keys, labels, old = batch["row_key"][i].values, batch["row_label"][i].values, batch["bounds"][i].as_py()
                    yield pa.RecordBatch.from_pydict(entry(keys, labels, values, old, books, drifts))

        return step

    blocks = written(rows.mapInArrow(begin, shape), "vector-blocks")
    for _ in range(cfg.rounds if k else 0):
        totals = _added(blocks, sum(k * (z - a + 1) for a, z in zip(cuts, cuts[1:])))
        new, at = [], 0
        for book in books:
            size = k * (book.shape[1] + 1)
            table = totals[at : at + size].reshape(k, -1)
            used = table[:, :1] > 0
            new.append(np.where(used, table[:, 1:] // np.maximum(table[:, :1], 1), book))
            at += size
        drifts = [_drift(a, b) for a, b in zip(books, new)]
        books = new
        before, blocks = blocks, written(blocks.mapInArrow(go_on(books, drifts), shape), "vector-blocks")
        removed(before)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch["own"][i].as_py(), "<u2").reshape(-1, cfg.parts)
                shown = ["".join(map("{:02x}".format, row)) for row in own.tolist()]
                error = np.frombuffer(batch["error"][i].as_py(), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch["row_key"][i].values, batch["row_label"][i].values, pa.array(shown, pa.string()), pa.array(error, pa.int64())],
                    [key, label, "code", "error"],
                )

    shown = f"`{key}` {types[key]}, `{label}` {types[label]}, code string, error long"
    return blocks.mapInArrow(codes, shown), books


def _added(blocks: DataFrame, size: int) -> np.ndarray:
    """The blocks' sums added up: first within a task, then by place in the table."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for sums in batch["sums"]:
                total += np.frombuffer(sums.as_py(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["place", "total"])

    added = blocks.select("sums").mapInArrow(task, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    found = added.toArrow()
    total = np.zeros(size, np.int64)
    total[np.asarray(found["place"])] = np.asarray(found["total"])
    return total


def codebook_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    numbers = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def with_label_error(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` with the errors of each label summed; rows without label are one.

    The sums are one row a label. Rows of a frequent label need not meet in one task:
    they are summed where they are, and the join is skewed on one side only, which
    adaptive execution splits (or it sends the sums to the rows where these are few).
    """
    totals = codes.groupBy(F.col(label).alias("of_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, codes[label].eqNullSafe(totals["of_label"])).drop("of_label")

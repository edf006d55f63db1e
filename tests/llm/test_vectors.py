"""Vector codes and exact search against plain versions."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quotelake.llm import top_k, vector_codes, vectors

SHAPE = "vec_id bigint, embedding array<float>, label int, code string, block int, rank int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, m, "x", 1, 2) for i, v, m in rows], SHAPE).repartition(parts)


def random_rows(seed, n, length=16, spread=3):
    """Vectors around a few centres, with many ties and repeated vectors."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(5)]
    rows = []
    for i in range(n):
        vector = [x + rng.randint(-spread, spread) / 16 for x in rng.choice(centres)]
        if rows and rng.random() < 0.3:
            vector = rng.choice(rows)[1]
        rows.append((i * 5, vector, rng.choice([None, 1, 2, 3])))
    return rows


ODD = [
    (3, None, 1),
    (4, [], 1),
    (6, [None] * 16, 1),
    (7, [math.nan] + [0.0] * 15, 1),
    (8, [math.inf] + [0.0] * 15, None),
    (9, [1.0] * 15, 2),
]


def single(x):
    return float(np.float32(x))


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * single(x)) for x in v], m) for i, v, m in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    found = [(i, m, "".join(f"{k:02x}" for _, k in o), sum(d for d, _ in o)) for (i, _, m), o in zip(kept, own)]
    return found, books


@pytest.mark.parametrize("seed,n,near", [(1, 200, 4), (2, 90, 1), (3, 9, 4), (4, 150, 16)])
def test_codes(spark, seed, n, near):
    rows = random_rows(seed, n)
    rows += [rows[0], (None, rows[1][1], None)]
    cfg = vector_codes.CodeConfig(near=near)
    found, books = vector_codes.fit_codes(frame(spark, rows + ODD), cfg=cfg)
    expected, plain_books = plain_codes(rows)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected, key=key)
    assert [b.tolist() for b in books] == plain_books
    totals = defaultdict(int)
    for _, label, _, error in expected:
        totals[label] += error
    shown = vector_codes.with_label_error(found).collect()
    assert len(shown) == len(rows)
    assert all(r["label_error"] == totals[r["label"]] for r in shown)


@pytest.mark.parametrize("b", [1, 2, 5, 16])
def test_bounds_hold_and_spare_distances(monkeypatch, b):
    rng = np.random.default_rng(b)
    cfg = vector_codes.CodeConfig()
    book = rng.integers(-400, 400, (16, 4))
    parts = book[rng.integers(0, 16, 3000)] + rng.integers(-30, 31, (3000, 4))
    bounds = vector_codes.fresh_bounds(parts, book, b)
    measured, whole = [], vector_codes.squares
    monkeypatch.setattr(vector_codes, "squares", lambda p, e: measured.append(np.broadcast_shapes(p.shape, e.shape)) or whole(p, e))
    for step in (0, 3, 12, 60):
        new = book + rng.integers(-step, step + 1, book.shape)
        drift = vector_codes._drift(book, new)
        book = new
        measured.clear()
        bounds = vector_codes.moved_bounds(parts, book, drift, bounds, cfg)
        spent = sum(int(np.prod(shape[:-1])) for shape in measured)
        if step <= 3 and b > 1:
            assert spent < len(parts) * 16 / 4
        far = whole(parts[:, None], book[None])
        assert (bounds.near[:, 0] == far.argmin(1)).all()
        real = np.sqrt(far)
        assert (bounds.high >= real.min(1)).all()
        assert (bounds.low <= np.take_along_axis(real, bounds.near, 1)).all()
        rest = np.ones(far.shape, bool)
        np.put_along_axis(rest, bounds.near, False, 1)
        assert (~rest | (bounds.outer[:, None] <= real)).all()
        bounds = vector_codes.Bounds.unpack(bounds.pack(), len(parts))


def test_b_adapts():
    rng = np.random.default_rng(5)
    cfg, book = vector_codes.CodeConfig(), rng.integers(-400, 400, (16, 4))
    parts = rng.integers(-500, 500, (500, 4))
    still = vector_codes.moved_bounds(parts, book, np.zeros(16), vector_codes.fresh_bounds(parts, book, 8), cfg)
    assert still.near.shape[1] == 2
    moved = rng.integers(-400, 400, (16, 4))
    wild = vector_codes.moved_bounds(parts, moved, vector_codes._drift(book, moved), vector_codes.fresh_bounds(parts, book, 3), cfg)
    assert wild.near.shape[1] == 6


def plain_matches(rows, every=100, k=10):
    kept = [(i, [math.floor(1024 * single(x)) for x in v]) for i, v, _ in rows]
    found = []
    for n, (query, a) in enumerate(kept):
        if query is None or query % every:
            continue
        scores = [(-sum(map(lambda x, y: x * y, a, b)), i is None, i or 0) for m, (i, b) in enumerate(kept) if m != n]
        for rank, (score, none, i) in enumerate(sorted(scores)[:k], 1):
            found.append((query, rank, None if none else i, -score))
    return found


@pytest.mark.parametrize("seed,n,queries,scores", [(1, 400, 4096, 262_144), (2, 300, 3, 64), (3, 8, 4096, 64)])
def test_matches(spark, monkeypatch, seed, n, queries, scores):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 8_000)
    rows = random_rows(seed, n)
    # Few components that are not 0, all equal ones, and a repeated query.
    rows += [(1100 + 100 * i, [0.0] * 15 + [i / 4], 0) for i in range(4)]
    rows += [rows[0], (None, rows[1][1], None)]
    cfg = top_k.SearchConfig(queries=queries, scores=scores)
    found = top_k.top_matches(frame(spark, rows + ODD), cfg=cfg)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_matches(rows), key=str)


def test_no_vectors_and_no_queries(spark):
    for rows in ([], ODD[:2]):
        codes, books = vector_codes.fit_codes(frame(spark, rows))
        assert vector_codes.with_label_error(codes).count() == 0
        assert sum(b.size for b in books) == 0
        assert top_k.top_matches(frame(spark, rows)).count() == 0
    assert top_k.top_matches(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)])).count() == 0
    one = top_k.top_matches(frame(spark, [(100, [1.0], 1)]))
    assert one.count() == 0


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="not supported"):
        top_k.top_matches(frame(spark, [(100, [1e30], 1), (2, [1.0], 1)])).count()


def test_search_sends_each_pair_of_blocks_to_one_group(spark):
    plan = top_k.top_matches(frame(spark, random_rows(1, 50)))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_search_gathers_no_copies_of_queries(spark):
    """Spark cannot know how many copies of the query blocks there are, so none may be broadcast."""
    plan = top_k.top_matches(frame(spark, random_rows(1, 50)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("blocks,partitions", [(1, 1), (3, 1), (32, 2)])
def test_matches_by_groups_of_blocks(spark, monkeypatch, blocks, partitions):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 4_000)
    rows = random_rows(6, 330)
    rows += [rows[0], (None, rows[0][1], None), (None, rows[20][1], None)]
    cfg = top_k.SearchConfig(queries=3, scores=64, blocks=blocks)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = top_k.top_matches(frame(spark, rows), cfg=cfg).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, found), key=str) == sorted(plain_matches(rows), key=str)


def test_best_of_ties():
    found = pa.table(
        {
            "query": pa.array([1, 0, 0, 1, 0, 0], pa.int32()),
            "vec_id": pa.array([4, None, 7, 2, 3, 9], pa.int64()),
            "score": pa.array([5, 8, 8, 5, 8, 9], pa.int64()),
        }
    )
    assert [tuple(r.values()) for r in top_k.best(found, 2).to_pylist()] == [(0, 9, 9), (0, 3, 8), (1, 2, 5), (1, 4, 5)]
    assert top_k.best(found, 4)["vec_id"].to_pylist() == [9, 3, 7, None, 2, 4]

"""Near-duplicates by shingle sets against all pairs of a small table."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa

from quotelake.llm import simhash_sets


def plain_groups(texts, words=5, similarity=0.8):
    """Sets of linked pairs and the smallest number reachable from each text."""
    sets = []
    for text in texts:
        found = (text or "").lower().split()
        last = max(1, len(found) - words + 1)
        sets.append({tuple(found[i : i + words]) for i in range(last)} if found else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    linked = set()
    for a, b in combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] == sets[b] or common >= similarity * (len(sets[a]) + len(sets[b]) - common) > 0:
            linked.add((a, b))
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return linked, [find(i) for i in range(len(texts))]


def near_copies(seed, bases, copies):
    """Texts of 80 to 300 words, each followed by copies with up to six words changed."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(bases):
        base = rng.choices(words, k=rng.randint(80, 300))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, copies)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def groups_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = simhash_sets.near_groups(rows).collect()
    assert len(found) == len(texts)
    return {r["doc_id"]: r["component_id"] for r in found}


def test_groups_against_all_pairs(spark):
    texts = near_copies(5, 60, 4) + ["", None, "  ", "three words only", "Three words ONLY"]
    linked, expected = plain_groups(texts)
    found = groups_of(spark, texts)
    together = sum(found[a] == found[b] for a, b in linked)
    assert len(linked) > 80 and together >= 0.9 * len(linked)
    # What is put together hangs together over links: no pair below 0.8 joins groups.
    assert all(expected[i] == expected[found[i]] for i in found)
    assert found[len(texts) - 1] == found[len(texts) - 2]
    assert len({found[i] for i in range(len(texts) - 5, len(texts) - 2)}) == 1


def test_a_large_group_keeps_one(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(200)] = f"c{i}"
        texts.append(" ".join(copy))
    assert set(groups_of(spark, texts).values()) == {0}
    pairs = simhash_sets.candidates(
        spark.createDataFrame(
            [
                (simhash_sets._digest(s), np.frombuffer(simhash_sets.ring(s), ">i8").tolist())
                for s in (simhash_sets.shingle_set(t.encode(), 5) for t in texts)
            ],
            "node binary, ring array<bigint>",
        )
    )
    assert pairs.count() < 0.5 * 400 * 399 / 2


def test_leaders_go_on_over_batches():
    rng = np.random.default_rng(1)
    chains = np.sort(rng.integers(0, 6, 300)).astype(np.uint64)
    words = np.sort((chains << np.uint64(32)) | (rng.integers(0, 1 << 32, 300, np.uint64) & np.uint64(0xFF0F)))
    rows = pa.RecordBatch.from_arrays(
        [pa.array(words.view(np.int64)), pa.array(rng.permutation(300))], names=["word", "short"]
    )

    def links(size):
        parts = (rows.slice(i, size) for i in range(0, 300, size))
        return sorted(
            pair for b in simhash_sets.stars(parts) for pair in zip(*(c.to_pylist() for c in b.columns))
        )

    assert len(links(300)) > 100
    assert all(links(size) == links(300) for size in (1, 7, 64))


def test_ring_by_plain_votes():
    shingles = simhash_sets.shingle_set(" ".join(map(str, range(700))).encode(), 5)
    votes = np.zeros(1024, int)
    for value in shingles.tolist():
        for place, odd in enumerate(simhash_sets._ODD.tolist()):
            mixed = value * odd % 2**64
            mixed = (mixed ^ (mixed >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
            mixed ^= mixed >> 32
            bits = "".join(f"{byte:08b}" for byte in mixed.to_bytes(8, "little"))
            votes[64 * place : 64 * place + 64] += np.array(list(bits), int)
    assert simhash_sets.ring(shingles) == np.packbits(votes * 2 > len(shingles)).tobytes()


def pairs_at_the_edge(seed, bases):
    """Texts of 60 to 200 words and copies of about 0.8, that lead no chain together."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(bases):
        base = rng.choices(words, k=rng.randint(60, 200))
        texts.append(" ".join(base))
        copy = list(base)
        for at in range(5, len(base) - 5, len(base) // max(1, round(len(base) * 0.0222) - rng.randint(0, 1))):
            copy[at] = rng.choice(words)
        texts.append(" ".join(copy))
    return texts


def test_no_pair_is_left_to_chance(spark):
    texts = pairs_at_the_edge(11, 400)
    linked, expected = plain_groups(texts)
    assert len(linked) > 150
    assert groups_of(spark, texts) == dict(enumerate(expected))


def test_a_member_without_a_leader_is_found(spark, monkeypatch):
    """Also if chains find nothing at all, and with many small buckets."""
    monkeypatch.setattr(simhash_sets, "BUCKET", 2_000)
    monkeypatch.setattr(simhash_sets, "PAIRS", 7)
    nothing = lambda nodes: nodes.selectExpr("node as low", "node as high").limit(0)
    monkeypatch.setattr(simhash_sets, "candidates", nothing)
    texts = [*near_copies(8, 25, 5), "", None, "  ", "three words only", "Three words ONLY", "three words only then"]
    linked, expected = plain_groups(texts)
    assert len(linked) > 50
    assert groups_of(spark, texts) == dict(enumerate(expected))


def test_one_key_over_batches():
    rng = np.random.default_rng(4)
    n = 300
    key, root = np.sort(rng.integers(0, 9, n)), rng.integers(0, 4, n)
    order = np.lexsort((root, key))
    rows = pa.RecordBatch.from_pydict(
        {"key": key[order], "root": root[order], "short": np.arange(n), "size": np.full(n, 100), "place": np.zeros(n, int)}
    )
    expected = {(a, b) for a, b in combinations(range(n), 2) if key[order][a] == key[order][b] and root[order][a] != root[order][b]}

    def found(size):
        parts = (rows.slice(i, size) for i in range(0, n, size))
        return [p for x in simhash_sets._crossing(0.8)(parts) for p in zip(*(c.to_pylist() for c in x.columns))]

    for size in (1, 17, n):
        assert len(found(size)) == len(expected) and set(found(size)) == expected


def test_sizes_and_places_rule_pairs_out():
    def found(sizes, places):
        rows = {"key": [5, 5], "root": [1, 2], "short": [1, 2], "size": sizes, "place": places}
        batch = pa.RecordBatch.from_pydict({n: np.array(x) for n, x in rows.items()})
        return sum(x.num_rows for x in simhash_sets._crossing(0.8)([batch]))

    assert found([80, 100], [0, 20]) == found([9, 9], [1, 1]) == 1
    assert found([79, 100], [0, 0]) == found([80, 100], [1, 0]) == found([9, 9], [2, 0]) == 0

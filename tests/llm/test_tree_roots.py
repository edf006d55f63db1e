"""Roots of the near-duplicate stage's trees, and how many rows its groups take."""

import random

from quotelake.llm import simhash_sets


def linked(spark, pairs):
    return spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "low binary, high binary")


def test_tree_roots(spark):
    rng = random.Random(2)
    parents = {i: rng.randrange(max(0, i - 3), i) for i in range(1, 120) if i % 17}
    parents |= {i: i - 1 for i in range(121, 200)}

    def root(i):
        return root(parents[i]) if i in parents else i

    found = simhash_sets.tree_roots(linked(spark, [(low, high) for high, low in parents.items()])).collect()
    assert {(r["node"][0], r["root"][0]) for r in found} == {(i, root(i)) for i in parents}
    assert len(found) == len(parents)
    assert simhash_sets.tree_roots(linked(spark, []).limit(0)).count() == 0


def test_a_large_group_spreads_no_labels(spark, monkeypatch):
    rng, spread = random.Random(4), []
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(200)] = f"c{i}"
        texts.append((i, " ".join(copy)))
    kept = simhash_sets.components
    monkeypatch.setattr(
        simhash_sets, "components", lambda nodes, links: spread.append(links.count()) or kept(nodes, links)
    )
    found = simhash_sets.near_groups(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r["component_id"] for r in found} == {0}
    # Each text was in as many rows of every round; now only trees that meet are.
    assert sum(spread) < 100

"""Counts by sorted word pointers, shares and divergences against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotelake.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
ASCII = {c: c + 32 for c in range(65, 91)}
texts = st.lists(
    st.one_of(st.none(), st.text(alphabet="abAB é漢\0.x1", max_size=40), st.text(max_size=20)), max_size=12
)


def terms_of(text):
    return TERM.findall((text or "").translate(ASCII))


def plain_counts(texts, groups):
    found = defaultdict(lambda: [0, 0])
    for text, group in zip(texts, groups):
        for term, n in Counter(terms_of(text)).items():
            found[term, group][0] += n
            found[term, group][1] += 1
    return {k: tuple(v) for k, v in found.items()}


def counted(texts, groups, n):
    terms, group, n, docs = divergence.shard_counts(pa.array(texts, pa.string()), np.array(groups, np.int64), n)
    rows = list(zip(terms.to_pylist(), group.tolist(), n.tolist(), docs.tolist()))
    assert len({r[:2] for r in rows}) == len(rows)
    return {(t, g): (n, d) for t, g, n, d in rows}


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 40))
def test_shard_counts(found, few):
    groups = [i % 3 for i in range(len(found))]
    before, divergence.FEW = divergence.FEW, few
    try:
        assert counted(found, groups, 3) == plain_counts(found, groups)
    finally:
        divergence.FEW = before


@pytest.mark.parametrize("few", [1, 7, 1000])
def test_pointers_are_sorted_by_their_bytes(monkeypatch, few):
    monkeypatch.setattr(divergence, "FEW", few)
    rng = random.Random(few)
    stems = ["", "a", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "é", "漢字漢字漢字"]
    words = [rng.choice(stems) + rng.choice(stems) + rng.choice("abz") for _ in range(3000)]
    folded, starts, lengths, _ = divergence.word_pointers(pa.array([" ".join(words[:1500]), " ".join(words[1500:])]))
    order, begins = divergence.pointer_sort(folded, starts, lengths)
    shown = [bytes(folded[a : a + n]) for a, n in zip(starts[order], lengths[order])]
    assert shown == sorted(w.encode() for w in words)
    assert begins.tolist() == [i == 0 or shown[i] != shown[i - 1] for i in range(len(shown))]
    # Equal terms keep the order of the text.
    assert all(a < b for a, b, new in zip(order, order[1:], begins[1:]) if not new)


SHAPE = "doc_id bigint, text string, lang string, source string, term string, n int, docs int, value string"


def plain_divergence(rows, least=3, ranks=200, scale=10**9):
    found, docs = [], defaultdict(set)
    count, everywhere = defaultdict(Counter), defaultdict(Counter)
    groups = {(r[2] or "", r[3] or "") for r in rows}
    for k, r in enumerate(rows):
        for term in terms_of(r[1]):
            docs[r[2] or "", term].add(k)
            count[r[2] or "", r[3] or ""][term] += 1
            everywhere[r[2] or ""][term] += 1
    for lang, source in groups:
        kept = [t for t in everywhere[lang] if len(docs[lang, t]) >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return [1 + scale * (counts[t] + 1) // total for t in kept]

        gap = lambda p, q: (p - q) * (p - q) // q
        p, q = shares(count[lang, source]), shares(everywhere[lang])
        parts = {
            "pair": [
                (sum(map(gap, p, shares(count[lang, s]))), s) for x, s in groups if x == lang and s != source
            ],
            "term": [
                (gap(a, b), t) for a, b, t in zip(p, q, kept) if count[lang, source][t] and a > b
            ],
        }
        for part, values in parts.items():
            values.sort(key=lambda v: (-v[0], v[1].encode()))
            for rank, (value, item) in enumerate(values[: ranks if part == "term" else None], 1):
                found.append((lang, source, part, item, value, rank))
    return found


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 4))) for _ in range(40)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 30)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None]), rng.choice(["s1", "s1", "s2", "s3", None, ""])))
    rows += [(None, None, None, None), (7, "", "de", "s9"), (7, "one", "de", "s8"), (8, "word " * 50_000 + "zoë", "it", "s1")]
    rows += rows[:3]
    return rows


@pytest.mark.parametrize("seed,shard,ranks", [(1, 8_000_000, 200), (2, 100, 3)])
def test_divergence(spark, seed, shard, ranks):
    rows = corpus(seed, 120)
    frame = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SHAPE).repartition(3)
    cfg = divergence.DivergenceConfig(shard_bytes=shard, ranks=ranks)
    found = sorted(map(tuple, divergence.divergence(frame, cfg).collect()))
    assert found == sorted(plain_divergence(rows, ranks=ranks))


def test_an_empty_table_gives_no_rows(spark):
    assert divergence.divergence(spark.createDataFrame([], SHAPE)).count() == 0

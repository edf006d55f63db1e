"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotelake.llm import (
    decontamination,
    language_model,
    order_minhash,
    packing,
    quality,
    secrets,
    simhash,
    simhash_sets,
    suffix_dedup,
    token_files,
    url_filters,
)
from quotelake.session import new_path

#: Extra columns bear names that the operators use themselves.
SHAPE = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "bits bigint, words int, ids string, gone string, secrets int, spans string, doc string"
)
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = "alpha beta gamma delta " * 30_000


def rows(texts):
    return [
        (i, t, "en", "s", None if t is None else len(t), 1, 2, "x", "y", 3, "z", "d") for i, t in texts
    ]


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (5, "one"), (None, "two words")]
    return spark.createDataFrame(rows([*texts, (7, LONG), (None, None)]), SHAPE).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "one"), (2, None), (3, ""), (None, "two words")], "item_id bigint, text string"
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1, 0), (7, 0, None), (None, 0, 1), (4, 1, 0)], "doc_id bigint, quality int, toxic int"
    )


def per_document(spark, labels, items):
    ids = lambda df: df.select("doc_id")
    return {
        "lm": lambda d: ids(language_model.score_documents(d)),
        "quality": lambda d: ids(quality.judge(d, labels)),
        "suffix": lambda d: ids(suffix_dedup.remove_repeats(d)),
        "windows": lambda d: ids(decontamination.find_windows(d, items)),
        "simhash": lambda d: ids(simhash.near_duplicates(d)),
        "sets": lambda d: ids(simhash_sets.near_groups(d)),
        "minhash": lambda d: ids(order_minhash.edited_fingerprints(d)),
        "secrets": lambda d: ids(secrets.scan_secrets(d)),
        "masked": lambda d: ids(secrets.mask_secrets(d)),
        "tokens": lambda d: ids(written_and_read(spark, d)),
    }


def written_and_read(spark, docs):
    folder = new_path(spark, "ids")
    token_files.write_token_ids(docs, folder, BYTE_BPE)
    return token_files.with_starts(token_files.token_digests(spark, folder))


NAMES = ["lm", "quality", "suffix", "windows", "simhash", "sets", "minhash", "secrets", "masked", "tokens"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_its_result(spark, odd, labels, items, name):
    found = per_document(spark, labels, items)[name](odd).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    assert sorted(found, key=key) == sorted(odd.select("doc_id").collect(), key=key)


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_table_gives_no_rows(spark, none, labels, items, name):
    assert per_document(spark, labels, items)[name](none).count() == 0


@pytest.mark.parametrize("most", [decontamination.BROADCAST_WINDOWS, -1])
def test_an_empty_benchmark_hits_nothing(spark, odd, items, most):
    """Items without words too; every row has its own result."""
    for bench in (items.limit(0), items.filter("item_id in (2, 3)")):
        found = decontamination.find_windows(odd, bench, broadcast_windows=most)
        assert found.count() == odd.count()
        assert found.filter("size(hits) > 0 or size(item_ids) > 0").count() == 0
        assert decontamination.remove_contaminated(odd, bench).count() == odd.count()


@pytest.mark.parametrize("empty", [(), ("benchmark",), ("labels",), ("documents",), ("documents", "labels", "benchmark")])
def test_pipeline_of_odd_and_empty_tables(spark, odd, labels, items, tmp_path, empty):
    """Texts equal in their shingles are one group, of which the row of the smallest id stays."""
    docs = odd.filter("doc_id is null or doc_id <> 7")
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", items)):
        (frame.limit(0) if name in empty else frame).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in found.select("doc_id").collect()}
    assert ids == set() if "documents" in empty else ids <= {1, 2, 3, 4, 5, None}
    if "documents" not in empty:
        # A benchmark item takes every document that holds its one word.
        assert (4 in ids) == ("benchmark" in empty)


def test_packing_takes_every_row(spark, odd, none):
    pieces = packing.pack_documents(odd, WORD_BPE)
    starts = pieces.filter("start = 0").select("doc_id").collect()
    assert len(starts) == odd.count()
    assert packing.pack_documents(none, WORD_BPE).count() == 0


def test_stages_keep_the_columns(spark, odd, labels, items):
    for kept in (
        quality.keep_good(odd, labels),
        simhash.keep_one(odd),
        simhash_sets.keep_one(odd),
        decontamination.remove_contaminated(odd, items),
        secrets.mask_secrets(odd),
    ):
        assert kept.columns == odd.columns
        assert kept.filter("doc_id is null").count() <= 2


def test_ties_of_documents(spark, odd, items):
    found = {r["doc_id"]: r for r in simhash.near_duplicates(odd).collect() if r["doc_id"]}
    assert found[4]["component_id"] == found[5]["component_id"] == 4
    # Texts without words, of any kind, have the same fingerprint.
    assert {found[i]["component_id"] for i in (1, 2, 3)} == {1}
    kept = {r["doc_id"] for r in decontamination.remove_contaminated(odd, items).collect()}
    assert kept == {1, 2, 3, 7, None}


def test_nothing_known_about_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, 5), (2, "no scheme", 5), (None, "http://A.ORG?q=1#x", 5), (3, "http://a.b/c", 5), (3, "http://a.b/c", 5)],
        "page_id bigint, url string, tokens int",
    )
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rules = [url_filters.Rule("org/", "block")]
    found = url_filters.judge_urls(pages, labels, rules).collect()
    assert len(found) == 5
    assert {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found} == {
        (1, "", "", None, "allow"),
        (2, "", "", None, "allow"),
        (None, "a.org", "", None, "allow"),
        (3, "a.b", "/c", None, "allow"),
    }
    assert url_filters.judge_urls(pages.limit(0), labels, rules).count() == 0


def test_urls_of_one_page_path_stay_apart(spark):
    pages = [(None, f"http://h.test/p?{q}=1#f") for q in ("a", "b", "bad")]
    pages += [(1, "http://h.test/p?bad=1"), (1, "http://h.test/p?a=1"), (1, "http://h.test/p?a=1"), (1, None), (1, "h.test")]
    known = [(100 + i, f"http://h{i}.test/{i}?{'a' if i % 3 else 'bad'}=1") for i in range(90)]
    marks = [(100 + i, int(i % 3 > 0), 0) for i in range(90)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    frame = spark.createDataFrame(pages + known, "page_id bigint, url string")
    found = url_filters.judge_urls(frame, labels, []).filter("page_id is null or page_id = 1").collect()
    key = lambda r: tuple(map(str, r))
    shown = [(r["page_id"], r["path"], r["verdict"], r["mined_rule"] is None) for r in found]
    assert sorted(shown, key=key) == sorted(
        ((i, "/p" if u and "/" in u else "", *(("block", False) if u and "bad" in u else ("allow", True))) for i, u in pages),
        key=key,
    )


def test_without_labels_all_is_kept(spark, odd):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.judge(odd, labels).filter(~F.col("keep")).count() == 0

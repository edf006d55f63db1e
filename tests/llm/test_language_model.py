"""Language model: tokens of batches, sums by row, and what a round's tasks send."""

import numpy as np
import pyarrow as pa

from quotelake.llm import language_model


def test_tokens_of_a_batch():
    texts = ["A b", None, "", " \n", "c\x0b\x0cD \x1c  x", "É é b b ", "\tz"] * 3
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["dropped"] * 2000 + texts, pa.string())}).slice(2000)
    found = language_model.tokens_in(batch)
    expected = [language_model.tokens_of((t or "").encode()) for t in texts]
    assert found.sizes.tolist() == [len(t) for t in expected]
    assert [found.words[i] for i in found.codes] == [t for own in expected for t in own]


def test_errors_by_row():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(0, 200_000, 500), np.repeat([7, 70_000, 199_999], [1, 40, 300])])
    error = rng.normal(size=(len(rows), 5))
    touched, times, total = language_model._by_row(rows, error)
    expected = np.zeros((200_000, 5))
    np.add.at(expected, rows, error)
    assert touched.tolist() == np.unique(rows).tolist()
    assert times.tolist() == np.bincount(rows)[touched].tolist()
    assert np.allclose(total, expected[touched])


def test_large_weights_keep_their_range():
    table = np.array([[90, -90, 0], [-120, -110, -115]], np.float32)
    rows = np.array([[0, 1]])
    plain = np.exp(table.astype(float) - table.max(1, keepdims=True))
    plain /= plain.sum(1, keepdims=True)
    assert np.allclose(language_model._softmax(table, rows), plain)
    assert np.allclose(language_model._chances(table, rows, np.array([0, 2])), plain[[0, 1], [0, 2]])


def test_moves_take_no_more_than_texts(spark, monkeypatch):
    cfg = language_model.ModelConfig()
    for text_bytes in (0, 10**6, 10**9, 10**11):
        tasks = language_model.training_tasks(text_bytes, cfg)
        assert tasks == language_model.LEAST_TASKS or tasks * cfg.model_bytes * cfg.rounds <= text_bytes
    kept, sent = language_model.written, []

    def noted(df, label):
        if label == "moves":
            sent.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(language_model, "written", noted)
    small = language_model.ModelConfig(classes=2, members=2, known=10, class_rows=64, member_rows=64)
    texts = [(i, f"w{i % 7} w{i % 5}") for i in range(200)]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(30)
    assert len(language_model.score_documents(rows, small).collect()) == 200
    assert len(sent) == small.rounds
    assert all(f"Coalesce {language_model.LEAST_TASKS}" in plan for plan in sent)

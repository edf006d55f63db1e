"""Ids of whole texts, found by units."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from quotelake.llm import tokens


def odd_texts(seed, n):
    rng = random.Random(seed)
    signs = "ab É'ſΣ1.,!\n\t 　Ġ́\x1c\x85\0<|>" + " " * 8
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "", " ", "  ", "a", " a", "a ", "a\0 b", "a <|endoftext|> b", "x" * 60 + " y"]


def test_units_give_the_ids_of_whole_texts():
    encoder = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for seed in range(6):
        texts = odd_texts(seed, 300)
        assert encoder.encode(texts) == encoder.whole(texts)
        column = pa.array([*texts, *texts], pa.string()).slice(len(texts))
        assert encoder.encode(column) == encoder.whole(texts)
    assert encoder.encode([]) == []


def test_new_units_are_one_text_for_the_library(monkeypatch):
    encoder, given = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json")), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: given.extend(texts) or whole(texts))
    texts = [f"first {i}.{i}, ({i}) w{i}! w{i}!" for i in range(1000)]
    found = encoder.encode(texts)
    assert len(given) <= 3 * len(texts) / 512 + 2
    assert found == whole(texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_words_are_not_given_again(name, monkeypatch):
    encoder, given = tokens.TextEncoder(public_tokenizers.path(name)), []
    monkeypatch.setattr(tokens, "MEMORY", 100_000)
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijé", k=8)) for _ in range(2000)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, 2000, 100)]
    first, whole = encoder.encode(texts), encoder.whole
    assert first == whole(texts) and encoder.used <= 100_000
    monkeypatch.setattr(encoder, "whole", lambda texts: given.extend(texts) or whole(texts))
    assert encoder.encode(texts) == first and not given


def test_letters_whose_lower_case_is_no_letter():
    encoder = tokens.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["aİ, b", "İ'İ!", "क़, c", "J̌, K"]
    assert encoder.encode(texts) == encoder.whole(texts)


def test_words_beside_marks_and_line_ends_are_given_once(monkeypatch):
    encoder, given = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json")), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: given.extend(texts) or whole(texts))
    words = ["".join(random.Random(i).choices("abcdefghij", k=8)) for i in range(40)]
    texts = [" ".join(f"{a}{m}\n({b})" for a in words for m in ".,") for b in words]
    found = encoder.encode(texts)
    assert sum(map(len, given)) < 20 * 4 * len(words)
    assert found == whole(texts)

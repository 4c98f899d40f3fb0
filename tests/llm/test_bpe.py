"""Byte-pair coding against the tokenizers library and a rescanning merger."""

from __future__ import annotations

import hashlib
import random
import sys

import pytest

from stockflow.llm import bpe
from stockflow.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")
WINDOWS = bpe.windows


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(PATH)


def rescanned(merger, letters):
    """Ids by looking for the lowest rank, leftmost first, again after every merge."""
    symbols = [merger.vocab[c] for c in letters[:-1]] + [merger.vocab[letters[-1] + merger.end]]
    while True:
        found = [(merger.rank[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if pair in merger.rank]
        if not found:
            return symbols
        (_, merged), i = min(found)
        symbols[i : i + 2] = [merged]


def test_queue_equals_rescan(coder):
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice("aeinorstlhéĠĊ") for _ in range(rng.randint(1, 30)))
        letters = "".join(coder.letters[b] for b in word.encode())
        assert coder.merger.ids(letters) == rescanned(coder.merger, letters)


@pytest.mark.parametrize("form", ["{}", "a{}b", "{}!", "'{} 1", "{}́"])
def test_every_character(library, coder, form):
    texts = [form.format(chr(c)) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    if form != "a{}b":
        texts = texts[:0x3400] + texts[0xA000:0x20000]  # without the ideographs, which are all alike
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert coder.encode(text).tolist() == want.ids, ascii(text)


def test_random_texts(library, coder):
    rng = random.Random(11)
    pool = "abcdeΣσςİıéñJȞ̱'’“”.,;:!?()0123456789 \n\t\r  \x1c\x85̧̇क़हिन्दी中文日本語ßẞ<|>_-"
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.2:
            text = f"{text[:5]}<|endoftext|>{text[5:]}<|startoftext|>"
        want = library.encode(text, add_special_tokens=False).ids
        ids = coder.encode(text)
        assert ids.tolist() == want, ascii(text)
        assert coder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_long_texts_and_words(library, coder, monkeypatch):
    rng = random.Random(4)
    word = "".join(rng.choice("etaoin") for _ in range(100_000))
    text = " ".join("".join(rng.choice("etaoinäß") for _ in range(rng.randint(1, 9))) for _ in range(60_000))
    for long in (word, text, f"{word}\n{text}", "\n" * 5000, "a " * 70_000):
        want = library.encode(long, add_special_tokens=False).ids
        for size in (1000, bpe.WINDOW):
            monkeypatch.setattr(bpe, "windows", lambda t, s=size: WINDOWS(t, s))
            assert coder.encode(long).tolist() == want


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 10)
    coder = bpe.Coder(PATH)
    text = " ".join(f"word{i}x" for i in range(200))
    assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(coder.words) <= 10 and len(coder.parts) <= 11


def test_rows(spark, rows, docs, odd, nothing, library):
    def digests(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), sha(" ".join(map(str, ids))), sha(decoded)

    got = bpe.code_report(docs, PATH).collect()
    assert sorted(map(tuple, got)) == sorted((i, *digests(t)) for i, t in rows)
    got = bpe.code_report(odd, PATH).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((r.doc_id, *digests(r.text))) for r in odd.collect())
    empty = bpe.code_report(nothing, PATH)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    lists = {r.doc_id: r for r in bpe.coded(docs, PATH).collect()}
    assert all(lists[i].ids == library.encode(t or "", add_special_tokens=False).ids for i, t in rows)


def test_batches_stay_small(spark, monkeypatch, rows):
    """Many rows of one batch come out in several batches, whole."""
    monkeypatch.setattr(bpe, "BATCH_BYTES", 1)
    frame = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").coalesce(1)
    assert sorted(r.doc_id for r in bpe.coded(frame, PATH).collect()) == sorted(i for i, _ in rows)

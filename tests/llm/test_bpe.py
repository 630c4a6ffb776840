import json
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexgraph.llm import bpe
from lexgraph.llm.queries import tokenizer_path

PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "'s", "'", "é", "日本", "12", "!!", "<|endoftext|>", "　", "don't", "aaaa", "\r\n", "😀", "<|"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(tokenizer_path())


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), st.text(max_size=20)), max_size=20))
@settings(max_examples=60, deadline=None)
def test_ids_of_the_library(vocabulary, reference, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    encoder = bpe.Encoder(vocabulary)
    encoder.learn(texts)
    for text in texts:
        ids = [i for c in encoder.parts(text) for i in encoder.known[c]]
        assert ids == reference.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids, vocabulary) == reference.decode(ids, skip_special_tokens=False)


def test_overlapping_pairs_merge_from_the_left(vocabulary):
    letters = bpe.printable_bytes()
    vocab = {c: i for i, c in enumerate(letters)} | {"aa": 256, "aaa": 257}
    small = bpe.load_vocabulary(json.dumps({"model": {"vocab": vocab, "merges": ["a a", "aa a"]}, "added_tokens": []}))
    a = vocab["a"]
    assert bpe.merge_pieces([b"a" * n for n in range(1, 6)], small) == [[a], [256], [257], [256, 256], [256, 257]]


def test_forgetting_chunks_changes_nothing(vocabulary, monkeypatch):
    texts = [f"word{i} and word{i + 1}" for i in range(40)]
    whole = bpe.Encoder(vocabulary)
    whole.learn(texts)
    monkeypatch.setattr(bpe.Encoder, "LIMIT", 5)
    small = bpe.Encoder(vocabulary)
    for text in texts:
        small.learn([text])
        assert [small.known[c] for c in small.parts(text)] == [whole.known[c] for c in whole.parts(text)]


def test_odd_rows(odd, odd_texts, vocabulary, reference):
    def digest(text):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        back = reference.decode(ids, skip_special_tokens=False)
        return len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(back.encode()).hexdigest()

    key = lambda r: str(r)
    got = sorted((tuple(r) for r in bpe.digest_documents(odd, vocabulary).collect()), key=key)
    assert got == sorted(((i, *digest(t)) for i, t in odd_texts), key=key)


def test_round_trip(odd, odd_texts, vocabulary):
    back = bpe.decode_documents(bpe.encode_documents(odd, vocabulary), vocabulary)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((str(i), t or "") for i, t in odd_texts)


def test_empty(empty, vocabulary):
    assert bpe.digest_documents(empty, vocabulary).collect() == []


def test_chunks_in_use_are_kept_and_texts_cut_once(vocabulary, monkeypatch):
    """When there are too many chunks, those of the run at hand stay; a text is cut into chunks once."""
    monkeypatch.setattr(bpe.Encoder, "LIMIT", 4)
    encoder = bpe.Encoder(vocabulary)
    encoder.learn(["the old house"])
    kept = encoder.known[" old"]
    assert encoder.learn(["an old tree stands"]) == [["an", " old", " tree", " stands"]]
    assert encoder.known[" old"] is kept and " house" not in encoder.known and set(encoder.known) == {"an", " old", " tree", " stands"}

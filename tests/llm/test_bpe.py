import hashlib
import random
import time

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from railyard.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", None, "a<|endoftext|>b<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "aaaa aaaaaaa",
    "ΑΣ ΣΑΣ Σ", "İstanbul ıI", "é é ẛ̣", "x\x1cy\x1dz\x1e\x1f\x85\xa0᠎​ w", "don't I'LL we're 12½ ² Ⅷ",
    "😀👩‍👩‍👧 ok!!! ---", "日本語 テキスト", "\x00\x01", "'s's 'S", "ǅ ß ẞ", "<|endoftext|", "a" * 3000, "\n\n\t",
]


def test_as_the_library_does(frame, odd_rows):
    tool = Tokenizer.from_file(PATH)
    rows = [*odd_rows, *((500 + i, t, "s") for i, t in enumerate(ODD))]
    out = bpe.encode_documents(frame(rows), PATH).collect()
    digests = bpe.encode_documents(frame(rows), PATH, digests=True).collect()
    assert len(out) == len(rows)
    for (doc, text, _), r, d in zip(rows, out, digests, strict=True):
        ids = tool.encode(text or "", add_special_tokens=False).ids
        assert (r["doc_id"], r["n_tokens"]) == (doc, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == tool.decode(ids, skip_special_tokens=False)
        assert d["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.encode_documents(frame([]), PATH).count() == 0


def test_forgetting_chunks_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 3)
    one = bpe.Bpe(PATH)
    texts = ["some words and others", "words again", "and <|endoftext|> more words", "some others"]
    first = [one.encode([t])[0].tolist() for t in texts]
    assert first == [x.tolist() for x in bpe.Bpe(PATH).encode(texts)]


def test_often_used_chunks_stay(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 60)
    one = bpe.Bpe(PATH)
    tool = Tokenizer.from_file(PATH)
    for i in range(20):
        text = "often seen <|endoftext|> again " * 3 + " ".join(f"w{i}x{j}" for j in range(20))
        assert one.encode([text])[0].tolist() == tool.encode(text, add_special_tokens=False).ids
        assert len(one.cache) == len(one.uses) == len(one.bounds) - 1 <= 60 + len(one.added) + 24
    assert {"often", "seen", "again"} <= one.cache.keys()
    assert len(one.flat) == one.bounds[-1]


def test_long_words_and_new_letters():
    tool, one = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
    assert one.rising
    rng = random.Random(1)
    texts = [
        "".join(rng.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(200_000)),
        "".join(rng.choice("ab") for _ in range(30_000)),
        "a" * 5001 + "b" + "a" * 400,
        "".join(rng.choice(["the", "ing", "aaaa", "é", "日", "xyz", "nn"]) for _ in range(20_000)),
        "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(20_000)),
    ]
    began = time.monotonic()
    got = [one.encode([t])[0].tolist() for t in texts]
    assert time.monotonic() - began < 60
    assert got == [tool.encode(t, add_special_tokens=False).ids for t in texts]
    every = [chr(c) for c in [*range(0x300, 0xD800, 7), *range(0xE000, 0x110000, 37)]]
    tests = [f"a{c}B" for c in every]
    wants = tool.encode_batch(tests, add_special_tokens=False)
    assert [x.tolist() for x in one.encode(tests)] == [w.ids for w in wants]
    new = [chr(c) for c in (0x558, 0x88F, 0x1C89, 0x209D, 0xA7CB, 0xA7DA, 0x2EBF0, 0x1E4D0, 0x31350)]
    for c in new:
        text = f"a{c}B {c}{c} 1{c}2 x{c}!"
        assert one.encode([text])[0].tolist() == tool.encode(text, add_special_tokens=False).ids, hex(ord(c))

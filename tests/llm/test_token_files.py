"""Token files: an exact round trip, keyed access, and the perfect hash."""

from __future__ import annotations

import time
import zlib

import numpy as np
from tokenizers import Tokenizer

from reelhouse.llm import token_files as t
from reelhouse.llm import tokens


def test_index_gives_each_key_its_place_and_no_other():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 5000):
        hashes = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        shard, offset, length = np.arange(len(hashes)) % 9, np.arange(len(hashes)) * 3, np.arange(len(hashes)) + 1
        data = t.build_index(hashes, shard, offset, length)
        index = t.Index(data)
        slots, known = index.find(hashes)
        assert known.all() and (slots["shard"] == shard).all() and (slots["offset"] == offset).all() and (slots["length"] == length).all()
        assert not index.find(rng.integers(0, 1 << 64, 2000, np.uint64))[1].any()
        assert len(data) < 200 + 30 * n


def test_round_trip(spark, small, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    rows = {r.doc_id: r for r in t.round_trip(small["documents"], tokenizer, t.Layout(part_keys=40, block_keys=16)).collect()}
    at = 0
    for d in small["documents"].orderBy("doc_id").collect():
        ids = np.array(library.encode(d.text, add_special_tokens=False).ids + [1], "<u4")
        r = rows.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not rows


def test_keyed_access(spark, small, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    docs = small["documents"].where("doc_id < 20")
    files = t.write_token_files(docs, tokenizer)
    reader = t.TokenReader(files, spark)
    for d in docs.collect():
        assert reader.get(d.doc_id).tolist() == library.encode(d.text, add_special_tokens=False).ids + [1]
    assert reader.get(10**6) is None and reader.get(3, copy=1) is None


def test_edge_rows(spark, edge_docs, no_docs, tokenizer):
    rows = t.round_trip(edge_docs, tokenizer).orderBy("start").collect()
    assert len(rows) == 14
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert t.round_trip(no_docs, tokenizer).count() == 0


def test_words_with_accents_and_signs_are_put_together_from_those_encoded_before(tokenizer, monkeypatch):
    encoded = []
    encode_new = tokens.WordEncoder._encode_new
    monkeypatch.setattr(tokens.WordEncoder, "_encode_new", lambda self, words: encoded.extend(words) or encode_new(self, words))
    words = "éclair Éclair ÉCLAIR*** éclair$$$ Éclair### éclair(a) straße STRAßE*** ×2 l'été été's être' a\u0301b*** <|endoftext|> a<|endoftext|>"
    texts = [words, None, "", " \n\t ", "\x1c a\xa0b\x0b c\x85\x1f ", " \n " + words.upper()]
    letters = [chr(c) for c in range(0xC0, 0x100)]
    texts.append(" ".join(c + "x" + s for c in letters for s in ["", *map(chr, range(0x21, 0x30)), "|><", "`~^_", "'s", "'."]))
    library, encoder = Tokenizer.from_file(tokenizer), tokens.WordEncoder(tokenizer)
    for text, ids in zip(texts, encoder.encode(t if t is None else t.encode() for t in texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert {"éclair", "straße"} <= {w.decode() for w in encoded} and len(encoded) == len(set(encoded))
    assert not {"Éclair", "ÉCLAIR***", "éclair$$$", "Éclair###", "STRAßE***"} & {w.decode() for w in encoded}


def test_forms_of_a_word_are_looked_up_as_one(tokenizer):
    encoder, library = tokens.WordEncoder(tokenizer), Tokenizer.from_file(tokenizer)
    texts = ["the, The. THE!! (the) tHe$the; Été/ÉTÉ=été", "the<|ENDOFTEXT|> The", "THE12the"]
    for text, ids in zip(texts, encoder.encode(t.encode() for t in texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
    assert {w.decode() for w in encoder.new} == {"", *"the été , . !! ( ) $ ; / = 12 the<|ENDOFTEXT|>".split()}


def test_cut_texts_have_the_ids_of_the_whole(tokenizer):
    encoder, library = tokens.WordEncoder(tokenizer), Tokenizer.from_file(tokenizer)
    pieces = [*"aAeEjJÉéÀßÿ×÷º12 \n'.,=<>|$\xa0\x85\x00\x1cſKİıΣσǰ日😀", "\u0301", "\u030c", "\u0338", "'s", "'S", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>"]
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(pieces, rng.integers(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(t.encode() for t in texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_an_idle_encoder_drops_its_cache(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "_IDLE_SECONDS", 0.1)
    encoder, texts = tokens.WordEncoder(tokenizer), [b"one two three", b"two four", None]
    open_call = encoder.encode(texts)
    first = [next(open_call)]
    time.sleep(0.4)
    assert encoder.new  # a call that has not ended keeps it
    first += open_call
    assert encoder.new and encoder.size
    time.sleep(1)
    assert not encoder.new and not encoder.old and not encoder.size
    assert list(encoder.encode(texts)) == first

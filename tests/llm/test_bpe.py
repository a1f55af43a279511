import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelweave.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def ids(encoder, text):
    return np.frombuffer(encoder(text), "<u4").tolist()


def test_equals_the_library(vocabulary, library):
    encoder, decoder, rnd = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary), random.Random(1)
    parts = ["a", "aa", " ", "  ", "\n", "\n\n", "'s", "'", "the", "é", "日本", "<|endoftext|>", "12", "!!", " the", "\t",
             "\xa0", "\x1c", "\x85", "😀", "ing", "=" * 30, "\u2028", "ǅ", "\u0300"]
    for _ in range(800):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50)))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(encoder, text) == want, text
        assert decoder(encoder(text)) == library.decode(want, skip_special_tokens=False)


def test_long_pieces_stream(vocabulary, library):
    encoder, rnd = bpe.Encoder(vocabulary), random.Random(2)
    for k in range(12):
        few = ["a", "aa", "e", "t", "h", "he", "in", "er", "é", "s", "A", "="][: rnd.randint(2, 12)]
        text = "".join(rnd.choice(few) for _ in range(rnd.randint(5000, 15000)))
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_what_is_stable_stays(vocabulary):
    """Tokens that end a lookahead before the end are those of any longer text."""
    encoder, rnd = bpe.Encoder(vocabulary), random.Random(3)
    for _ in range(300):
        raw = "".join(rnd.choice("aehinrst ") for _ in range(vocabulary.lookahead + 60)).encode()
        end, stable = 0, []
        for i in encoder._merge(raw):
            end += encoder.size[i]
            if end > len(raw) - vocabulary.lookahead:
                break
            stable.append(i)
        more = raw + "".join(rnd.choice("aehinrst ") for _ in range(20)).encode()
        assert encoder._merge(more)[: len(stable)] == stable


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    # b needs c, and a needs that b is free: two steps to the left
    assert bpe.sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 2
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"b", b"c")]) == 1
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(b"ab", b"c"), (b"a", b"b")])


def test_decoder_of_broken_bytes(vocabulary, library):
    decoder, rnd = bpe.Decoder(vocabulary), random.Random(4)
    for _ in range(200):
        some = [rnd.randrange(50257) for _ in range(20)]
        raw = np.array(some, "<u4").tobytes()
        assert decoder(raw) == library.decode(some, skip_special_tokens=False)
        assert "".join(decoder.stream(raw, 1)) == decoder(raw)
    assert decoder(np.array([50257, 10**6], "<u4").tobytes()) == ""


def test_digest_and_round_trip(docs_of, corpus, vocabulary, library):
    docs = docs_of([*corpus, corpus[0], (None, "a b")])
    rows = bpe.digest(docs, vocabulary).collect()
    assert len(rows) == len(corpus) + 2
    texts = {d: t or "" for d, t, _ in corpus} | {None: "a b"}
    for r in rows:
        want = library.encode(texts[r["id"]], add_special_tokens=False).ids
        raw = np.array(want, "<u4").tobytes()
        text = library.decode(want, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    out = bpe.round_trip(docs, vocabulary)
    for r in out.collect():
        assert r["n_tokens"] == len(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, vocabulary).drop("text"), vocabulary)
    assert {(r["doc_id"], r["text"]) for r in back.collect()} == set(texts.items())
    assert bpe.digest(docs_of([]), vocabulary).collect() == []
    assert bpe.round_trip(docs_of([]), vocabulary).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Vocabulary(bpe.vocabulary_path("word_bpe_49k.json"))


def test_few_remembered_words_change_nothing_and_are_forgotten(vocabulary, library):
    encoder, rnd = bpe.Encoder(vocabulary, words=20), random.Random(5)
    for _ in range(60):
        text = " ".join(f"w{rnd.randrange(200)}," for _ in range(40)) + "\nline"
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids
    memos = encoder.memo, encoder.spaced, encoder.lined
    assert [m.most for m in memos] == [10, 20, 2] and all(len(m) <= m.most for m in memos)
    encoder.forget()
    assert not any(m or m.old for m in memos)

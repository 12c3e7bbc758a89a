from __future__ import annotations

import random
import zlib

import numpy as np
import sentencepiece

from millrace.llm import pieces
from millrace.llm.frames import vocabulary

from .conftest import corpus
from .test_tokens import ODD

PATH = vocabulary("piece_bpe_32k.model")


def library():
    """The public library on the same pieces and scores, told that they are Unigram scores."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto.FromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def texts():
    rng = random.Random(2)
    some = [t for t in ODD if "\x85" not in t] + ["a  b   c", "   lead", "trail  ", "▁x ▁▁y"]
    some += ["".join(rng.choice("abeEt .,\n\té1Σ漢😀") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    return some + [(t or "")[:200] for _, t in corpus(3)]


def test_ids_and_decoding_match_the_library():
    own, other = pieces.Unigram(PATH), library()
    for text in texts():
        ids = own.encode(text)
        assert ids == other.encode(text), repr(text)
        assert own.decode(ids) == other.decode(ids), repr(text)


def test_words_give_the_ids_of_whole_texts():
    own, whole = pieces.Unigram(PATH), pieces.Unigram(PATH)
    assert own.by_words
    whole.by_words = False
    for text in texts():
        assert own.encode(text) == whole.encode(text)


def test_words_side_by_side_get_the_ids_of_words_alone():
    for with_bytes in (True, False):
        own, alone = pieces.Unigram(PATH), pieces.Unigram(PATH)
        if not with_bytes:
            own.bytes, alone.bytes = {}, {}
        own.learn(texts())
        assert own.known
        for word, ids in own.known.items():
            assert ids == alone.viterbi(word), repr(word)


def test_double_array_finds_all_prefixes():
    rng = random.Random(5)
    keys = {bytes(rng.choice(b"ab\xff\x00") for _ in range(rng.randint(1, 6))): i for i in range(300)}
    trie = pieces.DoubleArray(keys)
    for _ in range(300):
        data = bytes(rng.choice(b"ab\xff\x00c") for _ in range(8))
        expected = [(n, keys[data[:n]]) for n in range(1, 9) if data[:n] in keys]
        assert list(trie.prefixes(data, 0)) == expected


def test_round_trip_over_a_table(table):
    rows = corpus(12)
    own = pieces.Unigram(PATH)
    for r in pieces.encode(table(rows), PATH).collect():
        sums = {zlib.crc32(np.array(own.encode(t or ""), "<u4").tobytes()) for i, t in rows if i == r.doc_id}
        assert r.round_trip and r.ids_crc32 in sums
    assert pieces.encode(table(rows).filter("doc_id = -5"), PATH).count() == 0

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from geonet.llm import language

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_sum_over_all_segmentations():
    vocab = language.pieces(PATH)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    names = [sp.id_to_piece(i) for i in range(259, sp.get_piece_size())]
    number = {n: int(vocab.find(np.array([sum(ord(c) * int(vocab.up[k]) for k, c in enumerate(n)) & (1 << 64) - 1], dtype=np.uint64))[0]) for n in names}
    assert sorted(number.values()) == list(range(vocab.n))
    rng = np.random.default_rng(1)
    prob = rng.random((vocab.n + 1, 2))
    for word in ["▁the", "▁Wörter", "▁x", "▁a\u0001b", "▁internationale", "▁" + "ab" * 9]:
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=min(len(word) - 1, 18)):
            parts, at = [], 0
            for i, c in enumerate((*cuts, 1), 1):
                if c:
                    parts.append(word[at:i])
                    at = i
            if all(p in number or len(p) == 1 for p in parts):
                total += np.prod([prob[number.get(p, vocab.n)] for p in parts], axis=0)
        assert np.allclose(language.log_likelihood(vocab, [word], prob)[0], np.log(total))


def test_long_words_do_not_underflow():
    vocab = language.pieces(PATH)
    x = language.log_likelihood(vocab, ["▁" + "\u0001z" * 3000], np.full((vocab.n + 1, 3), 1e-7))
    assert np.isfinite(x).all() and (x < -1000).all()


def test_expected_uses_add_up():
    vocab = language.pieces(PATH)
    prob = language.normal(np.zeros((vocab.n + 1, 1)))
    uses = language.expected(vocab, ["▁the", "▁cat"], np.zeros(2, dtype=np.int64), np.array([2.0, 1.0]), prob)
    # every segmentation of a word covers each of its characters once
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    size = np.zeros(vocab.n + 1)
    for i in range(259, sp.get_piece_size()):
        p = sp.id_to_piece(i)
        size[vocab.find(np.array([sum(ord(c) * int(vocab.up[k]) for k, c in enumerate(p)) & (1 << 64) - 1], dtype=np.uint64))] = len(p)
    assert (uses[:, 0] * size).sum() == pytest.approx(2 * 4 + 4)


def test_held_out_accuracy(documents, doc_rows):
    got = {r["doc_id"]: r for r in language.identify(documents, PATH).collect()}
    assert len(got) == len(doc_rows)
    right = total = 0
    for r in doc_rows:
        g = got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0.0 <= g["score"] <= 1.0
        if g["held_out"] and r["lang"] and r["text"] and g["lang_pred"] != "und":
            total += 1
            right += g["lang_pred"] == r["lang"]
    assert total > 20 and right / total >= 0.9


def test_awkward_rows(awkward, nothing):
    got = language.identify(awkward, PATH).collect()
    assert len(got) == awkward.count()
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[2] == by[3] == by[4] == by[7] == "und" and by[5] == "de" and by[None] != "und"
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]
    assert language.identify(nothing, PATH).count() == 0

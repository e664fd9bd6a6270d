import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from geonet.llm import sentence_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["Hello  world\n new", "  lead", " a", "", " ", "  ", "a ", "x\xa0y", "ﬁ ½ é é 日本　x \t y  ", "▁a b", "▁", "▁▁ x▁y", "a" * 3000,
       "ab" * 500 + "  " * 9 + "c", "\x00", "a\x00b", "😀 \U0001F9D1", "    " * 7 + "x" + " " * 33, "..........", "--------- ====", "<unk> <s> </s> <0x0A>"]


@pytest.fixture(scope="module")
def enc():
    return sentence_pieces.Encoder(PATH)


def ids(enc, texts):
    return [np.frombuffer(x, dtype=enc.kind).tolist() for x in enc.encode(texts)]


@pytest.mark.parametrize("letters", ["aeinrst \n.,ABCöé0▁", "ab ", "▁x", "日本語のtext ", "-=. *#"])
def test_equals_the_library(enc, letters, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "INDEX_CHARS", 2000)
    rng = random.Random(letters)
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    got = ids(enc, texts)
    assert got == [SP.encode(t) for t in texts]
    assert [enc.decode(np.array(x, dtype=enc.kind).tobytes()) for x in got] == [SP.decode(x) for x in got]


def test_pieces_that_stay_side_by_side(enc):
    """The border rule against encoding both pieces together, on pairs that do merge and pairs that do not."""
    m, rng = enc.model, random.Random(2)
    pool = [int(i) for i in m.pieces if len(m.names[i]) <= 6]
    pairs = [(rng.choice(pool), rng.choice(pool)) for _ in range(3000)] + [(int(a), int(b)) for a, b in rng.sample(sorted(m.merge), 1000) if m.usable[a] and m.usable[b]]
    a, b = np.array(pairs).T
    got = m.compatible(a, b)
    for (x, y), g in zip(pairs, got.tolist()):
        assert g == (m.merged(m.names[x] + m.names[y])[0] == [x, y]), (m.names[x], m.names[y])


def test_suffix_array_and_occurrences(enc):
    m = enc.model
    text = "the cat and the hat\n" * 3 + "and then"
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4") + np.uint32(1)
    order = sentence_pieces.suffix_array(codes, m.longest)
    key = [text[i:i + 16] for i in order.tolist()]
    assert key == sorted(key)
    at, row = sentence_pieces.occurrences(m, codes, order)
    got = sorted((i, m.names[p]) for i, p in zip(at.tolist(), m.pieces[row].tolist()))
    want = sorted((i, text[i:i + k]) for i in range(len(text)) for k in range(1, 17) if i + k <= len(text) and text[i:i + k] in m.ids and m.usable[m.ids[text[i:i + k]]])
    assert got == want


def test_forgetting_changes_nothing(enc, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CACHE_UNITS", 5)
    texts = ["one two three", "two three four five six seven", "one nine", "ten"]
    assert [ids(enc, [t])[0] for t in texts * 3] == [SP.encode(t) for t in texts * 3]


def test_a_batch_is_taken_in_bounded_parts(enc, monkeypatch):
    """What a worker remembers follows the limits, not the number of texts that it gets at once."""
    monkeypatch.setattr(sentence_pieces, "CACHE_UNITS", 300)
    monkeypatch.setattr(sentence_pieces, "HELD_CHARS", 1000)
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(60)] + [None, "", "w1x1 w2x2"]
    enc.known.clear()
    got, most = [], 0
    for x in enc.encode(texts):
        got.append(np.frombuffer(x, dtype=enc.kind).tolist())
        most = max(most, len(enc.known))
    assert got == [SP.encode(t or "") for t in texts]
    assert most <= 300 + 2 * 200


def test_documents(documents, doc_rows):
    got = {r["doc_id"]: tuple(r)[1:] for r in sentence_pieces.digests(documents, PATH).collect()}
    for r in doc_rows:
        x = np.array(SP.encode(r["text"] or ""), dtype="<u4")
        assert got[r["doc_id"]] == (len(x), zlib.crc32(x.tobytes()), True)


def test_encode_and_decode_frames(awkward, nothing):
    rows = sentence_pieces.encode(awkward, PATH, keep=["doc_id", "text"])
    for r in rows.collect():
        assert list(r["ids"]) == SP.encode(r["text"] or "")
    back = sentence_pieces.decode(rows.withColumnRenamed("text", "want"), PATH, keep=["doc_id", "want"])
    for r in back.collect():
        assert r["text"] == (r["want"] or "").replace("▁", " ")
    assert sentence_pieces.encode(nothing, PATH).count() == 0 and sentence_pieces.digests(nothing, PATH).count() == 0
    assert all(r["round_trip"] for r in sentence_pieces.digests(awkward, PATH).collect())

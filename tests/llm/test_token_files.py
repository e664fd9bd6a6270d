import tempfile
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from geonet.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def run(docs, **options):
    folder = "file://" + tempfile.mkdtemp(prefix="tokens-")
    parts = token_files.write_tokens(docs, folder, PATH, end_id=2, **options)
    return folder, parts, [tuple(r) for r in token_files.token_index(parts, folder).collect()]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, got):
    """Order by id (null first); rows of one id may follow each other in either order."""
    start = 0
    want = {}
    for r in rows:
        ids = np.array(ids_of(r["text"]), dtype="<u4")
        want.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
    for i, at, n, crc in got:
        assert at == start
        want[i].remove((n, crc))
        start += n


def test_documents(documents, doc_rows):
    check(doc_rows, run(documents)[2])


def test_awkward_rows(awkward, nothing):
    rows = [r.asDict() for r in awkward.collect()]
    check(rows, run(awkward)[2])
    check(rows, run(awkward, seq_len=3)[2])
    assert run(nothing)[2] == []


def test_sequences_and_masks(documents, doc_rows):
    folder, parts, _ = run(documents, seq_len=64)
    total = 0
    for part in sorted(r["part"] for r in parts.collect()):
        reader = token_files.read_sequences(folder, part)
        for k in range(reader.num_record_batches):
            b = reader.get_batch(k)
            assert b.schema.field("ids").type.list_size == 64 and b.schema.field("mask").type.list_size == 64
            b.column(0).values.to_numpy(zero_copy_only=True)
            total += int(b.column(1).values.to_numpy(zero_copy_only=False).sum())
    assert total == sum(len(ids_of(r["text"])) for r in doc_rows)


def test_pieces_cut_like_whole_texts():
    enc, tok = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["", " ", "a", " a", "a ", "a  b", "a \n b", "it's 's x's <|endoftext|> y", "x <|endo text|> <", "é ü ß “q” 日 本 😀 z",
             "\na b", "Word, word. wörd! x1,日本. a's, -. .", "a\n b", "a b\n", "don't  stop", "1 2 3,4 5%", "\u00a0a \u00a0 b", "\x1c a \x1c", "tab\t x", "▁ a ▁b"] * 2
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]

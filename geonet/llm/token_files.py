"""Token ids as Arrow files of equal-length sequences.

Documents are encoded in ascending id order and their ids, each document closed by an end id, run on through
sequences of fixed length.  A file holds record batches with two fixed-size-list columns, ``ids`` and ``mask``
(false where the last sequence is filled up), so that a reader maps the file and takes any sequence without copying.
Beside it lies a small file with the documents of the data file, in order, and their number of ids.

Files go to a folder that all executors share, written under another name and renamed when complete, so a
task that is run again or twice leaves one whole file.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from geonet.llm.common import few_at_once, stored, worker_store

SEQ_LEN = 2_048
BATCH_SEQS = 256
CACHE_UNITS = 1_200_000
#: Marks that the vocabulary splits off a word of letters.
MARKS = ".,;:!?"
#: A piece between two spaces can be encoded by itself if it neither begins nor ends with white space.
PLAIN = re.compile(r"[!-~¡-ɏ](?:.*[!-~¡-ɏ])?", re.S)
PLAIN_END = re.compile(r"(?:.*[!-~¡-ɏ])?", re.S)


class Encoder:
    """Ids of whole texts by the tokenizers library, which is asked once per distinct piece.

    The vocabulary splits text before every space that follows and precedes other characters, so pieces cut
    there have the ids that they have inside the text.  A text with other white space around a cut (double
    spaces, spaces at line ends) or other scripts at it goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.inner: dict[str, bytes | None] = {}
        self.first: dict[str, bytes | None] = {}
        self.marks = dict(zip(MARKS, self.whole(list(MARKS))))

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, cache: dict, new: list[str], lead: str, plain: re.Pattern) -> None:
        """Cache the ids of ``lead + piece`` per piece, None if the piece cannot stand alone."""
        if len(cache) + len(new) > CACHE_UNITS:
            cache.clear()
        fit, marked = [], []
        for p in new:
            if p[-1:] in MARKS and p[:-1].isalpha():
                marked.append(p)
            elif plain.fullmatch(p):
                fit.append(p)
            else:
                cache[p] = None
        fit += {p[:-1] for p in marked}.difference(cache, fit)
        cache.update(zip(fit, self.whole([lead + p for p in fit])))
        cache.update((p, cache[p[:-1]] + self.marks[p[-1]]) for p in marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [t.split(" ") for t in texts]
        inner, first = set(), set()
        for p in pieces:
            first.add(p[0])
            inner.update(p[1:])
        first = [p for p in first if p not in self.first]
        inner = [p for p in inner if p not in self.inner]
        self.learn(self.first, first, "", PLAIN_END)
        self.learn(self.inner, inner, " ", PLAIN)
        out: list[bytes | None] = []
        for p in pieces:
            ids = [self.first.get(p[0])]
            ids += map(self.inner.get, p[1:])
            out.append(None if None in ids else b"".join(ids))
        missed = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(missed, self.whole([texts[i] for i in missed])):
            out[i] = ids
        return out


def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    store = worker_store("byte_bpe")
    if path not in store:
        store.clear()
        store[path] = Encoder(path)
    return store[path]


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class SequenceFile:
    """One data file while it is written: ids come in, whole batches of sequences go out."""

    def __init__(self, folder: str, name: str, kind: np.dtype, seq_len: int):
        self.fs, base = place(folder)
        self.kind, self.seq_len, self.final = kind, seq_len, f"{base}/{name}"
        self.temp = f"{base}/.{name}-{uuid.uuid4().hex}"
        item = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("ids", pa.list_(item, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.sink = self.fs.open_output_stream(self.temp)
        self.writer = ipc.new_file(self.sink, self.schema)
        self.held: list[bytes] = []
        self.n_held = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n_held += len(ids) // self.kind.itemsize
        if self.n_held >= BATCH_SEQS * self.seq_len:
            self.flush(False)

    def flush(self, last: bool) -> None:
        values = np.frombuffer(b"".join(self.held), dtype=self.kind)
        size = BATCH_SEQS * self.seq_len
        at = 0
        while len(values) - at >= size or last and at < len(values):
            part = values[at:at + size]
            n = -(-len(part) // self.seq_len) * self.seq_len
            ids, mask = np.zeros(n, dtype=self.kind), np.zeros(n, dtype=bool)
            ids[:len(part)], mask[:len(part)] = part, 1
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
            self.writer.write_batch(pa.record_batch(columns, schema=self.schema))
            at += len(part)
        self.held, self.n_held = [values[at:].tobytes()], len(values) - at

    def close(self) -> None:
        self.flush(True)
        self.writer.close()
        self.sink.close()
        self.fs.move(self.temp, self.final)


def write_table(folder: str, name: str, table: pa.Table) -> None:
    fs, base = place(folder)
    temp = f"{base}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(temp) as sink, ipc.new_file(sink, table.schema) as writer:
        writer.write_table(table)
    fs.move(temp, f"{base}/{name}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, seq_len: int = SEQ_LEN,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the files into ``folder`` (a URI that all executors reach); returns part, n_docs, n_ids per file.

    Every text is encoded whole; null counts as empty and has the end id alone.  Documents follow each other by
    doc_id, nulls first, rows of one id by their text.  Other columns are not read; an empty table gives no
    files.  Memory per task: one batch of texts, one batch of sequences, the piece cache and the file's index.
    """
    fs, base = place(folder)
    fs.create_dir(base, recursive=True)
    d = few_at_once(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, out = TaskContext.get().partitionId(), None
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=enc.kind).tobytes()
        ids, counts = [], []
        for frame in frames:
            out = out or SequenceFile(folder, f"ids-{part:06d}.arrow", enc.kind, seq_len)
            ids += [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
            for at in range(0, len(frame), 500):
                for raw in enc.encode(frame["text"].iloc[at:at + 500].tolist()):
                    out.add(raw + end)
                    counts.append(len(raw) // enc.kind.itemsize + 1)
        if out is not None:
            out.close()
            table = pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(counts, pa.int64())})
            write_table(folder, f"docs-{part:06d}.arrow", table)
            yield pd.DataFrame({"part": [part], "n_docs": [len(ids)], "n_ids": [sum(counts)]})

    return stored(d.mapInPandas(write, "part int, n_docs long, n_ids long"), "token-parts")


def read_sequences(folder: str, part: int) -> ipc.RecordBatchFileReader:
    """Random access to the batches of one data file; a local file is mapped, not copied."""
    fs, base = place(folder)
    path = f"{base}/ids-{part:06d}.arrow"
    return ipc.open_file(pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path))


def read_docs(folder: str, part: int) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
    """(doc_id, first id within the file, views of its ids) per document of one file."""
    fs, base = place(folder)
    with fs.open_input_file(f"{base}/docs-{part:06d}.arrow") as f:
        index = ipc.open_file(f).read_all()
    reader, batch, begin, values = read_sequences(folder, part), -1, 0, np.zeros(0)
    at = 0
    for doc, n in zip(index["doc_id"].to_pylist(), index["n_tokens"].to_pylist()):
        views, first = [], at
        while n:
            if at - begin >= len(values):
                begin += len(values)
                batch += 1
                values = reader.get_batch(batch).column(0).values.to_numpy(zero_copy_only=True)
            view = values[at - begin:at - begin + n]
            views.append(view)
            at += len(view)
            n -= len(view)
        yield doc, first, views


def token_index(parts: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files.

    One row per file goes through one window, which gives the ids in the files before it.
    """
    before = W.partitionBy(F.lit(1)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, base in zip(frame["part"], frame["base"]):
                rows = []
                for doc, first, views in read_docs(folder, int(part)):
                    crc = 0
                    for v in views:
                        crc = zlib.crc32(v.astype("<u4").tobytes(), crc)
                    rows.append((doc, int(base) + first, sum(map(len, views)), crc))
                    if len(rows) == 10_000:
                        yield index_frame(rows)
                        rows = []
                yield index_frame(rows)

    spread = bases.repartition(max(1, parts.count()), "part")  # a number given is not coalesced
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def index_frame(rows: list[tuple]) -> pd.DataFrame:
    doc, start, n, crc = zip(*rows) if rows else ((), (), (), ())
    return pd.DataFrame({"doc_id": pd.array(doc, dtype="Int64"), "start": np.array(start, dtype=np.int64),
                         "n_tokens": np.array(n, dtype=np.int64), "ids_crc32": np.array(crc, dtype=np.int64)})

"""Language identification by segmentation-marginalised unigrams.

A language is a unigram distribution over the pieces of a fixed public vocabulary.  The probability of a word is
the sum over all its segmentations into pieces, which the forward algorithm adds up position by position; a
text is the product of its words.  Piece probabilities come from expectation-maximisation over the word counts
of labelled texts: the forward and backward sums give the expected number of times that each piece is used.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from geonet.llm.common import few_at_once, stored, worker_store
from geonet.llm.mixing import hash60

UND = "und"
#: Documents per language that a model is fitted on, at most about; those of least hash are taken.
TRAIN_DOCS = 2_000
ROUNDS = 2
CACHE_WORDS = 300_000
#: Characters of equally long words that are summed together.
WAVE_CHARS = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
LETTER = regex.compile(r"\p{L}")
#: All sums are scaled by this per character, and again every few characters, so that they stay near one.
SCALE, RESCALE = 64.0, 16


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    up, down = np.ones(n + 1, dtype=np.uint64), np.ones(n + 1, dtype=np.uint64)
    up[1:], down[1:] = BASE, np.uint64(pow(int(BASE), -1, 1 << 64))
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Pieces:
    """The normal pieces of a sentencepiece vocabulary, found by a polynomial hash of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        text = [m.id_to_piece(i) for i in normal]
        self.longest = max(map(len, text))
        self.up, self.down = powers(64)
        keys = np.array([sum((ord(c) * int(self.up[k])) for k, c in enumerate(p)) & (1 << 64) - 1 for p in text], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.n = keys[order], len(text)
        assert (self.keys[1:] != self.keys[:-1]).all()
        self.first = self.keys >> np.uint64(48)
        self.start = np.searchsorted(self.first, np.arange(1 << 16, dtype=np.uint64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the piece with each key, ``n`` if there is none."""
        at = np.searchsorted(self.keys, keys)
        at[at == self.n] = 0
        return np.where(self.keys[at] == keys, at, self.n)


def pieces(path: str) -> Pieces:
    store = worker_store("language")
    if ("pieces", path) not in store:
        store["pieces", path] = Pieces(path)
    return store["pieces", path]


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, character codes) of the words of each length."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        step = max(1, WAVE_CHARS // n)
        for i in range(0, len(at), step):
            some = at[i:i + step]
            codes = np.frombuffer("".join([words[k] for k in some.tolist()]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            yield some, codes.reshape(len(some), n).astype(np.uint64)


def edges(vocab: Pieces, codes: np.ndarray, end: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, piece) per piece length that may end at ``end``."""
    for size in range(1, min(end, vocab.longest) + 1):
        key = (codes[:, end - size:end] * vocab.up[:size]).sum(axis=1, dtype=np.uint64)
        yield size, vocab.find(key)


def forward(vocab: Pieces, codes: np.ndarray, prob: np.ndarray, lang: np.ndarray | None = None):
    """(alpha, log of the scale taken out, pieces per end and length) of equally long words.

    ``prob`` has a row per piece and one for an unknown character; with ``lang`` each word uses its own column, and
    only then the pieces are kept.
    """
    k, n = codes.shape
    width = prob.shape[1] if lang is None else 1
    alpha = np.zeros((n + 1, k, width))
    alpha[0] = 1.0
    scale, found = np.zeros((k, width)), []
    for end in range(1, n + 1):
        here = []
        for size, piece in edges(vocab, codes, end):
            if size > 1 and (piece == vocab.n).all():
                continue
            p = prob[piece] if lang is None else prob[piece, lang][:, None]
            if size > 1:
                p = p * (piece != vocab.n)[:, None]
            alpha[end] += p * SCALE ** size * alpha[end - size]
            if lang is not None:
                here.append((size, piece))
        found.append(here)
        if lang is None and end % RESCALE == 0:
            s = alpha[end].copy()
            alpha[max(0, end - vocab.longest):end + 1] /= s
            scale += np.log(s)
    return alpha, scale, found


def log_likelihood(vocab: Pieces, words: list[str], prob: np.ndarray) -> np.ndarray:
    """Log probability per word and language."""
    out = np.zeros((len(words), prob.shape[1]))
    for at, codes in by_length(words):
        alpha, scale, _ = forward(vocab, codes, prob)
        out[at] = np.log(alpha[-1]) + scale - codes.shape[1] * np.log(SCALE)
    return out


def expected(vocab: Pieces, words: list[str], lang: np.ndarray, weight: np.ndarray, prob: np.ndarray, longest: int = 64) -> np.ndarray:
    """Expected uses of every piece per language; words longer than ``longest`` teach nothing."""
    out = np.zeros(prob.shape)
    for at, codes in by_length(words):
        n = codes.shape[1]
        if n > longest:
            continue
        who = lang[at]
        alpha, _, found = forward(vocab, codes, prob, who)
        beta = np.zeros((n + 1, len(at)))
        beta[n] = weight[at] / alpha[n, :, 0]
        for end in range(n, 0, -1):
            for size, piece in found[end - 1]:
                known = (piece != vocab.n) | (size == 1)
                flow = prob[piece, who] * SCALE ** size * known * beta[end]
                np.add.at(out, (piece, who), alpha[end - size, :, 0] * flow)
                beta[end - size] += flow
    return out


def normal(counts: np.ndarray) -> np.ndarray:
    """Smoothed probabilities; the unknown character is equally rare in every language."""
    prob = counts[:-1] + 0.05
    prob /= prob.sum(axis=0)
    return np.vstack([prob, np.full((1, prob.shape[1]), 1e-7)])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, vocabulary: str, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS,
        text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """(languages, probabilities: a row per piece and a column per language) from text and lang.

    Learns from rows with a lang whose crc32(doc_id) mod 5 is not 0.  Of a language with more than
    ``train_docs`` such rows, the share train_docs / rows of least hash is read.  Word counts and expected
    counts are made by Spark; what reaches the driver is bounded by pieces x languages.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    d = d.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    share = stored(d.groupBy("lang").agg((F.lit(float(train_docs)) / F.count(F.lit(1))).alias("share")), "lang-share")
    some = d.join(share, "lang").filter(hash60(F.concat(F.lit("lang"), F.col("doc_id").cast("string"))) < F.col("share") * float(1 << 60))
    words = some.select("lang", F.explode(F.array_remove(F.split("text", r"\s+"), "")).alias("word"))
    words = stored(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "lang-words")
    languages = [r[0] for r in words.select("lang").distinct().sort("lang").collect()]
    size = pieces(vocabulary).n + 1
    prob = normal(np.zeros((size, len(languages)))) if languages else np.zeros((size, 0))
    number = {name: i for i, name in enumerate(languages)}
    for _ in range(rounds if languages else 0):

        def uses(frames: Iterator[pd.DataFrame], prob=prob) -> Iterator[pd.DataFrame]:
            vocab, total = pieces(vocabulary), np.zeros(prob.shape)
            for x in frames:
                marked = ["▁" + w for w in x["word"]]
                total += expected(vocab, marked, x["lang"].map(number).to_numpy(np.int64), x["n"].to_numpy(np.float64), prob)
            piece, who = np.nonzero(total)
            yield pd.DataFrame({"piece": piece.astype(np.int32), "who": who.astype(np.int32), "uses": total[piece, who]})

        made = words.mapInPandas(uses, "piece int, who int, uses double").groupBy("piece", "who").agg(F.sum("uses").alias("uses"))
        counts = np.zeros(prob.shape)
        for r in made.toLocalIterator():
            counts[r["piece"], r["who"]] = round(r["uses"], 6)
        prob = normal(counts)
    return languages, prob


def has_letter():
    """Pandas function text -> whether the text has a letter; false for null."""

    @F.pandas_udf("boolean")
    def found(text: pd.Series) -> pd.Series:
        return pd.Series([bool(t and LETTER.search(t)) for t in text], dtype=bool)

    return found


def predictor(model: tuple[list[str], np.ndarray], vocabulary: str):
    """Pandas function text -> (lang_pred, score)."""
    languages, prob = model
    name = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        store = worker_store("language")
        if store.get("model") != name:
            store["model"], store["words"] = name, ({}, [np.zeros((0, len(languages)))])
        rows, table = store["words"]
        vocab = pieces(vocabulary)
        texts = [t if t and languages and LETTER.search(t) else None for t in text]
        if len(rows) > CACHE_WORDS:
            rows.clear()
            table[0] = table[0][:0]
        new: set[str] = set()
        for at in range(0, len(texts), 64):  # all words of the batch that are new are scored together
            new |= set().union(*[t.split() for t in texts[at:at + 64] if t]).difference(rows, new)
        if new:
            words = list(new)
            rows.update(zip(words, range(len(rows), len(rows) + len(words))))
            table[0] = np.vstack([table[0], log_likelihood(vocab, ["▁" + w for w in words], prob)])
        said = []
        for t in texts:
            if t is None:
                said.append((UND, 0.0))
                continue
            words = t.split()
            x = table[0][np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
            best = int(x.argmax())
            said.append((languages[best], float(1.0 / np.exp(x - x[best]).sum())))
        return pd.DataFrame(said, columns=["lang_pred", "score"])

    # so marked, a filter on the prediction is not moved before it, which would predict every text twice
    return predict.asNondeterministic()


def identify(docs: DataFrame, vocabulary: str, model: tuple[list[str], np.ndarray] | None = None,
             text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of the prediction, languages equally likely) per document.

    ``und`` with score 0 where the text is null, empty or has no letter, or where nothing was learned.  Whole
    texts count, repeated rows each; a null doc_id is not held out and teaches nothing.
    """
    model = model or fit(docs, vocabulary, text=text, lang=lang, doc_id=doc_id, **options)
    d = few_at_once(docs).select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), predictor(model, vocabulary)(F.col(text)).alias("p"))
    return d.select("doc_id", "held_out", "p.lang_pred", "p.score")

"""Cheapest repair of the turns of a conversation, by tables of blocks.

A conversation is right if its role initials are nothing, or an ``s`` that may lack and then ``ua`` once or more.  Rows
are kept (0), given the role user or assistant (1) or deleted (2, a must for blank and duplicate rows); empty rows of
user or assistant may be inserted anywhere (5), and a truncated row that stays adds 5.

What the rest of a conversation costs is a vector over four states: nothing yet, after s, after u, after a.  Less
its smallest entry it is one of a few vectors, so the step over a row is a table of (vector, symbol), and the step
over a block of BLOCK rows a table of (vector, block), as in the method of the Four Russians.  Blocks are looked up from
the end of the conversation; for the edits each block is expanded again from the vector at its end, backward, and then
walked forward, taking of the cheapest edits the one whose letter comes first (D, I, K, R).  A letter fixes the next
state, so this gives the least of all cheapest strings.

No conversation is gathered to be solved: rows are ordered by a range shuffle, in which even equal rows may part, and
cut into pieces of at most 2^PIECE_BITS rows.  A conversation of several pieces is solved from one summary per piece:
for every vector at its end the vector at its start, and the state that each state leads to.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geonet.llm.common import stored, worker_store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Symbols of a block.
BLOCK = 4
#: Rows of a piece as a power of two.
PIECE_BITS = 16
#: Symbols: twice the role (s, u, a, other), plus one if truncated; GONE must be deleted.
GONE, SYMBOLS = 8, 9
START, S, U, A = range(4)
#: State after an inserted or renamed row.
NEXT = (U, U, A, U)
#: State after a kept row, by state and role.
KEPT = ((S, U, None, None), (None, U, None, None), (None, None, A, None), (None, U, None, None))
NAMES = {U: "user", A: "assistant"}
SPACES = " \t\n\x0b\f\r"


def closed(cost: list[int]) -> list[int]:
    """The vector after allowing inserts."""
    for _ in range(3):
        cost = [min(c, INSERT + cost[NEXT[q]]) for q, c in enumerate(cost)]
    return cost


#: What remains at the end: only nothing or an ``a`` may be last.
AT_END = closed([0, 99, 99, 0])


def options(symbol: int, q: int, after: list[int]) -> list[tuple[str, int, int]]:
    """(letter, cost with the rest, next state) of the edits of one row, in the order of their letters; no insert."""
    out = [("D", DELETE + after[q], q)]
    if symbol != GONE:
        more = TRUNCATED * (symbol % 2)
        kept = KEPT[q][symbol // 2]
        if kept is not None:
            out.append(("K", KEEP + more + after[kept], kept))
        out.append(("R", REROLE + more + after[NEXT[q]], NEXT[q]))
    return out


def before(symbol: int, after: list[int]) -> list[int]:
    return closed([min(c for _, c, _ in options(symbol, q, after)) for q in range(4)])


def walk(symbol: int, q: int, after: list[int]) -> tuple[str, int]:
    """Letters of the inserts before one row and of its own edit, and the state behind it."""
    now, letters = before(symbol, after), ""
    while True:
        for letter, cost, to in sorted([*options(symbol, q, after), ("I", INSERT + now[NEXT[q]], NEXT[q])]):
            if cost == now[q]:
                break
        letters, q = letters + letter, to
        if letter != "I":
            return letters, q


class Tables:
    """Normalised vectors and the steps over symbols and blocks."""

    def __init__(self):
        self.vectors = [tuple(c - min(AT_END) for c in AT_END)]
        number, to, out = {self.vectors[0]: 0}, [], []
        for vector in self.vectors:  # grows while it is walked
            row = []
            for symbol in range(SYMBOLS):
                cost = before(symbol, list(vector))
                least = tuple(c - min(cost) for c in cost)
                if least not in number:
                    number[least] = len(self.vectors)
                    self.vectors.append(least)
                row.append(number[least])
            to.append(row)
            out.append([[walk(symbol, q, list(vector))[1] for q in range(4)] for symbol in range(SYMBOLS)])
        self.to, self.out = np.array(to), np.array(out)  # [vector behind, symbol], [vector behind, symbol, state]
        count = len(self.vectors)
        block = np.arange(SYMBOLS ** BLOCK)[:, None]
        digits = [block // SYMBOLS ** (BLOCK - 1 - k) % SYMBOLS for k in range(BLOCK)]
        behind = [np.broadcast_to(np.arange(count), (len(block), count))]
        for digit in digits[::-1]:
            behind.append(self.to[behind[-1], digit])
        self.block_to = behind[-1]  # [block, vector behind]
        state = np.broadcast_to(np.arange(4), (len(block), count, 4))
        for digit, vector in zip(digits, behind[-2::-1]):
            state = self.out[vector[..., None], digit[..., None], state]
        self.block_out = state  # [block, vector behind, state]
        self.expanded: dict[tuple[int, int, int], list[str]] = {}

    def blocks(self, codes: np.ndarray) -> tuple[list[int], list[int]]:
        """Whole blocks of a sequence, and the symbols before them that make no block."""
        odd = len(codes) % BLOCK
        weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return (codes[odd:].reshape(-1, BLOCK) @ weights).tolist(), codes[:odd].tolist()

    def summary(self, codes: np.ndarray) -> tuple[list[int], list[int]]:
        """For each vector behind a sequence: the vector before it, and the state that each state leads to (flat)."""
        blocks, odd = self.blocks(codes)
        vector, behind = np.arange(len(self.vectors)), []
        for block in reversed(blocks):
            behind.append(vector)
            vector = self.block_to[block, vector]
        state = np.broadcast_to(np.arange(4), (len(vector), 4))
        first = []
        for symbol in reversed(odd):
            first.append(vector)
            vector = self.to[vector, symbol]
        for symbol in odd:
            state = self.out[first.pop()[:, None], symbol, state]
        for block in blocks:
            state = self.block_out[block, behind.pop()[:, None], state]
        return vector.tolist(), state.ravel().tolist()

    def expand(self, block: int, vector: int, q: int) -> list[str]:
        """Letters per row of a block, from the vector behind it and the state before it."""
        found = self.expanded.get((block, vector, q))
        if found is None:
            symbols = [block // SYMBOLS ** (BLOCK - 1 - k) % SYMBOLS for k in range(BLOCK)]
            found = self.expanded[block, vector, q] = self.letters_of(symbols, vector, q)[0]
        return found

    def letters_of(self, symbols: list[int], vector: int, q: int) -> tuple[list[str], int]:
        behind = []
        for symbol in reversed(symbols):
            behind.append(vector)
            vector = int(self.to[vector, symbol])
        out = []
        for symbol in symbols:
            letters, q = walk(symbol, q, list(self.vectors[behind.pop()]))
            out.append(letters)
        return out, q

    def edits(self, codes: np.ndarray, vector: int, q: int) -> tuple[list[str], int]:
        """Letters per row of a sequence and the state behind it."""
        blocks, odd = self.blocks(codes)
        behind = []
        for block in reversed(blocks):
            behind.append(vector)
            vector = int(self.block_to[block, vector])
        out, q = self.letters_of(odd, vector, q)
        for block in blocks:
            vector = behind.pop()
            out.extend(self.expand(block, vector, q))
            q = int(self.block_out[block, vector, q])
        return out, q


def tables() -> Tables:
    store = worker_store("conversation_repair")
    if "tables" not in store:
        store["tables"] = Tables()
    return store["tables"]


def tail(q: int) -> str:
    """Inserts after the last row."""
    return "I" * (AT_END[q] // INSERT)


@F.pandas_udf(T.StructType([T.StructField("vectors", T.ArrayType(T.IntegerType())), T.StructField("states", T.ArrayType(T.IntegerType()))]))
def summaries(codes: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([tables().summary(np.asarray(c, dtype=np.int64)) for c in codes], columns=["vectors", "states"])


@F.pandas_udf(T.StructType([T.StructField("letters", T.ArrayType(T.StringType())), T.StructField("tail", T.StringType())]))
def edit_letters(codes: pd.Series, vector: pd.Series, state: pd.Series, last: pd.Series) -> pd.DataFrame:
    rows = []
    for c, v, q, end in zip(codes, vector, state, last):
        letters, q = tables().edits(np.asarray(c, dtype=np.int64), int(v), int(q))
        rows.append((letters, tail(q) if end else ""))
    return pd.DataFrame(rows, columns=["letters", "tail"])


def borders(piece: pd.DataFrame) -> pd.DataFrame:
    """Summaries of the pieces of one conversation -> vector behind, state before and whether it is the last, per piece."""
    rows = piece.sort_values("chunk").reset_index(drop=True)
    vector, behind = 0, [0] * len(rows)
    for k in range(len(rows) - 1, -1, -1):
        behind[k] = vector
        vector = int(rows["vectors"][k][vector])
    q, state = START, [0] * len(rows)
    for k in range(len(rows)):
        state[k] = q
        q = int(rows["states"][k][4 * behind[k] + q])
    last = [False] * (len(rows) - 1) + [True]
    return pd.DataFrame({"chunk": rows["chunk"], "vector": behind, "state": state, "last": last})


def cleaned(conversations: DataFrame) -> DataFrame:
    """conv_id, turn (long), role and text; a null role or text is one space."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])


ORDER = ["conv_id", "turn", "role", "text"]


def symbols(rows: DataFrame) -> DataFrame:
    """conv_id, seq (ascending in the order of the conversation's rows) and symbol of every row."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    role = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 2).when(F.startswith("role", F.lit("a")), 4).otherwise(6)
    d = rows.withColumn("salt", F.monotonically_increasing_id())  # equal rows may part
    d = d.repartitionByRange(*ORDER, "salt").sortWithinPartitions(*ORDER, "salt")
    d = d.select(
        "conv_id", F.monotonically_increasing_id().alias("seq"), (trimmed == "").alias("blank"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("what"),
        (role + (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).cast("int")).alias("symbol"))
    d = stored(d, "repair-rows")
    first = d.filter("NOT blank").groupBy("conv_id", "what").agg(F.min("seq").alias("at"))
    d = d.join(first.select("at"), F.col("seq") == F.col("at"), "left")
    return d.select("conv_id", "seq", F.when(F.col("at").isNull(), F.lit(GONE)).otherwise(F.col("symbol")).cast("int").alias("symbol"))


def pieces(rows: DataFrame, bits: int) -> DataFrame:
    """conv_id, chunk, letters per row of the piece, codes, tail: the edits of every conversation."""
    got = symbols(rows).groupBy("conv_id", F.shiftright("seq", bits).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("seq", "symbol"))).alias("rows"))
    got = stored(got.select("conv_id", "chunk", F.col("rows.symbol").alias("codes")), "repair-pieces")
    several = got.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("conv"))
    again = got.join(several, F.col("conv_id").eqNullSafe(F.col("conv")), "left_semi").select("conv_id", "chunk", summaries("codes").alias("s"))
    kind = got.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("c_id", kind), T.StructField("c_chunk", T.LongType()), T.StructField("vector", T.IntegerType()),
                           T.StructField("state", T.IntegerType()), T.StructField("last", T.BooleanType())])

    def solve(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = borders(frame).rename(columns={"chunk": "c_chunk"})
        out.insert(0, "c_id", pd.Series([key[0]] * len(out), dtype=object))
        return out

    known = again.select("conv_id", "chunk", "s.*").groupBy("conv_id").applyInPandas(solve, schema)
    got = got.join(known, F.col("conv_id").eqNullSafe(F.col("c_id")) & (F.col("chunk") == F.col("c_chunk")), "left")
    edits = edit_letters("codes", F.coalesce("vector", F.lit(0)), F.coalesce("state", F.lit(START)), F.coalesce("last", F.lit(True)))
    return got.select("conv_id", "chunk", "codes", edits.alias("e")).select("conv_id", "chunk", "codes", "e.*")


class Conversation:
    """Walks the rows of one conversation with their edits; holds letters and symbols, never the texts."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.letters, self.tail, self.at = conv_id, [], [], "", 0
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.low = self.high = self.initial = None
        self.state, self.audit, self.place, self.digest = START, [], 0, hashlib.sha256()

    def piece(self, codes: list[int], letters: list[str], end: str) -> None:
        self.codes.extend(codes)
        self.letters.extend(letters)
        self.tail += end

    def out(self, role: str, text: str) -> tuple:
        row = f"{role}:{text}".encode("utf-8", "surrogatepass")
        self.digest.update(b"\n" + row if self.place else row)
        self.place += 1
        return self.conv_id, self.place, role, text

    def insert(self) -> tuple:
        self.cost += INSERT
        self.state = NEXT[self.state]
        return self.out(NAMES[self.state], "")

    def row(self, turn: int | None, role: str, text: str) -> list[tuple]:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        initial, code, letters = role[:1], self.codes[self.at], self.letters[self.at]
        self.at += 1
        if code == GONE:
            if text.strip(SPACES):
                self.duplicate += 1
            else:
                self.blank += 1
        else:
            self.truncated += code % 2
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.audit.append(letters)
        rows = [self.insert() for _ in letters[:-1]]
        edit = letters[-1]
        if edit == "D":
            self.cost += DELETE
            return rows
        self.cost += TRUNCATED * (code % 2)
        if edit == "R":
            self.cost += REROLE
            self.state = NEXT[self.state]
            return [*rows, self.out(NAMES[self.state], text)]
        self.state = KEPT[self.state][code // 2]
        return [*rows, self.out(role, text)]

    def end(self) -> list[tuple]:
        self.audit.append(self.tail)
        return [self.insert() for _ in self.tail]

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest())


def streamed(want: str, schema: pa.Schema):
    """Arrow function over rows sorted by conversation, each one's pieces first -> its repaired rows, or its report."""

    def batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        while part := list(itertools.islice(rows, 4096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    def walked(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None

        def ended() -> list[tuple]:
            rows = now.end()
            return rows if want == "rows" else [now.report()]

        for frame in frames:
            columns = [frame.column(c).to_pylist() for c in ("conv_id", "kind", "codes", "letters", "tail", "turn", "role", "text")]
            for conv_id, kind, codes, letters, end, turn, role, text in zip(*columns):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield from ended()
                    now = Conversation(conv_id)
                if kind == 1:
                    now.piece(codes, letters, end)
                elif kind == 2:
                    rows = now.row(turn, role, text)
                    if want == "rows":
                        yield from rows
        if now is not None:
            yield from ended()

    return lambda frames: batches(walked(frames))


def walk_through(rows: DataFrame, ids: DataFrame, want: str, kept: T.StructType, bits: int) -> DataFrame:
    empty = {"codes": "array<int>", "letters": "array<string>", "tail": "string", "turn": "long", "role": "string", "text": "string", "chunk": "long"}
    columns = ["conv_id", "kind", *empty]

    def shaped(d: DataFrame, kind: int) -> DataFrame:
        d = d.withColumn("kind", F.lit(kind))
        return d.select(*[F.col(c) if c in d.columns else F.lit(None).cast(empty[c]).alias(c) for c in columns])

    edits = stored(pieces(rows, bits), "repair-edits")
    d = shaped(ids.select("conv_id").distinct(), 0).unionByName(shaped(edits, 1)).unionByName(shaped(rows, 2))
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "chunk", "turn", "role", "text")
    return d.mapInArrow(streamed(want, to_arrow_schema(kept)), kept)


def repaired(conversations: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """conv_id, place (from 1), role, text: the rows of every conversation after its cheapest repair.

    Rows go by turn (nulls first), then role, then text; a null role or text counts as one space, and null
    conv_ids are one conversation.  Blank rows and later rows of equal role and text are deleted.  Further columns take no part.
    Only role initials count, in ASCII and as they are written.  A conversation without a row that stays gives none.
    """
    rows = cleaned(conversations)
    kind = conversations.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return walk_through(rows, rows, "rows", schema, bits)


def reports(conversations: DataFrame, ids: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """Per conv_id of ``ids``: gaps, blank, duplicate, truncated, illegal, cost, audit (edits in order), repaired_sha256.

    As ``repaired``; an id without rows gives zeros, an empty audit and the hash of the empty string.  The digest of one
    conversation is by its definition taken in order, so its rows stream through one task, which holds an edit
    and a symbol per row, as the audit does, but no texts.
    """
    rows = cleaned(conversations)
    longs = [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = T.StructType([T.StructField("conv_id", conversations.schema["conv_id"].dataType), *longs,
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    return walk_through(rows, ids, "report", schema, bits)


def damaged(conversations: DataFrame) -> DataFrame:
    """A test pattern: rows that drop, lose their text or its sentence marks, repeat or change role, by crc32 of ``conv_id:turn``.

    Nulls count as one space, in the key as in role and text.
    """
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    d = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20).alias("how"))
    d = d.filter("how <> 0").select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"), "how")
    return d.withColumn("copy", F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("how", "copy")

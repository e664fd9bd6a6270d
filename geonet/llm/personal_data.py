"""Personal data: patterns, and a semi-Markov conditional random field that finds what the patterns swallow.

The patterns take their longest match and drop it whole if it fails: two card numbers side by side are one of 32 digits, a
phone number before an address is one of too many.  The field segments the surroundings of digits and @ signs
jointly.  Every candidate segment is scored as a whole (its kind, digits, separators, check digit, groups, the
characters beside it) and by the kind before it, and dynamic programming over segments of at most MAX_TOKENS tokens picks the
boundaries and kinds of greatest score.  It is trained by conditional likelihood on a bounded sample of stretches that the
patterns label without a doubt; stretches in which a match of several numbers failed teach nothing.  A number beside a
letter or digit, or a phone number that begins with neither + nor a bracket, is no candidate.

All scans are linear in the text, also in very long digit runs or words.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from geonet.llm.common import few_at_once, free_name

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = KINDS
NONE = "none"
LABELS = (NONE, *KINDS)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does, and what a group took it keeps: both leave the matches as they are.
IP_RE = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_RE = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE_RE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile("[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
SPACES = frozenset(" \t\n\x0b\f\r")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
#: Tokens (digit runs, letter runs, single other characters) in a candidate segment, at most.
MAX_TOKENS = 24
#: Digit groups in a number, at most.
MAX_GROUPS = 8
#: Documents (about) and stretches (at most) that the field is trained on, and characters of such a stretch, at most.
TRAIN_DOCS, TRAIN_STRETCHES, TRAIN_CHARS = 4_000, 2_000, 200
#: A kind with fewer labelled examples is not added.
LEAST_EXAMPLES = 5
EPOCHS, RATE, DECAY = 4, 0.5, 1e-3

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    return out


def patterns(text: str) -> tuple[list[Span], list[Span]]:
    """(matches that hold, matches that fail), as (start, end, kind)."""
    good, bad = [(a, b, EMAIL) for a, b in emails(text)], []
    for kind, pattern in ((IP, IP_RE), (CARD, CARD_RE), (PHONE, PHONE_RE)):
        for m in pattern.finditer(text):
            s = m.group()
            if kind == IP:
                ok = octets(s.split("."))
            else:
                low, high = CARD_DIGITS if kind == CARD else PHONE_DIGITS
                d = digits_of(s)
                ok = low <= len(d) <= high and (kind == PHONE or luhn(d))
            (good if ok else bad).append((m.start(), m.end(), kind))
    rank = KINDS.index
    return sorted(good, key=lambda s: (s[0], rank(s[2]))), bad


def stretches(text: str) -> list[tuple[int, int]]:
    """[from, to) of neighbouring words that hold a digit or an @ sign, with one or two spaces between them."""
    out: list[tuple[int, int]] = []
    hit = TRIGGER.search(text)
    while hit:
        start, floor = hit.start(), out[-1][1] if out else 0
        while start > floor and text[start - 1] not in SPACES:
            start -= 1
        stop = SPACE.search(text, hit.end())
        end = stop.start() if stop else len(text)
        if out and text[floor:start] in (" ", "  "):
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        hit = TRIGGER.search(text, end)
    return out


def side(c: str) -> str:
    """Class of a character beside a segment."""
    return "edge" if not c or c in SPACES else "word" if c.isalnum() else "@" if c == "@" else c if c in "+-.%_" else "mark"


class Stretch:
    """Tokens of a stretch with all its candidate segments: end token -> (first token, kind, features)."""

    def __init__(self, body: str, left: str, right: str):
        self.tokens = TOKEN.findall(body)
        self.at = [0]
        for t in self.tokens:
            self.at.append(self.at[-1] + len(t))
        self.body, self.left, self.right = body, left, right
        self.segments: dict[int, list[tuple[int, str, list[str]]]] = defaultdict(list)
        signs = "@" in body
        for i, t in enumerate(self.tokens):
            if t[0] in "0123456789+(" and side(body[self.at[i] - 1] if i else left) != "word":
                self._numbers(i)
            if signs and t[0] in LOCAL:
                self._mails(i)

    def _add(self, i: int, j: int, kind: str, features: list[str]) -> None:
        before = self.body[self.at[i] - 1] if i else self.left
        after = self.body[self.at[j]] if j < len(self.tokens) else self.right
        whole = [f"{kind}", f"{kind} <{side(before)}", f"{kind} >{side(after)}", *(f"{kind} {f}" for f in features)]
        self.segments[j].append((i, kind, whole))

    def _numbers(self, i: int) -> None:
        tokens, groups, marks, count = self.tokens, [], "", 0
        for j in range(i, min(i + MAX_TOKENS, len(tokens))):
            t = tokens[j]
            if "0" <= t[0] <= "9":
                groups.append(t)
                count += len(t)
                if count > CARD_DIGITS[1] or len(groups) > MAX_GROUPS:
                    return
                if side(self.body[self.at[j + 1]] if j + 1 < len(tokens) else self.right) == "word":
                    continue
                if len(groups) == 4 and j == i + 6 and marks == "..." and octets(groups):
                    self._add(i, j + 1, IP, [f"sizes {sum(len(g) > 1 for g in groups)}"])
                if CARD_DIGITS[0] <= count and marks.strip(" -") == "" and len(marks) < len(groups):
                    digits = "".join(groups)
                    self._add(i, j + 1, CARD, [f"digits {count}", f"luhn {luhn(digits)}", f"groups {len(groups)}"])
                if PHONE_DIGITS[0] <= count <= PHONE_DIGITS[1] and tokens[i] in ("+", "("):
                    self._add(i, j + 1, PHONE, [f"digits {count}", f"begins {tokens[i]}", f"groups {'-'.join(str(len(g)) for g in groups)}",
                                                f"marks {''.join(sorted(set(marks)))}"])
            elif t not in "+(). -" or t == "+" and j > i:
                return
            else:
                marks += t

    def _mails(self, i: int) -> None:
        tokens, at, dots = self.tokens, -1, 0
        for j in range(i, min(i + MAX_TOKENS, len(tokens))):
            t = tokens[j]
            if t == "@":
                if at >= 0 or j == i:
                    return
                at = j
            elif at < 0:
                if t[0] not in LOCAL:
                    return
            elif t == ".":
                if j == at + 1 or tokens[j - 1] == ".":
                    return
                dots += 1
            elif t[0] not in LOCAL or t in "_%+":
                return
            elif dots and t != "-":
                self._add(i, j + 1, EMAIL, [f"dots {min(dots, 4)}", f"local {min(at - i, 4)}", f"last {'word' if t.isalpha() and len(t) > 1 else 'other'}"])

    def plain(self, j: int) -> list[str]:
        """Features of one token outside of every segment."""
        t = self.tokens[j]
        if "0" <= t[0] <= "9":
            return [f"none digits {min(len(t), 20)}"]
        return [f"none {t}"] if t in "@+" else []


class Field:
    """Weights by feature; zero for those never seen."""

    def __init__(self, weights: dict[str, float], kinds: tuple[str, ...]):
        self.weights, self.kinds = weights, kinds

    def score(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def steps(self, s: Stretch) -> list[list[tuple[int, str, float, list[str]]]]:
        """Per end token: (first token, label, score without the transition, features)."""
        out = [[]]
        for j in range(1, len(s.tokens) + 1):
            plain = s.plain(j - 1)
            here = [(j - 1, NONE, self.score(plain), plain)]
            here += [(i, kind, self.score(f), f) for i, kind, f in s.segments.get(j, ()) if kind in self.kinds]
            out.append(here)
        return out

    def best(self, s: Stretch) -> list[tuple[int, int, str]]:
        """(first token, end token, kind) of the segmentation of greatest score; on ties the earlier candidate, plain text first."""
        steps, get = self.steps(s), self.weights.get
        table: list[dict[str, tuple]] = [{NONE: (0.0, None)}]
        for here in steps[1:]:
            row: dict[str, tuple] = {}
            for i, label, score, _ in here:
                for last, (value, _) in table[i].items():
                    total = value + score + get(f"{last}>{label}", 0.0)
                    if label not in row or total > row[label][0]:
                        row[label] = (total, (i, last))
            table.append(row)
        j, out = len(s.tokens), []
        label = max(table[j], key=lambda k: table[j][k][0])
        while j:
            i, last = table[j][label][1]
            if label != NONE:
                out.append((i, j, label))
            j, label = i, last
        return out[::-1]

    def gradient(self, s: Stretch, gold: set[tuple[int, int, str]]) -> dict[str, float]:
        """Features of the labelled segmentation less their expectation under the model."""
        steps, get = self.steps(s), self.weights.get
        n = len(s.tokens)
        ahead: list[dict[str, float]] = [{NONE: 0.0}]
        for here in steps[1:]:
            parts: dict[str, list[float]] = defaultdict(list)
            for i, label, score, _ in here:
                parts[label].extend(v + score + get(f"{last}>{label}", 0.0) for last, v in ahead[i].items())
            ahead.append({label: logsum(v) for label, v in parts.items()})
        back: list[dict[str, float]] = [defaultdict(lambda: -math.inf) for _ in range(n + 1)]
        back[n] = dict.fromkeys(ahead[n], 0.0)
        total = logsum(list(ahead[n].values()))
        out: dict[str, float] = defaultdict(float)
        for j in range(n, 0, -1):
            for i, label, score, features in steps[j]:
                rest = back[j].get(label, -math.inf)
                if rest == -math.inf:
                    continue
                for last, v in ahead[i].items():
                    move = f"{last}>{label}"
                    step = score + get(move, 0.0) + rest
                    p = math.exp(v + step - total)
                    out[move] -= p
                    for f in features:
                        out[f] -= p
                    back[i][last] = logsum([back[i].get(last, -math.inf), step])
        j, chain = n, []
        ends = {end: (first, kind) for first, end, kind in gold}
        while j:
            first, kind = ends.get(j, (j - 1, NONE))
            features = s.plain(j - 1) if kind == NONE else next(f for i, k, f in s.segments[j] if i == first and k == kind)
            chain.append((kind, features))
            j = first
        last = NONE
        for kind, features in reversed(chain):
            for f in (f"{last}>{kind}", *features):
                out[f] += 1.0
            last = kind
        return out


def logsum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def labelled(body: str, left: str, right: str) -> tuple[Stretch, set[tuple[int, int, str]]] | None:
    """A stretch with its segments by the patterns; None if a match failed, or a span is no candidate or meets another."""
    good, bad = patterns(body)
    for a, b, kind in bad:
        if kind != CARD or not body[a:b].isdigit() and b - a >= CARD_DIGITS[0]:  # one number that fails is no card; of several some may be
            return None
    s = Stretch(body, left, right)
    token = {at: k for k, at in enumerate(s.at)}
    gold, stop = set(), 0
    for a, b, kind in good:
        i, j = token.get(a), token.get(b)
        if a < stop or i is None or j is None or not any(x == i and k == kind for x, k, _ in s.segments.get(j, ())):
            return None
        gold.add((i, j, kind))
        stop = b
    return s, gold


def train(rows: list[tuple[str, str, str]]) -> Field:
    """Field from stretches (body, character before, character after), by AdaGrad on the conditional likelihood."""
    examples = [e for e in (labelled(*r) for r in rows) if e is not None]
    count: dict[str, int] = defaultdict(int)
    for _, gold in examples:
        for _, _, kind in gold:
            count[kind] += 1
    kinds = tuple(k for k in KINDS if count[k] >= LEAST_EXAMPLES)
    examples = [(s, gold) for s, gold in examples if all(kind in kinds for _, _, kind in gold)]
    field, seen = Field({}, kinds), defaultdict(float)
    for _ in range(EPOCHS if kinds else 0):
        for s, gold in examples:
            for f, g in field.gradient(s, gold).items():
                g -= DECAY * field.weights.get(f, 0.0)
                if g:
                    seen[f] += g * g
                    field.weights[f] = field.weights.get(f, 0.0) + RATE * g / math.sqrt(seen[f])
    return field


def sampled_stretches(found: str = "array<struct<body:string,left:string,right:string>>"):
    @F.pandas_udf(found)
    def of(text: pd.Series) -> pd.Series:
        return pd.Series([[{"body": t[a:b], "left": t[max(a - 1, 0):a], "right": t[b:b + 1]} for a, b in stretches(t) if b - a <= TRAIN_CHARS]
                          for t in text], dtype=object)

    return of


def fit(docs: DataFrame, text: str = "text", train_docs: int = TRAIN_DOCS, train_stretches: int = TRAIN_STRETCHES) -> Field:
    """The field, trained on at most ``train_stretches`` stretches of about ``train_docs`` documents.

    Documents whose hash begins with as many zeros as leave that many are taken where they lie, so no text is moved; of their
    stretches those of least hash.  The labels are the patterns' own matches, so no labelled table is needed;
    without any the field adds nothing.
    """
    level = F.lit(64) - F.length(F.regexp_replace(F.bin(F.xxhash64(text)), "^0+", ""))
    d = docs.filter(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text"), level.alias("level"))
    found = d.groupBy("level").count().collect()  # at most 65 rows
    taken, least = 0, 0
    for level, n in sorted(found, reverse=True):
        if taken and taken + n > train_docs:
            break
        taken, least = taken + n, level
    d = d.filter(F.col("level") >= least).select(F.explode(sampled_stretches()(F.col("text"))).alias("s")).select("s.*").distinct()
    d = d.orderBy(F.xxhash64("body", "left", "right"), "body", "left", "right").limit(train_stretches)
    return train([tuple(r) for r in d.collect()])


def found_spans(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """(spans of the patterns, spans that the field adds); the latter overlap no other span."""
    if not text or not TRIGGER.search(text):
        return [], []
    base = patterns(text)[0]
    more: list[Span] = []
    if field.kinds:
        taken, k = sorted((a, b) for a, b, _ in base), 0
        for a, b in stretches(text):
            s = Stretch(text[a:b], text[max(a - 1, 0):a], text[b:b + 1])
            if not s.segments:
                continue
            for i, j, kind in field.best(s):
                x, y = a + s.at[i], a + s.at[j]
                while k < len(taken) and taken[k][1] <= x:
                    k += 1
                if all(q <= x or p >= y for p, q in taken[k:k + 2 * len(KINDS)]):
                    more.append((x, y, kind))
    return base, more


SPANS = "array<struct<kind:string,start:long,end:long>>"


def span_columns(field: Field):
    """Pandas function text -> base and added spans, each by start, then kind as listed."""

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": kind, "start": a, "end": b} for a, b, kind in spans]

    @F.pandas_udf(f"base {SPANS}, added {SPANS}")
    def of(text: pd.Series) -> pd.DataFrame:
        both = [found_spans(t, field) for t in text]
        return pd.DataFrame({"base": [rows(b) for b, _ in both], "added": [rows(m) for _, m in both]})

    return of


def personal_data(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: spans (kind, start, end) in code points, ends exclusive.

    Whole texts are searched; null and empty texts have no spans.  Base spans of different kinds may overlap.  Without a
    ``field`` one is trained on ``docs``.  Columns of these two names are replaced.
    """
    spans = free_name(docs, "_spans")
    d = few_at_once(docs).withColumn(spans, span_columns(field or fit(docs, text))(F.col(text)))
    keep = [F.col(c) for c in docs.columns if c.lower() not in ("base", "added")]
    return d.select(*keep, F.col(f"{spans}.base").alias("base"), F.col(f"{spans}.added").alias("added"))


def all_spans(base: Column, added: Column) -> Column:
    """Both kinds of spans by start, then kind as listed."""
    rank = lambda s: F.array_position(F.lit(list(KINDS)), s["kind"])
    keyed = F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind in angle brackets; overlapping spans by the first one's."""

    @F.pandas_udf("string")
    def masked(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(text, spans):
            parts, at = [], 0
            for s in found:
                if s["start"] >= at:
                    parts += [t[at:s["start"]], f"<{s['kind']}>"]
                at = max(at, s["end"])
            out.append(t if not parts else "".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    d = personal_data(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text")), "text", field)
    d = d.withColumn("masked", masked(F.col("text"), all_spans(F.col("base"), F.col("added"))))
    return d.select(*[F.col("masked").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, number of base spans by kind, SHA-256 of the base spans as text, all spans as text, number of added ones."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    d = personal_data(d)
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return d.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                    listed(all_spans(F.col("base"), F.col("added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))

"""Secret scan: fixed formats, and automata inferred from the credentials that these find.

The fixed formats (``KINDS``) give the base spans and, with them, labelled credentials.  For each kind
a probabilistic automaton is inferred from all its distinct credentials: a prefix acceptor over character classes
whose states are the position (from ``DEPTH`` on, one position) and the class before it, with frequencies that Spark counts
over every credential, and whose states are merged, in breadth-first order, into the first state whose
outgoing and stopping frequencies are compatible (Hoeffding bound) all the way down; the frequencies of the merged states
are then counted over every credential again.  Half of a kind's credentials (by hash) are learned, the others set its threshold.
A background automaton is inferred in the same way from all distinct long tokens that touch no base span and equal no
labelled credential.  The driver gets counts by state and by score (in steps of 1 / ``STEPS``), which do not grow with the texts.
Every long token of every text is
scored: log likelihood ratio per character of its best format against the background.  It is added as a
``grammar`` span if it scores above all but a ``FALSE_RATE`` share of the background and no lower than nearly all
labelled credentials of that kind do, and touches no base span.  Base spans are never changed.

Spans are code points, end exclusive; a base span is the whole match.  Defined cases: null and empty texts
have no span; a null id is scanned like any other; repeated rows each have their spans; with no labelled credential nothing is
added; other columns are not read (``redact`` keeps them, whatever their names).
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferrule.llm.common import give_back, map_arrow, map_batches, parts, slices, stored

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
ADDED = "grammar"
#: Tokens that are scored: runs of the characters and the least length of labelled credentials.
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")

#: Positions that are states of their own, and steps of scores in which thresholds are counted.
DEPTH = 64
STEPS = 1024
FALSE_RATE = 0.001
_KEYWORDS = re.compile(rb"password|passwd|secret|token|api_?key", re.I)
_CREDENTIAL = np.zeros(256, dtype=bool)
_CREDENTIAL[[ord(c) for c in "+/_.=-"]] = True
_CREDENTIAL[48:58] = _CREDENTIAL[65:91] = _CREDENTIAL[97:123] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_HEX = _DIGIT.copy()
_HEX[97:103] = True

#: Character classes of the automata, with the number of characters in each.
_CLASSES = {**{c: ("0", 10) for c in "0123456789"}, **{c: ("a", 6) for c in "abcdef"}, **{c: ("g", 20) for c in "ghijklmnopqrstuvwxyz"},
            **{c: ("A", 6) for c in "ABCDEF"}, **{c: ("G", 20) for c in "GHIJKLMNOPQRSTUVWXYZ"}}


_NAMES = sorted({k for k, _ in _CLASSES.values()} | set("+/_.=-"))
_N = len(_NAMES)                               # classes are 0 .. _N - 1; _N is the stop, and the class before the first
_CLASS = np.zeros(256, dtype=np.int64)
for _c in set(_CLASSES) | set("+/_.=-"):
    _CLASS[ord(_c)] = _NAMES.index(_CLASSES.get(_c, (_c, 1))[0])
_LOG_SIZE = np.log([{k: n for k, n in _CLASSES.values()}.get(k, 1) for k in _NAMES] + [1])


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the fixed formats."""
    out = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


class _Strings:
    """Strings as classes: one after the other, the longest first."""

    def __init__(self, strings: list[str]):
        size = np.array([len(x) for x in strings], dtype=np.int64)
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.data = _CLASS[np.frombuffer("".join(strings[i] for i in self.order).encode("ascii", "replace"), dtype=np.uint8)]
        self.start = np.cumsum(self.size) - self.size

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of state * (_N + 1) + symbol in the prefix acceptor, the stop included."""
        n, ends = len(self.size), self.start + self.size
        symbol = np.insert(self.data, ends, _N)
        first = self.start + np.arange(n)                       # each string has one symbol more
        at = np.arange(len(symbol)) - np.repeat(first, self.size + 1)
        before = np.concatenate([[_N], symbol[:-1]])
        before[first] = _N
        return np.unique((np.minimum(at, DEPTH) * (_N + 1) + before) * (_N + 1) + symbol, return_counts=True)

    def walk(self, to: np.ndarray):
        """(indexes in length order, states, symbols) at each position; the stop as the last symbol."""
        state = np.zeros(len(self.size), dtype=np.int64)
        active = len(state)
        for j in range(int(self.size[0]) + 1 if active else 0):
            longer = int(np.searchsorted(-self.size, -j, side="left"))           # strings with a character j
            if longer < active:
                yield slice(longer, active), state[longer:active], np.full(active - longer, _N)
            active = longer
            symbol = self.data[self.start[:active] + j]
            if active:
                yield slice(0, active), state[:active], symbol
                state[:active] = to[state[:active], symbol]


class Automaton:
    """A deterministic probabilistic automaton: transitions, and transition and stop counts, by state."""

    def __init__(self, strings: list[str] = (), alpha: float = 0.05):
        s = _Strings(list(strings))
        keys, counts = s.contexts()
        self._merge_states(keys, counts, alpha)
        self.learn(*self.used(s))

    def _merge_states(self, keys: np.ndarray, counts: np.ndarray, alpha: float = 0.05) -> None:
        """Transitions of the merged states from the counts of the prefix acceptor; the last state is the unknown."""
        m = _N + 1
        states, row = np.unique(keys // m, return_inverse=True)           # breadth first: by position
        count = np.zeros((len(states), m))
        np.add.at(count, (row, keys % m), counts)
        total = count.sum(1)
        share, width = count / total[:, None], math.sqrt(0.5 * math.log(2 / alpha)) / np.sqrt(total)
        after = np.minimum(states // m + 1, DEPTH)[:, None] * m + np.arange(_N)
        to = np.where(count[:, :_N] > 0, np.searchsorted(states, after), -1)
        apart = np.zeros((len(states), len(states)), dtype=bool)
        for c in range(m):
            apart |= np.abs(share[:, c, None] - share[None, :, c]) > width[:, None] + width[None, :]
        moves = [(np.flatnonzero(to[:, c] >= 0), c) for c in range(_N)]
        before = -1
        while before != (before := int(apart.sum())):           # all the way down
            for have, c in moves:
                apart[np.ix_(have, have)] |= apart[np.ix_(to[have, c], to[have, c])]
        red: list[int] = []
        into = np.zeros(len(states), dtype=np.int64)
        for q in range(len(states)):
            fits = np.flatnonzero(~apart[q, red])
            into[q] = fits[0] if len(fits) else len(red)
            if not len(fits):
                red.append(q)
        unknown = len(red)
        self.to = np.full((unknown + 1, _N), unknown)
        for c in range(_N):
            seen = np.flatnonzero(states % m == c)
            if len(seen):                                       # where a merged state has no such move
                self.to[:unknown, c] = into[seen[0]]
            for q in range(len(states) - 1, -1, -1):            # the first of its states decides
                if to[q, c] >= 0:
                    self.to[into[q], c] = into[to[q, c]]
        for k, q in enumerate(red):
            have = to[q] >= 0
            self.to[k, have] = into[to[q, have]]

    def used(self, s: _Strings) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of state * (_N + 1) + symbol over the strings."""
        n = np.zeros(len(self.to) * (_N + 1), dtype=np.int64)
        for _, state, symbol in s.walk(self.to):
            n += np.bincount(state * (_N + 1) + symbol, minlength=len(n))
        return np.flatnonzero(n), n[n > 0]

    def learn(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Probabilities from the counts, with one pseudo count for each class and the stop."""
        n = np.zeros(len(self.to) * (_N + 1))
        n[keys] = counts
        n = n.reshape(len(self.to), _N + 1)
        alphabet = max(2, int((n[:, :_N].sum(0) > 0).sum()) + 1)
        self.log = np.log((n + 0.5) / (n.sum(1, keepdims=True) + 0.5 * alphabet)) - _LOG_SIZE

    def log_likelihoods(self, s: _Strings) -> np.ndarray:
        out = np.zeros(len(s.size))
        for rows, state, symbol in s.walk(self.to):
            out[rows] += self.log[state, symbol]
        back = np.empty_like(out)
        back[s.order] = out
        return back

    def log_likelihood(self, s: str) -> float:
        """Natural log of the probability of s."""
        return float(self.log_likelihoods(_Strings([s]))[0])


class Grammar:
    def __init__(self, formats: dict[str, Automaton], background: Automaton):
        self.formats, self.background = formats, background
        self.least: dict[str, float] = {}

    def scores(self, values: list[str]) -> dict[str, np.ndarray]:
        s, n = _Strings(values), np.array([len(v) + 1 for v in values])
        other = self.background.log_likelihoods(s)
        return {k: (f.log_likelihoods(s) - other) / n for k, f in self.formats.items()}

    def accepted(self, values: list[str]) -> set[str]:
        ok = np.zeros(len(values), dtype=bool)
        if values:
            for k, x in self.scores(values).items():
                ok |= x > self.least[k]
        return {v for v, y in zip(values, ok) if y}

    def accepts(self, s: str) -> bool:
        return s in self.accepted([s])


def _runs(mask: np.ndarray, cut: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of True of at least that length, not across the cuts."""
    before, after = np.empty_like(mask), np.empty_like(mask)
    before[:1], before[1:] = False, mask[:-1]
    after[-1:], after[:-1] = False, mask[1:]
    inner = cut[(cut > 0) & (cut < len(mask))]
    before[inner] = False
    after[inner - 1] = False
    s, e = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    long = e - s >= least
    return s[long], e[long]


def _promising(data: np.ndarray, off: np.ndarray, tokens: bool) -> np.ndarray:
    """Rows that may have a span: a necessary condition, over whole texts."""
    at = []
    if len(data):
        raw = data.tobytes()
        at += [m.start() for m in _KEYWORDS.finditer(raw)]
        p = raw.find(b"AKIA")
        while p >= 0:
            at.append(p)
            p = raw.find(b"AKIA", p + 1)
        at += _runs(_HEX[data], off, 16)[0].tolist()
        if tokens:
            at += _runs(_CREDENTIAL[data], off, 12)[0].tolist()
    return np.unique(np.searchsorted(off, np.array(at, dtype=np.int64), side="right") - 1)


def _tokens(text: str, spans) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)
            if not any(s < m.end() and m.start() < e for _, s, e, _ in spans)]


_PLAIN = 1 << len(KINDS)                       # in ``found``: a token that is not labelled


def _counted(rows: DataFrame, count) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
    """(kind or background, half) -> keys and counts, summed by Spark; ``count`` gives them for the strings of one batch."""
    def run(b):
        values, found, half = b.column(0).to_pylist(), b.column(1).to_numpy(), b.column(2).to_numpy()
        out = []
        for k, name in enumerate((*KINDS, "background")):
            for x in (0, 1):
                mask = (found == _PLAIN) & (x == 0) if k == len(KINDS) else (found >> k & 1 == 1) & (half == x)
                if mask.any():
                    out += [(f, x, *pair) for f, pair in count(name, [values[i] for i in np.flatnonzero(mask)])]
        for f, x, keys, n in out:
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(keys), pa.string()), pa.array([x] * len(keys), pa.int32()),
                                              pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["name", "half", "key", "n"])
    got = map_arrow(rows, run, "name string, half int, key long, n long").groupBy("name", "half", "key").agg(F.sum("n").alias("n")).toArrow()
    out: dict[tuple[str, int], list] = {}
    for name, half, key, n in zip(*(got.column(c).to_pylist() for c in ("name", "half", "key", "n"))):
        out.setdefault((name, half), []).append((key, n))
    return {k: tuple(np.array(v, dtype=np.int64) for v in zip(*sorted(pairs))) for k, pairs in out.items()}


def _quantile(counts: tuple[np.ndarray, np.ndarray], share: float) -> int:
    """The least key that at least this share of the counts does not exceed."""
    keys, n = counts
    return int(keys[np.searchsorted(np.cumsum(n), share * n.sum())])


def infer(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> Grammar | None:
    """Automata from the credentials and tokens of all texts; None where there is no credential."""
    def find(b):
        for a, z, data, off in slices(b.column(0)):
            found: dict[str, int] = {}
            for d in _promising(data, off, True).tolist():
                text = data[off[d]:off[d + 1]].tobytes().decode("utf-8")
                base = base_spans(text)
                for kind, _, _, value in base:
                    found[value] = found.get(value, 0) | 1 << KINDS.index(kind)
                for _, _, value in _tokens(text, base):
                    found[value] = found.get(value, 0) | _PLAIN
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int32())], ["value", "found"])

    rows = map_arrow(docs.select(text_col), find, "value string, found int").groupBy("value").agg(F.expr("bit_or(found)").alias("found"))
    rows = stored(spark, rows.withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2)).cast("int")), "credentials")
    context = _counted(rows, lambda name, values: [(name, _Strings(values).contexts())])
    # a kind with credentials in one half only learns from that half and takes its threshold from it
    learned = {k: 0 if (k, 0) in context else 1 for k in KINDS if (k, 0) in context or (k, 1) in context}
    if not learned:
        return None
    shapes = {}
    for name, half in [*learned.items(), ("background", 0)]:
        shapes[name] = Automaton()
        if (name, half) in context:
            shapes[name]._merge_states(*context[name, half])
    walked = _counted(rows, lambda name, values: [(name, shapes[name].used(_Strings(values)))] if name in shapes else [])
    for name, half in [*learned.items(), ("background", 0)]:
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        shapes[name].learn(*walked.get((name, half), none))
    grammar = Grammar({k: shapes[k] for k in learned}, shapes["background"])

    def steps(name, values):
        at = {k: np.unique(np.floor(x * STEPS).astype(np.int64), return_counts=True) for k, x in grammar.scores(values).items()}
        return [(f"other {k}", x) for k, x in at.items()] if name == "background" else [(name, at[name])]
    scored = _counted(rows, steps)
    for k in learned:
        own = _quantile(scored[k, 1] if (k, 1) in scored else scored[k, 0], 0.02) / STEPS
        other = (_quantile(scored[f"other {k}", 0], 1 - FALSE_RATE) + 1) / STEPS if (f"other {k}", 0) in scored else 0.0
        grammar.least[k] = max(own, other, 0.0)
    return grammar


def _scan(grammar: Grammar | None, column: pa.Array):
    """(row, base spans, all spans) of the rows that have any."""
    for a, z, data, off in slices(column):
        rows = []
        for d in _promising(data, off, grammar is not None).tolist():
            text = data[off[d]:off[d + 1]].tobytes().decode("utf-8")
            base = base_spans(text)
            rows.append((a + d, base, _tokens(text, base) if grammar else []))
        good = grammar.accepted(list({v for _, _, tokens in rows for _, _, v in tokens})) if grammar else set()
        for row, base, tokens in rows:
            more = [(ADDED, s, e, v) for s, e, v in tokens if v in good]
            if base or more:
                yield row, base, sorted(base + more, key=lambda s: (s[1], (*KINDS, ADDED).index(s[0])))


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of ``docs``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    grammar = spark.sparkContext.broadcast(infer(spark, d))

    def run(b):
        n = b.num_rows
        counts = np.zeros((n, 3), dtype=np.int64)
        sha, spans = [hashlib.sha256(b"").hexdigest()] * n, [""] * n
        for row, base, every in _scan(grammar.value, b.column(1)):
            for k, _, _, _ in base:
                counts[row, KINDS.index(k)] += 1
            sha[row] = hashlib.sha256(_joined(base).encode()).hexdigest()
            spans[row] = _joined(every)
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(counts[:, k]) for k in range(3)), pa.array(sha), pa.array(spans)],
                                         ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return map_arrow(d, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(spark: SparkSession, docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the credentials of each text replaced by ``mark``; all rows and columns stay."""
    grammar = spark.sparkContext.broadcast(infer(spark, docs.select(F.col(text_col).alias("text")), "text"))
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                texts = {}
                for row, _, every in _scan(grammar.value, b.column(at)):
                    text, out, p = b.column(at)[row].as_py(), [], 0
                    for s, e in _union([(e - len(v), e) for _, _, e, v in every]):
                        out += [text[p:s], mark]
                        p = e
                    texts[row] = "".join(out) + text[p:]
                column = b.column(at)
                if texts:
                    column = pa.array([texts.get(i, t) for i, t in enumerate(column.to_pylist())], column.type)
                yield from parts(pa.RecordBatch.from_arrays([column if k == at else c for k, c in enumerate(b.columns)], b.schema.names))
                del b, column, texts
                give_back()
    return map_batches(docs, run, StructType([StructField(f.name, StringType() if f.name == text_col else f.dataType) for f in docs.schema]))


def _union(spans):
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out

"""Secrets: fixed patterns, and formats learnt from labelled credentials by grammar inference.

Credentials (labelled ones, or the values that the fixed patterns found) become a prefix tree over character classes,
whose states are the sets of places in the strings that a prefix leads to. States that are statistically compatible are
merged into a probabilistic automaton. Deep states hold few strings each, so compatibility also looks at what is pooled
below a state: how much of the strings is left, and the classes of the next few characters. Formats of fixed length so
keep a state for each place, and formats of any length come down to loops. Within a state the characters of a class have
their own shares, so that fixed prefixes are learnt.

A second automaton is inferred from ordinary tokens. Every token of the fixed patterns' characters, six or more of them,
is a candidate; it is a secret if it ends where credentials of its format end, if its likelihood ratio beats the odds of
ordinary tokens to credentials, and if it fits the credentials' automaton as well as credentials that weren't used for it.
A beginning of a credential is thus no credential, however well its characters fit. Unlabelled credentials among the ordinary tokens
leave them, and their automaton is inferred anew until none is left. Training takes bounded samples, the same ones each
time; scanning covers all texts where they lie.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import staged

KINDS = ("assign", "access", "hex")
#: Credentials and ordinary tokens that the automata are inferred from, at most.
SAMPLE = 3_000
#: Confidence of the compatibility tests, places that a state needs for one of its own, places looked ahead.
ALPHA, LEAST_COUNT, AHEAD = 0.01, 12, 3
LEAST_CHARS = 6
#: Characters of a candidate that are scored: all; of a training string: so many, which also bounds the automaton.
LONGEST = 128
#: Tokens whose verdict a task remembers, and the characters of the longest that it remembers.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 128
#: How far below the first percentile of unseen credentials' likelihoods a character a candidate may lie.
MARGIN = 0.15
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_KEYWORD = re.compile(r"passw(?:or)?d|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST_CHARS)
_CLASSES = {"a": "abcdef", "z": "ghijklmnopqrstuvwxyz", "A": "ABCDEF", "Z": "GHIJKLMNOPQRSTUVWXYZ", "0": "0123456789", "+": "+/", "_": "_-", ".": ".", "=": "="}
_CLASS = str.maketrans({c: k for k, group in _CLASSES.items() for c in group})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then by kind as listed; matches that are too short are dropped."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda f: (f[0], f[2]))]


class Automaton:
    """A probabilistic automaton merged from the prefix tree of some strings."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.strings = [s[:LONGEST] for s in strings]
        self.kinds = [s.translate(_CLASS) for s in self.strings]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.places: list[list[tuple[int, int]]] = [[(i, 0) for i in range(len(strings))]]  # (string, characters read)
        self.next: list[dict[str, int]] = [{}]
        self._infer()
        self._count()
        del self.strings, self.kinds, self.places

    def _split(self, places: list[tuple[int, int]]) -> dict[str, list[tuple[int, int]]]:
        """The places that each next class leads to."""
        out: dict[str, list[tuple[int, int]]] = {}
        for i, d in places:
            if d < len(self.kinds[i]):
                out.setdefault(self.kinds[i][d], []).append((i, d + 1))
        return out

    def _evidence(self, places: list[tuple[int, int]]) -> tuple[int, list[dict]]:
        """Count, and counts of: what is left (in steps that widen), and the class (or end) at each of the next places."""
        left: dict = {}
        ahead: list[dict] = [{} for _ in range(AHEAD)]
        for i, d in places:
            k = self.kinds[i]
            n = len(k) - d
            left[n] = left.get(n, 0) + 1
            for j in range(AHEAD):
                c = k[d + j] if d + j < len(k) else "$"
                ahead[j][c] = ahead[j].get(c, 0) + 1
        return len(places), [left, *ahead]

    def _compatible(self, p: tuple[int, list[dict]], q: tuple[int, list[dict]]) -> bool:
        """Hoeffding's bound on the shares of classes, and the same on the distribution function of what is left."""
        n, m = p[0], q[0]
        if min(n, m) < LEAST_COUNT:
            # too few to tell: only what was never seen there speaks against it
            return all(set(y if n >= m else x) <= set(x if n >= m else y) for x, y in zip(p[1], q[1], strict=True))
        most = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        for x, y in zip(p[1][1:], q[1][1:], strict=True):
            if any(abs(x.get(c, 0) / n - y.get(c, 0) / m) > most for c in x.keys() | y.keys()):
                return False
        a = b = 0
        for k in sorted(p[1][0].keys() | q[1][0].keys()):
            a, b = a + p[1][0].get(k, 0), b + q[1][0].get(k, 0)
            if abs(a / n - b / m) > most:
                return False
        return True

    def _infer(self) -> None:
        red, seen = [0], [self._evidence(self.places[0])]
        fringe: dict[tuple[int, str], list[tuple[int, int]]] = {(0, c): x for c, x in self._split(self.places[0]).items()}
        while fringe:
            p, c = max(fringe, key=lambda f: (len(fringe[f]), -f[0], f[1]))
            blue = fringe.pop((p, c))
            own = self._evidence(blue)
            same = next((k for k, e in enumerate(seen) if self._compatible(e, own)), None)
            if same is None:
                red.append(len(self.next))
                seen.append(own)
                self.next[p][c] = red[-1]
                self.next.append({})
                self.places.append(blue)
                fringe |= {(red[-1], k): x for k, x in self._split(blue).items()}
                continue
            self.next[p][c] = same
            todo = [(same, blue)]
            while todo:  # the places flow on along the merged state's transitions
                q, more = todo.pop()
                self.places[q] += more
                n, counts = self._evidence(more)
                seen[q] = (seen[q][0] + n, [{k: x.get(k, 0) + y.get(k, 0) for k in x.keys() | y.keys()} for x, y in zip(seen[q][1], counts, strict=True)])
                for k, x in self._split(more).items():
                    if k in self.next[q]:
                        todo.append((self.next[q][k], x))
                    else:
                        fringe[q, k] = fringe.get((q, k), []) + x

    def _count(self) -> None:
        """Reads all strings once more: how often each state ends, goes on by a class, and by a character."""
        n = len(self.next)
        self.total, self.end = [0] * n, [0] * n
        self.by_kind: list[dict[str, int]] = [{} for _ in range(n)]
        self.by_char: list[dict[str, int]] = [{} for _ in range(n)]
        for s, kinds in zip(self.strings, self.kinds, strict=True):
            at = 0
            for c, k in zip(s, kinds, strict=True):
                self.total[at] += 1
                self.by_kind[at][k] = self.by_kind[at].get(k, 0) + 1
                self.by_char[at][c] = self.by_char[at].get(c, 0) + 1
                at = self.next[at][k]
            self.total[at] += 1
            self.end[at] += 1

    def ends(self, s: str) -> bool | None:
        """Whether a training string ended in the state that s leads to; None where s takes a class that wasn't seen."""
        at = 0
        for k in s.translate(_CLASS):
            at = self.next[at].get(k)
            if at is None:
                return None
        return self.end[at] > 0

    def logp(self, s: str) -> float:
        """Log-likelihood, the end included. A class that wasn't seen there has a share of a hundredth and leads nowhere, from
        where all classes are alike."""
        at, total = 0, 0.0
        for c, k in zip(s, s.translate(_CLASS), strict=True):
            size = len(_CLASSES[k])
            if at is None:
                total += math.log(0.1 / size)
                continue
            n = self.by_kind[at].get(k, 0)
            total += math.log((n + 0.01) / (self.total[at] + 0.1)) + math.log((self.by_char[at].get(c, 0) + 0.5) / (n + 0.5 * size))
            at = self.next[at].get(k)
        return total + math.log(0.1 if at is None else (self.end[at] + 0.01) / (self.total[at] + 0.1))


class Formats:
    """The two automata, and what a candidate has to reach. Without credentials nothing is a secret by its format."""

    def __init__(self, credentials: list[str], ordinary: list[str], odds: float = 100.0):
        """odds: of ordinary tokens to credentials among all candidates."""
        self.usable, self.known = bool(credentials), {}
        if self.usable:
            # a fifth isn't shown to the automaton: it tells how well unseen credentials fit
            unseen = credentials[::5] if len(credentials) >= 25 else credentials
            self.secret = Automaton([s for i, s in enumerate(credentials) if i % 5] if len(credentials) >= 25 else credentials)
            self.lengths = {len(s) for s in credentials}
            fit = sorted(self.secret.logp(s) / (len(s) + 1) for s in unseen)
            self.least_fit = fit[len(fit) // 100] - MARGIN
            self.least = math.log(max(odds, 1.0))
            self.ordinary = Automaton(ordinary)
            while len(rest := [s for s in ordinary if not self._judged(s)]) < len(ordinary):
                ordinary = rest
                self.ordinary = Automaton(ordinary)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def _ends(self, s: str) -> bool:
        """Whether credentials end where s does; off the automaton's paths, whether any is as long. Strings over LONGEST, of
        which the automaton knows the beginnings only, are judged by length alone."""
        found = self.secret.ends(s) if len(s) < LONGEST else None
        return len(s) in self.lengths if found is None else found

    def _judged(self, s: str) -> bool:
        if not self._ends(s):
            return False
        p = self.secret.logp(s)
        return p / (len(s) + 1) >= self.least_fit and p - self.ordinary.logp(s) > self.least

    def is_secret(self, s: str) -> bool:
        if not self.usable:
            return False
        found = self.known.get(s)
        if found is None:
            found = self._judged(s)
            if len(s) <= LONGEST_REMEMBERED:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[s] = found
        return found


def distinct_values(hashes: list[int], sample: int) -> float:
    """How many distinct values there are, of which `hashes` (63 bits, ascending) are the least `sample`: their number where
    these are all, else what their density tells."""
    return len(hashes) * 2.0**63 / (hashes[-1] + 1) if len(hashes) >= sample else float(len(hashes))


def candidates(text: str, base: list[tuple[int, int, str]]):
    """(start, end) of each run of the patterns' characters, or of what fixed spans leave of it, of LEAST_CHARS or more."""
    starts = iter(sorted(base))
    span = next(starts, None)
    for m in _CANDIDATE.finditer(text):
        at, end = m.span()
        while span is not None and span[0] < end:
            if span[1] > at:
                if span[0] - at >= LEAST_CHARS:
                    yield at, span[0]
                at = span[1]
                if at >= end:
                    break
            span = next(starts, None)
        if end - at >= LEAST_CHARS:
            yield at, end


def learn(docs: DataFrame, text_col: str = "text", credentials: DataFrame | None = None, sample: int = SAMPLE) -> Formats:
    """Formats from labelled credentials (one string column), or from the values that the fixed patterns find in docs.

    All texts are read. Of distinct credentials and of distinct ordinary tokens those with the least hashes go to the
    driver, at most `sample` of each; every batch of rows passes on no more. The odds between the two are those of their
    numbers of distinct values; where the sample does not hold all of either, the density of its hashes tells its number, so
    the odds do not depend on `sample`. A value that is a credential anywhere is no ordinary
    token. Null and empty texts have neither; an empty table gives formats that find nothing.
    """

    def values(it):
        for b in it:
            own, other = set(), set()
            for t in b.column(0):
                text = t.as_py() or ""
                spans = base_spans(text)
                own |= {text[s:e] if kind != "assign" else _ASSIGN.match(text, s).group(2) for s, e, kind in spans}
                other |= {text[s:e] for s, e in candidates(text, spans)}
            rows = [(xxhash.xxh64_intdigest(v.encode()) >> 1, v, secret) for some, secret in ((own, True), (other - own, False)) for v in some]
            rows = heapq.nsmallest(2 * sample, (r for r in rows if r[2])) + heapq.nsmallest(2 * sample, (r for r in rows if not r[2]))
            if rows:
                yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.bool_()))], names=["h", "value", "secret"])

    found = staged(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(values, "h long, value string, secret boolean").groupBy("h", "value").agg(F.max("secret").alias("secret")), "values")
    least = lambda df: df.orderBy("h", "value").limit(sample).collect()
    own, ordinary = least(found.where("secret")), least(found.where("not secret"))
    if credentials is not None:
        given = credentials.select(F.col(credentials.columns[0]).cast("string").alias("value")).where("value is not null and value != ''").distinct()
        own = given.select(F.shiftrightunsigned(F.xxhash64("value"), 1).alias("h"), "value").orderBy("h", "value").limit(sample).collect()
    names = {r.value for r in own}
    tokens = [r.value for r in ordinary if r.value not in names]
    many, few = (distinct_values([r.h for r in rows], sample) for rows in (ordinary, own))
    return Formats([r.value for r in own], tokens, many / max(1.0, few))


def spans_of(text: str, formats: Formats | None) -> list[tuple[int, int, str]]:
    """The fixed patterns' spans and, of kind 'format', candidates outside them that have a learnt format; of an empty text none."""
    base = base_spans(text)
    if formats is None or not formats.usable:
        return base
    more = [(s, e, "format") for s, e in candidates(text, base) if formats.is_secret(text[s:e])]
    order = {k: i for i, k in enumerate((*KINDS, "format"))}
    return sorted(base + more, key=lambda f: (f[0], order[f[2]]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, formats: Formats | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans): one row per row of docs.

    Null texts are empty; repeated rows come back repeated; other columns aren't read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(formats)

    def run(it):
        for b in it:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                spans = spans_of(t.as_py() or "", shared.value)
                base = [x for x in spans if x[2] != "format"]
                n = [sum(x[2] == k for x in base) for k in KINDS]
                rows.append((i, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string").withColumnRenamed("id", id_col)

"""Secret scans: fixed patterns, plus formats learned as probabilistic automata by grammar inference.

Training (on the driver, on a bounded, generated sample: ``PER_FORMAT`` labelled credentials of each format and
``NEGATIVES`` ordinary strings): the strings of a format make a prefix tree with counts; states are merged, in the order of
the tree, when their symbol and end frequencies differ by less than Hoeffding bounds, and so do those of their successors
(the ALERGIA test). One automaton is learned per format and one for ordinary strings. Symbols are classes: digits, hexadecimal
and other letters by case; other characters stand for themselves.

Scan: every run of ``SHORTEST`` or more token characters in every text is a candidate, whatever patterns found in or around it; runs end
at dots, so the parts of a dotted key are candidates each. A candidate's evidence is the best format's log likelihood less that of
ordinary strings. It is a secret if that is over a margin, which a second labelled sample sets: halfway between what one in ``RARE`` of the
ordinary strings and all but one in ``WEAK`` of the credentials exceed. A secret that lies inside a span of the fixed patterns adds nothing; any other is a span of its own. Different candidates are scored once in
a while of the scan, many at a time. Spans are code points of the whole text, end exclusive.

Cases: a null or empty text has no spans; very long texts, and very long runs in them, are scanned whole; ties between formats change nothing;
repeated rows are scanned each; an empty table gives an empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from presslens.llm.common import documents, lean, text_bytes

PER_FORMAT = 400
NEGATIVES = 4000
ALPHA = 0.05
SEED = 11
ASSIGN = re.compile(rb"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
SHORTEST = 8
RARE, WEAK = 1000, 20
JUMP = 0.02
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Candidates whose verdicts a worker remembers, bytes of text that it scans between two scorings, length up to which they are scored together.
REMEMBERED = 200_000
SCAN_BYTES = 1 << 20
TOGETHER = 256
KINDS = ("assign", "access", "hex", "auto")

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_CLASS = {ord(c): ord("x" if c in "abcdef" else "l") for c in _LOWER} | {ord(c): ord("X" if c in "ABCDEF" else "U") for c in _UPPER} | {ord(c): ord("d") for c in _DIGITS}
_CLASSES = bytes(_CLASS.get(i, i) for i in range(256))
ALPHABET = 12
#: Symbols by number: the five classes, then what stands for itself, then all else.
_INDEX = {ord(c): i for i, c in enumerate("xlXUd+/_=-")}
SYMBOLS = len(_INDEX) + 1
_SYMBOL = np.array([_INDEX.get(c, SYMBOLS - 1) for c in _CLASSES], np.uint8)


def _pick(r: random.Random, letters: str, n: int) -> str:
    return "".join(r.choice(letters) for _ in range(n))


def credentials(seed: int, per_format: int = PER_FORMAT) -> dict[str, list[str]]:
    """Labelled credentials by format, generated."""
    r, mixed, hexes = random.Random(seed), _LOWER + _UPPER + _DIGITS, "0123456789abcdef"
    makers = {
        "hex": lambda: _pick(r, hexes, r.choice((24, 32, 40, 64))),
        "upper_id": lambda: r.choice(("AKIA", "ASIA")) + _pick(r, _UPPER + "234567", 16),
        "prefixed": lambda: r.choice(("ghp_", "gho_", "glpat-", "sk_live_", "pk_test_", "npm_")) + _pick(r, mixed, r.randint(16, 40)),
        "chat": lambda: "xoxb-" + _pick(r, _DIGITS, 12) + "-" + _pick(r, _DIGITS, 12) + "-" + _pick(r, mixed, 24),
        "base64": lambda: _pick(r, mixed + "+/", r.choice((40, 43, 44, 64))) + r.choice(("", "=")),
        "url_safe": lambda: _pick(r, mixed + "-_", r.randint(22, 48)),
        "uuid": lambda: "-".join(_pick(r, hexes, n) for n in (8, 4, 4, 4, 12)),
        "lower_id": lambda: _pick(r, _LOWER[:5], r.randint(2, 4)) + r.choice("-_") + _pick(r, _LOWER + _DIGITS, r.randint(20, 36)),
    }
    return {name: [make() for _ in range(per_format)] for name, make in makers.items()}


def ordinary(seed: int, n: int = NEGATIVES) -> list[str]:
    """Strings that are no credentials: words, compounds, names, paths, numbers, dates, rules."""
    r = random.Random(seed)

    def word() -> str:
        return "".join(_pick(r, "bcdfghjklmnpqrstvwxyz", r.randint(1, 2)) + _pick(r, "aeiou", r.randint(1, 2)) for _ in range(r.randint(1, 4)))

    def long(join: str, shape=str) -> str:
        least = r.choice((SHORTEST, 12, 20))
        out = shape(word())
        while len(out) < least:
            out += join + shape(word())
        return out

    makers = [
        lambda: long(""),
        lambda: _pick(r, _LOWER, r.randint(8, 16)),
        lambda: _pick(r, _UPPER, r.randint(8, 16)),
        lambda: _pick(r, _UPPER, r.randint(1, 5)) + _pick(r, _LOWER, r.randint(4, 14)),
        lambda: word() + _pick(r, _DIGITS, r.randint(1, 4)) + r.choice(("", "_", "-")) + word(),
        lambda: _pick(r, _UPPER, r.randint(1, 4)) + r.choice(("", "-")) + _pick(r, _DIGITS, r.randint(1, 4)) + r.choice(("-", "_", "")) + r.choice((word(), word().capitalize(), _pick(r, _UPPER, r.randint(1, 4)))),
        lambda: word()[:2] + "".join(r.choice((word().capitalize(), _pick(r, _DIGITS, r.randint(1, 2)))) for _ in range(r.randint(2, 4))),
        lambda: r.choice("-_/").join(r.choice((word(), word().capitalize(), _pick(r, _UPPER, r.randint(2, 5)), _pick(r, _DIGITS, r.randint(1, 4)))) for _ in range(r.randint(2, 5))),
        lambda: _pick(r, _UPPER, r.randint(2, 5)) + "".join(word().capitalize() for _ in range(r.randint(1, 3))),
        lambda: long("").capitalize(),
        lambda: long("").upper(),
        lambda: long("-"),
        lambda: long("_"),
        lambda: long("/"),
        lambda: long("", str.capitalize),
        lambda: long("_", str.upper),
        lambda: _pick(r, _DIGITS, r.randint(8, 32)),
        lambda: long("-") + r.choice(("", "-", "_")) + str(r.randint(1, 9999)),
        lambda: f"{r.randint(1900, 2099)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}",
        lambda: "-".join(_pick(r, _DIGITS, r.randint(2, 4)) for _ in range(r.randint(3, 5))),
        lambda: f"{long('-')}-{r.randint(1900, 2099)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}",
        lambda: long("/") + str(r.randint(1, 9999)),
        lambda: r.choice("-=_+/") * r.randint(8, 60),
    ]
    out: list[str] = []
    while len(out) < n:
        made = r.choice(makers)()
        if len(made) >= SHORTEST:
            out.append(made)
    return out


class Automaton:
    """A deterministic probabilistic automaton, learned by merging compatible states of a prefix tree."""

    def __init__(self, samples: list[str], alpha: float = ALPHA, restart: bool = False):
        """``restart``: a symbol that no sample has in a state leads back to the start, at the price of a rare event, as compounds do."""
        self.restart = restart
        counts = np.bincount(_SYMBOL[np.frombuffer("".join(samples).encode(), np.uint8)], minlength=SYMBOLS) + 0.1
        self.single = np.log(counts / counts.sum())
        self.next: list[dict[int, int]] = [{}]
        self.count: list[dict[int, int]] = [{}]
        self.ends = [0]
        self.total = [0]
        for sample in samples:
            at = 0
            for c in sample.encode().translate(_CLASSES):
                self.total[at] += 1
                self.count[at][c] = self.count[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.ends.append(0)
                    self.total.append(0)
                at = self.next[at][c]
            self.total[at] += 1
            self.ends[at] += 1
        self._merge_states(math.sqrt(0.5 * math.log(2 / alpha)))

    def _differ(self, f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) >= bound * (n1**-0.5 + n2**-0.5)

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if self._differ(self.ends[a], self.total[a], self.ends[b], self.total[b], bound):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if self._differ(self.count[a].get(c, 0), self.total[a], self.count[b].get(c, 0), self.total[b], bound):
                    return False
                if c in self.next[a] and c in self.next[b] and self.next[a][c] != self.next[b][c]:
                    stack.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the subtree at ``tree`` to the automaton at ``into``."""
        stack = [(into, tree)]
        while stack:
            a, b = stack.pop()
            self.ends[a] += self.ends[b]
            self.total[a] += self.total[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
                if c in self.next[a]:
                    stack.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_states(self, bound: float) -> None:
        red, done = [0], {0}
        while found := next(((r, c) for r in red for c in sorted(self.next[r]) if self.next[r][c] not in done), None):
            a, c = found
            b = self.next[a][c]
            match = next((r for r in red if self._compatible(r, b, bound)), None)
            if match is None:
                red.append(b)
                done.add(b)
            else:
                self.next[a][c] = match
                self._fold(match, b)
        place = {s: i for i, s in enumerate(red)}
        self.states = len(red)
        self.next_state = np.tile(np.arange(self.states, dtype=np.int32)[:, None], (1, SYMBOLS))
        self.weight = np.empty((self.states, SYMBOLS))
        self.end = np.empty(self.states)
        for s, i in place.items():
            total = self.total[s] + 0.1 * ALPHABET
            # A symbol that no sample has here leaves the state as it is, or leads back to the start.
            self.weight[i] = self.single + math.log(JUMP) if self.restart else math.log(0.1 / total) - 1.0
            if self.restart:
                self.next_state[i] = 0
            self.end[i] = math.log((self.ends[s] + 0.1) / total)
            for c, to in self.next[s].items():
                self.weight[i, _INDEX[c]] = math.log((self.count[s][c] + 0.1) / total)
                self.next_state[i, _INDEX[c]] = place[to]
        del self.next, self.count, self.ends, self.total

    def log_likelihoods(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of strings given as rows of symbols, the longest first."""
        state, out = np.zeros(len(lengths), np.int32), np.zeros(len(lengths))
        for column in range(symbols.shape[1]):
            n = int(np.searchsorted(-lengths, -column, "left"))  # those longer than the column
            c = symbols[:n, column]
            out[:n] += self.weight[state[:n], c]
            state[:n] = self.next_state[state[:n], c]
        return out + self.end[state]


class Scorer:
    """Format likelihood of candidates against ordinary strings."""

    def __init__(self, positives: dict[str, list[str]], negatives: list[str], more_positives: dict[str, list[str]], more_negatives: list[str]):
        self.formats = {name: Automaton(samples) for name, samples in positives.items()}
        self.plain = Automaton(negatives, restart=True)
        low, high = (np.sort(self.evidence([s.encode() for s in strings])) for strings in ([s for v in more_positives.values() for s in v], more_negatives))
        self.margin = float(max(0.0, (low[len(low) // WEAK] + high[-1 - len(high) // RARE]) / 2))

    def evidence(self, tokens: list[bytes]) -> np.ndarray:
        """The best format's log likelihood less that of ordinary strings."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        out = np.empty(len(tokens))
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = int(lengths[order[at]])
            some = order[at : at + 1] if longest > TOGETHER else order[at : at + 4096]
            size = lengths[some]
            symbols = np.zeros((len(some), longest), np.uint8)
            flat = _SYMBOL[np.frombuffer(b"".join(tokens[i] for i in some.tolist()), np.uint8)]
            symbols[np.arange(longest)[None, :] < size[:, None]] = flat
            best = np.max([a.log_likelihoods(symbols, size) for a in self.formats.values()], axis=0)
            out[some] = best - self.plain.log_likelihoods(symbols, size)
            at += len(some)
        return out

    def secrets(self, tokens: list[bytes]) -> list[bool]:
        return (self.evidence(tokens) > self.margin).tolist() if tokens else []


def train(seed: int = SEED, per_format: int = PER_FORMAT, negatives: int = NEGATIVES) -> Scorer:
    return Scorer(credentials(seed, per_format), ordinary(seed, negatives), credentials(seed + 1, per_format), ordinary(seed + 1, negatives))


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) in bytes, of the fixed patterns."""
    spans = []
    if b"=" in raw or b":" in raw:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if m.end(1) - m.start(1) >= 8]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw)]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(raw)]


class Scanner:
    """All spans of many texts; the verdicts on candidates are remembered for a while."""

    def __init__(self, scorer: Scorer | None):
        self.scorer, self.known = scorer, {}

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        found = [base_spans(raw) for raw in texts]
        if self.scorer is None:
            return [sorted(f) for f in found]
        candidates = [set(CANDIDATE.findall(raw)) for raw in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = list(set().union(*candidates) - self.known.keys())
        self.known.update(zip(fresh, self.scorer.secrets(fresh), strict=True))
        for raw, own, spans in zip(texts, candidates, found, strict=True):
            if any(map(self.known.__getitem__, own)):
                base = list(spans)
                for m in CANDIDATE.finditer(raw):
                    if self.known[m.group()] and not any(a <= m.start() and m.end() <= b for a, _, b in base):
                        spans.append((m.start(), 3, m.end()))
        return [sorted(f) for f in found]


def in_points(raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    if raw.isascii():
        return spans
    places, at, points = {}, 0, 0
    for b in sorted({x for s, _, e in spans for x in (s, e)}):
        points += len(raw[at:b].decode("utf-8", "replace"))
        at, places[b] = b, points
    return [(places[s], k, places[e]) for s, k, e in spans]


_OUT = pa.schema([("doc_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def _row(doc_id: int | None, raw: bytes, spans: list[tuple[int, int, int]]) -> tuple:
    spans = in_points(raw, spans)
    said = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
    base = ",".join(x for x, (_, k, _) in zip(said, spans, strict=True) if k < 3)
    n = [sum(k == i for _, k, _ in spans) for i in range(3)]
    return doc_id, [KINDS[k] for _, k, _ in spans], [s for s, _, _ in spans], [e for _, _, e in spans], *n, hashlib.sha256(base.encode()).hexdigest(), ",".join(said)


def _scanner(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(scorer)

        def made(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            rows = [_row(i, t, s) for i, t, s in zip(ids, texts, scanner.spans(texts), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OUT.types, strict=True)], schema=_OUT)

        for batch in lean(batches):
            ids, texts, held = [], [], 0
            for doc_id, raw in zip(batch.column(batch.schema.get_field_index("doc_id")).to_pylist(), text_bytes(batch), strict=True):
                ids.append(doc_id)
                texts.append(raw)
                held += len(raw)
                if held > SCAN_BYTES:
                    yield made(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield made(ids, texts)

    return run


def scan_secrets(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Each document's spans as arrays (kinds, starts, ends), their counts and digests."""
    schema = "doc_id long, kinds array<string>, starts array<long>, ends array<long>, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(_scanner(scorer or train()), schema)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")

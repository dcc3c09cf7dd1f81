"""Secrets in texts: rules that always hold, and a character convolutional network for what they miss.

1. Base rules find assignments to names of secrets, access keys and long hexadecimal strings.
2. Candidates are all those findings, every other long token with a digit, and every token that stands where a value
   is assigned to a name, however it is made up. Each is taken whole, with the characters around it.
3. A network in numpy (a convolution over characters, rectified, the maximum over all places, a logistic
   output) learns from a bounded sample of candidates which of them the rules found, each with its own name and with
   a name of chance. Characters of the context and of the candidate have different symbols, so it sees which is which.
   There are two networks, each learned from one half (by a checksum) and used for the other: a secret that the
   rules have missed is labelled as none, so it must not be scored by what has learned that. On the half it has
   not seen, an isotonic fit, weighted to the numbers of all candidates, makes probabilities of a network's scores.
4. Calibrated scores of all candidates are counted in bins. The threshold is one half (a candidate that is more
   likely a finding than not), or lower, wherever it takes that to reach the wanted share of all findings. Other
   candidates above it are added.

Texts are read once; cheap byte searches decide which need the patterns at all. Nothing is shuffled but
counts and the sample. Long tokens pass through the network in overlapping windows under one maximum, which is the
same maximum, so memory does not grow with a token.

Defined results: a null or empty text has no spans; repeated rows give repeated results; ids may be of any type; with
too few findings to learn from, the base spans are the result; other columns are left out."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from logsieve.llm.base import binary, lists, quoted, released, slices, text_sizes, written
from logsieve.llm.fourier import isotonic

KINDS = ["assign", "access", "hex", "model"]
# The base rules' patterns and least lengths; fixed values.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_LEAST = 6
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX_LEAST = 24
HEX = re.compile("[0-9a-f]{24,}")

# Candidates beside the findings: long tokens with a digit, and what is assigned to any name.
VALUE = re.compile(r"""[A-Za-z0-9_]["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", re.A)
NAME = re.compile(r"""[A-Za-z]+(?=["']?\x20*[:=]\x20*["']?$)""", re.A)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
BEFORE, AFTER = 24, 8

SAMPLE_ROWS = 6000  # of candidates that the network and its calibration learn from, at most (half of each label)
SAMPLE_CHARS = 4000  # of a candidate in that sample, at most; all are scored
LEAST_SAMPLE = 10  # of each label in each half
GROUP = 10  # rows that calibrate one step, at least
FILTERS, SPAN, EPOCHS, BATCH, RATE, SEED = 24, 5, 6, 64, 0.02, 3
RECALL, LIKELY = 0.98, 0.5
BINS = 10_000
# Symbols that the network sees at once, about, and the windows that longer candidates are cut into.
AT_ONCE, WINDOW = 1 << 17, 1 << 15

_HEX_BYTES = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_DIGIT_BYTES = bytes(1 if 48 <= b <= 57 else 0 for b in range(256))
# One symbol for each printing ASCII character, one for all others; context characters have their own.
ALPHABET = 97


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end (code points) by start, then kind; leftmost matches that do not overlap, per kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, bool]]:
    """start, end, whether the rules found something there, by start. Every finding is one, seen by its value, as
    the others are; of what overlaps, findings come first, then values, then tokens."""
    found = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(s, e) for kind, s, e in base if kind != "assign"]
    others = [m.span(1) for m in VALUE.finditer(text)]
    others += [m.span() for m in TOKEN.finditer(text) if any(map(str.isdigit, m[0]))]
    out: list[tuple[int, int, bool]] = []
    for label, spans in ((True, sorted(set(found))), (False, others)):
        for start, end in spans:
            at = bisect_left(out, (start, end))
            before = label and at and out[at - 1][1] >= end  # a finding inside another one
            clash = not label and (at and out[at - 1][1] > start or at < len(out) and out[at][0] < end)
            if not before and not clash:
                insort(out, (start, end, label))
    return out


def worth_reading(data: bytes) -> bool:
    """Whether a rule or a candidate can be in the text at all."""
    if b"=" in data or b":" in data or b"AKIA" in data:
        return True
    if b"\x01" in data.translate(_DIGIT_BYTES):
        return True
    return b"\x01" * HEX_LEAST in data.translate(_HEX_BYTES)


def read_spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, base (arrays of kind, start, end), starts, ends, found and shown (the candidates)."""
    spans = T.StructType.fromDDL(
        "base array<struct<kind:string,start:int,end:int>>, "
        "cands array<struct<start:int,end:int,found:boolean,left:string,own:string,right:string>>"
    )
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *spans.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        fields = [("start", pa.int32()), ("end", pa.int32()), ("found", pa.bool_()), *((n, pa.string()) for n in ("left", "own", "right"))]
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                all_base, all_candidates = [], []
                for data in binary(part.column(1)):
                    if not worth_reading(data):
                        all_base.append([])
                        all_candidates.append([])
                        continue
                    t = data.decode("utf-8", errors="replace")
                    base = base_spans(t)
                    all_base.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                    all_candidates.append(
                        [
                            {"start": s, "end": e, "found": f, "left": t[max(0, s - BEFORE) : s], "own": t[s:e], "right": t[e : e + AFTER]}
                            for s, e, f in candidates(t, base)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(all_base, pa.list_(span)), pa.array(all_candidates, pa.list_(pa.struct(fields)))],
                    names=["doc_id", "base", "cands"],
                )

    return docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text")).mapInArrow(released(run), schema)


def symbols(left: str, own: str, right: str) -> np.ndarray:
    """The characters of a candidate and its context as symbols, with room for one window at either end."""
    code = lambda s: np.frombuffer(s.encode("ascii", errors="replace"), np.uint8).astype(np.int64) - 31
    parts = [np.clip(code(left), 1, 96), np.clip(code(own), 1, 96) + ALPHABET, np.clip(code(right), 1, 96)]
    edge = np.zeros(SPAN - 1, dtype=np.int64)
    return np.concatenate([edge, *parts, edge])


def renamed(left: str, r: np.random.RandomState) -> str:
    """The context with other letters for the name that something is assigned to."""
    letters = lambda m: "".join(chr(c) for c in r.randint(97, 123, len(m[0])))
    return NAME.sub(letters, left)


class Network:
    """filters[k, symbol, f]: what a symbol at place k of a window adds to filter f."""

    def __init__(self):
        r = np.random.RandomState(SEED)
        self.filters = r.normal(0, 0.1, (SPAN, 2 * ALPHABET, FILTERS))
        self.bias = np.zeros(FILTERS)
        self.weights = r.normal(0, 0.1, FILTERS)
        self.level = 0.0

    def pooled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rectified maximum of each filter over each text, where it is, and all symbols."""
        every = np.concatenate(texts)
        lengths = np.array([len(t) for t in texts])
        first = np.cumsum(lengths) - lengths
        total = np.zeros((len(every) - SPAN + 1, FILTERS)) + self.bias
        for k in range(SPAN):
            total += self.filters[k][every[k : len(every) - SPAN + 1 + k]]
        best = np.zeros((len(texts), FILTERS))
        where = np.zeros((len(texts), FILTERS), dtype=np.int64)
        for i, (a, n) in enumerate(zip(first, lengths)):
            own = total[a : a + n - SPAN + 1]
            where[i] = own.argmax(axis=0)
            best[i] = own[where[i], np.arange(FILTERS)]
            where[i] += a
        return np.maximum(best, 0), where, every

    def raw_scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """The logistic output for each text, many at once; long ones in windows under one maximum."""
        best = np.zeros((len(texts), FILTERS))
        owners, parts, held = [], [], 0

        def take() -> None:
            np.maximum.at(best, np.array(owners), self.pooled(parts)[0])
            owners.clear()
            parts.clear()

        for i, text in enumerate(texts):
            for start in range(0, max(1, len(text) - SPAN + 1), WINDOW):
                owners.append(i)
                parts.append(text[start : start + WINDOW + SPAN - 1])
                held += len(parts[-1])
                if held >= AT_ONCE:
                    take()
                    held = 0
        if parts:
            take()
        return 1 / (1 + np.exp(-np.clip(best @ self.weights + self.level, -30, 30)))

    def calibrate(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> None:
        """Learn the isotonic steps from raw scores to the share of findings, GROUP rows or more to a step, so that
        a single secret that the rules have missed makes no step of its own."""
        raw = self.raw_scores(texts)
        order = np.argsort(raw, kind="stable")
        starts = np.arange(0, max(1, len(order) - GROUP + 1), GROUP)
        total = lambda values: np.add.reduceat(values[order], starts)
        self.steps = isotonic(total(raw * weights) / total(weights), total(labels * weights), total(weights))

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """The probability that each text is a finding; a hundredth of it is the raw score, which keeps the order
        where the steps are level."""
        raw = self.raw_scores(texts)
        return 0.99 * np.interp(raw, *self.steps) + 0.01 * raw

    def fit(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """Adam on the cross entropy, in a fixed order of batches."""
        r = np.random.RandomState(SEED)
        names = ("filters", "bias", "weights")
        state = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in names}
        step = 0
        for _ in range(EPOCHS):
            order = r.permutation(len(texts))
            for start in range(0, len(order), BATCH):
                batch = order[start : start + BATCH]
                best, where, every = self.pooled([texts[i] for i in batch])
                error = 1 / (1 + np.exp(-np.clip(best @ self.weights + self.level, -30, 30))) - labels[batch]
                back = error[:, None] * self.weights[None, :] * (best > 0) / len(batch)
                slope = {"weights": best.T @ error / len(batch), "bias": back.sum(0), "filters": np.zeros_like(self.filters)}
                column = np.broadcast_to(np.arange(FILTERS), where.shape)
                for k in range(SPAN):
                    np.add.at(slope["filters"][k], (every[where + k], column), back)
                step += 1
                for n in names:
                    m, v = state[n]
                    m += 0.1 * (slope[n] - m)
                    v += 0.001 * (slope[n] ** 2 - v)
                    value = getattr(self, n)
                    value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                self.level -= RATE * error.mean()


Shown = tuple[str, str, str]  # context before, the candidate, context after


def fold(shown: Shown) -> int:
    return zlib.crc32("".join(shown).encode()) & 1


class Pair:
    """Two calibrated networks, each for the candidates of the half that it has not learned from."""

    def __init__(self, sample: list[Shown], labels: np.ndarray, weights: np.ndarray):
        r = np.random.RandomState(SEED)
        half = np.array([fold(s) for s in sample])
        texts = [symbols(*s) for s in sample]
        # Each is seen twice, once with a name of chance, as a secret may be assigned to names that no rule knows.
        others = [symbols(renamed(left, r), own, right) for left, own, right in sample]
        self.networks = []
        for f in (0, 1):
            seen, kept = np.flatnonzero(half != f), np.flatnonzero(half == f)
            network = Network()
            network.fit([x[i] for x in (texts, others) for i in seen], np.tile(labels[seen], 2))
            network.calibrate([texts[i] for i in kept], labels[kept], weights[kept])
            self.networks.append(network)

    def scores(self, shown: list[Shown]) -> np.ndarray:
        half = np.array([fold(s) for s in shown], dtype=np.int64)
        out = np.zeros(len(shown))
        for f, network in enumerate(self.networks):
            own = np.flatnonzero(half == f)
            if len(own):
                out[own] = network.scores([symbols(*shown[i]) for i in own])
        return out


def learn(table: DataFrame) -> Pair | None:
    """Networks fitted and calibrated on SAMPLE_ROWS candidates at most, chosen by a hash of what they show."""
    rows = table.select(F.explode("cands").alias("c")).select("c.found", "c.left", "c.own", "c.right")
    counts = {r["found"]: r["count"] for r in rows.groupBy("found").count().collect()}
    shown = rows.where(F.length("own") <= SAMPLE_CHARS)
    half = lambda x: shown.where(F.col("found") == x).distinct().orderBy(F.xxhash64("left", "own", "right")).limit(SAMPLE_ROWS // 2)
    sample = half(True).union(half(False)).collect()
    labels = np.array([float(r["found"]) for r in sample])
    given = [(r["left"], r["own"], r["right"]) for r in sample]
    for f in (0, 1):
        own = labels[[fold(s) == f for s in given]]
        if own.sum() < LEAST_SAMPLE or (1 - own).sum() < LEAST_SAMPLE:
            return None
    weights = np.where(labels == 1, counts[True] / labels.sum(), counts[False] / (1 - labels).sum())
    return Pair(given, labels, weights)


def threshold(scored: DataFrame) -> float:
    """From counts of all findings: the highest score, LIKELY at most, above which RECALL of them lie."""
    rows = (
        scored.select(F.explode(F.arrays_zip("cands", "scores")).alias("x"))
        .where("x.cands.found")
        .groupBy(F.floor(F.col("x.scores") * BINS).cast("int").alias("bin"))
        .count()
        .collect()
    )
    findings, above = sum(r["count"] for r in rows), 0
    for r in sorted(rows, key=lambda r: -r["bin"]):
        above += r["count"]
        if above >= RECALL * findings:
            return min(LIKELY, r["bin"] / BINS)
    return LIKELY


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end; code points, end exclusive), by start, then kind."""
    table = written(read_spans(docs, doc_id, text), "secret-candidates")
    networks = learn(table)
    if networks is None:
        return table.select("doc_id", F.col("base").alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("cands")
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = part.column(at).to_pylist()
                scores = networks.scores([(c["left"], c["own"], c["right"]) for own in found for c in own])
                arrays = [*part.columns, lists(scores, [len(own) for own in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "scores"])

    schema = T.StructType([*table.schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))])
    scored = written(table.mapInArrow(released(run), schema), "secret-scores")
    limit = threshold(scored)
    added = F.expr(
        "transform(filter(arrays_zip(cands, scores), x -> NOT x.cands.found AND "
        f"x.scores >= {limit}D), x -> struct('model' AS kind, x.cands.start AS start, x.cands.end AS end))"
    )
    place = "CAST(array_position(array('assign', 'access', 'hex', 'model'), {}.kind) AS int)"
    order = f"CASE WHEN a.start <> b.start THEN a.start - b.start ELSE {place.format('a')} - {place.format('b')} END"
    every = F.expr(f"array_sort(concat(base, added), (a, b) -> {order})")
    return scored.withColumn("added", added).select("doc_id", every.alias("spans"))

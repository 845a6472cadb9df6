"""Secret scans: base patterns, and a character network over every candidate.

The base patterns find assignments, access keys and hex strings. Every other run of key-like characters is a candidate
too, and so is what those leave of a run and the whole word that a hex string or an access key is a part of; a
convolutional network reads each candidate with the characters around it, a long one in overlapping parts, and those
above its threshold are secrets as well. The network is trained here on labelled findings, its
scores are calibrated on findings held out from training, and the threshold is the highest that keeps the
asked recall on them.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from limnos.llm.text import blocks, code_points, runs, small_batches, text_bytes

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: A candidate of the network: so many key characters.
LEAST_CANDIDATE = 16
REDACTED = "[secret]"


def _among(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


HEX = _among("0123456789abcdef")
DIGIT = _among(string.digits)
KEY = _among(string.ascii_letters + string.digits + "+/_=-")
#: Characters of one word of a key; the others of KEY also part paths and assignments.
WORD = _among(string.ascii_letters + string.digits + "+_-")

# ---- the network -----------------------------------------------------------------------------------------

LEFT, MIDDLE, RIGHT = 24, 48, 8
WIDTH, FILTERS, EMBED, HIDDEN = 5, 24, 12, 16
SIZE = LEFT + MIDDLE + RIGHT
STEP = 16


def windows(data: np.ndarray, spans: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The bytes around each span (start, end), from its own document (lo..hi), as SIZE classes; 0 is outside.

    A span longer than MIDDLE shows its front (slid() gives its other parts); bytes beyond ASCII share a class.
    """
    n = len(spans)
    out = np.zeros((n, SIZE), np.uint8)
    if not n:
        return out
    start, end = spans[:, :1], spans[:, 1:]
    left = start + np.arange(-LEFT, 0)
    middle = start + np.arange(MIDDLE)
    right = end + np.arange(RIGHT)
    for at, where, ok in ((0, left, left >= lo[:, None]), (LEFT, middle, middle < end), (LEFT + MIDDLE, right, right < hi[:, None])):
        got = np.minimum(data[np.where(ok, where, 0)], 127) + 1
        out[:, at : at + where.shape[1]] = np.where(ok, got, 0)
    return out


def slid(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(span, what is shown of it): each span, and of those longer than MIDDLE all parts of that size, STEP apart."""
    which, shown = [np.arange(len(spans))], [spans]
    for i in np.flatnonzero(spans[:, 1] - spans[:, 0] > MIDDLE).tolist():
        at = np.append(np.arange(spans[i, 0] + STEP, spans[i, 1] - MIDDLE, STEP), spans[i, 1] - MIDDLE)
        which.append(np.full(len(at), i))
        shown.append(np.stack([at, at + MIDDLE], axis=1))
    return np.concatenate(which), np.concatenate(shown)


@dataclass
class Network:
    """Embedding, one convolution with ReLU, maxima over context and over the candidate, two dense layers."""

    embed: np.ndarray
    conv: np.ndarray
    conv_b: np.ndarray
    dense: np.ndarray
    dense_b: np.ndarray
    last: np.ndarray
    last_b: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    NAMES = ("embed", "conv", "conv_b", "dense", "dense_b", "last", "last_b")

    @staticmethod
    def new(seed: int) -> Network:
        r = np.random.default_rng(seed)
        init = lambda *shape: (r.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)
        return Network((r.standard_normal((129, EMBED)) * 0.5).astype(np.float32), init(WIDTH * EMBED, FILTERS), np.zeros(FILTERS, np.float32), init(3 * FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32), init(HIDDEN, 1), np.zeros(1, np.float32))

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        e = self.embed[x]
        cols = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), SIZE - WIDTH + 1, WIDTH * EMBED)
        h = np.maximum(cols @ self.conv + self.conv_b, 0)
        cut = (LEFT - WIDTH + 1, LEFT + MIDDLE - WIDTH + 1)
        parts = [(0, cut[0]), (cut[0], cut[1]), (cut[1], h.shape[1])]
        arg = [h[:, a:b].argmax(axis=1) + a for a, b in parts]
        pooled = np.concatenate([np.take_along_axis(h, a[:, None, :], axis=1)[:, 0] for a in arg], axis=1)
        z = np.maximum(pooled @ self.dense + self.dense_b, 0)
        return (z @ self.last + self.last_b)[:, 0], (x, cols, h, arg, pooled, z)

    def backward(self, grad: np.ndarray, saved: tuple) -> list[np.ndarray]:
        x, cols, h, arg, pooled, z = saved
        g = grad[:, None].astype(np.float32)
        d_last, d_last_b = z.T @ g, g.sum(0)
        gz = (g @ self.last.T) * (z > 0)
        d_dense, d_dense_b = pooled.T @ gz, gz.sum(0)
        gp = gz @ self.dense.T
        gh = np.zeros_like(h)
        for k, a in enumerate(arg):
            np.put_along_axis(gh, a[:, None, :], gp[:, None, k * FILTERS : (k + 1) * FILTERS], axis=1)
        gh *= h > 0
        flat = gh.reshape(-1, FILTERS)
        d_conv, d_conv_b = cols.reshape(-1, WIDTH * EMBED).T @ flat, flat.sum(0)
        gc = (flat @ self.conv.T).reshape(len(x), SIZE - WIDTH + 1, WIDTH, EMBED)
        d_embed = np.zeros_like(self.embed)
        for k in range(WIDTH):
            np.add.at(d_embed, x[:, k : k + SIZE - WIDTH + 1], gc[:, :, k])
        return [d_embed, d_conv, d_conv_b, d_dense, d_dense_b, d_last, d_last_b]

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability that each window holds a secret."""
        if not len(x):
            return np.zeros(0)
        logit = np.concatenate([self.forward(x[i : i + 1024])[0] for i in range(0, len(x), 1024)])
        return 1 / (1 + np.exp(-np.clip(self.scale * logit.astype(np.float64) + self.shift, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, recall: float = 0.99, epochs: int = 6, batch: int = 64, rate: float = 3e-3, seed: int = 5) -> Network:
    """Train on four fifths of the findings, calibrate and set the threshold on the others."""
    r = np.random.default_rng(seed)
    order = r.permutation(len(x))
    cut = len(x) * 4 // 5
    train, held = order[:cut], order[cut:]
    net = Network.new(seed)
    m1 = [np.zeros_like(getattr(net, k)) for k in net.NAMES]
    m2 = [np.zeros_like(a) for a in m1]
    step = 0
    for _ in range(epochs):
        r.shuffle(train)
        for i in range(0, len(train), batch):
            rows = train[i : i + batch]
            logit, saved = net.forward(x[rows])
            grads = net.backward((1 / (1 + np.exp(-logit)) - y[rows]) / len(rows), saved)
            step += 1
            for k, g, a, b in zip(net.NAMES, grads, m1, m2, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p = getattr(net, k)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    logit = net.forward(x[held])[0].astype(np.float64)
    truth = y[held]
    for _ in range(500):  # Platt scaling with a weak pull towards the identity
        p = 1 / (1 + np.exp(-np.clip(net.scale * logit + net.shift, -60, 60)))
        net.scale -= 0.05 * (float(np.mean((p - truth) * logit)) + 0.01 * (net.scale - 1))
        net.shift -= 0.05 * (float(np.mean(p - truth)) + 0.01 * net.shift)
    p = net.probability(x[held])
    positive = np.sort(p[truth == 1])
    net.threshold = float(positive[int(np.floor((1 - recall) * len(positive)))]) if len(positive) else 1.0
    return net


def labelled_findings(n: int = 16000, seed: int = 9) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of generated findings, half of them secrets; used where no own ones are given."""
    r = random.Random(seed)
    letters = string.ascii_lowercase
    word = lambda a=3, b=9: "".join(r.choice(letters) for _ in range(r.randint(a, b)))
    pick = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))
    mixed = string.ascii_letters + string.digits
    onsets, codas = ("", "b", "br", "c", "ch", "d", "f", "g", "gr", "h", "k", "l", "m", "n", "p", "pr", "qu", "r", "s", "sch", "sp", "st", "t", "tr", "v", "w", "z"), ("", "", "", "l", "n", "ns", "r", "rt", "rtz", "s", "ch", "t", "nt", "st", "ng")
    case = lambda x: r.choice((str.lower, str.capitalize, str.upper, str.upper))(x)
    spoken = lambda a=2, b=6: case("".join(r.choice(onsets) + r.choice(("a", "e", "i", "o", "u", "ie", "ea", "ou")) + r.choice(codas) for _ in range(r.randint(a, b))))
    secrets = (
        lambda: pick(mixed, 10, 15), lambda: pick(mixed, 8, 11) + r.choice(string.digits) + r.choice(string.ascii_uppercase), lambda: pick(string.ascii_letters, 16, 44),
        lambda: pick("0123456789abcdef", 24, 64), lambda: pick(mixed, 20, 44), lambda: pick(mixed + "+/", 28, 64) + "=",
        lambda: r.choice(("sk-", "sk_live_", "ghp_", "xoxb-", "glpat-")) + pick(mixed, 20, 40), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16),
        lambda: "eyJ" + pick(mixed + "_-", 30, 60),
    )
    benign = (
        *[spoken] * 10, lambda: spoken(3, 7), lambda: r.choice("-/_").join(spoken(1, 4) for _ in range(r.randint(2, 6))), lambda: spoken(2, 4) + str(r.randint(1, 2030)), lambda: spoken(1, 3) + "=" + spoken(1, 3),
        lambda: "".join(spoken(1, 2).capitalize() for _ in range(r.randint(2, 4))), lambda: r.choice("-=_") * r.randint(8, 60), lambda: pick(string.digits, 8, 14),
        lambda: "-".join(word() for _ in range(4)) + "-" + str(r.randint(1, 99)), lambda: word() + "_" + word() + "_" + word() + str(r.randint(0, 9)),
        lambda: f"20{r.randint(10, 29)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}-{r.randint(0, 59):02d}-00",
        lambda: "/".join([word(), word(), word() + str(r.randint(1, 9)), word()]), lambda: "-".join(pick(string.digits, 3, 4) for _ in range(5)),
        lambda: word(8, 14) + "=" + str(r.randint(1, 9999)) + word(4, 8), lambda: "=" * r.randint(14, 40) + str(r.randint(1, 9)), lambda: "CHAPTER-" + word().upper() + "-" + str(r.randint(1, 40)),
    )
    before = ('key = "', "token: ", "Authorization: Bearer ", "secret=", "export X_KEY=", "")
    out = []
    for i in range(n):
        label = i % 2
        lead = " ".join(word() for _ in range(r.randint(0, 6))) + " "
        if r.random() < (0.7 if label else 0.1):
            lead += r.choice(before)
        found = r.choice(secrets if label else benign)()
        while len(found) < LEAST_CANDIDATE:
            found += "-" + (pick(mixed, 6, 9) if label else word())
        out.append((lead + found + r.choice((" ", '" ', ". ", "\n")) + " ".join(word() for _ in range(3)), len(lead), len(lead) + len(found), label))
    return out


def fit_findings(findings: list[tuple[str, int, int, int]], recall: float = 0.99) -> Network:
    """Network fitted to (text, start, end, label) rows; places count code points."""
    xs = []
    for text, a, b, _ in findings:
        data = np.frombuffer(text.encode() or b" ", np.uint8)
        at, to = len(text[:a].encode()), len(text[:b].encode())
        xs.append(windows(data, np.array([[at, to]]), np.array([0]), np.array([len(data)]))[0])
    return fit(np.array(xs), np.array([f[3] for f in findings], np.float32), recall)


@lru_cache(maxsize=1)
def default_network() -> Network:
    return fit_findings(labelled_findings())


# ---- the scan --------------------------------------------------------------------------------------------


def _candidates(data: np.ndarray, offsets: np.ndarray, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(row, start, end): runs that base findings leave, and whole words that hex strings and access keys are parts of."""

    def inside(spans) -> np.ndarray:
        edges = np.zeros(len(data) + 1, np.int32)
        for _, a, _, b in spans:
            edges[a] += 1
            edges[b] -= 1
        return np.cumsum(edges[:-1]) > 0

    base = inside(found)
    starts, ends = runs(KEY[data] & ~base, offsets)
    long = ends - starts >= LEAST_CANDIDATE
    spans = [np.stack([starts[long], ends[long]], axis=1)]
    if found:
        starts, ends = runs(WORD[data], offsets)
        covered, touched = (np.append(0, np.cumsum(x)) for x in (base, inside([f for f in found if f[2]])))
        some = (touched[ends] > touched[starts]) & (covered[ends] - covered[starts] < ends - starts) & (ends - starts >= LEAST_CANDIDATE)
        spans.append(np.stack([starts[some], ends[some]], axis=1))
    every = np.concatenate(spans)
    rows = np.searchsorted(offsets, every[:, 0], "right") - 1
    return list(zip(rows.tolist(), *every.T.tolist(), strict=True))


def scan(texts: pa.Array, net: Network | None) -> dict[int, list[tuple[int, int, int, float]]]:
    """Findings of a block: row -> (start, kind, end, probability) in code points, by start and kind."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return {}
    found: list[tuple[int, int, int, int]] = []  # row, start, kind, end in bytes
    row_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    for row in np.unique(row_of(np.flatnonzero((data == 58) | (data == 61)))).tolist():
        lo = int(offsets[row])
        found += [(row, lo + m.start(), 0, lo + m.end()) for m in ASSIGN.finditer(data[lo : offsets[row + 1]].tobytes()) if m.end(2) - m.start(2) >= LEAST["assign"]]
    keys = np.flatnonzero(data == 75)  # the K of AKIA
    keys = keys[(keys >= 1) & (keys < len(data) - 2)]
    for row in np.unique(row_of(keys[(data[keys - 1] == 65) & (data[keys + 1] == 73)])).tolist():
        lo = int(offsets[row])
        found += [(row, lo + m.start(), 1, lo + m.end()) for m in ACCESS.finditer(data[lo : offsets[row + 1]].tobytes()) if m.end() - m.start() >= LEAST["access"]]
    starts, ends = runs(HEX[data], offsets)
    long = ends - starts >= LEAST["hex"]
    starts, ends = starts[long], ends[long]
    found += list(zip(row_of(starts).tolist(), starts.tolist(), [2] * len(starts), ends.tolist(), strict=True))
    if net is not None:
        found += [(row, a, 3, b) for row, a, b in _candidates(data, offsets, found)]
    if not found:
        return {}
    found.sort(key=lambda x: (x[0], x[1], x[2], -x[3]))
    spans = np.array(found, np.int64)
    scores = np.full(len(spans), np.nan)
    if net is not None:
        which, shown = slid(spans[:, [1, 3]])
        rows = spans[which, 0]
        scores = np.zeros(len(spans))
        np.maximum.at(scores, which, net.probability(windows(data, shown, offsets[rows], offsets[rows + 1])))
    points = code_points(data)
    first = points[offsets[spans[:, 0]]]
    out: dict[int, list[tuple[int, int, int, float]]] = {}
    whole: dict[int, int] = {}  # row -> end of its last word or run found
    for row, a, kind, b, p in zip(spans[:, 0].tolist(), (points[spans[:, 1]] - first).tolist(), spans[:, 2].tolist(), (points[spans[:, 3]] - first).tolist(), scores.tolist(), strict=True):
        if kind < 3 or p >= net.threshold:
            if kind == 3:
                if b <= whole.get(row, 0):
                    continue  # a part of a word that is found as a whole
                whole[row] = b
            out.setdefault(row, []).append((a, kind, b, p))
    return out


def find_secrets(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and findings (kind, start, end, probability) of each row of docs.

    A null or empty text has none; base findings stay whatever the network says of them; repeated rows get
    equal findings; places count code points and the end is exclusive; a very long text is scanned as a whole;
    other columns are left out, whatever their names; no rows give no rows.
    """
    small_batches(docs)
    net = net or default_network()
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("probability", DoubleType())])
    schema = StructType([docs.schema[id_col], StructField("findings", ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches):
        for part in blocks(batches, "__text"):
            got = scan(part.column(1), net)
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "probability": p} for a, k, b, p in got.get(i, ())] for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, arrow)], names=schema.names)

    return source.mapInArrow(run, schema)


def redact(docs: DataFrame, net: Network | None = None, text_col: str = "text") -> DataFrame:
    """docs with each finding in the text replaced (overlapping ones once); other columns, whatever their names, and null texts stay."""
    small_batches(docs)
    net = net or default_network()
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            for part in blocks(iter([batch.rename_columns([f"c{i}" for i in range(len(names))])]), f"c{at}"):
                texts = part.column(at)
                got = scan(texts, net)
                if got:
                    values = texts.to_pylist()
                    for i, spans in got.items():
                        values[i] = _replaced(values[i], spans)
                    texts = pa.array(values, pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:at], texts, *part.columns[at + 1 :]], names=names)

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list[tuple[int, int, int, float]]) -> str:
    out, done = [], 0
    for a, _, b, _ in spans:
        if a >= done:
            out += [text[done:a], REDACTED]
        done = max(done, b)
    return "".join([*out, text[done:]])


def op8(spark, sf_dir: str) -> DataFrame:
    net = default_network()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_secrets(docs, net)
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("findings", lambda x: x["kind"] != "model")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"), count("model").alias("n_model"),
    )

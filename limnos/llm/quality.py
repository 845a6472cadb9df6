"""Quality by nearest-neighbour voting over latent-semantic vectors.

A document's features are counts of hashed byte pairs and of word events (a word again within four words, a
line again, a word of symbols only). Their damped, weighted counts are projected to the leading singular
directions of a bounded sample of labelled documents, whose vectors go to every task. Each document's cosines
with all of them are computed in blocks, and the nearest vote with their labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from limnos.llm.text import LOWER, SPACE, blocks, mix64, runs, small_batches, span_hashes, text_bytes, word_spans

#: Labelled documents that vote, at most; their vectors take LABELLED * RANK * 4 bytes in every task.
LABELLED = 8192
RANK = 48
NEIGHBOURS = 25
#: A neighbour's vote weighs its cosine to this power.
POWER = 8
#: The whole sample votes with this weight, which decides where no neighbour is near.
PRIOR = 0.05
PAIRS = 2048
EVENTS = 8
FEATURES = PAIRS + EVENTS
#: Events are few; each counts as much as so many byte pairs.
EVENT_WEIGHT = 4.0

_pairs = (mix64(np.arange(65536, dtype=np.uint64) + np.uint64(77)) % np.uint64(PAIRS)).astype(np.int64)
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


def features(column: pa.Array) -> np.ndarray:
    """Counts (rows x FEATURES) of a block."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), np.float32)
    if not len(data):
        return out
    row = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) > 1:
        code = _pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
        inside = row[:-1] == row[1:]
        out[:, :PAIRS] = np.bincount((row[:-1] * PAIRS + code)[inside], minlength=n * PAIRS).reshape(n, PAIRS)
    lower = LOWER[data]
    starts, ends, first = word_spans(lower, offsets)
    words = span_hashes(lower, starts, ends)
    word_row = np.repeat(np.arange(n), np.diff(first))
    letters = np.append(0, np.cumsum(LETTER[data]))
    uppers = np.append(0, np.cumsum(UPPER[data]))
    events = [np.zeros(len(words), bool) for _ in range(6)]
    for k in range(1, 5):
        if len(words) > k:
            events[k - 1][k:] = (words[k:] == words[:-k]) & (word_row[k:] == word_row[:-k])
    events[4] = letters[ends] == letters[starts]
    events[5] = (uppers[ends] - uppers[starts]) * 2 > ends - starts
    for k, e in enumerate(events):
        out[:, PAIRS + k] = np.bincount(word_row[e], minlength=n)
    a, b = runs(data != 10, offsets)
    filled = np.append(0, np.cumsum(~SPACE[data]))
    some = filled[b] > filled[a]
    a, b = a[some], b[some]
    lines = span_hashes(data, a, b)
    line_row = row[a]
    order = np.lexsort((lines, line_row))
    again = np.zeros(len(lines), bool)
    again[1:] = (lines[order][1:] == lines[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    out[:, PAIRS + 6] = np.bincount(line_row[order][again], minlength=n)
    out[:, PAIRS + 7] = np.bincount(line_row, minlength=n)
    return out


@dataclass
class Voters:
    weights: np.ndarray  # of features
    basis: np.ndarray  # FEATURES x RANK
    vectors: np.ndarray  # RANK x voters, of length 1
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Latent vectors of length 1; a document without features is the null vector."""
        x = _damped(counts) * self.weights
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        v = x @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The weighted share of label 1 among each row's nearest voters."""
        base = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(counts), base)
        out = np.empty(len(counts))
        v = self.project(counts)
        k = min(neighbours, len(self.labels))
        for at in range(0, len(v), 512):
            cosines = v[at : at + 512] @ self.vectors
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** POWER
            out[at : at + 512] = ((w * self.labels[near]).sum(1) + PRIOR * base) / (w.sum(1) + PRIOR)
        return out


def _damped(counts: np.ndarray) -> np.ndarray:
    """Log shares per thousand features, so that long and short documents of a kind agree."""
    total = np.maximum(counts[:, :PAIRS].sum(axis=1, keepdims=True), 1)
    return np.log1p(counts * (1000 / total)).astype(np.float32)


def fit(counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Voters:
    """Feature weights, singular directions and vectors of labelled rows."""
    x = _damped(counts)
    seen = (counts > 0).mean(axis=0) if len(counts) else np.zeros(FEATURES)
    weights = (1 + np.log((1 + len(counts)) / (1 + seen * len(counts)))).astype(np.float32)
    weights[PAIRS : FEATURES - 1] *= EVENT_WEIGHT
    weights[FEATURES - 1] = 0  # lines are counted for the record only
    x = x * weights
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64)) if len(x) else (None, np.eye(FEATURES))
    voters = Voters(weights, np.ascontiguousarray(vectors[:, ::-1][:, :rank]).astype(np.float32), np.zeros((rank, 0), np.float32), labels.astype(np.float64))
    voters.vectors = np.ascontiguousarray(voters.project(counts).T)
    return voters


def learn(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = LABELLED) -> Voters:
    """Voters from at most `most` labelled documents where training (over the id) holds, in the order of a hash of the id."""
    small_batches(docs)
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label")).filter(F.col("label").isNotNull() & F.col("id").isNotNull())
    marked = marked.withColumnRenamed("id", id_col).filter(training).withColumnRenamed(id_col, "id").groupBy("id").agg(F.max("label").alias("label"))
    marked = marked.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = texts.join(F.broadcast(marked), "id").select("id", "label", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text"):
            counts = features(part.column(2))
            sparse = [np.flatnonzero(r) for r in counts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([s.astype(np.uint16).tobytes() for s in sparse], pa.binary()), pa.array([r[s].tobytes() for r, s in zip(counts, sparse, strict=True)], pa.binary())], names=["id", "label", "at", "n"]
            )

    schema = StructType([rows.schema["id"], StructField("label", DoubleType()), StructField("at", BinaryType()), StructField("n", BinaryType())])
    # of the texts of a repeated id the least one by its features, so that a rerun learns the same
    out = rows.mapInArrow(run, schema).groupBy("id", "label").agg(F.min(F.struct("at", "n")).alias("x")).select("id", "label", "x.*").orderBy("id").collect()
    counts = np.zeros((len(out), FEATURES), np.float32)
    for i, r in enumerate(out):
        counts[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["n"], np.float32)
    return fit(counts, np.array([r["label"] for r in out]))


def score(docs: DataFrame, voters: Voters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The score (0 to 1, higher: label 1 likelier) of each row of docs, beside its id.

    A null or empty text has the sample's share of label 1, and so has every text when nothing was labelled
    (0.5 then); repeated rows get equal scores up to rounding; equal cosines at the last place are cut as they
    come from the sample's order; a very long text is a block of its own; other columns are left out, whatever
    their names; no rows give no rows.
    """
    small_batches(docs)
    given = docs.sparkSession.sparkContext.broadcast(voters)
    schema = StructType([docs.schema[id_col], StructField("score", DoubleType())])
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches):
        for part in blocks(batches, "__text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(given.value.score(features(part.column(1))))], names=schema.names)

    return source.mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    from limnos.llm.language import crc_mod

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, learn(docs, labels, crc_mod(F.col("doc_id"), 5) != 0))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

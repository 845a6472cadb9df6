r"""Scoring text by a recurrent language model learned from the corpus.

Tokens are the words ``[^\x20\x09-\x0D]+`` with A-Z lowered and one end for each document. The counts of all
training tokens are a staged table. Its HEAD most frequent words are the model's own symbols; every other word
belongs to one of the tail classes by its ending, and is drawn from its class by its count. The model gives
the probability of a symbol after all that came before in the document.

Counts of the KNOWN most frequent words go to every task (24 bytes each); those of the rest are joined.
Texts are read twice, for the counts and to stage their symbols, from which the weights and the scores come.
Training starts from a bounded sample at the driver and goes on over all training documents in ROUNDS rounds:
the tasks of a round start from one model, read that round's documents, and their weights are averaged.

A word is known by 58 bits of a hash and its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from limnos.llm.gru import GROUP, GROUPS, TAILS, Gru
from limnos.llm.text import LOWER, blocks, mix64, small_batches, span_hashes, text_bytes, word_spans
from limnos.plans.staging import stage

HEAD = GROUP * GROUPS
KNOWN = 200_000
#: Bits of a hash by which known words are found.
TOP = 20
#: Tokens counted, and scored, together in a task: the more documents go side by side, the fewer steps a token costs.
CHUNK = 2_000_000
SCORED = 5_000_000
#: One training document of SHARE trains the weights (1: all do), in ROUNDS rounds of tasks of about TASK_TOKENS in so
#: many streams; WARM documents of WARM_CHARS at most start them.
SHARE = 1
ROUNDS = 4
TASK_TOKENS = 2_500_000
STREAMS, RATE = 384, 0.1
#: Parts in which weights are averaged.
PARTS = 64
WARM = 512
WARM_CHARS = 50_000
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
END = np.uint64(0)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of the tokens of each row, its end included; the low bits of a hash are the tail class."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    if len(starts):
        last = ends - 1
        last = np.where(PUNCTUATION[data[last]] & (last > starts), last - 1, last)
        ending = data[last].astype(np.uint64) * np.uint64(256) + np.where(last > starts, data[last - 1], 0).astype(np.uint64)
        with np.errstate(over="ignore"):
            cls = mix64(ending + np.uint64(1)) % np.uint64(TAILS)
        hashes = (hashes & ~np.uint64(TAILS - 1)) | cls
    n = len(first) - 1
    out = np.empty(len(hashes) + n, np.uint64)
    at = first[1:] + np.arange(n)
    words = np.ones(len(out), bool)
    words[at] = False
    out[at], out[words] = END, hashes
    return out, np.append(0, at + 1)


def count_tokens(texts: DataFrame) -> DataFrame:
    """(h, c): how often each token comes in column text."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

        for part in blocks(batches, "text"):
            held.append(tokens(part.column(part.schema.get_field_index("text")))[0])
            n += len(held[-1])
            if n >= CHUNK:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Known:
    """The frequent words, sorted by hash: counts and symbols; and what the whole table of counts adds up to."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    n: int
    v: int
    head_counts: np.ndarray
    tail_counts: np.ndarray
    tail_log: np.ndarray  # log10(N_k + 0.1 (V_k + 1)) of each tail class
    end: int

    @staticmethod
    def of(counts: DataFrame, known: int = KNOWN) -> Known:
        cls = F.col("h").bitwiseAND(TAILS - 1).alias("k")
        by_class = counts.groupBy(cls).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
        top = counts.orderBy(F.desc("c"), "h").limit(known).toArrow()
        h, c = top.column("h").to_numpy().astype(np.int64).view(np.uint64), top.column("c").to_numpy().astype(np.int64)
        if END not in h[:HEAD]:  # an end has a symbol even where other words are more frequent
            there = c[h == END]
            h, c = np.append(END, h[h != END]), np.append(there if len(there) else 0, c[h != END])
        n_k, v_k = np.zeros(TAILS), np.zeros(TAILS)
        for r in by_class:
            n_k[r["k"]], v_k[r["k"]] = r["n"], r["v"]
        n, v = int(n_k.sum()), int(v_k.sum())
        head_cls = (h[:HEAD] & np.uint64(TAILS - 1)).astype(np.int64)
        np.subtract.at(n_k, head_cls, c[:HEAD])
        np.subtract.at(v_k, head_cls, c[:HEAD] > 0)
        symbols = HEAD + (h & np.uint64(TAILS - 1)).astype(np.int64)
        symbols[:HEAD] = np.arange(min(HEAD, len(h)))
        order = np.argsort(h)
        return Known(h[order], c[order], symbols[order], n, v, c[:HEAD].astype(float), n_k, np.log10(n_k + 0.1 * (v_k + 1)), int(np.flatnonzero(h == END)[0]))

    @cached_property
    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes turned, in order, and the greatest number; where each has its count; the first for each value of TOP bits).

        Among words of one count the limit leaves those of the smallest hashes, so their highest bits aren't even;
        turned, other bits are the highest.
        """
        turned = _turned(self.hashes)
        order = np.argsort(turned)
        turned = np.append(turned[order], ~np.uint64(0))
        return turned, np.append(order, 0), np.searchsorted(turned, np.arange(1 << TOP, dtype=np.uint64) << np.uint64(64 - TOP)).astype(np.int32)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, symbols); the count of a word that isn't here is -1."""
        turned, order, first = self.index
        want = _turned(h)
        at = first.take(want >> np.uint64(64 - TOP))
        late = np.flatnonzero(turned.take(at) < want)
        while len(late):  # further in the bucket
            at[late] += 1
            late = late[turned.take(at[late]) < want[late]]
        at = order.take(at)
        hit = self.hashes.take(at) == h
        return np.where(hit, self.counts[at], -1), np.where(hit, self.symbols[at], HEAD + (h & np.uint64(TAILS - 1)).astype(np.int64))


def _turned(h: np.ndarray) -> np.ndarray:
    """Hashes with their bits from the 44th down first."""
    return (h << np.uint64(20)) | (h >> np.uint64(44))


def _symbols(batches) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the rows (column symbols), and whether each begins a document."""
    held, lengths = [], []
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("symbols")).cast(pa.large_binary())
        if len(column):
            _, where, data = column.buffers()
            offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] // 2
            held.append(np.frombuffer(data, np.uint16)[offsets[0] : offsets[-1]].astype(np.int32))
            lengths.append(np.diff(offsets))
    if not held:
        return np.zeros(0, np.int32), np.zeros(0, bool)
    symbols, lengths = np.concatenate(held), np.concatenate(lengths)
    first = np.zeros(len(symbols), bool)
    first[np.cumsum(lengths) - lengths] = True
    return symbols, first


def _means(batches) -> Iterator[pa.RecordBatch]:
    """The mean of each part of the weights, by the tokens that trained them."""
    sums: dict[int, np.ndarray] = {}
    tokens_of: dict[int, int] = {}
    for batch in batches:
        for i, n, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums[i] = sums.get(i, 0.0) + np.frombuffer(w, np.float32).astype(np.float64) * n
            tokens_of[i] = tokens_of.get(i, 0) + n
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(w / tokens_of[i]).tobytes() for i, w in sums.items()], pa.binary())], names=["i", "w"])


def encode(rows: DataFrame, given) -> DataFrame:
    """rows (column text among others) with their symbols, and what their words count, in place of their texts.

    symbols: 16 bits each; n_tokens, n_known; base: the sum of log10 (c + 0.1) of known words; own: that of words drawn
    from tail classes; rare: the hashes of the other words. given: the known words, broadcast.
    """
    others = [f for f in rows.schema.fields if f.name != "text"]
    added = [StructField("symbols", BinaryType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("base", DoubleType()), StructField("own", DoubleType()), StructField("rare", ArrayType(LongType()))]
    schema = StructType([*others, *added])

    def run(batches) -> Iterator[pa.RecordBatch]:
        known = given.value
        for part in blocks(batches, "text"):
            h, offsets = tokens(part.column(part.num_columns - 1))
            c, symbols = known.look_up(h)
            there = c >= 0
            sums = lambda x, offsets=offsets: np.add.reduceat(x, offsets[:-1])  # noqa: E731  every row has its end
            log_c = np.where(there, np.log10(np.maximum(c, 0) + 0.1), 0.0)
            own = np.where(symbols >= HEAD, log_c - known.tail_log[symbols & (TAILS - 1)], 0.0)
            packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((2 * offsets).astype(np.int32)), pa.py_buffer(symbols.astype(np.uint16))])
            rare = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sums((~there).astype(np.int64)))).astype(np.int32)), pa.array(h[~there].view(np.int64)))
            sizes = [np.diff(offsets).astype(np.int64), sums((c > 0).astype(np.int64)), sums(log_c), sums(own)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], packed, *map(pa.array, sizes), rare], names=schema.names)

    return rows.select(*[F.col(f"`{f.name}`") for f in others], "text").mapInArrow(run, schema)


def train(texts: DataFrame, known: Known, given, **how) -> Gru:
    """Weights from the training texts: column text, and x as for fit(). given: known, broadcast."""
    return fit(encode(texts.select("x", (F.length("text") <= WARM_CHARS).alias("short"), "text"), given), known, **how)


def fit(rows: DataFrame, known: Known, share: int = SHARE, warm: int = WARM, task_tokens: int = TASK_TOKENS, rounds: int = ROUNDS) -> Gru:
    """Weights from symbols. x: a hash that deals rows to shares and rounds; short: whether a row may start the weights."""
    net = Gru.new(known.head_counts, known.tail_counts, known.end)
    first = rows.filter("short").select("x", "symbols").orderBy("x", "symbols").limit(warm).select("symbols").toArrow()
    net = net.train(*_symbols(first.to_batches()), epochs=2)
    tasks = max(1, -(-known.n // (share * rounds * task_tokens)))
    for turn in range(rounds):
        start = rows.sparkSession.sparkContext.broadcast(net)

        def run(batches, start=start) -> Iterator[pa.RecordBatch]:
            symbols, begins = _symbols(batches)
            if len(symbols):
                got = start.value.train(symbols, begins, rate=RATE, streams=STREAMS).flat()
                parts = np.array_split(got, PARTS)
                yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([len(symbols)] * PARTS), pa.array([w.tobytes() for w in parts], pa.binary())], names=["i", "n", "w"])

        part = rows.filter(F.pmod(F.col("x"), F.lit(share * rounds)) == share * turn).select("symbols").repartition(tasks)
        mean = part.mapInArrow(run, "i int, n long, w binary").repartition("i").mapInArrow(_means, "i int, w binary").toArrow()
        if mean.num_rows:
            by_part = dict(zip(mean.column("i").to_pylist(), mean.column("w").to_pylist(), strict=True))
            net = net.with_flat(np.concatenate([np.frombuffer(by_part[i], np.float64) for i in range(PARTS)]))
        start.unpersist()
    return net


def likelihoods(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, known_words: int = KNOWN) -> DataFrame:
    """Scores of each row of docs, learned from the rows where training holds.

    Returns the id, training, n_tokens, n_known, train_tokens, base_score (add-0.1 unigram) and score (the
    model), in log10. A null or empty text is one end token; repeated rows get equal scores up to rounding;
    with no training rows every count is 0; a very long text is scored as a whole, its state carried all through;
    other columns are left out, whatever their names; no rows give no rows.
    """
    small_batches(docs)
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), training.alias("training"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    counts = stage(count_tokens(rows.filter("training").select("text")), "counts")
    known = Known.of(counts, known_words)
    given = spark.sparkContext.broadcast(known)
    # the hash is of the id too, so that copies of one text are sampled like other rows
    rows = rows.select("id", "training", F.xxhash64("id", "text").alias("x"), (F.length("text") <= WARM_CHARS).alias("short"), "text")
    encoded = stage(encode(rows, given).withColumn("row", F.monotonically_increasing_id()), "encoded")
    net = spark.sparkContext.broadcast(fit(encoded.filter("training"), known, share))
    plain = ["row", "id", "training", "n_tokens", "n_known", "base"]
    schema = StructType([*[encoded.schema[k] for k in plain], StructField("score", DoubleType())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = net.value
        held: list[pa.RecordBatch] = []
        n = 0

        def out() -> pa.RecordBatch:
            columns = [pa.concat_arrays([x.column(i) for x in held]) for i in range(len(plain) + 1)]
            offsets = np.append(0, np.cumsum(columns[3].to_numpy()))
            score = model.score(_symbols(held)[0], offsets) / np.log(10) + columns[-1].to_numpy()
            return pa.RecordBatch.from_arrays([*columns[:-1], pa.array(score)], names=schema.names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += int(pc.sum(batch.column(3)).as_py())
            if n >= SCORED:
                yield out()
                held, n = [], 0
        if held:
            yield out()

    scored = encoded.select(*plain, "own", "symbols").mapInArrow(run, schema)
    rare = encoded.select("row", F.explode("rare").alias("h")).join(counts, "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("rare_log"), F.count("c").alias("rare_known"))
    both = scored.join(rare, "row", "left")
    floor = float(np.log10(known.n + 0.1 * (known.v + 1)))
    more = F.coalesce("rare_log", F.lit(0.0))
    return both.select(
        F.col("id").alias(id_col), "training", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(floor)).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def op4(spark, sf_dir: str) -> DataFrame:
    from limnos.llm.language import crc_mod

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = likelihoods(docs, crc_mod(F.col("doc_id"), 10) != 0)
    return out.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""SentencePiece encoding and decoding with merge-type vocabularies.

A text becomes symbols, one for each character, and an agenda of adjacent pairs whose concatenation is in the
vocabulary; the pair with the highest score (leftmost among equals) merges next, until none is left. No piece
has a space mark behind another character, so merges never cross the start of a run of spaces: a text falls
into segments, equal segments encode alike, and a worker keeps the results of those it has met in a bounded
table. New segments of a block run their agendas together, one merge a round in each; long ones use a heap.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from limnos.llm.text import blocks, small_batches

MARK = "▁"
#: Segments in a worker's table, and their characters, before it starts anew; longer segments aren't kept in it.
TABLE_SIZE = 250_000
TABLE_CHARS = 4_000_000
LONGEST_KEPT = 256
#: Symbols up to which segments are merged together in arrays.
SHORT = 40
NEVER = np.iinfo(np.int32).max
SHIFT = np.int64(1 << 21)


class Pieces:
    """A merge-type vocabulary with byte fallback."""

    def __init__(self, model_file: str, packed: bool = False) -> None:
        """packed: results hold little-endian 32-bit ids instead of decimal ids joined by commas."""
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = lib.vocab_size()
        kinds = [(lib.is_byte(i), lib.is_unknown(i) or lib.is_control(i), lib.is_unused(i)) for i in range(n)]
        names = [lib.id_to_piece(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.text: list[str | None] = [None] * n  # what an id decodes to; None for bytes and marks without text
        self.byte_of: dict[int, int] = {}
        scores: dict[str, float] = {}
        for i, (is_byte, is_mark, unused) in enumerate(kinds):
            if is_byte:
                self.byte_of[i] = int(names[i][3:5], 16)
                self.byte_ids[self.byte_of[i]] = i
            elif not is_mark:
                if unused or MARK in names[i].lstrip(MARK):
                    raise ValueError("only vocabularies without unused pieces and inner space marks are supported")
                self.ids[names[i]] = i
                self.text[i] = names[i]
                scores[names[i]] = lib.get_score(i)
        if len(self.byte_of) != 256:
            raise ValueError("only vocabularies with byte fallback are supported")
        if lib.encode(" a  b ") != lib.encode([" a  b "])[0] or lib.decode(lib.encode(" a  b ")) != " a  b ":
            raise ValueError("only models that keep white space are supported")
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in scores.items()}
        self._pairs()
        self.packed = packed
        self.table: dict[str, str | bytes] = {}  # segment without its first mark -> its ids
        self.odd: dict[str, str] = {}  # those whose decoded text isn't their own
        self.chars = 0  # of the table's segments
        self.id_text = [str(i) for i in range(n)]

    def _pairs(self) -> None:
        """The merges as sorted arrays of symbol pairs; a symbol is a piece or a character of one."""
        symbols = {p: i for i, p in enumerate(self.ids)}
        for p in list(symbols):
            for c in p:
                symbols.setdefault(c, len(symbols))
        self.symbols = symbols
        found = []
        for p in self.ids:
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    found.append((a * int(SHIFT) + b, self.rank[p], symbols[p]))
        found.sort()
        self.pair_keys = np.array([f[0] for f in found], np.int64)
        self.pair_rank = np.array([f[1] for f in found], np.int32)
        self.pair_to = np.array([f[2] for f in found], np.int64)
        self.of_char = np.arange(0x110000, dtype=np.int64) + len(symbols)  # characters of no piece
        for p, s in symbols.items():
            if len(p) == 1:
                self.of_char[ord(p)] = s
        self.symbol_ids: list[tuple[int, ...]] = [(self.ids[p],) if p in self.ids else tuple(self.byte_ids[b] for b in p.encode()) for p in symbols]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * SHIFT + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_rank[at], NEVER), self.pair_to[at]

    def _emit(self, symbol: int) -> tuple[int, ...]:
        n = len(self.symbol_ids)
        return self.symbol_ids[symbol] if symbol < n else tuple(self.byte_ids[b] for b in chr(symbol - n).encode())

    def encode_long(self, segment: str) -> list[int]:
        """One segment (space marks for spaces) by a heap of pairs."""
        parts: list[str | None] = list(segment)
        after = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        heap: list[tuple[int, int, int]] = []

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            if both in self.rank:
                heapq.heappush(heap, (self.rank[both], i, len(both)))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or len(parts[i]) + len(parts[j]) != size:
                continue  # one side has merged elsewhere
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        out: list[int] = []
        for p in parts:
            if p is not None:
                out += [self.ids[p]] if p in self.ids else [self.byte_ids[b] for b in p.encode()]
        return out

    def encode_short(self, segments: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(place, ids) of segments of one length, their agendas run side by side."""
        n = len(segments[0])
        rows = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).reshape(-1, n)
        s = self.of_char[rows]
        place = np.arange(len(segments))
        rank, to = self._look_up(s[:, :-1], s[:, 1:]) if n > 1 else (np.zeros((len(s), 0), np.int32), s[:, :0])
        while len(s):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(s), np.int64)
            every = np.arange(len(s))
            going = rank[every, best] < NEVER if rank.shape[1] else np.zeros(len(s), bool)
            for i, symbols in zip(place[~going].tolist(), s[~going].tolist(), strict=True):
                ids: list[int] = []
                for x in symbols:
                    ids += self._emit(x)
                yield i, ids
            s, rank, to, best, place = s[going], rank[going], to[going], best[going], place[going]
            if not len(s):
                return
            every = np.arange(len(s))
            s[every, best] = to[every, best]
            width = s.shape[1]
            cols = np.arange(width - 1)[None, :]
            s = np.take_along_axis(s, cols + (cols > best[:, None]), axis=1)
            cols = np.arange(width - 2)[None, :]
            shift = cols + (cols >= best[:, None])
            rank, to = np.take_along_axis(rank, shift, axis=1), np.take_along_axis(to, shift, axis=1)
            for at in (best - 1, best):  # the pairs that the new symbol is in
                ok = np.flatnonzero((at >= 0) & (at < width - 2))
                if len(ok):
                    c = at[ok]
                    rank[ok, c], to[ok, c] = self._look_up(s[ok, c], s[ok, c + 1])

    def _learn(self, keys: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for k in keys:
            by_length.setdefault(len(k), []).append(k)
        for n, group in by_length.items():
            marked = [MARK + k.replace(" ", MARK) for k in group]
            pairs = self.encode_short(marked) if n < SHORT else ((i, self.encode_long(x)) for i, x in enumerate(marked))
            for i, ids in pairs:
                self.table[group[i]] = np.array(ids, "<i4").tobytes() if self.packed else ",".join([self.id_text[x] for x in ids])
                if "".join([self.text[x] or "" for x in ids]) != marked[i] and (text := self.decode(ids, first=False)) != " " + group[i]:
                    self.odd[group[i]] = text

    @staticmethod
    def segments(text: str) -> list[str]:
        """The text's segments without their first mark; joined by spaces they are the text."""
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return parts
        out, spaces = [], 0
        for p in parts[:-1]:
            if p:
                out.append(" " * spaces + p)
                spaces = 0
            else:
                spaces += 1
        return [*out, " " * spaces + parts[-1]]

    def decode(self, ids: Iterable[int], first: bool = True) -> str:
        """The text of ids; bytes that aren't UTF-8 become U+FFFD. first: a leading mark is the encoder's own."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            out.append(self.text[i] or "")
        if raw:
            out.append(raw.decode(errors="replace"))
        text = "".join(out)
        return (text.removeprefix(MARK) if first else text).replace(MARK, " ")

    def batch(self, texts: list[str | None]) -> list[tuple[str | bytes, str]]:
        """(ids, decoded text) of each text; a null one is empty."""
        split = [self.segments(t or "") for t in texts]
        fresh: set[str] = set()
        for s in split:
            fresh.update(s)
        if len(self.table) > TABLE_SIZE or self.chars > TABLE_CHARS:
            self.table, self.odd, self.chars = {}, {}, 0
        fresh = {k for k in fresh if k not in self.table}
        long = [k for k in fresh if len(k) > LONGEST_KEPT]
        self.chars += sum(map(len, fresh)) - sum(map(len, long))
        self._learn(list(fresh))
        out = []
        for t, s in zip(texts, split, strict=True):
            ids = (b"" if self.packed else ",").join(map(self.table.__getitem__, s))
            if not s:
                text = ""
            elif self.odd and not self.odd.keys().isdisjoint(s):
                text = "".join([self.odd.get(k, " " + k) for k in s])[1:]
            else:
                text = " ".join(s)
            out.append((ids, text))
        for k in long:
            del self.table[k]
            self.odd.pop(k, None)
        return out

    def encode(self, text: str | None) -> list[int]:
        ids = self.batch([text])[0][0]
        if self.packed:
            return np.frombuffer(ids, "<i4").tolist()
        return [int(x) for x in ids.split(",")] if ids else []


@lru_cache(maxsize=4)
def pieces(model_file: str, packed: bool = False) -> Pieces:
    """The worker's vocabulary of a file that every node has."""
    return Pieces(model_file, packed)


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded: bool = True) -> DataFrame:
    """Ids (array of int) and decoded text of each row of docs, beside its id and the columns in `keep`.

    A null or empty text has no ids and decodes to the empty string; rows stay as they are, repeated or not;
    other columns are left out; a kept one named ids or decoded is an error; a very long text is a block of its own.
    """
    small_batches(docs)
    first = [docs.schema[c] for c in (id_col, *keep)]
    schema = StructType([*first, StructField("ids", ArrayType(IntegerType())), *([StructField("decoded", StringType())] if decoded else [])])
    if len({n.lower() for n in schema.names}) < len(schema.names):
        raise ValueError(f"a kept column has the name of a result: {schema.names}")
    source = docs.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(first)], F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches):
        p = pieces(model_file, True)
        for part in blocks(batches, "__text"):
            got = p.batch(part.column(len(first)).to_pylist())
            ends = np.cumsum([0, *[len(g[0]) // 4 for g in got]]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join([g[0] for g in got]), "<i4")))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(first)], ids, *([pa.array([g[1] for g in got], pa.string())] if decoded else [])], names=schema.names)

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of each row of docs: encode() without its long columns."""
    small_batches(docs)
    schema = StructType([docs.schema[id_col], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches):
        p = pieces(model_file)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for part in blocks(batches, "__text"):
            got = p.batch(part.column(1).to_pylist())
            n = [ids.count(",") + 1 if ids else 0 for ids, _ in got]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array([sha(g[0]) for g in got]), pa.array([sha(g[1]) for g in got])], names=schema.names)

    return source.mapInArrow(run, schema)


def differences(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose ids or decoded text differ from the library's, checked in Arrow batches."""
    small_batches(docs)
    schema = StructType([docs.schema[id_col], StructField("same_ids", StringType()), StructField("same_text", StringType())])
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches):
        import sentencepiece

        p, lib = pieces(model_file), sentencepiece.SentencePieceProcessor(model_file=model_file)
        for part in blocks(batches, "__text"):
            texts = [t or "" for t in part.column(1).to_pylist()]
            theirs = lib.encode(texts, num_threads=1)
            same = [(",".join(map(str, ids)) == g[0], lib.decode(ids) == g[1]) for ids, g in zip(theirs, p.batch(texts), strict=True)]
            bad = [i for i, s in enumerate(same) if s != (True, True)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(bad, pa.int64())), pa.array([str(same[i][0]) for i in bad], pa.string()), pa.array([str(same[i][1]) for i in bad], pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)


def op9(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))

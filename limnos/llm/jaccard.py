r"""Jaccard join on word shingles: a size-aware heavy-light join.

A document's set holds the distinct 5-word shingles of its words (runs of ``[^\x20\x09-\x0D]``, A-Z lowered);
a text of fewer words is one shingle. Two documents link when ``100 * |A & B| >= threshold * |A | B|``.

Equal sets are one class, so copies cost one set. Shingles are ordered by how common they are, rare ones
first, and two sets that link share shingles among the first few in that order. Small sets are keyed by all
pairs of those few shingles (two linked sets share one pair at least); large sets by single shingles, whose
inverted lists are scanned. The boundary between small and large is the one with the least estimated cost.

A list isn't turned into all its pairs. In a few turns one of its sets leads, and only its pairs with sets of
other components are verified; the links found join components. At the end every pair of a list whose sets are
still in different components is verified. So no link between components is missed, and a group of m near
copies costs some m verifications and not m * m.

Shingles and classes are 59- and 64-bit hashes: two different shingles of a corpus of 1e13 words share a hash
with a probability of about 1e-5 per document pair at most, and a pair is decided by the hashes of its sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.llm.text import LOWER, blocks, keys64, mix64, plain_names, small_batches, span_hashes, text_bytes, word_spans
from limnos.plans.staging import bounded_join, drop_staged, stage

THRESHOLD = 80
SHINGLE = 5
#: Common shingles whose rank is known to every task (16 bytes each); the others count as rare, which only
#: changes the order in which shingles are tried.
COMMON = 524_288
#: Shingles counted together in one task. Those that come once among them are left out of the task's counts, and
#: a shingle is common from LEAST_COMMON of such counts.
COUNTED = 3_000_000
LEAST_COMMON = 4
#: Cost of an inverted list's entry against that of a key of a small set.
SCAN_COST = 2.0
#: Sets in a list up to which its pairs are tried all together.
SHORT_LIST = 48
#: Turns in which the lists' leaders are verified, unless one links less than a twentieth of its pairs.
TURNS = 5
#: Largest boundary that is considered.
MOST_BOUNDARY = 64
#: Rows up to which ids are broadcast to pick documents; beyond that they are joined by shuffling.
BROADCAST_IDS = 500_000

_PLACE = keys64(SHINGLE, 31)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


def need(n, threshold: int):
    """Least overlap of a set of n with any set it links to."""
    return -(-threshold * n // 100)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles of a block, rows ascending."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    place = _PLACE if size == SHINGLE else keys64(size, 31)
    with np.errstate(over="ignore"):
        n = max(0, len(words) - size + 1)
        sums = np.zeros(n, np.uint64)
        for k in range(size):
            sums += words[k : k + n] * place[k]
        whole = row[:n] == row[size - 1 : size - 1 + n]
        rows, hashes = row[:n][whole], mix64(sums[whole])
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):
            sums = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                has = count[short] > k
                sums[has] += words[first[short[has]] + k] * place[k]
            rows = np.concatenate([rows, short])
            hashes = np.concatenate([hashes, mix64(sums + count[short].astype(np.uint64) * _SHORT)])
            order = np.argsort(rows, kind="stable")
            rows, hashes = rows[order], hashes[order]
    return rows, hashes


def ordered_sets(column: pa.Array, common: np.ndarray, level: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(keys, offsets): each row's distinct shingles as keys that sort from rare to common."""
    rows, hashes = shingles(column, size)
    keys = hashes >> np.uint64(5)
    if len(common) and len(keys):
        at = np.searchsorted(common, keys)
        at[at == len(common)] = 0
        keys |= np.where(common[at] == keys, level[at], 0).astype(np.uint64) << np.uint64(59)
    edges = np.searchsorted(rows, np.arange(len(column) + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a > 1:
            keys[a:b].sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    keys, rows = keys[fresh], rows[fresh]
    return keys, np.searchsorted(rows, np.arange(len(column) + 1))


def class_ids(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for an empty one."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        with np.errstate(over="ignore"):
            # the level bits are left out: the same set has the same id whatever is common
            bare = keys & np.uint64((1 << 59) - 1)
            out[full] = mix64(np.add.reduceat(mix64(bare), offsets[full]) + n[full].astype(np.uint64) * _SHORT)
    return out.view(np.int64)


def common_shingles(texts: DataFrame, size: int = SHINGLE, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the most common shingles and their levels (log2 of the counts, 31 at most)."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out():
            keys = np.concatenate(held)
            held.clear()
            keys.sort()
            starts, ends = _edges(keys)
            often = ends - starts > 1
            return pa.RecordBatch.from_arrays([pa.array(keys[starts[often]].view(np.int64)), pa.array((ends - starts)[often])], names=["key", "n"])

        for part in blocks(batches, "text"):
            held.append(shingles(part.column(part.schema.get_field_index("text")), size)[1] >> np.uint64(5))
            n += len(held[-1])
            if n >= COUNTED:
                yield out()
                n = 0
        if n:
            yield out()

    top = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COMMON).orderBy(F.desc("n"), "key").limit(COMMON if most is None else most)
    got = top.toArrow()
    keys = got.column("key").to_numpy().astype(np.int64).view(np.uint64)
    level = np.minimum(31, np.log2(np.maximum(1, got.column("n").to_numpy())).astype(np.int64))
    order = np.argsort(keys)
    return keys[order], level[order]


def boundary(sizes: dict[int, int], threshold: int, scan_cost: float = SCAN_COST) -> int:
    """Sets below this size are small. sizes: classes by set size, those over MOST_BOUNDARY left out."""

    def cost(b: int) -> float:
        total = 0.0
        for n, classes in sizes.items():
            few = n - need(n, threshold) + 1
            if 1 < n < b:
                total += classes * (few + 1) * few / 2
            if 100 * n >= threshold * b:
                total += classes * few * scan_cost
        return total

    return min(range(2, MOST_BOUNDARY + 1), key=lambda b: (cost(b), b))


def _lists(batches, columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Arrays of columns holding whole lists, from batches sorted by their first column."""
    held: list[pa.RecordBatch] = []

    def arrays(upto=None):
        t = pa.Table.from_batches(held).combine_chunks()
        out = [np.array(t.column(c).to_numpy(zero_copy_only=False)) for c in columns]
        held.clear()
        if upto is not None:
            cut = int(np.searchsorted(out[0], upto))
            if cut < len(out[0]):
                held.append(t.slice(cut).to_batches()[0])
            out = [x[:cut] for x in out]
        return out

    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 100_000 and held[0].column(0)[0] != batch.column(0)[-1]:
                yield arrays(batch.column(0)[-1].as_py())
                rows = sum(b.num_rows for b in held)
    if held:
        yield arrays()


def _edges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return starts, np.append(starts[1:], len(keys))


def _could(na, ia, nb, ib, threshold: int):
    """Whether sets of these sizes, whose first common key is at places ia and ib, may link."""
    both = (100 * np.minimum(na, nb) >= threshold * np.maximum(na, nb)) & (np.minimum(na - ia, nb - ib) * (100 + threshold) >= threshold * (na + nb))
    return both


def _shared(batches, threshold: int) -> Iterator[pa.RecordBatch]:
    """The rows of lists of two sets or more, without those that no set of their list can link to by this key."""
    names = ["key", "cid", "n", "place", "large"]
    for columns in _lists(batches, names):
        while True:
            key, _, n, place, _ = columns
            starts, ends = _edges(key)
            if not len(starts):
                break
            least = np.repeat(np.minimum.reduceat(n, starts), ends - starts)
            least = np.maximum(least, need(n, threshold))
            ok = ((n - place) * (100 + threshold) >= threshold * (n + least)) & np.repeat(ends - starts > 1, ends - starts)
            if ok.all():
                break
            columns = [c[ok] for c in columns]
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _split(key: np.ndarray, label: np.ndarray, every: bool = False) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """Lists that span components: the rows of short ones, and (start, end, rows outside the largest component) of long ones."""
    starts, ends = _edges(key)
    if not len(starts):
        return np.zeros(0, np.int64), []
    mixed = (np.minimum.reduceat(label, starts) != np.maximum.reduceat(label, starts)) | every
    short = np.flatnonzero(np.repeat(mixed & (ends - starts <= SHORT_LIST), ends - starts))
    long = []
    for a, b in zip(starts[mixed & (ends - starts > SHORT_LIST)].tolist(), ends[mixed & (ends - starts > SHORT_LIST)].tolist(), strict=True):
        names, counts = np.unique(label[a:b], return_counts=True)
        long.append((a, b, np.arange(b - a) if every else np.flatnonzero(label[a:b] != names[counts.argmax()])))
    return short, long


def _led(batches, threshold: int, turn: int) -> Iterator[pa.RecordBatch]:
    """Pairs of each list's leader with the sets of other components: linear in the list.

    The leader is the set with the fewest rarer shingles, of the largest component in a long list: the one that
    its copies were made from, most likely. Ties fall in an order of the turn's own, which is the same in all
    lists, so the members of a group mostly meet the same leader.
    """
    for key, cid, n, place, large, label in _lists(batches, ["key", "cid", "n", "place", "large", "label"]):
        order = mix64(cid.view(np.uint64) ^ keys64(turn + 1, 47)[turn])
        first = place * 4096 // n
        short, long = _split(key, label)
        by = np.lexsort((order[short], first[short], key[short]))
        starts, ends = _edges(key[short][by])
        leads = [np.repeat(short[by][starts], ends - starts)]
        rows = [short[by]]
        for a, b, outside in long:
            inside = np.ones(b - a, bool)
            inside[outside] = len(outside) == b - a - 1  # all components have one set: any may lead
            inside &= first[a:b] == first[a:b][inside].min()
            lead = a + int(np.where(inside, order[a:b], np.uint64(2**64 - 1)).argmin())
            leads.append(np.full(b - a, lead))
            rows.append(np.arange(a, b))
        i, j = np.concatenate(leads), np.concatenate(rows)
        ok = (label[i] != label[j]) & (large[i] | large[j]) & _could(n[i], place[i], n[j], place[j], threshold)
        if ok.any():
            yield _pairs_of(cid[i[ok]], cid[j[ok]])


def _others(batches, threshold: int, every: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of a list that could link and are in different components (every: in any)."""
    for key, cid, n, place, large, label in _lists(batches, ["key", "cid", "n", "place", "large", "label"]):

        def could(i, j, cid=cid, n=n, place=place, large=large, label=label):
            apart = cid[i] != cid[j] if every else label[i] != label[j]
            return apart & (large[i] | large[j]) & _could(n[i], place[i], n[j], place[j], threshold)

        short, long = _split(key, label, every)
        found, held = [], 0
        i = np.arange(len(short))
        for d in range(1, SHORT_LIST):  # each row with the one d places on
            i = i[i + d < len(short)]
            i = i[key[short[i]] == key[short[i + d]]]
            if not len(i):
                break
            ok = could(short[i], short[i + d])
            found.append((short[i][ok], short[i + d][ok]))
        for a, b, rows in long:
            # a pair of two components has a set outside the largest one
            listed = np.zeros(b - a, bool)
            listed[rows] = True
            for i in rows.tolist():
                ok = could(a + i, np.arange(a, b))
                ok[:i] &= ~listed[:i]  # that pair was met the other way round
                j = a + np.flatnonzero(ok)
                found.append((np.full(len(j), a + i), j))
                held += len(j)
                if held > 50_000:
                    yield _pairs_of(*(cid[np.concatenate(x)] for x in zip(*found, strict=True)))
                    found, held = [], 0
        if found:
            yield _pairs_of(*(cid[np.concatenate(x)] for x in zip(*found, strict=True)))


def _pairs_of(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = np.minimum(i, j), np.maximum(i, j)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.RecordBatch.from_arrays([pa.array(a[fresh]), pa.array(b[fresh])], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The overlap of each pair (a, b) of classes, from their whole sets."""
    left = sets.select(F.col("cid").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("set").alias("sb"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")

    def overlap(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sa, sb = (part.column(i).to_pylist() for i in (2, 3))
                na, nb = [len(x) // 8 for x in sa], [len(x) // 8 for x in sb]
                both = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(sa, sb, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(na, pa.int64()), pa.array(nb, pa.int64()), pa.array(both, pa.int64())], names=["a", "b", "na", "nb", "both"])

    return rows.mapInArrow(overlap, "a long, b long, na long, nb long, both long")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of all nodes of the links: label is the smallest node of the component.

    Labels spread along links and then jump to the label of the label, until none changes; each round is a
    staged table, so nothing is gathered at the driver but the number of changes.
    """
    edges = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).union(links.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stage(spread.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        changed = moved.filter("was <> label").limit(1).count()
        drop_staged(labels)
        labels = moved.select("node", "label")
        if not changed:
            drop_staged(edges)
            return labels


class JaccardJoin:
    """The join over one table; its parts are staged tables."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, size: int = SHINGLE, scan_cost: float = SCAN_COST) -> None:
        small_batches(docs)
        self.threshold, self.size = threshold, size
        text = F.col(f"`{text_col}`").cast("string")
        self.texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("pick"), text.alias("text"))
        common, level = common_shingles(self.texts.filter(F.col("text").isNotNull()), size)
        sc = docs.sparkSession.sparkContext
        self.common = sc.broadcast((common, level))  # COMMON rows at most
        self.rows = stage(self._sets(prefix=True), "sets")  # id, pick, cid, n, prefix
        self.classes = self.rows.filter("n > 0").groupBy("cid", "n").agg(F.min("pick").alias("pick"), F.first("prefix").alias("prefix"))
        self.boundary = boundary(self._sizes(), threshold, scan_cost)

    def _sizes(self) -> dict[int, int]:
        sizes = self.rows.filter(F.col("n").between(1, MOST_BOUNDARY)).select("cid", "n").distinct().groupBy("n").count()
        return {r["n"]: r["count"] for r in sizes.collect()}

    def _sets(self, prefix: bool, only: DataFrame | None = None) -> DataFrame:
        """A row for each document: its class, set size and either the front of its set or the whole of it."""
        given, threshold, size = self.common, self.threshold, self.size
        out = "pick long, cid long, n long, " + ("prefix array<long>" if prefix else "set binary")
        source = self.texts if prefix else only
        kept = source.schema["id"] if prefix else None
        if prefix:
            schema = f"id {kept.dataType.simpleString()}, {out}"
        else:
            schema, source = out, source.select("pick", "text")

        def run(batches):
            common, level = given.value
            for part in blocks(batches, "text"):
                text = part.column(part.schema.get_field_index("text"))
                keys, offsets = ordered_sets(text, common, level, size)
                n = np.diff(offsets)
                ids = [part.column(part.schema.get_field_index(c)) for c in (("id", "pick") if prefix else ("pick",))]
                if prefix:
                    take = np.minimum(n, n - need(n, threshold) + 2)
                    starts = np.cumsum(take) - take
                    where = np.repeat(offsets[:-1] - starts, take) + np.arange(take.sum())
                    last = pa.ListArray.from_arrays(pa.array(np.append(starts, take.sum()).astype(np.int32)), pa.array(keys[where].view(np.int64)))
                else:
                    last = pa.array([keys[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary())
                names = [*(("id", "pick") if prefix else ("pick",)), "cid", "n", "prefix" if prefix else "set"]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(class_ids(keys, offsets)), pa.array(n.astype(np.int64)), last], names=names)

        return source.mapInArrow(run, schema)

    def postings(self) -> DataFrame:
        """(key, cid, n, place, large): keys of small sets are pairs of shingles, those of large sets shingles."""
        t, b = self.threshold, self.boundary
        n = F.col("n")
        few = (n - F.ceil(n * t / 100) + 1).cast("int")
        # sets so tiny that one common shingle may do have no pair for a key: they go to the lists, and with them
        # the sets that they could link to. At thresholds over 50 these have one shingle and only equal sets link.
        tiny = 100 // t
        beside = 100 * tiny // t
        lists = self.classes.filter(((n * 100 >= t * b) | (n <= beside)) & (n > (0 if beside > 1 else 1))).select(F.posexplode(F.slice("prefix", F.lit(1), few)).alias("place", "key"), "cid", "n")
        lists = lists.select("key", "cid", "n", F.col("place").cast("long").alias("place"), ((n >= b) | (n <= tiny)).alias("large"))
        pairs = F.flatten(
            F.transform(
                F.slice(F.col("prefix"), F.lit(1), F.size("prefix") - 1),
                lambda x, i: F.transform(F.slice(F.col("prefix"), i + 2, F.size("prefix")), lambda y: F.xxhash64(x, y)),
            )
        )
        small = self.classes.filter((n > tiny) & (n < b)).select(F.explode(pairs).alias("key"), "cid", "n")
        # any two small sets may meet under such a key, wherever it stands
        small = small.select("key", "cid", "n", F.lit(0).cast("long").alias("place"), F.lit(True).alias("large"))
        return lists.unionByName(small)

    def _of(self, rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
        """The rows whose key is among ids (staged); beyond a bound they are joined by shuffling."""
        return rows.join(F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids, key, "left_semi")

    def _whole_sets(self, cids: DataFrame) -> DataFrame:
        """(cid, set) of classes (staged), staged: another reading of texts, one of each class."""
        picks = self._of(self.rows.filter("n > 0"), cids, "cid").groupBy("cid", "pick").agg(F.count("*").alias("copies"))
        picks = stage(picks.groupBy("cid").agg(F.min("pick").alias("pick"), F.min_by("copies", "pick").alias("copies")), "picks")
        sets = self._sets(prefix=False, only=self._of(self.texts, picks.select("pick"), "pick")).select("cid", "set")
        if picks.filter("copies > 1").limit(1).count():  # only repeated rows must be brought together
            sets = sets.groupBy("cid").agg(F.first("set").alias("set"))
        sets = stage(sets, "whole")
        drop_staged(picks)
        return sets

    def _likely(self, pairs: DataFrame, cids: DataFrame) -> DataFrame:
        """The pairs whose sets have as many keys in common among the fronts of their sets as a link asks for.

        Of an overlap of o, at most need - 1 are behind the front of the set whose front ends first.
        """
        t = self.threshold
        fronts = self._of(self.rows.filter("n > 0"), cids, "cid").groupBy("cid", "n").agg(F.first("prefix").alias("prefix"))
        fronts = fronts.select("cid", "n", F.slice("prefix", F.lit(1), (F.col("n") - F.ceil(F.col("n") * t / 100) + 1).cast("int")).alias("front"))
        side = lambda x: fronts.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("front").alias(f"f{x}"))
        both = F.size(F.array_intersect("fa", "fb"))
        asked = F.ceil((F.col("na") + F.col("nb")) * t / (100 + t)) - F.ceil(F.greatest("na", "nb") * t / 100) + 1
        return pairs.join(side("b"), "b").join(side("a"), "a").filter(both >= asked).select("a", "b")

    def overlaps(self, every: bool = False) -> DataFrame:
        """Verified pairs of classes (a, b, na, nb, both).

        Those that link are enough for the components; with every, they are all pairs of classes that link.
        """
        t = self.threshold
        by_list = lambda df: df.repartition("key").sortWithinPartitions("key", "n", "cid")
        lists = stage(by_list(self.postings()).mapInArrow(lambda x: _shared(x, t), "key long, cid long, n long, place long, large boolean"), "lists")
        seen, labels = [], None
        whole: list[DataFrame] = []  # sets read so far: those of the first turn and the few that others ask for

        def classes_of(pairs: DataFrame) -> DataFrame:
            return stage(pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct(), "cids")

        def sets_of(cids: DataFrame) -> DataFrame:
            """The sets of classes (staged); only those that no turn has read yet are made from texts."""
            more = cids
            for part in whole:
                more = more.join(part.select("cid"), "cid", "left_anti")
            more = stage(more, "more") if whole else cids
            if more.limit(1).count() or not whole:
                whole.append(self._whole_sets(more))
            return self._of(reduce(DataFrame.unionByName, whole), cids, "cid")

        def labelled() -> DataFrame:
            if labels is None:
                return by_list(lists.withColumn("label", F.col("cid")))
            rows = lists.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
            return by_list(rows.withColumn("label", F.coalesce("label", "cid")))

        def verify(pairs: DataFrame, sift: bool = False) -> tuple[int, int]:
            """Verify the pairs not seen yet; (pairs, links) of them. sift: look at the fronts of their sets first."""
            for done in seen:
                pairs = pairs.join(done, ["a", "b"], "left_anti")
            pairs = stage(pairs.distinct(), "pairs")
            cids = classes_of(pairs)
            if sift:
                every_pair, every_cid = pairs, cids
                pairs = stage(self._likely(pairs, cids), "likely")
                cids = classes_of(pairs)
                drop_staged(every_pair, every_cid)
            seen.append(stage(_verified(pairs, sets_of(cids)), "seen"))
            drop_staged(pairs, cids)
            row = seen[-1].agg(F.count("*").alias("n"), F.count_if(self._links()).alias("links")).first()
            return row["n"], row["links"]

        every_seen = lambda: reduce(DataFrame.unionByName, seen)
        for turn in range(TURNS):
            tried, linked = verify(labelled().mapInArrow(lambda x, turn=turn: _led(x, t, turn), "a long, b long"))
            if linked:
                labels = components(every_seen().filter(self._links()))
            if linked * 20 < tried or not tried:
                break
        _, linked = verify(labelled().mapInArrow(lambda x: _others(x, t, every), "a long, b long"), sift=True)
        self.labels = None if linked else labels  # those of the turns hold where the last pairs gave no link
        drop_staged(lists, *whole)
        return every_seen()

    def _links(self):
        t = self.threshold
        return F.col("both") * (100 + t) >= t * (F.col("na") + F.col("nb"))

    def links(self) -> DataFrame:
        """All pairs of different sets that link: class ids a < b, set sizes and overlap."""
        return self.overlaps(every=True).filter(self._links())

    def members(self) -> DataFrame:
        """id, n_shingles and class id (0 for an empty set) of each row."""
        return self.rows.select("id", F.col("n").alias("n_shingles"), "cid")

    def groups(self) -> DataFrame:
        """id, n_shingles and component_id of each row: the smallest id that links reach, its own included.

        An empty set has its own id. Ids that are null lose to others; repeated rows are in one component; a very long
        text is a block of its own; no rows give no rows.
        """
        pairs = self.overlaps()
        labels = components(pairs.filter(self._links())) if self.labels is None else self.labels
        classes = self.rows.filter("n > 0").groupBy("cid").agg(F.min("id").alias("least"))
        labelled = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
        of_class = labelled.join(least, "label").select("cid", "component_id")
        out = self.rows.join(of_class, "cid", "left")
        return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    return JaccardJoin(docs, id_col, text_col, threshold, size).groups().withColumnRenamed("id", id_col)


def op6(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """docs with one row of each component: that with the smallest id (null ids come last), of such with the least hash of the text.

    Documents without words all stay, but for rows that repeat an id with its text, null ids too. Rows with a null id
    are documents of their own; a very long text is a block of its own; all columns are kept, whatever their names.
    """
    # a row is decided by its id and its text, as an id may be null or repeated with another text
    named, at = plain_names(docs)
    given, text = F.col(at[id_col]), F.col(at[text_col]).cast("string")
    key = F.struct(given.isNull().alias("missing"), given.alias("id"), F.xxhash64(text).alias("text"))
    join = JaccardJoin(named.select(key.alias("key"), text.alias("text")), "key", "text", threshold, size)
    pick = lambda missing, x: F.xxhash64(missing, x).alias("pick")
    gone = (~F.col("id").eqNullSafe(F.col("component_id"))).cast("int").alias("gone")
    groups = stage(join.groups().select(pick(F.col("id.missing"), F.col("id.id")), F.col("id.text").alias("text"), gone), "groups")
    # rows to look at: those that another one stands for, and those that come more than once
    touched = groups.groupBy("pick", "text").agg(F.max("gone").alias("gone"), (F.count("*") > 1).alias("again"))
    touched = stage(touched.filter((F.col("gone") == 1) | F.col("again")), "touched")
    rows = named.select("*", pick(given.isNull(), given), F.xxhash64(text).alias("text"))
    out = bounded_join(rows, touched, ["pick", "text"], "left", most=BROADCAST_IDS).filter(F.coalesce("gone", F.lit(0)) == 0)
    again = F.coalesce("again", F.lit(False))
    kept = out.filter(~again).unionByName(out.filter(again).dropDuplicates(["pick", "text"]))
    return kept.select(*[F.col(new).alias(name) for name, new in at.items()])

"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target number of words; whole epochs of a source come first and the rest of its target is
a weighted sample without replacement. The sample orders documents by the exponential key ``-ln(u) / w``,
where u comes from a digest of the document's id and text and w is its quality weight, and takes the front of
that order up to the budget.

The prefix sums are built in two levels, since one source may hold a third of all rows: keys fall into ordered
buckets, the buckets of a source are summed and prefix-summed, and only rows of the same bucket meet in one task.
A bucket is a 1024th of an octave of the key: whatever the weights, the logarithm of an exponential key has a
density of 1/e at most, so a bucket is expected to hold a 3900th of its source. Repeated rows are one row with a
count until the end. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnos.llm.text import plain_names
from limnos.plans.staging import bounded_join, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Buckets of an octave of the keys.
BUCKETS = 1024
#: Repeats of a row that one task puts out.
REPEATS = 4096
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def quality_weight(size: Column, chars: Column) -> Column:
    """Weight in (0, 1]: rises with length, falls as characters per word leave the usual six."""
    per_word = chars / size
    return F.when(size == 0, F.lit(0.01)).otherwise(
        F.greatest(F.lit(0.01), (size / (size + 20.0)) / (1.0 + F.abs(per_word - 6.0) / 6.0))
    )


def uniform(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the first 12 hex digits of a digest of the key and the text."""
    whole = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    digits = F.substring(F.md5(whole.cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**12))


def targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Targets of sources (columns src, src_null, source_size): weights in code-point order, null last.

    A target stops at `epochs` times its source's size. Sources ordered by size over weight fill up first,
    so the level that the others share is found by one pass over that order instead of by repeated resharing:
    it is the one at the first source whose share stays below its cap, and later ones are lower.
    The table has a row for each source.
    """
    by_name = Window.orderBy("src_null", "src")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    w = sizes.withColumn("w", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("cap") / F.col("w"), "src_null", "src")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    w = w.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    level = F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(everything)
    return w.withColumn("target", F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("w"))).select("src", "src_null", "source_size", "target")


ORDER = ("k", "id", "size", "x")
SOURCE = ["src", "src_null"]


def _sourced(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, dict[str, str]]:
    """docs under plain names with id, src and src_null (a source that is never null), the text and x, a hash of the row."""
    named, at = plain_names(docs)
    text, source = F.col(at[text_col]).cast("string"), F.col(at[source_col]).cast("string")
    hashed = [at[f.name] for f in docs.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    return named.select("*", F.col(at[id_col]).alias("id"), F.coalesce(source, F.lit("")).alias("src"), source.isNull().alias("src_null"), text.alias("text"), F.xxhash64(*hashed).alias("x")), at


def _keyed(rows: DataFrame) -> DataFrame:
    """rows with size (words) and k, the key."""
    rows = rows.withColumns({"size": n_words(F.col("text")), "u": uniform(F.col("id"), F.col("text")), "chars": F.coalesce(F.length("text"), F.lit(0))})
    # a projection of its own: words are counted once for all that the key needs
    return rows.withColumn("k", -F.log("u") / quality_weight(F.col("size"), F.col("chars"))).drop("u", "chars", "text")


def _groups(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, epochs: int, buckets: int) -> DataFrame:
    """A row for each different row of docs: ORDER, SOURCE, n (how often it comes), source_size, target, whole and room.

    whole is the number of whole epochs of the source, room the words that are left of its last one before the first
    of the n rows.
    """
    rows = _keyed(_sourced(docs, id_col, text_col, source_col)[0]).groupBy(*SOURCE, *ORDER).agg(F.count("*").alias("n"))
    rows = stage(rows.withColumn("b", F.floor(F.log2("k") * buckets).cast("int")), "mix-rows")
    words = F.col("size") * F.col("n")
    per_bucket = rows.groupBy(*SOURCE, "b").agg(F.sum(words).alias("in_bucket"))
    per_source = per_bucket.groupBy(*SOURCE).agg(F.sum("in_bucket").alias("source_size"))
    before = Window.partitionBy(*SOURCE).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*SOURCE, "b", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets(per_source, weights, epochs), SOURCE)
    within = Window.partitionBy(*SOURCE, "b").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("here", F.coalesce(F.sum(words).over(within), F.lit(0))).join(offsets, [*SOURCE, "b"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    return rows.withColumn("room", F.floor(F.col("rest") - F.col("offset") - F.col("here")).cast("long")).drop("b", "offset", "here", "rest")


def _repeated(rows: DataFrame, n: str, name: str) -> DataFrame:
    """Each row n times, numbered from 0; a row that comes very often is dealt out over tasks first."""
    every = lambda df, first, upto: df.withColumn(name, F.explode(F.sequence(first, upto)))
    many = F.col(n) > REPEATS
    few = every(rows.filter((F.col(n) > 0) & ~many), F.lit(0).cast("long"), F.col(n) - 1)
    parts = rows.filter(many).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / REPEATS).cast("long"))))
    parts = parts.repartition(F.col("part"))
    return few.unionByName(every(parts, F.col("part") * REPEATS, F.least(F.col(n), (F.col("part") + 1) * REPEATS) - 1).drop("part"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, epochs: int = EPOCHS, buckets: int = BUCKETS) -> DataFrame:
    """How often the mix takes each document: its id, size (words), source_size, target, taken (words) and copies.

    A null or blank text has size 0 and adds no words; a null source is a source of its own; repeated rows are
    documents of their own, and as many of them are taken as fit; no rows give no rows; a very long text is a document
    like others; other columns may have any name. The last document of a source's front gives the words that still
    fit, so a source ends within a word of its target; it counts as a copy when that is half of it at least.
    """
    rows = _repeated(_groups(docs, id_col, text_col, source_col, weights, epochs, buckets), "n", "i")
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("i") * F.col("size"))).cast("long")
    rows = rows.withColumn("more", more).withColumns({"taken": F.col("whole") * F.col("size") + F.col("more"), "copies": F.col("whole") + ((F.col("more") > 0) & (2 * F.col("more") >= F.col("size"))).cast("long")})
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, epochs: int = EPOCHS, buckets: int = BUCKETS) -> DataFrame:
    """The rows of docs, each as often as the mix takes it; documents come whole (see copies in mix).

    What a source takes of its last epoch is the front of one order, so its whole epochs, the last row of that front
    and the copies of it that are taken say it all. They are joined to the documents by source, so no text is shuffled
    but those last rows. All columns are kept, whatever their names.
    """
    groups = _groups(docs, id_col, text_col, source_col, weights, epochs, buckets)
    n, size = F.col("n"), F.col("size")
    full = F.least(n, F.floor(F.greatest(F.lit(0), F.col("room")) / F.nullif(size, F.lit(0))).cast("long"))
    part = F.greatest(F.lit(0), F.col("room") - full * size)  # words of the one after the full ones
    extra = F.when(size > 0, full + ((full < n) & (part > 0) & (2 * part >= size)).cast("long")).otherwise(F.lit(0).cast("long"))
    groups = groups.withColumn("extra", extra)
    last = F.max(F.when(F.col("extra") > 0, F.struct(*ORDER, "extra"))).alias("last")
    limits = stage(groups.groupBy(*SOURCE).agg(F.max("whole").alias("whole"), last), "mix-limits")
    rows, at = _sourced(docs, id_col, text_col, source_col)
    back = [F.col(new).alias(name) for name, new in at.items()]
    end = F.struct(*[F.col(f"last.{c}").alias(c) for c in ORDER])
    before = F.col("last").isNotNull() & (size > 0) & (F.struct(*ORDER) < end)
    # the join stands between the counting of words and the filter, which would else be put below it and count again
    out = bounded_join(_keyed(rows), limits, SOURCE, "inner").withColumn("copies", F.col("whole") + F.coalesce(before, F.lit(False)).cast("long"))
    out = out.filter("copies > 0").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    ends = bounded_join(rows, limits, SOURCE, "inner").filter(F.col("x") == F.col("last.x")).dropDuplicates([*SOURCE, "x"]).withColumn("copies", F.col("last.extra"))
    return out.select(*back).unionByName(_repeated(ends, "copies", "i").select(*back))


def op10(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")


_SIZED = r"""
sized AS (SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS src_null,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
    CASE WHEN text IS NULL THEN 0 ELSE length(text) END AS chars, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest FROM documents),
keyed AS (SELECT doc_id, src, src_null, CAST(size AS BIGINT) AS size,
    -ln((CAST(('0x' || substr(digest, 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
    / CASE WHEN size = 0 THEN 0.01::DOUBLE ELSE greatest(0.01::DOUBLE, (size / (size + 20.0::DOUBLE)) / (1.0::DOUBLE + abs(chars / size - 6.0::DOUBLE) / 6.0::DOUBLE)) END AS k
    FROM sized)"""

SQL10 = f"""WITH {_SIZED},
per AS (SELECT src, src_null, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY ALL),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY src_null, src) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM per),
lev AS (SELECT *, 3.0::DOUBLE * source_size AS cap, (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / w, src_null, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 3.0::DOUBLE * source_size / w, src_null, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
tgt AS (SELECT src, src_null, source_size, least(cap, coalesce(max(CASE WHEN level * w <= cap THEN level END) OVER (), 'infinity'::DOUBLE) * w) AS target FROM lev),
cum AS (SELECT k.*, t.source_size, t.target, coalesce(sum(size) OVER (PARTITION BY k.src, k.src_null ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
    FROM keyed k JOIN tgt t ON k.src = t.src AND k.src_null = t.src_null)
SELECT doc_id, size, source_size, target, CAST(size * whole + greatest(0, least(size, floor(target - whole * source_size - before))) AS BIGINT) AS taken FROM cum"""

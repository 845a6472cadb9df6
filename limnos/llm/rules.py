r"""Quality rules with verdicts on hosts, in DataFrame operations only.

Counts of each document come from its words (runs of ``[^\x20\x09-\x0D]``). Rule failures are summed by host,
each host's failure rate is shrunk towards a beta prior whose two parameters are fitted to the rates of all
hosts by their mean and variance, and the verdict on the host is joined back to its documents: a host whose rate
passes a limit goes as a whole; of a host whose rate of a rule is above the prior's mean, the documents that fail
that rule go; elsewhere such a failure is taken for an accident. The base rule holds on every host.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.plans.staging import bounded_join, let, stage

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: A host goes when the shrunk share of its documents that fail a rule passes this.
HOST_LIMIT = 0.5
RULES = ("base", "symbols", "dup_lines", "word_length")
#: The rules that a host's verdict turns on or off, and by how much its rate must be above the mean.
SOFT = RULES[1:]
ABOVE = 1e-9


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Window digests are sorted; only a text with equal neighbours goes on to sort (digest, place) pairs, from
    whose places the covered words are summed: each repeated window adds the words that the one before left.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))

    def covered(pairs: Column) -> Column:
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        places = F.array_sort(F.transform(F.filter(pairs, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))), lambda x: x["i"]))
        total = F.aggregate(
            places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        )
        return total["n"]

    def count(hashes: Column) -> Column:
        repeats = let(F.sort_array(hashes), lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.get(s, i) == F.get(s, i - 1)))
        pairs = lambda: F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(hashes) < 2, F.lit(0).cast("long")).when(repeats, let(pairs(), covered)).otherwise(F.lit(0).cast("long"))

    def from_words(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(windows(h), count)))

    return let(words, from_words)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """A row of counts for each row of docs: id, host (``__host``, never null, and ``__no_host``) and the counts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    host = F.col(f"`{host_col}`").cast("string")

    def of_words(w: Column) -> Column:
        chars = F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
        return F.struct(F.size(w).cast("long").alias("n_words"), chars.alias("word_chars"), repeated_words(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    rows = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.coalesce(host, F.lit("")).alias("__host"), host.isNull().alias("__no_host"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(words, of_words).alias("__w"), let(lines, of_lines).alias("__l"),
    )
    return rows.select("*", "__w.*", "__l.*").drop("__w", "__l")


def failures() -> dict[str, Column]:
    """Each rule's failure, from the counts."""
    n = F.col("n_words")
    return {
        "base": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n),
    }


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """A row for each host: its documents, its shrunk failure rate by rule, host_kept, and which soft rules are strict there.

    The prior of a rule is Beta(m k, (1 - m) k) with m the mean of the hosts' rates and k = m (1 - m) / v - 1
    for their variance v, held between 1 and 1e6; with one host or equal rates k is 1e6.
    """
    hosts = rows.groupBy("__host", "__no_host").agg(F.count("*").alias("n_docs"), *[F.sum(f"fail_{r}").alias(f"fail_{r}") for r in RULES])
    rate = lambda r: F.col(f"fail_{r}") / F.col("n_docs")
    prior = hosts.agg(*[F.avg(rate(r)).alias(f"m_{r}") for r in RULES], *[F.var_pop(rate(r)).alias(f"v_{r}") for r in RULES])
    row = prior.first()  # the prior is a few numbers
    mean, k = {}, {}
    for r in RULES:
        m, v = row[f"m_{r}"], row[f"v_{r}"]
        mean[r], k[r] = F.lit(m).cast("double"), F.lit(min(1e6, max(1.0, m * (1 - m) / v - 1)) if v else 1e6)
    rates = [((F.col(f"fail_{r}") + mean[r] * k[r]) / (F.col("n_docs") + k[r])).alias(f"rate_{r}") for r in RULES]
    strict = [(F.col(f"rate_{r}") > mean[r] + ABOVE).alias(f"strict_{r}") for r in SOFT]
    hosts = hosts.select("*", *rates).select("__host", "__no_host", "n_docs", *[f"rate_{r}" for r in RULES], *strict)
    return hosts.withColumn("host_kept", F.greatest(*[F.col(f"rate_{r}") for r in RULES]) <= limit)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, base_failed, the host's verdict and kept for each row of docs.

    A null text has no words and fails; null hosts are one host; repeated rows count as often as they come;
    no rows give no rows. A host is judged by rates only, so its clean documents go with it when it goes. A very long
    text is counted as a whole; other columns are left out, whatever their names.
    """
    rows = counts(docs, id_col, text_col, host_col)
    rows = stage(rows.withColumns({f"fail_{r}": c.cast("long") for r, c in failures().items()}), "rules")
    verdicts = stage(host_verdicts(rows, limit), "hosts")
    strict = [F.col(f"strict_{r}") for r in SOFT]
    judged = verdicts.filter(reduce(or_, strict, ~F.col("host_kept"))).select("__host", "__no_host", "host_kept", *strict)
    out = bounded_join(rows, judged, ["__host", "__no_host"], "left").withColumn("base_failed", F.col("fail_base") == 1)
    failed = reduce(or_, [(F.col(f"fail_{r}") == 1) & F.col(f"strict_{r}") for r in SOFT])
    good = F.coalesce(F.col("host_kept") & ~failed, F.lit(True))
    return out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & good).alias("kept"))


def op7(spark, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_RATES = ", ".join(f"(sum(f_{r}) + m_{r} * k_{r}) / (count(*) + k_{r}) AS r_{r}, m_{r}" for r in RULES)
_FAILS = " OR ".join(f"(f_{r} = 1 AND r_{r} > m_{r} + {ABOVE})" for r in SOFT)
SQL7 = rf"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
toks AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
word AS (SELECT rid, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM toks),
win AS (SELECT rid, i, w || ' ' || lead(w) OVER d || ' ' || lead(w, 2) OVER d AS g FROM word WINDOW d AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win WHERE g IS NOT NULL) x WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + s) AS n FROM rep, (VALUES (0), (1), (2)) v(s) GROUP BY rid),
line AS (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM docs),
dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
wc AS (SELECT rid, count(*) AS n, sum(length(w)) AS c FROM word GROUP BY rid),
base AS (SELECT doc_id, source, CAST(coalesce(wc.n, 0) AS BIGINT) AS n_words, CAST(coalesce(wc.c, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, coalesce(dup.n_lines, 0) AS n_lines
    FROM docs LEFT JOIN wc USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CAST(n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS INT) AS f_base, CAST(10 * n_symbols > n_words AS INT) AS f_symbols,
    CAST(10 * n_dup_lines > 3 * n_lines AS INT) AS f_dup_lines, CAST(word_chars < 3 * n_words OR word_chars > 12 * n_words AS INT) AS f_word_length FROM base),
host AS (SELECT source, {", ".join(f"avg(f_{r}) AS a_{r}" for r in RULES)} FROM f GROUP BY source),
mv AS (SELECT {", ".join(f"avg(a_{r}) AS m_{r}, var_pop(a_{r}) AS v_{r}" for r in RULES)} FROM host),
prior AS (SELECT *, {", ".join(f"CASE WHEN v_{r} > 0 THEN least(1e6, greatest(1.0, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE 1e6 END AS k_{r}" for r in RULES)} FROM mv),
verdict AS (SELECT source, {_RATES} FROM f, prior GROUP BY source, {", ".join(f"m_{r}, k_{r}" for r in RULES)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND greatest({", ".join(f"r_{r}" for r in RULES)}) <= {HOST_LIMIT} AND NOT ({_FAILS}) AS kept
FROM f JOIN verdict v ON f.source IS NOT DISTINCT FROM v.source"""

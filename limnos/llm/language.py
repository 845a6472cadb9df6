"""Language identification by compression.

Each language has a raw-content dictionary of its own text. A document, cut into short blocks so that it can't
teach the compressor its own language, is compressed with every dictionary; the smallest total wins, and a
document whose runner-up comes close is rejected.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from limnos.llm.text import blocks, small_batches
from limnos.plans.staging import bounded_join, stage

#: Training documents of a language, characters from the middle of each that are gathered and bytes of these that go
#: to the dictionary at most; and bytes of a dictionary and of all of them.
DOCS_PER_LANGUAGE = 160
CHARS_PER_DOC = 4096
BYTES_PER_DOC = 2048
DICTIONARY_BYTES = 98_304
ALL_BYTES = 64 << 20
#: Bytes of a document compressed at once.
PIECE = 2048
#: The runner-up must be larger by this share, or the document is rejected.
MARGIN = 0.002
#: Bytes saved that multiply the odds of a language by e.
BYTES_PER_NAT = 12.0
#: Letters, and some other signs that count as numbers.
LETTER = re.compile(r"[^\W\d_]")
NOISE = bytes(b for b in range(128) if not (chr(b).isalpha() or b in b" '"))
UNDETERMINED = "und"


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def has_letter(text: str) -> bool:
    """Whether a character is of the Unicode category L."""
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def letters(text: str) -> bytes:
    """Lower-cased text without ASCII digits, controls and punctuation."""
    return text.lower().encode().translate(None, NOISE)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> dict[str, bytes]:
    """A dictionary of each language from a bounded sample: the middles of its different texts in the order of a hash.

    At most `docs_per_language` texts of a language are gathered, CHARS_PER_DOC characters of each, and their letters
    fill its dictionary until it has DICTIONARY_BYTES, or its share of ALL_BYTES where there are very many languages.
    Rows without a language, a text or a letter teach nothing; copies of a text count once.
    """
    small_batches(docs)
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    rows = docs.filter(lang.isNotNull() & text.isNotNull())
    start = F.greatest(F.lit(1), F.floor((F.length(text) - CHARS_PER_DOC) / 2).cast("int") + 1)
    rows = rows.select(lang.alias("lang"), F.substring(text, start, F.lit(CHARS_PER_DOC)).alias("text"), F.xxhash64(text).alias("h"))
    # a share of each language's different texts that holds some four times the sample, so that no language is gathered
    # in one task; copies of a text come or go together, so rows don't count
    share = rows.select("lang", "h").distinct().groupBy("lang").agg(F.least(F.lit(1.0), F.lit(4.0 * docs_per_language) / F.count("*")).alias("share"))
    rows = bounded_join(rows, stage(share, "languages"), ["lang"], "inner").filter(F.pmod(F.col("h"), F.lit(1 << 30)) <= F.col("share") * (1 << 30))
    rows = rows.groupBy("lang", "h").agg(F.first("text").alias("text"))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("n") <= docs_per_language)
    found: dict[str, list[bytes]] = {}
    for r in rows.orderBy("lang", "n").collect():
        found.setdefault(r["lang"], []).append(letters(r["text"])[:BYTES_PER_DOC])
    most = min(DICTIONARY_BYTES, ALL_BYTES // max(1, len(found)))
    return {k: b" ".join(v)[:most] for k, v in found.items() if any(v)}


@lru_cache(maxsize=4)
def compressors(dictionaries: tuple[tuple[str, bytes], ...]):
    import zstandard

    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, window_log=18, hash_log=17, chain_log=17, search_log=4, min_match=4,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    out = []
    for name, data in dictionaries:
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append((name, zstandard.ZstdCompressor(dict_data=d, compression_params=params)))
    return out


def classify(text: str | None, models, margin: float = MARGIN) -> tuple[str, float, bool]:
    """(language, score, rejected) of one text."""
    if not models or not text or not has_letter(text):
        return UNDETERMINED, 0.0, True
    clean = letters(text)
    parts = [clean[i : i + PIECE] for i in range(0, len(clean), PIECE)] or [b""]
    sizes = [(sum([len(c.compress(p)) for p in parts]), name) for name, c in models]
    best, name = min(sizes)
    score = 1.0 / sum(math.exp((best - s) / BYTES_PER_NAT) for s, _ in sizes)
    second = min((s for s, n in sizes if n != name), default=None)
    return name, score, second is not None and second - best < margin * second


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN, keep: tuple[str, ...] = ()) -> DataFrame:
    """lang_pred, score and rejected for each row of docs, beside its id and the columns in `keep`.

    A text that is null or has no letter is `und` with score 0 and rejected, as is every text when no language
    was learned; ties go to the first language by name; repeated rows get equal results; a very long text is
    compressed piece by piece and counts as a whole; no rows give no rows. Columns that aren't kept may have any
    name; a kept one with the name of a result is an error.
    """
    small_batches(docs)
    kept = [id_col, *[c for c in keep if c not in (id_col, text_col)]]
    fields = [*[docs.schema[c] for c in kept], *([StructField(text_col, StringType())] if text_col in keep else [])]
    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())])
    if len({n.lower() for n in schema.names}) < len(schema.names):
        raise ValueError(f"a kept column has the name of a result: {schema.names}")
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text_col}`").cast("string").alias("text"))
    frozen = tuple(sorted(dictionaries.items()))

    def run(batches):
        models = compressors(frozen)
        for part in blocks(batches, "text"):
            texts = part.column(part.num_columns - 1)
            got = [classify(t, models, margin) for t in texts.to_pylist()]
            columns = part.columns[: len(fields)]  # the text is the last column, and the last field if it is kept
            yield pa.RecordBatch.from_arrays([*columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())], names=schema.names)

    return source.mapInArrow(run, schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dictionaries = learn(docs.filter(crc_mod(F.col("doc_id"), 4) != 2))
    out = identify(docs, dictionaries)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")

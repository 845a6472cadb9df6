"""License scans by conditional compression.

A text with a cue word is cut into overlapping blocks of words, wherever lines break. Each block is compressed
without a dictionary, with all templates as one raw-content dictionary and, where that saves bytes, with each
template's own: a template is a candidate where it shrinks a block, and nowhere else. It may differ from the text in
a share of its words. Cut into one more piece than words may differ, one of its pieces at least is in the text word by
word, which gives the places at a candidate block. They are confirmed by aligning the template with the words there (a
finding holds those that are missing, added or changed, none of which may be a license's name or version) and by
compressing just these words with the template and without. Of findings that overlap, the longest with the fewest
differences stays, of equally long ones the one that is shrunk more, so a text gives all its licenses.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from limnos.llm.text import LOWER, blocks, small_batches, text_bytes

#: Name and wording of each template. A name may have several wordings.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    *((name, f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
      for name, what, kind, version in (
          ("GPL-2.0", "program", "", "2"), ("LGPL-2.0", "library", "Library ", "2"), ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-2.1", "program", "Lesser ", "2.1"),
          ("LGPL-3.0", "library", "Lesser ", "3"), ("LGPL-3.0", "program", "Lesser ", "3"), ("AGPL-3.0", "program", "Affero ", "3"))),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    *((f"CC-BY-{short}-4.0", text)
      for short, long in (("ND", "NoDerivatives"), ("NC-SA", "NonCommercial-ShareAlike"), ("NC-ND", "NonCommercial-NoDerivatives"))
      for text in (f"Licensed under CC BY-{short} 4.0", f"This work is licensed under a Creative Commons Attribution-{long} 4.0 International License")),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Parts of single words, as lines may break between words; each template has more of them than words that may differ.
CUES = (b"licen", b"copyright", b"permission", b"redistribut", b"domain", b"software", b"commons", b"binary", b"permitted", b"unencumbered", b"rights", b"modify", b"foundation", b"governed", b"mozilla", b"mpl", b"dedicated")
#: The share of a template's words that may differ, and the words, beside numbers, that may not.
TOLERANCE = 0.12
NAMES = frozenset("apache mit gnu lesser library affero general mozilla mpl bsd creative commons attribution sharealike noncommercial noderivatives noderivs share alike commercial derivatives".split())
#: Bytes by which a template must shrink a finding.
LEAST_SAVED = 4
#: Bytes by which a template must shrink a block: far less than what any wording shrinks the best of its blocks by.
LEAST_SHRUNK = 1
#: Words of a block, every BLOCK / 2 words: one holds the whole of a wording of up to BLOCK / 2 + 1 words.
BLOCK = 16
#: Characters of a word that are compressed; no template has a word as long, and dictionaries stay in reach.
LONGEST = 20
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def words(text: str) -> list[tuple[str, int, int]]:
    """Lower-cased words with their places. Case folding keeps places: only A-Z change."""
    folded = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return [(m[0], m.start(), m.end()) for m in WORD.finditer(folded)]


def parameters():
    import zstandard

    return zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_BTOPT, window_log=16, hash_log=14, chain_log=14, search_log=4, min_match=3, target_length=64, write_content_size=False, write_checksum=False, write_dict_id=False)


@lru_cache(maxsize=1)
def templates():
    import zstandard

    params = parameters()
    plain = zstandard.ZstdCompressor(compression_params=params)
    out = []
    for name, text in TEMPLATES:
        found = [w for w, _, _ in words(text)]
        data = zstandard.ZstdCompressionDict(" ".join(found).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        most = int(TOLERANCE * len(found))
        cuts = [len(found) * i // (most + 1) for i in range(most + 2)]
        parts = [(i, f" {' '.join(found[i:j])} ") for i, j in zip(cuts, cuts[1:], strict=False)]
        out.append((name, found, zstandard.ZstdCompressor(dict_data=data, compression_params=params), most, parts))
    return plain, out


@lru_cache(maxsize=1)
def together():
    """A compressor with all templates as one dictionary."""
    import zstandard

    every = " ".join(" ".join(wording) for _, wording, _, _, _ in templates()[1])
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(every.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=parameters())


def shrunk(block: list[str]) -> dict[int, list[int]]:
    """Where the blocks of a text's words begin that each template shrinks."""
    plain, known = templates()
    every = together()
    short = [w[:LONGEST] for w in block]
    out: dict[int, list[int]] = {}
    for at in range(0, max(1, len(short) - BLOCK // 2), BLOCK // 2):
        data = " ".join(short[at : at + BLOCK]).encode()
        most = len(plain.compress(data)) - LEAST_SHRUNK
        if len(every.compress(data)) <= most:
            for k, (_, _, compressor, _, _) in enumerate(known):
                if len(compressor.compress(data)) <= most:
                    out.setdefault(k, []).append(at)
    return out


def naming(difference: str, block: list[str]) -> bool:
    """Whether a difference touches a name or a version, or is a word inside a name; "3" and "3.0" are one version."""
    touched = re.sub("^[-+]", "", difference).split(">")
    if len({re.sub(r"(\.0)+$", "", w) for w in touched}) < len(touched):
        return False
    protected = lambda w: w in NAMES or w[0].isdigit()
    if any(map(protected, touched)):
        return True
    return difference[0] != "-" and any(w == touched[-1] and protected(block[i]) and protected(block[i + 2]) for i, w in enumerate(block[1:-1]))


def align(template: list[str], block: list[str]) -> tuple[int, int, int, list[str]]:
    """(differences, start, end, wording): the template against the part of the block that differs least.

    Wording lists "-word" for a missing, "+word" for an added and "word>other" for a changed word.
    """
    n, m = len(template), len(block)
    cost = [[0] * (m + 1)]
    for i in range(1, n + 1):
        above, row = cost[-1], [i]
        for j in range(1, m + 1):
            row.append(min(above[j - 1] + (template[i - 1] != block[j - 1]), above[j] + 1, row[j - 1] + 1))
        cost.append(row)
    end = min(range(m + 1), key=lambda j: (cost[n][j], j))
    i, j, diff = n, end, []
    while i:
        if j and cost[i][j] == cost[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            if template[i - 1] != block[j - 1]:
                diff.append(f"{template[i - 1]}>{block[j - 1]}")
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + 1:
            diff.append(f"-{template[i - 1]}")
            i -= 1
        else:
            diff.append(f"+{block[j - 1]}")
            j -= 1
    return cost[n][end], j, end, diff[::-1]


def scan(text: str) -> list[tuple[str, int, int, float, list[str], bool]]:
    """Findings (name, start, end, reduction, differences, exact) of one text, by place; none overlap."""
    plain, known = templates()
    found = words(text)
    block = [w for w, _, _ in found]
    joined, at = f" {' '.join(block)} ", [0]
    for w in block:
        at.append(at[-1] + len(w) + 1)
    held = []
    for k, begins in shrunk(block).items():
        _, wording, compressor, most, parts = known[k]
        reach = len(wording) + most
        starts, done = set(), 0
        for begin in begins:
            lo, hi = max(done, at[max(0, begin - reach)]), at[min(len(block), begin + BLOCK + reach)] + 1
            for offset, part in parts:
                place = joined.find(part, lo, hi)
                while place >= 0:
                    starts.add(bisect_left(at, place) - offset)
                    place = joined.find(part, place + 1, hi)
            done = max(0, hi - max(len(part) for _, part in parts))
        seen = set()
        for start in sorted(starts):
            if start >= 0 and block[start : start + len(wording)] == wording:
                differences, a, b, diff = 0, start, start + len(wording), []
            elif most:
                lo = max(0, start - most)
                differences, a, b, diff = align(wording, block[lo : max(0, start + len(wording) + most)])
                a, b = lo + a, lo + b
            else:
                continue
            if b <= a or (a, b) in seen or differences > most or any(naming(x, block[a:b]) for x in diff):
                continue
            seen.add((a, b))
            data = " ".join(block[a:b]).encode()
            alone = len(plain.compress(data))
            less = alone - len(compressor.compress(data))
            if less >= LEAST_SAVED:
                held.append((len(wording) - 2 * differences, less, -k, a, b, less / alone, diff))
    out: list[tuple[int, int, int, float, list[str]]] = []
    taken = bytearray(len(block))
    for _, _, k, a, b, reduction, diff in sorted(held, key=lambda x: (x[:3], -x[3]), reverse=True):
        if not any(taken[a:b]):
            taken[a:b] = b"\1" * (b - a)
            out.append((a, b, -k, reduction, diff))
    return [(known[k][0], found[a][1], found[b - 1][2], reduction, diff, not diff) for a, b, k, reduction, diff in sorted(out)]


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and findings (license, start, end, reduction, differences, exact) of each row of docs.

    Places count code points, ends are exclusive. A null or empty text has no findings; repeated rows get equal
    ones; of templates that fit a block equally, the one that shrinks it more wins; a very long text is scanned as a
    whole; other columns are left out, whatever their names; no rows give no rows.
    """
    small_batches(docs)
    finding = StructType(
        [StructField("license", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("reduction", DoubleType()), StructField("differences", ArrayType(StringType())), StructField("exact", BooleanType())]
    )
    schema = StructType([docs.schema[id_col], StructField("findings", ArrayType(finding))])
    arrow = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("differences", pa.list_(pa.string())), ("exact", pa.bool_())]))
    names = [f.name for f in finding.fields]
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "__text"):
            data, offsets = text_bytes(part.column(1))
            lower = LOWER[data].tobytes()
            hits = set()
            for cue in CUES:
                at = lower.find(cue)
                while at >= 0:
                    row = int(offsets.searchsorted(at, "right")) - 1
                    hits.add(row)
                    at = lower.find(cue, int(offsets[row + 1]))
            rows = [[] for _ in range(part.num_rows)]
            for row in hits:
                if text := part.column(1)[row].as_py():
                    rows[row] = [dict(zip(names, f, strict=True)) for f in scan(text)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, arrow)], names=schema.names)

    return source.mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    found = find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    main = F.get(F.array_sort(F.col("findings"), lambda a, b: F.when(a["reduction"] > b["reduction"], -1).when(a["reduction"] < b["reduction"], 1).otherwise(a["start"] - b["start"]).cast(IntegerType())), F.lit(0))
    return found.select(
        "doc_id", F.size("findings").cast("long").alias("n_findings"), main["license"].alias("license"), main["reduction"].alias("reduction"),
        F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"], F.size(x["differences"]))), ",").alias("spans"),
    )

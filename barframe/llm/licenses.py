"""License scans: MinHash bands over overlapping text windows retrieve templates, then exact
shingle containment verifies them.

Only DataFrame functions are used. A text is a list of lower-case words; its shingles are three
words in a row. Windows of ``WINDOW`` words begin at every ``STRIDE``-th word, so at least one
holds five or more consecutive words of any template in the text, and a template is indexed with
all its windows and with its beginnings and ends of five words or more. Such a window and its
indexed counterpart share at least half of their shingles, so with ``BANDS`` bands of one MinHash
value each they collide with probability 1 - 2 ** -BANDS or more, and a longer verbatim passage,
whose windows have equal counterparts, always does.

Lines ``SPDX-License-Identifier: ...`` are read by a pattern, whatever identifiers they name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 3
WINDOW = 8
STRIDE = 4
BANDS = 10
CONTAINMENT = 0.8

#: Notices by which texts state their license, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-or-later", "either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0-or-later", "either version 2 of the License, or (at your option) any later version"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)

_GNU = "the terms of the [{} as published by the Free Software Foundation, either version {}] of the License, or (at your option) any later version"
_LESSER, _LIBRARY, _AFFERO = "GNU Lesser General Public License", "GNU Library General Public License", "GNU Affero General Public License"
_SPOKEN = (
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License 2.0"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("GPL-2.0", "GNU General Public License version 2"),
    ("GPL-3.0", "GNU General Public License version 3"),
    ("LGPL-2.1", f"{_LESSER} version 2.1"),
    ("LGPL-3.0", f"{_LESSER} version 3"),
    ("AGPL-3.0", f"{_AFFERO} version 3"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License v. 2.0"),
    ("EPL-1.0", "Eclipse Public License v1.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
)

#: Whole notices and further wordings. What stands in brackets names the license and
#: must be in a text word for word, so notices that differ in a name or a version are told apart.
NOTICES = (
    ("LGPL-2.0-or-later", _GNU.format(_LIBRARY, "2 of")),
    ("LGPL-2.1-or-later", _GNU.format(_LESSER, "2.1 of")),
    ("LGPL-3.0-or-later", _GNU.format(_LESSER, "3 of")),
    ("AGPL-3.0-or-later", _GNU.format(_AFFERO, "3 of")),
    ("CC0-1.0", "To the extent possible under law, the author has [waived all copyright and related or neighboring rights] to this work"),
    ("CC0-1.0", "has dedicated the work to the public domain by [waiving all of his or her rights to the work worldwide under copyright law]"),
    ("CC0-1.0", "This work is licensed under [CC0 1.0 Universal]"),
    ("CC0-1.0", "This work is dedicated to the public domain under [CC0 1.0]"),
    ("EPL-1.0", "made available under the terms of the [Eclipse Public License v1.0] which accompanies this distribution"),
    ("EPL-2.0", "made available under the terms of the [Eclipse Public License 2.0] which is available at"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or [organization obtaining a copy of the software and accompanying documentation] covered by this license"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for [any damages arising from the use of this software]"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons [Attribution-NoDerivatives 4.0 International] License"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons [Attribution-NonCommercial-ShareAlike 4.0 International] License"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons [Attribution-NonCommercial-NoDerivatives 4.0 International] License"),
    *((name, f"[{verb} under {terms}the {spoken}]") for name, spoken in _SPOKEN for verb in ("licensed", "released", "distributed", "available") for terms in ("", "the terms of ")),
)

#: An SPDX expression, which ends at a line's end or where a comment closes.
SPDX = r"(?i)SPDX-License-Identifier\s*:[ \t]*([A-Za-z0-9.+:() \t-]+)"


def words(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(listed: str) -> Column:
    """64-bit hashes of every three words in a row, in text order."""
    inner = F.when(F.size(listed) >= SHINGLE, F.slice(listed, 1, F.size(listed) - (SHINGLE - 1))).otherwise(F.array().cast("array<string>"))
    return F.transform(inner, lambda w, i: F.xxhash64(w, F.col(listed)[i + 1], F.col(listed)[i + 2]))


def _seeds(bands: int) -> list[int]:
    return np.random.default_rng(11).integers(-(1 << 63), (1 << 63) - 1, bands).tolist()


def window_bands(df: DataFrame, hashes: str, out: str, bands: int = BANDS, window: int = WINDOW, stride: int = STRIDE) -> DataFrame:
    """Add the MinHash values of all windows of a shingle list, all bands in one array.

    A window reads its shingles by place: ``slice`` would copy the whole list for every window.
    """
    width = window - SHINGLE + 1

    def values(k: Column) -> Column:
        inside = [F.get(hashes, k * stride + i) for i in range(width)]  # null beyond the end
        return F.array(*[F.least(*[h.bitwiseXOR(F.lit(seed)) for h in inside]) for seed in _seeds(bands)])

    starts = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / stride).cast("int"))
    found = F.when(F.size(hashes) > 0, F.array_distinct(F.flatten(F.transform(starts, values))))
    return df.withColumn(out, F.coalesce(found, F.array().cast("array<bigint>")))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(template, license, words, hashes, named)`` of the templates; the list is fixed and small."""
    rows = [(i, name, text, " ".join(re.findall(r"\[(.*?)\]", text))) for i, (name, text) in enumerate(templates)]
    listed = spark.createDataFrame(rows, "template int, license string, text string, bracket string").withColumn("words", words("text"))
    named = listed.withColumn("inside", words("bracket")).withColumn("named", shingles("inside"))
    return named.withColumn("hashes", F.array_distinct(shingles("words"))).select("template", "license", "words", "hashes", "named")


def _least(hashes: str, seed: int) -> Column:
    return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(seed))))


def template_bands(templates: DataFrame, bands: int = BANDS, window: int = WINDOW) -> DataFrame:
    """``(band, template)``: MinHash values of all windows, beginnings and ends of the templates."""
    width, least = window - SHINGLE + 1, 5 - SHINGLE + 1
    n = F.size("hashes")
    spans = F.concat(
        F.transform(F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))), lambda s: F.struct(s.alias("s"), F.lit(width).alias("k"))),
        F.transform(F.sequence(F.lit(least), F.lit(width)), lambda k: F.struct(F.lit(1).alias("s"), k.alias("k"))),
        F.transform(F.sequence(F.lit(least), F.lit(width)), lambda k: F.struct(F.greatest(n - k + 1, F.lit(1)).alias("s"), k.alias("k"))),
    )
    parts = templates.select("template", "words", "hashes", F.explode(F.array_distinct(spans)).alias("span")).select("template", F.slice("hashes", F.col("span.s"), F.col("span.k")).alias("part"))
    values = F.array(*[_least("part", seed) for seed in _seeds(bands)])
    return parts.select("template", F.explode(values).alias("band")).distinct()


def _times(hashes: str, phrase: Column) -> Column:
    """How often a list of shingles stands in a text, in its order."""
    return F.size(F.filter(hashes, lambda h, i: (h == F.get(phrase, F.lit(0))) & (F.slice(hashes, i + 1, F.greatest(F.size(phrase), F.lit(1))) == phrase)))


def _share(hashes: str, wanted: Column) -> Column:
    return F.size(F.array_intersect(F.col(hashes), wanted)) / F.size(wanted)


def spdx_lines(docs: DataFrame, doc_id: str, text: str, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``(doc_id, license, containment)`` of the identifiers in SPDX lines; exceptions after WITH are
    left out, and an identifier of a template has its spelling."""
    spelling = {name.lower(): name for name, _ in templates}
    known = F.create_map(*[F.lit(v) for pair in spelling.items() for v in pair]) if spelling else F.create_map().cast("map<string,string>")
    lines = docs.where(F.col(text).contains("-") & F.lower(F.col(text)).contains("spdx-license-identifier")).select(F.col(doc_id).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(SPDX), F.lit(1))).alias("line"))
    # the first word after an opening bracket, AND or OR is an identifier; anything else ends the expression
    plain = F.regexp_replace(F.regexp_replace("line", r"(?i)\s+WITH\s+[A-Za-z0-9.+-]+", ""), r"[()]", " ")
    parts = F.split(F.trim(F.regexp_replace(plain, r"\s+", " ")), r" (?:AND|OR) ")
    name = F.explode(F.transform(parts, lambda x: F.regexp_extract(x, r"^([A-Za-z0-9][A-Za-z0-9.+:-]*)", 1))).alias("name")
    return lines.select("doc_id", name).where("name <> ''").select("doc_id", F.coalesce(F.try_element_at(known, F.lower("name")), "name").alias("license"), F.lit(1.0).alias("containment"))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES + NOTICES, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license, containment)``: the licenses whose notice a document holds, with the
    largest share of a template's shingles found in it, at least ``containment``.

    Words in brackets must all be there, in order. Where a text holds such a notice, a clause of another
    license that stands in the notice counts only if it stands elsewhere too; the share of a fuller
    template goes before that of a wording of the same license that it contains. Whole texts are scanned. A
    null, empty or short text holds none; other columns are ignored; a repeated document row gives
    repeated results once per id, license and share.
    """
    table = template_table(docs.sparkSession, templates)
    index: dict[int, list[int]] = {}
    for r in template_bands(table).collect():  # of the fixed templates
        index.setdefault(r["band"], []).append(r["template"])
    bands = sorted(index)
    rows = [r for r in table.collect() if r["hashes"]]
    fuller = {
        r["template"]: [(f["hashes"], f["named"], len({*r["hashes"]} & {*f["hashes"]})) for f in rows if f["named"] and not r["named"] and f["license"] != r["license"] and len({*r["hashes"]} & {*f["hashes"]}) >= containment * len(r["hashes"])]
        for r in rows
    }
    holders = {r["template"]: [f["hashes"] for f in rows if f["license"] == r["license"] and {*r["hashes"]} < {*f["hashes"]}] for r in rows}
    wanted = docs.sparkSession.createDataFrame(
        [(r["template"], r["license"], r["hashes"], r["named"], fuller[r["template"]], holders[r["template"]]) for r in rows],
        "template int, license string, wanted array<bigint>, named array<bigint>, fuller array<struct<hashes: array<bigint>, named: array<bigint>, common: int>>, holders array<array<bigint>>",
    )
    listed = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), words(text).alias("words"))
    hashed = listed.withColumn("hashes", shingles("words")).select("doc_id", "hashes")
    met = window_bands(hashed, "hashes", "bands").withColumn("bands", F.expr(f"filter(bands, b -> b in ({', '.join(f'{b}L' for b in bands)}))") if bands else F.col("bands"))
    filed = F.map_from_arrays(F.lit(bands).cast("array<bigint>"), F.lit([",".join(map(str, sorted(index[b]))) for b in bands]).cast("array<string>"))
    candidates = F.array_distinct(F.flatten(F.transform("bands", lambda b: F.split(F.try_element_at(filed, b), ","))))
    # An outer explode: the filters of an inner one are pushed below the bands and compute them per element.
    retrieved = met.select("doc_id", "hashes", F.explode_outer(candidates.cast("array<int>")).alias("template"))
    found = retrieved.join(F.broadcast(wanted), "template").withColumn("containment", _share("hashes", F.col("wanted"))).where(F.col("containment") >= containment)
    found = found.where((F.size("named") == 0) | (_times("hashes", F.col("named")) > 0))
    found = found.where(~F.exists("holders", lambda h: _share("hashes", h) >= containment))
    inside = F.aggregate(
        "fuller", F.lit(0), lambda total, f: total + F.when(_share("hashes", f["hashes"]) >= containment, _times("hashes", f["named"]) * f["common"]).otherwise(F.lit(0))
    )
    hits = F.size(F.filter("hashes", lambda h: F.array_contains(F.col("wanted"), h)))
    elsewhere = (F.size("fuller") == 0) | (inside == 0) | (hits - inside >= containment * F.size("wanted"))
    notices = found.where(elsewhere).select("doc_id", "license", "containment")
    return notices.unionByName(spdx_lines(docs, doc_id, text, templates)).groupBy("doc_id", "license").agg(F.max("containment").alias("containment"))

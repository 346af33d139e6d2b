"""License texts inside documents, in DataFrame functions only.

Templates are cut into pieces of PIECE_WORDS words, and texts into windows of twice as
many words that overlap by half, so a piece that occurs lies inside a window whole. Both
are sets of word pairs. Ten hash functions give ten minima and ten maxima, each a band of
its own: a piece inside a window has similarity of at least 4/9 to it, and the chance that
all 20 bands differ is below 1e-5. Only windows that hold a pair of some template are
hashed: no other can share a band. Templates found so are verified by exact containment of
their five-word shingles. A text is scanned within its row: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.divergence import let
from tidemark.llm.text import seeded, text_key

PIECE_WORDS = 5
HASHES = 10
SHINGLE = 5
CONTAINED_PERCENT = 80
# A pair's hash with some bits turned over is another hash of it: the least one is the
# nearest to the mask, which any of a set's random hashes is equally likely to be.
MASKS = [int(m) for m in seeded(43, HASHES).view("int64")]

# Wordings by which licenses are given.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def license_words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _runs(words: Column, width: int) -> Column:
    """Hashes of every `width` words in a row."""
    return F.when(
        F.size(words) >= width,
        F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, width))),
    ).otherwise(F.array().cast("array<bigint>"))


def _pairs(words: Column) -> Column:
    """Hashes of every two words in a row."""
    ahead = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    return F.zip_with(ahead, F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda b, a: F.xxhash64(a, b))


def _bands(pairs: Column, starts: Column, width: int) -> Column:
    """Band keys of the sets of `width` pairs from each start on, all in one array."""

    def ends(window: Column, k: int) -> list[Column]:
        hashed = lambda pick: pick(F.transform(window, lambda x: x.bitwiseXOR(F.lit(MASKS[k]))))
        return [hashed(F.array_min), hashed(F.array_max)]

    def of(window: Column) -> Column:
        return F.array(*[key for k in range(HASHES) for key in ends(window, k)])

    return F.flatten(F.transform(starts, lambda i: let(F.slice(pairs, i, width), of)))


def _near_starts(pairs: Column, wanted: list[int], width: int) -> Column:
    """Starts 1, 6, 11, ... of the windows of `width` pairs that hold a wanted one.

    A band key is the hash of one of the set's own pairs, so no other window shares a band.
    """
    if not wanted:
        return F.array().cast("array<int>")
    held = F.transform(pairs, lambda x, i: F.when(x.isin(*wanted), i))
    at = F.filter(held, lambda i: i.isNotNull())
    # Place i, from 0 on, is in the windows that begin at the greatest multiple of the step up to it and, if near, at the one before.
    first = lambda i: i - i % PIECE_WORDS
    windows = [(lambda i, b=b: F.when((first(i) >= b) & (i < first(i) - b + width), first(i) - b + 1)) for b in range(0, width, PIECE_WORDS)]
    starts = F.flatten(F.transform(at, lambda i: F.array(*[w(i) for w in windows])))
    return F.array_distinct(F.filter(starts, lambda i: i.isNotNull()))


def _templates(spark, templates: Mapping[str, str]) -> list:
    """(name, shingles, keys, pairs) of each template with enough words for a shingle; driver-sized by contract."""
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in sorted(templates.items())])
    rows = spark.range(1).select(F.inline(listed)) if templates else spark.range(0).selectExpr("'' AS name", "'' AS text")
    words = license_words(F.col("text"))
    last = F.size("words") - PIECE_WORDS + 1
    step = F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(PIECE_WORDS))
    # The last piece ends with the template.
    pieces = F.when(last >= 1, F.array_distinct(F.concat(step, F.array(last))))
    named = rows.select("name", words.alias("words")).filter(F.size("words") >= max(SHINGLE, PIECE_WORDS))
    return named.select(
        "name", F.array_distinct(_runs(F.col("words"), SHINGLE)).alias("shingles"),
        F.array_distinct(_bands(_pairs(F.col("words")), pieces, PIECE_WORDS - 1)).alias("keys"),
        F.array_distinct(_pairs(F.col("words"))).alias("pairs"),
    ).collect()


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = CONTAINED_PERCENT
) -> DataFrame:
    """(doc_id, text_key, n_words, licenses) of every row of `docs`.

    `licenses` holds (name, percent) of each template of whose distinct five-word shingles
    the text has at least `percent` in the hundred, in order of name. `templates` is a
    fixed list that every task gets; one of fewer words than a shingle finds nothing. A
    null, empty or short text has none; repeated rows repeat; no rows give no rows. Other
    columns are not looked at.
    """
    found = _templates(docs.sparkSession, templates)
    by_key: dict[int, list[int]] = {}
    for i, t in enumerate(found):
        for key in t["keys"]:
            by_key.setdefault(key, []).append(i)
    words = license_words(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), words.alias("words"))
    rows = rows.withColumn("pairs", _pairs(F.col("words")))
    wanted = sorted({pair for t in found for pair in t["pairs"]})
    width = 2 * PIECE_WORDS - 1
    rows = rows.withColumn("starts", _near_starts(F.col("pairs"), wanted, width))
    keys = F.when(F.size("starts") > 0, _bands(F.col("pairs"), F.col("starts"), width))
    hit = F.array_distinct(F.filter(keys, lambda k: k.isin(*by_key))) if by_key else F.array().cast("array<bigint>")
    rows = rows.withColumn("hit", F.coalesce(hit, F.array().cast("array<bigint>"))).drop("pairs", "starts")
    # Only templates that share a band are verified, and only in texts that have one.
    shingles = F.when(F.size("hit") > 0, F.array_distinct(_runs(F.col("words"), SHINGLE)))
    rows = rows.withColumn("shingles", shingles)
    checks = []
    for i, t in enumerate(found):
        own = F.array(*[F.lit(k) for k in t["keys"]])
        whole = F.array(*[F.lit(s) for s in t["shingles"]])
        share = 100 * F.size(F.array_intersect("shingles", whole)) / len(t["shingles"])
        checks.append(
            F.when(F.arrays_overlap("hit", own), F.struct(F.lit(t["name"]).alias("name"), share.alias("percent")))
        )
    kind = "array<struct<name: string, percent: double>>"
    checked = F.array(*checks).cast(kind) if checks else F.array().cast(kind)
    licenses = F.when(F.size("hit") > 0, F.filter(checked, lambda x: x["percent"] >= percent)).otherwise(F.array().cast(kind))
    return rows.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), licenses.alias("licenses"))

"""License scan with DataFrame functions only: MinHash bands over windows, then exact containment.

A text becomes an array of five-word shingle hashes, cut into blocks of ``scale`` shingles. Two
neighbouring blocks are a window, so windows overlap by half and any segment of ``scale`` shingles
lies whole in one of them. A window's minimum under a band's hash is the least of its blocks'
minima. The number of bands is set so that a window with three quarters of a template's segment
shares a band with it with the wanted probability. Templates shorter than a segment are looked up
with windows of one shingle, where equal minima are certain. The text around a retrieved window is
then compared with the template shingle by shingle. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verigrid.llm.common import WORD

SHINGLE = 5
#: Notices to look for.
TEMPLATES: dict[str, str] = {
    "mit-line": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
}


def shingles(text: Column) -> Column:
    """Hashes of all five-word runs, in order; case and punctuation do not count."""
    bare = F.translate(F.lower(F.coalesce(text, F.lit(""))), ".,;:!?()\"'", "")
    words = F.transform(F.regexp_extract_all(bare, F.lit(f"({WORD})"), 1), lambda w: F.xxhash64(w))
    at = lambda ws, i: F.xxhash64(*[F.get(ws, i + j) for j in range(SHINGLE)])
    # the one-element array gives the words a name, so they are computed once
    return F.flatten(
        F.transform(
            F.array(words),
            lambda ws: F.when(
                F.size(ws) >= SHINGLE,
                F.transform(F.sequence(F.lit(0), F.size(ws) - SHINGLE), lambda i: at(ws, i)),
            ).otherwise(F.array().cast("array<bigint>")),
        )
    )


def band_seeds(bands: int) -> list[int]:
    """Fixed odd constants from a multiplicative sequence, as signed 64-bit numbers."""
    step = 0x9E3779B97F4A7C15
    values = [((k + 1) * step ^ (k * 0xC2B2AE3D27D4EB4F)) % 2**64 for k in range(bands)]
    return [v - 2**64 if v >= 2**63 else v for v in values]


def minima(hashes: Column, seeds: list[int]) -> Column:
    """The least value of the hashes under each band's hash."""
    bands = F.array(*[F.lit(s) for s in seeds])
    return F.transform(bands, lambda s: F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(s))))


def bands_needed(scale: int, share: float, sure: float) -> int:
    """Bands so that a window with ``share`` of a segment's shingles shares one with chance ``sure``."""
    similarity = share * scale / (3 * scale - share * scale)
    return math.ceil(math.log(1 - sure) / math.log(1 - similarity))


def groups_of(spark: SparkSession, templates: Mapping[str, str], scale: int, share: float, sure: float) -> list[dict]:
    """Short templates (windows of one shingle) and long ones (windows of two blocks), a few rows on the driver.

    A long template is cut into segments of ``scale`` shingles, the last one ending with it; each
    segment has its band values.
    """
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    known = {r["name"]: r["s"] for r in rows.select("name", shingles(F.col("text")).alias("s")).collect()}
    if bad := [n for n, s in known.items() if not s]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {bad}")
    seeds = band_seeds(bands_needed(scale, share, sure))
    short = {"scale": 1, "seeds": seeds[:1], "templates": {}, "values": {}}
    long = {"scale": scale, "seeds": seeds, "templates": {}, "values": {}}
    for name, values in known.items():
        group = short if len(values) < scale else long
        size = group["scale"]
        group["templates"][name] = list(dict.fromkeys(values))
        starts = sorted({*range(0, len(values) - size + 1, size), len(values) - size})
        segments = [values[i : i + size] for i in starts]
        group["values"][name] = [[min(v ^ s for v in part) for s in group["seeds"]] for part in segments]
    return [g for g in (short, long) if g["templates"]]


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def block_minima(group: dict) -> Column:
    """Per block of the text an array of minima, one per band."""
    scale, h = group["scale"], F.col("h")
    if scale == 1:
        return F.transform(h, lambda v: F.array(v.bitwiseXOR(F.lit(group["seeds"][0]))))
    last = F.ceil(F.size("h") / scale).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda k: minima(F.slice(h, k * scale + 1, F.lit(scale)), group["seeds"])
    )


def windows_found(group: dict, name: str, share: float) -> Column:
    """How many windows share a band with the template and stand where ``share`` of it is found."""
    scale, blocks, own = group["scale"], F.col(f"b{group['scale']}"), group["templates"][name]
    segments = [longs(values) for values in group["values"][name]]
    n = len(own)

    def retrieved(k: Column) -> Column:
        if scale == 1:
            return F.array_contains(F.array(*[F.get(s, 0) for s in segments]), F.get(F.get(blocks, k), 0))
        following = F.get(blocks, k + 1)
        bands = F.transform(F.get(blocks, k), lambda v, j: F.least(v, F.coalesce(F.get(following, j), v)))
        meets = [F.exists(F.zip_with(bands, s, lambda a, b: a == b), lambda x: x) for s in segments]
        return F.exists(F.array(*meets), lambda x: x)

    def contained(k: Column) -> Column:
        first = F.greatest(F.lit(1), k * scale + 1 - n)
        around = F.slice(F.col("h"), first, F.lit(2 * n + 2 * scale))
        return F.size(F.array_intersect(around, longs(own))) >= math.ceil(share * n)

    windows = F.filter(F.sequence(F.lit(0), F.size(blocks) - 1), retrieved)
    return F.size(F.filter(windows, contained))


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, scale: int = 8, share: float = 0.75, sure: float = 0.99
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``licenses`` (sorted names, comma-joined, empty if none), ``n_matches``.

    A template matches where a window was retrieved and the text around it, twice as long as the
    template, holds at least ``share`` of its shingles; ``n_matches`` counts (template, window) pairs. A row per document, repeated ones too; null, empty and texts
    of fewer than five words have no shingle and match nothing; other columns are ignored.
    """
    groups = groups_of(docs.sparkSession, templates, scale, share, sure)
    out = docs.select("doc_id", shingles(F.col("text")).alias("h"))
    for group in groups:
        blocks = F.when(F.size("h") > 0, block_minima(group)).otherwise(F.array().cast("array<array<bigint>>"))
        out = out.withColumn(f"b{group['scale']}", blocks)
    for group in groups:
        # a window's minimum is a block's minimum, so texts without any band value of a template are done
        every = sorted({v for parts in group["values"].values() for vs in parts for v in vs})
        out = out.withColumn(f"hit{group['scale']}", F.arrays_overlap(F.flatten(f"b{group['scale']}"), longs(every)))
    matches = []
    for group in groups:
        for name in group["templates"]:
            found = F.when(F.col(f"hit{group['scale']}"), windows_found(group, name, share)).otherwise(F.lit(0))
            matches.append(F.struct(F.lit(name).alias("name"), found.alias("n")))
    out = out.withColumn("m", F.filter(F.array(*matches), lambda x: x["n"] > 0))
    names = F.array_join(F.array_sort(F.transform("m", lambda x: x["name"])), ",")
    total = F.aggregate("m", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
    return out.select("doc_id", F.size("h").cast("bigint").alias("n_shingles"), names.alias("licenses"), total.alias("n_matches"))

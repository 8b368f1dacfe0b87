"""Licence notices by MinHash over overlapping windows, verified by containment of shingles.

For templates of m words, a text is cut into windows of m + m/2 words that begin every m/2 + 1
words, so any m words lie whole in some window. A window's minima under several hash functions,
each a band of its own, fetch the templates that share one. The number of bands follows from the lowest
similarity that a window around a match can have, so that a match is missed with MISS at most.
Templates fetched are then verified: the share of their shingles that the window holds.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Wordings of licence notices.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "MIT line": "Released under the MIT License.",
}
WORD = r"[\p{L}\p{N}_]+"
SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4


def _words(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower())


def _runs(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def key_words(templates: dict[str, str], containment: float = CONTAINMENT) -> list[str]:
    """Words of which every text that matches a template holds one.

    A match has the share ``containment`` of a template's shingles, so at least one of any that are more than
    the rest. Of these shingles, each holds one of the words. Words of seven letters or more are
    preferred, as short ones are in most texts.
    """
    runs = {n: set(_runs(_words(t))) for n, t in templates.items()}
    spare = {n: len(r) - math.ceil(containment * len(r) - 1e-9) for n, r in runs.items()}
    out: list[str] = []
    while wanting := [n for n in runs if len(runs[n]) > 0 and spare[n] >= 0]:
        cover: dict[str, int] = defaultdict(int)
        for n in wanting:
            for w in {w for s in runs[n] for w in s.split()}:
                cover[w] += min(spare[n] + 1, sum(w in s.split() for s in runs[n]))
        best = min(cover, key=lambda w: (len(w) < 7, -cover[w], -len(w), w))
        out.append(best)
        for n in wanting:
            covered = {s for s in runs[n] if best in s.split()}
            runs[n] -= covered
            spare[n] -= len(covered)
    return out


def window_plan(length: int, containment: float = CONTAINMENT) -> tuple[int, int, int]:
    """(words in a window, step, bands) for templates of so many words."""
    step = max(1, length // 2) + 1
    window = length + step - 1
    own = length - SHINGLE + 1
    shared = math.ceil(containment * own - 1e-9)
    least = shared / (own + window - SHINGLE + 1 - shared)
    return window, step, math.ceil(math.log(MISS) / math.log(1 - least)) if least < 1 else 1


def minima(hashes: Column, bands: int) -> Column:
    """A number for each band: its place and the smallest hash there."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(bands)),
        lambda i: F.xxhash64(i, F.array_min(F.transform(hashes, lambda x: F.xxhash64(i, x)))),
    )


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column computed once for each row, whatever uses it later."""
    return df.withColumn(name, F.explode(F.array(value)))


def found_licenses(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """Rows (id, license, containment, first_word): templates that a text holds, at their best window.

    One row for each row of ``df`` and each template with a window that holds at least the share
    ``containment`` of its distinct shingles of five words; of windows alike the first. A null, empty or
    short text has none. Rows that repeat are judged each by itself, null ids too. An empty table gives no
    rows. Templates need five words. Work on a text grows with its length; rows are not regrouped, but
    for the few windows found.
    """
    spark = df.sparkSession
    known = spark.createDataFrame([(n, " ".join(_words(t)), len(_words(t))) for n, t in sorted(templates.items())], "license string, words string, length int")
    hashed = F.transform(F.sequence(F.lit(1), F.col("length") - SHINGLE + 1), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(F.split("words", " "), i, SHINGLE))))
    known = known.withColumn("hashes", F.array_distinct(hashed))
    plans = {n: window_plan(n, containment) for n in sorted({len(_words(t)) for t in templates.values()})}
    signed = [known.where(F.col("length") == n).withColumn("bands", minima(F.col("hashes"), b)) for n, (_, _, b) in plans.items()]
    by_length: dict[int, list] = defaultdict(list)
    for part in signed:  # one row for each template
        for r in part.collect():
            by_length[r["length"]].append(r)

    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    lower = F.lower("text")
    hit = F.lit(False)
    for word in key_words(templates, containment):
        hit = hit | F.contains(lower, F.lit(word))
    rows = _once(rows.where(hit), "words", F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0)).drop("text").where(F.size("words") >= SHINGLE)
    shingle = F.transform(F.sequence(F.lit(1), F.size("words") - SHINGLE + 1), lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i, SHINGLE))))
    rows = _once(rows, "hashes", shingle).drop("words")

    def windows(length: int) -> Column:
        window, step, _ = plans[length]
        starts = F.sequence(F.lit(1), F.size("hashes"), F.lit(step))
        return F.transform(starts, lambda s: F.struct(F.lit(length).alias("length"), s.alias("start"), F.slice("hashes", s, window - SHINGLE + 1).alias("part")))

    cut = rows.select("id", "row", F.explode(F.flatten(F.array(*map(windows, plans)))).alias("w"))

    def fetched(length: int) -> Column:
        bands = minima(F.col("w.part"), plans[length][2])
        each = [
            F.struct(F.lit(r["license"]).alias("license"), F.array(*map(F.lit, r["bands"])).alias("bands"), F.array(*map(F.lit, r["hashes"])).alias("hashes"))
            for r in by_length[length]
        ]
        return F.filter(F.array(*each), lambda t: F.arrays_overlap(t["bands"], bands))

    choice = None
    for n in plans:
        choice = F.when(F.col("w.length") == n, fetched(n)) if choice is None else choice.when(F.col("w.length") == n, fetched(n))
    candidates = cut.select("id", "row", F.col("w.start").alias("start"), F.col("w.part").alias("part"), F.explode(choice).alias("t"))
    share = F.size(F.array_intersect("t.hashes", "part")) / F.size("t.hashes")
    held = candidates.select("id", "row", F.col("t.license").alias("license"), share.alias("containment"), (F.col("start") - 1).alias("at"))
    best = held.where(F.col("containment") >= containment).groupBy("row", "id", "license")
    best = best.agg(F.max(F.struct("containment", (-F.col("at")).alias("back"))).alias("best"))
    return best.select(
        F.col("id").alias(id_column), "license", F.col("best.containment").alias("containment"), (-F.col("best.back")).cast("long").alias("first_word")
    )

"""License notices found by MinHash bands over windows of the text, in built-in expressions only.

Texts are lower-cased and cut into runs of letters and digits. Templates are cut
into pieces of ``PIECE`` words, texts into windows of ``WINDOW`` words, two words
apart, so every piece that stands in a text lies whole in a window and makes at
least a quarter of the window's 5-word shingles. ``BANDS`` bands of one MinHash
value each then miss it with probability 0.75 ** 48, one in a million, for the
shortest piece, and practically never for others. Retrieved templates are
verified: the share of a template's shingles that the text holds.

An exact screen stands before: every 5-word run of every template contains one
of a few pairs of neighbouring words, so texts, and windows, without any of
those cannot share a shingle with a template. Only windows around such pairs
are formed.

Rows: a null or empty text holds no template. Repeated rows are scanned each
and give equal rows. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a shingle, a template piece and a window; windows start every second word.
SHINGLE, PIECE, WINDOW, STRIDE = 5, 7, 8, 2
BANDS = 48
#: Letters of the longer word from which a pair is preferred for the screen.
LONG_WORD = 7
#: Share of a template's shingles that a text must hold, in percent.
PERCENT = 80

#: Notices of well-known licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_WORDS = "filter(split(regexp_replace(lower({text}), '[^a-z0-9]+', ' '), ' '), x -> x <> '')"
_SHINGLES = f"CASE WHEN size({{words}}) < {SHINGLE} THEN array() ELSE transform(sequence(1, size({{words}}) - {SHINGLE - 1}), i -> concat_ws(' ', slice({{words}}, i, {SHINGLE}))) END"


def words_of(text: str) -> str:
    return _WORDS.format(text=text)


def shingles_of(words: str) -> str:
    """The shingles; the words are bound once."""
    return f"aggregate(array({words}), CAST(array() AS ARRAY<STRING>), (z, w) -> {_SHINGLES.format(words='w')})"


def band_keys(shingles: str) -> str:
    """One MinHash value for each band, the band's number mixed in."""
    return (
        f"aggregate(array({shingles}), CAST(array() AS ARRAY<LONG>), (z, s) -> transform(sequence(1, {BANDS}), "
        "b -> xxhash64(b, array_min(transform(s, x -> xxhash64(x, b))))))"
    )


def plain(text: str) -> list[str]:
    return "".join(c if "a" <= c <= "z" or "0" <= c <= "9" else " " for c in text.lower()).split()


def screen_pairs(templates: tuple[tuple[str, str], ...]) -> list[str]:
    """Pairs of neighbouring words of which every 5-word run of the templates contains one; chosen greedily, pairs with a long word first."""
    pairs = lambda words: {f"{x} {y}" for x, y in zip(words, words[1:])}
    runs = [pairs(w[i : i + SHINGLE]) for _, t in templates for w in [plain(t)] for i in range(len(w) - SHINGLE + 1)]
    chosen: list[str] = []
    while runs:
        longest = lambda pair: max(map(len, pair.split(" ")))
        best = max({p for r in runs for p in r}, key=lambda p: (sum(p in r for r in runs) * (longest(p) >= LONG_WORD), longest(p), p))
        chosen.append(best)
        runs = [r for r in runs if best not in r]
    return chosen


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, license, matched, shingles): the templates each row holds, by license the one with the largest share."""
    spark = docs.sparkSession
    screen = screen_pairs(templates)
    listing = [F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(" ".join(plain(t))).alias("body")) for i, (name, t) in enumerate(templates)]
    known = spark.range(0, 1, 1, 1).select(F.inline(F.array(*listing)))
    known = known.withColumn("words", F.expr("split(body, ' ')")).withColumn("all", F.expr(f"array_distinct({shingles_of('words')})"))
    pieces = known.select(
        "template", "license", "all",
        F.explode(F.expr(f"transform(sequence(1, greatest(1, size(words) - {PIECE - 1})), i -> slice(words, i, {PIECE}))")).alias("piece"),
    )
    keys = pieces.select("template", "license", "all", F.explode(F.expr(band_keys(shingles_of("piece")))).alias("key")).dropDuplicates(["template", "key"])
    listed, firsts = (", ".join(f"'{x}'" for x in xs) for xs in (screen, sorted({p.split(" ")[0] for p in screen})))
    shown = " OR ".join(f"contains(low, '{w}')" for w in sorted({max(p.split(" "), key=len) for p in screen}))
    at = f"filter(sequence(1, size(w) - 1), i -> element_at(w, i) IN ({firsts}) AND concat_ws(' ', element_at(w, i), element_at(w, i + 1)) IN ({listed}))"
    starts = f"array_distinct(flatten(transform({at}, i -> filter(sequence(greatest(1, i - {WINDOW - 2}), i), s -> s % {STRIDE} = 1))))"
    windows = f"filter(transform({starts}, s -> slice(w, s, {WINDOW})), x -> size(x) >= {SHINGLE})"
    # The words are bound by the aggregate, and no filter passes the row number: else the optimizer would cut a text anew for each word.
    rows = (
        docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.coalesce(text, F.lit(""))).alias("low"))
        .filter(shown)
        .withColumn("windows", F.expr(f"aggregate(array({words_of('low')}), CAST(array() AS ARRAY<ARRAY<STRING>>), (z, w) -> CASE WHEN size(w) >= {SHINGLE} THEN {windows} ELSE z END)"))
        .select("doc_id", "windows", F.monotonically_increasing_id().alias("row"))
    )
    runs = sorted({" ".join(w[i : i + SHINGLE]) for _, t in templates for w in [plain(t)] for i in range(len(w) - SHINGLE + 1)})
    in_templates = ", ".join(f"'{r}'" for r in runs)
    # A template's shingle holds a screen pair, so it stands in a text if it stands in one of these windows.
    here = f"flatten(transform(windows, w -> {_SHINGLES.format(words='w')}))"
    near = rows.select("doc_id", "row", F.expr(f"array_intersect(array({in_templates}), {here})").alias("held"), F.explode("windows").alias("window"))
    found = near.select("doc_id", "row", "held", F.explode(F.expr(band_keys(shingles_of("window")))).alias("key")).join(F.broadcast(keys), "key")
    verified = (
        found.withColumn("matched", F.expr("CAST(size(array_intersect(`all`, held)) AS LONG)"))
        .withColumn("shingles", F.expr("CAST(size(`all`) AS LONG)"))
        .filter(f"100 * matched >= {percent} * shingles")
    )
    best = verified.groupBy("row", "doc_id", "license").agg(F.expr("max(struct(matched / shingles AS share, shingles, matched))").alias("b"))
    return best.select("doc_id", "license", F.col("b.matched").alias("matched"), F.col("b.shingles").alias("shingles"))


def oracle_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, percent: int = PERCENT) -> str:
    """Exact containment of all templates in all texts."""
    rows = ", ".join(f"({i}, '{name}', '{' '.join(plain(t))}')" for i, (name, t) in enumerate(templates))
    return f"""
WITH t AS (SELECT template, license, string_split(body, ' ') AS words FROM (VALUES {rows}) AS v(template, license, body)),
ts AS (
  SELECT DISTINCT template, license, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM t)),
n AS (SELECT template, license, count(*) AS shingles FROM ts GROUP BY ALL),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS words FROM documents),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM d)),
m AS (SELECT doc_id, template, license, count(*) AS matched FROM ds JOIN ts USING (s) GROUP BY ALL),
f AS (
  SELECT doc_id, license, matched, shingles,
         row_number() OVER (PARTITION BY doc_id, license ORDER BY matched / shingles DESC, shingles DESC, matched DESC) AS r
  FROM m JOIN n USING (template, license) WHERE 100 * matched >= {percent} * shingles)
SELECT doc_id, license, matched, shingles FROM f WHERE r = 1"""

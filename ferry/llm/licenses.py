"""Licence scans through a positional index of rare licence words."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import free_name, quoted, words


class Template(NamedTuple):
    label: str
    text: str
    phrase: str  # mandatory; a part of the text


# The base phrases, then notices of widely used licences.
BASE = (
    Template("cc-by", "cc by", "cc by"),
    Template("gpl", "general public license", "general public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
)
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
# Part of a notice's weight that must stand around its phrase.
COVERAGE = 0.6


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def weights(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[str, float]:
    """IDF of the licence words over all documents; one number per licence word."""
    vocab = vocabulary(templates)
    found = docs.select(
        F.array_intersect(words(quoted(text)), F.array(*map(F.lit, vocab))).alias("w")
    )
    counted = found.select(F.explode(F.array_append("w", F.lit(""))).alias("w")).groupBy("w").count()
    seen = {r["w"]: r["count"] for r in counted.collect()}
    total = seen.get("", 0)
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) + 1 for w in vocab}


def _anchors(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The two rarest different words of the phrase, with their places in it."""
    places: dict[str, int] = {}
    for i, w in enumerate(template.phrase.split()):
        places.setdefault(w, i)
    return sorted(places.items(), key=lambda x: (-idf[x[0]], x[0]))[:2]


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _places(template: Template, anchors: list[tuple[str, int]], hits: Column, tokens: Column) -> Column:
    """Where the phrase starts: places on which both anchors agree, then verified."""
    phrase = template.phrase.split()

    def starts(word: str, offset: int) -> Column:
        own = F.filter(hits, lambda h: h["w"] == word)
        return F.transform(own, lambda h: h["i"] - offset)

    agreed = starts(*anchors[0])
    for anchor in anchors[1:]:
        agreed = F.array_intersect(agreed, starts(*anchor))
    return F.filter(
        F.array_distinct(agreed),
        lambda p: (p >= 0) & (F.slice(tokens, F.greatest(p, F.lit(0)) + 1, len(phrase)) == _strings(phrase)),
    )


def _coverage(template: Template, idf: dict[str, float], places: Column, tokens: Column) -> Column:
    """Largest weight of template words found at their place, as a part of all."""
    text, phrase = template.text.split(), template.phrase.split()
    before = next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)
    total = sum(idf[w] for w in text)

    def at(p: Column) -> Column:
        found = F.lit(0.0)
        for i, w in enumerate(text):
            here = p + (i - before)
            found = found + F.when(
                F.get(tokens, here) == w, F.lit(idf[w] / total)
            ).otherwise(0.0)
        return found

    return F.coalesce(F.array_max(F.transform(places, at)), F.lit(0.0))


def scan(
    docs: DataFrame,
    notices: tuple[Template, ...] = NOTICES,
    id_column: str = "doc_id",
    text_column: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document: what licence phrases it holds, and where.

    n_base counts all places of base phrases, first_word and last_word are the
    smallest and largest of them. base_labels has the labels of base phrases,
    labels also those of notices whose mandatory phrase stands in the text and
    whose words around it make up ``coverage`` of the notice's weight. score is the largest
    coverage of a labelled template: 1 where a base phrase stands.

    Null text is empty text: no words, no labels, score 0. Repeated ids and rows
    give a row each. An empty table gives an empty result.
    """
    templates = (*BASE, *notices)
    idf = weights(docs, templates, text_column)
    anchors = [_anchors(t, idf) for t in templates]
    first = sorted({a[0][0] for a in anchors})
    wanted = sorted({w for a in anchors for w, _ in a})
    tokens = F.col("tokens")
    rows = docs.select(quoted(id_column).alias("doc_id"), words(quoted(text_column)).alias("tokens"))
    # Only texts with the rarest word of some phrase are looked at by place.
    hits = F.when(
        F.arrays_overlap(tokens, _strings(first)),
        F.filter(
            F.transform(tokens, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
            lambda h: h["w"].isin(wanted),
        ),
    )
    rows = rows.withColumn("hits", hits)
    none = F.array().cast("array<int>")
    for k, t in enumerate(templates):
        found = F.when(F.col("hits").isNotNull(), _places(t, anchors[k], F.col("hits"), tokens))
        rows = rows.withColumn(f"p{k}", F.coalesce(found, none))
    covers = [_coverage(t, idf, F.col(f"p{k}"), tokens) for k, t in enumerate(templates)]
    rows = rows.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_words"),
        F.concat(*[F.col(f"p{k}") for k in range(len(BASE))]).alias("base"),
        F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(t.label)) for k, t in enumerate(BASE)]).alias("base_labels"),
        F.array(
            *[F.struct(c.alias("cover"), F.lit(t.label).alias("label")) for c, t in zip(covers, templates, strict=True)]
        ).alias("covers"),
    )
    rows = rows.withColumn("covers", F.filter("covers", lambda c: c["cover"] >= coverage))
    names = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(c))))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        names(F.col("base_labels")).alias("base_labels"),
        names(F.col("covers.label")).alias("labels"),
        F.round(F.least(F.coalesce(F.array_max("covers.cover"), F.lit(0.0)), F.lit(1.0)), 6).alias("score"),
    )


def label(docs: DataFrame, text_column: str = "text", name: str = "licenses") -> DataFrame:
    """``docs`` with the base labels of each row in a column of its own."""
    tokens = words(quoted(text_column))
    joined = F.concat(F.lit(" "), F.concat_ws(" ", tokens), F.lit(" "))
    found = F.array(*[F.when(joined.contains(f" {t.phrase} "), F.lit(t.label)) for t in BASE])
    return docs.withColumn(free_name(docs, name), F.concat_ws(",", F.array_compact(found)))

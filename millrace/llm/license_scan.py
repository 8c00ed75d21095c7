"""License scan by a positional rare-token index, as DataFrame operations only.

Templates are short licence notices. Each posts its rarest words with their positions, rare by document
frequency over all rows of the corpus. In a document every place of such a word proposes where its
templates would begin; a template's score at a beginning is the share of its rare words, weighed by IDF,
that stand at their positions there. From ``share`` up, and where all key phrases of the template stand
at their positions word for word, the template's label holds.

Next to that stand the base places: each place where the words of a base phrase follow one another.

Texts are lower-cased A-Z and split into words of ASCII letters and digits and all beyond ASCII. A null or
empty text has no words, no places and empty labels. Repeated rows each get a row. A very long text takes time
in proportion to its words, also where all of them are licence words. Other columns are not read. An empty table gives no rows. Templates are a parameter; their size bounds the literals.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import NOT_WORD, lower_ascii, settled, words


@dataclass(frozen=True)
class Template:
    """``notice``: the words looked for. ``phrases``: parts of it that must stand word for word."""

    label: str
    notice: str
    phrases: tuple[str, ...]


#: Common licence notices.
TEMPLATES = (
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("gpl", "licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("affero general public license",)),
    Template("mpl", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc0", "dedicated to the public domain under CC0 1.0 Universal", ("cc0 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

#: Base phrases and their labels; each ends in the same word.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Scan:
    """``rare``: words a template posts. ``share``: of their weight that must stand in place."""

    templates: Sequence[Template] = TEMPLATES
    rare: int = 5
    share: float = 0.6


def _split(text: str) -> list[str]:
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return [w for w in re.split(NOT_WORD, lowered) if w]


def with_words(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``words`` of each row."""
    listed = words(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), NOT_WORD)
    return docs.select("doc_id", settled(listed).alias("words"))


def weights(docs: DataFrame, how: Scan) -> dict[str, float]:
    """IDF of each template word over all rows; as many numbers as the templates have words."""
    vocabulary = sorted({w for t in how.templates for w in _split(t.notice)})
    met = with_words(docs).select(F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary))).alias("met"))
    counted = met.select(F.explode_outer("met").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    by_word = {r["word"]: r["n"] for r in counted if r["word"] is not None}
    # Rows of the exploded table are at least the documents; the constant only scales all weights.
    total = sum(r["n"] for r in counted)
    return {w: math.log((total + 1) / (by_word.get(w, 0) + 0.5)) for w in vocabulary}


def _index(how: Scan, idf: dict[str, float]) -> list[dict]:
    found = []
    for template in how.templates:
        listed = _split(template.notice)
        rare = sorted(set(listed), key=lambda w: (-idf[w], w))[: how.rare]
        places = [(w, i) for i, w in enumerate(listed) if w in rare]
        total = sum(idf[w] for w, _ in places)
        phrases = []
        for phrase in map(_split, template.phrases):
            at = next(i for i in range(len(listed)) if listed[i : i + len(phrase)] == phrase)
            phrases.append((at, phrase))
        found.append(
            {"label": template.label, "places": [(w, i, idf[w] / total) for w, i in places], "phrases": phrases}
        )
    return found


def _literals(index: list[dict]) -> tuple[Column, Column]:
    """The templates, and all postings of rare words."""
    lit = F.lit
    templates = F.array(
        *[
            F.struct(
                lit(t["label"]).alias("label"),
                F.array(
                    *[F.struct(lit(w).alias("word"), lit(i).alias("at"), lit(x).alias("weight")) for w, i, x in t["places"]]
                ).alias("places"),
                F.array(
                    *[F.struct(lit(i).alias("at"), F.array(*map(lit, p)).alias("words")) for i, p in t["phrases"]]
                ).alias("phrases"),
            )
            for t in index
        ]
    )
    postings = F.array(
        *[
            F.struct(lit(w).alias("word"), lit(k).alias("template"), lit(i).alias("at"))
            for k, t in enumerate(index)
            for w, i, _ in t["places"]
        ]
    )
    return templates, postings


def _at(i: Column) -> Column:
    return F.get("words", i)


def _base_places(hits: Column) -> Column:
    """Start and label of each base phrase; ``hits`` holds every place of its last word."""

    def places(phrase: list[str], label: str) -> Column:
        before = len(phrase) - 1

        def stands(i: Column) -> Column:
            same = F.lit(True)
            for k, word in enumerate(phrase):
                same = same & F.coalesce(_at(i - before + k) == word, F.lit(False))
            return same

        return F.transform(
            F.filter(hits, stands), lambda i: F.struct((i - before).alias("start"), F.lit(label).alias("label"))
        )

    return F.concat(*[places(phrase.split(), label) for phrase, label in BASE.items()])


def _coded(template: Column, start: Column) -> Column:
    """A template and where it would begin as one number; the place may be before the text."""
    return F.shiftleft(template.cast("bigint"), 33) + start.cast("bigint") + F.lit(1 << 32)


def _decoded(code: Column) -> Column:
    template = F.shiftright(code, 33)
    start = code - F.shiftleft(template, 33) - F.lit(1 << 32)
    return F.struct(template.cast("int").alias("template"), start.cast("int").alias("start"))


def scan(docs: DataFrame, how: Scan = Scan()) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` and ``score``, the largest share of a template that holds (0 where none does)."""
    index = _index(how, weights(docs, how))
    templates, postings = _literals(index)
    wanted = sorted({w for t in index for w, _, _ in t["places"]} | {p.split()[-1] for p in BASE})
    df = with_words(docs)
    marked = F.transform("words", lambda w, i: F.when(w.isin(wanted), i))
    df = df.withColumn("_hits", F.filter(marked, lambda i: i.isNotNull()))
    df = df.withColumn("_base", _base_places(F.col("_hits")))
    starts = F.flatten(
        F.transform(
            "_hits",
            lambda i: F.transform(
                F.filter(postings, lambda p: p["word"] == _at(i)),
                lambda p: _coded(p["template"], i - p["at"]),
            ),
        )
    )
    # Numbers are made distinct by a hash set, structs by comparing all pairs.
    df = df.withColumn("_starts", F.transform(F.array_distinct(starts), _decoded))

    def weighed(s: Column) -> Column:
        places = F.get(templates, s["template"])["places"]
        stands = lambda total, a: total + F.when(_at(s["start"] + a["at"]) == a["word"], a["weight"]).otherwise(0.0)
        return F.struct(s["template"].alias("template"), s["start"].alias("start"), F.aggregate(places, F.lit(0.0), stands).alias("share"))

    def holds(s: Column) -> Column:
        phrases = F.get(templates, s["template"])["phrases"]

        def stands(phrase: Column) -> Column:
            start = s["start"] + phrase["at"]
            return F.when(
                start >= 0, F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size(phrase["words"])) == phrase["words"]
            ).otherwise(F.lit(False))

        return (s["share"] >= how.share) & F.forall(phrases, stands)

    df = df.withColumn("_found", F.filter(F.transform("_starts", weighed), holds))
    base_labels = F.array_distinct(F.transform("_base", lambda b: b["label"]))
    own = F.transform("_found", lambda s: F.get(templates, s["template"])["label"])
    listed = lambda labels: F.array_join(F.sort_array(labels), ",")
    return df.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("_base", lambda b: b["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("_base", lambda b: b["start"])).cast("bigint").alias("last_word"),
        listed(base_labels).alias("base_labels"),
        listed(F.array_distinct(F.concat(base_labels, own))).alias("labels"),
        F.least(F.coalesce(F.array_max(F.transform("_found", lambda s: s["share"])), F.lit(0.0)), F.lit(1.0)).alias("score"),
    )

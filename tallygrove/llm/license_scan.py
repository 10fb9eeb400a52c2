"""Licence scans with a positional index of rare words, in DataFrame functions only.

Templates are short word sequences that name a licence. The words of all templates are counted over
all documents; the rarest ones of a template (highest inverse document frequency) are its anchors. The
index maps an anchor to the templates and the places it has in them. In a text only words of the index
are looked up: each gives a template and the place where that template would begin. Where every anchor
of a template points to the same beginning, the template's key phrases are compared word by word, and
the share of its other words that agree is the score. So nothing is joined or shuffled but the counts
of template words, and a text without an anchor is left after one lookup.

The template texts, of fixed number and length, bound the index; anchors are only a filter, so labels
do not depend on which words are rare. Words are maximal runs of a-z, 0-9 and characters beyond ASCII
after lower-casing A-Z. A null text has no words. Repeated rows are scanned each; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.tables import free_name

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence's label, its words, and the stretches (begin, end) of them that must all agree."""

    label: str
    text: str
    keys: tuple[tuple[int, int], ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


def _phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, ((0, len(text.split())),), base)


# The phrases that the result's base columns are about, and further licences.
BASE = (
    _phrase("mit", "under the mit license", True),
    _phrase("apache-2", "apache license version 2", True),
    _phrase("cc-by-nc", "cc by nc", True),
)
MORE = (
    _phrase("gpl-3", "gnu general public license version 3"),
    _phrase("gpl-2", "gnu general public license version 2"),
    _phrase("lgpl", "gnu lesser general public license"),
    _phrase("agpl-3", "gnu affero general public license"),
    _phrase("mpl-2", "mozilla public license version 2"),
    _phrase("cc-by-sa", "cc by sa"),
    _phrase("cc0", "cc0 1 0 universal"),
    _phrase("unlicense", "free and unencumbered software released into the public domain"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
        ((0, 7), (17, 20)),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ((0, 8), (12, 14)),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        ((0, 4), (13, 20)),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except "
        "in compliance with the license",
        ((3, 7), (10, 14)),
    ),
)
TEMPLATES = BASE + MORE


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), 0)


def rarity(documents: DataFrame, templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency of each template word, over all documents."""
    vocabulary = sorted({w for t in templates for w in t.words})
    listed = F.array(*(F.lit(w) for w in vocabulary))
    own = F.array_intersect(listed, words(F.col("text")))
    # At most as many rows as the templates have words, and one for the number of documents.
    counted = documents.select(F.explode(F.concat(F.array(F.lit("")), own)).alias("word"))
    counts = {r["word"]: r["count"] for r in counted.groupBy("word").count().collect()}
    n = counts.get("", 0)
    return {w: math.log((n + 1) / (counts.get(w, 0) + 0.5)) for w in vocabulary}


def anchors(template: Template, idf: dict[str, float], most: int) -> list[int]:
    """Places of the template's rarest key words."""
    keyed = [i for begin, end in template.keys for i in range(begin, end)]
    return sorted(sorted(keyed, key=lambda i: (-idf[template.words[i]], i))[:most])


def scanned(
    documents: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    least: float = 0.8,
    n_anchors: int = 2,
    into: str = "_licence",
) -> DataFrame:
    """All columns and a struct with the contract's counts, labels and score."""
    idf = rarity(documents, templates)
    places: dict[str, list[tuple[int, int]]] = {}
    needs = []
    for number, template in enumerate(templates):
        own = anchors(template, idf, n_anchors)
        needs.append(len(own))
        for i in own:
            places.setdefault(template.words[i], []).append((number, i))
    index = F.create_map(
        *(
            x
            for word, found in sorted(places.items())
            for x in (
                F.lit(word),
                F.array(*(F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in found)),
            )
        )
    )
    rare = F.array(*(F.lit(w) for w in sorted(places)))
    needed = F.array(*(F.lit(n) for n in needs))
    span = F.lit(1 << 40)
    # Working columns under names that the table does not have.
    words_name, codes_name, found_name, base_name = (
        free_name(name, documents.columns) for name in ("_words", "_codes", "_found", "_base")
    )
    own = F.col(words_name)

    # Code of a template and its beginning; beginnings may lie before the text and are shifted.
    def codes(word: Column, at: Column) -> Column:
        return F.transform(
            F.try_element_at(index, word),
            lambda p: p["t"].cast("long") * span + (at - p["i"]).cast("long") + F.lit(1 << 20),
        )

    hits = F.flatten(
        F.filter(F.transform(own, codes), lambda found: found.isNotNull())
    )
    ordered = F.sort_array(F.when(F.arrays_overlap(own, rare), hits).otherwise(F.array().cast("array<long>")))

    # As many equal codes in a row as the template has anchors: they all point to one beginning.
    def agrees(code: Column, at: Column) -> Column:
        need = F.get(needed, F.shiftright(code, 40).cast("int"))
        return F.get(F.col(codes_name), at + need - 1) == code

    begins = F.array_distinct(F.filter(F.col(codes_name), agrees))
    starts = F.transform(
        begins,
        lambda code: F.struct(
            F.shiftright(code, 40).cast("int").alias("t"),
            (code.bitwiseAND(span - 1) - F.lit(1 << 20)).cast("int").alias("at"),
        ),
    )

    def word_at(at: Column, i: int) -> Column:
        return F.get(own, at + i)

    def verified(start: Column) -> Column:
        at = start["at"]
        best = F.lit(None).cast("double")
        for number, template in reversed(list(enumerate(templates))):
            keyed = {i for begin, end in template.keys for i in range(begin, end)}
            key_words = [word_at(at, i) == F.lit(template.words[i]) for i in sorted(keyed)]
            all_keys = reduce(lambda a, b: a & b, key_words)
            other = [
                F.when(word_at(at, i) == F.lit(w), 1.0).otherwise(0.0)
                for i, w in enumerate(template.words)
                if i not in keyed
            ]
            share = (reduce(lambda a, b: a + b, other, F.lit(float(len(keyed))))) / F.lit(
                float(len(template.words))
            )
            best = F.when(
                start["t"] == number, F.when(all_keys & (share >= least), share)
            ).otherwise(best)
        return best

    names = F.array(*(F.lit(t.label) for t in templates))
    is_base = F.array(*(F.lit(t.base) for t in templates))
    sizes = F.array(*(F.lit(len(t.words)) for t in templates))
    found = F.filter(
        F.transform(
            starts,
            lambda s: F.struct(
                F.get(names, s["t"]).alias("label"),
                F.get(is_base, s["t"]).alias("base"),
                s["at"].alias("at"),
                F.get(sizes, s["t"]).alias("size"),
                verified(s).alias("score"),
            ),
        ),
        lambda f: f["score"].isNotNull(),
    )
    base = F.filter(found_name, lambda f: f["base"])

    def listed(hits_: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits_, lambda f: f["label"]))), ",")

    base_at = F.transform(base_name, lambda f: f["at"].cast("long"))
    result = F.struct(
        F.size(words_name).cast("long").alias("n_words"),
        F.size(base_name).cast("long").alias("n_base"),
        F.array_min(base_at).alias("first_word"),
        F.array_max(base_at).alias("last_word"),
        listed(F.col(base_name)).alias("base_labels"),
        listed(F.col(found_name)).alias("labels"),
        F.coalesce(F.array_max(F.transform(found_name, lambda f: f["score"])), F.lit(0.0)).alias("score"),
        F.transform(found_name, lambda f: F.struct(f["label"], f["at"], f["size"])).alias("spans"),
    )
    return (
        documents.withColumn(words_name, words(F.col("text")))
        .withColumn(codes_name, ordered)
        .withColumn(found_name, found)
        .withColumn(base_name, base)
        .select(*(F.col(f"`{c}`") for c in documents.columns), result.alias(into))
    )

"""Licence scan by a positional index of rare licence words.

Each template is a licence's telling sentence with mandatory key phrases. One pass over the
texts keeps, for each document, where words of the key phrases stand. From that much smaller
table follows in how many documents each word occurs; the rarest word of a key phrase (its
highest inverse document frequency) is the phrase's anchor. An anchor's place and its posting
(its position within the template) say where the template would have to start, the key
phrase is verified word by word around it, and a template counts where all its key phrases
call for the same start, a few words of drift allowed. Everything is a column expression: no
shuffle but the count of words, no Python on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import stored

#: Characters between words: ASCII but small letters and digits.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SLACK = 3

# Phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# Opening sentences of public licences and the phrases that must be found.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("hereby granted free", "person obtaining"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("binary forms", "without modification"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        ("free software", "gnu general public license"),
    ),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template(
        "mpl-2.0",
        "subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template(
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee",
        ("use copy modify", "without fee"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released", "public domain"),
    ),
)


def licence_words(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    """Words of all key phrases: the index's vocabulary, bounded by the templates."""
    phrases = [p for t in templates for p in t.phrases] + list(BASE)
    return sorted({w for p in phrases for w in p.split()})


def word_places(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> DataFrame:
    """Adds ``n_words`` and ``places``: position ``i`` and word ``w`` of each word of the vocabulary."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if any("k" in w for w in vocabulary):
        text = F.replace(text, F.lit("\u212a"), F.lit("\u00b0"))  # the one letter beyond ASCII whose lower case is within
    rows = docs.withColumn("__w", F.split(F.lower(text), GAP, -1))
    lead = F.when(F.get("__w", F.lit(0)) == "", 1).otherwise(0)
    trail = F.when(F.get("__w", F.size("__w") - 1) == "", 1).otherwise(0)
    at = F.filter(F.sequence(F.lit(0), F.size("__w") - 1), lambda i: F.get(F.col("__w"), i).isin(vocabulary))
    kept = F.transform(at, lambda i: F.struct((i - lead).alias("i"), F.get(F.col("__w"), i).alias("w")))
    return rows.withColumns(
        {"n_words": F.greatest(F.size("__w") - lead - trail, F.lit(0)).cast("bigint"), "places": kept}
    ).drop("__w")


def document_frequency(placed: DataFrame) -> dict[str, int]:
    """In how many documents each word of the bounded vocabulary occurs; "" maps to all documents."""
    words = F.array_append(F.array_distinct(F.transform("places", lambda x: x.w)), F.lit(""))
    return {r["w"]: r["count"] for r in placed.select(F.explode(words).alias("w")).groupBy("w").count().collect()}


def _starts(phrase: list[str], anchor: int) -> Column:
    """Where a phrase stands in full: its neighbours in the index are looked up from its anchor word."""

    def stands(x: Column, k: Column) -> Column:
        tests = [x.w == phrase[anchor]]
        for j, word in enumerate(phrase):
            if j != anchor:
                other = F.get(F.col("places"), k + F.lit(j - anchor))
                tests += [F.coalesce(other.w == word, F.lit(False)), other.i == x.i + F.lit(j - anchor)]
        return reduce(Column.__and__, tests)

    return F.transform(F.filter("places", stands), lambda x: x.i - F.lit(anchor))


def _earlier(words: int) -> Callable[[Column], Column]:
    return lambda i: i - F.lit(words)


def _agreement(others: list[str], slack: int) -> Callable[[Column], Column]:
    """Whether each other key phrase calls for nearly the same start."""

    def agreed(start: Column) -> Column:
        tests = (F.exists(o, lambda e: F.abs(e - start) <= slack) for o in others)
        return reduce(Column.__and__, tests, F.lit(True))

    return agreed


def _share(template: Template, idf: dict[str, float]) -> Callable[[Column], Column]:
    """Share of a template's inverse document frequency that stands in place."""
    weighed = [(j, w, idf[w]) for j, w in enumerate(template.text.split()) if w in idf]

    def share(start: Column) -> Column:
        stands = (F.exists("places", _is(start, j, w)) for j, w, _ in weighed)
        found = (F.when(test, F.lit(x)).otherwise(F.lit(0.0)) for test, (_, _, x) in zip(stands, weighed, strict=True))
        return reduce(Column.__add__, found) / F.lit(sum(x for _, _, x in weighed))

    return share


def _is(start: Column, offset: int, word: str) -> Callable[[Column], Column]:
    return lambda x: (x.i == start + F.lit(offset)) & (x.w == word)


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    slack: int = SLACK,
) -> DataFrame:
    """Licences named in each document.

    Returns ``doc_id``, ``n_words``, ``n_base`` (places of the base phrases), ``first_word``
    and ``last_word`` (the smallest and largest start among them, else null),
    ``base_labels``, ``labels`` (base and template labels; distinct, sorted, comma-joined,
    empty if there are none) and ``score``: 1 with a base phrase, else the share of the
    template's inverse document frequency found in place, 0 without a label. A null or empty
    text has no words; repeated rows and ties give one row each; other columns are not read.
    """
    vocabulary = licence_words(templates)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    rows = stored(word_places(rows, vocabulary, "__text").drop("__text"), "licences")
    counts = document_frequency(rows)
    total = counts.get("", 0)
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1e-3 for w in vocabulary}

    def rarest(words: list[str]) -> int:
        return max(range(len(words)), key=lambda j: (idf[words[j]], -j))

    base = [p.split() for p in BASE]
    rows = rows.withColumns({f"__b{n}": _starts(p, rarest(p)) for n, p in enumerate(base)})
    starts: dict[str, Column] = {}
    for n, t in enumerate(templates):
        words = t.text.split()
        for m, phrase in enumerate(t.phrases):
            p = phrase.split()
            within = next(i for i in range(len(words)) if words[i : i + len(p)] == p)
            starts[f"__t{n}_{m}"] = F.transform(_starts(p, rarest(p)), _earlier(within))
    rows = rows.withColumns(starts)

    shares, labels = [], [F.when(F.size(f"__b{n}") > 0, F.lit(x)) for n, x in enumerate(BASE.values())]
    found_base = list(labels)
    for n, t in enumerate(templates):
        others = [f"__t{n}_{m}" for m in range(1, len(t.phrases))]

        kept = F.filter(f"__t{n}_0", _agreement(others, slack))
        labels.append(F.when(F.size(kept) > 0, F.lit(t.label)))
        shares.append(F.array_max(F.transform(kept, _share(t, idf))))
    base_places = F.concat(*(F.col(f"__b{n}") for n in range(len(base))))

    def joined(of: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*of)))), ",")

    n_base = F.size(base_places)
    return rows.select(
        "doc_id",
        "n_words",
        n_base.cast("bigint").alias("n_base"),
        F.array_min(base_places).cast("bigint").alias("first_word"),
        F.array_max(base_places).cast("bigint").alias("last_word"),
        joined(found_base).alias("base_labels"),
        joined(labels).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.greatest(*shares), F.lit(0.0)))).alias("score"),
    )

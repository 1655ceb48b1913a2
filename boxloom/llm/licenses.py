"""Licence scan by a positional index of rare words. DataFrame operations only.

Templates are word sequences. Their words' inverse document frequencies are counted over all documents; each template
is represented by its rarest words (anchors). A document's postings hold only the positions of anchors: an anchor at
position p that stands at place q of a template votes for the start p - q; starts are intersected over the anchors of a
template and the template's mandatory key phrase is compared word by word there. All of it happens in a row's own
arrays: nothing is shuffled, and documents without any anchor are settled after one look.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxloom.llm.common import UPPER, table
from boxloom.llm.registry import query

#: The phrases of the base labels.
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: Sentences from the texts of public licences, with the label that the method adds.
TEXTS = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl": "gnu general public license",
    "lgpl": "gnu lesser general public license",
    "agpl": "gnu affero general public license",
    "mpl-2": "mozilla public license version 2",
    "epl": "eclipse public license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0": "cc0 1 0 universal",
    "cc-by": "creative commons attribution",
    "proprietary": "all rights reserved",
}
#: Of a licence text so many first words are mandatory; a phrase is mandatory as a whole.
KEY_WORDS = 5
#: Rarest words by which a template is looked up.
ANCHORS = 3
#: A word, A-Z still being there.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What separates words (A-Z are still there: they become a-z).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    """Lower-case only A-Z and cut at everything in ASCII but letters and digits."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def idf(docs: DataFrame, templates: dict[str, str]) -> dict[str, float]:
    """Inverse document frequency of every template word over all documents; as many numbers as the templates have words."""
    vocabulary = sorted({w for t in templates.values() for w in t.split()})
    listed = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(words(), listed)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}
    total = docs.count()
    return {w: 1 + math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def anchors(template: list[str], weight: dict[str, float], n: int = ANCHORS) -> list[tuple[int, str]]:
    """The places of the n rarest words of a template, the rarest first; of a word that comes twice, its first place."""
    first = {w: template.index(w) for w in template}
    return [(first[w], w) for w in sorted(first, key=lambda w: (-weight[w], first[w]))[:n]]


def scan(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEXTS) -> DataFrame:
    """`docs` plus n_words, n_base, first_word, last_word, base_labels, labels and score.

    Base: all places where the words of a base phrase stand consecutively (word numbers from 0). The method adds the
    labels of `templates` whose mandatory phrase (its first KEY_WORDS words) stands where their anchors agree. `score` is
    1 with a base place, else the largest share of a found template's inverse document frequencies that stands in
    place, else 0. Labels are distinct, sorted and joined by commas, an empty string without any.

    Null and empty texts have no words; rows are independent and keep all their columns (those named above are
    replaced); an empty table gives an empty one.
    """
    every = {**base, **templates}
    weight = idf(docs.select("text"), every)
    looked_up = {label: anchors(t.split()[:KEY_WORDS] if label in templates else t.split(), weight) for label, t in every.items()}
    rarest = sorted({found[0][1] for found in looked_up.values()})
    out = docs.drop("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    out = out.withColumn("n_words", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"))
    # a text that does not even contain the letters of a rarest word has no postings and is not cut into words
    low = F.lower("text")
    maybe = F.coalesce(reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in rarest]), F.lit(False))
    out = out.withColumn("_scan_words", F.when(maybe, words()).otherwise(F.array().cast("array<string>")))
    # postings of the rarest word of every template: (position, word)
    posted = F.transform("_scan_words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    out = out.withColumn("_scan_posts", F.filter(posted, lambda p: p["word"].isin(rarest)))
    no_places = F.array().cast("array<int>")

    def starts(label: str, text: str) -> Column:
        template, found = text.split(), looked_up[label]
        key = template[:KEY_WORDS] if label in templates else template
        (q, rare), rest = found[0], found[1:]
        places = F.transform(F.filter("_scan_posts", lambda p: p["word"] == rare), lambda p: p["at"] - q)

        def stands(s: Column, k: int, word: str) -> Column:
            return F.get(F.col("_scan_words"), s + k) == word

        def agrees(s: Column) -> Column:
            ok = s >= 0
            for k, word in rest:  # the other anchors first, then the whole phrase
                ok = ok & stands(s, k, word)
            for k, word in enumerate(key):
                ok = ok & stands(s, k, word)
            return F.coalesce(ok, F.lit(False))

        return F.when(F.size("_scan_posts") > 0, F.filter(places, agrees)).otherwise(no_places)

    out = out.withColumns({f"_scan_at_{k}": starts(label, text) for k, (label, text) in enumerate(every.items())})
    n = {label: F.size(f"_scan_at_{k}") for k, label in enumerate(every)}
    at = [F.col(f"_scan_at_{k}") for k, label in enumerate(every) if label in base]

    def share(label: str, text: str, k: int) -> Column:
        """Of the template's weights, the part whose words stand at the best start."""
        template = text.split()
        total = sum(weight[w] for w in template)

        def in_place(s: Column) -> Column:
            return sum((F.when(F.get(F.col("_scan_words"), s + i) == w, F.lit(weight[w])).otherwise(0.0) for i, w in enumerate(template)), F.lit(0.0))

        return F.when(n[label] > 0, F.array_max(F.transform(f"_scan_at_{k}", lambda s: in_place(s))) / F.lit(total)).otherwise(0.0)

    shares = [share(label, text, k) for k, (label, text) in enumerate(every.items()) if label in templates]
    joined = F.concat(*at)
    n_base = sum((n[label] for label in base), F.lit(0)).cast("long")

    def named(which) -> Column:
        listed = [F.when(n[label] > 0, F.lit(label)) for label in sorted(which)]
        return F.concat_ws(",", *listed)

    return out.withColumns({
        "n_base": n_base,
        "first_word": F.array_min(joined).cast("long"),
        "last_word": F.array_max(joined).cast("long"),
        "base_labels": named(base),
        "labels": named(every),
        "score": F.when(n_base > 0, F.lit(1.0)).otherwise(F.least(F.greatest(*shares), F.lit(1.0))),
    }).drop("_scan_words", "_scan_posts", *[f"_scan_at_{k}" for k in range(len(every))])


@query()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places and labels of every document."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

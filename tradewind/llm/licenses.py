"""License scans: exact set-similarity join of text blocks with license templates.

A block is a window of a text's words: twice as long as the longest template, one at every length of
it, so that each run as long as a template lies in one, however the text is wrapped. (Lines can be
taken as blocks too.) Block and template are sets of words. A block belongs to a template if it holds
at least ``percent`` of the template's words, among them those that only its license has. Words are ordered by how often the corpus has
them, rarest first. A block that contains enough of a template must hold one of the template's
rarest ``size - needed + 1`` words (prefix filter), must have as many template words as are needed
(length filter), and what follows the first common word on either side must suffice (positional
filter); what is left is counted exactly. The order changes the work, never the result.

Templates are a parameter: a fixed list, so whatever is derived from them (their words and the
words' frequencies, the index from prefix words to templates) is bounded by that list, and is
broadcast or collected for that reason. Built-in expressions only. Texts are not shuffled: blocks
that hold a prefix word are, one short row each, and one narrow row per document.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.sinks.shared import shared_dir

# fixed value: a word is a run of these
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# the same for a text whose A-Z were not made small
_ANY_CASE_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# fixed values: phrases and the labels they give
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


@dataclass(frozen=True)
class Template:
    """Words that mark a license, in any order, within one block.

    Notices of different licenses share most of their words, so a block must also hold the words of
    ``must``, those that tell the license apart, and none of ``without``, which tell another one.
    """

    label: str
    text: str
    must: str
    without: str = ""

    @property
    def words(self) -> "list[str]":
        return sorted(set(self.text.split()))


# fixed values: notices as their licenses word them, lower-cased, for the labels above and others
TEMPLATES = (
    Template("mit", "released under the mit license", "mit"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files",
        "granted charge obtaining",
    ),
    Template("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except "
        "in compliance with the license",
        "apache compliance",
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc nc"),
    Template(
        "cc-by-nc",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        "commons noncommercial",
    ),
    Template(
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        "commons attribution",
        "noncommercial sharealike noderivatives",
    ),
    Template(
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        "commons sharealike",
        "noncommercial",
    ),
    Template("cc0", "cc0 1 0 universal public domain dedication", "cc0"),
    Template(
        "gpl-3",
        "this work is licensed under the gnu general public license version 3",
        "gnu general 3",
        "lesser affero library",
    ),
    Template(
        "gpl-3",
        "under the terms of the gnu general public license as published by the free software "
        "foundation either version 3 of the license or at your option any later version",
        "gnu general 3",
        "lesser affero library",
    ),
    Template(
        "gpl-2",
        "this work is licensed under the gnu general public license version 2",
        "gnu general 2",
        "lesser affero library",
    ),
    Template(
        "gpl-2",
        "under the terms of the gnu general public license as published by the free software "
        "foundation either version 2 of the license or at your option any later version",
        "gnu general 2",
        "lesser affero library",
    ),
    Template("lgpl", "gnu lesser general public license", "lesser"),
    Template("agpl", "gnu affero general public license", "affero"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla 2"),
    Template("mpl-2", "licensed under the mozilla public license version 2 0", "mozilla 2"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification",
        "redistribution binary",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "permission fee granted",
    ),
    Template("proprietary", "all rights reserved do not copy or distribute", "reserved not"),
)
PERCENT = 85


def small_letters(text: Column) -> Column:
    """A-Z as a-z, all else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_order(
    docs: DataFrame, templates: "tuple[Template, ...]", text: str = "text"
) -> "list[str]":
    """The templates' words, rarest in the corpus first, ties by the word.

    Counts every occurrence in every text; each task sends a count per template word.
    """
    known = sorted({w for t in templates for w in (*t.words, *t.without.split())})
    counted = (
        docs.select(
            F.explode(_words(small_letters(F.col(text)))).alias("word")
        )
        .filter(F.col("word").isin(known))
        .groupBy("word")
        .count()
        .collect()
    )
    often = {r["word"]: r["count"] for r in counted}
    return sorted(known, key=lambda w: (often.get(w, 0), w))


def needed(template: Template, percent: int) -> int:
    return -(-len(template.words) * percent // 100)


def _index(spark, templates, order: "list[str]", percent: int) -> DataFrame:
    """``word, place, template, size, need``: each template's prefix words, by rank in the order."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, template in enumerate(templates):
        ranks = sorted(rank[w] for w in template.words)
        need = needed(template, percent)
        for place, r in enumerate(ranks[: len(ranks) - need + 1]):
            rows.append((r, place, number, ranks, need))
    names = ["prefix", "place", "template", "ranks", "need", "must", "without"]

    def listed(words) -> Column:
        return F.array(*[F.lit(rank[w]) for w in words]).cast("array<int>")

    built = F.array(
        *[
            F.struct(
                F.lit(r).alias(names[0]),
                F.lit(p).alias(names[1]),
                F.lit(t).alias(names[2]),
                F.array(*[F.lit(x) for x in ranks]).alias(names[3]),
                F.lit(need).alias(names[4]),
                listed(templates[t].must.split()).alias(names[5]),
                listed(templates[t].without.split()).alias(names[6]),
            )
            for r, p, t, ranks, need in rows
        ]
    )
    return spark.range(1).select(F.inline(built))


def _windows(words: Column, known: Column, templates: "tuple[Template, ...]") -> Column:
    """For each window of a text's words, those of them that are in ``known``."""
    step = max([len(t.text.split()) for t in templates], default=1)
    last = F.greatest(F.size(words) - step - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last, F.lit(step)),
        lambda i: F.array_intersect(F.slice(words, i + 1, 2 * step), known),
    )


def similar_blocks(
    docs: DataFrame,
    keys: "list[str]",
    templates: "tuple[Template, ...]" = TEMPLATES,
    percent: int = PERCENT,
    text: str = "text",
    windows: bool = False,
) -> DataFrame:
    """``keys, block, template, share``: every block that holds enough of a template's words.

    Blocks are lines, or with ``windows`` the windows of words; ``block`` counts them from 0.
    ``template`` is its place in ``templates``, ``share`` the part of its words that is there.
    """
    spark = docs.sparkSession
    order = word_order(docs, templates, text)
    index = _index(spark, templates, order, percent)
    rank = {w: i for i, w in enumerate(order)}
    prefix = sorted(
        {
            order[r]
            for t in templates
            for r in sorted(rank[w] for w in t.words)[: len(t.words) - needed(t, percent) + 1]
        }
    )
    ranks = F.create_map(*[F.lit(x) for w, i in rank.items() for x in (w, i)])
    rare = F.array(*[F.lit(w) for w in prefix])
    known = F.array(*[F.lit(w) for w in order])
    words = _words(small_letters(F.col(text)))
    if windows:
        cut = docs.select(*keys, words.alias("_all")).filter(F.arrays_overlap("_all", rare))
        have = _windows(F.col("_all"), known, templates)
        lines = cut.select(*keys, F.posexplode(have).alias("block", "_have"))
    else:
        lines = (
            docs.filter(F.arrays_overlap(words, rare))
            .select(*keys, F.posexplode(F.split(F.col(text), "\n", -1)).alias("block", "_line"))
            .withColumn("_have", F.array_intersect(_words(small_letters(F.col("_line"))), known))
        )
    blocks = (
        lines.filter(F.arrays_overlap("_have", rare))
        .select(
            *keys,
            "block",
            F.array_sort(F.transform("_have", lambda w: ranks[w])).alias("_have"),
        )
        .select(*keys, "block", "_have", F.posexplode("_have").alias("_at", "_word"))
    )
    size = F.size("_have")
    follow = F.least(F.size("ranks") - F.col("place"), size - F.col("_at"))
    return (
        blocks.join(F.broadcast(index), F.col("_word") == F.col("prefix"))
        .filter((size >= F.col("need")) & (follow >= F.col("need")))
        .withColumn("_common", F.size(F.array_intersect("_have", "ranks")))
        .filter(
            (F.col("_common") >= F.col("need"))
            & (F.size(F.array_except("must", "_have")) == 0)
            & ~F.arrays_overlap("without", "_have")
        )
        .select(*keys, "block", "template", (F.col("_common") / F.size("ranks")).alias("share"))
        .distinct()
    )


def _starts(words: Column, phrase: str) -> Column:
    """Places where the phrase's words stand one after another.

    The outer lambda binds the words: a text is split once, not again for every place.
    """
    parts = phrase.split()

    def places(bound: Column) -> Column:
        def here(i: Column) -> Column:
            same = F.get(bound, i).eqNullSafe(F.lit(parts[0]))
            for k, part in enumerate(parts[1:], 1):
                same = same & F.get(bound, i + k).eqNullSafe(F.lit(part))
            return same

        return F.when(
            F.size(bound) > 0, F.filter(F.sequence(F.lit(0), F.size(bound) - 1), here)
        ).otherwise(F.array().cast("array<int>"))

    return F.transform(F.array(words), places)[0]


def phrase_places(text: Column, phrases=PHRASES) -> Column:
    """Array of (start, label) of all phrases of a text; words count from 0."""
    words = _words(small_letters(text))
    kind = "array<struct<start:int,label:string>>"
    found = [
        F.when(
            text.rlike("(?i)" + _BETWEEN.join(phrase.split())),
            F.transform(
                _starts(words, phrase),
                lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")),
            ),
        )
        .otherwise(F.array().cast(kind))
        .cast(kind)
        for phrase, label in phrases
    ]
    return F.concat(*found)


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases=PHRASES,
    templates: "tuple[Template, ...]" = TEMPLATES,
    percent: int = PERCENT,
) -> DataFrame:
    """``key, n_words, places, similar, score`` for every row of ``docs``.

    ``places``: (start, label) of the phrases; ``similar``: (label, block, share) of the windows that
    belong to a template; ``score``: the best share, 1 where a phrase stands, 0 with neither. Null
    and empty texts have no words. Rows with one key and one text have equal results; each row
    comes back.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    place = shared_dir(spark, "licenses-blocks")
    labels = F.array(*[F.lit(t.label) for t in templates])
    similar_blocks(rows, ["key", "mark"], templates, percent, windows=True).groupBy("key", "mark").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.element_at(labels, F.col("template") + 1).alias("label"), "block", "share"
                )
            )
        ).alias("similar"),
        F.max("share").alias("best"),
    ).write.parquet(place)
    found = spark.read.parquet(place).select(
        F.col("key").alias("_key"), F.col("mark").alias("_mark"), "similar", "best"
    )
    narrow = rows.select(
        "key",
        "mark",
        F.regexp_count("text", F.lit(_ANY_CASE_WORD)).cast("long").alias("n_words"),
        phrase_places(F.col("text"), phrases).alias("places"),
    )
    return narrow.join(
        found, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark")), "left"
    ).select(
        F.col("key").alias(key),
        "n_words",
        "places",
        F.coalesce(
            "similar", F.array().cast("array<struct<label:string,block:int,share:double>>")
        ).alias("similar"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

"""License scans: phrases, and an exact containment join of text blocks with license templates.

Blocks are overlapping windows of words, so a notice that is wrapped over lines is found. A template of m words has the hop h, the smallest power of two that is
m / threshold or more; its blocks are the 2h words from each multiple of h on, so any h words that follow each other stand in one block together.
A template fits a block if the block holds at least `threshold` of its distinct words, its marks (words that tell it from others) among them.

Words are ordered by how many documents hold them, rarest first (ties by the word). A template's prefix is its
|T| - ceil(threshold * |T|) + 1 rarest words: a block without any of them holds too few words to fit. So places of prefix words are joined with
the templates' prefixes on the word; a block must then hold ceil(threshold * |T|) of the templates' words (length filter), and what is left of the template behind
the first of its words that the block holds must reach that number (position filter), before the words are compared.

Texts are cut into words once: the places of the templates' and phrases' words are written, and all later steps read those.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: Fixed values of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices in common use: label, words, marks.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser"),
    ("mit", "released under the mit license", "mit"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("reserved", "all rights reserved", "reserved"),
)
THRESHOLD = 0.8


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _literal(words) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def plan_templates(templates, frequency: dict[str, int], threshold: float) -> list[dict]:
    """For each template its distinct words, rarest first, how many of them a block needs, the prefix's length and the hop of its blocks."""
    out = []
    for i, (label, text, marks) in enumerate(templates):
        held = sorted(set(text.split()), key=lambda w: (frequency.get(w, 0), w))
        need = math.ceil(threshold * len(held) - 1e-9)
        hop = 1 << math.ceil(math.log2(max(1, len(text.split()) / threshold)) - 1e-9)
        out.append({"template": i, "label": label, "words": held, "marks": sorted(set(marks.split())), "need": need, "prefix": len(held) - need + 1, "hop": hop})
    return out


def places_of(docs: DataFrame, vocabulary: set[str]) -> DataFrame:
    """row, doc_id, n_words, hits (pos, word: the places of the vocabulary's words) for each row of docs (doc_id, text), written once."""
    words = words_of(F.coalesce("text", F.lit("")))
    placed = F.transform(F.col("words"), lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    known = sorted(vocabulary)
    held = docs.select("doc_id", words.alias("words")).select("doc_id", F.size("words").alias("n_words"), F.filter(placed, lambda h: h["word"].isin(known)).alias("hits"))
    return materialize(held.select(F.monotonically_increasing_id().alias("row"), "*"), "places")


def phrase_places(phrase: str) -> Column:
    """Where the phrase's words stand consecutively, from hits that hold all places of its words."""
    parts = phrase.split()
    at = lambda i: F.get(F.col("hits"), i)

    def begins(i: Column) -> Column:
        test = F.lit(True)
        for d, word in enumerate(parts):
            test = test & F.coalesce((at(i + d)["word"] == word) & (at(i + d)["pos"] == at(i)["pos"] + d), F.lit(False))
        return test

    some = F.filter(F.sequence(F.lit(0), F.size("hits") - 1), begins)
    return F.when(F.exists("hits", lambda h: h["word"] == parts[0]), F.transform(some, lambda i: at(i)["pos"])).otherwise(F.array().cast("array<int>"))


def fitting(places: DataFrame, plans: list[dict]) -> DataFrame:
    """row, own (labels of the templates that fit a block of the row), share (the largest containment), for rows with such a template."""
    spark = places.sparkSession
    table = spark.createDataFrame([tuple(p[c] for c in ("label", "words", "marks", "need", "prefix", "hop")) for p in plans], "label string, words array<string>, marks array<string>, need int, prefix int, hop int")
    prefixes = table.select("*", F.posexplode(F.slice("words", F.lit(1), F.col("prefix"))).alias("at", "word"))
    probe = sorted({w for p in plans for w in p["words"][: p["prefix"]]})
    # A place takes along the places near it, as many as the largest block can hold on either side, so a long text's places aren't copied for each.
    reach = 2 * max(p["hop"] for p in plans)
    some = F.filter(F.sequence(F.lit(0), F.size("hits") - 1), lambda i: F.coalesce(F.get(F.col("hits"), i)["word"].isin(probe), F.lit(False)))
    near = F.transform(some, lambda i: F.struct(F.get(F.col("hits"), i).alias("at"), F.slice("hits", F.greatest(i + 1 - reach, F.lit(1)), F.lit(2 * reach)).alias("hits")))
    met = places.where(F.size("hits") > 0).select("row", F.explode(near).alias("near"))
    met = met.select("row", F.col("near.hits").alias("hits"), F.col("near.at.pos").alias("pos"), F.col("near.at.word").alias("word")).join(prefixes, "word")

    def share(k: Column) -> Column:
        """Containment in the block from k hops on, 0 if a filter or the marks refuse it."""
        own = F.filter("hits", lambda h: (h["pos"] >= k * F.col("hop")) & (h["pos"] < (k + 2) * F.col("hop")))
        block = F.array_distinct(F.transform(own, lambda h: h["word"]))
        n = F.size("words")

        def test(b: Column) -> Column:
            first = F.array_position(F.transform(F.slice("words", F.lit(1), F.col("at") + 1), lambda w: F.array_contains(b, w)), True)
            could = (k >= 0) & (F.size(b) >= F.col("need")) & (n - first + 1 >= F.col("need")) & (F.size(F.array_except("marks", b)) == 0)
            both = F.size(F.array_intersect("words", b))
            return F.when(could, F.when(both >= F.col("need"), both / n.cast("double"))).otherwise(F.lit(None).cast("double"))

        return F.get(F.transform(F.array(block), test), F.lit(0))

    last = F.floor(F.col("pos") / F.col("hop")).cast("int")
    met = met.select("row", "label", F.greatest(share(last), share(last - 1)).alias("share")).where("share is not null")
    return met.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("share"))


def scan(docs: DataFrame, *, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs (doc_id, text): n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: 1 where a phrase stands, else the largest containment of a fitting template, else 0. Null and empty
    texts have no words, no labels and score 0; repeated rows stay; other columns are ignored; an empty table gives an empty result."""
    vocabulary = {w for _, t, _ in templates for w in t.split()} | {w for p, _ in phrases for w in p.split()}
    places = places_of(docs, vocabulary)
    # At most one row for each word of the templates comes to the driver.
    counts = places.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    plans = plan_templates(templates, {r.word: r.n for r in counts.collect()}, threshold)
    rows = places.select("row", "doc_id", "n_words", F.array(*[phrase_places(p) for p, _ in phrases]).alias("found"))
    base = F.filter(_literal([label for _, label in phrases]), lambda x, i: F.size(F.get(F.col("found"), i)) > 0)
    flat = F.flatten("found")
    rows = rows.select("row", "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.size(flat).cast("bigint").alias("n_base"), F.array_min(flat).cast("bigint").alias("first_word"), F.array_max(flat).cast("bigint").alias("last_word"), base.alias("base"))
    rows = rows.join(fitting(places, plans), "row", "left")
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("base", F.coalesce("own", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

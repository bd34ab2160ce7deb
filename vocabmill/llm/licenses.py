"""License scans: exact phrases, and an exact set-similarity join of text blocks with license templates.

Native: DataFrame and SQL functions only.

Blocks are lines, and for notices wrapped over lines each line with a prefix word together with the words around it, as many on either side
as the longest template has. What a line says of a template goes before what its surroundings say. A block and a template are sets of words. A block matches a template if it holds at least ``THRESHOLD`` of
the template's words (containment). Template words are put in the order of how many documents hold them, rarest first, counted over
the whole corpus. If ``need`` words must be common, one of the first ``n - need + 1`` words must be in the block (prefix
filter). A block's own template words stand in the same order: there must be ``need`` of them (length filter), and as many must be
left from the first common word on, in the block as in the template (positional filter). What passes is verified exactly.

The templates are a fixed short list, so the table that is broadcast has a known size (a row for each prefix word).

Defined results: null or empty texts have no words and no labels; repeated rows get equal results; a null doc_id is kept.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Phrases and labels of the base scan.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices of common licenses, by the label that this method gives them.
TEMPLATES = [
    ("mit-notice", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without permission"),
]
THRESHOLD = 0.85
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; letters beyond A-Z that lower() also changes stay word characters and meet no ASCII template."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), 0)


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    return sorted({w for _, t in templates for w in t.split()})


def base_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, key, n_words, n_base, first_word, last_word, base_labels (array): places of the phrases in the word sequence;
    held (array): the template words that the text has."""
    own = F.array(*map(F.lit, vocabulary(templates))).cast("array<string>")
    d = docs.select("doc_id", F.xxhash64("text").alias("key"), words(F.coalesce("text", F.lit(""))).alias("w"))
    d = d.select("doc_id", "key", F.size("w").cast("long").alias("n_words"), F.array_intersect(own, "w").alias("held"), F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("s"))
    d = d.withColumn("any", F.col("s").contains(" license "))
    counts, first, last, labels = [], [], [], []
    blanks = lambda s: (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("long")
    for phrase, label in PHRASES.items():
        size, here = len(phrase.split()), F.col("any") & F.col("s").contains(f" {phrase} ")
        counts.append(F.when(here, F.regexp_count("s", F.lit(f" {phrase}(?= )")).cast("long")).otherwise(F.lit(0)))
        first.append(F.when(here, blanks(F.expr(f"substring(s, 1, instr(s, ' {phrase} ') - 1)"))))
        last.append(F.when(here, F.col("n_words") - size - blanks(F.expr(f"substring(reverse(s), 1, instr(reverse(s), ' {phrase[::-1]} ') - 1)"))))
        labels.append(F.when(here, F.lit(label)))
    return d.select(
        "doc_id", "key", "n_words", sum(counts, F.lit(0).cast("long")).alias("n_base"), F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_labels"), "held",
    )


def order_of(held: DataFrame, templates: list[tuple[str, str]]) -> dict[str, int]:
    """In how many documents each template word occurs; as many rows reach the driver as the templates have words."""
    counted = held.select(F.explode("held").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    return {w: 0 for w in vocabulary(templates)} | {r.w: r.n for r in counted}


def template_join(docs: DataFrame, count: dict[str, int], templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, key, block, label, containment, wrapped: every (line, template) pair that meets the threshold, and those of lines with their
    surroundings. ``count`` (``order_of``) orders the words; any order gives the same pairs."""
    spark = docs.sparkSession
    rows = []
    for label, text in templates:
        own = sorted(set(text.split()), key=lambda w: (count[w], w))
        need = ceil(threshold * len(own) - 1e-9)
        rows += [(own[p], label, own, p, len(own), need) for p in range(len(own) - need + 1)]
    prefix = spark.createDataFrame(rows, "word string, label string, own array<string>, place int, n int, need int")
    starts = sorted({r[0] for r in rows})
    hit = "(?<![0-9a-z\\x80-\\x{10FFFF}])(?:" + "|".join(starts) + ")(?![0-9a-z\\x80-\\x{10FFFF}])"
    lines = docs.select("doc_id", F.xxhash64("text").alias("key"), F.posexplode(F.split("text", "\n")).alias("block", "line"))
    # a line without any prefix word is left before its words are taken apart
    lines = lines.withColumn("line", F.lower("line")).where(F.col("line").rlike(hit))
    lines = lines.select("doc_id", "key", "block", F.array_distinct(F.regexp_extract_all("line", F.lit(_WORD), 0)).alias("w"), F.lit(False).alias("wrapped"))
    lines = lines.union(surroundings(docs, hit, max((len(t.split()) for _, t in templates), default=0)))
    # of a block only the words of any template matter; an intersection keeps the order of its left side
    ordered = F.array(*map(F.lit, sorted(count, key=lambda w: (count[w], w)))).cast("array<string>")
    lines = lines.select("doc_id", "key", "block", "wrapped", F.array_intersect(ordered, "w").alias("v")).where(F.size("v") >= min((r[5] for r in rows), default=0))
    met = lines.select("*", F.posexplode("v").alias("at", "word")).join(F.broadcast(prefix), "word")
    met = met.where((F.size("v") >= F.col("need")) & (F.least(F.col("n") - F.col("place"), F.size("v") - F.col("at")) >= F.col("need")))
    common = F.size(F.array_intersect("v", "own"))
    # a pair is verified at its first common word in the order only
    earlier = F.size(F.array_intersect("v", F.expr("slice(own, 1, place)")))
    return met.where(earlier == 0).withColumn("common", common).where("common >= need").select("doc_id", "key", "block", "label", (F.col("common") / F.col("n")).alias("containment"), "wrapped")


def surroundings(docs: DataFrame, hit: str, reach: int) -> DataFrame:
    """doc_id, key, block, w, wrapped: the words of each line that ``hit`` meets, with up to ``reach`` words before and after it."""
    none = F.array().cast("array<string>")
    add = lambda a, x: F.when(F.size(a) >= reach, a)

    def around(i: Column) -> Column:
        at, ls = i.cast("int"), F.col("ls")
        before = F.reverse(F.slice(ls, F.greatest(at - 2 * reach + 1, F.lit(1)), F.least(at, F.lit(2 * reach))))
        before = F.aggregate(before, none, lambda a, x: add(a, x).otherwise(F.concat(words(x), a)), lambda a: F.slice(a, F.greatest(F.size(a) - reach + 1, F.lit(1)), reach))
        after = F.aggregate(F.slice(ls, at + 2, 2 * reach), none, lambda a, x: add(a, x).otherwise(F.concat(a, words(x))), lambda a: F.slice(a, 1, reach))
        return F.array_distinct(F.concat(before, words(F.get(ls, at)), after))

    d = docs.where(F.lower("text").rlike(hit)).select("doc_id", F.xxhash64("text").alias("key"), F.split("text", "\n").alias("ls")).where(F.size("ls") > 1)
    met = d.select("*", F.explode(F.filter(F.transform("ls", lambda x, i: F.when(F.lower(x).rlike(hit), i)), lambda i: i.isNotNull())).alias("block"))
    return met.select("doc_id", "key", "block", around(F.col("block")).alias("w"), F.lit(True).alias("wrapped"))


def scan(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    line = F.max(F.when(~F.col("wrapped"), F.col("containment")))
    # texts are taken apart once; what is written of them is small
    base = stored(base_scan(docs), "licenses")
    found = template_join(docs, order_of(base, TEMPLATES)).groupBy("doc_id", "key", "label").agg(F.coalesce(line, F.max("containment")).alias("containment"))
    found = found.groupBy("doc_id", "key").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    found = found.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "found", "best")
    both = base.join(found, base.doc_id.eqNullSafe(found._d) & (base.key == found._k), "left")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


_W = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {
    "op5_licenses": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOW} AS low FROM documents),
        w AS (SELECT r, doc_id, regexp_extract_all(low, {_W}) AS ws FROM d),
        f(phrase, n, label) AS (VALUES {", ".join(f"('{p}', {len(p.split())}, '{x}')" for p, x in PHRASES.items())}),
        p AS (SELECT r, label, i - 1 AS i FROM (SELECT r, ws, label, phrase, n, unnest(range(1, len(ws) + 2 - n)) AS i FROM w, f) WHERE array_to_string(ws[i:i + n - 1], ' ') = phrase),
        b AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS base FROM p GROUP BY r),
        t(label, own) AS (VALUES {", ".join(f"('{x}', list_distinct(string_split('{t}', ' ')))" for x, t in TEMPLATES)}),
        l AS (SELECT r, list_distinct(regexp_extract_all(line, {_W})) AS ws FROM (SELECT r, unnest(string_split(low, chr(10))) AS line FROM d)),
        m AS (SELECT r, label, len(list_intersect(ws, own)) / len(own) AS c FROM l, t WHERE len(list_intersect(ws, own)) >= {THRESHOLD} * len(own) - 1e-9),
        g AS (SELECT r, list(DISTINCT label) AS found, max(c) AS best FROM m GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
            coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ',') AS labels,
            CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0) END::DOUBLE AS score
        FROM w LEFT JOIN b USING (r) LEFT JOIN g USING (r)""",
}

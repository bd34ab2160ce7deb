"""Names held against a list of names, by whole words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored

#: Names are broadcast up to so many and so many characters in all; more of them meet the runs in a join of sorted shuffles.
BROADCAST_NAMES, BROADCAST_CHARS = 100_000, 4 << 20


def word_runs(x: Column, most: int) -> Column:
    """All runs of up to ``most`` neighbouring words, each once."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " ")), " "), lambda w: w != "")
    run = lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(words) - i)), lambda k: F.array_join(F.slice(words, i + 1, k), " "))
    every = F.flatten(F.transform(F.sequence(F.lit(0), F.size(words) - 1), run))
    return F.when(F.size(words) > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def longest_contained(texts: DataFrame, names: DataFrame, most: int) -> DataFrame:
    """(id, name_id, how): the longest of ``names`` (name, name_id) whose words stand together in a text of ``texts`` (id, text).

    ``how`` is exact where the name is the whole text, else contains. Of names of equal length the first by spelling is taken, of one name's ids the
    smallest. Names of more than ``most`` words are found only as whole texts. Texts without a name have no row. Every text gives at most
    ``most`` rows a word, which meet the names in an equi-join. The runs are many times what Spark takes them for by the size of the texts, so
    the side of a join is never left to it: runs are not broadcast, names only where counted as few.
    """
    norm = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    known = names.select(norm(F.col("name")).alias("run"), "name_id").where("run <> ''").groupBy("run").agg(F.min("name_id").alias("name_id"))
    known = stored(known, "names")
    n, chars = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("run")), F.lit(0))).first()
    known = F.broadcast(known) if n <= BROADCAST_NAMES and chars <= BROADCAST_CHARS else known.hint("merge")
    asked = texts.select("id", norm(F.col("text")).alias("whole"), F.col("text"))
    runs = asked.select("id", "whole", F.explode(F.array_union(word_runs(F.col("text"), most), F.array("whole"))).alias("run"))
    met = runs.join(known, "run").select("id", "name_id", (F.col("run") == F.col("whole")).alias("exact"), "run", F.size(F.split("run", " ")).alias("words"))
    best = met.groupBy("id").agg(F.min(F.struct((~F.col("exact")).alias("other"), (-F.col("words")).alias("words"), "run", "name_id")).alias("m"))
    return best.select("id", F.col("m.name_id").alias("name_id"), F.when(F.col("m.other"), "contains").otherwise("exact").alias("how"))

"""Text normalisation rules as column expressions (JVM side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that a class name's key leaves out, and the tags that names end in.
CLASS_STOP = ["receptor", "receptors", "agents", "agent", "drugs", "drug", "of", "the", "and"]
TAGS = "disorder|finding|procedure|body structure|substance|organism|observable entity|qualifier value|product|medicinal product|clinical drug|morphologic abnormality|cell|situation|regime/therapy|physical object|specimen|assessment scale|record artifact|event"


def squash(x: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def squash_vowels(x: Column) -> Column:
    """``squash`` with ae and oe as e; null is empty."""
    return F.regexp_replace(F.replace(F.replace(F.lower(F.coalesce(x, F.lit(""))), F.lit("ae"), F.lit("e")), F.lit("oe"), F.lit("e")), "[^a-z0-9]", "")


def substance_name(x: Column) -> Column:
    """A substance's name for equality: tag off, sulph as sulf, oe as e, other characters as single blanks."""
    out = F.regexp_replace(F.trim(x), "\\s*\\(substance\\)$", "")
    for old, new in (("sulph", "sulf"), ("oe", "e"), ("[^a-z0-9 ]", " "), ("\\s+", " ")):
        out = F.regexp_replace(out, old, new)
    return F.lower(out)


def bag_of_words(x: Column) -> Column:
    """Sorted words without the closing tag."""
    bare = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), f"\\s*\\((?:{TAGS})\\)\\s*$", "")
    return F.array_join(F.array_sort(F.regexp_extract_all(bare, F.lit("[a-z0-9]+"), 0)), " ")


def class_key(x: Column) -> Column:
    """A class name's words: kind tag off, letters and digits apart, singular, without stop words, sorted, distinct."""
    bare = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "\\s*\\[(moa|pe|epc|cs)\\]\\s*$", "")
    words = F.regexp_extract_all(F.regexp_replace(bare, "([a-z])(\\d)", "$1 $2"), F.lit("[a-z0-9]+"), 0)
    single = F.transform(words, lambda w: F.when(w.endswith("s") & (F.length(w) > 3), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w))
    return F.array_join(F.array_sort(F.array_except(F.array_distinct(single), F.array(*map(F.lit, CLASS_STOP)))), " ")


def tag(x: Column) -> Column:
    """The word or words in the closing brackets of a name, else empty."""
    return F.regexp_extract(x, "\\(([^()]*)\\)\\s*$", 1)


def acronym_of(short: Column, long: Column) -> Column:
    """Whether the letters of ``short`` appear, in order, among the initials of ``long``."""
    initials = F.array_join(F.transform(F.regexp_extract_all(F.lower(long), F.lit("[a-z0-9]+"), 0), lambda w: F.substring(w, 1, 1)), "")
    pattern = F.concat(F.lit("^.*"), F.regexp_replace(F.lower(short), "([a-z0-9])", "$1.*"), F.lit("$"))
    return F.rlike(initials, pattern)


def cited_items(x: Column) -> Column:
    """Item numbers of "item N [, M and K] of the Medicare Benefits Schedule"."""
    lists = F.regexp_extract_all(x, F.lit("(?i)items?\\s+((?:\\d+(?:\\s*,\\s*|\\s+and\\s+|\\s+or\\s+)?)+)\\s+of the Medicare Benefits Schedule"), 1)
    return F.array_distinct(F.flatten(F.transform(lists, lambda s: F.regexp_extract_all(s, F.lit("\\d+"), 0))))

"""Line dedup: lines within one word edit of an earlier line, by a deletion-neighbourhood join.

Native: DataFrame and SQL functions only.

A line is normalised to its lower-cased words. Two lines are near if one word inserted, deleted or replaced turns one
into the other and leaves more than half of the longer line's words, so the longer line has at least three words; all other lines with words
must be equal. Callers may ask for less: lines of fewer than ``near_words`` words must be equal, and lines of fewer than ``min_words`` words
stay untouched. The query and the pipeline ask for all (``WHOLE``). A line goes if an earlier line (smaller doc_id, then smaller line number; kept or not) is equal or near.

1. Equal lines: grouped by two 64-bit hashes, the earliest occurrence stays.
2. Which lines can have a near one: one edited word leaves the front half or the back half of a line as it is, counted from the side that
   it is on. Lines that share no such half with a line of their length, or of one word more or less, are near to none and emit nothing more.
3. Deletion neighbourhood: of the others every variant with one word deleted, written once as hashed keys. Equal
   (variant, place) of lines of one length is a replaced word; a variant equal to a whole line is an inserted one.
   Groups meet in minimums only, so a variant that thousands of lines share costs no pairs.
4. The words of a line and of the earliest line that its groups name are compared before it goes.

Defined results: null and empty texts have no lines that go; rows with equal doc_id and equal line number tie, and ties stay; a null doc_id
sorts first; a document's text is put together from the lines that stay, in order, and other columns are unchanged. A document
that loses every line that has words is dropped by ``dedup``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import aside, discard, stored, table

MIN_WORDS, NEAR_WORDS = 3, 8
#: Every line with words, and every near pair: a line of two words can be near to one of three.
WHOLE = {"min_words": 1, "near_words": 2}
#: So many rows at most (some 16 bytes each) are broadcast to be looked up; beyond it a shuffle does.
BROADCAST_LINES = 1_000_000


def plain(t: Column) -> Column:
    """Lower-cased words with single blanks between; where the line is like that already, without a pattern."""
    odd = t.startswith(" ") | t.endswith(" ")
    for x in ("  ", "\t", "\x0b", "\f", "\r"):
        odd = odd | t.contains(x)
    low = F.lower(t)
    return F.when(odd, F.trim(F.regexp_replace(low, "[\\x09-\\x0D\\x20]+", " "))).otherwise(low)


def lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, line (number), s (words between single blanks), n for the lines with enough words."""
    each = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    # generated, not projected: a filter on s would be pushed below a projection and work it out again
    each = each.select("doc_id", "line", F.inline(F.array(F.struct(plain(F.col("t")).alias("s"))))).where("s <> ''")
    each = each.withColumn("n", F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit(""))) + 1)
    return each.where(F.col("n") >= min_words) if min_words > 1 else each


def hashed(docs: DataFrame, name: str, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id, line, h1, h2 and the keys of halves, k0 to k3 (null for short lines): texts are taken apart once, all else reads this table."""
    return stored(lines(docs, min_words).select("doc_id", "line", *identity(), *half_keys(near_words)), name)


def identity() -> list[Column]:
    """128 bits for a line's words."""
    return [F.xxhash64("s").alias("h1"), F.xxhash64(F.lit(1), "s").alias("h2")]


def half_keys(near_words: int) -> list[Column]:
    """Hashes of the front and back half of a line of m words, for its own length m and for one word less."""
    keys = []
    for m, least in (("n", max(near_words, 2)), ("(n - 1)", max(near_words, 3))):
        for half in (f"0, substring_index(s, ' ', {m} div 2)", f"1, substring_index(s, ' ', {m} div 2 - {m})"):
            keys.append(F.expr(f"CASE WHEN n >= {least} THEN xxhash64({m}, {half}) END").alias(f"k{len(keys)}"))
    return keys


def moment(doc_id: str = "doc_id", line: str = "line") -> Column:
    """The order of occurrences as one number, which hash aggregation can hold: doc_id (null first), then line."""
    return F.expr(f"cast(coalesce(cast({doc_id} as decimal(20, 0)), cast('-9223372036854775809' as decimal(20, 0))) * cast(4294967296 as decimal(10, 0)) + cast({line} as decimal(10, 0)) as decimal(32, 0))")


def few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES


def variants() -> Column:
    """(key, place) of each variant with one word deleted; place -1: the line itself.

    A sequence's key is the xor of its hashed (word, place) pairs, with its length; the variants' keys follow
    from running xors, kept per ``step`` words (the cube root of twice the length), so long lines cost no quadratic time. A line of two words has no variants.
    """
    xor = lambda a: f"aggregate({a}, 0L, (s, x) -> s ^ x)"
    runs = "sequence(0, (n - 1) div step)"
    return F.expr(f"""
        transform(array(named_struct('a', transform(w, (x, i) -> xxhash64(x, i)), 'b', transform(w, (x, i) -> xxhash64(x, i - 1)))), r ->
        transform(array(named_struct('a', r.a, 'b', r.b, 'd', zip_with(r.a, r.b, (x, y) -> x ^ y))), r ->
        transform(array(named_struct('a', r.a, 'b', r.b, 'd', r.d, 'c', transform({runs}, c -> {xor("slice(r.d, cast(c * step + 1 as int), step)")}), 't', {xor("r.b")})), r ->
        transform(array(named_struct('a', r.a, 'b', r.b, 'd', r.d, 't', r.t, 'p', transform({runs}, c -> {xor("slice(r.c, 1, cast(c as int))")}))), r ->
            concat(array(named_struct('key', xxhash64({xor("r.a")}, n), 'place', -1)),
            transform(CASE WHEN n > 2 THEN sequence(0, n - 1) ELSE cast(array() as array<int>) END, i -> named_struct('key', xxhash64(r.t ^ r.p[cast(i div step as int)] ^ {xor("slice(r.d, cast(i div step * step + 1 as int), i % step)")} ^ r.b[i], n - 1), 'place', i))
        ))[0])[0])[0])[0]""")


def near_lines(docs: DataFrame, every: DataFrame, name: str = "lines") -> DataFrame:
    """h1, h2 of the distinct lines that have an earlier near line; ``every``: the table of ``hashed``."""
    look_up = lambda x: F.broadcast(x) if few(x) else x
    keys = every.where("k0 is not null").select("doc_id", "line", "h1", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")).where("key is not null")
    shared = stored(keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("key"), name)
    able = keys.join(look_up(shared), "key", "left_semi")
    firsts = stored(able.groupBy("h1", "h2").agg(F.min(moment()).alias("moment"), F.min_by(F.struct("doc_id", "line"), moment()).alias("first")), name)
    # the words of just those lines, numbered in the order of their first occurrence
    at = firsts.select(F.col("first.doc_id").alias("_d"), F.col("first.line").alias("_l"), "h1", "h2", "moment")
    hint = F.broadcast if few(firsts) else lambda x: x
    held = docs.join(hint(at.select("_d").distinct()), F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi")
    each = held.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).join(hint(at), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("line") == F.col("_l")))
    each = each.select("h1", "h2", "moment", plain(F.col("t")).alias("s")).where(F.xxhash64("s") == F.col("h1")).dropDuplicates(["h1", "h2"])
    own = each.orderBy("moment").select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "moment", F.split("s", " ").alias("w"))
    own = own.withColumn("n", F.size("w")).withColumn("step", F.greatest(F.lit(4), F.cbrt(2 * F.col("n")).cast("int")))
    own = stored(own, name)

    v = stored(own.select("id", F.explode(variants()).alias("v")).select("id", "v.key", "v.place"), name)
    # replaced word: equal variant and place; the earliest of the group and the rest
    same = v.where("place >= 0").groupBy("key", "place").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.count(F.lit(1)).alias("k")).where("k > 1")
    same = stored(same, name)
    pairs = same.where("k = 2").select("a", "z", "place")
    more = same.where("k > 2").select("key", "place", "a")
    pairs = pairs.union(v.where("place >= 0").join(look_up(more), ["key", "place"]).where("id > a").select("a", F.col("id").alias("z"), "place"))
    # inserted word: a variant equals a whole line
    whole = v.where("place = -1").select("key", F.col("id").alias("whole"))
    cut = stored(v.where("place >= 0").select("key", "place", F.col("id").alias("cut")).join(look_up(whole), "key"), name)
    first = lambda by, other: cut.groupBy(by).agg(F.min(other).alias(other), F.min_by("place", other).alias("place")).select("cut", "whole", "place")
    cut = first("whole", "cut").union(first("cut", "whole")).select(F.least("cut", "whole").alias("a"), F.greatest("cut", "whole").alias("z"), "place")
    pairs = pairs.union(cut).distinct()

    for side in ("a", "z"):
        pairs = pairs.join(own.select(*(F.col(c).alias(side if c == "id" else f"{side}_{c}") for c in own.columns)), side)
    without = lambda x: f"concat(slice({x}, 1, place), slice({x}, place + 2, size({x})))"
    edit = F.expr(f"""a_moment < z_moment AND CASE WHEN a_n = z_n THEN size(filter(zip_with(a_w, z_w, (x, y) -> x <> y), d -> d)) <= 1
        WHEN a_n = z_n + 1 THEN {without("a_w")} = z_w WHEN z_n = a_n + 1 THEN {without("z_w")} = a_w ELSE false END""")
    return pairs.where(edit).select(F.col("z_h1").alias("h1"), F.col("z_h2").alias("h2")).distinct()


def duplicates(docs: DataFrame, name: str = "lines", min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id, line of every occurrence that goes."""
    every = hashed(docs, name, min_words, near_words)
    near = near_lines(docs, every, name).withColumn("near", F.lit(True))
    own = every.select("doc_id", "line", "h1", "h2")
    group = own.groupBy("h1", "h2").agg(F.min(moment()).alias("first"), F.count(F.lit(1)).alias("k"))
    known = group.join(near, ["h1", "h2"], "left").where("k > 1 or near").select("h1", "h2", "first", "near")
    known = stored(known, name)  # a written table, so that the join below may split a line that very many texts hold
    return own.join(known, ["h1", "h2"]).where(F.col("near") | (moment() > F.col("first"))).select("doc_id", "line").distinct()


def gone(docs: DataFrame, name: str = "lines", min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id and the sorted numbers of its lines that go."""
    return duplicates(docs, name, min_words, near_words).groupBy("doc_id").agg(F.array_sort(F.collect_list("line")).alias("gone"))


def dedup(docs: DataFrame, name: str = "lines", min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` without those lines; a document that had words and has none left is dropped."""
    columns = docs.columns
    docs, back = aside(docs, "gone", "_id", "_cut")
    # what leads to the numbers of the lines is removed before whole texts may have to travel to them
    work = f"{name}-{uuid.uuid4().hex}"
    g = stored(gone(docs, f"{work}/{name}", min_words, near_words), name).withColumnRenamed("doc_id", "_id")
    discard(docs.sparkSession, work)
    both = docs.join(g, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    kept = F.array_join(F.expr("filter(split(text, '\\n'), (x, i) -> not array_contains(gone, i))"), "\n")
    both = both.withColumn("_cut", F.col("gone").isNotNull() & F.col("text").isNotNull()).withColumn("text", F.when(F.col("_cut"), kept).otherwise(F.col("text")))
    both = both.where(~F.col("_cut") | F.col("text").rlike("[^\\x09-\\x0D\\x20]"))
    if "n_chars" in columns:
        both = both.withColumn("n_chars", F.when(F.col("_cut"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return both.select(*back)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document: n_lines, n_gone and the numbers of the lines that go, comma-joined."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    g = gone(docs, **WHOLE).withColumnRenamed("doc_id", "_id")
    n = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    both = n.join(g, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return both.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_gone"), F.coalesce(F.array_join("gone", ","), F.lit("")).alias("gone"))


ORACLE = {
    "op10_lines": rf"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents),
        w AS (SELECT doc_id, line, regexp_extract_all(lower(t), '[^\x09-\x0D\x20]+') AS ws FROM l),
        o AS (SELECT doc_id, line, ws, array_to_string(ws, ' ') AS s FROM w WHERE len(ws) > 0),
        d AS (SELECT s, any_value(ws) AS ws, min((doc_id, line)) AS first FROM o GROUP BY s),
        v AS (SELECT s, first, i, len(ws) AS n, array_to_string(list_concat(ws[1:i - 1], ws[i + 1:]), ' ') AS key FROM (SELECT s, ws, first, unnest(range(1, len(ws) + 1)) AS i FROM d WHERE len(ws) > 2)),
        near AS (
            SELECT b.s FROM v a JOIN v b ON a.key = b.key AND a.i = b.i AND a.n = b.n AND a.first < b.first
            UNION SELECT CASE WHEN v.first < d.first THEN d.s ELSE v.s END FROM v JOIN d ON d.s = v.key),
        g AS (SELECT DISTINCT o.doc_id, o.line FROM o JOIN d USING (s) WHERE (o.doc_id, o.line) > d.first OR o.s IN (SELECT s FROM near)),
        a AS (SELECT doc_id, count(*) AS n_gone, string_agg(line::VARCHAR, ',' ORDER BY line) AS gone FROM g GROUP BY doc_id)
        SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_gone, 0)::BIGINT AS n_gone, coalesce(gone, '') AS gone
        FROM documents LEFT JOIN a USING (doc_id)""",
}

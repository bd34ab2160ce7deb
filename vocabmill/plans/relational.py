"""Relational operators: scans, predicates, joins, aggregates, windows, set operations, functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import units as U
from ..operators import editions as E
from .base import t

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size > 40 AND p_type = 'PROMO'")
def scan_project(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "part").where("p_size > 40 and p_type = 'PROMO'").select("p_partkey", "p_name", "p_retailprice")


@query("""SELECT p_partkey, CASE WHEN p_name LIKE 'red %' THEN 'red' WHEN p_name ILIKE '%BOLT' THEN 'bolt' WHEN p_type NOT LIKE 'S%' AND p_size < 10 THEN 'tiny' ELSE 'other' END AS kind
    FROM part WHERE p_brand LIKE 'Brand#1%'""")
def filter_like_case(s, d):
    kind = F.when(F.col("p_name").like("red %"), "red").when(F.col("p_name").ilike("%BOLT"), "bolt").when(~F.col("p_type").like("S%") & (F.col("p_size") < 10), "tiny").otherwise("other")
    return t(s, d, "part").where(F.col("p_brand").like("Brand#1%")).select("p_partkey", kind.alias("kind"))


@query("""SELECT w.word, count(*) AS parts FROM part JOIN (SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part) w ON p_name LIKE w.word || ' %' GROUP BY w.word""")
def prefix_join(s, d):
    # the first word is the only prefix that ends before a blank and holds none, so the theta join is an equi-join
    p = t(s, d, "part").where(F.col("p_name").contains(" ")).withColumn("word", F.split_part("p_name", F.lit(" "), F.lit(1)))
    words = t(s, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word")).distinct()
    return p.join(words, "word").groupBy("word").agg(F.count(F.lit(1)).alias("parts"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_in(s, d):
    return t(s, d, "customer").join(t(s, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def anti_not_in(s, d):
    return t(s, d, "part").join(t(s, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti").select("p_partkey")


@query("SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE (l_orderkey, l_suppkey) IN (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')")
def tuple_in(s, d):
    li = t(s, d, "lineitem")
    return li.join(li.where("l_returnflag = 'R'").select("l_orderkey", "l_suppkey"), ["l_orderkey", "l_suppkey"], "left_semi").select("l_orderkey", "l_partkey").distinct()


@query("""SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)
    OR EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 9500)""")
def exists_or(s, d):
    o = t(s, d, "orders").where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("a", F.lit(True))
    n = t(s, d, "supplier").where("s_acctbal > 9500").select(F.col("s_nationkey").alias("c_nationkey")).distinct().withColumn("b", F.lit(True))
    return t(s, d, "customer").join(o, "c_custkey", "left").join(n, "c_nationkey", "left").where("a or b").select("c_custkey")


@query("""WITH o AS (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1),
    l AS (SELECT o_custkey, count(DISTINCT l_partkey) AS parts FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT c_custkey, n_name, r_name, coalesce(orders, 0)::BIGINT AS orders, spent, parts FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey""")
def star_left_join(s, d):
    o, li, c = t(s, d, "orders"), t(s, d, "lineitem"), t(s, d, "customer")
    spent = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    parts = li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_distinct("l_partkey").alias("parts"))
    out = c.join(t(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.join(spent, "c_custkey", "left").join(parts, "c_custkey", "left").select("c_custkey", "n_name", "r_name", F.coalesce("orders", F.lit(0)).alias("orders"), "spent", "parts")


@query("SELECT p_partkey, w.word FROM part LEFT JOIN LATERAL (SELECT unnest(string_split(p_name, ' ')) AS word) w ON true WHERE p_size < 5")
def lateral_unnest(s, d):
    return t(s, d, "part").where("p_size < 5").select("p_partkey", F.explode_outer(F.split("p_name", " ")).alias("word"))


@query("""SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o,
    max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS p FROM orders GROUP BY 1""")
def pivot_max_case(s, d):
    return t(s, d, "orders").groupBy("o_custkey").agg(*[F.max(F.when(F.col("o_orderstatus") == x, F.col("o_totalprice"))).alias(x.lower()) for x in "FOP"])


@query("SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_shipmode)), ',') AS modes FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS l_shipmode FROM lineitem WHERE l_quantity > 49) GROUP BY 1")
def ordered_distinct_list(s, d):
    modes = F.collect_set(F.concat("l_returnflag", "l_linestatus"))
    return t(s, d, "lineitem").where("l_quantity > 49").groupBy("l_suppkey").agg(F.array_join(F.array_sort(modes), ",").alias("modes"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' + ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def string_agg_distinct(s, d):
    return t(s, d, "orders").groupBy("o_custkey").agg(F.expr("listagg(DISTINCT o_orderpriority, ' + ') WITHIN GROUP (ORDER BY o_orderpriority)").alias("priorities"))


@query("""SELECT l_partkey, arg_min(l_orderkey, (CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END, l_extendedprice, l_orderkey, l_linenumber)) AS best,
    arg_max(l_suppkey, (l_extendedprice, l_suppkey)) AS dearest FROM lineitem GROUP BY 1""")
def arg_min_composite(s, d):
    score = F.struct(F.when(F.col("l_returnflag") == "N", 0).otherwise(1), "l_extendedprice", "l_orderkey", "l_linenumber")
    return t(s, d, "lineitem").groupBy("l_partkey").agg(F.min_by("l_orderkey", score).alias("best"), F.max_by("l_suppkey", F.struct("l_extendedprice", "l_suppkey")).alias("dearest"))


@query("SELECT l_orderkey, bool_or(l_returnflag = 'R') AS some_returned, bool_and(l_linestatus = 'F') AS all_final FROM lineitem GROUP BY 1")
def bool_rollup(s, d):
    return t(s, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("some_returned"), F.bool_and(F.col("l_linestatus") == "F").alias("all_final"))


@query("""SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(DISTINCT l_partkey) FILTER (WHERE l_discount > 0.05) AS discounted,
    round(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 2) AS open_quantity FROM lineitem GROUP BY ALL""")
def filter_aggregates(s, d):
    return t(s, d, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_distinct(F.when(F.col("l_discount") > 0.05, F.col("l_partkey"))).alias("discounted"),
        F.round(F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))), 2).alias("open_quantity"),
    )


@query("""WITH k AS (SELECT l_partkey, l_quantity, l_discount, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1, 2, 3 HAVING count(DISTINCT l_orderkey) = 1)
    SELECT l.l_orderkey, l.l_linenumber, k.l_orderkey AS found FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM lineitem WHERE l_returnflag = 'R') l JOIN k USING (l_partkey, l_quantity, l_discount)""")
def having_unique_key(s, d):
    li, key = t(s, d, "lineitem"), ["l_partkey", "l_quantity", "l_discount"]
    one = li.groupBy(*key).agg(F.min("l_orderkey").alias("found"), F.max("l_orderkey").alias("last")).where("found = last")
    return li.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", *key).distinct().join(one, key).select("l_orderkey", "l_linenumber", "found")


@query("""WITH per AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS r, bool_and(l_linestatus = 'F') AS f FROM lineitem GROUP BY 1)
    SELECT count(*) AS orders, count(*) FILTER (WHERE r) AS with_return, count(*) FILTER (WHERE f) AS final FROM per""")
def two_level_agg(s, d):
    return bool_rollup(s, d).agg(F.count(F.lit(1)).alias("orders"), F.count_if("some_returned").alias("with_return"), F.count_if("all_final").alias("final"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def latest_version(s, d):
    return E.latest(t(s, d, "events"), ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "event_type")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events
    WHERE ts <= CASE event_type WHEN 'error' THEN TIMESTAMP '2024-01-10' WHEN 'click' THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '2024-01-15' END) WHERE k = 1""")
def edition_cut(s, d):
    until = F.when(F.col("event_type") == "error", F.lit("2024-01-10")).when(F.col("event_type") == "click", F.lit("2024-01-20")).otherwise(F.lit("2024-01-15")).cast("timestamp_ntz")
    return E.cut(t(s, d, "events"), ["user_id", "event_type"], "ts", until, ["event_id"]).select("user_id", "event_type", "event_id", "value")


_CUT = "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE ts <= TIMESTAMP '{}') WHERE k = 1"


@query(f"""SELECT user_id, CASE WHEN a.event_type IS NULL THEN 'added' WHEN b.event_type IS NULL THEN 'removed' ELSE 'changed' END AS change, a.event_type AS before, b.event_type AS after
    FROM ({_CUT.format("2024-01-03")}) a FULL JOIN ({_CUT.format("2024-01-20")}) b USING (user_id) WHERE a.event_type IS DISTINCT FROM b.event_type""")
def edition_difference(s, d):
    e = t(s, d, "events")
    at = lambda day: E.cut(e, ["user_id"], "ts", F.lit(day).cast("timestamp_ntz"), ["event_id"])
    return E.difference(at("2024-01-03"), at("2024-01-20"), ["user_id"], "event_type")


@query("""WITH r AS (SELECT c_custkey, n_name AS answer, 'nation' AS method, 1 AS p FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey < 8
    UNION ALL SELECT c_custkey, r_name, 'region', 2 FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_regionkey < 3
    UNION ALL SELECT c_custkey, c_mktsegment, 'segment', 3 FROM customer)
    SELECT c_custkey, answer, method FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY p, answer) AS k FROM r) WHERE k = 1""")
def method_priority(s, d):
    c, n, r = t(s, d, "customer"), t(s, d, "nation"), t(s, d, "region")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    routes = [
        cn.where("n_nationkey < 8").select("c_custkey", F.col("n_name").alias("answer"), F.lit("nation").alias("method")),
        cn.join(r, F.col("n_regionkey") == F.col("r_regionkey")).where("r_regionkey < 3").select("c_custkey", F.col("r_name").alias("answer"), F.lit("region").alias("method")),
        c.select("c_custkey", F.col("c_mktsegment").alias("answer"), F.lit("segment").alias("method")),
    ]
    return E.first_route(routes, ["c_custkey"], ["answer"])


@query("SELECT DISTINCT o_custkey, o_orderpriority, count(*) OVER (PARTITION BY o_custkey) AS orders FROM orders WHERE o_orderstatus = 'P'")
def partition_count(s, d):
    return t(s, d, "orders").where("o_orderstatus = 'P'").select("o_custkey", "o_orderpriority", F.count(F.lit(1)).over(Window.partitionBy("o_custkey")).alias("orders")).distinct()


@query("""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('24|' || doc_id), doc_id) AS k FROM documents) WHERE k <= 3""")
def stratified_md5_sample(s, d):
    return E.stratified(t(s, d, "documents"), ["source"], ["doc_id"], 3, "24").select("source", "doc_id")


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_custkey, o_orderpriority, o_totalprice DESC, o_orderkey")
def distinct_on(s, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")
    return t(s, d, "orders").withColumn("k", F.row_number().over(w)).where("k = 1").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""(SELECT c_nationkey AS n, 'customer only' AS side FROM customer WHERE c_acctbal > 9900 EXCEPT SELECT s_nationkey, 'customer only' FROM supplier WHERE s_acctbal > 5000)
    UNION (SELECT c_nationkey, 'both' FROM customer WHERE c_acctbal > 9900 INTERSECT SELECT s_nationkey, 'both' FROM supplier WHERE s_acctbal > 5000)""")
def set_ops(s, d):
    c = t(s, d, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n"))
    p = t(s, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n"))
    return c.subtract(p).withColumn("side", F.lit("customer only")).union(c.intersect(p).withColumn("side", F.lit("both")))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k(s, d):
    return t(s, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("""SELECT c_custkey, x FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS x FROM customer) ORDER BY x NULLS LAST, c_custkey DESC LIMIT 50""")
def nulls_order(s, d):
    c = t(s, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("x"))
    return c.orderBy(F.col("x").asc_nulls_last(), F.desc("c_custkey")).limit(50)


@query("""SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def json_attrs_group(s, d):
    return t(s, d, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("""SELECT p_partkey, json_object('name', p_name, 'size', p_size, 'promo', CASE WHEN p_type = 'PROMO' THEN 1 END)::VARCHAR AS j FROM part""")
def json_build(s, d):
    j = F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.when(F.col("p_type") == "PROMO", 1).alias("promo")), {"ignoreNullFields": "false"})
    return t(s, d, "part").select("p_partkey", j.alias("j"))


@query("""SELECT c_mktsegment, string_agg(k || ':' || n, ',' ORDER BY k) AS by_nation FROM (SELECT c_mktsegment, lpad(c_nationkey::VARCHAR, 2, '0') AS k, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY 1""")
def json_group_object(s, d):
    n = t(s, d, "customer").groupBy("c_mktsegment", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("c_mktsegment").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "k", F.col("n").cast("string")))), ",").alias("by_nation"))


@query("""SELECT event_id, try_cast(CASE WHEN event_id % 3 = 0 THEN 'x' || event_id ELSE json_extract_string(props, '$.k') END AS BIGINT) AS k, coalesce(nullif(event_type, 'error'), 'none') AS kind FROM events""")
def try_cast_parse(s, d):
    e = t(s, d, "events")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.get_json_object("props", "$.k"))
    return e.select("event_id", raw.try_cast("bigint").alias("k"), F.coalesce(F.nullif("event_type", F.lit("error")), F.lit("none")).alias("kind"))


# ---------------------------------------------------------------- text and units


@query("SELECT n_name, regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS plain, regexp_replace(replace(replace(lower(n_name || ' Oesophagus (Haema)'), 'ae', 'e'), 'oe', 'e'), '[^a-z0-9]', '', 'g') AS vowels FROM nation")
def norm_alnum(s, d):
    n = F.col("n_name")
    return t(s, d, "nation").select(n, T.squash(n).alias("plain"), T.squash_vowels(F.concat(n, F.lit(" Oesophagus (Haema)"))).alias("vowels"))


@query("""SELECT p_partkey, array_to_string(list_sort(regexp_extract_all(lower(p_type || ' ' || p_name), '[a-z0-9]+')), ' ') AS bag FROM part""")
def norm_bag_of_words(s, d):
    return t(s, d, "part").select("p_partkey", T.bag_of_words(F.concat("p_type", F.lit(" "), "p_name", F.lit(" (finding)"))).alias("bag"))


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(regexp_replace(lower(p_name || ' agents X2'), '([a-z])(\\d)', '\\1 \\2', 'g'), '[a-z0-9]+'), lambda w: w <> 'agents'),
    lambda w: CASE WHEN w LIKE '%s' AND length(w) > 3 THEN w[:-2] ELSE w END))), ' ') AS k FROM part""")
def norm_class_key(s, d):
    return t(s, d, "part").select("p_partkey", T.class_key(F.concat("p_name", F.lit(" agents X2 [EPC]"))).alias("k"))


@query("""SELECT p_partkey, lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(p_name || ' Sulphate'), 'sulph', 'sulf', 'g'), 'oe', 'e', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')) AS nm FROM part""")
def norm_substance(s, d):
    return t(s, d, "part").select("p_partkey", T.substance_name(F.concat("p_name", F.lit(" Sulphate (substance)"))).alias("nm"))


@query("SELECT p_partkey, lower(p_type) AS tag, split_part(p_brand, '#', 2)::INT AS brand_no FROM part")
def regex_extract_tag(s, d):
    name = F.concat("p_name", F.lit(" ("), F.lower("p_type"), F.lit(")"))
    return t(s, d, "part").select("p_partkey", T.tag(name).alias("tag"), F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int").alias("brand_no"))


@query("SELECT word, count(*) AS n, count(DISTINCT p_partkey) AS parts FROM (SELECT p_partkey, unnest(string_split(p_name || ';' || p_type, ';')) AS word FROM part) GROUP BY 1")
def split_explode(s, d):
    w = t(s, d, "part").select("p_partkey", F.explode(F.split(F.concat_ws(";", "p_name", "p_type"), ";")).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_partkey").alias("parts"))


@query("""WITH a AS (SELECT DISTINCT p_name AS alias FROM part), b AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS brand FROM part UNION SELECT DISTINCT upper(p_name) FROM part WHERE p_size = 7 UNION SELECT DISTINCT replace(p_name, ' ', '-') FROM part WHERE p_size = 9),
    m AS (SELECT alias, brand, 1 AS k, 'exact_name' AS method FROM a JOIN b ON lower(alias) = lower(brand)
    UNION ALL SELECT alias, brand, 2, 'normalised_name' FROM a JOIN b ON regexp_replace(lower(alias), '[^a-z0-9]', '', 'g') = regexp_replace(lower(brand), '[^a-z0-9]', '', 'g')
    UNION ALL SELECT alias, brand, 3, 'prefix_name' FROM a JOIN b ON lower(alias) LIKE lower(brand) || ' %')
    SELECT alias, brand, arg_min(method, k) AS method FROM m GROUP BY 1, 2""")
def brand_alias(s, d):
    p = t(s, d, "part")
    a = p.select(F.col("p_name").alias("alias")).distinct()
    b = p.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("brand")).union(p.where("p_size = 7").select(F.upper("p_name"))).union(p.where("p_size = 9").select(F.replace("p_name", F.lit(" "), F.lit("-")))).distinct()
    exact = a.join(b, F.lower("alias") == F.lower("brand")).withColumn("method", F.lit("exact_name"))
    plain = a.join(b, T.squash(F.col("alias")) == T.squash(F.col("brand"))).withColumn("method", F.lit("normalised_name"))
    # every prefix that ends before a blank is a key, so the prefix route is an equi-join too
    words = F.split(F.lower("alias"), " ")
    heads = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    prefix = a.where(F.col("alias").contains(" ")).withColumn("head", F.explode(heads)).join(b, F.col("head") == F.lower("brand")).select("alias", "brand", F.lit("prefix_name").alias("method"))
    return E.first_route([exact, plain, prefix], ["alias", "brand"], ["method"]).select("alias", "brand", "method")


_UNIT = "CASE l_linenumber % 4 WHEN 0 THEN 'g/L' WHEN 1 THEN 'mg/dL' WHEN 2 THEN 'ug/mL' ELSE 'mmol/L' END"


@query(f"""WITH q AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, {_UNIT} AS unit FROM lineitem WHERE l_suppkey = 3),
    b AS (SELECT *, l_quantity * CASE unit WHEN 'g/L' THEN 1.0 WHEN 'mg/dL' THEN 0.01 WHEN 'ug/mL' THEN 0.001 END AS base FROM q),
    m AS (SELECT l_partkey, min(base) AS lo, max(base) AS hi, count(*) AS n, count(base) AS k FROM b GROUP BY 1)
    SELECT l_partkey, n, CASE WHEN k = 0 THEN 'no unit' WHEN k < n THEN 'kinds differ' WHEN hi = lo THEN 'equal' WHEN hi / lo <= 1.05 THEN 'near' WHEN hi / lo >= 1000 THEN 'scale' ELSE 'different' END AS verdict FROM m""")
def unit_reduce_verdict(s, d):
    unit = F.element_at(F.array(*map(F.lit, ("g/L", "mg/dL", "ug/mL", "mmol/L"))), F.col("l_linenumber") % 4 + 1)
    q = t(s, d, "lineitem").where("l_suppkey = 3").withColumn("base", F.col("l_quantity") * U.scale(unit, F.lit("g/L")))
    m = q.groupBy("l_partkey").agg(F.min("base").alias("lo"), F.max("base").alias("hi"), F.count(F.lit(1)).alias("n"), F.count("base").alias("k"))
    ratio = F.col("hi") / F.col("lo")
    verdict = F.when(F.col("k") == 0, "no unit").when(F.col("k") < F.col("n"), "kinds differ").when(F.col("hi") == F.col("lo"), "equal").when(ratio <= 1.05, "near").when(ratio >= 1000, "scale").otherwise("different")
    return m.select("l_partkey", "n", verdict.alias("verdict"))


@query("""SELECT * FROM (VALUES ('g/dL', 'g/L', 10.0::DOUBLE, 'scale'), ('/uL', '10*9/L', 0.001, 'scale'), ('%', 'L/L', 0.01, 'scale'), ('mg/dL', 'mmol/L', NULL, 'kind'), ('[IU]/L', 'U/L', 1.0, 'spelling'),
    ('mmHg', 'mm[Hg]', NULL, 'spelling'), ('mg/L;g/L', 'g/L', NULL, 'none'), ('', 'g/L', NULL, 'no US example'), ('k[IU]/L', 'kU/L', 1.0, 'spelling')) v(us, au, factor, difference), (SELECT count(*) AS nations FROM nation)""")
def unit_scale(s, d):
    rows = [("g/dL", "g/L"), ("/uL", "10*9/L"), ("%", "L/L"), ("mg/dL", "mmol/L"), ("[IU]/L", "U/L"), ("mmHg", "mm[Hg]"), ("mg/L;g/L", "g/L"), ("", "g/L"), ("k[IU]/L", "kU/L")]
    u = s.createDataFrame(rows, "us string, au string").crossJoin(t(s, d, "nation").agg(F.count(F.lit(1)).alias("nations")))
    return u.select("us", "au", U.scale(F.col("us"), F.col("au")).alias("factor"), U.difference(F.col("us"), F.col("au")).alias("difference"), "nations")


@query("""SELECT 'with null' AS kind, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END FROM orders)
    UNION ALL SELECT 'without', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)""")
def anti_not_in_null(s, d):
    """NOT IN as SQL has it: one null on the right and nothing is left."""
    c = t(s, d, "customer")
    out = None
    for kind, o in (("with null", t(s, d, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("o"))), ("without", t(s, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("o")))):
        right = o.distinct()
        nulls = right.agg(F.bool_or(F.col("o").isNull()).alias("any"))  # one row
        left = c.join(right, F.col("c_custkey") == F.col("o"), "left_anti").join(F.broadcast(nulls)).where("not coalesce(any, false)")
        row = left.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = row if out is None else out.union(row)
    return out


@query("SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def select_exclude(s, d):
    return t(s, d, "customer").drop("c_name", "c_acctbal")


@query("""SELECT c_nationkey, c_custkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 9 END, c_custkey) AS k FROM customer) WHERE k = 1""")
def dialect_row_number(s, d):
    """The first by a list of preferences, then by id."""
    place = F.coalesce(F.nullif(F.array_position(F.array(F.lit("MACHINERY"), F.lit("BUILDING")), F.col("c_mktsegment")), F.lit(0)), F.lit(9))
    best = F.min(F.struct(place.alias("place"), "c_custkey", "c_mktsegment")).alias("m")
    return t(s, d, "customer").groupBy("c_nationkey").agg(best).select("c_nationkey", "m.c_custkey", "m.c_mktsegment")

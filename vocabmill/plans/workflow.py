"""Workflow operators: resolvers, candidate families, evidence, gates, tickets, reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats as S
from ..operators import editions as E
from ..operators import names as N
from .base import SQL_EDGE, edge, t

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query("SELECT DISTINCT c_custkey, o_orderkey FROM customer JOIN orders ON o_orderkey IN (c_custkey * 2, c_custkey + 7, c_custkey * c_nationkey)")
def or_key_join(s, d):
    """A join on any of three keys: the keys are rows, so it is an equi-join."""
    c = t(s, d, "customer").select("c_custkey", F.explode(F.array_distinct(F.array(F.col("c_custkey") * 2, F.col("c_custkey") + 7, F.col("c_custkey") * F.col("c_nationkey")))).alias("o_orderkey"))
    return c.join(t(s, d, "orders").select("o_orderkey").distinct(), "o_orderkey").select("c_custkey", "o_orderkey")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = CASE WHEN l_returnflag = 'R' THEN l_partkey % 100 ELSE l_suppkey END WHERE s_acctbal > 5000 GROUP BY 1")
def conditional_key_join(s, d):
    key = F.when(F.col("l_returnflag") == "R", F.col("l_partkey") % 100).otherwise(F.col("l_suppkey"))
    good = t(s, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("k"))
    return t(s, d, "lineitem").select("l_orderkey", key.alias("k")).join(good, "k").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, json_extract_string(j, '$.k') AS k, json_extract_string(j, '$.t') AS t FROM (SELECT event_id, json_merge_patch(props::JSON, CASE WHEN event_id % 2 = 0 THEN json_object('k', 'new', 't', event_type) ELSE json_object('t', event_type) END) AS j FROM events)""")
def json_merge(s, d):
    """Attributes laid over attributes: the patch's keys win."""
    base = F.from_json("props", "map<string,string>")
    patch = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("k"), F.lit("new"), F.lit("t"), F.col("event_type"))).otherwise(F.create_map(F.lit("t"), F.col("event_type")))
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(patch, k)), patch)
    return t(s, d, "events").select("event_id", merged["k"].alias("k"), merged["t"].alias("t"))


@query("""WITH g AS (SELECT event_type, count(*) FILTER (WHERE user_id % 3 = 0 AND value > 8)::DOUBLE AS tp, count(*) FILTER (WHERE user_id % 3 = 0)::DOUBLE AS p, count(*) FILTER (WHERE user_id % 3 <> 0 AND value <= 8)::DOUBLE AS tn, count(*) FILTER (WHERE user_id % 3 <> 0)::DOUBLE AS n FROM events GROUP BY 1)
    SELECT event_type, round(tp / p, 6) AS sens, round(tn / n, 6) AS spec, round((tp / p) / (1 - tn / n), 6) AS lr_present, round((1 - tp / p) / (tn / n), 6) AS lr_absent FROM g""")
def likelihood_ratio(s, d):
    case, high = F.col("user_id") % 3 == 0, F.col("value") > 8
    g = t(s, d, "events").groupBy("event_type").agg(F.count_if(case & high).alias("tp"), F.count_if(case).alias("p"), F.count_if(~case & ~high).alias("tn"), F.count_if(~case).alias("n"))
    sens, spec = F.col("tp") / F.col("p"), F.col("tn") / F.col("n")
    return g.select("event_type", F.round(sens, 6).alias("sens"), F.round(spec, 6).alias("spec"), F.round(sens / (1 - spec), 6).alias("lr_present"), F.round((1 - sens) / spec, 6).alias("lr_absent"))


@query("""WITH x AS (SELECT c_custkey, regexp_extract_all(c_name || ' ' || c_nationkey, '[0-9]+') AS stated, regexp_extract_all(lpad(c_custkey::VARCHAR, 9, '0') || ' in ' || (c_nationkey + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END), '[0-9]+') AS source FROM customer)
    SELECT c_custkey, len(list_filter(stated, lambda v: NOT list_contains(source, v))) = 0 AS verified FROM x""")
def transcription_check(s, d):
    """Every number of a statement stands in its source."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit("[0-9]+"), 0)
    stated = numbers(F.concat_ws(" ", "c_name", F.col("c_nationkey").cast("string")))
    source = numbers(F.concat(F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit(" in "), (F.col("c_nationkey") + F.when(F.col("c_custkey") % 4 == 0, 1).otherwise(0)).cast("string")))
    return t(s, d, "customer").select("c_custkey", (F.size(F.array_except(stated, source)) == 0).alias("verified"))


@query("""WITH p AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_size % 5 > 0 THEN p_type END AS method, CASE WHEN p_partkey % 2 = 0 THEN 'mass' ELSE 'molar' END AS kind FROM part)
    SELECT a.p_partkey AS mass, b.p_partkey AS molar, round(10.0::DOUBLE / a.p_size, 6) AS factor FROM p a JOIN p b ON a.p_name = b.p_name AND a.method IS NOT DISTINCT FROM b.method WHERE a.kind = 'mass' AND b.kind = 'molar'""")
def unit_pairs(s, d):
    """Mass and molar twins agree on all axes; the method may be null on both."""
    p = t(s, d, "part").select("p_partkey", "p_name", "p_size", F.when(F.col("p_size") % 5 > 0, F.col("p_type")).alias("method"))
    a, b = p.where("p_partkey % 2 = 0").alias("a"), p.where("p_partkey % 2 = 1").alias("b")
    on = (F.col("a.p_name") == F.col("b.p_name")) & F.col("a.method").eqNullSafe(F.col("b.method"))
    return a.join(b, on).select(F.col("a.p_partkey").alias("mass"), F.col("b.p_partkey").alias("molar"), F.round(10.0 / F.col("a.p_size"), 6).alias("factor"))


@query(f"""WITH e AS ({SQL_EDGE}), m AS (SELECT predicate, o_vocab, count(*) AS n FROM e GROUP BY 1, 2)
    SELECT predicate, arg_max(o_vocab, (n, o_vocab)) AS object, CASE WHEN predicate LIKE 'in_%' THEN 'classification' WHEN regexp_matches(predicate, '(^|_)by$') THEN 'agency' ELSE 'composition' END AS category, sum(n)::BIGINT AS edges FROM m GROUP BY 1""")
def register_derivation(s, d):
    """A predicate's category from its label, its object vocabulary from most of its edges."""
    m = edge(s, d).groupBy("predicate", "o_vocab").agg(F.count(F.lit(1)).alias("n"))
    category = F.when(F.col("predicate").like("in\\_%"), "classification").when(F.col("predicate").rlike("(^|_)by$"), "agency").otherwise("composition")
    return m.groupBy("predicate").agg(F.max_by("o_vocab", F.struct("n", "o_vocab")).alias("object"), F.sum("n").alias("edges")).withColumn("category", category)


@query("""SELECT c_mktsegment AS condition, count(DISTINCT o_orderkey) AS restrictions, count(DISTINCT l_partkey) AS items FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1""")
def provenance_join(s, d):
    """Condition to restriction to item, counted along the way."""
    o = t(s, d, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    li = t(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return o.join(t(s, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").join(li, "o_orderkey").groupBy(F.col("c_mktsegment").alias("condition")).agg(F.count_distinct("o_orderkey").alias("restrictions"), F.count_distinct("l_partkey").alias("items"))


@query("""WITH g AS (SELECT d.doc_id, quality, toxic, n_chars FROM documents d LEFT JOIN labels USING (doc_id))
    SELECT CASE WHEN quality IS NULL THEN '4 pending' WHEN toxic = 1 THEN '3 refused' WHEN n_chars < 200 THEN '1 too short' WHEN quality = 0 THEN '2 not supported' ELSE '5 passed' END AS stage, count(*) AS n FROM g GROUP BY 1""")
def citation_gate(s, d):
    """Stages in order: the first that fails names the outcome; what nobody has judged is pending, never refused."""
    g = t(s, d, "documents").select("doc_id", "n_chars").join(t(s, d, "labels"), "doc_id", "left")
    stage = F.when(F.col("quality").isNull(), "4 pending").when(F.col("toxic") == 1, "3 refused").when(F.col("n_chars") < 200, "1 too short").when(F.col("quality") == 0, "2 not supported").otherwise("5 passed")
    return g.groupBy(stage.alias("stage")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT DISTINCT o_custkey AS s, l_suppkey AS o FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 40),
    g AS (SELECT c.* FROM c JOIN customer ON c_custkey = s JOIN supplier ON s_suppkey = o WHERE c_nationkey = s_nationkey),
    p AS (SELECT s, o FROM g WHERE (s, o) NOT IN (SELECT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')),
    w AS (SELECT DISTINCT o_custkey AS s, l_suppkey AS o FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_discount > 0.08),
    x AS (SELECT p.s, p.o, w.s IS NOT NULL AS second FROM p LEFT JOIN w ON w.s = p.s AND w.o = p.o)
    SELECT s, o, second FROM (SELECT *, row_number() OVER (PARTITION BY second ORDER BY md5('7|' || s || '|' || o), s, o) AS k FROM x) WHERE k <= 20""")
def candidate_family(s, d):
    """Candidates, a gate, those that are there already, a second path, and a stratified sample for a sheet."""
    li = t(s, d, "orders").join(t(s, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("s"), F.col("l_suppkey").alias("o"), "l_quantity", "l_returnflag", "l_discount")
    pair = lambda c: li.where(c).select("s", "o").distinct()
    c = pair("l_quantity > 40").join(t(s, d, "customer").select(F.col("c_custkey").alias("s"), "c_nationkey"), "s").join(t(s, d, "supplier").select(F.col("s_suppkey").alias("o"), "s_nationkey"), "o").where("c_nationkey = s_nationkey").select("s", "o")
    x = c.join(pair("l_returnflag = 'R'"), ["s", "o"], "left_anti").join(pair("l_discount > 0.08").withColumn("w", F.lit(True)), ["s", "o"], "left").select("s", "o", F.col("w").isNotNull().alias("second"))
    return E.stratified(x, ["second"], ["s", "o"], 20, "7")


@query(f"""WITH e AS ({SQL_EDGE}), x AS (SELECT s_vocab || ':' || s_code AS node, predicate, o_vocab || ':' || o_code AS other FROM e WHERE predicate <> 'contains' UNION SELECT o_vocab || ':' || o_code, '~' || predicate, s_vocab || ':' || s_code FROM e WHERE predicate <> 'contains'),
    n AS (SELECT 'CUST:' || c_custkey AS node FROM customer WHERE c_acctbal < 0)
    SELECT predicate, count(*) AS statements, count(*) FILTER (WHERE node IN (SELECT node FROM n) OR other IN (SELECT node FROM n)) AS superseded FROM x GROUP BY 1""")
def evidence_index(s, d):
    """Statements from both ends, with those that touch a retired node marked."""
    e = edge(s, d).where("predicate <> 'contains'")
    a, b = F.concat_ws(":", "s_vocab", "s_code"), F.concat_ws(":", "o_vocab", "o_code")
    x = e.select(a.alias("node"), "predicate", b.alias("other")).union(e.select(b, F.concat(F.lit("~"), "predicate"), a)).distinct()
    gone = t(s, d, "customer").where("c_acctbal < 0").select(F.concat(F.lit("CUST:"), F.col("c_custkey")).alias("node"))
    x = x.join(gone.withColumn("g1", F.lit(True)), "node", "left").join(gone.select(F.col("node").alias("other"), F.lit(True).alias("g2")), "other", "left")
    return x.groupBy("predicate").agg(F.count(F.lit(1)).alias("statements"), F.count_if(F.coalesce("g1", "g2", F.lit(False))).alias("superseded"))


@query(f"""WITH e AS ({SQL_EDGE}), r AS (SELECT * FROM (VALUES ('1', 1), ('2', 2), ('inadmissible', 3), ('ungraded', 4), ('native', 1)) v(tier, k)),
    c AS (SELECT a.s_code AS ord, greatest(ra.k, rb.k) AS k FROM e a JOIN e b ON a.predicate = 'contains' AND b.predicate = 'supplied_by' AND b.s_code = a.o_code JOIN r ra ON ra.tier = CASE WHEN a.o_code::BIGINT % 3 = 0 THEN '2' ELSE a.tier END JOIN r rb ON rb.tier = b.tier)
    SELECT ord, CASE min(k) WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN 'inadmissible' ELSE 'ungraded' END AS tier, count(*) AS chains FROM c GROUP BY 1""")
def weakest_tier(s, d):
    """A chain is as good as its weakest edge; of several chains the best counts."""
    e = edge(s, d)
    a = e.where("predicate = 'contains'").select(F.col("s_code").alias("ord"), F.col("o_code").alias("part"), F.when(F.col("o_code").cast("long") % 3 == 0, "2").otherwise(F.col("tier")).alias("ta"))
    b = e.where("predicate = 'supplied_by'").select(F.col("s_code").alias("part"), F.col("tier").alias("tb"))
    order = F.array(*map(F.lit, ("1", "2", "inadmissible", "ungraded")))
    c = a.join(b, "part").select("ord", F.array_position(order, S.weakest(F.array("ta", "tb"))).alias("k"))
    return c.groupBy("ord").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("chains")).select("ord", F.element_at(order, F.col("k").cast("int")).alias("tier"), "chains")


@query("""WITH d AS (SELECT DISTINCT p_name AS name, min(p_partkey) AS id FROM part WHERE p_size < 25 GROUP BY 1), n AS (SELECT p_partkey, unnest([p_name, 'old ' || split_part(p_name, ' ', 2), 'red ' || split_part(p_name, ' ', 2)]) AS name, unnest([1, 2, 3]) AS place FROM part)
    SELECT p_partkey, arg_min(id, place) AS found, min(place) AS place FROM n JOIN d USING (name) GROUP BY 1""")
def first_exact_hit(s, d):
    """Names in order of preference; the first that the dictionary has wins."""
    p = t(s, d, "part")
    words = p.where("p_size < 25").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    last = F.split_part("p_name", F.lit(" "), F.lit(2))
    n = p.select("p_partkey", F.posexplode(F.array("p_name", F.concat(F.lit("old "), last), F.concat(F.lit("red "), last))).alias("place", "name"))
    return n.join(words, "name").groupBy("p_partkey").agg(F.min_by("id", "place").alias("found"), (F.min("place") + 1).alias("place"))


@query("""SELECT p_partkey, trim(part) AS part FROM (SELECT p_partkey, unnest(string_split(replace(replace(p_type || ' ' || p_name || CASE p_size % 3 WHEN 0 THEN ' and ' || p_brand WHEN 1 THEN '; ' || p_brand ELSE '' END, ' and ', '|'), ';', '|'), '|')) AS part FROM part)""")
def name_split(s, d):
    """A name of several entities taken apart at its joints."""
    joint = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" and "), "p_brand")).when(F.col("p_size") % 3 == 1, F.concat(F.lit("; "), "p_brand")).otherwise("")
    return t(s, d, "part").select("p_partkey", F.explode(F.split(F.concat("p_type", F.lit(" "), "p_name", joint), " and |;")).alias("part")).select("p_partkey", F.trim("part").alias("part"))


@query("""SELECT CASE WHEN regexp_matches(lower(p_name), '^(red|blue)') THEN 'colour' WHEN regexp_matches(lower(p_name), 'bolt|gear$') AND p_size < 20 THEN 'small metal' WHEN regexp_matches(p_brand, '#(1|2)$') THEN 'house brand' ELSE 'keep' END AS bucket, count(*) AS n FROM part GROUP BY 1""")
def bucket_classifier(s, d):
    low = F.lower("p_name")
    b = F.when(low.rlike("^(red|blue)"), "colour").when(low.rlike("bolt|gear$") & (F.col("p_size") < 20), "small metal").when(F.col("p_brand").rlike("#(1|2)$"), "house brand").otherwise("keep")
    return t(s, d, "part").groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, sha256('{"name":"' || c_name || '","nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}') AS ticket FROM customer""")
def content_ticket(s, d):
    """A record's address is the hash of its canonical JSON: keys in order, no blanks."""
    j = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")))
    return t(s, d, "customer").select("c_custkey", F.sha2(j, 256).alias("ticket"))


@query("""WITH a AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS ok FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
    SELECT source, n, ok, row_number() OVER (ORDER BY ok / n, source) AS place FROM a WHERE ok / n < 0.5""")
def underverified(s, d):
    """Sources of which less than half is verified, worst first (one row a source)."""
    a = t(s, d, "documents").join(t(s, d, "labels"), "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("ok"))
    share = F.col("ok") / F.col("n")
    return a.where(share < 0.5).withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(share, "source")))


@query("""WITH a AS (SELECT l_orderkey AS cui, CASE l_linestatus WHEN 'O' THEN 'A' ELSE 'B' END AS v, l_partkey AS code, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey),
    b AS (SELECT DISTINCT cui, v, code, array_to_string(list_sort(string_split(name, ' ')), ' ') AS n FROM a)
    SELECT x.cui, x.code AS sc, y.code AS oc, bool_or(x.n = y.n) AS same_name FROM b x JOIN b y ON x.cui = y.cui AND x.v < y.v GROUP BY 1, 2, 3""")
def shared_concept_pairs(s, d):
    """Codes of two vocabularies in one concept, and whether they share a name as a bag of words."""
    a = t(s, d, "lineitem").join(t(s, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    b = a.select(F.col("l_orderkey").alias("cui"), F.when(F.col("l_linestatus") == "O", "A").otherwise("B").alias("v"), F.col("l_partkey").alias("code"), F.array_join(F.array_sort(F.split("p_name", " ")), " ").alias("n")).distinct()
    x, y = b.where("v = 'A'").select("cui", F.col("code").alias("sc"), F.col("n").alias("n1")), b.where("v = 'B'").select("cui", F.col("code").alias("oc"), F.col("n").alias("n2"))
    return x.join(y, "cui").groupBy("cui", "sc", "oc").agg(F.bool_or(F.col("n1") == F.col("n2")).alias("same_name"))


@query("""WITH o AS (SELECT o_custkey, count(*) AS groups, bool_or(o_orderpriority LIKE '1%') AS conditional FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders) GROUP BY 1)
    SELECT o_custkey, n_name FROM o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE groups = 1 AND NOT conditional""")
def single_group_chain(s, d):
    """Chained only where a source has one group, and that one without a condition."""
    o = t(s, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()
    one = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("groups"), F.bool_or(F.col("o_orderpriority").like("1%")).alias("conditional")).where("groups = 1 and not conditional")
    return one.join(t(s, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(t(s, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("o_custkey", "n_name")


@query(r"""WITH k AS (SELECT run, min(name_id) AS name_id, len(string_split(run, ' ')) AS words FROM (SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS run, p_partkey AS name_id FROM part
        UNION ALL SELECT trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')), p_partkey FROM part) WHERE run <> '' GROUP BY 1),
    a AS (SELECT DISTINCT p_partkey AS id, trim(regexp_replace(lower(CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'new ' || p_type || ' (' || p_name || ')' END), '[^a-z0-9]+', ' ', 'g')) AS whole FROM part),
    m AS (SELECT id, name_id, run, words, run <> whole AS other FROM a JOIN k ON contains(' ' || whole || ' ', ' ' || run || ' '))
    SELECT id, name_id, CASE WHEN other THEN 'contains' ELSE 'exact' END AS how FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY other, words DESC, run) = 1""")
def longest_name_inside(s, d):
    """The longest known name that stands in a text as whole words."""
    p = t(s, d, "part")
    names = p.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("name_id")).union(p.select("p_type", "p_partkey"))
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat(F.lit("new "), "p_type", F.lit(" ("), "p_name", F.lit(")")))
    return N.longest_contained(p.select(F.col("p_partkey").alias("id"), text.alias("text")), names, 6)

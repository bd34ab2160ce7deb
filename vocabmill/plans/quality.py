"""Statistics, agreement, concept-model rules, completeness, guards and review queues."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats as S
from ..operators import hierarchy as H
from ..operators import quality as Q
from ..operators.edges import balance
from ..operators.storage import stored
from .base import SQL_EDGE, SQL_TREE, edge, isa_tree, t, kept, loaders

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _wilson(k: str, n: str, side: str = "lo") -> str:
    z = 1.96
    mid, half = f"({k} / {n} + {z * z} / (2 * {n}))", f"{z} * sqrt({k} / {n} * (1 - {k} / {n}) / {n} + {z * z} / (4.0 * {n} * {n}))"
    x = f"({mid} {'-' if side == 'lo' else '+'} {half}) / (1 + {z * z} / {n})"
    return f"CASE WHEN {n} = 0 THEN 0.0::DOUBLE ELSE {'greatest(0.0::DOUBLE, ' if side == 'lo' else 'least(1.0::DOUBLE, '}{x}) END"


def _tier(lo: str, n: str) -> str:
    return f"CASE WHEN {n} < 30 THEN 'ungraded' WHEN {lo} >= 0.99 THEN '1' WHEN {lo} >= 0.8 THEN '2' ELSE 'inadmissible' END"


@query(f"""WITH g AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (WHERE quality = 1)::DOUBLE AS good FROM documents JOIN labels USING (doc_id) GROUP BY 1)
    SELECT source, n::BIGINT AS n, good::BIGINT AS good, round({_wilson("good", "n")}, 4) AS wilson_lo, round({_wilson("good", "n", "hi")}, 4) AS wilson_hi, {_tier(_wilson("good", "n"), "n")} AS tier FROM g""")
def wilson_tiers(s, d):
    sheet = t(s, d, "documents").select("doc_id", "source").join(t(s, d, "labels").select("doc_id", F.col("quality").alias("verdict")), "doc_id")
    return Q.graded(sheet, ["source"])


@query(f"""WITH RECURSIVE e AS ({SQL_TREE}), u(start, node) AS (SELECT c_custkey, c_custkey FROM customer UNION SELECT u.start, e.parent FROM u JOIN e ON e.child = u.node),
    p AS (SELECT DISTINCT o_orderkey % 997 AS route_id, o_custkey AS a, (o_custkey * 7 + o_orderkey % 3) // 70 AS b FROM orders),
    per AS (SELECT route_id, bool_or(a = b) AS exact, bool_or(EXISTS (SELECT 1 FROM u WHERE start = a AND node = b) OR EXISTS (SELECT 1 FROM u WHERE start = b AND node = a)) AS consistent FROM p GROUP BY 1),
    x AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE exact) AS exact, count(*) FILTER (WHERE consistent) AS k FROM per)
    SELECT n::BIGINT AS n, exact, k AS consistent, n::BIGINT - k AS contradicted, round({_wilson("k", "n")}, 4) AS wilson_lo, {_tier(_wilson("k", "n"), "n")} AS earned_tier FROM x""")
def route_agreement(s, d):
    p = t(s, d, "orders").select((F.col("o_orderkey") % 997).alias("route_id"), F.col("o_custkey").alias("a"), F.expr("(o_custkey * 7 + o_orderkey % 3) div 70").alias("b")).distinct()
    return Q.agreement(p, isa_tree(s, d))


@query(f"""WITH truth AS (SELECT c_custkey AS subject, c_nationkey AS gold FROM customer), a AS (SELECT o_custkey AS subject, min(s_nationkey) AS pred FROM orders JOIN supplier ON s_suppkey = o_custkey % 20 GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 3),
    h AS (SELECT count(*)::DOUBLE AS fired, count(*) FILTER (WHERE pred = gold)::DOUBLE AS correct FROM a LEFT JOIN truth USING (subject)),
    z AS (SELECT count(*)::DOUBLE AS n, count(DISTINCT gold)::DOUBLE AS g FROM truth),
    x AS (SELECT coalesce(sum(i * j), 0)::DOUBLE AS met FROM (SELECT pred, count(*) AS i FROM a GROUP BY 1) JOIN (SELECT gold, count(*) AS j FROM truth GROUP BY 1) ON pred = gold),
    v AS (SELECT *, correct / n AS m, greatest(met / greatest(1, fired * n), 1 / greatest(1, g)) AS u FROM h, z, x)
    SELECT fired::BIGINT AS fired, correct::BIGINT AS correct, round(fired / n, 4) AS coverage, round(correct / fired, 4) AS precision, round({_wilson("correct", "fired")}, 4) AS wilson_lo, round(m, 6) AS m, round(u, 8) AS u, round(ln(m / u), 3) AS weight, {_tier(_wilson("correct", "fired"), "fired")} AS tier FROM v""")
def route_score(s, d):
    o, p = t(s, d, "orders"), t(s, d, "supplier")
    a = o.join(p, F.col("s_suppkey") == F.col("o_custkey") % 20).groupBy(F.col("o_custkey").alias("subject")).agg(F.min("s_nationkey").alias("pred"), F.count_distinct("o_orderstatus").alias("k")).where("k = 3").drop("k")
    return Q.route_score(a, t(s, d, "customer").select(F.col("c_custkey").alias("subject"), F.col("c_nationkey").alias("gold")))


_EVIDENCE = "SELECT event_type, count(*) FILTER (WHERE value > 10) AS tm, count(*) AS tt, count(*) FILTER (WHERE value > 20) AS cm, count(*) + 100 AS ct FROM events GROUP BY 1"


@query(f"""WITH e AS ({_EVIDENCE}), w AS (SELECT event_type, (tm + 0.5) / (tt + 1) AS m, (cm + 0.5) / (ct + 1) AS u FROM e)
    SELECT event_type, round(ln(m / u), 6) AS agree, round(ln((1 - m) / (1 - u)), 6) AS disagree, round(1 / (1 + exp(-ln(m / u))), 6) AS posterior FROM w""")
def evidence_weight(s, d):
    e = t(s, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 10).alias("tm"), F.count(F.lit(1)).alias("tt"), F.count_if(F.col("value") > 20).alias("cm"))
    w = lambda hit: S.match_weight(F.col("tm"), F.col("tt"), F.col("cm"), F.col("tt") + 100, F.lit(hit))
    return e.select("event_type", F.round(w(True), 6).alias("agree"), F.round(w(False), 6).alias("disagree"), F.round(S.posterior(w(True)), 6).alias("posterior"))


@query("""WITH p AS (SELECT source, least(greatest(n_chars / 5000.0, 0.05), 0.95)::DOUBLE AS p, quality AS o FROM documents JOIN labels USING (doc_id))
    SELECT source, round(avg((p - o) * (p - o)), 8) AS brier, round(avg(-(o * ln(p) + (1 - o) * ln(1 - p))), 8) AS log_loss FROM p GROUP BY 1""")
def brier_logloss(s, d):
    p = t(s, d, "documents").join(t(s, d, "labels"), "doc_id").select("source", F.least(F.greatest(F.col("n_chars") / 5000.0, F.lit(0.05)), F.lit(0.95)).alias("p"), F.col("quality").alias("o"))
    return p.groupBy("source").agg(F.round(S.brier(F.col("p"), F.col("o")), 8).alias("brier"), F.round(S.log_loss(F.col("p"), F.col("o")), 8).alias("log_loss"))


@query("""WITH a AS (SELECT l_orderkey, l_partkey, list_sort(list(DISTINCT l_suppkey)) AS x FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2), b AS (SELECT l_orderkey, l_partkey, list_sort(list(DISTINCT l_suppkey)) AS y FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2)
    SELECT count(*) AS both, count(*) FILTER (WHERE x = y) AS same, count(*) FILTER (WHERE x <> y AND len(list_intersect(x, y)) > 0) AS overlap, count(*) FILTER (WHERE len(list_intersect(x, y)) = 0) AS apart FROM (SELECT l_orderkey // 8 AS k, list_sort(list_distinct(flatten(list(x)))) AS x FROM a GROUP BY 1) JOIN (SELECT l_orderkey // 8 AS k, list_sort(list_distinct(flatten(list(y)))) AS y FROM b GROUP BY 1) USING (k)""")
def parallel_disagreement(s, d):
    li = t(s, d, "lineitem").withColumn("k", F.expr("l_orderkey div 8"))
    side = lambda c, name: li.where(c).groupBy("k").agg(F.array_sort(F.collect_set("l_suppkey")).alias(name))
    both = side("l_returnflag = 'N'", "x").join(side("l_returnflag <> 'N'", "y"), "k")
    meet = F.arrays_overlap("x", "y")
    return both.agg(F.count(F.lit(1)).alias("both"), F.count_if(F.col("x") == F.col("y")).alias("same"), F.count_if((F.col("x") != F.col("y")) & meet).alias("overlap"), F.count_if(~meet).alias("apart"))


@query("""WITH c AS (SELECT l_orderkey, lpad((l_partkey * 37 % 100000)::VARCHAR, 5, '0') AS a, lpad(((l_partkey * 37 + CASE WHEN l_quantity > 40 THEN 1 WHEN l_quantity > 30 THEN 10 WHEN l_quantity > 20 THEN 1000 ELSE 0 END) % 100000)::VARCHAR, 5, '0') AS b FROM lineitem)
    SELECT l_orderkey, bool_or(a = b) AS fifth, bool_or(a[:4] = b[:4]) AS fourth, bool_or(a[:3] = b[:3]) AS third FROM c GROUP BY 1""")
def prefix_level_agreement(s, d):
    k = F.col("l_partkey") * 37
    code = lambda x: F.lpad((x % 100000).cast("string"), 5, "0")
    moved = k + F.when(F.col("l_quantity") > 40, 1).when(F.col("l_quantity") > 30, 10).when(F.col("l_quantity") > 20, 1000).otherwise(0)
    c = t(s, d, "lineitem").select("l_orderkey", code(k).alias("a"), code(moved).alias("b"))
    same = lambda n: F.bool_or(F.substring("a", 1, n) == F.substring("b", 1, n))
    return c.groupBy("l_orderkey").agg(same(5).alias("fifth"), same(4).alias("fourth"), same(3).alias("third"))


@query("""SELECT count(DISTINCT c_custkey) AS customers, count(DISTINCT o_custkey) AS with_order, count(DISTINCT CASE WHEN l_orderkey IS NOT NULL THEN o_custkey END) AS with_line, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN o_custkey END) AS with_return
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def coverage_funnel(s, d):
    # flags are folded to one row an order, then one a customer, before anything is joined
    li = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("r"))
    o = t(s, d, "orders").join(li, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("r").isNotNull()).alias("line"), F.bool_or(F.coalesce("r", F.lit(False))).alias("ret"))
    c = t(s, d, "customer").select("c_custkey").distinct().join(o, "c_custkey", "left")
    return c.agg(F.count(F.lit(1)).alias("customers"), F.count("line").alias("with_order"), F.count_if("line").alias("with_line"), F.count_if("ret").alias("with_return"))


@query(f"SELECT tier, state, source, count(*) AS edges, count(DISTINCT o_vocab || o_code) AS objects FROM ({SQL_EDGE}) GROUP BY ALL")
def graph_health(s, d):
    return edge(s, d).groupBy("tier", "state", "source").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("o_vocab", "o_code").alias("objects"))


@query("""WITH i AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linestatus = 'O'), f AS (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT i.l_partkey, count(DISTINCT f.l_suppkey) AS found FROM i JOIN f USING (l_orderkey) GROUP BY 1 HAVING count(DISTINCT f.l_suppkey) > 1""")
def role_group_pairs(s, d):
    """Attributes of one concept that share a role group."""
    li = t(s, d, "lineitem")
    i, f = li.where("l_linestatus = 'O'").select("l_orderkey", "l_partkey"), li.where("l_returnflag = 'R'").select("l_orderkey", "l_suppkey")
    return i.distinct().join(f.distinct(), "l_orderkey").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("found")).where("found > 1")


@query(f"""WITH RECURSIVE e AS ({SQL_TREE}), u(start, node) AS (SELECT child, parent FROM e UNION SELECT u.start, e.parent FROM u JOIN e ON e.child = u.node), k AS (SELECT c_custkey AS id, c_mktsegment AS k FROM customer WHERE c_acctbal > 4000)
    SELECT id, k FROM k WHERE NOT EXISTS (SELECT 1 FROM u JOIN k x ON x.id = u.node WHERE u.start = k.id AND x.k = k.k)""")
def remove_refined(s, d):
    """Targets without a broader target of the same kind."""
    k = t(s, d, "customer").where("c_acctbal > 4000").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("k"))
    up = H.ancestors(k.select(F.col("id").alias("start")), isa_tree(s, d), include_self=False).select(F.col("start").alias("id"), "node")
    finer = k.join(up, "id").join(k.select(F.col("id").alias("node"), F.col("k").alias("k2")), "node").where("k = k2").select("id").distinct()
    return k.join(finer, "id", "left_anti")


@query("""WITH m AS (SELECT l_suppkey AS salt, l_partkey % 50 AS base, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT salt, sum(n) AS total, max(n) AS top, count(*) AS bases FROM m GROUP BY 1)
    SELECT salt, total::BIGINT AS total, top, CASE WHEN bases = 1 THEN 'single' WHEN top >= 0.05 * total THEN 'converges' ELSE 'scattered' END AS verdict FROM t""")
def salt_base(s, d):
    m = t(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("salt"), (F.col("l_partkey") % 50).alias("base")).agg(F.count(F.lit(1)).alias("n"))
    v = F.when(F.col("bases") == 1, "single").when(F.col("top") >= 0.05 * F.col("total"), "converges").otherwise("scattered")
    return m.groupBy("salt").agg(F.sum("n").alias("total"), F.max("n").alias("top"), F.count(F.lit(1)).alias("bases")).select("salt", "total", "top", v.alias("verdict"))


@query("""SELECT count(*) AS n_hard, count(o) AS hard_fired, round(1 - count(o) / count(*), 4) AS hard_silence
    FROM (SELECT c_custkey, (SELECT min(o_custkey) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS o FROM customer WHERE c_acctbal < 0)""")
def hard_silence(s, d):
    answers = t(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("subject"))
    return Q.hard_silence(answers, t(s, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("subject")))


_BALANCED = [("customer in nation", "c_custkey, c_nationkey", "customer", "c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE'"), ("order contains part", "l_orderkey, l_partkey", "lineitem", "l_returnflag <> 'R'")]


@query(" UNION ALL ".join(f"""SELECT '{name}' AS loader, available, available - kept AS excluded, loaded, CASE WHEN kept > loaded THEN 'collapsed' WHEN kept < loaded THEN 'fanned out' ELSE 'none' END AS residual, abs(kept - loaded) AS rows
    FROM (SELECT count(*) AS available, count(*) FILTER (WHERE {keep}) AS kept, count(DISTINCT ({key})) FILTER (WHERE {keep}) AS loaded FROM {table})""" for name, key, table, keep in _BALANCED))
def ledger_balance(s, d):
    return balance([x for x in loaders(s, d) if x.name in [b[0] for b in _BALANCED]])


# ---------------------------------------------------------------- concept model

_USES = "SELECT o_custkey AS s, 1 + o_orderkey % 4 AS a, (o_custkey * 3 + o_orderkey) % 1500 AS o, o_orderkey % 3 AS grp FROM orders"
_RULES = "(VALUES (1, 10, true, 0, NULL, 1, false), (1, 20, false, 0, 2, 1, false), (2, 10, true, 1, 3, NULL, true), (3, 20, true, 0, 1, 1, false)) v(a, domain, grouped, card_lo, card_hi, gcard_hi, mandatory)"


def _model(s, d):
    """Uses of attributes 1 to 4 (4 is in no rule), domains 10 (below 2) and 20 (below 3, or members of set 9), ranges of 1 and 2."""
    o = t(s, d, "orders")
    uses = o.select(F.col("o_custkey").alias("s"), (1 + F.col("o_orderkey") % 4).cast("int").alias("a"), ((F.col("o_custkey") * 3 + F.col("o_orderkey")) % 1500).alias("o"), (F.col("o_orderkey") % 3).alias("grp"))
    rules = s.createDataFrame([(1, 10, True, 0, None, 1, False), (1, 20, False, 0, 2, 1, False), (2, 10, True, 1, 3, None, True), (3, 20, True, 0, 1, 1, False)], "a int, domain int, grouped boolean, card_lo int, card_hi int, gcard_hi int, mandatory boolean")
    closure = kept(s, d, "tree closure", lambda: stored(H.closure(isa_tree(s, d)), "closure"))
    members = t(s, d, "customer").where("c_mktsegment = 'MACHINERY'").select(F.lit(9).cast("long").alias("refset"), F.col("c_custkey").alias("id"))
    flat = lambda key, text: [(key, op, focus) for op, focus in Q.terms(text)]
    domain = s.createDataFrame(flat(10, "<< 2 |two|") + flat(20, "< 3 OR ^ 9"), "key int, op string, focus bigint")
    ranges = s.createDataFrame(flat(1, "<< 1") + flat(2, "(<< 4 OR 7)"), "key int, op string, focus bigint")
    subjects = uses.select(F.col("s").alias("id")).union(t(s, d, "customer").select("c_custkey"))
    in_domain = Q.satisfied(subjects, domain, closure, members)
    ok = Q.satisfied(uses.select(F.col("o").alias("id")), ranges, closure, members).select(F.col("key").alias("a"), F.col("id").alias("o"))
    return uses, rules, uses.join(ok, ["a", "o"], "left_semi"), ranges.select(F.col("key").alias("a")), in_domain


_MODEL = f"""WITH RECURSIVE e AS ({SQL_TREE}), r(a, x) AS (SELECT parent, child FROM e UNION SELECT e.parent, r.x FROM r JOIN e ON e.child = r.a), uses AS ({_USES}), rules AS (SELECT * FROM {_RULES}),
    dom AS (SELECT 10 AS domain, x AS s FROM r WHERE a = 2 UNION SELECT 10, 2 UNION SELECT 20, x FROM r WHERE a = 3 UNION SELECT 20, c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
    ind AS (SELECT * FROM dom), ok AS (SELECT 1 AS a, x AS o FROM r WHERE a = 1 UNION SELECT 1, 1 UNION SELECT 2, x FROM r WHERE a = 4 UNION SELECT 2, 4 UNION SELECT 2, 7),
    gov AS (SELECT s, a, bool_or(grouped) AS mg, bool_or(NOT grouped) AS mu, CASE WHEN bool_or(card_hi IS NULL) THEN NULL ELSE max(card_hi) END AS hi, CASE WHEN bool_or(gcard_hi IS NULL) THEN NULL ELSE max(gcard_hi) END AS ghi FROM (SELECT DISTINCT s, a FROM uses) JOIN rules USING (a) JOIN ind USING (domain, s) GROUP BY 1, 2) """


def _model_query(cls: str, sql: str, name: str):
    def run(s, d):
        return Q.model_violations(*_model(s, d)).where(F.col("class").isin(cls.split("|"))).select("class", F.col("a").cast("int").alias("a"), "n")

    run.__name__ = name
    query(_MODEL + sql)(run)


_model_query("attribute|domain", """SELECT 'attribute' AS class, a::INT AS a, count(*) AS n FROM uses WHERE a NOT IN (SELECT a FROM rules) GROUP BY 2
    UNION ALL SELECT 'domain', a::INT, count(*) FROM uses u WHERE a IN (SELECT a FROM rules) AND NOT EXISTS (SELECT 1 FROM rules JOIN ind USING (domain) WHERE rules.a = u.a AND ind.s = u.s) GROUP BY 2""", "mrcm_domain")
_model_query("range", "SELECT 'range' AS class, a::INT AS a, count(*) AS n FROM uses u WHERE a IN (1, 2) AND NOT EXISTS (SELECT 1 FROM ok WHERE ok.a = u.a AND ok.o = u.o) GROUP BY 2", "mrcm_range")
_model_query("grouping", "SELECT 'grouping' AS class, a::INT AS a, count(*) AS n FROM uses JOIN gov USING (s, a) WHERE (grp = 0 AND NOT mu) OR (grp <> 0 AND NOT mg) GROUP BY 2", "mrcm_grouping")
_model_query("cardinality|group cardinality", """SELECT 'cardinality' AS class, a::INT AS a, count(*) AS n FROM (SELECT s, a FROM uses JOIN gov USING (s, a) GROUP BY 1, 2 HAVING max(hi) IS NOT NULL AND count(*) > max(hi)) GROUP BY 2
    UNION ALL SELECT 'group cardinality', a::INT, count(*) FROM (SELECT s, a, grp FROM uses JOIN gov USING (s, a) WHERE grp <> 0 GROUP BY 1, 2, 3 HAVING max(ghi) IS NOT NULL AND count(*) > max(ghi)) GROUP BY 2""", "mrcm_cardinality")
_model_query("mandatory", "SELECT 'mandatory' AS class, 2 AS a, count(*) AS n FROM ind WHERE domain = 10 AND s NOT IN (SELECT s FROM uses WHERE a = 2)", "mrcm_mandatory")


@query("""WITH v AS (SELECT p_partkey AS s, 1 + p_size % 3 AS a, CASE p_size % 4 WHEN 0 THEN 'string' WHEN 1 THEN 'decimal' ELSE 'integer' END AS datatype, CASE WHEN p_size % 4 > 0 THEN p_size / 1.0::DOUBLE END AS value FROM part)
    SELECT a::INT AS a, datatype, count(*) AS n FROM v WHERE (a = 1 AND datatype IN ('integer', 'decimal') AND value > 10) OR (a = 2 AND datatype = 'integer' AND value >= 5 AND value <= 30) OR (a = 3 AND datatype = 'string') GROUP BY 1, 2""")
def mrcm_concrete(s, d):
    kind = F.when(F.col("p_size") % 4 == 0, "string").when(F.col("p_size") % 4 == 1, "decimal").otherwise("integer")
    v = t(s, d, "part").select(F.col("p_partkey").alias("s"), (1 + F.col("p_size") % 3).alias("a"), kind.alias("datatype"), F.when(F.col("p_size") % 4 > 0, F.col("p_size") / 1.0).alias("value"))
    ranges = [(a, *Q.concrete_range(x)) for a, x in ((1, "dec(>#10..)"), (2, "int(#5..#30)"), (3, 'str("*")'))]
    return Q.in_range(v, s.createDataFrame(ranges, "a int, typ string, lo double, lo_x boolean, hi double, hi_x boolean")).groupBy("a", "datatype").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- completeness, guards, queues

_MOVES = f"""SELECT s_vocab || ':' || s_code AS f, o_vocab || ':' || o_code AS x, 'id' AS kind FROM ({SQL_EDGE}) WHERE predicate = 'placed_by'
    UNION SELECT s_vocab || ':' || s_code, o_vocab || ':' || o_code, 'cls' FROM ({SQL_EDGE}) WHERE predicate IN ('in_nation', 'in_region')"""


@query(f"""WITH mv AS ({_MOVES}), m AS (SELECT 'ORDER:' || o_orderkey AS k FROM orders WHERE o_orderkey % 10 = 1), a AS (SELECT m.k, mv.x, kind FROM m JOIN mv ON mv.f = m.k),
    b AS (SELECT a.k, mv.x FROM a JOIN mv ON mv.f = a.x WHERE mv.kind = 'cls'), c AS (SELECT b.k, mv.x FROM b JOIN mv ON mv.f = b.x WHERE mv.kind = 'cls'),
    h AS (SELECT count(*)::DOUBLE AS n, (SELECT count(DISTINCT k) FROM c WHERE x LIKE 'REGION:%')::DOUBLE AS k FROM m)
    SELECT n::BIGINT AS members, k::BIGINT AS reached, round(k / n, 4) AS share, round({_wilson("k", "n")}, 3) AS wilson_lo FROM h""")
def completeness_cell(s, d):
    move = lambda ps, kind: H.steps(edge(s, d), ps, keep_inadmissible=False).select("source", "target", F.lit(kind).alias("kind"))
    m = t(s, d, "orders").where("o_orderkey % 10 = 1").select(F.concat(F.lit("ORDER:"), F.col("o_orderkey")).alias("member"))
    return Q.completeness(m, move(["placed_by"], "id").union(move(["in_nation", "in_region"], "cls")), 3, F.col("node").startswith("REGION:"))


@query("""WITH b AS (SELECT 'edges' AS kind, event_type AS family, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'edges', 'old', 5 UNION ALL SELECT 'conflicts', 'C', 40), c AS (SELECT 'edges' AS kind, event_type AS family, count(*) + CASE event_type WHEN 'click' THEN -200 WHEN 'view' THEN 5000 ELSE -3 END AS n FROM events WHERE event_type <> 'error' GROUP BY 2 UNION ALL SELECT 'edges', 'brand new', 7 UNION ALL SELECT 'conflicts', 'C', 60)
    SELECT * FROM (SELECT kind, family, b.n AS was, c.n AS "is", CASE WHEN kind = 'conflicts' THEN CASE WHEN coalesce(c.n, 0) - coalesce(b.n, 0) > greatest(5, 0.05 * coalesce(b.n, 0)) THEN 'fail: rose' END WHEN b.n IS NULL THEN 'warn: new' WHEN b.n > 0 AND coalesce(c.n, 0) = 0 THEN 'fail: vanished'
    WHEN b.n - c.n > greatest(10, 0.01 * b.n) THEN 'fail: shrank' WHEN c.n - b.n > greatest(1000, 0.25 * b.n) THEN 'warn: grew' END AS verdict FROM b FULL JOIN c USING (kind, family)) WHERE verdict IS NOT NULL""")
def guard_compare(s, d):
    n = t(s, d, "events").groupBy(F.lit("edges").alias("kind"), F.col("event_type").alias("family")).agg(F.count(F.lit(1)).alias("n"))
    more = lambda rows: s.createDataFrame(rows, "kind string, family string, n bigint")
    moved = F.when(F.col("family") == "click", -200).when(F.col("family") == "view", 5000).otherwise(-3)
    now = n.where("family <> 'error'").withColumn("n", F.col("n") + moved).union(more([("edges", "brand new", 7), ("conflicts", "C", 60)]))
    return Q.guard(n.union(more([("edges", "old", 5), ("conflicts", "C", 40)])), now)


@query("""WITH x AS (SELECT o_custkey AS c_custkey, CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment ELSE 'MOVED' END AS expected, o_orderpriority AS decision, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey DESC) AS k FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 400000)
    SELECT c.c_custkey, CASE WHEN x.decision IS NULL THEN 'none' WHEN x.expected = c.c_mktsegment THEN 'applied' ELSE 'stale' END AS overlay, CASE WHEN x.expected = c.c_mktsegment THEN x.decision ELSE c.c_mktsegment END AS c_mktsegment FROM customer c LEFT JOIN (SELECT * FROM x WHERE k = 1) x USING (c_custkey)""")
def decision_overlay(s, d):
    from ..operators.editions import latest

    c, o = t(s, d, "customer").select("c_custkey", "c_mktsegment"), t(s, d, "orders").where("o_totalprice > 400000")
    x = latest(o, ["o_custkey"], "o_orderdate", ["o_orderpriority", "o_orderkey"]).join(c, F.col("o_custkey") == F.col("c_custkey"))
    x = x.select("c_custkey", F.col("o_orderdate").alias("decided_on"), F.when(F.col("o_orderkey") % 2 == 0, F.col("c_mktsegment")).otherwise("MOVED").alias("expected"), F.col("o_orderpriority").alias("decision"))
    return Q.overlay(c, x, ["c_custkey"], "c_mktsegment").select("c_custkey", "overlay", "c_mktsegment")


@query("""WITH q AS (SELECT c_mktsegment || '/' || c_nationkey AS item, count(*) AS blocked FROM customer GROUP BY 1), r AS (SELECT item, blocked, sum(blocked) OVER (ORDER BY blocked DESC, item ROWS UNBOUNDED PRECEDING)::BIGINT AS upto, sum(blocked) OVER () AS total FROM q)
    SELECT item, blocked, upto, CASE WHEN upto <= 0.5 * total THEN 'first half' WHEN upto <= 0.8 * total THEN 'to 80 %' ELSE 'rest' END AS band FROM r""")
def queue_cumulative(s, d):
    # the queue has an entry a segment and nation (125 at any size), so one ordered window suffices
    q = t(s, d, "customer").groupBy(F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("item")).agg(F.count(F.lit(1)).alias("blocked"))
    upto = F.sum("blocked").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("blocked"), "item").rowsBetween(Window.unboundedPreceding, 0))
    r = q.select("item", "blocked", upto.alias("upto"), F.sum("blocked").over(Window.partitionBy(F.lit(0))).alias("total"))
    band = F.when(F.col("upto") <= 0.5 * F.col("total"), "first half").when(F.col("upto") <= 0.8 * F.col("total"), "to 80 %").otherwise("rest")
    return r.select("item", "blocked", "upto", band.alias("band"))

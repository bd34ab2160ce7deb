"""Graph queries: building and checking edges, hierarchies, walks, components, the constraint language."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components as C
from ..operators import ecl as L
from ..operators import edges as G
from ..operators import hierarchy as H
from ..operators.storage import stored
from .base import SQL_EDGE, SQL_POLY, SQL_RING, SQL_TREE, edge, isa_poly, isa_tree, loaders, ring, t, kept

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"SELECT predicate, s_vocab, o_vocab, tier, count(*) AS edges, count(DISTINCT s_code) AS subjects FROM ({SQL_EDGE}) GROUP BY ALL")
def edges_build(s, d):
    return edge(s, d).groupBy("predicate", "s_vocab", "o_vocab", "tier").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("s_code").alias("subjects"))


@query(f"""SELECT 'object vocabulary not allowed' AS rule, predicate, count(*) AS edges FROM ({SQL_EDGE}) WHERE predicate = 'contains' GROUP BY ALL
    UNION ALL SELECT 'predicate not in the register', predicate, count(*) FROM ({SQL_EDGE}) WHERE predicate = 'in_region' GROUP BY ALL
    UNION ALL SELECT 'subject vocabulary not allowed', predicate, count(*) FROM ({SQL_EDGE}) WHERE predicate = 'in_nation' AND s_vocab = 'SUPP' GROUP BY ALL
    UNION ALL SELECT 'predicate is retired', predicate, count(*) FROM ({SQL_EDGE}) WHERE predicate = 'placed_by' GROUP BY ALL""")
def register_violations(s, d):
    rows = [("in_nation", ["CUST"], ["NATION"], "active"), ("placed_by", ["ORDER"], ["CUST"], "retired"), ("contains", ["ORDER"], ["ITEM"], "active"), ("supplied_by", ["PART"], ["SUPP"], "active")]
    return G.violations(edge(s, d), s.createDataFrame(rows, "id string, subject array<string>, object array<string>, status string"))


def _ledger(name, table, *keep):
    out, passed = [f"SELECT '{name}' AS loader, 0 AS step, 'available' AS reason, count(*) AS rows FROM {table}"], "true"
    for k, (reason, c) in enumerate(keep, 1):
        out.append(f"SELECT '{name}', {k}, '{reason}', count(*) FILTER (WHERE ({passed}) AND NOT ({c})) FROM {table}")
        passed += f" AND {c}"
    return " UNION ALL ".join([*out, f"SELECT '{name}', {len(keep) + 1}, 'kept', count(*) FILTER (WHERE {passed}) FROM {table}"])


@query(" UNION ALL ".join([
    _ledger("customer in nation", "customer", ("balance below zero", "c_acctbal >= 0"), ("segment not covered", "c_mktsegment <> 'FURNITURE'")),
    _ledger("supplier in nation", "supplier"), _ledger("nation in region", "nation"),
    _ledger("order placed by customer", "orders", ("status pending", "o_orderstatus <> 'P'"), ("low priority", "o_orderpriority NOT LIKE '5%'")),
    _ledger("order contains part", "lineitem", ("returned", "l_returnflag <> 'R'")),
    _ledger("part supplied by supplier", "lineitem", ("small quantity", "l_quantity >= 10"), ("discounted", "l_discount < 0.05")),
]))
def loader_ledger(s, d):
    return G.ledger(loaders(s, d))


@query(f"""WITH e AS ({SQL_EDGE}), n AS (SELECT s_vocab AS vocab, s_code AS code FROM e UNION SELECT o_vocab, o_code FROM e),
    h AS (SELECT 'CUST' AS vocab, c_custkey::VARCHAR AS code, c_name AS name FROM customer UNION ALL SELECT 'PART', p_partkey::VARCHAR, p_name FROM part UNION ALL SELECT 'NATION', n_nationkey::VARCHAR, n_name FROM nation)
    SELECT n.vocab, n.code, n.vocab || ':' || n.code AS key, h.name FROM n LEFT JOIN h ON h.vocab = n.vocab AND h.code = n.code""")
def node_names(s, d):
    hint = lambda name, vocab, code, label, p: t(s, d, name).select(F.lit(vocab).alias("vocab"), F.col(code).cast("string").alias("code"), F.col(label).alias("name"), F.lit(p).alias("priority"))
    hints = hint("customer", "CUST", "c_custkey", "c_name", 1).union(hint("part", "PART", "p_partkey", "p_name", 1)).union(hint("part", "PART", "p_partkey", "p_type", 2)).union(hint("nation", "NATION", "n_nationkey", "n_name", 1))
    return G.nodes(edge(s, d), hints)


@query(f"""SELECT predicate, count(*) AS edges FROM ({SQL_EDGE}) WHERE NOT (predicate = 'contains' AND method = 'line') AND NOT (predicate = 'placed_by') GROUP BY 1""")
def usable_edge_counts(s, d):
    graded = s.createDataFrame([("contains", "line", "inadmissible", None), ("placed_by", "declared", None, "rejected")], "predicate string, method string, new_tier string, new_state string")
    return G.usable(G.tiered(edge(s, d), graded)).groupBy("predicate").agg(F.count(F.lit(1)).alias("edges"))


@query(f"""WITH e AS ({SQL_EDGE}) SELECT edge_id, predicate, s_code, o_code FROM (SELECT *, row_number() OVER (ORDER BY s_vocab, s_code, predicate, o_vocab, o_code) AS edge_id FROM e WHERE predicate IN ('in_nation', 'in_region'))""")
def edge_ids(s, d):
    return G.numbered(edge(s, d).where("predicate in ('in_nation', 'in_region')")).select(F.col("edge_id").cast("long").alias("edge_id"), "predicate", "s_code", "o_code")


@query(f"""WITH e AS ({SQL_EDGE}), w AS (SELECT DISTINCT l_orderkey::VARCHAR AS s_code, l_partkey::VARCHAR AS o_code FROM lineitem WHERE l_tax > 0.06)
    SELECT method, count(*) AS edges FROM (SELECT CASE WHEN w.s_code IS NULL THEN e.method ELSE e.method || '+tax' END AS method FROM (SELECT * FROM e WHERE predicate = 'contains') e LEFT JOIN w ON w.s_code = e.s_code AND w.o_code = e.o_code) GROUP BY 1""")
def corroborated_methods(s, d):
    w = t(s, d, "lineitem").where("l_tax > 0.06").select(F.col("l_orderkey").cast("string").alias("s_code"), F.col("l_partkey").cast("string").alias("o_code"))
    return G.corroborated(edge(s, d).where("predicate = 'contains'"), w, ["s_code", "o_code"], "+tax").groupBy("method").agg(F.count(F.lit(1)).alias("edges"))


# ---------------------------------------------------------------- hierarchies

_CLOSURE = "WITH RECURSIVE e AS ({0}), r(ancestor, descendant) AS (SELECT parent, child FROM e UNION SELECT e.parent, r.descendant FROM r JOIN e ON e.child = r.ancestor) "


@query(_CLOSURE.format(SQL_POLY) + "SELECT ancestor, descendant FROM r")
def closure_full(s, d):
    return H.closure(isa_poly(s, d))


@query(_CLOSURE.format(SQL_RING) + "SELECT ancestor, count(*) AS descendants FROM r GROUP BY 1")
def closure_ring(s, d):
    return H.closure(ring(s, d)).groupBy("ancestor").agg(F.count(F.lit(1)).alias("descendants"))


@query(f"""WITH RECURSIVE e AS {SQL_POLY}, u(start, node, depth) AS (SELECT c_custkey, c_custkey, 0 FROM customer WHERE c_custkey % 10 = 3 UNION SELECT u.start, e.parent, u.depth + 1 FROM u JOIN e ON e.child = u.node WHERE u.depth < 2)
    SELECT start, node, min(depth) AS depth FROM u GROUP BY 1, 2""")
def ancestors_capped(s, d):
    seeds = t(s, d, "customer").where("c_custkey % 10 = 3").select(F.col("c_custkey").alias("start"))
    return H.ancestors(seeds, isa_poly(s, d), 2)


@query(f"""WITH RECURSIVE e AS {SQL_POLY}, q AS (SELECT c_custkey AS node FROM customer WHERE c_mktsegment = 'BUILDING'),
    u(start, node, depth) AS (SELECT c_custkey, c_custkey, 0 FROM customer UNION SELECT u.start, e.parent, u.depth + 1 FROM u JOIN e ON e.child = u.node),
    h AS (SELECT start, node, min(depth) AS depth FROM u WHERE depth > 0 AND node IN (SELECT node FROM q) GROUP BY 1, 2)
    SELECT start, node, depth FROM h WHERE depth = (SELECT min(depth) FROM h x WHERE x.start = h.start)""")
def nearest_qualifying(s, d):
    c = t(s, d, "customer")
    return H.nearest(c.select(F.col("c_custkey").alias("start")), isa_poly(s, d), c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("node")))


@query(f"""WITH RECURSIVE e AS {SQL_POLY}, h(node) AS (SELECT c_custkey FROM customer WHERE c_acctbal > 9000 UNION SELECT e.parent FROM h JOIN e ON e.child = h.node) SELECT e.child, e.parent FROM e JOIN h ON h.node = e.child""")
def climb_fixpoint(s, d):
    return H.climb(t(s, d, "customer").where("c_acctbal > 9000").select(F.col("c_custkey").alias("node")), isa_poly(s, d))


@query(f"WITH e AS {SQL_POLY} SELECT parents, count(*) AS children FROM (SELECT child, count(DISTINCT parent) AS parents FROM e GROUP BY 1) GROUP BY 1")
def multi_parent(s, d):
    return isa_poly(s, d).groupBy("child").agg(F.count_distinct("parent").alias("parents")).groupBy("parents").agg(F.count(F.lit(1)).alias("children"))


@query(f"""WITH RECURSIVE e AS {SQL_TREE.join("()")}, a AS (SELECT c_custkey AS id, c_acctbal < 5000 AS active FROM customer),
    u(start, node, path, done) AS (SELECT id, id, id::VARCHAR, active FROM a UNION ALL SELECT u.start, e.parent, u.path || '>' || e.parent, a.active FROM u JOIN e ON e.child = u.node JOIN a ON a.id = e.parent WHERE NOT u.done AND length(u.path) - length(replace(u.path, '>', '')) < 3)
    SELECT start, node, path FROM u WHERE done AND start <> node""")
def association_lift(s, d):
    """Inactive concepts lifted at most three steps until an active one."""
    e, a = isa_tree(s, d), t(s, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") < 5000).alias("active"))
    at, out = a.where("not active").select(F.col("id").alias("start"), F.col("id").alias("node"), F.col("id").cast("string").alias("path")), None
    for _ in range(3):
        up = at.join(e, at.node == e.child).select("start", F.col("parent").alias("node"), F.concat("path", F.lit(">"), F.col("parent").cast("string")).alias("path")).join(a, F.col("node") == F.col("id"))
        hit = up.where("active").select("start", "node", "path")
        out, at = hit if out is None else out.union(hit), up.where("not active").select("start", "node", "path")
    return out


@query(f"""WITH e AS ({SQL_TREE}), f AS (SELECT c_custkey AS id, c_mktsegment AS fact FROM customer WHERE c_acctbal > 6000)
    SELECT id, fact, 'own' AS via FROM f UNION SELECT e.parent, f.fact, 'child' FROM f JOIN e ON e.child = f.id WHERE e.parent NOT IN (SELECT id FROM f)""")
def propagate_fact(s, d):
    """A fact moves from a child to a parent that has none of its own."""
    f = t(s, d, "customer").where("c_acctbal > 6000").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("fact"))
    up = f.join(isa_tree(s, d), F.col("id") == F.col("child")).select(F.col("parent").alias("id"), "fact").distinct()
    return f.withColumn("via", F.lit("own")).union(up.join(f.select("id"), "id", "left_anti").withColumn("via", F.lit("child")))


# ---------------------------------------------------------------- walks


def _walk(e: str, start: str, follow: list[str], depth: int) -> str:
    fwd, back = [p for p in follow if p[0] != "~"], [p[1:] for p in follow if p[0] == "~"]
    return f"""WITH RECURSIVE e AS ({e}), st AS (SELECT s_vocab || ':' || s_code AS f, predicate AS p, o_vocab || ':' || o_code AS x FROM e WHERE predicate IN {(*fwd, "")}
        UNION ALL SELECT o_vocab || ':' || o_code, '~' || predicate, s_vocab || ':' || s_code FROM e WHERE predicate IN {(*back, "")}),
        w(node, depth, via, seen) AS (SELECT '{start}', 0, '', ['{start}'] UNION ALL SELECT st.x, w.depth + 1, CASE WHEN w.via = '' THEN st.p ELSE w.via || ' > ' || st.p END, list_append(w.seen, st.x) FROM w JOIN st ON st.f = w.node WHERE w.depth < {depth} AND NOT list_contains(w.seen, st.x))
        SELECT node AS key, depth, min(via) AS via FROM w WHERE depth > 0 AND (node, depth) IN (SELECT (node, min(depth)) FROM w GROUP BY node) GROUP BY 1, 2"""


@query(_walk(SQL_EDGE, "CUST:1", ["in_nation", "in_region"], 3))
def walk_forward(s, d):
    return H.walk(edge(s, d), "CUST:1", ["in_nation", "in_region"], 3)


@query(_walk(SQL_EDGE, "REGION:2", ["~in_region", "~in_nation"], 2))
def walk_backward(s, d):
    return H.walk(edge(s, d), "REGION:2", ["~in_region", "~in_nation"], 2)


_RING_EDGE = "SELECT 'N' AS s_vocab, n_nationkey::VARCHAR AS s_code, 'next' AS predicate, 'N' AS o_vocab, ((n_nationkey + 1) % 25)::VARCHAR AS o_code FROM nation"


@query(_walk(_RING_EDGE, "N:0", ["next", "~next"], 5))
def walk_ring_visited(s, d):
    n = ring(s, d).select(F.lit("N").alias("s_vocab"), F.col("child").cast("string").alias("s_code"), F.lit("next").alias("predicate"), F.lit("N").alias("o_vocab"), F.col("parent").cast("string").alias("o_code"), F.lit("native").alias("tier"), F.lit("asserted").alias("state"))
    return H.walk(n, "N:0", ["next", "~next"], 5)


# ---------------------------------------------------------------- components


@query("""WITH g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS c FROM documents) SELECT c AS component, count(*) AS nodes FROM g GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT -1, count(*) FROM nation""")
def component_sizes(s, d):
    docs = t(s, d, "documents")
    first = docs.groupBy("text").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    links = docs.join(first, "text").where("doc_id <> a").select("a", F.col("doc_id").alias("b"))
    n = ring(s, d).select((-F.col("child") - 1).alias("a"), (-F.col("parent") - 1).alias("b"))
    out = C.components(links.union(n)).groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))
    return out.select(F.when(F.col("component") < 0, -1).otherwise(F.col("component")).alias("component"), "nodes")


_ISLES = "SELECT c_custkey AS a, CASE WHEN c_custkey % 2 = 0 THEN c_custkey // 3 ELSE c_custkey - 1 END AS b FROM customer WHERE c_custkey % 5 <> 0"


@query(f"""WITH RECURSIVE l AS ({_ISLES}), b AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r(x, y) AS (SELECT a, a FROM b UNION SELECT r.x, b.b FROM r JOIN b ON b.a = r.y)
    SELECT component, count(*) AS nodes FROM (SELECT x, min(y) AS component FROM r GROUP BY 1) GROUP BY 1""")
def islands(s, d):
    k = F.col("c_custkey")
    links = t(s, d, "customer").where("c_custkey % 5 <> 0").select(k.alias("a"), F.when(k % 2 == 0, F.expr("c_custkey div 3")).otherwise(k - 1).alias("b"))
    return C.components(links).groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"""WITH RECURSIVE l AS ({_ISLES}), b AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r(x, y) AS (SELECT a, a FROM b UNION SELECT r.x, b.b FROM r JOIN b ON b.a = r.y),
    c AS (SELECT x, min(y) AS component FROM r GROUP BY 1), n AS (SELECT c_mktsegment AS vocab, coalesce(component, c_custkey) AS component FROM customer LEFT JOIN c ON x = c_custkey),
    m AS (SELECT component FROM n GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT vocab, count(*) AS nodes, count(*) FILTER (WHERE component NOT IN (SELECT component FROM m)) AS outside FROM n GROUP BY 1""")
def outside_main_component(s, d):
    """Customers outside the largest island, by segment."""
    k = F.col("c_custkey")
    links = t(s, d, "customer").where("c_custkey % 5 <> 0").select(k.alias("a"), F.when(k % 2 == 0, F.expr("c_custkey div 3")).otherwise(k - 1).alias("b"))
    return C.outside_main(t(s, d, "customer").select(k.alias("node"), F.col("c_mktsegment").alias("vocab")), links)


@query(f"""WITH l AS ({_ISLES}), v AS (SELECT c_custkey AS k, c_mktsegment AS vocab FROM customer),
    f AS (SELECT a, b FROM l JOIN v x ON x.k = a JOIN v y ON y.k = b WHERE x.vocab <> y.vocab), u AS (SELECT a AS k FROM f UNION SELECT b FROM f)
    SELECT vocab, count(*) AS nodes, count(u.k) AS linked, round(count(u.k) / count(*), 3) AS share FROM v LEFT JOIN u USING (k) GROUP BY 1""")
def reach_outside_vocab(s, d):
    """Customers with a link to a customer of another segment."""
    k = F.col("c_custkey")
    links = t(s, d, "customer").where("c_custkey % 5 <> 0").select(k.alias("a"), F.when(k % 2 == 0, F.expr("c_custkey div 3")).otherwise(k - 1).alias("b"))
    return C.reach_outside(t(s, d, "customer").select(k.alias("node"), F.col("c_mktsegment").alias("vocab")), links)


def _twins(s, d):
    """Customers and suppliers are held equal by their rounded balance; a component with two customers is a conflict."""
    c = t(s, d, "customer").select(F.concat(F.lit("C:"), F.col("c_custkey")).alias("a"), F.concat_ws(":", F.lit("B"), F.col("c_nationkey").cast("string"), F.floor(F.col("c_acctbal") / 500).cast("string")).alias("b"))
    p = t(s, d, "supplier").select(F.concat(F.lit("S:"), F.col("s_suppkey")), F.concat_ws(":", F.lit("B"), F.col("s_nationkey").cast("string"), F.floor(F.col("s_acctbal") / 500).cast("string")))
    return c.union(p)


@query("""WITH m AS (SELECT 'C' AS vocab, c_custkey AS k, c_nationkey AS n, floor(c_acctbal / 500) AS f FROM customer UNION ALL SELECT 'S', s_suppkey, s_nationkey, floor(s_acctbal / 500) FROM supplier)
    SELECT vocab, codes, count(*) AS components FROM (SELECT n, f, vocab, count(*) AS codes FROM m GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1, 2""")
def conflict_clusters(s, d):
    labels = C.components(_twins(s, d)).withColumn("vocab", F.split_part("node", F.lit(":"), F.lit(1))).where("vocab <> 'B'")
    return C.conflicts(labels).groupBy("vocab", "codes").agg(F.count(F.lit(1)).alias("components"))


@query(None)
def bridge_links(s, d):
    links = _twins(s, d)
    labels = C.components(links).withColumn("vocab", F.split_part("node", F.lit(":"), F.lit(1))).where("vocab = 'S'")
    return C.bridges(links, C.sampled_pairs(labels))


# ---------------------------------------------------------------- the constraint language

_CONCEPT = "SELECT c_custkey AS id, c_acctbal >= 0 AS active, c_name AS term FROM customer"
_REL = f"""(SELECT child AS source, parent AS target, 0 AS type, 0::BIGINT AS grp FROM {SQL_POLY}
    UNION ALL SELECT DISTINCT o_custkey, o_custkey // 4, 1 + o_orderkey % 3, o_orderkey % 5 FROM orders)"""


def edition(s, d) -> L.Edition:
    """Customers as concepts under two parents; orders as attributes 1 to 3 in groups 0 to 4; reference sets by segment. Written once."""

    def make() -> L.Edition:
        c = t(s, d, "customer")
        concept = c.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") >= 0).alias("active"), F.col("c_name").alias("term"))
        isa = isa_poly(s, d)
        o = t(s, d, "orders").select(F.col("o_custkey").alias("source"), F.expr("o_custkey div 4").alias("target"), (1 + F.col("o_orderkey") % 3).cast("int").alias("type"), (F.col("o_orderkey") % 5).alias("grp")).distinct()
        r = isa.select(F.col("child").alias("source"), F.col("parent").alias("target"), F.lit(0).alias("type"), F.lit(0).cast("long").alias("grp")).union(o)
        member = c.where("c_mktsegment = 'MACHINERY'").select(F.lit(7).alias("refset"), F.col("c_custkey").alias("id"))
        return L.Edition(stored(concept, "concept"), stored(r, "relationship"), stored(H.closure(isa), "closure"), concept.select("id", "term"), member)

    return kept(s, d, "edition", make)


def _ecl(text: str, sql: str, name: str):
    def run(s, d):
        return L.Compiler(edition(s, d)).expand(text)

    run.__name__ = name
    query(_CLOSURE.format(SQL_POLY) + f", c AS ({_CONCEPT}), q AS (SELECT * FROM {_REL}) " + sql)(run)


_UNDER = "(SELECT descendant FROM r WHERE ancestor = {0} UNION SELECT {0})"
_ecl("<< 12", f"SELECT descendant AS id FROM {_UNDER.format(12)}", "ecl_descendants")
_ecl("< 1 AND > 700", "SELECT descendant AS id FROM r WHERE ancestor = 1 INTERSECT SELECT ancestor FROM r WHERE descendant = 700", "ecl_between")
_ecl("<! 3", "SELECT DISTINCT source AS id FROM q WHERE type = 0 AND target = 3", "ecl_children")
_ecl(">! 800 OR >> 44", "SELECT target AS id FROM q WHERE type = 0 AND source = 800 UNION SELECT ancestor FROM r WHERE descendant = 44 UNION SELECT 44", "ecl_parents")
_ecl("<< 1 MINUS << 12", f"SELECT descendant AS id FROM {_UNDER.format(1)} EXCEPT SELECT descendant FROM {_UNDER.format(12)}", "ecl_minus")
_ecl("<< 1 : 2 = << 3", f"SELECT DISTINCT source AS id FROM q WHERE type = 2 AND source IN {_UNDER.format(1)} AND target IN {_UNDER.format(3)}", "ecl_refine")
_ecl("<< 1 : 2 != << 3", f"SELECT descendant AS id FROM {_UNDER.format(1)} EXCEPT SELECT source FROM q WHERE type = 2 AND target IN {_UNDER.format(3)}", "ecl_not_equal")
_ecl("<< 1 : 1 = *, 3 = *", f"SELECT source AS id FROM q WHERE type = 1 AND source IN {_UNDER.format(1)} INTERSECT SELECT source FROM q WHERE type = 3", "ecl_conjunction")
_ecl("<< 1 : { 1 = *, 2 = << 3 }", f"SELECT DISTINCT a.source AS id FROM q a JOIN q b ON a.source = b.source AND a.grp = b.grp WHERE a.type = 1 AND b.type = 2 AND a.source IN {_UNDER.format(1)} AND b.target IN {_UNDER.format(3)}", "ecl_group")
_ecl("<< 12 . 2", f"SELECT DISTINCT target AS id FROM q WHERE type = 2 AND source IN {_UNDER.format(12)}", "ecl_dotted")
_ecl('<< 1 {{ term = ("00000012" "customer 0000001") }}', f"SELECT id FROM c WHERE id IN {_UNDER.format(1)} AND (regexp_matches(lower(term), '(^|[^a-z0-9])00000012') OR (regexp_matches(lower(term), '(^|[^a-z0-9])customer') AND regexp_matches(lower(term), '(^|[^a-z0-9])0000001')))", "ecl_term")
_ecl("<< 12 OR << 13 : 1 = *", f"SELECT DISTINCT source AS id FROM q WHERE type = 1 AND (source IN {_UNDER.format(12)} OR source IN {_UNDER.format(13)})", "ecl_compound")
_ecl("^ 7 AND * : * = << 2", f"SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal >= 0 AND c_custkey IN (SELECT source FROM q WHERE type <> 0 AND target IN {_UNDER.format(2)})", "ecl_members")
_ecl("<! (12 OR 13)", "SELECT DISTINCT source AS id FROM q WHERE type = 0 AND target IN (12, 13)", "ecl_over_brackets")
_ecl("<< ^ 7", "SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'MACHINERY' UNION SELECT descendant FROM r WHERE ancestor IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')", "ecl_over_members")
_ecl("<< 1 : 1 = << 3 OR 2 = << 4", f"SELECT DISTINCT source AS id FROM q WHERE source IN {_UNDER.format(1)} AND ((type = 1 AND target IN {_UNDER.format(3)}) OR (type = 2 AND target IN {_UNDER.format(4)}))", "ecl_or_refinement")
_ecl("<< 1 : << 1 = << 3, < 0 = *", f"SELECT DISTINCT source AS id FROM q WHERE source IN {_UNDER.format(1)} AND type IN {_UNDER.format(1)} AND target IN {_UNDER.format(3)} INTERSECT SELECT source FROM q WHERE type IN (SELECT descendant FROM r WHERE ancestor = 0)", "ecl_attribute_names")

"""Agreement of routes, graded tiers, concept-model rules, completeness and regression guards."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import earned_tier, tier, wilson
from .ecl import parse
from .hierarchy import ancestors, reach


def agreement(pairs: DataFrame, isa: DataFrame, max_depth: int = 25) -> DataFrame:
    """One row: how often a route's answer ``a`` and an independent one ``b`` (by ``route_id``) are equal, or on one is-a line."""
    seeds = pairs.select(F.col("a").alias("start")).union(pairs.select("b")).distinct()
    up = ancestors(seeds, isa, max_depth).select("start", "node")
    line = pairs.join(up, (pairs.a == up.start) & (pairs.b == up.node), "left_semi").union(pairs.join(up, (pairs.b == up.start) & (pairs.a == up.node), "left_semi")).distinct()
    per = pairs.join(line.withColumn("_l", F.lit(True)), pairs.columns, "left").groupBy("route_id").agg(F.bool_or(F.col("a") == F.col("b")).alias("exact"), F.bool_or((F.col("a") == F.col("b")) | F.col("_l").isNotNull()).alias("consistent"))
    n = per.agg(F.count(F.lit(1)).alias("n"), F.count_if("exact").alias("exact"), F.count_if("consistent").alias("consistent"))
    low = wilson(F.col("consistent"), F.col("n"))[0]
    return n.select("n", "exact", "consistent", (F.col("n") - F.col("consistent")).alias("contradicted"), F.round(low, 4).alias("wilson_lo"), tier(low, F.col("n")).alias("earned_tier"))


def graded(sheet: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, good, wilson_lo, wilson_hi, tier of a hand-check sheet (verdict 0/1)."""
    g = sheet.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == 1).alias("good"))
    low, high = wilson(F.col("good"), F.col("n"))
    return g.select(*keys, "n", "good", F.round(low, 4).alias("wilson_lo"), F.round(high, 4).alias("wilson_hi"), tier(low, F.col("n")).alias("tier"))


def hard_silence(answers: DataFrame, hard: DataFrame) -> DataFrame:
    """One row: on how many of the hard subjects (which no route can know) a route answers, and the share on which it is silent."""
    hit = hard.select("subject").distinct().join(answers.select("subject").distinct().withColumn("_a", F.lit(True)), "subject", "left")
    n = hit.agg(F.count(F.lit(1)).alias("n_hard"), F.count("_a").alias("hard_fired"))
    return n.select("n_hard", "hard_fired", F.when(F.col("n_hard") > 0, F.round(1 - F.col("hard_fired") / F.col("n_hard"), 4)).alias("hard_silence"))


def route_score(answers: DataFrame, truth: DataFrame, source_class: str = "lookup") -> DataFrame:
    """One row: fired, correct, coverage, precision, m, u (chance by permutation, floored) and the log weight of a route.

    ``answers`` (subject, pred), one each; ``truth`` (subject, gold). A route that is never right weighs minus infinity.
    """
    size = truth.agg(F.count(F.lit(1)).alias("n_truth"), F.count_distinct("gold").alias("n_gold"))
    hit = answers.join(truth, "subject", "left").agg(F.count(F.lit(1)).alias("fired"), F.count_if(F.col("pred") == F.col("gold")).alias("correct"))
    by = answers.groupBy("pred").agg(F.count(F.lit(1)).alias("a")).join(truth.groupBy("gold").agg(F.count(F.lit(1)).alias("b")), F.col("pred") == F.col("gold"))
    chance = by.agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("met"))
    all_ = hit.crossJoin(size).crossJoin(chance)  # three single rows
    m = F.when(F.col("n_truth") > 0, F.col("correct") / F.col("n_truth")).otherwise(0.0)
    u = F.greatest(F.col("met") / F.greatest(F.lit(1), F.col("fired") * F.col("n_truth")), 1 / F.greatest(F.lit(1), F.col("n_gold")))
    low = wilson(F.col("correct"), F.col("fired"))[0]
    return all_.select(
        "fired", "correct", F.round(F.col("fired") / F.col("n_truth"), 4).alias("coverage"), F.round(F.col("correct") / F.col("fired"), 4).alias("precision"), F.round(low, 4).alias("wilson_lo"),
        F.round(m, 6).alias("m"), F.round(u, 8).alias("u"), F.when((m > 0) & (u > 0), F.round(F.ln(m / u), 3)).otherwise(F.lit(float("-inf"))).alias("weight"), earned_tier(F.lit(source_class), low, F.col("fired")).alias("tier"),
    )


# ---------------------------------------------------------------- concept-model rules

_BOUND = r"(?P<{0}_op>[<>]=?)?\s*#(?P<{0}>[-+]?\d+(?:\.\d+)?)"
_CONCRETE = re.compile(rf"(?P<type>dec|int|str)\(\s*(?:{_BOUND.replace('{0}', 'low')})?\s*(?:\.\.\s*(?:{_BOUND.replace('{0}', 'high')})?)?[^)]*\)")


def terms(constraint: str) -> list[tuple[str, int]] | None:
    """(operator, concept) alternatives of a constraint, or None for what is not a list of them."""
    try:
        rest, found = [parse(constraint)], []
    except SyntaxError:
        return None
    while rest:
        s = rest.pop()
        inner = s.parts[0] if s.kind == "over" else None
        if s.kind == "bool" and s.op == "OR":
            rest += s.parts[::-1]
        elif s.kind in ("one", "members"):
            found.append(("^" if s.kind == "members" else "self", s.id))
        elif inner is not None and inner.kind == "one" and s.op in ("<", "<<"):
            found.append((s.op, inner.id))
        else:
            return None
    return found


def concrete_range(constraint: str) -> tuple[str, float | None, bool, float | None, bool] | None:
    """(type, low, low open, high, high open) of a range of values; strings have no bounds."""
    m = _CONCRETE.fullmatch(constraint.split("|")[0].strip())
    if not m:
        return None
    bound = lambda k: float(m[k]) if m[k] and m["type"] != "str" else None
    return m["type"], bound("low"), m["low_op"] == ">", bound("high"), m["high_op"] == "<"


def satisfied(values: DataFrame, rules: DataFrame, closure: DataFrame, members: DataFrame) -> DataFrame:
    """(key, id): ids that meet a term (key, op, focus) — an equi-join for each operator instead of one OR of lookups."""
    r = F.broadcast(rules)
    own = values.select("id").distinct()
    same = own.join(r.where("op in ('self', '<<')"), F.col("id") == F.col("focus")).select("key", "id")
    below = closure.join(r.where("op in ('<', '<<')"), F.col("ancestor") == F.col("focus")).select("key", F.col("descendant").alias("id")).where("id is not null")
    inside = members.join(r.where("op = '^'"), F.col("refset") == F.col("focus")).select("key", "id")
    return same.union(below.join(own, "id", "left_semi").select("key", "id")).union(inside.join(own, "id", "left_semi").select("key", "id")).distinct()


def in_range(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows (s, a, datatype, value) that meet a concrete range (a, typ, lo, lo_x, hi, hi_x) of their attribute."""
    kind = "CASE typ WHEN 'str' THEN datatype = 'string' WHEN 'int' THEN datatype = 'integer' ELSE datatype IN ('integer', 'decimal') END"
    low = "(lo IS NULL OR CASE WHEN lo_x THEN value > lo ELSE value >= lo END)"
    high = "(hi IS NULL OR CASE WHEN hi_x THEN value < hi ELSE value <= hi END)"
    return values.join(F.broadcast(ranges), "a").where(f"{kind} AND {low} AND {high}").select(*values.columns).distinct()


def governing(uses: DataFrame, rules: DataFrame, in_domain: DataFrame) -> DataFrame:
    """(s, a) with the most permissive of the rules that apply: grouping allowed if any allows it, the largest maximum (null: none)."""
    u = uses.select("s", "a").distinct().join(F.broadcast(rules), "a").join(in_domain.select(F.col("key").alias("domain"), F.col("id").alias("s")), ["domain", "s"])
    top = lambda c: F.when(F.bool_or(F.col(c).isNull()), F.lit(None)).otherwise(F.max(c))
    return u.groupBy("s", "a").agg(F.bool_or("grouped").alias("may_group"), F.bool_or(~F.col("grouped")).alias("may_ungroup"), top("card_hi").alias("card_hi"), top("gcard_hi").alias("gcard_hi"))


def model_violations(uses: DataFrame, rules: DataFrame, range_ok: DataFrame, with_range: DataFrame, in_domain: DataFrame) -> DataFrame:
    """class, a, n: how often uses (s, a, o, grp) break the rules (a, domain, grouped, card_lo, card_hi, gcard_hi, mandatory)."""
    known = rules.select("a").distinct().withColumn("known", F.lit(True))
    fits = rules.select("a", "domain").distinct().join(in_domain.select(F.col("key").alias("domain"), F.col("id").alias("s")), "domain").select("a", "s").distinct().withColumn("fits", F.lit(True))
    e = uses.join(F.broadcast(known), "a", "left").join(fits, ["a", "s"], "left").join(with_range.select("a").distinct().withColumn("ranged", F.lit(True)), "a", "left")
    e = e.join(range_ok.select("s", "a", "o").distinct().withColumn("ok", F.lit(True)), ["s", "a", "o"], "left")
    each = F.array_compact(F.array(
        F.when(F.col("known").isNull(), F.lit("attribute")), F.when(F.col("known").isNotNull() & F.col("fits").isNull(), F.lit("domain")),
        F.when(F.col("known").isNotNull() & F.col("ranged").isNotNull() & F.col("ok").isNull(), F.lit("range")),
    ))
    out = e.select("a", F.explode(each).alias("class"))
    gov = governing(uses, rules, in_domain)
    g = uses.join(gov, ["s", "a"])
    out = out.union(g.where("(grp = 0 and not may_ungroup) or (grp <> 0 and not may_group)").select("a", F.lit("grouping")))
    out = out.union(g.groupBy("s", "a").agg(F.count(F.lit(1)).alias("n"), F.max("card_hi").alias("hi")).where("hi is not null and n > hi").select("a", F.lit("cardinality")))
    out = out.union(g.where("grp <> 0").groupBy("s", "a", "grp").agg(F.count(F.lit(1)).alias("n"), F.max("gcard_hi").alias("hi")).where("hi is not null and n > hi").select("a", F.lit("group cardinality")))
    need = F.broadcast(rules.where("mandatory and card_lo >= 1").select("a", "domain")).join(in_domain.select(F.col("key").alias("domain"), F.col("id").alias("s")), "domain")
    out = out.union(need.join(uses.select("a", "s").distinct(), ["a", "s"], "left_anti").select("a", F.lit("mandatory")))
    return out.groupBy("class", "a").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- completeness and guards


def completeness(members: DataFrame, moves: DataFrame, hops: int, reached) -> DataFrame:
    """One row: members, reached, share, wilson_lo; ``reached`` is a condition on the nodes that a member reaches."""
    hit = reach(members, moves, hops).where(reached).select("member").distinct()
    n = members.select("member").distinct().join(hit.withColumn("_h", F.lit(True)), "member", "left").agg(F.count(F.lit(1)).alias("members"), F.count("_h").alias("reached"))
    return n.select("members", "reached", F.round(F.col("reached") / F.col("members"), 4).alias("share"), F.round(wilson(F.col("reached"), F.col("members"))[0], 3).alias("wilson_lo"))


def guard(base: DataFrame, now: DataFrame) -> DataFrame:
    """kind, family, was, is, verdict: families (kind, family, n) that vanished, shrank beyond 1 % and 10, grew beyond 25 % and 1,000, or are new.

    Kinds that count faults (``conflicts``, ``violations``: 5 % and 5; ``islands``: 5 % and 50) fail when they rise.
    """
    b, c = base.select("kind", "family", F.col("n").alias("was")), now.select("kind", "family", F.col("n").alias("is"))
    both = b.join(c, ["kind", "family"], "full")
    fault = F.col("kind").isin("conflicts", "violations", "islands")
    slack = F.greatest(F.when(F.col("kind") == "islands", 50).otherwise(5), 0.05 * F.coalesce("was", F.lit(0)))
    verdict = (
        F.when(fault & (F.coalesce("is", F.lit(0)) - F.coalesce("was", F.lit(0)) > slack), "fail: rose")
        .when(fault, None)
        .when(F.col("was").isNull(), "warn: new")
        .when((F.col("was") > 0) & (F.coalesce("is", F.lit(0)) == 0), "fail: vanished")
        .when(F.col("was") - F.col("is") > F.greatest(F.lit(10), 0.01 * F.col("was")), "fail: shrank")
        .when(F.col("is") - F.col("was") > F.greatest(F.lit(1000), 0.25 * F.col("was")), "warn: grew")
    )
    return both.withColumn("verdict", verdict).where("verdict is not null").select("kind", "family", "was", "is", "verdict")


def overlay(rows: DataFrame, decisions: DataFrame, key: list[str], value: str) -> DataFrame:
    """``rows`` with the last decision of each key laid over ``value``, and what it was: applied, stale (the row has moved on) or none.

    ``decisions``: key, decided_on, expected, decision.
    """
    from .editions import latest

    d = latest(decisions, key, "decided_on", ["decision"]).select(*key, "expected", "decision")
    state = F.when(F.col("decision").isNull(), "none").when(F.col("expected").eqNullSafe(F.col(value)), "applied").otherwise("stale")
    return rows.join(d, key, "left").withColumn("overlay", state).withColumn(value, F.when(F.col("overlay") == "applied", F.col("decision")).otherwise(F.col(value))).drop("expected", "decision")

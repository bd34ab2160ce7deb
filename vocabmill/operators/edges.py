"""Building the graph: edge families with a ledger, validation against a register, nodes with one name, tiers.

An edge family is a DataFrame of ``EDGE`` columns. Families are united, never updated: tiers, rejections and method suffixes
are joined in. A loader declares what it excludes; one pass counts what was there, what each reason took, and what was left.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored

EDGE = ["s_vocab", "s_code", "predicate", "o_vocab", "o_code", "source", "source_locator", "method", "tier", "state", "pin", "attrs"]
#: Fixed values of two edge columns.
TIERS = ["1", "2", "3", "inadmissible", "ungraded", "native", "decision"]
STATES = ["asserted", "corrected_pending_attestation", "attested", "rejected"]


def _column(x: Column | str | None) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("string")


@dataclass
class Loader:
    """An edge family: its rows, the conditions that keep a row (with the reason why others go), and its constants.

    Vocabularies, predicate, source, place (where in the source), method, tier and state are texts, or columns where rows differ.
    """

    name: str
    rows: DataFrame
    subject: tuple[Column | str, Column]
    predicate: Column | str
    object: tuple[Column | str, Column]
    source: Column | str
    keep: list[tuple[str, Column]] = field(default_factory=list)
    method: Column | str = "native"
    tier: Column | str = "native"
    state: Column | str = "asserted"
    pin: str = ""
    attrs: Column | None = None
    distinct: bool = True
    place: Column | str | None = None

    def edges(self) -> DataFrame:
        kept = self.rows
        for _, condition in self.keep:
            kept = kept.where(condition)
        place = self.name if self.place is None else self.place
        values = [self.subject[0], self.subject[1].cast("string"), self.predicate, self.object[0], self.object[1].cast("string"), self.source, place, self.method, self.tier, self.state, self.pin, self.attrs]
        out = kept.select(*[_column(v).alias(c) for c, v in zip(EDGE, values, strict=True)])
        return out.distinct() if self.distinct else out

    def ledger(self) -> DataFrame:
        """loader, step, reason, rows: available rows, those lost to each reason in turn, and those left, in one pass."""
        passed, counts = F.lit(True), [F.count(F.lit(1)).alias("n0")]
        for k, (_, condition) in enumerate(self.keep, 1):
            passed = passed & F.coalesce(condition, F.lit(False))
            counts.append(F.count_if(passed).alias(f"n{k}"))
        row = self.rows.agg(*counts)
        steps = [F.struct(F.lit(0).alias("step"), F.lit("available").alias("reason"), F.col("n0").alias("rows"))]
        steps += [F.struct(F.lit(k).alias("step"), F.lit(reason).alias("reason"), (F.col(f"n{k - 1}") - F.col(f"n{k}")).alias("rows")) for k, (reason, _) in enumerate(self.keep, 1)]
        steps.append(F.struct(F.lit(len(self.keep) + 1).alias("step"), F.lit("kept").alias("reason"), F.col(f"n{len(self.keep)}").alias("rows")))
        return row.select(F.lit(self.name).alias("loader"), F.explode(F.array(*steps)).alias("s")).select("loader", "s.step", "s.reason", "s.rows")


def balance(loaders: list[Loader]) -> DataFrame:
    """loader, available, excluded, loaded, residual, rows: what is left between rows kept and edges loaded is named, never absorbed."""
    out = None
    for x in loaders:
        kept = F.lit(True)
        for _, condition in x.keep:
            kept = kept & F.coalesce(condition, F.lit(False))
        counts = x.rows.agg(F.count(F.lit(1)).alias("available"), F.count_if(kept).alias("kept")).join(x.edges().agg(F.count(F.lit(1)).alias("loaded")))  # two single rows
        left = F.col("kept") - F.col("loaded")
        name = F.when(left > 0, "collapsed").when(left < 0, "fanned out").otherwise("none")
        row = counts.select(F.lit(x.name).alias("loader"), "available", (F.col("available") - F.col("kept")).alias("excluded"), "loaded", name.alias("residual"), F.abs(left).alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


def gate(inputs, required: list[str], allowed: list[str] = ()) -> list[str]:
    """The required inputs that are missing and allowed to be; any other missing one is refused."""
    missing = [x for x in required if x not in inputs]
    refused = [x for x in missing if x not in allowed and "all" not in allowed]
    if refused:
        raise FileNotFoundError(f"inputs missing: {', '.join(refused)}")
    return missing


def build(loaders: list[Loader]) -> DataFrame:
    out = None
    for x in loaders:
        out = x.edges() if out is None else out.unionByName(x.edges())
    return out


def ledger(loaders: list[Loader]) -> DataFrame:
    out = None
    for x in loaders:
        out = x.ledger() if out is None else out.unionByName(x.ledger())
    return out


def present(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key (of one or more columns) is among ``keys``."""
    return rows.join(keys.select(*on).distinct(), on, "left_semi")


def violations(edge: DataFrame, register: DataFrame) -> DataFrame:
    """rule, predicate, edges: what the register (id, subject[], object[], status) refuses; no rows for a sound graph."""
    r = F.broadcast(register.select(F.col("id").alias("predicate"), "subject", "object", "status"))
    e = edge.join(r, "predicate", "left")
    rules = F.array_compact(F.array(
        F.when(F.col("status").isNull(), F.lit("predicate not in the register")),
        F.when(F.col("status") == "retired", F.lit("predicate is retired")),
        F.when(~F.array_contains("subject", F.col("s_vocab")), F.lit("subject vocabulary not allowed")),
        F.when(~F.array_contains("object", F.col("o_vocab")), F.lit("object vocabulary not allowed")),
        F.when(F.coalesce(F.trim("source"), F.lit("")) == "", F.lit("no source")),
        F.when(~F.coalesce(F.col("tier").isin(TIERS) & F.col("state").isin(STATES), F.lit(False)), F.lit("unknown tier or state")),
        F.when(F.col("s_code").isNull() | F.col("o_code").isNull(), F.lit("an end is missing")),
    ))
    return e.select("predicate", F.explode(rules).alias("rule")).groupBy("rule", "predicate").agg(F.count(F.lit(1)).alias("edges"))


def refuse(edge: DataFrame, register: DataFrame) -> DataFrame:
    """The edges, if the register refuses none; else an error that names the rules."""
    found = violations(edge, register).limit(20).collect()
    if found:
        raise ValueError("; ".join(f"{r.rule}: {r.predicate} ({r.edges})" for r in found))
    return edge


def nodes(edge: DataFrame, hints: DataFrame) -> DataFrame:
    """vocab, code, key, name: every end of an edge; the name hint of the lowest priority, then the smallest, is its name."""
    ends = edge.select(F.col("s_vocab").alias("vocab"), F.col("s_code").alias("code")).union(edge.select("o_vocab", "o_code")).distinct()
    best = hints.where("name is not null").groupBy("vocab", "code").agg(F.min(F.struct("priority", "name")).alias("m")).select("vocab", "code", F.col("m.name").alias("name"))
    return ends.join(best, ["vocab", "code"], "left").select("vocab", "code", F.concat_ws(":", "vocab", "code").alias("key"), "name")


def numbered(edge: DataFrame) -> DataFrame:
    """``edge_id`` 1, 2, ... in the order of all columns, nulls last, over ranges: no single task sees all rows.

    The sorted ranges are written once. Bounds of ranges are sampled, so rows that were counted in one run and numbered in another would stand in
    other ranges.
    """
    spark = edge.sparkSession
    order = [F.col(c).asc_nulls_last() for c in EDGE]
    placed = edge.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())  # the range in the upper 31 bits
    placed = stored(placed, "numbered").withColumn("_p", F.shiftright("_at", 33).cast("int"))
    before, total = {}, 0
    for r in placed.groupBy("_p").count().orderBy("_p").collect():  # one row a partition
        before[r._p] = total
        total += r["count"]
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "_p int, _n bigint")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "_p").withColumn("edge_id", within + F.col("_n") + 1).drop("_p", "_n", "_at")


def usable(edge: DataFrame) -> DataFrame:
    return edge.where("state <> 'rejected' and tier <> 'inadmissible'")


def tiered(edge: DataFrame, graded: DataFrame) -> DataFrame:
    """Edges with the tier and state that (predicate, method) earned; ``graded``: predicate, method, new_tier, new_state."""
    g = F.broadcast(graded)
    return edge.join(g, ["predicate", "method"], "left").withColumn("tier", F.coalesce("new_tier", "tier")).withColumn("state", F.coalesce("new_state", "state")).select(*EDGE)


def corroborated(edge: DataFrame, witness: DataFrame, on: list[str], suffix: str) -> DataFrame:
    """Edges with a suffix on the method of those that a witness also holds."""
    w = witness.select(*on).distinct().withColumn("_w", F.lit(True))
    return edge.join(w, on, "left").withColumn("method", F.when(F.col("_w"), F.concat("method", F.lit(suffix))).otherwise(F.col("method"))).drop("_w").select(*edge.columns)

"""Small fixtures for operators: properties, edge cases, formats."""

import random

import pytest
from pyspark.sql import functions as F

from vocabmill.functions import stats, text, units
from vocabmill.operators import components, ecl, edges, editions, hierarchy, names, quality
from vocabmill.sources import readers


def pairs(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_closure_is_transitive(spark):
    isa = spark.createDataFrame([(1, 2), (2, 3), (8, 9)], "child bigint, parent bigint")
    got = pairs(hierarchy.closure(isa), "descendant", "ancestor")
    assert got == {(1, 2), (2, 3), (1, 3), (8, 9)}
    chain = spark.range(40).selectExpr("id as child", "id + 1 as parent")
    assert hierarchy.closure(chain).count() == 40 * 41 // 2


def test_closure_depth_and_empty(spark):
    isa = spark.createDataFrame([(1, 2), (2, 3)], "child bigint, parent bigint")
    assert pairs(hierarchy.closure(isa, 1), "descendant", "ancestor") == {(1, 2), (2, 3)}
    assert hierarchy.closure(isa.limit(0)).count() == 0
    seeds = spark.createDataFrame([(1,)], "start bigint")
    assert pairs(hierarchy.ancestors(seeds, isa), "node", "depth") == {(1, 0), (2, 1), (3, 2)}


def test_components_random(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = pairs(components.components(spark.createDataFrame(links, "a bigint, b bigint")), "node", "component")
    assert got == {(x, find(x)) for x in root}


def test_bridges(spark):
    links = spark.createDataFrame([("A:1", "X:1"), ("X:1", "X:2"), ("X:2", "A:2"), ("X:2", "B:1")], "a string, b string")
    labels = components.components(links).withColumn("vocab", F.split_part("node", F.lit(":"), F.lit(1)))
    assert pairs(components.conflicts(labels), "vocab", "codes") == {("A", 2), ("X", 2)}
    got = pairs(components.bridges(links, spark.createDataFrame([("A:1", "A:2")], "s string, t string")), "a", "b", "paths")
    assert got == {("A:1", "X:1", 1), ("X:1", "X:2", 1), ("A:2", "X:2", 1)}


def test_main_component(spark):
    nodes = spark.createDataFrame([("A:1", "A"), ("A:2", "A"), ("B:1", "B"), ("B:2", "B"), ("B:3", None)], "node string, vocab string")
    links = spark.createDataFrame([("A:1", "B:1"), ("B:1", "A:2"), ("B:2", "B:3")], "a string, b string")
    assert pairs(components.outside_main(nodes, links), "vocab", "nodes", "outside") == {("A", 2, 0), ("B", 2, 1), (None, 1, 1)}
    assert pairs(components.reach_outside(nodes, links), "vocab", "nodes", "linked", "share") == {("A", 2, 2, 1.0), ("B", 2, 1, 0.5), (None, 1, 0, 0.0)}
    assert components.outside_main(nodes.limit(0), links).count() == 0


def test_longest_contained(spark):
    known = spark.createDataFrame([("Red Eye", 5), ("red eye", 4), ("eye", 1), ("acute red eye pain", 9), ("", 7)], "name string, name_id int")
    texts = spark.createDataFrame([(1, "severe red-eye"), (2, "EYE"), (3, "redeye"), (4, None), (5, ""), (6, "acute red eye pain, left"), (7, "Acute red eye pain")], "id int, text string")
    assert pairs(names.longest_contained(texts, known, 3), "id", "name_id", "how") == {(1, 4, "contains"), (2, 1, "exact"), (6, 4, "contains"), (7, 9, "exact")}
    assert pairs(names.longest_contained(texts, known, 4), "id", "name_id") == {(1, 4), (2, 1), (6, 9), (7, 9)}


def test_longest_contained_sides(spark, monkeypatch, capsys):
    """Runs, whose number sizes of tables do not show, are never the broadcast side; names only where they are few."""
    texts = spark.range(40).select("id", F.concat(F.lit("red eye "), "id").alias("text"))
    known = spark.range(40).select(F.concat(F.lit("eye "), "id").alias("name"), F.col("id").alias("name_id"))
    for most, plan in ((1000, "BuildRight"), (10, "SortMergeJoin")):
        monkeypatch.setattr(names, "BROADCAST_NAMES", most)
        found = names.longest_contained(texts, known.union(known), 3)
        assert pairs(found, "id", "name_id", "how") == {(i, i, "contains") for i in range(40)}
        found.explain()
        shown = capsys.readouterr().out
        assert plan in shown and "BuildLeft" not in shown and ("BroadcastHashJoin" in shown) == (most == 1000)


def test_ecl_syntax():
    assert ecl.parse("<< 1 OR < 2 : 3 = *").kind == "refined"
    assert ecl.shape('<<12 {{ term = "x" }}') == "<< N {{ TERM = S }}"
    for bad in ("<<", "1 : 2 = 3, 4 = 5 OR 6 = 7", "1 2", "1 ? 2", "(1"):
        with pytest.raises(SyntaxError):
            ecl.parse(bad)


def test_ecl_seeds(spark):
    concept = spark.createDataFrame([(1, True, "root"), (2, False, "old heart"), (3, True, "new heart")], "id bigint, active boolean, term string")
    rel = spark.createDataFrame([(2, 1, 0, 0), (3, 1, 0, 0)], "source bigint, target bigint, type int, grp bigint")
    closure = spark.createDataFrame([(1, 2), (1, 3)], "ancestor bigint, descendant bigint")
    c = ecl.Compiler(ecl.Edition(concept, rel, closure, concept))
    ids = lambda q: {r.id for r in c.expand(q).collect()}
    assert ids("<< 2") == {2} and ids("<< 77") == set() and ids("*") == {1, 3}
    assert ids('<< 1 {{ term = "hea new" }}') == {3} and ids('<< 1 {{ term = "art" }}') == set()
    typed = ecl.Compiler(ecl.Edition(concept, rel, closure, concept.withColumn("type", F.when(F.col("id") == 3, 900000000000013009).otherwise(900000000000003001))))
    assert {r.id for r in typed.expand('<< 1 {{ D term = "heart", type = syn }}').collect()} == {3} and {r.id for r in typed.expand('<< 1 |root| {{ type = (fsn syn) }}').collect()} == {1, 2, 3}
    assert ecl.replay(c, [("< 1", {2, 3}), ("< 1", {2, 4})]) == [("< N", "< 1", 1, 1)]


def test_stats(spark):
    r = spark.createDataFrame([(0, 0), (30, 30), (1000, 1000), (29, 29), (10, 40)], "k int, n int")
    low, high = stats.wilson(F.col("k"), F.col("n"))
    got = {(x.k, x.n): (x.lo, x.hi, x.t) for x in r.select("k", "n", low.alias("lo"), high.alias("hi"), stats.tier(low, F.col("n")).alias("t")).collect()}
    assert got[0, 0][:2] == (0.0, 0.0) and got[30, 30][2] == "2" and got[1000, 1000][2] == "1" and got[29, 29][2] == "ungraded" and got[10, 40][2] == "inadmissible"
    w = stats.match_weight(F.lit(9), F.lit(10), F.col("n"), F.lit(1000), F.lit(True))
    weights = {x.n: x.w for x in r.select("n", w.alias("w")).collect()}
    assert weights[0] > weights[30] > weights[1000]  # what is rarer by chance weighs more
    assert spark.range(1).select(stats.weakest(F.array(F.lit("1"), F.lit("inadmissible"), F.lit("2")))).first()[0] == "inadmissible"
    one = spark.range(1).select(stats.posterior(stats.match_weight(F.lit(1), F.lit(1), F.lit(0), F.lit(1), F.lit(True)))).first()[0]
    assert one < 0.9  # a single case is never certain


def test_text(spark):
    value = lambda c: spark.range(1).select(c).first()[0]
    assert value(text.bag_of_words(F.lit("Fracture of Arm (disorder)"))) == "arm fracture of"
    assert value(text.class_key(F.lit("Beta2 Receptors Blockers [MoA]"))) == "2 beta blocker"
    assert value(text.cited_items(F.lit("see item 12, 15 and 20 of the Medicare Benefits Schedule"))) == ["12", "15", "20"]
    assert value(text.acronym_of(F.lit("mi"), F.lit("Myocardial Infarction"))) and not value(text.acronym_of(F.lit("im"), F.lit("Myocardial Infarction")))
    assert value(units.malformed(F.lit("[IU]mL"))) == ["no operator behind a bracket"]


def test_hard_silence(spark):
    answers = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "subject int, pred string")
    hard = spark.createDataFrame([(2,), (3,), (4,)], "subject int")
    assert tuple(quality.hard_silence(answers, hard).first()) == (3, 1, 0.6667)
    score = quality.route_score(answers, spark.createDataFrame([(1, "z")], "subject int, gold string")).first()
    assert score.correct == 0 and score.weight == float("-inf")


def test_ledger_balances(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 9), (3, 9)], "a int, b int")
    x = edges.Loader("x", rows, ("A", F.col("a")), "p", ("B", F.col("b")), "src", keep=[("null", F.col("b").isNotNull()), ("small", F.col("b") > 6)])
    assert [(r.reason, r.rows) for r in x.ledger().orderBy("step").collect()] == [("available", 4), ("null", 1), ("small", 1), ("kept", 2)]
    assert x.edges().count() == 1
    register = spark.createDataFrame([("p", ["A"], ["C"], "active")], "id string, subject array<string>, object array<string>, status string")
    with pytest.raises(ValueError, match="object vocabulary"):
        edges.refuse(x.edges(), register)


def test_numbering(spark):
    rows = spark.range(500).select(F.lit("A").alias("s_vocab"), F.col("id").cast("string").alias("s_code"), *[F.lit("x").alias(c) for c in edges.EDGE[2:]])
    got = [(r.edge_id, r.s_code) for r in edges.numbered(rows).collect()]
    assert sorted(got) == list(enumerate(sorted(str(i) for i in range(500)), 1))


def test_numbering_once(spark):
    """Bounds of ranges are sampled anew in each run, which must not show in the numbers."""
    rows = spark.range(20000).select(F.lit("A").alias("s_vocab"), F.col("id").cast("string").alias("s_code"), *[F.lit("x").alias(c) for c in edges.EDGE[2:]])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    try:
        got = sorted((r.edge_id, r.s_code) for r in edges.numbered(rows).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == list(enumerate(sorted(str(i) for i in range(20000)), 1))


def test_numbering_nulls(spark):
    rows = spark.createDataFrame([("A", c, *["x"] * 10) for c in ("b", None, "a")], ", ".join(f"{c} string" for c in edges.EDGE))
    assert sorted((r.edge_id, r.s_code) for r in edges.numbered(rows).collect()) == [(1, "a"), (2, "b"), (3, None)]


def test_rule_syntax():
    assert quality.terms("<< 12 |x| OR ^ 9") == [("<<", 12), ("^", 9)] and quality.terms("< 1 : 2 = 3") is None
    assert quality.terms("(<< 12 OR 7)") == [("<<", 12), ("self", 7)] and quality.terms("dec(>#0..)") is None
    assert quality.concrete_range("dec(>#0..)") == ("dec", 0.0, True, None, False)
    assert quality.concrete_range("int(#5..<=#30)") == ("int", 5.0, False, 30.0, False) and quality.concrete_range("dec(>=#1..<#2)") == ("dec", 1.0, False, 2.0, True)
    assert quality.concrete_range('str("*")') == ("str", None, False, None, False) and quality.concrete_range("<< 1") is None


def test_editions(spark):
    v = spark.createDataFrame([(1, "20200101", "a"), (1, "20210101", "b"), (2, "20220101", "c")], "id int, t string, x string")
    assert pairs(editions.cut(v, ["id"], "t", F.lit("20201231")), "id", "x") == {(1, "a")}


def test_readers(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('id\tterm\n1\t"quoted\n2\tx\n')
    assert pairs(readers.delimited(spark, str(tmp_path / "a.tsv"), ["id", "term"]), "id", "term") == {("1", '"quoted'), ("2", "x")}
    (tmp_path / "a.rrf").write_text("C1|N|\nC2||\n")
    assert pairs(readers.pipe_rows(spark, str(tmp_path / "a.rrf"), ["c", "s"]), "c", "s") == {("C1", "N"), ("C2", None)}
    (tmp_path / "a.obo").write_text("format-version: 1.2\n\n[Term]\nid: A:1\nname: one\nis_a: A:0 ! zero\nxref: B:7\nxref: C:8 {x}\n\n[Term]\nid: A:2\nis_obsolete: true\n\n[Typedef]\nid: r\n")
    got = {r.id: r for r in readers.obo(spark, str(tmp_path / "a.obo")).collect()}
    assert set(got) == {"A:1", "A:2"} and got["A:1"].is_a == ["A:0"] and got["A:1"].xref == ["B:7", "C:8"] and got["A:2"].obsolete
    (tmp_path / "d.sql").write_text("-- x\nCOPY public.t (a, b) FROM stdin;\n1\tx\\ty\n2\t\\N\n\\.\n\nCOPY public.u (a) FROM stdin;\n9\n\\.\n")
    assert pairs(readers.dump_table(spark, str(tmp_path / "d.sql"), "t", ["b", "a"]), "a", "b") == {("1", "x\ty"), ("2", None)}
    # one split a line, escapes from left to right, a block that spans splits
    body = "".join(f"{k}\ta\\\\tb\n" for k in range(50))
    (tmp_path / "e.sql").write_text("COPY public.u (a) FROM stdin;\n7\n\\.\nCOPY public.t (a, b) FROM stdin;\n" + body + "\\.\n9\tno\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    got = readers.dump_table(spark, str(tmp_path / "e.sql"), "t", ["a", "b"])
    assert got.rdd.getNumPartitions() > 4 and pairs(got, "a", "b") == {(str(k), "a\\tb") for k in range(50)}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "e.json").write_text('{"rows": [{"a": "1"}, {"a": null}]}')
    assert pairs(readers.enveloped(spark, str(tmp_path / "e.json"), "a string"), "a") == {("1",), (None,)}
    (tmp_path / "m.tsv").write_text("#head\nsubject_id\tp\tobject_id\ta\tb\tc\nX:1\tp\tY:2\t\t\t\n")
    assert pairs(readers.mappings(spark, str(tmp_path / "m.tsv")), "subject_id", "object_id") == {("X:1", "Y:2")}
    (tmp_path / "x.xml").write_text("<r><d><c>1</c></d><d><c>2</c></d></r>")
    assert pairs(readers.xml(spark, str(tmp_path / "x.xml"), "d", "c string"), "c") == {("1",), ("2",)}


def test_literals_and_axioms(spark):
    raw = spark.createDataFrame([("#3",), ("#12.5",), ('"ab"',)], "x string").select("x", readers.literal(F.col("x")).alias("v"))
    assert {(r.x, r.v.datatype, r.v.value_num, r.v.value_str) for r in raw.collect()} == {("#3", "integer", 3.0, None), ("#12.5", "decimal", 12.5, None), ('"ab"', "string", None, "ab")}
    axiom = 'SubClassOf(:1 ObjectIntersectionOf(:2 ObjectSomeValuesFrom(:609096000 ObjectIntersectionOf(ObjectSomeValuesFrom(:10 :20) DataHasValue(:11 "5"^^xsd:decimal)))))'
    got = spark.createDataFrame([(axiom,)], "a string").select(F.explode(readers.axiom_groups(F.col("a"))).alias("g")).select("g.*")
    assert pairs(got, "grp", "attribute", "value") == {(1, "10", "20"), (1, "11", "5")}
    axiom = "SubClassOf(:1 ObjectIntersectionOf(:2 ObjectSomeValuesFrom(:609096000 ObjectSomeValuesFrom(:10 :20)) ObjectSomeValuesFrom(:30 :40) ObjectSomeValuesFrom(:609096000 ObjectIntersectionOf(ObjectSomeValuesFrom(:11 :21) ObjectSomeValuesFrom(:12 :22)))))"
    got = spark.createDataFrame([(axiom,), (None,)], "a string").select(F.explode(readers.axiom_groups(F.col("a"))).alias("g")).select("g.*")
    assert pairs(got, "grp", "attribute", "value") == {(1, "10", "20"), (0, "30", "40"), (2, "11", "21"), (2, "12", "22")}
    big = spark.createDataFrame([("#1000000000000000",), ("#0.00000001",), ("#x",)], "x string").select("x", readers.literal(F.col("x")).alias("v"))
    assert {(r.x, r.v.value_num) for r in big.collect()} == {("#1000000000000000", 1e15), ("#0.00000001", 1e-8), ("#x", None)}


def test_streaming_ledger(spark, tmp_path):
    from vocabmill import streaming

    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"item": "a", "batch": 1, "status": "done", "recorded_on": "2024"}\n{"item": "b", "batch": 1, "status": "failed", "recorded_on": "2024"}\n')
    for k in (2, 3):  # a second run takes only what is new
        streaming.append_ledger(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        (tmp_path / f"in/{k}.json").write_text(f'{{"item": "c{k}", "batch": {k}, "status": "done", "recorded_on": "2024"}}\n')
    ledger = spark.read.parquet(str(tmp_path / "out"))
    assert ledger.count() == 3
    items = spark.createDataFrame([("a",), ("b",), ("z",)], "item string")
    assert pairs(streaming.todo(items, ledger), "item") == {("b",), ("z",)}

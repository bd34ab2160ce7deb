"""The edge families of the medical vocabularies, as data over named input tables.

An input is a DataFrame of strings under a short name (``Inputs``); families that build on the graph read ``edge``, what has been loaded
before them. Sources that are alike share a shape: reference sets, concept relationships, ontology statements, mapping files,
part codes. ``assemble`` loads the groups in order and writes the graph between those that read it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import wilson
from ..functions.text import cited_items, squash_vowels
from ..functions.units import difference, malformed
from ..operators.edges import EDGE, Loader
from ..operators.hierarchy import ancestors, climb
from ..operators.storage import stored

E = F.expr
Inputs = Mapping[str, DataFrame]

#: Prefixes and identifiers of other systems by the vocabulary that the graph names them with.
OMOP = {"RxNorm": "RXN", "RxNorm Extension": "RXE", "AMT": "SCT", "SNOMED": "SCT", "ATC": "ATC", "ICD10CM": "ICD10CM"}
AXES = {"COMPONENT": "component", "PROPERTY": "property", "TIME": "time_aspect", "SYSTEM": "system", "SCALE": "scale", "METHOD": "method"}
MONDO_EXACT = {"SCTID": "SCT", "ICD10CM": "ICD10CM", "OMIM": "OMIM", "Orphanet": "ORPHA", "DOID": "DOID", "NCIT": "NCIT", "mesh": "MESH", "icd11.foundation": "ICD11", "EFO": "EFO", "UMLS": "UMLS", "MEDGEN": "MEDGEN", "ICD10WHO": "ICD10WHO", "OMIMPS": "OMIMPS"}
MONDO_XREF = {"GARD": "GARD", "HP": "HP", "SCTID": "SCT", "ICD10CM": "ICD10CM", "NCIT": "NCIT", "MESH": "MESH", "Orphanet": "ORPHA", "OMIM": "OMIM", "DOID": "DOID", "ICDO": "ICDO"}
HPO_XREF = {"NCIT": "NCIT", "ORPHA": "ORPHA", "ICD-10": "ICD10WHO"}
DRUG_IDS = {"CHEBI": "CHEBI", "UNII": "UNII", "PUBCHEM_CID": "PUBCHEM", "ChEMBL_ID": "CHEMBL", "MESH_DESCRIPTOR_UI": "MESH", "MESH_SUPPLEMENTAL_RECORD_UI": "MESH", "UMLSCUI": "UMLS", "IUPHAR_LIGAND_ID": "IUPHAR", "KEGG_DRUG": "KEGG", "INN_ID": "INN"}
ANALYTES = {"https://www.ebi.ac.uk/chebi": "CHEBI", "http://www.nlm.nih.gov/research/umls/rxnorm": "RXN", "http://pubchem.ncbi.nlm.nih.gov": "PUBCHEM", "http://fdasis.nlm.nih.gov": "UNII", "https://www.ncbi.nlm.nih.gov/taxonomy": "NCBITAXON", "https://www.ncbi.nlm.nih.gov/gene": "NCBIGENE", "http://www.genenames.org": "HGNC", "https://www.ncbi.nlm.nih.gov/clinvar": "CLINVAR"}
SNOMED_URL, RADLEX_URL, TAXON_URL = "http://snomed.info/sct", "http://www.radlex.org", "https://www.ncbi.nlm.nih.gov/taxonomy"
ORPHANET = {"ICD-10": "ICD10WHO", "ICD-11": "ICD11MMS", "OMIM": "OMIM", "UMLS": "UMLS", "MeSH": "MESH", "MONDO": "MONDO", "GARD": "GARD"}
MEDGEN = {"HPO": "HP", "OMIM": "OMIM", "Orphanet": "ORPHA", "MONDO": "MONDO", "SNOMEDCT_US": "SCT", "MeSH": "MESH", "GARD": "GARD"}
ATC_KIND = {"ATC - RxNorm": "primary", "ATC - RxNorm pr lat": "primary", "ATC - RxNorm pr up": "primary", "Drug class of drug": "primary", "Maps to": "primary", "ATC - RxNorm sec lat": "secondary", "ATC - RxNorm sec up": "secondary"}
EXTENSION = {"Marketed form of": "marketed_form_of", "Tradename of": "tradename_of", "Box of": "box_of", "RxNorm has ing": "has_ingredient", "Quantified form of": "quantified_form_of", "Consists of": "consists_of", "RxNorm is a": "is_a"}
IS_A, COMPONENT, SPECIMEN, SITE, INTERPRETS, INTERPRETATION, RELATIVE = ("sct:116680003", "sct:246093002", "sct:116686009", "sct:704327008", "sct:363714003", "sct:363713009", "sct:704325000")
NOT_LEVELS = ["Protein.abnormal band", "Other cells", "Unidentified cells", "Cells counted.total"]
FRACTIONS = ["259355006", "710118001", "708043004", "73828001", "37852002", "540101010000101", "115333008", "1382094000"]
BLOOD = "119297000"
RANKS = "kingdom|subkingdom|phylum|subphylum|division|superclass|class|subclass|infraclass|superorder|order|suborder|infraorder|superfamily|family|subfamily|tribe|genus|subgenus|section|species"


# ---------------------------------------------------------------- shapes


def named(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def facts(**columns: Column | str) -> Column:
    return F.to_json(F.struct(*[(E(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()]))


def knows(rows: DataFrame, flag: str, on: dict[str, Column], keys: DataFrame) -> DataFrame:
    """``rows`` with a flag that says whether their key is among ``keys`` (columns named like those of ``on``)."""
    k = keys.select(*[F.col(c).alias(f"_{flag}_{c}") for c in on]).distinct().withColumn(flag, F.lit(True))
    cond = [v == F.col(f"_{flag}_{c}") for c, v in on.items()]
    return rows.join(k, cond, "left").drop(*[f"_{flag}_{c}" for c in on]).withColumn(flag, F.coalesce(flag, F.lit(False)))


def present(i: Inputs) -> DataFrame:
    """v, c: the nodes that the graph holds."""
    e = i["edge"]
    return e.select(F.col("s_vocab").alias("v"), F.col("s_code").alias("c")).union(e.select("o_vocab", "o_code")).distinct()


def held(i: Inputs, rows: DataFrame, flag: str, vocab: Column | str, code: Column) -> DataFrame:
    return knows(rows, flag, {"v": vocab if isinstance(vocab, Column) else F.lit(vocab), "c": code}, present(i))


def of(i: Inputs, predicate: str, *names: str) -> DataFrame:
    """Ends of the edges of a predicate under the given names."""
    return i["edge"].where(F.col("predicate") == predicate).select("s_code", "o_code").toDF(*names)


def active_concept(i: Inputs, rows: DataFrame, code: str, flag: str = "known") -> DataFrame:
    return knows(rows, flag, {"id": F.col(code)}, i["concept"])


def active() -> tuple[str, Column]:
    return "inactive row", E("active = '1'")


def known() -> tuple[str, Column]:
    return "concept not active in the release", E("known")


def refset(i: Inputs, name: str, table: str, predicate: str, vocab: str, target: str, sets: list[str], method: Column | str, source: str, attrs: Column | None = None) -> Loader:
    rows = active_concept(i, i[table].where(F.col("refsetId").isin(sets)), "referencedComponentId")
    return Loader(name, rows, ("SCT", E("referencedComponentId")), predicate, (vocab, E(target)), source, [active(), known()], method, place=F.concat(F.lit("reference set "), "refsetId"), attrs=attrs)


def related(i: Inputs, name: str, left: str, right: list[str], predicates: dict[str, str], tier: str = "native", both_held: bool = False, attrs: Column | None = None) -> Loader:
    """Concept relationships from one vocabulary to others: another relationship, a retired one or another target goes."""
    c = i["C"].select("concept_id", "vocabulary_id", "concept_code", "invalid_reason")
    a = c.where(F.col("vocabulary_id") == left).toDF("concept_id_1", "_v", "a", "a_invalid").drop("_v")
    rows = i["CR"].join(a, "concept_id_1").join(c.toDF("concept_id_2", "b_vocab", "b", "_x").drop("_x"), "concept_id_2", "left")
    rows = rows.withColumns({"v": named(OMOP, F.col("b_vocab")), "p": named(predicates, F.col("relationship_id"))})
    keep = [("another relationship", E("p is not null")), ("relationship retired", E("coalesce(invalid_reason, '') = ''")), ("target in another vocabulary", F.coalesce(F.col("b_vocab").isin(right), F.lit(False)))]
    if both_held:
        rows = held(i, held(i, rows, "a_held", OMOP[left], F.col("a")), "b_held", F.col("v"), F.col("b"))
        keep += [("first end not a node the graph holds", E("a_held")), ("second end not a node the graph holds", E("b_held"))]
    return Loader(name, rows, (OMOP.get(left, left), E("a")), E("p"), (E("v"), E("b")), "OMOP Athena", keep, E("relationship_id"), tier, place="CONCEPT_RELATIONSHIP", attrs=attrs)


def statements(terms: DataFrame, prefix: str, field: str) -> DataFrame:
    """id, to: one row a statement of the terms of an ontology, its own live terms flagged."""
    return terms.where(F.col("id").startswith(prefix)).select("id", "obsolete", F.explode(field).alias("to"))


def isa(name: str, terms: DataFrame, prefix: str, vocab: str, predicate: str, source: str) -> Loader:
    rows = statements(terms, prefix, "is_a").where("not obsolete")
    return Loader(name, rows, (vocab, E("id")), predicate, (vocab, E("to")), source, [("parent outside the ontology", F.col("to").startswith(prefix))], place=f"{source} is_a")


def mapped(name: str, rows: DataFrame, prefix: str, target: str, vocab: str, own: str, predicate: str, match: str | None, tier: str, source: str) -> Loader:
    """Rows of a mapping file between two prefixes, of one kind of match."""
    rows = rows.where(F.col("subject_id").startswith(prefix) & F.col("object_id").startswith(f"{target}:"))
    keep = [("another kind of match", F.col("predicate_id") == match)] if match else []
    return Loader(name, rows, (own, E("subject_id")), predicate, (vocab, E("substring_index(object_id, ':', -1)")), source, keep, E("predicate_id"), tier, place="mapping file", attrs=facts(mapping_justification="mapping_justification"))


def rule_kind() -> Column:
    return E("CASE mapRule WHEN 'TRUE' THEN 'unconditional' WHEN 'OTHERWISE TRUE' THEN 'default, when no condition holds' ELSE 'conditional' END")


# ---------------------------------------------------------------- groups of families


def snomed(i: Inputs) -> list[Loader]:
    source, us = "SNOMED CT-AU RF2", "SNOMED CT US Edition"
    structure = {"734138000": "sct:anatomy_structure_entire", "734139008": "sct:anatomy_structure_part"}
    names = i["concept"].select(F.col("id").alias("refsetId"), F.col("pt").alias("set_name"))
    sets = active_concept(i, i["simple_set"].join(names, "refsetId", "left"), "referencedComponentId")
    maps = active_concept(i, i["ext_map"], "referencedComponentId").withColumn("code", E("rtrim('.', regexp_replace(rtrim('?', mapTarget), 'X+$', ''))"))
    maps = knows(maps, "is_code", {"concept_code": F.col("code")}, i["C"].where("vocabulary_id = 'ICD10CM'"))
    whole, partial = ("no target", E("coalesce(mapTarget, '') <> ''")), E("mapTarget like '%?%'")
    about = facts(group="cast(mapGroup as int)", priority="cast(mapPriority as int)", rule="CASE WHEN mapRule NOT IN ('TRUE', 'OTHERWISE TRUE') THEN mapRule END", advice="mapAdvice")
    out = [
        Loader("SNOMED CT-AU relationships", i["rel"], ("SCT", E("src")), E("concat('sct:', typ)"), ("SCT", E("dst")), source, attrs=facts(group="grp"), distinct=False),
        refset(i, "SNOMED CT -> ICD-O-3", "simple_map", "sct:icdo_map", "ICDO", "mapTarget", ["446608001"], "simple map", source, facts(axis="if(mapTarget like 'C%', 'topography', 'morphology')")),
        refset(i, "AMT product -> ARTG id", "simple_map", "sct:artg_id", "ARTG", "mapTarget", ["11000168105"], "simple map", source),
        Loader("SNOMED anatomy structure -> entire / part", i["association"].where(F.col("refsetId").isin(list(structure))), ("SCT", E("referencedComponentId")), named(structure, F.col("refsetId")), ("SCT", E("targetComponentId")), source, [active()], "association"),
        Loader("SNOMED CT-AU reference set membership", sets, ("SCT", E("referencedComponentId")), "sct:in_refset", ("SCT", E("refsetId")), source, [active(), known()], E("coalesce(set_name, refsetId)"), distinct=False),
    ]
    for sets_, predicate, vocab, label in (("447562003", "sct:icd10_map", "ICD10WHO", "SNOMED CT -> ICD-10"), ("6011000124106", "sct:icd10cm_map", "ICD10CM", "SNOMED CT -> ICD-10-CM")):
        out.append(Loader(label, maps.where(F.col("refsetId") == sets_), ("SCT", E("referencedComponentId")), predicate, (vocab, E("mapTarget")), us, [whole, ("partial code, loaded apart", ~partial), known()], rule_kind(), attrs=about))
    sub = maps.where((F.col("refsetId") == "6011000124106") & partial)
    out.append(Loader("SNOMED CT -> ICD-10-CM subcategory", sub, ("SCT", E("referencedComponentId")), "sct:icd10cm_map", ("ICD10CM", E("code")), us, [("subcategory is no code", E("is_code")), known()], F.concat(rule_kind(), F.lit(", partial code (subcategory)")), attrs=facts(target_as_published="mapTarget")))
    return out


def fifth_characters(i: Inputs) -> list[Loader]:
    """Mapped codes that the published tables lack, under the parent that these have."""
    who = i["who"].select(F.col("icd10Code").alias("code")).distinct()
    rows = of(i, "sct:icd10_map", "_s", "code").select("code").distinct().join(who, "code", "left_anti")
    rows = rows.withColumn("up", E("nullif(regexp_extract(code, '^([A-Z][0-9][0-9](?:[.][0-9](?=[0-9]$)|(?=[.]X[0-9]$)))', 1), '')"))
    rows = knows(rows, "listed", {"code": F.col("up")}, who)
    return [Loader("ICD-10 fifth-character code -> its WHO parent", rows, ("ICD10WHO", E("code")), "icd10:subdivision_of", ("ICD10WHO", E("up")), "WHO ICD-10 code structure", [("no parent in the tables", E("listed"))], "fifth-character subdivision")]


def medicines(i: Inputs) -> list[Loader]:
    c = i["C"].select(F.col("concept_id").alias("std"), named(OMOP, F.col("vocabulary_id")).alias("v"), F.col("concept_code").alias("code"))
    check = i["omop_check"].where("source = 'omop_drug'").select("product_id", "verdict")
    out = []
    for label, table, column, predicate, method, state, attrs in (
        ("OMOP product -> standard drug", i["omop_drug"].join(check, "product_id", "left"), "standard_concept_id", "omop:maps_to", "Maps to", "asserted", facts(level="level", witness="verdict")),
        ("OMOP product -> standard drug (rejected)", i["omop_drug"], "refused_standard_concept_id", "omop:maps_to", "Maps to", "rejected", facts(level="level", review="review_status")),
        ("OMOP product -> standard drug (indirect)", i["omop_indirect"], "standard_concept_id", "omop:maps_to_indirect", E("route"), "asserted", facts(level="level", via="via_product_id")),
    ):
        rows = table.where(F.col(column).isNotNull()).withColumn("std", F.col(column)).join(c, "std", "left")
        out.append(Loader(label, rows, ("SCT", E("product_id")), predicate, (E("v"), E("code")), "OMOP Athena", [("concept not in the bundle", E("code is not null"))], method, "ungraded", state, attrs=attrs))
    route = E("split_part(source, ':', 1)")
    out.append(Loader("substance -> standard ingredient", i["std_ingredient"], ("SCT", E("substance_id")), "std_ingredient", (E("if(vocabulary = 'RxNorm', 'RXN', 'RXE')"), E("code")), E("source"), [], route, E("CASE split_part(source, ':', 1) WHEN 'route' THEN tier WHEN 'decision' THEN 'decision' ELSE 'ungraded' END"), E("state"), distinct=False))
    pbs = F.col("source") == "pbs"
    out.append(Loader("product -> ATC", i["product_atc"], ("SCT", E("product_id")), "in_atc_class", ("ATC", E("atc_code")), F.when(pbs, "PBS item-atc").otherwise("OMOP CONCEPT_ANCESTOR"), [], F.when(pbs, "native").otherwise("omop ancestry"), F.when(pbs, "native").otherwise("ungraded"), attrs=facts(atc_level="atc_level"), distinct=False))
    text = i["pbs_text"].join(i["pbs_ind"].select(F.col("indication_prescribing_txt_id").alias("prescribing_text_id"), "severity", "episodicity", F.lit(True).alias("is_indication")), "prescribing_text_id", "left")
    out += [
        Loader("AMT -> PBS item", i["pbs_amt"], ("SCT", E("amt_code")), "pbs:lists", ("PBS_ITEM", E("split_part(li_item_id, '_', 1)")), "PBS API amt-items", [("no AMT code", E("amt_code is not null"))], attrs=facts(amt_level="concept_type_code")),
        Loader("PBS item -> restriction", i["pbs_rel"], ("PBS_ITEM", E("pbs_code")), "pbs:has_restriction", ("PBS_RESTRICTION", E("res_code")), "PBS API item restrictions", attrs=facts(benefit_type="benefit_type_code")),
        Loader("PBS restriction -> indication", text, ("PBS_RESTRICTION", E("res_code")), "pbs:restricted_to", ("PBS_INDICATION", E("prescribing_text_id")), "PBS API prescribing texts", [("text is not an indication", E("is_indication"))], attrs=facts(severity="severity", episodicity="episodicity")),
        Loader("PBS indication -> SNOMED", i["pbs_bind"], ("PBS_INDICATION", E("id")), "pbs:indication_is", ("SCT", E("concept_id")), "indication bindings", [("not bound exactly", E("concept_id is not null"))], E("method"), "ungraded", place=E("text"), distinct=False),
        Loader("corpus condition -> SNOMED", i["corpus_bind"], ("CORPUS", E("condition")), "corpus:binds_to", ("SCT", E("concept_id")), "condition bindings", [("not bound", E("concept_id is not null"))], E("method"), "ungraded", place=E("condition"), distinct=False),
        Loader("ATC class -> parent class (PBS)", i["pbs_atc"], ("ATC", E("atc_code")), "atc:is_a", ("ATC", E("atc_parent_code")), "PBS API atc-codes", [("top level", E("coalesce(atc_parent_code, '') <> ''"))], E("concat('PBS ATC level ', atc_level)")),
    ]
    return out


def loinc(i: Inputs) -> list[Loader]:
    ext, table = "SNOMED CT LOINC Extension", "LOINC table"
    role = i["lx_set"].where("active = '1'").groupBy(F.col("referencedComponentId").alias("sct")).agg(F.bool_or(E("refsetId = '635121010000106'")).alias("observation"), F.bool_or(E("refsetId = '635111010000100'")).alias("orderable"))
    poor = i["lx_note"].where("active = '1' and value = 'Discouraged'").select(F.col("referencedComponentId").alias("sct")).distinct().withColumn("discouraged", F.lit(True))
    ids = i["lx_id"].where("identifierSchemeId = '30051010000102'").withColumn("sct", F.col("referencedComponentId")).join(role, "sct", "left").join(poor, "sct", "left").join(i["loinc"].withColumnRenamed("LOINC_NUM", "alternateIdentifier"), "alternateIdentifier", "left")
    example = i["loinc"].select(F.col("LOINC_NUM").alias("loinc"), F.nullif(F.trim("EXAMPLE_UCUM_UNITS"), F.lit("")).alias("us"))
    unit = i["rcpa"].withColumn("ucum", F.trim("ucum")).join(example, "loinc", "left").withColumn("difference", difference(F.col("us"), F.col("ucum")))
    codes = i["rcpa"].where("lower(trim(ucum)) not in ('', 'no unit')").select("loinc").distinct()
    pairs = knows(knows(i["unit_pairs"], "mass", {"loinc": F.col("mass_loinc")}, codes), "molar", {"loinc": F.col("molar_loinc")}, codes)
    units = i["loinc"].where("EXAMPLE_UCUM_UNITS is not null").select("*", F.explode(F.split("EXAMPLE_UCUM_UNITS", ";")).alias("u"))
    bound = active_concept(i, i["rcpa_el"].groupBy("loinc", "sct").agg(F.array_sort(F.collect_set("element")).alias("elements")), "sct")
    return [
        Loader("LOINC term -> axis part", i["loinc_axis"], ("LOINC", E("code")), F.concat(F.lit("loinc:has_"), named(AXES, F.col("axis"))), ("LOINC", E("part_code")), "LOINC via Athena", distinct=False),
        Loader("LOINC question -> answer", i["loinc_answer"], ("LOINC", E("question_code")), "loinc:has_answer", ("LOINC", E("answer_code")), "LOINC via Athena"),
        related(i, "LOINC -> SNOMED", "LOINC", ["SNOMED"], {"Is a": "loinc:is_a_snomed", "Maps to": "loinc:maps_to_snomed", "Maps to value": "loinc:maps_to_snomed"}, "ungraded"),
        Loader("LOINC Extension relationships", i["lx_rel"], ("SCT", E("sourceId")), E("concat('sct:', typeId)"), ("SCT", E("destinationId")), ext, [active()], attrs=facts(group="relationshipGroup"), distinct=False),
        Loader("LOINC -> SNOMED observable", ids, ("LOINC", E("alternateIdentifier")), E("if(CLASS = 'LABORDERS.ONTOLOGY', 'loinc:order_grouper_concept', 'loinc:sct_concept')"), ("SCT", E("sct")), ext, [active()], "official identifier", attrs=facts(observation="observation", orderable="orderable", discouraged="discouraged is not null", loinc_status="STATUS")),
        Loader("LOINC -> Australian preferred unit", unit, ("LOINC", E("loinc")), "loinc:au_preferred_unit", ("UCUM", E("ucum")), "RCPA SPIA", [("no unit stated", E("lower(coalesce(ucum, '')) not in ('', 'no unit')"))], "RCPA preferred unit", attrs=facts(us_example_ucum="us", difference="difference", differs_from_us_example="difference in ('scale', 'kind')", malformed=malformed(F.col("ucum")))),
        Loader("LOINC mass <-> molar unit counterpart", pairs, ("LOINC", E("mass_loinc")), "loinc:unit_counterpart", ("LOINC", E("molar_loinc")), "LOINC + PubChem", [], "same axes, MCnc / SCnc", attrs=facts(factor="factor", au_preferred="CASE WHEN mass AND molar THEN 'both' WHEN mass THEN 'mass' WHEN molar THEN 'molar' END")),
        Loader("LOINC term -> example UCUM unit", units, ("LOINC", E("LOINC_NUM")), "loinc:example_unit", ("UCUM", E("trim(u)")), table, [("term not active", E("STATUS = 'ACTIVE'")), ("empty", E("trim(u) <> ''"))], E("if(contains(EXAMPLE_UCUM_UNITS, ';'), 'one of several example units', 'example unit')"), attrs=facts(as_written="EXAMPLE_UCUM_UNITS")),
        Loader("LOINC <-> SNOMED CT bound to the same RCPA report element", bound, ("LOINC", E("loinc")), "rcpa:same_data_element", ("SCT", E("sct")), "RCPA SPIA", [known()], "same report data element", attrs=facts(elements="elements")),
    ]


def _levels(i: Inputs) -> DataFrame:
    """loinc, obs, site, result: LOINC observables that state a level (no ratios, differences or refined heads)."""
    e = i["edge"].where("predicate = 'loinc:sct_concept'").select(F.col("s_code").alias("loinc"), F.col("o_code").alias("obs"), "attrs")
    ratio = of(i, RELATIVE, "obs", "_t").select("obs")
    facts_ = i["loinc"].select(F.col("LOINC_NUM").alias("loinc"), F.lower(F.coalesce("PROPERTY", F.lit(""))).alias("property"), F.split_part(F.coalesce("COMPONENT", F.lit("")), F.lit("^"), F.lit(1)).alias("head"), "STATUS")
    x = e.join(of(i, SITE, "obs", "site"), "obs").join(facts_, "loinc", "left").join(ratio, "obs", "left_anti")
    x = x.where(~F.coalesce(F.col("property"), F.lit("")).rlike("diff|rto") & ~F.coalesce(F.col("head"), F.lit("")).isin(NOT_LEVELS))
    flag = lambda k: F.get_json_object("attrs", f"$.{k}") == "true"
    return x.select("loinc", "obs", "site", (flag("observation") & ~flag("discouraged") & (F.col("STATUS") == "ACTIVE")).alias("result"))


def interpreted(i: Inputs) -> list[Loader]:
    """Laboratory results and the findings that interpret them, by analyte and by placement."""
    e = i["edge"].withColumn("grp", F.get_json_object("attrs", "$.group"))
    find = e.where(F.col("predicate") == INTERPRETS).select(F.col("s_code").alias("finding"), F.col("o_code").alias("tgt"), "grp")
    find = find.join(e.where(F.col("predicate") == INTERPRETATION).select(F.col("s_code").alias("finding"), F.col("o_code").alias("interp"), "grp"), ["finding", "grp"]).drop("grp").distinct()
    comp, spec, isa_ = of(i, COMPONENT, "tgt", "comp"), of(i, SPECIMEN, "tgt", "spec"), of(i, IS_A, "child", "parent")
    target = find.join(comp, "tgt").join(spec, "tgt")
    above = ancestors(target.select(F.col("tgt").alias("start")).distinct(), isa_, 20, include_self=False).select(F.col("start").alias("tgt"), F.col("node").alias("up"))
    refined = target.select("tgt", "comp", "spec").join(above, "tgt").join(comp.toDF("up", "comp"), ["up", "comp"]).join(spec.toDF("up", "spec"), ["up", "spec"]).select("tgt")
    level = stored(_levels(i), "levels")
    sites = stored(ancestors(level.select(F.col("site").alias("start")).distinct(), isa_, 25).select(F.col("start").alias("site"), F.col("node").alias("spec")), "sites")
    analyte = level.join(comp.toDF("obs", "comp"), "obs").join(target.join(refined.distinct(), "tgt", "left_anti"), "comp").join(sites, ["site", "spec"])
    about = facts(interpretation="interp", interprets="tgt", finding_specimen="spec", loinc_specimen="site", loinc_observable="obs")
    out = [Loader("LOINC result -> finding it defines (by analyte)", analyte, ("LOINC", E("loinc")), "loinc:interpreted_in_finding", ("SCT", E("finding")), "SNOMED CT-AU + SNOMED CT LOINC Extension", [], "same component, specimen at or below", "ungraded", attrs=about, distinct=False)]
    placed = i["edge"].where("predicate in ('loinc:is_a_snomed', 'loinc:maps_to_snomed') and state <> 'rejected'").select(F.col("s_code").alias("loinc"), F.col("o_code").alias("tgt")).distinct()
    kept = placed.join(find, "tgt").join(level.where("result"), "loinc")
    other = comp.toDF("obs", "own").where(F.col("own").isin(FRACTIONS)).join(kept.select("obs", "tgt").distinct(), "obs").join(comp, "tgt").where("own <> comp").select("obs", "tgt").distinct()
    kept = kept.join(other, ["obs", "tgt"], "left_anti").join(spec, "tgt", "left").withColumn("need", F.coalesce("spec", F.lit(BLOOD)))
    kept = kept.join(sites.toDF("site", "need"), ["site", "need"])
    how = F.when(F.col("spec").isNull(), "placement, target without specimen, blood-family specimen").otherwise("placement, specimen at or below")
    out.append(Loader("LOINC result -> finding it defines (by placement)", kept, ("LOINC", E("loinc")), "loinc:interpreted_in_finding", ("SCT", E("finding")), "OMOP Athena + SNOMED CT-AU + SNOMED CT LOINC Extension", [], how, "ungraded", attrs=about))
    return out


def ontologies(i: Inputs) -> list[Loader]:
    mondo, hp, uberon = i["mondo"], i["hp"], i["uberon"]
    exact = i["mondo_sssom"].withColumns({"pre": E("split_part(object_id, ':', 1)"), "code": E("substring(object_id, instr(object_id, ':') + 1)")})
    exact = knows(exact, "live", {"id": F.col("subject_id")}, mondo.where("not obsolete"))
    vocab = named(MONDO_EXACT, F.col("pre"))
    xref = statements(hp, "HP:", "xref").where("not obsolete").withColumn("v", named(HPO_XREF, E("split_part(to, ':', 1)")))
    ann = i["hpoa"].withColumns({"v": E("split_part(database_id, ':', 1)"), "code": E("substring(database_id, instr(database_id, ':') + 1)")})
    part = statements(uberon, "UBERON:", "is_a").withColumn("p", F.lit("uberon:is_a")).union(statements(uberon, "UBERON:", "relationship").where("to like 'part_of %'").withColumn("to", E("split_part(to, ' ', 2)")).withColumn("p", F.lit("uberon:part_of")))
    live, mesh = ("obsolete class", E("not obsolete")), statements(uberon, "UBERON:", "xref").where("to like 'MESH:%'").withColumn("to", E("substring(to, 6)"))
    said = statements(mondo, "MONDO:", "relationship").where("not obsolete").withColumns({"kind": E("split_part(to, ' ', 1)"), "at": E("split_part(to, ' ', 2)")})
    place = {"disease_has_location": ("UBERON:", "UBERON"), "disease_has_infectious_agent": ("NCBITaxon:", "NCBITAXON")}
    ends = [F.when((F.col("kind") == k) & F.col("at").startswith(p), v) for k, (p, v) in place.items()]
    feature = ["disease_has_feature", "disease_has_major_feature", "has_characteristic"]
    note = statements(mondo, "MONDO:", "xref_line").where("not obsolete").withColumns({"pre": E("split_part(to, ':', 1)"), "code": E("substring(split_part(to, ' ', 1), instr(to, ':') + 1)"), "how": F.regexp_extract_all("to", F.lit('source="MONDO:([A-Za-z]+)'), 1)}).where(F.col("pre").isin(list(MONDO_XREF)))
    says = lambda *names: F.arrays_overlap("how", F.array(*map(F.lit, names)))
    loose = ["mondoIsBroaderThanSource", "mondoIsNarrowerThanSource", "relatedTo"]
    v = named(MONDO_XREF, F.col("pre"))
    note = note.withColumn("p", F.when(says("equivalentTo", "obsoleteEquivalent", "obsoleteEquivalentObsolete", "ObsoleteEquivalent", "obsolete", "Obsolete"), None).when((F.col("pre") == "GARD") & says("GARD"), "mondo:gard_xref").when((F.col("pre") == "HP") & says("otherHierarchy"), "mondo:other_hierarchy").when(says("equivalentObsolete"), "mondo:obsolete_equivalent").when(says(*loose) & v.isin("SCT", "ICD10CM", "NCIT", "MESH"), "mondo:related_xref").when((F.col("pre") == "ICDO") & (F.size("how") == 0), "mondo:icdo_xref"))
    code = F.when((F.col("pre") == "GARD") & F.col("code").rlike("^[0-9]+$"), E("cast(cast(code as bigint) as string)")).when(F.col("pre") == "HP", E("concat('HP:', code)")).otherwise(F.col("code"))
    how = F.when(F.col("p") == "mondo:related_xref", F.concat(F.lit("MONDO:"), F.array_min(F.array_intersect("how", F.array(*map(F.lit, loose)))))).when(F.col("p") == "mondo:icdo_xref", "unannotated ICD-O xref").otherwise(F.concat(F.lit("MONDO:"), named({"mondo:gard_xref": "GARD", "mondo:other_hierarchy": "otherHierarchy", "mondo:obsolete_equivalent": "equivalentObsolete"}, F.col("p"))))
    return [
        isa("MONDO is-a", mondo, "MONDO:", "MONDO", "mondo:is_a", "MONDO"),
        Loader("MONDO exactMatch -> other vocabularies", exact, ("MONDO", E("subject_id")), "mondo:exact_match", (vocab, E("code")), "MONDO SSSOM", [("not an exact match", E("predicate_id = 'skos:exactMatch'")), ("a vocabulary not loaded", vocab.isNotNull()), ("obsolete class", E("live"))], E("mapping_justification"), "ungraded", distinct=False),
        isa("HPO is-a", hp, "HP:", "HP", "hp:is_a", "HPO"),
        Loader("HPO xref -> NCIT / Orphanet / ICD-10", xref, ("HP", E("id")), "hp:xref", (E("v"), E("substring(to, instr(to, ':') + 1)")), "HPO", [("a vocabulary not loaded", E("v is not null"))], E("split_part(to, ':', 1)")),
        Loader("HPO disease -> phenotype", ann, (E("v"), E("code")), E("if(qualifier = 'NOT', 'hpo:lacks_phenotype', 'hpo:has_phenotype')"), ("HP", E("hpo_id")), "HPO annotations", [("not a phenotype annotation", E("aspect = 'P'")), ("disease vocabulary not loaded", E("v in ('OMIM', 'ORPHA', 'DECIPHER')"))], E("evidence"), place=E("reference"), attrs=facts(frequency="frequency"), distinct=False),
        Loader("Uberon is-a / part-of", part, ("UBERON", E("id")), E("p"), ("UBERON", E("to")), "Uberon", [live, ("target outside the ontology", E("to like 'UBERON:%'"))], distinct=False),
        Loader("Uberon -> MeSH", mesh, ("UBERON", E("id")), "uberon:mesh_xref", ("MESH", E("to")), "Uberon", [live, ("not a descriptor", F.col("to").rlike("^[DC][0-9]+$"))], "database cross-reference"),
        mapped("Uberon -> SNOMED body structure", i["uberon_sssom"], "UBERON:", "SCTID", "SCT", "UBERON", "uberon:sct_narrow_match", "skos:narrowMatch", "ungraded", "Uberon SSSOM"),
        mapped("Uberon -> NCI Thesaurus anatomy", i["uberon_sssom"], "UBERON:", "NCIT", "NCIT", "UBERON", "uberon:ncit_narrow_match", "skos:narrowMatch", "native", "Uberon SSSOM"),
        mapped("Uberon <-> FMA", i["uberon_sssom"], "UBERON:", "FMA", "FMA", "UBERON", "uberon:fma_match", None, "native", "Uberon SSSOM"),
        Loader("MONDO disease -> location / infectious agent", said.where(F.col("kind").isin(list(place))), ("MONDO", E("id")), F.concat(F.lit("mondo:"), "kind"), (F.coalesce(*ends), E("if(at like 'NCBITaxon:%', substring(at, 11), at)")), "MONDO", [("target in another vocabulary", F.coalesce(*ends).isNotNull())]),
        Loader("MONDO disease -> causal gene", said.where("kind = 'has_material_basis_in_germline_mutation_in'"), ("MONDO", E("id")), "mondo:germline_gene", ("HGNC", E("concat('HGNC:', substring_index(at, '/', -1))")), "MONDO", [("not a human gene", E("at like '%/hgnc/%'"))], E("kind")),
        Loader("MONDO disease -> HPO feature", said.where(F.col("kind").isin(feature)), ("MONDO", E("id")), "mondo:has_feature", ("HP", E("at")), "MONDO", [("not a phenotype", E("at like 'HP:%'"))], E("kind")),
        Loader("MONDO disease -> annotated xrefs", note, ("MONDO", E("id")), E("p"), (v, code), "MONDO", [("an exact match, a retiring class or another annotation", E("p is not null"))], how),
        Loader("HPO gene -> disease", i["hp_genes"], ("NCBIGENE", E("split_part(ncbi_gene_id, ':', 2)")), "hpo:gene_disease", (E("split_part(disease_id, ':', 1)"), E("split_part(disease_id, ':', 2)")), "HPO", [("disease vocabulary not loaded", E("split_part(disease_id, ':', 1) in ('OMIM', 'ORPHA')"))], E("association_type"), attrs=facts(gene_symbol="gene_symbol")),
    ]


def drugcentral(i: Inputs) -> list[Loader]:
    me, source, ids = ("DRUGCENTRAL", E("struct_id")), "DrugCentral", i["dc_id"]
    c = i["C"].where("vocabulary_id = 'RxNorm'").select("concept_id", "concept_code", "concept_class_id", "standard_concept")
    own = ids.where("id_type = 'RXNORM'").select("struct_id", "identifier").distinct().join(c.withColumnRenamed("concept_code", "identifier"), "identifier", "left")
    goal = c.where("concept_class_id = 'Ingredient' and standard_concept = 'S'").select(F.col("concept_id").alias("concept_id_2"), F.col("concept_code").alias("ing"))
    step = named({"Precise Ingredient": "Form of", "Brand Name": "Brand name of", "Multiple Ingredients": "Maps to"}, F.col("concept_class_id"))
    up = own.withColumnRenamed("concept_id", "concept_id_1").withColumn("relationship_id", step).join(i["CR"].where("coalesce(invalid_reason, '') = ''").drop("invalid_reason"), ["concept_id_1", "relationship_id"]).join(goal, "concept_id_2")
    itself = own.where("concept_class_id = 'Ingredient' and standard_concept = 'S'").select("struct_id", "identifier", F.col("identifier").alias("ing"), F.lit("itself").alias("via"))
    lifted = own.select("struct_id", "identifier").distinct().join(itself.union(up.select("struct_id", "identifier", "ing", "relationship_id")), ["struct_id", "identifier"], "left")
    fda, mesh = i["dc_class"].where("source = 'FDA'"), i["dc_class"].where("source = 'MeSH'")
    label = {"indication": "indication", "contraindication": "contraindication", "off-label use": "off_label_use"}
    protein = i["dc_tc"].withColumnRenamed("id", "component_id")
    moa = F.col("moa") == "1"
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return [
        Loader("DrugCentral -> RxNorm ingredient (lifted)", lifted, me, "drugcentral:rxnorm", ("RXN", E("ing")), source, [("not liftable to a standard ingredient", E("ing is not null"))], E("concat('RXNORM ', via)"), "ungraded", attrs=facts(id_rxcui="identifier", lifted_via="via")),
        Loader("DrugCentral -> SNOMED", ids.where("id_type = 'SNOMEDCT_US'"), me, "drugcentral:snomed", ("SCT", E("identifier")), source, [], E("id_type"), "ungraded"),
        Loader("DrugCentral -> other identifiers", ids.where(F.col("id_type").isin(list(DRUG_IDS))), me, "drugcentral:xref", (named(DRUG_IDS, F.col("id_type")), E("replace(identifier, 'CHEBI:', '')")), source, [("empty identifier", filled("identifier"))], E("id_type")),
        Loader("DrugCentral drug -> FDA pharmacologic class", fda, me, "fda:pharmacologic_class", ("MEDRT", E("class_code")), "FDA SPL class indexing", [("another class type", E("type in ('EPC', 'MoA', 'PE')")), ("not an N-code", E("class_code like 'N%'"))], E("type"), attrs=facts(class_name="name")),
        Loader("DrugCentral -> ATC", i["dc_atc"], me, "drugcentral:in_atc_class", ("ATC", E("atc_code")), source),
        Loader("DrugCentral drug -> condition", i["dc_omop"], me, F.concat(F.lit("drugcentral:"), named(label, F.col("relationship_name"))), ("SCT", E("snomed_conceptid")), source, [("another relationship", F.col("relationship_name").isin(list(label))), ("no SNOMED concept", filled("snomed_conceptid"))], E("relationship_name")),
        Loader("DrugCentral drug -> target", i["dc_act"], me, F.when(moa, "drugcentral:mechanism_target").otherwise("drugcentral:bioactivity"), ("DC_TARGET", E("target_id")), source, [], F.coalesce(F.when(moa, F.col("moa_source")).otherwise(F.col("act_source")), F.lit("unstated")), place=E("concat('act_id=', act_id)"), attrs=facts(action_type="action_type"), distinct=False),
        Loader("DrugCentral target -> protein component", i["dc_td"].join(protein, "component_id"), ("DC_TARGET", E("target_id")), "drugcentral:target_component", ("UNIPROT", E("accession")), source, [("no accession", filled("accession"))], attrs=facts(organism="organism")),
        Loader("protein -> gene (DrugCentral)", protein.join(i["dc_td"].select("component_id").distinct(), "component_id", "left_semi"), ("UNIPROT", E("accession")), "uniprot:encoded_by", ("NCBIGENE", E("geneid")), source, [("no gene id", filled("geneid")), ("no accession", filled("accession"))], attrs=facts(gene_symbol="gene")),
        Loader("DrugCentral drug -> MeSH pharmacological action", mesh, me, "drugcentral:mesh_pharmacological_action", ("MESH", E("class_code")), source, [("not a pharmacological action", E("type = 'PA'")), ("no code", filled("class_code"))], "MeSH pharmacological action", "ungraded"),
    ]


def services(i: Inputs) -> list[Loader]:
    items = i["mbs"].withColumn("grp", E("concat(Category, '/', Group)"))
    live = ("item ended", E("coalesce(ItemEndDate, '') = ''"))
    ends = F.array(F.struct(F.lit("MBS").alias("v"), F.col("ItemNum").alias("s"), F.lit("mbs:in_group").alias("p"), F.lit("MBS_GROUP").alias("w"), F.col("grp").alias("o")), F.struct(F.lit("MBS_GROUP").alias("v"), F.col("grp").alias("s"), F.lit("mbs:group_in_category").alias("p"), F.lit("MBS_CATEGORY").alias("w"), F.col("Category").alias("o")))
    cites = i["pbs_res"].select("res_code", F.explode(F.array_distinct(cited_items(F.regexp_replace("text", "<[^>]+>", " ")))).alias("item"))
    cites = knows(cites, "active", {"ItemNum": F.col("item")}, items.where(live[1]))
    return [
        Loader("MBS item -> group -> category", items.withColumn("x", F.explode(ends)), (E("x.v"), E("x.s")), E("x.p"), (E("x.w"), E("x.o")), "MBS XML", [live]),
        Loader("PBS restriction -> MBS item it cites", cites, ("PBS_RESTRICTION", E("res_code")), "pbs:cites_mbs_item", ("MBS", E("item")), "PBS API restrictions", [("not an active item", E("active"))], "item number in the restriction's text", distinct=False),
    ]


def taxon_name(x: Column) -> Column:
    """A taxon's name without its rank words, tags and annotations."""
    out = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    for old, new in (("\\s*\\(organism\\)$", ""), ("\\s+-\\s+.*$", ""), (f"^({RANKS}) ", ""), ("\\s+(species|sp\\.?|spp\\.?)$", ""), (" ss\\. ", " subsp. "), ("[\\[\\]]", ""), ("\\s+", " ")):
        out = F.regexp_replace(out, old, new)
    return F.trim(out)


def structure_name(x: Column) -> Column:
    """A body structure's name without the words that only say that it is one."""
    out = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    for old in ("\\s*\\(body structure\\)$", "^(entire |structure of |bone structure of )", "( region structure| structure)$"):
        out = F.regexp_replace(out, old, "")
    return F.trim(F.regexp_replace(out, "\\s+", " "))


def parts(i: Inputs) -> list[Loader]:
    """What LOINC's parts are in other vocabularies, at the part and through it at the term."""
    lpm, source = i["lpm"], "LOINC part mapping"
    link, more = i["lpl"].withColumn("f", F.lit("primary")), i["lpl_more"].where("PartTypeName <> 'SUFFIX'").withColumn("f", F.lit("supplementary"))
    detail = more.where("LinkTypeName = 'DetailedModel'")
    rich = more.where("LinkTypeName in ('SyntaxEnhancement', 'SemanticEnhancement')").join(link.union(detail).select("LoincNumber", "PartNumber"), ["LoincNumber", "PartNumber"], "left_anti")
    rich = rich.select(*link.columns)
    live = i["loinc"].where("STATUS = 'ACTIVE'").select(F.col("LOINC_NUM").alias("LoincNumber"))
    code = F.when(F.col("ExtCodeSystem") == "http://www.genenames.org", F.col("ExtCodeId")).otherwise(F.replace("ExtCodeId", F.lit("CHEBI:"), F.lit("")))
    # links whose part has a code: one row a code; others stay as rows that say so
    def coded(links: DataFrame, kinds: list[str], systems: list[str]) -> DataFrame:
        codes = lpm.where(F.col("ExtCodeSystem").isin(systems)).select("PartNumber", "PartName", "ExtCodeId", "ExtCodeSystem", "Equivalence")
        return knows(links.where(F.col("PartTypeName").isin(kinds)).join(codes, "PartNumber", "left"), "term", {"LoincNumber": F.col("LoincNumber")}, live)

    to_sct = coded(link.union(rich.where("LinkTypeName = 'SyntaxEnhancement' and PartTypeName in ('COMPONENT', 'DIVISOR', 'NUMERATOR')")), ["COMPONENT", "SYSTEM", "METHOD", "DIVISOR", "NUMERATOR"], [SNOMED_URL])
    to_code = coded(link.union(detail.select(*link.columns)).union(rich).drop("f").distinct(), ["COMPONENT", "DIVISORS", "DIVISOR", "NUMERATOR", "GENE", "CHALLENGE"], list(ANALYTES))
    every = ANALYTES | {SNOMED_URL: "SCT", RADLEX_URL: "RADLEX"}
    both = lpm.where((F.col("ExtCodeSystem") == SNOMED_URL) & (F.col("Equivalence") == "equivalent")).join(lpm.where((F.col("ExtCodeSystem") == TAXON_URL) & (F.col("Equivalence") == "equivalent")).select("PartNumber", F.col("ExtCodeId").alias("taxon")), "PartNumber", "left")
    answer = active_concept(i, i["loinc_answers"].where("ExtCodeId is not null").groupBy("AnswerStringId", "ExtCodeId", "ExtCodeSystem").agg(F.min("DisplayText").alias("answer"), F.count_distinct("AnswerListId").alias("lists")), "ExtCodeId")
    same = i["umls_taxa"].join(i["concept"].select(F.col("id").alias("source_code"), "pt"), "source_code", "left")
    as_is = F.lower(F.trim(F.coalesce("pt", F.lit("")))) == F.lower(F.trim("target_name"))
    how = F.when(as_is, "UMLS shared CUI, same name").when(taxon_name(F.col("pt")) == taxon_name(F.col("target_name")), "UMLS shared CUI, same name after rank words")
    has, on = ("the part has no such code", E("ExtCodeId is not null")), ("LOINC term not active", E("term"))
    kind = E("concat(if(f = 'primary', PartTypeName, concat(LinkTypeName, ' ', PartTypeName)), ' ', Equivalence)")
    return [
        Loader("SNOMED organism <-> NCBI Taxonomy (LOINC part)", both, ("SCT", E("ExtCodeId")), "sct:ncbitaxon_equivalent", ("NCBITAXON", E("taxon")), source, [("no equivalent taxon", E("taxon is not null"))], "LOINC part asserts both", "ungraded", place=E("concat('part ', PartNumber)")),
        Loader("LOINC term -> SNOMED via its part", to_sct, ("LOINC", E("LoincNumber")), "loinc:part_maps_to_sct", ("SCT", E("ExtCodeId")), source, [has, ("the unspecified part", E("PartName <> 'XXX'")), on], kind, place=E("concat('part ', PartNumber)"), attrs=facts(part="PartNumber", part_type="PartTypeName")),
        Loader("LOINC term -> analyte code", to_code, ("LOINC", E("LoincNumber")), "loinc:part_xref", (named(ANALYTES, F.col("ExtCodeSystem")), code), source, [has, on], E("concat(LinkTypeName, ' ', PartTypeName, ' ', Equivalence)"), place=E("concat('part ', PartNumber)")),
        Loader("LOINC part -> its code in another vocabulary", lpm, ("LOINC", E("PartNumber")), "loinc:part_code", (named(every, F.col("ExtCodeSystem")), code), source, [("not a vocabulary of the graph", F.col("ExtCodeSystem").isin(list(every))), ("the unspecified part", E("PartName <> 'XXX'"))], E("concat(PartTypeName, ' ', Equivalence)")),
        Loader("LOINC answer -> SNOMED CT", answer, ("LOINC", E("AnswerStringId")), "loinc:answer_sct", ("SCT", E("ExtCodeId")), "LOINC answer list", [("not SNOMED CT", F.col("ExtCodeSystem") == SNOMED_URL), known()], "LOINC answer external code", attrs=facts(answer="answer", answer_lists="lists")),
        Loader("SNOMED organism <-> NCBI Taxonomy (same name)", same, ("SCT", E("source_code")), "sct:ncbitaxon_equivalent", ("NCBITAXON", E("target_code")), "UMLS", [("names differ", how.isNotNull())], how, "ungraded", distinct=False),
    ]


def radiology(i: Inputs) -> list[Loader]:
    terms, book = i["radlex"], knows(i["loinc_rsna"], "term", {"LOINC_NUM": F.col("LoincNumber")}, i["loinc"].where("STATUS = 'ACTIVE'"))
    say = lambda field: terms.select("id", F.explode(field).alias("to"))
    ours, on, filled = ("target not a RadLex id", E("to like 'RID%'")), ("LOINC term not active", E("term")), lambda c: (f"no {c}", E(f"coalesce({c}, '') <> ''"))
    fields = i["rsna"].withColumn("f", F.explode(F.arrays_zip(F.split("FIELDS", "\\|").alias("name"), F.split("RIDS", "\\|").alias("rid"))))
    return [
        Loader("RadLex is-a", say("is_a"), ("RADLEX", E("id")), "radlex:is_a", ("RADLEX", E("to")), "RadLex", [ours], distinct=False),
        Loader("RadLex part-of", say("part_of"), ("RADLEX", E("id")), "radlex:part_of", ("RADLEX", E("to")), "RadLex", [ours], distinct=False),
        Loader("RadLex -> FMA", say("ext"), ("RADLEX", E("id")), "radlex:fma_xref", ("FMA", E("substring(to, 5)")), "RadLex", [("not an FMA id", E("to like 'FMA:%'"))], distinct=False),
        Loader("LOINC radiology term -> RadLex part", book, ("LOINC", E("LoincNumber")), "loinc:radlex_part", ("RADLEX", E("RID")), "LOINC/RSNA playbook", [filled("RID"), on], E("PartTypeName"), attrs=facts(part_type="PartTypeName", part="PartNumber")),
        Loader("LOINC radiology term -> RSNA playbook procedure", book, ("LOINC", E("LoincNumber")), "loinc:rsna_rpid", ("RPID", E("RPID")), "LOINC/RSNA playbook", [filled("RPID"), on], "LOINC/RSNA harmonised"),
        Loader("RSNA playbook procedure -> RadLex part", fields, ("RPID", E("RPID")), "rsna:radlex_part", ("RADLEX", E("f.rid")), "RSNA playbook", [("status neither ACTIVE nor TRIAL", E("STATUS in ('ACTIVE', 'TRIAL')")), ("no RadLex id", E("f.rid like 'RID%'"))], E("f.name"), attrs=facts(field="f.name")),
    ]


def anatomy(i: Inputs) -> list[Loader]:
    """RadLex to SNOMED CT body structures by three routes of codes, and LOINC terms through them."""
    ext = i["radlex"].select(F.col("id").alias("rid"), F.explode("ext").alias("x"))
    fma, cui = ext.where("x like 'FMA:%'").select("rid", E("substring(x, 5)").alias("fma")), ext.where("x like 'UMLS:%'").select("rid", E("substring(x, 6)").alias("cui"))
    one = fma.join(of(i, "uberon:fma_match", "uberon", "fma"), "fma").join(of(i, "uberon:sct_narrow_match", "uberon", "sct"), "uberon").select("rid", "sct", F.lit("FMA -> Uberon -> SNOMED CT").alias("route"))
    two = fma.join(i["umls_fma"].toDF("fma", "sct"), "fma").select("rid", "sct", F.lit("FMA -> UMLS shared CUI"))
    three = cui.join(i["umls_radlex"].toDF("cui", "sct"), "cui").select("rid", "sct", F.lit("RadLex CUI -> UMLS atoms"))
    rows = knows(one.union(two).union(three).distinct(), "body", {"id": F.col("sct")}, i["concept"].where("tag = 'body structure'"))
    return [Loader("RadLex -> SNOMED CT body structure", rows, ("RADLEX", E("rid")), "radlex:anatomy_sct", ("SCT", E("sct")), "RadLex + Uberon + UMLS", [("not an active body structure", E("body"))], E("route"), "ungraded")]


def anatomy_terms(i: Inputs) -> list[Loader]:
    kind = F.get_json_object("attrs", "$.part_type")
    p = i["edge"].where(F.col("predicate") == "loinc:radlex_part").where(kind.like("Rad.Anatomic Location.%") & ~kind.like("%Laterality%")).select(F.col("s_code").alias("loinc"), F.col("o_code").alias("rid"))
    a = i["edge"].where("predicate = 'radlex:anatomy_sct'").select(F.col("s_code").alias("rid"), F.col("o_code").alias("sct"), F.col("method").alias("route"))
    return [Loader("LOINC radiology term -> SNOMED via its anatomy", p.join(a, "rid"), ("LOINC", E("loinc")), "loinc:part_maps_to_sct", ("SCT", E("sct")), "LOINC/RSNA playbook", [], E("concat('RadLex anatomy: ', route)"), "ungraded", attrs=facts(rid="rid", route="route"))]


def genes(i: Inputs) -> list[Loader]:
    """Only genes that something else in the graph names."""
    ids = {"entrez_id": "NCBIGENE", "uniprot_ids": "UNIPROT", "omim_id": "OMIM"}
    each = F.flatten(F.array(*[_codes(c, v) for c, v in ids.items()]))
    rows = i["hgnc"].withColumn("x", F.explode(each))
    rows = held(i, held(i, rows, "own", "HGNC", F.col("hgnc_id")), "known", F.col("x.v"), F.col("x.code"))
    joined = rows.where("own or known").select("hgnc_id").distinct().withColumn("joins", F.lit(True))
    rows = rows.join(joined, "hgnc_id", "left")
    return [Loader("HGNC gene -> NCBI Gene / UniProt / OMIM", rows, ("HGNC", E("hgnc_id")), "hgnc:xref", (E("x.v"), E("x.code")), "HGNC", [("entry withdrawn", E("status = 'Approved'")), ("no id shared with the graph", E("joins"))], E("x.field"))]


def _codes(column: str, vocab: str) -> Column:
    return F.transform(F.filter(F.split(F.coalesce(column, F.lit("")), "\\|"), lambda x: x != ""), lambda x: F.struct(F.lit(vocab).alias("v"), F.trim(x).alias("code"), F.lit(column).alias("field")))


def orphanet(i: Inputs) -> list[Loader]:
    source, me = "Orphanet", ("ORPHA", E("orpha"))
    v = named(ORPHANET, F.col("vocab"))
    moved = {"Moved to": "orpha:moved_to", "Referred to": "orpha:referred_to"}
    return [
        Loader("Orphanet disorder -> its alignments", i["orpha_xref"], me, "orpha:xref", (v, E("if(vocab = 'MONDO', concat('MONDO:', lpad(ref, 7, '0')), ref)")), source, [("a vocabulary not loaded", v.isNotNull()), ("no reference", E("coalesce(ref, '') <> ''"))], E("coalesce(nullif(split_part(relation, ' ', 1), ''), 'unqualified')"), attrs=facts(validation="validation")),
        refset(i, "SNOMED CT -> Orphanet", "orpha_map", "sct:orphanet_map", "ORPHA", "mapTarget", ["784008009"], "SNOMED CT to Orphanet simple map", "SNOMED International / Inserm"),
        Loader("Orphanet entry -> where it moved / is referred to", i["orpha_moved"], me, named(moved, F.col("kind")), ("ORPHA", E("target")), source, [("another association", F.col("kind").isin(list(moved))), ("no target", E("target is not null"))], E("kind")),
        Loader("Orphanet gene -> disorder", i["orpha_gene"], ("HGNC", E("concat('HGNC:', hgnc)")), "orpha:gene_disease", ("ORPHA", E("orpha")), source, [("not yet assessed", E("status = 'Assessed'")), ("no HGNC id", E("hgnc is not null"))], E("kind"), attrs=facts(symbol="symbol")),
        Loader("Orphanet disorder -> HPO phenotype", i["orpha_hpo"], me, E("if(frequency like 'Excluded%', 'orpha:lacks_phenotype', 'orpha:has_phenotype')"), ("HP", E("hpo")), source, [("no code", E("orpha is not null and hpo is not null"))], E("coalesce(frequency, 'frequency not stated')")),
    ]


def _revision(i: Inputs, name: str) -> DataFrame:
    """A table between revisions: codes, the entity and the linearised entity, and which of them the graph holds."""
    rows = i[name].withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in ("icd10Code", "icd11Code")})
    rows = rows.withColumn("entity", E("nullif(regexp_extract(foundation, '/entity/([^/]+)/?$', 1), '')")).withColumn("mms", E("nullif(regexp_extract(linear, '/mms/([^/]+)', 1), '')"))
    for flag, v, c in (("t10", "ICD10WHO", "icd10Code"), ("t11", "ICD11MMS", "icd11Code"), ("tf", "ICD11", "entity")):
        rows = held(i, rows, flag, v, F.col(c))
    return rows


def classifications(i: Inputs) -> list[Loader]:
    """The published tables between two revisions of a classification, where the graph names one of a row's codes.

    ``who``: forward (one or several categories), ``who_back``, and the same for the foundation; codes trimmed, entities by their last part.
    """
    w, b, f, g = (_revision(i, x) for x in ("who", "who_back", "who_foundation_back", "who_foundation"))
    need = lambda *cs: ("a code is missing", E(" and ".join(f"{c} is not null" for c in cs)))
    touch = lambda *fs: ("no code shared with the graph", E(" or ".join(fs)))
    ten, mms, ent = ("ICD10WHO", E("icd10Code")), ("ICD11MMS", E("icd11Code")), ("ICD11", E("entity"))
    return [
        Loader("WHO ICD-10 -> ICD-11 (MMS)", w, ten, "who:icd10_to_icd11", mms, "WHO", [need("icd10Code", "icd11Code"), touch("t10", "t11", "tf")], E("how"), attrs=facts(icd11_foundation="entity")),
        Loader("WHO ICD-11 (MMS) -> ICD-10", b, mms, "who:icd11_to_icd10", ten, "WHO", [need("icd10Code", "icd11Code"), touch("t10", "t11")], "one category"),
        Loader("WHO ICD-11 foundation entity -> ICD-10", f, ent, "who:icd11_to_icd10", ten, "WHO", [need("entity", "icd10Code"), touch("t10", "tf")], "foundation, one category"),
        Loader("WHO ICD-10 -> ICD-11 foundation entity", g, ten, "who:icd10_to_icd11", ent, "WHO", [need("entity", "icd10Code"), touch("t10", "tf")], "foundation, one category"),
    ]


def linearised(i: Inputs) -> list[Loader]:
    """A code and the entity that it stands for, where a row states both."""
    w, f = _revision(i, "who").where("mms = entity"), _revision(i, "who_foundation_back")
    both = w.select("icd11Code", "entity", "t11", "tf").union(f.select("icd11Code", "entity", "t11", "tf")).where("icd11Code is not null and entity is not null").distinct()
    return [Loader("ICD-11 MMS code -> its foundation entity", both, ("ICD11MMS", E("icd11Code")), "who:icd11_mms_foundation", ("ICD11", E("entity")), "WHO", [("no code shared with the graph", E("t11 or tf"))], "stated on the same row")]


def pathways(i: Inputs) -> list[Loader]:
    human, out = ("not a human pathway", E("species = 'Homo sapiens'")), []
    for label, table, vocab in (("UniProt protein -> Reactome pathway", "reactome_protein", "UNIPROT"), ("ChEBI chemical -> Reactome pathway", "reactome_chebi", "CHEBI")):
        out.append(Loader(label, i[table], (vocab, E("id")), "reactome:participates_in", ("REACTOME", E("pathway")), "Reactome", [human], E("evidence"), attrs=facts(evidence="evidence")))
    ours = i["reactome"].where(human[1])
    rows = knows(knows(i["reactome_rel"], "p", {"id": F.col("parent")}, ours), "c", {"id": F.col("child")}, ours)
    return [*out, Loader("Reactome pathway -> parent pathway", rows, ("REACTOME", E("child")), "reactome:part_of", ("REACTOME", E("parent")), "Reactome", [("not a pair of human pathways", E("p and c"))])]


def likelihood(i: Inputs) -> list[Loader]:
    """Transcribed ratios whose number was verified, whose ends are bound, and whose family of bindings has earned a tier."""
    review = i["lr_review"].select("family", ((F.col("n").cast("int") >= 30) & (wilson(F.col("n").cast("int") - F.col("wrong").cast("int"), F.col("n").cast("int"))[0] >= 0.8)).alias("admitted"))
    rows = i["lr"].withColumn("family", E("if(kind = 'finding', 'finding', 'test_score_prognosis')")).join(review, "family", "left")
    ranged, reported = F.col("lr").isNull() & F.col("lr_range").isNotNull(), F.col("lr").isNotNull()
    derived = E("if(shown = 'present', double(sens) / (1 - double(spec)), (1 - double(sens)) / double(spec))")
    value = F.when(reported, F.col("lr").cast("double")).when(~ranged, derived)
    predicate = E("CASE kind WHEN 'finding' THEN concat('finding_lr_if_', shown) WHEN 'test' THEN 'test_result_lr' WHEN 'score' THEN 'score_result_lr' WHEN 'prognosis' THEN 'finding_lr_for_outcome' END")
    how = F.when(reported, "LR as reported").when(ranged, "LR range across studies").otherwise("LR derived from pooled sensitivity and specificity")
    keep = [("number not verified", E("verified = 'true'")), ("an end is not bound", E("finding is not null and diagnosis is not null")), ("family not admitted", E("coalesce(admitted, false)"))]
    return [Loader("finding -> diagnosis likelihood ratio", rows, ("SCT", E("finding")), predicate, ("SCT", E("diagnosis")), "PubMed abstract", keep, how, "ungraded", "corrected_pending_attestation", place=E("concat('PMID:', pmid, ' record=', id)"), attrs=F.to_json(F.struct(F.round(value, 3).alias("lr"))), distinct=False)]


def metathesaurus(i: Inputs) -> list[Loader]:
    """Codes under one concept: same-name pairs, members of concepts the graph names, and what its sources state."""
    source = "UMLS"
    hp = active_concept(i, i["umls_hp"], "snomed_code").join(i["hp"].where("not obsolete").select(F.col("id").alias("hpo_id"), F.col("name").alias("hp_name")), "hpo_id", "left").join(i["concept"].select(F.col("id").alias("snomed_code"), "pt"), "snomed_code", "left")
    plain = squash_vowels(F.col("hp_name"))
    same = (plain == squash_vowels(F.col("pt"))) | (plain == squash_vowels(F.col("snomed_name")))
    ccsr = held(i, i["mrmap"].where("MAPSETSAB = 'CCSR_ICD10CM'"), "node", "ICD10CM", F.col("FROMEXPR"))
    gene = of(i, "hgnc:xref", "_g", "c").join(i["edge"].where("predicate = 'hgnc:xref' and o_vocab = 'OMIM'").select(F.col("o_code").alias("c")).distinct(), "c", "left_semi").select("c")
    up = held(i, held(i, i["umls_pairs"], "s_held", F.col("sv"), F.col("sc")), "o_held", F.col("ov"), F.col("oc"))
    up = knows(knows(up, "s_gene", {"c": F.col("sc")}, gene), "o_gene", {"c": F.col("oc")}, gene)
    up = knows(knows(up, "s_known", {"id": F.col("sc")}, i["concept"]), "o_known", {"id": F.col("oc")}, i["concept"])
    def either(rule: str) -> str:
        """A rule on one side (x) and the other (y), either way round."""
        return "(" + " or ".join("(" + rule.replace("{x}", a).replace("{y}", b) + ")" for a, b in (("s", "o"), ("o", "s"))) + ")"

    gene_rule = either("{x}v = 'OMIM' and {x}_gene and not ({y}v = 'HGNC' or ({y}v = 'NCIT' and lower({y}_name) like '% gene'))")
    fusion, prone = either("{x}v = 'NCIT' and lower({x}_name) like '%fusion gene%' and {y}v = 'OMIM'"), either("{x}v = 'OMIM' and lower({x}_name) like '%susceptib%' and lower({y}_name) not like '%susceptib%'")
    keep = [("neither code a node the graph holds", E("s_held or o_held")), ("a gene entry paired with a non-gene", E(f"not {gene_rule}")), ("SNOMED code not active", E("(sv <> 'SCT' or s_known) and (ov <> 'SCT' or o_known)")), ("a fusion gene with a gene entry", E(f"not {fusion}")), ("a susceptibility entry with another concept", E(f"not {prone}")), ("loaded by its own family", E("not (sv = 'NCBITAXON' and ov = 'SCT')")), ("names differ", E("same_name"))]
    atoms = held(i, knows(i["mrconso"].where("SAB = 'SNOMEDCT_US'"), "clinical", {"id": F.col("CODE")}, i["concept"].where("tag in ('disorder', 'finding')")), "node", "UMLS", F.col("CUI"))
    member = held(i, i["wave_members"].where("v in ('HP', 'MESH', 'NCIT')"), "node", "UMLS", F.col("cui"))
    unii = held(i, held(i, i["wave_unii"], "a_held", "UNII", F.col("unii")), "b_held", "RXN", F.col("rxcui"))
    return [
        Loader("HPO phenotype -> SNOMED (same name)", hp, ("HP", E("hpo_id")), "hp:umls_snomed", ("SCT", E("snomed_code")), source, [("no SNOMED code", E("coalesce(snomed_code, '') <> ''")), known(), ("HPO term unknown", E("hp_name is not null")), ("names differ", same)], "shared CUI + same name", "2"),
        Loader("ICD-10-CM -> CCSR clinical category", ccsr, ("ICD10CM", E("FROMEXPR")), "ccsr:category", ("CCSR", E("TOEXPR")), "AHRQ CCSR", [("no code", E("FROMEXPR is not null and TOEXPR is not null")), ("code not in the graph", E("node"))], E("RELA"), attrs=facts(body_system="left(TOEXPR, 3)")),
        Loader("UMLS shared CUI, same name", up, (E("sv"), E("sc")), "umls:shared_cui", (E("ov"), E("oc")), source, keep, E("concat(sv, '-', ov, ' same name')"), "ungraded", place=E("concat('CUI ', cui)"), attrs=facts(shared_name="shared_name")),
        Loader("UMLS concept -> SNOMED CT disorder / finding", atoms, ("UMLS", E("CUI")), "umls:concept_member", ("SCT", E("CODE")), source, [("suppressed", E("SUPPRESS = 'N'")), ("CUI not in the graph", E("node")), ("not an active disorder or finding", E("clinical"))], "SNOMED CT atom in the concept", "ungraded"),
        Loader("UMLS disease concept -> its HPO / MeSH / NCIt code", member, ("UMLS", E("cui")), "umls:disease_member", (E("v"), E("code")), source, [("names differ", E("gate = 'true'")), ("already reached", E("present = 'false'")), ("CUI not in the graph", E("node"))], "atom in the concept, same name", "ungraded"),
        Loader("UNII substance <-> RxNorm ingredient", unii, ("UNII", E("unii")), "umls:unii_rxnorm", ("RXN", E("rxcui")), source, [("names differ", E("gate = 'true'")), ("already reached", E("present = 'false'")), ("neither in the graph", E("a_held or b_held"))], "shared CUI, same name", "ungraded", attrs=facts(rxnorm_tty="tty")),
    ]


def chains(i: Inputs) -> list[Loader]:
    """Orphanet disorders without an ICD-10 code of their own, by the code of their SNOMED CT concept where that is single and unconditional."""
    x = i["edge"].where("predicate = 'orpha:xref' and method = 'E'").select(F.col("s_code").alias("orpha"), "o_vocab", F.col("o_code").alias("mid"))
    by_cui = x.where("o_vocab = 'UMLS'").join(of(i, "umls:concept_member", "mid", "sct"), "mid").withColumn("via", F.lit("via SNOMED CT (UMLS concept)"))
    exact = i["edge"].where("predicate = 'mondo:exact_match' and o_vocab = 'SCT'").select(F.col("s_code").alias("mid"), F.col("o_code").alias("sct"))
    by_mondo = x.where("o_vocab = 'MONDO'").join(exact, "mid").withColumn("via", F.lit("via SNOMED CT (MONDO)"))
    m = i["edge"].where("predicate = 'sct:icd10_map'").withColumn("grp", F.get_json_object("attrs", "$.group").cast("int"))
    single = m.groupBy(F.col("s_code").alias("sct")).agg(F.max("grp").alias("g"), F.bool_and(F.col("method") == "unconditional").alias("sure")).where("g = 1 and sure").select("sct")
    has = i["edge"].where("predicate = 'orpha:xref' and o_vocab = 'ICD10WHO'").select(F.col("s_code").alias("orpha"))
    level = i["orpha_level"].where("level in ('Disorder', 'Subtype of disorder') and active = 'true'").select("orpha")
    rows = by_cui.unionByName(by_mondo).join(single, "sct", "left_semi").join(m.select(F.col("s_code").alias("sct"), F.col("o_code").alias("icd")), "sct").join(level, "orpha", "left_semi").join(has, "orpha", "left_anti")
    rows = rows.groupBy("orpha", "icd", "via").agg(F.array_sort(F.collect_set("mid")).alias("mids"), F.array_sort(F.collect_set("sct")).alias("scts"))
    return [Loader("Orphanet disorder -> ICD-10 via SNOMED CT's map", rows, ("ORPHA", E("orpha")), "orpha:icd10_via_snomed", ("ICD10WHO", E("icd")), "derived", [], E("via"), "ungraded", attrs=facts(intermediate="mids", snomed="scts"))]


def hierarchies(i: Inputs) -> list[Loader]:
    """What sources state above the nodes that the graph holds, and drug knowledge between its nodes."""
    rel = i["mrrel"]
    up = rel.where("predicate = 'umls:source_parent'").withColumns({"child": F.concat_ws(" ", "s_vocab", "s_code"), "parent": F.concat_ws(" ", "o_vocab", "o_code")})
    seeds = present(i).where("v in ('MESH', 'NCIT', 'FMA', 'LOINC')").select(F.concat_ws(" ", "v", "c").alias("node"))
    reached = climb(seeds, up.select("child", "parent").distinct()).select("child").distinct()
    up = knows(up, "above", {"child": F.col("child")}, reached)
    drug = held(i, held(i, rel.where("sab = 'MED-RT'"), "s_held", F.col("s_vocab"), F.col("s_code")), "o_held", F.col("o_vocab"), F.col("o_code"))
    s, o, drug_in = (E("s_vocab"), E("s_code")), (E("o_vocab"), E("o_code")), ("drug not in the graph", E("s_held"))
    chebi = i["chebi"].where("not obsolete")
    live = chebi.select(E("substring(id, 7)").alias("c"))
    mine = present(i).where("v = 'CHEBI'").select("c").join(live, "c", "left_semi")
    role = chebi.select(E("substring(id, 7)").alias("c"), F.explode("relationship").alias("r")).where("r like 'RO:0000087 CHEBI:%'").select("c", E("split_part(r, 'CHEBI:', 2)").alias("role"))
    role = knows(role.join(mine, "c", "left_semi"), "live", {"c": F.col("role")}, live)
    tree = chebi.select(E("substring(id, 7)").alias("child"), F.explode("is_a").alias("p")).select("child", E("substring(p, 7)").alias("parent"))
    tree = tree.join(live.toDF("parent"), "parent", "left_semi").select("child", "parent")
    climbed = climb(mine.toDF("node").union(role.where("live").select("role")).distinct(), tree)
    atoms = i["mrconso_all"].select("AUI", "CODE")
    raw = i["mrrel_raw"].join(atoms.toDF("AUI1", "code1"), "AUI1").join(atoms.toDF("AUI2", "code2"), "AUI2")
    heading = held(i, raw.where("SAB = 'MSH' and RELA = 'mapped_to'"), "node", "MESH", F.col("code2"))
    mg = i["medgen"]
    uid = mg.where("source = 'MedGen'").select("cui", F.col("id").alias("uid"))
    mg = active_concept(i, held(i, mg.where("source <> 'MedGen'").join(uid, "cui"), "node", "MEDGEN", F.col("uid")), "id")
    against = ["Disputed Evidence", "Refuted Evidence", "No Known Disease Relationship"]
    calls = i["gencc"].groupBy("gene_curie", "disease_curie", "submitter_curie").agg(F.min("submitter_title").alias("by"), F.min(F.when(~F.col("classification_title").isin(against), F.col("classification_title"))).alias("call"), F.count_if(~F.col("classification_title").isin(against)).alias("submissions"))
    return [
        Loader("UMLS: a source's own hierarchy", up, s, "umls:source_parent", o, E("concat('UMLS (', sab, ')')"), [("not above a node the graph holds", E("above"))], E("concat(sab, ' ', rela)")),
        Loader("UMLS: MED-RT drug -> disease", drug.where("o_vocab <> 'MEDRT'"), s, E("predicate"), o, "UMLS (MED-RT)", [drug_in, ("disease not in the graph", E("o_held"))], E("how"), "ungraded"),
        Loader("UMLS: MED-RT drug -> mechanism / effect class", drug.where("o_vocab = 'MEDRT'"), s, E("predicate"), o, "UMLS (MED-RT)", [drug_in], E("how"), "ungraded"),
        related(i, "ATC class -> parent class (Athena)", "ATC", ["ATC"], {"Is a": "atc:is_a"}),
        related(i, "ATC class -> RxNorm drug", "ATC", ["RxNorm", "RxNorm Extension"], {k: f"atc:rxnorm_{x}" for k, x in ATC_KIND.items()}, both_held=True),
        related(i, "RxNorm Extension -> RxNorm", "RxNorm Extension", ["RxNorm"], {k: f"rxe:{x}" for k, x in EXTENSION.items()}, both_held=True),
        Loader("MeSH supplementary record -> heading", heading, ("MESH", E("code2")), "mesh:mapped_to", ("MESH", E("code1")), "UMLS (MSH)", [("record not in the graph", E("node"))], "MeSH heading mapped to"),
        Loader("MED-RT class -> parent class", raw.where("SAB = 'MED-RT' and REL = 'PAR' and code2 like 'N%'"), ("MEDRT", E("code1")), "medrt:is_a", ("MEDRT", E("code2")), "UMLS (MED-RT)", [("child is a drug, not a class", E("code1 like 'N%'"))], "MED-RT class hierarchy"),
        Loader("MedGen concept -> its codes", mg, ("MEDGEN", E("uid")), "medgen:xref", (named(MEDGEN, F.col("source")), E("if(source = 'Orphanet', replace(id, 'Orphanet_', ''), id)")), "NCBI MedGen", [("a source the graph does not hold", F.col("source").isin(list(MEDGEN))), ("concept not in the graph", E("node")), ("SNOMED code not active", E("source <> 'SNOMEDCT_US' or known"))], E("concat('MedGen concept groups ', source)")),
        Loader("GenCC gene -> disease validity", calls, ("HGNC", E("gene_curie")), "gencc:gene_disease", ("MONDO", E("disease_curie")), "GenCC", [("a claim against the link", E("call is not null")), ("not HGNC / MONDO", E("gene_curie like 'HGNC:%' and disease_curie like 'MONDO:%'"))], E("call"), place=E("by"), attrs=facts(submitter="by", submissions="submissions"), distinct=False),
        Loader("ChEBI entity -> role", role, ("CHEBI", E("c")), "chebi:has_role", ("CHEBI", E("role")), "ChEBI", [("role obsolete", E("live"))], "has role"),
        Loader("ChEBI entity -> parent", climbed, ("CHEBI", E("child")), "chebi:is_a", ("CHEBI", E("parent")), "ChEBI"),
    ]


def foreign(i: Inputs) -> list[Loader]:
    """SNOMED ids that the release lacks: its own answer where it has one, and the nearest ancestor that it carries."""
    own = i["concept"].select("id").union(i["lx_concept"].select("id")).distinct()
    alien = present(i).where("v = 'SCT'").select(F.col("c").alias("code")).join(own.toDF("code"), "code", "left_anti")
    names = i["concept"].select("id", "pt")
    gone = i["association"].where("refsetId not in ('734138000', '734139008')").join(names.toDF("refsetId", "kind"), "refsetId").select("active", F.col("referencedComponentId").alias("code"), F.col("targetComponentId").alias("now"), "kind")
    mapped_ = i["value_map"].join(names.toDF("mapType", "k"), "mapType").select("active", F.col("referencedComponentId").alias("code"), F.col("targetSnomedCtSubstance").alias("now"), F.concat(F.lit("Substance map: "), "k").alias("kind"))
    moved = knows(knows(gone.union(mapped_), "alien", {"code": F.col("code")}, alien), "ours", {"id": F.col("now")}, own)
    c = i["C"].where("vocabulary_id = 'SNOMED'").select("concept_id", "concept_code")
    up = i["CA"].where("min_levels_of_separation <> '0'").join(c.toDF("descendant_concept_id", "code"), "descendant_concept_id").join(alien, "code", "left_semi").join(c.toDF("ancestor_concept_id", "anc"), "ancestor_concept_id").join(own.toDF("anc"), "anc", "left_semi").select("code", "anc", F.col("min_levels_of_separation").cast("int").alias("levels"))
    up = up.join(up.groupBy("code").agg(F.min("levels").alias("levels")), ["code", "levels"])
    return [
        Loader("retired SNOMED -> current", moved, ("SCT", E("code")), "sct:historical_association", ("SCT", E("now")), "SNOMED CT-AU RF2", [active(), ("not an id the release lacks", E("alien")), ("target not in the release", E("ours"))], E("kind")),
        Loader("foreign SNOMED -> nearest ancestor", up, ("SCT", E("code")), "sct:au_nearest_ancestor", ("SCT", E("anc")), "OMOP Athena", [], "nearest ancestor in SNOMED CT-AU", attrs=facts(levels_up="levels")),
    ]


def decided(i: Inputs) -> list[Loader]:
    rows = active_concept(i, i["decisions"].join(i["queues"], "queue", "left"), "o_code")
    keep = [("recorded, not an edge", E("decision = 'accept' and o_code is not null")), ("SNOMED concept no longer active", E("o_vocab <> 'SCT' or known"))]
    return [Loader("Decisions by a person", rows, (E("s_vocab"), E("s_code")), E("predicate"), (E("o_vocab"), E("o_code")), "reviewer", keep, E("concat('confirmed by ', reviewer, ' ', date)"), "decision", attrs=facts(queue="queue"), distinct=False)]


def icd10cm(i: Inputs) -> list[Loader]:
    """Every target of a code, with how many it has: together they are its meaning."""
    x = related(i, "ICD-10-CM -> SNOMED", "ICD10CM", ["SNOMED"], {"Maps to": "icd10cm:maps_to"}, "ungraded")
    kept = x.rows
    for _, condition in x.keep:
        kept = kept.where(condition)
    x.rows = x.rows.join(kept.groupBy("a").agg(F.count(F.lit(1)).alias("targets")), "a", "left")
    x.attrs = facts(targets_of_code="targets", icd_deprecated="coalesce(a_invalid, '') = 'D'")
    return [x]


#: In the order of loading; a group after a bar reads the graph that the groups before it have made.
GROUPS: list[list[Callable[[Inputs], list[Loader]]]] = [
    [snomed, medicines, loinc, icd10cm, ontologies, drugcentral, services, parts, radiology, orphanet, pathways, likelihood],
    [fifth_characters, interpreted, anatomy, genes],
    [anatomy_terms, classifications],
    [metathesaurus, linearised],
    [chains, hierarchies],
    [foreign],
    [decided],
]


def assemble(inputs: Inputs, groups: list[list[Callable[[Inputs], list[Loader]]]] = GROUPS) -> tuple[DataFrame, list[Loader]]:
    """(the graph, the loaders as they were run)."""
    inputs, graph, run = dict(inputs), None, []
    for group in groups:
        loaders = [x for make in group for x in make(inputs)]
        run += loaders
        for x in loaders:
            graph = x.edges() if graph is None else graph.unionByName(x.edges())
        graph = inputs["edge"] = stored(graph.select(*EDGE), "graph")
    return graph, run

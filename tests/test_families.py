"""A small world of every input, and the edges that each family makes of it."""

import pytest
from pyspark.sql import functions as F

from vocabmill.operators import edges
from vocabmill.sources import families

#: name: columns; then a row a line. ``-`` is null, ``~`` a blank.
WORLD = """
concept: id pt tag / c1 Heart~structure body~structure / c2 Asthma disorder / c3 Salmonella~species organism / c4 REPLACED~BY foundation / s1 Problem~set foundation / c5 Glucose~measurement procedure / c6 Hyperglycaemia finding / c7 Fever finding
rel: src typ dst grp / c2 116680003 c6 0 / c6 363714003 c5 1 / c6 363713009 q1 1 / c5 246093002 glu 0 / c5 116686009 blood 0 / serum 116680003 blood 0 / obs1 246093002 glu 0 / obs1 704327008 serum 0
simple_map: active refsetId referencedComponentId mapTarget / 1 446608001 c2 C50 / 0 446608001 c6 C51 / 1 11000168105 c1 99
association: active refsetId referencedComponentId targetComponentId / 1 734138000 c1 c8 / 0 734139008 c1 c9 / 1 c4 f1 c2 / 1 c4 c2 c6
simple_set: active refsetId referencedComponentId / 1 s1 c2 / 1 s1 zz
ext_map: refsetId referencedComponentId mapTarget mapRule mapGroup mapPriority mapAdvice / 447562003 c2 M41.15 TRUE 1 1 a / 447562003 c6 - TRUE 1 1 a / 6011000124106 c2 I1 TRUE 1 1 a / 6011000124106 c6 I1XX? IFA~x 1 1 a
C: concept_id vocabulary_id concept_code concept_class_id standard_concept invalid_reason / 1 LOINC l1 Lab S - / 2 SNOMED c5 Proc S - / 3 RxNorm r1 Ingredient S - / 4 RxNorm r2 Precise~Ingredient - - / 5 ICD10CM I1 Code - - / 6 SNOMED c2 Dis S - / 7 ATC A1 ATC - - / 8 ATC A ATC - - / 9 RxNorm~Extension x1 Drug S - / 10 SNOMED f1 Dis S -
CR: concept_id_1 concept_id_2 relationship_id invalid_reason / 1 2 Is~a - / 1 2 Other - / 4 3 Form~of - / 5 6 Maps~to - / 5 2 Maps~to D / 7 8 Is~a - / 7 3 ATC~-~RxNorm - / 9 3 RxNorm~is~a -
CA: ancestor_concept_id descendant_concept_id min_levels_of_separation / 6 10 1 / 2 10 2 / 10 10 0
omop_drug: product_id level standard_concept_id refused_standard_concept_id review_status / p1 TPUU 3 - ok / p2 TPUU 99 - ok / p3 TPUU - 9 no
omop_check: product_id source verdict / p1 omop_drug agrees
omop_indirect: product_id level route via_product_id standard_concept_id / p4 TPP up p1 3
std_ingredient: substance_id vocabulary code source tier state / u1 RxNorm r1 route:x 1 asserted
product_atc: product_id atc_code source atc_level / p1 A1 pbs 5
pbs_amt: amt_code li_item_id concept_type_code / p1 100_7 TPUU / - 5_1 TPP
pbs_rel: pbs_code res_code benefit_type_code / 100 R1 U
pbs_text: res_code prescribing_text_id / R1 7 / R1 8
pbs_ind: indication_prescribing_txt_id condition severity episodicity / 7 asthma severe acute
pbs_bind: id text concept_id method / 7 asthma c2 exact / 8 x - -
corpus_bind: condition concept_id method / asthma c2 exact / gout - -
pbs_atc: atc_code atc_parent_code atc_level / A1 A 2 / A - 1
lx_set: active refsetId referencedComponentId / 1 635121010000106 obs1
lx_note: active referencedComponentId value / 1 obs7 Discouraged
lx_id: active identifierSchemeId alternateIdentifier referencedComponentId / 1 30051010000102 l1 obs1 / 0 30051010000102 l9 obs9
lx_rel: active sourceId typeId destinationId relationshipGroup / 1 obs1 1 x9 0 / 0 obs1 1 x8 0
lx_concept: id / obs1
loinc: LOINC_NUM CLASS STATUS COMPONENT PROPERTY EXAMPLE_UCUM_UNITS / l1 CHEM ACTIVE Glucose MCnc mg/dL;mg/L / l2 CHEM DEPRECATED x y g/L
rcpa: loinc ucum set term / l1 mmol/L S T / l2 no~unit S T
unit_pairs: mass_loinc molar_loinc factor / l1 l3 0.0555
rcpa_el: loinc sct element / l1 c2 e1 / l1 zz e2
loinc_axis: code axis part_code / l1 COMPONENT LP1
loinc_answer: question_code answer_code / l1 LA1
mondo_sssom: subject_id predicate_id object_id mapping_justification / MONDO:0000001 skos:exactMatch SCTID:c2 j / MONDO:0000001 skos:exactMatch MEDGEN:77 j / MONDO:0000001 skos:broadMatch OMIM:3 j / MONDO:9 skos:exactMatch OMIM:4 j / MONDO:0000001 skos:exactMatch MEDDRA:4 j
uberon_sssom: subject_id predicate_id object_id mapping_justification / UBERON:1 skos:narrowMatch SCTID:c1 j / UBERON:1 skos:narrowMatch NCIT:C9 j / UBERON:1 semapv:cross FMA:77 j / UBERON:1 skos:closeMatch SCTID:c2 j
hpoa: database_id qualifier hpo_id reference evidence aspect frequency / OMIM:154700 - HP:1 PMID:1 PCS P 1/2 / OMIM:1 NOT HP:1 PMID:1 PCS P - / OMIM:1 - HP:1 x y I -
hp_genes: ncbi_gene_id disease_id association_type gene_symbol / NCBIGene:5 OMIM:154700 MENDELIAN AB / NCBIGene:5 MONDO:1 x AB
dc_id: struct_id identifier id_type / d1 r2 RXNORM / d1 zz RXNORM / d1 c9 SNOMEDCT_US / d1 CHEBI:15 CHEBI
dc_class: struct_id type source class_code name / d1 MoA FDA N01 X / d1 Chem FDA N02 X / d1 PA MeSH D5 Y
dc_atc: struct_id atc_code / d1 A1
dc_omop: struct_id relationship_name snomed_conceptid / d1 indication f1 / d1 symptom c2
dc_act: act_id struct_id target_id moa moa_source act_source action_type / 1 d1 T1 1 LABEL - INHIB / 2 d1 T2 - - CHEMBL -
dc_td: target_id component_id / T1 k1
dc_tc: id accession gene geneid organism / k1 P1 AB 5 Homo / k2 P2 CD 6 Homo
mbs: ItemNum Category Group ItemEndDate / 23 1 A1 - / 24 1 A2 2020
pbs_res: res_code text / R1 see~item~23~and~24~of~the~Medicare~Benefits~Schedule
lpm: PartNumber PartName PartTypeName ExtCodeId ExtCodeSystem Equivalence / LP1 Glu COMPONENT c7 http://snomed.info/sct equivalent / LP1 Glu COMPONENT 562 https://www.ncbi.nlm.nih.gov/taxonomy equivalent / LP1 Glu COMPONENT CHEBI:17 https://www.ebi.ac.uk/chebi equivalent / LP1 Glu COMPONENT LP2 http://loinc.org equivalent
lpl: LoincNumber PartNumber PartTypeName LinkTypeName / l1 LP1 COMPONENT Primary / l2 LP1 COMPONENT Primary
lpl_more: LoincNumber PartNumber PartTypeName LinkTypeName / l1 LP1 COMPONENT DetailedModel
loinc_answers: AnswerListId AnswerStringId DisplayText ExtCodeId ExtCodeSystem / LL1 LA1 Small c2 http://snomed.info/sct / LL1 LA2 Big zz http://snomed.info/sct
umls_taxa: source_code target_code target_name / c3 590 genus~Salmonella / c2 7 Other
loinc_rsna: LoincNumber PartNumber PartTypeName RID RPID / l1 LP9 Rad.Anatomic~Location.Region RID1 RPID5 / l2 LP9 x RID1 -
rsna: RPID STATUS FIELDS RIDS / RPID5 ACTIVE MODALITY|BODY_REGION RID3|0 / RPID6 OLD a RID9
umls_fma: fma sct / 77 c1
umls_radlex: cui sct / C7 c2
hgnc: hgnc_id status entrez_id uniprot_ids omim_id / HGNC:5 Approved 5 P1|P7 600 / HGNC:9 Approved 99 - - / HGNC:6 Withdrawn 5 - -
orpha_xref: orpha vocab ref relation validation / 558 ICD-10 Q87 E~(exact) V / 559 MONDO 1 E V / 558 MedDRA 3 E V / 560 UMLS C1 E V
orpha_map: active refsetId referencedComponentId mapTarget / 1 784008009 c2 558
orpha_moved: orpha kind target / 600 Moved~to 558 / 600 Other 1
orpha_gene: orpha hgnc status kind symbol / 558 5 Assessed Causal AB / 558 6 Not~yet~assessed x CD
orpha_hpo: orpha hpo frequency / 558 HP:1 Frequent / 558 HP:2 Excluded~(0%)
orpha_level: orpha level active / 560 Disorder true / 559 Group true
reactome_protein: id pathway evidence species / P1 R-1 TAS Homo~sapiens / P1 R-2 TAS Mus
reactome_chebi: id pathway evidence species / 17 R-1 IEA Homo~sapiens
reactome: id species / R-1 Homo~sapiens / R-0 Homo~sapiens / R-2 Mus
reactome_rel: parent child / R-0 R-1 / R-0 R-2
lr_review: family n wrong / finding 40 0 / test_score_prognosis 10 0
lr: id kind shown lr lr_range sens spec verified finding diagnosis pmid / 1 finding present 3.2 - - - true c7 c2 11 / 2 test present - - 0.9 0.8 true c7 c2 12 / 3 finding absent - - 0.9 0.8 true c6 c2 13 / 4 finding present 1 - - - false c7 c2 14
who: icd10Code icd11Code foundation linear how / M41.1 FA1 http://id/entity/123 http://id/mms/123 one / Z9 ZZ - - one
who_back: icd10Code icd11Code foundation linear / M41.1 FA1 - -
who_foundation_back: icd10Code icd11Code foundation linear / M41.1 FA1 http://id/entity/123 -
who_foundation: icd10Code icd11Code foundation linear / M41.1 - http://id/entity/123 -
umls_hp: hpo_id snomed_code snomed_name / HP:1 c7 Fever / HP:1 c2 Asthma
mrmap: MAPSETSAB FROMEXPR TOEXPR RELA / CCSR_ICD10CM I1 RSP001 r / CCSR_ICD10CM ZZ RSP002 r
umls_pairs: sv sc ov oc cui shared_name s_name o_name same_name / OMIM 154700 ORPHA 558 C2 n Marfan Marfan true / OMIM 600 ORPHA 558 C3 n a b true / HP HP:1 NCIT C1 C4 n Fever Fire false
mrconso: SAB SUPPRESS CUI CODE / SNOMEDCT_US N C1 c2 / SNOMEDCT_US O C1 c6
wave_members: cui v code gate present / C1 HP HP:3 true false / C1 HP HP:4 false false
wave_unii: unii rxcui gate present cui tty / U9 r1 true false C IN
mrrel: predicate s_vocab s_code o_vocab o_code sab rela how / umls:source_parent MESH D001 MESH D000 MSH isa h / umls:source_parent MESH D777 MESH D778 MSH isa h / medrt:may_treat RXN r1 SCT c2 MED-RT may_treat h / medrt:has_mechanism_of_action RXN r1 MEDRT N01 MED-RT moa h
mrconso_all: AUI CODE / a1 D5 / a2 C000 / a3 N01 / a4 N00
mrrel_raw: AUI1 AUI2 SAB REL RELA / a2 a1 MSH RO mapped_to / a3 a4 MED-RT PAR -
medgen: cui id source / C9 77 MedGen / C9 HP:1 HPO / C9 5 Other
gencc: gene_curie disease_curie submitter_curie submitter_title classification_title / HGNC:5 MONDO:1 S1 ClinGen Definitive / HGNC:5 MONDO:1 S2 X Refuted~Evidence
value_map: active mapType referencedComponentId targetSnomedCtSubstance / 1 c4 f1 c6
decisions: queue decision s_vocab s_code o_vocab o_code reviewer date / q1 accept HP HP:9 SCT c2 Ann 2024 / q1 reject HP HP:8 SCT c2 Ann 2024
queues: queue predicate / q1 hp:reviewed
"""
TERMS = {
    "mondo": [("MONDO:0000001", "x", ["MONDO:0000002", "X:1"], [], ['GARD:0007 {source="MONDO:GARD"}', "ICDO:8000/3", 'OMIM:1 {source="MONDO:equivalentTo"}', 'SCTID:c2 {source="MONDO:relatedTo"}'], ["disease_has_location UBERON:1", "has_material_basis_in_germline_mutation_in http://identifiers.org/hgnc/5", "disease_has_feature HP:1"], False)],
    "hp": [("HP:1", "Fever", ["HP:0"], ["NCIT:C1", "MDR:2"], [], [], False)],
    "uberon": [("UBERON:1", "heart", ["UBERON:0"], ["MESH:D001", "MESH:zz"], [], ["part_of UBERON:2"], False), ("UBERON:7", "old", ["UBERON:0"], [], [], [], True)],
    "chebi": [("CHEBI:15", "", ["CHEBI:14"], [], [], ["RO:0000087 CHEBI:50"], False), ("CHEBI:14", "", ["CHEBI:10"], [], [], [], False), ("CHEBI:50", "", [], [], [], [], False), ("CHEBI:10", "", [], [], [], [], False), ("CHEBI:99", "", ["CHEBI:10"], [], [], [], False)],
}
#: predicate: the edges wanted, by the codes of their ends.
EDGES = """
sct:116680003 c2>c6 serum>blood / sct:363714003 c6>c5 / sct:363713009 c6>q1 / sct:246093002 c5>glu obs1>glu / sct:116686009 c5>blood / sct:704327008 obs1>serum / sct:icdo_map c2>C50 / sct:artg_id c1>99
sct:anatomy_structure_entire c1>c8 / sct:in_refset c2>s1 / sct:icd10_map c2>M41.15 / sct:icd10cm_map c2>I1 c6>I1 / icd10:subdivision_of M41.15>M41.1 / omop:maps_to p1>r1 p3>x1 / omop:maps_to_indirect p4>r1
std_ingredient u1>r1 / in_atc_class p1>A1 / pbs:lists p1>100 / pbs:has_restriction 100>R1 / pbs:restricted_to R1>7 / pbs:indication_is 7>c2 / corpus:binds_to asthma>c2 / atc:is_a A1>A
loinc:has_component l1>LP1 / loinc:has_answer l1>LA1 / loinc:is_a_snomed l1>c5 / sct:1 obs1>x9 / loinc:sct_concept l1>obs1 / loinc:au_preferred_unit l1>mmol/L / loinc:unit_counterpart l1>l3 / loinc:example_unit l1>mg/dL l1>mg/L
rcpa:same_data_element l1>c2 / loinc:interpreted_in_finding l1>c6 / icd10cm:maps_to I1>c2 / mondo:is_a MONDO:0000001>MONDO:0000002 / mondo:exact_match MONDO:0000001>c2 MONDO:0000001>77 / hp:is_a HP:1>HP:0 / hp:xref HP:1>C1
hpo:has_phenotype 154700>HP:1 / hpo:lacks_phenotype 1>HP:1 / uberon:is_a UBERON:1>UBERON:0 / uberon:part_of UBERON:1>UBERON:2 / uberon:mesh_xref UBERON:1>D001 / uberon:sct_narrow_match UBERON:1>c1 / uberon:ncit_narrow_match UBERON:1>C9
uberon:fma_match UBERON:1>77 / mondo:disease_has_location MONDO:0000001>UBERON:1 / mondo:germline_gene MONDO:0000001>HGNC:5 / mondo:has_feature MONDO:0000001>HP:1 / mondo:gard_xref MONDO:0000001>7 / mondo:icdo_xref MONDO:0000001>8000/3
mondo:related_xref MONDO:0000001>c2 / hpo:gene_disease 5>154700 / drugcentral:rxnorm d1>r1 / drugcentral:snomed d1>c9 / drugcentral:xref d1>15 / fda:pharmacologic_class d1>N01 / drugcentral:in_atc_class d1>A1 / drugcentral:indication d1>f1
drugcentral:mechanism_target d1>T1 / drugcentral:bioactivity d1>T2 / drugcentral:target_component T1>P1 / uniprot:encoded_by P1>5 / drugcentral:mesh_pharmacological_action d1>D5 / mbs:in_group 23>1/A1 / mbs:group_in_category 1/A1>1
pbs:cites_mbs_item R1>23 / sct:ncbitaxon_equivalent c7>562 c3>590 / loinc:part_maps_to_sct l1>c7 l1>c1 / loinc:part_xref l1>562 l1>17 / loinc:part_code LP1>c7 LP1>562 LP1>17 / loinc:answer_sct LA1>c2 / radlex:is_a RID1>RID0 / radlex:part_of RID1>RID2
radlex:fma_xref RID1>77 / loinc:radlex_part l1>RID1 / loinc:rsna_rpid l1>RPID5 / rsna:radlex_part RPID5>RID3 / radlex:anatomy_sct RID1>c1 / hgnc:xref HGNC:5>5 HGNC:5>P1 HGNC:5>P7 HGNC:5>600 / orpha:xref 558>Q87 559>MONDO:0000001 560>C1
sct:orphanet_map c2>558 / orpha:moved_to 600>558 / orpha:gene_disease HGNC:5>558 / orpha:has_phenotype 558>HP:1 / orpha:lacks_phenotype 558>HP:2 / who:icd10_to_icd11 M41.1>FA1 M41.1>123 / who:icd11_to_icd10 FA1>M41.1 123>M41.1
who:icd11_mms_foundation FA1>123 / reactome:participates_in P1>R-1 17>R-1 / reactome:part_of R-1>R-0 / finding_lr_if_present c7>c2 / finding_lr_if_absent c6>c2 / hp:umls_snomed HP:1>c7 / ccsr:category I1>RSP001 / umls:shared_cui 154700>558
umls:concept_member C1>c2 / umls:disease_member C1>HP:3 / umls:unii_rxnorm U9>r1 / orpha:icd10_via_snomed 560>M41.15 / umls:source_parent D001>D000 / medrt:may_treat r1>c2 / medrt:has_mechanism_of_action r1>N01 / atc:rxnorm_primary A1>r1
rxe:is_a x1>r1 / mesh:mapped_to D5>C000 / medrt:is_a N01>N00 / medgen:xref 77>HP:1 / gencc:gene_disease HGNC:5>MONDO:1 / chebi:has_role 15>50 / chebi:is_a 15>14 14>10 / sct:historical_association f1>c2 f1>c6 / sct:au_nearest_ancestor f1>c2 / hp:reviewed HP:9>c2
"""


@pytest.fixture(scope="module")
def world(spark):
    out = {}
    for line in WORLD.strip().splitlines():
        head, *rows = line.split(" / ")
        name, columns = head.split(": ")
        cells = [[None if c == "-" else c.replace("~", " ") for c in r.split()] for r in rows]
        out[name] = spark.createDataFrame(cells, ", ".join(f"`{c}` string" for c in columns.split()))
    out["umls_pairs"] = out["umls_pairs"].withColumn("same_name", F.col("same_name") == "true")
    for name, rows in TERMS.items():
        out[name] = spark.createDataFrame(rows, "id string, name string, is_a array<string>, xref array<string>, xref_line array<string>, relationship array<string>, obsolete boolean")
    out["radlex"] = spark.createDataFrame([("RID1", ["RID0"], ["RID2"], ["FMA:77", "UMLS:C7"])], "id string, is_a array<string>, part_of array<string>, ext array<string>")
    return out


def test_every_family(spark, world):
    graph, loaders = families.assemble(world)
    got = {}
    for r in graph.collect():
        got.setdefault(r.predicate, set()).add(f"{r.s_code}>{r.o_code}")
        assert r.s_vocab and r.o_vocab and r.source and r.method and r.tier in edges.TIERS and r.state in edges.STATES
    want = {x.split()[0]: set(x.split()[1:]) for line in EDGES.strip().splitlines() for x in line.split(" / ")}
    assert got == want
    some = [x for x in loaders if x.name in ("SNOMED CT -> ICD-O-3", "MBS item -> group -> category", "LOINC part -> its code in another vocabulary", "DrugCentral -> RxNorm ingredient (lifted)")]
    assert {tuple(r) for r in edges.balance(some).collect()} == {("SNOMED CT -> ICD-O-3", 2, 1, 1, "none", 0), ("MBS item -> group -> category", 4, 2, 2, "none", 0), ("LOINC part -> its code in another vocabulary", 4, 1, 3, "none", 0), ("DrugCentral -> RxNorm ingredient (lifted)", 2, 1, 1, "none", 0)}


def test_gate(world):
    assert edges.gate(world, ["rel", "nothing"], ["nothing"]) == ["nothing"]
    with pytest.raises(FileNotFoundError, match="nothing"):
        edges.gate(world, ["rel", "nothing"])


def test_names(spark):
    value = lambda c: spark.range(1).select(c).first()[0]
    assert value(families.taxon_name(F.lit("Order Strigiformes (organism)"))) == "strigiformes" and value(families.taxon_name(F.lit("Salmonella sp."))) == "salmonella"
    assert value(families.structure_name(F.lit("Structure of left Kidney region structure (body structure)"))) == "left kidney"

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, jaccard, licenses, lines, passages, pieces, toxicity, vectors, warc, wavelet

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_warc": warc.op2_warc,
    "op3_wavelet": wavelet.op3_wavelet,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_licenses": licenses.op5_licenses,
    "op6_pieces": pieces.op6_pieces,
    "op7_passages": passages.op7_passages,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_vectors": vectors.op9_vectors,
    "op10_lines": lines.op10_lines,
}
ORACLE_SQL = {**decontaminate.ORACLE, **jaccard.ORACLE, **licenses.ORACLE, **lines.ORACLE, **vectors.ORACLE, **warc.ORACLE}

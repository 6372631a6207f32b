"""Queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from eventlake.llm import bloom_lm, jaccard, language, licenses, mixing, negatives, neighbours, pieces, quality, ranked, substrings, toxicity, warc

QUERIES = {
    "op1_nearest": neighbours.op1_nearest,
    "op2_mixing": mixing.op2_mixing,
    "op3_compression_bands": quality.op3_compression_bands,
    "op4_pieces": pieces.op4_pieces,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_bloom_lm": bloom_lm.op6_bloom_lm,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_warc": warc.op8_warc,
    "op9_language": language.op9_language,
    "op10_repeats": substrings.op10_repeats,
    "op11_license_scan": licenses.op11_license_scan,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_ranked_search": ranked.op13_ranked_search,
}

ORACLES = {
    "op1_nearest": neighbours.ORACLE,
    "op8_warc": warc.ORACLE,
    "op2_mixing": mixing.ORACLE,
    "op7_jaccard_join": jaccard.ORACLE,
    "op10_repeats": substrings.ORACLE,
    "op11_license_scan": licenses.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_ranked_search": ranked.ORACLE,
}

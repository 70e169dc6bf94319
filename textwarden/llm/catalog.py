"""Queries of this package: one per operator, and the pipeline of stages."""

from __future__ import annotations

from . import (
    language, lexical, lines, near, neighbours, oracles, phrases, pieces, pii, repeats,
    secret_scan, simhash, templates, toxicity,
)

QUERIES = {
    "op1_nearest": neighbours.op1_nearest,
    "op2_decontamination": templates.op2_decontamination,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_repeats": repeats.op5_repeats,
    "op6_secrets": secret_scan.op6_secrets,
    "op7_near_duplicates": near.op7_near_duplicates,
    "op8_pii": pii.op8_pii,
    "op9_language_id": language.op9_language_id,
    "op10_lines": lines.op10_lines,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_simhash": simhash.op12_simhash,
    "op13_collocations": phrases.op13_collocations,
}

ORACLES: dict[str, str] = {
    "op7_near_duplicates": oracles.NEAR_DUPLICATES,
    "op11_lexical_search": oracles.LEXICAL_SEARCH,
    "op13_collocations": oracles.COLLOCATIONS,
}

"""The subpackage's queries and the SQL that some of them equal."""

from __future__ import annotations

from limnos.llm import jaccard, language, licenses, likelihood, mixing, neighbours, pieces, quality, rules, secrets


def queries() -> dict:
    return {"op1_language_id": language.op1, "op2_quality_voting": quality.op2, "op3_license_scan": licenses.op3, "op4_language_model": likelihood.op4, "op5_multiprobe_search": neighbours.op5, "op6_jaccard_join": jaccard.op6, "op7_quality_rules": rules.op7, "op8_secret_scan": secrets.op8, "op9_sentencepiece": pieces.op9, "op10_mix_sources": mixing.op10}


def oracle_sql() -> dict[str, str]:
    return {"op7_quality_rules": rules.SQL7, "op10_mix_sources": mixing.SQL10}

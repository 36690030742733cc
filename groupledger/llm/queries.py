"""The training-data operators as registered queries."""

from __future__ import annotations

from . import (
    bpe, decontamination, hard_negatives, html_text, licenses, pieces, pii, quality_rules, simhash, spelling,
    token_files, toxicity, warc,
)

LLM_QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_pii": pii.op2_pii,
    "op3_pieces": pieces.op3_pieces,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_simhash": simhash.op6_simhash,
    "op7_warc": warc.op7_warc,
    "op8_token_files": token_files.op8_token_files,
    "op9_html_text": html_text.op9_html_text,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_bpe": bpe.op11_bpe,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_spelling": spelling.op13_spelling,
}
LLM_ORACLE = {
    "op1_license_scan": licenses.SQL,
    "op2_pii": pii.SQL,
    "op7_warc": warc.SQL,
    "op10_decontamination": decontamination.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}

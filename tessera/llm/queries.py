"""Registered queries of the subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables, and their SQL."""

from __future__ import annotations

from tessera.llm import conversations, decontaminate, html_text, line_dedup, mixing, ppm, quality, secrets, simhash, substrings, toxicity, warc, whitening

QUERIES = {
    "op1_ppm_scoring": ppm.query,
    "op2_quality_rules": quality.query,
    "op3_line_dedup": line_dedup.query,
    "op4_html_extraction": html_text.query,
    "op5_source_mixing": mixing.query,
    "op6_substring_dedup": substrings.query,
    "op7_warc": warc.query,
    "op8_simhash": simhash.query,
    "op9_secret_scan": secrets.query,
    "op10_decontamination": decontaminate.query,
    "op11_toxicity": toxicity.query,
    "op12_whitening": whitening.query,
    "op13_conversation_repair": conversations.query,
}

ORACLE = {
    "op2_quality_rules": quality.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op7_warc": warc.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
}

"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from changeflow.llm import decontamination, language_id, license_scan, merkle, pieces, quality, repetition, simhash, sketches, substrings, token_counts, turn_repair, warc

QUERIES = {
    "op1_licenses": license_scan.op1_licenses,
    "op2_sketches": sketches.op2_sketches,
    "op3_pieces": pieces.op3_pieces,
    "op4_warc": warc.op4_warc,
    "op5_simhash": simhash.op5_simhash,
    "op6_language": language_id.op6_language,
    "op7_substrings": substrings.op7_substrings,
    "op8_quality": quality.op8_quality,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_repetition": repetition.op11_repetition,
    "op12_turn_repair": turn_repair.op12_turn_repair,
    "op13_merkle": merkle.op13_merkle,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op7_substrings": substrings.OP7_SQL,
    "op4_warc": warc.OP4_SQL,
    "op13_merkle": merkle.OP13_SQL,
}

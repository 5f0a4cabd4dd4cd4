"""Queries of the training-data operators by name, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from . import alignment, audit, bpe, decontaminate, jaccard, licenses, lm, mil, minhash, simhash, substrings, units


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_bpe": bpe.op2_bpe,
        "op3_quality": mil.op3_quality,
        "op4_substrings": substrings.op4_substrings,
        "op5_lm": lm.op5_lm,
        "op6_minhash": minhash.op6_minhash,
        "op7_toxicity": mil.op7_toxicity,
        "op8_line_runs": units.op8_line_runs,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_licenses": licenses.op10_licenses,
        "op11_alignment": alignment.op11_alignment,
        "op12_filter_audit": audit.op12_filter_audit,
        "op13_jaccard": jaccard.op13_jaccard,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict:
    return {"op4_substrings": substrings.ORACLE, "op8_line_runs": units.ORACLE, "op9_decontaminate": decontaminate.ORACLE, "op12_filter_audit": audit.ORACLE}

"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from assetpulse.llm import exact_dedup, licenses, mixing, packing, preferences, quality, secrets, simhash, spelling, token_counts, vector_codes, vectors, warc


def all_queries() -> dict:
    return {
        "op1_secrets": secrets.op1_secrets,
        "op2_pack": packing.op2_pack,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_mix": mixing.op4_mix,
        "op5_quality": quality.op5_quality,
        "op6_warc": warc.op6_warc,
        "op7_licenses": licenses.op7_licenses,
        "op8_simhash": simhash.op8_simhash,
        "op9_vectors": vectors.op9_vectors,
        "op10_preferences": preferences.op10_preferences,
        "op11_token_counts": token_counts.op11_token_counts,
        "op12_spelling": spelling.op12_spelling,
        "op13_vector_codes": vector_codes.op13_vector_codes,
    }


def all_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.SQL, "op7_licenses": licenses.sql(), "op13_vector_codes": vector_codes.sql()}

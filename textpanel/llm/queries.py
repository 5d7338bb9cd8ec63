"""The named queries of this subpackage, and their SQL where SQL can state the result."""

from __future__ import annotations

from textpanel.llm import alignment, attribution, chat, idfile, jaccard, langid, mixing, packing, quality, secrets, topk, toxicity, variants
from textpanel.llm.common import Query


def queries() -> dict[str, Query]:
    return {
        "op1_packing": packing.op1_query,
        "op2_jaccard_join": jaccard.op2_query,
        "op3_toxicity": toxicity.op3_query,
        "op4_mixing": mixing.op4_query,
        "op5_quality_rules": quality.op5_query,
        "op6_token_counts": attribution.op6_query,
        "op7_exact_topk": topk.op7_query,
        "op8_secret_scan": secrets.op8_query,
        "op9_id_files": idfile.op9_query,
        "op10_language_id": langid.op10_query,
        "op11_chat_formatting": chat.op11_query,
        "op12_spelling_variants": variants.op12_query,
        "op13_token_alignment": alignment.op13_query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": mixing.ORACLE, "op5_quality_rules": quality.ORACLE, "op7_exact_topk": topk.ORACLE, "op11_chat_formatting": chat.ORACLE}

"""The corpus queries by name."""

from . import chat, exact_dedup, filter_audit, licenses, order_minhash, packing, page_text, pieces, quality, simhash, suffix_dedup, vector_codes, window_dedup


def queries():
    return {
        "op1_quality": quality.op1_quality,
        "op2_sentencepiece": pieces.op2_sentencepiece,
        "op3_order_minhash": order_minhash.op3_order_minhash,
        "op4_exact_dedup": exact_dedup.op4_exact_dedup,
        "op5_chat_format": chat.op5_chat_format,
        "op6_packing": packing.op6_packing,
        "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
        "op8_license_scan": licenses.op8_license_scan,
        "op9_window_dedup": window_dedup.op9_window_dedup,
        "op10_simhash": simhash.op10_simhash,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_vector_codes": vector_codes.op12_vector_codes,
        "op13_page_text": page_text.op13_page_text,
    }


def oracle_sql():
    return {
        "op4_exact_dedup": exact_dedup.ORACLE,
        "op5_chat_format": chat.ORACLE,
        "op7_suffix_dedup": suffix_dedup.ORACLE,
        "op9_window_dedup": window_dedup.ORACLE,
        "op11_filter_audit": filter_audit.ORACLE,
        "op12_vector_codes": vector_codes.ORACLE,
    }

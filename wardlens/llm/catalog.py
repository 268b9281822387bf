"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from wardlens.llm import (ann, bpe, chat, crosstok, decontaminate, language, licenses, neardup,
                          pii, ranked, token_counts, token_files, warc)

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_pii": pii.query,
    "op3_licenses": licenses.query,
    "op4_warc": warc.query,
    "op5_bpe": bpe.query,
    "op6_ann": ann.query,
    "op7_token_files": token_files.query,
    "op8_near_dedup": neardup.query,
    "op9_token_counts": token_counts.query,
    "op10_language": language.query,
    "op11_ranked_search": ranked.query,
    "op12_chat": chat.query,
    "op13_cross_tokenizer": crosstok.query,
}

SQL = {
    "op1_decontaminate": decontaminate.SQL,
    "op4_warc": warc.SQL,
    "op8_near_dedup": neardup.SQL,
    "op11_ranked_search": ranked.SQL,
    "op12_chat": chat.SQL,
}

"""Registered queries of this subpackage and, where SQL can express one, its DuckDB statement."""

from __future__ import annotations

from deskpulse.llm.align import op12_token_alignment
from deskpulse.llm.chat_format import OP3_SQL, op3_chat_format
from deskpulse.llm.decontaminate import op10_benchmark_decontamination
from deskpulse.llm.embed_dedup import op1_embedding_near_dedup
from deskpulse.llm.minhash_dedup import op2_minhash_near_dedup
from deskpulse.llm.pii import op4_pii
from deskpulse.llm.quality import op8_quality
from deskpulse.llm.secrets import op6_secret_scan
from deskpulse.llm.sentencepiece_scan import op5_sentencepiece
from deskpulse.llm.spelling import op13_spelling_variants
from deskpulse.llm.token_files import op11_token_files
from deskpulse.llm.toxicity import op7_toxicity
from deskpulse.llm.url_filter import op9_sql, op9_url_filter

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_pii": op4_pii,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_secret_scan": op6_secret_scan,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_url_filter": op9_url_filter,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_token_files": op11_token_files,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op3_chat_format": OP3_SQL,
    "op9_url_filter": op9_sql(),
}

"""The registered queries of the operators and the DuckDB SQL they are checked against."""

from __future__ import annotations

from flowatlas.llm.align import op11_alignment
from flowatlas.llm.bpe import op1_bpe
from flowatlas.llm.compress import ORACLE as CODES_SQL, op12_codes
from flowatlas.llm.decontaminate import op9_decontaminate
from flowatlas.llm.embeddings import op3_embedding_forest
from flowatlas.llm.language import op6_language
from flowatlas.llm.language_model import op8_language_model
from flowatlas.llm.licenses import op2_license_scan
from flowatlas.llm.minhash import op7_minhash
from flowatlas.llm.neighbours import op13_neighbours
from flowatlas.llm.oracle import ORACLES
from flowatlas.llm.quality import op4_quality
from flowatlas.llm.secrets import op10_secrets
from flowatlas.llm.urls import op5_url_filter

QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_license_scan, op3_embedding_forest, op4_quality, op5_url_filter, op6_language, op7_minhash, op8_language_model, op9_decontaminate, op10_secrets,
    op11_alignment, op12_codes, op13_neighbours)}

ORACLES = {**ORACLES, "op12_codes": CODES_SQL}

__all__ = ["ORACLES", "QUERIES"]

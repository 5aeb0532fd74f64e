"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .op1_language import op1_language
from .op10_decontaminate import op10_decontaminate
from .op11_minhash import op11_minhash
from .op12_vector_codes import op12_vector_codes
from .op13_fill_middle import op13_fill_middle
from .op2_mixing import op2_mixing
from .op3_token_store import op3_token_store
from .op4_jaccard import op4_jaccard, op4_links
from .op5_ppm import op5_ppm
from .op6_quality import op6_quality
from .op7_toxicity import op7_toxicity
from .op8_token_counts import op8_token_counts
from .op9_pii import op9_pii
from .oracles import ORACLES

QUERIES = {
    "op1_language": op1_language,
    "op10_decontaminate": op10_decontaminate,
    "op11_minhash": op11_minhash,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_middle": op13_fill_middle,
    "op2_mixing": op2_mixing,
    "op3_token_store": op3_token_store,
    "op4_jaccard": op4_jaccard,
    "op4_links": op4_links,
    "op5_ppm": op5_ppm,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_pii": op9_pii,
}

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries of the llm operators and their SQL oracles."""

from __future__ import annotations

from . import fm_decontam, stripes
from .bpe_trie import op8_bpe_trie
from .chosen_path import op5_chosen_path
from .fm_decontam import op12_fm_decontam
from .ftrl_toxicity import op6_ftrl_toxicity
from .ipf_mixing import op1_ipf_mixing
from .kd_sharding import op3_kd_sharding
from .langid_pieces import op4_langid_pieces
from .lm_trie import op10_lm_trie
from .mcd_rules import op2_mcd_rules
from .stripes import op11_stripes_collocations
from .tool_calls import op7_tool_calls
from .whitening import op13_spectrum_whitening
from .winnowing import op9_winnowing

QUERIES = {
    "op1_ipf_mixing": op1_ipf_mixing,
    "op10_lm_trie": op10_lm_trie,
    "op11_stripes_collocations": op11_stripes_collocations,
    "op12_fm_decontam": op12_fm_decontam,
    "op13_spectrum_whitening": op13_spectrum_whitening,
    "op2_mcd_rules": op2_mcd_rules,
    "op3_kd_sharding": op3_kd_sharding,
    "op4_langid_pieces": op4_langid_pieces,
    "op5_chosen_path": op5_chosen_path,
    "op6_ftrl_toxicity": op6_ftrl_toxicity,
    "op7_tool_calls": op7_tool_calls,
    "op8_bpe_trie": op8_bpe_trie,
    "op9_winnowing": op9_winnowing,
}
ORACLES: dict[str, str] = {
    "op11_stripes_collocations": stripes.ORACLE,
    "op12_fm_decontam": fm_decontam.ORACLE,
}

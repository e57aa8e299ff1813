"""Queries of the numbered operators, each over its whole table, and their SQL where SQL can express them."""

from scribemill.llm.decontamination import OP10_SQL, op10_decontamination
from scribemill.llm.html_extraction import op8_html_extraction
from scribemill.llm.lexical_search import OP12_SQL, op12_lexical_search
from scribemill.llm.line_dedup import OP6_SQL, op6_line_dedup
from scribemill.llm.lm_scoring import op7_lm_scoring
from scribemill.llm.matroska import op9_media_columns
from scribemill.llm.mixing import OP2_SQL, op2_mixing
from scribemill.llm.near_dedup import op4_near_dedup
from scribemill.llm.resampling import OP11_SQL, op11_resampling
from scribemill.llm.suffix_dedup import op3_suffix_dedup
from scribemill.llm.token_output import op1_token_output
from scribemill.llm.toxicity import op5_toxicity
from scribemill.llm.url_rules import OP13_SQL, op13_url_rules

QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_mixing": op2_mixing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_html_extraction": op8_html_extraction,
    "op9_media_columns": op9_media_columns,
    "op10_decontamination": op10_decontamination,
    "op11_resampling": op11_resampling,
    "op12_lexical_search": op12_lexical_search,
    "op13_url_rules": op13_url_rules,
}
ORACLES = {
    "op2_mixing": OP2_SQL,
    "op6_line_dedup": OP6_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_resampling": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_url_rules": OP13_SQL,
}

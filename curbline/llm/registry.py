"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from curbline.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from curbline.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from curbline.llm.jaccard import OP9_SQL, op9_jaccard
from curbline.llm.language import op7_language
from curbline.llm.licenses import op4_licenses
from curbline.llm.mixing import OP10_SQL, op10_mixing
from curbline.llm.nn_descent import OP3_SQL, op3_nn_descent
from curbline.llm.packing import op8_packing
from curbline.llm.prefix_forest import op12_prefix_forest
from curbline.llm.quotes import OP6_SQL, op6_quotes
from curbline.llm.resampling import OP11_SQL, op11_resampling
from curbline.llm.toxicity import op5_toxicity
from curbline.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_nn_descent": op3_nn_descent,
    "op4_licenses": op4_licenses,
    "op5_toxicity": op5_toxicity,
    "op6_quotes": op6_quotes,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_jaccard": op9_jaccard,
    "op10_mixing": op10_mixing,
    "op11_resampling": op11_resampling,
    "op12_prefix_forest": op12_prefix_forest,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE = {
    "op1_warc": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op3_nn_descent": OP3_SQL,
    "op6_quotes": OP6_SQL,
    "op9_jaccard": OP9_SQL,
    "op10_mixing": OP10_SQL,
    "op11_resampling": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}

"""The queries of this folder by name, and the expected SQL of those that have one."""

from __future__ import annotations

from parcelhouse.llm.cross_tokenizer import op11_cross_tokenizer
from parcelhouse.llm.decontamination import op3_decontamination
from parcelhouse.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from parcelhouse.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from parcelhouse.llm.line_dedup import op1_line_dedup
from parcelhouse.llm.lm import op5_lm_scoring
from parcelhouse.llm.packing import op9_packing
from parcelhouse.llm.pii import op2_pii
from parcelhouse.llm.quality import op8_quality
from parcelhouse.llm.sharding import op13_sharding
from parcelhouse.llm.simhash import op6_simhash
from parcelhouse.llm.toxicity import op10_toxicity
from parcelhouse.llm.url_filters import OP7_SQL, op7_url_filters

QUERIES = {
    q.__name__: q
    for q in (
        op1_line_dedup, op2_pii, op3_decontamination, op4_exact_dedup, op5_lm_scoring, op6_simhash,
        op7_url_filters, op8_quality, op9_packing, op10_toxicity,
        op11_cross_tokenizer, op12_hard_negatives, op13_sharding)
}
ORACLE_SQL = {"op4_exact_dedup": OP4_SQL, "op7_url_filters": OP7_SQL, "op12_hard_negatives": OP12_SQL}

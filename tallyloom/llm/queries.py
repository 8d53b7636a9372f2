"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from tallyloom.llm.bpe import op10_bpe
from tallyloom.llm.covertree import op1_covertree
from tallyloom.llm.katz import op3_katz
from tallyloom.llm.lines import OP2_SQL, op2_lines
from tallyloom.llm.mixing import OP9_SQL, op9_mixing
from tallyloom.llm.packing import op12_packing
from tallyloom.llm.quality import op8_quality
from tallyloom.llm.search import OP11_SQL, op11_search
from tallyloom.llm.sharding import op4_sharding, op4_sql
from tallyloom.llm.simhash import op7_simhash
from tallyloom.llm.spans import op6_spans
from tallyloom.llm.spelling import op13_spelling
from tallyloom.llm.urls import OP5_SQL, op5_urls

QUERIES = {
    f.__name__: f
    for f in (
        op1_covertree,
        op2_lines,
        op3_katz,
        op4_sharding,
        op5_urls,
        op6_spans,
        op7_simhash,
        op8_quality,
        op9_mixing,
        op10_bpe,
        op11_search,
        op12_packing,
        op13_spelling,
    )
}


def oracles() -> dict[str, str]:
    return {
        "op2_lines": OP2_SQL,
        "op4_sharding": op4_sql(),
        "op5_urls": OP5_SQL,
        "op9_mixing": OP9_SQL,
        "op11_search": OP11_SQL,
    }

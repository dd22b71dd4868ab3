"""Queries of the ten training-data operators, with DuckDB twins where SQL can say the same."""

from palimpsest.llm import (
    exact_dedup,
    langid,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    sharding,
    tool_calls,
    url_filter,
)


def queries():
    return {
        "op1_rendezvous_sharding": sharding.op1,
        "op2_radix_exact_dedup": exact_dedup.op2,
        "op3_tool_call_linking": tool_calls.op3,
        "op4_line_alignment": line_dedup.op4,
        "op5_link_graph_url_filter": url_filter.op5,
        "op6_best_fit_packing": packing.op6,
        "op7_cross_polytope_search": neighbours.op7,
        "op8_hyperdimensional_language_id": langid.op8,
        "op9_curriculum_mixing": mixing.op9,
        "op10_minhash_near_dedup": near_dedup.op10,
    }


def oracle_sql():
    return {"op2_radix_exact_dedup": exact_dedup.ORACLE, "op3_tool_call_linking": tool_calls.ORACLE}

"""The registered queries of the operators and their DuckDB SQL."""
from __future__ import annotations

from barspark.llm import align, audit, bestfit, chat, embeddings, lm, minhash, nbest, packing, rules, toxicity, urls, weak

QUERIES = {
    "op1_snapshot_collapse": chat.op1_snapshot_collapse,
    "op2_weak_labels": weak.op2_weak_labels,
    "op3_host_rules": rules.op3_host_rules,
    "op4_link_trust": urls.op4_link_trust,
    "op5_n_best": nbest.op5_n_best,
    "op6_multiple_instance": toxicity.op6_multiple_instance,
    "op7_cross_entropy": lm.op7_cross_entropy,
    "op8_itq_hamming": embeddings.op8_itq_hamming,
    "op9_minhash": minhash.op9_minhash,
    "op10_power_of_two": packing.op10_power_of_two,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_alignment": align.op12_alignment,
    "op13_best_fit": bestfit.op13_best_fit,
}

SQL = {
    "op1_snapshot_collapse": chat.SQL,
    "op3_host_rules": rules.SQL,
    "op4_link_trust": urls.SQL,
    "op11_filter_audit": audit.SQL,
}

"""Registered queries of this subpackage and their SQL statements."""

from __future__ import annotations

from . import (fill_middle, host_consensus, learned_ann, packing, personal_data, prefix_hash, simhash, source_divergence,
               subwords, suffix_dedup, toxicity, url_lists, warc)

QUERIES = {f.__name__: f for f in (
    warc.op1_warc, url_lists.op2_url_lists, packing.op3_best_fit_packing, simhash.op4_simhash,
    prefix_hash.op5_prefix_hash, suffix_dedup.op6_suffix_dedup, learned_ann.op7_learned_ann,
    toxicity.op8_toxicity, personal_data.op9_personal_data, subwords.op10_sentencepiece,
    host_consensus.op11_host_consensus, fill_middle.op12_fill_middle, source_divergence.op13_source_divergence)}

ORACLE_SQL = {"op1_warc": warc.OP1_SQL, "op2_url_lists": url_lists.OP2_SQL, "op12_fill_middle": fill_middle.OP12_SQL,
              "op13_source_divergence": source_divergence.OP13_SQL}

"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from vellumflow.llm import op4_fm_index, op10_epsilon_grid, op11_annulus, op12_assembly, op13_relative_lz
from vellumflow.llm.op10_epsilon_grid import op10_epsilon_grid_join
from vellumflow.llm.op11_annulus import op11_annulus_clustering
from vellumflow.llm.op12_assembly import op12_sale_assembly
from vellumflow.llm.op13_relative_lz import op13_relative_lz_dedup
from vellumflow.llm.op1_mixing import op1_sainte_lague_mixing
from vellumflow.llm.op2_toxicity import op2_ngram_toxicity
from vellumflow.llm.op3_deep_shallow import op3_deep_shallow_dedup
from vellumflow.llm.op4_fm_index import op4_fm_index_decontamination
from vellumflow.llm.op5_pii import op5_boosted_pii
from vellumflow.llm.op6_huffman import op6_huffman_ids
from vellumflow.llm.op7_hilbert import op7_hilbert_sharding
from vellumflow.llm.op8_bradley_terry import op8_bradley_terry_quality
from vellumflow.llm.op9_golay import op9_golay_simhash

QUERIES = {
    "op3_deep_shallow_dedup": op3_deep_shallow_dedup,
    "op6_huffman_ids": op6_huffman_ids,
    "op5_boosted_pii": op5_boosted_pii,
    "op8_bradley_terry_quality": op8_bradley_terry_quality,
    "op2_ngram_toxicity": op2_ngram_toxicity,
    "op10_epsilon_grid_join": op10_epsilon_grid_join,
    "op4_fm_index_decontamination": op4_fm_index_decontamination,
    "op1_sainte_lague_mixing": op1_sainte_lague_mixing,
    "op7_hilbert_sharding": op7_hilbert_sharding,
    "op9_golay_simhash": op9_golay_simhash,
    "op11_annulus_clustering": op11_annulus_clustering,
    "op12_sale_assembly": op12_sale_assembly,
    "op13_relative_lz_dedup": op13_relative_lz_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op4_fm_index_decontamination": op4_fm_index.ORACLE,
    "op10_epsilon_grid_join": op10_epsilon_grid.ORACLE,
    "op11_annulus_clustering": op11_annulus.ORACLE,
    "op12_sale_assembly": op12_assembly.ORACLE,
    "op13_relative_lz_dedup": op13_relative_lz.ORACLE,
}

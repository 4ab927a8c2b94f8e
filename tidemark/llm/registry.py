"""Queries of the training-data operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from tidemark.llm import op01_divergence, op02_skipchain, op03_slack, op04_unigram, op05_nnpu, op06_spaced, op07_randomness, op08_simhash, op09_ring, op10_diagonal, op11_multiindex, op12_centroids, op13_bitsliced
from tidemark.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_divergence": op01_divergence.query,
    "op2_skip_chain": op02_skipchain.query,
    "op3_min_slack": op03_slack.query,
    "op4_unigram": op04_unigram.query,
    "op5_nnpu": op05_nnpu.query,
    "op6_spaced_seeds": op06_spaced.query,
    "op7_randomness": op07_randomness.query,
    "op8_simhash": op08_simhash.query,
    "op9_ring": op09_ring.query,
    "op10_diagonal": op10_diagonal.query,
    "op11_multiindex": op11_multiindex.query,
    "op12_centroids": op12_centroids.query,
    "op13_bitsliced": op13_bitsliced.query,
}

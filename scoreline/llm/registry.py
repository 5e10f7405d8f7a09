"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, centroids, html, lines, mixing, packing, pii, quality, simhash, substrings, topk, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.op1_mixing,
    "op2_topk": topk.op2_topk,
    "op3_simhash": simhash.op3_simhash,
    "op4_lines": lines.op4_lines,
    "op5_quality": quality.op5_quality,
    "op6_html": html.op6_html,
    "op7_packing": packing.op7_packing,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_pii": pii.op9_pii,
    "op10_substrings": substrings.op10_substrings,
    "op11_centroids": centroids.op11_centroids,
    "op12_bpe": bpe.op12_bpe,
    "op13_whitening": whitening.op13_whitening,
}
SQL: dict[str, str] = {**topk.SQL, **lines.SQL, **quality.SQL, **substrings.SQL, **centroids.SQL}

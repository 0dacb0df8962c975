"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, decontaminate, hostrules, minhash, negatives, packing, phrases, pieces, pseudonyms, suffix, toxicity, urlfilter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": minhash.op1_minhash_near_dedup,
    "op2_sentencepiece_round_trip": pieces.op2_sentencepiece_round_trip,
    "op3_suffix_array_dedup": suffix.op3_suffix_array_dedup,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_warc": warc.op5_warc,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_url_filter": urlfilter.op7_url_filter,
    "op8_quality_rules": hostrules.op8_quality_rules,
    "op9_substring_dedup": phrases.op9_substring_dedup,
    "op10_pii_pseudonyms": pseudonyms.op10_pii_pseudonyms,
    "op11_centroid_clusters": centroids.op11_centroid_clusters,
    "op12_pack_powers_of_two": packing.op12_pack_powers_of_two,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": minhash.ORACLE,
    "op4_benchmark_decontamination": decontaminate.ORACLE,
    "op5_warc": warc.ORACLE,
    "op7_url_filter": urlfilter.ORACLE,
    "op8_quality_rules": hostrules.ORACLE,
    "op9_substring_dedup": phrases.ORACLE,
    "op11_centroid_clusters": centroids.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}

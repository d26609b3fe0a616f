"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import ann, decontam, dedup, licenses, lm, packing, pii, secrets, sharding, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": packing.op1_harmonic_packing,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_probminhash_dedup": dedup.op3_probminhash_dedup,
    "op4_decontamination": decontam.op4_decontamination,
    "op5_pii": pii.op5_pii,
    "op6_secrets": secrets.op6_secrets,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_backoff_lm": lm.op8_backoff_lm,
    "op9_multiprobe_search": ann.op9_multiprobe_search,
    "op10_rendezvous_sharding": sharding.op10_rendezvous_sharding,
}

ORACLES: dict[str, str] = {}

"""Registered queries of the subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from tickspark.llm.decontam import op6_benchmark_leaks
from tickspark.llm.langid import op5_language_id
from tickspark.llm.licenses import op2_license_scan, scan_sql
from tickspark.llm.minhash import op1_dart_minhash
from tickspark.llm.packing import op7_binary_pack
from tickspark.llm.pii import op13_pii
from tickspark.llm.quality import op4_pu_quality
from tickspark.llm.runs import op11_periodic_runs
from tickspark.llm.sharding import op9_kd_shards
from tickspark.llm.substring import op8_relative_lz
from tickspark.llm.topk import OP3_SQL, op3_nra_topk
from tickspark.llm.warc import OP10_SQL, op10_warc_revisits
from tickspark.llm.whitening import op12_whitening

QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_license_scan": op2_license_scan,
    "op3_nra_topk": op3_nra_topk,
    "op4_pu_quality": op4_pu_quality,
    "op5_language_id": op5_language_id,
    "op6_benchmark_leaks": op6_benchmark_leaks,
    "op7_binary_pack": op7_binary_pack,
    "op8_relative_lz": op8_relative_lz,
    "op9_kd_shards": op9_kd_shards,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_pii": op13_pii,
}

ORACLE = {"op2_license_scan": scan_sql(), "op3_nra_topk": OP3_SQL, "op10_warc_revisits": OP10_SQL}

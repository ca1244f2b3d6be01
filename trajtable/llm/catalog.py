"""The queries of the corpus operators and the SQL some of them are compared with."""

from __future__ import annotations

from trajtable.llm import bpe, collocations, decontaminate, exact_dedup, licenses, merkle, near_dedup, neighbours, personal, quality, secrets, token_files, toxicity

QUERIES = {
    "op1_bpe_trie": bpe.op1_bpe_trie,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_personal_data": personal.op5_personal_data,
    "op6_order_minhash": near_dedup.op6_order_minhash,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_toxicity_cnn": toxicity.op8_toxicity_cnn,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_token_files": token_files.op10_token_files,
    "op11_nearest_vectors": neighbours.op11_nearest_vectors,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}
ORACLES = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op7_benchmark_decontamination": decontaminate.OP7_SQL,
    "op12_phrase_collocations": collocations.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}

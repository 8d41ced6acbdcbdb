"""One query per operator, and SQL for those that SQL can express."""

import corpus_pipeline
from ledgerloom.llm import (
    bpe,
    hard_negatives,
    html_crf,
    language,
    licences,
    merkle,
    mixing,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    urls,
    whitening,
)

QUERIES = {
    f.__name__: f
    for f in (
        mixing.op1_mix_sources,
        merkle.op2_fingerprint_documents,
        quality_model.op3_quality_scores,
        simhash.op4_simhash_near_duplicates,
        quality_rules.op5_quality_rules,
        bpe.op6_bpe_round_trip,
        html_crf.op7_main_text,
        urls.op8_judge_urls,
        sharding.op9_pack_shards,
        licences.op10_license_notices,
        hard_negatives.op11_hard_negatives,
        language.op12_languages,
        whitening.op13_whitened_embeddings,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLES = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op8_judge_urls": urls.OP8_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

"""One registered query per corpus operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chat, collocations, jaccard, language, negatives, oracle, packing, pieces, pii, sharding, spotsigs, suffixes, toxicity, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_collision_counting": vectors.op1,
    "op2_personal_data": pii.op2,
    "op3_pieces_round_trip": pieces.op3,
    "op4_repeated_bytes": suffixes.op4,
    "op5_binary_packing": packing.op5,
    "op6_language_profiles": language.op6,
    "op7_histogram_shards": sharding.op7,
    "op8_shingle_components": jaccard.op8,
    "op9_transcript_roles": chat.op9,
    "op10_spot_signatures": spotsigs.op10,
    "op11_phrase_automata": collocations.op11,
    "op12_recurrent_toxicity": toxicity.op12,
    "op13_coordinate_negatives": negatives.op13,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op1_collision_counting": oracle.OP1,
    "op4_repeated_bytes": oracle.OP4,
    "op8_shingle_components": oracle.OP8,
    "op11_phrase_automata": oracle.OP11,
    "op13_coordinate_negatives": oracle.OP13,
}

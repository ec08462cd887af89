"""The registered query of each operator."""

from __future__ import annotations

from tallyline.llm import embeddings, katz, language, merkle, mixing, pieces, quality, search, secrets, simhash, spots, tokenfiles, toxicity
from tallyline.llm.statements import EMBEDDINGS, MERKLE, SEARCH

QUERIES = {
    "op1_embeddings": embeddings.query,
    "op2_pieces": pieces.query,
    "op3_mixing": mixing.query,
    "op4_simhash": simhash.query,
    "op5_token_files": tokenfiles.query,
    "op6_katz": katz.query,
    "op7_secrets": secrets.query,
    "op8_spots": spots.query,
    "op9_language": language.query,
    "op10_toxicity": toxicity.query,
    "op11_merkle": merkle.query,
    "op12_search": search.query,
    "op13_quality": quality.query,
}
#: SQL for the queries that SQL can express.
STATEMENTS: dict[str, str] = {"op1_embeddings": EMBEDDINGS, "op11_merkle": MERKLE, "op12_search": SEARCH}

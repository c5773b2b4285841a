"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from brasa.llm import (alignment, digests, embeddings, hamming, licenses, packing, periodic, pieces, simhash, suffixes,
                       token_counts, toxicity, warc)

QUERIES = {
    "op1_embedding_near_dedup": embeddings.op1,
    "op2_license_scan": licenses.op2,
    "op3_warc_archive": warc.op3,
    "op4_token_counts": token_counts.op4,
    "op5_exact_top_k": hamming.op5,
    "op6_toxicity": toxicity.op6,
    "op7_simhash_near_dedup": simhash.op7,
    "op8_packing": packing.op8,
    "op9_suffix_array_dedup": suffixes.op9,
    "op10_unigram_pieces": pieces.op10,
    "op11_document_digests": digests.op11,
    "op12_cross_tokenizer_alignment": alignment.op12,
    "op13_periodic_runs": periodic.op13,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.ORACLE,
    "op3_warc_archive": warc.ORACLE,
}

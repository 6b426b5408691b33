"""The opN queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from geohealth.llm import ann, bestfit, collocation, decontam, langid, lm, packing, quality, secrets, sharding, simhash, toxicity, whitening

QUERIES = {
    "op1_adaptive_dimension_scan": ann.run,
    "op2_subword_lattice": lm.run,
    "op3_credential_linking": secrets.run,
    "op4_simhash_multi_index": simhash.run,
    "op5_recurrent_toxicity": toxicity.run,
    "op6_line_field_quality": quality.run,
    "op7_harmonic_packing": packing.run,
    "op8_hash_tree_sharding": sharding.run,
    "op9_prefix_filter_decontamination": decontam.run,
    "op10_output_codes": langid.run,
    "op11_best_fit_packing": bestfit.run,
    "op12_embedding_whitening": whitening.run,
    "op13_phrase_collocation": collocation.run,
}
ORACLES: dict[str, str] = {
    "op9_prefix_filter_decontamination": decontam.SQL,
    "op13_phrase_collocation": collocation.SQL,
}

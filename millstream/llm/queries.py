"""Import every module with a query, so that the queries register."""

from . import (  # noqa: F401
    anchor_tree, bit_planes, collision_search, factorisation, ftrl, latent_retrieval,
    license_templates, match_model, prob_minhash, secret_entropy, soft_mixing, stream_dedup,
    word_runs,
)

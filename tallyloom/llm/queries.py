"""All operators' queries; importing this module registers them."""

from tallyloom.llm import (  # noqa: F401
    ann, bpe, chat, embed_dedup, filter_audit, license, minhash, ngram_lm, packing, phrases, pii, quality, sharding,
)
from tallyloom.llm.registry import ORACLE, QUERIES  # noqa: F401

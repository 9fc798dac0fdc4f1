"""Where the public vocabularies of the registered queries are; every operator takes the path as a parameter."""

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

"""Parameters that the registered queries and the pipeline share."""

from __future__ import annotations

END_OF_TEXT = 50256  # of the byte-level vocabulary
SURROGATE_KEY = "registered-queries"  # a real run passes a secret


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file on the driver; it is read there and never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)

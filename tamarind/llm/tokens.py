"""What both tokenizer operators share: the tokenizer of a file, once per Python worker."""

from __future__ import annotations

import os
from functools import lru_cache


def place_of(name: str) -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(name: str):
    """The tokenizer of a file's name or path, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(name if os.path.sep in name else place_of(name))
    loaded.no_truncation()
    loaded.no_padding()
    return loaded

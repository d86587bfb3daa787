"""Byte-level BPE ids of whole texts.

The ids are those of a file of the ``tokenizers`` library.  Where the same
vocabulary is at hand as ranks, texts are encoded by ``tiktoken`` from it, about
three times as fast; texts with a special token's string, or with characters on
whose class the two libraries' expressions could differ, go to ``tokenizers``.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
# Anything but ASCII, white space and Latin letters and signs.
_RARE = re.compile(r"[^\t-\r -~\xa0-ɏ]")


class ByteBpe:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, file: str, ranks: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_file(file)
        self._library.no_truncation()
        self._library.no_padding()
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self._fast is None or _RARE.search(text) or any(s in text for s in self._special):
            return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4")
        return self._fast.encode_to_numpy(text).astype("<u4", copy=False)


@lru_cache(maxsize=2)
def byte_bpe(file: str, ranks: str | None) -> ByteBpe:
    """Made once in each Python worker."""
    return ByteBpe(file, ranks)


def public_files() -> tuple[str, str]:
    """Paths of the byte-level vocabulary, as a file of the library and as ranks."""
    return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(BYTE_RANKS)

"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64

import numpy as np

SPECIAL = "<|endoftext|>"


class ByteBpe:
    """Ids as `Tokenizer.from_file(path).encode(text, add_special_tokens=False)` gives them.

    The same vocabulary as ranks for `tiktoken` encodes the same ids several
    times faster. A text with the string of the special token, or any text if
    there are no ranks, goes through `tokenizers` itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None, pattern: str | None):
        self.path, self.whole, self.fast = tokenizer_path, None, None
        if ranks_path is not None:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                pairs = [line.split() for line in lines]
            ranks = {base64.b64decode(a): int(b) for a, b in pairs}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and SPECIAL not in text:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

"""Token ids of texts by a public byte-level BPE vocabulary.

``path`` names a tokenizer file of the ``tokenizers`` library, or is a bare file
name of the installed vocabulary package. Beside the JSON file lies the same
vocabulary as ranks, which the faster reader uses; its ids are the same. A text
that spells out a special token goes to the ``tokenizers`` library, which gives
that token its own id. Readers are kept in the reader library's own registry, so
a worker process loads a vocabulary once."""

from __future__ import annotations

import base64
import os

import numpy as np

#: Bare name of the default vocabulary (fixed by the task).
DEFAULT = "byte_bpe_50k.json"


def locate(path: str) -> str:
    if os.path.sep in path:
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


def reader(path: str = DEFAULT):
    """Function from a text to its ids (numpy, unsigned 32 bits), without special tokens added."""
    import public_tokenizers
    import tiktoken
    from tiktoken import registry
    from tokenizers import Tokenizer

    path = locate(path)
    if path not in registry.ENCODINGS:
        with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        registry.ENCODINGS[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    fast = registry.ENCODINGS[path]
    slow: list = []

    def ids(text: str) -> np.ndarray:
        if "<|" in text:
            if not slow:
                slow.append(Tokenizer.from_file(path))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return ids

"""Token ids of the public byte-level vocabulary."""

from __future__ import annotations

import base64
import json
import re
from pathlib import Path

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
# Both libraries split these characters alike (a test compares them over every one).
_SHARED = re.compile(r"[\x00-ɏ‐-‧€]*")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as ``tokenizers`` gives them.

    The same vocabulary comes as ranks beside the JSON file, and ``tiktoken`` reads those at four
    times the speed. It serves texts of characters on which the two are known to agree; any other
    text, and any vocabulary without ranks beside it, goes through ``tokenizers``.

    The vocabulary's added tokens, where a text spells one out, are that token's id, as ``tokenizers``
    reads them by default; with ``plain`` they are text like any other.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        self._path, self._plain, self._slow, self._fast = path, plain, None, None
        with open(path, encoding="utf-8") as file:
            self._added = [token["content"] for token in json.load(file).get("added_tokens", [])]
        ranks = Path(path).with_suffix(".tiktoken")
        if ranks.exists():
            import public_tokenizers
            import tiktoken

            lines = map(bytes.split, ranks.read_bytes().splitlines())
            self._fast = tiktoken.Encoding(
                "ranks",
                pat_str=public_tokenizers.PATTERN,
                mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in lines},
                special_tokens={},
            )

    def ids(self, text: str) -> np.ndarray:
        spelt_out = not self._plain and any(token in text for token in self._added)
        if self._fast and not spelt_out and _SHARED.fullmatch(text):
            return self._fast.encode_to_numpy(text, disallowed_special=())
        if not self._slow:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
            self._slow.encode_special_tokens = self._plain
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

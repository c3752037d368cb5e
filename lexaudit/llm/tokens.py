"""Token counts by a public tokenizer's vocabulary file."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

#: Vocabulary of merge ranks; every function that counts takes another path as a parameter.
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's own splitting rule (a fixed value of the byte-level format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose count is remembered in a worker; beyond it the memory starts anew.
MEMO = 200_000


class Counter:
    """Counts tokens word by word: the splitting rule cuts before white space, so that counts of words add up."""

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._split = regex.compile(PATTERN).findall
        self._memo: dict[str, int] = {}

    def count(self, text: str) -> int:
        memo, total = self._memo, 0
        for w in self._split(text):
            n = memo.get(w)
            if n is None:
                n = len(self._encoding.encode_ordinary(w))
                if len(w) < 64:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[w] = n
            total += n
        return total

    def counts(self, text: str):
        """The words of a text by the splitting rule, each with its tokens."""
        memo = self._memo
        for w in self._split(text):
            n = memo.get(w)
            yield w, self.count(w) if n is None else n

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)


@lru_cache(maxsize=4)
def counter(path: str = DEFAULT_RANKS) -> Counter:
    return Counter(path)

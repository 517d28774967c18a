"""Token ids of whole texts by the file of a byte-level BPE.

The file is read by ``tokenizers``; its merges are run by ``tiktoken``, which gives the same
ids in about a third of the time. Texts with very long words, where the latter slows down,
are left to the former.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# The pattern that splits text before the merges of such files.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LONG_WORD = re.compile(r"\S{1000}|\s{1000}")


def byte_of_letter() -> dict[str, int]:
    """Which byte a letter of the file's vocabulary stands for: itself where it can be seen, else the next free one."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """A byte-level BPE whose ids rise in the order of its merges."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self._tokenizer.to_str())
        step = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or step.get("type") != "ByteLevel" or step["add_prefix_space"] or not step["use_regex"]:
            raise ValueError(f"{path} is no byte-level BPE on unchanged texts")
        special = {token.content: i for i, token in self._tokenizer.get_added_tokens_decoder().items()}
        letters = byte_of_letter()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        merged = [vocabulary["".join(pair)] for pair in parts["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path} numbers its tokens in another order than its merges")
        self._special = frozenset(special)
        self._fast = tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    @staticmethod
    def of(path: str) -> ByteBpe:
        """One for each worker process.

        What travels with a task is made anew for each; the installed library stays, so the
        encoders that a worker has built are kept there.
        """
        import tokenizers

        built = tokenizers.__dict__.setdefault("_built_by_tally", {})
        if path not in built:
            built[path] = ByteBpe(path)
        return built[path]

    def ids(self, text: str) -> np.ndarray:
        """The ids of the whole text, without any that the tokenizer would add."""
        if _LONG_WORD.search(text):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        return self._fast.encode_to_numpy(text, allowed_special=self._special, disallowed_special=()).astype(np.int32)

"""Encoding of whole texts by a ``tokenizers`` file.

The merges of these tokenizers never cross a pre-token, so a text's ids are the ids of its pre-tokens in order. Each
pre-token is encoded by the library and then looked up (see :mod:`.pretokens`). Texts that hold an added token (such as
``<|endoftext|>``) and tokenizers of a build other than those two known here go through the library text by text.
"""

from __future__ import annotations

import json
from functools import lru_cache
from unicodedata import is_normalized, normalize

import numpy as np

from .common import CACHES
from .pretokens import VectorEncoder

#: Splits that are made here (fixed values of the file format).
WORDS_AND_DIGITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A character that sends a text to the library.
UNFAMILIAR = chr(0xFFFF)


def _composed_lower(text: str) -> str:
    """NFC, then lower case letter by letter. Text where Python's lower case looks at a letter's neighbours stays as it
    is, with a mark that sends it to the library."""
    if "Σ" in text:
        return text + UNFAMILIAR
    return (text if is_normalized("NFC", text) else normalize("NFC", text)).lower()


class WordCache:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = self._kind(spec)
        #: What the library looks for in a text before it splits it.
        self.added = [x["content"] for x in spec.get("added_tokens") or [] if x["content"]]
        self.vector = VectorEncoder(self.kind == "byte level", self._encode, None, self.dtype) if self.kind else None

    @staticmethod
    def _kind(spec: dict) -> str | None:
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        if model.get("dropout") or model.get("type") != "BPE":
            return None
        if spec.get("normalizer") and any(x.get("normalized") for x in spec.get("added_tokens") or []):
            return None  # such a token is found in the normalised text
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer"):
            return "byte level"
        if pre.get("type") == "Sequence" and [x.get("type") for x in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
            split, level = pre["pretokenizers"]
            steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
            if steps == ["NFC", "Replace", "Lowercase"] and split["pattern"].get("Regex") == WORDS_AND_DIGITS and split.get("behavior") == "Removed" and split.get("invert") and not level.get("use_regex") and not level.get("add_prefix_space"):
                return "lower-case words"
        return None

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as ``dtype``."""
        whole = [self.vector is None or any(x in t for x in self.added) for t in texts]
        if any(whole):
            rest = iter(self.encode_many([t for t, w in zip(texts, whole, strict=True) if not w]) if not all(whole) else ())
            return [np.array(self._whole(t), self.dtype) if w else next(rest) for t, w in zip(texts, whole, strict=True)]
        plain = texts if self.kind == "byte level" else [_composed_lower(t) for t in texts]
        originals = dict(zip(plain, texts, strict=True))
        self.vector.encode_whole = lambda t: self._whole(originals[t])
        return self.vector.encode_many(plain)


@lru_cache(maxsize=4)
def word_cache(path: str) -> WordCache:
    """One cache in each worker process."""
    return WordCache(path)


CACHES["word ids"] = word_cache.cache_clear

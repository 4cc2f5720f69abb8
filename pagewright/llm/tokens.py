"""Token ids of whole texts by a public tokenizer's file, in Arrow batches inside tasks."""

from __future__ import annotations

import json
import os
import re
import unicodedata

import public_tokenizers
from tokenizers import Tokenizer

from pagewright.llm.shared import worker_cache

#: Ids of so many distinct words at most are kept by a Python worker.
WORDS = 200_000
WORD_BPE = "word_bpe_49k.json"
#: How word_bpe_49k.json prepares a text; only a file that does just this has its words cut here.
CUT = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def tokenizer_path(name: str = WORD_BPE) -> str:
    return public_tokenizers.path(name)


def _of(kinds: str, last: int = 0x24F) -> str:
    """A regular expression's class body: code points up to ``last`` of the given general categories."""
    return "".join(re.escape(chr(c)) for c in range(last + 1) if unicodedata.category(chr(c))[0] in kinds)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordEncoder:
    """Ids of a text as bytes (little-endian unsigned 32 bit), equal to the tokenizer's own.

    The vocabulary of ``word_bpe_49k.json`` splits lower-cased text into words
    that are merged one by one, so the ids of a word can be kept. Texts with
    anything but Latin letters, common signs and plain white space, or with the
    start of a special token, go to the tokenizer whole, and so do all texts where
    the file is one that cuts words in any other way.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.cuts = all(told[k] == v for k, v in CUT.items()) and all("<|" in t["content"] for t in told["added_tokens"])
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.kept: dict[str, bytes] = {}
        letters, numbers = _of("L"), _of("N")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^ \\t\\n\\r{letters}{numbers}]+").findall
        self.unusual = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-įı-ɏ]|<\\|").search

    def _encoded(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _word(self, word: str) -> bytes:
        tokens = self.merge(word.encode().decode("latin-1").translate(self.letters))
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def __call__(self, text: str) -> bytes:
        if not self.cuts or self.unusual(text):
            return self._encoded(text)
        words = self.words(text.lower())
        kept = self.kept
        try:
            return b"".join([kept[w] for w in words])
        except KeyError:
            if len(kept) > WORDS:
                kept.clear()
            for w in words:
                if w not in kept:
                    kept[w] = self._word(w)
            return b"".join([kept[w] for w in words])


def encoder(path: str) -> WordEncoder:
    """The encoder for a file, once per Python worker."""
    encoders = worker_cache("tokens")
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]

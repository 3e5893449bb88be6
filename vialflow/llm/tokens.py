"""Word-wise encoding with a public tokenizer file, inside tasks."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable

#: Words in each of the two generations of encodings that a worker keeps. When the young one is full, the old one is
#: dropped and the young one becomes the old; words that are met again move to the young one, so common words stay.
CACHE = 250_000
#: Latin letters without marks of their own (ASCII, U+00C0 to U+00FF), then ASCII punctuation but the apostrophe.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*)([!-&(-/:-@\[-`{-~]*)")
#: What a tokenizer file must say so that a plain word is its lower-cased letters and its punctuation, each merged by itself.
_STEPS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pre_tokenizer": ["Split", "ByteLevel"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
#: Byte-level form of bytes that Latin-1 has no printable character for, as far as plain words need it.
_BYTES = {b: 256 + 33 + i for i, b in enumerate(range(0x7F, 0xA1))} | {0xAD: 256 + 67}
_LOADED: dict[tuple[str, bool], "Encoder"] = {}


class _Words(dict):
    """The ids of words as little-endian unsigned 32-bit integers, made when first asked for."""

    def __init__(self, tokenizer, plain: bool) -> None:
        self.old: dict[bytes, bytes] = {}
        self.plain, self.tokenizer, self.merge = plain, tokenizer, tokenizer.model.tokenize
        self.ends: dict[bytes, bytes] = {b"": b""}

    def __missing__(self, word: bytes) -> bytes:
        made = self[word] = self.old.get(word) or self.encode(word)
        return made

    def encode(self, word: bytes) -> bytes:
        if self.plain and (found := _PLAIN.fullmatch(word)):
            letters, end = found.groups()
            if end not in self.ends:
                if len(self.ends) > 10_000:
                    self.ends = {b"": b""}
                self.ends[end] = self._merged(end.decode())
            small = letters.lower() if letters.isascii() else letters.decode().lower().encode()
            if not small:
                return self.ends[end]
            if small != word:
                return self[small] + self.ends[end]
            return self._merged(small.decode() if small.isascii() else small.decode("latin-1").translate(_BYTES))
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _merged(self, word: str) -> bytes:
        return array("I", [t.id for t in self.merge(word)]).tobytes()


class Encoder:
    """Encodes whole texts by their white-space words, each distinct word once.

    Right for tokenizers that drop white space and never join what it parts
    (a test compares it with the library's encoding of the whole text). The
    library merges each word, and it normalises and splits all but the plain
    ones, for which these steps only lower the letters and part them from the
    punctuation after them.
    """

    def __init__(self, path: str, plain_specials: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.words = _Words(self.tokenizer, _steps_are_known(self.tokenizer.to_str()))

    def encode(self, texts: Iterable[bytes | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        words, out = self.words, []
        for text in texts:
            if len(words) > CACHE:
                words.old = dict(words)
                words.clear()
            out.append(b"".join(map(words.__getitem__, text.split())) if text else b"")
        return out


def _steps_are_known(tokenizer: str) -> bool:
    said = json.loads(tokenizer)
    kinds = {k: [s["type"] for s in (said[k] or {}).get(f"{k}s".replace("pre_tokenizers", "pretokenizers"), [])] for k in ("normalizer", "pre_tokenizer")}
    if any(kinds[k] != _STEPS[k] for k in kinds) or said["model"]["type"] != "BPE" or said["model"].get("dropout"):
        return False
    split = said["pre_tokenizer"]["pretokenizers"][0]
    added = any(_PLAIN.fullmatch(t["content"].encode()) for t in said["added_tokens"])
    return split["pattern"] == {"Regex": _STEPS["pattern"]} and split["invert"] and not added


def encoder(path: str, plain_specials: bool = False) -> Encoder:
    """This worker's encoder for ``path``."""
    key = (path, plain_specials)
    if key not in _LOADED:
        _LOADED[key] = Encoder(path, plain_specials)
    return _LOADED[key]

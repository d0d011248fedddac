"""Exact fast encoding through per-worker caches of pre-tokens.

A byte-pair model encodes each pre-token on its own, so the ids of a text are
the ids of its pre-tokens in order. Pre-tokens are looked up in a dictionary; a miss
asks the tokenizer's model. Texts of Latin-1 characters are cut with one compiled
pattern, any other text with the file's own normaliser and pre-tokenizer. Only a text that
holds one of the file's special strings goes through the library whole. All three give
the library's ids.

Null is no text here (callers pass ""); equal texts give equal pre-tokens; a cache holds a
bounded number of pre-tokens whatever the texts.
"""

from __future__ import annotations

import re

# Latin-1 letters (lower and upper), numbers and white space as Unicode has them
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACE = "\t-\r \x85\xa0"
_CLITICS = "'(?:s|t|re|ve|m|ll|d)"

#: the pre-tokens of the two JSON files; alternatives with distinct first characters may stand in any order
BYTE_LEVEL = re.compile(f"{_CLITICS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
LOWER_WORDS = re.compile(f"[{LETTER}]+|[{NUMBER}]|{_CLITICS}|[^{SPACE}{LETTER}{NUMBER}]+")


def _byte_chars() -> dict[int, str]:
    """The printable character that byte-level models write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()


class Misses(dict):
    """pre-token -> value, asking the model for new ones; at most ``most`` are
    kept beside the given first entries."""

    def __init__(self, model, value, first: dict | None = None, most: int = 400_000):
        super().__init__(first or {})
        self.model, self.value, self.first, self.most = model, value, first or {}, most
        self.limit = most + len(self.first)

    def __missing__(self, word: str):
        shown = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(BYTE_CHARS)
        got = self[word] = self.value(self.model.tokenize(shown))
        return got

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
            self.update(self.first)


class Cutter:
    """text -> its pre-tokens (of the normalised text), or None where the library must encode it whole."""

    def __init__(self, tok, specials: list[str], pattern: re.Pattern, lower: bool):
        self.tok, self.specials, self.pattern, self.lower = tok, specials, pattern, lower

    def __call__(self, text: str) -> list[str] | None:
        if any(s in text for s in self.specials):
            return None
        try:
            text.isascii() or text.encode("latin-1")
        except UnicodeEncodeError:
            if self.tok.normalizer is not None:
                text = self.tok.normalizer.normalize_str(text)
            return [text[s:e] for _, (s, e) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return self.pattern.findall(text.lower() if self.lower else text)


def load(path: str):
    """(tokenizer, model without its own cache, special strings)."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    model = tok.model
    model._resize_cache(0)
    return tok, model, [t.content for t in tok.get_added_tokens_decoder().values()]

"""Token ids of whole texts with the ``tokenizers`` library, cached by pre-token.

A byte-pair tokenizer splits a text at its added tokens (such as an end of text
spelled out), normalizes what is between them, cuts it into pre-tokens by a
pattern and merges inside each.  Here the pattern of the tokenizer's own definition
cuts, and the library's model merges each distinct pre-token once: ids of
common words are looked up.  Texts outside Latin-1 pass the library's
normalizer first; inside it, only case can change.  Definitions of another
make are encoded by the whole tokenizer.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

import numpy as np
import regex

#: Pre-tokens in each of the two generations that a worker keeps; those used again move to the younger one.
CACHE = 150_000
#: The usual byte-level pattern, which definitions name without spelling it out.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, numbers and white space of Latin-1, as parts of a character class.
_LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9²³¹¼-¾", r"\s": "\t-\r \x85\xa0"}
_SPACE = "\t-\r \x85\xa0  -     　"
#: Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {**{b: chr(b) for b in _SELF}, **{b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_SELF}))}}


def default_path(name: str) -> str:
    """Path of a public vocabulary file that is installed beside the libraries."""
    import public_tokenizers
    return public_tokenizers.path(name)


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def split_pattern(definition: str) -> str | None:
    """The pattern whose matches are the pre-tokens, or None if the definition isn't of that make."""
    d = json.loads(definition)
    pre, norm = d.get("pre_tokenizer") or {}, d.get("normalizer")
    steps = pre.get("pretokenizers") or [pre]
    level = [s for s in steps if s.get("type") == "ByteLevel" and not s.get("add_prefix_space")]
    kinds = [n.get("type") for n in (norm or {}).get("normalizers", [norm] if norm else [])]
    plain = all(not any(t.get(k) for k in ("normalized", "lstrip", "rstrip", "single_word")) for t in d.get("added_tokens") or [])
    if d["model"].get("type") != "BPE" or not level or not plain or not {*kinds} <= {"NFC", "Replace", "Lowercase"}:
        return None
    if len(steps) == 1 and level[0].get("use_regex") and not norm:
        return USUAL
    if len(steps) == 2 and steps[0].get("type") == "Split" and steps[0].get("invert") and steps[0].get("behavior") == "Removed" \
            and "Regex" in steps[0]["pattern"] and not level[0].get("use_regex"):
        return steps[0]["pattern"]["Regex"]
    return None


def _classes(pattern: str, names: dict[str, str]) -> str:
    """``pattern`` with the classes spelled out, also those outside brackets."""
    out = pattern.replace(r"\S", f"[^{names[r'\s']}]").replace(r"\s+", f"[{names[r'\s']}]+")
    for name, chars in names.items():
        out = re.sub(rf"(\[\^?[^\]]*?){re.escape(name)}", lambda m: m[1] + chars, out)
    return re.sub(r"\\p\{[LN]\}", lambda m: f"[{names[m[0]]}]" if m[0] in names else m[0], out)


_SHORT = "'s|'t|'re|'ve|'m|'ll|'d|"


def _words_first(pattern: str) -> str:
    """The same matches, tried in a quicker order: no word starts with an apostrophe, so words can come first."""
    first, _, others = pattern.removeprefix(_SHORT).partition("|")
    if not pattern.startswith(_SHORT) or first not in (r" ?\p{L}+", r"[\p{L}]+", r"\p{L}+"):
        return pattern
    return f"{first}|'(?:[stmd]|re|ve|ll)|{others}"


class Encoder:
    """``ids(texts)`` gives each text's ids, those that the library gives without adding special tokens.

    An added token that a text spells out has its own id, as there.
    """

    def __init__(self, definition: str, cache: int = CACHE, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._t = Tokenizer.from_str(definition)
        self.dtype = np.dtype("<u2" if self._t.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._model, self._norm = self._t.model, self._t.normalizer
        pattern = None if whole else split_pattern(definition)
        pattern = pattern and _words_first(pattern)
        if pattern:
            self._latin = re.compile(_classes(pattern, _LATIN))
            self._any = regex.compile(_classes(pattern, {r"\s": _SPACE}))
            self._lower = "Lowercase" in definition.partition('"pre_tokenizer"')[0]
            self._added = {t["content"]: array(self._code, [t["id"]]).tobytes() for t in json.loads(definition).get("added_tokens") or []}
            self._split = re.compile("|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) or r"(?!)")
        self._whole, self._limit, self._kept, self._old = not pattern, cache, {}, {}

    def _merge(self, piece: str) -> bytes:
        """Ids of one pre-token, by the tokenizer's model (the whole tokenizer takes twice as long for it)."""
        if piece.isascii() and piece.lstrip(" ").isalpha():
            got = self._model.tokenize(piece.replace(" ", _BYTES[32]))
        else:
            got = self._model.tokenize(piece.encode().decode("latin1").translate(_BYTES))
        return array(self._code, [t.id for t in got]).tobytes()

    def _pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin1")
        except UnicodeEncodeError:
            return self._any.findall(self._norm.normalize_str(text) if self._norm else text)
        return self._latin.findall(text.lower() if self._lower else text)

    def ids(self, texts: list[str | None]):
        """Yields one array for each text, in order; null counts as empty."""
        for text in texts:
            if self._whole:
                yield np.array(self._t.encode(text or "", add_special_tokens=False).ids, self.dtype)
                continue
            text, out, at = text or "", [], 0
            if any(map(text.__contains__, self._added)):  # nearly no text: the plain test is quicker than the pattern
                for m in self._split.finditer(text):
                    out += [self._plain(text[at:m.start()]), self._added[m[0]]]
                    at = m.end()
            out.append(self._plain(text[at:] if at else text))
            yield np.frombuffer(b"".join(out), self.dtype)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        pieces = self._pieces(text)
        if len(self._kept) > self._limit:
            self._old, self._kept = self._kept, {}
        kept, old = self._kept, self._old
        for p in set(pieces).difference(kept):
            kept[p] = old.get(p) or self._merge(p)
        return b"".join(map(kept.__getitem__, pieces))


@functools.lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    """The worker's encoder of a definition, kept with its cache from task to task."""
    return Encoder(definition)

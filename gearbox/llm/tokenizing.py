"""Tokenizer access inside tasks: one instance per worker and vocabulary file.

The vocabularies are read by the libraries they are published for.  Texts in
Latin letters, where character classes, case and composition are fixed in
every Unicode version, go through ``tiktoken`` with the same merges (about
five times faster); all others through the file's own library.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
from array import array
from functools import lru_cache


def _load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def is_latin(text: str) -> bool:
    """Characters up to U+00FF only: classes that no Unicode version changes."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class ByteBpe:
    """Token ids of a byte-level BPE vocabulary, as the ``tokenizers`` library
    gives them without added special tokens.  A text that holds a special
    token's string always goes to the library, which gives that token."""

    def __init__(self, path: str):
        self.tokenizer = _load(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("byte", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                          special_tokens={}).encode_ordinary

    @classmethod
    @lru_cache(maxsize=4)
    def of(cls, path: str) -> ByteBpe:
        return cls(path)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        if self.fast is not None and is_latin(text) and not any(s in text for s in self.special):
            ids = array("I", self.fast(text))
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder != "little":
            ids.byteswap()
        return ids.tobytes()


class WordBpe:
    """Token counts of words for a BPE vocabulary with word ends whose
    normaliser lower-cases and folds white space, and whose pattern never joins
    across it.  ``latin`` is False for other vocabularies: use the library.

    The word end is written as the byte 0, which no text on this path holds;
    byte + end pairs stand before all merges in the vocabulary, so the first
    merge of every word closes its last character, as the library does.
    """

    END = "\0"
    _mark = "\1"  # an apostrophe that begins a contraction
    _letters = "a-z\1\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff"
    _signs = re.compile(f"([^\\s{_letters}]+)")
    _digit = re.compile("([0-9\u00b2\u00b3\u00b9\u00bc-\u00be])")
    _contraction = re.compile(f"(?<![^\\s0-9\u00b2\u00b3\u00b9\u00bc-\u00be{_letters}])'(s|t|re|ve|m|ll|d)")
    _other = re.compile("[\0\1\x1c-\x1f]")  # the marks, and separators the library reads otherwise

    def __init__(self, path: str):
        self.tokenizer = _load(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or ()]
        self.separable = _word_pattern(spec)
        self.fast = _end_marked(spec, self.END) if self.separable else None
        self.merges = _merges(spec, self.END) if self.fast else None

    @classmethod
    @lru_cache(maxsize=4)
    def of(cls, path: str) -> WordBpe:
        return cls(path)

    def closed(self, text: str) -> bytes | None:
        """The text's words, each closed by ``END``; None for the library."""
        if self.fast is None or not is_latin(text) or self._other.search(text):
            return None
        low = text.lower()
        quoted = "'" in low
        if quoted:
            low = self._contraction.sub(f" {self._mark}\\1 ", low)
        words = self._digit.sub(r" \1 ", self._signs.sub(r" \1 ", low)).split()
        if not words:
            return b""
        closed = self.END.join(words) + self.END
        return (closed.replace(self._mark, "'") if quoted else closed).encode()

    def count(self, text: str) -> int:
        """Tokens of a text that holds no special token's string, by the libraries."""
        closed = self.closed(text)
        if closed is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        return len(self.fast(closed.decode())) if closed else 0


# The pre-tokenizer pattern that ``WordBpe.count`` follows.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _word_pattern(spec: dict) -> bool:
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or ()]
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")
                    for t in spec.get("added_tokens") or ())
    first, last = steps[0], steps[-1]
    return (plain and len(steps) == 2 and kinds == ["NFC", "Replace", "Lowercase"]
            and first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and (first.get("pattern") or {}).get("Regex") == _WORD_PATTERN
            and last.get("type") == "ByteLevel" and not last.get("use_regex") and not last.get("add_prefix_space"))


def _raw_token(spec: dict, end: str):
    """Function from a token's spelling to its bytes, with ``end`` for the word end."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    suffix = spec["model"].get("end_of_word_suffix") or ""

    def raw(token: str) -> bytes:
        closed = bool(suffix) and token.endswith(suffix)
        return bytes(byte[c] for c in (token[:-len(suffix)] if closed else token)) + (end.encode() if closed else b"")

    return raw


def _pair(merge) -> list[str]:
    return merge if isinstance(merge, list) else merge.split(" ")


def _merges(spec: dict, end: str) -> list[tuple[bytes, bytes]]:
    raw = _raw_token(spec, end)
    return [(raw(left), raw(right)) for left, right in map(_pair, spec["model"]["merges"])]


def _end_marked(spec: dict, end: str):
    """``encode_ordinary`` over words closed by ``end``, or None if the
    vocabulary's order is not that of its merges."""
    import tiktoken

    model, raw = spec["model"], _raw_token(spec, end)
    suffix = model.get("end_of_word_suffix") or ""
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    ranks = {}
    for token, i in model["vocab"].items():
        if token in special:
            continue
        ranks[raw(token)] = i
    merged = [model["vocab"]["".join(_pair(m))] for m in model["merges"]]
    singles = 256 + 256 * bool(suffix)
    if not suffix or merged != sorted(merged) or merged[0] < singles or len(ranks) != singles + len(merged):
        return None
    # the byte 0 itself and the end mark share a place: such texts never come here
    ranks.setdefault(end.encode(), ranks.pop(b"\0", 0))
    return tiktoken.Encoding("word", pat_str=f"[^{end}]+{end}", mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


@lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer as its library loads it: ``.json`` or ``.model``."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    return _load(path)

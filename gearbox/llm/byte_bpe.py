"""Byte-level BPE by reduction of a tree of text segments.

A text is cut by the vocabulary's pattern; every match is encoded by itself.
A match that is a token as a whole is that token.  Any other is a product in
the monoid of encoded segments: its bytes are halved (the left part is the
largest power of two below the length), both halves are encoded recursively,
and neighbours are joined.  Segments of at most ``LEAF`` bytes are merged
directly, pair of lowest rank first, leftmost on ties.

A join re-encodes a window around the boundary, at first the last token of the
left segment and the first of the right one.  A side whose outer token and the
window's token beside it are not *stable* (a merge would cross their boundary)
has its share of the window doubled, until both sides are stable or the window
holds all of them.  That is proof enough: were a sequence of tokens with stable neighbours not the encoding of
its bytes, then the first merge across one of its boundaries would happen in
the encoding of the two neighbours alone as well, since merges inside the
tokens come in the same order there.

Decoding is the homomorphism back: the tokens' bytes concatenated up the tree.

Matches of different texts are independent, so encoding is one pass without a
shuffle; each worker keeps the ids of up to ``WORDS`` different short matches.

Defined results: null and empty texts have no ids and decode to no bytes;
strings of special tokens are ordinary text; repeated rows give repeated
rows; an empty table gives no rows; other columns of the input are left out.
Ids outside the vocabulary raise an error when decoded.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import id_and_text, map_in_arrow, tokenizer_path
from gearbox.llm.tokenizing import is_latin

LEAF = 4  # bytes merged directly
WORDS = 150_000  # different matches whose ids a worker keeps (twice, see _Words)
WORD_CHARS = 32  # longer matches are not kept
WINDOW = 32  # bytes of the windows and segments whose tokens a worker keeps
SEGMENTS = 1 << 16  # how many of them
ROWS = 256  # put out at a time
MATCHES = 1 << 16  # matches of a long text held at a time


class ByteBpe:
    """The monoid of one vocabulary: ``ranks`` maps a token's bytes to its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.packed = {b: i.to_bytes(4, "little") for b, i in ranks.items()}
        self.pattern, self.latin = regex.compile(pattern), _latin_pattern(pattern)
        self.words = _Words(self)
        self.stable = lru_cache(maxsize=SEGMENTS)(self._stable)
        self.last_merge = lru_cache(maxsize=SEGMENTS)(self._last_merge)
        self.window = lru_cache(maxsize=SEGMENTS)(self.merge)
        self.segment = lru_cache(maxsize=SEGMENTS)(self._halves)

    @classmethod
    @lru_cache(maxsize=4)
    def of(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    # segments: lists of tokens, a token being its bytes

    def leaf(self, piece: bytes, least_parts: int = 1) -> list[bytes]:
        """Merge a short segment: lowest rank first, leftmost on ties."""
        rank, parts = self.ranks.get, [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > least_parts:
            least, at = None, 0
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1])
                if r is not None and (least is None or r < least):
                    least, at = r, i
            if least is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merge(self, piece: bytes) -> list[bytes]:
        """The same for a window of any length, with the pairs in a heap."""
        n = len(piece)
        if n <= 6 * LEAF:
            return self.leaf(piece)
        ranks = self.ranks
        end = list(range(1, n + 1))  # end of the token that starts here
        before = list(range(-1, n))  # start of the token that ends here
        live = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if not live[i] or middle >= stop or end[middle] != stop:
                continue  # one of the two has been merged since
            live[middle] = False
            end[i], before[stop] = stop, i
            if stop < n and (r := ranks.get(piece[i:end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
            if i and (r := ranks.get(piece[before[i]:stop])) is not None:
                heappush(heap, (r, before[i], stop))
        return [piece[i:end[i]] for i in range(n) if live[i]]

    def _last_merge(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge is ``token``."""
        return tuple(self.leaf(token, 2))

    def _stable(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the boundary of two tokens.  Their merges are undone, the later one
        first, so that every pair of tokens that ever met at the boundary is seen; such a pair
        merges if its rank comes before those that took its tokens into larger ones (on the
        right, at the same rank too: leftmost first)."""
        ranks, taken_left, taken_right = self.ranks, 1 << 40, 1 << 40
        while True:
            met = ranks.get(left + right)
            if met is not None and met < taken_left and met <= taken_right:
                return False
            made_left = ranks[left] if len(left) > 1 else -1
            made_right = ranks[right] if len(right) > 1 else -1
            if made_left > made_right:
                taken_left, left = made_left, self.last_merge(left)[1]
            elif made_right >= 0:
                taken_right, right = made_right, self.last_merge(right)[0]
            else:
                return True

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            held = b"".join(left[len(left) - i:] + right[:j])
            window = self.window(held) if len(held) <= WINDOW else self.merge(held)
            open_left = i < len(left) and not self.stable(left[-i - 1], window[0])
            open_right = j < len(right) and not self.stable(window[-1], right[j])
            if not (open_left or open_right):
                return left[:len(left) - i] + window + right[j:]
            if open_left:
                i = min(2 * i, len(left))
            if open_right:
                j = min(2 * j, len(right))

    def _halves(self, piece: bytes) -> list[bytes]:
        if len(piece) <= LEAF:
            return self.leaf(piece)
        half = 1 << ((len(piece) - 1).bit_length() - 1)
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def tree(self, piece: bytes) -> list[bytes]:
        """Tokens of a segment; not to be changed by the caller."""
        return self.segment(piece) if len(piece) <= LEAF else self._halves(piece)

    def match(self, word: str) -> bytes:
        """Ids of one match of the pattern, packed."""
        piece = word.encode("utf-8")
        whole = self.packed.get(piece)
        return whole if whole is not None else b"".join([self.packed[t] for t in self.tree(piece)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        pattern = self.latin if self.latin and is_latin(text) else self.pattern
        if len(text) <= MATCHES:
            return b"".join(map(self.words.__getitem__, pattern.findall(text)))
        found, parts = (m.group() for m in pattern.finditer(text)), []
        while block := list(islice(found, MATCHES)):
            parts.append(b"".join(map(self.words.__getitem__, block)))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Words(dict):
    """Ids of the matches seen.  When there are ``WORDS``, those not asked for
    since the last time are forgotten."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe, self.older = bpe, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or self.bpe.match(word)
        if len(word) <= WORD_CHARS:
            if len(self) >= WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts whose characters are all below U+0100, with its
    character classes spelt out for Python's own engine, which is about twice
    as fast there; none if the pattern holds anything else it does not know."""
    def members(name: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if regex.match(name, chr(c)))

    def spell(found: re.Match) -> str:
        inside = found.group()
        if inside == r"\S":
            return f"[^{members(chr(92) + 's')}]"
        spelt = re.sub(r"\\p\{\w+\}|\\s", lambda m: members(m.group()), inside)
        return spelt if inside.startswith("[") else f"[{spelt}]"

    spelt = re.sub(r"\[[^\]]*\]|\\p\{\w+\}|\\s|\\S", spell, pattern)
    try:
        return None if re.search(r"\\[a-zA-Z]", re.sub(r"\\x..", "", spelt)) else re.compile(spelt)
    except re.error:
        return None


def _vocabulary(ranks: str | None, pattern: str | None) -> tuple[str, str]:
    if ranks is None:
        ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return ranks, pattern


def _per_value(df: DataFrame, schema: T.StructType, convert) -> DataFrame:
    """The last column of ``df`` through ``convert(value)``, under the schema's names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, ROWS):
                b = whole.slice(s, ROWS)
                out = pa.array([convert(v) for v in b.column(b.num_columns - 1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(schema) - 1], out], names=schema.fieldNames())

    return df.transform(map_in_arrow, run, schema)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
           pattern: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``<id>, <ids>`` for every row: the text's ids as little-endian unsigned
    32-bit integers (``numpy.frombuffer(ids, "<u4")``)."""
    ranks, pattern = _vocabulary(ranks, pattern)
    docs = id_and_text(df, id_col, text_col)
    schema = T.StructType([docs.schema[id_col], T.StructField(ids_col, T.BinaryType())])
    return _per_value(docs, schema, lambda text: ByteBpe.of(ranks, pattern).encode(text))


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str | None = None,
           pattern: str | None = None, bytes_col: str = "bytes") -> DataFrame:
    """``<id>, <ids>, <bytes>`` for every row of packed ids."""
    ranks, pattern = _vocabulary(ranks, pattern)
    rows = df.select(id_col, F.coalesce(F.col(ids_col), F.lit(b"")).alias(ids_col))
    rows = rows.select(id_col, ids_col, F.col(ids_col).alias(bytes_col))
    return _per_value(rows, rows.schema, lambda ids: ByteBpe.of(ranks, pattern).decode(ids))


def digest(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``<id>, n_tokens, ids_sha256, decoded_sha256`` of the output of ``decode``."""
    return decoded.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("bytes", 256).alias("decoded_sha256"))

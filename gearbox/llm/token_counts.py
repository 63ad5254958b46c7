"""Token counts by a compiled finite-state transducer, over chunks of texts.

For a word vocabulary (its pre-tokenizer never joins across white space) the
tokenizer is a transducer that reads a text from left to right.  Words are cut
by the pre-tokenizer's rules (``tokenizing.WordBpe.closed``); the merges are
compiled into a deterministic transducer over their bytes whose transitions
carry the numbers of emitted tokens (``word_transducer.WordTransducer``).  The
words of many texts are read together, in chunks that advance in lanes; a
chunk's state map takes every entry state to one exit once a word has ended in
it, and the maps compose to every chunk's entry.

A text of more than ``chunk_chars``, which few have, is also cut before its words are, into chunks of ``chunk_chars``.  Such a chunk
does not know its entry state, the word begun but not yet ended, so it yields its state map ``(head, inner, tail)``: the part that
completes the word it may begin in, the tokens emitted between, and the word
it leaves open; ``head`` alone when no word ends in it.  Maps compose
associatively (``compose``), so the chunks are folded pairwise like a prefix
scan in any bracketing, and no chunk waits for its predecessor.

A text with characters above U+00FF, whose classes and composition depend on the
library's Unicode version, goes to the library.
Special tokens' strings are matched before any normalisation, as in the
library: a text that holds one is cut there, each occurrence is one token.
Texts for vocabularies of another kind (``.model`` files, pre-tokenizers that
read white space) go to the library whole.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated
rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import id_and_text, map_in_arrow, tokenizer_path
from gearbox.llm.tokenizing import WordBpe, library
from gearbox.llm.word_transducer import MAX_STATES, WordTransducer

BLOCK_BYTES = 1 << 19  # words that the transducer reads at once
CHUNK_CHARS = 1 << 16
LIMIT = 2048
ENDS = re.compile("[ \t\n\r]")  # each ends a word; rarer white space is left to the vocabulary's own rules

StateMap = tuple[str, "int | None", str]  # (head, inner, tail); inner None: no word ends here, head is all


class Transducer:
    def __init__(self, path: str, max_states: int = MAX_STATES):
        self.model = path.endswith(".model")
        self.library = library(path)
        self.words = None if self.model else WordBpe.of(path)
        self.compiled = None
        if self.words and self.words.merges:
            self.compiled = WordTransducer(self.words.merges, max_states)
        self.specials = None
        if self.words and self.words.special:
            self.specials = re.compile("|".join(map(re.escape, self.words.special)))

    def word_tokens(self, text: str) -> int:
        """Tokens of a text that holds no special token's string."""
        closed = self.words.closed(text) if self.compiled else None
        return self.words.count(text) if closed is None else self.compiled.counts([closed])[0]

    def chunk(self, text: str) -> StateMap:
        first = ENDS.search(text)
        if first is None:
            return text, None, ""
        last = max(text.rfind(c) for c in " \t\n\r")
        return text[:first.start()], self.word_tokens(text[first.start():last + 1]), text[last + 1:]

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.word_tokens(a[2] + b[0]) + b[1], b[2]

    def finish(self, m: StateMap) -> int:
        return self.word_tokens(m[0]) + ((m[1] + self.word_tokens(m[2])) if m[1] is not None else 0)

    def scan(self, text: str, chunk_chars: int) -> int:
        if len(text) <= chunk_chars:
            return self.word_tokens(text)  # one chunk: head, inner and tail at once
        maps = [self.chunk(text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.finish(maps[0])

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if self.model:
            return len(self.library.encode(text))
        if not self.words.separable:
            return len(self.library.encode(text, add_special_tokens=False))
        if self.specials is None or not any(s in text for s in self.words.special):
            return self.scan(text, chunk_chars)
        return (sum(self.scan(part, chunk_chars) for part in self.specials.split(text))
                + len(self.specials.findall(text)))


    def counts(self, texts: list[str], chunk_chars: int = CHUNK_CHARS) -> list[int]:
        """``count`` of every text; words of short texts are read together."""
        n = [0] * len(texts)
        places: list[int] = []
        streams: list[bytes] = []
        held = 0

        def read() -> None:
            for place, found in zip(places, self.compiled.counts(streams)):
                n[place] = found
            places.clear()
            streams.clear()

        for place, text in enumerate(texts):
            closed = None
            if self.compiled and len(text) <= chunk_chars and not any(s in text for s in self.words.special):
                closed = self.words.closed(text)
            if closed is None:
                n[place] = self.count(text, chunk_chars)
                continue
            places.append(place)
            streams.append(closed)
            held += len(closed)
            if held >= BLOCK_BYTES:
                read()
                held = 0
        if streams:
            read()
        return n


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``<id>, n_bytes, n_tokens, over_limit`` for every row; one pass, no shuffle."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    docs = id_and_text(df, id_col, text_col)
    docs = docs.select(id_col, text_col, F.octet_length(text_col).cast("long").alias("n_bytes"))
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for b in batches:
            n = machine.counts(b.column(1).to_pylist(), chunk_chars)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())],
                                             names=schema.fieldNames())

    return docs.transform(map_in_arrow, run, schema).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))

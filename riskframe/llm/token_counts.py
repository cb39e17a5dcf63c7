"""Token counts by the tokenizers library, huge texts by overlapping chunks.

A text above `CHUNK` characters is encoded in chunks that overlap by `OVERLAP`
characters, with offsets. Two neighbours are spliced at a boundary that both
prove stable: an offset where both start a new pre-token. The pre-token rule
reads forward only, one character past a match, and an added token is at most
`GUARD` characters long, so

* the left chunk's boundaries up to its end less `GUARD` are those of the whole
  text, given that it began at such a boundary;
* from a boundary that both chunks have in common, the right chunk's pre-tokens
  and so its tokens are those of the whole text.

Where an overlap holds no common boundary (one pre-token spans it), the overlap
of that seam is doubled and both sides are encoded again, up to the whole rest.

Texts below `CHUNK` go through the library whole in effect: a cut at a space
after a non-space character is stable by the same argument, and recurring pieces
between such cuts are counted by the library once per worker (bounded memory).

Defined results: null and empty texts have 0 bytes and 0 tokens; rows are
counted one by one, repeated rows included; extra columns are ignored.
"""
from __future__ import annotations

import functools
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches

CHUNK = 32_768
OVERLAP = 512
LIMIT = 1024
CACHE_ENTRIES = 250_000
CACHE_CHARS = 48

_SPACE_PAIR = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


class Counter:
    """Counts tokens of texts with one tokenizer."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.chunk, self.overlap = chunk, overlap
        self.guard = 1 + max([len(t.content) for t in self.tok.get_added_tokens_decoder().values()], default=0)
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.widened = 0

    def library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, texts: list[str]) -> list[int]:
        """Counts of texts below the chunk size; unseen pieces go to the library in one batch."""
        cut = [_CUT.split(t) if _SPACE_PAIR.search(t) else t.split(" ") for t in texts]
        known, old, unseen = self.new, self.old, {}
        totals = []
        for first, *rest in cut:
            n, missing = 0, []
            for p in (first, *[" " + r for r in rest]):
                c = known.get(p)
                if c is None:
                    c = old.get(p)
                    if c is None:
                        unseen[p] = 0
                        missing.append(p)
                        continue
                    known[p] = c
                n += c
            totals.append((n, missing))
        if unseen:
            unseen = dict(zip(unseen, self.library(list(unseen))))
        out = [n + sum(map(unseen.__getitem__, m)) for n, m in totals]
        if len(known) + len(unseen) > CACHE_ENTRIES:
            self.old, self.new = known, {}
        for p, c in unseen.items():
            if len(p) <= CACHE_CHARS and len(self.new) < CACHE_ENTRIES:
                self.new[p] = c
        return out

    def boundaries(self, text: str, start: int, end: int) -> tuple[list[int], list[int], int]:
        """Offsets in the whole text where a pre-token starts in text[start:end], the tokens before each, all tokens."""
        e = self.tok.encode(text[start:end], add_special_tokens=False)
        at, before, last = [], [], object()
        for k, (word, (a, _)) in enumerate(zip(e.word_ids, e.offsets)):
            if word is None or word != last:
                at.append(start + a)
                before.append(k)
            last = word
        return at, before, len(e.ids)

    def huge(self, text: str) -> int:
        """Tokens of a text of any length; memory is bounded by one chunk and its overlap."""
        n, total, start, first = len(text), 0, 0, 0      # `first`: proven boundary from which this chunk counts
        while True:
            end = min(n, start + self.chunk)
            if end == n:
                at, before, tokens = self.boundaries(text, start, end)
                return total + tokens - _before(at, before, first, tokens)
            overlap = self.overlap
            while True:
                stop = min(n, end + overlap // 2)
                left = self.boundaries(text, start, stop)
                if stop == n:
                    return total + left[2] - _before(left[0], left[1], first, left[2])
                head = max(first, end - overlap // 2)
                right = self.boundaries(text, head, min(n, stop + overlap))
                common = set(right[0][1:]).intersection(a for a in left[0] if first < a <= stop - self.guard)
                # the right chunk may not trust a boundary that its own cut end could move
                common = [a for a in common if a <= min(n, stop + overlap) - self.guard]
                if common:
                    seam = min(common)
                    total += _before(left[0], left[1], seam, left[2]) - _before(left[0], left[1], first, left[2])
                    start, first = head, seam
                    break
                overlap *= 2
                self.widened += 1

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        small = [i for i, t in enumerate(texts) if t and len(t) <= self.chunk]
        for i, c in zip(small, self.pieces([texts[i] for i in small])):
            out[i] = c
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = self.huge(t)
        return out


def _before(at: list[int], before: list[int], seam: int, tokens: int) -> int:
    """Tokens ahead of the boundary `seam`; 0 at the very start."""
    from bisect import bisect_left
    k = bisect_left(at, seam)
    return before[k] if k < len(at) else tokens


@functools.lru_cache(2)
def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    return Counter(path, chunk, overlap)


def default_tokenizer() -> str:
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json")


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    small_batches(docs.sparkSession)

    def rows(batches):
        c = counter(tokenizer or default_tokenizer(), chunk, overlap)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(c.count(texts), pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
            .mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))

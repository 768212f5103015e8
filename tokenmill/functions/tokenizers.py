"""Tokenizers. Each gives ``encode(text)`` -> array column and ``count(text)`` -> its length.

``counts_cheaply`` tells planners of wide jobs whether the length is known without
encoding: then they move the text through the shuffle and encode behind it.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill import constants as C

TOKENS = T.ArrayType(T.IntegerType(), containsNull=False)
STRETCH = 1 << 20  # bytes or tokens that a function holds at once, longer rows apart


class ByteTokenizer:
    """UTF-8 bytes as ids 0..255, built-ins only."""

    counts_cheaply = True
    distinct_ids = 257

    def __init__(self, stretch: int = 1 << 20):
        self.stretch = stretch

    def encode(self, text: Column) -> Column:
        # one char per byte; never index into the hex form, that is quadratic on long texts
        latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
        # a split makes an object per char: take long texts piece by piece
        stretches = F.regexp_extract_all(latin, F.lit(f"(?s).{{1,{self.stretch}}}"), F.lit(0))
        return (
            F.when(F.length(text) == 0, F.array().cast(TOKENS))
            .when(F.octet_length(text) <= self.stretch, self._codes(latin))
            .when(text.isNotNull(), F.flatten(F.transform(stretches, self._codes)))
        )

    @staticmethod
    def _codes(latin: Column) -> Column:
        return F.transform(F.split(latin, ""), lambda c: F.ascii(c))

    def count(self, text: Column) -> Column:
        return F.octet_length(text)

    def decode(self, tokens: Column) -> Column:
        """Text of byte tokens; broken UTF-8 becomes the replacement character."""
        digits = F.transform(tokens, lambda t: F.lpad(F.hex(t), 2, "0"))
        return F.make_valid_utf8(F.unhex(F.array_join(digits, "")).cast("string"))

    def end_of_text(self) -> Column:
        return F.lit(C.END_OF_TEXT)


class PieceTokenizer:
    """Pre-split pieces as strings: what a byte-pair encoder gets to see."""

    counts_cheaply = False
    distinct_ids = None

    def __init__(self, pattern: str = C.PRESPLIT_PATTERN):
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit("(?U)" + self.pattern), F.lit(0))

    def count(self, text: Column) -> Column:
        return F.size(self.encode(text))

    def end_of_text(self) -> Column:
        return F.lit(C.END_OF_TEXT_PIECE)


class BpeTokenizer:
    """Byte-pair encoding over a rank table that the user supplies (token bytes -> id).

    The table is bounded by the vocabulary, so it travels with the function. Encoding runs
    on Arrow batches; special markers are plain text, as in the data format.
    """

    counts_cheaply = False

    def __init__(self, ranks: dict[bytes, int], pattern: str = C.PRESPLIT_PATTERN):
        too_large = [i for i in ranks.values() if not 0 <= i <= C.MAX_TOKEN_ID]
        if too_large:
            raise ValueError("token ids must fit 16 bits")
        self.distinct_ids = len(ranks) + 1
        self._encode, self._decode = _bpe_functions(dict(ranks), pattern)

    def decode(self, tokens: Column) -> Column:
        return self._decode(tokens)

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def count(self, text: Column) -> Column:
        return F.size(self.encode(text))

    def end_of_text(self) -> Column:
        return F.lit(C.END_OF_TEXT)


def _bpe_functions(ranks: dict[bytes, int], pattern: str):
    def encoding():
        import tiktoken

        return tiktoken.Encoding(name="supplied", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @F.arrow_udf(TOKENS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding()
        for batch in batches:
            for part in parts(batch, pc.binary_length(batch)):
                # one buffer for all ids: as Python numbers they take many times the text
                ids, ends = array("i"), array("i", [0])
                for text in part:
                    if text.is_valid:
                        ids.extend(coder.encode_ordinary(text.as_py()))
                    ends.append(len(ids))
                yield pa.ListArray.from_arrays(_numbers(ends), _numbers(ids), mask=part.is_null())

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding()
        for batch in batches:
            for part in parts(batch, pc.list_value_length(batch)):
                yield pa.array([coder.decode(row.as_py()) if row.is_valid else None for row in part], pa.string())

    return encode, decode


def parts(batch: pa.Array, lengths: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows of ``STRETCH`` bytes or tokens, or one longer row each: a batch is cut by rows, and these may be long."""
    begin = filled = 0
    for place, length in enumerate(lengths.to_pylist()):
        if filled and filled + (length or 0) > STRETCH:
            yield batch.slice(begin, place - begin)
            begin, filled = place, 0
        filled += length or 0
    yield batch.slice(begin)


def _numbers(values: array) -> pa.Array:
    return pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)])


def parse_ranks(lines: Iterable[str]) -> dict[bytes, int]:
    """Rank table from lines of ``base64(token) rank``."""
    ranks = {}
    for line in lines:
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


def ranks_from_merges(merges: Iterable[str]) -> dict[bytes, int]:
    """The 256 bytes under their own value, then one token per entry of ``merges``."""
    ranks = {bytes([b]): b for b in range(256)}
    for token in merges:
        ranks.setdefault(token.encode("utf-8"), len(ranks))
    return ranks


def document_tokens(tokenizer, text: Column) -> Column:
    """Tokens of a document, closed by end-of-text."""
    return F.concat(tokenizer.encode(text), F.array(tokenizer.end_of_text()))


def document_length(tokenizer, text: Column) -> Column:
    return (tokenizer.count(text) + 1).cast("bigint")

"""Secrets in texts: fixed patterns, and random strings told by how many characters a token covers."""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame

from tokenmill.llm.common import map_texts

# fixed values: the base kinds in their order, and their patterns
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs are maximal, so a run of 20 is the same as a match of 20
HEX = r"[0-9a-f]{24,}"

# fixed values: digests by their number of hex digits (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512)
DIGEST_DIGITS = (32, 40, 56, 64, 96, 128)
PRESPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# identifiers: parts (a word, a number, or a word with a number behind it) between separators, the first one may be
# more words; possessive throughout, and what a part takes first is never too much, so a match is one pass
PART = r"(?:[A-Z]?+[a-z]++|[A-Z]++|[0-9]++)"
WORDS = r"(?:[A-Z]*+[a-z]{2,}+|[A-Z]{2,}+)++[0-9]*+"
IDENTIFIER = rf"(?:{PART}{{1,2}}+(?![A-Za-z0-9])|{WORDS})(?:[_/=+-]++{PART}{{0,2}}+)*+"

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: lines of base64 token and rank. Read on the driver, bounded by the vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def secret_scan(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    min_length: int = 20,
    max_ratio: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``secrets``: array of (kind, start, end) in code points, by start and then kind, end exclusive.

    The base kinds are matched leftmost and without overlap, each kind by itself. ``random``: a
    maximal run of ``[A-Za-z0-9+/_=-]`` of ``min_length`` or more with letters and digits, outside all
    base spans, whose characters per token are at most ``max_ratio`` — after leaving out digests,
    UUIDs and identifiers (words, numbers and their joins by ``_ - /`` or capitals).

    One pass, no shuffle; a task holds one text at a time and the vocabulary. Null and empty texts
    have no secrets; rows with equal ids each keep their own result; other columns are not read.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    digests = DIGEST_DIGITS

    def setup():
        import tiktoken

        coder = tiktoken.Encoding(name="supplied", pat_str=PRESPLIT, mergeable_ranks=ranks.value, special_tokens={})
        assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        access, hexa = re.compile(ACCESS), re.compile(HEX)
        run = re.compile(rf"[A-Za-z0-9+/_=-]{{{min_length},}}")
        digest = re.compile("|".join(rf"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in digests))
        uuid = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
        identifier = re.compile(IDENTIFIER)

        def is_random(text: str) -> bool:
            if not any(c.isdigit() for c in text) or not any(c.isalpha() for c in text):
                return False
            if digest.fullmatch(text) or uuid.fullmatch(text) or identifier.fullmatch(text):
                return False
            return len(text) <= max_ratio * len(coder.encode_ordinary(text))

        def spans(text: str) -> tuple:
            found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 6]
            found += [(m.start(), 1, m.end()) for m in access.finditer(text)]
            found += [(m.start(), 2, m.end()) for m in hexa.finditer(text)]
            # runs and base spans both in order of their ends: spans that end before a run are behind for good
            base, at, more = sorted((end, start) for start, _, end in found), 0, []
            first = [start for _, start in base]  # the least start of this span and all that end later
            for k in range(len(first) - 2, -1, -1):
                first[k] = min(first[k], first[k + 1])
            for m in run.finditer(text):
                while at < len(base) and base[at][0] <= m.start():
                    at += 1
                if (at == len(base) or first[at] >= m.end()) and is_random(m.group()):
                    more.append((m.start(), 3, m.end()))
            found += more
            return ([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)],)

        return spans

    return map_texts(docs, id_col, text_col, "secrets array<struct<kind:string,start:bigint,end:bigint>>", setup)

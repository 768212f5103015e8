"""Quality rules from tokenizer fertility: how well public vocabularies cover a text."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tokenmill.llm.common import SPACED_WORD, map_texts
from tokenmill.llm.secret_scan import PRESPLIT, VOCABULARY, read_ranks

PIECES = "/opt/tokenizers/piece_bpe_32k.model"

# fixed values: first code points of scripts; "common" ends a range
SCRIPT_RANGES = [
    (0x41, "latin"), (0x5B, "common"), (0x61, "latin"), (0x7B, "common"), (0xC0, "latin"), (0x250, "common"),
    (0x370, "greek"), (0x400, "cyrillic"), (0x530, "common"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x780, "common"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "common"), (0x1100, "hangul"), (0x1200, "common"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "common"), (0x3040, "kana"), (0x3100, "common"), (0x3400, "han"),
    (0xA000, "common"), (0xAC00, "hangul"), (0xD7B0, "common"), (0xF900, "han"), (0xFB00, "common"),
    (0x20000, "han"), (0x32000, "common"),
]


@dataclass(frozen=True)
class Band:
    """What a text of a script may measure.

    The entropy share is held only from ``entropy_from`` tokens on, and so is ``min_long_chars``, the least characters per token of
    a text long enough for the measure to be steady; ``min_chars`` is for any.
    """

    min_chars: float = 1.0
    min_long_chars: float = 0.0
    max_chars: float = 12.0
    max_byte_share: float = 0.6
    min_entropy_share: float = 0.35
    entropy_from: int = 100


#: English-centred vocabularies split other scripts finely, so these have wider bands, as has Latin script of which an eighth of the
#: letters or more has marks. Measured in Latin script on the given prose (2,263 texts): 1.65 to 2.67 characters a token;
#: random letters 1.47 to 1.58, base64 1.27 to 1.52, hex dumps 1.27 to 1.38, random letters and digits 1.25 to 1.31.
BANDS = {
    "latin": Band(min_chars=1.25, min_long_chars=1.6, max_byte_share=0.25),
    "latin-marked": Band(min_chars=1.25, max_byte_share=0.25),
    "greek": Band(min_chars=0.5),
    "cyrillic": Band(min_chars=0.5),
    "other": Band(min_chars=0.2, max_byte_share=0.98),
}

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, script string, "
    "chars_per_token double, byte_share double, entropy double, entropy_share double, base_failed boolean, kept boolean"
)


def repeated_words(ids: np.ndarray, window: int = 8) -> int:
    """Places covered by windows that occur twice or more. Window ids are exact: pairs of pairs are ranked."""
    if len(ids) <= window:
        return 0
    span, codes = 1, ids.astype(np.int64)
    while span < window:
        step = min(span, window - span)
        pairs = codes[:-step] * (int(codes.max()) + 1) + codes[step:]
        _, codes = np.unique(pairs, return_inverse=True)
        span += step
    often = np.bincount(codes)[codes] > 1
    if not often.any():
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def repeated_lines(text: str, spaced: re.Pattern) -> int:
    counts = Counter(text.split("\n"))
    return sum(n - 1 for line, n in counts.items() if n > 1 and spaced.search(line))


def entropy_of(counts: np.ndarray) -> float:
    """Shannon entropy in bits."""
    shares = counts[counts > 0] / counts.sum()
    return float(-(shares * np.log2(shares)).sum()) + 0.0


def token_quality(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    pieces: str = PIECES,
    bands: dict[str, Band] = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col`` and ``FIELDS``: word and line counts, fertility measures, verdict.

    Each word is encoded with one space before it, so a text's tokens are those of its words.
    ``chars_per_token``: code points of the words per byte-level BPE token. ``byte_share``: share of
    the words' UTF-8 bytes that the SentencePiece vocabulary can only spell as single bytes. ``entropy``: of the text's BPE tokens, in
    bits; ``entropy_share``: of log2(number of tokens). The script is that of most letters; a text
    is kept if it stays inside its script's band ("other" where there is none) and the base rules.

    One pass, no shuffle; a task holds one Arrow batch of texts, the vocabularies and one text's
    words. Null, empty and white-space texts have no words and fail the base rule (under 20
    words); their measures are null. Other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    ranks = context.broadcast(read_ranks(vocabulary))
    with open(pieces, "rb") as file:
        model = context.broadcast(file.read())

    def setup():
        import sentencepiece
        import tiktoken

        coder = tiktoken.Encoding(name="supplied", pat_str=PRESPLIT, mergeable_ranks=ranks.value, special_tokens={})
        splitter = sentencepiece.SentencePieceProcessor()
        splitter.LoadFromSerializedProto(model.value)
        is_byte = frozenset(i for i in range(splitter.GetPieceSize()) if splitter.IsByte(i))
        spaced = re.compile(SPACED_WORD)
        symbols = re.compile(r"[#*$%&|<>]")
        starts = np.array([s for s, _ in SCRIPT_RANGES])
        names = ["common", *(name for _, name in SCRIPT_RANGES)]
        known = frozenset(splitter.IdToPiece(i) for i in range(splitter.GetPieceSize()))
        ordinary = frozenset(map(chr, range(0x21, 0x7F))) & known
        ascii_letters = re.compile("[^A-Za-z]+")
        opens_word = np.zeros(max(ranks.value.values()) + 1, bool)
        for token, rank in ranks.value.items():
            opens_word[rank] = token.startswith(b" ")

        def fallback_bytes(counted: Counter, text: str) -> int:
            """Bytes that the piece vocabulary spells one by one; only words with a sign it lacks can have any."""
            lacking = {c for c in set(text) - ordinary if c not in known and not c.isspace()}
            if not lacking:
                return 0
            rare = [w for w in counted if not lacking.isdisjoint(w)]
            coded = splitter.EncodeAsIds(rare, num_threads=1)
            return sum(counted[w] * sum(map(is_byte.__contains__, p)) for w, p in zip(rare, coded, strict=True))

        def script_of(text: str) -> str:
            if text.isascii():
                return "latin" if re.search("[A-Za-z]", text) else "other"
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            counts = np.bincount(np.searchsorted(starts, points, side="right"), minlength=len(names))
            by_script = Counter()
            for name, n in zip(names, counts.tolist(), strict=True):
                by_script[name] += n
            del by_script["common"]
            name, n = min(by_script.items(), key=lambda item: (-item[1], item[0]))
            if name == "latin" and 8 * (n - len(ascii_letters.sub("", text))) >= n:
                return "latin-marked"
            return name if n else "other"

        def judge(text: str) -> tuple:
            words = spaced.findall(text)
            counted = Counter(words)
            number = {w: i for i, w in enumerate(counted)}
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            chars = sum(map(len, words))
            n_repeat = repeated_words(ids)
            failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
            base = (len(words), chars, len(symbols.findall(text)), repeated_lines(text, spaced), n_repeat)
            script = script_of(text)
            if not words:
                return (*base, script, None, None, None, None, True, False)
            # each distinct word once; words hold no space, so a token with one in front opens the next word
            flat = np.array(coder.encode_ordinary(" " + " ".join(counted)))
            weights = np.fromiter(counted.values(), np.int64, len(counted))
            times = weights[np.cumsum(opens_word[flat]) - 1]
            order = np.argsort(flat)
            first = np.flatnonzero(np.diff(flat[order], prepend=-1))
            entropy = entropy_of(np.add.reduceat(times[order], first))
            n_tokens = int(times.sum())
            share = entropy / np.log2(n_tokens) if n_tokens > 1 else 0.0
            n_bytes = len(text.encode()) - (len(text) - chars)  # what is between words is ASCII
            per_char, bytes_share = chars / n_tokens, fallback_bytes(counted, text) / n_bytes
            band = bands.get(script, bands["other"])
            inside = (
                band.min_chars <= per_char <= band.max_chars
                and (n_tokens < band.entropy_from or per_char >= band.min_long_chars)
                and bytes_share <= band.max_byte_share
                and (n_tokens < band.entropy_from or share >= band.min_entropy_share)
            )
            return (*base, script, per_char, bytes_share, entropy, float(share), failed, bool(inside and not failed))

        return judge

    return map_texts(docs, id_col, text_col, FIELDS, setup)

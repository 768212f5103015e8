"""SentencePiece encoding and decoding of merge-type vocabularies, by backtracking over longest matches."""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words and chunks that a worker remembers at most, token pairs, longest chunk that it remembers; characters cut at once.
REMEMBERED, PAIRS, LONGEST, WINDOW = 300_000, 300_000, 48, 1 << 18
#: Ids decoded at once, or one longer row.
DECODED = 1 << 20

# fixed values: piece types and model type of the SentencePiece model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2


def read_model(path: str) -> dict:
    """Pieces with scores and types, the switches of the normalizer and the usable tokens of the model file at ``path``.

    Read on the driver and bounded by the vocabulary; plain values, so a broadcast needs nothing installed. Models
    that this encoder does not cover are refused.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    types = [p.type for p in model.pieces]
    refused = {
        "not of merge type": train.model_type != MERGES,
        "no byte fallback": not train.byte_fallback or types.count(BYTE) != 256,
        "a normalization table": bool(norm.precompiled_charsmap),
        "removes extra white space": norm.remove_extra_whitespaces,
        "white space is not escaped": not norm.escape_whitespaces,
        "white space as suffix": train.treat_whitespace_as_suffix,
        "user-defined or unused pieces": USER_DEFINED in types or UNUSED in types,
    }
    if any(refused.values()):
        raise ValueError(f"{path} is not supported: {', '.join(k for k, v in refused.items() if v)}")
    scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
    return {
        "pieces": [p.piece for p in model.pieces],
        "types": types,
        "scores": scores,
        # pieces that merging never ends with are no tokens; a sign that only longer pieces have is one
        "tokens": sorted({p for p in scores if merged(p, scores) == [p]} | {c for p in scores for c in p}),
        "dummy_prefix": norm.add_dummy_prefix,
        "unknown": train.unk_surface,
    }


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The merges themselves, on a short text: of all neighbours those whose union scores highest, leftmost first, become one."""
    parts = list(text)
    while True:
        best, place = None, 0
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, place = score, i
        if best is None:
            return parts
        parts[place : place + 2] = [parts[place] + parts[place + 1]]


def stays_apart(a: str, b: str, scores: dict[str, float]) -> bool:
    """Whether merging the two tokens' joined text again leaves them as they are: no merge goes over the border."""
    parts, border = list(a + b), len(a)
    scored = [scores.get(x + y) for x, y in pairwise(parts)]
    while True:
        best, place = None, 0
        for i, score in enumerate(scored):
            if score is not None and (best is None or score > best):
                best, place = score, i
        if best is None:
            return True
        if place == border - 1:
            return False
        parts[place : place + 2] = [parts[place] + parts[place + 1]]
        border -= place < border
        del scored[place]
        if place > 0:
            scored[place - 1] = scores.get(parts[place - 1] + parts[place])
        if place < len(scored):
            scored[place] = scores.get(parts[place] + parts[place + 1])


def chunk_pattern(pieces: Iterable[str]) -> str:
    """Pattern of the chunks of a text: runs of signs that pieces connect, with the spaces before them, or one other sign.

    Signs that stand side by side in a piece belong to one class, as do classes that share a sign: no piece holds two
    signs of different classes, space signs apart, which only begin pieces.
    """
    parent: dict[str, str] = {}

    def top(sign: str) -> str:
        while parent.setdefault(sign, sign) != sign:
            sign = parent[sign]
        return sign

    for piece in pieces:
        for a, b in pairwise(piece.lstrip(SPACE)):
            parent[top(a)] = top(b)
    classes: dict[str, list[str]] = {}
    for sign in parent:
        classes.setdefault(top(sign), []).append(sign)
    runs = [f"[{re.escape(''.join(sorted(c)))}]+" for c in sorted(classes.values(), key=len, reverse=True) if len(c) > 1]
    return f"(?s:{SPACE}*(?:{'|'.join([*runs, f'[^{SPACE}]'])})|{SPACE}+)"


def encoder(model: dict) -> Callable[[str], bytes]:
    """A function from a whole text to its ids, as the bytes of 32-bit numbers.

    A sequence of tokens is the one that the merges give exactly if each two neighbours are: merging their
    joined text again gives these two. So a chunk is read from the left: the longest token that begins at a place, then its
    shorter prefixes, until one is compatible with the token before. Where none is, the place is marked in a
    bitfield of failed positions and the token before gives way to its next shorter prefix. No place fails twice,
    so the work grows with the length. Longest matches come from an Aho-Corasick automaton of the reversed tokens,
    run over the reversed chunk once: what ends at a place there begins there here.

    A text is cut where no piece goes on, first before spaces, then between signs that no piece has side by side (see
    ``chunk_pattern``), and each chunk is encoded by itself. Words and chunks come back, so a bounded number of them is
    remembered with their ids.
    """
    import ahocorasick

    class Memory(dict):
        """Bytes of words and chunks; what is not there is made, and what has not come up for a while is forgotten."""

        older: dict[str, bytes] = {}

        def __missing__(self, word: str) -> bytes:
            ids = self.older.get(word)
            if ids is None:
                parts = chunks.findall(word)
                ids = coded(word) if len(parts) == 1 else b"".join(map(self.__getitem__, parts))
            if len(word) <= LONGEST:
                if len(self) >= REMEMBERED // 2:
                    self.older = dict(self)
                    self.clear()
                self[word] = ids
            return ids

    scores, types, tokens = model["scores"], model["types"], set(model["tokens"])
    number = {p: i for i, (p, t) in enumerate(zip(model["pieces"], types)) if t == NORMAL}
    fallback = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(model["pieces"], types)) if t == BYTE}
    automaton = ahocorasick.Automaton()
    same = {token: token for token in tokens}  # one string for a token wherever it is met
    for token in (t for t in same if len(t) > 1):  # with the tokens that are prefixes of it, itself first
        prefixes = (same.get(token[:k]) for k in range(len(token), 0, -1))
        automaton.add_word(token[::-1], tuple(p for p in prefixes if p is not None))
    automaton.make_automaton()
    cuts = not any(SPACE in p.lstrip(SPACE) for p in scores)  # else the texts are not cut
    chunks = re.compile(chunk_pattern(scores) if cuts else "(?s:.+)")
    runs = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if cuts else "(?s:.+)")
    memory = Memory()
    known: dict[tuple[str, str], bool] = {}
    firsts: dict[str, dict[str, int]] = {}
    nothing: dict[str, int] = {}
    room = PAIRS

    def compatible(a: str, b: str) -> bool:
        """Whether merging the two tokens' joined text again leaves them as they are."""
        found = known.get((a, b))
        if found is None:
            if len(known) >= PAIRS:
                known.clear()
            found = known[a, b] = a + b not in tokens and stays_apart(a, b, scores)
        return found

    def following(before: str | None, prefixes: tuple[str, ...], k: int) -> int:
        """The first place from ``k`` on of a prefix that may follow ``before``."""
        while k < len(prefixes) and not (before is None or compatible(before, prefixes[k])):
            k += 1
        return k

    def first_behind(before: str, prefixes: tuple[str, ...]) -> int:
        nonlocal room
        if room == 0:
            firsts.clear()
            room = PAIRS
        room -= 1
        k = firsts.setdefault(before, {})[prefixes[0]] = following(before, prefixes, 0)
        return k

    def tokens_of(chunk: str) -> list[str]:
        if chunk in tokens:
            return [chunk]
        size = len(chunk)
        # by places from the end; of the tokens that end at a place the longest comes first, so it is entered last.
        # Where there is none, the sign stands alone: one that no piece has never merges
        found = [*automaton.iter(chunk[::-1])]
        found.reverse()
        longest, last = dict(found), size - 1
        at, taken, tried, failed = 0, [], [], None
        prefixes, k = longest.get(last) or (chunk[0],), 0
        while at < size:
            while k < len(prefixes):
                token = prefixes[k]
                to = at + len(token)
                if failed is None or not failed[to >> 3] >> (to & 7) & 1:
                    break
                k = following(taken[-1] if taken else None, prefixes, k + 1)
            if k < len(prefixes):
                taken.append(token)
                tried.append((prefixes, k))
                at = to
                if at < size:
                    prefixes = longest.get(last - at) or (chunk[at],)
                    k = firsts.get(token, nothing).get(prefixes[0])
                    if k is None:
                        k = first_behind(token, prefixes)
            else:
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(taken.pop())
                prefixes, k = tried.pop()
                k = following(taken[-1] if taken else None, prefixes, k + 1)
        return taken

    spelled = {p: array("i", [i]).tobytes() for p, i in number.items()}

    def coded(chunk: str) -> bytes:
        try:
            return b"".join([spelled[token] for token in tokens_of(chunk)])
        except KeyError:  # a sign that is no piece is spelled in bytes
            ids = array("i")
            for token in tokens_of(chunk):
                ids.extend([number[token]] if token in number else [fallback[byte] for byte in token.encode()])
            return ids.tobytes()

    def windows(text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = at + WINDOW if cuts else len(text)
            while end < len(text) and not (text[end] == SPACE and text[end - 1] != SPACE):
                end = text.find(SPACE, end + 1)
                end = len(text) if end < 0 else end
            yield text[at:end]
            at = end

    def words(window: str) -> list[str]:
        """The window cut before each run of spaces."""
        if cuts and SPACE + SPACE not in window:
            return window.replace(SPACE, " " + SPACE).split(" ")
        return runs.findall(window)

    def encode(text: str) -> bytes:
        shown = (SPACE if model["dummy_prefix"] else "") + text.replace(" ", SPACE) if text else ""
        return b"".join([b"".join(map(memory.__getitem__, words(window))) for window in windows(shown)])

    return encode


def spelled_pieces(model: dict) -> list[bytes]:
    """What each id stands for."""
    spellings = []
    for piece, kind in zip(model["pieces"], model["types"]):
        text = {CONTROL: "", UNKNOWN: model["unknown"]}.get(kind, piece.replace(SPACE, " "))
        spellings.append(bytes([int(piece[1:-1], 16)]) if kind == BYTE else text.encode())
    return spellings


def decoder(model: dict) -> Callable[[list[int]], str]:
    """A function from ids to text: pieces joined, byte pieces read as UTF-8 with a replacement sign for each wrong byte.

    The one space that encoding put in front goes; control pieces have no text. Unknown ids raise.
    """
    spellings, types = spelled_pieces(model), model["types"]
    codecs.register_error("each_byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))
    controls = frozenset(i for i, kind in enumerate(types) if kind == CONTROL)

    def read(ids: list[int]) -> str:
        return b"".join(map(spellings.__getitem__, ids)).decode(errors="each_byte")

    def decode(ids: list[int]) -> str:
        if ids and min(ids) < 0:
            raise ValueError("negative id")
        if controls.isdisjoint(ids):
            text, first = read(ids), ids[:1]
        else:  # bytes on both sides of a control piece are not one sign
            runs = [list(run) for control, run in groupby(ids, controls.__contains__) if not control]
            text, first = "".join(map(read, runs)), [run[0] for run in runs[:1]]
        opened = model["dummy_prefix"] and first and types[first[0]] == NORMAL and text.startswith(" ")
        return text[1:] if opened else text

    return decode


def column_decoder(model: dict) -> Callable[[pa.Array], list[str | None]]:
    """``decoder`` for a column of id lists: the pieces of many rows are looked up and joined at once.

    Rows with control pieces are rare and go one by one.
    """
    decode = decoder(model)
    spellings = pa.array(spelled_pieces(model), pa.large_binary())
    kinds = np.array(model["types"], np.uint8)

    def joined(lists: pa.Array) -> list[str | None]:
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        ids = lists.flatten()
        flat = ids.to_numpy(zero_copy_only=False)
        if len(flat) and flat.min() < 0:
            raise ValueError("negative id")
        kind = kinds[flat]
        if (kind == CONTROL).any():
            return [None if row is None else decode(row) for row in lists.to_pylist()]
        bounds = pa.array(np.concatenate([[0], ends]), pa.int64())
        texts = pc.binary_join(pa.LargeListArray.from_arrays(bounds, spellings.take(ids)), pa.scalar(b"", pa.large_binary()))
        firsts = np.zeros(len(lists), bool)
        filled = lengths > 0
        firsts[filled] = kind[(ends - lengths)[filled]] == NORMAL
        out: list[str | None] = []
        for text, first, valid in zip(texts.to_pylist(), firsts.tolist(), lists.is_valid().to_pylist()):
            shown = text.decode(errors="each_byte") if valid else None
            out.append(shown[1:] if first and model["dummy_prefix"] and shown.startswith(" ") else shown)
        return out

    def decode_column(lists: pa.Array) -> list[str | None]:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        out, at, done = [], 0, 0
        while at < len(lists):
            to = max(at + 1, int(np.searchsorted(ends, done + DECODED, side="right")))
            out += joined(lists.slice(at, to - at))
            at, done = to, int(ends[to - 1])
        return out

    return decode_column


def shared(value: dict, name: str, make: Callable):
    """What ``make`` builds from a broadcast value, once per Python worker: the value stays there between tasks."""
    if name not in value:
        value[name] = make(value)
    return value[name]


def encode_texts(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids): each whole text's ids, without begin and end ids, exactly as the vocabulary's own library gives them.

    One pass, rows stay where they are. A task holds the vocabulary, one Arrow batch, its ids and a bounded memory of chunks.
    Null and empty texts have no ids. Repeated rows stay, null ids too. Other columns are not read. ``model`` is read on the driver.
    """
    known = docs.sparkSession.sparkContext.broadcast(read_model(model))
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared(known.value, "encode", encoder)
        for batch in batches:
            coded = [encode(text.as_py() or "") for text in batch.column(1)]
            lengths = array("q", [0])
            for ids in coded:
                lengths.append(lengths[-1] + len(ids) // 4)
            values = pa.Array.from_buffers(pa.int32(), lengths[-1], [None, pa.py_buffer(b"".join(coded))])
            made = pa.LargeListArray.from_arrays(pa.array(lengths, pa.int64()), values).cast(arrow.field(1).type)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), made], schema=arrow)

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, schema)


def decode_ids(coded: DataFrame, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``text``: the text that the ids stand for. Null ids give null, no ids the empty text."""
    known = coded.sparkSession.sparkContext.broadcast(read_model(model))
    schema = T.StructType([coded.schema[c] for c in keep]).add("text", T.StringType())
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = shared(known.value, "decode", column_decoder)
        for batch in batches:
            texts = decode(batch.column(len(keep)))
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, arrow.field(len(keep)).type)], schema=arrow)

    return coded.select(*(f"`{c}`" for c in keep), f"`{ids_col}`").mapInArrow(run, schema)

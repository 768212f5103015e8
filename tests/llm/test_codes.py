import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenmill.llm import pieces
from tokenmill.llm.divergence import source_divergence
from tokenmill.llm.vector_codes import nearest_entries, vector_codes


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


SIGNS = [" ", "  ", "\n", "\t", "e", "th", "ing", "2024", "▁", "é", "漢字", "😀", "\x00", "...", "ZZZ", "<s>", "<unk>", "<0x41>", "𝔘", " " * 17]


def mixed(rng, n):
    return "".join(rng.choice(SIGNS) if rng.random() < 0.5 else rng.choice("abcdefghijklmnopqrstuvwxyzABC") for _ in range(n))


def test_pieces_are_those_of_the_library(spark, frame, odd_rows, library):
    rng = random.Random(3)
    rows = odd_rows + [(100 + i, mixed(rng, rng.randrange(60))) for i in range(2000)]
    rows += [(5000, " " * 100_001), (5001, mixed(rng, 40_000).replace(" ", "")), (5002, mixed(rng, 300_000)), (5003, "a" * 100_000)]
    coded = pieces.encode_texts(frame(rows))
    got = Counter((r.doc_id, tuple(r.ids)) for r in coded.collect())
    assert got == Counter((i, tuple(library.encode(t or ""))) for i, t in rows)
    spelled = pieces.decode_ids(coded)
    assert Counter(map(tuple, spelled.collect())) == Counter((i, library.decode(library.encode(t or ""))) for i, t in rows)


def test_any_ids_are_decoded_as_the_library_does(library):
    rng = random.Random(4)
    decode = pieces.decoder(pieces.read_model(pieces.MODEL))
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000), 29871, 0, 1, 2]) for _ in range(rng.randrange(12))]
        assert decode(ids) == library.decode(ids)


@pytest.mark.parametrize("at_once", [7, 1 << 20])
def test_a_column_of_ids_is_decoded_as_its_rows(library, monkeypatch, at_once):
    monkeypatch.setattr(pieces, "DECODED", at_once)
    rng, model = random.Random(6), pieces.read_model(pieces.MODEL)
    decode = pieces.column_decoder(model)
    for ids in (range(3, 32000), range(3, 300), [1, 2, 0, 29871, 400, 3 + 0xE6]):
        rows = [rng.choices([*ids, 29871], k=rng.randrange(12)) for _ in range(400)] + [None, [], list(ids)]
        rng.shuffle(rows)
        lists = pa.array([[5], *rows], pa.list_(pa.int32())).slice(1)
        assert decode(lists) == [None if row is None else library.decode(row) for row in rows]
    with pytest.raises(ValueError):
        decode(pa.array([[3], [-1]], pa.list_(pa.int32())))
    with pytest.raises(IndexError):
        decode(pa.array([[3], [32000]], pa.list_(pa.int32())))


def test_words_are_cut_before_each_run_of_spaces(library):
    encode = pieces.encoder(pieces.read_model(pieces.MODEL))
    for text in (" a", "  a", "a ", "a  ", "a  b c", "a▁ b", "a ▁b", "▁", " ▁", "a.\nB, c!!", "a b" * 9 + "  ", "x " * 300_000, " x" * 300_000):
        for _ in range(2):  # made, then remembered
            assert np.frombuffer(encode(text), np.int32).tolist() == library.encode(text)


def test_a_full_memory_of_chunks_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    monkeypatch.setattr(pieces, "WINDOW", 11)
    encode, rng = pieces.encoder(pieces.read_model(pieces.MODEL)), random.Random(5)
    for _ in range(300):
        text = mixed(rng, 50)
        assert np.frombuffer(encode(text), np.int32).tolist() == library.encode(text)


def test_pieces_of_an_empty_table_and_null_ids(spark, frame):
    assert pieces.decode_ids(pieces.encode_texts(frame([]))).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [tuple(r) for r in pieces.decode_ids(none).orderBy("doc_id").collect()] == [(1, None), (2, "")]


def brute_divergence(rows, min_docs, top):
    """rows of (text, lang, source); plain loops over exact whole numbers."""
    words = [(lang or "", source or "", terms(text)) for text, lang, source in rows]
    out = []
    for lang in {w[0] for w in words}:
        mine = [w for w in words if w[0] == lang]
        docs = Counter(t for _, _, ts in mine for t in set(ts))
        kept = {t for t, n in docs.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for _, source, ts in mine:
            counts[source].update(t for t in ts if t in kept)
        every = sum(counts.values(), Counter())

        def share(counter, t):
            return 1 + 10**9 * (counter[t] + 1) // (sum(counter.values()) + len(kept))

        p = {s: {t: share(c, t) for t in kept} for s, c in counts.items()}
        q = {t: share(every, t) for t in kept}
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
            own = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            own.sort(key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(own[:top])]
    return sorted(out)


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("span, left", [(4096, 256), (16, 2)])
def test_divergence_equals_brute_force(spark, span, left):
    rng = random.Random(6)
    vocabulary = [rng.choice("abcxyzÉé") * rng.randrange(1, 4) + rng.choice(["", "q", "ü", "Z"]) + str(i % 7) + chr(97 + i % 26) for i in range(300)]
    rows = [
        (" ".join(rng.choices(vocabulary, k=rng.randrange(40))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "d", None]))
        for _ in range(150)
    ]
    rows += [(None, "en", "bare"), ("", "none", "x"), ("once", "none", "y"), (None, None, None), ("same same", "fr", "s")] + [("same same", "fr", "s")] * 3
    rows += [("long " * 250_000 + "Tail", "fr", "t")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "n", "docs", "block", "value")})
    got = source_divergence(docs, top_terms=20, span=span, left=left)
    assert got.dtypes[-2:] == [("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, 3, 20)


def test_divergence_of_an_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


@pytest.mark.parametrize("scale", [6, 4_000_000])  # floating-point products are exact for the first, whole numbers for both
def test_search_finds_the_nearest_and_lowest_entry(scale):
    rng = np.random.default_rng(7)
    for m, entries, n in [(4, 1, 5), (4, 50, 700), (1, 30, 300), (16, 256, 900), (0, 3, 4)]:
        x, book = (rng.integers(-scale, scale, (k, m)) for k in (n, entries))
        apart = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        index, best = nearest_entries(x, book)
        assert (index == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def brute_codes(rows, entries, rounds=4):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort()
    m = len(good[0][1]) // 4
    cut = [[v[p * m : (p + 1) * m] for p in range(4)] for _, v in good]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            for i, parts in groups.items():
                books[p][i] = [sum(col) // len(parts) for col in zip(*parts)]
    found = [[near(c[p], books[p]) for p in range(4)] for c in cut]
    return sorted((i, [e for _, e in f], sum(d for d, _ in f)) for (i, _), f in zip(good, found)), books


def test_codes_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(i * 3 % 211, [rng.choice([rng.gauss(0, 0.3), 0.25, -0.001]) for _ in range(8)]) for i in range(200)]
    rows += [(300, None), (301, [0.1] * 7 + [None]), (302, [0.1] * 7 + [float("nan")]), (303, [float("inf")] + [0.0] * 7), rows[5], rows[5]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({c: F.lit(1) for c in ("_vector", "code", "error", "label")})
    got, books = vector_codes(vectors, keep=("label",), entries=20)
    as_floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want, want_books = brute_codes(as_floats, 20)
    assert [b.tolist() for b in books] == want_books
    assert sorted((r.vec_id, list(r.code), r.error) for r in got.collect()) == want


def test_vectors_that_cannot_be_cut_alike(spark):
    schema = "vec_id bigint, embedding array<float>"
    got, _ = vector_codes(spark.createDataFrame([(1, [0.5] * 4), (2, [0.5] * 8), (None, [0.25] * 4)], schema))
    assert {r.vec_id: (r.code, r.error) for r in got.collect()} == {1: ([0] * 4, 0), 2: (None, None), None: ([1] * 4, 0)}
    got, books = vector_codes(spark.createDataFrame([(1, [0.5] * 5)], schema))
    assert [tuple(r) for r in got.collect()] == [(1, None, None)] and books == []
    got, _ = vector_codes(spark.createDataFrame([(1, []), (2, [])], schema))
    assert sorted(map(tuple, got.collect())) == [(1, [0] * 4, 0), (2, [0] * 4, 0)]
    got, books = vector_codes(spark.createDataFrame([], schema))
    assert got.count() == 0 and books == []
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [1e30] * 4)], schema))

import itertools
import random
import re
import threading
import time
from collections import Counter

import numpy as np
import pytest

from tokenmill.llm import fertility, language_id, license_scan, secret_scan
from tokenmill.llm.common import SPACED_WORD


def test_license_scan_finds_blocks_and_places(frame):
    texts = [
        (1, "Intro line.\nPermission is hereby granted, free of charge, to any\nperson obtaining a copy of this software."),
        (2, "the MIT license and the mit License; not a mit-ish license"),
        (3, "Redistribution and use, in source or binary forms"),
        (4, "no notice at all"),
    ]
    rows = {r.doc_id: r for r in license_scan.license_scan(frame(texts)).collect()}
    assert {b.label for b in rows[1].blocks} == {"mit"} and rows[1].blocks[0].containment == 1.0 and rows[1].blocks[0].word == 2
    assert [p.word for p in rows[2].places] == [1, 5]
    assert not rows[4].blocks and not rows[4].places and rows[4].n_words == 4


@pytest.mark.parametrize("gap", ["\n", "\n\n \n// ", " "])
def test_a_notice_over_any_number_of_lines_is_found(frame, gap):
    notice = "permission is hereby granted free of charge to any person obtaining a copy of this software".split()
    texts = [(1, "intro text " * 9 + gap.join(notice) + " and more" * 9), (2, (" filler" * 9 + " ").join(notice))]
    rows = {r.doc_id: r for r in license_scan.license_scan(frame(texts)).collect()}
    assert {b.label for b in rows[1].blocks} == {"mit"} and rows[1].blocks[0].containment == 1.0
    assert not rows[2].blocks  # the words are there, but nowhere together


def test_license_blocks_equal_brute_force(frame, documents):
    rng, templates = random.Random(21), license_scan.TEMPLATES
    vocabulary = [w for _, t in templates for w in t.split()] + ["other", "word"]
    texts = {r.doc_id: r.text for r in documents.collect()}
    texts |= {10_000 + i: " ".join(rng.choices(vocabulary[-30:], k=60)) for i in range(60)}
    texts |= {20_000 + i: " ".join(w for w in (t + " x y ") .split() * 2 if rng.random() < 0.85) for i, (_, t) in enumerate(templates * 6)}
    found = license_scan.license_scan(frame(list(texts.items()))).collect()
    hits = 0
    for row in found:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in texts[row.doc_id]))
        want = []
        for label, notice in templates:
            plain = re.findall("[a-z0-9]+", notice)
            tokens = set(plain)
            for at in range(len(words)):
                held = tokens & set(words[at : at + 2 * len(plain)])
                if words[at] in tokens and 5 * len(held) >= 4 * len(tokens):
                    want.append((label, at, len(held) / len(tokens)))
        hits += len(want)
        assert sorted((b.label, b.word, b.containment) for b in row.blocks) == sorted(want)
    assert hits > 500


def test_license_scan_of_odd_rows(frame, odd_rows, spark):
    assert license_scan.license_scan(frame(odd_rows)).count() == len(odd_rows)
    assert license_scan.license_scan(frame([])).count() == 0


def plain_secrets(text):
    """Base spans, read by hand from the contract: maximal runs of signs, and what stands before a value."""
    found, n = [], len(text)
    low = "".join(c.lower() if c.isascii() else c for c in text)
    at = 0
    while at < n:
        key = next((k for k in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(k, at)), None)
        end = at + len(key) if key else at
        if key:
            end += end < n and text[end] in "\"'"
            while end < n and text[end] == " ":
                end += 1
            if end < n and text[end] in ":=":
                end += 1
                while end < n and text[end] == " ":
                    end += 1
                end += end < n and text[end] in "\"'"
                value = end
                while end < n and text[end].isascii() and (text[end].isalnum() or text[end] in "+/_.=-"):
                    end += 1
                if end > value:
                    if end - value >= 6:
                        found.append((at, 0, end))
                    at = end
                    continue
        at += 1
    for k, signs, least, opens in ((1, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20, "AKIA"), (2, "0123456789abcdef", 24, "")):
        at = 0
        while at < n:
            begins = text.startswith(opens, at) and text[at] in signs
            end = at
            while begins and end < n and text[end] in signs:
                end += 1
            if begins and end - at >= max(least, len(opens) + 1):
                found.append((at, k, end))
            at = end if begins and end > at + len(opens) else at + 1
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def test_secrets_equal_the_plain_patterns(frame):
    rng = random.Random(3)
    parts = ["password: ", "token=", "API-KEY ", "api_key\" = '", "AKIA", "deadbeef" * 4, "ABCDEF0123456789XYZ", "é", " ", "=", "ſecret=abcdefgh"]
    texts = [(i, "".join(rng.choice(parts) for _ in range(14))) for i in range(300)]
    for row in secret_scan.secret_scan(frame(texts)).collect():
        base = [tuple(s) for s in row.secrets if s.kind != "random"]
        assert base == plain_secrets(texts[row.doc_id][1])


@pytest.mark.parametrize(
    "text, random_spans",
    [
        ("key zX9qT4vB7nL2kW8rJ5mC1 end", 1),
        ("sum d41d8cd98f00b204e9800998ecf8427e end", 0),
        ("id 123e4567-e89b-12d3-a456-426614174000 end", 0),
        ("call get_user_by_identifier_2 now", 0),
        ("InternationalizationServiceFactory2", 0),
        ("a plain sentence of words", 0),
    ],
)
def test_random_strings(frame, text, random_spans):
    row = secret_scan.secret_scan(frame([(1, text)])).first()
    assert sum(s.kind == "random" for s in row.secrets) == random_spans


def test_a_log_of_many_finds_is_scanned_in_time(frame):
    log = " ".join(f"{'%024x' % (i * 7919)}{'0123456789abcdef' * 2} and x9Qz{i % 10}T4vB7nL2kW8rJ5mC1" for i in range(100_000))
    started = time.time()
    row = secret_scan.secret_scan(frame([(1, log)])).first()
    kinds = Counter(s.kind for s in row.secrets)
    assert kinds == {"hex": 100_000, "random": 100_000} and time.time() - started < 60


def test_random_runs_that_touch_base_spans_are_none(frame):
    rng = random.Random(31)
    parts = ["token=", "deadbeef" * 3, "zX9qT4vB7nL2kW8rJ5mC1", "AKIA" + "A1" * 9, " ", "/", "é"]
    texts = [(i, "".join(rng.choice(parts) for _ in range(12))) for i in range(200)]
    for row in secret_scan.secret_scan(frame(texts)).collect():
        base = [s for s in row.secrets if s.kind != "random"]
        assert all(s.kind != "random" or all(s.end <= b.start or b.end <= s.start for b in base) for s in row.secrets)


def test_identifiers_are_told_in_one_pass(spark, frame):
    slug = "com/towards-data-science/the-complete-guide-to-time-series-analysis-and-forecasting-with-many-more-words-behind-it-and-a-hash-70d476bfe775"
    texts = [slug, "v1" + "-" * 4000 + "x1Y2z3", "abcdefghij" * 20 + "1x2", "Ab" * 2000 + "1x2", "a_" * 3000 + "x1Y2z3"]
    timer = threading.Timer(90, spark.sparkContext.cancelAllJobs)  # a rule that backtracks does not end
    timer.start()
    try:
        rows = secret_scan.secret_scan(frame(list(enumerate(texts)))).collect()
    finally:
        timer.cancel()
    assert len(rows) == len(texts) and not next(r for r in rows if r.doc_id == 0).secrets


def test_identifiers_are_the_same_strings():
    part = r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
    plain = re.compile(rf"(?:{part}{{1,2}}|(?:[A-Z]?[a-z]{{2,}}|[A-Z]{{2,}})+[0-9]*)(?:[_/=+-]+{part}{{0,2}})*")
    quick = re.compile(secret_scan.IDENTIFIER)
    rng = random.Random(8)
    texts = ["".join(t) for n in range(1, 8) for t in itertools.product("aB1-", repeat=n)]
    texts += ["".join(rng.choice("abAB12_/=") for _ in range(rng.randint(8, 14))) for _ in range(50_000)]
    assert all(bool(plain.fullmatch(t)) == bool(quick.fullmatch(t)) for t in texts)


def test_secret_scan_of_odd_rows(frame, odd_rows):
    assert secret_scan.secret_scan(frame(odd_rows)).count() == len(odd_rows)
    assert secret_scan.secret_scan(frame([])).count() == 0


def brute_counts(text):
    words = re.findall(SPACED_WORD, text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        again += line in seen and bool(re.search(SPACED_WORD, line))
        seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_fertility_counts_equal_brute_force(frame, documents, odd_rows):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("ab \n#é") for _ in range(200))) for i in range(60)]
    texts += [(r.doc_id, r.text) for r in documents.limit(60).collect()]
    texts += odd_rows
    rows = fertility.token_quality(frame(texts)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((i, *brute_counts(t)) for i, t in texts)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_fertility_measures_are_those_of_the_vocabularies(frame):
    import sentencepiece
    import tiktoken

    text = "Shared words, shared words and ünïcode \U0001f600 here \u4e2d\u6587"
    row = fertility.token_quality(frame([(1, text)])).first()
    ranks = secret_scan.read_ranks(secret_scan.VOCABULARY)
    coder = tiktoken.Encoding(name="t", pat_str=secret_scan.PRESPLIT, mergeable_ranks=ranks, special_tokens={})
    words = text.split(" ")
    tokens = [t for w in words for t in coder.encode_ordinary(" " + w)]
    shares = np.array(list(Counter(tokens).values())) / len(tokens)
    assert row.chars_per_token == pytest.approx(sum(map(len, words)) / len(tokens))
    assert row.entropy == pytest.approx(-(shares * np.log2(shares)).sum())
    pieces = sentencepiece.SentencePieceProcessor(model_file=fertility.PIECES)
    single = sum(pieces.IsByte(i) for w in words for i in pieces.EncodeAsIds(w))
    assert row.byte_share == pytest.approx(single / sum(len(w.encode()) for w in words))


def test_fertility_rejects_one_word_and_byte_texts(frame):
    letters = "bcdfghjklmnpqrstvwxz"
    noise = " ".join(letters[i % 20] + letters[i * 7 % 20] + "\u0253\u1e37\u01a5" * 4 for i in range(200))
    prose = "the committee met again on tuesday to discuss how new roads would reach small villages near our river"
    rows = {r.doc_id: r for r in fertility.token_quality(frame([(1, noise), (2, prose + " before " + prose[::-1])])).collect()}
    assert not rows[1].kept
    clean = {r.doc_id: r for r in fertility.token_quality(frame([(3, " ".join(sorted(set(prose.split()))) + " while winter lasts")])).collect()}
    assert clean[3].kept


def test_fertility_tells_noise_from_prose(frame, documents):
    """Both kinds of errors: of noise of four kinds nothing is kept, of the given prose nothing is lost to the bands."""
    import base64

    rng, letters = random.Random(12), "abcdefghijklmnopqrstuvwxyz"
    word = lambda signs, low, high: "".join(rng.choice(signs) for _ in range(rng.randint(low, high)))
    noise = [" ".join(word(letters, 2, 10) for _ in range(150)) for _ in range(20)]
    noise += [" ".join(word(letters + letters.upper() + "0123456789", 4, 12) for _ in range(150)) for _ in range(20)]
    noise += ["\n".join(base64.b64encode(rng.randbytes(54)).decode() for _ in range(40)) for _ in range(20)]
    noise += [" ".join(f"{rng.randrange(256):02x}" for _ in range(300)) for _ in range(20)]
    noise += [" ".join(rng.choices(["buy", "now", "cheap"], k=300)) for _ in range(20)]
    assert not any(r.kept for r in fertility.token_quality(frame(list(enumerate(noise)))).collect())
    prose = [r for r in fertility.token_quality(documents).collect() if not r.base_failed]
    assert len(prose) > 100 and all(r.kept for r in prose)
    marked = "tiếng việt được viết bằng chữ cái la tinh với nhiều dấu và người ta đọc nó mỗi ngày trên báo hay trong sách của mình " * 2
    row = fertility.token_quality(frame([(1, marked)])).first()
    assert row.script == "latin-marked"


def test_language_id_on_held_out_rows(documents):
    rows = language_id.identify(documents)
    joined = rows.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in joined) / len(joined) > 0.9
    assert all(0 <= r.score <= 1 for r in joined)


def test_language_id_odd_rows(frame, odd_rows, documents):
    rows = language_id.identify(frame([*odd_rows, (7, "123 !?")], lang="en")).collect()
    assert len(rows) == len(odd_rows) + 1
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 4, 7)} == {"und"}
    assert {r.lang_pred for r in language_id.identify(frame([(1, "words")])).collect()} == {"und"}
    assert language_id.identify(frame([])).count() == 0


def test_held_out_rows_are_not_learned_from(frame, spark):
    import zlib

    rows = language_id.training_rows(
        frame([(i, f"text {i}") for i in range(200)], lang="en"), language_id.Training(), "doc_id", "text", "lang"
    )
    learned = {int(text.split()[1]) for text, _ in rows}
    assert learned == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_a_repeated_row_does_not_fill_the_sample(spark, frame):
    rows = [(0, "the same text again")] * 4000 + [(i, f"text number {i}") for i in range(1, 300)]
    how = language_id.Training(max_documents=100)
    assert len(language_id.training_rows(frame(rows, lang="en"), how, "doc_id", "text", "lang")) <= 100


def test_many_languages_are_all_learned(spark):
    rows = [(i, f"text of language {i}", f"l{i % 300}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = language_id.training_rows(docs, language_id.Training(), "doc_id", "text", "lang")
    assert len({lang for _, lang in learned}) == 300


def test_portions_hold_the_buckets_of_the_whole_text(monkeypatch):
    letters, rng = language_id.letter_table(), random.Random(9)
    texts = ["".join(rng.choice("abcé ,\n") for _ in range(500)) for _ in range(20)] + ["word " * 100, "", "a"]
    whole = [sorted(language_id.gram_buckets(t, letters, 15).tolist()) for t in texts]
    monkeypatch.setattr(language_id, "PORTION", 40)
    assert [sorted(b for p in language_id.portions(t, letters, 15) for b in p.tolist()) for t in texts] == whole


def test_predictions_are_those_of_the_plain_model(documents):
    """The registered prediction against the model's own arithmetic, one gram at a time."""
    how = language_id.Training()
    made = language_id.fit(language_id.training_rows(documents, how, "doc_id", "text", "lang"), how)
    letters = language_id.letter_table()
    texts = {r.doc_id: r.text for r in documents.limit(40).collect()}
    for row in language_id.identify(documents).where(f"doc_id in ({','.join(map(str, texts))})").collect():
        buckets = language_id.gram_buckets(texts[row.doc_id], letters, how.bucket_bits)
        if not len(buckets):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        total = sum((made.scores[b].astype(float) for b in buckets), np.zeros(len(made.languages))) / len(buckets) + made.bias
        shares = np.exp(total / made.temperature) / np.exp(total / made.temperature).sum()
        assert row.lang_pred == made.languages[int(shares.argmax())] and row.score == pytest.approx(float(shares.max()), abs=1e-6)

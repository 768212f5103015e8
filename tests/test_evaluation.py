import math
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions.tokenizers import ByteTokenizer
from tokenmill.operators import picks, requests, scoring, tensors
from tokenmill.sources import readers

E = C.END_OF_TEXT
BYTES = ByteTokenizer()
REQUEST = "item_id bigint, choice_idx int, context string, continuation string"


def test_choices_keep_their_order(spark):
    items = spark.createDataFrame(
        [(1, "c", ["a", "b", "d"], 2)], "item_id bigint, ctx string, endings array<string>, label int"
    )
    got = sorted(tuple(r) for r in requests.choice_requests(items).collect())
    assert got == [(1, 0, "c", " a", 2), (1, 1, "c", " b", 2), (1, 2, "c", " d", 2)]


def test_labelled_choices(spark):
    items = spark.createDataFrame(
        [(1, "q", (["x", "y"], ["B", "A"]), "A")],
        "item_id bigint, question string, choices struct<text: array<string>, label: array<string>>, answer_key string",
    )
    got = sorted(tuple(r) for r in requests.labelled_choice_requests(items).collect())
    assert got == [(1, 0, "q", " x", "B", "A"), (1, 1, "q", " y", "A", "A")]


def test_last_word_limit_counts_valid_items(spark):
    items = spark.createDataFrame(
        [(1, "one"), (2, "a b  c"), (3, ""), (4, "x "), (5, "p q\nr s")], "item_id bigint, text string"
    )
    got = {r.item_id: (r.context, r.continuation) for r in requests.last_word_requests(items).collect()}
    assert got == {2: ("a b ", " c"), 4: ("x", " "), 5: ("p q\nr", " s")}
    assert {r.item_id for r in requests.last_word_requests(items, 2).collect()} == {2, 4}


def test_cloze_needs_exactly_one_blank(spark):
    items = spark.createDataFrame(
        [(1, "a _ c", "x", "y", "1"), (2, "no blank", "x", "y", "1"), (3, "_ and _", "x", "y", "2"), (4, "end _", "x", "y", "2")],
        "item_id bigint, sentence string, option1 string, option2 string, answer string",
    )
    got = sorted(tuple(r) for r in requests.cloze_requests(items).collect())
    assert got == [
        (1, 0, "a ", "x c", "1"),
        (1, 1, "a ", "y c", "1"),
        (4, 0, "end ", "x", "2"),
        (4, 1, "end ", "y", "2"),
    ]


def test_long_requests_lose_their_left(spark):
    rows = spark.createDataFrame([(1, 0, "abc", "de"), (2, 0, "a", "d"), (3, 0, "a", "defgh")], REQUEST)
    got = {r.item_id: (bytes(r.tokens), r.cont_start) for r in requests.loglik_requests(rows, BYTES, 4).collect()}
    assert got == {1: (b"bcde", 2), 2: (b"ad", 1), 3: (b"defgh", 0)}


def _fit(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return scoring.fit_bigram(docs, BYTES)


def _brute(texts):
    pairs = Counter()
    for t in texts:
        tokens = [E, *t.encode(), E]
        pairs.update(zip(tokens, tokens[1:]))
    totals = Counter()
    for (prev, _), n in pairs.items():
        totals[prev] += n
    return lambda prev, nxt: math.log((pairs[(prev, nxt)] + 1) / (totals[prev] + C.VOCAB_SIZE))


TEXTS = ["the then", "hat", "", "e" * 400]


@pytest.mark.parametrize("broadcast", [True, False])
def test_scores_equal_brute_force_either_way(spark, broadcast):
    scores = replace(_fit(spark, TEXTS), broadcast_pairs=broadcast)
    look = _brute(TEXTS)
    cases = {1: ("th", "en"), 2: ("", "he"), 3: ("zz", "qq"), 4: ("a", ""), 5: ("e", "e" * 90)}
    rows = spark.createDataFrame([(i, 0, *c) for i, c in cases.items()], REQUEST)
    coded = requests.loglik_requests(rows, BYTES, 64)
    got = {r.item_id: r.score for r in scoring.loglik_scores(coded, scores, ["item_id"]).collect()}
    for i, (context, continuation) in cases.items():
        # the continuation is scored whole; beside one of 90 tokens a block of 64 leaves no context
        tokens = list(("" if i == 5 else context).encode() + continuation.encode())
        padded = [E, *tokens]
        want = sum(look(padded[j], padded[j + 1]) for j in range(len(tokens) - len(continuation), len(tokens)))
        assert got[i] == pytest.approx(want, abs=1e-4), i
    assert got[4] == 0.0


def test_first_of_equal_choices_and_strictly_better_option(spark):
    scored = spark.createDataFrame(
        [(1, 0, 0, -1.0), (1, 1, 0, -1.0), (1, 2, 0, -2.0), (2, 0, 1, -3.0), (2, 1, 1, 0.0)],
        "item_id bigint, choice_idx int, label int, score double",
    )
    got = {r.item_id: (r.pred, r.hit) for r in picks.pick_choice(scored).collect()}
    assert got == {1: (0, 1), 2: (1, 1)}
    options = spark.createDataFrame(
        [(1, 0, "1", -1.0), (1, 1, "1", -1.0), (2, 0, "1", -0.5), (2, 1, "1", -0.6)],
        "item_id bigint, choice_idx int, answer string, score double",
    )
    assert {r.item_id: (r.pred, r.hit) for r in picks.pick_option(options).collect()} == {1: ("2", 0), 2: ("1", 1)}


def test_last_word_looks_at_its_first_token_only(spark):
    scores = _fit(spark, ["b a", "b a", "b c"])
    rows = spark.createDataFrame([(1, 0, "b", " zzz"), (2, 0, "x", " a"), (3, 0, "", " b"), (4, 0, "b", "")], REQUEST)
    got = {r.item_id: r.hit for r in picks.pick_last_word(rows, scores, BYTES).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_accuracy_of_nothing_is_zero(spark):
    none = spark.createDataFrame([], "item_id bigint, hit int")
    assert tuple(picks.accuracy(none, "t").first()) == ("t", 0, 0, 0.0)


def test_running_accuracy_over_segments(spark):
    rows = [("a", i, int(i % 3 == 0)) for i in range(700)] + [("b", i, 1) for i in range(55)]
    hits = spark.createDataFrame(rows, "task string, item_id bigint, hit int").repartition(6)
    got = {(r.task, r.n): r.acc for r in picks.running_accuracy(hits, 25, rows_per_segment=60).collect()}
    want = {("a", n): sum(i % 3 == 0 for i in range(n)) / n for n in range(25, 701, 25)}
    assert got == {**want, ("b", 25): 1.0, ("b", 50): 1.0}


def test_mask_contract_of_the_loss(spark):
    scores = _fit(spark, TEXTS)
    example = [("all", 0, list(b"the hat"), [1] * 7), ("none", 0, list(b"the hat"), [0] * 7)]
    rows = spark.createDataFrame(example, "id string, start bigint, tokens array<int>, loss_mask array<int>")
    targets = tensors.sft_targets(tensors.sft_tensors(rows, 16))
    got = {r.id: r.loss for r in scoring.masked_loss(targets, scores, ["id"]).collect()}
    look = _brute(TEXTS)
    unmasked = -sum(look(a, b) for a, b in zip(b"the hat", b"the hat"[1:])) / 6
    assert got["none"] is None and got["all"] == pytest.approx(unmasked, abs=1e-5)


def test_validation_loss_is_a_mean_of_batch_means(spark):
    scores = _fit(spark, TEXTS)
    look = _brute(TEXTS)
    blocks = [(0, list(b"ab")), (1, list(b"th")), (2, list(b"ee")), (3, list(b"zz"))]
    rows = spark.createDataFrame([(i, b, b) for i, b in blocks], "block_id bigint, x array<int>, y array<int>")
    row = scoring.val_loss(rows, scores, batch_size=3).first()
    each = [[-look(t, t) for t in b] for _, b in blocks]
    first, second = sum(each[:3], []), each[3]
    assert row.mean_of_means == pytest.approx((sum(first) / 6 + sum(second) / 2) / 2, abs=1e-5)
    assert row.token_mean == pytest.approx(sum(first + second) / 8, abs=1e-5)
    assert row.perplexity == pytest.approx(math.exp(row.token_mean))
    only = scoring.val_loss(rows, scores, batch_size=3, eval_iters=1).first()
    assert only.mean_of_means == pytest.approx(sum(first) / 6, abs=1e-5)
    assert only.token_mean == row.token_mean and only.perplexity == row.perplexity


def test_windows_account_for_every_trainable_token(spark):
    long = [("a", 0, list(range(1, 24)), [i % 2 for i in range(23)]), ("b", 0, [5], [1]), ("c", 0, [7, 8, 9, 10, 11], [1] * 5)]
    rows = spark.createDataFrame(long, "id string, start bigint, tokens array<int>, loss_mask array<int>")
    for align, shift in (("input", 0), ("target", 1)):
        windows = tensors.sft_targets(tensors.sft_tensors(rows, 4, align, "windows")).collect()
        count = {i: sum(w.n_targets for w in windows if w.id == i) for i in "abc"}
        assert count == {i: sum(m[shift : len(t) - 1 + shift]) for i, _, t, m in long}
        seen = sorted((w.start, [t for t in w.x if t]) for w in windows if w.id == "a")
        assert sum((x for _, x in seen), []) == long[0][2][:-1]


def test_limits_count_valid_items(spark):
    clozes = [(1, "no blank", "a", "b", "1"), (2, "one _ here", "a", "b", "1"), (3, "x _ y", "a", "b", "2"), (4, "z _", "a", "b", "2")]
    rows = spark.createDataFrame(clozes, "item_id bigint, sentence string, option1 string, option2 string, answer string")
    assert {r.item_id for r in requests.cloze_requests(rows, limit=2).collect()} == {2, 3}
    choices = spark.createDataFrame([(1, "c", []), (2, "c", ["x"]), (3, "c", ["y"])], "item_id bigint, ctx string, endings array<string>")
    assert {r.item_id for r in requests.choice_requests(choices, limit=1).collect()} == {2}


def test_last_word_context_keeps_room_for_one_token(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4],)], "t array<int>")
    assert rows.select(requests.last_word_context(F.col("t"), 3)).first()[0] == [3, 4]


def _candidates(spark, counts, **options):
    rows = spark.createDataFrame([(0, i, n - 1) for i, n in enumerate(counts)], "prev int, next int, n bigint")
    options.setdefault("vocabulary", len(counts))
    return {r.next: r.p for r in scoring.nucleus_candidates(rows, **options).collect()}


def test_nucleus_and_ties(spark):
    got = _candidates(spark, [10, 6, 3, 1], top_k=50, top_p=0.9)
    assert got == pytest.approx({0: 10 / 19, 1: 6 / 19, 2: 3 / 19})
    assert set(_candidates(spark, [5, 4, 4, 1], top_k=2, top_p=1.0)) == {0, 1, 2}
    hot = _candidates(spark, [9, 1], top_k=2, top_p=1.0, temperature=0.5)
    assert hot == pytest.approx({0: 81 / 82, 1: 1 / 82})


def test_unseen_tokens_tie_at_the_border(spark):
    rows = spark.createDataFrame([(0, 5, 7), (0, 6, 1)], "prev int, next int, n bigint")
    got = {r.next: (r.n_tokens, r.p) for r in scoring.nucleus_candidates(rows, 3, 1.0, vocabulary=10).collect()}
    assert got == {5: (1, 8 / 18), 6: (1, 2 / 18), None: (8, 1 / 18)}
    cut = {r.next: (r.n_tokens, r.p) for r in scoring.nucleus_candidates(rows, 3, 0.75, vocabulary=10).collect()}
    assert cut == {5: (1, 8 / 14), 6: (1, 2 / 14), None: (4, 1 / 14)}
    assert None not in {r.next for r in scoring.nucleus_candidates(rows, 2, 1.0, vocabulary=10).collect()}


def test_best_next_token_takes_the_smallest_among_equals(spark):
    scores = _fit(spark, ["ab", "ac", "ad", "ad", "ac"])
    assert {r.prev: r.next for r in scoring.next_token(scores).collect()}[ord("a")] == ord("c")


def test_model_of_the_tables_sums_to_its_tokens(spark, tiny):
    docs = readers.documents(spark, tiny)
    total = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    assert scoring.bigram_counts(docs, BYTES).agg(F.sum("n")).first()[0] == total


def test_loss_of_examples_needs_no_tensors(spark):
    import random

    rng = random.Random(4)
    rows = []
    for i in range(60):
        n = rng.choice([0, 1, 2, 5, 33])
        rows.append((i, 0, [rng.randrange(6) for _ in range(n)], [rng.randrange(2) for _ in range(n)]))
    examples = spark.createDataFrame(rows, "id bigint, start bigint, tokens array<int>, loss_mask array<int>")
    pairs = spark.createDataFrame([(p, n, 3, -1000 * (p + n)) for p in range(5) for n in range(4)], "prev int, next int, n bigint, logprob_micro bigint")
    floors = spark.createDataFrame([(p, -7_000_000) for p in range(5)], "prev int, floor_micro bigint")
    scores = scoring.ScoreTable.of_table(pairs, floors, -9_000_000)
    windows = tensors.sft_targets(tensors.sft_tensors(examples, 8, overflow="windows"))
    want = {r.id: r.loss for r in scoring.masked_loss(windows, scores, ["id"]).collect()}
    assert {r.id: r.loss for r in scoring.masked_loss_of_examples(examples, scores, ["id"]).collect()} == want


def test_byte_pairs_are_counted_without_a_row_for_each_byte(spark):
    texts = ["abab", None, "", "é€", "b", "", "ab" * 700_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    counts = scoring.bigram_counts(docs, BYTES)
    want = Counter()
    for text in texts:
        if text is not None:
            stream = [C.END_OF_TEXT, *text.encode(), C.END_OF_TEXT]
            want.update(zip(stream, stream[1:]))
    assert {(r["prev"], r["next"]): r["n"] for r in counts.collect()} == want
    assert dict(counts.dtypes)["prev"] == "int"
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()

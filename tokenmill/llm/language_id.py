"""Language identification: averaged hashed subword embeddings under a linear softmax, trained here."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.common import map_texts
from tokenmill.session import cut_lineage

GRAMS = (2, 3, 4)
#: Characters of a text that are looked at at once.
PORTION = 1 << 20
#: Odd multipliers of a gram's places; any would do, but a model belongs to its own.
PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@dataclass(frozen=True)
class Training:
    """Bounds and rates of training. The sample is bounded; everything is learned from it.

    ``max_documents`` rows, or one of each language where there are more; of a text longer than
    ``max_chars`` one stretch of that length, at a hashed place.
    """

    max_documents: int = 3000
    max_chars: int = 30_000
    stretch: int = 400
    stretches: int = 4
    bucket_bits: int = 15
    width: int = 16
    epochs: int = 4
    rate: float = 2.0
    accepted: float = 0.995
    seed: int = 11


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language: embedding times output weights
    bias: np.ndarray
    temperature: float
    threshold: float


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_buckets(text: str, letters: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of all 2-, 3- and 4-grams inside words; a word's edges count as one sign. Empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    points = np.where(letters[points], points, np.uint32(0))
    points = np.concatenate(([np.uint32(0)], points, [np.uint32(0)]))
    points = points[(points != 0) | np.concatenate(([True], points[:-1] != 0))]
    if len(points) < 2:
        return np.empty(0, np.int64)
    edge, found = points == 0, []
    for n in GRAMS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        code = np.full(size, n, np.uint32)
        inner = np.zeros(size, bool)
        for k in range(n):
            code += points[k : k + size] * PLACES[k]
            if 0 < k < n - 1:
                inner |= edge[k : k + size]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        found.append((code >> np.uint32(32 - bits))[~inner])
    return np.concatenate(found).astype(np.int64)


def logits_of(portions: Iterable[np.ndarray], scores: np.ndarray, bias: np.ndarray) -> np.ndarray | None:
    """Mean score of all buckets of a text's portions; None without any."""
    total, n = np.zeros(scores.shape[1]), 0
    for buckets in portions:
        n += len(buckets)
        for at in range(0, len(buckets), 1 << 16):
            total += scores[buckets[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
    return total / n + bias if n else None


def portions(text: str, letters: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """``gram_buckets`` of a whole text, a long one cut between words; a word longer than a portion is cut with an overlap."""
    at, longest = 0, max(GRAMS)
    while at < len(text):
        end = min(at + PORTION, len(text))
        if end < len(text):
            cut = next((k for k in range(end, max(at, end - PORTION // 2), -1) if not text[k - 1].isalpha()), None)
            yield gram_buckets(text[at : cut or end], letters, bits)
            at = cut or end - longest + 1
        else:
            yield gram_buckets(text[at:end], letters, bits)
            return


def softmax(values: np.ndarray) -> np.ndarray:
    powers = np.exp(values - values.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]], how: Training = Training()) -> Model:
    """Model from (text, language) in a fixed order: four fifths train it, each fifth row calibrates it."""
    letters, random = letter_table(), np.random.default_rng(how.seed)
    languages = sorted({language for _, language in rows})
    number = {language: i for i, language in enumerate(languages)}
    bags, tuning = [], []
    for i, (text, language) in enumerate(rows):
        if i % 5 == 4:
            tuning.append((text, number[language]))
            continue
        starts = random.integers(0, max(1, len(text) - how.stretch + 1), how.stretches) if len(text) > how.stretch else [0]
        for start in starts:
            buckets = gram_buckets(text[start : start + how.stretch], letters, how.bucket_bits)
            if len(buckets):
                unique, counts = np.unique(buckets, return_counts=True)
                bags.append((unique, (counts / counts.sum()).astype(np.float32), number[language]))
    embedding = random.normal(0, 0.1, (1 << how.bucket_bits, how.width)).astype(np.float32)
    output = np.zeros((how.width, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = how.epochs * len(bags), 0
    for _ in range(how.epochs):
        for k in random.permutation(len(bags)):
            unique, shares, label = bags[k]
            rate = np.float32(how.rate * (1 - done / steps))
            hidden = shares @ embedding[unique]
            error = softmax(hidden @ output + bias)
            error[label] -= 1
            # shares are about 1 / n: the root keeps long and short bags alike
            embedding[unique] -= (rate * np.sqrt(shares))[:, None] * (output @ error)
            output -= rate * np.outer(hidden, error)
            bias -= np.float32(0.1) * rate * error
            done += 1
    scores = embedding @ output
    values, truth = [], []
    for text, label in tuning:
        logits = logits_of(portions(text, letters, how.bucket_bits), scores, bias)
        if logits is not None:
            values.append(logits)
            truth.append(label)
    temperature, threshold = 1.0, 0.0
    if values:
        values, truth = np.array(values), np.array(truth)
        at = np.arange(len(truth))
        loss = {t: -np.log(softmax(values / t)[at, truth] + 1e-12).mean() for t in np.geomspace(0.1, 20, 60)}
        temperature = float(min(loss, key=loss.get))
        shares = softmax(values / temperature)
        right = shares.argmax(axis=1) == truth
        if right.any():
            threshold = float(np.quantile(shares.max(axis=1)[right], 1 - how.accepted))
    return Model(languages, scores, bias, temperature, threshold)


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(
    docs: DataFrame, how: Training, id_col: str, text_col: str, lang_col: str
) -> list[tuple[str, str]]:
    """At most ``max_documents`` labelled rows outside the held-out part, as many of each language as there are, up to its share.

    Which ones is told by a hash of id and text: a hashed draw thins the rows to about that share, ranks within a
    language cut it exactly, however often one row is repeated.
    """
    fit_for = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    fit_for = fit_for.where(F.length(text_col) > 0).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    counts = cut_lineage(fit_for.groupBy("lang").agg(F.count("*").alias("n")))
    languages = counts.count()
    if not languages:
        return []
    quota = max(1, how.max_documents // languages)
    chance = F.least(F.lit(1.0), F.lit(quota + 4 * quota**0.5) / F.col("n"))
    draw = F.pmod(F.xxhash64("i", "text"), F.lit(1 << 40))
    drawn = fit_for.withColumn("draw", draw).join(counts, "lang").where(F.col("draw") < chance * float(1 << 40))
    spare = F.greatest(F.length("text") - how.max_chars, F.lit(0))
    place = (1 + F.pmod(F.xxhash64("text"), spare.cast("bigint") + 1)).cast("int")
    drawn = drawn.select("lang", "draw", "i", F.substring("text", place, F.lit(how.max_chars)).alias("text"))
    order = Window.partitionBy("lang").orderBy("draw", "i", "text")
    rows = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= quota).collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["draw"], r["i"], r["lang"]))]


def identify(
    docs: DataFrame,
    how: Training = Training(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(``id_col``, held_out, lang_pred, score, rejected) for every row.

    The model is fitted on the driver from ``training_rows``: the one bounded sample, and with it the
    memory of training. Held-out rows (crc32 of the id as text, modulo 4, is 2) are never
    learned from; language, source and id are no inputs of a prediction. Each whole text is
    scored in tasks, a long one in portions. ``score`` is the calibrated probability of the predicted language (a
    temperature fitted on training rows that the weights have not seen); ``rejected`` marks a score under
    the one that all but 0.5 % of right predictions among those rows reach.

    A null text or one without a letter is ``und`` with score 0, rejected; so is every text where
    there is nothing to learn from. Null ids are not learned from and not held out. Repeated rows
    stay; other columns are not read.
    """
    rows = training_rows(docs, how, id_col, text_col, lang_col)
    # plain values, so workers need not have this package to read them
    made = fit(rows, how) if rows else None
    plain = (made.languages, made.scores, made.bias, made.temperature, made.threshold) if made else None
    model = docs.sparkSession.sparkContext.broadcast((letter_table(), plain))
    bits = how.bucket_bits

    def setup():
        letters, known = model.value

        def predict(text: str) -> tuple:
            logits = logits_of(portions(text, letters, bits), known[1], known[2]) if known else None
            if logits is None:
                return "und", 0.0, True
            languages, _, _, temperature, threshold = known
            shares = softmax(logits / temperature)
            best = int(shares.argmax())
            score = min(1.0, float(shares[best]))
            return languages[best], score, score < threshold

        return predict

    found = map_texts(docs, id_col, text_col, "lang_pred string, score double, rejected boolean", setup)
    return found.withColumn("held_out", held_out(F.col(id_col))).select(id_col, "held_out", "lang_pred", "score", "rejected")

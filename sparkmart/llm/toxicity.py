"""Toxic passages and documents.

Method: maximum-scoring segment search. Words score by their log-odds with Dirichlet priors; a linear-time scan finds
every maximal passage; an extreme-value law tells the significant ones and a document's score adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks, releasing, run_sums, split_words
from sparkmart.llm.langid import held_out
from sparkmart.session import durable

TRIM = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalpha())
PREFIXES = (6, 5, 4)
PRIOR = 1.0  # documents that the prior of a feature counts for
MIN_G = 20.0  # likelihood-ratio statistic from which a feature counts
SCORED_BYTES = 2 << 20  # texts that a worker scores at once: words and scores take several times their bytes


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    codes, words, offsets = split_words(texts)
    return codes, pc.utf8_trim(pc.utf8_lower(words), characters=TRIM), offsets


def count_features(sample: DataFrame) -> DataFrame:
    """Documents of each class that hold a feature, over sampled (text, toxic): feature, toxic_n, clean_n.

    A feature is a word, or a prefix written with ``*``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                codes, words, offsets = _words(texts)
                toxic = rows.column(1).to_numpy(zero_copy_only=False) == 1
                doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
                size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
                for width in (None, *PREFIXES):
                    names = words
                    if width:
                        cut = pc.utf8_slice_codeunits(words, 0, width)
                        names = pc.binary_join_element_wise(cut, pa.scalar("*", cut.type), pa.scalar("", cut.type))
                    named = names.dictionary_encode()
                    of = named.indices.to_numpy(zero_copy_only=False)[codes].astype(np.int64)
                    use = size[codes] > (width or 0)
                    pair = np.unique(doc[use] * len(named.dictionary) + of[use])
                    at, name = np.divmod(pair, max(len(named.dictionary), 1))
                    ones = np.bincount(name[toxic[at]], minlength=len(named.dictionary))
                    zeros = np.bincount(name[~toxic[at]], minlength=len(named.dictionary))
                    keep = ones + zeros > 0
                    yield pa.RecordBatch.from_arrays(
                        [named.dictionary.filter(pa.array(keep)).cast(pa.string()), pa.array(ones[keep]), pa.array(zeros[keep])],
                        names=["feature", "toxic_n", "clean_n"],
                    )

    parts = sample.select("text", "toxic").mapInArrow(releasing(run), "feature string, toxic_n long, clean_n long")
    return parts.groupBy("feature").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n"))


@dataclass
class Scorer:
    """Scores of features, of all other words, the law's parameters, and the line from evidence to log-odds."""

    features: list[str]
    scores: np.ndarray
    other: float
    decay: float = 1.0
    rate: float = 0.1
    slope: float = 1.0
    base: float = 0.0


def learn_scores(counts: pd.DataFrame, toxic_words: int, clean_words: int) -> Scorer:
    """Log-odds with an informative Dirichlet prior: a feature starts from ``PRIOR`` documents shared out as all words are.

    Features that the likelihood-ratio test does not tell from chance score as ordinary words. Words that clean text uses too
    are kept as ordinary words where a prefix of theirs is a feature.
    """
    y1, y0 = counts["toxic_n"].to_numpy(float), counts["clean_n"].to_numpy(float)
    share = toxic_words / (toxic_words + clean_words)
    p1 = np.minimum((y1 + PRIOR * share) / (toxic_words + PRIOR), 0.9)
    p0 = np.minimum((y0 + PRIOR * (1 - share)) / (clean_words + PRIOR), 0.9)
    odds = np.log(p1 / (1 - p1)) - np.log(p0 / (1 - p0))
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(y1 > 0, y1 * np.log(y1 / ((y1 + y0) * share)), 0) + np.where(y0 > 0, y0 * np.log(y0 / ((y1 + y0) * (1 - share))), 0)
    good = (2 * g >= MIN_G) & (y1 >= 3) & (odds > 1.0)
    names = counts["feature"].to_numpy(object)
    prefixes = {n for n in names[good] if n.endswith("*")}
    words = np.array([not n.endswith("*") for n in names], bool)
    share1 = min(0.5, y1[good & words].sum() / max(toxic_words, 1))
    other = min(np.log1p(-share1), -0.01)
    exempt = words & ~good & (y0 > 0) & np.array([any(n[:k] + "*" in prefixes for k in PREFIXES if len(n) > k) for n in names], bool)
    keep = good | exempt
    scores = np.where(good, odds, other)[keep]
    # decay: the positive root of E[exp(decay * score)] = 1 over clean text
    mass = np.append(np.where(good & words, p0, 0)[keep], 0.0)
    mass[-1] = 1 - mass.sum()
    value, low, high = np.append(scores, other), 1e-3, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if (mass * np.exp(np.minimum(mid * value, 700))).sum() > 1 else (mid, high)
    return Scorer(names[keep].tolist(), scores, float(other), float(low))


def word_scores(words: pa.Array, scorer: Scorer) -> np.ndarray:
    """The word's own score, else that of its longest prefix that has one, else that of ordinary words."""
    table = pa.array(scorer.features, words.type)
    found = pc.fill_null(pc.index_in(words, value_set=table), -1).to_numpy(zero_copy_only=False)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for width in PREFIXES:
        cut = pc.utf8_slice_codeunits(words, 0, width)
        names = pc.binary_join_element_wise(cut, pa.scalar("*", cut.type), pa.scalar("", cut.type))
        at = pc.fill_null(pc.index_in(names, value_set=table), -1).to_numpy(zero_copy_only=False)
        found = np.where((found < 0) & (size > width), at, found)
    return np.append(scorer.scores, scorer.other)[found]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score) of one sequence, left to right, in linear time.

    The disjoint segments found by taking the best one first and going on in what is left of and right of it.
    Only words of positive score open or extend a candidate, so the loop runs over those.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    held: list[tuple[int, int, float, float]] = []  # start, stop, sum before, sum after
    for k in np.flatnonzero(scores > 0).tolist():
        start, before, after = k, float(total[k]), float(total[k + 1])
        stop = k + 1
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= before:
                j -= 1
            if j < 0 or held[j][3] >= after:
                held.append((start, stop, before, after))
                break
            start, before = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, r - l) for a, b, l, r in held]


def passages(texts: pa.Array, scorer: Scorer) -> tuple[list[list[tuple[int, int, float]]], np.ndarray]:
    """Maximal segments of each whole text, and its number of words."""
    codes, words, offsets = _words(texts)
    scores = word_scores(words, scorer)[codes]
    count = np.diff(offsets)
    hot = run_sums(scores > 0, offsets) > 0
    return [
        maximal_segments(scores[offsets[k] : offsets[k + 1]]) if hot[k] else [] for k in range(len(count))
    ], count


def evidence(segments: list[tuple[int, int, float]], words: int, scorer: Scorer) -> float:
    """Sum of a text's segments in units of the law, less what chance gives in so many words.

    A segment of score s is expected rate * words * exp(-decay * s) times in clean text of that length; those expected
    once or more are noise. Without a significant segment: 0.
    """
    limit = np.log(scorer.rate * max(words, 1))
    found = [scorer.decay * s - limit for _, _, s in segments if scorer.decay * s > limit]
    return float(sum(found)) if found else 0.0


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> Scorer | None:
    """Learn from at most ``bound`` labelled documents that are not held out, drawn by a hash of their ids.

    Three quarters give the word counts, the rest the law's rate and the line from evidence to
    log-odds, so no document is scored by its own words. A document with several labels counts as toxic if one says so; of
    several texts under one id the one with the smallest hash is used, so an id that many rows share is one document. None
    if either class is missing.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if not total:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000))
    likely = known.withColumn("draw", draw).filter(F.col("draw") < int(1_000_000 * min(1.0, 1.2 * bound / total)) + 1)
    drawn = durable(likely.orderBy("draw", "doc_id").limit(bound).select("doc_id", "toxic"), "toxic-draw")
    text = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # at most ``bound`` ids
    sample = durable(sample.groupBy("doc_id", "toxic").agg(text), "toxic-sample")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(4)) == 0
    counts = durable(count_features(sample.filter(~fold)), "toxic-features")
    words = ~F.col("feature").endswith("*")
    sums = counts.agg(F.sum(F.when(words, F.col("toxic_n"))), F.sum(F.when(words, F.col("clean_n")))).first()
    if not sums[0] or not sums[1]:
        return None
    # the test of ``learn_scores``, a hair wider, decides here too, so only what it keeps leaves the executors
    telling = (F.col("toxic_n") >= 3) & (2 * _ratio(int(sums[0]) / (int(sums[0]) + int(sums[1]))) >= MIN_G - 1e-6)
    table = counts.filter(telling).orderBy("feature").toPandas()
    scorer = learn_scores(table, int(sums[0]), int(sums[1]))
    stems = sorted({f[:-1] for f in scorer.features if f.endswith("*")})
    if stems:
        match = F.lit(False)
        for k in PREFIXES:
            some = [s for s in stems if len(s) == k]
            if some:
                match |= F.substring("feature", 1, k).isin(some)
        also = counts.filter(~telling & words & (F.col("clean_n") > 0) & match).orderBy("feature").toPandas()
        scorer = learn_scores(pd.concat([table, also], ignore_index=True), int(sums[0]), int(sums[1]))
    return calibrate(scorer, sample.filter(fold))


def _ratio(share: float) -> Column:
    """Half the likelihood-ratio statistic of a feature's counts, where toxic text holds ``share`` of all words."""

    def part(n: str, p: float) -> Column:
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / ((F.col("toxic_n") + F.col("clean_n")) * p))).otherwise(0.0)

    return part("toxic_n", share) + part("clean_n", 1 - share)


def calibrate(scorer: Scorer, sample: DataFrame) -> Scorer:
    """Set the law's rate from clean documents, then fit the line from evidence to log-odds."""
    shared = sample.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                segments, words = passages(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(1).cast(pa.int32()),
                        pa.array(words),
                        pa.array([[s for _, _, s in one] for one in segments], pa.list_(pa.float64())),
                    ],
                    names=["toxic", "words", "scores"],
                )

    rows = sample.select("text", "toxic").mapInArrow(releasing(run), "toxic int, words long, scores array<double>").toPandas()
    if not len(rows):
        return scorer
    clean = rows[rows["toxic"] != 1]
    # rate: segments of clean text weigh exp(decay * s) / decay-free expectation per word; one in all as the least
    seen = [s for x in clean["scores"] for s in x]
    high = np.quantile(seen, 0.5) if seen else 0.0
    above = sum(s >= high for s in seen)
    scorer.rate = float(max(above, 1) / max(clean["words"].sum(), 1) * np.exp(min(scorer.decay * high, 50)))
    x = np.array([min(evidence([(0, 0, s) for s in x], w, scorer), 60.0) for x, w in zip(rows["scores"], rows["words"])])
    y = (rows["toxic"] == 1).to_numpy(float)
    slope, base = 0.0, 0.0
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(base + slope * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([(y - p).sum() - 1e-2 * base, ((y - p) * x).sum() - 1e-2 * slope])
        h = np.array([[w.sum() + 1e-2, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        base, slope = base + float(np.clip(step[0], -2, 2)), slope + float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    scorer.slope, scorer.base = max(slope, 1e-3), base
    return scorer


def small_chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch that is scored."""
    return chunks(batch, "text", SCORED_BYTES)


def score_documents(docs: DataFrame, scorer: Scorer | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, passages (start word, words, score) of every row.

    Only the text is looked at, the whole of it. NULL or empty text, and every text if there is no model,
    has no passage and gets the score of no evidence (0 without a model). Rows are scored one by one, NULL ids and repeated rows
    included; other columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, texts in small_chunks(batch):
                score = np.zeros(len(texts))
                found: list = [[] for _ in range(len(texts))]
                if model is not None:
                    segments, words = passages(texts, model)
                    x = np.array([min(evidence(s, w, model), 60.0) for s, w in zip(segments, words.tolist())])
                    score = 1 / (1 + np.exp(-np.clip(model.base + model.slope * x, -30, 30)))
                    found = [
                        [{"start": a, "words": b - a, "score": s} for a, b, s in one if evidence([(a, b, s)], w, model) > 0]
                        for one, w in zip(segments, words.tolist())
                    ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(score), pa.array(found, kind)], names=["doc_id", "score", "passages"]
                )

    out = docs.select("doc_id", "text").mapInArrow(
        releasing(run), "doc_id long, score double, passages array<struct<start:long,words:long,score:double>>"
    )
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return out.select("doc_id", held_out().alias("held_out"), "score", predicted, "passages")


def keep_clean(docs: DataFrame, scorer: Scorer | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, whose text scores below ``threshold``; NULL text is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if model is None:
                yield batch
                continue
            for rows, texts in small_chunks(batch):
                segments, words = passages(texts, model)
                x = np.array([min(evidence(s, w, model), 60.0) for s, w in zip(segments, words.tolist())])
                yield rows.filter(pa.array(1 / (1 + np.exp(-np.clip(model.base + model.slope * x, -30, 30))) < threshold))

    return docs.mapInArrow(releasing(run), docs.schema)

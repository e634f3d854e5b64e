"""Language identification.

Method: linear-chain conditional random field. Affix, n-gram and lexicon features with learned transitions label the
words of code-switched text by forward-backward; a document's language is the one with most of its words' probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks, run_sums, split_words

BINS = 1 << 17
CHAIN = 128  # words of one chain; a longer text is several chains


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features, offsets) of words: the word itself, prefixes and suffixes of 1 to 3, bigrams and trigrams."""
    marked = pc.binary_join_element_wise(pa.scalar("^", pa.large_string()), words, pa.scalar("$", pa.large_string()), pa.scalar("", pa.large_string()))
    points = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    n, total = len(lengths), len(points)
    with np.errstate(over="ignore"):
        spread = lambda h, salt: ((h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(47)).astype(np.int64) & (BINS - 1)
        padded = np.concatenate((points, np.zeros(4, np.uint64)))
        gram = [points]
        for k in range(1, 4):
            gram.append(gram[-1] * np.uint64(0x100000001B3) + padded[k : k + total])
        mixed = (points + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
        place = np.arange(total, dtype=np.uint64) - np.repeat(starts, lengths).astype(np.uint64)
        lexicon = np.add.reduceat(mixed * (place * np.uint64(2) + np.uint64(1)), starts)
    word = np.repeat(np.arange(n), lengths)
    left = np.repeat(ends, lengths) - np.arange(total)
    ids, of = [spread(lexicon, 1)], [np.arange(n)]
    for k in (2, 3, 4):  # affixes, the border mark included
        fit = lengths >= k
        ids += [spread(gram[k - 1][starts[fit]], 10 + k), spread(gram[k - 1][ends[fit] - k], 20 + k)]
        of += [np.flatnonzero(fit)] * 2
    for k in (2, 3):
        fit = left >= k
        ids.append(spread(gram[k - 1][fit], 30 + k))
        of.append(word[fit])
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ids[order], np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n))))


def emissions(features: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's features, over the root of their number."""
    if len(offsets) == 1:
        return np.zeros((0, weights.shape[1]), np.float32)
    total = np.add.reduceat(weights[features], offsets[:-1], axis=0)
    return total / np.sqrt(np.diff(offsets))[:, None]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (chain, word, label) and expected transitions of padded chains.

    All chains advance together; messages are normalised at every word.
    """
    chains, steps, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves)
    ahead, back = np.empty_like(local), np.ones_like(local)
    ahead[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        now = (ahead[:, t - 1] @ step) * local[:, t]
        ahead[:, t] = now / now.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        now = (local[:, t + 1] * back[:, t + 1]) @ step.T
        now /= now.sum(axis=1, keepdims=True)
        back[:, t] = np.where((t + 1 < lengths)[:, None], now, 1.0)
    post = ahead * back
    post /= post.sum(axis=2, keepdims=True)
    pairs = np.zeros((labels, labels))
    for t in range(1, steps):
        both = ahead[:, t - 1, :, None] * step[None] * (local[:, t] * back[:, t])[:, None, :]
        both /= both.sum(axis=(1, 2), keepdims=True)
        pairs += both[t < lengths].sum(axis=0)
    return post, pairs


@dataclass
class Field:
    """A trained model: labels, feature weights, transition scores."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray


def train(texts: list[str], langs: list[str], epochs: int = 3, seed: int = 7, window: int = CHAIN, batch: int = 64) -> Field:
    """Fit by stochastic gradient (AdaGrad) on chains cut from a bounded sample of labelled texts.

    Every word of a text carries the text's label. Half of the chains are spliced from two texts, so that the
    transitions are learned from text that switches language.
    """
    labels = sorted(set(langs))
    number = {x: k for k, x in enumerate(labels)}
    rng = np.random.default_rng(seed)
    column = pc.utf8_lower(pa.array(texts, pa.large_string()))
    codes, words, offsets = split_words(column)
    features, starts = word_features(words)
    full = np.flatnonzero(np.diff(offsets) > 0)
    label = np.array([number[x] for x in langs], np.int64)
    weights = np.zeros((BINS, len(labels)), np.float32)
    moves = np.zeros((len(labels), len(labels)))
    seen, seen_moves = np.full_like(weights, 1e-2), np.full_like(moves, 1.0)

    def cut(doc: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = offsets[doc], offsets[doc + 1]
        a = rng.integers(a, max(a + 1, b - size + 1))
        got = codes[a : min(b, a + size)]
        return got, np.full(len(got), label[doc])

    for _ in range(epochs):
        order = rng.permutation(full)
        for at in range(0, len(order), batch):
            chains = []
            for doc in order[at : at + batch]:
                if rng.random() < 0.5:
                    first = int(rng.integers(1, window))
                    parts = [cut(doc, first), cut(full[rng.integers(len(full))], window - first)]
                    chains.append(tuple(np.concatenate(x) for x in zip(*parts)))
                else:
                    chains.append(cut(doc, window))
            size = np.array([len(c[0]) for c in chains])
            steps = size.max()
            word = np.concatenate([c[0] for c in chains])
            truth = np.concatenate([c[1] for c in chains])
            at_row = np.repeat(np.arange(len(size)), size)
            at_step = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
            used, inverse = np.unique(word, return_inverse=True)
            counts = starts[used + 1] - starts[used]
            bounds = np.concatenate(([0], np.cumsum(counts)))
            feats = features[np.repeat(starts[used] - bounds[:-1], counts) + np.arange(bounds[-1])]
            scores = np.zeros((len(size), steps, len(labels)))
            scores[at_row, at_step] = emissions(feats, bounds, weights)[inverse]
            post, pairs = forward_backward(scores, size, moves)
            gap = -post[at_row, at_step]
            gap[np.arange(len(truth)), truth] += 1
            by_word = np.stack([np.bincount(inverse, gap[:, k], len(used)) for k in range(len(labels))], axis=1)
            by_word /= np.sqrt(counts)[:, None]
            grad = np.stack([np.bincount(feats, np.repeat(by_word[:, k], counts), BINS) for k in range(len(labels))], axis=1)
            hit = np.unique(feats)
            g = grad[hit] - 1e-3 * weights[hit]
            seen[hit] += g * g
            weights[hit] += 0.3 * g / np.sqrt(seen[hit])
            real = np.zeros_like(moves)
            follow = at_step > 0
            np.add.at(real, (truth[np.flatnonzero(follow) - 1], truth[follow]), 1)
            g = (real - pairs) - 1e-2 * moves
            seen_moves += g * g
            moves += 0.3 * g / np.sqrt(seen_moves)
    return Field(labels, weights, moves)


def label_words(field: Field, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of every word, whether it has a letter, offsets) of whole texts."""
    codes, words, offsets = split_words(pc.utf8_lower(texts))
    total = len(codes)
    letters = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
    table = np.zeros((len(words), len(field.labels)), np.float32)
    if letters.any():
        table[letters] = emissions(*word_features(words.filter(pa.array(letters))), field.weights)
    counts = np.diff(offsets)
    chains = -(-counts // CHAIN)
    of = np.repeat(np.arange(len(counts)), chains)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(chains) - chains, chains)
    first = offsets[of] + nth * CHAIN
    size = np.minimum(CHAIN, offsets[of + 1] - first)
    post = np.zeros((total, len(field.labels)))
    order = np.argsort(size, kind="stable")
    for at in range(0, len(order), 2048):  # chains of like length share a padded block
        part = order[at : at + 2048]
        steps = int(size[part].max())
        inside = np.arange(steps)[None, :] < size[part][:, None]
        place = np.minimum(first[part][:, None] + np.arange(steps)[None, :], total - 1)
        scores = np.where(inside[:, :, None], table[codes[place]], 0)
        got, _ = forward_backward_posterior(scores, size[part], field.moves)
        post[place[inside]] = got[inside]
    return post, letters[codes] if total else np.zeros(0, bool), offsets


def forward_backward_posterior(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, None]:
    """Posteriors only, with the words of all chains side by side in memory."""
    chains, steps, labels = scores.shape
    local = np.ascontiguousarray(np.exp(scores - scores.max(axis=2, keepdims=True)).transpose(1, 0, 2))
    step = np.exp(moves)
    ahead, back = np.empty_like(local), np.ones_like(local)
    ahead[0] = local[0]
    for t in range(1, steps):
        now = (ahead[t - 1] @ step) * local[t]
        ahead[t] = now / now.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        now = (local[t + 1] * back[t + 1]) @ step.T
        back[t] = np.where((t + 1 < lengths)[:, None], now / now.sum(axis=1, keepdims=True), 1.0)
    post = ahead * back
    return (post / post.sum(axis=2, keepdims=True)).transpose(1, 0, 2), None


def fit(docs: DataFrame, per_label: int = 600) -> Field | None:
    """A field trained on at most ``per_label`` documents of each language.

    Used are text and lang of rows whose id is not held out, drawn by a hash of id and text at a rate set per language from
    its number of different ones, so rare languages are not lost and an id that many rows share neither floods the draw nor
    falls out of it as a whole. Repeated rows count once. None if no row has a label and a word.
    """
    rows = docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    rows = rows.filter(~held_out()).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("__mark", F.xxhash64("doc_id", "text", F.lit(11)))
    different = rows.groupBy("lang").agg(F.approx_count_distinct("__mark", 0.02).alias("n"))
    counts = {r["lang"]: r["n"] for r in different.collect()}  # one row a language
    if not counts:
        return None
    rate = F
    for lang, n in sorted(counts.items()):
        rate = rate.when(F.col("lang") == lang, F.lit(int(1_000_000 * min(1.0, 1.2 * per_label / max(n, 1))) + 1))
    likely = rows.filter(F.pmod("__mark", F.lit(1_000_000)) < rate.otherwise(F.lit(0))).dropDuplicates(["lang", "__mark"])
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("__mark", F.lit(1_000_000)), "__mark"))
    drawn = likely.withColumn("__nth", nth).filter(F.col("__nth") <= per_label)
    sample = drawn.select("text", "lang", "doc_id").toPandas().sort_values(["doc_id", "text", "lang"])
    return train(sample["text"].tolist(), sample["lang"].tolist()) if len(sample) else None


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Only the text is looked at, the whole of it. ``score`` is the mean probability of the predicted language over the words that
    hold a letter. NULL text, text without letters, or no model: ``und`` with score 0. Ties go to the first language in
    alphabetical order. Rows are judged one by one, NULL ids and repeated rows included; other columns are
    ignored; an empty table gives no rows. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, texts in chunks(batch, "text", 4 << 20):
                n = len(texts)
                names, score = ["und"] * n, np.zeros(n)
                if model is not None:
                    post, letters, offsets = label_words(model, texts)
                    counted = run_sums(letters, offsets)
                    mass = np.stack([run_sums(np.where(letters, post[:, k], 0.0), offsets) for k in range(len(model.labels))], axis=1)
                    best = np.argmax(np.round(mass, 9), axis=1)
                    some = counted > 0
                    score = np.where(some, np.clip(mass[np.arange(n), best] / np.maximum(counted, 1), 0, 1), 0.0)
                    names = [model.labels[b] if s else "und" for b, s in zip(best, some)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
                )

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

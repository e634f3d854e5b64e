"""Alignment of the tokens of two tokenizers over the same bytes.

Method: token-byte incidence matrices in hand-built CSR. Gustavson row products A B' give the links of tokens that share
bytes; products of the token-group incidences give the links within groups.
"""

from __future__ import annotations

import gc
import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks, gather, run_sums, split_words
from sparkmart.llm.piece_rounds import SPACE, PieceIds
from sparkmart.llm.token_ids import _DOUBLE, TokenIds
from sparkmart.session import durable

HOT_PAIRS = 200_000  # pairs that are looked up in tasks; each has at least this part of all links
STORED_WORDS = 300_000
_SPLIT = "\x1f"  # marks the line ends at which texts are cut


@dataclass
class Csr:
    """A sparse matrix of counts by rows: entries of row i are at ptr[i]:ptr[i + 1]."""

    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray
    n_cols: int

    @classmethod
    def of_runs(cls, ends: np.ndarray, n_cols: int) -> Csr:
        """Row i holds a one in each column from the end of row i - 1 to ``ends[i]``: tokens over bytes."""
        return cls(np.concatenate(([0], ends)), np.arange(n_cols), np.ones(n_cols, np.int64), n_cols)

    @classmethod
    def of_places(cls, cols: np.ndarray, n_cols: int) -> Csr:
        """Row i holds a one in column ``cols[i]``: tokens over groups."""
        return cls(np.arange(len(cols) + 1), cols, np.ones(len(cols), np.int64), n_cols)

    def transpose(self) -> Csr:
        rows = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        order = np.argsort(self.col, kind="stable")
        ptr = np.concatenate(([0], np.cumsum(np.bincount(self.col, minlength=self.n_cols))))
        return Csr(ptr, rows[order], self.val[order], len(self.ptr) - 1)

    def times(self, other: Csr) -> Csr:
        """Product by Gustavson's rows: row i is the sum of the rows of ``other`` that row i names, times its entries."""
        counts = np.diff(other.ptr)[self.col]
        rows = np.repeat(np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr)), counts)
        key = rows * other.n_cols + gather(other.col, other.ptr[self.col], counts)
        val = np.repeat(self.val, counts) * gather(other.val, other.ptr[self.col], counts)
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, val = key[order], val[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key, val = key[first], np.add.reduceat(val, first) if len(first) else val
        ptr = np.concatenate(([0], np.cumsum(np.bincount(key // other.n_cols, minlength=len(self.ptr) - 1))))
        return Csr(ptr, key % other.n_cols, val, other.n_cols)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of every entry, by rows."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr)), self.col, self.val


def link_tokens(ends_a: np.ndarray, ends_b: np.ndarray, kind: str = "end") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, group of each a, group of each b) over the same bytes, given by the tokens' ends.

    Offsets at which tokens of both end close a group. Links of kind "overlap" are the tokens that share a byte, "end" those
    of them that end together, "group" all tokens of one group (as many as its tokens of a times those of b).
    """
    size = int(ends_a[-1]) if len(ends_a) else 0
    i, j, _ = Csr.of_runs(ends_a, size).times(Csr.of_runs(ends_b, size).transpose()).entries()
    shut = ends_a[i] == ends_b[j]
    common = ends_a[i[shut]]
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    if kind == "end":
        i, j = i[shut], j[shut]
    elif kind == "group":
        i, j, _ = Csr.of_places(group_a, len(common)).times(Csr.of_places(group_b, len(common)).transpose()).entries()
    elif kind != "overlap":
        raise ValueError(kind)
    return i, j, group_a, group_b


def _byte_spelling() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable bytes are themselves, the others numbered from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Bytes:
    """Bytes of every id of a vocabulary in one flat array."""

    def __init__(self, entries: list[bytes]):
        self.length = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.pool, self.start[ids], self.length[ids])


class Aligner:
    """Tokens, groups and links of whole texts. Texts are cut where neither tokenizer joins anything, and each distinct
    piece is aligned once and kept in a bounded store.

    Both cut before a space that follows no white space, and around a line end before a letter or a visible ASCII
    character. Texts with other runs of white space, or with U+2581, are aligned whole.
    """

    def __init__(self, path_a: str, path_b: str, kind: str = "end", limit: int = STORED_WORDS):
        self.a, self.b, self.kind, self.limit = TokenIds(path_a, spaces_matter=True, limit=1), PieceIds(path_b, limit=1), kind, limit
        spelled, tokenizer = _byte_spelling(), self.a.tokenizer
        vocabulary = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
        added = {i for i, t in tokenizer.get_added_tokens_decoder().items()}
        entries = [vocabulary.get(i, "") for i in range(max(vocabulary) + 1)]
        self.bytes_a = _Bytes([t.encode() if i in added else bytes(spelled[c] for c in t) for i, t in enumerate(entries)])
        model = self.b.model
        pieces = [model.id_to_piece(i) for i in range(len(model))]
        self.bytes_b = _Bytes([bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)])
        self.digits = np.array([str(i) for i in range(max(len(entries), len(pieces)))], dtype=object)
        self.at_lines = not any("\n" in p for p in pieces)
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.facts = np.zeros((0, 4), np.int64)  # tokens of a, of b, groups, whether the bytes agree
        self.keys, self.start, self.length = (np.zeros(0, np.int64) for _ in range(3))
        self.strings: list[str] = []

    def _align(self, ids_a: list, ids_b: list, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(facts, link keys, links of each text, groups as text with ; at the end) of texts and their ids."""
        raw = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b)]
        flat = [np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in zip((ids_a, ids_b), counts)]
        good = np.ones(len(raw), bool)
        for kind, ids, n in zip((self.bytes_a, self.bytes_b), flat, counts):
            own = run_sums(kind.length[ids], np.concatenate(([0], np.cumsum(n))))
            good &= own == sizes
            if good.all() and kind.joined(ids).tobytes() == b"".join(raw):
                continue
            at = np.concatenate(([0], np.cumsum(n)))
            for k in np.flatnonzero(good).tolist():
                good[k] = kind.joined(ids[at[k] : at[k + 1]]).tobytes() == raw[k]
        if not good.all():
            flat = [ids[np.repeat(good, n)] for ids, n in zip(flat, counts)]
            counts = [np.where(good, n, 0) for n in counts]
        ends = [np.cumsum(kind.length[ids]) for kind, ids in zip((self.bytes_a, self.bytes_b), flat)]
        i, j, group_a, group_b = link_tokens(*ends, self.kind)
        text_of = np.repeat(np.arange(len(raw)), counts[0])
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
        keys = flat[0][i] << 32 | flat[1][j]
        facts = np.stack([*counts, np.bincount(text_of[last_a], minlength=len(raw)), good.astype(np.int64)], axis=1)
        # groups as text: tokens of a, then of b, of one group after the other
        order = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
        mark = np.concatenate((np.where(last_a, "|", ","), np.where(last_b, ";", ","))).astype(object)
        parts = (np.concatenate((self.digits[flat[0]], self.digits[flat[1]])) + mark)[order].tolist() if len(order) else []
        at = np.concatenate(([0], np.cumsum(counts[0] + counts[1]))).tolist()
        return facts, keys, np.bincount(text_of[i], minlength=len(raw)), ["".join(parts[p:q]) for p, q in zip(at, at[1:])]

    def _pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Alignment of distinct pieces: words after a space, or after the line end that they begin with."""
        ends = [w[:1] == _SPLIT for w in words]
        lines = [w[1:] for w, e in zip(words, ends) if e]
        spaced = [w for w, e in zip(words, ends) if not e]
        both = []
        for plain, others in ((self.a._words(spaced, " "), self.a._encode(lines)), self._rounds(spaced, lines)):
            plain, others = iter(plain), iter(others)
            both.append([next(others) if e else next(plain) for e in ends])
        return self._align(*both, [w[1:] if e else " " + w for w, e in zip(words, ends)])

    def _rounds(self, spaced: list[str], lines: list[str]) -> tuple[list, list]:
        ids = self.b.rounds.encode([SPACE + w for w in spaced] + lines) if spaced or lines else []
        return ids[: len(spaced)], ids[len(spaced) :]

    def _slots(self, words: list[str]) -> np.ndarray:
        if len(self.slot) + len(words) > self.limit:
            self._clear()
        found = np.array([self.slot.get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            missing = [words[k] for k in new.tolist()]
            facts, keys, counts, strings = self._pieces(missing)
            first = len(self.facts)
            self.start = np.concatenate((self.start, len(self.keys) + np.cumsum(counts) - counts))
            self.length = np.concatenate((self.length, counts))
            self.keys, self.facts = np.concatenate((self.keys, keys)), np.concatenate((self.facts, facts))
            self.strings += strings
            self.slot.update(zip(missing, range(first, first + len(missing))))
            found[new] = np.arange(first, first + len(missing))
        return found

    def align(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
        """(facts by text, link keys, links of each text, lists of strings that join to each text's groups).

        Facts are tokens of a, tokens of b, groups. A text that is empty, or whose tokens' bytes are not a space and the
        text, has no tokens.
        """
        odd = pc.or_(pc.match_substring_regex(texts, _DOUBLE), pc.match_substring_regex(texts, f"^ | $|{SPACE}|{_SPLIT}")).to_numpy(False)
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(False)
        odd &= ~empty
        plain = pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts)
        if self.at_lines:
            plain = pc.replace_substring_regex(plain, r"\n([!-~\p{L}])", f" {_SPLIT}\n\\1")
        codes, words, offsets = split_words(plain, spaces_only=True)
        keep = np.repeat(~(odd | empty), np.diff(offsets))
        offsets, codes = np.concatenate(([0], np.cumsum(keep)))[offsets], codes[keep]
        used, place = np.unique(codes, return_inverse=True)
        slot = self._slots(pc.take(words, pa.array(used)).to_numpy(zero_copy_only=False).tolist())[place]
        facts = np.stack([run_sums(self.facts[slot, k], offsets) for k in range(4)], axis=1)
        counts = self.length[slot]
        links, keys = run_sums(counts, offsets), gather(self.keys, self.start[slot], counts)
        strings, at = self.strings, offsets.tolist()
        slot = slot.tolist()
        groups = [[strings[s] for s in slot[p:q]] for p, q in zip(at, at[1:])]
        whole = facts[:, 3] == np.diff(offsets)
        if odd.any():
            raw = texts.filter(pa.array(odd)).to_pylist()
            ids_b, ends = self.b.encode(pa.array(raw, pa.large_string()))
            own, own_keys, own_links, own_groups = self._align(
                self.a._encode([" " + t for t in raw]), [ids_b[p:q].tolist() for p, q in zip(ends, ends[1:])], [" " + t for t in raw]
            )
            parts = np.split(keys, np.cumsum(links)[:-1])
            rest = iter(np.split(own_keys, np.cumsum(own_links)[:-1]))
            facts[odd], links[odd] = own, own_links
            whole[odd] = own[:, 3] == 1
            for k, text in zip(np.flatnonzero(odd).tolist(), own_groups):
                parts[k], groups[k] = next(rest), [text]
            keys = np.concatenate(parts)
        if not whole.all():
            keys = keys[np.repeat(whole, links)]
            facts[~whole], links = 0, np.where(whole, links, 0)
            groups = [g if w else [] for g, w in zip(groups, whole)]
        return facts[:, :3], keys, links, groups


_LOADED: dict[tuple[str, str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str, kind: str) -> Aligner:
    """One for each Python worker."""
    key = (path_a, path_b, kind)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[key] = Aligner(path_a, path_b, kind)
    return _LOADED[key]


def align(docs: DataFrame, path_a: str, path_b: str, kind: str = "end", digest: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, pairs (array of a << 32 | b) and times of each distinct pair of ids.

    Tokenizer a is a byte-level one and gets a space and the text, b is a sentencepiece one and adds that space itself.
    ``groups`` is "a1,a2|b1;a3|b2,b3" in ids, or with ``digest`` the SHA-256 of it. A text that is NULL or empty, or
    whose tokens' bytes differ from a space and the text (U+2581 in it), has zeros, no pairs and "" for groups, not
    digested. One row per row, so repeated rows and NULL ids stay; other columns are ignored; an empty table gives no rows.
    Nothing is shuffled; a chunk of texts and a bounded store of words are all a task holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b, kind)
        for batch in batches:
            for rows, texts in chunks(batch, "text", 2 << 20):
                gc.disable()
                try:
                    facts, keys, links, groups = aligner.align(texts)
                finally:
                    gc.enable()
                joined = ["".join(g)[:-1] for g in groups]
                if digest:
                    joined = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in joined]
                # times of the distinct pairs of each text, all texts at once
                names, code = np.unique(keys, return_inverse=True)
                both, times = np.unique(np.repeat(np.arange(len(links)), links) * max(len(names), 1) + code, return_counts=True)
                of = both // max(len(names), 1)
                places = pa.array(np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(links))))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        *(pa.array(facts[:, k], pa.int64()) for k in range(3)),
                        pa.array(links, pa.int64()),
                        pa.array(joined, pa.string()),
                        pa.ListArray.from_arrays(places, pa.array(names[both % max(len(names), 1)], pa.int64())),
                        pa.ListArray.from_arrays(places, pa.array(times, pa.int64())),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, count): links of every pair of ids in the whole corpus, added in each task before the shuffle."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy("p.pairs").agg(F.sum("p.times").alias("count"))
    a, b = F.shiftrightunsigned("pairs", 32).alias("a"), F.col("pairs").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    return each.select(F.col("pairs").alias("pair"), a, b, "count")


def score_links(aligned: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for the rows of ``align``.

    n_best are the links whose pair has the highest corpus count of all pairs with its id of b, count_sum adds the counts of
    all links. Frequent pairs, each with at least 1 / ``HOT_PAIRS`` of all links and so at most ``HOT_PAIRS`` of them,
    and the best count of each id of b, at most one an entry of the vocabulary, go to the tasks; all others are joined by
    pair, where none is frequent enough to be hot.
    """
    spark = aligned.sparkSession
    aligned = durable(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = durable(pair_counts(aligned), "pair-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("count") * HOT_PAIRS >= total).select("pair", "count").toPandas().sort_values("pair")
    best_of = durable(counts.groupBy("b").agg(F.max("count").alias("best")), "pair-best")
    best = best_of.toPandas().sort_values("b")
    held = spark.sparkContext.broadcast([t[c].to_numpy(np.int64) for t, c in ((hot, "pair"), (hot, "count"), (best, "b"), (best, "best"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counted, ids, highest = held.value
        for batch in batches:
            lists, times = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False)
            key = lists.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
            at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            known = pairs[at] == key if len(pairs) else np.zeros(len(key), bool)
            count = np.where(known, counted[at], 0) if len(pairs) else np.zeros(len(key), np.int64)
            top = known & (count == highest[np.searchsorted(ids, key & 0xFFFFFFFF)]) if len(ids) else known
            rare = np.concatenate(([0], np.cumsum(~known)))[offsets]
            rare = pa.array(rare, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(run_sums(np.where(top, times, 0), offsets)),
                    pa.array(run_sums(count * times, offsets)),
                    pa.ListArray.from_arrays(rare, pa.array(key[~known])),
                    pa.ListArray.from_arrays(rare, pa.array(times[~known])),
                ],
                names=["row", "n_best", "count_sum", "pairs", "times"],
            )

    schema = "row long, n_best long, count_sum long, pairs array<long>, times array<long>"
    looked = durable(aligned.select("row", "pairs", "times").mapInArrow(run, schema), "links-scored")
    rare = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), "p.times")
    rare = rare.join(counts.select("pair", "b", "count"), "pair").join(F.broadcast(best_of), "b")
    late = rare.groupBy("row").agg(
        F.sum(F.when(F.col("count") == F.col("best"), F.col("times")).otherwise(0)).alias("best2"), F.sum(F.col("count") * F.col("times")).alias("sum2")
    )
    scored = looked.select("row", "n_best", "count_sum").join(late, "row", "left")
    n_best, count_sum = ((F.col(c) + F.coalesce(d, F.lit(0))).alias(c) for c, d in (("n_best", "best2"), ("count_sum", "sum2")))
    facts = aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return facts.join(scored.select("row", n_best, count_sum), "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"
    )

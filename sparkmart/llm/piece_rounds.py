"""SentencePiece BPE ids by vectorised merge rounds, and the way back.

Method: flat numpy symbol arrays, segmented minimum pair rank per word, simultaneous leftmost merges,
compaction until no pair remains.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks, gather, run_sums, split_words
from sparkmart.llm.token_ids import WordStore

SPACE = "▁"
_NONE = np.int64(1) << 40
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class MergeRounds:
    """The merges of one model as sorted arrays of pairs.

    A pair is (left symbol, right symbol), its rank the place of the merged piece's score from the best
    down; equal scores share a rank. Symbols are piece ids; characters outside the vocabulary get
    negative symbols, which never merge and become byte pieces at the end.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = {
            model.id_to_piece(i): i
            for i in range(len(model))
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        scores = {i: model.get_score(i) for i in plain.values()}
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        if any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("a piece of this model crosses a word border")
        keys, ranks, merged = [], [], []
        for piece, i in plain.items():
            for k in range(1, len(piece)):
                left, right = plain.get(piece[:k]), plain.get(piece[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(order[scores[i]])
                    merged.append(i)
        by = np.argsort(np.array(keys, np.int64))
        self.keys, self.ranks, self.merged = (np.array(a, np.int64)[by] for a in (keys, ranks, merged))
        self.char = np.full(0x110000, -1, np.int64)
        for piece, i in plain.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the tables) of pairs; rank _NONE where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (left >= 0) & (right >= 0) & (self.keys[at] == key)
        return np.where(known, self.ranks[at], _NONE), at

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words, exactly as the model merges them: best score first, leftmost on ties.

        All best pairs of a word merge in one round unless a pair that this makes is as good or better
        than them: the library would then have gone on with the new pair. Such words start again with one
        merge a round.
        """
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols = np.where(self.char[points] >= 0, self.char[points], -1 - points)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat, word, again = self._rounds(symbols, np.repeat(np.arange(len(words)), lengths), many=True)
        if len(again):
            keep = ~np.isin(word, again)
            at = np.isin(np.repeat(np.arange(len(words)), lengths), again)
            single, of, _ = self._rounds(symbols[at], np.repeat(np.arange(len(words)), lengths)[at], many=False)
            flat, word = np.concatenate((flat[keep], single)), np.concatenate((word[keep], of))
            by = np.argsort(word, kind="stable")
            flat, word = flat[by], word[by]
        unknown = np.flatnonzero(flat < 0)
        if len(unknown):
            raw = [chr(-1 - s).encode() for s in flat[unknown].tolist()]
            size = np.ones(len(flat), np.int64)
            size[unknown] = [len(r) for r in raw]
            ends = np.cumsum(size)
            out = np.repeat(flat, size)
            out[np.repeat(flat < 0, size)] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
            flat, word = out, np.repeat(word, size)
            del ends
        counts = np.bincount(word, minlength=len(words))
        ends, ids = np.cumsum(counts).tolist(), flat.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _rounds(self, symbols: np.ndarray, word: np.ndarray, many: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        done, again = [], []
        while len(symbols):
            if len(symbols) == 1:
                done.append((symbols, word))
                break
            rank, at = self._pairs(symbols[:-1], symbols[1:])
            rank = np.append(np.where(word[:-1] == word[1:], rank, _NONE), _NONE)
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(heads, len(word)))
            best = np.minimum.reduceat(rank, heads)
            over = np.repeat(best == _NONE, sizes)
            if over.any():  # compaction: finished words leave
                done.append((symbols[over], word[over]))
                at = np.append(at, 0)[~over]
                symbols, word, rank = symbols[~over], word[~over], rank[~over]
                if not len(symbols):
                    break
                sizes, best = sizes[best < _NONE], best[best < _NONE]
            else:
                at = np.append(at, 0)
            best = np.repeat(best, sizes)
            hit = rank == best
            places = np.flatnonzero(hit)
            if many:  # leftmost of overlapping ones: every second of a run of neighbours
                run = np.append(True, np.diff(places) != 1)
                first = np.repeat(np.flatnonzero(run), np.diff(np.append(np.flatnonzero(run), len(places))))
                places = places[(np.arange(len(places)) - first) % 2 == 0]
            else:
                places = places[np.append(True, word[places[1:]] != word[places[:-1]])]
            symbols = symbols.copy()
            symbols[places] = self.merged[at[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            before = best[places]
            where = places - np.searchsorted(places + 1, places, side="right")  # positions after compaction
            symbols, word = symbols[keep], word[keep]
            if many and len(symbols) > 1:
                new = np.full(len(places), _NONE)
                left = where > 0
                for mask, a in ((left, where[left] - 1), (where < len(symbols) - 1, where[where < len(symbols) - 1])):
                    got, _ = self._pairs(symbols[a], symbols[a + 1])
                    new[mask] = np.minimum(new[mask], np.where(word[a] == word[a + 1], got, _NONE))
                counts = np.bincount(word[where], minlength=1)
                bad = np.unique(word[where[(new <= before) & (counts[word[where]] > 1)]])
                if len(bad):
                    again.append(bad)
                    stay = ~np.isin(word, bad)
                    symbols, word = symbols[stay], word[stay]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.concatenate([*again, np.zeros(0, np.int64)])
        flat, of = (np.concatenate(x) for x in zip(*done))
        by = np.argsort(of, kind="stable")
        return flat[by], of[by], np.concatenate([*again, np.zeros(0, np.int64)])


class PieceIds:
    """Ids of whole texts; each distinct word is merged once and kept in a bounded store."""

    def __init__(self, path: str, limit: int = 400_000):
        self.rounds = MergeRounds(path)
        self.model = self.rounds.model
        self.store = WordStore(self.rounds.encode, limit)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets). A text is led by one space, spaces are written as U+2581, nothing else changes."""
        gc.disable()
        try:
            odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.match_substring(texts, SPACE), pc.ends_with(texts, " ")))
            odd = pc.or_(odd, pc.or_(pc.starts_with(texts, " "), pc.equal(pc.binary_length(texts), 0))).to_numpy(zero_copy_only=False)
            plain = texts.filter(pa.array(~odd))
            codes, words, offsets = split_words(plain, spaces_only=True)
            slot = self.store.slots([SPACE + w for w in words.to_pylist()])
            used = slot[codes]
            np.add.at(self.store.hits, slot, np.bincount(codes, minlength=len(slot)))
            lengths = self.store.length[used]
            ids, counts = gather(self.store.pool, self.store.start[used], lengths), run_sums(lengths, offsets)
            if not odd.any():
                return ids, np.concatenate(([0], np.cumsum(counts)))
            parts = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else [])
            rest = iter(self._odd(texts.filter(pa.array(odd)).to_pylist()))
            parts = [next(rest) if o else next(parts) for o in odd]
            return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        finally:
            gc.enable()

    def _odd(self, texts: list[str]) -> list[np.ndarray]:
        """Texts with runs of spaces, or spaces at their ends."""
        split = [_WORD.findall((SPACE + t.replace(" ", SPACE)) if t else "") for t in texts]
        known: dict[str, int] = {}
        for words in split:
            for w in words:
                known.setdefault(w, len(known))
        ids = [np.array(i, np.uint32) for i in self.rounds.encode(list(known))] if known else []
        return [np.concatenate([ids[known[w]] for w in words]) if words else np.zeros(0, np.uint32) for words in split]


_LOADED: dict[str, PieceIds] = {}


def piece_ids(path: str) -> PieceIds:
    """One encoder per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceIds(path)
    return _LOADED[path]


def encode_pieces(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode whole texts: doc_id, n_tokens, ids (decimal, joined by commas), decoded.

    Ids are those of the model without begin or end ids; ``decoded`` is what the library's ``decode`` makes of
    them. NULL text counts as empty (no ids, empty decoded text). One row per row of the table, so repeated rows and
    NULL ids stay; other columns are ignored; an empty table gives none. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(model)
        digits = np.array([f"{i}," for i in range(len(encoder.model))], dtype=object)
        for batch in batches:
            for rows, texts in chunks(batch, "text", 4 << 20):
                ids, offsets = encoder.encode(texts)
                lists = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
                written = ["".join(digits[i])[:-1] for i in np.split(ids, offsets[1:-1])]
                decoded = encoder.model.decode(lists, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(offsets)), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string")

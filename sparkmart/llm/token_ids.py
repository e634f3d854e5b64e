"""Token ids of whole texts by the tokenizers library, with a bounded store of words already encoded."""

from __future__ import annotations

import gc
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparkmart.llm.arrow_text import gather, run_sums, split_words

#: White space after which a space may belong to another token than the word that follows it.
_DOUBLE = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] "


#: Latin letters with marks that may follow them, and the same again on the next line.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)(?:\n([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*))?")
_PROBES = ["word", "Word,", "ünïcödé.", "ÀÉ!?", "aß", "x;:", "the", "Étion", "ÿ...", "Don", "s", "re", "end.\nÉt", "a\nb,", "so!\nThe..."]


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell the letters beyond ASCII that ``_PLAIN`` takes.

    Printable bytes stand for themselves; the others are numbered from U+0100 in byte order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    spelled = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordStore:
    """Word -> ids, as slots into one flat array; the less used half goes when it is full."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self.slot: dict[str, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int64)

    def slots(self, words: list[str]) -> np.ndarray:
        if len(self.slot) + len(words) > self.limit and self.slot:
            self._shrink()
        get = self.slot.get
        found = np.array([get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            missing = dict.fromkeys(words[k] for k in new.tolist())
            once, missing = len(missing) == len(new), list(missing)
            ids = self.encode(missing)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            first = len(self.start)
            self.start = np.concatenate((self.start, len(self.pool) + np.cumsum(lengths) - lengths))
            self.length = np.concatenate((self.length, lengths))
            self.pool = np.concatenate((self.pool, flat))
            self.hits = np.concatenate((self.hits, np.zeros(len(missing), np.int64)))
            self.slot.update(zip(missing, range(first, first + len(missing))))
            found[new] = np.arange(first, first + len(missing)) if once else [self.slot[words[k]] for k in new.tolist()]
        return found

    def _shrink(self) -> None:
        words = list(self.slot)  # in slot order
        keep = np.sort(np.argsort(self.hits, kind="stable")[len(words) - self.limit // 3 :]) if len(words) > self.limit // 3 else np.arange(len(words))
        self.pool = gather(self.pool, self.start[keep], self.length[keep])
        self.length = self.length[keep]
        self.start = np.cumsum(self.length) - self.length
        self.hits = self.hits[keep] // 2
        self.slot = {words[k]: i for i, k in enumerate(keep.tolist())}


class TokenIds:
    """Ids of texts, equal to ``encode(text, add_special_tokens=False)`` of the library.

    Strings of special tokens inside a text are ordinary text. Texts are cut before spaces,
    where the pre-tokenizer always cuts too, and each distinct piece is encoded once. Texts in
    which white space stands before a space are encoded whole when spaces matter.
    """

    def __init__(self, path: str, spaces_matter: bool, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.model._resize_cache(0)  # words come once
        self.spaces_matter = spaces_matter
        self.letters = _byte_letters()
        self.marks: dict[str, list[int]] = {}
        self.direct = True
        for lead in (" ", "") if spaces_matter else ("",):
            self.direct &= self._words(_PROBES, lead) == self._encode([lead + w for w in _PROBES])
        self.inner = WordStore(lambda words: self._words(words, " " if spaces_matter else ""), limit)
        self.first = WordStore(lambda words: self._words(words, ""), limit // 4)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], lead: str) -> list[list[int]]:
        """Ids of words after ``lead``. Plain words go to the library's BPE model at once.

        Whether that gives the same ids is tried on a few words when the vocabulary is loaded.
        """
        if not self.direct:
            return self._encode([lead + w for w in words])
        model, plain, marks, letters = self.tokenizer.model.tokenize, _PLAIN.fullmatch, self.marks, self.letters
        before, lower = "Ġ" if lead else "", not self.spaces_matter
        out, rest = [], []
        line = [] if lower else [t.id for t in model("Ċ")]

        def spell(lead: str, core: str, mark: str) -> list[int]:
            if lower:
                core = core.lower()
            if not core.isascii():
                core = core.translate(letters)
            ids = [t.id for t in model(lead + core)]
            if mark:
                if mark not in marks:
                    if len(marks) > 10_000:
                        marks.clear()
                    marks[mark] = [t.id for t in model(mark)]
                ids += marks[mark]
            return ids

        known = marks.get
        odd = "\0".join(w for w in words if not w.isascii())  # spelled all at once
        spelled = iter((odd.lower() if lower else odd).translate(letters).split("\0"))
        for w in words:
            if w.isascii():  # most words are letters, or letters and one mark that has been met
                if w.isalpha():
                    out.append([t.id for t in model(before + (w.lower() if lower else w))])
                    continue
                mark = known(w[-1:])
                if mark and w[:-1].isalpha():
                    out.append([t.id for t in model(before + (w[:-1].lower() if lower else w[:-1]))] + mark)
                    continue
                shown = None
            else:
                shown = next(spelled) if "\0" not in w else [next(spelled) for _ in w.split("\0")]
            m = plain(w)
            if m is None:
                rest.append(lead + w)
                out.append(None)
                continue
            core, mark, core2, mark2 = m.groups()
            if shown and not core2 and (not mark or mark in marks):
                cut = shown[: -len(mark)] if mark else shown
                out.append([t.id for t in model(before + cut)] + (marks[mark] if mark else []))
                continue
            ids = spell(before, core, mark)
            if core2:
                ids += line + spell("", core2, mark2)
            out.append(ids)
        coded = iter(self._encode(rest))
        return [next(coded) if ids is None else ids for ids in out]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets), each text followed by ``end_id``."""
        gc.disable()
        try:
            ids, lengths = self._encode_texts(texts)
        finally:
            gc.enable()
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        if end_id is None:
            return ids, offsets
        out = np.full(len(ids) + len(texts), end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), lengths)] = ids
        return out, offsets + np.arange(len(texts) + 1)

    def _encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.zeros(len(texts), bool)
        if self.spaces_matter:
            whole = pc.match_substring_regex(texts, _DOUBLE).to_numpy(zero_copy_only=False)
        if whole.any():
            direct = self._encode(texts.filter(pa.array(whole)).to_pylist())
            ids, lengths = self._encode_words(pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts))
            lengths = lengths.copy()
            parts, at = np.split(ids, np.cumsum(lengths)[:-1]), 0
            for k in np.flatnonzero(whole):
                parts[k], at = np.array(direct[at], np.uint32), at + 1
                lengths[k] = len(parts[k])
            return np.concatenate(parts), lengths
        return self._encode_words(texts)

    def _encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        codes, words, offsets = split_words(texts, spaces_only=True)
        slot = self.inner.slots(words.to_numpy(zero_copy_only=False).tolist())
        lengths, starts = self.inner.length[slot][codes], self.inner.start[slot][codes]
        self.inner.hits[slot] += np.bincount(codes, minlength=len(slot))  # the words are distinct
        pool = self.inner.pool
        if self.spaces_matter and len(texts):
            head = offsets[:-1]
            firsts = self.first.slots(pc.take(words, pa.array(codes[head])).to_numpy(zero_copy_only=False).tolist())
            lengths[head], starts[head] = self.first.length[firsts], self.first.start[firsts] + len(pool)
            pool = np.concatenate((pool, self.first.pool))
        return gather(pool, starts, lengths), run_sums(lengths, offsets)


_LOADED: dict[tuple[str, bool], TokenIds] = {}


def token_ids(path: str, spaces_matter: bool) -> TokenIds:
    """One encoder per Python worker."""
    key = (path, spaces_matter)
    if key not in _LOADED:
        _LOADED[key] = TokenIds(path, spaces_matter)
    return _LOADED[key]

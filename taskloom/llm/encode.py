"""Sub-word encoding of many texts by the tokenizers library, with a bounded cache of white-space-free chunks.

The vocabularies used here normalise and cut texts inside white-space-free runs only, so the ids of a text are
the ids of its runs one after another; the runs follow a Zipf law and most are found in the cache.
"""

from __future__ import annotations

import gc
import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Letters whose lower case and normal form never depend on what stands beside them, then marks that make one token.
_PARTS = r"^(?P<letters>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
_PROBES = ["Plain", "the", "\xc9COLE", "stra\xdfe", "na\xefve", "abcdefghijklmnop", "x"]


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 onward in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer's file; an existing path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """encode_batch(texts) -> (ids uint32 of all texts, one after another; number of ids of each text)."""

    def __init__(self, vocabulary: str, cached_runs: int = 350_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.cached_runs = cached_runs
        self.letters = _byte_letters()
        self.plain = "Lowercase" in str(self.tokenizer.normalizer) and all(self._plain(p) + self._whole([m])[0] == self._whole([p + m])[0] for p in _PROBES for m in ("", ".", "***", '",'))
        self._reset()

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _plain(self, letters: str) -> list[int]:
        """Ids of one run of plain letters straight from the merge model, without the text pipeline around it."""
        text = letters.lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def _encode(self, words: list[str]) -> list[list[int]]:
        if not self.plain:
            return self._whole(words)
        tokenize, letters, match = self.tokenizer.model.tokenize, self.letters, _LETTERS.fullmatch
        out, late = [], []
        for k, text in enumerate(words):
            if match(text):
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(letters)
                out.append([t.id for t in tokenize(text)])
            else:
                late.append(k)
                out.append(None)
        for k, ids in zip(late, self._whole([words[k] for k in late])):
            out[k] = ids
        return out

    def _reset(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.start, self.size, self.hits = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used = 0

    def _make_room(self) -> None:
        """Keep the most often used third of the runs, if their ids are not too many."""
        n = len(self.code)
        order = np.argsort(-self.hits[:n], kind="stable")[: self.cached_runs // 3]
        order = np.sort(order[np.cumsum(self.size[order]) <= 4 * self.cached_runs])
        names, sizes, hits = list(self.code), self.size[order], self.hits[order]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[order] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        flat = self.flat[at]
        self._reset()
        self.code = {names[k]: i for i, k in enumerate(order.tolist())}
        self.flat = np.concatenate([flat, self.flat])
        self.start, self.size, self.hits = (np.concatenate([x, np.zeros(1 << 14, np.int64)]) for x in (ends - sizes, sizes, hits // 2))
        self.used = len(flat)

    def _learn(self, new: list[str]) -> None:
        collecting = gc.isenabled()
        gc.disable()  # many small lists that live briefly
        got = self._encode(new)
        if collecting:
            gc.enable()
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum()))
        n, m = len(self.code), len(new)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + m > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.hits = np.concatenate([self.hits, np.zeros_like(self.hits)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[n : n + m] = sizes
        self.start[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.code.update(zip(new, range(n, n + m)))

    def _cut(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cache places of each run, one or two; bytes of each run; runs before each text and in all)."""
        if len(self.code) > self.cached_runs or self.used > 16 * self.cached_runs:
            self._make_room()
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        cut = pc.ascii_split_whitespace(texts)
        count = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        if self.plain:
            parts = pc.extract_regex(words, _PARTS)
            plain = pc.is_valid(parts)
            base = pc.if_else(plain, pc.utf8_lower(pc.struct_field(parts, "letters")), words)
            mark = pc.if_else(plain, pc.struct_field(parts, "marks"), "")
            codes = np.stack([self._codes(base), self._codes(mark)], axis=1)
        else:
            codes = self._codes(words)[:, None]
        return codes[index], pc.binary_length(words).to_numpy(zero_copy_only=False)[index], count

    def run_sizes(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each run of all texts, number of runs of each text)."""
        codes, lengths, count = self._cut(texts)
        some = lengths > 0  # white space at an end of a text leaves an empty run
        upto = np.concatenate([[0], np.cumsum(some)])[count]
        return self.size[codes].sum(axis=1)[some], np.diff(upto)

    def encode_batch(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        codes, _, count = self._cut(texts)
        if not len(codes):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        count = count * codes.shape[1]
        codes = codes.reshape(-1)
        sizes = self.size[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1])
        at = np.repeat(self.start[codes] - (ends - sizes), sizes)
        at += np.arange(total)
        upto = np.concatenate([[0], ends])[count]
        return self.flat[at], np.diff(upto)

    def _codes(self, words: pa.Array) -> np.ndarray:
        """Places of words in the cache, which learns those it does not have."""
        coded = words.dictionary_encode()
        names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        codes = np.fromiter(map(self.code.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            first = len(self.code)
            self._learn([names[k] for k in missing.tolist()])
            codes[missing] = np.arange(first, first + len(missing))
        self.hits[codes] += 1
        return codes[index]


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """The process's encoder: Python workers serve many tasks, and the next one finds the cache filled."""
    return Encoder(vocabulary)

"""Whole-text encoding with a ``tokenizers`` vocabulary file, one call per distinct word.

A byte-pair tokenizer first cuts a text into pre-tokens and then merges inside
each.  A text is therefore split at white space that is always a pre-token
boundary, every distinct chunk is encoded once by the library, and a text's
ids are gathered from the chunks' ids.  The result equals a plain library call
on the whole text (tested); texts repeat their words, so the library sees a
small part of the input.

* ``byte`` style (byte-level BPE whose pattern attaches a leading space to the
  next run): a space or newline after a non-space character starts a
  pre-token.  No pre-token before it looks further, so the cut is exact.
* ``word`` style (white space is dropped, words end in a marker): any space or
  newline is a cut.

Arrow splits a step of texts and numbers its distinct chunks, so Python touches
distinct chunks only; numpy gathers the ids.  A chunk of letters with a run of
punctuation behind it is two pre-tokens, and only the letters are kept.  Texts
that hold a special token's string go to the library whole.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks and ids kept per worker.  When there are more, the half used in most steps stays.
MAX_CHUNKS, MAX_IDS = 400_000, 4_000_000
#: Bytes of text encoded at a time (a longer text is one such step by itself).
STEP_BYTES = 1 << 22

#: Before a chunk that stands for itself: the others follow a space.
_LITERAL = "\0"
_TAIL = string.punctuation
_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n])")

#: Letters, digits and symbols of byte-level vocabularies: printable bytes stand
#: for themselves, the others for the code points from 256 up, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: b for b in _PRINTABLE} | {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class _Codes(dict):
    """Number of each chunk; unknown chunks get the next number and are noted."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, chunk):
        self[chunk] = n = len(self)
        self.new.append(chunk)
        return n


def _byte_chunks(text: str) -> list[str]:
    """Chunks of a text in which white space stands before a space or newline."""
    cut = _BOUNDARY.split(text)
    return [_LITERAL + cut[0]] + [c[1:] if c[0] == " " and c[1:2] != "\n" else _LITERAL + c for c in cut[1:]]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + counts[i] - 1, one run after another."""
    after = np.cumsum(counts, dtype=np.int64)
    total = int(after[-1]) if len(after) else 0
    kind = np.int32 if total < 1 << 31 and (not len(starts) or int(starts.max()) < 1 << 30) else np.int64
    out = np.repeat((starts - (after - counts)).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out


class Encoder:
    """Encodes texts to ids; keeps the ids of the chunks it has met.

    Words of Latin-1 letters only are one pre-token whatever stands around
    them: they are handed to the library's BPE model in the vocabulary's byte
    alphabet.  Anything else goes through the whole tokenizer, a chunk at a time."""

    def __init__(self, path: str, style: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = max(self.tokenizer.get_vocab().values()) + 1
        self.style = style
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "(?i)" + "|".join([*special, r"\x00"])
        self._begin()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _begin(self) -> None:
        self.codes = _Codes()
        self.tails: dict[str, np.ndarray] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.count, self.hits = (np.zeros(1 << 14, np.int32) for _ in range(3))

    def _forget(self) -> None:
        """Keep the half of the chunks that was met in most steps."""
        n = len(self.codes)
        kept = np.zeros(n, bool)
        kept[np.argsort(self.hits[:n], kind="stable")[n - n // 2 :]] = True
        number = np.cumsum(kept) - 1
        codes, self.codes = self.codes, _Codes()
        self.codes.update((k, int(number[c])) for k, c in codes.items() if kept[c])
        start, count = self.start[:n][kept], self.count[:n][kept]
        ids = self.flat[_spread(start, count)]
        self.used = len(ids)
        self.flat[: self.used] = ids
        m = len(count)
        self.count[:m], self.start[:m], self.hits[:m] = count, np.cumsum(count) - count, self.hits[:n][kept] // 2
        self.hits[m:] = 0

    def _store(self, codes: list[int], lists: list[list[int]]) -> None:
        counts = np.fromiter(map(len, lists), np.int32, len(lists))
        total = int(counts.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) // 2 + total, np.uint32)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        self.count[codes] = counts
        self.start[codes] = self.used + np.cumsum(counts) - counts
        self.used += total

    def _learn(self) -> None:
        if len(self.codes) > len(self.start):
            more = np.zeros(len(self.codes) - len(self.start) // 2, np.int32)
            self.start, self.count, self.hits = (np.concatenate([x, more]) for x in (self.start, self.count, self.hits))
        new, self.codes.new = self.codes.new, []
        number, tokenize = self.codes.__getitem__, self.model.tokenize
        lead = "" if self.style == "word" else chr(_ALPHABET[32])
        plain, lists, other = [], [], []
        fold = self.style == "word"  # that vocabulary folds case; ASCII letters are folded already
        for chunk in new:
            if not chunk.isalpha():
                other.append(chunk)
            elif chunk.isascii():
                plain.append(number(chunk))
                lists.append([t.id for t in tokenize(lead + chunk)])
            elif max(chunk) < "Ā":
                word = (chunk.lower() if fold else chunk).encode().decode("latin-1").translate(_ALPHABET)
                plain.append(number(chunk))
                lists.append([t.id for t in tokenize(lead + word)])
            else:
                other.append(chunk)
        self._store(plain, lists)
        texts = other
        if self.style == "byte":  # a newline needs no space before it
            texts = [c[1:] if c[:1] == _LITERAL else c if c[:1] == "\n" else " " + c for c in other]
        self._store([number(c) for c in other], self._ids(texts))

    def _tail(self, tail: str) -> np.ndarray:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[tail] = np.array(self._ids([tail])[0], np.uint32)
        return self.tails[tail]

    def _gather(self, chunks: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks one after another, ids of each chunk)."""
        bodies, tails, tailed = [], [], []
        known = self.tails
        for n, chunk in enumerate(chunks.dictionary.to_numpy(zero_copy_only=False).tolist()):
            body = chunk.rstrip(_TAIL)
            if body is not chunk and body.isalpha() and (body.isascii() or max(body) < "Ā"):
                bodies.append(body)
                tail = chunk[len(body) :]
                tails.append(known[tail] if tail in known else self._tail(tail))
                tailed.append(n)
            else:
                bodies.append(chunk)
        codes = np.fromiter(map(self.codes.__getitem__, bodies), np.int32, len(bodies))
        if self.codes.new:
            self._learn()
        self.hits[codes] += 1
        counts, starts, flat = self.count[codes], self.start[codes], self.flat
        if tailed:  # the step's own table: bodies with their tails behind them
            own = counts.copy()
            extra = np.fromiter(map(len, tails), np.int32, len(tails))
            counts[tailed] += extra
            begins = np.cumsum(counts) - counts
            flat = np.empty(int(counts.sum()), np.uint32)
            flat[_spread(begins, own)] = self.flat[_spread(starts, own)]
            flat[_spread(begins[tailed] + own[tailed], extra)] = np.concatenate(tails)
            starts = begins
        at = chunks.indices.to_numpy()
        each = counts[at]
        return flat[_spread(starts[at], each)], each

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets: len(texts) + 1).  Null texts are empty."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if len(self.codes) > MAX_CHUNKS or self.used > MAX_IDS:
            self._forget()
        whole = pc.match_substring_regex(texts, self.whole)
        odd = pc.match_substring_regex(texts, f"{_SPACES}[ \n]") if self.style == "byte" else None
        apart = whole if odd is None else pc.or_(whole, odd)
        rows = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        even = pc.if_else(apart, "", texts) if len(rows) else texts
        if self.style == "byte":
            even = pc.binary_join_element_wise(_LITERAL, pc.replace_substring(even, "\n", " \n"), "")
        else:
            even = pc.ascii_lower(pc.replace_substring(even, "\n", " "))
        lists = pc.split_pattern(even, " ")
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        ids, each = self._gather(lists.flatten().dictionary_encode())
        offsets = np.concatenate(([0], np.cumsum(each, dtype=np.int64)))[ends]
        if not len(rows):
            return ids, offsets
        parts = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
        for i in rows.tolist():
            text = texts[i].as_py()
            if whole[i].as_py():
                parts[i] = np.array(self._ids([text])[0], np.uint32)
            else:
                parts[i] = self._gather(pa.array(_byte_chunks(text), pa.string()).dictionary_encode())[0]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, style: str) -> Encoder:
    """The worker's encoder for a vocabulary file (kept from task to task)."""
    if (path, style) not in _ENCODERS:
        _ENCODERS[path, style] = Encoder(path, style)
    return _ENCODERS[path, style]


def encoded(column: pa.Array, path: str, style: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of a column of texts (null: empty), in order, a bounded step of texts at a time."""
    enc = encoder(path, style)
    column = column.cast(pa.string())
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = int(sizes[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + STEP_BYTES, "right")))
        ids, offsets = enc.encode(column.slice(at, stop - at))
        for i in range(stop - at):
            yield at + i, ids[offsets[i] : offsets[i + 1]]
        at = stop

"""Token ids of whole texts by a public tokenizer file.

The vocabulary lower-cases texts and cuts them at white space, and into runs of letters, single
digits and runs of signs, before it merges anything; so a text's ids are its parts' ids in a row.
Parts recur: each batch of texts is cut with array operations, equal parts are found by two 64-bit
hashes, and the tokenizers library merges each new part once. A word with any byte beyond plain
Latin goes to the library whole. A worker keeps the parts it has met, up to ``CACHE`` of them. A
vocabulary of another build encodes text by text instead.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from tokenizers import Tokenizer

#: Id that ends a document.
END = 1
#: Bytes handled at once, and words kept by a worker.
CHUNK, CACHE = 1 << 20, 3_000_000
SPACE, NEWLINE = 32, 10
_RNG = np.random.default_rng(20)
_CODES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_UNSTEP = pow(_STEP, -1, 2**64)
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)


def _byte_kinds() -> np.ndarray:
    """The kind of each byte; 0xC3 opens a Latin letter. Words with an odd byte are left to the library whole:
    apostrophes and "<" may open patterns or marks, and other scripts may compose or fold."""
    kinds = np.full(256, ODD, np.uint8)
    kinds[33:127] = SIGN
    kinds[ord("0"):ord("9") + 1] = DIGIT
    kinds[ord("a"):ord("z") + 1] = kinds[ord("A"):ord("Z") + 1] = kinds[0xC3] = LETTER
    kinds[[ord("'"), ord("<")]] = ODD
    kinds[[SPACE, NEWLINE]] = BLANK
    return kinds


_KINDS = _byte_kinds()


def _byte_letters() -> dict[int, str]:
    """The letters of byte-level vocabularies: visible bytes stand for themselves, others follow U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


class _Powers:
    """Powers of the step and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_STEP, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_UNSTEP, k, 2**64))])
        return self.up[:n], self.down[:n]


class _Words:
    """Sorted first hashes of known words with second hashes and places of their ids."""

    def __init__(self) -> None:
        self.key = np.empty(0, np.uint64)
        self.check = np.empty(0, np.uint64)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return self.key[at] == key, at

    def add(self, key, check, start, length) -> None:
        key = np.concatenate([self.key, key])
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        for name, more in (("check", check), ("start", start), ("length", length)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])


class Encoder:
    """Encodes batches of texts; ``size`` is one more than the largest id."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        build = json.loads(self.tokenizer.to_str())
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.model = self.tokenizer.model
        steps = [s["type"] for s in (build["normalizer"] or {}).get("normalizers", [])]
        cuts = (build["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.wordwise = (
            steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and r"[^\s\p{L}\p{N}]+" in cuts[0]["pattern"]["Regex"]
            and all(t["content"].startswith("<") and " " not in t["content"] and not (t["lstrip"] or t["rstrip"]) for t in build["added_tokens"])
        )
        self.letters = _byte_letters()
        self.powers = _Powers()
        self._reset()

    def _reset(self) -> None:
        self.old, self.new = _Words(), _Words()
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0

    def word(self, word: bytes, odd: bool) -> list[int]:
        """The ids of a part that the vocabulary's pattern cuts out, or of an odd word."""
        if odd:
            return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        shown = word.decode() if word.isascii() else word.decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(shown)]

    def _learn(self, data: bytes, starts, ends, odd, key, check) -> None:
        """Encode words not met before and keep their ids."""
        found = [self.word(data[s:e], o) for s, e, o in zip(starts.tolist(), ends.tolist(), odd.tolist())]
        length = np.fromiter(map(len, found), np.int64, len(found))
        total = int(length.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(len(self.ids), np.uint32)])
        self.ids[self.used:self.used + total] = np.fromiter((i for ids in found for i in ids), np.uint32, total)
        start = self.used + np.cumsum(length) - length
        self.used += total
        self.new.add(key, check, start, length)
        if len(self.new.key) > 50_000 + len(self.old.key) // 4:
            self.old.add(self.new.key, self.new.check, self.new.start, self.new.length)
            self.new = _Words()

    def _words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of the byte ranges between ``bounds``, without end ids."""
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        data, kinds = self._parts(data, cut)
        differs = np.ones(len(data) + 1, bool)
        differs[1:-1] = kinds[1:] != kinds[:-1]
        differs[:-1] |= kinds == DIGIT  # each digit stands alone
        differs |= cut
        shown = kinds != BLANK
        starts = np.flatnonzero(shown & differs[:-1])
        ends = np.flatnonzero(shown & differs[1:]) + 1
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        up, down = self.powers.get(len(data))
        key, check = (self._hash(codes, data, up, down, starts, ends) for codes in _CODES)
        codes, distinct = pd.factorize(key)
        order = np.argsort(distinct)  # ascending look-ups stay in the processor's caches
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        codes, distinct = place[codes], distinct[order]
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        if (check[first][codes] != check).any():
            raise ValueError("two words share a hash")
        if len(self.old.key) + len(self.new.key) + len(distinct) > CACHE:
            self._reset()
        in_old, _ = self.old.find(distinct)
        in_new, _ = self.new.find(distinct)
        fresh = ~(in_old | in_new)
        if fresh.any():
            at = first[fresh]
            self._learn(data.tobytes(), starts[at], ends[at], kinds[starts[at]] == ODD, distinct[fresh], check[at])
        start, length, known = (np.empty(len(distinct), t) for t in (np.int64, np.int64, np.uint64))
        for words in (self.old, self.new):
            here, at = words.find(distinct)
            for out, column in ((start, words.start), (length, words.length), (known, words.check)):
                out[here] = column[at[here]]
        if (known != check[first]).any():
            raise ValueError("two words share a hash")
        sizes = length[codes]
        total = int(sizes.sum())
        place = np.arange(total) + np.repeat(start[codes] - (np.cumsum(sizes) - sizes), sizes)
        owner = np.searchsorted(bounds, starts, side="right") - 1
        return self.ids[place], np.bincount(owner, weights=sizes, minlength=len(bounds) - 1).astype(np.int64)

    @staticmethod
    def _parts(data: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes with A-Z and their Latin kin in lower case, but for odd words, and each byte's kind."""
        kinds = _KINDS[data]
        kin = np.zeros(len(data), bool)
        kin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & ~cut[1:-1]
        kinds[kin & (data != 0x97) & (data != 0xB7)] = LETTER  # but for the times and division signs
        low = data.copy()
        low[(data >= ord("A")) & (data <= ord("Z")) | kin & (data <= 0x9E)] += 32
        bad = np.flatnonzero(kinds == ODD)
        if len(bad):
            blank = kinds == BLANK
            edge = np.ones(len(data) + 1, bool)
            edge[1:-1] = blank[1:] != blank[:-1]
            edge |= cut
            run = np.cumsum(edge[:-1])
            odd = np.isin(run, run[bad]) if len(bad) < 1000 else np.bincount(run[bad], minlength=run[-1] + 1).astype(bool)[run]
            kinds[odd] = ODD
            low[odd] = data[odd]
        return low, kinds

    @staticmethod
    def _hash(codes, data, up, down, starts, ends) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * up, out=total[1:])
        return (total[ends] - total[starts]) * down[starts]

    def _long(self, data: np.ndarray) -> np.ndarray:
        """The ids of one text of more than a chunk, cut at blanks."""
        out, at = [], 0
        while at < len(data):
            end = min(at + CHUNK, len(data))
            if end < len(data):
                blanks = np.flatnonzero((data[at:end] == SPACE) | (data[at:end] == NEWLINE))
                if len(blanks):
                    end = at + int(blanks[-1]) + 1
                else:  # a word longer than a chunk stays whole
                    rest = data[end:]
                    next_blank = np.flatnonzero((rest == SPACE) | (rest == NEWLINE))
                    end = end + int(next_blank[0]) + 1 if len(next_blank) else len(data)
            out.append(self._words(data[at:end], np.array([0, end - at]))[0])
            at = end
        return np.concatenate(out)

    def encode(self, texts: pa.Array):
        """Yield (first, ids, counts): runs of texts from ``first`` on, each text's ids with the end id."""
        if not self.wordwise:
            for n, text in enumerate(texts.to_pylist()):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                yield n, np.array([*ids, END], np.uint32), np.array([len(ids) + 1])
            return
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
            last = min(last, len(texts))
            piece = data[offsets[first]:offsets[last]]
            if last == first + 1 and len(piece) > CHUNK:
                ids = self._long(piece)
                counts = np.array([len(ids)])
            else:
                ids, counts = self._words(piece, offsets[first:last + 1] - offsets[first])
            owner = np.repeat(np.arange(last - first), counts)
            full = np.full(len(ids) + last - first, END, np.uint32)
            full[np.arange(len(ids)) + owner] = ids
            yield first, full, counts + 1
            first = last


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of the file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def reference_ids(tokenizer: Tokenizer, text: str | None) -> list[int]:
    """What the contract says, text by text; for tests."""
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]

"""X1 parameters and counting: a term is a token of at least this many letters, or a bigram of two."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MIN_TOKEN_CHARS = 2
ID_BITS = 21              # a key is group, word, word of so many bits each
SLICE = 1 << 20           # tokens looked at together
HELD_KEYS = 1 << 21       # different keys a task holds before it hands them on
SLOT_BITS = 19            # slots of the tables that find a word's number
SHORT, LONG = 8, 16       # bytes that one or two integers hold
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(SHORT + 1)], dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """Tokens of the clean texts of a batch (between single spaces; null: no token), as places in its bytes."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)
        ends = ends[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        self.bytes = np.concatenate((data, np.zeros(LONG, np.uint8)))   # eight bytes can be read from any place
        self.raw = self.bytes.tobytes()
        self.eights = np.ndarray(len(data) + SHORT + 1, "<u8", self.bytes.data, strides=(1,))
        self.plain = bool(data.all())   # no byte 0: zeros after a token tell its length
        spaces = np.flatnonzero(data == 32)
        self.per_row = np.diff(np.searchsorted(spaces, ends)) + 1
        self.row = np.repeat(np.arange(len(texts)), self.per_row)
        first = np.cumsum(self.per_row) - self.per_row
        inner = np.ones(len(self.row), bool)
        inner[first] = False
        self.start = np.empty(len(self.row), np.int64)
        self.start[first], self.start[inner] = ends[:-1], spaces + 1
        end = np.empty(len(self.row), np.int64)
        end[first + self.per_row - 1], end[np.roll(inner, -1)] = ends[1:], spaces
        self.length = end - self.start

    def __len__(self) -> int:
        return len(self.row)


class WordNumbers:
    """Numbers of words: found for whole slices at once in two tables of fixed size, by
    the word's bytes as one or two integers; a word that is not in its slot (new, longer,
    or pushed out by another) is looked up in a dictionary."""

    def __init__(self, number):
        self.number, self.known = number, {}   # number(word): called once for every new word
        self.keys, self.ids = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.int64)
        self.pairs, self.pair_ids = np.zeros((1 << SLOT_BITS, 2), np.uint64), np.zeros(1 << SLOT_BITS, np.int64)

    def one(self, raw: bytes) -> int:
        n = self.known.get(raw)
        if n is None:
            n = self.known[raw] = self.number(raw.decode())
        return n

    def _each(self, tokens: Tokens, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        raw, one = tokens.raw, self.one
        return np.array([one(raw[s:e]) for s, e in zip(start.tolist(), (start + length).tolist())], dtype=np.int64)

    def of(self, tokens: Tokens, start: int, stop: int) -> np.ndarray:
        """The numbers of the tokens from ``start`` to ``stop`` (-1: what ``number`` drops, and shorter than two bytes)."""
        at, length = tokens.start[start:stop], tokens.length[start:stop]
        out = np.full(len(at), -1, np.int64)
        if not tokens.plain:
            some = np.flatnonzero(length > 1)
            out[some] = self._each(tokens, at[some], length[some])
            return out
        some = np.flatnonzero((length > 1) & (length <= SHORT))
        key = tokens.eights[at[some]] & _MASKS[length[some]]
        slot = (key * _MIX >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        found, missed = self.ids[slot], np.flatnonzero(self.keys[slot] != key)
        if len(missed):
            fresh, place, back = np.unique(key[missed], return_index=True, return_inverse=True)
            here = some[missed[place]]
            ids = self._each(tokens, at[here], length[here])
            found[missed] = ids[back]
            slot = slot[missed[place]]
            self.keys[slot], self.ids[slot] = fresh, ids
        out[some] = found
        some = np.flatnonzero((length > SHORT) & (length <= LONG))
        if len(some):
            pair = np.empty((len(some), 2), np.uint64)
            pair[:, 0] = tokens.eights[at[some]]
            pair[:, 1] = tokens.eights[at[some] + SHORT] & _MASKS[length[some] - SHORT]
            slot = ((pair[:, 0] * _MIX ^ pair[:, 1]) * _MIX >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            found, missed = self.pair_ids[slot], np.flatnonzero((self.pairs[slot] != pair).any(axis=1))
            if len(missed):
                found[missed] = ids = self._each(tokens, at[some[missed]], length[some[missed]])
                slot, last = np.unique(slot[missed][::-1], return_index=True)   # one word a slot
                last = len(missed) - 1 - last
                self.pairs[slot], self.pair_ids[slot] = pair[missed[last]], ids[last]
            out[some] = found
        some = np.flatnonzero(length > LONG)
        out[some] = self._each(tokens, at[some], length[some])
        return out


def is_term(word: str, stops: frozenset) -> bool:
    """Whether the word is a token (length as Java counts it: UTF-16 units)."""
    units = len(word) if word.isascii() else len(word.encode("utf-16-le")) // 2
    return units >= MIN_TOKEN_CHARS and word not in stops


class TermSums:
    """Counts of (group, term) over the Arrow batches of a task.

    Words and groups become numbers, so a term is one integer; a batch's integers are
    sorted and counted in numpy.  Words, groups and sums are bounded: beyond that the
    sums so far are handed on and counting starts anew (Spark adds the parts up); the
    numbers of words and groups are kept as long as there are not too many.
    """

    def __init__(self, stop_words: Sequence[str]):
        self.stops = frozenset(stop_words)
        self.parts, self.pending = [], 0
        self._restart()

    def _restart(self) -> None:
        self.words, self.names = WordNumbers(self._word), [""]     # 0 stands for "no second word"
        self.groups, self.values = {}, []

    def _crowded(self) -> bool:
        return max(len(self.words.known), len(self.values)) >= SLICE

    def _word(self, word: str) -> int:
        """The word's number, -1 if it is no token."""
        if not is_term(word, self.stops):
            return -1
        self.names.append(word)
        return len(self.names) - 1

    def add(self, texts: pa.Array, groups: pa.Array | None = None) -> Iterator[tuple]:
        """Counts clean texts (tokens between single spaces; null: no token)."""
        tokens = Tokens(texts)
        own = None if groups is None else groups.dictionary_encode(null_encoding="encode")
        # a slice ends with the first token of the next one, for the pair across the cut;
        # dropped tokens are taken out before pairing, so the last kept token is carried over
        last, last_row = 0, -1
        for start in range(0, len(tokens), SLICE):
            if self._crowded() or self.held() > HELD_KEYS:
                last_name = self.names[last]
                yield from self.flush()
                last = self.words.one(last_name.encode()) if last else 0
            word = self.words.of(tokens, start, start + SLICE)
            good = np.flatnonzero(word >= 0)
            word, rows = word[good], tokens.row[start:start + SLICE][good]
            if not len(word):
                continue
            before = np.concatenate(([last], word[:-1]))
            paired = np.concatenate(([last_row], rows[:-1])) == rows
            keys = word << ID_BITS
            if own is not None:
                group = self._group(own, rows) << 2 * ID_BITS
                keys |= group
                word = word | group
            self._sum(np.concatenate((keys, (before << ID_BITS | word)[paired])))
            last, last_row = int(keys[-1] >> ID_BITS & (1 << ID_BITS) - 1), rows[-1]

    def _group(self, own: pa.DictionaryArray, rows: np.ndarray) -> np.ndarray:
        codes = own.indices.to_numpy()
        numbers = np.zeros(len(own.dictionary), np.int64)
        used = np.unique(codes[rows[0]:rows[-1] + 1])
        for code, value in zip(used.tolist(), own.dictionary.take(pa.array(used)).to_pylist()):
            if value not in self.groups:
                self.groups[value] = len(self.values)
                self.values.append(value)
            numbers[code] = self.groups[value]
        return numbers[codes][rows]

    def _sum(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts))
        self.pending += len(keys)
        if self.pending > 2 * HELD_KEYS:
            self._merge()

    def _merge(self) -> None:
        if len(self.parts) > 1:
            keys = np.concatenate([k for k, _ in self.parts])
            counts = np.concatenate([c for _, c in self.parts])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.parts = [(keys[first], np.add.reduceat(counts, first))]
        self.pending = sum(len(k) for k, _ in self.parts)

    def held(self) -> int:
        return len(self.parts[0][0]) if self.parts else 0

    def flush(self) -> Iterator[tuple]:
        """(group values, terms, counts) of what is held; counting starts anew."""
        self._merge()
        names, values = pa.array(self.names, pa.string()), np.empty(len(self.values), object)
        values[:] = self.values
        mask = (1 << ID_BITS) - 1
        for keys, counts in self.parts:
            for start in range(0, len(keys), SLICE >> 4):
                k = keys[start:start + (SLICE >> 4)]
                first, second = names.take(pa.array(k >> ID_BITS & mask)), names.take(pa.array(k & mask))
                terms = pc.if_else(pa.array(k & mask == 0), first, pc.binary_join_element_wise(first, second, " "))
                yield values[k >> 2 * ID_BITS].tolist() if len(values) else None, terms, counts[start:start + (SLICE >> 4)]
        self.parts, self.pending = [], 0
        if self._crowded():
            self._restart()


class VocabularyCounts:
    """Terms of a vocabulary counted in each text.

    Only the vocabulary's words have numbers above 0, every other token is 0: it parts
    two words but is in no term."""

    def __init__(self, stop_words: Sequence[str], terms: Sequence[str]):
        stops, self.size = frozenset(stop_words), len(terms)
        parts = [t.split(" ") for t in terms]
        numbers = {w: n for n, w in enumerate(dict.fromkeys(w for p in parts for w in p), 1)}
        self.number = lambda word: numbers.get(word, 0) if is_term(word, stops) else -1
        self.words = WordNumbers(self.number)
        self.single = np.full(len(numbers) + 1, -1, np.int64)
        pairs = []
        for index, p in enumerate(parts):
            if len(p) == 1:
                self.single[numbers[p[0]]] = index
            elif len(p) == 2:
                pairs.append((numbers[p[0]] << 32 | numbers[p[1]], index))
        self.pairs = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)

    def add(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(different terms per text, their indices, their counts), a text's indices in order."""
        tokens = Tokens(texts)
        ends = np.cumsum(tokens.per_row)
        found, row, start = [], 0, 0
        while row < len(ends):
            # whole texts, of about SLICE tokens together
            upto = max(row + 1, int(np.searchsorted(ends, start + SLICE, "right")))
            found.append(self._slice(tokens, start, int(ends[upto - 1])))
            row, start = upto, int(ends[upto - 1])
        keys, counts = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        size = max(self.size, 1)
        return np.bincount(keys // size, minlength=len(texts)), (keys % size).astype(np.int32), counts

    def _slice(self, tokens: Tokens, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words.known) >= SLICE:
            self.words = WordNumbers(self.number)
        word = self.words.of(tokens, start, stop)
        good = np.flatnonzero(word >= 0)
        word, row = word[good], tokens.row[start:stop][good] * self.size
        term = self.single[word]
        some = np.flatnonzero(term >= 0)
        keys = [row[some] + term[some]]
        if len(self.pairs) and len(word):
            some = np.flatnonzero((word[:-1] > 0) & (word[1:] > 0) & (row[:-1] == row[1:]))
            pair = word[some] << 32 | word[some + 1]
            place = np.minimum(np.searchsorted(self.pairs[:, 0], pair), len(self.pairs) - 1)
            hit = self.pairs[place, 0] == pair
            keys.append(row[some[hit]] + self.pairs[place[hit], 1])
        return np.unique(np.concatenate(keys), return_counts=True)

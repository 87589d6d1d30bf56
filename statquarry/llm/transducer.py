"""Token counts by finite-state transducers compiled from a tokenizer file.

Two deterministic transducers run one after the other.

* The *splitter* reads classes of characters and marks where pieces begin (letters, single digits, other signs, the
  contractions).  A text is cut into chunks of equal length without regard to pieces.  For every chunk its state map is
  computed (the state after it, for every state before it); the maps are composed by a parallel prefix scan, which gives
  each chunk the state it begins in; then all chunks are read once more, side by side.
* The *counter* reads the bytes of a piece.  A transition carries the number of tokens by which the encoding of the piece
  so far grows (it may shrink: a merge), and a last byte carries the number that is added at the end of a piece, so the sum
  along the path is the number of tokens.  A state stands for all prefixes with the same longest suffix that can begin a
  token and the same last tokens and counts at each place of this suffix: which token ends at a later place depends on
  nothing else, because a pair-merge encoding is valid exactly if all neighbouring tokens are.  Transitions are compiled
  when they are first needed and kept in tables; tables beyond ``MAX_STATES`` are started anew.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from statquarry.llm.arrays import PAD, hash_slices

SPACE, LETTER, NUMBER, OTHER, APOSTROPHE, ONE_LETTER, R, V, L, E = range(10)
FRESH, IN_LETTERS, IN_OTHER, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
CHUNK = 1024
MAX_STATES = 120_000
MAX_KNOWN = 1 << 20


def _splitter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state; whether a piece begins at the character read; whether one begins at the character before it."""
    step = np.zeros((7, 10), np.uint8)
    here = np.zeros((7, 10), bool)
    before = np.zeros((7, 10), bool)
    letters = (LETTER, ONE_LETTER, R, V, L, E)
    for state in range(7):
        for symbol in range(10):
            if symbol == SPACE:
                step[state, symbol], here[state, symbol] = FRESH, False
            elif symbol == NUMBER:
                step[state, symbol], here[state, symbol] = FRESH, True
            elif symbol in letters:
                step[state, symbol], here[state, symbol] = IN_LETTERS, state != IN_LETTERS
            elif symbol == OTHER or state in (IN_OTHER, QUOTE):
                step[state, symbol], here[state, symbol] = IN_OTHER, state not in (IN_OTHER, QUOTE)
            else:
                step[state, symbol], here[state, symbol] = QUOTE, True
        # a quote and one of r, v, l that no contraction follows: the letter begins a piece of its own
        if state in (QUOTE_R, QUOTE_V, QUOTE_L):
            before[state, :] = True
            for symbol in letters:
                here[state, symbol] = False
    for symbol, state in ((R, QUOTE_R), (V, QUOTE_V), (L, QUOTE_L)):
        step[QUOTE, symbol], here[QUOTE, symbol] = state, False
    step[QUOTE, ONE_LETTER], here[QUOTE, ONE_LETTER] = FRESH, False
    for state, symbol in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, L)):
        step[state, symbol], here[state, symbol], before[state, symbol] = FRESH, False, False
    return step, here, before


_STEP, _HERE, _BEFORE = _splitter()


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Which characters begin a piece; the class sequence is read from the state ``FRESH``."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    grid = np.full(chunks * CHUNK, SPACE, np.uint8)
    grid[:n] = classes
    columns = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    flat = _STEP.ravel()
    # state map of each chunk
    maps = np.repeat(np.arange(7, dtype=np.uint8)[:, None], chunks, axis=1)
    for column in columns:
        maps = flat[maps * np.uint8(10) + column]
    # inclusive scan: maps[:, k] becomes the map of chunks 0 to k
    reach = 1
    while reach < chunks:
        later = np.take_along_axis(maps[:, reach:], maps[:, :-reach].astype(np.intp), axis=0)
        maps = np.concatenate([maps[:, :reach], later], axis=1)
        reach *= 2
    state = np.concatenate([[np.uint8(FRESH)], maps[FRESH, :-1]])
    seen = np.empty((CHUNK, chunks), np.uint8)
    for k, column in enumerate(columns):
        seen[k] = state * np.uint8(10) + column
        state = flat[seen[k]]
    seen = seen.T.ravel()
    begins = _HERE.ravel()[seen]
    begins[:-1] |= _BEFORE.ravel()[seen[1:]]
    if chunks * CHUNK == n and flat[seen[-1]] in (QUOTE_R, QUOTE_V, QUOTE_L):
        begins[-1] = True  # the sequence ends where a contraction was still possible
    return begins[:n]


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Specification:
    """What the transducers need of a tokenizer file; made once on the driver and sent to the tasks."""

    def __init__(self, content: str):
        self.content = content
        parsed = json.loads(content)
        self.specials = [t["content"] for t in parsed["added_tokens"]]
        tokenizer = Tokenizer.from_str(content)
        self.classes = self._classes(tokenizer)
        self.lower = self._exceptions(tokenizer, self.classes)

    @staticmethod
    def _classes(tokenizer: Tokenizer) -> bytes:
        """Class of every code point, asked of the tokenizer's own splitter: a c c a in one to four pieces.

        Planes 4 to 13, 15 and 16 hold no letters, numbers or spaces, only unassigned and private places.
        """
        table = np.full(0x110000, OTHER, np.uint8)
        points = [c for c in [*range(0x40000), *range(0xE0000, 0xF0000)] if not 0xD800 <= c < 0xE000]
        for low in range(0, len(points), 1 << 15):
            block = points[low : low + (1 << 15)]
            pieces = tokenizer.pre_tokenizer.pre_tokenize_str("".join(f"a{chr(c)}{chr(c)}a " for c in block))
            count = np.bincount([span[0] // 5 for _, span in pieces], minlength=len(block))
            table[block] = np.array([OTHER, LETTER, SPACE, OTHER, NUMBER], np.uint8)[count]
        for sign, kind in [("'", APOSTROPHE), *((c, ONE_LETTER) for c in "stmd"), ("r", R), ("v", V), ("l", L), ("e", E)]:
            table[ord(sign)] = kind
        return table.tobytes()

    @staticmethod
    def _exceptions(tokenizer: Tokenizer, classes: bytes) -> dict[int, str]:
        """Characters that the tokenizer's normaliser turns into something else than Python's lower case does."""
        found = {}
        for low in range(0x80, 0x40000, 1 << 12):
            block = [c for c in range(low, low + (1 << 12)) if not 0xD800 <= c < 0xE000]
            block = [c for c in block if classes[c] == LETTER]
            for c in block:
                wanted = tokenizer.normalizer.normalize_str(chr(c))
                if wanted != unicodedata.normalize("NFC", chr(c)).lower():
                    found[c] = wanted
        found[ord("Σ")] = "σ"  # one character at a time: no final form
        return found


class Counter:
    """The transducer that counts the tokens of pieces, compiled as it is needed."""

    def __init__(self, content: str):
        model = json.loads(content)["model"]
        byte = _byte_of()
        suffix = model["end_of_word_suffix"]
        self.rank = {}
        for number, (a, b) in enumerate(model["merges"]):
            self.rank[self._symbol(a, byte, suffix), self._symbol(b, byte, suffix)] = number
        special = {token["content"] for token in json.loads(content)["added_tokens"]}
        self.tokens = {self._symbol(token, byte, suffix) for token in model["vocab"] if token not in special}
        self.prefixes = {body[:k] for body, _ in self.tokens for k in range(len(body))}
        self.reset()

    @staticmethod
    def _symbol(token: str, byte: dict[str, int], suffix: str) -> tuple[bytes, bool]:
        last = token.endswith(suffix)
        return bytes(byte[c] for c in (token[: -len(suffix)] if last else token)), last

    def reset(self) -> None:
        self.column = np.full(256, -1, np.int64)
        self.width = 0
        self.next = np.full((256, 64), -1, np.int32)
        self.grow = np.zeros((256, 64), np.int8)
        self.end = np.full((256, 64), -128, np.int8)
        # a state: the longest suffix that can begin a token, and each place in it from which a token can go on, with the
        # last token there and the number of tokens less than now
        self.states: list[tuple[bytes, tuple]] = []
        self.known: dict[tuple, int] = {}
        self.fitting: dict[tuple, bool] = {}
        self._state((b"", ((0, None, 0),)))

    def _state(self, key: tuple[bytes, tuple]) -> int:
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.states)
            self.states.append(key)
            if number == len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.grow = np.concatenate([self.grow, np.zeros_like(self.grow)])
                self.end = np.concatenate([self.end, np.full_like(self.end, -128)])
        return number

    def _merged(self, symbols: list[tuple[bytes, bool]]) -> list[tuple[bytes, bool]]:
        rank = self.rank
        while len(symbols) > 1:
            best = min((rank.get(pair, 1 << 30) for pair in zip(symbols, symbols[1:])))
            if best == 1 << 30:
                break
            out, k = [], 0
            while k < len(symbols):
                if k + 1 < len(symbols) and rank.get((symbols[k], symbols[k + 1]), -1) == best:
                    out.append((symbols[k][0] + symbols[k + 1][0], symbols[k + 1][1]))
                    k += 2
                else:
                    out.append(symbols[k])
                    k += 1
            symbols = out
        return symbols

    def compile(self, state: int, symbol: int) -> None:
        """Both transitions of a state on a byte: as a middle byte and as the last one."""
        if self.column[symbol] < 0:
            self.column[symbol] = self.width
            self.width += 1
            if self.width > self.next.shape[1]:
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)], axis=1)
                self.grow = np.concatenate([self.grow, np.zeros_like(self.grow)], axis=1)
                self.end = np.concatenate([self.end, np.full_like(self.end, -128)], axis=1)
        tail, places = self.states[state]
        grown = tail + bytes([symbol])
        token, grow = self._ending(grown, places, False)
        now = [(k, last, less - grow) for k, last, less in places if grown[k:] in self.prefixes]
        now.append((len(grown), token, 0))
        base = now[0][0]
        to = self._state((grown[base:], tuple((k - base, last, less) for k, last, less in now)))
        at = self.column[symbol]
        self.next[state, at] = to
        self.grow[state, at] = grow
        self.end[state, at] = self._ending(grown, places, True)[1]

    def _ending(self, grown: bytes, places: tuple, final: bool) -> tuple[bytes, int]:
        """The token that ends a prefix, and the growth of the count: the one that fits the last token before it."""
        for k, last, less in places:
            token = (grown[k:], final)
            if token in self.tokens and self._fits(last, token):
                return token[0], less + 1
        raise ValueError("the vocabulary lacks a single byte")

    def _fits(self, last: bytes | None, token: tuple[bytes, bool]) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together (or a first token stays whole)."""
        known = self.fitting.get((last, token))
        if known is None:
            body, final = token
            symbols = [(bytes([b]), False) for b in (last or b"") + body]
            symbols[-1] = (symbols[-1][0], final)
            known = self._merged(symbols) == ([token] if last is None else [(last, False), token])
            self.fitting[last, token] = known
        return known

    def count(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of every piece ``buf[start:end]``; all pieces are read side by side."""
        if len(self.states) > MAX_STATES:
            self.reset()
        total = np.zeros(len(start), np.int64)
        pieces, state, at = np.arange(len(start)), np.zeros(len(start), np.int64), start.copy()
        while len(pieces):
            symbol = buf[at]
            column = self.column[symbol]
            fresh = (column < 0) | (self.next[state, column] < 0)
            if fresh.any():
                for pair in np.unique(state[fresh] << 8 | symbol[fresh]).tolist():
                    self.compile(pair >> 8, pair & 255)
                column = self.column[symbol]
            at += 1
            last = at == end[pieces]
            ended = pieces[last]
            total[ended] += self.end[state[last], column[last]]
            more = ~last
            pieces, state, column, at = pieces[more], state[more], column[more], at[more]
            total[pieces] += self.grow[state, column]
            state = self.next[state, column].astype(np.int64)
        return total


class Memo:
    """Whole numbers under 64-bit names, in a large and a small sorted array; emptied when it is full."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.tiers = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of sorted names, and which of them are known."""
        values, known = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        for keys, held in self.tiers:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, names), len(keys) - 1)
                hit = keys[at] == names
                values[hit], known = held[at[hit]], known | hit
        return values, known

    def add(self, names: np.ndarray, values: np.ndarray) -> None:
        (large, of_large), (small, of_small) = self.tiers
        small, of_small = np.concatenate([small, names]), np.concatenate([of_small, values])
        order = np.argsort(small)
        small, of_small = small[order], of_small[order]
        if len(small) > 1 << 16:
            large, of_large = np.concatenate([large, small]), np.concatenate([of_large, of_small])
            order = np.argsort(large)
            large, of_large = large[order], of_large[order]
            small, of_small = small[:0], of_small[:0]
        self.tiers = [(large, of_large), (small, of_small)]

    def __len__(self) -> int:
        return sum(len(keys) for keys, _ in self.tiers)


class Pieces:
    """Normalises texts and cuts them into the pieces that are encoded one by one."""

    def __init__(self, specification: Specification):
        self.classes = np.frombuffer(specification.classes, np.uint8)
        self.lower = specification.lower
        self.special = re.compile("|".join(map(re.escape, sorted(specification.specials, key=len, reverse=True))))
        self.odd = re.compile("[" + re.escape("".join(map(chr, self.lower))) + "]")

    def normalised(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if self.odd.search(text):
            text = "".join(self.lower[ord(c)] if ord(c) in self.lower else c.lower() for c in text)
        return text.lower()

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Padded UTF-8 bytes of the normalised texts; start, end and text number of every piece."""
        parts = list(map(self.normalised, texts))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        joined = "\n".join([*parts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        buf = np.frombuffer(joined.encode("utf-8", "surrogatepass") + bytes(PAD), np.uint8)
        classes = self.classes[points]
        begins = piece_starts(classes)
        # a piece ends where the next begins or at a space
        mark = np.flatnonzero(begins | (classes == SPACE))
        edge = np.append(mark, len(points))
        keep = begins[mark]
        at, stop = edge[:-1][keep], edge[1:][keep]
        if len(buf) == len(points) + PAD:
            start, end = at, stop
        else:
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            offset = np.append(0, np.cumsum(width))
            start, end = offset[at], offset[stop]
        doc = np.searchsorted(np.cumsum(sizes), at, side="right")
        return buf, start, end, doc


def different(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the different pieces, the first place of each, and the number of every piece among them."""
    return np.unique(hash_slices(buf, start, end), return_index=True, return_inverse=True)


class TokenCounts:
    """Counts tokens of whole texts as the tokenizer of a file does, without begin and end tokens.

    Each different piece is read by the counter once, as long as its 64-bit hash stays in the memo.
    """

    def __init__(self, specification: Specification):
        self.pieces = Pieces(specification)
        self.counter = Counter(specification.content)
        self.memo = Memo()

    def counts(self, texts: list[str | None]) -> np.ndarray:
        specials = np.zeros(len(texts), np.int64)
        plain = []
        for k, text in enumerate(texts):
            if text and "<|" in text:
                parts = self.pieces.special.split(text)
                specials[k] = len(parts) - 1
                text = "\n".join(parts)  # a special token parts pieces, as a line end does
            plain.append(text or "")
        buf, start, end, doc = self.pieces.of(plain)
        names, place, which = different(buf, start, end)
        if len(self.memo) > MAX_KNOWN:
            self.memo.clear()
        values, known = self.memo.find(names)
        fresh = np.flatnonzero(~known)
        values[fresh] = self.counter.count(buf, start[place[fresh]], end[place[fresh]])
        self.memo.add(names[fresh], values[fresh])
        return specials + np.bincount(doc, weights=values[which], minlength=len(texts)).astype(np.int64)

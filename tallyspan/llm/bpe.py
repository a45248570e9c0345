"""Byte-level BPE over whole slices of text, exact to the tokenizers library.

The pre-tokenizer's split depends on character classes only, so it is found by array operations;
each distinct piece is encoded once by the library and its ids are kept in a bounded cache of the
worker process. New pieces go to the library some hundred at a time, a line feed between each two:
it is always a piece of its own before something that is no white space, so the ids between two line feeds
are those of one piece. Pieces are found in the cache by hash and then compared byte for byte, and a piece's
ids are decoded when it is learnt. Texts with characters outside the checked range, or with the text of a
special token, go to the library whole, and so does any text with a piece that fails one of the comparisons.
"""

from __future__ import annotations

import functools
import os
import unicodedata

import numpy as np

from tallyspan.llm.arrays import Hasher

#: Pieces kept by one worker process before it starts afresh (about 50 bytes each).
CACHE_PIECES = 600_000
#: New pieces that the library gets as one text.
JOINED = 200

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def _classes() -> np.ndarray:
    """Class of each code point under U+2070; all others count as unknown."""
    kinds = np.full(1 << 16, UNKNOWN, np.uint8)
    for c in range(0x2070):
        category = unicodedata.category(chr(c))
        if category == "Cn":
            continue
        kinds[c] = {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)
    # White_Space of the Unicode character database, below U+2070 (fixed values).
    white = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680]
    white += [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]
    kinds[white] = SPACE
    return kinds


def _code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first bytes of the characters, and their code points (0xFFFF if long)."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at].astype(np.int32)
    points = lead.copy()
    for low, high, keep, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2)):
        which = np.flatnonzero((lead >= low) & (lead < high))
        value = lead[which] & keep
        for k in range(1, more + 1):
            value = (value << 6) | (buf[np.minimum(at[which] + k, len(buf) - 1)] & 0x3F)
        points[which] = value
    points[lead >= 0xF0] = 0xFFFF
    return at, points


def pieces(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the pre-tokenizer's pieces, and which texts hold unknown characters.

    Contractions, then letters, numbers and other characters each with one space before, then white
    space, whose last character is left to what follows it.
    """
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, bool)
    at, points = _code_points(buf)
    n = len(at)
    kind = _classes()[points]
    bounds = np.searchsorted(at, offsets)  # in characters
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    unknown = np.zeros(len(offsets) - 1, bool)
    if (odd := np.flatnonzero(kind == UNKNOWN)).size:
        unknown[np.searchsorted(bounds, odd, "right") - 1] = True
    before, here = kind[:-1], kind[1:]
    start = np.ones(n, bool)
    # a class change starts a piece, unless one plain space stands before
    start[1:] = (before != here) & ~((before == SPACE) & (points[:-1] == 32))
    # the last of some white space starts a piece, if more follows within the text
    last = np.zeros(n, bool)
    last[:-1] = (before == SPACE) & (here != SPACE) & ~first[1:-1]
    start |= last
    start |= first[:-1]
    # contractions (fixed values): an apostrophe that begins a piece, then s, t, m or d, or re, ve or ll
    quote = np.flatnonzero(points == 39)
    if quote.size:
        prior = np.maximum(quote - 1, 0)
        free = first[quote] | ((kind[prior] != OTHER) & (points[prior] != 32))
        quote = quote[free]
        padded = np.concatenate((points, [0, 0]))
        one, two = padded[quote + 1], padded[quote + 2]
        same1 = ~first[np.minimum(quote + 1, n)]
        same2 = same1 & ~first[np.minimum(quote + 2, n)]
        short = same1 & np.isin(one, [ord(c) for c in "stmd"])
        long = same2 & (
            ((one == ord("r")) & (two == ord("e")))
            | ((one == ord("v")) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l")))
        )
        start[quote[short] + 1] = False
        start[quote[long] + 1] = False
        after = np.concatenate((quote[short] + 2, quote[long] + 3))
        start[after[after < n]] = True
    return at[np.flatnonzero(start)], unknown


class Codec:
    """One vocabulary file, with the ids of the pieces met so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.token_bytes = _token_bytes(self.tokenizer)
        self.decimals = [str(i) for i in range(len(self.token_bytes))]
        self.line_feed = self.token_bytes.index(b"\n") if b"\n" in self.token_bytes else -1
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros((0, 4), np.int64)
        # Sorted hashes of pieces, and for each the place and number of its ids, and of its bytes. What was learnt
        # lately stands apart, so that learning little does not move much.
        self._old, self._new = none, none
        self._ids, self._bytes = _Growing(np.uint32), _Growing(np.uint8)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each piece, and which pieces they do not decode to."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        order = [k for k, t in enumerate(texts) if not t.isspace()]
        alone = [k for k, t in enumerate(texts) if t.isspace()]
        found: list[np.ndarray | None] = [None] * len(pieces)
        wrong = np.zeros(len(pieces), bool)
        groups = [order[k : k + JOINED] for k in range(0, len(order), JOINED)]
        made = self.tokenizer.encode_batch_fast(["\n".join([texts[k] for k in g]) for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, made, strict=True):
            ids = np.array(encoded.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.line_feed)
            if len(cuts) != len(group) - 1 or self.decode(encoded.ids) != b"\n".join([pieces[k] for k in group]):
                alone += group
                continue
            begins = np.concatenate(([0], cuts + 1)).tolist()
            for k, a, b in zip(group, begins, [*cuts.tolist(), len(ids)], strict=True):
                found[k] = ids[a:b]
        for k, encoded in zip(alone, self.tokenizer.encode_batch_fast([texts[k] for k in alone], add_special_tokens=False), strict=True):
            found[k] = np.array(encoded.ids, np.uint32)
            wrong[k] = self.decode(encoded.ids) != pieces[k]
        return found, wrong

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """``keys`` are sorted and not known yet."""
        found, wrong = self._encode_pieces(pieces)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rows = np.empty((len(keys), 4), np.int64)
        rows[:, 0] = self._ids.add(np.concatenate(found)) + np.cumsum(counts) - counts
        rows[:, 1] = counts
        rows[:, 2] = self._bytes.add(np.frombuffer(b"".join(pieces), np.uint8)) + np.cumsum(sizes) - sizes
        # a size that no piece has, for a piece that is not to be found equal to any
        rows[:, 3] = np.where(wrong, -1, sizes)
        self._new = _merged(self._new, (keys, rows))
        if len(self._new[0]) * 4 > len(self._old[0]):
            self._old, self._new = _merged(self._old, self._new), (self._new[0][:0], self._new[1][:0])

    def _lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cache's rows of the keys, and which of them there are."""
        rows, known = np.zeros((len(keys), 4), np.int64), np.zeros(len(keys), bool)
        for have, stored in (self._old, self._new):
            if len(have):
                at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                here = have[at] == keys
                rows[here] = stored[at[here]]
                known |= here
        return rows, known

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> Encoded:
        starts, odd = pieces(buf, offsets)
        raw = buf.tobytes()
        for special in self.specials:
            if raw.find(special) >= 0:
                for d in range(len(offsets) - 1):
                    odd[d] |= raw.find(special, offsets[d], offsets[d + 1]) >= 0
        if not len(starts):
            return Encoded(self, buf, offsets, starts, np.zeros(1, np.int64), np.zeros(0, np.uint32), odd)
        ends = np.append(starts[1:], len(buf))
        distinct, sample, which = np.unique(Hasher(buf).spans(starts, ends), return_index=True, return_inverse=True)
        rows, known = self._lookup(distinct)
        if not known.all():
            if len(self._old[0]) + len(self._new[0]) + int((~known).sum()) > CACHE_PIECES:
                self.clear()
                known[:] = False
            new = np.flatnonzero(~known)
            bounds = zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)
            self._learn(distinct[new], [raw[s:e] for s, e in bounds])
            rows, _ = self._lookup(distinct)
        places, counts, at, sizes = rows[which].T
        token_ends = np.cumsum(counts)
        pick = np.arange(int(token_ends[-1])) + np.repeat(places - (token_ends - counts), counts)
        # every piece is the stored one, byte for byte
        lengths = ends - starts
        same = sizes == lengths
        source = np.repeat(np.where(same, at, 0) - starts, lengths) + np.arange(len(buf))
        stored = self._bytes.taken(np.minimum(source, self._bytes.size - 1) if not same.all() else source)
        if not same.all() or not np.array_equal(stored, buf):
            differs = np.add.reduceat((stored != buf).astype(np.int32), starts) > 0
            wrong = starts[differs | ~same]
            odd[np.searchsorted(offsets, wrong, "right") - 1] = True
        return Encoded(self, buf, offsets, starts, np.concatenate(([0], token_ends)), self._ids.taken(pick), odd)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


class Encoded:
    """Ids of a slice of texts. ``starts`` and ``tokens`` give the byte and token start of pieces."""

    def __init__(self, codec, buf, offsets, starts, tokens, flat, odd):
        self.codec, self.buf, self.offsets = codec, buf, offsets
        self.starts, self.tokens, self.flat, self.odd = starts, tokens, flat, odd
        self.first = np.searchsorted(starts, offsets)

    def text(self, d: int) -> bytes:
        return self.buf[self.offsets[d] : self.offsets[d + 1]].tobytes()

    def array(self, d: int) -> np.ndarray:
        """Ids of one text."""
        if self.odd[d]:
            return self.codec.whole(self.text(d).decode("utf-8", "replace"))
        return self.flat[self.tokens[self.first[d]] : self.tokens[self.first[d + 1]]]

    def ids(self, d: int) -> tuple[list[int], bytes]:
        """Ids of one text, and the bytes they decode to."""
        ids = self.array(d).tolist()
        return ids, decoded(self.codec, ids) if self.odd[d] else self.text(d)


class _Growing:
    """An array that is added to, with room for more than it holds."""

    def __init__(self, kind):
        self._values, self.size = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> int:
        """Where the values begin."""
        begin, self.size = self.size, self.size + len(values)
        if self.size > len(self._values):
            room = np.empty(max(self.size, len(self._values) * 3 // 2), self._values.dtype)
            room[:begin] = self._values[:begin]
            self._values = room
        self._values[begin : self.size] = values
        return begin

    def taken(self, at: np.ndarray) -> np.ndarray:
        return self._values[at]


def _merged(a: tuple, b: tuple) -> tuple:
    """Two tables of sorted keys and their rows as one."""
    at = np.searchsorted(a[0], b[0])
    return np.insert(a[0], at, b[0]), np.insert(a[1], at, b[1], axis=0)


def decoded(codec: Codec, ids: list[int]) -> bytes:
    """As the library's decode, which replaces what isn't UTF-8."""
    return codec.decode(ids).decode("utf-8", "replace").encode()


def _token_bytes(tokenizer) -> list[bytes]:
    """The bytes each id stands for: byte-level vocabularies write each byte as one character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    back |= {chr(256 + k): b for k, b in enumerate(rest)}
    vocabulary = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    out = []
    for i in range(max(vocabulary) + 1):
        token = vocabulary.get(i, "")
        known = all(c in back for c in token)
        out.append(bytes(back[c] for c in token) if known else token.encode())
    return out


@functools.cache
def codec(path: str) -> Codec:
    """The worker process's codec for a vocabulary file."""
    return Codec(path)

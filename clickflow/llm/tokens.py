"""Whole texts to token ids, with the installed ``tokenizers`` library.

Byte-level BPE cuts a text before every single space that stands between two
visible characters, and between letters, digits, other visible characters and a single
line end (but not between an apostrophe and a letter), so the pieces between such places
can be encoded alone and in any order: each distinct piece is encoded once by the library
and its ids are copied to every place where it stands. Pieces that are not cached yet are
strung together to one text for the library, for the same reason, with a line end behind
those that don't begin with a space; the bytes of each token tell which ids belong to
which piece. The cache is a direct-mapped table of bounded size; a piece that has lost its
place is encoded again. The table holds numbers of entries, and only pieces that were met
have entries, so a worker that Spark keeps beside the heap holds little more than what it met.
"""

from __future__ import annotations

import os

import numpy as np

from .common import chunks, span_hashes

#: Bytes of text by pass.
PASS_BYTES = 1 << 20
#: Bytes of new pieces in one text for the library, whose results take many times its size.
RUN_BYTES = 1 << 16

#: Slots of the piece cache; its id pool starts anew beyond POOL ids.
SLOT_BITS, POOL = 22, 12_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _solid() -> np.ndarray:
    """By byte: an ASCII character that is seen, or the lead of a two-byte character that is no space."""
    t = np.zeros(256, bool)
    t[0x21:0x7F] = True
    t[0xC3:0xE0] = True
    return t


def _kinds() -> np.ndarray:
    """By byte: LETTER (ASCII, or the lead of U+00C0 to U+023F), DIGIT, MARK (other ASCII that is seen), LINE, or 0."""
    t = np.zeros(256, np.uint8)
    t[0x21:0x7F] = MARK
    t[0x30:0x3A] = DIGIT
    t[0x41:0x5B] = t[0x61:0x7B] = t[0xC3:0xC9] = LETTER
    t[0x0A] = LINE
    return t


LETTER, DIGIT, MARK, LINE = 1, 2, 3, 4


class Encoder:
    """ids(buf, off) -> (ids of all rows as uint32, offsets by row)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True  # their strings in a text are ordinary text
        self.bytes = np.zeros(self.lib.get_vocab_size(), np.int64)
        for token, i in self.lib.get_vocab().items():  # byte-level: a character of a token is a byte
            self.bytes[i] = len(token)
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)  # entry, 0: none
        self.entries = np.zeros((1 << 12, 2), np.uint64)  # hash; place in the pool << 16 | ids
        self.taken = 1
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.after, self.kinds = _solid(), _kinds()
        if hasattr(self.lib.model, "_resize_cache"):
            self.lib.model._resize_cache(0)  # each piece comes once

    def _pieces(self, buf, off):
        """By piece: first byte, length, whether it can be encoded in one text with others, whether a line end parts it
        from them there."""
        n = len(buf)
        kind = self.kinds[buf]
        lead = ((buf[:-1] >= 0xC3) & (buf[:-1] < 0xC9)).nonzero()[0]
        kind[lead + 1] = LETTER
        sign = lead[(buf[lead] == 0xC3) & ((buf[lead + 1] == 0x97) | (buf[lead + 1] == 0xB7))]  # U+00D7, U+00F7
        kind[sign] = kind[sign + 1] = 0
        edge = off[(off > 0) & (off < n)]
        known = kind != 0
        # a line end by itself: what stands before it is known, and so is what follows (a space is looked at below)
        line = kind == LINE
        one = line.copy()
        one[0] = False
        one[1:] &= known[:-1] & ~line[:-1]
        one[edge] = False
        start = np.zeros(n, bool)
        start[1:] = (kind[1:] != kind[:-1]) & known[1:] & known[:-1] & (~line[:-1] | one[:-1])
        quote = (buf[:-1] == 0x27).nonzero()[0]  # 's and the like
        start[quote[kind[quote + 1] == LETTER] + 1] = False
        prev_ok = np.zeros(n, bool)
        prev_ok[1:] = (buf[:-1] >= 0x21) & (buf[:-1] < 0x7F) | one[:-1]
        # the end of a two-byte character whose lead is C3 to DF
        prev_ok[2:] |= (buf[1:-1] >= 0x80) & (buf[1:-1] < 0xC0) & (buf[:-2] >= 0xC3) & (buf[:-2] < 0xE0)
        next_ok = np.zeros(n, bool)
        next_ok[:-1] = self.after[buf[1:]]
        space = buf == 0x20
        # neighbours have to be of the same row
        space[edge - 1] = False
        start |= space & prev_ok & next_ok
        cut = off[:-1][off[:-1] < off[1:]]
        start[cut] = True
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, n))
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        begin, end = kind[first], kind[first + size - 1]
        parted = (begin != 0) & (begin != LINE) & (end != 0) & (end != LINE)
        inner = parted | (buf[first] == 0x20) & ~(edge[first] | edge[first + size])
        return first, size, inner, parted

    def _encode(self, buf, first, size, inner, parted):
        """ids and their numbers by piece: ``inner`` pieces in texts of about ``RUN_BYTES``, a line end behind each that
        is ``parted``; the others alone."""
        a, b = np.concatenate((np.flatnonzero(parted), np.flatnonzero(inner & ~parted))), np.flatnonzero(~inner)
        counts, where = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        parts, n = [], 0
        for x, y in chunks(np.concatenate(([0], np.cumsum(size[a] + parted[a]))), RUN_BYTES):
            at = a[x:y]
            ids, here = self._strung(buf, first[at], size[at], parted[at])
            counts[at] = np.diff(here, prepend=0)
            where[at] = n + here - counts[at]
            counts[at] -= parted[at]
            parts.append(ids)
            n += len(ids)
        flat, count = self._alone(buf, first[b], size[b])
        counts[b], where[b] = count, n + np.cumsum(count) - count
        return np.concatenate((*parts, flat)), where, counts

    def _strung(self, buf, first, size, parted):
        """ids of the pieces in one text, those that are ``parted`` first, and where each piece's ids end."""
        mark = parted.astype(np.int64)
        ends = np.cumsum(size + mark)
        at = np.arange(int(ends[-1])) + np.repeat(first - (ends - size - mark), size + mark)
        marks = ends[: int(mark.sum())] - 1
        at[marks] = 0
        run = buf[at]
        run[marks] = 0x0A
        ids = np.array(self.lib.encode_batch_fast([run.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
        return ids, np.searchsorted(np.cumsum(self.bytes[ids]), ends, "left") + 1

    def _alone(self, buf, first, size):
        texts = [buf[a: a + n].tobytes().decode("utf-8", "replace") for a, n in zip(first.tolist(), size.tolist())]
        out = [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter((i for ids in out for i in ids), np.uint32, int(count.sum()))
        return flat, count

    def _chunk(self, buf, off):
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        first, size, inner, parted = self._pieces(buf, off)
        h = span_hashes(buf, first, size)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        h |= np.uint64(1)
        held = self.entries[self.slots[slot]]
        miss = np.flatnonzero(held[:, 0] != h)
        held = held[:, 1].astype(np.int64)
        length = (held & 0xFFFF).astype(np.int32)
        begin = (held >> 16).astype(np.int32)
        if len(miss):
            _, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[one]
            flat, where, count = self._encode(buf, first[at], size[at], inner[at], parted[at])
            if self.used + len(flat) > POOL and self.used:
                self.slots[:] = 0
                self.used, self.taken = 0, 1
                return self._chunk(buf, off)
            if self.used + len(flat) > len(self.pool):
                grown = np.zeros(max(2 * len(self.pool), self.used + len(flat)), np.uint32)
                grown[: self.used] = self.pool[: self.used]
                self.pool = grown
            where += self.used
            self.pool[self.used: self.used + len(flat)] = flat
            self.used += len(flat)
            begin[miss], length[miss] = where[back], count[back]
            keep = count < 1 << 16
            at, where, count = at[keep], where[keep], count[keep]
            self._hold(slot[at], h[at], (where << 16 | count).astype(np.uint64))
        ends = np.cumsum(length)
        total = int(ends[-1])
        ids = self.pool[np.arange(total, dtype=np.int32) + np.repeat(begin - (ends - length).astype(np.int32), length)]
        return ids, np.diff(np.append(0, ends)[np.searchsorted(first, off)])

    def _hold(self, slot, h, place):
        """Entries for the pieces, in place of those that have their slots."""
        fresh = np.unique(slot[self.slots[slot] == 0])
        self.slots[fresh] = np.arange(self.taken, self.taken + len(fresh))
        self.taken += len(fresh)
        if self.taken > len(self.entries):
            grown = np.zeros((max(self.taken, len(self.entries) * 3 // 2), 2), np.uint64)
            grown[: len(self.entries)] = self.entries
            self.entries = grown
        entry = self.slots[slot]
        _, last = np.unique(entry[::-1], return_index=True)  # of pieces with one slot the last
        last = len(entry) - 1 - last
        self.entries[entry[last], 0], self.entries[entry[last], 1] = h[last], place[last]

    def ids(self, buf, off):
        parts, counts = [], []
        for a, b in chunks(off, PASS_BYTES):
            ids, n = self._chunk(buf[off[a]: off[b]], off[a: b + 1] - off[a])
            parts.append(ids)
            counts.append(n)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        per_row = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return flat, np.concatenate(([0], np.cumsum(per_row)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]

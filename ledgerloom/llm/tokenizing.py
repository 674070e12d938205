"""Whole-text encoding with a public tokenizer file, many texts at a time.

Texts are cut only where the file's own pre-tokenizer always cuts, so the ids
of the pieces, joined, are the ids of the text. The pieces of a run of texts
have 64-bit codes, which are looked up in a table of bounded size, all at once
in numpy, and the ids are gathered. A code only says where to look: the table
holds the bytes of its pieces (of long ones a SHA-256), and a piece that finds
another one under its code goes on to its next code. A piece that the table
lacks is encoded by the tokenizers library: plain Latin-1 words go straight to
its BPE model, everything else through its full `encode`.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np

from .common import ASCII_LOWER, ASCII_SPACES
from .wordcode import FIRST_BYTES, chunks, mixed, piece_codes

#: Pieces and ids that a table keeps from one run of texts to the next; a fuller one is begun anew.
PIECES, POOL = 450_000, 3_000_000
#: Bytes of texts that are looked up at once: what is worked with meanwhile takes some hundred times as much.
RUN_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[list(ASCII_SPACES)] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Printable ASCII, and the first bytes of two-byte characters from U+00C0: none of these begins white space.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = _VISIBLE[0xC3:0xE0] = True


#: Longer pieces are told apart by their SHA-256.
_LONG = 64


def short_keys(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Where the bytes stand that tell each piece from all others of its size: a digest behind `data` for long ones, else the piece itself."""
    long = np.flatnonzero(sizes > _LONG)
    if not len(long):
        return data, starts, sizes
    digests = [hashlib.sha256(data[a : a + n]).digest() for a, n in zip(starts[long].tolist(), sizes[long].tolist(), strict=True)]
    at, width = starts.copy(), sizes.copy()
    at[long], width[long] = len(data) + 32 * np.arange(len(long)), 32
    return data + b"".join(digests), at, width


def _eights(data) -> np.ndarray:
    """Eight bytes from each place of `data` but its last eight."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


class PieceTable:
    """Ids of pieces by their codes: open addressing with linear probing, one pool that holds the ids, and one of the pieces' keys."""

    def __init__(self, bits: int = 16):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.codes = np.zeros(1 << self.bits, np.uint64)
        self.first = np.zeros(1 << self.bits, np.int32)
        self.size = np.full(1 << self.bits, -1, np.int32)  # -1: an empty slot
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = self.held = 0
        self.length = np.zeros(1 << self.bits, np.int32)  # of the piece
        self.key_at = np.zeros(1 << self.bits, np.int32)
        self.keys = np.zeros(1 << 20, np.uint8)
        self.keyed = 0

    def others(self, slots: np.ndarray, data: bytes, at: np.ndarray, width: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces that are not those which their slots hold. `at`, `width`: their keys in `data`, which ends in eight bytes more."""
        mine, held = _eights(data), _eights(self.keys)
        wrong = self.length[slots] != sizes
        left, here, there, size = np.flatnonzero(~wrong), at, self.key_at[slots], width
        here, there, size = here[left], there[left], size[left]
        while len(left):
            differ = ((mine[here] ^ held[there]) & FIRST_BYTES[np.minimum(size, 8)]) != 0
            wrong[left[differ]] = True
            more = np.flatnonzero(size > 8)
            left, here, there, size = left[more], here[more] + 8, there[more] + 8, size[more] - 8
        return np.flatnonzero(wrong)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The slot of each code, -1 where it is not held."""
        mask = np.uint64(len(self.codes) - 1)
        slots = (codes & mask).astype(np.int64)
        found = np.where((self.codes[slots] == codes) & (self.size[slots] >= 0), slots, -1)
        left = np.flatnonzero((found < 0) & (self.size[slots] >= 0))
        while len(left):
            slots[left] = (slots[left] + 1) & int(mask)
            here = slots[left]
            taken = self.size[here] >= 0
            hit = taken & (self.codes[here] == codes[left])
            found[left[hit]] = here[hit]
            left = left[taken & ~hit]
        return found

    def add(self, codes: np.ndarray, ids: list[int], counts: list[int], keys: list[bytes], lengths: np.ndarray) -> None:
        """New, all different codes; `ids` are those of all of them, one after another; `keys` and `lengths` are the pieces'."""
        sizes = np.array(counts, np.int32)
        joined = np.frombuffer(b"".join(keys), np.uint8)
        if self.keyed + len(joined) + 8 > len(self.keys):
            self.keys = np.concatenate([self.keys[: self.keyed], np.zeros(self.keyed // 4 + 2 * len(joined) + 8, np.uint8)])
        self.keys[self.keyed : self.keyed + len(joined)] = joined
        widths = np.fromiter(map(len, keys), np.int64, len(keys))
        key_at = self.keyed + np.cumsum(widths) - widths
        self.keyed += len(joined)
        if 2 * (self.held + len(codes)) > len(self.codes):
            old = np.flatnonzero(self.size >= 0)
            kept = self.codes[old], self.first[old], self.size[old], self.length[old], self.key_at[old]
            width = 1 << (2 * (self.held + len(codes))).bit_length()
            self.codes, self.first, self.size = np.zeros(width, np.uint64), np.zeros(width, np.int32), np.full(width, -1, np.int32)
            self.length, self.key_at = np.zeros(width, np.int32), np.zeros(width, np.int32)
            self._place(*kept)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used // 4 + 2 * len(ids), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self._place(codes, (self.used + np.cumsum(sizes) - sizes).astype(np.int32), sizes, lengths, key_at)
        self.used += len(ids)
        self.held += len(codes)

    def _place(self, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, key_at: np.ndarray) -> None:
        mask = len(self.codes) - 1
        slots, left = (codes & np.uint64(mask)).astype(np.int64), np.arange(len(codes))
        while len(left):
            free = left[self.size[slots[left]] < 0]
            self.first[slots[free]] = free  # of several that want a slot, the last one stays
            won = free[self.first[slots[free]] == free]
            self.codes[slots[won]], self.size[slots[won]], self.first[slots[won]] = codes[won], sizes[won], first[won]
            self.length[slots[won]], self.key_at[slots[won]] = lengths[won], key_at[won]
            lost = np.ones(len(codes), bool)
            lost[won] = False
            left = left[lost[left]]
            slots[left] = (slots[left] + 1) & mask


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class TextEncoder:
    """Ids of whole texts by the tokenizer of one file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        pre, normal = spec["pre_tokenizer"] or {}, json.dumps(spec["normalizer"])
        #: White space stays, a single space as part of the word after it.
        self.led = pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not pre.get("add_prefix_space") and spec["normalizer"] is None
        #: White space is dropped and letters are lower-cased.
        self.dropped = '"Lowercase"' in normal and '"Replace"' in normal and pre.get("type") == "Sequence" and pre["pretokenizers"][0].get("invert") is True and bool(spec["model"].get("end_of_word_suffix"))
        self.letters = dict(enumerate(_byte_letters()))
        self.table = PieceTable()

    def _piece(self, piece: bytes) -> list[int]:
        word = piece[1:] if self.led and piece[:1] == b" " else piece
        if word.isalpha():  # of ASCII letters
            return [t.id for t in self.model.tokenize(("\u0120" if len(word) < len(piece) else "") + word.decode())]
        text = piece.decode("utf-8", "surrogatepass")
        bare = text[1:] if self.led and text[:1] == " " else text
        if bare.isalpha() and max(bare) <= "\xff" and (self.led or bare.islower() or bare.isascii()):
            return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.letters))]
        if self.dropped and not piece.strip(ASCII_SPACES):
            return []
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _cuts(self, raw: np.ndarray) -> np.ndarray:
        """Whether a piece may begin at each byte."""
        before, after = np.roll(raw, 1), np.roll(raw, -1)
        wide = (np.roll(raw, 2) == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)  # the byte before ends a Latin-1 letter
        stop = ((raw == 0x2E) | (raw == 0x2C)) & (_LETTER[before] | wide)
        if self.dropped:
            gap = _SPACE[raw]
            return stop | gap | _SPACE[before]
        word = (raw == 0x20) & _VISIBLE[after]
        shown = (_VISIBLE[before] & (before < 0x7F)) | wide
        line = (raw == 0x0A) & shown & _VISIBLE[after]
        return stop | word | line | np.roll(line, 1)

    def _pieces(self, texts: list[bytes | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """All texts joined, where each piece begins, its size, and the number of its text."""
        data = b"\0".join(x or b"" for x in texts)
        if self.dropped:
            data = data.translate(ASCII_LOWER)
        lengths = np.fromiter((len(x or b"") for x in texts), np.int64, len(texts))
        if not data:
            return data, *(np.zeros(0, np.int64) for _ in range(3))
        raw = np.frombuffer(data, np.uint8)
        begins = np.cumsum(lengths + 1) - lengths - 1
        edge = self._cuts(raw)
        edge[begins[begins < len(raw)]] = True
        between = (begins + lengths)[:-1]  # the zero bytes that join texts
        edge[between] = True
        starts = np.flatnonzero(edge)
        if starts[0] != 0:
            starts = np.concatenate([[0], starts])
        sizes = np.diff(np.append(starts, len(raw)))
        joint = np.zeros(len(raw) + 1, bool)
        joint[between] = True
        real = ~joint[starts]
        if self.dropped:
            real &= ~((sizes == 1) & _SPACE[raw[starts]])
        starts, sizes = starts[real], sizes[real]
        return data, starts, sizes, np.searchsorted(begins, starts, side="right") - 1

    def _library_ids(self, texts: list[bytes | None]) -> list[list[int]]:
        return [self.tokenizer.encode((x or b"").decode("utf-8"), add_special_tokens=False).ids for x in texts]

    def encode_many(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, one after another, and how many each text has."""
        if not (self.led or self.dropped):
            each = self._library_ids(texts)
            return np.array([i for ids in each for i in ids], np.uint32), np.array([len(ids) for ids in each], np.int64)
        data, starts, sizes, of = self._pieces(texts)
        slots = self._slots(data, starts, sizes)
        n, from_ = self.table.size[slots], self.table.first[slots]
        ends = np.cumsum(n, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(from_ - (ends - n), n)
        return self.table.pool[at], np.bincount(of, n, len(texts)).astype(np.int64)

    def count_many(self, texts: list[bytes | None]) -> np.ndarray:
        """How many ids each text has; the ids themselves are not gathered."""
        if not (self.led or self.dropped):
            return np.array([len(ids) for ids in self._library_ids(texts)], np.int64)
        data, starts, sizes, of = self._pieces(texts)
        slots = self._slots(data, starts, sizes)  # before the table's arrays are looked at: it may grow, or begin anew
        return np.bincount(of, self.table.size[slots], len(texts)).astype(np.int64)

    def split(self, text: bytes, size: int) -> Iterator[bytes]:
        """`text` in parts of about `size` bytes, cut where a piece may begin; a stretch without such a place stays whole."""
        raw, at = np.frombuffer(text, np.uint8), 0
        while (self.led or self.dropped) and len(raw) - at > size:
            width, cut = size, 0
            while not cut:
                cuts = np.flatnonzero(self._cuts(raw[at : at + width])[8:-8])  # its ends look around the corner
                cut = at + 8 + int(cuts[-1]) if len(cuts) else len(raw) if at + width >= len(raw) else 0
                width *= 2
            yield text[at:cut]
            at = cut
        yield text[at:]

    def _slots(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where the table holds each piece, which it does by then."""
        table = self.table
        if not len(starts):
            return np.zeros(0, np.int64)
        if table.held > PIECES or table.used > POOL:
            table.clear()
        data, at, width = short_keys(data, starts, sizes)
        codes = piece_codes(data, at, width)
        padded = data + bytes(8)
        slots = found = table.find(codes)
        left = np.arange(len(codes))
        while len(left):  # once, but for pieces that share a code with others
            lacking = left[found < 0]
            if len(lacking):
                new, first = np.unique(codes[lacking], return_index=True)
                some = lacking[first]
                ids: list[int] = []
                counts: list[int] = []
                keys: list[bytes] = []
                piece: Callable[[bytes], list[int]] = self._piece
                for a, n, k, w in zip(*(x[some].tolist() for x in (starts, sizes, at, width)), strict=True):
                    got = piece(data[a : a + n])
                    ids += got
                    counts.append(len(got))
                    keys.append(data[k : k + w])
                table.add(new, ids, counts, keys, sizes[some])
                slots = table.find(codes)  # those of all, as adding may move them
            left = left[table.others(slots[left], padded, at[left], width[left], sizes[left])]
            if len(left):
                codes[left] = mixed(codes[left] + np.uint64(1))
                slots = table.find(codes)
                found = slots[left]
        return slots

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([(text or "").encode("utf-8", "surrogatepass")])[0].tolist()


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per file and worker process, so that its cache lives across tasks."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def encoded(path: str, texts: list[bytes | None], end_id: int):
    """For each text its ids and `end_id`, as little-endian unsigned 32-bit numbers."""
    encode, end = encoder(path).encode_many, np.array([end_id], "<u4")
    for _, some in chunks(texts, RUN_BYTES):
        ids, counts = encode(some)
        ends = np.cumsum(counts)
        for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            yield np.concatenate([ids[a:b], end])


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()) & 0xFFFFFFFF


def narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id where all ids allow it; a leading byte says which."""
    return b"\x02" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 65536 else b"\x04" + ids.tobytes()


def wide(value) -> np.ndarray:
    """The ids that `narrow` has made bytes."""
    return np.frombuffer(value, "<u2", offset=1).astype("<u4") if value[0] in (2, b"\x02") else np.frombuffer(value, "<u4", offset=1)

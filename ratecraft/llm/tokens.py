"""Token ids of whole texts, vectorised.

The byte-level BPE splits a text at white space before any merge, so the ids
of a text are the ids of its units (a run of white space and the run that
follows) one after the other.  Units are found on the bytes of a whole batch,
only units not met before by the worker go through the tokenizer, and the ids
of all occurrences are gathered from flat arrays.

A unit begins at a blank or line break only if the character before it is
certainly no white space (ASCII, or a two-byte letter); other places just make
longer units.  Texts without blanks are single units.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from . import text as tx

BPE_FILE = "byte_bpe_50k.json"
#: Id that ends a document in flat files: the vocabulary's own end-of-text id.
END_OF_TEXT = 50256
#: Units that a worker keeps; beyond, those met in one piece only are forgotten.
KEEP_UNITS = 800_000


def tokenizer_path(path: str | None = None) -> str:
    """The given vocabulary file, or the installed public one."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(BPE_FILE)


class Units:
    """Ids of units, kept across batches: sorted hashes and their places in one flat id array."""

    def __init__(self, path: str, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # False here is the library's own reading: names such as <|endoftext|> in a text give their single id
        self.tokenizer.encode_special_tokens = not special
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, dtype=np.uint64)
        self.starts = np.empty(0, dtype=np.int64)
        self.lens = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)
        self.met = np.empty(0, dtype=np.uint32)  # pieces that had the unit

    def forget(self) -> None:
        """Keep the units met in several pieces, and of these no more than half of what may be kept."""
        least = 2
        while (self.met >= least).sum() > KEEP_UNITS // 2:
            least *= 2
        keep = np.flatnonzero(self.met >= least)
        lens = self.lens[keep]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        self.ids = self.ids[np.repeat(self.starts[keep] - (ends - lens), lens) + np.arange(total)]
        self.hashes, self.lens, self.met, self.starts = self.hashes[keep], lens, self.met[keep], ends - lens

    def places(self, hashes: np.ndarray, spell) -> np.ndarray:
        """Indexes of sorted distinct hashes; ``spell(i)`` gives the text of an unknown one."""
        if len(self.hashes) + len(hashes) > KEEP_UNITS and len(self.hashes):
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            coded = [e.ids for e in self.tokenizer.encode_batch([spell(i) for i in fresh.tolist()], add_special_tokens=False)]
            lens = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
            flat = np.fromiter((x for ids in coded for x in ids), dtype=np.uint32, count=int(lens.sum()))
            starts = len(self.ids) + np.cumsum(lens) - lens
            merged = np.concatenate([self.hashes, hashes[fresh]])
            order = np.argsort(merged, kind="stable")
            self.hashes = merged[order]
            self.starts = np.concatenate([self.starts, starts])[order]
            self.lens = np.concatenate([self.lens, lens])[order]
            self.ids = np.concatenate([self.ids, flat])
            self.met = np.concatenate([self.met, np.zeros(len(fresh), np.uint32)])[order]
            at = np.searchsorted(self.hashes, hashes)
        self.met[at] += np.uint32(1)
        return at

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a piece, and the texts' offsets in them."""
        if not len(data):
            return np.empty(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        blank = (data == 0x20) | (data == 0x0A)
        before = np.zeros(len(data), dtype=bool)
        before[1:] = (data[:-1] > 0x20) & (data[:-1] < 0x7F)
        before[2:] |= (data[1:-1] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] < 0xE0)
        cut = blank & before
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        lens = np.diff(np.append(starts, len(data)))
        u_off = np.searchsorted(starts, offsets)
        hashes, first, which = np.unique(tx.hash_spans(data, starts, lens), return_index=True, return_inverse=True)

        def spell(i: int) -> str:
            s = starts[first[i]]
            return data[s : s + lens[first[i]]].tobytes().decode("utf-8")

        at = self.places(hashes, spell)[which]
        n = self.lens[at]
        ends = np.cumsum(n)
        total = int(ends[-1])
        ids = self.ids[np.repeat(self.starts[at] - (ends - n), n) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[u_off]


_UNITS: dict[tuple[str, bool], Units] = {}


def units(path: str | None = None, special: bool = False) -> Units:
    """The worker's tokenizer for a vocabulary file."""
    key = (tokenizer_path(path), special)
    if key not in _UNITS:
        _UNITS[key] = Units(*key)
    return _UNITS[key]


def require_width(dtype: str, end_id: int, path: str | None = None) -> None:
    """Raise unless every id of the vocabulary, and the end id, fits ``dtype``."""
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(tokenizer_path(path)).get_vocab(with_added_tokens=True).values()
    largest, room = max([end_id, *known]), np.iinfo(np.dtype(dtype)).max
    if largest > room or end_id < 0:
        raise ValueError(f"ids up to {largest} don't fit {dtype} (0 to {room}): pass a wider dtype")


def encoded(texts: pa.Array, end_id: int, path: str | None = None, special: bool = False):
    """(first row, end row, ids, offsets) over pieces of a batch; each text is followed by ``end_id``.

    ``special`` reads names of special tokens in a text as these tokens, as the
    library's ``encode`` does by default; otherwise they are ordinary text.
    """
    u = units(path, special)
    for lo, hi, data, offsets in tx.pieces(texts):
        ids, off = u.encode(data, offsets)
        yield lo, hi, np.insert(ids, off[1:], np.uint32(end_id)), off + np.arange(len(off))

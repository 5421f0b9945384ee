"""Token ids of whole batches of texts with a byte-level BPE vocabulary file."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

from .common import binary_array, bytes_of

#: Name of the vocabulary file among the installed public tokenizers; a full path may be given instead.
VOCABULARY = "byte_bpe_50k.json"
#: Id written after each document.
END_ID = 2
#: Units whose ids a task remembers, the first ones it meets.
REMEMBERED = 500_000
#: Splitting pattern of this family of vocabularies. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_symbol() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BatchTokenizer:
    """Ids of many texts at once, equal to those of the vocabulary's own library without added special tokens.

    Texts are cut before white space that follows a visible character. A token
    never spans such a place, so a unit has the same ids wherever it stands,
    and each distinct unit of a batch is encoded once.
    """

    def __init__(self, name: str = VOCABULARY, remembered: int = REMEMBERED):
        with open(vocabulary_path(name), encoding="utf-8") as file:
            spec = json.load(file)
        symbol = _byte_of_symbol()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(symbol[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.size = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, rank in [*ranks.items(), *((k.encode(), v) for k, v in special.items())]:
            self.size[rank] = len(token)
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.starts = np.zeros(1, np.int64)  # offsets of known units' ids in flat
        self.flat = np.zeros(0, np.uint32)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all", disallowed_special=())

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each unit). Units that begin with a space and end visibly are encoded as one string."""
        data, at = bytes_of(units)
        head, last = data[at[:-1]], data[at[1:] - 1]
        plain = ((head == 32) | ((head >= 9) & (head <= 13))) & (last > 32) & (last < 127)
        tail = np.nonzero(~plain & (head <= 32) & (last >= 128))[0].tolist()
        plain[[i for i in tail if not units[i].as_py().decode()[-1].isspace() and units[i].as_py()[:1].isspace()]] = True
        joined, cut = bytes_of(units.filter(pa.array(plain))) if plain.any() else (data[:0], at[:1])
        ids = np.array(self.encode(joined.tobytes().decode()), np.uint32)
        ends = np.searchsorted(np.cumsum(self.size[ids]), cut[1:], "left") + 1
        odd = [np.array(self.encode(u.decode()), np.uint32) for u in units.filter(pa.array(~plain)).to_pylist()]
        length = np.zeros(len(units), np.int64)
        length[plain] = np.diff(ends, prepend=0)
        length[~plain] = [len(p) for p in odd]
        out = np.empty(length.sum(), np.uint32)
        mine = np.repeat(plain, length)
        out[mine] = ids
        out[~mine] = np.concatenate(odd) if odd else ids[:0]
        return out, length

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): all texts' ids one after another, and where each text's begin."""
        data, doc_at = bytes_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        cut = _cuts(data)
        cut[doc_at[:-1][doc_at[:-1] < len(data)]] = True
        cut[0] = True
        at = np.append(np.nonzero(cut)[0], len(data))
        coded = binary_array(data, at).dictionary_encode()
        units = coded.dictionary
        place = pc.index_in(units, value_set=self.known)
        new = units.filter(pc.is_null(place))
        flat, starts = self.flat, self.starts
        place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        if len(new):
            ids, length = self._encode_units(new)
            flat = np.concatenate([flat, ids])
            starts = np.concatenate([starts, starts[-1] + np.cumsum(length)])
            place[place < 0] = len(self.known) + np.arange(len(new))
            if len(starts) <= self.remembered:
                self.known, self.flat, self.starts = pa.concat_arrays([self.known, new]), flat, starts
        index = place[coded.indices.to_numpy()]
        length = starts[index + 1] - starts[index]
        ends = np.cumsum(length)
        ids = flat[np.repeat((starts[index] - (ends - length)).astype(np.int32), length) + np.arange(ends[-1], dtype=np.int32)]
        first = np.searchsorted(at, doc_at)  # unit at which each text begins
        return ids, np.append(0, ends)[first]


def _cuts(data: np.ndarray) -> np.ndarray:
    """True where ASCII white space follows a byte that surely ends a visible character."""
    cut = np.zeros(len(data), bool)
    before, here = data[:-1], data[1:]
    space = (here == 32) | ((here >= 9) & (here <= 13))
    visible = (before >= 0x21) & (before != 0x7F)
    cut[1:] = space & visible
    # Spaces beyond ASCII have the lead bytes C2 (two bytes) and E1 to E3 (three): no cut after those.
    if len(data) > 3 and (data >= 0xE1).any() or (data == 0xC2).any():
        cut[2:] &= ~((data[1:-1] >= 0x80) & (data[:-2] == 0xC2))
        cut[3:] &= ~((data[2:-1] >= 0x80) & (data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
    return cut


@lru_cache(2)
def tokenizer(name: str = VOCABULARY) -> BatchTokenizer:
    """One tokenizer per task process and vocabulary."""
    return BatchTokenizer(name)

"""Token ids of whole texts by the tokenizers library.

A text is cut where white space follows something else. White space never joins the
characters before it in one pre-token, and no added token of the vocabulary holds white
space or strips it, so each piece gives the ids that it has within the whole text.
Pieces recur, so a worker keeps the ids of those it has seen, in the end of those that most
batches met; the new ones of a batch go to the library together.
"""

from __future__ import annotations

import itertools
import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sievewright.llm.common import CACHES

#: The characters of Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Texts in which a space or line feed follows white space, or with the mark: cut by PIECES, not by Arrow.
UNEVEN = f"[{WHITE}][ \n]|\x00"
#: A piece with the mark stands for what follows the mark; another for itself behind a space, unless it begins with a line feed.
MARK = "\x00"
#: Signs behind a letter or digit begin a pre-token of their own (an apostrophe may not), so words with and without them share a piece. Letters: those that every version of Unicode's tables has.
SIGNS = "([0-9A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?%&$#*]+)"
END, END_ID = "<|endoftext|>", 50256
#: Bytes of ids per token, and the pieces that a worker keeps before it lets go of the seldom ones.
WIDTH, KEPT = 4, 500_000
#: Pieces that go to the library as one text.
GROUP = 512


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def widths(path: str) -> np.ndarray:
    """Bytes that each id stands for."""
    found = library(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(found.values()) + 1, dtype=np.int64)
    for entry, i in found.items():
        out[i] = len(entry)
    return out


def _meant(pieces: pa.Array) -> pa.Array:
    """The text that each piece stands for."""
    spaced = pc.if_else(pc.starts_with(pieces, "\n"), pieces, pc.binary_join_element_wise("", pieces, " "))
    marked = pc.starts_with(pieces, MARK)
    if not pc.any(marked).as_py():
        return spaced
    return pc.if_else(marked, pc.utf8_slice_codeunits(pieces, 1), spaced)


class Encoder:
    """Ids of texts, each text followed by ``end_id``."""

    def __init__(self, path: str, end_id: int, kept: int = KEPT):
        self.path, self.end_id, self.kept = path, end_id, kept
        self.slot: dict[str, int] = {}
        self.ids = np.array([self.end_id], dtype="<u4")
        self.starts, self.sizes = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.int64)  # slot 0: the end
        self.uses = np.zeros(1, dtype=np.int32)

    def _forget(self) -> None:
        """Keep the pieces that most batches met, at most half as many as may be kept."""
        least = max(2, int(np.partition(self.uses, -(self.kept // 2))[-(self.kept // 2)]) + 1)
        stay = self.uses >= least
        stay[0] = False
        pieces, old = np.array([*self.slot], dtype=object), np.array([*self.slot.values()], dtype=np.int64)
        pieces, old = pieces[stay[old]], old[stay[old]]
        n = self.sizes[old]
        starts = np.cumsum(n) - n
        self.ids = np.concatenate([self.ids[:1], self.ids[np.arange(n.sum()) + np.repeat(self.starts[old] - starts, n)]])
        self.starts, self.sizes = np.concatenate(([0], starts + 1)), np.concatenate(([1], n))
        self.uses = np.concatenate(([0], self.uses[old] >> 1)).astype(np.int32)
        self.slot = dict(zip(pieces.tolist(), range(1, len(pieces) + 1)))

    def _learn(self, pieces: pa.Array) -> None:
        """Give ``pieces`` the next slots, in order."""
        meant = _meant(pieces)
        # Behind another piece, one that begins with a space or line feed is cut off by the pre-tokens themselves.
        even = pc.and_(pc.match_substring_regex(meant, "^[ \n]"), pc.invert(pc.or_(pc.match_substring(meant, END), pc.match_substring_regex(meant, f"[{WHITE}]$"))))
        plain = even.to_numpy(zero_copy_only=False)
        joined = meant.filter(even)
        cuts = np.append(np.arange(0, len(joined), GROUP), len(joined)).astype(np.int32)
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), joined), "").to_pylist()
        found = [e.ids for e in library(self.path).encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(found), dtype="<u4", count=sum(map(len, found)))
        # A token stands for as many bytes as its entry has characters, which tells where pieces end.
        ends = np.searchsorted(np.cumsum(widths(self.path)[ids]), np.cumsum(pc.binary_length(joined).to_numpy(), dtype=np.int64), side="left") + 1
        sizes, starts = np.empty(len(pieces), dtype=np.int64), np.empty(len(pieces), dtype=np.int64)
        sizes[plain], starts[plain] = np.diff(ends, prepend=0), np.concatenate(([0], ends))[:-1]
        tail, held = [ids], len(ids)
        for i in np.flatnonzero(~plain).tolist():
            own = np.array(library(self.path).encode(meant[i].as_py(), add_special_tokens=False).ids, dtype="<u4")
            sizes[i], starts[i] = len(own), held
            tail.append(own)
            held += len(own)
        self.slot.update(zip(pieces.to_numpy(zero_copy_only=False).tolist(), range(len(self.sizes), len(self.sizes) + len(pieces))))
        self.starts, self.sizes = np.concatenate([self.starts, starts + len(self.ids)]), np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *tail])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), dtype=np.int32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and where each text's begin (one more than texts). A null text is as an empty one."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        uneven = pc.match_substring_regex(texts, UNEVEN)
        odd = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
        cut = pc.replace_substring_regex(pc.replace_substring(pc.if_else(uneven, "", texts), "\n", " \n"), SIGNS, rf"\1 {MARK}\2")
        marked = pc.binary_join_element_wise(MARK, cut, "")
        lists = pc.split_pattern(marked, " ")
        counts = np.diff(lists.offsets.to_numpy())
        first = lists.offsets.to_numpy()[:-1].astype(np.int64)
        values = lists.values
        if len(odd):
            own = [[MARK + p for p in PIECES.findall(texts[int(i)].as_py())] for i in odd]
            sizes = np.array([len(x) for x in own])
            first[odd], counts[odd] = len(values) + np.cumsum(sizes) - sizes, sizes
            values = pa.concat_arrays([values, pa.array([p for x in own for p in x], pa.string())])
        coded = values.dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.slot) > self.kept:
            self._forget()
        own_slots = np.fromiter(map(self.slot.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        new = np.flatnonzero(own_slots < 0)
        if len(new):
            own_slots[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self._learn(coded.dictionary.take(pa.array(new)))
        self.uses[own_slots] += 1
        slots = own_slots[coded.indices.to_numpy()]
        # Each text's pieces in order, then the end.
        total = counts + 1
        edge = np.cumsum(total)
        at = np.arange(edge[-1] if len(edge) else 0) + np.repeat(first - (edge - total), total)
        at[edge - 1] = 0
        chosen = slots[at] if len(slots) else np.zeros(len(at), dtype=np.int64)
        chosen[edge - 1] = 0
        n = self.sizes[chosen]
        stop = np.cumsum(n)
        out = self.ids[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.starts[chosen] - (stop - n), n)]
        return out, np.concatenate(([0], stop[edge - 1])).astype(np.int64)


@lru_cache(maxsize=1)
def encoder(path: str, end_id: int, kept: int = KEPT) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, end_id, kept)


CACHES.extend([encoder.cache_clear, library.cache_clear, widths.cache_clear])

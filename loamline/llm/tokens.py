"""Token ids of whole texts with a word-based tokenizer of the tokenizers library.

The tokenizers here split at white space, and between letters and punctuation, before anything else, so
the ids of a text are those of its chunks, one after another. Each distinct chunk of a slice is
encoded once; chunks seen before come from a bounded memo. Words of letters alone are encoded many
at a time, as one text, and told apart by the token that ends each.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from loamline.llm.text import ragged, words_of

#: Bytes that a worker's memo of chunks takes, about. It has two halves: once the young one is full it becomes the old one,
#: and of that only chunks that are met again go on, so words that occur once do not drive out the common ones.
MEMO_BYTES = 128 << 20
#: Bytes of an entry besides its letters and ids.
_ENTRY = 190
#: Words that are encoded as one text.
JOINED = 32
#: Latin letters (but the dotted capital I, which lower-cases to two characters) and digits, then ASCII marks.
_LETTERS = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"
_CHUNK = rf"^(?P<stem>[0-9{_LETTERS}]+)(?P<marks>[!-/:-@\[-`{{-~]*)$"
_WORD = rf"^[{_LETTERS}]+$"


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder, with its memo, for each worker and tokenizer file."""
    return ChunkEncoder(path)


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends_word = np.zeros(size, bool)
        self.ends_word[[i for x, i in self.tokenizer.get_vocab().items() if x.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _fill(self, chunks: pa.Array) -> list[str]:
        """Put the ids of distinct chunks that the memo lacks into it."""
        listed = chunks.to_pylist()
        if self.held > MEMO_BYTES // 2:
            self.old, self.memo, self.held = self.memo, {}, 0
        unmet = [x for x in listed if x not in self.memo]
        again = {x: self.old[x] for x in unmet if x in self.old}
        self.memo.update(again)
        lacking = [x for x in unmet if x not in again]
        self.held += sum(map(len, unmet)) * 3 + _ENTRY * len(unmet)
        is_word = pc.match_substring_regex(pa.array(lacking, pa.string()), _WORD).to_pylist()
        words = [x for x, w in zip(lacking, is_word, strict=True) if w]
        rest = [x for x, w in zip(lacking, is_word, strict=True) if not w]
        texts = [" ".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)]
        for at in range(0, len(texts), 512):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 512], add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), self.dtype)
            part = words[at * JOINED : (at + 512) * JOINED]
            to = np.flatnonzero(self.ends_word[ids]) + 1
            if len(to) != len(part):  # not a tokenizer with word ends: one by one
                rest += part
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            cuts = [0, *(to * width).tolist()]
            self.memo.update(zip(part, [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            for x, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.memo[x] = np.array(e.ids, self.dtype).tobytes()
        return listed

    def _pool(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct chunks, and where each chunk's ids start and how many they are."""
        found = [self.memo[x] for x in self._fill(chunks)]
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        return np.frombuffer(b"".join(found), self.dtype), np.cumsum(size) - size, size

    def encode(self, text: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of null-free texts, each with the id ``end`` appended if there is one."""
        w = words_of(text)
        # a chunk is letters and marks, which the tokenizer takes apart there, or it stays whole
        parts = pc.extract_regex(w.names.cast(pa.string()), _CHUNK)
        stems = pc.coalesce(pc.utf8_lower(pc.struct_field(parts, "stem")), w.names.cast(pa.string())).dictionary_encode()
        marks = pc.fill_null(pc.struct_field(parts, "marks"), "").dictionary_encode()
        both = pa.concat_arrays([stems.dictionary, marks.dictionary]).dictionary_encode()
        ids, start, size = self._pool(both.dictionary)
        code = both.indices.to_numpy()
        pair = np.stack([code[: len(stems.dictionary)][stems.indices.to_numpy()], code[len(stems.dictionary) :][marks.indices.to_numpy()]], axis=1).ravel()
        pool = np.append(ids[ragged(start[pair], size[pair])], np.array([] if end is None else [end], self.dtype))
        size = size[pair].reshape(-1, 2).sum(axis=1)
        start = np.cumsum(size) - size
        # each word's ids, and after each text's words the end
        n = w.counts
        extra = int(end is not None)
        at = w.offsets[:-1] + extra * np.arange(len(n))
        total = len(w.ids) + extra * len(n)
        from_, long = np.empty(total, np.int64), np.ones(total, np.int64)
        is_word = np.ones(total, bool)
        if extra:
            is_word[at + n] = False
            from_[at + n] = len(pool) - 1
        from_[is_word], long[is_word] = start[w.ids], size[w.ids]
        sums = np.concatenate(([0], np.cumsum(long)))
        return sums[np.concatenate((at, [total]))], pool[ragged(from_, long)]

"""Texts to ids with the tokenizers library, each distinct word once.

The word-level tokenizer folds white space and never lets a token reach across it, so a text's ids are the ids of its
white-space words in order. A batch encodes its distinct words through the library, and a worker keeps what is common.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa

#: Words whose ids a task keeps, and a worker between tasks; the longest of them; words in one call of the library.
CACHE_WORDS, STAY_WORDS, CACHE_BYTES, CALL_WORDS = 450_000, 150_000, 24, 4_000
END_ID = 1
#: ASCII marks other than the apostrophe: a run of them after letters is a unit of its own.
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)
#: Letters of ASCII and Latin-1, which case folding and normalisation map one to one.
FOLDS = re.compile("[^\x00-\xff]").search
#: A word of such letters and the marks behind it, or any other word, each with the blank after it.
PARTS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([" + re.escape(MARKS) + rb"]*) |([^ ]+) ")


class WordCoder:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.closes = np.zeros(self.size, dtype=bool)
        self.closes[[i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]] = True
        self.cache: dict[bytes, bytes] = {}

    def _raw(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), CALL_WORDS):
            for e in self.library.encode_batch(words[at : at + CALL_WORDS], add_special_tokens=False):
                out.append(b"".join([i.to_bytes(4, "little") for i in e.ids]))
        return out

    def _plain(self, stems: list[bytes]) -> list[bytes]:
        """Ids of words of plain letters. Each is one unit of the merges, so its last id, and no other, stands for a word's end."""
        out: list[bytes] = []
        for at in range(0, len(stems), CALL_WORDS):  # letters of either case: the library folds them
            part = stems[at : at + CALL_WORDS]
            ids = np.array(self.library.encode(b" ".join(part).decode(), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part):
                return out + self._raw([w.decode() for w in stems[at:]])
            raw, cuts = ids.tobytes(), [0, *(ends * 4).tolist()]
            out += [raw[i:j] for i, j in zip(cuts, cuts[1:])]
        return out

    def _fresh(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words outside the cache. A plain word is its letters followed by its marks, which are tokens apart."""
        cache = self.cache
        parts = PARTS.findall(b" ".join([*words, b""]))
        stems = [x for x in dict.fromkeys([p[0] for p in parts]) if x and x not in cache]
        tails = [x for x in dict.fromkeys([p[1] for p in parts]) if x and x not in cache]
        whole = [p[2] for p in parts if p[2]]
        got = dict(zip(stems, self._plain(stems)))
        got |= zip(tails, self._raw([x.decode() for x in tails]))
        got |= zip(whole, self._raw([w.decode() for w in whole]))
        at = lambda x: got[x] if x in got else cache[x]
        out = {w: (at(stem) + at(tail) if tail else at(stem)) if stem else got[w] for w, (stem, tail, _) in zip(words, parts)}
        room = CACHE_WORDS - len(cache)
        if room > 0:  # letters and marks apart serve many words
            cache.update(islice(((k, v) for k, v in got.items() if len(k) <= CACHE_BYTES), room))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without the end id."""
        # below U+0100 lower case maps one character to one, as the library's does, so variants fold before they are looked up
        split = [(t.lower() if FOLDS(t) is None else t).encode().split() for t in texts]
        cache = self.cache
        distinct: set[bytes] = set()
        for ws in split:
            distinct.update(ws)
        fresh = self._fresh([*distinct.difference(cache)])
        room = max(0, CACHE_WORDS - len(cache))
        cache.update(fresh)  # for this step all of them; then only what there is room for stays
        out = [b"".join(map(cache.__getitem__, ws)) for ws in split]
        for w in fresh:
            if room > 0 and len(w) <= CACHE_BYTES:
                room -= 1
            else:
                del cache[w]
        return out

    def trim(self) -> None:
        """After a task: keep the words met first, which are the common ones, and give the memory of the others back."""
        if len(self.cache) > STAY_WORDS:
            self.cache = dict(islice(self.cache.items(), STAY_WORDS))
        pa.default_memory_pool().release_unused()


@lru_cache(2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def vocabulary_size(path: str) -> int:
    return coder(path).size

"""Scoring by an n-gram trie in Elias-Fano levels.

Words are 64-bit hashes. Level 1 is the sorted sequence of all training words, Elias-Fano coded, so a word's number is the
rank that a successor search finds; counts stand beside it. Levels 2 and 3 hold the n-grams of these lengths: for each
context its children in order of word number. Children are stored relative to their context, as the word number added to
the last value before the context's range, which makes a level one monotone sequence; pointers to the ranges are monotone
too. Both are Elias-Fano coded. A child is found by one successor search inside its context's range. Probabilities and
back-off weights are eight-bit codes into a table per file.

Smoothing is interpolated absolute discounting down to the unigram estimate (c + 1/2) / (N + (V + 1)/2). Every n-gram of the
training texts enters the trie; what the discount takes goes to the shorter context, so the probabilities of all words
after a context add up to one.

Building is Spark's. Words are counted per task, summed and written as one file for each range of hashes. Trigrams are
counted per task over word numbers, which the trie's first level gives, and shuffled once, as sorted and compressed runs,
to parts: ranges of bigrams that hold about PART_TOKENS tokens each, as the word counts tell beforehand. A frequent first
word is divided into several parts by its second word. Bigram counts are sums of trigram counts, so they need no shuffle.
Each part becomes one file of levels 2 and 3 in the shared folder, where all executors map it into memory. Only sizes and
the bounds of the parts (one for each PART_TOKENS tokens) reach the driver.

A null or empty text is its end token. Repeated rows count and score each. Without training texts the model is uniform
over one unknown word. Words are told apart by 63 bits of a hash; two words that share them count as one.
"""

from __future__ import annotations

import json
import math
import tempfile
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import drop, fold, shared_dir, small_batches, text_steps, written
from tallymart.llm.tokenfile import file_system

DISCOUNT = 0.5
#: Tokens whose trigrams share a part, words in a file of level 1, tokens that a task counts at once (so that three of their words fit 63 bits) and characters of them.
PART_TOKENS, FILE_WORDS, COUNT_TOKENS, COUNT_CHARS = 2_000_000, 500_000, 2_000_000, 10 << 20
#: Bytes of files that a worker keeps open: of copies in full, of mapped files their directories.
OPEN_BYTES = 512 << 20
#: Searches that one vectorised step handles together.
CHUNK = 1 << 14
#: Hash of the end of a text; no word has it, being kept apart by a bit.
END = np.uint64(0)


# --- Elias-Fano ---------------------------------------------------------------------------------------------------


def ef_encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """A monotone sequence: low bits packed, high parts in unary with the number of set bits before each word."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low_bits = min(62, max(0, ((top + 1) // max(1, n)).bit_length() - 1))
    at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    words = (int(at[-1]) if n else 0) // 64 + 2
    bits = np.zeros(words * 64, dtype=np.uint8)
    bits[at] = 1
    high = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.cumsum(np.bitwise_count(high), dtype=np.uint32)
    ones = np.r_[np.zeros(1, np.uint32), ones[:-1]]
    return {"head": np.array([n, low_bits, top], dtype=np.uint64), "low": _pack(v & np.uint64((1 << low_bits) - 1), low_bits), "high": high, "ones": ones}


def _pack(x: np.ndarray, bits: int) -> np.ndarray:
    """`bits` bits of each, in 64-bit words with one to spare."""
    n = len(x)
    out = np.zeros(n * bits // 64 + 2, dtype=np.uint64)
    if bits and n:
        bit = np.arange(n, dtype=np.int64) * bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[first]] = np.bitwise_or.reduceat(x << shift, first)
        spill = np.flatnonzero(shift.astype(np.int64) + bits > 64)
        out[word[spill] + 1] |= x[spill] >> (np.uint64(64) - shift[spill])
    return out


_L8, _H8 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Position of set bit number k of an octet, at k * 256 + octet.
_SELECT = np.array([next((i for i in range(8) if o >> i & 1 and (o & ((1 << i) - 1)).bit_count() == k), 0) for k in range(8) for o in range(256)], dtype=np.uint64)


def _select_in(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of set bit number k (from 0) of each 64-bit word: byte sums side by side, then a table for the byte."""
    s = x - ((x >> 1) & 0x5555555555555555)
    s = (s & 0x3333333333333333) + ((s >> 2) & 0x3333333333333333)
    s = ((s + (s >> 4)) & 0x0F0F0F0F0F0F0F0F) * _L8
    byte = (((((k * _L8) | _H8) - s) & _H8) >> 7) * _L8 >> 56
    shift = byte << 3
    before = ((s << 8) >> shift) & 255
    return shift + _SELECT[((k - before) << 8) | ((x >> shift) & 255)]


class EliasFano:
    """Random access and successor search on a mapped sequence."""

    def __init__(self, head, low, high, ones):
        self.n, self.low_bits, self.top = (int(x) for x in head)
        self.low, self.high, self.ones = low, high, ones
        self.zeros = None

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        # of the next word, the bits that this one lacks: shifted in two steps, as 64 at once would be no shift
        x = (self.low[word] >> shift) | ((self.low[word + 1] << 1) << (63 - shift))
        return x & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, dtype=np.int64)
        if len(i) > CHUNK:
            return np.concatenate([self.get(i[a : a + CHUNK]) for a in range(0, len(i), CHUNK)])
        word = np.searchsorted(self.ones, i.astype(np.uint32), side="right") - 1
        inside = _select_in(self.high[word], i.astype(np.uint64) - self.ones[word])
        high = (word.astype(np.uint64) << 6) + inside - i.astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        at = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        i = np.arange(self.n)
        return ((at - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def _below(self, part: np.ndarray) -> np.ndarray:
        """Number of values whose high part is smaller: set bits before clear bit number part - 1."""
        if self.zeros is None:
            self.zeros = (np.arange(len(self.ones)) * 64 - self.ones).astype(np.uint32)
        h = np.maximum(part - 1, 0)
        word = np.searchsorted(self.zeros, h.astype(np.uint32), side="right") - 1
        at = (word << 6) + _select_in(~self.high[word], (h - self.zeros[word]).astype(np.uint64)).astype(np.int64)
        return np.where(part > 0, np.minimum(at - h, self.n), 0)

    def find(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First position in [lo, hi) whose value is at least x, else hi; and whether the value there is x.

        All values before lo must be smaller than x. Values of x's high part stand in one run of set bits, which is
        stepped through, and halved where it is long."""
        x, lo, hi = np.asarray(x, np.uint64), np.asarray(lo, dtype=np.int64), np.asarray(hi, dtype=np.int64)
        equal = np.zeros(len(lo), dtype=bool)
        if not self.n or not len(lo):
            return hi.copy(), equal
        if len(x) > CHUNK:  # so that what a chunk needs stays in the processor's cache
            found = [self.find(x[i : i + CHUNK], lo[i : i + CHUNK], hi[i : i + CHUNK]) for i in range(0, len(x), CHUNK)]
            return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        part = np.minimum(x >> np.uint64(self.low_bits), np.uint64((self.top >> self.low_bits) + 1)).astype(np.int64)
        want = x & np.uint64((1 << self.low_bits) - 1)
        pos = np.minimum(np.maximum(self._below(part), lo), hi)
        open_ = np.flatnonzero(pos < hi)
        for _ in range(4):
            bit = pos[open_] + part[open_]
            open_ = open_[((self.high[bit >> 6] >> (bit & 63).astype(np.uint64)) & 1).astype(bool)]  # the run goes on
            low = self._low(pos[open_])
            less = low < want[open_]
            equal[open_] = low == want[open_]
            open_ = open_[less]
            pos[open_] += 1
            open_ = open_[pos[open_] < hi[open_]]
            if not len(open_):
                return pos, equal
        a, b = pos[open_], np.minimum(self._below(part[open_] + 1), hi[open_])
        end, wanted = b.copy(), want[open_]
        left = np.flatnonzero(a < b)
        while len(left):
            mid = (a[left] + b[left]) >> 1
            less = self._low(mid) < wanted[left]
            a[left[less]] = mid[less] + 1
            b[left[~less]] = mid[~less]
            left = left[a[left] < b[left]]
        pos[open_] = a
        inside = np.flatnonzero(a < end)
        equal[open_[inside]] = self._low(a[inside]) == wanted[inside]
        return pos, equal


# --- files --------------------------------------------------------------------------------------------------------


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of aligned arrays, written under another name and renamed whole."""
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    spec, at = [], 0
    for k, a in arrays.items():
        spec.append((k, a.dtype.str, len(a), at))
        at += (a.nbytes + 63) // 64 * 64
    head = json.dumps(spec).encode()
    aside, final = f"{root}/.{uuid.uuid4().hex}", f"{root}/{name}"
    with store.open_output_stream(aside) as out:
        out.write(np.array([len(head)], "<i8").tobytes() + head + b" " * (-(8 + len(head)) % 64))
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 64))
    if store.get_file_info(final).is_file:
        store.delete_file(final)
    store.move(aside, final)


def _with_ef(arrays: dict[str, np.ndarray], **sequences: np.ndarray) -> dict[str, np.ndarray]:
    return arrays | {f"{name}.{k}": v for name, s in sequences.items() for k, v in ef_encode(s).items()}


def _with_codes(arrays: dict[str, np.ndarray], **values: np.ndarray) -> dict[str, np.ndarray]:
    """Codes of one byte and their table: the values themselves if they are few, else 256 equal steps, each with the mean of its values."""
    for name, x in values.items():
        table, code = np.unique(x, return_inverse=True)
        if len(table) > 256:
            low, step = table[0], (table[-1] - table[0]) / 256
            code = np.minimum((x - low) / step, 255).astype(np.int64)
            n = np.bincount(code, minlength=256)
            table = np.where(n > 0, np.bincount(code, x, minlength=256) / np.maximum(n, 1), low)
        arrays = arrays | {f"{name}.code": code.astype(np.uint8), f"{name}.table": table.astype(np.float32)}
    return arrays


class _Parts(dict):
    """Arrays and sequences of a file. Coded values are read as table[code]."""

    def coded(self, name: str, at: np.ndarray) -> np.ndarray:
        return self[f"{name}.table"][self[f"{name}.code"][at]].astype(np.float64)


_OPEN: OrderedDict[tuple[str, str], tuple[int, _Parts]] = OrderedDict()


def _load(folder: str, name: str, keep: bool = True) -> _Parts:
    """A file mapped into memory; from a store without a local path a nameless copy is mapped. The least used are given up beyond OPEN_BYTES."""
    if (folder, name) in _OPEN:
        _OPEN.move_to_end((folder, name))
        return _OPEN[folder, name][1]
    store, root = file_system(folder)
    path = f"{root}/{name}"
    if store.type_name == "local":
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        cost = len(raw) // 16
    else:
        with tempfile.TemporaryFile() as copy, store.open_input_stream(path) as source:
            while chunk := source.read(1 << 22):
                copy.write(chunk)
            copy.flush()
            raw = np.memmap(copy, dtype=np.uint8, mode="r")
        cost = len(raw)
    raw = raw.view(np.ndarray)
    n = int(raw[:8].view("<i8")[0])
    base = (8 + n + 63) // 64 * 64
    parts, sequences = _Parts(), defaultdict(dict)
    for k, t, m, at in json.loads(bytes(raw[8 : 8 + n])):
        parts[k] = raw[base + at : base + at + np.dtype(t).itemsize * m].view(t)
        sequences[k.rpartition(".")[0]][k.rpartition(".")[2]] = parts[k]
    for k, s in sequences.items():
        if "ones" in s:
            parts[k] = EliasFano(s["head"], s["low"], s["high"], s["ones"])
    if not keep:
        return parts
    _OPEN[folder, name] = (cost, parts)
    while len(_OPEN) > 1 and sum(c for c, _ in _OPEN.values()) > OPEN_BYTES:
        _OPEN.popitem(last=False)
    return parts


# --- tokens -------------------------------------------------------------------------------------------------------


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Words are hashed eight bytes at a time, all words at once; a longer one by the library.
LONG_WORD = 64


def _hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of raw begin, and their hashes: two bits of them are set apart for the end of a text."""
    flat = np.frombuffer(raw, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[flat], prepend=True, append=True))
    at, size = edge[::2], edge[1::2] - edge[::2]
    eights = np.ndarray(len(raw) + 1, dtype="<u8", buffer=raw + bytes(8), strides=(1,))
    h = size.astype(np.uint64) * _ODD[0]
    rest = np.arange(len(at))
    for k in range(0, LONG_WORD, 8):
        left = np.minimum(size[rest] - k, 8)
        part = eights[at[rest] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - 8 * left).astype(np.uint64))
        x = (h[rest] ^ part) * _ODD[1]
        x = (x ^ (x >> 32)) * _ODD[2]
        h[rest] = x ^ (x >> 29)
        rest = rest[size[rest] > k + 8]
        if not len(rest):
            break
    for i in rest.tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[at[i] : at[i] + size[i]])
    return at, h | 2


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text with its end, and their numbers by text."""
    parts = [t.encode() for t in texts]
    at, h = _hashes(b" ".join(parts).lower())
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    text = np.searchsorted(begins, at, side="right") - 1
    lengths = np.bincount(text, minlength=len(texts)) + 1
    out = np.full(len(h) + len(texts), END)
    out[np.arange(len(h)) + text] = h
    return out, lengths


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    k = keys[order]
    heads = _heads(k)
    return k[heads], np.add.reduceat(counts[order], heads) if len(k) else counts


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    change = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[np.ones(min(1, len(columns[0])), bool), change])


def _runs(sorted_parts: np.ndarray) -> list[tuple[int, slice]]:
    heads = _heads(sorted_parts)
    return [(int(sorted_parts[a]), slice(a, b)) for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(sorted_parts)])]


# --- the model ----------------------------------------------------------------------------------------------------


class Model:
    """Descriptor of the files: sizes, one offset for each file of words and one bound for each part."""

    def __init__(self, folder: str):
        self.folder, self.tokens, self.vocabulary, self.documents = folder, 0, 0, 0
        self.bits, self.word_at = 0, np.zeros(2, dtype=np.int64)
        #: First bigram (first word << 32 | second) and number of bigrams of each part.
        self.bounds, self.sizes = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        #: First words that several parts share, with their numbers of different second words.
        self.hot, self.hot_types = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (-1: unknown) and training counts of ascending hashes."""
        number, count = np.full(len(h), -1, dtype=np.int64), np.zeros(len(h), dtype=np.int64)
        if not self.vocabulary or not len(h):
            return number, count
        file = (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        for f, run in _runs(file):
            if self.word_at[f] == self.word_at[f + 1]:
                continue
            level = _load(self.folder, f"words-{f:06d}")
            ef = level["hash"]
            pos, hit = ef.find(h[run], np.zeros(len(h[run]), np.int64), np.full(len(h[run]), ef.n))
            at = np.arange(run.start, run.stop)[hit]
            number[at] = self.word_at[f] + pos[hit]
            count[at] = level["count"][pos[hit]]
        return number, count

    def counts_of(self, number: np.ndarray) -> np.ndarray:
        """Training counts by word number; the number after the last is the beginning of texts."""
        out = np.full(len(number), self.documents, dtype=np.int64)
        order = np.argsort(number)
        order = order[number[order] < self.vocabulary]
        for f, run in _runs(np.searchsorted(self.word_at, number[order], side="right") - 1):
            at = order[run]
            out[at] = _load(self.folder, f"words-{f:06d}")["count"][number[at] - self.word_at[f]]
        return out

    def pairs(self, key: np.ndarray) -> dict[str, np.ndarray]:
        """For distinct, ascending bigrams (first << 32 | second): part, node in it (-1: none), log10 probability, and the
        back-off weights of the first word and of the bigram as contexts (0 where they are none)."""
        n = len(key)
        out = {"part": np.searchsorted(self.bounds, key, side="right") - 1, "node": np.full(n, -1, np.int64), "prob": np.zeros(n), "back1": np.zeros(n), "back2": np.zeros(n)}
        first, second = key >> 32, (key & 0xFFFFFFFF).astype(np.uint64)
        for p, run in _runs(out["part"]) if self.vocabulary else []:
            if not self.sizes[p]:
                continue
            level, prob = _load(self.folder, f"grams-{p:06d}"), _load(self.folder, f"second-{p:06d}")
            x = first[run]
            heads = _heads(x)
            of = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(x)]))
            ctx, ptr, child = level["ctx"], level["ptr"], level["child"]
            pos, hit = ctx.find(x[heads], np.zeros(len(heads), np.int64), np.full(len(heads), ctx.n))
            pos = pos[hit]
            lo, hi, base, back = (np.zeros(len(heads), t) for t in (np.int64, np.int64, np.uint64, np.float64))
            lo[hit], hi[hit], back[hit] = ptr.get(pos), ptr.get(pos + 1), prob.coded("back1", pos)
            later = np.flatnonzero(lo > 0)
            base[later] = child.get(lo[later] - 1) + np.uint64(1)
            at, found = child.find(base[of] + second[run], lo[of], hi[of])
            rows = np.arange(run.start, run.stop)[found]
            out["back1"][run] = back[of]
            out["node"][rows], out["prob"][rows], out["back2"][rows] = at[found], prob.coded("prob", at[found]), prob.coded("back2", at[found])
        if len(self.hot) and n:  # such a word's children may all be in other parts than the one asked
            at = np.minimum(np.searchsorted(self.hot, first), len(self.hot) - 1)
            same = self.hot[at] == first
            out["back1"][same] = np.log10(DISCOUNT * self.hot_types[at[same]] / self.counts_of(first[same]))
        return out

    def triples(self, part: np.ndarray, node: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the children `word` of the nodes exist, and their log10 probabilities; ascending by part, node and word."""
        found, prob = np.zeros(len(part), dtype=bool), np.zeros(len(part))
        for p, run in _runs(part):
            level, third = _load(self.folder, f"grams-{p:06d}"), _load(self.folder, f"third-{p:06d}")
            ptr, child = level["ptr3"], level["child3"]
            heads = _heads(node[run])
            of = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, run.stop - run.start]))
            nodes = node[run][heads]
            lo, hi, base = ptr.get(nodes).astype(np.int64), ptr.get(nodes + 1).astype(np.int64), np.zeros(len(nodes), np.uint64)
            later = np.flatnonzero((lo > 0) & (lo < hi))
            base[later] = child.get(lo[later] - 1) + np.uint64(1)
            at, hit = child.find(base[of] + word[run].astype(np.uint64), lo[of], hi[of])
            found[run] = hit
            prob[np.arange(run.start, run.stop)[hit]] = third.coded("prob", at[hit])
        return found, prob

    def walk(self, number: np.ndarray, count: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        """For all tokens of the texts, by number (-1: unknown) and count: whether bigram and trigram are stored, and the log10 probability after the text so far."""
        first = np.zeros(len(number), dtype=bool)
        first[np.cumsum(lengths) - lengths] = True
        before = np.where(first, self.vocabulary, np.r_[-1, number[:-1]])
        # an unknown word's pair with its context is asked too, for the context's back-off weight
        ok = np.flatnonzero(before >= 0)
        key, of = np.unique((before[ok] << 32) | np.where(number[ok] >= 0, number[ok], 0xFFFFFFFF), return_inverse=True)
        pair = np.full(len(number), len(key))
        pair[ok] = of
        found = {k: np.r_[v, [-1 if k == "node" else 0]][pair] for k, v in self.pairs(key).items()}
        two = found["node"] >= 0
        p2 = np.where(two, found["prob"], found["back1"] + self.unigram(count))
        context = np.r_[0, np.arange(len(number) - 1)]  # the bigram before this token
        under = two[context] & ~first
        back = np.where(under, found["back2"][context], 0.0)
        three, p3 = np.zeros(len(number), dtype=bool), np.zeros(len(number))
        ok = np.flatnonzero(under & (number >= 0))
        ok = ok[np.argsort((pair[context[ok]] << 32) | number[ok])]
        if len(ok):
            at = context[ok]
            three[ok], p3[ok] = self.triples(found["part"][at], found["node"][at], number[ok])
        return {"two": two, "three": three, "p": np.where(three, p3, back + p2)}


def score(model: Model, texts: list[str]) -> dict[str, np.ndarray]:
    """n_tokens, n_known, base_score and score of each text."""
    hashes, lengths = tokens(texts)
    distinct, code = np.unique(hashes, return_inverse=True)
    number, count = (x[code] for x in model.words(distinct))
    p = model.walk(number, count, lengths)["p"]
    heads = np.cumsum(lengths) - lengths
    total = lambda x: np.add.reduceat(x, heads)
    return {"n_tokens": lengths, "n_known": total((count > 0).astype(np.int64)), "base_score": total(model.unigram(count)), "score": total(p)}


# --- building -----------------------------------------------------------------------------------------------------


def _blob(x: np.ndarray, y: np.ndarray, z: np.ndarray, c: np.ndarray) -> bytes:
    """Sorted trigrams and counts: steps of the first word, the second where the pair changes, the third, all by byte planes."""
    import zstandard

    new = np.zeros(len(x), dtype=bool)
    new[_heads(x, y)] = True
    planes = [a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in (np.diff(x, prepend=x[0]), np.where(new, y, 0), z, c)]
    return np.array([len(x), x[0]], dtype="<i8").tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unblob(raw: bytes) -> tuple[np.ndarray, ...]:
    import zstandard

    n, x0 = (int(i) for i in np.frombuffer(raw, dtype="<i8", count=2))
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[16:], max_output_size=16 * n), dtype=np.uint8).reshape(4, 4, n)
    dx, y, z, c = (np.ascontiguousarray(a.T).view("<u4").ravel().astype(np.int64) for a in flat)
    new = (dx > 0) | (y > 0)  # a second word 0 is the first of its first word
    new[0] = True
    return x0 + np.cumsum(dx), y[np.flatnonzero(new)[np.cumsum(new) - 1]], z, c


def _trigrams(code: np.ndarray, words: np.ndarray, lengths: np.ndarray, begin: int, piece: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Distinct (first, second, third + 1 or 0 where the text ends) and counts of at most `piece` tokens at once, in order.

    code: places in `words`, ascending word numbers, so that codes are small and in their order."""
    first = np.zeros(len(code) + 1, dtype=bool)
    first[np.cumsum(lengths) - lengths] = first[-1] = True
    for a in range(0, len(code), piece):
        b = min(len(code), a + piece)
        inner, of = code[max(0, a - 1) : b + 1], words
        if len(words) + 1 >= 1 << 21:
            seen, inner = np.unique(inner, return_inverse=True)
            of = words[seen]
        of = np.r_[-1, of, begin]
        inner = inner + 1
        here = inner[a - max(0, a - 1) :]
        x = np.where(first[a:b], len(of) - 1, (inner if a else np.r_[0, inner])[: b - a])
        z = np.where(first[a + 1 : b + 1], 0, np.r_[here[1:], 0][: b - a])
        bits = np.uint64((len(of) - 1).bit_length())
        key = ((x.astype(np.uint64) << bits | here[: b - a].astype(np.uint64)) << bits) | z.astype(np.uint64)
        key, c = np.unique(key, return_counts=True)
        mask = np.uint64((1 << int(bits)) - 1)
        yield of[(key >> (bits + bits)).astype(np.int64)], of[((key >> bits) & mask).astype(np.int64)], of[(key & mask).astype(np.int64)] + 1, c


def _relative(word: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Children's words added to the end of the context before."""
    some = width[width > 0]
    ends = word[np.cumsum(some) - 1] + 1
    return word + np.repeat(np.cumsum(ends) - ends, some)


def _absolute(child: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """The words again."""
    lo = ptr[:-1][np.diff(ptr) > 0]
    base = np.where(lo > 0, child[lo - 1] + 1, 0)
    return child - np.repeat(base, np.diff(ptr)[np.diff(ptr) > 0])


def learn(docs: DataFrame, part_tokens: int = PART_TOKENS, file_words: int = FILE_WORDS, count_tokens: int = COUNT_TOKENS) -> Model:
    """docs: text. Counts all of it."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    model = Model(f"{folder}/trie")
    docs = docs.select("text")

    def word_counts(batches):
        held, size = [], 0

        def out():
            h, c = _sums(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "c": pa.array(c)})

        for (texts,) in text_steps(batches):
            held.append(np.unique(tokens(texts)[0], return_counts=True))
            size += len(held[-1][0])
            if size > 3_000_000:
                yield out()
                size = 0
        if held:
            yield out()

    words = written(docs.mapInArrow(word_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), f"{folder}/words")
    totals = words.agg(F.count("*").alias("v"), F.sum("c").alias("n"), F.max(F.when(F.col("h") == 0, F.col("c"))).alias("d")).first()
    if not totals["v"]:
        return model
    model.vocabulary, model.tokens, model.documents = totals["v"], totals["n"], totals["d"]
    if model.vocabulary >= (1 << 31) - 1:
        raise ValueError("more than 2**31 distinct words: shard the corpus first")
    model.bits = max(0, math.ceil(math.log2(model.vocabulary / file_words)))

    def word_file(key, rows):
        f = key[0].as_py()
        h, c = rows.column("h").to_numpy().view(np.uint64), rows.column("c").to_numpy()
        order = np.argsort(h)
        h, c = h[order], c[order]
        _save(model.folder, f"words-{f:06d}", _with_ef({"count": c}, hash=h))
        follows = np.where(h == END, 0, c)  # nothing follows an end
        mass = np.cumsum(follows)
        hot = np.flatnonzero(follows > part_tokens)
        starts = np.unique(np.r_[0, _heads((mass - follows) // part_tokens), hot, hot + 1])
        starts = starts[starts < len(h)]
        return pa.table({"f": pa.array([f], pa.int64()), "n": pa.array([len(h)], pa.int64()), "starts": pa.array([starts.tolist()], pa.list_(pa.int64())), "hot": pa.array([hot.tolist()], pa.list_(pa.int64())), "c": pa.array([follows[hot].tolist()], pa.list_(pa.int64()))})

    shard = F.shiftrightunsigned("h", 64 - model.bits) if model.bits else F.lit(0).cast("long")
    made = words.withColumn("f", shard).groupBy("f").applyInArrow(word_file, "f long, n long, starts array<long>, hot array<long>, c array<long>").collect()
    model.word_at = np.concatenate([[0], np.cumsum(np.bincount([r["f"] for r in made], [r["n"] for r in made], minlength=1 << model.bits).astype(np.int64))])
    drop(spark, f"{folder}/words")
    begin = model.vocabulary
    starts = np.unique([int(model.word_at[r["f"]]) + s for r in made for s in r["starts"]] + [begin])
    hot = {int(model.word_at[r["f"]]) + i: c for r in made for i, c in zip(r["hot"], r["c"])}
    if model.documents > part_tokens:
        hot[begin] = model.documents
    model.hot = np.array(sorted(hot), dtype=np.int64)
    bounds = [0]
    for s in starts.tolist():
        # parts of a hot word begin at second words that divide the tokens of the whole corpus evenly, as the starts do
        k = min(len(starts), -(-hot[s] // part_tokens)) if s in hot else 1
        bounds += [(s << 32) | (int(starts[len(starts) * j // k]) if j else 0) for j in range(k)]
    model.bounds = np.unique(np.array(bounds, dtype=np.int64))
    model.sizes = np.zeros(len(model.bounds), dtype=np.int64)

    def counts(batches):
        for (texts,) in text_steps(batches, step=COUNT_CHARS):
            hashes, lengths = tokens(texts)
            distinct, code = np.unique(hashes, return_inverse=True)
            for x, y, z, c in _trigrams(code, model.words(distinct)[0], lengths, begin, count_tokens):
                for p, run in _runs(np.searchsorted(model.bounds, (x << 32) | y, side="right") - 1):
                    yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64()), "grams": pa.array([_blob(x[run], y[run], z[run], c[run])], pa.binary())})

    def part_file(key, rows):
        p = key[0].as_py()
        x, y, z, c = (np.concatenate(a) for a in zip(*(_unblob(r.as_py()) for r in rows.column("grams"))))
        x0, b = int(x.min()), (begin + 1).bit_length()
        if 2 * b + (int(x.max()) - x0).bit_length() <= 63:
            order = np.argsort((((x - x0) << b | y) << b) | z)
        else:
            order = np.lexsort((z, y, x))
        x, y, z, c = x[order], y[order], z[order], c[order]
        heads = _heads(x, y, z)
        x, y, z, c = x[heads], y[heads], z[heads], np.add.reduceat(c, heads)
        nodes = _heads(x, y)
        c2, width3 = np.add.reduceat(c, nodes), np.add.reduceat((z > 0).astype(np.int64), nodes)
        z, c3 = z[z > 0] - 1, c[z > 0]
        x, y = x[nodes], y[nodes]
        contexts = _heads(x)
        width = np.diff(np.r_[contexts, len(x)])
        none = np.zeros(0, np.int64)
        _save(model.folder, f"grams-{p:06d}", _with_ef({}, ctx=x[contexts], ptr=np.r_[contexts, len(x)], child=_relative(y, width), ptr3=np.r_[0, np.cumsum(width3)], child3=_relative(z, width3) if len(z) else none))
        many = np.flatnonzero(c3 > 254)
        _save(f"{folder}/counts", f"counts-{p:06d}", {"two": c2, "three": np.minimum(c3, 255).astype(np.uint8), "many": many, "much": c3[many]})
        return pa.table({"p": pa.array([p], pa.int64()), "n": pa.array([len(x)], pa.int64())})

    made = docs.mapInArrow(counts, "p long, grams binary").groupBy("p").applyInArrow(part_file, "p long, n long").collect()
    model.sizes[[r["p"] for r in made]] = [r["n"] for r in made]
    of_hot = np.searchsorted(model.hot, model.bounds >> 32)
    is_hot = np.isin(model.bounds >> 32, model.hot)
    model.hot_types = np.bincount(of_hot[is_hot], model.sizes[is_hot], minlength=len(model.hot)).astype(np.int64)
    filled = spark.createDataFrame([(int(p),) for p in np.flatnonzero(model.sizes)], "p long")
    filled = filled.repartition(max(1, min(int((model.sizes > 0).sum()), 4 * spark.sparkContext.defaultParallelism)), "p")

    def second(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                level, held = _load(model.folder, f"grams-{p:06d}"), _load(f"{folder}/counts", f"counts-{p:06d}", keep=False)
                ctx, ptr = level["ctx"].values().astype(np.int64), level["ptr"].values().astype(np.int64)
                word = _absolute(level["child"].values().astype(np.int64), ptr)
                width, width3, c2 = np.diff(ptr), np.diff(level["ptr3"].values().astype(np.int64)), held["two"]
                types = width.copy()
                if len(model.hot):
                    at = np.minimum(np.searchsorted(model.hot, ctx), len(model.hot) - 1)
                    types = np.where(model.hot[at] == ctx, model.hot_types[at], width)
                total = model.counts_of(ctx).astype(np.float64)
                left = DISCOUNT * types / total
                prob = (c2 - DISCOUNT) / np.repeat(total, width) + np.repeat(left, width) * 10.0 ** model.unigram(model.counts_of(word))
                back2 = np.where(width3 > 0, np.log10(np.maximum(DISCOUNT * width3, DISCOUNT) / c2), 0.0)
                _save(model.folder, f"second-{p:06d}", _with_codes({}, prob=np.log10(prob), back1=np.log10(left), back2=back2))
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64())})

    def third(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                level, held = _load(model.folder, f"grams-{p:06d}"), _load(f"{folder}/counts", f"counts-{p:06d}", keep=False)
                ptr = level["ptr3"].values().astype(np.int64)
                width = np.diff(ptr)
                word = _absolute(level["child3"].values().astype(np.int64), ptr)
                middle = _absolute(level["child"].values().astype(np.int64), level["ptr"].values().astype(np.int64))
                key, of = np.unique((np.repeat(middle, width) << 32) | word, return_inverse=True)
                shorter = model.pairs(key)["prob"][of]
                c3 = held["three"].astype(np.float64)
                c3[held["many"]] = held["much"]
                total = np.repeat(held["two"].astype(np.float64), width)
                prob = (c3 - DISCOUNT) / total + DISCOUNT * np.repeat(width, width) / total * 10.0**shorter
                _save(model.folder, f"third-{p:06d}", _with_codes({}, prob=np.log10(prob)))
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64())})

    for step in (second, third):
        filled.mapInArrow(step, "p long").write.format("noop").mode("overwrite").save()
    drop(spark, f"{folder}/counts")
    return model


def scored(df: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score for every row."""

    def rows(batches):
        for keys, texts in text_steps(batches, key):
            found = score(model, texts)
            yield pa.RecordBatch.from_pydict({key: pa.array(keys, pa.int64()), "train_tokens": pa.array([model.tokens] * len(keys), pa.int64())} | {k: pa.array(v) for k, v in found.items()})

    return df.select(F.col(key).cast("long").alias(key), "text").mapInArrow(rows, f"{key} long, train_tokens long, n_tokens long, n_known long, base_score double, score double")


def query(documents: DataFrame) -> DataFrame:
    held = fold("doc_id", 5) == 1
    with small_batches(documents.sparkSession, "8m"):
        model = learn(documents.where(F.coalesce(~held, F.lit(True))))
    return scored(documents, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

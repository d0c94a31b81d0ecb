"""The trie holds n-grams that occur once."""

import numpy as np
import pytest

from tallymart.llm import trie


def test_ngrams_seen_once_are_stored(spark):
    docs = spark.createDataFrame([("a b c d",), ("a b e",)], "text string")
    model = trie.learn(docs)
    hashes, lengths = trie.tokens(["a b c d", "a b e", "c a"])
    distinct, code = np.unique(hashes, return_inverse=True)
    number, count = model.words(distinct)
    w = model.walk(number[code], count[code], lengths)
    assert w["two"][:9].all()  # every bigram of the training texts, ends and beginnings included
    first = np.array([True, False, False, False, False, True, False, False, False])
    assert (w["three"][:9] == ~first).all()  # the first token of a text has no trigram
    assert not w["two"][9:].any() and not w["three"][9:].any()

    n, v, d = 9, 6, trie.DISCOUNT
    p1 = lambda c: (c + 0.5) / (n + 0.5 * (v + 1))
    p_bc = (1 - d) / 2 + (1 - 2 * (1 - d) / 2) * p1(1)
    p_abc = (1 - d) / 2 + (1 - 2 * (1 - d) / 2) * p_bc
    assert w["p"][2] == pytest.approx(np.log10(p_abc), abs=1e-6)


def test_words_by_their_bytes():
    texts = ["One two", "", " x\u00a0y\tONE " + "q" * 63 + " " + "q" * 64 + " " + "q" * 65 + " " + "q" * 5000 + "\n", "\x1c a\x00 a", "\u0130 \u00e9\u00c9 two"]
    want = [t.encode().lower().split() for t in texts]
    hashes, lengths = trie.tokens(texts)
    assert lengths.tolist() == [len(w) + 1 for w in want]
    flat = [w for ws in want for w in [*ws, None]]
    assert len({h for h in hashes.tolist()}) == len(set(flat)) == len(set(zip(flat, hashes.tolist())))
    assert all((h == trie.END) == (w is None) for w, h in zip(flat, hashes))

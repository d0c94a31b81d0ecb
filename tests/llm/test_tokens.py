import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import bpe, packing, tokenfile
from tallymart.llm.common import shared_dir
from tallymart.llm.queries import tokenizer_file
from tallymart.llm.tokens import WordCoder

WORDS, BYTES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
text = st.text(alphabet=st.one_of(st.sampled_from("aeÉßthing '.,!%$0129 \n\t  \x1c\x85漢İΣ́<|>"), st.characters(exclude_categories=["Cs"])), max_size=60)


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coders():
    return WordCoder(WORDS), library(WORDS), bpe.Codec(BYTES), library(BYTES)


@settings(max_examples=300, deadline=None)
@given(t=text)
def test_ids_equal_the_library(coders, t):
    words, word_lib, codec, byte_lib = coders
    assert np.frombuffer(words.encode([t])[0], "<u4").tolist() == word_lib.encode(t, add_special_tokens=False).ids
    ids = codec.encode([t])[0]
    want = byte_lib.encode(t, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert codec.decode(ids) == byte_lib.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("bits", range(1, 33))
def test_bits_round_trip(bits):
    x = np.random.default_rng(bits).integers(0, 1 << bits, 777).astype("<u4")
    raw = tokenfile.pack(x, bits)
    assert len(raw) == -(-777 * bits // 8) and (tokenfile.unpack(raw, 777, bits) == x).all()


def test_width():
    assert [tokenfile.width(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_random_access(tmp_path):
    from pyarrow import fs

    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 5000, n).astype("<u4") for n in (0, 3, 700, 1, 0, 90, 4000)]
    store = fs.LocalFileSystem()
    with store.open_output_stream(str(tmp_path / "x")) as out:
        w = tokenfile.Writer(out, 13, block_ids=64)
        for i, d in enumerate(docs):
            w.add(i, d)
        w.close()
    with store.open_input_file(str(tmp_path / "x")) as f:
        r = tokenfile.Reader(f)
        for i in (6, 0, 3, 5, 2):
            assert (r.document(i) == docs[i]).all()
        assert [x[2].tolist() for x in r.documents()] == [d.tolist() for d in docs]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def wanted(rows):
    lib = library(WORDS)
    return [(d, [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]


def test_token_files(spark, sf_dir, odd, none):
    from tallymart.llm.queries import op2_packed_token_ids

    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    start, want = 0, []
    for d, ids in wanted(rows):
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, op2_packed_token_ids(spark, sf_dir).collect())) == want
    got = tokenfile.query(odd, WORDS).collect()
    assert len(got) == odd.count() and min(r.start for r in got if r.doc_id is None) == 0
    assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
    assert tokenfile.query(none, WORDS).collect() == []
    folder = shared_dir(spark)
    back = tokenfile.read(spark, folder, tokenfile.write(odd, folder, WORDS)).collect()
    assert {(r.doc_id, bytes(r.ids)) for r in back} == {(d, np.array(i, "<u4").tobytes()) for d, i in wanted((r.doc_id, r.text) for r in odd.collect())}


def check_packed(got, docs, capacity=4096):
    bins, by_doc = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(len(i) for _, i in docs)
    assert sum(r.length for r in got) == total
    for d, ids in docs:
        for r in by_doc[d]:
            if r.start < len(ids) and r.piece * capacity == r.start:
                assert any(r2.piece == r.piece and r2.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r2 in by_doc[d])
    return len(bins), -(-total // capacity)


def test_packing(spark, sf_dir, odd, none):
    from tallymart.llm.queries import op8_dominance_packing

    docs = wanted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    n, least = check_packed(op8_dominance_packing(spark, sf_dir).collect(), docs)
    assert n <= least + 1
    check_packed(packing.packed(odd, WORDS).collect(), wanted((r.doc_id, r.text) for r in odd.collect()))
    assert packing.packed(none, WORDS).collect() == []


def optimum(sizes, capacity):
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) < best[0]:
            if i == len(sizes):
                best[0] = len(bins)
                return
            for k in {b: k for k, b in enumerate(bins) if b + sizes[i] <= capacity}.values():
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
            go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(sizes=st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_an_optimum(sizes):
    plan = packing.Plan(np.bincount(sizes, minlength=21), 20)
    assert optimum(sorted(sizes, reverse=True), 20) <= plan.bins <= optimum(sorted(sizes, reverse=True), 20) + 1
    assert sum(r[2] for r in plan.runs) == len(sizes)


def test_bpe_query(spark, odd, none):
    got = {r.doc_id: r for r in bpe.query(odd, BYTES).collect()}
    assert got[2].n_tokens == 0 and got[3].ids_sha256 == got[2].ids_sha256 and got[1].ids_sha256 == got[5].ids_sha256
    assert bpe.query(none, BYTES).collect() == []
    assert all(r.decoded == (r.text or "") for r in bpe.encoded(odd, BYTES).join(odd.select("doc_id", "text"), "doc_id").collect())

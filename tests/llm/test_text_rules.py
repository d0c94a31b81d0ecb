import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import language, quality, rollup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    ws = WORD.findall(text)
    wins = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    inside = {i + k for i in range(len(ws) - 4) if wins[tuple(ws[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def measures(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(quality.query(df).collect())
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]


def test_base_measures(spark, odd, none):
    texts = [None, "", " \n\t", "a b c d e a b c d e a b c d e", "x y\nx y\n\nx y \nx y", "é漢 \x1c\x85 😀 #*$", "a " * 3000, "a b c d e f a b c d e", "1 2 3 4"]
    assert measures(spark, texts) == [by_hand(t) for t in texts]
    assert quality.query(none).collect() == [] and quality.query(odd).count() == odd.count()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t.|#é", max_size=120), min_size=1, max_size=20))
def test_base_measures_of_any_text(spark, texts):
    assert measures(spark, texts) == [by_hand(t) for t in texts]


def test_verdicts(spark):
    clean = "This is a plain line of prose, with an end.\n"
    cases = {
        clean * 1 + "Another line of prose that says something else.": True,
        "Too short.": False,
        clean + "Home | About | Contact | Login | More | Terms | Help | Site | Map | Index | News | Jobs": False,
        "\n".join(f"item {i} | price {i} | add to basket" for i in range(9)): False,
        "SHOUTING LINES ARE NOT PROSE AT ALL, THEY SAY!! ONE MORE TIME, THEY SAY NOTHING!!": False,
        clean + "No end here": True,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert [r.kept for r in sorted(quality.judged(df).select("doc_id", "kept").collect())] == list(cases.values())


def test_quality_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = quality.query(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = con.execute(quality.SQL)
    at = [c[0] for c in found.description]
    assert sorted(tuple(r[c] for c in at) for r in df.collect()) == sorted(found.fetchall())


def test_language(spark, sf_dir, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.query(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    found = {r.doc_id: r for r in language.labelled(odd, language.fit(docs)).collect()}
    assert len(found) == odd.select("doc_id").distinct().count()
    assert [found[k].lang_pred for k in (2, 3, 7)] == ["und"] * 3 and found[1].lang_pred == "en"
    assert all(r.lang_pred == "und" for r in language.labelled(odd, language.fit(none)).collect())
    assert language.query(none).collect() == []


def test_toxicity(spark, odd, none):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.query(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.96
    assert sum(r.predicted for r in held if not r.toxic) <= 0.01 * len(held)
    assert toxicity.query(none, labels).collect() == []
    none_labelled = toxicity.query(odd, labels.limit(0)).collect()
    assert len(none_labelled) == odd.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in none_labelled)


def test_composition_is_all_paths():
    """The composed machine against the five transducers run one by one over every string of up to five symbols."""
    from itertools import product

    for n in range(6):
        for symbols in product("itTNR", repeat=n):
            states, total, last = [""] * 5, 0.0, 0.0
            for s in symbols:
                steps = [t.step(q, s) for t, q in zip(toxicity.GRAMMAR, states)]
                if s in "it":
                    last = math.prod(x[1] for x in steps)
                    total += last
                else:
                    total += max(x[2] for x in steps) * last
                states = [x[0] for x in steps]
            assert toxicity.clause_weight([(s, 1.0) for s in symbols])[0] == pytest.approx(total)
    weight = lambda s: toxicity.clause_weight([(c, 1.0) for c in s])[0]
    assert weight("Ti") > weight("i") > weight("Ri") > weight("Ni") > weight("NRi") and weight("TNi") > weight("Ni") and weight("t") < weight("i") < weight("iT")
    assert len({a for (a, _) in toxicity.MACHINE.arcs}) == 20


def test_short_words_and_null_ids(spark, odd):
    """A word shorter than a stem is learned whole; null ids are not held out."""
    docs = spark.createDataFrame([(i, f"you ass now w{i}" if i % 2 else f"the assembly met w{i}") for i in range(400)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.query(docs, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None) and [r.held_out for r in got if r.doc_id is None] == [False]


def test_language_by_hand(spark):
    """Sizes against plain zstandard calls, one text and one dictionary at a time."""
    import zstandard

    rows = [(i, f"{w} haus und garten {i}" if i % 2 else f"{w} house and garden {i}", "de" if i % 2 else "en") for i, w in enumerate(["alpha", "beta", "gamma", "delta"] * 10)]
    found = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["the house and the garden", "das haus und der garten", "x" * 7001, "é" * 1999 + " house"]
    want = []
    for t in texts:
        raw, sizes = t.lower().encode(), []
        for d in found.dictionaries:
            z = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(z.compress(raw[a : a + language.PIECE])) for a in range(0, len(raw), language.PIECE)))
        want.append(sizes)
    assert abs(language.encoded_sizes(texts, found.compressors()) - want).max() <= 8
    best = {r.text: r.lang_pred for r in language.labelled(spark.createDataFrame([(t,) for t in texts], "text string"), found).collect()}
    assert best[texts[0]] == "en" and best[texts[1]] == "de"
    assert sorted(len(d.split(b"\n")) for d in found.dictionaries) == [20, 20]


def test_grammar_weighs_clauses():
    a = toxicity.Grammar({"idiot": 2.0}).automaton()
    top = lambda t: toxicity.features(t, a)[1]
    assert top("you are an idiot.") > top("an idiot.") > top("he said idiot.") > top("never an idiot.") > top("nothing.") == 0
    assert top("he is not bad. what an idiot") == top("idiot")
    assert toxicity.features("videoidiot", a)[1] == 0
    assert toxicity.features("", a) == [1.0, 0, 0, 0, 0, 0]


def test_rollup_counts(spark, sf_dir, odd, none):
    """The totals against the library's own counts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    paths = [public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")]
    library = [Tokenizer.from_file(p) for p in paths]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df in (docs, odd):
        want = {}
        for r in df.collect():
            v = 2 if r.doc_id is not None and r.doc_id % 3 == 0 else 1
            n = len(library[v - 1].encode(r.text or "", add_special_tokens=False).ids)
            d, t = want.get((r.source, r.lang, v), (0, 0))
            want[r.source, r.lang, v] = (d + 1, t + n)
        assert {tuple(x[:3]): tuple(x[3:]) for x in rollup.query(df, *paths).collect()} == want
    assert rollup.query(none, *paths).collect() == []


def test_rollup(spark, tmp_path):
    r = rollup.TokenRollup(spark, str(tmp_path / "r"))
    rows = lambda *x: spark.createDataFrame(x, "source string, lang string, tokenizer_version int, n_tokens long")
    assert r.totals().collect() == []
    assert r.commit("b1", rollup.inserts(rows(("s", "en", 1, 10), ("s", "en", 1, None), (None, None, 1, 5))))
    assert not r.commit("b1", rollup.inserts(rows(("s", "en", 1, 10))))
    assert r.commit("b2", rollup.revisions(rows(("s", "en", 1, 10)), rows(("s", "en", 2, 12))))
    assert r.commit("b3", rollup.deletes(rows((None, None, 1, 5)))) and r.commit("b4", rollup.inserts(rows(("t", "de", 1, 1)).limit(0)))
    for _ in range(2):
        assert {tuple(x) for x in r.totals().collect()} == {("s", "en", 1, 1, 0), ("s", "en", 2, 1, 12)}
        r.compact()
    assert not r.commit("b1", rollup.inserts(rows(("s", "en", 1, 10)))) and r.commit("b5", rollup.inserts(rows(("u", "fr", 1, 7))))
    assert {tuple(x) for x in r.totals().collect()} == {("s", "en", 1, 1, 0), ("s", "en", 2, 1, 12), ("u", "fr", 1, 1, 7)}
    assert r.sweep(3600) == 0 and r.sweep(0) == 4 and len(r._names("deltas")) == 2  # the base and b5
    assert not r._put(["other"], "commits/b5") and r._lines("commits/b5") != ["other"]  # of two committers at once one wins
    with pytest.raises(ValueError):
        r.commit("../x", rollup.inserts(rows(("s", "en", 1, 1))))


def test_compaction_meets_others(spark, tmp_path):
    rows = lambda n: rollup.inserts(spark.createDataFrame([("s", "en", 1, n)], "source string, lang string, tokenizer_version int, n_tokens long"))
    totals = lambda r: [tuple(x) for x in r.totals().collect()]
    path = str(tmp_path / "r")

    class Slow(rollup.TokenRollup):
        """Does something else after its base is written and before it is put in place."""

        meanwhile = None

        def _put(self, lines, final):
            if self.meanwhile and final.startswith(self.where):
                job, self.meanwhile = self.meanwhile, None
                job()
            return super()._put(lines, final)

    def slow(where, job):
        r = Slow(spark, path)
        r.where, r.meanwhile = where, job
        return r

    plain = rollup.TokenRollup(spark, path)
    plain.commit("b1", rows(1)), plain.commit("b2", rows(2))
    held = plain.totals()  # a reader from before
    assert not slow("bases", lambda: plain.compact()).compact()  # the other compaction came first
    assert totals(plain) == [("s", "en", 1, 2, 3)] and [tuple(x) for x in held.collect()] == [("s", "en", 1, 2, 3)]
    plain.commit("b3", rows(3))
    assert slow("bases", lambda: plain.commit("b4", rows(4))).compact()  # a commit during a compaction
    assert totals(plain) == [("s", "en", 1, 4, 10)] and [tuple(x) for x in held.collect()] == [("s", "en", 1, 2, 3)]
    assert slow("commits", lambda: (plain.compact(), plain.sweep(3600))).commit("b5", rows(5))  # a compaction during a commit, its delta written but not named
    assert totals(plain) == [("s", "en", 1, 5, 15)]
    assert plain.compact() and plain.sweep(0) > 0 and not plain.compact()
    assert totals(plain) == [("s", "en", 1, 5, 15)] and len(plain._names("deltas")) == 1


def test_callers_columns_stay(spark):
    df = spark.createDataFrame([(1, "A plain line of prose, with an end.", "a", "b")], "doc_id long, text string, _ws string, _good string")
    got = quality.judged(df).first()
    assert (got["_ws"], got["_good"], got.n_words) == ("a", "b", 8)


def test_logistic_learns():
    import numpy as np

    x = np.array([[1.0, 0], [1.0, 0], [1.0, 3], [1.0, 4]])
    w = toxicity._fit_logistic(x, np.array([0, 0, 1, 1.0]))
    assert 1 / (1 + math.exp(-(x[3] @ w))) > 0.9

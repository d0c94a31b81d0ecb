"""Language identification by compression.

Each language has a zstandard raw-content dictionary cut from training texts. A text is encoded piece by piece with every
dictionary, and the language with the smallest sum wins; short pieces keep a long text from becoming its own dictionary.
A label is rejected when the winner's margin over the runner-up is narrow.

A null text, or one without a letter, is `und`, score 0 and rejected. Ties go to the language with more training texts,
then to the smaller name. Without any training row every text is `und`. Repeated rows are labelled alike. A null id is not
held out, and nothing is learned from it. The languages are few: each has its dictionary in every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.llm.common import fold, text_steps

#: Bound of what is learned from: training texts of each language, the first by hash of the id, each of them whole.
FIT_TEXTS = 60
LEVEL, PIECE = 6, 2_000
#: A margin below this share of the winner's size is narrow; what is asked grows with the text, to half at HALF characters, as a short one can show little.
MIN_MARGIN, HALF = 0.01, 200


@dataclass
class Languages:
    names: list[str]
    dictionaries: list[bytes]

    def compressors(self):
        import zstandard

        out = []
        for d in self.dictionaries:
            zd = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            zd.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=zd, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out


def fit(labelled: DataFrame, key: str = "doc_id") -> Languages:
    """labelled: key, text, lang. Takes the FIT_TEXTS texts of each language whose ids hash lowest; of several texts of one id the largest."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col(key).isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64(key), key)
    ids = rows.select(key, "lang").groupBy("lang", key).agg(F.count("*").alias("texts"))
    picked = ids.withColumn("at", F.row_number().over(order)).where(F.col("at") <= FIT_TEXTS).drop("texts")
    found = rows.select(key, "lang", "text").join(F.broadcast(picked), [key, "lang"]).groupBy("lang", "at").agg(F.max("text").alias("text")).collect()
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    parts: dict[str, dict[bytes, None]] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["at"])):
        parts.setdefault(r["lang"], {})[r["text"].lower().encode()] = None
    names = sorted(parts, key=lambda n: (-counts[n], n))
    return Languages(names, [b"\n".join(parts[n]) + b"        " for n in names])


def encoded_sizes(texts: list[str], compressors) -> np.ndarray:
    """Encoded bytes of each text, letter case folded, under each dictionary."""
    out = np.zeros((len(texts), len(compressors)), dtype=np.int64)
    for i, t in enumerate(texts):
        raw = t.lower().encode()
        for at in range(0, len(raw), PIECE):
            piece = raw[at : at + PIECE]
            for k, c in enumerate(compressors):
                out[i, k] += len(c.compress(piece))
    return out


def _verdicts(texts: list[str], names: np.ndarray, compressors) -> dict[str, pa.Array]:
    n = len(compressors)
    spoken = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool) & bool(n)
    sizes = np.full((len(texts), max(2, n)), 1.0e18)
    sizes[:, :n] = encoded_sizes([t if s else "" for t, s in zip(texts, spoken)], compressors)
    best = sizes.argmin(axis=1)
    two = np.sort(sizes, axis=1)[:, :2]
    margin = np.where(spoken, np.minimum(1.0, (two[:, 1] - two[:, 0]) / np.maximum(two[:, 0], 1.0)), 0.0)
    chars = np.array([len(t) for t in texts], dtype=np.int64)
    return {
        "lang_pred": pa.array(names[np.where(spoken, best, n)].tolist(), pa.string()),
        "score": pa.array(np.where(spoken, 1 / (1 + np.exp(-50 * margin)), 0.0)),
        "margin": pa.array(margin),
        "rejected": pa.array(~spoken | (margin < MIN_MARGIN * chars / (chars + HALF))),
    }


def labelled(df: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """df with lang_pred, score, margin and rejected; columns of these names in df are replaced."""
    made = T.StructType().add("lang_pred", "string").add("score", "double").add("margin", "double").add("rejected", "boolean")
    names = made.names
    df = df.drop(*(c for c in names if c in df.columns and c != text))

    def rows(batches):
        compressors, tags = languages.compressors(), np.array([*languages.names, "und"], dtype=object)
        for batch in batches:
            at = 0
            for (texts,) in text_steps([batch], text=text):
                found = _verdicts(texts, tags, compressors)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, *(found[n] for n in names)], [*part.schema.names, *names])

    return df.mapInArrow(rows, T.StructType([*df.schema.fields, *made.fields]))


def query(documents: DataFrame) -> DataFrame:
    held = fold("doc_id", 4) == 2
    languages = fit(documents.where(~held).select("doc_id", "text", "lang"))
    out = labelled(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), languages)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score", "margin", "rejected")

"""Language by the nearest of several centroids of TF-IDF vectors of character n-grams.

Texts become vectors of hashed byte n-grams (1 to 3 bytes of lower-cased words and
their borders, ``DIMS`` numbers): (1 + ln tf) * idf, normalised to length 1. The idf
counts all training documents. Per language, spherical k-means finds ``CENTROIDS``
centroids among ``SAMPLE_ROWS`` / languages (at most ``PER_LANGUAGE``) documents,
each language in a task of its own. A text gets the language of the nearest centroid
by cosine, and is marked rejected if it is farther from it than nearly all (``TAIL``)
of the sampled texts that are nearest to that centroid.

Defined results: ``und`` with score 0 for a null text, one without letters, or where
nothing was learned; a rejected text still names its nearest language; ties go to the
first language by code point; training rows with null text, language or id teach
nothing; repeated rows are predicted each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riftlog.llm.text import LOWER, carried, column_bytes, mix, pieces

DIMS = 4096
SAMPLE_ROWS, PER_LANGUAGE, CENTROIDS, ROUNDS = 8_000, 1_000, 4, 12
TAIL = 0.005
LETTER = r"\p{L}"
UNKNOWN = "und"

_FOLDED = np.where(LOWER > 0, LOWER, 32).astype(np.uint32)


def term_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """For pieces of a batch: the first row, and the n-gram counts (rows x DIMS)."""
    raw, off = column_bytes(column)
    for a, b in pieces(off, rows=256):
        cut = off[a : b + 1] - off[a]
        folded = _FOLDED[raw[off[a] : off[b]]]
        row = np.repeat(np.arange(b - a), np.diff(cut))
        out = np.zeros((b - a) * DIMS, np.int64)
        code = np.zeros(len(folded), np.uint32)
        for n in (1, 2, 3):
            m = len(folded) - n + 1
            if m <= 0:
                break
            code = code[:m] * np.uint32(256) + folded[n - 1 :]
            inside = row[:m] == row[n - 1 :]
            place = _BUCKET[n][code] if n < 3 else (mix(code) & np.uint64(DIMS - 1)).astype(np.int64)
            out += np.bincount((row[:m] * DIMS + place)[inside], minlength=len(out))
        yield a, out.reshape(b - a, DIMS)


_BUCKET = {n: (mix(np.arange(256**n, dtype=np.uint64) + np.uint64(n << 32)) & np.uint64(DIMS - 1)).astype(np.int64) for n in (1, 2)}


@dataclass
class Model:
    langs: np.ndarray  # of each centroid, sorted
    centroids: np.ndarray  # (centroids, DIMS), of length 1
    nearest: np.ndarray  # cosine below which a text is rejected, per centroid
    idf: np.ndarray


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.zeros(counts.shape, np.float32)
    seen = counts > 0
    x[seen] = 1 + np.log(counts[seen])
    x *= idf.astype(np.float32)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norm, out=x, where=norm > 0)


def spherical_kmeans(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and, for each, the cosine that the share TAIL of its rows lies below.
    The first centre is the row nearest the mean, the next ones the farthest rows."""
    centre = x[[(x @ x.mean(0)).argmax()]]
    while len(centre) < min(k, len(x)):
        centre = np.vstack([centre, x[[(x @ centre.T).max(1).argmin()]]])
    for _ in range(ROUNDS):
        own = (x @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-9), centre)
    near = x @ centre.T
    own, best = near.argmax(1), near.max(1)
    tail = [np.quantile(best[own == c], TAIL) if (own == c).any() else 0.0 for c in range(len(centre))]
    return centre, np.array(tail)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", where: Column | None = None) -> Model:
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    known = known if where is None else known.where(where)
    known = known.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS + 1, np.int64), 0
        for batch in batches:
            for _, counts in term_counts(batch.column("text")):
                df[:DIMS] += (counts > 0).sum(0)
                n += len(counts)
        df[DIMS] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["dim", "n"])

    frequency = known.select("text").mapInArrow(document_frequency, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIMS + 1)
    df[frequency["dim"]] = frequency["n"]
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1
    # One row per language; the sample is bounded however many there are.
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return Model(np.empty(0, object), np.empty((0, DIMS), np.float32), np.empty(0), idf)
    most = min(PER_LANGUAGE, max(SAMPLE_ROWS // len(sizes), 1))
    draw = F.pmod(F.xxhash64(F.lit(0), "id"), F.lit(1 << 30))
    limit = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, int(min(1.0, most / n) * (1 << 30)))])
    sample = known.where(draw < F.element_at(limit, F.col("lang"))).repartition("lang")

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.concatenate([vectors(c, idf) for _, c in term_counts(pa.array(frame.sort_values("id")["text"], pa.large_string()))])
        x = x[(x * x).sum(1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centre": [], "tail": []})
        centre, tail = spherical_kmeans(x, CENTROIDS)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centre": [c.astype(np.float32).tobytes() for c in centre], "tail": tail})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre binary, tail double").toPandas()
    found = found.sort_values(["lang", "centre"])
    centroids = np.stack([np.frombuffer(c, np.float32) for c in found["centre"]]) if len(found) else np.empty((0, DIMS), np.float32)
    return Model(found["lang"].to_numpy(object), centroids, found["tail"].to_numpy(float), idf)


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``lang_pred``, ``cosine``, ``rejected``."""
    payload, texts_of = carried(docs, text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = texts_of(batch)
            letters = pc.fill_null(pc.match_substring_regex(text, LETTER), False).to_numpy(zero_copy_only=False)
            for first, counts in term_counts(text):
                rows = len(counts)
                lang, cosine, rejected = np.full(rows, UNKNOWN, object), np.zeros(rows), np.ones(rows, bool)
                ok = letters[first : first + rows] & bool(len(model.langs))
                if ok.any():
                    near = vectors(counts[ok], model.idf) @ model.centroids.T
                    best = near.argmax(1)
                    lang[ok], cosine[ok] = model.langs[best], np.clip(near.max(1), 0, 1)
                    rejected[ok] = near.max(1) < model.nearest[best]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, rows), pa.array(lang, pa.string()), pa.array(cosine), pa.array(rejected)],
                    names=["row", "lang_pred", "cosine", "rejected"],
                )

    added = T.StructType.fromDDL("lang_pred string, cosine double, rejected boolean")
    return payload.mapInArrow(run, T.StructType(payload.select("row").schema.fields + added.fields))

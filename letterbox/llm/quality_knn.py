"""Quality by nearest-neighbour voting: labelled documents as latent-semantic vectors, exact cosines, weighted labels.

A text's terms are hashed byte trigrams, weighted by log count and inverse
document frequency, and the shares of its words that repeat one of the four
words before them. A truncated singular value decomposition over the labelled
documents makes them short vectors. The labelled vectors are sent to every
worker; each text is compared with all of them in blocks.

A NULL or empty text has the zero vector: all cosines are zero, and its score is
the share of label 1. Rows that repeat get equal scores; NULL ids are carried
through. Very long texts are read whole, in a slice of their own. Of labelled texts
tied for the last place among the neighbours some vote, the same ones for the same
cosines. An empty table gives an empty result; without labels all scores are 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common
from .common import ID, TEXT, column

#: Hashed trigram terms.
TERMS = 2048
#: Distances at which a repeated word is looked for.
LAGS = 4
#: Labelled documents at most: those with the smallest hash of their id. This bounds what is sent to workers.
MAX_LABELLED = 4096
#: Texts whose weights are worked out at once.
BLOCK = 256


@dataclass(frozen=True)
class Model:
    """All a worker needs: under 2 MB with the default sizes."""

    idf: np.ndarray
    axes: np.ndarray  # (TERMS + LAGS, dimensions)
    vectors: np.ndarray  # (labelled, dimensions), of length 1
    labels: np.ndarray
    neighbours: int = 15
    power: int = 8


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed trigrams of each text, and the share of words that repeat the one 1 to ``LAGS`` before."""
    n = len(offsets) - 1
    text_of = np.repeat(np.arange(n), np.diff(offsets))
    wide = data.astype(np.uint32)
    three = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    hashed = ((three * np.uint32(2654435761)) >> np.uint32(32 - TERMS.bit_length() + 1)).astype(np.int64)
    whole = text_of[:-2] == text_of[2:]
    counts = np.bincount((text_of[:-2] * TERMS + hashed)[whole], minlength=n * TERMS).reshape(n, TERMS)

    inside, starts, ends = common.words(data, offsets)
    repeats = np.zeros((n, LAGS), np.float32)
    if len(starts):
        code, _ = common.codes(data, inside, starts, ends)
        n_words = common.per_text(starts, offsets)
        of = np.repeat(np.arange(n), n_words)
        for lag in range(1, min(LAGS, len(code) - 1) + 1):
            same = (code[lag:] == code[:-lag]) & (of[lag:] == of[:-lag])
            repeats[:, lag - 1] = np.bincount(of[lag:][same], minlength=n)
        repeats /= np.maximum(n_words, 1)[:, None]
    return counts.astype(np.float32), repeats


def weighted(counts: np.ndarray, repeats: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length 1: trigram weights and, of comparable size, the roots of the repeat shares."""
    found = np.log1p(counts) * idf
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)
    found = np.hstack([found, np.sqrt(repeats)]).astype(np.float32)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        for row in range(0, batch.num_rows, BLOCK):
            part = batch.slice(row, BLOCK)
            counts, repeats = terms(*common.byte_view(part.column(TEXT)))
            blobs = [c.astype("<f4").tobytes() + r.astype("<f4").tobytes() for c, r in zip(counts, repeats)]
            yield pa.RecordBatch.from_arrays(
                [part.column(ID), part.column("lb_label"), pa.array(blobs, pa.binary())], [ID, "lb_label", "lb_terms"]
            )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms are mostly zero bytes; packed, they are a fraction of that in the driver."""
    for batch in batches:
        blobs = [zlib.compress(b.as_buffer(), 1) for b in batch.column("lb_terms")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(ID), batch.column("lb_label"), pa.array(blobs, pa.binary())], [ID, "lb_label", "lb_terms"]
        )


def _unpacked(blobs: pa.ChunkedArray) -> Iterator[np.ndarray]:
    for row in range(0, len(blobs), BLOCK):
        raw = b"".join(zlib.decompress(b) for b in blobs.slice(row, BLOCK).to_pylist())
        yield np.frombuffer(raw, "<f4").reshape(-1, TERMS + LAGS)


def _weighted_rows(blobs: pa.ChunkedArray, idf: np.ndarray) -> np.ndarray:
    """``weighted`` of all rows, with a block's intermediate arrays only."""
    found = np.empty((len(blobs), TERMS + LAGS), np.float32)
    for i, table in enumerate(_unpacked(blobs)):
        found[i * BLOCK : i * BLOCK + len(table)] = weighted(table[:, :TERMS], table[:, TERMS:], idf)
    return found


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    usable: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    max_labelled: int = MAX_LABELLED,
    dimensions: int = 64,
    neighbours: int = 15,
) -> Model:
    """Learn from at most ``max_labelled`` rows of ``labels`` that are ``usable``; a bounded, repeatable sample."""
    known = labels.select(column(id_column).cast("long").alias(ID), column(label).cast("int").alias("lb_label"))
    known = known.filter(F.col(ID).isNotNull() & F.col("lb_label").isin(0, 1))
    if usable is not None:
        known = known.filter(usable)
    # An id labelled twice counts as its largest label.
    known = known.groupBy(ID).agg(F.max("lb_label").alias("lb_label"))
    sample = known.orderBy(F.xxhash64(ID), ID).limit(max_labelled)
    rows = (
        common.ids_and_texts(docs, id_column, text_column)
        .join(F.broadcast(sample), ID)
        .mapInArrow(_training_rows, f"{ID} long, lb_label int, lb_terms binary")
        # Rows that repeat an id must not make the sample grow.
        .groupBy(ID)
        .agg(F.min(F.struct("lb_label", "lb_terms")).alias("row"))
        .select(ID, "row.*")
        .mapInArrow(_packed, f"{ID} long, lb_label int, lb_terms binary")
        .toArrow()
        .sort_by(ID)
    )
    width = TERMS + LAGS
    if not rows.num_rows:
        return Model(np.ones(TERMS, np.float32), np.zeros((width, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    blobs = rows.column("lb_terms")
    given = rows.column("lb_label").to_numpy().astype(np.float32)
    seen = sum((table[:, :TERMS] > 0).sum(axis=0) for table in _unpacked(blobs))
    idf = (np.log((1 + len(blobs)) / (1 + seen)) + 1).astype(np.float32)
    # The driver holds the rows or the decomposition, whose working space is five such matrices, never both.
    found = _weighted_rows(blobs, idf)
    square = (found.T @ found).astype(np.float64)
    del found
    # Right singular vectors: those of the small square matrix of terms.
    values, axes = np.linalg.eigh(square)
    del square
    axes = axes[:, np.argsort(values)[::-1][:dimensions]].astype(np.float32)
    return Model(idf, axes, _unit(_weighted_rows(blobs, idf) @ axes), given, min(neighbours, len(given)))


def scores(model: Model, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The weighted vote of each text's nearest labelled neighbours."""
    out = np.full(len(offsets) - 1, 0.5)
    if not len(model.labels):
        return out
    base = float(model.labels.mean())
    for start in range(0, len(out), block):
        stop = min(start + block, len(out))
        own = offsets[start : stop + 1]
        vectors = _unit(weighted(*terms(data[own[0] : own[-1]], own - own[0]), model.idf) @ model.axes)
        cosine = vectors @ model.vectors.T
        near = np.argpartition(-cosine, model.neighbours - 1, axis=1)[:, : model.neighbours]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** model.power
        total = weight.sum(axis=1)
        vote = (weight * model.labels[near]).sum(axis=1)
        out[start:stop] = np.where(total > 1e-12, vote / np.maximum(total, 1e-12), base)
    return np.clip(out, 0.0, 1.0)


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        found = scores(model.value, *common.byte_view(batch.column(TEXT)))
        yield pa.RecordBatch.from_arrays([batch.column(ID), pa.array(found)], [ID, "score"])


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``lb_id`` and ``score`` (0 to 1, higher: label 1 likelier) of every row; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return common.ids_and_texts(docs, id_column, text_column).mapInArrow(
        partial(_scored, model=sent), f"{ID} long, score double"
    )


def _passing(batches: Iterator[pa.RecordBatch], model, text: str, least: float) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, text):
        found = scores(model.value, *common.byte_view(batch.column(text).cast(pa.string())))
        yield batch.filter(pa.array(found >= least))


def keep_good(docs: DataFrame, model: Model, least: float = 0.3, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # Names inside are numbers, so that no name of the caller's gets in the way.
    names = docs.columns
    inner = [f"lb_{i}" for i in range(len(names))]
    text = inner[names.index(text_column)]
    numbered = docs.toDF(*inner)
    kept = numbered.mapInArrow(partial(_passing, model=sent, text=text, least=least), numbered.schema)
    return kept.toDF(*names)

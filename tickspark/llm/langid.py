"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random +-1 vector.  A trigram is bound from its letters'
vectors, each permuted (rotated) by its place: ``rot2(a) * rot1(b) * c``.  A
text's vector bundles (adds) the vectors of its trigrams; a language's
prototype bundles the unit vectors of its training texts.  A text gets the
language whose prototype has the largest cosine with it.

Defined results: a text that is null or has no letter gets ``und`` and score 0,
so does every text when there is nothing to learn from; equal cosines go to the
first language by name; a row whose language or id is null is never learned from
(but is predicted); repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.common import column_texts, crc_mod, on_documents, read_table, slices, with_fields

DIMENSIONS = 1024
SEED = 20_240_607
UNKNOWN = "und"
#: Unit vectors are added as integers of this scale: sums do not depend on their order.
SCALE = 1 << 20
#: Largest dense trigram space; beyond it (very large alphabets) codes are made dense by sorting.
DENSE_TRIGRAMS = 1 << 22


class Letters(dict):
    """code point -> its random +-1 vector (0 stands for every non-letter)."""

    def __init__(self, dimensions: int, seed: int):
        super().__init__()
        self.dimensions, self.seed = dimensions, seed

    def __missing__(self, point: int) -> np.ndarray:
        draw = np.random.default_rng([self.seed, point]).integers(0, 2, self.dimensions)
        self[point] = vector = (draw * 2 - 1).astype(np.float32)
        return vector


def text_vectors(texts: list[str], letters: Letters) -> np.ndarray:
    """Unit trigram-bundle vector of each text (zeros for a text without letters).

    Runs of non-letters count as one blank.  Trigrams centred on a blank are
    not used, so no trigram spans two words or two texts.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    present = np.flatnonzero(np.bincount(points))
    alphabet = [int(p) for p in present if chr(p).isalpha()]
    table = np.zeros(int(present[-1]) + 1, np.int64)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    symbols = table[points]
    keep = symbols > 0
    keep[1:] |= keep[:-1].copy()
    symbols, owner = symbols[keep], owner[keep]
    symbols = np.concatenate(([0], symbols, [0]))
    centre = np.flatnonzero(symbols[1:-1]) + 1
    base = len(alphabet) + 1
    codes = (symbols[centre - 1] * base + symbols[centre]) * base + symbols[centre + 1]
    owner = owner[centre - 1]
    out = np.zeros((len(texts), letters.dimensions), np.float32)
    if not len(codes):
        return out
    if base ** 3 <= DENSE_TRIGRAMS:
        grams = np.flatnonzero(np.bincount(codes, minlength=base ** 3))
        index = np.zeros(base ** 3, np.int64)
        index[grams] = np.arange(len(grams))
        place = index[codes]
    else:
        grams, place = np.unique(codes, return_inverse=True)
    vectors = np.stack([letters[p] for p in (0, *alphabet)])
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    # the trigrams' vectors are made in blocks, so a very large alphabet stays in bounded memory
    for lo in range(0, len(grams), 8192):
        block = grams[lo: lo + 8192]
        here = (place >= lo) & (place < lo + 8192) if len(grams) > 8192 else slice(None)
        counts = np.bincount(owner[here] * len(block) + place[here] - lo,
                             minlength=len(texts) * len(block)).reshape(len(texts), len(block))
        bound = twice[block // (base * base)] * once[block // base % base] * vectors[block % base]
        out += counts.astype(np.float32) @ bound
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=out, where=norms > 0)


def learn_prototypes(training: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototype (unit vector) per language of ``training``; only these few vectors reach the driver."""
    rows = training.select(F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).where("lang is not null")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(dimensions, seed), {}
        for batch in batches:
            texts, langs = column_texts(batch), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                scaled = np.rint(text_vectors(texts[lo:hi], letters) * SCALE).astype(np.int64)
                own = np.array(langs[lo:hi], object)
                for lang in dict.fromkeys(langs[lo:hi]):
                    sums[lang] = sums.get(lang, 0) + scaled[own == lang].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "sums"])

    parts = rows.mapInArrow(bundle, "lang string, sums array<bigint>")
    summed = (parts.select("lang", F.posexplode("sums").alias("dim", "value"))
              .groupBy("lang", "dim").agg(F.sum("value").alias("value")))
    found: dict[str, np.ndarray] = {}
    for r in summed.collect():  # languages x dimensions rows
        found.setdefault(r.lang, np.zeros(dimensions))[r.dim] = float(r.value)
    norms = {k: np.linalg.norm(v) for k, v in found.items()}
    return {k: (found[k] / norms[k]).astype(np.float32) for k in sorted(found) if norms[k] > 0}


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text",
                     lang_into: str = "lang_pred", score_into: str = "score",
                     dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """``docs`` with the predicted language and its cosine (negative ones as 0) appended."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names], axis=1) if names else None
    schema = with_fields(docs.schema, T.StructField(lang_into, T.StringType()),
                         T.StructField(score_into, T.DoubleType()))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(dimensions, seed)
        for batch in batches:
            texts, langs, scores = column_texts(batch, text_col), [], []
            for lo, hi in slices(texts):
                vectors = text_vectors(texts[lo:hi], letters)
                known = vectors.any(axis=1) if names else np.zeros(hi - lo, bool)
                cosines = vectors @ matrix if names else np.zeros((hi - lo, 1))
                best = cosines.argmax(axis=1)
                langs += [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                top = np.clip(cosines[np.arange(hi - lo), best], 0, 1)
                scores += np.where(known, np.round(top.astype(float), 6), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, lang_into, score_into])

    return docs.mapInArrow(predict, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The documents a model may learn from: id known, crc32(id) mod 3 not 1, language given."""
    return docs.where((crc_mod("doc_id", 3) != 1) & F.col("lang").isNotNull())


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    prototypes = learn_prototypes(training_rows(docs))
    found = predict_language(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


#: Documents whose best cosine is below this are in none of the languages learned.
REJECT_BELOW = 0.05


@on_documents
def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a recognised language go."""
    prototypes = learn_prototypes(training_rows(docs))
    lang, score = "__lang_pred", "__lang_score"
    found = predict_language(docs, prototypes, lang_into=lang, score_into=score)
    if not prototypes:  # nothing to judge by: only texts without letters go
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return (found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= REJECT_BELOW)).select(*docs.columns))

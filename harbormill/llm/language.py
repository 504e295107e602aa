"""Language of a text by a string kernel: presence of characters n-grams, landmarks, one-versus-rest ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.llm.common import worker_state

UNKNOWN = "und"
LONGEST_GRAM = 3
TRAIN_ROWS = 300  # labelled rows of each language at most that the model is fitted on
LANDMARKS = 24  # of each language
RIDGE = 1e-3
BATCH = 64
# The split of documents into three folds, of which one is held out.
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    grams: np.ndarray  # sorted codes of all n-grams of the landmarks
    present: np.ndarray  # grams x landmarks, 0 or 1
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages


def held_out(doc_id: Column) -> Column:
    """A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _letters() -> np.ndarray:
    state = worker_state("letters")
    if not state:
        state["table"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return state["table"]


def spectrum(text: str | None) -> np.ndarray:
    """Codes of the distinct n-grams (1 to 3 characters, 21 bits each); none if the text has no letter.

    Letters are lower-cased, each run of other characters counts as one space.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.array([], dtype=np.int64)
    c = np.where(letter, points, 32)
    c = np.concatenate([[32], c[letter | np.concatenate([[True], letter[:-1]])], [32]])
    grams = c
    parts = [c]
    for _ in range(LONGEST_GRAM - 1):
        grams = (grams[:-1] << 21) | c[len(c) - len(grams) + 1 :]
        parts.append(grams)
    return np.unique(np.concatenate(parts))


def kernel(spectra: list[np.ndarray], model_grams: np.ndarray, present: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Texts x landmarks: n-grams in common over the geometric mean of both numbers, as one matrix product a batch."""
    rows = np.zeros((len(spectra), len(model_grams)), dtype=np.float32)
    for n, s in enumerate(spectra):
        at = np.searchsorted(model_grams, s)
        at[at == len(model_grams)] = 0
        rows[n, at[model_grams[at] == s]] = 1
    own = np.array([max(1, len(s)) for s in spectra], dtype=np.float64)
    return (rows @ present) / np.sqrt(own[:, None] * sizes[None, :])


def fit(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Nystroem features of the landmarks, the first texts of each language, and a ridge regression for each
    language against the rest, in which every language has the same weight."""
    spectra = [spectrum(t) for t in texts]
    known = [(s, lang) for s, lang in zip(spectra, labels, strict=True) if len(s)]
    languages = sorted({lang for _, lang in known})
    marks, met = [], dict.fromkeys(languages, 0)
    for s, lang in known:
        if met[lang] < landmarks:
            met[lang] += 1
            marks.append(s)
    if not marks:
        return LanguageModel([], np.array([0]), np.zeros((1, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    grams = np.unique(np.concatenate(marks))
    present = np.zeros((len(grams), len(marks)), dtype=np.float32)
    for n, s in enumerate(marks):
        present[np.searchsorted(grams, s), n] = 1
    sizes = np.array([len(s) for s in marks], dtype=np.float64)
    among = kernel(marks, grams, present, sizes)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = vectors @ (vectors / np.sqrt(np.maximum(values, 1e-6))).T
    features = np.concatenate([kernel([s for s, _ in known[i : i + BATCH]], grams, present, sizes) for i in range(0, len(known), BATCH)]) @ root
    own = np.array([languages.index(lang) for _, lang in known])
    target = np.where(own[:, None] == np.arange(len(languages)), 1.0, -1.0)
    share = (1 / np.bincount(own))[own][:, None]
    w = np.linalg.solve((features * share).T @ features + ridge * np.eye(len(marks)), (features * share).T @ target)
    return LanguageModel(languages, grams, present, sizes, root @ w)


def predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is the winner's regression value brought to 0..1."""
    names, scores = [], []
    for lo in range(0, len(texts), BATCH):
        spectra = [spectrum(t) for t in texts[lo : lo + BATCH]]
        if not model.languages:
            names += [UNKNOWN] * len(spectra)
            scores += [0.0] * len(spectra)
            continue
        values = kernel(spectra, model.grams, model.present, model.sizes) @ model.weights
        best = values.argmax(axis=1)
        for s, b, v in zip(spectra, best, values, strict=True):
            names.append(model.languages[b] if len(s) else UNKNOWN)
            scores.append(float(np.clip((v[b] + 1) / 2, 0, 1)) if len(s) else 0.0)
    return names, np.array(scores, dtype=np.float64)


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> LanguageModel:
    """A model of the rows with a non-null ``lang`` that are not held out.

    At most ``train_rows`` of each language are taken, those of least hashed id: a bound on what reaches
    the driver. Each task keeps its least rows before they meet, so a language with most of the rows is no hot spot.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= train_rows)
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("n").alias("n"))
    rows = labelled.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    rows = rows.groupBy("n", "lang").agg(F.min("text").alias("text")).orderBy("n", "lang").collect()
    return fit([r["text"] for r in rows], [r["lang"] for r in rows], landmarks)


def with_language(docs: DataFrame, model: LanguageModel, prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) of every whole text; both names can have a ``prefix``.

    Only the text is looked at. A null text or one without a letter is ``und`` with score 0, as is every text if
    the model knows no language. Rows and other columns stay as they are; columns of the new names are replaced.
    """
    new = T.StructType(
        [T.StructField(f"{prefix}lang_pred", T.StringType(), False), T.StructField(f"{prefix}score", T.DoubleType(), False)]
    )
    kept = docs.drop(*new.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, *new.names])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *new.fields]))

"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased; runs of characters that are not letters count as one
space. Its n-grams of 1 to NGRAMS characters are hashed to FEATURES numbers.
Training counts them per language; a prediction adds up their log-probabilities.
The matrix of log-probabilities (features x languages) goes to every task: its
size is bounded by MATRIX_BYTES; more languages than fit are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store
from pagemill.llm.tokens import encoder

FEATURES = 1 << 16
NGRAMS = 3
TRAINING_ROWS = 20_000  # labelled documents that are learned from, at most about so many
LEAST_SCORE = 0.5  # a language less probable than all others together is not recognised
SURE_SCORE = 0.99  # from here on a prediction counts more than a label
MATRIX_BYTES = 64 << 20
SMOOTHING = 0.5
UNKNOWN = "und"

_SLAB = 1 << 18  # characters handled at once
_TASKS = 32  # tasks of the training, each with a table of counts per language


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    points = range(0x110000)
    return np.fromiter((chr(i).isalpha() for i in points), bool, len(points))


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text between spaces; what is not a letter is a space, once."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(_letters()[codes], codes, 0x20)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0x20) | (codes[:-1] != 0x20)
    return np.concatenate([[0x20], codes[keep], [0x20]]).astype(np.uint32)


def _features(codes: np.ndarray, features: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each length n, the feature of the n-gram from each position on, and n."""
    gram = np.zeros(len(codes), np.uint32)
    bits = np.uint32(32 - (features.bit_length() - 1))
    for n in range(1, NGRAMS + 1):
        m = len(codes) - n + 1
        if m <= 0:
            return
        gram = gram[:m] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
        h = gram * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        yield (h * np.uint32(0x85EBCA77)) >> bits, n


def _slabs(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of texts in slabs: code points of all, the text and the length of each part. A very
    long text is several parts, each between spaces."""
    codes, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text)), _SLAB):
            part = _codes(text[at : at + _SLAB])
            codes.append(part)
            owners.append((i, len(part)))
            size += len(part)
            if size >= _SLAB:
                yield _joined(codes, owners)
                codes, owners, size = [], [], 0
    if codes:
        yield _joined(codes, owners)


def _joined(codes: list[np.ndarray], owners: list[tuple[int, int]]):
    lengths = np.array([n for _, n in owners])
    return np.concatenate(codes), np.array([i for i, _ in owners]), lengths


@dataclass
class Model:
    languages: list[str]
    log_probabilities: np.ndarray  # languages x features
    log_priors: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each text under each language (texts x languages)."""
        features = self.log_probabilities.shape[1]
        out = np.tile(self.log_priors, (len(texts), 1))
        for codes, owner, lengths in _slabs(texts):
            starts = np.cumsum(lengths) - lengths
            last = np.cumsum(lengths)
            total = np.zeros((len(self.languages), len(owner)))
            for feature, n in _features(codes, features):
                # n-grams that begin too near the end of their text reach into the next one
                ends = np.minimum(last - n + 1, len(feature))
                bounds = np.column_stack([starts, np.maximum(ends, starts)]).ravel()
                bounds = np.minimum(bounds, len(feature))
                for k, row in enumerate(self.log_probabilities):
                    sums = np.concatenate([[0.0], np.cumsum(row[feature], dtype=np.float64)])
                    part = sums[bounds]
                    total[k] += part[1::2] - part[0::2]
            np.add.at(out, owner, total.T)
        return out


def train(
    documents: DataFrame,
    usable: Column | None = None,
    rows: int = TRAINING_ROWS,
    features: int = FEATURES,
) -> Model:
    """Learn from text and lang of documents with both, and letters, where `usable` holds.

    Of each language at most about `rows` divided by the number of languages are taken,
    those with the smallest hashes of doc_id and text, so that a rare language
    is learned however large the others are; the prior probabilities are those of all labelled
    documents. Other columns are not read. ValueError if there are so many languages that a
    table of `features` (a power of two) numbers each exceeds MATRIX_BYTES.
    """
    spark = documents.sparkSession
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if usable is not None:
        labelled = labelled.where(usable)
    most = MATRIX_BYTES // (4 * features)
    numbers = {r[0]: r[1] for r in labelled.groupBy("lang").count().limit(most + 1).collect()}
    if len(numbers) > most:
        raise ValueError(f"more than {most} languages are too many for one matrix")
    if not numbers:
        return Model([], np.zeros((0, features), np.float32), np.zeros(0))
    quota = max(1, rows // len(numbers))
    shares = spark.createDataFrame(
        [(lang, min(1.0, quota / n)) for lang, n in numbers.items()], "lang string, taken double"
    )
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    # at most MATRIX_BYTES / (4 * features) languages
    labelled = labelled.select("lang", "text", share.alias("share")).join(F.broadcast(shares), "lang")
    labelled = labelled.where("share < taken")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder.cache_clear()  # what an earlier stage left in this worker
        store.give_back()
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                held = counts.setdefault(lang, np.zeros(features, np.int64))
                docs[lang] = docs.get(lang, 0) + len(group)
                for text in group["text"]:
                    for at in range(0, len(text), _SLAB):
                        for feature, _ in _features(_codes(text[at : at + _SLAB]), features):
                            held += np.bincount(feature, minlength=features)
            store.give_back()
        if not counts:
            return
        yield pd.DataFrame(
            {
                "lang": list(counts),
                "n": [docs[x] for x in counts],
                "counts": [x.tobytes() for x in counts.values()],
            }
        )

    def add(_: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in parts["counts"])
        return pd.DataFrame(
            {"lang": [parts["lang"].iloc[0]], "n": [parts["n"].sum()], "counts": [total.tobytes()]}
        )

    schema = "lang string, n long, counts binary"
    few = labelled.select("lang", "text").repartition(_TASKS)
    summed = few.mapInPandas(count, schema).groupBy("lang").applyInPandas(add, schema)
    found = summed.toPandas()  # a row a language
    counts = dict(zip(found["lang"], found["counts"]))
    languages = sorted(numbers)
    none = np.zeros(features, "<i8")  # of a language of which no document was taken
    table = np.array([np.frombuffer(counts[x], "<i8") if x in counts else none for x in languages])
    table = table + SMOOTHING
    log = np.log(table) - np.log(table.sum(axis=1, keepdims=True))
    n_docs = np.array([numbers[x] for x in languages], float)
    return Model(languages, log.astype(np.float32), np.log(n_docs / n_docs.sum()))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """All columns, with lang_pred and score (the posterior probability of lang_pred).

    A null text, or one without a letter, is `und` with score 0; so is every
    text where nothing was learned. Ties go to the language that sorts first.
    Columns of these names are replaced. Each text is scored whole.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most MATRIX_BYTES

    @F.pandas_udf("lang_pred string, score double")
    def scored(text: pd.Series) -> pd.DataFrame:
        m = shared.value
        lang = np.full(len(text), UNKNOWN, object)
        score = np.zeros(len(text))
        encoder.cache_clear()  # what an earlier stage left in this worker
        store.give_back()
        rows = [i for i, t in enumerate(text) if t and any(map(str.isalpha, t))]
        if rows and m.languages:
            logs = m.scores([text.iloc[i] for i in rows])
            best = logs.argmax(axis=1)
            lang[rows] = np.array(m.languages, object)[best]
            shifted = np.exp(logs - logs.max(axis=1, keepdims=True))
            score[rows] = 1 / shifted.sum(axis=1)
            del logs, shifted
        store.give_back()
        return pd.DataFrame({"lang_pred": pd.Series(lang, dtype=object), "score": score})

    names = [c for c in documents.columns if c not in ("lang_pred", "score")]
    # not a deterministic function: otherwise it would run once for each of its fields
    both = store.free_name(documents, "scored")
    return documents.withColumn(both, scored.asNondeterministic()("text")).select(
        *[F.col(f"`{c}`") for c in names], f"{both}.lang_pred", f"{both}.score"
    )


def held_out() -> Column:
    """Documents whose crc32 of the id, as text, leaves 1 when divided by 3; a null id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(
    documents: DataFrame, least: float = LEAST_SCORE, sure: float = SURE_SCORE
) -> DataFrame:
    """Documents whose language is recognised, with all their columns; lang is what was found.

    Learns from the documents' own lang column. Documents without a letter (`und`) or
    whose best language has a posterior below `least` go. Of the others, lang becomes the prediction
    where it was null or the posterior is at least `sure`, and stays otherwise. If no
    document has a lang, there is nothing to learn: those with a letter stay as they are.
    """
    model = train(documents.select("doc_id", "text", "lang"))
    if not model.languages:
        return documents.where(F.col("text").rlike(r"\p{L}"))
    clash = [c for c in documents.columns if c.lower() in ("lang_pred", "score")]
    spare = {c: store.free_name(documents, f"_{c}") for c in clash}
    found = predict(documents.withColumnsRenamed(spare), model)
    trusted = F.col("lang").isNull() | (F.col("score") >= sure)
    lang = F.when(trusted, F.col("lang_pred")).otherwise(F.col("lang"))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(
        *[
            (lang if c == "lang" else F.col(f"`{spare.get(c, c)}`")).alias(c)
            for c in documents.columns
        ]
    )

"""Near duplicates by weighted MinHash over TF-IDF shingles.

A document is the weighted set of its five-word shingles, each weighing
tf * idf with idf = 1 + IDF_SHARE * ln((N + 1) / (df + 1)) / ln(N + 1): between 1
and 1 + IDF_SHARE, so that the measure means the same in a small and in a large
corpus, and that in a large group of near copies, whose common shingles are
frequent and whose edits are rare, the edits do not outweigh what is common. Similarity is
the weighted Jaccard, the sum of the smaller weights over that of the larger.

(1) Document frequencies come from the exchange of chunks.py. (2) A shingle of
one document only matches nothing; a document whose shared shingles weigh less
than the threshold's share of it cannot have a near duplicate and is done.
(3) The others get signatures by improved consistent weighted sampling. The
smallest of a document's samples over its unshared shingles is exponential
with their total weight, so one draw stands for all of them. (4) Bands of the signature deal
documents to buckets. Each bucket compares all members with its centre. Jaccard
distance is a metric: the distances to the centre tell which other pairs of the
bucket can still be links, and those are compared unless already connected.
(5) Links make classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import chunks as ch
from pagemill.llm import store
from pagemill.llm.components import components
from pagemill.llm.tokens import encoder

SHINGLE = 5
SIMILARITY = 0.8
IDF_SHARE = 0.25
BANDS, BAND_ROWS = 16, 4  # finds a pair of similarity 0.8 with probability 0.9998

_SLACK = 1e-6  # weights are kept with 24 bits
_SIGNED_AT_ONCE = 1 << 18  # shingles


def idf(df: np.ndarray, n: int, share: float = IDF_SHARE) -> np.ndarray:
    return 1 + share * np.log((n + 1) / (df + 1.0)) / np.log(n + 1.0)


def _uniform(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1) from each 64-bit number."""
    high = (bits >> np.uint64(32)).astype(np.float64)
    low = (bits & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return (high + 0.5) / 2**32, (low + 0.5) / 2**32


def _seed(k: int, part: int) -> np.uint64:
    return ch.mixed(np.array([k * 8 + part + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]


def signatures(
    hashes: np.ndarray,
    weights: np.ndarray,
    bounds: np.ndarray,
    own: np.ndarray,
    own_weight: np.ndarray,
    samples: int,
) -> np.ndarray:
    """Samples of each document, as 64-bit numbers (documents x samples).

    hashes, weights: shared shingles of the documents, one after another, cut by
    `bounds` (no document is without). own: a number for each document, for the sample that
    falls on shingles it shares with none, which weigh `own_weight`.
    """
    out = np.empty((len(own), samples), np.uint64)
    if len(own) > 1 and len(hashes) > _SIGNED_AT_ONCE:
        half = int(np.searchsorted(bounds, bounds[-1] // 2).clip(1, len(own) - 1))
        for part in (slice(0, half), slice(half, len(own))):
            cut = slice(bounds[part.start], bounds[part.stop])
            edges = bounds[part.start : part.stop + 1] - bounds[part.start]
            out[part] = signatures(
                hashes[cut], weights[cut], edges, own[part], own_weight[part], samples
            )
        return out
    log_weight = np.log(weights.astype(np.float64))
    starts = bounds[:-1]
    counts = np.diff(bounds)
    for k in range(samples):
        u1, u2 = _uniform(ch.mixed(hashes ^ _seed(k, 0)))
        u3, u4 = _uniform(ch.mixed(hashes ^ _seed(k, 1)))
        u5, _ = _uniform(ch.mixed(hashes ^ _seed(k, 2)))
        r = -np.log(u1 * u2)
        t = np.floor(log_weight / r + u5)
        log_a = np.log(-np.log(u3 * u4)) - r * (t - u5 + 1)
        least = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == np.repeat(least, counts))
        document = np.searchsorted(bounds, at, "right") - 1
        first = np.concatenate([[True], document[1:] != document[:-1]])
        at = at[first]
        chosen = ch.mixed(hashes[at] + ch.mixed(t[at].astype(np.int64).astype(np.uint64)))
        v, _ = _uniform(ch.mixed(own ^ _seed(k, 3)))
        with np.errstate(divide="ignore"):
            log_own = np.log(-np.log(v)) - np.log(own_weight)
        out[:, k] = np.where(log_own < least, ch.mixed(own ^ _seed(k, 4)), chosen)
    return out


def _shingles(chunk: ch.Chunk) -> tuple[np.ndarray, ...]:
    """Distinct (document, shingle) with counts, and a 128-bit digest of each document's words.

    A document of one to four words is one shingle.
    """
    (words, other), bounds = chunk.word_hashes(2)
    counts = np.diff(bounds)
    hashes = ch.windows(words, bounds, SHINGLE)
    document = np.repeat(np.arange(len(counts)), counts)
    digests = []
    for copy, w in enumerate((words, other)):
        # a sum over position-dependent images of the words
        inside = (np.arange(len(w)) - np.repeat(bounds[:-1], counts)).astype(np.uint64)
        image = ch.mixed(w + ch.mixed(inside + np.uint64(copy + 1)))
        total = np.concatenate([[np.uint64(0)], np.cumsum(image)])
        digests.append(ch.mixed(total[bounds[1:]] - total[bounds[:-1]] + counts.astype(np.uint64)))
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    keep = hashes != 0
    hashes = np.concatenate([hashes[keep], digests[0][short]])
    document = np.concatenate([document[keep], short])
    order = np.lexsort((hashes, document))
    h, d = hashes[order], document[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])[: len(h)]
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    return d[at], h[at], tf, np.column_stack(digests), counts


_NODE = (
    "doc_key string, n_words long, text_hash long, text_id binary, shingles binary, weights binary, "
    "weight double, shared double, bands array<long>"
)


def _nodes(
    documents: DataFrame, similarity: float, chunk_bytes: int, idf_share: float
) -> DataFrame:
    place = store.folder(documents.sparkSession, "near-dup")
    chunks = ch.write_chunks(documents, place, chunk_bytes)
    buckets = ch.buckets_for(chunks)
    n = chunks.agg(F.sum("n_documents")).first()[0] or 0

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder.cache_clear()  # what an earlier stage left in this worker
        store.give_back()
        for batch in batches:
            for name in batch["chunk"]:
                _, shingle, *_ = _shingles(ch.Chunk(name))
                distinct, count = np.unique(shingle, return_counts=True)
                yield ch.sent(name, distinct, buckets, 4, documents=count.astype("<u4"))
                store.give_back()

    def frequency(group: np.ndarray, documents: np.ndarray) -> np.ndarray:
        return np.bincount(group, weights=documents)[group].astype("<u4")

    answers = ch.answered(
        store.dealt(chunks.select("chunk")).mapInPandas(
            send, "bucket long, chunk string, hashes binary, documents binary"
        ),
        4,
        {"documents": "<u4"},
        frequency,
    )

    def describe(key: tuple, names: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        chunk = ch.Chunk(key[0])
        document, shingle, tf, digest, counts = _shingles(chunk)
        _, index = np.unique(shingle, return_inverse=True)
        df = ch.gathered(rows, "<u4")[index]
        weight = (tf * idf(df, n, idf_share)).astype(np.float32)
        m = len(chunk.ids)
        total = np.bincount(document, weight, minlength=m)
        shared = df > 1
        common = np.bincount(document[shared], weight[shared], minlength=m)
        possible = (counts > 0) & (common >= (similarity - _SLACK) * total)
        ids = [d.tobytes() for d in digest]
        _, first = np.unique(digest, axis=0, return_index=True)
        once = np.zeros(m, bool)
        once[first] = True
        chosen = possible & once  # copies within the chunk share one description
        use = shared & chosen[document]
        hashes, w = shingle[use], weight[use]
        number = np.flatnonzero(chosen)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(document[use], minlength=m)[number])])
        out = pd.DataFrame(
            {
                "doc_key": [None if i is None else str(i) for i in chunk.ids],
                "n_words": counts,
                # Spark's xxhash64 of the text
                "text_hash": np.array(
                    [xxhash.xxh64_intdigest(t, 42) for t in chunk.texts], np.uint64
                ).view(np.int64),
                "text_id": ids,
                "shingles": None,
                "weights": None,
                "weight": total,
                "shared": common,
                "bands": None,
            }
        ).astype({"shingles": object, "weights": object, "bands": object})
        if len(number):
            sample = signatures(
                hashes,
                w,
                bounds,
                digest[number, 0],
                np.maximum(total - common, 0)[number],
                BANDS * BAND_ROWS,
            )
            bands = sample.reshape(len(number), BANDS, BAND_ROWS)
            key_ = np.zeros((len(number), BANDS), np.uint64)
            for i in range(BAND_ROWS):
                key_ = ch.mixed(key_ * np.uint64(31) + bands[:, :, i])
            key_ = ch.mixed(key_ + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            cut = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
            out.loc[number, "shingles"] = pd.Series([hashes[c].tobytes() for c in cut], number)
            out.loc[number, "weights"] = pd.Series([w[c].tobytes() for c in cut], number)
            out.loc[number, "bands"] = pd.Series(list(key_), number)
        store.give_back()
        return out

    names = chunks.select("chunk")
    rows = names.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(describe, _NODE)
    return store.written(rows, "near-dup-nodes")


def _similarities(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs: a, b (text ids). Adds their weighted Jaccard similarity."""
    vector = ["text_id", "shingles", "weights", "weight"]

    def side(name: str) -> DataFrame:
        return nodes.select([F.col(c).alias(f"{c}_{name}") for c in vector]).withColumnRenamed(
            f"text_id_{name}", name
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # on Arrow's own buffers: two vectors a row are too much to copy for a whole batch
        for batch in batches:
            values = []
            weight_a, weight_b = (batch.column(f"weight_{s}").to_pylist() for s in "ab")

            def vector(name: str, i: int, kind: str) -> np.ndarray:
                return np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: B023

            for i in range(len(batch)):
                ha, hb = (vector(f"shingles_{s}", i, "<u8") for s in "ab")
                wa, wb = (vector(f"weights_{s}", i, "<f4") for s in "ab")
                at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
                both = hb[at] == ha
                least = float(np.minimum(wa[both], wb[at[both]]).sum(dtype=np.float64))
                values.append(least / (weight_a[i] + weight_b[i] - least))
            columns = [batch.column("a"), batch.column("b"), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"])
        store.give_back()

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.mapInArrow(run, "a binary, b binary, similarity double")


def _links(nodes: DataFrame, similarity: float) -> DataFrame:
    """Links between different texts, enough to connect all that any bucket links."""
    least = similarity - _SLACK
    members = store.written(
        nodes.select(
            F.posexplode("bands").alias("band", "bucket"),
            F.col("text_id").alias("a"),
            F.col("weight").alias("w"),
            F.col("shared").alias("s"),
            "bands",
        ),
        "buckets",
    )
    # the text with the smallest share of shingles of its own is the likeliest to be near all others
    own_share = F.round(1 - F.col("s") / F.col("w"), 4)
    order = F.struct(own_share.alias("p"), F.xxhash64("a").alias("o"), "a", "w")
    # tables of their own: only rows that come from an exchange can be split where a key is frequent
    centres = store.written(
        members.groupBy("bucket")
        .agg(F.min(order).alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("bucket", F.col("least.a").alias("b"), F.col("least.w").alias("w_centre")),
        "bucket-centres",
    )
    placed = store.written(members.join(centres, "bucket"), "centres")
    # what two texts have in common lies in the centre, at most what each has in common with it,
    # or outside, at most what each shares there with any other text
    common = F.least("in_a", "in_b") + F.least(F.col("s_a") - F.col("in_a"), F.col("s_b") - F.col("in_b"))
    possible = common >= least * (F.col("w_a") + F.col("w_b") - common)
    compared = store.written(
        _similarities(placed.where("a != b").select("a", "b").distinct(), nodes), "compared"
    )
    first = compared.where(F.col("similarity") >= least).select("a", "b")
    labels = components(first)

    # what a bucket's centre leaves open: members in different components that may be links
    distance = placed.join(compared, ["a", "b"], "left").join(
        labels.withColumnRenamed("node", "a"), "a", "left"
    )
    distance = distance.select(
        "bucket",
        "band",
        "bands",
        "a",
        "w",
        "s",
        F.coalesce("label", "a").alias("label"),
        "w_centre",
        (1 - F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.col("similarity"))).alias("d"),
    ).withColumn("in", (1 - F.col("d")) * (F.col("w") + F.col("w_centre")) / (2 - F.col("d")))
    distance = store.written(distance, "distances")
    open_ = store.written(
        distance.groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo != hi")
        .select("bucket"),
        "open",
    )
    rows = store.written(distance.join(open_, "bucket"), "open-buckets")
    reach = 1 - similarity + 2 * _SLACK
    # members of the centre's own star are linked to each other already
    left = rows.where(F.col("d") > reach).select(
        "bucket", "band", "a", *[F.col(c).alias(f"{c}_a") for c in ("label", "d", "w", "s", "in", "bands")]
    )
    right = rows.select(
        "bucket",
        F.col("a").alias("b"),
        *[F.col(c).alias(f"{c}_b") for c in ("label", "d", "w", "s", "in", "bands")],
    )
    # a pair that meets in several buckets is taken in the first
    meet = F.zip_with("bands_a", "bands_b", lambda x, y: x == y)
    # distances in steps of the reach: a pair within it lies in the same step or the next
    step = lambda c: F.floor(F.col(c) / reach)
    left = left.withColumn("step", F.explode(F.array(*[step("d_a") + i for i in (-1, 0, 1)])))
    pairs = left.join(right.withColumn("step", step("d_b")), ["bucket", "step"]).where(
        (F.col("label_a") != F.col("label_b"))
        & (F.abs(F.col("d_a") - F.col("d_b")) <= reach)
        & ((F.col("d_b") <= reach) | (F.col("a") < F.col("b")))
        & possible
        & (F.array_position(meet, True) == F.col("band") + 1)
    )
    second = _similarities(pairs.select("a", "b"), nodes)
    return first.union(second.where(F.col("similarity") >= least).select("a", "b"))


def near_duplicates(
    documents: DataFrame,
    similarity: float = SIMILARITY,
    chunk_bytes: int = ch.CHUNK_BYTES,
    idf_share: float = IDF_SHARE,
) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id, is_representative.

    Classes are the connected components of similarity >= `similarity`; words are
    `[^\\x20\\x09-\\x0D]+`, unchanged, and documents with the same words are one
    text. class_id is the smallest doc_id of the class (null ids last), whose
    document represents it; of repeated rows with that id and text all are marked.
    text_hash is xxhash64 of the text, which tells rows with one doc_id apart.
    A null or empty text, or one without words, is a class of its own. A document is
    never cut: a task holds a chunk of `chunk_bytes`, or one longer document. Other
    columns are not read.
    """
    nodes = _nodes(documents, similarity, chunk_bytes, idf_share)
    described = store.written(
        nodes.where("shingles IS NOT NULL").dropDuplicates(["text_id"]), "near-dup-texts"
    )
    links = store.written(_links(described, similarity), "near-dup-links")
    labels = components(links)
    # a text without words is alone: its label is its row
    rows = nodes.select(
        F.col("doc_key").cast("long").alias("doc_id"),
        "text_hash",
        F.when(F.col("n_words") > 0, F.col("text_id")).alias("text_id"),
    )
    worded = store.written(
        rows.where("text_id IS NOT NULL")
        .join(labels.withColumnRenamed("node", "text_id"), "text_id", "left")
        .withColumn("label", F.coalesce("label", "text_id")),
        "near-dup-labels",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id", "text_hash")
    best = store.written(
        worded.groupBy("label").agg(F.min(order).alias("best")), "near-dup-classes"
    )
    return (
        worded.join(best, "label")
        .select(
            "doc_id",
            "text_hash",
            F.col("best.doc_id").alias("class_id"),
            (order == F.col("best")).alias("is_representative"),
        )
        .union(
            rows.where("text_id IS NULL").select(
                "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(True)
            )
        )
    )


def without_near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns; of repeated rows one stays.

    Documents without words all stay.
    """
    key, digest = (store.free_name(documents, n) for n in ("kept_id", "kept_hash"))
    mine = store.free_name(documents, "text_hash")
    kept = (
        near_duplicates(documents, similarity)
        .where("is_representative")
        .select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest))
        .distinct()
    )
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^ \\t-\\r]")
    hashed = documents.where(~wordless).withColumn(mine, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mine) == F.col(digest))
    one_each = hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", mine]).drop(mine)
    return one_each.union(documents.where(wordless))

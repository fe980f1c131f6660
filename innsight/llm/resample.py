"""Importance resampling of a corpus towards a target: array-scored weights, then a distributed radix sort."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import map_text, materialise
from innsight.llm.radix import places

#: Words are runs of ASCII digits, letters (A-Z lower-cased) and all characters beyond ASCII.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Words whose checksum a worker remembers at a time.
REMEMBERED = 250_000
#: Extra columns of the result.
ADDED = ("n_features", "weight", "score", "rank")


class _Sums(dict):
    def __missing__(self, gram: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[gram] = zlib.crc32(gram)
        return h


_sums = _Sums()


def features(text: str | None, longest: int, n_buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``longest`` consecutive words, repeats included."""
    words = (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()
    grams = list(map(_sums.__getitem__, words))
    for n in range(2, longest + 1):
        grams += [zlib.crc32(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)]
    return len(words), (np.array(grams, np.uint32) % np.uint32(n_buckets)).astype("<u4")


def _bucketed(docs: DataFrame, text_col: str, carry: list[str], longest: int, n_buckets: int) -> DataFrame:
    """n_words, n_features and the buckets (little-endian unsigned 32-bit) of every text."""
    def make():
        def run(texts: pa.Array) -> list:
            rows = [features(t.as_py(), longest, n_buckets) for t in texts]
            return [[n for n, _ in rows], [len(b) for _, b in rows], [b.tobytes() for _, b in rows]]
        return run

    new = [T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("buckets", T.BinaryType())]
    return map_text(docs, text_col, new, make, carry)


def bucket_counts(bucketed: DataFrame, n_buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows; a task sums its rows in one array, and ``n_buckets`` rows come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for b in batches:
            for row in b.column(0):
                counts += np.bincount(np.frombuffer(row.as_py(), "<u4"), minlength=n_buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "m"])

    sums = bucketed.select("buckets").mapInArrow(run, "bucket long, m long").groupBy("bucket").agg(F.sum("m").alias("m"))
    out = np.zeros(n_buckets, np.int64)
    for r in sums.collect():  # at most n_buckets rows, whatever the corpus
        out[r["bucket"]] = r["m"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over its share in the corpus, both smoothed by one, in doubles."""
    s, t, n = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weighed(bucketed: DataFrame, gain: np.ndarray) -> DataFrame:
    """Replace ``buckets`` by ``weight``, the floored mean of the row's gains (0 without features): array look-ups and one sum per row."""
    kept = [f for f in bucketed.schema if f.name != "buckets"]
    schema = T.StructType([*kept, T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weights = []
            for row in b.column(0):
                g = gain[np.frombuffer(row.as_py(), "<u4")]
                weights.append(int(g.sum()) // len(g) if len(g) else 0)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(weights, pa.int64())], names=schema.names)

    return bucketed.select("buckets", *[f.name for f in kept]).mapInArrow(run, schema)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of sha256("seed:key"); a null key is the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, key: str, text_col: str = "text", target_col: str = "text",
             share: tuple[int, int] = (10, 100), least_words: int = 20, longest: int = 1, n_buckets: int = 10_000,
             seed: int = 2024, carry: list[str] | None = None) -> DataFrame:
    """Draw ``share`` of the documents so that their words come near those of the target, without replacement.

    Every run of 1 to ``longest`` words falls into a bucket; a bucket's gain is the logarithm of
    its frequency in the target over that in the corpus, and a document's ``weight`` the
    floored mean gain of its features. ``score`` adds seeded Gumbel noise of the key, so taking the
    highest scores is a draw by weight. ``floor(N * share)`` of the N documents with at least ``least_words`` words are drawn.

    Returns the columns named in ``carry`` (all, if None) and n_features, weight, score, rank (1, 2, 3, ... from
    the highest score, ties to the smaller key; null if not drawn), all long; a column of ``docs`` with one of these
    names is replaced. The key is a long. Null and empty texts have no feature and weight 0 and are never drawn (unless
    ``least_words`` is 0); a null key counts as the empty text in the noise and comes last among ties; rows
    with one key are rows like any other and differ in rank. An empty corpus gives an empty table; an empty target
    makes every gain that of a bucket that is rare everywhere. Counts cover both tables whole.

    Nothing grows in a task or on the driver: counts are arrays of ``n_buckets``, and the
    ranks come from the radix sort of :mod:`innsight.llm.radix` over (score, key).
    """
    cols = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    rows = docs.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{key}`").cast("long").alias("key"),
                       *[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(cols)])
    own = ["key", *[f"in{i}" for i in range(len(cols))]]
    corpus = materialise(_bucketed(rows, "t", own, longest, n_buckets), "features")
    wanted = _bucketed(target.select(F.col(f"`{target_col}`").alias("t")), "t", [], longest, n_buckets)
    gain = gains(bucket_counts(corpus, n_buckets), bucket_counts(wanted, n_buckets))
    # the row number is written with the row, so that later reads agree on it
    scored = materialise(_weighed(corpus, gain).withColumn("score", F.col("weight") + noise(F.col("key"), seed))
                         .withColumn("r", F.monotonically_increasing_id()), "scored")

    eligible = scored.where(F.col("n_words") >= least_words).select(
        "r", (-F.col("score")).alias("fall"), F.col("key").isNull().cast("long").alias("none"),
        F.coalesce("key", F.lit(0).cast("long")).alias("id"))
    low = eligible.agg(F.min("fall")).first()[0]
    placed, n = places(eligible.withColumn("fall", F.col("fall") - F.lit(low or 0).cast("long")), "r", ["fall", "none", "id"])
    drawn = placed.where(F.col("place") < n * share[0] // share[1]).select("r", (F.col("place") + 1).alias("rank"))
    return scored.join(drawn, "r", "left").select(
        *[F.col(f"in{i}").alias(c) for i, c in enumerate(cols)], "n_features", "weight", "score", "rank")

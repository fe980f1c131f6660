"""Near-duplicate texts: a chosen-path join of word 5-gram sets by Jaccard similarity."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import materialise
from innsight.operators.components import components

#: Words of a shingle, and the least similarity as a fraction (4/5).
WORDS, SIMILAR = 5, (4, 5)
#: Sampled tokens of a set (values of independent minimum hashes): all, and those that each split of a path tries.
TOKENS, TRIES = 64, 2
#: Chance that a pair of the least similarity is found.
TARGET_RECALL = 0.9999
#: A bucket of at most so many sets is compared by brute force; a larger one is split, at most so often.
BRUTE_FORCE, MOST_SPLITS = 256, 12
#: A split that leaves more than this share of a bucket together met sets that are all alike: no path tells them apart.
ALIKE = 0.6
#: Such a bucket is compared in blocks of so many sets by so many.
BLOCK = 768
#: Sampled tokens that a pair must share to be verified: five standard deviations under the expectation at 4/5.
SHARED_TOKENS = 35
#: Words whose hashes a worker remembers at a time.
REMEMBERED = 250_000

_rng = np.random.default_rng(20)
_A = _rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word 5-grams; of all words together if there are fewer; none without words."""
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    words = (text or "").encode("utf-8", "replace").split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    size = min(n, WORDS)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = (h ^ w[i:n - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def sample_tokens(s: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``TOKENS`` hashes."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(s), 4096):
        least = np.minimum(least, (_A[:, None] * s[None, lo:lo + 4096] + _B[:, None]).min(1))
    return least


def runs_needed(target: float = TARGET_RECALL) -> int:
    """Runs until a pair at the least similarity s is missed with at most 1 - target.

    A path dies out at a split with q = (1 - s (1 - q)) ** TRIES, the chance
    that none of the tried tokens is shared and lives on.
    """
    s, q = SIMILAR[0] / SIMILAR[1], 0.0
    for _ in range(200):
        q = (1 - s * (1 - q)) ** TRIES
    return max(1, math.ceil(math.log(1 - target) / math.log(q)))


def _sketches(docs: DataFrame, runs: int) -> DataFrame:
    """(td, sd, n, keys, tokens) of each distinct text with words; td and sd are digests of the text and of its set."""
    at = np.arange(TOKENS)[:runs * TRIES] if runs * TRIES <= TOKENS else np.arange(TOKENS)
    schema = "td binary, sd binary, n long, keys array<long>, tokens binary"
    arrow = pa.schema([("td", pa.binary()), ("sd", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())),
                       ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: set[bytes] = set()  # texts seen lately: copies near each other are hashed once
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                td = b.column(0)[i].as_py()
                if td in last:
                    continue
                if len(last) > REMEMBERED:
                    last.clear()
                last.add(td)
                s = shingle_set(b.column(1)[i].as_py())
                if len(s):
                    least = sample_tokens(s)
                    keys = (least[at] ^ (at.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                    keys *= np.uint64(0xBF58476D1CE4E5B9)
                    rows.append((td, hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s),
                                 keys.view(np.int64), least.astype(np.uint8).tobytes()))
            cols = zip(*rows, strict=True) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    # a text that many tasks met comes once from each: the rows are small, and are combined before the shuffle
    made = docs.select("td", "t").where("td is not null").mapInArrow(run, schema)
    return made.groupBy("td").agg(*[F.any_value(c).alias(c) for c in ("sd", "n", "keys", "tokens")])


def _paths(sets: DataFrame) -> DataFrame:
    """(leaf, id, m): sets that met in a bucket small enough, or all alike, to be compared; m the size of the bucket.

    Every sampled token of a run's first try names a bucket. Buckets that are
    too large are split by the sampled tokens that a seeded draw of the path picks, level by level.
    """
    rows = sets.select("id", F.explode("keys").alias("leaf")).withColumn("parent", F.lit(None).cast("long"))
    leaves = []
    for depth in range(MOST_SPLITS + 1):
        rows = materialise(rows, "paths")
        # the key as a struct: the join shuffles both sides for itself, and a bucket with many sets can be split
        sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.struct("leaf").alias("k"), "m")
        rows = rows.withColumn("k", F.struct("leaf")).join(sizes, "k").drop("k")
        large = F.col("m") > BRUTE_FORCE
        if depth < MOST_SPLITS:
            large = large & (F.col("parent").isNull() | (F.col("m") <= ALIKE * F.col("parent")))
        else:
            large = F.lit(False)
        leaves.append(rows.where(~large).select("leaf", "id", "m"))
        deeper = rows.where(large)
        if depth == MOST_SPLITS or deeper.isEmpty():
            break
        tries = F.array(*[F.pmod(F.xxhash64("leaf", F.lit(depth), F.lit(i)), F.lit(TOKENS)) for i in range(TRIES)])
        rows = (deeper.join(sets.select("id", "tokens"), "id").withColumn("p", F.explode(F.array_distinct(tries)))
                .select("id", F.xxhash64("leaf", "p", F.expr("substring(tokens, cast(p as int) + 1, 1)")).alias("leaf"),
                        F.col("m").alias("parent")))
    out = leaves[0]
    for x in leaves[1:]:
        out = out.unionByName(x)
    return out


def _blocks(paths: DataFrame) -> DataFrame:
    """Deal the sets of each leaf to blocks (x, y), x <= y, so that any two of them meet in exactly one."""
    n = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "leaf"), n).cast("int")
    return (paths.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .select("leaf", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id"))


def _each_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, across batches of a sorted partition."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        if not t.num_rows:
            continue
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for k in keys:
            v = t.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(change).tolist()
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            yield t.slice(lo, hi - lo)
        held = t.slice(at[-1])
    if held is not None and held.num_rows:
        yield held


def _pairs_here(t: pa.Table) -> np.ndarray:
    """Which pairs of rows are compared in this block: each once, and only in the first leaf that both are in."""
    n = t.num_rows
    x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
    own = t.column("own").to_numpy()
    mask = np.triu(np.ones((n, n), bool), 1) if x == y else (own == x)[:, None] & (own == y)[None, :]
    leaf = t.column("leaf")[0].as_py()
    lists = t.column("leaves").combine_chunks()
    flat, rows = lists.flatten().to_numpy(), np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    rows, flat = rows[flat < leaf], flat[flat < leaf]
    values, which, count = np.unique(flat, return_inverse=True, return_counts=True)
    for v in np.flatnonzero(count > 1):
        both = rows[which == v]
        mask[np.ix_(both, both)] = False
    return mask


def _candidates(t: pa.Table) -> np.ndarray:
    """Rows with a pair that shares enough sampled tokens and fits in size."""
    mask = _pairs_here(t)
    sizes = t.column("n").to_numpy()
    small, large = np.minimum(sizes[:, None], sizes[None]), np.maximum(sizes[:, None], sizes[None])
    mask &= SIMILAR[1] * small >= SIMILAR[0] * large
    if not mask.any():
        return np.zeros(0, int)
    tokens = np.frombuffer(b"".join(t.column("tokens").to_pylist()), np.uint8).reshape(t.num_rows, TOKENS)
    if t.num_rows <= 64:
        i, j = np.nonzero(mask)
        hit = (tokens[i] == tokens[j]).sum(1) >= SHARED_TOKENS
        return np.unique(np.concatenate([i[hit], j[hit]]))
    same = np.zeros(mask.shape, np.uint8)
    for p in range(TOKENS):
        same += tokens[:, p][:, None] == tokens[:, p][None]
    mask &= same >= SHARED_TOKENS
    return np.flatnonzero(mask.any(0) | mask.any(1))


def _links(t: pa.Table) -> np.ndarray:
    """Which pairs of rows have a Jaccard similarity of at least 4/5, by their whole sets."""
    n = t.num_rows
    mask = _pairs_here(t)
    lists = t.column("shingles").combine_chunks()
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = lists.values.to_numpy()[offsets[0]:offsets[-1]]
    rows = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    new = np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)
    token = np.cumsum(new) - 1
    shared = np.bincount(token)[token] > 1 if len(token) else new  # a shingle of one set is shared with none
    token, rows = token[shared], rows[shared]
    both = np.zeros((n, n), np.float32)
    width = max(1, 8_000_000 // n)
    if len(token):
        token = np.cumsum(np.append(0, np.diff(token) > 0))
        for lo in range(0, int(token[-1]) + 1, width):
            a, b = np.searchsorted(token, [lo, lo + width])
            m = np.zeros((n, min(width, int(token[-1]) + 1 - lo)), np.float32)
            m[rows[a:b], token[a:b] - lo] = 1
            both += m @ m.T
    common = both.astype(np.int64)
    # common / (a + b - common) >= s / t
    s, of = SIMILAR
    return mask & ((s + of) * common >= s * (sizes[:, None] + sizes[None]))


def _least_linked(adjacent: np.ndarray) -> np.ndarray:
    """For each row the least row of its component."""
    label = np.arange(len(adjacent))
    while True:
        new = np.minimum(label, np.where(adjacent, label[None], len(label)).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _grouped(rows: DataFrame, fn: Callable[[pa.Table], list[tuple]], schema: str, arrow: pa.Schema) -> DataFrame:
    """``fn`` of each block's rows; blocks are bounded, and sorted partitions stream through the workers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for t in _each_group(batches, ["leaf", "x", "y"]):
            if t.num_rows > 1:
                out += fn(t.combine_chunks())
            if len(out) > 10_000:
                yield batch(out)
                out = []
        yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        cols = zip(*out, strict=True) if out else [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return rows.repartition("leaf", "x", "y").sortWithinPartitions("leaf", "x", "y", "id").mapInArrow(run, schema)


def _shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the wanted texts."""
    arrow = pa.schema([("id", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: set[bytes] = set()
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part, rows = b.slice(lo, 1000), []
                for td, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if td not in last:
                        last.add(td)
                        rows.append((td, shingle_set(text.as_py()).view(np.int64)))
                if len(last) > REMEMBERED:
                    last.clear()
                cols = zip(*rows, strict=True) if rows else [[], []]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    # merged at every size: what is wanted grows with the corpus, and a text with many copies can be split
    texts = docs.join(wanted.select(F.col("id").alias("td")).hint("merge"), "td", "left_semi").select("td", "t")
    return texts.mapInArrow(run, "id binary, shingles array<long>").groupBy("id").agg(F.any_value("shingles").alias("shingles"))


def near_duplicates(texts: DataFrame, text: Column, runs: int | None = None) -> DataFrame:
    """(td, set_id, n_texts, n_links, root): one row per distinct text with words; td is its MD5 digest.

    A text's words are runs without blanks (space, tab to carriage return);
    its set holds all runs of five words, or all words together if there are
    fewer. Texts are linked if the Jaccard similarity of their sets is 4/5 at
    least, copies aside. ``n_links``: other distinct texts it is linked to,
    ``n_texts``: distinct texts with the same set (all linked to each other),
    ``root``: digest shared by all texts that links join, ``set_id``: digest of
    the text that stands for the set. Null texts and texts without words have no set, no row and no link.

    Chosen path: in every run a set goes to the buckets of its sampled tokens;
    large buckets are split again by tokens that the path samples, small ones
    are compared by brute force, and runs are repeated until the target recall
    at the least similarity. Buckets that no token splits (near copies of one text) are
    compared in blocks that different tasks take. A pair is counted in the
    first leaf both sets are in, so no list of pairs is made or sorted: each block gives sums and one root per set.
    """
    docs = texts.select(F.unhex(F.md5(text.cast("binary"))).alias("td"), text.cast("string").alias("t"))
    runs = runs or runs_needed()
    sketches = materialise(_sketches(docs, runs), "sketches")
    sets = materialise(sketches.groupBy("sd").agg(
        F.min("td").alias("id"), F.count(F.lit(1)).alias("w"),
        *[F.any_value(c).alias(c) for c in ("n", "keys", "tokens")]), "sets")

    paths = materialise(_paths(sets), "leaves")
    lists = paths.groupBy("id").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))  # a bounded number for each set
    facts = sets.select("id", "n", "w", "tokens").join(lists, "id")
    blocks = _blocks(paths).join(facts, "id")

    cand_arrow = pa.schema([("leaf", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("own", pa.int32()), ("id", pa.binary())])

    def pick(t: pa.Table) -> list[tuple]:
        at = _candidates(t)
        t = t.select(["leaf", "x", "y", "own", "id"]).take(pa.array(at)) if len(at) else t.slice(0, 0)
        return list(zip(*[c.to_pylist() for c in t.columns[:5]], strict=True)) if t.num_rows else []

    found = materialise(_grouped(blocks, pick, "leaf long, x int, y int, own int, id binary", cand_arrow), "candidates")
    wanted = materialise(found.select("id").distinct(), "wanted")
    whole = materialise(_shingles(docs, wanted), "shingles")

    link_arrow = pa.schema([("id", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def verify(t: pa.Table) -> list[tuple]:
        linked = _links(t)
        if not linked.any():
            return []
        linked |= linked.T
        count = linked @ t.column("w").to_numpy()
        root, ids = _least_linked(linked), t.column("id").to_pylist()  # sorted by id: the least row has the least id
        return [(ids[i], int(count[i]), ids[root[i]]) for i in np.flatnonzero(linked.any(1))]

    rows = found.join(whole, "id").join(facts.select("id", "w", "leaves"), "id")
    linked = materialise(_grouped(rows, verify, "id binary, links long, root binary", link_arrow), "linked")
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))

    by_set = (sets.select("sd", "id", "w").join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
              .select("sd", "id", "w", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root")))
    return sketches.select("td", "sd").join(by_set, "sd").select(
        "td", F.col("id").alias("set_id"), F.col("w").alias("n_texts"),
        (F.col("links") + F.col("w") - 1).alias("n_links"), "root")


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``class_id``, ``set_class`` and ``n_links``.

    ``class_id``: the least key of the documents that copies and links join to
    this one; ``set_class``: the least key of those with the same text or set; ``n_links``: other distinct
    texts with a similarity of 4/5 at least. Documents without words are alone:
    their own key, no links. Null keys do not count for the least key (all null: null).
    """
    d = docs.select(F.col(f"`{key}`").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text}`").cast("binary"))).alias("td"))
    near = materialise(near_duplicates(docs.select(F.col(f"`{text}`").alias("t")), F.col("t")), "near")
    least = d.groupBy("td").agg(F.min("doc_id").alias("k"))
    near = materialise(near.join(least, "td"), "near-keys")
    by_root = near.groupBy("root").agg(F.min("k").alias("class_id"))
    by_set = near.groupBy("set_id").agg(F.min("k").alias("set_class"))
    near = near.join(by_root, "root").join(by_set, "set_id").select("td", "class_id", "set_class", "n_links")
    out = d.join(near, "td", "left")
    alone = F.col("n_links").isNull()
    return out.select(F.col("doc_id").alias(key), F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("set_class")).alias("set_class"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``; of each group of copies and near copies only the row of the least key (then digest).

    Rows without words (null texts too) belong to no group and stay. Of rows
    repeated with the same key and text one stays. Null keys come last.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = F.col(f"`{text}`")
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)],
                       F.unhex(F.md5(body.cast("binary"))).alias("d"), F.col(f"`{key}`").alias("k"),
                       F.coalesce(body.rlike(r"[^ \t-\r]"), F.lit(False)).alias("words"))
    near = near_duplicates(docs.select(body.alias("t")), F.col("t")).select("td", "root")
    # how many rows have a text and a key; the least key of a group names the row that stays
    counts = rows.where("words").groupBy("d", "k").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("k").isNull().alias("last"), "k", "td", "n")
    stays = materialise(near.join(counts, F.col("td") == F.col("d")).groupBy("root").agg(F.min(order).alias("s"))
                        .select("s.td", F.col("s.k").alias("least"), "s.n"), "stays")
    # the right side is narrow; a text with many copies is split like any skewed join
    kept = rows.where("words").join(stays, (F.col("d") == F.col("td")) & F.col("k").eqNullSafe(F.col("least")))
    if not stays.where("n > 1").isEmpty():  # a row that stays is there more than once
        first = F.row_number().over(Window.partitionBy("d").orderBy("k")) == 1
        once = kept.where("n > 1").withColumn("first", first).where("first")
        kept = kept.where("n = 1").select(names).unionByName(once.select(names))
    out = kept.select(names).unionByName(rows.where("not words").select(names))
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])

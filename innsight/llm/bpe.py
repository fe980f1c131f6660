"""Byte-pair encoding and decoding with a contiguous rank array."""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from innsight.llm.common import map_text

#: Words of up to so many bytes are merged in rank arrays; longer ones by a heap over linked parts.
SHORT_WORD = 64
#: Pieces of text of a generation that a worker remembers.
REMEMBERED = 150_000
#: Rank of a pair that never merges.
NEVER = np.int32(2**31 - 1)

# --- fixed values: the split pattern of the vocabulary, over an alphabet where this module and the tokenizers
# library agree (printable ASCII and the letters of Latin-1); other pieces go through the library's own splitting
PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
STOPS = b".,;:!?"
PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


class Vocabulary:
    """Merges of a tokenizers JSON file whose words end in a suffix and whose symbols are bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: t for t, i in [*ids.items(), *self.special.items()]}
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer

        chars = _byte_chars()
        self.inner = np.array([ids[c] for c in chars], np.int64)
        self.last = np.array([ids[c + suffix] for c in chars], np.int64)
        self.byte_of = {c: b for b, c in enumerate(chars)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(self.texts) + 1
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.by_pair = {k: r for r, k in reversed(list(enumerate(keys.tolist())))}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of neighbours."""
        k = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.ranks[at], NEVER)

    def merge(self, words: list[bytes]) -> dict[bytes, tuple[bytes, str]]:
        """Ids (little-endian 32-bit) and decoded text of each word (not empty)."""
        out: dict[bytes, tuple[bytes, str]] = {}
        by_length: dict[int, list[bytes]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for n, same in by_length.items():
            if n > SHORT_WORD:
                for w in same:
                    ids = self._merge_long(w)
                    out[w] = (ids.astype("<u4").tobytes(), decode(ids.tolist(), self))
                continue
            part, count = self._merge_short(np.frombuffer(b"".join(same), np.uint8).reshape(len(same), n))
            raw = part.astype("<u4").tobytes()
            for i, (w, c, ids) in enumerate(zip(same, count.tolist(), part.tolist(), strict=True)):
                out[w] = (raw[4 * n * i:4 * (n * i + c)], decode(ids[:c], self))
        return out

    def _merge_short(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of one length: ids of their parts, and how many are left of each.

        Row by row, ``part`` holds the ids of the parts that are left, ``ranks`` those of neighbours.
        """
        m, n = raw.shape
        part = self.inner[raw]
        part[:, -1] = self.last[raw[:, -1]]
        count = np.full(m, n)
        ranks = np.full((m, n), NEVER, np.int32)  # the last column never merges
        if n > 1:
            ranks[:, :-1] = self.rank(part[:, :-1], part[:, 1:])
        live = np.arange(m)
        while len(live) and n > 1:
            at = ranks[live].argmin(1)  # the leftmost of the least ranks
            best = ranks[live, at]
            live, at, best = live[best != NEVER], at[best != NEVER], best[best != NEVER]
            if not len(live):
                break
            # delete the boundary behind ``at``: everything right of it moves up by one
            cols = np.arange(n - 1)
            src = cols + (cols > at[:, None])
            part[live[:, None], cols] = np.take_along_axis(part[live], src, 1)
            part[live, at] = self.made[best]
            src = cols + (cols >= at[:, None])
            ranks[live[:, None], cols] = np.take_along_axis(ranks[live], src, 1)
            ranks[live, n - 1] = NEVER
            count[live] -= 1
            # only the ranks of the two new neighbours change
            right = at < count[live] - 1
            r, a = live[right], at[right]
            ranks[r, a] = self.rank(part[r, a], part[r, a + 1])
            ranks[live[~right], at[~right]] = NEVER
            left = at > 0
            r, a = live[left], at[left]
            ranks[r, a - 1] = self.rank(part[r, a - 1], part[r, a])
        return part, count

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word: linked parts and a heap of neighbour ranks, n log n."""
        raw = np.frombuffer(word, np.uint8)
        ids = self.inner[raw].tolist()
        n = len(ids)
        ids[-1] = int(self.last[raw[-1]])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = lambda i: self.by_pair.get(ids[i] * self.size + ids[after[i]]) if after[i] < n else None
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            if ids[i] != a or after[i] >= n or ids[after[i]] != b:
                continue
            gone = after[i]
            ids[i], ids[gone], after[i] = int(self.made[r]), -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (r := rank(j)) is not None:
                    heapq.heappush(heap, (r, j, ids[j], ids[after[j]]))
        return np.array([x for x in ids if x >= 0], np.int64)

    def words(self, piece: bytes) -> list[bytes]:
        """The words of a piece without blanks, in lower case; their bytes carry the merges."""
        if piece.isalpha():  # ASCII letters only
            return [piece.lower()]
        if piece[-1] in STOPS and piece[:-1].isalpha():
            return [piece[:-1].lower(), piece[-1:]]
        if PLAIN.fullmatch(piece):
            return [w.encode() for w in PLAIN_SPLIT.findall(piece.decode().lower())]
        text = self.normalizer.normalize_str(piece.decode("utf-8", "replace"))
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.splitter.pre_tokenize_str(text)]


@cache
def vocabulary(path: str) -> Vocabulary:
    """One for each worker process."""
    return Vocabulary(path)


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in vocabulary files: itself if it is a visible Latin-1 character, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encodes texts piece by piece.

    Pieces met lately are remembered in two generations: when the young one is
    full it becomes the old one, and a piece that is met again moves back, so
    frequent pieces stay and memory is bounded.
    """

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.young: dict[bytes, tuple[bytes, str]] = {}
        self.old: dict[bytes, tuple[bytes, str]] = {}
        self.words: dict[bytes, tuple[bytes, str]] = {}
        marks = [re.escape(s.encode()) for s in sorted(vocab.special, key=len, reverse=True)]
        self.marks = re.compile(b"(" + b"|".join(marks) + b")") if marks else None

    def learn(self, pieces: set[bytes]) -> None:
        special, v = {}, self.v
        split: dict[bytes, list[bytes]] = {}
        for p in pieces:
            if self.marks and b"<|" in p:
                # odd parts are special tokens, which are no words
                cut = self.marks.split(p)
                special[p] = [(i % 2, w) for i, c in enumerate(cut) for w in ([c] if i % 2 else v.words(c) if c else [])]
                split[p] = [w for odd, w in special[p] if not odd]
            else:
                split[p] = v.words(p)
        if len(self.words) > REMEMBERED:
            self.words = {}
        merged = self.words
        merged.update(v.merge(list({w for ws in split.values() for w in ws} - merged.keys())))
        for p, ws in split.items():
            if len(ws) == 1 and p not in special:
                self.young[p] = merged[ws[0]]
                continue
            parts = [merged[w] for w in ws]
            if p in special:
                parts = [(np.array([v.special[w.decode()]], "<u4").tobytes(), w.decode()) if odd else merged[w] for odd, w in special[p]]
            self.young[p] = (b"".join([i for i, _ in parts]), " ".join([t for _, t in parts]))

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids of each text as little-endian 32-bit integers, and the decoded text."""
        gc.disable()  # millions of small tuples, and no cycles among them
        try:
            return self._encode([t.encode("utf-8", "replace").split() for t in texts])
        finally:
            gc.enable()

    def _encode(self, pieces: list[list[bytes]]) -> list[tuple[bytes, str]]:
        fresh: set[bytes] = set()
        for ps in pieces:
            fresh.update(ps)
        fresh -= self.young.keys()
        for p in fresh & self.old.keys():
            self.young[p] = self.old[p]
        self.learn(fresh - self.old.keys())
        get, out = self.young.__getitem__, []
        for ps in pieces:
            ids, words = zip(*map(get, ps), strict=True) if ps else ((), ())
            out.append((b"".join(ids), " ".join(filter(None, words))))
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        return out


def decode(ids: list[int], vocab: Vocabulary) -> str:
    """The vocabulary has no decoder of its own: its tokens, special ones included, joined by a space."""
    return " ".join([vocab.texts[i] for i in ids])


FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
          T.StructField("decoded", T.StringType()), T.StructField("ids_sha256", T.StringType()),
          T.StructField("decoded_sha256", T.StringType())]

#: Characters of text that are encoded at a time.
BLOCK_CHARS = 4_000_000


def encode_texts(docs: DataFrame, vocab_path: str, text_col: str = "text", carry: list[str] | None = None,
                 digests_only: bool = False) -> DataFrame:
    """Add ``n_tokens``, ``ids`` (little-endian unsigned 32-bit), ``decoded`` and their SHA-256 hex digests.

    ``digests_only`` leaves out ``ids`` and ``decoded``. The ids are those of
    the tokenizers library without special tokens added; special tokens that
    stand in a text are encoded as such. A null text counts as empty: no
    tokens. Each row is encoded by itself, so repeated rows get equal results and an empty table none.
    Columns of the new names are replaced.

    Every distinct blank-separated piece of a block is split and merged once.
    Short words of one length are merged together: part boundaries and
    neighbour ranks lie in one array, the least rank is found by a scan, its
    boundary deleted and the two neighbour ranks refreshed.
    """
    fields = [f for f in FIELDS if not (digests_only and f.name in ("ids", "decoded"))]

    def make():
        enc = Encoder(vocabulary(vocab_path))

        def run(texts: pa.Array) -> list:
            cols: dict[str, list] = {f.name: [] for f in FIELDS}
            block, size = [], 0

            def flush():
                nonlocal block, size
                for ids, text in enc.encode(block):
                    cols["n_tokens"].append(len(ids) // 4)
                    cols["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    cols["decoded_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
                    if not digests_only:
                        cols["ids"].append(ids)
                        cols["decoded"].append(text)
                block, size = [], 0

            for t in texts:
                block.append(t.as_py() or "")
                size += len(block[-1])
                if size > BLOCK_CHARS:
                    flush()
            flush()
            return [cols[f.name] for f in fields]
        return run

    return map_text(docs, text_col, fields, make, carry)

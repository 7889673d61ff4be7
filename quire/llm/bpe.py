"""Encoding of a corpus with a public byte-level BPE vocabulary.

Catalyst cuts each text into chunks, a run of blanks with the word behind it (``regexp_extract_all`` in the JVM); no
pretoken of the vocabulary's pattern crosses the end of one. In the workers the chunks of a batch are dictionary-
encoded by Arrow, so each distinct chunk is encoded once a task and the ids of all its occurrences are assembled by
numpy; no Python code runs per occurrence. A chunk is split into pretokens by the vocabulary's pattern, and a pretoken
is encoded by a segment tree over its byte positions: a leaf holds the rank of the pair that begins there, an inner
node the smallest (rank, position) below it, so the root is the leftmost pair of least rank. A merge links the two
live neighbours and updates the three leaves it touches, each in logarithmic time; a pretoken of n bytes takes
O(n log n) whatever its shape. The trees of many short pretokens are advanced together, one merge each a step.

The vocabulary file is read once on the driver from a path that is a parameter and shipped to the workers as a
broadcast of fixed size. Null and empty texts give an empty list. Ids are never special tokens.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY_KEY = "spark.quire.tokenizer.path"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary is a fixed table; a larger file than this is not taken for one.
MAX_VOCABULARY_BYTES = 64 << 20
#: A run of blanks with the word behind it, in Java's dialect.
CHUNKS = r"\p{IsWhite_Space}*\P{IsWhite_Space}+|\p{IsWhite_Space}+"
#: The pretoken pattern that belongs to the byte-level vocabularies; \s means Unicode white space.
PRETOKENS = (
    r"'(?:s|t|re|ve|m|ll|d)"
    r"| ?\p{L}++| ?\p{N}++| ?[^\p{White_Space}\p{L}\p{N}]++"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Distinct chunks a task remembers before it starts afresh; a bound on memory, not on what is encoded.
MEMO = 400_000


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is no vocabulary file")
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class SegmentTree:
    """Smallest (rank, position) over positions 0..n-1, with point updates."""

    __slots__ = ("size", "tree")

    def __init__(self, leaves: list[int], none: int):
        size = 1
        while size < len(leaves):
            size *= 2
        tree = [none] * size + leaves + [none] * (size - len(leaves))
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        self.size, self.tree = size, tree

    def set(self, i: int, value: int) -> None:
        tree = self.tree
        i += self.size
        tree[i] = value
        while i > 1:
            a, b = tree[i], tree[i ^ 1]
            i >>= 1
            least = a if a < b else b
            if tree[i] == least:
                return
            tree[i] = least


SHIFT = 32
NONE = 1 << 62


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pretoken."""
    if not piece:
        return []
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    leaves = []
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        leaves.append(NONE if r is None else (r << SHIFT) | i)
    tree = SegmentTree(leaves, NONE)
    root = tree.tree
    end = list(range(1, n + 1))  # where the live part that begins here ends
    prev = list(range(-1, n - 1))
    while (best := root[1] if tree.size > 1 else root[tree.size]) != NONE:
        i = best & ((1 << SHIFT) - 1)
        j = end[i]
        k = end[j]
        end[i] = k
        if k < n:
            prev[k] = i
            r = get(piece[i : end[k]])
            tree.set(i, NONE if r is None else (r << SHIFT) | i)
        else:
            tree.set(i, NONE)
        if j < n - 1:
            tree.set(j, NONE)
        if i > 0:
            p = prev[i]
            r = get(piece[p:k])
            tree.set(p, NONE if r is None else (r << SHIFT) | p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """Ranks by bytes, and by pair of ranks for the trees that advance together."""

    def __init__(self, data: bytes):
        self.ranks = ranks = parse_ranks(data)
        self.split = regex.compile(PRETOKENS).findall
        self.byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        pairs = [(ranks[w[:i]] << 32 | ranks[w[i:]], r) for w, r in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs] + [1 << 62], dtype=np.int64)
        self.vals = np.array([v for _, v in pairs] + [0], dtype=np.int64)

    def leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        key = (left << 32) | right
        i = np.searchsorted(self.keys, key)
        return np.where(self.keys[i] == key, (self.vals[i] << SHIFT) | at, NONE)

    def encode_together(self, pieces: list[bytes], size: int) -> list[np.ndarray]:
        """Pretokens of at most ``size + 1`` bytes, ``size`` a power of two; one merge of every tree a step."""
        count = len(pieces)
        n = np.array([len(p) for p in pieces], dtype=np.int64)
        width = size + 2
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(count, width)
        tok = self.byte[raw]
        pos = np.arange(size, dtype=np.int64)
        tree = np.full((count, 2 * size), NONE, dtype=np.int64)
        tree[:, size:] = np.where(pos[None, :] < (n - 1)[:, None], self.leaf(tok[:, :size], tok[:, 1 : size + 1], pos[None, :]), NONE)
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        end = np.tile(np.arange(1, width + 1, dtype=np.int64), (count, 1))
        prev = np.tile(np.arange(-1, width - 1, dtype=np.int64), (count, 1))
        live = np.arange(width)[None, :] < n[:, None]
        a = np.arange(count)
        while True:
            best = tree[a, 1]
            go = best != NONE
            if not go.any():
                break
            a, best = a[go], best[go]
            i = best & ((1 << SHIFT) - 1)
            j = end[a, i]
            k = end[a, j]
            tok[a, i] = best >> SHIFT
            end[a, i] = k
            live[a, j] = False
            more = k < n[a]
            prev[a[more], k[more]] = i[more]
            after = np.where(more, self.leaf(tok[a, i], tok[a, np.minimum(k, width - 1)], i), NONE)
            p = prev[a, i]
            some = p >= 0
            before = self.leaf(tok[a[some], p[some]], tok[a[some], i[some]], p[some])
            gone = j < size
            rows = np.concatenate([a, a[gone], a[some]])
            leaf = np.concatenate([i, j[gone], p[some]]) + size
            tree[rows, leaf] = np.concatenate([after, np.full(int(gone.sum()), NONE, dtype=np.int64), before])
            while leaf[0] > 1:  # all leaves are on one level
                leaf = leaf >> 1
                tree[rows, leaf] = np.minimum(tree[rows, 2 * leaf], tree[rows, 2 * leaf + 1])
        return [tok[r][live[r]] for r in range(count)]

    def encode_pieces(self, pieces: list[str]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        classes: dict[int, list[str]] = {}
        for s in pieces:
            b = s.encode("utf-8")
            if (whole := self.ranks.get(b)) is not None:
                out[s] = [whole]
            elif len(b) > 257:
                out[s] = encode_piece(b, self.ranks)
            else:
                size = 2
                while size < len(b) - 1:
                    size *= 2
                classes.setdefault(size, []).append(s)
        for size, members in classes.items():
            step = max(64, 400_000 // size)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for s, ids in zip(part, self.encode_together([s.encode("utf-8") for s in part], size), strict=True):
                    out[s] = ids.tolist()
        return out


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(data: bytes) -> Vocabulary:
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(data)
    return _LOADED[key]


def _encode_batches(batches: Iterator[pa.RecordBatch], data: bytes) -> Iterator[pa.RecordBatch]:
    vocabulary = _vocabulary(data)
    memo: dict[str, list[int]] = {}
    small: dict[str, list[int]] = {}
    for batch in batches:
        chunks = batch.column("chunks")
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(memo) + len(small) > MEMO:
            memo, small = {}, {}
        parts = {s: vocabulary.split(s) for s in distinct if s not in memo}
        small |= vocabulary.encode_pieces(list({p for x in parts.values() for p in x if p not in small}))
        for s, x in parts.items():
            memo[s] = small[x[0]] if len(x) == 1 else [i for p in x for i in small[p]]
        flat, sizes = [], []
        for s in distinct:
            ids = memo[s]
            flat.extend(ids)
            sizes.append(len(ids))
        size = np.array(sizes, dtype=np.int64)
        start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        values = np.array(flat, dtype=np.int32)
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # ids of all occurrences: ranges [start, start + size) of the dictionary's ids, one after another
        count = size[index]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total, dtype=np.int64) + np.repeat(start[index] - (ends - count), count)
        ids = values[at] if total else np.zeros(0, np.int32)
        offsets = np.asarray(chunks.offsets)
        upto = np.concatenate([[0], ends]).astype(np.int64)[offsets - offsets[0]]
        lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids))
        yield pa.RecordBatch.from_arrays([batch.column("key"), lists], names=["key", "ids"])


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """(key, ids) with the ids of every row's text; other columns are not read. No shuffle."""
    spark = df.sparkSession
    data = read_vocabulary(vocabulary or spark.conf.get(VOCABULARY_KEY, VOCABULARY))
    shipped = spark.sparkContext.broadcast(data)
    cut = df.select(df[key].alias("key"), F.coalesce(F.regexp_extract_all(df[text], F.lit(CHUNKS), F.lit(0)), F.array().cast("array<string>")).alias("chunks"))
    kind = dict(cut.dtypes)["key"]
    out = cut.mapInArrow(lambda b: _encode_batches(b, shipped.value), f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)

"""Passages of held-out evaluation items inside a corpus, by Wu-Manber multi-pattern search.

Both sides are brought to one form in the JVM (lower case, markup and hidden characters removed, hyphenated line
breaks rejoined, everything but letters and digits one blank). Items of one form are one text, searched for once and
reported under all their ids. The patterns are the windows of ``WINDOW`` bytes that begin at the words of the texts.
Over the raw bytes of an Arrow batch, many cursors move at once: a table indexed by the hash of the last ``BLOCK``
bytes of the window gives the shift; where it is zero, the bucket of that suffix is compared with the window byte by
byte (as three machine words). Windows that stand in more than ``stock_share`` of the texts are phrases of the genre,
not of an item, and open no search.

How many texts hold a word, a phrase, a sentence or a window is counted once in Spark over all items; each text
carries the places that are common, so that no result depends on how items are put together for a search.

A hit is then extended word by word in both directions over the item and the document, tolerating changed, added and
missing words; the words of an item that are covered count, but for phrases of the genre (runs of five words that
stand in many items). A stock sentence is known by its shape: a short run (less than ``PASSAGE`` words) that more than
``COMMON_SHARE`` of the distinct documents hold from the same first to the same last word, and of the item nothing
else. It is taken out by counts over the whole corpus; documents that hold more of the item have no vote, however many
they are, and a run of ``PASSAGE`` words or more that goes well beyond each stock sentence stays. A document is reported
with an item if enough of the item's words remain, and enough of them are its own (words that few other items use). In
a run that is a passage, phrases of the genre count too, but not sentences that many items share. A text that shares
most of its words with many others is no carrier of a stock sentence but one of a family of near-copies; its passages
count whole.

The items are the stated query set: they are read in blocks of at most ``BLOCK_BYTES`` of text, ``PASS_BLOCKS`` of them
in one scan of the documents. What is shipped is the text of a block with its common places; the workers build the
tables, once each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import cut

WINDOW = 20
BLOCK = 8
TABLE_BITS = 21
STRIP = 2048
BLOCK_BYTES = 8 << 20
PASS_BLOCKS = 4
MIN_WORDS = 10
MIN_OWN = 6
MIN_RUN = 5
PHRASE = 5
OWN_SHARE = 0.1
STOCK_SHARE = 0.005
#: Words in a row that make a sentence, if many items share them; shorter ones are phrases, also of a passage.
SENTENCE = 8
#: Words that a passage has beyond stock sentences.
BEYOND = 8
COMMON_SHARE = 0.005
#: Covered words from which a run is a passage, whatever number of documents holds it.
PASSAGE = 14

#: Share of a text's words in sentences shared with many others from which it is one of a family of near-copies.
FAMILY = 0.5

#: What is taken out without a trace, and what is left as one blank.
_DROP = r"</?[A-Za-z!][^<>]*+>|\]\([^()\s]*+\)|[-‐‑]\s*\n\s*|[­​-‏⁠-⁤﻿*_`\[\]~]"
_BLANK = r"[^\p{L}\p{N}]+"


def plain_form(text: Column) -> Column:
    """Words in lower case between single blanks, with a blank at either end."""
    dropped = F.regexp_replace(F.lower(text), F.lit(_DROP), F.lit(""))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(dropped, F.lit(_BLANK), F.lit(" "))), F.lit(" "))


#: (text id, text, places of common words, starts of common phrases, of common sentences, of common windows)
Item = tuple[int, str, list[int], list[int], list[int], list[int]]


class WuManber:
    """Shift table, suffix buckets and comparison for windows of one length."""

    def __init__(self, items: list[Item]):
        self.text = {x[0]: x[1] for x in items}
        self._words: dict[int, list[str]] = {}
        self.own, self.generic, self.shared = {}, {}, {}
        windows, of, at = [], [], []
        for i, t, common, phrases, sentences, closed in items:
            n = t.count(" ") - 1
            spread = lambda starts, size: frozenset(k + d for k in starts for d in range(size))
            self.shared[i], self.generic[i] = spread(sentences, SENTENCE), spread(phrases, PHRASE)
            self.own[i] = frozenset(range(n)) - frozenset(common)
            if len(self.shared[i]) > FAMILY * n:
                self.shared[i], self.own[i], closed = frozenset(), frozenset(range(n)), []
            raw = np.frombuffer(t.encode("utf-8"), dtype=np.uint8)
            start = np.flatnonzero(raw == 32)
            k = np.arange(len(start))
            keep = (start + WINDOW <= len(raw)) & ~np.isin(k, closed)
            start, k = start[keep], k[keep]
            windows.append(raw[start[:, None] + np.arange(WINDOW)])
            of.append(np.full(len(k), i, dtype=np.int64))
            at.append(k)
        every = np.ascontiguousarray(np.concatenate(windows)) if windows else np.zeros((0, WINDOW), np.uint8)
        keys, which = np.unique(every.view(f"V{WINDOW}").ravel(), return_inverse=True)
        order = np.argsort(which, kind="stable")
        self.first = np.searchsorted(which[order], np.arange(len(keys) + 1))
        self.of, self.at = (np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (of, at))
        raw = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, WINDOW)
        word = lambda o: np.ascontiguousarray(raw[:, o : o + BLOCK]).view("<u8").ravel()
        self.shift = np.full(1 << TABLE_BITS, WINDOW - BLOCK + 1, dtype=np.uint8)
        for o in range(WINDOW - BLOCK + 1):
            h = self.hash(word(o))
            np.minimum.at(self.shift, h, np.uint8(WINDOW - BLOCK - o))
        suffix = word(WINDOW - BLOCK)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.order = suffix[order], order
        self.head, self.middle = word(0)[order], word(WINDOW - 2 * BLOCK)[order]

    def words(self, item: int) -> list[str]:
        if item not in self._words:
            self._words[item] = self.text[item].split()
        return self._words[item]

    def places(self, pattern: int) -> list[tuple[int, int]]:
        """(item, word) where a window stands."""
        a, z = self.first[pattern], self.first[pattern + 1]
        return list(zip(self.of[a:z].tolist(), self.at[a:z].tolist(), strict=True))

    @staticmethod
    def hash(x: np.ndarray) -> np.ndarray:
        return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, pattern) of every occurrence in a byte array."""
        n = len(data)
        if n < WINDOW or not len(self.suffix):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        view = np.ndarray(shape=(n - BLOCK + 1,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
        off = WINDOW - BLOCK
        pos = np.arange(0, n - WINDOW + 1, STRIP, dtype=np.int64) + off
        end = np.minimum(pos + STRIP, n - BLOCK + 1)
        found = []
        while len(pos):
            sh = self.shift[self.hash(view[pos])]
            if len(z := pos[sh == 0]):
                found.append(z)
            pos = pos + np.maximum(sh, 1)
            if not (go := pos < end).all():
                pos, end = pos[go], end[go]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate(found)
        block = view[at]
        lo, hi = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        some = hi > lo
        at, lo, size = at[some], lo[some], (hi - lo)[some]
        # every pattern of the bucket, compared directly
        ends = np.cumsum(size)
        k = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(lo, size)
        at = np.repeat(at, size)
        same = (view[at - off] == self.head[k]) & (view[at - BLOCK] == self.middle[k])
        return at[same] - off, self.order[k[same]]


def extend(item: list[str], doc: list[str], p: int, j: int) -> set[int]:
    """Item positions covered by the alignment around item[p] == doc[j], of a score that changes can't outweigh."""
    covered: set[int] = set()
    for step in (1, -1):
        a, b = (p, j) if step == 1 else (p - 1, j - 1)
        score = best = 0
        run: list[int] = []
        kept = 0
        while 0 <= a < len(item) and 0 <= b < len(doc):
            if item[a] == doc[b]:
                run.append(a)
                score += 1
                if score >= best:
                    best, kept = score, len(run)
                a, b = a + step, b + step
                continue
            for gap in _GAPS:
                x, y = a + step * gap[0], b + step * gap[1]
                x2, y2 = x + step, y + step
                if 0 <= x < len(item) and 0 <= y < len(doc) and item[x] == doc[y] and (not (0 <= x2 < len(item) and 0 <= y2 < len(doc)) or item[x2] == doc[y2]):
                    a, b = x, y
                    score -= 1 + max(gap)
                    break
            else:
                break
            if score < best - 6:
                break
        covered.update(run[:kept])
    return covered


_GAPS = sorted(((x, y) for x in range(4) for y in range(4) if x + y), key=lambda g: (max(g), sum(g)))


_AT = pa.list_(pa.int32())
_RUNS = pa.list_(pa.struct([("at", _AT), ("own", _AT)]))
#: What a worker built of a block; a few blocks at most are searched in one scan.
_BUILT: dict[str, WuManber] = {}


def _engine(name: str, shipped: Broadcast) -> WuManber:
    if (e := _BUILT.get(name)) is None:
        while len(_BUILT) >= PASS_BLOCKS:
            del _BUILT[next(iter(_BUILT))]
        e = _BUILT[name] = WuManber(shipped.value)
    return e


def _bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a column of strings, whatever the width of its offsets."""
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = text.buffers()
    wide = pa.types.is_large_string(text.type)
    if not (wide or pa.types.is_string(text.type)):
        raise TypeError(f"a column of strings is needed, not {text.type}")
    o = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, o - o[0]


def _find_in(engine: WuManber, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """(row, item, at, own, alone, runs) of every item that a row of the batch holds words of."""
    start, pattern = engine.find(data)
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + WINDOW <= offsets[row + 1] if len(start) else np.zeros(0, bool)
    start, pattern, row = start[inside], pattern[inside], row[inside]
    order = np.lexsort((start, row))
    cuts = np.flatnonzero(np.diff(row[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        r = int(row[part[0]])
        raw = data[offsets[r] : offsets[r + 1]]
        words = raw.tobytes().decode("utf-8").split()
        starts = np.flatnonzero(raw == 32)
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for o, j in zip(part.tolist(), np.searchsorted(starts, start[part] - offsets[r]).tolist(), strict=True):
            for item, p in engine.places(int(pattern[o])):
                seeds[item].append((p, j))
        for item, places in seeds.items():
            covered: set[int] = set()
            passages = []
            for p, j in places:
                if p not in covered:
                    part_ = extend(engine.words(item), words, p, j)
                    if len(part_) >= MIN_RUN:
                        covered |= part_
                    if len(part_) >= PASSAGE:
                        passages.append(part_ - engine.shared[item])
            left, own = covered - engine.generic[item], engine.own[item]
            if left or passages:
                yield r, item, sorted(left), sorted(left & own), [min(covered), max(covered)] if len(covered) < PASSAGE else None, [{"at": sorted(x), "own": sorted(x & own)} for x in passages]


def _search(batches: Iterator[pa.RecordBatch], blocks: list, first: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = _bytes_of(batch.column("text"))
        rows = [x for b in blocks for x in _find_in(_engine(*b), data, offsets)]
        cols = list(zip(*rows, strict=True)) or [()] * 6
        take = pa.array(cols[0], type=pa.int64())
        out = [batch.column("key").take(take), batch.column("print").take(take), *(pa.array(c, type=t) for c, t in zip(cols[1:], (pa.int64(), _AT, _AT, _AT, _RUNS), strict=True))]
        names = ["key", "print", "item", "at", "own", "alone", "runs"]
        yield pa.RecordBatch.from_arrays([*out, pa.nulls(len(rows), pa.list_(pa.int64()))], names=[*names, "prints"])
        if first:  # all documents of the batch, to be counted
            prints = pa.array([batch.column("print").to_pylist()], type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, c.type) for c in out), prints], names=[*names, "prints"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, kind, key, at): where each word, phrase, sentence and window stands in a text."""
    for b in batches:
        rows: list[tuple[int, str, bytes, list[int]]] = []
        for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
            w, raw = t.split(), t.encode("utf-8")
            where: dict[tuple[str, bytes], list[int]] = defaultdict(list)
            for kind, size in (("word", 1), ("phrase", PHRASE), ("sentence", SENTENCE)):
                for k in range(len(w) - size + 1):
                    where[kind, " ".join(w[k : k + size]).encode("utf-8")].append(k)
            at, k = raw.find(b" "), 0
            while at >= 0 and at + WINDOW <= len(raw):
                where["window", raw[at : at + WINDOW]].append(k)
                at, k = raw.find(b" ", at + 1), k + 1
            rows += [(i, kind, key, places) for (kind, key), places in where.items()]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.binary(), _AT), strict=True)], names=["item", "kind", "key", "at"])


def item_texts(items: DataFrame, item: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(ids, texts): (item, id) of every item, and (item, text, common, phrases, sentences, windows) of every text.

    Texts are numbered as they come. The arrays are the places of its words, phrases, sentences and windows
    that stand in many texts of the whole table.
    """
    rows = items.select(items[item].alias("id"), plain_form(items[text]).alias("text")).where("text is not null and id is not null")
    texts = cut(rows.select("text").distinct().withColumn("item", F.monotonically_increasing_id()))
    ids = rows.join(texts, "text").select("item", "id").distinct()
    n = texts.count()
    stock = max(1, int(STOCK_SHARE * n + 0.5))
    grams = texts.mapInArrow(_grams, "item bigint, kind string, key binary, at array<int>")
    many = grams.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.when(F.col("kind") == "word", max(stock, int(OWN_SHARE * n))).otherwise(stock))
    places = lambda kind: F.array_sort(F.flatten(F.collect_list(F.when(F.col("kind") == kind, F.col("at")))))
    common = grams.join(many.select("kind", "key"), ["kind", "key"]).groupBy("item").agg(*(places(k).alias(k) for k in _KINDS))
    none = F.array().cast("array<int>")
    return ids, texts.join(common, "item", "left").select("item", "text", *(F.coalesce(k, none).alias(k) for k in _KINDS))


_KINDS = ("word", "phrase", "sentence", "window")


def _blocks(texts: DataFrame, block_bytes: int) -> Iterator[list[Item]]:
    part, size = [], 0
    for r in texts.orderBy("item").toLocalIterator():
        part.append(tuple(r))
        size += len(r["text"])
        if size > block_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


def leaked_words(docs: DataFrame, key: str, text: str, texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, print, item, at, own, alone, runs, prints): what is found in each document, before stock sentences go.

    ``texts`` are those of ``item_texts``. ``print`` tells documents of other words apart, ``at`` and ``own`` are item
    word positions, ``alone`` the first and last of them where they are less than a passage, ``runs`` the positions in
    each run that is a passage. Rows of another kind have nothing but ``prints``: those of all documents of a batch.
    """
    src = docs.select(docs[key].alias("key"), plain_form(docs[text]).alias("text")).where("text is not null").withColumn("print", F.xxhash64("text"))
    kind = dict(src.dtypes)["key"]
    schema = f"key {kind}, print bigint, item bigint, at array<int>, own array<int>, alone array<int>, runs array<struct<at: array<int>, own: array<int>>>, prints array<bigint>"
    sc = docs.sparkSession.sparkContext
    shipped = [(uuid4().hex, sc.broadcast(b)) for b in _blocks(texts, block_bytes)]
    out = None
    for k in range(0, len(shipped), PASS_BLOCKS):
        part = src.mapInArrow(lambda b, s=shipped[k : k + PASS_BLOCKS], f=not k: _search(b, s, f), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def leaked_items(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, min_words: int = MIN_WORDS, min_own: int = MIN_OWN, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item, n_words, n_own) of every document that holds a passage of an item.

    Null texts and items hold nothing; an item shorter than ``min_words`` cannot be found; copies of a document are
    each reported but count once towards a stock sentence; an item listed several times is one text, reported under
    each of its ids; repeated rows of a key give one row.
    """
    ids, texts = item_texts(items, item, item_text)
    # read three times below; a few rows beside the corpus, kept where all executors can read them
    found = cut(leaked_words(docs, key, text, texts, block_bytes))
    hits = found.where("prints is null").drop("prints")
    n_docs = found.where("prints is not null").select(F.explode("prints").alias("print")).distinct().count()
    # what one document holds is no stock
    limit = max(1, int(COMMON_SHARE * n_docs))
    spread = hits.where("alone is not null").select("print", "item", "alone").distinct().groupBy("item", "alone").count().where(F.col("count") > limit)
    stock = spread.groupBy("item").agg(F.collect_list("alone").alias("stock"))  # at most some runs of each first word of one item
    left = hits.join(stock, "item", "left").withColumn("stock", F.coalesce("stock", F.array().cast("array<array<int>>")))
    out = lambda p, s: (p < s[0]) | (p > s[1])
    size = lambda c: F.size(F.filter(c, lambda p: F.forall("stock", lambda s: out(p, s))))
    # what a passage has beyond that stock sentence of which it holds most
    beyond = lambda c: F.array_min(F.concat(F.array(F.size(c)), F.transform("stock", lambda s: F.size(F.filter(c, lambda p: out(p, s))))))
    whole = F.transform("runs", lambda x: F.struct(beyond(x["at"]).alias("n_words"), beyond(x["own"]).alias("n_own")))
    enough = lambda n: lambda x: (x["n_words"] >= n) & (x["n_own"] >= min_own)
    pieces = F.array(F.struct(size("at").alias("n_words"), size("own").alias("n_own")))
    best = left.select("key", "item", F.explode(F.concat(F.filter(pieces, enough(min_words)), F.filter(whole, enough(min(BEYOND, min_words))))).alias("x"))
    best = best.groupBy("key", "item").agg(F.max("x.n_words").alias("n_words"), F.max("x.n_own").alias("n_own"))
    return best.join(ids, "item").select(F.col("key").alias(key), F.col("id").alias(item), "n_words", "n_own")

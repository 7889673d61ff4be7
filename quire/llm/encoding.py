"""Text garbled by a wrong character encoding: found and restored through a table of garbled word forms.

Every distinct clean word of the corpus that holds a character beyond ASCII is garbled under all encoding chains
(written in one encoding and read in another, once, twice or three times, also where characters are lost on the way).
The tokens of the examined fields are hash-joined with that table; a token that equals a garbled form of a clean word,
and is no clean word itself, is a case, and the word is its original. The same is done for runs of characters beyond
ASCII, so that a quote or sign inside an otherwise unknown name is found as well. Words and tokens are runs of ASCII
letters, digits and characters beyond ASCII, of any script. Where a chain makes ASCII signs out of a word, as Shift-JIS
read byte by byte does, its form is more than one token and is not found.

The forms of a batch of words are made chain by chain over the whole batch, which is one text with a word a line. Most
forms are those of no token at all: before they leave the worker they are looked up in a Bloom filter of the unknown
tokens, a bitmap of fixed size that is all that is shipped. What passes it is joined exactly.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import cut

REPLACEMENT = "�"
WESTERN = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850")
CENTRAL = ("cp1250", "iso8859-2")
CYRILLIC = ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic")
GREEK = ("cp1253",)
WIDE = ("cp932", "gbk", "euc_jp")
MISREAD = WESTERN + CENTRAL + CYRILLIC + GREEK
_DOUBLED = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8-r", "cp866")


@lru_cache(None)
def _reader(name: str) -> str:
    """Byte to character; an undefined byte stays the control character of its number."""
    out = []
    for i in range(256):
        try:
            out.append(codecs.decode(bytes([i]), name))
        except UnicodeDecodeError:
            out.append(chr(i))
    return "".join(out)


@lru_cache(None)
def _writer(name: str):
    table = _reader(name)
    return codecs.charmap_build(table) if len(set(table)) == 256 else {ord(c): i for i, c in reversed(list(enumerate(table)))}


def _write(text: str, name: str) -> bytes:
    """A character that the encoding has not becomes a question mark, which no word holds."""
    if name == "utf-8":
        return text.encode("utf-8", "surrogatepass")
    if name in WIDE:
        return text.encode(name, "replace")
    return codecs.charmap_encode(text, "replace", _writer(name))[0]


def _read(data: bytes, name: str) -> str:
    if name == "ascii":
        return data.decode("ascii", "replace")
    if name == "utf-8" or name in WIDE:
        return data.decode(name, "replace")
    return codecs.charmap_decode(data, "strict", _reader(name))[0]


def _chains() -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = [("utf-8", r) for r in MISREAD + WIDE]
    out += [("utf-8", x, "utf-8", y) for x in _DOUBLED for y in _DOUBLED]
    out += [("utf-8", x) * 3 for x in _DOUBLED]
    for group, others in ((("cp1252", "mac_roman", "cp437", "cp850"), MISREAD), (CENTRAL, WESTERN + CENTRAL), (CYRILLIC, CYRILLIC + WESTERN), (GREEK, WESTERN), (WIDE, WESTERN[:2] + WIDE)):
        out += [(a, b) for a in group for b in others if a != b]
    # characters lost: bytes that the reader replaces
    out += [("utf-8", "ascii"), *((x, "utf-8") for x in ("cp1252", "cp1250", "cp1251", "koi8-r", "cp866", "mac_roman", "cp437", *WIDE))]
    out += [("utf-8", "ascii", "utf-8", "cp1252"), ("cp1252", "utf-8", "utf-8", "cp1252")]
    return list(dict.fromkeys(out))


CHAINS = _chains()


def garble(text: str, chain: tuple[str, ...]) -> str:
    """The text after a chain of misreadings; a word that the chain cannot write comes out with a question mark."""
    for i in range(0, len(chain), 2):
        text = _read(_write(text, chain[i]), chain[i + 1])
    return text


#: A form that shows something: a letter, mark, sign or a control character of the bytes 128 to 159.
_SHOWN = r"[^\x00-\x7f\p{Cf}\p{Zs}]"
#: What a form may consist of: the characters of tokens.
_WHOLE = r"^[A-Za-z0-9\x{80}-\x{10ffff}]+$"
_UNDEFINED = re.compile("[\x80-\x9f]")


def _without_undefined(text: str) -> tuple[str, str]:
    """The text with each control character of the bytes 128 to 159 replaced, and without them."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bad = (cp >= 0x80) & (cp < 0xA0)
    return np.where(bad, np.uint32(ord(REPLACEMENT)), cp).tobytes().decode("utf-32-le", "surrogatepass"), cp[~bad].tobytes().decode("utf-32-le", "surrogatepass")


def _lines(words: list[str], chain: tuple[str, ...]) -> list[str]:
    lines = garble("\n".join(words), chain).split("\n")
    return lines if len(lines) == len(words) else [garble(w, chain) for w in words]  # a line end became part of a character


def garbled_forms(words: list[str], wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(places of the words, their forms) under each chain, also with the undefined bytes of cp1252 lost or replaced.

    A word that the chain leaves as it is, or turns into ASCII or into nothing visible, has no form there; nor has one
    whose form is not in the filter ``wanted``.
    """
    for chain in CHAINS:
        lines = _lines(words, chain)
        yield from _kept(words, lines, wanted, 1)
        whole = "\n".join(lines)
        if _UNDEFINED.search(whole):
            lost, bare = _without_undefined(whole)
            yield from _kept(lines, lost.split("\n"), wanted, 1)
            yield from _kept(lines, bare.split("\n"), wanted, 2)


def _kept(before: list[str], lines: list[str], wanted: np.ndarray | None, least: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    at = np.arange(len(lines)) if wanted is None else _passing(np.array(lines, dtype=object), wanted)
    if len(at):
        forms, old = pa.array([lines[i] for i in at], pa.string()), pa.array([before[i] for i in at], pa.string())
        good = pc.and_(pc.and_(pc.not_equal(forms, old), pc.match_substring_regex(forms, _WHOLE)), pc.match_substring_regex(forms, _SHOWN))
        keep = np.flatnonzero(pc.and_(good, pc.greater_equal(pc.utf8_length(forms), least)).to_numpy(zero_copy_only=False))
        if len(keep):
            yield at[keep], forms.take(pa.array(keep))


#: Bits of the filter of unknown tokens, a fixed 4 MB; more tokens than it is made for only let more forms pass.
FILTER_BITS = 25
_SEEDS = ("0123456789123456", "6543210987654321")


def _bits(raw: np.ndarray, seed: str) -> np.ndarray:
    return (pd.util.hash_array(raw, hash_key=seed, categorize=False) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _passing(raw: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.arange(len(raw))
    for seed in _SEEDS:
        h = _bits(raw[at], seed)
        at = at[(wanted[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)]
        if not len(at):
            break
    return at


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, bits): 64-bit words of the filter with the bits of the tokens of a partition."""
    bits = None
    for b in batches:
        bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8) if bits is None else bits
        raw = b.column("token").to_numpy(zero_copy_only=False)
        for h in (_bits(raw, seed) for seed in _SEEDS):
            np.bitwise_or.at(bits, h >> 3, (1 << (h & 7)).astype(np.uint8))
    if bits is not None:
        words = bits.view("<i8")
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "bits"])


def token_filter(tokens: DataFrame) -> np.ndarray:
    """Bloom filter of the tokens: at most 2 ** FILTER_BITS bits reach the driver, whatever the number of tokens."""
    words = np.zeros(1 << (FILTER_BITS - 6), "<i8")
    parts = tokens.select("token").mapInArrow(_set_bits, "at bigint, bits bigint").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits"))
    for b in parts.toArrow().to_batches():
        words[b.column("at").to_numpy()] = b.column("bits").to_numpy()
    return words.view(np.uint8)


#: Words garbled together; one text of them is a few hundred kilobytes.
_AT_ONCE = 4096


def _table(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        variants = [(v, n * 2 + (v == w), as_word) for w, n, as_word in zip(*(b.column(c).to_pylist() for c in ("word", "n", "as_word")), strict=True) for v in {w, w.lower(), w.upper(), w.capitalize()}]
        for k in range(0, len(variants), _AT_ONCE):
            words, weight, as_word = zip(*variants[k : k + _AT_ONCE], strict=True)
            weight, as_word, words = np.array(weight), np.array(as_word), list(words)
            size = np.array([len(w) for w in words])
            for at, forms in garbled_forms(words, wanted):
                # a run tells by itself, without the word around it, where its bytes were read one by one or lost
                telling = (pc.utf8_length(forms).to_numpy() > size[at]) | pc.match_substring(forms, REPLACEMENT).to_numpy(zero_copy_only=False)
                i = np.flatnonzero(as_word[at] | telling)
                yield pa.RecordBatch.from_arrays([forms.take(pa.array(i)), pa.array([words[j] for j in at[i]], pa.string()), pa.array(weight[at[i]], pa.int64()), pa.array(telling[i])], names=["token", "original", "weight", "telling"])


_TOKEN = r"[A-Za-z0-9\x{80}-\x{10FFFF}]*[\x{80}-\x{10FFFF}][A-Za-z0-9\x{80}-\x{10FFFF}]*"
_RUN = r"[\x{80}-\x{10FFFF}]+"
#: A clean token: letters, digits, marks, punctuation and signs of ordinary text in any script.
_CLEAN = r"^[A-Za-z0-9\p{L}\p{M}\p{Nd}‘’“”–—…«»„‚‹›·•°§©®™№½¼¾²³¹×÷€£¥¡¿、。〈-】〜！？：；，（）・ー]+$"
_TYPOGRAPHIC = r"[‘’“”–—…«»„‚‹›·•、。〈-】〜！？：；，（）・]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def corpus_words(texts: Iterable[DataFrame]) -> DataFrame:
    """(kind, word, n): distinct clean words (w) and runs beyond ASCII (r) of one-column frames of text."""
    parts = []
    for t in texts:
        c = t.columns[0]
        parts.append(t.select(F.explode(tokens(F.col(c))).alias("word")).where(F.col("word").rlike(_CLEAN)).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    words = reduce(DataFrame.unionByName, parts).groupBy("word").agg(F.sum("n").alias("n"))
    pieces = words.select("n", F.explode(F.concat(
        F.array(F.struct(F.lit("w").alias("kind"), F.col("word"))),
        F.transform(F.filter(F.split("word", _TYPOGRAPHIC), lambda x: x.rlike(_RUN)), lambda x: F.struct(F.lit("w").alias("kind"), x.alias("word"))),
        F.transform(F.regexp_extract_all("word", F.lit(_RUN), F.lit(0)), lambda x: F.struct(F.lit("r").alias("kind"), x.alias("word"))),
    )).alias("x")).select("x.kind", "x.word", "n")
    return pieces.groupBy("kind", "word").agg(F.sum("n").alias("n"))


def garbled_table(words: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """(token, original, weight, telling): the garbled forms of all words, those in the filter if one is given."""
    src = words.groupBy("word").agg(F.max("n").alias("n"), F.bool_or(F.col("kind") == "w").alias("as_word"))
    # a few words make many forms: keep the tasks that the planner would put together for their small input
    src = src.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("word"))
    return src.mapInArrow(lambda b: _table(b, wanted), "token string, original string, weight bigint, telling boolean")


def garbled_tokens(fields: DataFrame, words: DataFrame) -> DataFrame:
    """(field, record_id, kind, token, original, weight) of every garbled token or run.

    ``fields``: field, record_id, text. A null, empty or pure ASCII text has none. Repeated records come out once
    for each of their tokens. A token with a replacement character lost something for good; where it is the form of no
    word of the corpus, its original is null and its weight 0.
    """
    toks = fields.select("field", "record_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    keys = toks.select("field", "record_id", F.explode(F.array_distinct(F.concat(
        F.array(F.struct(F.lit("w").alias("kind"), F.col("token"))),
        F.transform(F.regexp_extract_all("token", F.lit(_RUN), F.lit(0)), lambda x: F.struct(F.lit("r").alias("kind"), x.alias("token"))),
    ))).alias("x")).select("field", "record_id", "x.kind", "x.token", F.lower("x.token").alias("low"))
    # a form that is itself a clean word of the corpus, in any case, tells nothing; what is left is little
    clean = words.select("kind", F.lower("word").alias("low")).distinct()
    unknown = cut(keys.join(clean, ["kind", "low"], "left_anti").drop("low"))
    distinct = unknown.select("token").distinct()
    table = garbled_table(words, token_filter(distinct))
    rank = F.struct(F.col("original").rlike(r"\p{L}"), "weight", "original")
    best = table.join(distinct, "token", "left_semi").groupBy("token").agg(
        F.max_by("original", rank).alias("w"), F.max("weight").alias("weight"), F.max_by("original", F.when(F.col("telling"), rank)).alias("r"))
    # nothing but replacement characters is the form of many words, and tells of none of them
    nothing = F.col("token").rlike(f"^{REPLACEMENT}+$")
    found = unknown.join(best, "token", "left").withColumn("original", F.when(~nothing, F.when(F.col("kind") == "w", F.col("w")).otherwise(F.col("r"))))
    lost = (F.col("kind") == "w") & F.col("token").contains(REPLACEMENT)
    return found.where(F.col("original").isNotNull() | lost).select("field", "record_id", "kind", "token", "original", F.coalesce("weight", F.lit(0)).cast("bigint").alias("weight"))


def garbled_fields(fields: DataFrame, words: DataFrame) -> DataFrame:
    """(field, record_id) of every field with at least one garbled sequence.

    A single letter that some other letter may have become is none by itself, since it may be a word of another
    language; one of Cyrillic that was another of Cyrillic is, since the few words of one letter there are clean words,
    unless it looks like a Latin letter.
    """
    hit = garbled_tokens(fields, words)
    letter = (F.length("token") == 1) & F.col("token").rlike(r"^\p{L}$")
    same = F.col("token").rlike(r"^[\p{IsCyrillic}&&[^АВЕЗІКМНОРСТУХЅЈасеорухіѕј]]$") & F.coalesce(F.col("original").rlike(r"^\p{IsCyrillic}$"), F.lit(False))
    hit = hit.where(~letter | same)
    return hit.select("field", "record_id").distinct()


def restore(fields: DataFrame, words: DataFrame) -> DataFrame:
    """(field, record_id, text, restored, complete) of the garbled fields.

    A garbled token is replaced by the most frequent clean word it may come from, a garbled run inside a token that is
    none by the run it comes from; ``complete`` is false where a replacement character is left, as where a whole word is
    lost.
    """
    hit = garbled_tokens(fields, words)
    # whole tokens first, then runs, longer before shorter, so that a part never spoils the whole
    pairs = hit.groupBy("field", "record_id").agg(F.sort_array(F.collect_set(F.when(F.col("original").isNotNull(), F.struct(F.when(F.col("kind") == "w", 1).otherwise(0).alias("w"), F.length("token").alias("n"), "token", "original"))), asc=False).alias("pairs"))
    out = fields.join(pairs, ["field", "record_id"])
    fixed = F.expr("aggregate(pairs, text, (acc, p) -> replace(acc, p.token, p.original))")
    return out.select("field", "record_id", "text", fixed.alias("restored")).withColumn("complete", ~F.col("restored").contains(REPLACEMENT))

"""Per-document text statistics and what a document mainly is: prose, list, table or junk.

A text is cut into chunks of ``CHUNK`` characters; nearly all documents are one chunk and pass without a
shuffle. Each chunk yields a partial state: sums of what lies wholly inside it, and the features of the two line
fragments at its edges. A chunk carries a few characters of what surrounds it (``LEFT``, ``RIGHT``), which settles
words and blanks that straddle a cut. States form a monoid (``merge``): the right fragment of one chunk and the left
fragment of the next become one line, which is then classified like any other. Documents of several chunks are merged
in a tree, ``FAN`` states a step, so no task ever sees more than ``FAN`` states of one document at a time.

Line rules give list, table, junk or prose weights in non-blank characters; the shape is what holds at least half.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 17
LEFT, RIGHT = 3, 32
FAN = 64
#: Characters counted at a time.
SLICE = 1 << 16
#: common_words is a fixed table of frequent words; a larger one is not taken for it.
MAX_COMMON = 100_000
#: Share of the non-blank characters from which something other than prose is the document's shape.
MAIN = 0.5

SUMS = ["chars", "nonspace", "letters", "digits", "symbols", "words", "word_chars", "common", "repeats", "vowelless", "lines", "ended", "w_list", "w_table", "w_junk", "w_prose", "n_short", "w_short", "n_list", "n_table", "sentence_marks"]
IX = {k: i for i, k in enumerate(SUMS)}
#: A line or line fragment: counts that add up, and both its ends. Marks of lists and headings and the number behind a
#: running title are shorter than EDGE; all other rules are over counts, so no line is too long for them.
EDGE = 40
FRAG = ["chars", "nonspace", "letters", "digits", "words", "common", "pipes", "semis", "tabs", "commas", "gaps", "tags", "odd", "longest", "ones", "lead", "trail", "tokens", "loose", "cjk", "dashes", "rules", "indent"]
FX = {k: i for i, k in enumerate(FRAG)}

_WORD = re.compile(r"[^\W_]+")
_DIGIT = re.compile(r"\d")
#: Characters that prose hardly has: private use, replacement, geometric and box signs, and those of rules and code.
_ODD = re.compile("[\ue000-\uf8ff\ufffd\u2580-\u25ff\u00a4\u00a7^~\\\\|=_#*<>/]")
_GAP = re.compile(r"(?<=   )\S")
#: A tab between cells; one behind the end of a sentence or behind other blanks is an odd blank of prose.
_TAB = re.compile(r"(?<=[^\s.!?…。！？])\t")
_TAG = re.compile(r"</?t(?:able|r|d|h|head|body)\b", re.I)
_BULLET = re.compile(r"(?:[-*+•–—◦▪▫■●○◆◇►▸‣⁃·]|\(?\d{1,4}[.)]|\(?[a-zA-Z][.)]|\(?[ivxlcIVXLC]{1,6}[.)])\s")
_HEADING = re.compile(r"#{1,6}\s")
_RUNNING = re.compile(r"<<\s*\d{0,9}$")
_RULES = frozenset("-=_~*.#^<>|/\\+")
_END = ".!?…。！？:;»”\"'’)"
_STOP = ".!?…。！？"
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
def _fragment(s: str, common: frozenset[str], before: str = "", after: str = "") -> tuple[list[int], str, str]:
    """Features of a line or of a part of one; words, tokens, tags and gaps count where they begin.

    ``before`` and ``after`` are the characters around the part on the same line.
    """
    text, n = before + s + after, len(before)
    stop = n + len(s)
    inside = [m.group().lower() for m in _WORD.finditer(text) if n <= m.start() < stop]
    alnum = sum(map(len, _WORD.findall(s)))
    digits = len(_DIGIT.findall(s))
    tokens = s.split()
    f = [0] * len(FRAG)
    f[0], f[1], f[2], f[3] = len(s), sum(map(len, tokens)), alnum - digits, digits
    f[4] = len(inside)
    f[5] = sum(map(common.__contains__, inside))
    f[6], f[7], f[9] = s.count("|"), s.count(";"), s.count(",")
    f[8] = sum(n <= m.start() < stop for m in _TAB.finditer(text))
    f[10] = sum(n <= m.start() < stop for m in _GAP.finditer(text))
    f[11] = sum(n <= m.start() < stop for m in _TAG.finditer(text)) if "<" in s else 0
    f[12] = len(_ODD.findall(s))
    f[13] = max(map(len, tokens), default=0)
    f[14] = sum(n <= m.start() < stop and m.end() - m.start() <= 2 for m in re.finditer(r"\S+", text))
    f[15] = len(tokens[0]) if tokens and not s[0].isspace() else 0
    f[16] = len(tokens[-1]) if tokens and not s[-1].isspace() else 0
    f[17] = len(tokens)
    f[18] = sum(c == "," and text[n + i + 1 : n + i + 2] == " " for i, c in enumerate(s))
    f[19] = len(_CJK.findall(s))
    f[20], f[21] = s.count("-"), sum(map(_RULES.__contains__, s))
    f[22] = len(s) - len(s.lstrip(" "))
    line = " ".join(tokens)
    return f, line[:EDGE], line[-EDGE:]


def _join(a: tuple[list[int], str, str], b: tuple[list[int], str, str]) -> tuple[list[int], str, str]:
    f = [x + y for x, y in zip(a[0], b[0], strict=True)]
    chars, longest, lead, trail = FX["chars"], FX["longest"], FX["lead"], FX["trail"]
    f[longest] = max(a[0][longest], b[0][longest], a[0][trail] + b[0][lead])
    f[lead] = a[0][lead] + (b[0][lead] if a[0][lead] == a[0][chars] else 0)
    f[trail] = b[0][trail] + (a[0][trail] if b[0][trail] == b[0][chars] else 0)
    f[FX["tokens"]] -= bool(a[0][trail] and b[0][lead])
    f[FX["indent"]] = a[0][FX["indent"]] + (b[0][FX["indent"]] if a[0][FX["indent"]] == a[0][chars] else 0)
    if not a[1] or not b[1]:  # one of them is blank
        return f, a[1] or b[1], a[2] or b[2]
    sep = "" if a[0][trail] and b[0][lead] else " "
    return f, (a[1] + sep + b[1])[:EDGE] if len(a[1]) < EDGE else a[1], (a[2] + sep + b[2])[-EDGE:] if len(b[2]) < EDGE else b[2]


def line_class(frag: tuple[list[int], str, str]) -> str:
    """blank, heading, list, table, junk, short (an unmarked item, perhaps) or prose."""
    f, head, tail = frag
    n, letters, words, last = f[1], f[2], f[4], tail[-1:]
    if not n:
        return "blank"
    if _HEADING.match(head) and f[FX["tokens"]] > 1:
        return "heading"
    if f[FX["rules"]] == n:
        return "table" if f[FX["dashes"]] and f[FX["pipes"]] >= 2 else "junk"
    if head.startswith(">>") and _RUNNING.search(tail):
        return "junk"
    if f[FX["tags"]]:
        return "table"
    if f[FX["odd"]] - f[FX["pipes"]] > 0.3 * n or letters + f[3] < 0.4 * n and f[FX["odd"]] > 0.15 * n and f[FX["pipes"]] < 0.5 * f[FX["odd"]]:
        return "junk"
    if words >= 10 and f[FX["ones"]] > 0.8 * (words + f[FX["odd"]]) and f[FX["common"]] < 0.2 * words and f[FX["pipes"]] < 0.15 * n:
        return "junk"
    if f[FX["longest"]] >= 32 and f[FX["longest"]] > 0.6 * n and not f[FX["cjk"]]:
        return "junk"
    cells = max(f[FX["pipes"]] + (0 if head.startswith("|") else 1), 1)
    per_cell = n / cells
    if f[FX["pipes"]] >= 2 and head.startswith("|") or f[FX["pipes"]] >= 1 and per_cell <= 30 and last not in _STOP:
        return "table"
    if head.startswith(("{|", "|-", "|}", "! ")) or f[FX["pipes"]] >= 2 and per_cell <= 40:
        return "table"
    if f[FX["tabs"]] and n / (f[FX["tabs"]] + 1) <= 30 and last not in _STOP:
        return "table"
    if f[FX["semis"]] >= 1 and n / (f[FX["semis"]] + 1) <= 18 and last not in _STOP and words <= 4 * (f[FX["semis"]] + 1):
        return "table"
    gaps = f[FX["gaps"]] - (f[FX["indent"]] >= 3)
    if gaps >= 1 and n / (gaps + 1) <= 20 and last not in _STOP and f[FX["common"]] <= 0.25 * words:
        return "table"
    if f[FX["commas"]] >= 2 and n / (f[FX["commas"]] + 1) <= 14 and last not in _STOP and not f[FX["loose"]]:
        return "table"
    if _BULLET.match(head) and f[FX["tokens"]] > 1:
        return "list"
    if n <= 48 and words <= 7 and last not in _STOP:
        return "short"
    return "prose"


_WEIGHT = {"list": "w_list", "table": "w_table", "junk": "w_junk", "short": "w_short", "prose": "w_prose"}
_NUMBER = {"list": "n_list", "table": "n_table", "short": "n_short"}


def _count_line(sums: list[int], frag: tuple[list[int], str, str]) -> None:
    kind = line_class(frag)
    if kind == "blank":
        return
    sums[IX["lines"]] += 1
    sums[IX["ended"]] += frag[2][-1:] in _END
    if kind in _WEIGHT:
        sums[IX[_WEIGHT[kind]]] += frag[0][1]
    if kind in _NUMBER:
        sums[IX[_NUMBER[kind]]] += 1


_ALNUM, _DIGITS, _SPACE, _MARK, _CONSONANT, _ODDS, _BULLETS, _RULED = (1 << i for i in range(8))
#: Characters above this are looked up one by one where a batch holds any.
_TABLED = 0x30000


def _class_of(c: str) -> int:
    out = _ALNUM * c.isalnum() | _DIGITS * bool(_DIGIT.match(c)) | _SPACE * c.isspace() | _MARK * (c in ".,;:!?。、")
    return out | _CONSONANT * (c.lower() in "bcdfghjklmnpqrstvwxz") | _ODDS * bool(_ODD.match(c)) | _BULLETS * (c in "-+•–—◦▪▫■●○◆◇►▸‣⁃·(") | _RULED * (c in _RULES)


_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class bits, lower case and mixed value of each character; built once a worker."""
    if not _TABLES:
        chars = list(map(chr, range(_TABLED)))
        cls = np.fromiter(map(_class_of, chars), dtype=np.uint8, count=_TABLED)
        low = np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars), dtype=np.uint32, count=_TABLED)
        _TABLES.extend([cls, low, _mixed(low)])
    return tuple(_TABLES)


def _mixed(low: np.ndarray) -> np.ndarray:
    x = low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)


_POWER = np.cumprod(np.full(256, 0x5851F42D4C957F2D, dtype=np.uint64), dtype=np.uint64)


def word_hash(word: str) -> int:
    low = np.array([ord(c) if len(c) == 1 else 0 for c in (x.lower() if len(x.lower()) == 1 else x for x in word)], dtype=np.uint32)
    return int((_mixed(low) * _POWER[np.minimum(np.arange(len(low)), 255)]).sum(dtype=np.uint64).astype(np.int64))


def _sums_by(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)


def chunk_states(chunks: list[tuple[str, str, str]], common: frozenset[str], whole: bool = False) -> list[dict]:
    """The states of many chunks at once; all counting is done by numpy over the code points of the batch.

    A chunk is (before, body, after); what surrounds the body counts for nothing itself. ``whole`` says that there is
    nothing around it, so that no line needs to be kept open.
    """
    out, part, size = [], [], 0
    hashes = np.sort(np.array([word_hash(w) for w in common] or [0], dtype=np.int64))
    for x in chunks:  # small enough for the processor's cache
        part.append(x)
        size += len(x[1])
        if size > SLICE:
            out += _states(part, common, hashes, whole)
            part, size = [], 0
    return out + _states(part, common, hashes, whole) if part else out


def _states(chunks: list[tuple[str, str, str]], common: frozenset[str], hashes: np.ndarray, whole: bool) -> list[dict]:
    count = len(chunks)
    cls_of, low_of, mixed_of = _tables()
    text = "\n".join(x[0] + x[1] + x[2] for x in chunks) + "\n"
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(x[0]) + len(x[1]) + len(x[2]) + 1 for x in chunks], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    safe = np.minimum(cp, _TABLED - 1)
    cls = cls_of[safe]
    if (high := np.flatnonzero(cp >= _TABLED)).size:
        cls[high] = [_class_of(chr(c)) for c in cp[high]]
    total = len(cp)
    own = np.ones(total, dtype=bool)
    own[first + size - 1] = False
    if not whole:
        for k, (x, y, z) in enumerate(chunks):
            own[first[k] : first[k] + len(x)] = False
            own[first[k] + len(x) + len(y) : first[k] + len(x) + len(y) + len(z)] = False
    bit = lambda m: (cls & m) != 0
    alnum, space, digit = bit(_ALNUM), bit(_SPACE), bit(_DIGITS)
    inked = own & ~space

    sums = np.zeros((count, len(SUMS)), dtype=np.int64)
    put = lambda k, v: sums.__setitem__((slice(None), IX[k]), v)
    n_alnum, n_digit = _sums_by(alnum & own, first), _sums_by(digit & own, first)
    put("chars", _sums_by(own, first))
    put("nonspace", _sums_by(inked, first))
    put("letters", n_alnum - n_digit)
    put("digits", n_digit)
    put("symbols", sums[:, IX["nonspace"]] - n_alnum)
    put("word_chars", n_alnum)
    put("sentence_marks", _sums_by(bit(_MARK) & own, first))

    # words; one belongs to the chunk in which it begins
    begins = alnum.copy()
    begins[1:] &= ~alnum[:-1]
    at = np.flatnonzero(begins)
    firsts, lasts = np.zeros(count, np.int64), np.zeros(count, np.int64)
    n_words = np.zeros(count, np.int64)
    is_common = np.zeros(total, dtype=bool)
    if len(at):
        which = np.cumsum(begins) - 1
        offset = np.arange(total) - at[np.maximum(which, 0)]
        value = np.where(alnum, mixed_of[safe] * _POWER[np.clip(offset, 0, 255)], np.uint64(0))
        code = np.add.reduceat(value, at).view(np.int64)
        length = np.add.reduceat(alnum.astype(np.int64), at)
        bare = np.add.reduceat(bit(_CONSONANT).astype(np.int64), at)
        mine = own[at]
        at, code, length, bare = at[mine], code[mine], length[mine], bare[mine]
        chunk = np.searchsorted(first, at, side="right") - 1
        n_words = np.bincount(chunk, minlength=count)
        hit = hashes[np.minimum(np.searchsorted(hashes, code), len(hashes) - 1)] == code if common else np.zeros(len(at), bool)
        is_common[at[hit]] = True
        put("words", n_words)
        put("common", np.bincount(chunk[hit], minlength=count))
        put("vowelless", np.bincount(chunk[(length >= 4) & (bare == length)], minlength=count))
        same = (code[1:] == code[:-1]) & (chunk[1:] == chunk[:-1])
        put("repeats", np.bincount(chunk[1:][same], minlength=count))
        firsts[chunk[::-1]], lasts[chunk] = code[::-1], code
        begins[:] = False
        begins[at] = True

    # lines of all chunks; the outer ones stay open unless the chunk is whole
    ends = np.flatnonzero(cp == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    if whole:
        take = np.ones(len(starts), dtype=bool)
    else:
        body_from = first + np.array([len(x[0]) for x in chunks])
        body_to = body_from + np.array([len(x[1]) for x in chunks])
        k = np.searchsorted(first, starts, side="right") - 1
        take = (starts > body_from[k]) & (ends < body_to[k])
    tokens = ~space
    t_begin = tokens.copy()
    t_begin[1:] &= ~tokens[:-1]
    t_at = np.flatnonzero(t_begin)
    t_len = np.zeros(total, dtype=np.int64)
    if len(t_at):
        t_len[t_at] = np.add.reduceat(tokens.astype(np.int64), t_at)
    gap = np.zeros(total, dtype=bool)
    gap[3:] = tokens[3:] & (cp[2:-1] == 32) & (cp[1:-2] == 32) & (cp[:-3] == 32)
    per = lambda v: np.add.reduceat(v.astype(np.int32), starts)
    is_pipe, is_semi, is_tab, is_comma, odd = cp == 124, cp == 59, cp == 9, cp == 44, bit(_ODDS)
    is_tab[1:] &= tokens[:-1] & ~np.isin(cp[:-1], [ord(c) for c in _STOP])
    is_tab[0] = False
    loose = np.zeros(total, dtype=bool)
    loose[:-1] = is_comma[:-1] & (cp[1:] == 32)
    f = {
        "chars": ends - starts, "nonspace": per(tokens), "letters": per(alnum & ~digit), "digits": per(digit), "words": per(begins), "common": per(is_common), "pipes": per(is_pipe), "semis": per(is_semi),
        "tabs": per(is_tab), "commas": per(is_comma), "gaps": per(gap), "tags": per(cp == 60), "odd": per(odd), "longest": np.maximum.reduceat(t_len, starts), "ones": per(t_begin & (t_len <= 2)),
        "tokens": per(t_begin), "loose": per(loose), "dashes": per(cp == 45), "rules": per(bit(_RULED)),
    }
    n_tokens = f["tokens"]
    where = np.arange(total)
    last_ink = np.maximum.reduceat(np.where(tokens, where, -1), starts)
    first_ink = np.minimum.reduceat(np.where(tokens, where, total - 1), starts)
    filled = take & (f["nonspace"] > 0)
    lead = t_len[first_ink]
    lead_end = cp[np.minimum(first_ink + np.maximum(lead, 1) - 1, total - 1)]
    plain = (
        filled & (n_tokens >= 8) & (f["longest"] < 32) & (f["nonspace"] > 2.4 * n_tokens) & (f["pipes"] + f["semis"] + f["tabs"] + f["gaps"] + f["odd"] == 0)
        & ((cls[first_ink] & _BULLETS) == 0) & ~((lead <= 7) & ((lead_end == 46) | (lead_end == 41))) & ((f["commas"] < 2) | (f["loose"] > 0))
    )
    chunk_of = np.searchsorted(first, starts, side="right") - 1
    stops = np.isin(cp[np.maximum(last_ink, 0)], [ord(c) for c in _END])
    sums[:, IX["lines"]] += np.bincount(chunk_of[plain], minlength=count)
    sums[:, IX["ended"]] += np.bincount(chunk_of[plain & stops], minlength=count)
    sums[:, IX["w_prose"]] += np.bincount(chunk_of[plain], weights=f["nonspace"][plain], minlength=count).astype(np.int64)
    out = sums.tolist()
    rest = np.flatnonzero(filled & ~plain)
    matrix = np.stack([f[k][rest] if k in f else np.zeros(len(rest), np.int64) for k in FRAG], axis=1).tolist() if len(rest) else []
    for r, row in zip(rest.tolist(), matrix, strict=True):
        a, z = int(starts[r]), int(ends[r])
        if row[FX["tags"]]:
            row[FX["tags"]] = len(_TAG.findall(text[a:z]))
        body = text[a:z]
        line = " ".join(body.split())
        row[FX["cjk"]], row[FX["indent"]] = len(_CJK.findall(body)), len(body) - len(body.lstrip(" "))
        _count_line(out[chunk_of[r]], (row, line[:EDGE], line[-EDGE:]))
    states = []
    for k, (x, y, z) in enumerate(chunks):
        head = tail = None
        if not whole:
            left, right = x.rsplit("\n", 1)[-1], z.split("\n", 1)[0]
            cut, end = y.find("\n"), y.rfind("\n")
            head = _fragment(y if cut < 0 else y[:cut], common, left, right if cut < 0 else "")
            tail = None if cut < 0 else _fragment(y[end + 1 :], common, "", right)
        states.append({"sums": out[k], "head": head, "tail": tail, "first": int(firsts[k]), "last": int(lasts[k])})
    return states


def chunk_state(before: str, body: str, after: str, common: frozenset[str], whole: bool = False) -> dict:
    return chunk_states([(before, body, after)], common, whole)[0]


def merge(a: dict, b: dict) -> dict:
    """Associative: the state of two texts, one after the other."""
    sums = [x + y for x, y in zip(a["sums"], b["sums"], strict=True)]
    sums[IX["repeats"]] += bool(a["last"]) and a["last"] == b["first"]
    out = {"sums": sums, "head": a["head"], "tail": b["tail"], "first": a["first"] or b["first"], "last": b["last"] or a["last"]}
    if a["tail"] is None:  # a is a single fragment
        out["head"] = _join(a["head"], b["head"])
    elif b["tail"] is None:
        out["tail"] = _join(a["tail"], b["head"])
    else:
        _count_line(sums, _join(a["tail"], b["head"]))
    return out


def finish(state: dict) -> dict:
    """Ratios and the shape of a whole text."""
    s = list(state["sums"])
    for frag in (state["head"], state["tail"]):
        if frag is not None:
            _count_line(s, frag)
    g = {k: s[i] for k, i in IX.items()}
    w, n = g["words"], g["nonspace"]
    out = {
        "n_chars": g["chars"], "n_words": w, "mean_word_length": g["word_chars"] / w if w else 0.0, "symbol_ratio": g["symbols"] / n if n else 0.0, "digit_ratio": g["digits"] / n if n else 0.0,
        "n_lines": g["lines"], "ended_share": g["ended"] / g["lines"] if g["lines"] else 0.0, "common_share": g["common"] / w if w else 0.0,
    }
    # unmarked short lines are items if there are several of them, one below the other, and little prose besides
    lists, table, junk, prose = g["w_list"], g["w_table"], g["w_junk"], g["w_prose"]
    if g["n_short"] >= 4 and g["n_short"] + g["n_list"] + g["n_table"] >= 0.5 * g["lines"]:
        lists += g["w_short"]
    else:
        prose += g["w_short"]
    shape = None
    total = lists + table + junk + prose
    if total:
        salad = w >= 20 and g["common"] <= 0.02 * w and g["sentence_marks"] <= 0.02 * w and g["n_list"] + g["n_short"] + g["n_table"] == 0
        gibberish = g["vowelless"] >= 6 and g["vowelless"] > 0.4 * w
        unreadable = n >= 20 and g["letters"] + g["digits"] < 0.3 * n and table < MAIN * total
        if salad or gibberish or unreadable or w >= 12 and g["repeats"] > 0.5 * w or junk >= MAIN * total:
            shape = "junk"
        elif table >= MAIN * total:
            shape = "table"
        elif lists >= MAIN * total:
            shape = "list"
        elif lists + table + junk >= MAIN * total:
            shape = max((table, "table"), (lists, "list"), (junk, "junk"))[1]
        elif g["n_list"] + (g["n_short"] if lists > g["w_list"] else 0) >= max(5, 0.75 * g["lines"]) and lists >= 0.25 * total:
            shape = "list"  # a sentence or two above a list of short items
        elif g["n_table"] >= max(4, 0.75 * g["lines"]) and table >= 0.25 * total:
            shape = "table"
    return out | {"shape": shape, "w_list": lists, "w_table": table, "w_junk": junk, "w_prose": prose}


STATS = "n_chars bigint, n_words bigint, mean_word_length double, symbol_ratio double, digit_ratio double, n_lines bigint, ended_share double, common_share double, shape string, w_list bigint, w_table bigint, w_junk bigint, w_prose bigint"
_STATS = [x.split()[0] for x in STATS.split(", ")]
_FRAG_T = pa.struct([("f", pa.list_(pa.int64())), ("head", pa.string()), ("tail", pa.string())])
_STATE_T = pa.struct([("sums", pa.list_(pa.int64())), ("head", _FRAG_T), ("tail", _FRAG_T), ("first", pa.int64()), ("last", pa.int64())])
_FRAG_S = "struct<f:array<bigint>,head:string,tail:string>"
_STATE_S = f"struct<sums:array<bigint>,head:{_FRAG_S},tail:{_FRAG_S},first:bigint,last:bigint>"


def _pack(s: dict) -> dict:
    frag = lambda x: None if x is None else {"f": x[0], "head": x[1], "tail": x[2]}
    return {**s, "head": frag(s["head"]), "tail": frag(s["tail"])}


def _unpack(s: dict) -> dict:
    frag = lambda x: None if x is None else (x["f"], x["head"], x["tail"])
    return {**s, "head": frag(s["head"]), "tail": frag(s["tail"])}


def _stats_arrays(rows: list[dict]) -> list[pa.Array]:
    kinds = [pa.int64() if "bigint" in x else pa.float64() if "double" in x else pa.string() for x in STATS.split(", ")]
    return [pa.array([r[k] for r in rows], type=t) for k, t in zip(_STATS, kinds, strict=True)]


def _whole(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [finish(s) for s in chunk_states([("", t, "") for t in b.column("text").to_pylist()], common, whole=True)]
        yield pa.RecordBatch.from_arrays([b.column("key"), *_stats_arrays(rows)], names=["key", *_STATS])


def _cut_up(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """(row, key, i, before, body, after): the chunks of each text, in one pass over it."""
    for b in batches:
        for row, key, text in zip(b.column("row").to_pylist(), b.column("key"), b.column("text").to_pylist(), strict=True):
            starts = range(0, max(len(text), 1), chunk)
            for k in range(0, len(starts), FAN):
                some = starts[k : k + FAN]
                cols = [[text[max(0, a - LEFT) : a] for a in some], [text[a : a + chunk] for a in some], [text[a + chunk : a + chunk + RIGHT] for a in some]]
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array([row] * n, pa.int64()), pa.array([key.as_py()] * n, key.type), pa.array(range(k, k + n), pa.int64()), *(pa.array(c, pa.string()) for c in cols)], names=["row", "key", "i", "before", "body", "after"])


def _partial(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("before", "body", "after")]
        states = [_pack(s) for s in chunk_states(list(zip(*cols, strict=True)), common)]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("key"), b.column("i"), pa.array(states, type=_STATE_T)], names=["row", "key", "i", "state"])


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One step of the tree: at most FAN neighbouring states of one row, which follow each other, become one."""
    open_: tuple | None = None
    state: dict = {}
    names = ["row", "key", "i", "state"]
    kind = None
    for b in batches:
        kind, done = b.column("key").type, []
        for row, key, i, x in zip(b.column("row").to_pylist(), b.column("key").to_pylist(), b.column("i").to_pylist(), b.column("state").to_pylist(), strict=True):
            x, block = _unpack(x), (row, key, i // FAN)
            if block == open_:
                state = merge(state, x)
            else:
                if open_ is not None:
                    done.append((*open_, _pack(state)))
                open_, state = block, x
        cols = list(zip(*done, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), kind, pa.int64(), _STATE_T), strict=True)], names=names)
    if open_ is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*open_, _pack(state)), (pa.int64(), kind, pa.int64(), _STATE_T), strict=True)], names=names)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [finish(_unpack(x)) for x in b.column("state").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("key"), *_stats_arrays(rows)], names=["key", *_STATS])


def common_set(words: DataFrame) -> frozenset[str]:
    """The fixed table of frequent words of all languages, lower case; refuses a table that is no such thing."""
    rows = words.select("word").where("word is not null").distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError("common_words is not a small fixed table")
    return frozenset(r[0].lower() for r in rows)


def text_statistics(df: DataFrame, key: str, text: str, common: Iterable[str], chunk: int = CHUNK) -> DataFrame:
    """(key, statistics, shape) for every row with a text; a null text gives no row, an empty one zeros and no shape.

    Repeated and null keys each have their own row, whatever the length of their texts.
    """
    common = frozenset(common)
    kind = df.select(key).dtypes[0][1]
    src = df.select(df[key].alias("key"), df[text].alias("text")).where("text is not null")
    out = f"key {kind}, {STATS}"
    whole = src.where(F.length("text") <= chunk).mapInArrow(lambda b: _whole(b, common), out)
    # a row's number depends on its place in its file alone
    long = src.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    pieces = long.mapInArrow(lambda b: _cut_up(b, chunk), f"row bigint, key {kind}, i bigint, before string, body string, after string")
    tree = f"row bigint, key {kind}, i bigint, state {_STATE_S}"
    states = pieces.repartition("row", "i").mapInArrow(lambda b: _partial(b, common), tree)
    levels, reach = 1, FAN
    while reach * chunk < 1 << 31:  # a string has at most 2**31 characters
        levels, reach = levels + 1, reach * FAN
    for _ in range(levels):
        block = F.expr(f"i div {FAN}")
        states = states.repartition("row", block).sortWithinPartitions("row", "i").mapInArrow(_merge_sorted, tree)
    merged = states.mapInArrow(_finish, out)
    return whole.unionByName(merged).withColumnRenamed("key", key)

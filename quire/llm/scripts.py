"""Text that looks alike but is stored with different characters, brought to one consistent form.

Each token's characters have a set of scripts in which they, or a look-alike of theirs, can be written. A token is
mixed if its own scripts do not agree; it is a whole-script confusable if it agrees, but every letter has a look-alike
in the script of the text around it. Intersecting the resolved sets over the token gives the scripts in which all of
it can be spelled; the one that fits the text around it is selected and the token is respelled in it. Of a mixed token that no script can spell whole, the letters that look like
ones of its main script are respelled. Everything else
that only looks like its plain spelling is normalised: full-width and other compatibility forms, ligatures, Roman
numeral signs, letters taken apart into base and accent, singletons such as the Kelvin sign, characters that show
nothing, blanks other than the ordinary one, and hyphens that look like the ASCII hyphen.

The JVM filters out what is pure printable ASCII, which is never a case and needs no Python.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut

# Letters of other scripts that look like these Latin ones, and Latin letters that look like others.
_CYRILLIC = dict(zip("авеёѕіїјкмнорстухһԁԛԝѵАВЕЁЅІЇЈКМНОРСТУХҺԀԚԜѴьӏгп", "aBeësiïjKMHopcTyxhdqwvABEËSIÏJKMHOPCTYXhdQWVbIrn", strict=True))
_CYRILLIC |= {"в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "ӏ": "l"}
_GREEK = dict(zip("αβγικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϲͿϳ", "aßyikvoptuxABEZHIKMNOPTYXCcJj", strict=True))
_ARMENIAN = dict(zip("օոսհյցզՕՏՍ", "onuhjgqOSU", strict=True))
_CHEROKEE = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏏᏒᏔᏙᏚᏞᏟᏢᏦᏧᏴᎺ", "DRTiYAJEWMHYGZbRWVSLCPKdBM", strict=True))
_COPTIC = dict(zip("ⲟⲞⲣⲢⲥⲤⲂⲎⲒⲔⲘⲚⲦⲬ", "oOpPcCBHIKMNTX", strict=True))
_LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFNLSRVHWXYAEIOU", strict=True))
_LATIN = dict(zip("ɑɡɩ", "agi", strict=True))
#: Look-alikes of letters in small capitals or in some type only; they count in tokens of mixed scripts alone.
_LOOSE = set("вкмнтьӏгпγβιτκѵҺԀ")
_OTHERS = {"Cyrl": _CYRILLIC, "Grek": _GREEK, "Armn": _ARMENIAN, "Cher": _CHEROKEE, "Copt": _COPTIC, "Lisu": _LISU}


def _alike(maps: dict[str, dict[str, str]]) -> dict[str, dict[str, str]]:
    """character -> script -> its look-alike there."""
    like: dict[str, dict[str, str]] = {}
    for name, pairs in maps.items():
        for a, b in pairs.items():
            like.setdefault(a, {})["Latn"] = b
            like.setdefault(b, {}).setdefault(name, a)
    for alike in list(like.values()):  # two letters that both look like one Latin letter
        if (b := alike.get("Latn")) is not None:
            for other, c in like[b].items():
                alike.setdefault(other, c)
    return like


LIKE = _alike({k: {a: b for a, b in m.items() if a not in _LOOSE} for k, m in _OTHERS.items()})
LOOSE = _alike(_OTHERS)

_INVISIBLE = regex.compile(r"[\p{Cf}\p{Default_Ignorable_Code_Point}\x00-\x08\x0e-\x1b\x7f]")
_EMOJI_JOIN = regex.compile(r"(?<=[\p{Extended_Pictographic}\p{Emoji_Modifier}️])[‍️]|[︎️](?=\P{L}|$)(?<=\p{Extended_Pictographic}[︎️])")
_JOINERS = regex.compile(r"(?<=[\p{Arabic}\p{Syriac}\p{Devanagari}\p{Bengali}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}])[‌‍]")
_BLANK = regex.compile(r"[\p{Zs}--[ ]]", flags=regex.V1)
#: Compatibility forms that look like their plain spelling; fractions, superscripts and signs do not.
_COMPAT = regex.compile(r"[！-～｡-ﾟ￠-￦ﬀ-ﬆﬓ-ﬗⅠ-ⅿ\U0001D400-\U0001D7FFǄ-ǌǱ-ǳĲĳŉſ]")
_HYPHEN = regex.compile(r"[‐‑﹣⁃−](?<![−])")
_LETTERS = regex.compile(r"[\p{L}\p{M}]+")


#: Scripts whose letters are compared; in those of other scripts, such as Han and Kana, Latin letters are at home.
_NAMES = {"LATIN": "Latn", "CYRILLIC": "Cyrl", "GREEK": "Grek", "ARMENIAN": "Armn", "CHEROKEE": "Cher", "COPTIC": "Copt", "LISU": "Lisu"}


@lru_cache(4096)
def script(c: str) -> str | None:
    """The script of a letter; any that is not compared is ``other``; what is no letter has none."""
    return _NAMES.get(unicodedata.name(c, "").split(" ")[0], "other") if c.isalpha() else None


def resolved(c: str, like: dict[str, dict[str, str]] = LIKE) -> set[str]:
    """Scripts in which the character, or a look-alike of it, can be written."""
    s = script(c)
    base = unicodedata.normalize("NFD", c)[0]
    return {s} | set(like.get(c, {}) or (like.get(base, {}) if base != c else {}))


def _letter(c: str, to: str, like: dict[str, dict[str, str]]) -> str | None:
    """The character in a script; itself where it has none."""
    s = script(c)
    if s is None or s == to:
        return c
    if (x := like.get(c, {}).get(to)) is not None:
        return x
    d = unicodedata.normalize("NFD", c)
    x = like.get(d[0], {}).get(to) if len(d) > 1 else None
    return None if x is None else unicodedata.normalize("NFC", x + d[1:])


def _spell(token: str, to: str, like: dict[str, dict[str, str]] = LIKE) -> str | None:
    out = [_letter(c, to, like) for c in token]
    return None if None in out else "".join(out)


def _certain(token: str, own: list[str], known: set[str]) -> str | None:
    """The script of a token that can be of no other of the scripts that come into question."""
    scripts = set(own)
    if len(scripts) == 1 and "other" not in scripts:
        s = own[0]
        others = set.intersection(*(resolved(c) for c in token if script(c)))
        return s if others & known == {s} else None
    return None


_STAND_INS = {c: chr(0xFDD0 + i) for i, c in enumerate("\u200d\u200c\ufe0e\ufe0f")}
_BACK = {ord(v): k for k, v in _STAND_INS.items()}


def _stand_in(m: regex.Match) -> str:
    return "".join(_STAND_INS.get(c, c) for c in m.group())


def consistent(text: str, host: str | None = None) -> tuple[str, bool, bool]:
    """(text in one form, whether a character differed from its plain spelling, whether only the host can tell).

    ``host`` is the script in which the source is mainly written; it decides where the text itself does not.
    """
    # joiners and selectors that emoji and some scripts need are kept, under stand-ins that are no characters
    plain = _JOINERS.sub(_stand_in, _EMOJI_JOIN.sub(_stand_in, text))
    case = bool(_INVISIBLE.search(plain) or _BLANK.search(plain) or _HYPHEN.search(plain))
    t = _INVISIBLE.sub("", plain)
    t = _BLANK.sub(" ", t)
    t = _HYPHEN.sub("-", t)
    c = _COMPAT.sub(lambda m: unicodedata.normalize("NFKC", m.group()), t)
    n = unicodedata.normalize("NFC", c)
    case |= n != t
    t = n
    if any(c in _LATIN for c in t):
        t, case = "".join(_LATIN.get(c, c) for c in t), True
    words = [(m.start(), m.group(), [s for s in map(script, m.group()) if s]) for m in _LETTERS.finditer(t)]
    known = {"Latn", "Cyrl", "Grek"}.union(*(own for _, _, own in words))
    votes: dict[str, int] = {}
    for _, w, own in words:
        if own and (s := _certain(w, own, known)):
            votes[s] = votes.get(s, 0) + len(w)
    if not votes:  # then what the mixed tokens can only be
        for _, w, own in words:
            if len(set(own)) > 1 and "other" not in own:
                can = {s for s in set.intersection(*(resolved(c) for c in w if script(c))) & known if _spell(w, s) is not None}
                if len(can) == 1:
                    s = can.pop()
                    votes[s] = votes.get(s, 0) + len(w)
    around = max(votes, key=votes.get) if votes else host
    unsure = False
    out, at = [], 0
    for start, w, own in words:
        scripts = set(own)
        x = None
        if "other" in scripts or not own:
            continue
        if len(scripts) > 1:  # mixed
            best = lambda can, own=own: max(sorted(can), key=lambda s: (s == around, own.count(s), s == "Latn"))
            for like in (LIKE, LOOSE):
                can = {s for s in set.intersection(*(resolved(c, like) for c in w if script(c))) if _spell(w, s, like) is not None}
                if like is LOOSE:
                    can &= {"Latn"}
                if can:
                    x = _spell(w, best(can), like)
                    break
            else:
                if scripts == {"Latn", "Grek"} and not any(_letter(c, "Latn", LIKE) for c in w if script(c) == "Grek"):
                    continue  # a symbol
                # no script has it all: the letters that have a look-alike in the script of most of it
                most = max(sorted(scripts), key=lambda s: (own.count(s), s == around, s == "Latn"))
                x = "".join(_letter(c, most, LIKE) or c for c in w)
        else:
            s = own[0]
            if s != "Latn" or around not in (None, "Latn"):
                can = set.intersection(*(resolved(c) for c in w if script(c))) - {s}
                single = len(w) == 1 and s == "Grek" and w not in "ΙΧΑΟο"
                if can and not single:
                    if around is None:
                        unsure = True
                    elif around != s and around in can:
                        x = _spell(w, around)
        if x is not None and x != w:
            out.append(t[at:start] + x)
            at = start + len(w)
            case = True
    return ("".join(out) + t[at:]).translate(_BACK), case, unsure and not case


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.schema.names
        hosts = b.column("host").to_pylist() if "host" in names else [None] * b.num_rows
        rows = [consistent(t, h) for t, h in zip(b.column("text").to_pylist(), hosts, strict=True)]
        keep = [b.column(c) for c in ("field", "record_id", "source")]
        yield pa.RecordBatch.from_arrays(
            [*keep, b.column("text"), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.bool_())],
            names=["field", "record_id", "source", "text", "form", "differs", "unsure"],
        )


#: Printable ASCII with its ordinary white space is its own consistent form.
NOT_PLAIN = r"[^\x09-\x0D\x20-\x7E]"
_SCHEMA = "field string, record_id bigint, source string, text string, form string, differs boolean, unsure boolean"


def host_scripts(fields: DataFrame) -> DataFrame:
    """(source, host): the script most letters of a source are written in."""
    count = lambda p: F.sum(F.regexp_count("text", F.lit(p)))
    c = fields.groupBy("source").agg(count(r"[A-Za-z]").alias("Latn"), count(r"\p{IsCyrillic}").alias("Cyrl"), count(r"\p{IsGreek}").alias("Grek"))
    return c.select("source", F.expr("case when Latn >= Cyrl and Latn >= Grek then 'Latn' when Cyrl >= Grek then 'Cyrl' else 'Grek' end").alias("host"))


def consistent_forms(fields: DataFrame) -> DataFrame:
    """(field, record_id, source, text, form, differs) of every text that is no pure ASCII.

    ``fields``: field, record_id, source, text. Null, empty and pure ASCII texts are left out: they are their own
    form. Where a text of look-alikes alone could be of two scripts, that of its source decides.
    """
    src = fields.select("field", F.col("record_id").cast("bigint").alias("record_id"), "source", "text")
    first = src.where(F.col("text").rlike(NOT_PLAIN)).mapInArrow(_normalise, _SCHEMA)
    known = first.where("not unsure")
    # few: texts that consist of look-alikes only
    open_ = first.where("unsure").select("field", "record_id", "source", "text").join(host_scripts(src), "source", "left")
    second = open_.mapInArrow(_normalise, _SCHEMA)
    return known.unionByName(second).drop("unsure")


def differing(fields: DataFrame) -> DataFrame:
    """The rows of ``consistent_forms`` whose form differs from their text; the texts are read once."""
    src = fields.select("field", F.col("record_id").cast("bigint").alias("record_id"), "source", "text")
    first = cut(src.where(F.col("text").rlike(NOT_PLAIN)).mapInArrow(_normalise, _SCHEMA).where("differs or unsure"))
    open_ = first.where("unsure").select("field", "record_id", "source", "text").join(host_scripts(src), "source", "left")
    return first.where("differs").unionByName(open_.mapInArrow(_normalise, _SCHEMA).where("differs")).drop("unsure", "differs")

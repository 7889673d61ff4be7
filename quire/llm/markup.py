"""Markup left in texts, converted to clean text that keeps headings, lists, tables, code and formulas.

Consensus host paths. Every record is parsed into containers, the stretches that HTML, Markdown, wiki or LaTeX
constructs delimit. A container has a generalised tag-class path (``html:table/tr/td``, ``md:strong``,
``latex:env.itemize``; numbers and ids are generalised away; an open construct has the path of the closed one) and is
scored by its content: whether it is closed, how far its signs are those of markup rather than plain writing, whether
it encloses text, and whether others of its notation stand beside it. In Spark each host, the book a record comes from,
votes on every path by the mean score of its containers there; the mean over all hosts counts as ``PRIOR`` further
containers, so that it decides where a host has little to say (for the null source too). Only the paths that win in
its host are extracted from a record, whatever the score of the single container: a clumsy or half-open construct is
taken out where its host is written that way, and left where it is not.

A text is parsed once: its reading with all its paths is kept beside its scores. Where all its paths win that is the
result; where only some do, the record is read again with the winners. The votes are sums that combine before the
shuffle; what joins back is one row a host, with the paths that lost there.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut

#: Score from which a container alone would be taken for markup; said in the votes, decides nothing.
STRONG = 0.7
#: A path wins in a host from this mean score on: that of an open construct for each closed one, and a third that is open.
WIN = 0.45
#: Weight of the mean over all hosts, in containers of the host.
PRIOR = 1.0
#: Weights of closure, form, enclosed text and company in a score.
CLOSURE, FORM, TEXT, COMPANY = 0.4, 0.3, 0.2, 0.1

_TAGS = "a|abbr|address|article|aside|b|big|blockquote|body|br|caption|center|cite|code|col|colgroup|dd|del|dfn|div|dl|dt|em|figcaption|figure|font|footer|h[1-6]|head|header|hr|html|i|img|ins|kbd|li|link|main|mark|math|meta|nav|nowiki|ol|p|pre|q|ref|references|s|samp|section|small|span|strike|strong|style|script|sub|sup|table|tbody|td|tfoot|th|thead|tr|tt|u|ul|var|gallery|poem|syntaxhighlight|source"
_TAG = regex.compile(rf"<(?P<close>/)?\s*(?P<name>{_TAGS})\b(?P<attrs>[^<>]*)(?P<end>/?>)?", regex.I)
_CLASS = regex.compile(r"class\s*=\s*[\"']?([\w-]+)", regex.I)
_COMMENT = regex.compile(r"<!--.*?(?:-->|$)|-->", regex.S)
_ENTITY = regex.compile(r"&(?:amp;)?(?:#\d{1,7}|#x[0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});")
#: Tags whose bare name behind a "<" may be a variable in a comparison.
_NAMES = ("a", "b", "i", "p", "q", "s", "u", "em", "th", "link", "main", "source", "section", "center", "table", "small", "header", "mark")


class Rule:
    """A construct: its path, how its end shows that it is closed, how far its signs are markup, what it becomes."""

    __slots__ = ("path", "closer", "form", "pattern", "to", "need")

    def __init__(self, path, closer, form, pattern, to, need):
        self.path, self.closer, self.form, self.pattern, self.to, self.need = path, closer, form, pattern, to, need


#: In the order in which they are taken out.
_RULES: list[Rule] = []


def _rule(path: str, closer: str | tuple[str, ...] | None, form: float, pattern: str, to: object, need: tuple[str, ...] = (), flags: int = 0) -> None:
    """``closer``: what a closed one ends with, "" for a sign that is whole by itself, None for one that never is."""
    _RULES.append(Rule(path, closer, form, regex.compile(pattern, flags), to, need))


def _cells(row: str) -> str:
    return " | ".join(c.strip() for c in row)


def _wiki_table(m: regex.Match) -> str:
    rows, row = [], []
    for line in m.group().split("\n"):
        s = line.strip()
        if s.startswith(("{|", "|}")):
            continue
        if s.startswith("|-"):
            if row:
                rows.append(row)
            row = []
        elif s.startswith("|+"):
            rows.append([s[2:].strip()])
        elif s.startswith(("!", "|")):
            row += [c.strip() for c in regex.split(r"!!|\|\|", s[1:])]
    if row:
        rows.append(row)
    return "\n" + "\n".join(_cells(r) for r in rows) + "\n"


def _tabular(m: regex.Match) -> str:
    rows = [r.replace("\\hline", "").strip() for r in regex.split(r"\\\\", m.group("body"))]
    return "\n" + "\n".join(_cells(r.split(" & ")) for r in rows if r) + "\n"


class _Kept(list):
    """Code and formulas, put aside under a mark so that no later rule reads them."""

    def __call__(self, content: str) -> str:
        self.append(content)
        return f"\x02{len(self) - 1}\x03"


_MARK = regex.compile("\x02(\\d+)\x03")
_ITEM = regex.compile(r"\\item\s*(?:\[[^\]]*\])?\s*")


def _inside(stop: str) -> str:
    """Any character of a paragraph but the delimiter ``stop``: a search for the end never passes the next delimiter."""
    c, rest = regex.escape(stop[0]), regex.escape(stop[1:])
    return rf"(?:[^{c}\n]|\n(?![ \t]*\n)" + (rf"|{c}(?!{rest}))" if rest else ")")


_B, _D = ("\\",), ("$",)
_MATH = _inside("$")
# LaTeX
_rule("latex:env.tabular", "}", 1, r"\\begin\{(?:tabular|tabularx|longtable|array)\*?\}(?:\{[^{}]*\})*(?P<body>.*?)(?:\\end\{(?:tabular|tabularx|longtable|array)\*?\}|$)", _tabular, _B, regex.S)
_rule("latex:env.list", "}", 1, r"\\begin\{(?:itemize|enumerate|description)\}(?P<body>.*?)(?:\\end\{(?:itemize|enumerate|description)\}|$)", lambda m: _ITEM.sub("\n- ", m.group("body")).rstrip() + "\n", _B, regex.S)
_rule("latex:env.verbatim", "}", 1, r"\\begin\{(?:verbatim|lstlisting|alltt)\}(.*?)(?:\\end\{(?:verbatim|lstlisting|alltt)\}|$)", "keep", _B, regex.S)
_rule("latex:env", "", 1, r"\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\[[^\]]*\])?", "", _B)
_rule("latex:displaymath", ("]", "$"), 1, r"\\\[(.+?)\\\]|\$\$(.+?)\$\$", "keep", (*_B, *_D), regex.S)
_rule("latex:math", ")", 1, r"\\\((.+?)\\\)", "keep", _B, regex.S)
_rule("latex:dollarmath", "$", 0.5, rf"(?<![\\$\w])\$(?=\S)(?={_MATH}*?[\\^_={{}}])(?![\d.,]+(?:\s|$))({_MATH}+?)(?<=\S)\$(?!\d)|(?<![\\$\w])\$(\d[^$\n|]*?\^\{{?\w+\}}?)\$(?!\d)", "keep", _D)
_rule("latex:section", "}", 1, r"\\(?:part|chapter|(?:sub){0,2}section|paragraph)\*?\{([^{}]*)\}?", r"\n\1\n", _B)
_rule("latex:footnote", "}", 1, r"\\footnote\{([^{}]*)\}?", r" (\1)", _B)
_rule("latex:cite", "}", 1, r"\\(?:cite[a-z]*|ref|label|pageref|autoref)\*?(?:\[[^\]]*\])?\{[^{}]*\}?", "", _B)
_rule("latex:font", "}", 1, r"\{\\(?:bf|it|em|tt|sc|rm|sf|sl|bfseries|itshape|ttfamily|scshape|small|large|Large|footnotesize)\b\s*([^{}]*)\}?", r"\1", _B)
_rule("latex:href", "}", 1, r"\\(?:href|url)\{[^{}]*\}(?:\{([^{}]*)\})?", lambda m: m.group(1) or "", _B)
_rule("latex:command", "}", 1, r"\\(?:text(?:bf|it|tt|sc|rm|sf|sl)|emph|underline|mbox|textsuperscript|textsubscript|caption|title|author|mathrm|mathbf|mathit|operatorname)\{([^{}]*)\}?", r"\1", _B)
_rule("latex:item", "", 1, r"\\item\b\s*", "\n- ", _B)
_rule("latex:sign", "", 1, r"\\(?:ldots|dots|textellipsis)\b(?:\{\})?", "…", _B)
_rule("latex:paragraph-sign", "", 1, r"\\S(?=\d|\s|~|\b)", "§", _B)
_rule("latex:escape", "", 0.7, r"(?<!\\)\\([%&#_$])(?!\\)", r"\1", _B)
_rule("latex:command", "", 0.7, r"\\(?:frac|sqrt|times|cdot|leq?|geq?|neq?|pm|infty|alpha|beta|gamma|delta|sum|int|prod|hline|noindent|newline|linebreak|quad|qquad|bigskip|medskip|smallskip|centering|par|LaTeX|TeX|textbackslash|bf|it|em|tt)\b(?![\w/\\])", " ", _B)
_rule("latex:tie", "", 0.5, r"(?<=[\p{L}.])~(?=[\d\p{L}\\])", " ", ("~",))
_rule("latex:quotes", "''", 0.8, r"``(?![`\s])((?:[^`'\n]|\n(?![ \t]*\n)|'(?!'))+?)''", r"“\1”", ("``",))
_rule("latex:break", "", 0.5, r"(?<=\S)\s*\\\\(?=\s|$|\\)", "\n", _B)
# wiki
_rule("wiki:table", "|}", 1, r"\{\|[^\n]*(?:\n[^\n]*)*?(?:\n\|\}|$)", _wiki_table, ("{|",))
_rule("wiki:table", None, 0.8, r"(?m)^\s*(?:\|\}|\|-)\s*$", "", ("|",))
_rule("wiki:category", "]]", 1, r"\[\[\s*(?:Category|Kategorie|Catégorie|Categoría|Категория|File|Image|Datei|Fichier|Archivo|Файл)\s*:[^\[\]]*(?:\]\]|$)", "", ("[[",), regex.I)
_rule("wiki:link", "]]", 1, r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)(?:\]\]|\](?!\])|$)", r"\1", ("[[",))
_rule("wiki:template", "}}", 1, r"\{\{(?:[^{}|]*\|)?([^{}|]*)(?:\|[^{}]*)?(?:\}\}|$)", r"\1", ("{{",))
_rule("wiki:extlink", "]", 1, r"\[(?:https?|ftp)://[^\s\]]+(?:\s+([^\]]*))?\]", lambda m: m.group(1) or "", ("://",))
_rule("wiki:magic", "", 1, r"__[A-Z]{3,}__", "", ("__",))
_rule("wiki:heading", "=", 1, r"(?m)^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", r"\n\2\n", ("==",))
_rule("wiki:bold", "'''", 1, rf"'''''(?!')({_inside("''")}+)'''''", r"\1", ("'''",))
_rule("wiki:bold", "'''", 1, rf"'''(?!')({_inside("'''")}+)'''(?!')", r"\1", ("'''",))
_rule("wiki:italic", "''", 1, rf"(?<!')''(?!')({_inside("''")}+)''(?!')", r"\1", ("''",))
_rule("wiki:bold", None, 0.8, r"(?<!')'{2,5}(?!')", "", ("''",))
_rule("wiki:link", None, 0.8, r"\]\]|\[\[", "", ("[[", "]]"))
_rule("wiki:template", None, 0.8, r"\}\}", "", ("}}",))
_rule("wiki:list", "", 0.5, r"(?m)(?:^[ \t]*[*#:;]{1,4}[ \t]+\S[^\n]*(?:\n|$)){2,}", lambda m: regex.sub(r"(?m)^[ \t]*[*#:;]{1,4}[ \t]+", "- ", m.group()), ("\n",))
# Markdown
_rule("md:fence", ("```", "~~~"), 1, r"(?m)^[ \t]*(```|~~~)[^\n`]*\n?(.*?)(?:\n[ \t]*\1[ \t]*$|\Z)", "keep", ("```", "~~~"), regex.S)
_rule("md:image", ")", 1, r"!\[([^\[\]]*)\]\([^()\n]*\)?", r"\1", ("![",))
_rule("md:link", ")", 1, r"(?<!!)\[([^\[\]\n]*)\]\([^()\n]*(?:\)|$)", r"\1", ("](",))
_rule("md:link", ")", 1, r"(?<!!)\[([^\[\]\n]*)\]\([^()\n]*(?:\)|$)", r"\1", ("](",))
_rule("md:reflink", "]", 1, r"\[([^\[\]\n]+)\]\[([^\[\]\n]*)\]", r"\1", ("][",))
_rule("md:linkdef", "", 1, r"(?m)^[ \t]*\[[^\[\]\n]+\]:[ \t]+\S+[^\n]*$|\[[^\[\]\n]+\]:[ \t]*[^\s.]*[./]\S+", "", ("]:",))
_rule("md:footnote", "", 1, r"\[\^[^\[\]\s]+\]:?", "", ("[^",))
_rule("md:task", "", 1, r"(?m)^([ \t]*[-*+])[ \t]+\[[ xX]\][ \t]+", r"\1 ", ("[",))
_rule("md:heading", "", 1, r"(?m)^[ \t]{0,3}#{1,6}[ \t]+([^\n]*?)[ \t]*#*[ \t]*$", r"\1", ("#",))
_rule("md:setext", "", 1, r"(?m)^([^\n|]*\p{L}[^\n|]*)\n[ \t]*(?:={3,}|-{3,})[ \t]*$", r"\1", ("\n",))
_rule("md:quote", "", 0.5, r"(?m)^[ \t]{0,3}>[ \t]+(?=\S)", "", (">",))
_rule("md:rule", "", 0.5, r"(?m)^[ \t]*(?:\*[ \t]*){3,}$|^[ \t]*(?:-[ \t]*){3,}$|^[ \t]*(?:_[ \t]*){3,}$", "", ("*", "-", "_"))
_rule("md:code", "`", 0.5, rf"(?<!`)``(?!`)({_inside("``")}+?)``(?!`)|(?<!`)`(?!`)({_inside("`")}+?)`(?!`)", "keep", ("`",))
_rule("md:strong", "*", 1, rf"(?<![*\w])\*\*\*(?=\S)({_inside("*")}+?)(?<=\S)\*\*\*(?!\*)", r"\1", ("***",))
_rule("md:strong", "*", 1, rf"(?<!\*)\*\*(?=\S)({_inside("*")}+?)(?<=\S)\*\*(?!\*)", r"\1", ("**",))
_rule("md:em", "*", 0.5, rf"(?<![*\w])\*(?=[^\s*])({_inside("*")}*?[^\s*])\*(?![*\w])", r"\1", ("*",))
_rule("md:strongunder", "__", 1, rf"(?<![_\w])__(?=[^\s_])({_inside("__")}*?[^\s_])__(?![_\w])", r"\1", ("__",))
_rule("md:emunder", "_", 0.5, rf"(?<![_\w])_(?=[^\s_])({_inside("_")}*?[^\s_])_(?![_\w])", r"\1", ("_",))
_rule("md:em", "*", 0.5, rf"(?<![*\w])\*(?=[^\s*])({_inside("*")}*?[^\s*])\*(?![*\w])", r"\1", ("*",))
_rule("md:strike", "~~", 1, rf"~~(?=\S)({_inside("~~")}+?)~~", r"\1", ("~~",))
_rule("md:strong", None, 0.8, r"(?<![*\w])\*{2,3}(?=\w)|(?<=[\w.,;:!?])\*{2,3}(?![*\w])", "", ("**",))
_rule("md:strongunder", None, 0.8, r"(?<![_\w])__(?=\p{L})|(?<=[\p{L}.,;:!?])__(?![_\w])", "", ("__",))
_rule("md:strike", None, 0.8, r"~~(?=\w)|(?<=\w)~~", "", ("~~",))
_rule("md:code", None, 0.8, r"`{2,3}", "", ("``",))
_rule("md:list", "", 0.5, r"(?m)(?:^[ \t]*[-*+][ \t]+\S[^\n]*(?:\n|$)){2,}", lambda m: regex.sub(r"(?m)^([ \t]*)[*+-][ \t]+", r"\1- ", m.group()), ("\n",))
_rule("md:ordered", "", 0.5, r"(?m)(?:^[ \t]*\d{1,3}[.)][ \t]+\S[^\n]*(?:\n|$)){2,}", lambda m: m.group(), ("\n",))
_rule("md:pipetable", "", 0.8, r"(?m)(?:^[^\n|]*\|[^\n]*\n)?^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$(?:\n[^\n|]*\|[^\n]*)*", lambda m: "\n".join(_cells([c for c in line.strip().strip("|").split("|")]) for line in m.group().split("\n") if not regex.fullmatch(r"[\s|:-]+", line)), ("--",))
# signs that are also plain writing
_rule("md:em", None, 0.2, r"(?<![\w*])\*(?=\p{L})|(?<=\p{L})\*(?![\w*])", "", ("*",))
_rule("md:emunder", None, 0.2, r"(?<![\w_])_(?=\p{L})|(?<=[\p{L}.,;:!?])_(?![\w_])", "", ("_",))
_rule("md:code", None, 0.2, r"(?<!`)`(?!`)", "", ("`",))
_rule("latex:command", None, 0.2, r"\\[a-zA-Z]{2,}\b", " ", _B)

#: What the pipe layout of a table is by itself.
_LAYOUT = {"md:pipetable", "md:setext", "md:rule", "md:list", "md:ordered", "wiki:list", "md:quote", "latex:break"}

_BLOCK = {"p", "div", "br", "hr", "li", "ul", "ol", "dl", "dd", "dt", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "section", "article", "header", "footer", "caption", "poem", "gallery"}




class Container:
    __slots__ = ("path", "closure", "form", "text", "score")

    def __init__(self, path: str, closure: float, form: float, text: float):
        self.path, self.closure, self.form, self.text, self.score = path, closure, form, text, 0.0


_LETTER = regex.compile(r"\p{L}")


def _enclosed(s: str) -> float:
    """How far a container encloses text: letters, anything else, nothing."""
    return 1.0 if _LETTER.search(s) else 0.5 if s.strip() else 0.0


def _html(text: str, found: list[Container], lost: frozenset[str]) -> str:
    """Tags out, with the path of open elements; blocks become lines, list items and cells keep their marks."""
    if "<" not in text and "-->" not in text:
        return text

    def comment(m: regex.Match) -> str:
        found.append(Container("html:comment", 1.0 if m.group().endswith("-->") else 0.5, 1.0, 1.0))
        return m.group() if "html:comment" in lost else ""

    text = _COMMENT.sub(comment, text)
    tags: list[tuple[regex.Match, Container]] = []
    stack: list[tuple[str, Container, int]] = []
    for m in _TAG.finditer(text):
        name = m.group("name").lower()
        general = "h" if regex.fullmatch(r"h[1-6]", name) else name
        ended, attrs = bool(m.group("end")), m.group("attrs") or ""
        bare = not ended and not attrs.strip() and not m.group("close") and m.end() < len(text) and name in _NAMES
        form = 0.0 if bare else 1.0  # "<a" without an end may be a comparison
        if m.group("close"):
            own = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0].split(".")[0] == general), None)
            if own is None:
                c = Container("html:" + general, 0.5, form, 0.0)
                found.append(c)
            else:
                _, c, start = stack[own]
                c.closure, c.text = 1.0, _enclosed(_TAG.sub("", text[start : m.start()]))
                del stack[own:]
            tags.append((m, c))
            continue
        cls = _CLASS.search(attrs)
        step = general + (f".{cls.group(1).lower()}" if cls else "")
        path = "html:" + "/".join([x for x, _, _ in stack[-3:]] + [step])
        alone = name in ("br", "hr", "img", "meta", "link", "col", "nowiki") or attrs.endswith("/")
        c = Container(path, 1.0 if alone and ended else 0.5, form, 1.0 if alone else 0.0 if bare else _enclosed(text[m.end() : m.end() + 32]))
        found.append(c)
        tags.append((m, c))
        if not alone:
            stack.append((step, c, m.end()))
    out, at = [], 0
    for m, c in tags:
        if c.path in lost:
            continue
        name, closed, attrs = m.group("name").lower(), bool(m.group("end")), m.group("attrs") or ""
        out.append(text[at : m.start()])
        end = m.end()
        if not closed:  # a half-open tag: what follows it on the way to the next sign is its attributes, if any
            end = m.start() + len(m.group().rstrip()) if not attrs.strip() else m.end() if "=" in attrs else m.start("attrs")
        if name == "li" and not m.group("close"):
            out.append("\n- ")
        elif name in ("td", "th") and not m.group("close"):
            out.append("" if "".join(out[-1:]).endswith("\n") or not out[-1:] else " | ")
        elif name in _BLOCK:
            out.append("\n")
        at = end
    return "".join(out) + text[at:]


def _closure(rule: Rule, m: regex.Match) -> float:
    if rule.closer is None:
        return 0.0
    return 1.0 if m.group().rstrip().endswith(rule.closer) else 0.5


def parse(text: str, table: bool = False, lost: frozenset[str] = frozenset()) -> tuple[str, list[Container]]:
    """(clean text, containers). ``table`` says that the pipe layout itself is no markup; ``lost`` are paths to leave."""
    found: list[Container] = []
    kept = _Kept()
    text = text.replace("\x02", " ").replace("\x03", " ")

    def entity(m: regex.Match) -> str:
        s = html.unescape(html.unescape(m.group()))
        if s == m.group():
            return s
        found.append(Container("html:entity", 1.0, 1.0, 1.0))
        return m.group() if "html:entity" in lost else " " if s == "\xa0" else s

    t = _ENTITY.sub(entity, text) if "&" in text else text
    t = _html(t, found, lost)
    for rule in _RULES:
        if table and (rule.path in _LAYOUT or rule.path == "wiki:table" and rule.closer is None) or not any(x in t for x in rule.need):
            continue
        hits: list[regex.Match] = []

        def swap(m: regex.Match) -> str:
            hits.append(m)  # noqa: B023
            to = rule.to  # noqa: B023
            if to == "keep":
                return kept(next(g for g in reversed(m.groups()) if g is not None).strip("\n"))
            return m.expand(to) if isinstance(to, str) else to(m)

        new = rule.pattern.sub(swap, t)
        for m in hits:
            inner = next((g for g in reversed(m.groups()) if g is not None), None) if rule.closer else None
            found.append(Container(rule.path, _closure(rule, m), rule.form, 1.0 if inner is None else _enclosed(inner)))
        if hits and rule.path not in lost:
            t = new
    if not found:
        return text, found
    of: dict[str, int] = {}
    for c in found:
        k = c.path.split(":")[0]
        of[k] = of.get(k, 0) + 1
    for c in found:
        c.score = CLOSURE * c.closure + FORM * c.form + TEXT * c.text + COMPANY * min(1.0, (of[c.path.split(":")[0]] - 1) / 2)
    if all(c.path in lost for c in found):
        return text, found
    t = regex.sub(r"[ \t]+\n", "\n", t)
    t = regex.sub(r"\n{3,}", "\n\n", t)
    t = regex.sub(r"(?<=\S)[ \t]{2,}(?=\S)", " ", t).strip()
    while _MARK.search(t):
        t = _MARK.sub(lambda m: kept[int(m.group(1))], t)
    return t, found


#: Cheap test in the JVM: a text without any of these holds no markup.
MAYBE = r"[<>&\\*_`#\[\]{}$|~=^]|''|``|\n\s*[-+>]|\n\s*\d{1,3}[.)]\s|^\s*[-+>]\s"
_PATHS_T = pa.list_(pa.struct([("path", pa.string()), ("n", pa.int64()), ("strong", pa.int64()), ("score", pa.float64())]))
_READ = "field string, record_id bigint, source string, text string, is_table boolean, clean string, paths array<struct<path:string,n:bigint,strong:bigint,score:double>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The reading of each text with all its paths, and the scores of its containers; texts without any are left out."""
    for b in batches:
        keep, clean, paths = [], [], []
        for k, (text, is_table) in enumerate(zip(b.column("text").to_pylist(), b.column("is_table").to_pylist(), strict=True)):
            t, found = parse(text, is_table)
            if not found:
                continue
            votes: dict[str, list] = {}
            for c in found:
                v = votes.setdefault(c.path, [0, 0, 0.0])
                v[0], v[1], v[2] = v[0] + 1, v[1] + (c.score >= STRONG), v[2] + c.score
            keep.append(k)
            clean.append(t)
            paths.append([{"path": p, "n": v[0], "strong": v[1], "score": v[2]} for p, v in sorted(votes.items())])
        rows = b.take(pa.array(keep, pa.int64()))
        cols = [rows.column(c) for c in ("field", "record_id", "source", "text", "is_table")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(clean, pa.string()), pa.array(paths, _PATHS_T)], names=["field", "record_id", "source", "text", "is_table", "clean", "paths"])


def readings(fields: DataFrame) -> DataFrame:
    """Every text with containers: its reading with all paths and its scores by path. Parsed once, kept for two uses."""
    src = fields.where(F.col("text").rlike(MAYBE)).select("field", F.col("record_id").cast("bigint").alias("record_id"), "source", "text", "is_table")
    return cut(src.mapInArrow(_read, _READ))


def path_votes(read: DataFrame) -> DataFrame:
    """(source, path, n, strong, score, overall, won): each host's vote on each path that its records hold.

    ``score`` and ``overall`` are the mean scores in the host and in all hosts, ``strong`` the containers that would
    have been taken for markup by themselves.
    """
    by = read.select("source", F.explode("paths").alias("p")).groupBy("source", "p.path").agg(F.sum("p.n").alias("n"), F.sum("p.strong").alias("strong"), F.sum("p.score").alias("sum"))
    every = by.groupBy("path").agg((F.sum("sum") / F.sum("n")).alias("overall"))
    v = by.join(every, "path").withColumn("score", F.col("sum") / F.col("n"))
    # the null source is no host; only the mean of all counts for it
    mean = F.when(F.col("source").isNull(), F.col("overall")).otherwise((F.col("sum") + PRIOR * F.col("overall")) / (F.col("n") + PRIOR))
    return v.select("source", "path", "n", "strong", "score", "overall", (mean >= WIN).alias("won"))


_OUT = "field string, record_id bigint, clean string, marked boolean, kinds array<string>"


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        clean, kinds = [], []
        for text, is_table, lost in zip(b.column("text").to_pylist(), b.column("is_table").to_pylist(), b.column("lost").to_pylist(), strict=True):
            t, found = parse(text, is_table, frozenset(lost))
            clean.append(t)
            kinds.append(sorted({c.path.split(":")[0] for c in found if c.path not in lost}))
        yield pa.RecordBatch.from_arrays([b.column("field"), b.column("record_id"), pa.array(clean, pa.string()), pa.array([bool(k) for k in kinds], pa.bool_()), pa.array(kinds, pa.list_(pa.string()))], names=["field", "record_id", "clean", "marked", "kinds"])


def clean_texts(fields: DataFrame) -> DataFrame:
    """(field, record_id, clean, marked, kinds) of every text that may hold markup.

    ``fields``: field, record_id, source, text, is_table. Null and empty texts and texts without any sign of markup
    are left out: they are clean. A record listed twice comes out twice; its copies vote too.
    """
    read = readings(fields)
    lost = path_votes(read).where("not won").groupBy("source").agg(F.collect_set("path").alias("lost"))
    names = F.transform("paths", lambda p: p["path"])
    r = read.join(lost.withColumnRenamed("source", "host"), F.col("source").eqNullSafe(F.col("host")), "left").drop("host")
    r = r.withColumn("left", F.array_except(names, F.coalesce("lost", F.array().cast("array<string>"))))
    kinds = F.array_sort(F.array_distinct(F.transform("left", lambda p: F.substring_index(p, ":", 1))))
    whole, none = F.size("left") == F.size("paths"), F.size("left") == 0
    plain = r.where(whole | none).select("field", "record_id", F.when(whole, F.col("clean")).otherwise(F.col("text")).alias("clean"), whole.alias("marked"), kinds.alias("kinds"))
    mixed = r.where(~whole & ~none).select("field", "record_id", "text", "is_table", "lost").mapInArrow(_again, _OUT)
    return plain.unionByName(mixed)

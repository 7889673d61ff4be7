"""The training-text operators against brute force, round trips and edge cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, encoding, leakage, markup, quality, queries, scripts, survivors
from tests.oracle import compare

D = "/root/testdata/sf0.001"
COMMON = frozenset({"the", "of", "and", "a", "to", "in"})


# --- p1: consistent characters
@pytest.mark.parametrize("given, want", [
    ("Ｂｌｅｓｓｅｄ Ａｒｃｈｉｖｅ", "Blessed Archive"), ("Tоwеr", "Tower"), ("Circle ΙΙΙ", "Circle III"), ("путешествия хранителeй", "путешествия хранителей"), ("E\u0301lan", "Élan"),
    ("Ha\u200bven", "Haven"), ("The\u00a0Vault", "The Vault"), ("Ofﬁce", "Office"), ("Token Ⅱ", "Token II"), ("Cold‐Scar", "Cold-Scar"), ("\u212ailn", "Kiln"), ("Рeмёcла\u2005y рeки", "Ремёсла у реки"), ("Мӧnchе", "Mönche"),
    ("Ꭺrchive", "Archive"), ("օmen", "omen"), ("ɑrchive", "archive"), ("кot", "kot"), ("вook", "book"), ("ӏron", "lron"), ("ꓣing", "Ring"), ("Ⲣact", "Pact"), ("дragоn", "дragon"),
])
def test_consistent(given, want):
    form, differs, _ = scripts.consistent(given)
    assert (form, differs) == (want, True)
    assert scripts.consistent(form) == (want, False, False)


@pytest.mark.parametrize("plain", ["Kaberin’s Summit", "½ Manor", "Mirror²", "Courier™ Play", "№ 4", "Ω Journal", "δ lever", "Духи у реки", "Tempest — Passages", "MANHÃ Wreck", "Straße", "", "a  b\t\nc", "北の射手", "Tシャツ", "Δt and µm", "дом", "🧙\u200d♂️"])
def test_plain_spellings_are_no_cases(plain):
    assert scripts.consistent(plain) == (plain, False, False)


def test_host_decides_where_the_text_cannot(spark):
    rows = [("t", 1, "en", "СОРЕ"), ("t", 2, "en", "Long English title"), ("t", 3, "ru", "СОРЕ"), ("t", 4, "ru", "Длинное русское название"), ("t", 5, "en", None), ("t", 6, "en", "")]
    df = spark.createDataFrame(rows, "field string, record_id bigint, source string, text string").withColumn("form", F.lit(1))
    assert {(r.record_id, r.form) for r in scripts.differing(df).collect()} == {(1, "COPE")}
    assert {r.record_id: r.form for r in scripts.consistent_forms(df).collect()} == {1: "COPE", 3: "СОРЕ", 4: "Длинное русское название"}


# --- p4: wrong encodings
@pytest.fixture(scope="module")
def words(spark):
    return encoding.corpus_words([spark.createDataFrame([("Wälder höfliche château naïve L’été забытых богов и seÃ ™ № ’ “",)], "text string").select("text")]).cache()


def test_restore_is_a_round_trip(spark, words):
    text = "Wälder château забытых L’été"
    rows = [("f", i, " ".join(g or w for w, g in ((w, encoding.garble(w, c)) for w in text.split()))) for i, c in enumerate(encoding.CHAINS[:40])]
    df = spark.createDataFrame(rows, "field string, record_id bigint, text string")
    back = {r.record_id: r.restored for r in encoding.restore(df, words).collect()}
    for _, i, s in rows:
        if encoding.REPLACEMENT not in s and "\u00ad" not in s and s != text:
            assert back[i] == text, (encoding.CHAINS[i], s, back.get(i))


def test_cases_and_no_cases(spark, words):
    rows = [("f", 1, "W��lder"), ("f", 2, "Ulna’s château"), ("f", 3, "Thorinâ€™s"), ("f", 4, None), ("f", 5, ""), ("f", 6, "MANHÃ"), ("f", 7, "забытых È богов"), ("f", 8, "plain"), ("f", 8, "plain"), ("f", 9, "Courierâ„¢")]
    df = spark.createDataFrame(rows, "field string, record_id bigint, text string").withColumn("token", F.lit("clash"))
    assert {r.record_id for r in encoding.garbled_fields(df, words).collect()} == {1, 3, 9}


def test_japanese_and_long_runs(spark):
    clean = encoding.corpus_words([spark.createDataFrame([("北の射手は市場の裏で、旅の商人は暁に忘れられた地図を受け取る。",), ("naïve aöäüßb",), ("č ž řeka",)], "text string")])
    text = "旅の商人は暁に忘れられた地図を受け取る"
    rows = [("f", k, encoding.garble(text, c)) for k, c in enumerate([("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp932"), ("utf-8", "mac_roman") * 2])]
    rows += [("f", 10, "xx" + encoding.garble("öäüß", ("utf-8", "cp1252"))), ("f", 11, encoding.garble("řeka", ("cp1250", "cp1252"))), ("f", 12, "��"), ("f", 13, text)]
    df = spark.createDataFrame(rows, "field string, record_id bigint, text string")
    back = {r.record_id: (r.restored, r.complete) for r in encoding.restore(df, clean).collect()}
    whole = {k for k, v in back.items() if v == (text, True)}
    assert whole >= {0, 1, 2, 3} and back[10] == ("xxöäüß", True) and back[11] == ("řeka", True) and back[12] == ("��", False) and 13 not in back


def test_the_filter_loses_nothing(spark, words):
    df = spark.createDataFrame([(encoding.garble("Wälder", ("utf-8", "cp1252")),), ("zzz",)], "token string")
    whole = {tuple(r) for r in encoding.garbled_table(words).join(df, "token").collect()}
    assert whole and whole == {tuple(r) for r in encoding.garbled_table(words, encoding.token_filter(df)).join(df, "token").collect()}


def test_empty_tables(spark, words):
    none = spark.createDataFrame([], "field string, record_id bigint, text string")
    assert encoding.garbled_fields(none, words).count() == 0
    some = spark.createDataFrame([("f", 1, "WÃ¤lder")], "field string, record_id bigint, text string")
    assert encoding.garbled_fields(some, encoding.corpus_words([none.select("text")])).count() == 0


# --- p5: markup
@pytest.mark.parametrize("given, want", [
    ("a <b>bold</b> word", "a bold word"), ("a '''bold''' word", "a bold word"), ("a **bold** and _slanted_ word", "a bold and slanted word"), ("see [[Page|the page]] {{term|x}}", "see the page x"),
    ("\\textbf{a} \\emph{b", "a b"), ("x $\\frac{1}{2}$ y", "x \\frac{1}{2} y"), ("## Head\n\ntext", "Head\n\ntext"), ("10\\% \\ldots", "10% …"), ("&lt;b&gt;x&lt;/b&gt; &amp;nbsp; y", "x y"),
    ("[x](y.md) [a][b] [^4]", "x a"), ("<ul><li>one</li><li>two</li></ul>", "- one\n\n- two"), ("<!-- no --> yes", "yes"), ("```\nroll(__x__)\n```", "roll(__x__)"), ("{| class=x\n! A !! B\n|-\n| 1 || 2\n|}", "A | B\n1 | 2"),
    ("\\begin{tabular}{ll}\nA & B \\\\ \\hline\n1 & 2 \\\\\n\\end{tabular}", "A | B\n1 | 2"), ("cut <i>open", "cut open"),
])
def test_markup(given, want):
    clean, found = markup.parse(given)
    assert clean == want and any(c.score >= markup.STRONG for c in found)


@pytest.mark.parametrize("plain", ["Multiply 3 * 4 * 2 for it.", "Costs $5 or $12 at market.", "Take the {red} and {blue}.", "misspelt [sic] there", "About ~30 paces", "if 5 < total", "Guard < 5 and Nerve > 2.", "A+B beats C/D", "Ash & Oak", "slot_a_lower", "#1 - or so", "", "15% of § 4"])
def test_plain_writing(plain):
    clean, found = markup.parse(plain)
    assert clean == plain and not any(c.score >= markup.WIN for c in found)


def test_pipe_layout_is_no_markup_of_a_table():
    t = "| A | B |\n| --- | :---: |\n| 1 | < 5 |"
    assert markup.parse(t, table=True) == (t, []) and markup.parse(t)[1]


def test_host_votes_decide_doubtful_constructs(spark):
    rows = [("f", 1, "strong", "an *open end", False), ("f", 2, "strong", "and *em* here", False), ("f", 3, "weak", "an *open end", False), ("f", 4, None, "an *open end", False), ("f", 5, "weak", None, False)]
    df = spark.createDataFrame(rows, "field string, record_id bigint, source string, text string, is_table boolean")
    assert {r.record_id: r.marked for r in markup.clean_texts(df).collect()} == {1: True, 2: True, 3: False, 4: False}


def test_all_hosts_decide_where_a_host_has_no_vote(spark):
    rows = [("f", k, "strong", "and *em* here, <i>more</i>", False) for k in range(9)]
    rows += [("f", 20, "weak", "an *open end", False), ("f", 21, None, "an *open end", False), ("f", 22, "strong", "cut <i<5 open", False), ("f", 23, "strong", "see <th<5 open", False)]
    df = spark.createDataFrame(rows, "field string, record_id bigint, source string, text string, is_table boolean")
    got = {r.record_id: (r.marked, r.clean) for r in markup.clean_texts(df).collect() if r.record_id > 9}
    assert got == {20: (True, "an open end"), 21: (True, "an open end"), 22: (True, "cut <5 open"), 23: (False, "see <th<5 open")}


def test_constructs_of_any_length():
    long = "word " * 200 + "end"
    for a, z in (("*", "*"), ("_", "_"), ("**", "**"), ("'''", "'''"), ("''", "''"), ("~~", "~~"), ("__", "__"), ("<i>", "</i>"), ("\\emph{", "}")):
        assert markup.parse(f"see {a}{long}{z} here")[0] == f"see {long} here", a
        assert markup.parse(f"see {a}{long}\nmore{z} here")[0] == f"see {long}\nmore here", a
    assert markup.parse(f"see `{long}` here")[0] == f"see {long} here"
    assert markup.parse(f"see ${long} = x^2$ here")[0] == f"see {long} = x^2 here"
    for sign in ("*a ", "__a ", "_a ", "'''a ", "`a ", "<b ", "[[a ", "$a_ ", "{{a ", "\\emph{a "):  # never closed: no search runs twice over the same text
        markup.parse(sign * 20000)


def test_votes_decide_and_html_wins(spark):
    v = {(r.source, r.path): r for r in queries.p5_votes(spark, D).collect()}
    assert any(k[1].startswith("html:") and r.won for k, r in v.items())
    rows = [("f", k, "b", "a <div>block</div> of it", False) for k in range(3)] + [("f", 9, "b", "cut <div", False)]
    df = spark.createDataFrame(rows, "field string, record_id bigint, source string, text string, is_table boolean")
    (r,) = markup.path_votes(markup.readings(df)).collect()
    assert (r.path, r.won, r.n, r.strong) == ("html:div", True, 4, 3)


# --- p6: survivors
def test_survivors_against_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        at = dt.datetime(2024, 1, rnd.randrange(1, 6)) if rnd.random() > 0.2 else None
        rows.append(("s", rnd.choice("abc"), i, at, rnd.choice([3, 2, 1, 0]), rnd.choice([None, " ", f"d{i}"]), rnd.choice([None, f"s{i}"])))
    df = spark.createDataFrame(rows, "source string, key string, id bigint, at timestamp, trust int, definition string, section string")
    df = df.withColumn("has_def", survivors.filled(F.col("definition"))).withColumn("has_sec", F.col("section").isNotNull())
    got = {(r.group_id, r.definition_from, r.section_from) for r in survivors.survivors(df).collect()}
    want = set()
    for k in "abc":
        g = [r for r in rows if r[1] == k]
        best = lambda have: max((r for r in g if have(r)), key=lambda r: (r[4], r[3] or dt.datetime(1, 1, 1), -r[2]))[2]  # noqa: B023, E731
        want.add((min(r[2] for r in g), best(lambda r: (r[5] or "").strip()), best(lambda r: r[6] is not None)))
    assert got == want


def test_surviving_entries(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, "s", "Omen", None, "a", "field", at), (2, "s", "omen:", "a sign", None, "inline", at), (3, "s", "OMEN", " ", None, "lexicon", None), (4, "s", "—", "d", None, None, at), (5, "s", ":", "e", None, None, at), (6, None, "Omen", "x", None, None, at), (7, "s", None, "x", None, None, at)]
    g = spark.createDataFrame(rows, "glossary_id bigint, source_id string, term string, definition string, section_id string, source_type string, extracted_at timestamp").withColumn("key", F.lit(0))
    words = encoding.corpus_words([g.select("term")])
    assert [tuple(r) for r in survivors.surviving_entries(g, words).collect()] == [(1, "s", "OMEN", "lexicon", "a sign", 2, "a", 1)]
    assert survivors.surviving_entries(g.limit(0), words).count() == 0


def test_term_key(spark):
    rows = [(" Solitary-Manor Office.",), ("SOLITARY-MANOR  office —",), ("Fluß",), ("FLUSS:",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(survivors.fold(F.col("t"))).collect()]
    assert got == ["solitary-manor office", "solitary-manor office", "fluss", "fluss", None]


# --- p7: token ids
def test_segment_tree_and_trees_together_against_naive_merging():
    v = bpe.Vocabulary(bpe.read_vocabulary())
    rnd = random.Random(1)

    def naive(b):
        parts = [b[i : i + 1] for i in range(len(b))]
        while True:
            best = min(((v.ranks.get(x + y, 1 << 60), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                return [v.ranks[p] for p in parts]
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    pieces = ["".join(rnd.choice("abeinrst éя漢") for _ in range(rnd.randrange(1, 90))) for _ in range(150)] + ["aaaa" * 200, "the", " the", "x"]
    together = v.encode_pieces(pieces)
    for p in pieces:
        assert together[p] == naive(p.encode()) == bpe.encode_piece(p.encode(), v.ranks), p


def test_corpus_against_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    v = bpe.parse_ranks(bpe.read_vocabulary())
    pat = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    enc = tiktoken.Encoding("own", pat_str=pat, mergeable_ranks=v, special_tokens={})
    odd = ["", None, "  a   b \n\n c\t\td  ", "it's we'll 12½ ——", "\u3000x\u00a0 y", "<|endoftext|>", "z" * 3000]
    df = spark.createDataFrame(list(enumerate(odd, -100)), "doc_id bigint, text string").unionByName(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text"))
    texts = dict(df.collect())
    for r in bpe.encode_corpus(df.withColumn("chunks", F.lit(0)), "doc_id", "text").collect():
        assert list(r.ids) == enc.encode_ordinary(texts[r.doc_id] or "")


# --- p8: leakage
def test_wu_manber_against_find(spark):
    import numpy as np

    rnd = random.Random(2)
    vocab = ["omen", "tower", "of", "the", "pale", "judges", "rampart", "silver", "while", "broken"]
    items = [(i, " " + " ".join(rnd.choice(vocab) for _ in range(40)) + " ") for i in range(20)]
    engine = leakage.WuManber([(i, t, [], [], [], []) for i, t in items])
    doc = " " + " ".join(rnd.choice(vocab) for _ in range(3000)) + items[3][1] + " end "
    data = np.frombuffer(doc.encode(), dtype=np.uint8)
    start, pattern = engine.find(data)
    got = {(int(s), x) for s, p in zip(start, pattern) for x in engine.places(int(p))}
    want = set()
    for i, t in items:
        at, k = t.find(" "), 0
        while at >= 0 and at + leakage.WINDOW <= len(t):
            s = doc.find(t[at : at + leakage.WINDOW])
            while s >= 0:
                want.add((s, (i, k)))
                s = doc.find(t[at : at + leakage.WINDOW], s + 1)
            at, k = t.find(" ", at + 1), k + 1
    assert got == want and got


def test_passages(spark):
    item = "Suppose that Clunzhul and the stubborn journal of Rhukphael each claim the relic; which of the ramparts must first feed the lasting rival before dawn breaks over Iethbrae?"
    upper, marked = item.upper(), item.replace("journal", "**journal**").replace("relic", "[relic](x.md)").replace("Rhukphael", "Rhuk-\nphael").replace("the ", "the\u00ad ")
    changed = item.replace("claim", "hold").replace("lasting ", "").replace("first", "first ferry")
    half = "Other prose. " + item[: len(item) // 2] + " more prose here. " + item[len(item) // 2 :]
    docs = [(1, item), (2, upper), (3, marked), (4, changed), (5, half), (6, "They say “the stubborn journal of” and nothing more."), (7, None), (8, ""), (9, item), (10, "Suppose that Otherone and the pale dagger of Someone each break the gate; which of the towers must first hold the broken mask?")]
    i = spark.createDataFrame([(1, item), (2, None), (3, "short one")], "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("print", F.lit(1))
    got = {(r.doc_id, r.item_id) for r in leakage.leaked_items(df, "doc_id", "text", i, "item_id", "text").collect()}
    assert got == {(n, 1) for n in (1, 2, 3, 4, 5, 9)}
    assert leakage.leaked_items(df.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0
    assert leakage.leaked_items(df, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_many_leaks_stay_and_a_stock_sentence_goes(spark):
    item = "Suppose that Clunzhul and the stubborn journal of Rhukphael each claim the relic before dawn breaks over Iethbrae while seven patient ferrymen count their silver"
    stock = "Unless stated otherwise bonuses from the same origin never stack together anywhere."
    rnd = random.Random(3)
    broken = lambda s, k: " ".join(w + "\n" * (rnd.random() < 0.3) for w in s.split()) + f" Closing line {k} here."
    whole = [(k, broken(item + ". " + stock, k)) for k in range(120)]
    passage = [(200 + k, broken(" ".join(item.split()[3:23]), k)) for k in range(120)]
    only = [(400 + k, f"Opening line {k} here. {stock}") for k in range(12)]
    other = [(500 + k, f"Entirely other prose number {k} about nothing.") for k in range(300)]
    i = spark.createDataFrame([(1, item + ". " + stock)], "item_id bigint, text string")
    found = lambda rows: {r.doc_id for r in leakage.leaked_items(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text", i, "item_id", "text").collect()}
    assert found(whole + passage + only + other) == {k for k, _ in whole + passage}
    # lines broken otherwise make no other document
    assert found([(k, broken(stock, "same")) for k in range(60)] + other) == set(range(60))


ITEM = "Suppose that Clunzhul and the stubborn journal of Rhukphael each claim the relic; which of the ramparts must first feed the lasting rival before dawn breaks over Iethbrae?"


@pytest.mark.parametrize("copies", [2, 4, 50])
def test_an_item_under_many_ids(spark, copies):
    i = spark.createDataFrame([(k, ITEM if k % 2 else ITEM.upper()) for k in range(copies)] + [(100, "Another text about quiet harbors and their silver bells at the end of winter nights")], "item_id bigint, text string")
    df = spark.createDataFrame([(1, ITEM), (2, "nothing of it")], "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(df, "doc_id", "text", i, "item_id", "text").collect()} == {(1, k) for k in range(copies)}


def test_blocks_of_items_change_nothing(spark):
    rnd = random.Random(11)
    frames = ["a player pays some silver crowns", "and then barely resist the cursed summits", "at the edge of the map", "inside the lower wards and still", "as soon as the alarm sounds", "unless the warden has already spoken"]
    items = [(k, " ".join(f"{x} name{rnd.randrange(50)} of{k}" for x in rnd.sample(frames, 4))) for k in range(60)]
    docs = [(k, f"Prose {k}. {' '.join(t.split()[rnd.randrange(8):])} end.") for k, t in items] + [(k, " ".join(rnd.sample(frames, 3))) for k in range(100, 130)]
    i, df = spark.createDataFrame(items, "item_id bigint, text string"), spark.createDataFrame(docs, "doc_id bigint, text string")
    run = lambda n: set(map(tuple, leakage.leaked_items(df, "doc_id", "text", i, "item_id", "text", block_bytes=n).collect()))
    whole = run(8 << 20)
    assert whole and whole == run(1 << 10) == run(1)


def test_near_copies_of_an_item(spark):
    """A third of all items are one text with a word changed; documents with any of them are found with all of them."""
    words = ITEM.split()
    copies = [(k, " ".join(words[: k % 20] + [f"changed{k}"] + words[k % 20 + 1 :])) for k in range(40)]
    rest = [(100 + k, f"Case {k} tells how the herald of town{k} lost name{k} and found bell{k} near gate{k} before harvest{k} came with rain{k}") for k in range(80)]
    i = spark.createDataFrame(copies + rest, "item_id bigint, text string")
    df = spark.createDataFrame([(1, copies[3][1]), (2, f"Prose. {ITEM} And more."), (3, "the stubborn journal of someone else")], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaked_items(df, "doc_id", "text", i, "item_id", "text").collect()}
    assert got == {(d, k) for d in (1, 2) for k, _ in copies}


def test_markup_longer_than_a_line_and_wide_strings(spark):
    text = ITEM.replace("relic", '<span class="' + "x " * 400 + '">relic</span>').replace("journal", "[journal](" + "a/" * 300 + "b.md)")
    i = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    df = spark.createDataFrame([(1, text), (2, "if 5 < 6 then nothing > all")], "doc_id bigint, text string")
    found = lambda: {tuple(r) for r in leakage.leaked_items(df, "doc_id", "text", i, "item_id", "text").collect()}
    narrow = found()
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        assert narrow == found() == {(1, 1, 28, 28)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")


def test_passage_of_phrases_that_many_items_use(spark):
    rnd = random.Random(5)
    frames = ["a player pays some silver crowns", "and then barely resist the cursed summits", "at the edge of the map", "inside the lower wards and still", "as soon as the alarm sounds"]
    items = [(k, f"Case {k} of " + " ".join(f"{x} name{k}" for x in rnd.sample(frames, 5))) for k in range(100)]
    own = "Yon fearless salt archive of Hrothmrocieth Dwyrghast a player pays some silver crowns thrice and then barely resist the cursed summits"
    items.append((500, own + " while seven sparrows sing over the harbor"))
    docs = [(1, f"Other prose. {own} more."), (2, "They went to stay at the edge of the map as soon as the alarm sounds inside the lower wards and still nothing.")]
    i = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(df, "doc_id", "text", i, "item_id", "text").collect()} == {(1, 500)}


# --- p9: statistics and shape
def test_chunks_merge_to_the_whole(spark):
    rnd = random.Random(4)
    texts = [r[0] for r in spark.read.parquet(f"{D}/documents.parquet").where("text is not null").select("text").collect()]
    for t in texts:
        whole = quality.finish(quality.chunk_state("", t, "", COMMON, whole=True))
        k = rnd.choice([1, 5, 16, 90])
        state = None
        for a in range(0, max(len(t), 1), k):
            s = quality.chunk_state(t[max(0, a - quality.LEFT) : a], t[a : a + k], t[a + k : a + k + quality.RIGHT], COMMON)
            state = s if state is None else quality.merge(state, s)
        assert quality.finish(state) == whole


def test_long_documents_take_the_tree(spark):
    docs = [(1, "The tower of the omen.\n" * 400), (2, "* item one\n" * 300), (3, "| a | b |\n" * 300), (4, "x"), (5, None), (6, ""), (1, "> quoted\n" * 90), (None, "Prose of a kind, and more.\n" * 50), (None, "y" * 120)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    stats = lambda chunk: sorted((tuple(r) for r in quality.text_statistics(df, "doc_id", "text", COMMON, chunk=chunk).collect()), key=str)
    assert stats(50) == stats(1 << 17) and len(stats(50)) == 8
    large = {r.doc_id: r.asDict() for r in quality.text_statistics(df.where("doc_id is not null and text not like '>%'"), "doc_id", "text", COMMON).collect()}
    assert {k: v["shape"] for k, v in large.items()} == {1: None, 2: "list", 3: "table", 4: None, 6: None}


@pytest.mark.parametrize("text, shape", [
    ("- a thing\n- another\n- third\n- fourth\n- fifth", "list"), ("Cloak\nfortress\nbrazen spire\nInk\nQuill", "list"), ("a;b;c\n1;2;3\n4;5;6\n7;8;9", "table"), ("\ue000\ue001 □■ \ue002\ue003¤\ufffd\ue004\ue005 \ue006\ue007□■", "junk"),
    ("omen " * 60, "junk"), ("3f9a" * 16 + "\n" + "b07c" * 16, "junk"), ("zvtk bqdxr nhwbf kvgrt plsgd mrtxq wvbnz qrtpl", "junk"), ("北の射手は市場の裏で川辺の橋を失う。旅の商人は暁に忘れられた地図を受け取る。", None), ("   \n ", None), ("Short prose of a kind.", None),
    (">> " + "CHAPTER OF MANY WORDS " * 9 + "<< 412", "junk"), (" " * 100 + "- a thing\n- other\n" + "- " + "very long item " * 20 + "\n- x\n- y", "list"), ("|---" * 60 + "|\n" + "| a | b |\n" * 3, "table"),
])
def test_shape(text, shape):
    assert quality.finish(quality.chunk_state("", text, "", COMMON, whole=True))["shape"] == shape


# --- registered queries
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(spark, name):
    if name in queries.SQL:
        assert compare(spark, name, queries.QUERIES[name], queries.SQL[name], D) == ""
    else:
        df = queries.QUERIES[name](spark, D)
        rows = df.collect()
        assert rows and (not name.endswith("_found") or len(rows) == len(set(rows)))

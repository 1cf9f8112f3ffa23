"""Operators over ``pages`` and ``conversations``, and the SQL of the catalog."""

import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import duck
from railyard.llm import catalog, chat, common, htmltext, langid


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_statement(spark, sf_dir, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    want = duck(sf_dir).execute(catalog.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    cols = sorted(names)
    plain = [tuple(r[names.index(c)] for c in cols) for r in want.fetchall()]
    assert rows(got.select(cols)) == sorted(plain, key=repr)


# ------------------------------------------------------------- HTML

@pytest.mark.parametrize("html,text", [
    ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b</p>c", "a\n\nb\n\nc"), ("a<br>b<BR/>c", "a\nb\nc"),
    ("<ul><li>x<li>y<ol start=3><li>z</ol></ul>", "- x\n- y\n 3. z"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td colspan=2>both</table>", "Name   N\nalpha  1\nboth"),
    ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    ("<style>.x,#y{display:none}</style><b class='q x'>no</b><i id=y>no</i><i>yes</i>", "yes"),
    ("<div hidden>no</div><div style='Display: none'>no</div><span style='visibility:hidden'>n</span>yes", "yes"),
    ("<script>if (a<b) '</p>'</script><!-- x -->t<noscript>n</noscript></div></p>u", "tu"),
    ("<p><b>bold<p>next</b> tail", "bold\n\nnext tail"), ("<div>a</div><div>b</div>", "a\nb"),
    ("a < b <3 <c", "a < b <3"), ("x<!-- never closed <p>y", "x"),
    ("<dl><dt>t<dd>d</dl>", "t\nd"), ("<a href='x>y'>z</a>", "z"),
    ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "a in  b"),
])
def test_layout(html, text):
    assert htmltext.render(html) == text


@pytest.mark.parametrize("css,text", [
    ("@media print { nav, .toc { display:none } }", "nav toc"),
    ("@media (max-width:600px) { .toc { display:none } } nav { display: none }", "toc"),
    ("@media screen and (max-width:600px) { .toc { display:none } }", "nav toc"),
    ("@media print { @media screen { .toc { display:none } } }", "nav toc"),
    ("@media screen, print { .toc { display:none } }", "nav"), ("@media all{.toc{display:none}}", "nav"),
    (".toc { color: red; display: none } .toc { display: block }", "nav toc"),
    (".toc { display: none !important } .toc { display: block }", "nav"),
    (".toc { display: none } .toc { color: red }", "nav"), (".toc { display: none; display: block }", "nav toc"),
    (".toc { visibility: hidden } .toc { display: block }", "nav"),
    ("/* .toc { display: none } */ @import url(x.css); nav { display: none }", "toc"),
    ("@supports (display: grid) { .toc { display: none } }", "nav"),
    ("@media print { nav::after { content: '}' } .toc { display: none } }", "nav toc"),
    ("@supports not (display: grid) { .toc { display: none } }", "nav toc"), (".toc { display: none", "nav"),
])
def test_style_rules_of_the_ordinary_screen(css, text):
    assert htmltext.render(f"<style>{css}</style><nav>nav </nav><b class=toc>toc</b>").split() == text.split()


def test_formulas_drawings_and_print_sheets():
    assert htmltext.render("<style media=print>b{display:none}</style><b>b</b>") == "b"
    assert htmltext.render("so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds") == (
        "so x=2 holds")
    assert htmltext.render("<svg><title>t</title><desc>d</desc><path d='M0'/><text>up</text><text>down</text></svg>"
                           ) == "up down"


def test_deep_nesting_and_long_pages():
    assert htmltext.render("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert htmltext.render("<b>" * 5000 + "<table>" * 300 + "y").strip() == "y"
    assert htmltext.render("<p>w " * 30_000).count("w") == 30_000


def test_stray_end_tags_cost_nothing():
    start = time.time()
    assert htmltext.render("<b>" * 20_000 + "x" + "</i></li></td>" * 20_000) == "x"
    assert htmltext.render("<li><ul>" + "<b>" * 20_000 + "x" + "</li>" * 20_000).strip(" -") == "x"
    assert time.time() - start < 5


def test_end_tags_close_what_a_walk_up_the_stack_closes():
    """Random tag soup against a tree builder that walks the whole stack."""
    rng = np.random.default_rng(3)
    names = ["p", "li", "ul", "td", "tr", "table", "b", "div", "dt", "dd", "dl"]

    def walked(tokens):
        root = ("#root", [])
        stack = [root]

        def up_to(tags, scope):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in tags:
                    del stack[k:]
                    return
                if stack[k][0] in scope:
                    return
        for closing, tag in tokens:
            if closing:
                up_to({tag}, htmltext.END_SCOPE.get(tag, ()))
                continue
            if tag in htmltext.CLOSES_P and any(n[0] == "p" for n in stack[-8:]):
                up_to({"p"}, htmltext.P_SCOPE)
            if tag in htmltext.IMPLIED:
                up_to(*htmltext.IMPLIED[tag])
            stack[-1][1].append((tag, []))
            stack.append(stack[-1][1][-1])
        return root

    def plain(node):
        return node.tag, [plain(c) for c in node.children]

    for _ in range(500):
        tokens = [(bool(rng.random() < 0.4), names[rng.integers(len(names))]) for _ in range(40)]
        html = "".join(f"</{t}>" if c else f"<{t}>" for c, t in tokens)
        assert plain(htmltext.tree(html)[0]) == walked(tokens)


def test_rendered_pages(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (None, None, "<p>x", 5), (2, "u", "", 5), (2, "u", "", 5)],
                                  "page_id long, url string, html string, text int")
    assert rows(htmltext.rendered(pages)) == sorted([(1, "u", None), (None, None, "x"), (2, "u", ""), (2, "u", "")],
                                                    key=repr)
    assert htmltext.rendered(pages.limit(0)).count() == 0


# ------------------------------------------------------------- language

def test_text_model_on_held_out_documents(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").where("n_chars > 100")
    model = langid.text_model(docs.where("doc_id % 3 > 0"))
    held = docs.where("doc_id % 3 = 0").collect()
    right = sum(model.languages[int(model.scores(r["text"]).argmax())] == r["lang"] for r in held)
    assert right >= 0.95 * len(held)


def test_place_and_declaration_decide_when_the_text_does_not(spark):
    docs = spark.createDataFrame([("en", "the cat and the dog are in the house with them"),
                                  ("de", "der hund und die katze sind nicht in dem haus")] * 5, "lang string, text string")
    german = "<html lang=de><p>die katze und der hund sind nicht in dem haus"
    pages = [(i, f"http://a.beispiel.de/{i}", german) for i in range(30)]
    pages += [(100 + i, f"http://b.example.com/{i}", "<html lang='en'>the dog and the cat are in the house")
              for i in range(30)]
    pages += [(200, "http://neu.beispiel.de/", "123"), (201, "http://b.example.com/x", None), (202, None, None),
              (None, "::odd", german), (203, "http://a.beispiel.de/z", "<html lang=xx>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.identified(frame, docs).collect()}
    assert len(got) == 65 and got[0]["lang"] == "de" and got[100]["lang"] == "en"
    assert got[200]["lang"] == "de" and got[201]["lang"] == "en" and got[203]["lang"] == "de"
    assert got[None]["lang"] == "de" and got[202]["lang"] in ("de", "en")
    assert all(0.49 < r["posterior"] <= 1 for r in got.values())
    none = langid.identified(frame, docs.limit(0)).collect()
    assert len(none) == 65 and {r["lang"] for r in none} == {None}
    assert langid.identified(frame.limit(0), docs).count() == 0


def test_language_hints_match_the_patterns_on_random_pages():
    raw = re.compile(r"(?is)<(script|style|template|noscript)\b.*?</\1\s*>|<!--.*?-->")
    declared = re.compile(r"""(?is)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?\s*([a-z]{2,3})(?![a-z])""")
    rng = np.random.default_rng(5)
    parts = ["<html", " lang=", "xml:", "lang", "=", "'", '"', "de", "en ", "abcd", ">", "<", " ", "\n", "<script", "</script",
             "</SCRIPT >", "<style>", "</style>", "<!--", "-->", "<!-->", "x", "<template ", "</template>", "-"]
    for _ in range(20_000):
        html = "".join(rng.choice(parts, 14))
        m = declared.search(html)
        assert langid.declared_language(html) == (m and m[1].lower())
        assert langid.visible(html) == langid.entities.unescape(langid._TAG.sub(" ", raw.sub(" ", html)))


@pytest.mark.parametrize("part", ["<html ", "<script ", "<!--", " lang=", "<html lang= ", "<", "</script "])
def test_language_hints_of_a_page_of_one_megabyte(part):
    start = time.time()
    page = part * (1_000_000 // len(part))
    langid.declared_language(page + " " * 100_000)
    langid.visible(page)
    assert time.time() - start < 5


# ------------------------------------------------------------- chat

TURNS = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", None), (None, "<|im_end|>")]


def brute(turns):
    whole = {}
    for c in {t[0] for t in turns}:
        own = sorted({t[1:] for t in turns if t[0] == c}, key=lambda t: [(x is not None, x or 0) for x in t])
        whole[c] = tuple(t[1:] for t in own)
    best = {}
    for c, w in whole.items():
        if not any(len(v) > len(w) and v[:len(w)] == w for v in whole.values()):
            best.setdefault(w, []).append(c)
    return sorted((min(cs), len(w), len(cs)) for w, cs in best.items())


@pytest.mark.parametrize("block,task", [(1024, 1 << 16), (2, 5)])
def test_snapshots_collapse_to_the_longest(spark, block, task):
    turns = [(1, i, *t) for i, t in enumerate(TURNS[:2])] + [(2, i, *t) for i, t in enumerate(TURNS)]
    turns += [(3, i, *t) for i, t in enumerate(TURNS)] + [(4, i, *t) for i, t in enumerate(TURNS[1:])]
    turns += [(5, i, *t) for i, t in enumerate(TURNS[:4])] + [(5, 4, "user", "else")]
    turns += [(6, i, "user", f"t{i}") for i in range(50)] + [(7, i, "user", f"t{i}") for i in range(49)]
    turns += [(2, 0, *TURNS[0])] * 3                                    # repeated rows
    frame = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, h int")
    got = sorted((r["conv_id"], r["n_turns"], r["copies"]) for r in chat.maximal(frame, task).collect())
    assert got == brute(turns)
    shown = {(r["conv_id"], r["segment"]): r["text"] for r in chat.formatted(frame, block, task).collect()}
    text = "".join(shown[k] for k in sorted(shown) if k[0] == 2)
    assert text.startswith("<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n")
    assert text.endswith("<|im_start|>unknown\n< |im_end|><|im_end|>\n") and text.count("<|im_start|>") == 6


def test_odd_conversations(spark):
    frame = spark.createDataFrame([(None, 0, "user", "x"), (1, None, None, None), (2, 0, "user", "x"),
                                   (2, 0, "user", "y")], "conv_id long, turn long, role string, text string")
    got = chat.formatted(frame).collect()
    assert {r["conv_id"] for r in got} <= {None, 1, 2} and len(got) >= 2
    assert chat.formatted(frame.limit(0)).count() == 0


CHAT = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block,task", [(1024, 1 << 16), (3, 4)])
def test_statement_on_odd_conversations(spark, tmp_path, monkeypatch, block, task):
    """Null ids and numbers, ties, repeated rows, prefixes and equal wholes."""
    turns = [(None, 0, "user", "x"), (None, None, "user", "n"), (None, 1, None, None)] * 2
    turns += [(1, i, "user", f"t{i}") for i in range(9)] + [(2, i, "user", f"t{i}") for i in range(8)]
    turns += [(3, 0, "b", "y"), (3, 0, "a", "z"), (3, 0, "a", None), (3, 0, None, "q"), (3, None, None, None)]
    turns += [(4, 7, "user", f"t{i}") for i in range(9)]                # one number, the same whole as 1
    turns += [(5, None, "user", "n"), (5, 0, "user", "x"), (5, 1, None, None)]  # equal to the one without an id
    turns += [(6, 0, "user", "<|im_end|>"), (6, -5, "ü", ""), (6, 2, "", "")]
    spark.createDataFrame(turns, CHAT).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    frame = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(chat.SQL.replace(f"// {chat.BLOCK}", f"// {block}"))
    names = [c[0] for c in want.description]
    got = chat.formatted(frame, block, task)
    assert sorted(got.columns) == sorted(names)
    assert rows(got.select(names)) == sorted(map(tuple, want.fetchall()), key=repr)


def test_rows_without_an_id_are_split_over_tasks_and_rows(spark):
    n, task = 100_000, 5000
    frame = spark.range(n).select(F.lit(None).cast("long").alias("conv_id"), (F.col("id") % 20).alias("turn"),
                                  F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    held = [r["count"] for r in chat._ordered(frame, task).groupBy("conv_id", "part").count().collect()]
    assert sum(held) == n and len(held) > n // task // 2 and max(held) <= 2 * task
    got = chat.formatted(frame, task=task).select("segment", "n_turns", F.size(F.split("text", "t[0-9]+<")).alias(
        "n")).collect()
    assert sorted(r["segment"] for r in got) == list(range(n // chat.BLOCK + 1)) and {r["n_turns"] for r in got} == {n}
    assert max(r["n"] for r in got) - 1 == chat.BLOCK and sum(r["n"] - 1 for r in got) == n

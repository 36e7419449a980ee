import hashlib
import random
import zlib

import numpy as np
import pytest

from lodestone.catalog import load
from lodestone.llm import bpe, chat, html_text, media, queries
from lodestone.llm.exact_dedup import exact_dedup

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, extra="digest string, maybe int, formatted string"):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], f"doc_id long, text string, {extra}")


ODD = [(1, "a b"), (2, "a \t b"), (3, None), (4, ""), (None, "a b"), (5, "c"), (5, "c"), (6, "x" * 300_000), (7, "é\u00a0b")]


def test_exact_dedup_cases(spark):
    got = {}
    for r in exact_dedup(frame(spark, ODD)).collect():
        got.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert got[1] == [(1, 3, True)] and got[2] == [(1, 3, False)] and got[None] == [(1, 3, False)]
    assert got[3] == [(3, 2, True)] and got[4] == [(3, 2, False)]
    assert sorted(got[5]) == [(5, 2, False), (5, 2, True)]
    assert got[6] == [(6, 1, True)] and got[7] == [(7, 1, True)]
    assert exact_dedup(frame(spark, [])).count() == 0


def test_exact_dedup_with_a_full_filter(spark, data):
    docs = load(spark, data, "documents")
    want = sorted(map(tuple, exact_dedup(docs).collect()))
    assert sorted(map(tuple, exact_dedup(docs, max_bits=64).collect())) == want


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.vocabulary())


def test_bpe_equals_the_library(spark, data, library):
    rng = random.Random(5)
    made = ["".join(rng.choice("aabcdeinorst'.,!é ß\t\n09Σ<|>\x1c\u0107\u0130") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    odd = ["<|endoftext|>hi<|startoftext|> a", "İΣ ΑΣ", "don't we'll 123 ...!!", "a\x1cb", "", "the " * 20000, "z" * 5000]
    own = bpe.WordBPE(queries.vocabulary())
    for text in made + odd:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == own.encode_bytes(text)[2].decode() == library.decode(ids, skip_special_tokens=False)
    texts = {r.doc_id: r.text or "" for r in load(spark, data, "documents").collect()}
    for r in queries.QUERIES["op5_bpe"](spark, data).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_merging_agrees_with_prefix_programming():
    own, rng = bpe.WordBPE(queries.vocabulary(), cache=50), random.Random(2)
    for _ in range(2000):
        word = "".join(rng.choice("aeionrstlch") for _ in range(rng.randint(1, 14)))
        raw = word.encode()
        symbols = [own.single[own.plain[b]] for b in raw[:-1]] + [own.single[own.final[raw[-1]]]]
        assert own.encode_word(word) == own.merged(symbols)


def test_bpe_encodes_the_new_stretches_of_a_batch_together(library, monkeypatch):
    rng = random.Random(6)
    made = [" ".join("".join(rng.choice("aeiourstlnß',.é1") for _ in range(rng.randint(1, 12))) for _ in range(30)) for _ in range(200)]
    made += ["<|endoftext|>a b<|endoftext|>", "", "long" * 400 + " it's", "a " * 9, *made[:20]]
    own, calls = bpe.WordBPE(queries.vocabulary(), cache=100), []
    together = own.encode_chunks
    monkeypatch.setattr(own, "encode_chunks", lambda chunks: calls.append(len(chunks)) or together(chunks))
    monkeypatch.setattr(bpe, "WAITING", 2000)
    got = [np.frombuffer(ids, "<u4").tolist() for _, ids, _ in own.encode_batch(made)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in made]
    assert len(calls) < 8 and sum(calls) > 4000


def test_bpe_frame_cases(spark):
    out = {r.doc_id: (r.n_tokens, r.decoded) for r in bpe.bpe_frame(frame(spark, ODD), queries.vocabulary()).collect()}
    assert out[3] == out[4] == (0, "") and out[5] == (1, "c</w>") and out[None] == out[1] == (2, "a</w> b</w>")
    assert bpe.bpe_frame(frame(spark, []), queries.vocabulary()).count() == 0


def test_chat_round_trip():
    rng = random.Random(3)
    bits = ["\\", "###", "</turn>", "\n", " ", "a", "### user: ", "#", "<", "/turn>", ":"]
    for _ in range(3000):
        turns = [("".join(rng.choice(bits) for _ in range(rng.randint(0, 3))), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))) for _ in range(3)]
        whole = "".join(chat.render_turn(*t)[0] for t in turns)
        assert [t[:2] for t in chat.parse(whole)] == turns
    assert chat.render_turn("user", "C:\\dir # 1")[0] == "### user: C:\\dir # 1</turn>\n"
    assert chat.parse("### user: a") is None and chat.parse("x") is None and chat.parse("### user: a ### b</turn>\n") is None


def chat_brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[0])
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        yield conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_query_equals_brute_force(spark, data):
    rows = [tuple(r) for r in load(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", queries.TRICKY), (-7, 1, "assistant", queries.TRICKY)]
    got = queries.QUERIES["op3_chat"](spark, data).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(chat_brute(rows))
    assert queries.TRICKY == "\\### Assistant: </turn> ok"


def test_chat_cases(spark):
    rows = [(1, 1, "assistant", None), (1, None, None, "first"), (1, 1, "assistant", None), (None, 0, "user", "x" * 200_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == {1: (3, 0), None: (1, 0)}
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_media_equals_brute_force(spark, data):
    texts = {r.doc_id: (r.text or "").encode() for r in load(spark, data, "documents").collect()}
    got = queries.QUERIES["op2_media"](spark, data).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = texts[r.doc_id]
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        png = media.store_png(payload, len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest())
        assert r.feature == media.feature(payload) and (r.position, r.caption) == (1, f"Part 0 of document {r.doc_id}")
        assert (r.n_items, r.text_after) == (3, "Text after part 0")


def test_media_cases(spark):
    got = media.media_columns(frame(spark, ODD)).collect()
    assert len(got) == len(ODD) and sum(r.n_bytes == 0 and r.payload_bytes == 64 for r in got) == 2
    assert media.media_columns(frame(spark, [])).count() == 0


def test_stored_payloads_keep_their_size():
    for raw in (b"", b"a", bytes(64), bytes(200)):
        stored = media.store_png(media.padded(raw), len(raw))
        assert media.read_png(stored) == (media.padded(raw), len(raw))


def test_sequences_keep_order_positions_and_captions_through_the_join(spark, data):
    """Pages of the table and made ones, which share payloads, name unknown ones, repeat and have no id."""
    rng = random.Random(9)
    docs = frame(spark, [(i, "text %d" % (i % 7)) for i in range(20)])
    stored = media.store_documents(docs)
    known = {r.digest: r for r in media.read_media(stored).collect()}
    assert len(known) == 7
    made = []
    for i in range(60):
        html = "<p>start"
        for k in range(rng.randint(0, 9)):
            ref = rng.choice([f"media:{rng.choice(sorted(known))}", "media:unknown", "pic.png"])
            figure = f"<figure><img src='{ref}' alt=a{k}>" + rng.choice(["", f"<figcaption>caption {k}</figcaption>"]) + "</figure>"
            html += rng.choice([figure, f"<img src='{ref}'>", f"<p>words {k}</p>"])
        made.append((rng.choice([None, i, 5]), rng.choice([html, html, None])))
    pages = [(r.page_id, r.html) for r in load(spark, data, "pages").collect()] + made
    df = spark.createDataFrame(pages, "page_id long, html string").repartition(5)
    plain = lambda page, items: (-1 if page is None else page, tuple((x["position"], x["kind"], x["text"] or "", x["ref"] or "", x["caption"] or "", x["payload"]) for x in items))
    got = [plain(r.doc_id, [{**x.asDict(), "payload": x.media.payload_sha256 if x.media else ""} for x in r.sequence]) for r in media.sequences(df, media.read_media(stored)).collect()]
    want = []
    for page, html in pages:
        items = media.parse_interleaved(html or "")
        want.append(plain(page, [{**x, "payload": known[d].payload_sha256 if (d := (x["ref"] or "")[6:]) in known and x["ref"].startswith("media:") else ""} for x in items]))
    assert sorted(got) == sorted(want) and sum(len(x[1]) for x in want) > 200
    assert media.sequences(df.limit(0), media.read_media(stored)).count() == 0


def test_interleaving_keeps_order_and_captions():
    items = media.parse_interleaved("<p>a<img src=x alt=A>b<figure><img src='y'><figcaption>cap  <b>t</b></figcaption></figure><script>n</script><style>s</style>c")
    assert [(i["kind"], i["text"] or i["ref"], i["caption"]) for i in items] == [
        ("text", "a", None), ("media", "x", "A"), ("text", "b", None), ("media", "y", "cap t"), ("text", "c", None)
    ]
    assert [i["position"] for i in items] == list(range(5)) and media.parse_interleaved("") == []


CASES = {
    "a<p>b<p>c": "a\n\nb\n\nc",
    "<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e": "- a\n- b\n  3. c\n  4. d\n\ne",
    "<table><tr><th>Name<th>N<tr><td>x<td>10</table>after": "Name  N\nx     10\n\nafter",
    "<table><tr><td>a<td rowspan=2>r<tr><td>bb</table>": "a   r\nbb",
    "<div hidden>no</div><p style='display: none'>no</p>yes<script>var t='</p>'</script>": "yes",
    "<style>.ad{display:none}</style><div class='x ad'>no</div>yes": "yes",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>": "yes",
    "<pre> a\n  b</pre>c&amp;d&nbsp;e <": " a\n  b\n\nc&d e <",
    "<details><summary>s</summary>no</details>": "s",
    "<b>x</i></b></table> y": "x y",
}


@pytest.mark.parametrize("html", CASES)
def test_visible_text(html):
    assert html_text.visible_text(html) == CASES[html]


def test_cells_of_columns_that_only_start_spans():
    shown = lambda rows: html_text.visible_text("<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>").split()
    assert shown(["<td colspan=2>Total</td>"]) == ["Total"]
    assert shown(["<td colspan=2>one two</td>", "<td colspan=2>three</td>"]) == ["one", "two", "three"]
    rng, spans = np.random.default_rng(3), [2, 3, 5]
    for _ in range(200):
        rows = [[(f"w{i}x{j}" * int(rng.integers(1, 4)), spans[rng.integers(3)]) for j in range(rng.integers(1, 4))] for i in range(3)]
        assert shown(["".join(f"<td colspan={n}>{w}</td>" for w, n in r) for r in rows]) == [w for r in rows for w, _ in r]


@pytest.mark.parametrize(
    "css, shown",
    [
        ("@media print{.nav{display:none}}", True),
        ("@media (max-width: 600px) { .nav { display: none } }", True),
        ("@media print{.x{color:red}.nav{display:none}} .x{color:blue}", True),
        ("@media print{@media screen{.nav{display:none}}}", True),
        ("@supports (display:grid){.nav{display:none}}", True),
        (".x{color:red; @media print{.nav{display:none}}}", True),
        ("/* @media screen { */ @media print{.nav{display:none}}", True),
        ("@media print{.x{content:'}'}.nav{display:none}}", True),
        ("@media print{.x{color:red}} .nav{display:none}", False),
        ("@media screen{.nav{display:none}}", False),
        ("@media print, only screen{.x{color:red}.nav{display:none;}}", False),
        ("@media not print{.nav{color:red;display:none}}", False),
        ("@import url(x.css); @layer base{.nav{display:none}}", False),
        ("/* { */ .x, .nav { color: red; display: none }", False),
    ],
)
def test_rules_that_do_not_hold_on_a_screen_hide_nothing(css, shown):
    assert html_text.visible_text(f"<style>{css}</style><p class=nav>menu</p><p>text") == ("menu\n\ntext" if shown else "text")


def test_style_sheets_for_print_hide_nothing():
    page = "<style media={}>.nav{{display:none}}</style><p class=nav>menu</p><p>text"
    assert [html_text.visible_text(page.format(m)) for m in ("print", "screen", "all", "'print, screen'", "''")] == ["menu\n\ntext"] + ["text"] * 4


def test_html_never_fails_and_keeps_all_words(spark, data):
    rng = random.Random(4)
    bits = ["<p>", "</p>", "<table>", "<td>", "<tr>", "</table>", "<li>", "<ul>", "</ul>", "<b", "\"", "'", ">", "<!--", "-->", "<pre>", "&lt;", "<td colspan=3 rowspan=2>"]
    for _ in range(2000):
        html_text.visible_text("".join(rng.choice(bits) + rng.choice(["", "w", " "]) for _ in range(15)))
    assert html_text.visible_text("<div>" * 20_000 + "x") == "x"


def plain_list(kind, items, indent):
    """The lines of a list, each item a text and perhaps a list within."""
    lines = []
    for i, (text, inner) in enumerate(items):
        mark = "- " if kind == "ul" else f"{i + 1}. "
        lines.append(indent + mark + text)
        if inner:
            lines += plain_list(*inner, indent + " " * len(mark))
    return lines


def test_layout_of_made_pages():
    """Paragraphs, nested lists and tables, with and without end tags, against lines laid out from what they were made of."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 8)))
    words = lambda: " ".join(word() for _ in range(rng.randint(1, 4)))
    spread = lambda t: t.replace(" ", rng.choice([" ", "\n  ", "\t"]))
    ends = lambda tag: rng.choice([f"</{tag}>", ""])

    def a_list(depth):
        kind = rng.choice(["ul", "ol"])
        return kind, [(words(), a_list(depth + 1) if depth < 3 and rng.random() < 0.4 else None) for _ in range(rng.randint(1, 4))]

    def list_html(kind, items):
        return f"<{kind}>" + "".join(f"<li>{spread(t)}" + (list_html(*inner) if inner else "") + ends("li") for t, inner in items) + f"</{kind}>"

    for _ in range(400):
        html, want = "", []
        for _ in range(rng.randint(1, 6)):
            which = rng.choice(["p", "list", "table"])
            if which == "p":
                text = words()
                html += f"<p>{spread(text)}" + ends("p")
                want.append(text)
            elif which == "list":
                made = a_list(0)
                html += list_html(*made)
                want.append("\n".join(plain_list(*made, "")))
            else:
                across = rng.randint(1, 4)
                rows = [[words() for _ in range(across)] for _ in range(rng.randint(1, 4))]
                widths = [max(len(r[c]) for r in rows) for c in range(across)]
                html += "<table>" + "".join("<tr>" + "".join(f"<td>{spread(t)}" + ends("td") for t in r) + ends("tr") for r in rows) + "</table>"
                want.append("\n".join("  ".join(t.ljust(w) for t, w in zip(r, widths)).rstrip() for r in rows))
        assert html_text.visible_text(html) == "\n\n".join(want), html


def test_time_and_output_grow_with_the_page():
    import time

    began = time.perf_counter()
    assert html_text.visible_text("<a " * 30_000).count("<a") == 30_000
    assert html_text.visible_text("<a '\"" * 20_000 + "x").endswith("x")
    assert html_text.visible_text("<p><table><td>" + "<div>" * 30_000 + "x") == "x"
    deep = html_text.visible_text("<ul><li>x" * 3000)
    wide = html_text.visible_text("<table><tr><td>" + "y" * 20_000 + "</td><td>z</td></tr>" + "<tr><td>a</td><td>b</td></tr>" * 1000 + "</table>")
    assert deep.count("x") == 3000 and len(deep) < 100 * 3000 and len(wide) < 20_000 + 210 * 1001 and wide.endswith("a" + " " * 201 + "b")
    assert time.perf_counter() - began < 10


def test_pages_of_the_table_equal_brute_force(spark, data):
    rows = load(spark, data, "pages").collect()
    got = {r.page_id: r.text for r in queries.QUERIES["op9_html_text"](spark, data).collect()}
    assert len(got) == len(rows)
    for r in rows:
        html = r.html or ""
        body = html[html.find("<body") :] if "<body" in html else html
        import re
        from html import unescape

        plain = unescape(re.sub(r"<[^>]+>", " ", re.sub(r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<noscript.*?</noscript>", " ", body)))
        if not re.search(r"hidden|display|noscript|<svg|<template", html):
            assert sorted(got[r.page_id].replace("- ", " ").split()) == sorted(plain.replace("\xa0", " ").replace("- ", " ").split())


def test_html_cases(spark):
    df = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (None, "<p>x", "q"), (None, "<p>x", "q")], "page_id long, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in html_text.extract_text(df).collect()) == [(0, "x"), (0, "x"), (1, ""), (2, "")]
    assert html_text.extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # What is out of the layout stays so, whatever its children say.
        ("<style>.x{display:none}</style><div class=x><span style='visibility:visible'>no</span></div>yes", "yes"),
        ("<dialog>a<span style='visibility:visible'>no</span></dialog>yes", "yes"),
        ("<dialog open>yes</dialog>", "yes"),
        # What is only invisible may have visible children.
        ("<div style='display:block;visibility:hidden'>no<span style='visibility:visible'>yes</span></div>", "yes"),
        ("<style>.x{visibility:hidden} .y{visibility:visible}</style><p class=x>no<b class=y>yes<i>too</i></b></p>", "yestoo"),
        ("<p style='visibility:hidden'><b style='visibility:inherit'>no</b><b style='visibility:initial'>yes</b></p>", "yes"),
        # The last of equals wins, the more specific before the later, the attribute before both, the important before all.
        ("<p style='display:none;display:inline'>yes</p>", "yes"),
        ("<p style='display:inline;DISPLAY : NONE'>no</p>", ""),
        ("<style>.x{display:none}.y{display:block}</style><p class='x y'>yes</p><p class=x>no</p>", "yes"),
        ("<style>p.x{display:none}.y{display:block}</style><p class='x y'>no</p>", ""),
        ("<style>#i{display:none}</style><p id=i style='display:block'>yes</p>", "yes"),
        ("<style>p{display:none!important}</style><p style='display:block'>no</p>", ""),
        ("<style>p{display:none!important} .y{display:block !important}</style><p class=y>yes</p>", "yes"),
        ("<p style='display:nonsense'>yes</p><p style='display:none;display:nonsense'>no</p>", "yes"),
        # Descendants, children, compounds, attributes.
        ("<style>div .y{display:none}</style><div><p><b class=y>no</b></p></div><b class=y>yes</b>", "yes"),
        ("<style>div > .y{display:none}</style><div><b class=y>no</b><i><b class=y>yes</b></i></div>", "yes"),
        ("<style>nav a.x[href=up] b{display:none}</style><nav><a class=x href=up><b>no</b></a><a class=x href=on><b>yes</b></a></nav><a class=x href=up><b>too</b></a>", "yestoo"),
        ("<style>.a .a .a{display:none}</style><i class=a>1<i class=a>2<i class=a>3<i class=a>4</i></i></i></i>", "12"),
        ("<style>* i{display:none}</style><b>yes<i>no</i></b>", "yes"),
        ("<style>a:hover, b ~ i, :not(p){display:none}</style><a>yes</a>", "yes"),
        # A sheet holds for the whole page, an attribute of the page's language gives way to it.
        ("<p class=x>no</p>yes<style>.x{display:none}</style>", "yes"),
        ("<noscript><style>p{display:none}</style></noscript><p>yes</p>", "yes"),
        ("<p hidden>no</p><p hidden style='display:block'>yes</p>", "yes"),
        ("<style>/* p{display:none} */ p{ /* display:none */ color:red }</style><p>yes</p>", "yes"),
    ],
)
def test_what_a_cascade_shows(html, text):
    assert html_text.visible_text(html).replace("\n", "") == text


def test_rules_of_deep_pages_are_asked_once_an_element():
    import time

    sheet = "<style>" + "".join(f".a{k} .b .c{k} i{{display:none}}" for k in range(200)) + "</style>"
    took = []
    for depth in (2_000, 8_000):
        page = sheet + "".join(f"<div class='a{k % 200} b c{(k + 1) % 200}'>" for k in range(depth)) + "<i>no</i>yes"
        began = time.process_time()
        assert html_text.visible_text(page).strip() == "yes"
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.5

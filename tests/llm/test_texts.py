"""Personal data, fingerprints, languages, pages and pieces against plain versions."""

from __future__ import annotations

import hashlib
import html
import re
import time

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from roadpulse.llm import dom, imatch, language, page_text, pieces, pii


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return frame.selectExpr("*", "'s' as kind", "1 as start", "2 as term", "3 as `range`", "'h' as host")


# --- personal data ----------------------------------------------------------------

BASE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


PRIVATE = [
    "mail a.b+c@mail.example.com, or x@y.co_z@w.org! a@b a@b. @c.de a@b@c.com",
    "at 10.0.0.1 or 1.2.3.4.5.6.7.8, not 256.1.1.1 or 1.2.3; 0000255.1.1.01 9999999999999.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 378282246310005 12345678901234567890",
    "+1 (988) 555-2485, +49.30.1234567 +1+1 +123456789012345678 +1(((((2 ++44 20 7946 0958 ",
    "é😀 a@b.de ü 😀+33 1 23 45 67 89 ß 😀10.1.2.3",
    "\x01 4111\x011111 \x02a@b.c",
    "write to jane (at) example (dot) org or jane[at]example.org; call (212) 555-0199 at 10[.]0[.]0[.]7",
    "1 " * 3000 + "a." * 3000 + "@x" + ".y" * 3000 + "0" * 5000 + "+" + "1" * 3000,
    "no personal data here, 2024 and 3.14",
    "",
    None,
]


def test_base_spans_equal_regular_expressions(spark):
    rows = [(i, t, None) for i, t in enumerate(PRIVATE)] + [(0, PRIVATE[0], None), (None, PRIVATE[1], "x")]
    got = pii.personal_data(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, text, _ in rows:
        spans = base_spans(text)
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        counts = [sum(s[3] == k for s in spans) for k in pii.KINDS]
        want.append((i, *counts, hashlib.sha256(written.encode()).hexdigest()))
    found = [(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    for r in got:
        text = next(t for i, t, _ in rows if i == r["doc_id"])
        base = {f"{k}:{a}:{b}" for a, _, b, k in base_spans(text)}
        assert base <= set(r["spans"].split(",")) | {""}
    assert pii.personal_data(documents(spark, [])).count() == 0


def test_labelers_are_weighed():
    """A labeler that agrees with the others counts, one that answers at random does not."""
    counts = {}
    for i in range(4000):
        true = i % 4 == 0
        votes = [1 if true else -1] * 4 + [1 if (i // 4) % 2 else -1]
        key = ("phone", *votes)
        counts[key] = counts.get(key, 0) + 1
    truth = pii.estimate(counts)
    assert all((p > 0.9) == (votes[1] == 1) for votes, p in truth.items())


def test_written_addresses_join_the_spans(spark):
    known = [(i, f"contact: u{i}@mail.example.com, phone +1 (212) 555-{1000 + i} now", None) for i in range(60)]
    loose = [(100 + i, f"contact: v{i} (at) mail (dot) com, phone (212) 555-{2000 + i} now", None) for i in range(30)]
    junk = [(200 + i, f"number 41111111111111{10 + i % 80} end", None) for i in range(60)]
    rows = known + loose + junk
    got = {r["doc_id"]: r for r in pii.personal_data(documents(spark, rows)).collect()}
    for i, text, _ in loose:
        assert got[i]["n_email"] == got[i]["n_phone"] == 0
        assert "email:9:" in got[i]["spans"], text
    for i, text, _ in junk:
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(text))


def test_redaction(spark):
    rows = [(1, "é a@b.de, +1 212 555 0199!", "x"), (2, "none", None), (3, None, None), (1, "10.0.0.1", "y")]
    frame = documents(spark, rows).withColumn("n_chars", F.length("text").cast("bigint"))
    out = pii.redacted(frame)
    assert out.columns == frame.columns
    got = sorted((r["doc_id"], r["text"], r["lang"], r["n_chars"]) for r in out.collect() if r["text"])
    assert got == [(1, "[IP]", "y", 4), (1, "é [EMAIL], [PHONE]!", "x", 19), (2, "none", None, 4)]
    assert out.count() == 4


# --- fingerprints -----------------------------------------------------------------


def brute_prints(texts):
    """The fingerprint of each text over the lexicon of the first half of them."""
    words = lambda t: sorted({w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t)}, key=lambda w: w.encode())
    half = texts[: len(texts) // 2]
    df, texts_with = {}, {}
    often = {t for t in half if half.count(t) > max(1, len(half) // imatch.OFTEN_OF)}
    for i, t in enumerate(half):
        for w in words(t):
            df[w] = df.get(w, 0) + 1
            texts_with.setdefault(w, set()).add(t if t in often else i)
    n_texts = len({t if t in often else i for i, t in enumerate(half)})
    least, most = max(2, -(-len(half) // imatch.LEAST_OF)), max(2, n_texts // imatch.MOST_OF)
    out = []
    for t in texts:
        kept = [w for w in words(t) if df.get(w, 0) >= least and len(texts_with[w]) <= most]
        md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
        lists = [kept]
        for i, rate in enumerate(imatch.RATES):
            part = {w: int(md5(w)[4 * i : 4 * i + 4], 16) % rate for w in kept}
            lists += [[w for w in kept if part[w] == s] for s in range(imatch.SETS)]
        prints = [md5(" ".join(x))[:16] if x else "" for x in lists]
        out.append("-".join([prints[0] or "x" + md5(t)[:15], *prints[1:]]))
    return out


def like(a, b):
    pairs = list(zip(a.split("-"), b.split("-"), strict=True))
    return sum(x == y != "" for x, y in pairs) / sum(x != "" or y != "" for x, y in pairs)


@pytest.mark.parametrize("most_terms", [2_000_000, 1])
def test_fingerprints_equal_brute_force(spark, monkeypatch, most_terms):
    monkeypatch.setattr(imatch, "MOST_TERMS", most_terms)  # a larger lexicon is joined, not broadcast
    rng = np.random.default_rng(5)
    texts = [" ".join(f"t{int(x)}" for x in rng.zipf(1.4, rng.integers(1, 200)) % 400) for _ in range(60)]
    texts += [texts[0], texts[3].upper(), "", None, "lone", "é " * 9] + ["seen " + texts[7] + " often"] * 40
    rows = [(3 * i - 7, t, None) for i, t in enumerate(texts)] + [(None, "t1 t2", None), (2, texts[5], None)]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    plain = [r[1] or "" for r in order]
    edited = []
    for i, t in enumerate(plain):
        cut = len(t) // 4
        edited.append(t[: len(t) - cut] + plain[(i + 1) % len(plain)][:cut])
    prints = brute_prints(plain + edited)
    n = len(order)
    want = [
        (order[i][0], len(plain[i]), hashlib.sha256(edited[i].encode()).hexdigest(), prints[i], prints[n + i],
         round(like(prints[i], prints[n + i]), 9), round(like(prints[i], prints[(i + 1) % n]), 9))
        for i in range(n)
    ]
    got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, imatch.edit_test(documents(spark, rows)).collect())]
    assert sorted(got, key=str) == sorted(want, key=str)
    alone = {(r["doc_id"], r["fingerprint"]) for r in imatch.fingerprints(documents(spark, rows)).collect()}
    assert alone == {(w[0], w[3]) for w in want}


def test_fingerprints_of_few(spark):
    assert imatch.edit_test(documents(spark, [])).count() == 0
    (only,) = imatch.edit_test(documents(spark, [(4, "abcdefgh", None)])).collect()
    assert only["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and only["near_next"] == 1.0


def test_a_third_of_equal_rows_keeps_its_terms(spark):
    """Copies do not make their own words too common."""
    copied = " ".join(f"c{i}" for i in range(60))
    rows = [(i, copied if i % 3 == 0 else " ".join(f"w{i}x{j}" for j in range(60)), None) for i in range(30)]
    got = {r["doc_id"]: r for r in imatch.edit_test(documents(spark, rows)).collect()}
    assert all(got[i]["near_edited"] > 0 and got[i]["fingerprint"][0] != "x" for i in range(0, 30, 3))
    assert len({got[i]["fingerprint"] for i in range(0, 30, 3)}) == 1


# --- languages --------------------------------------------------------------------


def brute_bits(training: bytes, text: bytes) -> float:
    """Code length of a text by contexts of up to three bytes, escaping without exclusion."""
    pad = language._PAD
    data, follow = pad + training, {}
    for i in range(len(pad), len(data)):
        for k in range(language.ORDER + 1):
            context = data[i - k : i]
            follow.setdefault(context, {}).setdefault(data[i], 0)
            follow[context][data[i]] += 1
    total, data = 0.0, pad + text
    for i in range(len(pad), len(data)):
        for k in range(language.ORDER, -1, -1):
            seen = follow.get(data[i - k : i])
            if seen is None:
                continue
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                total += np.log2((n + d) / seen[data[i]])
                break
            total += np.log2((n + d) / d)
        else:
            total += 8
    return total


def counted(text: bytes):
    data = language._PAD + text
    seqs = [int.from_bytes(data[i - 3 : i + 1], "big") for i in range(3, len(data))]
    keys, number = np.unique(np.array(seqs, np.int64), return_counts=True)
    return keys, number.astype(float)


def test_code_lengths_equal_brute_force(monkeypatch):
    monkeypatch.setattr(language, "_SLICE", 37)
    training = {"a": b"the cat and the hat " * 3, "b": "le chat et l'été ".encode() * 4, "c": b"xyzzy"}
    model = language.compile_trees({k: counted(v) for k, v in training.items()})
    texts = [b"the chat", "été".encode(), b"", b"qqqq\x00\xff", b"the hat and the cat " * 10, b"x"]
    got = model.code_lengths(texts)
    for row, text in zip(got, texts, strict=True):
        for bits, name in zip(row, model.languages, strict=True):
            assert bits == pytest.approx(brute_bits(training[name], text), rel=1e-5, abs=1e-3)


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held_out = language.fold(docs["doc_id"]) == language.HELD_OUT_FOLD
    found = language.identified(docs.filter(held_out).withColumn("score", F.lit(9)), docs.filter(~held_out))
    pairs = found.join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in pairs) >= 0.95 * len(pairs)
    assert all(0 <= r["score"] <= 1 for r in pairs)


def test_texts_without_language(spark):
    learn = documents(spark, [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "x", None)])
    rows = [(1, None, None), (2, "123 !?", None), (3, "", "en"), (4, "the dog", "fr"), (None, "le chien", None)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identified(documents(spark, rows), learn).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] == "en" and got[None][0] == "fr"
    nothing = language.identified(documents(spark, rows), learn.limit(0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == 5
    assert language.identified(documents(spark, []), learn).count() == 0
    kept = language.labelled(documents(spark, rows), learn)
    assert kept.columns == learn.columns
    assert sorted((r["doc_id"] or -1, r["lang"]) for r in kept.collect()) == [(-1, "fr"), (4, "en")]
    unlabelled = language.labelled(documents(spark, rows), learn.limit(0))
    assert sorted((r["doc_id"] or -1, r["lang"]) for r in unlabelled.collect()) == [(-1, None), (4, "fr")]


def test_every_labelled_language_is_learned(spark):
    """One with long documents only, and one whose many rows share an id."""
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(20)] + [(50, "le chat et le chien " * 2000, "fr")]
    rows += [(7, f"der hund und die katze {i}", "de") for i in range(200_000)]
    model = language.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert sorted(model.languages) == ["de", "en", "fr"]


# --- pages ------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var t="</p>";f({n})</script></head>
<body><header class="site"><h2>Site</h2></header><nav><ul><li><a href="/a">A{n}</a><li><a>B</a></ul></nav>
<div class="cookie-notice">We use {n}</div><div id="wrap"><{tag}><h1>Title&nbsp;&amp; {n}</h1><p>First
 <b>bold<br>text</b> <span class="ad">buy {n}</span> here {n}<p>Second &lt;{n}&gt;<!-- <p>no</p> -->
<ul><li>one {n}<li>two</ul><form><p>no</p></form><blockquote>said {n}</blockquote><table><tr><td>c1<td>c2</table></{tag}>
<aside>side {n}</aside><section id="comments"><article><p>reader {n}</p></article></section></div><footer>&copy; {n}</footer>"""
TEXT = "Title & {n}\nFirst bold text here {n}\nSecond <{n}>\none {n}\ntwo\nsaid {n}\nc1\nc2"


@pytest.mark.parametrize("tag", ["article", "main", "div class='content'"])
def test_articles_of_a_host(spark, tag):
    end = tag.split()[0]
    make = lambda n: PAGE.format(n=n, tag=tag).replace(f"</{tag}>", f"</{end}>")
    rows = [(i, f"https://Host.example/{i}?x", make(i * 37)) for i in range(12)]
    rows += [(100, None, make(5)), (101, "not a url", None), (102, "http://x.y", ""), (3, rows[3][1], rows[3][2])]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as path", "2 as text")
    got = sorted((r["page_id"], r["url"] or "", r["text"]) for r in page_text.main_text(frame).collect())
    text = lambda h: TEXT.format(n=re.search(r"Title&nbsp;&amp; (\d+)", h)[1]) if h else ""
    assert got == sorted((i, u or "", text(h)) for i, u, h in rows)


def test_constant_blocks_are_template(spark):
    pages = [
        f"<body><div><p>Same line</p></div><div><p>{'own words ' * 9}{i}</p><p>more {i}</p></div><div><p>End</p></div>"
        for i in range(9)
    ]
    frame = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in page_text.main_text(frame).collect()}
    assert all(html.unescape(got[i]).startswith("own words") or "own words" in got[i] for i in got)
    assert page_text.main_text(frame.limit(0)).count() == 0


def test_constant_boxes_are_left_out(spark):
    """Exact texts: what is the same on the pages of a host is not content, whatever it is called."""
    before = "<div><p>Same line</p></div>"
    pages = [f"<body>{before}<div><p>{'own words ' * 9}{i}</p><p>more {i}</p></div><div><p>End</p></div>" for i in range(9)]
    pages += pages[:1] * 20  # copies count once
    menu = "<ul><li>Home<li>News</ul><div class=x9>We use cookies</div>"
    kinds = [("News", 6), ("Sport", 4)]
    kinds = [k for k, n in kinds for _ in range(n)]
    plain = [
        f"<body>{menu}<div class='post {k}'><p>{k}</p><p>Text {i}</p><div>Read on</div><table><td>size<td>{i}</table></div>"
        "<div>Imprint</div>"
        for i, k in enumerate(kinds)
    ]
    rows = [(i, "http://h/", p) for i, p in enumerate(pages)] + [(100 + i, "http://i/", p) for i, p in enumerate(plain)]
    rows += [(200 + i, "http://few/", f"<body><div>Same line</div><div>{i}</div>") for i in range(3)]
    rows += [(300 + i, "http://same/", "<body><div>Same line</div><div>all</div>") for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    own = lambda i: f"{'own words ' * 9}{i}\nmore {i}"
    want = {i: own(i if i < 9 else 0) for i in range(29)}
    want |= {100 + i: f"{k}\nText {i}\nsize\n{i}" for i, k in enumerate(kinds)}
    want |= {200 + i: f"Same line\n{i}" for i in range(3)} | {300 + i: "Same line\nall" for i in range(9)}
    for parts in (1, 5):
        got = {r["page_id"]: r["text"] for r in page_text.main_text(frame.repartition(parts)).collect()}
        assert got == want


# Pages of a host each, {i} being the page, {w} varying prose; and the exact text.
NAMED = {
    "main with a layout class": (
        "<body><main class='with-sidebar'><h1>T {i}</h1><p>{w}</p></main><div class=rail><p>teaser {i}</p></div>",
        "T {i}\n{w}",
    ),
    "body with a layout class": (
        "<body class='has-sidebar'><div class=a><p>{w}</p></div><div class=b><p>{w}{w}</p></div>", "{w}\n{w}{w}"
    ),
    "box around the article": (
        "<body><nav>menu</nav><div id='sidebar-layout'><div><h1>T {i}</h1><p>{w}</p></div><div class=sidebar>side {i}</div></div>",
        "T {i}\n{w}",
    ),
    "sections about their name": (
        "<body><article><h1>T {i}</h1><p>{w}</p><div class='related-work'><h2>Related work {i}</h2><p>others {i}</p></div>"
        "<section id=discussion><h2>Discussion {i}</h2><p>what of it {i}</p></section>"
        "<div class=related><h3>More {i}</h3><p><a>linked {i}</a></p></div>"
        "<section id=comments><h3>Comments {i}</h3><p>reader {i}</p></section></article>",
        "T {i}\n{w}\nRelated work {i}\nothers {i}\nDiscussion {i}\nwhat of it {i}",
    ),
    "lead in a header": (
        "<body><header><p>site {i}</p></header><article><header><p>Lead {i}</p></header><p>{w}</p></article>",
        "Lead {i}\n{w}",
    ),
    "formulas and pictures": (
        "<body><article><p>{w} <math><mi>x</mi><mo>=</mo><mn>{i}</mn></math> holds</p><p>a{i}<svg/> b"
        "<svg><text>no</text></svg> c</p><video src=v><p>after {i}</p><object data=o>none</object><p>end {i}</p></article>",
        "{w} x={i} holds\na{i} b c\nafter {i}\nend {i}",
    ),
    "teasers and readers": (
        "<body><div><article><h1>T {i}</h1><p>{w}</p></article><article class='comment even'><p>reader {w}</p></article>"
        "<div class=sidebar><article><p>teaser {i}</p></article></div></div>",
        "T {i}\n{w}",
    ),
}


def test_content_overrules_names(spark):
    rows, want = [], {}
    for k, (name, (page, text)) in enumerate(NAMED.items()):
        for i in range(1, 10):
            prose = f"own words {i * 37} " * 12
            rows.append((100 * k + i, f"http://host{k}/{i}", page.format(i=i * 11, w=prose.strip())))
            want[100 * k + i] = text.format(i=i * 11, w=prose.strip())
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    for parts in (1, 5):
        got = {r["page_id"]: r["text"] for r in page_text.main_text(frame.repartition(parts)).collect()}
        for k, name in enumerate(NAMED):
            assert got[100 * k + 1] == want[100 * k + 1], name
        assert got == want


def test_elements_that_never_end_take_linear_time():
    page = "<p>a" + "<svg><video>b" * 50_000
    began = time.perf_counter()
    assert dom.extract(dom.parse(page), None) == "a" + "b" * 50_000
    assert time.perf_counter() - began < 10


def test_matching_keeps_order_and_labels():
    a = dom.slots(dom.parse("<body><nav>x</nav><div><h1>t</h1><p>a</p><p>b</p></div><footer>f</footer>"))
    b = dom.slots(dom.parse("<body><div class=ad>x</div><div><h1>u</h1><p>c</p></div><footer>g</footer>"))
    pairs = dom.align(a.children[0], b.children[0])
    matched = [(x.label, y.label) for x, y in pairs if x is not None and y is not None]
    assert matched == [("div", "div"), ("footer", "footer")]
    back = dom.load(dom.dump(a))
    assert dom.dump(back) == dom.dump(a)


@pytest.mark.parametrize("deep", [10, 70, 5000])
def test_deep_pages_are_whole(deep):
    """End tags of a deep nest end the nest only, and what is ruled out in it stays out."""
    inner = "<div>" * deep + "<p>deep</p><nav>menu</nav><div class=ad><div>buy</div></div>" + "</div>" * deep
    page = f"<body><div class=wrap><article><p>first</p>{inner}<p>second</p></article><p>rail</p></div><p>last</p>"
    assert dom.extract(dom.parse(page), ["body", "div:wrap", "article"]) == "first\ndeep\nsecond"
    template = dom.slots(dom.parse(page))
    dom.merge(template, dom.slots(dom.parse(page.replace("<nav>", "<p>odd</p><nav>"))))
    assert dom.dump(dom.load(dom.dump(template))) == dom.dump(template)
    assert dom.main_path(template) == ["body", "div:wrap", "article"]


@pytest.mark.parametrize("pages, parts", [(12, 1), (200, 1), (1000, 1), (1000, 3)])
def test_containers_named_by_the_page_are_kept(spark, pages, parts):
    """An article whose container is named anew by each page, beside a stable block of varying text."""
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    rows = [
        (i, "http://h/", f"<body><div class='post tag-{name(i)}'><p>{'own words ' * 9}{i}</p><p>more {i}</p></div>"
         f"<div class=rail><p>{'teaser ' * 5}{i * 7}</p></div>")
        for i in range(pages)
    ]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string").coalesce(1).repartition(parts)
    got = {r["page_id"]: r["text"] for r in page_text.main_text(frame).collect()}
    assert got == {i: f"{'own words ' * 9}{i}\nmore {i}" for i in range(pages)}


def test_broken_pages_do_not_fail():
    for page in ("<", "<p", "<a title=\"x>y", "<script>if(a<b)", "</p></div>", "<li>a<li>b", "<table><td>x", "a & b &#x; &nosuch;", "<!--", "<div>" * 500 + "x"):
        dom.extract(dom.parse(page), ["html", "body"])


# --- pieces -----------------------------------------------------------------------

SAMPLES = [
    "", " ", "  two  spaces ", "The quick brown fox.", "日本語 텍스트 😀\x00 naïve", "ᚠᚢᚦ\n\n\ttab", "a" * 300, "x1234 5678",
    "eningea anble thstnder", "<0x0A> <unk> </s>", " lead", "Ünïcödé wörds añd ẞ",
]


def model_bytes():
    with open(pieces.default_model(), "rb") as file:
        return file.read()


def test_merges_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rows = [(i, t, None) for i, t in enumerate([*SAMPLES, None, "▁under"])] + [(0, "again", "x"), (None, "no id", None)]
    got = pieces.round_trip(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_text = {t: i for i, t, _ in rows[: len(SAMPLES)]}
    for text, i in by_text.items():
        r = next(r for r in got if r["doc_id"] == i and r["n_chars"] == len(text))
        assert list(r["ids"]) == library.encode(text)
        assert r["exact"] and r["n_pieces"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(library.encode(text)).encode()).hexdigest()
    assert not next(r for r in got if r["doc_id"] == len(SAMPLES) + 1)["exact"]
    assert pieces.round_trip(documents(spark, [])).count() == 0


def best_sum(codec, text):
    """Every segmentation, by plain dynamic programming over all substrings."""
    best = [(0.0, ())]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(end):
            score = codec.scores.get(text[start:end])
            if score is None and end - start == 1:
                score = codec.unknown_score
            if score is not None:
                options.append((best[start][0] + score, end - start, best[start][1] + (text[start:end],)))
        top = max(options, key=lambda o: (o[0], o[1]))
        best.append((top[0], top[2]))
    return best[-1][1]


def test_sums_equal_brute_force():
    codec = pieces.Codec(model_bytes(), "unigram")
    for text in SAMPLES:
        escaped = pieces.SPACE + text.replace(" ", pieces.SPACE)
        want = []
        for part in best_sum(codec, escaped):
            known = [i for i, s in enumerate(codec.strings) if s == part]
            want += known or [codec.byte_ids[b] for b in part.encode()]
        assert codec.segment(escaped) == want
        if text:
            assert np.frombuffer(codec.encode(text), np.int32).tolist() == want
    with pytest.raises(ValueError, match="kind"):
        pieces.Codec(model_bytes(), "word")

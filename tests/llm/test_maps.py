"""Operators that work on one text or page at a time."""

import hashlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from llm_cases import HARD, SF, docs_of  # noqa: F401

from queuelake.llm import bpe, html_density, licences


def test_licences_match_brute_force(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    hard = [*HARD, "MIT License mit license", "Mit-License apache\nlicense GNU General Public License", "license mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"]
    for table, want in ((docs, texts), (docs_of(hard), dict(enumerate(hard)))):
        rows = licences.scan_licences(table).collect()
        assert len(rows) == len(want)
        for r in rows:
            n, places, labels = licences.brute_force_base(want[r.doc_id])
            assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(labels))
            assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
            assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert rows[-1].labels == "mit" and rows[-1].n_base == 0 and rows[-1].score > 0.9
    assert licences.scan_licences(docs.limit(0)).count() == 0


def test_template_needs_all_key_phrases_in_place():
    index = licences.Index(licences.NOTICES)
    bsd = next(i for i, t in enumerate(index.templates) if t.label == "bsd")
    whole = index.templates[bsd].text
    assert index.match(bsd, index.postings(f"x y {whole} z")[1])[0].tolist() == [2]
    assert not len(index.match(bsd, index.postings("redistribution and use in source and binary forms")[1])[0])
    far = whole.replace("with or without", "with or without " + "word " * 20)
    assert not len(index.match(bsd, index.postings(far)[1])[0])
    assert len(index.match(bsd, index.postings(whole.replace("with or", "with and or"))[1])[0])


@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_bpe_equals_the_tokenizers_library(spark, docs_of, word_bpe):
    path, theirs = word_bpe
    texts = [*HARD, "İstanbul ﬁ Å 日本語 👩‍👩‍👧", "abc" * 40, "é" * 97, "\x00\x01\x1f", "ǅ ẞ ŉ ΐ", "<|startoftext|> x<|endoftext|>"]
    texts += spark.read.parquet(f"{SF}/documents.parquet").toPandas()["text"].tolist()
    for r in bpe.bpe_documents(docs_of(texts), path).collect():
        ids = theirs.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.bpe_documents(docs_of(texts).limit(0), path).count() == 0


def test_scan_and_heap_agree(word_bpe):
    own = bpe.WordBpe(word_bpe[0])
    for word in ("internationalization" * 3, "abababab" * 8, "zzzzzzz"):
        assert own.encode_word(word) == own._encode_long(own._parts(word))
    ids, text = own.encode("hello there")
    assert own.decode([int(i) for i in ids.split()]) == text


PAGES = {
    "<html><body><nav><a href=x>menu</a></nav><article><h1>Title  here</h1><p>One &amp; two\n three<p>Four</article><footer>foot</footer>": "Title here\nOne & two three\nFour",
    "<body><div class='ad'>buy</div><article><p>Text <b>bold</b><br>line</p><div id=comments><p>first!</p></div><aside>x</aside></article>": "Text bold line",
    "<article><p>A<script>var t='</p>';</script> b</p><form><input>name</form><style>p{}</style><!-- c --></article>": "A b",
    "<article><p>cut &am": "cut &am",
    "<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>": "a\nb\nc\nd",
    "": "",
    "<p></p>": "",
    "<b>" * 3000 + "deep": "deep",
}


def test_main_text(spark):
    for page, want in PAGES.items():
        assert html_density.main_text(page) == want
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>t", "y")], "page_id long, url string, html string, text string")
    rows = sorted(html_density.extract_pages(pages).collect(), key=str)
    assert [(r.page_id, r.text, r.n_chars) for r in rows] == [(1, "", 0), (1, "", 0), (None, "t", 1)]
    assert html_density.extract_pages(pages.limit(0)).count() == 0


def test_article_beats_links_and_its_sparse_blocks_stay():
    links = "".join(f"<li><a href=/{i}>a link of the page {i}</a></li>" for i in range(40))
    words = "plain words of the article that go on " * 12
    page = f"<body><div><ul>{links}</ul></div><div><p>{words}</p><p>Ok.</p><p>{words}</p></div></body>"
    assert html_density.main_text(page) == f"{words.strip()}\nOk.\n{words.strip()}"


def test_headings_beside_the_densest_block_stay():
    words = "plain words of the article that go on " * 12
    page = f"<body><div id=content><h1>A title</h1><div class=body>{f'<p>{words}</p>' * 9}</div></div><div class=comments><p>{words}</p></div></body>"
    assert html_density.main_text(page) == "\n".join(["A title", *[words.strip()] * 9])


def test_all_of_the_article_stays():
    def ps(n, chars, tag="p"):
        return [(c * chars) for c in "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz"[:n]], "".join(f"<{tag}>{c * chars}</{tag}>" for c in "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz"[:n])

    (a, a_html), (b, b_html), (items, items_html) = ps(6, 400), ps(6, 200), ps(40, 60, "li")
    for wrap in ("<article>%s</article>", "<main>%s</main>", "<body><div>%s</div></body>", "%s"):
        # sections of unlike density, a list denser than the paragraphs, short ones
        assert html_density.main_text(wrap % f"<h1>Title</h1><section>{a_html}</section><section>{b_html}</section>").split("\n") == ["Title", *a, *b]
        assert html_density.main_text(wrap % f"<p>Short.</p><ul>{items_html}</ul><p>Two.</p><div><p>Deep.</p></div>").split("\n") == ["Short.", *items, "Two.", "Deep."]
        # bare text beside and within blocks
        assert html_density.main_text(wrap % f"Lead <i>text</i> here<div>{a_html}</div>tail<div>bare<div>{b_html}</div></div>").split("\n") == ["Lead text here", *a, "tail", "bare", *b]
    # articles of a page beside each other, and what is not one
    links = "".join(f"<li><a href=/{i}>a link of the page {i}</a></li>" for i in range(9))
    page = f"<body><ul>{links}</ul><div><article>{a_html}</article></div><div><article>{b_html}</article><article><p>Last.</p></article></div><div>Login <p>off</div></body>"
    assert html_density.main_text(page).split("\n") == [*a, *b, "Last."]
    assert html_density.main_text(f"<article><p>Text</p><div>{a_html}</div><ul>{links}</ul><p><a href=x>One link</a></p></article>").split("\n") == ["Text", *a, "One link"]


def mixed_pages():
    """Pages of divisions without a telling name: the article, as one run or as
    sections, beside teasers, a side column and a footer; with what must stay."""
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join("".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 9))) for _ in range(n))

    for i in range(60):
        paragraphs = [prose(int(rng.integers(30, 110))) for _ in range(int(rng.integers(6, 14)))]
        html_of = "".join(f"<p>{x}</p>" for x in paragraphs)
        if i % 3 == 1:
            cut = len(paragraphs) // 2
            html_of = "".join(f"<section>{''.join(f'<p>{x}</p>' for x in part)}</section>" for part in (paragraphs[:cut], paragraphs[cut:]))
        if i % 3 == 2:
            html_of = f"<p>Short.</p>{html_of}<p>Last words.</p>"
            paragraphs = ["Short.", *paragraphs, "Last words."]
        teasers = "".join(f"<div><a href=/{j}>{prose(3)}</a><div><span>{prose(4)}</span><div>{prose(2)}</div></div></div>" for j in range(6))
        side = "".join(f"<div><div>{prose(2)}</div><div>{prose(1)}</div></div>" for _ in range(5))
        foot = f"<div><div>{prose(2)}</div><div><a href=/i>{prose(1)}</a></div></div>"
        around = (f"<div>{html_of}</div><div>{teasers}</div>", f"<div><div>{side}</div><div>{html_of}</div></div>", f"<div>{html_of}</div>")[i // 3 % 3]
        yield f"<html><body>{around}{foot}</body></html>", paragraphs


def test_densities_decide_on_pages_without_an_article_element(monkeypatch):
    pages = list(mixed_pages())
    for page, want in pages:
        assert html_density.main_text(page).split("\n") == want
    weigh, rng = html_density.weigh, np.random.default_rng(5)

    def by_chance(root):
        nodes = weigh(root)
        for node in nodes:
            node.density, node.sum = rng.random(), rng.random()
        return nodes

    monkeypatch.setattr(html_density, "weigh", by_chance)
    changed = sum(html_density.main_text(page).split("\n") != want for page, want in pages)
    assert changed >= 0.9 * len(pages)


def test_link_divisions_in_an_article_go():
    words = "plain words of the article that go on " * 12
    teaser = "".join(f"<div><a href=/{i}>next</a><div><span>{i} min</span> by someone</div></div>" for i in range(6))
    page = f"<article><p>{words}</p><div>{teaser}</div><p>{words}</p><div>Aside from that.</div></article>"
    assert html_density.main_text(page) == f"{words.strip()}\n{words.strip()}\nAside from that."


def test_what_holds_the_article_stays():
    words = "plain words of the article that go on " * 12
    want = "\n".join([words.strip()] * 3)
    text = f"<p>{words}</p>" * 3
    for page in (
        f"<html><head><title>t</title><body>{text}",
        f"<html><head><title>t</title>{text}",
        f"<head><meta charset=x><title>t</title>{words}<p>{words}</head><p>{words}</p>",
        f"<title>t</title><body></body>{text}</html>",
        *(f"<body><div {x}>{text}</div><div class=footer>foot</div>" for x in ("class='content no-sidebar'", "class='has-sidebar'", "class=legal-text", "id=related-work", "id=tabs")),
        *(f"<body><div class=sidebar-left><{x}>{text}</{x}></div>" for x in ("article", "main", "div")),
        f"<body class=has-nav><form id=aspnetForm><nav><a href=/>menu</a> menu</nav><div>{text}</div><aside>beside</aside></form>",
        f"<body><nav>{text}",
        # an article with less text than what stands around it
        f"<body><form><article>{text}</article><div class=cookie-banner>{words * 2}</div></form><div class='ad-slot'>{words}</div>",
        f"<body><div class=modal><main>{text}</main></div><div class=popup>{words * 9}</div>",
    ):
        assert html_density.main_text(page) == want, page[:80]
    marked = ("class=userComments", "id=commentForm", "class=cookieConsent", "class=siteFooter", "id=google_ads_frame1", "class=adsbygoogle",
              "class=post-share-tools", 'style="color:red; display: none"', "class=site-footer", "id=main-nav", "class='x sidebar-left'", "class=comment-list", "class=ad-1", "id=cookie-banner", "role=banner", "hidden")
    for out in marked:
        assert html_density.main_text(f"<body><div>{text}</div><div {out}><p>other words</p></div>") == want, out
    # reader comments stay out however long, and so do articles in them
    comments = f"<div id=comments>{f'<article>{text}</article>' * 5}</div>"
    assert html_density.main_text(f"<body><div>{text}</div>{comments}") == want


def test_pages_of_the_table(spark):
    from queuelake.llm.catalog import op8_html_extraction

    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")["html"]
    rows = op8_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r.page_id]
        assert r.n_chars == len(r.text) and "track(" not in r.text and "©" not in r.text
        assert r.text.startswith(" ".join(page.split("<h1>")[1].split("</h1>")[0].replace("&amp;", "&").replace("&quot;", '"').split()))

"""Tokens, languages, pages and benchmark items against brute force, round trips and held-out rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotelake.llm import bpe, decontaminate, html_text, language_id
from quotelake.llm.catalog import QUERIES, VOCABULARY
from quotelake.llm.grams import RUN_CHARS

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\W_]+")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def frame(spark, rows, schema="doc_id bigint, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


# --- tokens

AWKWARD = [
    "", None, " ", "\n\n", "it's  he'll\tgo\r\n", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>\n", "日本語 テキスト",
    "naïve café ﬁ ½ ² ٣٤ 𝒳𝒴 😀 👩‍👩‍👧 é", "₏₝ new ꟎", "x" * 5000, " " * 300 + "end", "don't 'S 'LL ''s", "\x00\x1c\x85  ",
]


def encoded(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("part_chars, buckets", [(1 << 25, None), (60, 3)])
def test_tokens_equal_the_library(spark, part_chars, buckets):
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(AWKWARD)]
    rows += [(100 + i, " ".join(rng.choice(["the", "Und", "été", "12", "-", "a's", "zebra"]) for _ in range(80))) for i in range(30)]
    docs = frame(spark, [(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, part int, ids string").coalesce(2)
    got = {r.doc_id: r for r in bpe.encode_documents(docs, VOCABULARY, part_chars, buckets).collect()}
    assert got.keys() == dict(rows).keys()
    for i, text in rows:
        assert np.frombuffer(bytes(got[i].ids), "<u4").tolist() == encoded(text)
        assert got[i].n_tokens == len(encoded(text))
        assert got[i].decoded == TOKENIZER.decode(encoded(text), skip_special_tokens=False) == (text or "")


def test_token_rows_that_repeat(spark):
    rows = [(None, "one two"), (3, "one two"), (3, "one two"), (3, "three"), (4, None)]
    got = bpe.encode_documents(frame(spark, rows, parts=2), VOCABULARY).collect()
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter((i, t or "") for i, t in rows)
    assert bpe.encode_documents(frame(spark, []), VOCABULARY).collect() == []


def test_tokens_of_the_query(spark):
    got = {r.doc_id: r for r in QUERIES["op6_bpe_words"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = encoded(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_word_split_equals_the_library():
    vocabulary = open(VOCABULARY).read()
    for c in [*range(0x300), *range(0x300, 0x30000, 37), 0x208F, 0x1C89, 0xA7D2, 0x1E030]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)} x  {chr(c)}'s\n"
            expected = [text[a:b] for _, (a, b) in TOKENIZER.pre_tokenizer.pre_tokenize_str(text)]
            assert bpe.split_words(text, vocabulary) == expected, hex(c)


# --- languages


def test_words_of_a_part_are_those_of_its_texts():
    with open(VOCABULARY, encoding="utf-8") as f:
        vocabulary = f.read()
    rng = random.Random(5)
    pieces = [*"'  \n\tarsZ\u00e9\u00d7\u00f7\u01ff17.-", "'s", "'re", "'ll", "  ", "\r\n", "<|endoftext|>", "\u65e5\u672c", "\u2003"]
    for _ in range(2000):
        texts = ["".join(rng.choices(pieces[: rng.choice((19, len(pieces)))], k=rng.randrange(9))) for _ in range(rng.randrange(6))]
        expected = [bpe.split_words(t, vocabulary) for t in texts]
        distinct, codes, sizes = bpe._words(texts, vocabulary)
        words = [w.decode() for w in distinct.to_pylist()]
        assert words == list(dict.fromkeys(w for own in expected for w in own))
        assert [words[c] for c in codes] == [w for own in expected for w in own] and sizes.tolist() == list(map(len, expected))


def test_language_accuracy_on_held_out_documents(spark):
    got = QUERIES["op9_language_id"](spark, SMALL)
    lang = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(lang, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def brute_bayes(train, texts, features):
    """Plain counting over the same bins."""
    counts, docs = defaultdict(Counter), Counter()
    for lang, text in train:
        counts[lang].update(features.of([text])[0].tolist())
        docs[lang] += 1
    out = []
    for text in texts:
        scores = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + features.bins
            bins = features.of([text])[0].tolist()
            scores[lang] = np.log(docs[lang] / sum(docs.values())) + sum(np.log((counts[lang][b] + 1) / total) for b in bins)
        out.append(max(scores, key=scores.get))
    return out


def test_language_model_equals_plain_counting(spark):
    rng = random.Random(7)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "efghé"}

    def text(lang):
        return "".join(rng.choice(alphabets[lang] + " .") for _ in range(rng.randint(3, 40)))

    train = [(lang, text(lang)) for lang in alphabets for _ in range(15)]
    probe = [text(lang) for lang in alphabets for _ in range(10)] + ["a", "ç", "A  B!!"]
    features = language_id.Features(bins=256)
    docs = frame(spark, [(lang, t) for lang, t in train] + [(None, "zzz"), ("aa", None)], "lang string, text string", 4)
    model = language_id.fit(docs, features)
    assert model.languages == ("aa", "bb", "cc")
    best, score = model.score(probe)
    assert [model.languages[i] for i in best] == brute_bayes(train, probe, features)
    alone = [model.score([p]) for p in probe]
    assert [int(b[0]) for b, _ in alone] == best.tolist() and np.allclose([s[0] for _, s in alone], score)


def test_language_edge_rows(spark):
    rows = [(1, "hallo welt", "de"), (2, "hello world", "en"), (3, None, "en"), (4, "", None), (5, "123 !?", "de"), (None, "hello", None)]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string").withColumns({"score": F.lit(7), "lang_pred": F.lit("x")})
    for model in (language_id.fit(docs), None):
        got = docs.withColumn("found", language_id.identify(docs, model)).select("doc_id", "found.lang", "found.score").collect()
        found = {r.doc_id: (r.lang, r.score) for r in got}
        assert found[3] == found[4] == found[5] == ("und", 0.0)
        assert (found[1][0], found[None][0]) == (("de", "en") if model else ("und", "und"))
    empty = docs.limit(0)
    assert language_id.fit(empty) is None and language_id.fit(docs.where("lang is null")) is None
    assert empty.select(language_id.identify(empty, None)).collect() == []
    tie = language_id.fit(frame(spark, [("b", "xx"), ("a", "xx")], "lang string, text string"))
    assert tie.languages[tie.score(["xx"])[0][0]] == "a"
    with pytest.raises(ValueError, match="more than 1 languages"):
        language_id.fit(docs, most_languages=1)


def test_a_prediction_does_not_depend_on_the_batch():
    features = language_id.Features()
    texts = ["ab", "", "c", "de f", "1", "g"]
    bins, starts = features.of(texts)
    for i, t in enumerate(texts):
        assert bins[starts[i] : starts[i + 1]].tolist() == features.of([t])[0].tolist()


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>Title &amp; more</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header class="site-header"><h1>Site name here, for all pages.</h1></header>
<nav><ul><li><a href="/a">Home, sweet home</a></li></ul></nav><div class="cookie-notice">We use cookies, as all do. Accept them now, please.</div>
<div id="content">%s</div><aside>Other stories, of no concern here. Read them all, today.</aside>
<div class="sidebar-right"><p>Weather, today: rain, wind, and more of it. Stay in.</p></div>
<section id="comments"><article class="comment"><p>First! I read it all, and I liked it, really.</p></article></section>
<form><p>Leave a reply, if you like. It is free, and quick.</p><textarea>type</textarea></form><footer>&copy; 2020, all rights reserved.</footer></body></html>"""
BODY = [
    "A heading", "The first paragraph, with a link and some more words. It goes on, for a while, and it ends.",
    "The second one: shorter, but not short. It has &, <, and ü.", "Last.",
]
MARKUP = """<h1>A heading</h1><p>The first paragraph, with <a href="x">a link</a> and some <b>more
words</b>. It goes on, <!-- not this --> for a while, and it ends.<p>The second one: shorter, but not short.<br>It has &amp;, &lt;, and &uuml;.</p>
<div class="ad">Buy now, pay later. Great offers, every day.</div><p hidden>secret text, hidden from all.</p><p>Last.</p>"""


@pytest.mark.parametrize("holder", ["<article>%s</article>", "<main>%s</main>", "<div class=\"post\">%s</div>", "<article><header>%s</header></article>"])
def test_main_text_without_the_rest(holder):
    text = html_text.main_text(PAGE % (holder % MARKUP))
    expected = [" ".join(b.split()) for b in BODY]
    if "post" in holder:  # without a mark, the page itself must tell
        assert text.split("\n")[-3:] == expected[1:]
    else:
        assert text.split("\n") == expected


def test_main_text_of_an_unmarked_page_with_inner_blocks():
    """Short blocks one or more levels deeper than the prose are part of the article; lists of links are not."""
    prose = [f"Paragraph {i}, which is long enough, " + "with words, and commas, and more of both, " * 7 + "to its end." for i in range(5)]
    items = [f"Item number {i} of a short list, between the paragraphs of it" for i in range(3)]
    inner = f"<ul>{''.join(f'<li>{x}</li>' for x in items)}<li><a href='x'>linked item</a></li></ul>"
    inner += "<table><caption>Sizes</caption><tr><th>name</th><td>12 cm</td></tr></table><figure><img src='x'><figcaption>A picture</figcaption></figure>"
    inner += "<blockquote><div><p>Quoted words</p></div></blockquote>"
    links = "".join(f"<li><a href='/{i}'>Another story, number {i}, to be read later</a></li>" for i in range(4))
    p = [f"<p>{x}</p>" for x in prose]
    holder = f"<div class='post'><h1>Title</h1>{''.join(p[:3])}{inner}{''.join(p[3:])}<div><ul>{links}</ul></div></div>"
    expected = ["Title", *prose[:3], *items, "linked item", "Sizes", "name", "12 cm", "A picture", "Quoted words", *prose[3:]]
    assert html_text.main_text(PAGE % holder).split("\n") == expected


PROSE = [f"Paragraph {i}, which is long enough, " + "with words, and commas, and more of both, " * 5 + "to its end." for i in range(4)]


@pytest.mark.parametrize("holder", ["<article>%s</article>", "<main>%s</main>", '<div class="post">%s</div>'])
def test_names_of_headings_and_sections_do_not_cost_them(holder):
    heads = ["ad-hoc-networks", "related-work", "form-and-function", "comments-on-method"]
    p = [f"<p>{x}</p>" for x in PROSE]
    body = "".join(f'<h2 id="{h}">About {h}</h2>{p[i]}' for i, h in enumerate(heads))
    body += f'<section id="discussion"><h2>Discussion</h2><p>What it means, in the end: much, or not.</p>{p[0]}</section>'
    body += '<div id="search-results"><p>We searched, and we found, as told above.</p></div>'
    expected = [x for i, h in enumerate(heads) for x in (f"About {h}", PROSE[i])]
    expected += ["Discussion", "What it means, in the end: much, or not.", PROSE[0], "We searched, and we found, as told above."]
    assert html_text.main_text(PAGE % (holder % body)).split("\n") == expected


@pytest.mark.parametrize("holder", ["<article>%s</article>", "<main>%s</main>"])
def test_parts_of_a_marked_article_that_are_none_of_it(holder):
    body = f"""<h1>Title</h1><p>{PROSE[0]}</p><div class="share"><a href="x">Share</a></div><p>{PROSE[1]}</p>
    <div id="reply"><p>Write to us, please, now.</p><input name="x"></div><div class="related"><a href="a">More of it</a></div>
    <div class="newsletter">Sign up, now.</div><div id="comments"><a href="c">12 comments</a></div><p class="sponsored">Buy, buy, buy.</p>"""
    assert html_text.main_text(PAGE % (holder % body)).split("\n") == ["Title", *PROSE[:2]]


def test_sources_and_short_articles():
    links = "".join(f"<li><a href='/{i}'>Source number {i}, with its title</a></li>" for i in range(4))
    sources = [f"Source number {i}, with its title" for i in range(4)]
    page = PAGE % f"<article><p>{PROSE[0]}</p><h2>Sources</h2><ol>{links}</ol></article>"
    assert html_text.main_text(page).split("\n") == [PROSE[0], "Sources", *sources]
    beside = "".join(f"<p>{x}</p>" for x in PROSE)
    assert html_text.main_text(f"<body><article><p>Short</p></article><div class='x'>{beside}</div></body>") == "Short"


def test_one_of_several_articles():
    teaser = "<article><h2>Another story</h2><p>Read it here, soon.</p></article>"
    own = f"<article><h1>This one</h1><p>{PROSE[0]}</p><p>{PROSE[1]}</p></article>"
    expected = ["This one", *PROSE[:2]]
    assert html_text.main_text(PAGE % (teaser + own + teaser)).split("\n") == expected
    assert html_text.main_text(PAGE % f"<main><p>Seen from afar.</p>{own}{teaser}</main>").split("\n") == ["Seen from afar.", *expected]
    cards = "".join(f"<article><a href='{i}'>A card that leads away</a></article>" for i in range(5))
    assert html_text.main_text(PAGE % f"<div class='post'><p>{PROSE[0]}</p><p>{PROSE[1]}</p></div><div>{cards}</div>").split("\n") == PROSE[:2]


def test_references_end_at_tags():
    assert html_text.main_text("<article><p>&<b>lt;</b> &am<!-- x -->p; &lt;b&gt; &amp;lt; a&nbsp;&#8203;b</p></article>") == "&lt; &amp; <b> &lt; a \u200bb"


def test_pages_equal_the_marked_article(spark):
    """The pages of the tables mark their articles, so that a pattern can cut them out."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in QUERIES["op8_html_text"](spark, SMALL).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        parts = [re.sub(r"<br>", " ", p) for p in re.split(r"</?(?:p|h1)>", article)]
        parts = [" ".join(html_text.html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_page_edge_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "just text, no markup", "x"), (3, "u", "<p>unclosed <b>text", "x"),
            (None, "u", "<nav><a>menu</a></nav>", "x"), (5, "u", "<p>a</p>" * 3000, "x"), (6, "u", "< 3 <p<p>x & y</ p><", "x")]
    got = html_text.extract_pages(frame(spark, rows, "page_id bigint, url string, html string, text string")).collect()
    assert got[0].__fields__ == ["page_id", "url", "text"]
    found = defaultdict(list)
    for r in got:
        found[r.page_id].append(r.text)
    assert found[1] == found[2] == found[None] == [""]
    assert sorted(found[3]) == ["just text, no markup", "unclosed text"]
    assert found[5] == ["\n".join("a" * 3000)]
    assert html_text.extract_pages(frame(spark, [], "page_id bigint, url string, html string")).collect() == []
    assert html_text.main_text("<div>" * 3000 + "deep words, in here." + "</div>" * 10) == "deep words, in here."


# --- benchmark items


def grams(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_leaks(docs, items, threshold=0.8):
    """An item of fewer than five words is one shingle of its own length."""
    held = [(i, grams(t), min(5, len(WORD.findall((t or "").lower())))) for i, t in items]
    found = Counter()
    for d, text in docs:
        words = WORD.findall((text or "").lower())
        runs = [{tuple(words[k : k + n]) for k in range(len(words) - n + 1)} for n in range(5)]
        own = grams(text)
        for i, wanted, width in held:
            here = wanted & (runs[width] if width < 5 else own)
            if wanted and len(here) >= threshold * len(wanted):
                found[d, i, len(here), len(wanted)] += 1
    return found


def spark_leaks(docs, items):
    return Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontaminate.contaminated(docs, items).collect())


@pytest.mark.parametrize("block", [20_000, 5])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    rng = random.Random(block)

    def words(n):
        return [f"w{rng.randrange(2000)}" for _ in range(n)]

    items = [(i, words(rng.choice([5, 6, 9, 20, 21, 40, 70, 200]))) for i in range(25)]
    items += [(100 + n, words(n)) for n in (1, 2, 2, 3, 4, 4)] + [(200, items[-1][1][:3])] * 2
    docs = []
    for d in range(80):
        text = words(rng.choice([0, 3, 50, 500, 3000]))
        for _, item in rng.sample(items, rng.choice([0, 0, 1, 2])):
            item = [w if rng.random() > rng.choice([0, 0, 0.01, 0.03]) else "zz" for w in item]
            item = item[rng.choice([0, 0, 1, 3]) :]
            at = rng.randint(0, len(text))
            text[at:at] = item
        docs.append((d, " ".join(text).title()))
    items = [(i, " ".join(t)) for i, t in items]
    expected = brute_leaks(docs, items)
    assert len(expected) > 25
    assert spark_leaks(frame(spark, docs), frame(spark, items, "item_id bigint, text string")) == expected


def test_leak_edge_rows(spark):
    item = "one two three four five six seven"
    items = [(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "..."), (5, "just three words")]
    docs = [(7, f"before it {item} and after"), (7, f"before it {item} and after"), (None, item.upper()), (8, None), (9, ""), (10, "just three words"),
            (11, "just three words more")]
    both = [frame(spark, [(*r, 0) for r in rows], f"{key} bigint, text string, {other} int") for rows, key, other in
            ((docs, "doc_id", "item_id"), (items, "item_id", "doc_id"))]
    assert spark_leaks(*both) == brute_leaks(docs, items)
    kept = decontaminate.drop_contaminated(both[0].withColumn("_leaks", both[0].item_id), both[1])
    assert kept.columns == [*both[0].columns, "_leaks"]
    # The item of three words stands in the document of four.
    assert sorted((r.doc_id, r._leaks) for r in kept.collect()) == [(8, 0), (9, 0)]
    empty = both[0].limit(0), both[1].limit(0)
    assert decontaminate.contaminated(empty[0], both[1]).collect() == decontaminate.contaminated(both[0], empty[1]).collect() == []


def test_blocks_of_items_drop_one_after_another(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    items = [(i, f"item{i} word word other word item{i}") for i in range(7)]
    docs = [(i, f"before {items[i][1]} after" if i < 7 else "clean") for i in range(9)]
    kept = decontaminate.drop_contaminated(frame(spark, docs), frame(spark, items, "item_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [7, 8]


def test_leaks_of_a_very_long_document(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(150_000)]
    items = [(1, " ".join(words[70_000:70_040])), (2, " ".join(words[149_970:])), (3, "not in it at all and never was")]
    assert len(" ".join(words)) > RUN_CHARS
    docs = [(1, " ".join(words)), (2, "short")]
    assert spark_leaks(frame(spark, docs), frame(spark, items, "item_id bigint, text string")) == brute_leaks(docs, items)


def test_leaks_of_the_query(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = QUERIES["op10_decontaminate"](spark, SMALL).collect()
    assert Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got) == brute_leaks(docs, items)
    assert all(r.containment == r.n_shared / r.n_item for r in got)

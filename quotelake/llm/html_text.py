"""Main text of web pages by tag-path ratios.

A page is a list of text blocks, each with the path of block elements that leads to it. Blocks in
parts that the markup itself names (menus, forms, adverts, ..) are left out. For every path the
text and the punctuation per block are aggregated, smoothed along the page and fused; paths
above the threshold hold content, and the element that holds those paths is the article. Where
the page marks articles, the one with the most text of its own is taken.
"""

from __future__ import annotations

import html
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of elements, by their names in HTML.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template".split())
NEVER = set(
    "head nav footer aside form menu dialog select button input label object svg math canvas audio video map applet "
    "fieldset option optgroup datalist".split()
) | RAW
ARTICLE = {"article", "main"}
HEADINGS = {f"h{i}" for i in range(1, 7)}
#: An element of the key's kind ends one of these that is still open, if no element of the third list lies between.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
INSIDE_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
P_SCOPE = {"td", "th", "caption", "table", "button", "object"}
CONTROLS = {"input", "textarea", "select", "button", "form"}
#: Words in `class`, `id` or `role` that name what is not the article.
NOT_ARTICLE = set(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar skip "
    "masthead footer contentinfo sidebar sidebars aside complementary widget widgets rail "
    "cookie cookies consent gdpr notice notices alert popup modal overlay dialog disclaimer "
    "newsletter subscribe subscription signup login search form "
    "comment comments commentlist reply replies respond disqus discussion "
    "share sharing social related recommended recommendations hidden".split()
)
#: Those that an article uses of its own parts, too, as an `id` does with any word (it often is the slug of a
#: heading). An element with nothing but such a word only goes if it is mostly links or holds form controls.
AMBIGUOUS = set(
    "alert alerts banner comment dialog disclaimer discussion form login notice notices overlay pager promotion rail "
    "related reply replies respond search signup skip social sponsor subscription toolbar widget widgets".split()
)
PAGE_HEADER = {"header", "banner"}
NEGATING = {"has", "with", "no", "without", "is", "not"}
PUNCTUATION = regex.compile(r"[.,;:!?…。，、；：！？¿¡]")
TOKEN = regex.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))|<[!?/][^>]*+(?:>|\Z)",
    regex.DOTALL,
)
ATTRIBUTE = regex.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
CLASS = regex.compile(r"""\bclass\s*=\s*["']?([\w-]+)""")
RAW_END = {n: regex.compile(rf"</{n}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", regex.IGNORECASE) for n in RAW}
NAME_WORD = regex.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int
    article: int  # the number of the outermost marked article around it, or 0
    part: int  # of an `article` in a `main`, or 0
    inside: tuple[int, ...]  # the numbers of the elements of `path`
    doubtful: tuple[int, ...]  # and of those that may be no part of an article


OUT, DOUBTFUL = 2, 1


def _named_out(name: str, attributes: str, in_article: bool) -> int:
    """Whether the element says of itself that it is no part of an article (OUT), or may be none (DOUBTFUL)."""
    if not attributes.strip("/> \n\t"):
        return 0
    verdict = 0
    for key, a, b, c in ATTRIBUTE.findall(attributes.rstrip(">")):
        key, value = key.lower(), a or b or c
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return OUT
        if key == "style" and regex.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return OUT
        if key in ("class", "id", "role") and name not in ("html", "body", "article", "main"):
            if key == "id" and name in HEADINGS:
                continue
            words = [w.lower() for w in NAME_WORD.findall(html.unescape(value))]
            for before, word in zip(["", *words], words, strict=False):
                if before not in NEGATING and (word in NOT_ARTICLE or (word in PAGE_HEADER and not in_article)):
                    unsure = (in_article and key == "id") or (word in AMBIGUOUS and (in_article or key == "id"))
                    verdict = max(verdict, DOUBTFUL if unsure else OUT)
        elif key in ("class", "id", "role") and name == "article":
            words = {w.lower() for w in NAME_WORD.findall(value)}
            if words & {"comment", "comments", "reply", "related", "recommended", "ad", "advert", "sponsored", "promo"}:
                return OUT
    return verdict


class Open(NamedTuple):
    """An element that has not ended yet."""

    name: str
    label: str
    left_out: bool
    linked: bool
    article: int  # its number, or that of the one around it
    part: int
    number: int
    doubtful: tuple[int, ...]


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, without those in parts that are something else."""
    out: list[Block] = []
    stack = [Open("", "", False, False, 0, 0, 0, ())]
    pieces: list[str] = []
    with_controls: set[int] = set()
    linked = articles = opened = 0

    def end_block() -> None:
        nonlocal linked
        if not pieces:
            return
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            around = [e for e in stack if e.name in BLOCK]
            path, inside = tuple(e.label for e in around), tuple(e.number for e in around)
            top = stack[-1]
            out.append(Block(path, text, min(linked, len(text)), top.article, top.part, inside, top.doubtful))
        linked = 0

    def close(upto: int) -> None:
        if any(e.name in BLOCK for e in stack[upto:]):
            end_block()
        del stack[upto:]

    def close_nearest(names: set[str], scope: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                close(i)
            elif stack[i].name in scope:
                return

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].left_out:
            text = html.unescape(text)  # a reference never reaches over a tag
            pieces.append(text)
            if stack[-1].linked:
                linked += len(text.strip())

    at = 0
    while m := TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        slash, name, attributes = m.groups()
        if not name:
            continue
        name = name.lower()
        if slash:
            held = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if held:
                close(held)
            elif name in BLOCK:
                end_block()
            continue
        top = stack[-1]
        if name in CONTROLS:
            with_controls.update(top.doubtful)
        if name in INSIDE_P:
            close_nearest({"p"}, P_SCOPE)
        if name in HEADINGS and top.name in HEADINGS:
            close(len(stack) - 1)
        if name in ENDED_BY:
            close_nearest(*ENDED_BY[name])
        if name == "body":
            close_nearest({"head"}, set())
        if name in VOID:
            if name == "hr":
                end_block()
            elif name == "br":
                add(" ")
            continue
        if name in RAW:
            # Everything up to the end tag is the element's own matter.
            end = RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in BLOCK:
            end_block()
        top = stack[-1]
        verdict = _named_out(name, attributes, top.article > 0) if len(attributes) > 2 else 0
        left_out = top.left_out or name in NEVER or (name == "header" and not top.article) or verdict == OUT
        article, part, label = top.article, top.part, name
        if name in ARTICLE and not left_out and (not article or (name == "article" and not part)):
            articles += 1
            article, part = article or articles, articles if article else 0
        if name in BLOCK and len(attributes) > 2 and (c := CLASS.search(attributes)):
            label = f"{name}.{c[1]}"
        opened += 1
        doubtful = (*top.doubtful, opened) if verdict == DOUBTFUL else top.doubtful
        stack.append(Open(name, label, left_out, top.linked or name == "a", article, part, opened, doubtful))
    add(page[at:])
    end_block()
    return _without_doubtful(out, with_controls)


def _without_doubtful(found: list[Block], with_controls: set[int]) -> list[Block]:
    """Elements that may be no part of an article go if they hold form controls or are mostly links."""
    if not any(b.doubtful for b in found):
        return found
    chars, linked = Counter(), Counter()
    for b in found:
        for element in b.doubtful:
            chars[element] += len(b.text)
            linked[element] += b.linked
    out = with_controls | {e for e in chars if 2 * linked[e] >= chars[e]}
    return [b for b in found if not out.intersection(b.doubtful)]


def _smooth(values: np.ndarray) -> np.ndarray:
    """Each value with its neighbours, weighted 1, 2, 1."""
    padded = np.pad(values, 1, mode="edge")
    return (padded[:-2] + 2 * values + padded[2:]) / 4


def path_scores(page: list[Block]) -> dict[tuple[str, ...], float]:
    """Text per block times punctuation per block, of each path, smoothed along the page."""
    count, chars, marks = Counter(), Counter(), Counter()
    for b in page:
        count[b.path] += 1
        chars[b.path] += len(b.text) - b.linked
        marks[b.path] += len(PUNCTUATION.findall(b.text))
    by_text = _smooth(np.array([chars[b.path] / count[b.path] for b in page], float))
    by_marks = _smooth(np.array([marks[b.path] / count[b.path] for b in page], float))
    scores = defaultdict(list)
    for b, score in zip(page, by_text * (by_marks + 0.1), strict=True):
        scores[b.path].append(score)
    return {path: sum(s) / len(s) for path, s in scores.items()}


def _largest(page: list[Block], number) -> int:
    """The marked part (by `number`) with the most text of its own, the first of equal ones; 0 if none has
    more than its links."""
    mass, chars, linked = Counter(), Counter(), Counter()
    for b in page:
        mass[number(b)] += (len(b.text) - b.linked) * (1 + len(PUNCTUATION.findall(b.text)))
        chars[number(b)] += len(b.text)
        linked[number(b)] += b.linked
    of_its_own = [n for n in chars if n and 2 * linked[n] < chars[n]]
    return max(of_its_own, key=lambda n: (mass[n], -n), default=0)


def main_text(page: str, share: float = 0.5) -> str:
    """The article's blocks, in order, one to a line.

    Of marked articles the one with the most text of its own (and punctuation in it) is taken whole, of
    several articles in a `main` the same, with what stands beside them. Where none is marked, content
    paths are those that score at least `share` of the mean over all blocks, and the article is the nearest
    element that holds all of them; all its blocks, at any depth, belong to it but for inner
    elements that are mostly links.
    """
    found = blocks(page)
    if not found:
        return ""
    article = _largest(found, lambda b: b.article)
    if article:
        own = [b for b in found if b.article == article]
        part = _largest(own, lambda b: b.part)
        return "\n".join(b.text for b in own if b.part in (0, part) or not part)
    scores = path_scores(found)
    limit = share * sum(scores[b.path] for b in found) / len(found)
    content = {p for p, s in scores.items() if s >= limit}
    parents = [p[:-1] for p in content]
    depth = 0
    while all(len(p) > depth for p in parents) and len({p[depth] for p in parents}) == 1:
        depth += 1
    holder = parents[0][:depth]
    own = [b for b in found if b.path[:depth] == holder]
    chars, linked = Counter(), Counter()
    for b in own:
        for element in b.inside[depth:]:
            chars[element] += len(b.text)
            linked[element] += b.linked

    def among_links(b: Block) -> bool:
        # A block's own element counts if nothing else of the holder is around it.
        alone = len(b.path) == depth + 1 and b.path not in content
        around = b.inside[depth:] if alone else b.inside[depth:-1]
        return any(2 * linked[element] >= chars[element] for element in around)

    return "\n".join(b.text for b in own if not among_links(b))


def extract_pages(pages: DataFrame) -> DataFrame:
    """`page_id, url, text` for every row of `pages` (`page_id, url, html`).

    `text` is the main text of the whole page; empty for a null or empty page, and for one without
    any text outside of menus and the like. Rows stay apart when they repeat. Other columns are not
    read.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1).cast(pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return source.mapInArrow(run, "page_id bigint, url string, text string")

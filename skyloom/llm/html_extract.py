"""HTML extraction by the maximum-scoring subsequence of a page's tokens.

Words score positive and tags negative, with weights counted on labelled pages.  One linear
scan finds the contiguous region with the best sum; what stands in it inside menus, headers,
footers, sidebars, notices, adverts, forms, comments and the like is left out.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "label", "option", "fieldset", "head"}
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "banner", "cookie", "cookies", "notice", "consent", "gdpr", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "share", "sharing", "social", "related", "promo", "newsletter", "subscribe", "signup", "comment", "comments", "respond", "reply", "replies", "footer", "header", "masthead", "popup", "modal", "pagination", "pager", "widget", "alert", "complementary", "contentinfo", "search", "skip", "toolbar"}
MAIN = {"article", "main"}
COMMENTS = {"comment", "comments", "respond", "reply", "replies"}
CONTENT = {"article", "post", "entry", "story", "content"}
POSTS = CONTENT - {"content"}
# Elements whose end tags may be left out, the start tags that end them, and the elements that keep them open.
IMPLIED = (
    (("p",), {"address", "article", "aside", "blockquote", "details", "dialog", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}, {"table", "td", "th", "button", "object"}),
    (("li",), {"li"}, {"ul", "ol", "menu"}),
    (("dt", "dd"), {"dt", "dd"}, {"dl"}),
    (("td", "th"), {"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
    (("tr",), {"tr", "tbody", "tfoot"}, {"table"}),
    (("option",), {"option", "optgroup"}, {"select"}),
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<tag2>/?[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _hinted(name: str, attrs: str) -> int:
    """Class, id or role name what isn't content (1) or reader comments (2). The header of a post is content (0)."""
    if name in ("body", "html") or not attrs or "=" not in attrs:
        return 0
    found = 0
    for m in _ATTR.findall(attrs):
        for value in next(filter(None, m), "").lower().split():
            words = set(re.split(r"[^a-z]+", value))
            if words & HINTS - ({"header"} if words & CONTENT else set()):
                found = max(found, 2 if words & COMMENTS else int(name not in MAIN))
    return found


def _is_post(attrs: str) -> bool:
    """Class or id name an article, post, entry or story; a header in it is the article's own."""
    return any(set(re.split(r"[^a-z]+", "".join(m).lower())) & POSTS for m in _ATTR.findall(attrs)) if "=" in attrs else False


def _ends(name: str, depth: int, places: dict[str, list[int]]) -> int:
    """How many open elements the start tag ends without their end tags; ``places``: where elements of a name are open."""
    last = lambda names: max((places[n][-1] for n in names if places.get(n)), default=-1)
    for these, starts, stops in IMPLIED:
        if name in starts:
            at = last(these)
            if at >= 0 and at > last(stops):
                return depth - at
    return 0


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, class, text): ``w`` a word, ``t`` a tag, ``-`` a word that isn't content; class is what weights hang on.

    Text is "" before a word that starts a new block or follows white space, so that the
    words of an inline run join again.  An element whose name says so (a menu, a form) is never content;
    one whose class only hints at it is, if it holds an article, or most of the page's words where no article
    stands elsewhere; reader comments never are.  Time and memory grow in proportion to the page, however deep it is.
    """
    out: list[tuple[str, str, str, int | None]] = []  # None: in an element that is never content
    stack: list[tuple[str, bool, bool, int, bool]] = []  # name, never content, is main, hint around it (-2: has none itself), is a post
    places: dict[str, list[int]] = {}  # where in the stack elements of a name are
    hint_now = -1  # number of the nearest open element with a hint
    held: list[list[int]] = []  # of each element with a hint: own words, own articles, in an article, comments, the hint around it
    asides = mains = links = posts = words = articles = 0
    gap = " "

    def leave(n: int) -> None:
        nonlocal asides, mains, links, posts, hint_now
        for _ in range(n):
            last, was_aside, was_main, around, was_post = stack.pop()
            places[last].pop()
            asides, mains, links, posts = asides - was_aside, mains - was_main, links - (last == "a"), posts - was_post
            if around != -2:
                hint_now = around

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            text = entities.unescape(text)
            parts = text.split()
            if not parts:
                gap = gap or (" " if text else "")
                continue
            if text[0].isspace():
                gap = " "
            where = ("main" if mains else "plain") + ("-link" if links else "")
            for part in parts:
                out.append(("w", where, gap + part, None if asides else hint_now))
                gap = " "
            if not asides:
                words += len(parts)
                if hint_now >= 0:
                    held[hint_now][0] += len(parts)
            gap = " " if text[-1].isspace() else ""
            continue
        if m["raw"]:
            if m["raw"].lower() not in ("script", "style"):
                gap = " "
            out.append(("t", "raw", "", -1))
            continue
        name = (m["tag"] or m["tag2"] or "").lower()
        if not name:
            continue
        attrs, closing = m["attrs"] or m["attrs2"] or "", name[0] == "/"
        name = name.lstrip("/")
        if name not in INLINE:
            gap = " "
        named = name if name in ("p", "br", "h1", "h2", "h3", "li", "td", "div") else "inline" if name in INLINE else "block"
        if closing:
            if places.get(name):
                leave(len(stack) - places[name][-1])
            out.append(("t", ("main:" if mains else "plain:") + ("aside" if name in ASIDE else named), "", None if asides else hint_now))
            continue
        leave(_ends(name, len(stack), places))
        main = name in MAIN
        aside = name in ASIDE or (name == "header" and not mains and not posts)
        hint = 0 if aside else _hinted(name, attrs)
        main = main and not hint
        articles += main
        if name == "body":
            while stack and stack[-1][0] == "head":
                leave(1)
        if main and hint_now >= 0:
            held[hint_now][1] += 1
        if name not in VOID and not attrs.endswith("/"):
            # Of paragraphs and inline elements only those that change the context are kept open.
            if aside or main or hint or name == "a" or (name != "p" and name not in INLINE) or asides:
                post = not aside and name not in INLINE and name not in ("body", "html") and _is_post(attrs)
                places.setdefault(name, []).append(len(stack))
                stack.append((name, aside, main, hint_now if hint else -2, post))
                asides, mains, links, posts = asides + aside, mains + main, links + (name == "a"), posts + post
                if hint:
                    held.append([0, 0, mains, hint == 2, hint_now])
                    hint_now = len(held) - 1
        out.append(("t", ("main:" if mains else "plain:") + named, "", None if asides else hint_now))
    for own, own_articles, _, _, around in reversed(held):  # what stands in an element stands in those around it
        if around >= 0:
            held[around][0] += own
            held[around][1] += own_articles
    content = {-1: True}
    for k, (n, own, within, comments, around) in enumerate(held):
        content[k] = content[around] and not comments and bool(own or (2 * n > words and (within or not articles)))
    return [
        (kind, group, text) if open_ is not None and content[open_] else ("-", group, text) if kind == "w" else ("t", group.partition(":")[0] + ":aside", "")
        for kind, group, text, open_ in out
    ]


def labelled_pages(n: int = 240, seed: int = 11) -> list[tuple[str, str]]:
    """(page, main text) made by rule: several layouts of menus, adverts, notices, articles, comments and footers."""
    rnd = random.Random(seed)
    words = lambda k: " ".join("".join(rnd.choice("aeioubcdfglmnprst") for _ in range(rnd.randint(2, 9))) for _ in range(k))
    forms = ["<p>{}</p>"] * 8 + ["<p><b>{}<br>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<section><h2>{}</h2></section>", "<table><tr><td>{}</td></tr></table>", "<div>{}</div>", "<figure><figcaption>{}</figcaption></figure>", "<h3>{}</h3>"]
    out = []
    for k in range(n):
        title, paras = words(rnd.randint(1, 9)), [words(rnd.randint(1, 80)) for _ in range(rnd.randint(1, 9))]
        menu = "".join(f'<li><a href="/{i}">{words(rnd.randint(1, 2))}</a></li>' for i in range(rnd.randint(3, 9)))
        side = f'<div class="{rnd.choice(["ad", "sidebar", "cookie-notice", "share"])}">{words(rnd.randint(3, 25))}</div>'
        foot = f"<footer>&copy; {words(rnd.randint(2, 20))}</footer>"
        head, inner = f"<h1>{title}</h1>", "".join(rnd.choice(forms).format(p) for p in paras)
        comment = f'<section class="comments"><p>{words(rnd.randint(5, 60))}</p></section>' * (k % 3 == 0)
        loose = f"<div><a href='/x'>{words(2)}</a> <a href='/y'>{words(2)}</a></div>"
        body = {0: f"<article>{head}{inner}</article>", 1: f"<main>{head}{side}{inner}{comment}</main>", 2: f'<div class="post">{head}{inner}</div>', 3: f"<article>{head}{side}{side}{inner}</article>"}[k % 4]
        out.append((f"<html><head><title>{title}</title></head><body><nav><ul>{menu}</ul></nav>{side}{loose}{body}{loose}{comment}{foot}</body></html>", " ".join([title, *paras])))
    return out


def fit(pages: list[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """A weight per class of word (0.1 to 4) and tag (-4 to -0.02), log odds of standing in the main text."""
    inside: dict[tuple[str, str], float] = {}
    total: dict[tuple[str, str], float] = {}
    for page, main in pages:
        found, wanted, at = tokens(page), main.split(), 0
        content = [i for i, t in enumerate(found) if t[0] == "w"]
        mine = [found[i][2].strip() for i in content]
        start = next((s for s in range(len(mine) - len(wanted) + 1) if mine[s : s + len(wanted)] == wanted), None)
        if start is None:
            continue
        at, end = content[start], content[start + len(wanted) - 1]
        for i, (kind, group, _) in enumerate(found):
            if kind != "-":
                total[kind, group] = total.get((kind, group), 0) + 1
                inside[kind, group] = inside.get((kind, group), 0) + (at <= i <= end)
    weights = {}
    for key, n in total.items():
        odds = math.log((inside[key] + 0.5) / (n - inside[key] + 0.5))
        weights[key] = min(4.0, max(0.1, odds)) if key[0] == "w" else max(-4.0, min(-0.02, odds / 2))
    return weights


@lru_cache(maxsize=1)
def default_weights() -> dict[tuple[str, str], float]:
    return fit(labelled_pages())


def extract(page: str | None, weights: dict[tuple[str, str], float] | None = None) -> str:
    """The main text of one page; "" if there is none.  Of equal regions the first and shortest one is taken."""
    weights = weights or default_weights()
    found = tokens(page or "")
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, group, _) in enumerate(found):
        if kind != "-":
            total += weights.get((kind, group), 0.5 if kind == "w" else -0.5)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    return "".join(t[2] for t in found[slice(*span)] if t[0] == "w").strip()


def _extracted(weights):
    def run(batches):
        for batch in batches:
            texts = [extract(h, weights) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, weights: dict[tuple[str, str], float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row: no shuffle, one scan of each whole page.

    A null html is empty, a page without main text gives "" and 0; unclosed tags, comments
    and scripts end with the page.  Ids and urls are carried as they are, repeats too.
    """
    weights = weights or default_weights()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted(weights), "page_id long, url string, text string, n_chars long")

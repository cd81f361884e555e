"""Main text of raw pages by a maximum-scoring run of tokens.

A page is one stream of tokens, words and tags. A word's weight is its log-odds of lying in the article, from a logistic
regression over what is around it: the elements it stands in, the parts of their class and id names, their roles, and how long
and how full of links its block is. Tags weigh a little below zero. One linear scan finds the contiguous run with the greatest
sum; its text is the article, without the words in it that weigh below zero themselves (adverts, forms, reader comments).

The regression is fitted on labelled pages that are drawn from layouts, see `labelled_pages`: names of parts, also in compounds,
in several languages, marked and unmarked articles. No page of the corpus is used, and the words of a text are no features.

Edge cases: null or empty html gives the empty string; unclosed or stray tags end with the nearest matching container, and a tag
that never closes ends before the next one; of attributes only real class, id, role, hidden and aria-hidden count, not words
inside other names or values; a script, style or comment that never ends takes the rest of the page; a page without a word of
content gives the empty string; repeated rows are pages of their own; other columns are ignored. Reading a page takes time in
proportion to its length, whatever is in it.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

# Kinds of elements in HTML.
OPEN_RAW = ("script", "style")  # without an end tag they take the rest of the page
RAW = {"noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas", "video", "audio", "select"}  # without one only their tag goes
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
    "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BREAK = {"br", "td", "th"}
ENDED_BY_ITSELF = {"p", "li", "td", "tr", "dd", "dt", "option"}
PLAIN = {"div", "span", "html", "body"}  # names that say nothing about what is in them

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(OPEN_RAW)})(?=[\s/>])(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/<>]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>?"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<+(?=<)|<)",
    re.I | re.S,
)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"|'")
_HUMP, _PART = re.compile(r"(?<=[a-zà-ÿ])(?=[A-Z])"), re.compile(r"[^a-zß-ÿ]+")


@lru_cache(1 << 14)
def element(name: str, rest: str, inside: bool) -> tuple[tuple[str, ...], bool]:
    """(features, whether it marks the article) of an element; inside: whether it stands in a marked article."""
    where = "in" if inside else "out"
    found = [] if name in PLAIN else [f"tag {where} {name}"]
    marks = name in ("article", "main")
    for key, *values in _ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), "".join(values)
        if key == "role":
            found.append(f"role {where} {value.lower()}")
            marks |= value.lower() in ("main", "article")
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            found.append(f"hidden {where}")
        elif key in ("class", "id") and name not in ("body", "html"):
            for own in value.split():
                parts = [p for p in _PART.split(_HUMP.sub("-", own).lower()) if p]
                if parts:
                    found += [f"name {where} {'-'.join(parts)}", f"first {where} {parts[0]}", f"last {where} {parts[-1]}"] if len(parts) > 1 else [f"name {where} {parts[0]}"]
    return tuple(found), marks


class Token:
    """One tag, or one text with what is around it: features of its elements, link, in a marked article, its block."""

    __slots__ = ("what", "text", "features", "link", "inside", "block")

    def __init__(self, what: str, text: str, features: tuple = (), link: bool = False, inside: bool = False, block: int = 0):
        self.what, self.text, self.features, self.link, self.inside, self.block = what, text, features, link, inside, block


def tokens(page: str) -> list[Token]:
    """The page's tokens; what is text, block, break or inline."""
    out: list[Token] = []
    stack: list[tuple[str, tuple, bool]] = []  # names, with the features and the mark around them
    opened: Counter = Counter()
    features, inside, link, block = (), False, False, 0
    endless: set[str] = set()  # names without an end tag in the rest of the page
    found = _TOKEN.finditer(page)
    while (m := next(found, None)) is not None:
        text = m["text"]
        if text is not None:
            out.append(Token("text", text, features, link, inside, block))
            continue
        name = m["name"]
        if name is None:
            continue
        name, rest = name.lower(), m["rest"]
        if name in RAW:
            closed = m["close"] or (name == "svg" and rest.endswith("/"))
            end = None if closed or name in endless else _END[name].search(page, m.end())
            if end:
                found = _TOKEN.finditer(page, end.end())
            elif not closed:
                endless.add(name)
            continue
        what = "block" if name in BLOCK else "break" if name in BREAK else "inline"
        block += what == "block"
        if m["close"]:
            link = link and name != "a"
            if opened[name]:
                while True:
                    own, features, inside = stack.pop()
                    opened[own] -= 1
                    if own == name:
                        break
        elif name not in VOID and not (name == "math" and rest.endswith("/")):
            if name in ENDED_BY_ITSELF and stack and stack[-1][0] == name:
                _, features, inside = stack.pop()
                opened[name] -= 1
            if name == "a":
                link = True
            elif name in BLOCK or rest or name not in PLAIN:
                stack.append((name, features, inside))
                opened[name] += 1
                own, marks = element(name, rest, inside)
                features, inside = (features, own) if own else features, inside or marks
        out.append(Token(what, name))
    return out


def described(found: list[Token]) -> Iterator[tuple[Token, int, tuple[str, ...], tuple]]:
    """(token, words, features of its block and page, features of its elements as a linked list) of every text with a word."""
    words, linked = Counter(), Counter()
    texts = [(t, len(t.text.split())) for t in found if t.what == "text"]
    for t, n in texts:
        words[t.block] += n
        linked[t.block] += n * t.link
    marked = any(t.inside and n for t, n in texts)
    for t, n in texts:
        if n:
            share = 4 * linked[t.block] // words[t.block]
            place = "in" if t.inside else "beside" if marked else "free"
            long = "" if t.inside else f" words {min(words[t.block].bit_length(), 6)}"
            yield t, n, (f"{place} links {share}", f"{place}{long}"), t.features


def flat(features: tuple) -> list[str]:
    """The features of all elements around a text."""
    out: list[str] = []
    while features:
        features, own = features
        out += own
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the contiguous run with the greatest positive sum, the longest of those; (0, 0) without one."""
    best, total, begin, found = 0.0, 0.0, 0, (0, 0)
    for k, s in enumerate(scores):
        if total < 0:
            total, begin = 0.0, k
        total += s
        if total > 0 and total >= best:
            best, found = total, (begin, k + 1)
    return found


class Weights(dict):
    """Weight of each feature; an unknown part of a name has the weight of all rare ones, anything else unknown has none."""

    def __missing__(self, feature: str) -> float:
        value = self.get(f"{feature.rpartition(' ')[0]} ?", 0.0)
        if len(self) < 1 << 16:
            self[feature] = value
        return value


TAG, OUTSIDE = -0.02, -0.5  # of a tag, and of a text below zero in a marked article, which must not cut the run; of a word below zero elsewhere


def extract(page: str | None, weights: Weights) -> str:
    """The article's blocks, one a line."""
    if not page:
        return ""
    found = tokens(page)
    logit: dict[int, float] = {}
    sums: dict[int, float] = {0: 0.0}

    def total(features: tuple) -> float:
        chain = []
        while features and id(features) not in sums:
            chain.append(features)
            features = features[0]
        value = sums[id(features) if features else 0]
        for f in reversed(chain):
            value += sum(map(weights.__getitem__, f[1]))
            sums[id(f)] = value
        return value

    for t, n, around, elements in described(found):
        logit[id(t)] = weights["bias"] + sum(map(weights.__getitem__, around)) + total(elements)
    score = lambda t: TAG if t.what != "text" else 0.0 if id(t) not in logit else _weight(logit[id(t)], len(t.text.split()), t.inside)
    begin, end = best_run([score(t) for t in found])
    blocks: list[str] = []
    run: list[str] = []
    for t in found[begin:end]:
        if t.what == "text":
            if logit.get(id(t), 1.0) > 0:
                run.append(t.text)
        elif t.what == "break":
            run.append(" ")
        elif t.what == "block" and run:
            blocks.append("".join(run))
            run = []
    blocks.append("".join(run))
    lines = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def _weight(z: float, words: int, inside: bool) -> float:
    return min(z, 2.0) * words if z > 0 else TAG if inside else OUTSIDE * words


# What pages call their parts, in the languages of the corpus, for the layouts of the labelled pages.
BOILERPLATE_NAMES = (
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "popup", "modal", "overlay",
    "sidebar", "side", "aside", "rail", "widget", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "header", "masthead",
    "topbar", "footer", "comment", "comments", "commentlist", "respond", "reply", "replies", "disqus", "discussion", "notice", "notices", "cookie", "cookies", "consent", "gdpr",
    "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "copyright", "legal", "disclaimer", "form", "search", "skip",
    "kommentar", "kommentare", "werbung", "anzeige", "anzeigen", "seitenleiste", "fusszeile", "fußzeile", "kopfzeile", "navigationsleiste", "hinweis", "hinweise", "anmeldung", "suche",
    "commentaire", "commentaires", "publicité", "publicite", "annonce", "annonces", "barre", "navigation", "entête", "avis", "recherche", "partage", "connexion",
    "comentario", "comentarios", "publicidad", "anuncio", "anuncios", "barra", "navegacion", "navegación", "cabecera", "aviso", "avisos", "pie", "buscar", "boletin", "boletín",
)
BOILERPLATE_KINDS = (
    "box", "wrapper", "wrap", "container", "inner", "outer", "list", "item", "items", "area", "block", "top", "left", "right", "bottom", "section", "content", "body", "text", "title", "bar", "panel",
    "slot", "unit", "group", "link", "links", "main", "site", "page", "primary", "secondary", "global", "fixed", "sticky", "small", "large", "thread", "count", "view", "module", "menu", "form", "nav",
)
CONTENT_NAMES = ("article", "content", "main", "post", "entry", "story", "body", "text", "articlebody", "maincontent", "artikel", "inhalt", "beitrag", "contenu", "contenido", "articulo", "artículo", "texte", "texto")
UTILITY_NAMES = ("row", "col", "container", "wrapper", "clearfix", "page", "site", "layout", "grid", "inner", "section", "block", "left", "right", "top")
INNER_NAMES = ("lead", "intro", "quote", "gallery", "chapter", "summary", "byline", "author", "title", "headline", "caption", "date", "paragraph", "image", "table", "list", "item", "note", "box")
NEUTRAL_NAMES = UTILITY_NAMES + INNER_NAMES
OUTSIDE_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "form", "menu", "menubar", "toolbar")


def labelled_pages(seed: int = 7, n: int = 900) -> Iterator[str]:
    """Invented pages; words of the article begin with c, all others with b."""
    rng = random.Random(seed)
    pick, chance = rng.choice, lambda p: rng.random() < p
    prose = lambda kind, a, b: " ".join(kind + pick(("or", "um", "it,", "olo", "et.")) for _ in range(rng.randint(a, b)))
    topic = lambda: "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 10)))

    left: dict[bool, list[list[str]]] = {True: [], False: []}  # names to come, so that all come up equally often in both places

    def styled(parts: list[str]) -> str:
        form = rng.randrange(4)
        if form == 3:
            return parts[0] + "".join(p.title() for p in parts[1:])
        return ("-", "_", "__")[form].join(parts) + (f"-{rng.randint(1, 99)}" if chance(0.1) else "")

    def attributes(parts: list[str]) -> str:
        names = [styled(parts), *(pick(UTILITY_NAMES) for _ in range(rng.randint(0, 2) if chance(0.3) else 0))]
        rng.shuffle(names)
        return f" id={names[0]}" if chance(0.15) and len(names) == 1 else f' class="{" ".join(names)}"'

    def boiler_name(inset: bool) -> list[str]:
        if not left[inset]:
            for name in BOILERPLATE_NAMES:
                left[inset] += [[name]] * 4 + [[name, pick(BOILERPLATE_KINDS)] for _ in range(5)] + [[pick(BOILERPLATE_KINDS), name] for _ in range(3)]
            rng.shuffle(left[inset])
        return left[inset].pop()

    def filling() -> str:
        links = "".join(pick(("<li><a href='/{0}'>{1}</a></li>", "<a href='/{0}'>{1}</a> ")).format(k, prose("b", 1, 3)) for k in range(rng.randint(2, 8)))
        return pick((prose("b", 2, 14), f"<p>{prose('b', 5, 60)}</p>", f"<p>{prose('b', 3, 20)}</p><p>{prose('b', 3, 30)}</p>", f"<ul>{links}</ul>", links, f"<div><h3>{prose('b', 1, 4)}</h3>{links}</div>"))

    def boilerplate(inset: bool) -> str:
        form, inner = rng.randrange(10), filling()
        if form < 7:
            tag = pick(("div", "div", "div", "section", "ul", "p") if form else ("aside", "div"))
            return f"<{tag}{attributes(boiler_name(inset))}>{inner}</{tag}>"
        if form == 7:
            return f'<div{pick((" hidden", " aria-hidden=true"))}>{inner}</div>' if chance(0.3) else f'<div role="{pick(OUTSIDE_ROLES)}">{inner}</div>'
        tag = pick(("nav", "footer", "aside", "form", "dialog", "menu", "button", "search", "fieldset", "footer") if inset else ("nav", "footer", "aside", "form", "header", "dialog", "menu", "header"))
        return f"<{tag}>{inner}</{tag}>"

    def content(marked: bool) -> str:
        out = [f"<h1>{prose('c', 2, 9)}</h1>"] if chance(0.8) else []
        if out and marked and chance(0.3):
            out = [f"<header>{out[0]}<p>{prose('c', 2, 12)}</p></header>"]
        for _ in range(rng.randint(1, 7)):
            p = prose("c", 4, 30)
            items = "".join(f"<li>{prose('c', 1, 12)}" for _ in range(rng.randint(2, 5)))
            linked = "".join(f"<li><a href=/x>{prose('c', 1, 5)}</a></li>" for _ in range(rng.randint(1, 4)))
            part = pick((
                f"<p>{p}</p>", f"<p>{p}", f"<p><b>{prose('c', 1, 5)}</b> {p}<br></p>", f'<p>{p} <a href="/y">{prose("c", 1, 3)}</a> {prose("c", 1, 9)}</p>', f"<h2>{prose('c', 1, 6)}</h2><p>{p}</p>", f"<ul>{items}</ul>",
                f"<blockquote>{p}</blockquote>", f"<figure><img><figcaption>{prose('c', 2, 15)}</figcaption></figure>", f"<table><tr><td>{prose('c', 1, 3)}<td>{prose('c', 1, 3)}</table>", f"<pre>{p}</pre>", f"<div>{p}</div>",
                f"<p><a href=/z>{prose('c', 1, 8)}</a></p>", f"<ul>{linked}</ul><p>{p}</p>",
            ))
            if chance(0.25):
                name = pick(([topic()], [pick(NEUTRAL_NAMES)], [pick(BOILERPLATE_NAMES), topic()], [pick(BOILERPLATE_NAMES), topic()], [topic(), topic()], [pick(CONTENT_NAMES), pick(INNER_NAMES)], [pick(INNER_NAMES)], [pick(CONTENT_NAMES), pick(NEUTRAL_NAMES)]))
                tag = pick(("div", "section", "p", "div"))
                part = f"<{tag}{attributes(name)}>{part}</{tag}>"
            out.append(part)
            if marked and chance(0.5):
                out += [boilerplate(True) for _ in range(rng.randint(1, 6))]
        return "".join(out)

    for _ in range(n):
        if chance(0.15):  # a page of its text alone, or with few words before it
            few = "".join(pick(("<p>{}", "<p>{}</p>", "{}<br>", "<h1>{}</h1>", "<div>{}</div>")).format(prose("c", 1, 9)) for _ in range(rng.randint(1, 4)))
            yield pick(("", "<body>", f"<div{attributes(boiler_name(False))}>{prose('b', 1, 6)}</div>", f"<nav>{prose('b', 1, 4)}</nav>")) + few
            continue
        kind = rng.randrange(5)
        name = [pick(CONTENT_NAMES)] if chance(0.6) else [pick(CONTENT_NAMES), pick((*CONTENT_NAMES, *NEUTRAL_NAMES))]
        opening = ("<article>", "<main>", f"<div{attributes(name)}>", "<div role=main>", pick(("<div>", f"<div{attributes([pick(NEUTRAL_NAMES)])}>")))[kind]
        closing = ("</article>", "</main>", "</div>", "</div>", "</div>")[kind]
        around = lambda: "".join(boilerplate(False) for _ in range(rng.randint(1, 4))) + (f"<div{attributes([topic()]) if chance(0.5) else ''}>{filling()}</div>" if kind in (0, 1, 3) and chance(0.6) else "")
        if chance(0.3):
            around = lambda: "".join(boilerplate(False) for _ in range(rng.randint(3, 8)))
        yield f"<html><body class={pick(BOILERPLATE_NAMES)}><div{attributes([pick(NEUTRAL_NAMES)])}>{around()}{opening}{content(kind < 4)}{closing}{around()}</div></body></html>"


@lru_cache(1)
def fit(epochs: int = 20, rate: float = 1.0, least: int = 3) -> Weights:
    """Weights of the features by logistic regression with step sizes per weight; features of fewer than `least` texts are unknown."""
    rows: list[list[str]] = []
    labels: list[int] = []
    for page in labelled_pages():
        for t, _, around, elements in described(tokens(page)):
            rows.append(["bias", *around, *flat(elements)])
            labels.append(int(t.text.split()[0].startswith("c")))
    seen = Counter(f for row in rows for f in set(row))
    known = lambda f: f if seen[f] >= least else f"{f.rpartition(' ')[0]} ?" if f.startswith(("first ", "last ")) else None
    rows = [[k for f in row if (k := known(f))] for row in rows]
    names = sorted({f for row in rows for f in row})
    number = {f: k for k, f in enumerate(names)}
    ids = [np.array([number[f] for f in row]) for row in rows]
    y, w, squares = np.array(labels, float), np.zeros(len(names)), np.full(len(names), 1e-2)
    rng = np.random.default_rng(1)
    for epoch in range(epochs):
        for batch in np.array_split(rng.permutation(len(ids)), len(ids) // 32 + 1):
            own = np.concatenate([ids[k] for k in batch])
            of = np.repeat(np.arange(len(batch)), [len(ids[k]) for k in batch])
            p = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[own], len(batch)), -30, 30)))
            g = np.bincount(own, (p - y[batch])[of], len(names)) + 1e-5 * w
            squares += g * g
            w -= rate * (1 - epoch / epochs) * g / np.sqrt(squares)
    return Weights(zip(names, w.tolist(), strict=True))


def main_text(pages: DataFrame, *, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page; one narrow Arrow pass, no shuffle."""
    weights = weights or fit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))

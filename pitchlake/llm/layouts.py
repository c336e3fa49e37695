"""Training pages in common layouts, labelled by construction.

The given pages may show only some kinds of boilerplate.  A page made here
has an article (``data-keep="1"``) among menus, headers, sidebars, notices,
adverts, forms and reader comments (``data-keep="0"``) with varying markup
and naming; the words are filler, since the model reads structure only.
A bare page also has text directly in the body: skip links, menus, footer
lines and adverts in inline elements at most, or the article itself.
"""

from __future__ import annotations

from random import Random

# Names authors give to parts of a page.
NAMES = {
    "article": ["article-body", "post-content", "entry-content", "story", "main-content", "content", "post", "article_text", "entry"],
    "menu": ["nav", "main-nav", "menu", "navbar", "site-nav", "breadcrumbs", "topmenu"],
    "header": ["header", "site-header", "masthead", "top-bar", "branding"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright"],
    "sidebar": ["sidebar", "side", "widget-area", "related", "recommended", "aside", "more-stories", "trending"],
    "notice": ["cookie-notice", "consent", "gdpr-banner", "alert", "notice", "popup", "modal", "newsletter", "subscribe-box"],
    "advert": ["ad", "ads", "advert", "banner-ad", "sponsored", "promo", "ad-slot", "advertisement"],
    "form": ["search-form", "login", "signup", "contact-form", "search"],
    "comments": ["comments", "comment-list", "disqus_thread", "responses", "replies", "discussion"],
    "share": ["share", "social", "share-buttons", "social-links"],
}
TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}


def _words(r: Random, least: int, most: int) -> str:
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 9))) for _ in range(r.randint(least, most)))


def _sentences(r: Random, least: int, most: int) -> str:
    return " ".join(_words(r, 3, 16).capitalize() + r.choice("....?!") for _ in range(r.randint(least, most)))


def _links(r: Random, n: int) -> str:
    if r.random() < 0.7:
        return "<ul>" + "".join(f"<li><a href=\"/x\">{_words(r, 1, 3)}</a></li>" for _ in range(n)) + "</ul>"
    return " | ".join(f"<a href=\"/x\">{_words(r, 1, 3)}</a>" for _ in range(n))


def _part(r: Random, kind: str) -> str:
    if kind == "menu":
        inner = _links(r, r.randint(3, 9))
    elif kind == "header":
        inner = f"<{r.choice(['div', 'p', 'h2'])}>{_words(r, 1, 4)}</div>" + (_links(r, 4) if r.random() < 0.5 else "")
    elif kind == "footer":
        inner = f"&copy; {_words(r, 1, 6)} {_links(r, 3) if r.random() < 0.4 else _words(r, 2, 9)}"
    elif kind == "sidebar":
        inner = f"<h3>{_words(r, 1, 3)}</h3>" + (_links(r, r.randint(3, 8)) if r.random() < 0.6 else f"<p>{_sentences(r, 1, 3)}</p>")
    elif kind == "notice":
        inner = f"<p>{_sentences(r, 1, 2)}</p>" if r.random() < 0.6 else _sentences(r, 1, 2)
    elif kind == "advert":
        inner = _sentences(r, 1, 3) if r.random() < 0.6 else f"<p>{_words(r, 3, 14)}</p><a href=\"/x\">{_words(r, 1, 3)}</a>"
    elif kind == "form":
        inner = f"<label>{_words(r, 1, 3)}</label><input><button>{_words(r, 1, 2)}</button><p>{_words(r, 2, 8)}</p>"
    elif kind == "comments":
        inner = f"<h3>{_words(r, 1, 2)}</h3>" + "".join(
            f"<div class=\"comment\"><{r.choice(['p', 'div'])}>{_words(r, 1, 2)}</p><p>{_sentences(r, 1, 4)}</p></div>"
            for _ in range(r.randint(1, 6)))
    else:
        inner = _links(r, r.randint(2, 5))
    tag = TAGS.get(kind, "div") if r.random() < 0.5 else r.choice(["div", "section"] if kind != "form" else ["form"])
    name = "" if tag in TAGS.values() and r.random() < 0.4 else f" {r.choice(['class', 'id'])}=\"{r.choice(NAMES[kind])}\""
    return f"<{tag}{name} data-keep=\"0\">{inner}</{tag}>"


def _shape(r: Random) -> str:
    """A part of an article that is no running text."""
    kind, n = r.choice(["list", "table", "terms", "figure", "linked", "code", "quote", "steps"]), r.randint(2, 8)
    if kind in ("list", "steps"):
        tag = "ol" if kind == "steps" else "ul"
        items = (f"<a href=\"/x\">{_words(r, 1, 4)}</a> {_words(r, 3, 9)}" if r.random() < 0.15 else _words(r, 1, 5) for _ in range(n))
        return f"<{tag}>" + "".join(f"<li>{i}</li>" for i in items) + f"</{tag}>"
    if kind == "table":
        wide = r.randint(1, 4)
        rows = ["".join(f"<{'td' if k else r.choice(['th', 'td'])}>{_words(r, 1, 3)}</td>" for _ in range(wide)) for k in range(n)]
        caption = f"<caption>{_words(r, 1, 6)}</caption>" if r.random() < 0.3 else ""
        return f"<table>{caption}" + "".join(f"<tr>{x}</tr>" for x in rows) + "</table>"
    if kind == "terms":
        return "<dl>" + "".join(f"<dt>{_words(r, 1, 3)}</dt><dd>{_words(r, 1, 12)}</dd>" for _ in range(n)) + "</dl>"
    if kind == "figure":
        return f"<figure><img src=\"x\"><figcaption>{_words(r, 2, 14)}</figcaption></figure>"
    if kind == "linked":
        return f"<p><a href=\"/x\">{_words(r, 3, 14).capitalize()}</a></p>"
    if kind == "code":
        return f"<pre><code>{_words(r, 1, 20)}</code></pre>"
    return f"<blockquote>{_sentences(r, 1, 2)}</blockquote>"


def _shapes(r: Random) -> list[str]:
    """The parts of an article made of such shapes, with text between or without."""
    parts = [_shape(r) if r.random() < 0.7 else f"<p>{_sentences(r, 1, 4)}</p>" for _ in range(r.randint(1, 5))]
    return ([f"<h{r.randint(1, 2)}>{_words(r, 1, 6)}</h1>"] if r.random() < 0.8 else []) + parts


def _article(r: Random, shapes: bool = False) -> str:
    parts = [f"<h1>{_words(r, 2, 12)}</h1>"] if r.random() < 0.8 else []
    if short := r.random() < 0.12:  # an article of a few words is one all the same
        parts = [f"<h1>{_words(r, 1, 3)}</h1>"] * (r.random() < 0.8) + [f"<p>{_words(r, 1, 3)}.</p>"]
    if shapes:
        short, parts = True, _shapes(r)
    for _ in range(0 if short else r.randint(1, 12)):
        x = r.random()
        if x < 0.72:
            parts.append(f"<p>{_sentences(r, 1, 7)}</p>")
        elif x < 0.8:
            parts.append(f"<p>{_words(r, 1, 3)}.</p>")
        elif x < 0.88:
            parts.append(f"<h2>{_words(r, 1, 6)}</h2><p>{_sentences(r, 1, 5)}</p>")
        elif x < 0.93:
            parts.append("<ul>" + "".join(f"<li>{_sentences(r, 1, 2)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif x < 0.97:
            parts.append(f"<blockquote><p>{_sentences(r, 1, 3)}</p></blockquote>")
        else:
            parts.append(f"<pre>{_words(r, 5, 20)}</pre>")
    x = r.random()
    tag = "article" if x < 0.45 else "main" if x < 0.6 else "div"
    name = f" class=\"{r.choice(NAMES['article'])}\"" if tag == "div" and r.random() < 0.8 or r.random() < 0.3 else ""
    inside = [_part(r, k) for k in ("advert", "share", "sidebar", "notice") if r.random() < 0.22]
    for p in inside:
        parts.insert(r.randint(0, len(parts)), p)
    return f"<{tag}{name} data-keep=\"1\">{''.join(parts)}</{tag}>"


def training_page(seed: int) -> str:
    r = Random(seed)
    before = [k for k, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.8), ("advert", 0.5), ("form", 0.25), ("sidebar", 0.2)) if r.random() < p]
    after = [k for k, p in (("share", 0.3), ("comments", 0.4), ("sidebar", 0.4), ("advert", 0.4), ("form", 0.2), ("footer", 0.8), ("notice", 0.2))
             if r.random() < p]
    r.shuffle(before)
    shapes = Random(f"shapes {seed}").random() < 0.35
    body = "".join(_part(r, k) for k in before) + _article(r, shapes) + "".join(_part(r, k) for k in after)
    if r.random() < 0.4:
        body = f"<div class=\"{r.choice(['wrapper', 'container', 'page', 'row'])}\">{body}</div>"
    return f"<html><body>{body}</body></html>"


def _bare(r: Random, kind: str) -> str:
    """Boilerplate directly in the body, in inline elements at most."""
    if kind == "menu":
        inner = " | ".join(f"<a href=\"/x\">{_words(r, 1, 3)}</a>" for _ in range(r.choice([1, 1, 3, 5])))
    elif kind == "footer":
        inner = f"&copy; {_words(r, 1, 8)}"
    else:
        inner = _sentences(r, 1, 2)
    name = f" class=\"{r.choice(NAMES[kind])}\"" if kind == "advert" or r.random() < 0.4 else ""
    return f"<span{name} data-keep=\"0\">{inner}</span>"


def _bare_article(r: Random) -> str:
    parts = [f"<h1 data-keep=\"1\">{_words(r, 2, 12)}</h1>"] if r.random() < 0.6 else []
    for k in range(r.randint(1, 5)):
        text = _sentences(r, 1, 9) if r.random() < 0.7 else _words(r, 4, 14).capitalize() + "."
        if r.random() < 0.3:
            text += f" <a href=\"/x\">{_words(r, 1, 3)}</a> <b>{_words(r, 1, 3)}</b> {_sentences(r, 1, 3)}"
        parts.append(f"<span data-keep=\"1\">{text}</span>" if not k or r.random() < 0.7 else f"<p data-keep=\"1\">{text}</p>")
    return "<hr>".join(parts)


def bare_page(seed: int) -> str:
    r = Random(f"bare {seed}")
    if r.random() < 0.25:
        return f"<html><body>{_bare_article(r)}</body></html>"
    parts = [_part(r, k) for k, p in (("header", 0.4), ("menu", 0.4), ("advert", 0.2)) if r.random() < p]
    parts += [_bare(r, k) for k, p in (("menu", 0.5), ("advert", 0.1)) if r.random() < p]
    r.shuffle(parts)
    parts.append(_bare_article(r) if r.random() < 0.5 else _article(r))
    parts += [_part(r, k) for k, p in (("share", 0.2), ("comments", 0.2), ("sidebar", 0.3), ("footer", 0.3)) if r.random() < p]
    parts += [_bare(r, k) for k, p in (("advert", 0.1), ("menu", 0.2), ("footer", 0.5)) if r.random() < p]
    return f"<html><body>{'<hr>'.join(parts)}</body></html>"

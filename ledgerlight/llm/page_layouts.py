"""Made-up pages with known main texts, to fit the model of ``html_extraction`` on: layouts and names are common ones, words are invented.

Main blocks carry the attribute ``MARK`` = 1, others inside them ``MARK`` = 0; the parser hands it to the fit only, no feature reads it.
"""

from __future__ import annotations

import random

MARK = "data-main"
#: Pages that a model is fitted on.
PAGES = 700

_PARTS = ["la ver ion the un tor es ma den ro ki sul".split(), "ча но ри ве ло ста".split(), "文 章 主 体 新 闻".split(), "é ça ñó ü öß ei".split()]
_NAMES = {
    "main": ["content", "main-content", "post", "article-body", "entry-content", "story", "page", "postText", "text", "body-copy", "article__content", "x1", "c-12", "col-8", "wrap"],
    "menu": ["nav", "menu", "main-nav", "navbar", "topMenu", "breadcrumbs", "site-navigation", "pagination", "tabs"],
    "header": ["header", "site-header", "masthead", "banner", "topbar", "logo"],
    "footer": ["footer", "site-footer", "colophon", "copyright", "bottom", "legal"],
    "side": ["sidebar", "widget", "side", "related-posts", "recommended", "aside", "more-stories", "popular", "tags"],
    "comment": ["comments", "comment-list", "disqus_thread", "replies", "discussion", "commentlist", "reviews", "respond"],
    "advert": ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement", "banner-ad"],
    "notice": ["cookie-notice", "notice", "alert", "consent", "gdpr-banner", "modal", "popup", "message-bar", "disclaimer"],
    "share": ["share", "social-links", "sharing", "follow-us"],
    "form": ["newsletter", "search-form", "login", "subscribe", "signup"],
}


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng, self.parts = rng, rng.choice(_PARTS)

    def words(self, least: int, most: int) -> str:
        rng = self.rng
        count = rng.randint(least, max(least, int(most ** rng.random())))
        out = ["".join(rng.choice(self.parts) for _ in range(rng.randint(1, 4))) for _ in range(count)]
        noise = rng.random() < 0.1
        for i in range(len(out)):
            if rng.random() < 0.12:
                out[i] += rng.choice([",", ".", ".", ":", ";"])
            if noise:
                out[i] += rng.choice(["###", "***", "&amp;", "%%"])
        text = " ".join(out).capitalize()
        if self.rng.random() < 0.15:
            text = text.replace(" ", rng.choice([" <b>", " <em>", " <span>"]), 1) + "</b>" * (rng.random() < 0.5)
        return text + rng.choice([".", ".", ".", "", "!", "?"])

    def named(self, kind: str, plain: bool = False) -> str:
        rng = self.rng
        if plain or rng.random() < 0.12:
            return ""
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(_NAMES[kind])}{rng.choice(["", "", " box", " clearfix", " 7"])}"'

    def links(self, count: int) -> str:
        items = "".join(f'<li><a href="/x">{self.words(1, 4)}</a>{self.rng.choice(["</li>", "</li>", ""])}' for _ in range(count))
        form = self.rng.random()
        if form < 0.6:
            return f"<ul>{items}</ul>"
        return " | ".join(f'<a href="/x">{self.words(1, 3)}</a>' for _ in range(count))

    def boiler(self, kind: str, inside: bool = False) -> str:
        """An element that isn't part of the main text."""
        rng, of = self.rng, self.named(kind)
        off = f' {MARK}="0"' if inside else ""
        wrap = lambda tag, body, named=True: f"<{tag}{of if named else ''}{off}>{body}</{tag}>"
        div = rng.choice(["div", "div", "section", "p"]) if of else None
        if kind == "menu":
            return wrap(rng.choice(["nav", "nav", div or "nav"]).replace("p", "div"), self.links(rng.randint(2, 9)), rng.random() < 0.6)
        if kind == "header":
            return wrap(rng.choice(["header", "header", div or "header"]).replace("p", "div"), rng.choice([self.words(1, 8), f"<a href='/'>{self.words(1, 3)}</a>", f"<h1>{self.words(1, 4)}</h1>{self.links(4)}", f"<p>{self.words(2, 15)}</p>"]), rng.random() < 0.6)
        if kind == "footer":
            body = rng.choice(["&copy; ", "&copy; ", "", "Copyright "]) + rng.choice(["a.example.com &middot; ", "2020 ", ""]) + self.words(2, 25)
            return wrap(rng.choice(["footer", "footer", div or "footer"]), rng.choice([body, body, f"<p>{body}</p>{self.links(4)}".replace("<p>", "<div>").replace("</p>", "</div>")]), rng.random() < 0.5)
        if kind == "side":
            body = rng.choice([f"<h3>{self.words(1, 5)}</h3>{self.links(rng.randint(2, 7))}", f"<p>{self.words(3, 40)}</p>", self.words(3, 25), self.links(5)])
            return wrap(rng.choice(["aside", "aside", div or "aside"]).replace("p", "div"), body, rng.random() < 0.6)
        if kind == "comment":
            each = [f"<p>{self.words(2, 60)}</p>" if rng.random() < 0.7 else self.words(2, 60) for _ in range(rng.randint(1, 6))]
            tag = rng.choice(["div", "li", "article"])
            body = f"<h3>{self.words(1, 3)}</h3>" * (rng.random() < 0.5) + "".join(f"<{tag}{rng.choice([' class=comment', ' class=comment', ' class=reply', ''])}>{x}</{tag}>" for x in each)
            return self._comments(body, off)
        if kind == "form":
            fields = rng.choice(["<input name=a>", "<label>" + self.words(1, 4) + "</label><input>", f"<select><option>{self.words(1, 2)}</select>"])
            return wrap("form", f"{rng.choice(['', '<p>' + self.words(2, 15) + '</p>'])}{fields}<button>{self.words(1, 2)}</button>", rng.random() < 0.6)
        body = rng.choice([self.words(2, 30), f"<p>{self.words(2, 40)}</p>", f"<a href='/x'>{self.words(2, 9)}</a>", f"<p>{self.words(2, 20)}</p><p>{self.words(2, 20)}</p>"])
        if not of:
            of = f' class="{rng.choice(_NAMES[kind])}"'
        tag = rng.choice(["div", "div", "section", "aside", "p"])
        return f"<{tag}{of}{off}>{self.words(2, 30) if tag == 'p' else body}</{tag}>"

    def _comments(self, body: str, off: str) -> str:
        tag = self.rng.choice(["section", "div", "div"])
        return f'<{tag} {self.rng.choice(["class", "id"])}="{self.rng.choice(_NAMES["comment"])}"{off}>{body}</{tag}>'

    def article(self) -> str:
        """Main blocks, each with the mark, and a few others among them."""
        rng, on = self.rng, f' {MARK}="1"'
        out = []
        if rng.random() < 0.85:
            head = f"<h1{on}>{self.words(1, 20)}</h1>"
            out.append(f"<header>{head}</header>" if rng.random() < 0.2 else head)
        loose = rng.random() < 0.35
        for _ in range(max(0, int(18 ** rng.random()) - (rng.random() < 0.1))):
            kind = rng.random()
            if kind < 0.72:
                text = self.words(1, 160)
                if loose and rng.random() < 0.3:
                    out.append(f"<p{on}><b>{text}<br>")
                else:
                    out.append(f"<p{on}>{text}{rng.choice(['</p>', '</p>', '</p>', '']) if not loose or rng.random() < 0.5 else ''}")
            elif kind < 0.8:
                out.append(f"<h{rng.randint(2, 4)}{on}>{self.words(1, 9)}</h2>")
            elif kind < 0.87:
                out.append("<{0}{1}>{2}</{0}>".format(rng.choice(["ul", "ol"]), on, "".join(f"<li>{self.words(1, 30)}</li>" for _ in range(rng.randint(1, 6)))))
            elif kind < 0.91:
                out.append(f"<blockquote{on}><p>{self.words(3, 50)}</p></blockquote>")
            elif kind < 0.94:
                out.append(f"<pre{on}>{self.words(3, 30)}</pre>")
            elif kind < 0.97:
                out.append(f"<figure{on}><img src=a.png><figcaption>{self.words(2, 15)}</figcaption></figure>")
            else:
                out.append(f"<table{on}><tr><th>{self.words(1, 3)}<th>{self.words(1, 3)}<tr><td>{self.words(1, 6)}<td>{self.words(1, 6)}</table>")
            if rng.random() < 0.1:
                out.append(self.boiler(rng.choice(["advert", "advert", "share", "form", "side", "notice"])))
        if rng.random() < 0.12:
            out.append(self.boiler("comment"))
        return "".join(out)


def layout(seed: int) -> str:
    """A page; the same for the same seed."""
    rng = random.Random(seed)
    w = _Writer(rng)
    style = rng.random()
    body = w.article()
    if style < 0.4:
        main = f"<article{w.named('main', rng.random() < 0.6)}>{body}</article>"
        main = f"<main>{main}</main>" if rng.random() < 0.3 else main
    elif style < 0.55:
        main = f"<main{w.named('main', rng.random() < 0.5)}>{body}</main>"
    elif style < 0.85:
        main = f"<div{w.named('main')}>{body}</div>"
        main = f"<div{w.named('main', rng.random() < 0.5)}>{main}</div>" if rng.random() < 0.3 else main
    elif style < 0.93:
        main = f"<table><tr><td>{w.links(5)}<td>{body}</table>"
    else:
        main = body
    some = lambda kinds, share: [w.boiler(kind) for kind in kinds if rng.random() < share]
    before = some(["notice"], 0.25) + some(["header"], 0.5) + some(["menu"], 0.8) + some(["advert"], 0.45) + some(["side"], 0.2) + some(["form"], 0.15)
    after = some(["share"], 0.25) + some(["comment"], 0.35) + some(["side"], 0.4) + some(["advert"], 0.2) + some(["form"], 0.2) + some(["notice"], 0.15) + some(["menu"], 0.15)
    if rng.random() < 0.15:
        rng.shuffle(before)
    parts = "".join(before) + main + "".join(after) + "".join(some(["footer"], 0.85))
    if rng.random() < 0.3:
        parts = f'<div class="{rng.choice(["wrapper", "container", "page", "site", "outer"])}">{parts}</div>'
    head = f"<!DOCTYPE html><html><head><title>{w.words(1, 9)}</title><style>p{{}}</style><script>var a='</p>';</script></head>" if rng.random() < 0.9 else ""
    return f"{head}<body>{parts}{rng.choice(['</body></html>', ''])}"

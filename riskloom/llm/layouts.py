"""Made pages with known main text, from which the block labeller learns.

No table says which block of a page is its article, so pages are put together
from an article and the things around it, in many markups: with and without
the language's own elements (article, nav, aside, ...), under class names in
use, with unclosed paragraphs, wrappers, notices, forms and comments in
and around the article.  Their prose is drawn from words of the given pages,
the same for article and surroundings, so that what is learned is the structure
and the phrases of the surroundings, not the subject.
"""

from __future__ import annotations

import numpy as np

#: Words of each kind of surrounding, as class names and ids and as short phrases shown to readers.
CLASSES = {
    "nav": "nav navbar menu main-menu navigation top-nav site-nav nav-links breadcrumb breadcrumbs pagination topbar toc",
    "header": "header site-header page-header masthead top-bar branding banner-top head",
    "footer": "footer site-footer page-footer copyright colophon bottom legal foot-links",
    "side": "sidebar side widget widget-area related related-posts right-col aside secondary popular recommended more-stories trending",
    "notice": "notice cookie cookie-notice cookie-banner consent gdpr alert banner newsletter popup modal subscribe paywall message announcement",
    "ad": "ad ads advert advertisement ad-slot adsbygoogle sponsored sponsor promo promotion google-ad ad-container",
    "form": "form search search-form login signup contact-form subscribe-form newsletter-form",
    "comments": "comments comment-list comment commentlist responses discussion replies reader-comments user-comments disqus thread feedback",
    "share": "share social share-buttons social-links tags meta tools",
    "body": "article content post entry story post-content entry-content article-body main-content text body page-content post-body "
            "story-body article-text main copy prose",
    "plain": "wrapper container page site row inner outer wrap layout grid box col section block",
}
PHRASES = {
    "nav": "Home|About|About us|Contact|News|Sports|Blog|Products|Services|Login|Sign in|Archive|Next|Previous|Menu|Skip to content|Help|World|Business",
    "header": "Welcome to our site|The daily news|Search|Sign in|Menu|Latest news and stories",
    "footer": "© 2021 All rights reserved.|Copyright 2019 Example Inc.|Privacy policy|Terms of service|Contact us|Powered by WordPress|Imprint|"
              "Site map|Follow us on Twitter|About us|All rights reserved",
    "side": "Related articles|Most read|Popular posts|Recent posts|Categories|Archives|You may also like|Read more|Trending now|Recommended for you|Tags",
    "notice": "We use cookies to improve your experience.|Accept all cookies|By using this site you agree to our cookie policy.|"
              "Subscribe to our newsletter|Sign up for free|Please enable JavaScript.|This site uses cookies.|Accept|Got it|Breaking news alert",
    "ad": "Advertisement|Sponsored|Buy now|Sponsored content|Click here|Special offer: 50% off today|Learn more|Shop now|Ad|Limited offer",
    "form": "Name|Email|Password|Submit|Send|Your email address|Log in|Search|Subscribe|Message|Remember me|Sign up now",
    "comments": "Comments|3 comments|Leave a reply|Reply|Post a comment|Anonymous says:|2 days ago|Log in to comment|Report|Like|Comments (12)",
    "share": "Share|Tweet|Share on Facebook|Share this article|Email|Print|Tags: news|Posted in general",
}
_OWN = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}


class Maker:
    """Pages as (html, labels of the blocks in order): 1 main text, 0 surroundings."""

    def __init__(self, words: list[str], seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.words = words or ["".join(self.rng.choice(list("abcdefghilmnoprstu"), self.rng.integers(2, 9))) for _ in range(400)]
        self.html: list[str] = []
        self.labels: list[int] = []

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def prose(self, most: int = 90, least: int = 1) -> str:
        n = int(np.exp(self.rng.uniform(np.log(least), np.log(most + 1))))
        chosen = [self.words[i] for i in self.rng.integers(len(self.words), size=max(1, n))]
        for i in np.flatnonzero(self.rng.random(len(chosen)) < 0.08):
            chosen[i] += self.pick([",", ".", ".", "!", "?"])
        return " ".join(chosen).capitalize() + ("." if self.chance(0.85) else "")

    def put(self, text: str, label: int) -> None:
        self.html.append(text.replace("&", "&amp;").replace("<", "&lt;"))
        self.labels.append(label)

    def raw(self, *parts: str) -> None:
        self.html.extend(parts)

    def attributes(self, kind: str) -> str:
        if self.masked and kind not in ("ad", "comments", "side"):
            return f' class="{"".join(self.rng.choice(list("abcdefghijkxyz"), 6))}"' if self.chance(0.6) else ""
        name = self.pick(CLASSES[kind].split())
        more = f" {self.pick(CLASSES['plain'].split())}" if self.chance(0.15) else ""
        return f' {self.pick(["class", "class", "id"])}="{name}{more}"'

    def box(self, kind: str, fill, named: float = 0.6) -> None:
        """An element of this kind around what ``fill`` puts: the language's own where there is one, or a div or section by its name."""
        own = _OWN.get(kind)
        if own and self.chance(0.55):
            tag, names = own, self.attributes(kind) if self.chance(named) else ""
        else:
            tag, names = self.pick(["div", "div", "section"]), self.attributes(kind)
        self.raw(f"<{tag}{names}>")
        if self.chance(0.2):
            self.raw("<div>")
            fill()
            self.raw("</div>")
        else:
            fill()
        self.raw(f"</{tag}>")

    def links(self, kind: str, most: int = 9) -> None:
        label = lambda: self.pick(PHRASES[kind].split("|")) if self.chance(0.4) else self.prose(6).rstrip(".")
        n = int(self.rng.integers(2, most))
        if self.chance(0.75):
            self.raw("<ul>")
            for _ in range(n):
                self.raw('<li><a href="/x">')
                self.put(label(), 0)
                self.raw("</a></li>")
            self.raw("</ul>")
        else:
            self.raw("<div>")
            self.put("", 0)
            for _ in range(n):
                self.raw(f'<a href="/x">{label()}</a>', self.pick([" ", " | ", "\n"]))
            self.raw("</div>")

    def lines(self, kind: str, most: int = 3, prose: float = 0.5) -> None:
        for _ in range(int(self.rng.integers(1, most + 1))):
            tag = self.pick(["p", "div", "span", "h3", "p"])
            self.raw(f"<{tag}>")
            self.put(self.prose(40, 2) if self.chance(prose) else self.pick(PHRASES[kind].split("|")), 0)
            self.raw(f"</{tag}>" + ("<hr>" if tag == "span" else ""))

    def bare(self, kind: str) -> None:
        """One text directly in the element."""
        self.put(self.prose(30, 3) if self.chance(0.6) else self.pick(PHRASES[kind].split("|")), 0)

    def nav(self) -> None:
        self.box("nav", lambda: self.links("nav", 12))

    def header(self) -> None:
        def fill():
            tag = self.pick(["h1", "h2", "div", "p", "a"])
            self.raw(f"<{tag}>")
            self.put(self.prose(5).rstrip("."), 0)
            self.raw(f"</{tag}><hr>")
            if self.chance(0.4):
                self.lines("header", 1)
            if self.chance(0.5):
                self.nav()
        self.box("header", fill)

    def footer(self) -> None:
        def fill():
            if self.chance(0.4):
                self.links("footer", 6)
                self.lines("footer", 2, 0.4)
            elif self.chance(0.5):
                self.put(f"© {self.prose(25)}", 0)
            else:
                self.lines("footer", 2, 0.4)
        self.box("footer", fill)

    def side(self) -> None:
        def fill():
            if self.chance(0.6):
                tag = self.pick(["h2", "h3", "h4", "p"])
                self.raw(f"<{tag}>")
                self.put(self.pick(PHRASES["side"].split("|")) if self.chance(0.6) else self.prose(5), 0)
                self.raw(f"</{tag}>")
            if self.chance(0.6):
                self.links("side", 7)
            else:
                self.lines("side", 3, 0.8)
        self.box("side", fill)

    def notice(self) -> None:
        def fill():
            self.bare("notice") if self.chance(0.4) else self.lines("notice", 2, 0.4)
            if self.chance(0.3):
                self.raw("<button>")
                self.put(self.pick(PHRASES["notice"].split("|")), 0)
                self.raw("</button>")
        self.box("notice", fill)

    def ad(self) -> None:
        self.box("ad", lambda: self.bare("ad") if self.chance(0.6) else self.lines("ad", 2, 0.6))

    def form(self) -> None:
        def fill():
            if self.chance(0.3):
                self.lines("form", 1, 0.6)
            for _ in range(int(self.rng.integers(1, 4))):
                self.raw("<div>")
                self.put("", 0)
                self.raw(f'<label>{self.pick(PHRASES["form"].split("|"))}</label><input type="text"></div>')
            self.raw("<button>")
            self.put(self.pick(PHRASES["form"].split("|")), 0)
            self.raw("</button>")
        self.raw("<form>" if (plain := self.chance(0.7)) else "")
        fill() if plain else self.box("form", fill)
        self.raw("</form>" if plain else "")

    def share(self) -> None:
        self.box("share", lambda: self.links("share", 5))

    def comments(self) -> None:
        def one():
            if self.chance(0.6):
                self.raw(self.pick(["<b>", "<span>", "<cite>"]))
                self.put(self.prose(3).rstrip("."), 0)
                self.raw("<hr>")
            self.raw("<p>")
            self.put(self.prose(50, 2), 0)
            self.raw("</p>")

        def fill():
            if self.chance(0.6):
                self.raw("<h3>")
                self.put(self.pick(PHRASES["comments"].split("|")), 0)
                self.raw("</h3>")
            tag, names = self.pick([("li", ""), ("div", ' class="comment"'), ("article", ' class="comment"'), ("div", "")])
            for _ in range(int(self.rng.integers(1, 5))):
                self.raw(f"<{tag}{names}>")
                one()
                self.raw(f"</{tag}>")
        self.box("comments", fill)

    def paragraph(self, style: str, label: int = 1) -> None:
        text = self.prose(120)
        if style == "open":
            self.raw("<p>")
            self.put(text, label)
        elif style == "bold":
            self.raw("<p><b>")
            self.put(text, label)
            self.raw("<br>")
        else:
            tag = "div" if style == "div" else "p"
            self.raw(f"<{tag}>")
            self.put(text, label)
            if self.chance(0.12):
                self.raw(f' <a href="/y">{self.prose(3)}</a> {self.prose(8)}')
            self.raw(f"</{tag}>\n")

    def article(self) -> None:
        kind = self.rng.random()
        tags: list[str] = []
        if kind < 0.45:
            tags = [f"article{self.attributes('body') if self.chance(0.4) else ''}"]
        elif kind < 0.55:
            tags = ["main"]
        elif kind < 0.9:
            tags = [f"{self.pick(['div', 'div', 'section', 'td', 'main'])}{self.attributes('body')}"]
        elif kind < 0.94:
            tags = ["div"]
        if tags and self.chance(0.25):
            tags.insert(0, "main")
        if tags and self.chance(0.3):
            tags.append(f"div{self.attributes('body')}")
        table = bool(tags) and tags[0].startswith("td")
        self.raw("<table><tr>" if table else "", *[f"<{t}>" for t in tags])
        if self.chance(0.8):
            inner = self.chance(0.25)
            name = self.pick(["", "", *(f' class="{x}-header"' for x in ("entry", "post", "article"))])
            self.raw(f"<header{name}>" if inner else "", h := self.pick(["<h1>", "<h1>", "<h2>"]))
            self.put(self.prose(12).rstrip("."), 1)
            self.raw(h.replace("<", "</"), "</header>" if inner else "")
        style = self.pick(["p", "p", "p", "mixed", "open", "div"])
        inside = [f for f, p in ((self.ad, .15), (self.notice, .06), (self.form, .06), (self.side, .1), (self.share, .08)) if self.chance(p)]
        n = int(self.rng.integers(1, 14))
        at = set(self.rng.integers(0, n, len(inside)).tolist())
        for i in range(n):
            self.paragraph(self.pick(["p", "p", "open", "bold"]) if style == "mixed" else style)
            if i in at and inside:
                self.raw("</p>" if style in ("open", "mixed") else "")
                inside.pop()()
            elif self.chance(0.12):
                tag = self.pick(["h2", "h3", "blockquote", "pre", "ul", "ol", "figure", "table"])
                self.raw(f"<{tag}>")
                for _ in range(int(self.rng.integers(1, 5)) if tag in ("ul", "ol", "table") else 1):
                    around = {"ul": "li", "ol": "li", "figure": "figcaption"}.get(tag)
                    self.raw(f"<{around}>" if around else "<tr><td>" if tag == "table" else "")
                    self.put(self.prose(20), 1)
                    self.raw(f"</{around}>" if around else "</td></tr>" if tag == "table" else "")
                self.raw(f"</{tag}>")
        for f in inside:
            f()
        if self.chance(0.06):
            self.comments()
        for t in reversed(tags):
            self.raw(f"</{t.split()[0]}>")
        self.raw("</tr></table>" if table else "")

    def page(self) -> tuple[str, list[int]]:
        self.html, self.labels = [], []
        self.masked = self.chance(0.15)
        names = f' class="{self.pick(CLASSES["plain"].split())} has-{self.pick(CLASSES["side"].split())}"' if self.chance(0.15) else ""
        self.raw('<!DOCTYPE html><html><head><meta charset="utf-8"><title>t</title><style>p{}</style></head>', f"<body{names}>")
        wraps = int(self.rng.integers(0, 3)) if self.chance(0.4) else 0
        for _ in range(wraps):
            self.raw(f"<div{self.attributes('plain')}>")
        for f, p in ((self.notice, .15), (self.header, .4), (self.nav, .6), (self.ad, .4), (self.side, .15), (self.form, .08), (self.share, .05)):
            if self.chance(p):
                f()
        if self.chance(0.97):
            self.article()
        for f, p in ((self.share, .12), (self.ad, .15), (self.comments, .35), (self.side, .3), (self.form, .15), (self.notice, .15), (self.nav, .08),
                     (self.footer, .75), (self.notice, .08)):
            if self.chance(p):
                f()
        self.raw("</div>" * wraps)
        if self.chance(0.9):
            self.raw("</body></html>")
        return "".join(self.html), self.labels

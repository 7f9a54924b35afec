"""Labelled pages to train on: layouts in common use, with made-up text.

Each page comes with the texts of its blocks that are main text. All is drawn
from a seed, so that a model is the same wherever it is trained.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

# Names that sites give to parts of a page (fixed values).
MAIN = ["article", "content", "post", "entry", "story", "body", "text", "main", "page", "blog", "news", "detail", "prose"]
MENU = ["menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "toc", "tabs", "links", "pagination", "pager"]
HEAD = ["header", "masthead", "branding", "logo", "banner", "top", "site", "hero"]
FOOT = ["footer", "copyright", "legal", "bottom", "colophon", "imprint", "site"]
SIDE = ["sidebar", "aside", "widget", "rail", "column", "secondary", "complementary", "related", "recommended", "popular", "trending", "more"]
ADS = ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "banner", "adsense", "teaser"]
NOTICES = ["notice", "cookie", "cookies", "consent", "gdpr", "alert", "warning", "popup", "modal", "overlay", "message", "paywall", "disclaimer", "hidden"]
COMMENTS = ["comments", "comment", "commentlist", "replies", "reply", "respond", "discussion", "reader", "feedback", "disqus"]
SHARE = ["share", "social", "follow", "tags", "meta", "author", "byline", "buttons", "tools", "rating"]
FORMS = ["form", "search", "login", "signup", "subscribe", "newsletter", "contact"]


class _Page:
    def __init__(self, draw: random.Random):
        self.draw = draw
        self.kept: set[str] = set()
        self.all: set[str] = set()
        self.paragraph = draw.choice(["p"] * 9 + ["div"])
        self.letters = draw.choice(["etaoinshrdlu", "enisratdhulcg", "eaosrnidlctu", "esaitnrulodcé", "оеаинтсрвлкм"])

    def words(self, low: int, high: int, main: bool, stop: str | None = None) -> str:
        if stop is None:
            stop = self.draw.choice([".", ".", ".", ".", "!", "?", "", " |", "%"])
        while True:
            n = self.draw.randint(low, high)
            text = " ".join("".join(self.draw.choices(self.letters, k=self.draw.randint(2, 9))) for _ in range(n))
            text = text.capitalize() + stop
            if text not in self.all:
                break
        self.all.add(text)
        if main:
            self.kept.add(text)
        return text

    def named(self, tag: str, names: list[str], inner: str, sure: bool = False) -> str:
        kind = self.draw.choice(["class", "class", "class", "id"])
        if not sure and self.draw.random() < 0.25:
            return f"<{tag}>{inner}</{tag}>"
        name = self.draw.choice(names)
        second = self.draw.choice(["", "", "", " box", " wrapper", " clearfix", "-container", " " + self.draw.choice(names)])
        return f'<{tag} {kind}="{name}{second}">{inner}</{tag}>'

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/x">{self.words(1, 3, False, "")}</a></li>' for _ in range(n))

    def prose(self, n: int, main: bool) -> str:
        out = []
        for _ in range(n):
            kind = self.draw.random()
            if kind < 0.06:
                out.append(f"<h2>{self.words(1, 8, main, '')}</h2>")
            elif kind < 0.1:
                out.append("<ul>" + "".join(f"<li>{self.words(1, 14, main)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.13:
                out.append(f"<blockquote><p>{self.words(4, 30, main)}</p></blockquote>")
            elif kind < 0.15:
                out.append(f"<pre>{self.words(3, 12, main, ';')}</pre>")
            elif kind < 0.18:
                cells = "".join(f"<td>{self.words(1, 4, main, '')}</td>" for _ in range(3))
                out.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.24:
                out.append(f"<p><b>{self.words(1, 20, main)}<br>")
            elif kind < 0.3:
                out.append(f"<{self.paragraph}>{self.words(1, 2, main)}</{self.paragraph}>")
            elif kind < 0.36:
                text = self.words(12, 40, main)
                cut = text.index(" ", len(text) // 2)
                out.append(f'<p>{text[:cut]}<a href="/y">{text[cut:]}</a></p>')
            else:
                out.append(f"<{self.paragraph}>{self.words(3, 90, main)}</{self.paragraph}>")
        return "".join(out)

    def aside(self) -> str:
        """A part that is no main text."""
        d = self.draw
        kind = d.randrange(9)
        if kind == 0:
            return self.named(d.choice(["nav", "div", "nav"]), MENU, f"<ul>{self.links(d.randint(2, 8))}</ul>", False) if d.random() < 0.6 else self.named("div", MENU, f"<ul>{self.links(d.randint(2, 8))}</ul>", True)
        if kind == 1:
            return self.named("div", ADS, self.words(1, 25, False), True)
        if kind == 2:
            return self.named(d.choice(["div", "section", "p"]), NOTICES, self.words(4, 30, False), True)
        if kind == 3:
            return self.named("aside", SIDE, f"<h3>{self.words(1, 4, False, '')}</h3>{self.prose(d.randint(1, 3), False)}")
        if kind == 4:
            return self.named("div", SIDE, f"<h3>{self.words(1, 4, False, '')}</h3><ul>{self.links(d.randint(2, 6))}</ul>{self.prose(d.randint(0, 2), False)}", True)
        if kind == 5:
            one = lambda: self.named(d.choice(["div", "li", "article", "p"]), COMMENTS, self.prose(d.randint(1, 2), False), True)
            return self.named(d.choice(["section", "div", "ol"]), COMMENTS, f"<h3>{self.words(1, 3, False, '')}</h3>" + "".join(one() for _ in range(d.randint(1, 4))), True)
        if kind == 6:
            return self.named("div", SHARE, self.words(1, 5, False, ""), True)
        if kind == 7:
            return self.named("form", FORMS, f"<label>{self.words(1, 4, False, '')}</label><input name='q'><p>{self.words(2, 12, False)}</p><button>{self.words(1, 2, False, '')}</button>")
        return self.named("div", FORMS + MENU, f"<p>{self.words(1, 12, False)}</p>", True)

    def asides(self, most: int) -> str:
        return "".join(self.aside() for _ in range(self.draw.randint(0, most)))

    def page(self) -> str:
        d = self.draw
        title = f"<h1>{self.words(1, 12, True, '')}</h1>"
        inner = title + self.prose(d.randint(1, 9), True)
        if d.random() < 0.3:
            inner += self.aside()
        if d.random() < 0.2:
            inner += self.prose(d.randint(1, 3), True)
        kind = d.random()
        if kind < 0.5:
            main = self.named("article", MAIN, inner)
        elif kind < 0.65:
            main = self.named("main", MAIN, inner)
        elif kind < 0.9:
            main = self.named("div", MAIN, inner, True)
        else:
            main = inner
        if d.random() < 0.3:
            main = self.named(d.choice(["main", "div", "section"]), MAIN, main + self.asides(1))
        head = self.named("header", HEAD, f"<p>{self.words(1, 8, False, d.choice(['', '.']))}</p>" + self.asides(1)) if d.random() < 0.5 else ""
        if d.random() < 0.2:
            head += self.named("div", HEAD, self.words(1, 6, False, ""), True)
        mark = d.choice(["&copy; ", "Copyright ", ""])
        foot_text = self.words(2, 16, False)
        self.all.add(foot_text)
        foot = self.named(d.choice(["footer", "footer", "div"]), FOOT, mark + foot_text, True) if d.random() < 0.5 else f"<footer>{mark}{foot_text}</footer>"
        nav = f"<nav><ul>{self.links(d.randint(2, 8))}</ul></nav>" if d.random() < 0.6 else ""
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(2, 6, False)}</title></head><body>"
            + head + nav + self.asides(2) + main + self.asides(3) + foot + d.choice(["</body></html>", ""])
        )


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, frozenset[str]]]:
    """``n`` pages and the block texts of each that are its main text."""
    draw = random.Random(seed)
    for _ in range(n):
        page = _Page(draw)
        source = page.page()
        yield source, frozenset(page.kept)

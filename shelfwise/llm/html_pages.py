"""Labelled training pages, put together by rule: 1 marks the blocks of the article."""

from __future__ import annotations

import numpy as np

# Usual names in the markup of pages, by what they hold.
NAMES = {
    "menu": "menu nav navigation navbar topnav mainmenu breadcrumb breadcrumbs pagination pager tabs toc links",
    "header": "header masthead topbar logo branding tagline siteheader pageheader",
    "footer": "footer copyright colophon legal bottom sitefooter imprint",
    "side": "sidebar side aside widget related recommended popular trending tags archive rail more also",
    "notice": "notice cookie cookies consent gdpr banner alert warning message popup modal paywall subscribe newsletter privacy",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsbygoogle teaser outbrain taboola",
    "form": "form login search signup contact register poll vote",
    "comment": "comments comment commentlist reply replies responses discussion disqus respond reader",
    "share": "share social follow print email",
}
MAIN = "content main article post entry body text story page container wrapper section column"
_SYLLABLES = "ta re mo li san ver ing er ent el ó ñar eau ßen über ción qu the on st le an"


class _Writer:
    def __init__(self, rng: np.random.Generator):
        self.rng, self.html, self.labels = rng, [], []

    def pick(self, words: str) -> str:
        words = words.split()
        return words[int(self.rng.integers(len(words)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, n: int) -> str:
        return " ".join("".join(self.pick(_SYLLABLES) for _ in range(int(self.rng.integers(1, 4)))) for _ in range(n))

    def sentences(self, n: int) -> str:
        return " ".join(self.words(int(self.rng.integers(1, 18))).capitalize() + "." for _ in range(n))

    def put(self, text: str, label: int | None = None) -> None:
        self.html.append(text)
        if label is not None:
            self.labels.append(label)

    def wrap(self, kind: str, inner, tags: str = "div section ul table", semantic: str = "") -> None:
        """An element named after its kind by tag, class or id, around what ``inner`` writes."""
        if semantic and self.chance(0.5):
            tag, mark = self.pick(semantic), ""
        else:
            tag = self.pick(tags)
            name = self.pick(NAMES[kind])
            if self.chance(0.3):
                name = f"{self.pick('site page block js top inner box')}{self.pick('- _')}{name}"
            mark = f' {self.pick("class id")}="{name}"'
        self.put(f"<{tag}{mark}>")
        inner()
        self.put(f"</{tag}>")

    def links(self, n: int) -> None:
        for _ in range(n):
            self.put(f'<li><a href="/{self.words(1)}">{self.words(int(self.rng.integers(1, 3)))}</a></li>', 0)

    def plain(self, n: int) -> None:
        """Running text like an article's, in a part that is none."""
        for _ in range(n):
            tag = self.pick("p p div h3 span")
            text = self.sentences(int(self.rng.integers(1, 5)))
            if tag == "span":
                self.put(f"<div><span>{text}</span></div>", 0)
            else:
                self.put(f"<{tag}>{text}</{tag}>", 0)

    def bare(self) -> None:
        self.put(self.sentences(int(self.rng.integers(1, 3))), 0)

    def foot(self) -> None:
        self.put(f"&copy; {self.words(1)}.example.com &middot; {self.sentences(int(self.rng.integers(1, 4)))}", 0)

    def form(self) -> None:
        self.put(f"<form><label>{self.words(2)}</label><input name=q><div>", 0)
        self.put(f"<button>{self.words(1)}</button></div></form>", 0)

    def aside(self) -> None:
        """One part that is not the article."""
        kind = self.pick("side notice advert form comment share menu")
        if kind == "form" and self.chance(0.6):
            self.form()
        elif kind == "form":
            self.wrap("form", lambda: self.plain(1))
        elif kind == "menu":
            self.wrap("menu", lambda: self.links(3), "div ul", "nav menu")
        elif kind == "comment":
            self.wrap("comment", lambda: self.plain(int(self.rng.integers(1, 5))), "div section ul ol article")
        elif kind == "side":
            self.wrap("side", lambda: self.plain(2) if self.chance(0.6) else self.links(4), "div section ul", "aside")
        else:
            self.wrap(kind, lambda: self.plain(1) if self.chance(0.5) else self.bare(), "div section aside p")

    def article(self, depth: int) -> None:
        tag = "article" if self.chance(0.5) else self.pick("main div section article td")
        mark = f' {self.pick("class id")}="{self.pick(MAIN)}"' if self.chance(0.6) else ""
        if tag == "td":
            self.put("<table><tr>")
        self.put(f"<{tag}{mark}>")
        if self.chance(0.8):
            self.put(f"<h1>{self.words(int(self.rng.integers(2, 9)))}</h1>", 1)
        for _ in range(int(self.rng.integers(1, 12))):
            shape = self.rng.random()
            text = self.sentences(int(self.rng.integers(1, 7)))
            if shape < 0.62:
                self.put(f"<p>{text}{self.pick('</p> </p> </p> <br>')}", 1)
            elif shape < 0.72:
                self.put(f"<p><b>{text}<br>", 1)
            elif shape < 0.78:
                self.put(f"<h2>{self.words(3)}</h2>", 1)
            elif shape < 0.84:
                self.put(f"<ul><li>{text}</li>", 1)
                self.put(f"<li>{self.words(3)} <a href='/x'>{self.words(1)}</a></li></ul>", 1)
            elif shape < 0.88:
                self.put(f"<blockquote>{text}</blockquote>", 1)
            elif shape < 0.92 and not depth:
                self.put(f'<div class="{self.pick(MAIN)}">')
                self.put(f"<p>{text}</p>", 1)
                self.put("</div>")
            elif self.chance(0.7):
                self.put("</p>")
                self.aside()
        self.put(f"</{tag}>")
        if tag == "td":
            self.put("</tr></table>")


def labelled_pages(n: int, seed: int) -> list[tuple[str, list[int]]]:
    """``n`` pages with the label of each leaf block."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        w = _Writer(rng)
        w.put("<!DOCTYPE html><html><head><title>x</title><script>var a='<p>no</p>';</script></head><body>")
        if w.chance(0.6):
            w.wrap("header", lambda: w.plain(1), "div section", "header")  # noqa: B023
        if w.chance(0.8):
            w.wrap("menu", lambda: w.links(int(rng.integers(2, 8))), "div ul", "nav nav nav")  # noqa: B023
        for _ in range(int(rng.integers(0, 3))):
            w.aside()
        w.article(0)
        for _ in range(int(rng.integers(0, 3))):
            w.aside()
        if w.chance(0.8):
            w.wrap("footer", w.foot, "div section p", "footer footer")
        w.put("</body></html>")
        out.append(("".join(w.html), w.labels))
    return out

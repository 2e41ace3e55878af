"""Labelled pages for training: drawn from a grammar of page layouts, each block with its label (1: main text).

The grammar covers the ways in which sites mark their parts: by HTML5 elements, by class or id names in several styles,
or by nothing but the text's form. Words are drawn from a small alphabet of syllables, so no weight can hang on content.
"""

from __future__ import annotations

import random

SYLLABLES = "an be ca do en fi go hu in jo ka li mo na or pe qui ra se ti un ve wa xi yo za".split()

MAIN = ("content", "main", "post", "entry-content", "article-body", "story", "post-body", "articleText", "main-content", "page-content", "text")
SIDE = ("sidebar", "widget", "related", "side-bar", "aside", "recommended", "popular-posts", "tag-cloud", "more-stories")
NOTICE = ("cookie-banner", "notice", "consent", "alert", "gdpr", "cookie", "message-bar", "popup", "overlay", "paywall", "disclaimer")
ADVERT = ("ad", "ads", "advert", "advertisement", "banner-ad", "sponsored", "promo", "adsense", "ad-slot", "sponsor")
COMMENTS = ("comments", "comment-list", "commentlist", "disqus", "discussion", "responses", "reader-comments", "comment")
HEADER = ("header", "masthead", "site-header", "top-bar", "branding", "page-header")
MENU = ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "site-nav", "main-menu")
FOOTER = ("footer", "site-footer", "bottom", "copyright", "foot", "page-footer", "legal")
SHARE = ("share", "social", "share-buttons", "social-links", "byline-tools", "toolbar")
FORM = ("newsletter", "signup", "search-form", "login", "subscribe", "contact-form", "search")


class Page:
    """Collects markup and, in order, the label of each leaf block."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.labels: list[int] = []

    def words(self, low: int, high: int, stop: bool = True) -> str:
        r = self.r
        text = " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))
        return text.capitalize() + (r.choice(".....!?") if stop else "")

    def sentences(self, n: int) -> str:
        return " ".join(self.words(3, 18) for _ in range(n))

    def block(self, open_tag: str, text: str, label: int, close: bool = True) -> None:
        self.out.append(f"<{open_tag}>{text}" + (f"</{open_tag.split()[0]}>" if close else ""))
        self.labels.append(label)

    def wrap(self, tag: str, names: tuple[str, ...] | None, fill, *args) -> None:
        """An element around what fill writes; sometimes the name is an id, sometimes there is none."""
        r = self.r
        mark = "" if not names else f' {r.choice(("class", "class", "id"))}="{r.choice(names)}{r.choice(("", "", f" {r.choice(SYLLABLES)}"))}"'
        self.out.append(f"<{tag}{mark}>")
        fill(*args)
        self.out.append(f"</{tag}>")

    # Parts that are not main text.

    def link_list(self, low: int = 3, high: int = 9) -> None:
        self.out.append("<ul>")
        for _ in range(self.r.randint(low, high)):
            self.block("li", f'<a href="/{self.words(1, 1, False)}">{self.words(1, 4, False)}</a>', 0)
        self.out.append("</ul>")

    def links_in_line(self) -> None:
        self.out.append(" | ".join(f'<a href="#">{self.words(1, 2, False)}</a>' for _ in range(self.r.randint(2, 6))))
        self.labels.append(0)

    def menu(self) -> None:
        r = self.r
        if r.random() < 0.6:
            self.wrap("nav", MENU if r.random() < 0.3 else None, r.choice((self.link_list, self.link_list, self.links_in_line)))
        else:
            self.wrap("div", MENU, r.choice((self.link_list, self.links_in_line)))

    def header(self) -> None:
        def fill():
            self.block(self.r.choice(("div", "p", "h1", "h2")), self.r.choice((self.words(1, 4, False), f'<a href="/">{self.words(1, 3, False)}</a>')), 0)
            if self.r.random() < 0.5:
                self.block("p", self.words(3, 8, False), 0)

        self.wrap(*(("header", None) if self.r.random() < 0.5 else ("div", HEADER)), fill)

    def advert(self) -> None:
        def fill():
            r = self.r
            for _ in range(r.choice((1, 1, 2))):
                if r.random() < 0.5:
                    self.out.append(r.choice((self.words(2, 14), self.sentences(2))))
                    self.labels.append(0)
                    break
                self.block("p", r.choice((self.words(2, 14), f'<a href="#">{self.words(2, 6)}</a>', self.sentences(3))), 0)

        self.wrap(self.r.choice(("div", "div", "aside", "section")), ADVERT, fill)

    def notice(self) -> None:
        def fill():
            self.block("p", self.r.choice(("We use cookies. ", "Cookies: ", "", "Our privacy terms changed. ", "")) + self.sentences(self.r.randint(1, 3)), 0)
            if self.r.random() < 0.5:
                self.block("div", "<button>" + self.words(1, 2, False) + "</button>", 0)

        self.wrap(self.r.choice(("div", "section")), NOTICE, fill)

    def form(self) -> None:
        def fill():
            r = self.r
            if r.random() < 0.5:
                self.block("p", r.choice(("Subscribe to our newsletter. ", "Sign up. ", "")) + self.words(3, 10), 0)
            self.block("div", f"<label>{self.words(1, 3, False)}</label><input type=text> <button>{r.choice(('Search', 'Log in', self.words(1, 1, False)))}</button>", 0)

        self.wrap("form", FORM if self.r.random() < 0.4 else None, fill)

    def side(self) -> None:
        def fill():
            r = self.r
            self.block(r.choice(("h2", "h3", "h4", "div")), r.choice(("Related", "Read more", self.words(1, 4, False))), 0)
            if r.random() < 0.7:
                self.link_list(2, 6)
            else:
                for _ in range(r.randint(1, 3)):
                    self.block("p", self.sentences(r.randint(1, 3)), 0)

        self.wrap(*(("aside", SIDE if self.r.random() < 0.3 else None) if self.r.random() < 0.5 else ("div", SIDE)), fill)

    def share(self) -> None:
        self.wrap(self.r.choice(("div", "ul")), SHARE, lambda: self.block("li", '<a href="#">Share</a> <a href="#">Tweet</a>', 0))

    def comments(self) -> None:
        def fill():
            r = self.r
            self.block("h3", r.choice(("Comments", f"{r.randint(2, 90)} comments", self.words(1, 3, False))), 0)
            for _ in range(r.randint(1, 5)):
                self.out.append(r.choice(("<div class=comment>", "<li class='comment depth-1'>", "<div>", "<article class=comment>")))
                inner = self.out[-1][1:].split()[0].strip(">")
                self.block("p" if r.random() < 0.4 else "div class=author", f"{self.words(1, 2, False)} {r.choice(('says:', '', 'Reply'))}", 0)
                self.out[-1] = self.out[-1].replace("</div class=author>", "</div>")
                self.block("p", self.sentences(r.randint(1, 5)), 0)
                self.out.append(f"</{inner}>")

        self.wrap(self.r.choice(("section", "div", "ol")), COMMENTS, fill)

    def footer(self) -> None:
        def fill():
            r = self.r
            if r.random() < 0.5:
                self.link_list(2, 6)
            text = r.choice(("&copy; ", "Copyright 2020 ", "© ", "")) + r.choice((self.words(2, 12), f"{self.words(1, 2, False)} &middot; {self.sentences(2)}", "All rights reserved. " + self.words(2, 4)))
            if r.random() < 0.5:
                self.block("p", text, 0)
            else:
                self.out.append(text)
                self.labels.append(0)

        self.wrap(*(("footer", None) if self.r.random() < 0.7 else ("div", FOOTER)), fill)

    # Main text.

    def paragraph(self, label: int = 1) -> None:
        r, text = self.r, self.sentences(self.r.randint(1, 6))
        if r.random() < 0.1:
            text = self.words(1, 2)
        if r.random() < 0.2:
            text = text.replace(" ", f' <a href="/x">{self.words(1, 2, False)}</a> ', 1)
        if r.random() < 0.15:
            text = f"<b>{text}<br>" if r.random() < 0.5 else f"<em>{text}</em>"
        self.block("p", text, label, close=r.random() < 0.85)

    def main(self) -> None:
        r = self.r
        if r.random() < 0.75:
            self.block("h1", self.words(1, 12, r.random() < 0.3), 1)
        if r.random() < 0.1:
            self.share()
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.7:
                self.paragraph()
            elif kind < 0.77:
                self.block(r.choice(("h2", "h3")), self.words(1, 7, False), 1)
            elif kind < 0.83:
                self.out.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    self.block("li", self.words(2, 14, r.random() < 0.5), 1)
                self.out.append("</ul>")
            elif kind < 0.87:
                self.block("blockquote", self.sentences(2), 1)
            elif kind < 0.9:
                self.block("pre", self.words(3, 12, False), 1)
            elif kind < 0.93:
                self.out.append("<table><tr>")
                for _ in range(r.randint(2, 4)):
                    self.block("td", self.words(1, 4, False), 1)
                self.out.append("</tr></table>")
            else:
                r.choice((self.advert, self.advert, self.form, self.notice, self.share, self.side))()
        if r.random() < 0.15:
            self.comments()

    def page(self) -> tuple[str, list[int]]:
        r = self.r
        self.out.append(f"<!DOCTYPE html><html><head><title>{self.words(2, 6, False)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>")
        before = [self.menu] * (r.random() < 0.85) + [self.header] * (r.random() < 0.5) + [self.notice] * (r.random() < 0.25) + [self.advert] * (r.random() < 0.4) + [self.form] * (r.random() < 0.15) + [self.side] * (r.random() < 0.15)
        r.shuffle(before)
        for f in before:
            f()
        style = r.random()
        if style < 0.4:
            self.wrap("article", None, self.main)
        elif style < 0.55:
            self.wrap("main", None, self.main)
        elif style < 0.85:
            self.wrap(r.choice(("div", "section", "td")), MAIN, self.main)
        else:
            self.main()
        after = [self.comments] * (r.random() < 0.3) + [self.side] * (r.random() < 0.4) + [self.advert] * (r.random() < 0.3) + [self.form] * (r.random() < 0.2) + [self.notice] * (r.random() < 0.15) + [self.share] * (r.random() < 0.15)
        r.shuffle(after)
        for f in after:
            f()
        if r.random() < 0.9:
            self.footer()
        self.out.append("</body></html>")
        return "".join(self.out), self.labels


def labelled_pages(n: int, seed: int = 0) -> list[tuple[str, list[int]]]:
    """n pages with the labels of their leaf blocks, the same for the same arguments."""
    return [Page(seed * 1_000_003 + k).page() for k in range(n)]

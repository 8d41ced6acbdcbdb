"""Labelled pages to train the extractor on, made from a small grammar of page layouts.

Texts are invented sentences; what is drawn is the markup around them: where
the article stands, what it is called, and which menus, headers, footers,
sidebars, notices, adverts, forms and comments surround or interrupt it.
"""

import random

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split()
ARTICLES = (
    "article", "main", 'div class="content"', 'div id="content"', 'div class="post"', "section",
    'div class="entry-content"', 'div class="article-body"', 'div class="story text"', "div", None,
    'div id="main" role="main"', 'article class="post"', 'td class="body"', 'div class="page"',
)
MENUS = (
    "nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="breadcrumb"',
    'div role="navigation"', 'div class="navbar"', 'div class="pagination"', 'ul class="tags"',
)
ASIDES = (
    "aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="related"', 'div class="widget"',
    'section class="related-posts"', 'div class="recommended"', 'aside class="sidebar"',
    'div class="share social"', 'div class="trending"',
)
NOTICES = (
    'div class="cookie-notice"', 'div id="cookie-banner"', 'div class="notice"', 'p class="notice"',
    'div class="alert"', 'div class="newsletter"', 'div class="popup modal"', 'p class="disclaimer"',
    'div class="subscribe"', 'div role="alert"', 'div class="banner"', 'div hidden', 'dialog',
    'div style="display:none"', 'div class="consent gdpr"', 'p class="legal"',
)
ADVERTS = (
    'div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"',
    'aside class="ad"', 'div class="sponsored"', 'div class="promo"', 'div id="ad-top"', 'p class="ad"',
    'section class="promo"', 'div class="banner-ad"', 'div class="adsbygoogle"',
)
COMMENTS = (
    'section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="comments"',
    'div class="reader-comments"', 'section id="comments"', 'div class="responses"', 'div class="discussion"',
)
HEADERS = ("header", 'div class="header"', 'div id="header"', 'div class="masthead"', 'div class="site-header"')
FOOTERS = ("footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"', 'footer class="site-footer"')
FORMS = ("form", 'form class="search"', 'form id="login"', 'form class="comment-form respond"', 'fieldset')
HEADINGS = ("h2", "h3", "h4")
MARKS = ("|", "|", "·", "©", "#", "*")
MARKED = 0.2


class Draw:
    """Pieces of pages, each a list of (html, text or None); text only where it is article text."""

    def __init__(self, seed):
        self.random = random.Random(seed)

    def some(self, least, most):
        return self.random.randint(least, most)

    def words(self, n):
        r = self.random
        return " ".join("".join(r.choices(SYLLABLES, k=r.choice((1, 2, 2, 3)))) for _ in range(n))

    def sentences(self, least, most):
        texts = [self.words(self.some(1, 16)).capitalize() + "." for _ in range(self.some(least, most))]
        if self.random.random() < MARKED:  # marks stand in articles too
            mark = self.one(MARKS)
            texts = [f" {mark} ".join(self.words(self.some(1, 4)) for _ in range(self.some(2, 8))), *texts[1:]]
        return " ".join(texts)

    def wrap(self, element, inside):
        if element is None:
            return inside
        return [f"<{element}>", *inside, f"</{element.split()[0]}>"]

    def one(self, options):
        return self.random.choice(options)

    def item(self, element, text, main):
        close = f"</{element}>" if element != "p" or self.random.random() < 0.9 else ""
        return [f"<{element}>", (text, main), close]

    def links(self):
        out = ["<ul>"]
        for _ in range(self.some(2, 8)):
            out += ["<li><a href='/x'>", (self.words(self.some(1, 4)), False), "</a></li>"]
        return [*out, "</ul>"]

    def paragraph(self, main, element="p"):
        text = self.sentences(1, 8)
        r = self.random.random()
        if r < 0.15:
            return [f"<{element}><b>", (text, main), "<br>"]
        if r < 0.25:
            return [f"<{element}><span>", (text, main), f"</span></{element}>"]
        return self.item(element, text, main)

    def aside(self):
        inside = [*self.item(self.one(HEADINGS), self.words(2), False), *self.links()]
        if self.random.random() < 0.5:
            inside += self.paragraph(False)
        return self.wrap(self.one(ASIDES), inside)

    def advert(self):
        text = (self.sentences(1, 3), False)
        inside = [text] if self.random.random() < 0.6 else ["<p>", text, "</p>"]
        return ["<!-- ad -->", *self.wrap(self.one(ADVERTS), inside)]

    def notice(self):
        text = (self.sentences(1, 3), False)
        extra = ["<button>", (self.words(1), False), "</button>"] if self.random.random() < 0.4 else []
        inside = [text] if self.random.random() < 0.5 else ["<p>", text, "</p>"]
        return self.wrap(self.one(NOTICES), [*inside, *extra])

    def comments(self):
        inside = self.item(self.one(HEADINGS), self.words(2), False)
        for _ in range(self.some(1, 4)):
            name = self.item("span", self.words(2), False) if self.random.random() < 0.5 else []
            inside += self.wrap(self.one(('div class="comment"', "li", "article", "div")), [*name, *self.paragraph(False)])
        return self.wrap(self.one(COMMENTS), inside)

    def form(self):
        text = (self.words(self.some(1, 6)), False)
        return self.wrap(self.one(FORMS), ["<label>", text, "</label><input><button>", (self.words(1), False), "</button>"])

    def header(self):
        inside = self.item(self.one(("h1", "div", "p")), self.words(self.some(1, 3)), False)
        if self.random.random() < 0.5:
            inside += self.links()
        return self.wrap(self.one(HEADERS), inside)

    def footer(self):
        inside = self.links() if self.random.random() < 0.4 else []
        mark = self.one(("&copy; ", "&copy; ", ""))
        text = f"{mark}{self.words(1)}.example.com &middot; {self.sentences(1, 2)}"
        return self.wrap(self.one(FOOTERS), [*inside, (text, False)])

    def article(self):
        inside = []
        if self.random.random() < 0.8:
            head = self.item("h1", self.words(self.some(2, 9)).capitalize(), True)
            inside += self.wrap("header", head) if self.random.random() < 0.1 else head
        for _ in range(self.some(1, 9)):
            inside += self.paragraph(True)
            r = self.random.random()
            if r < 0.08:
                inside += self.item(self.one(HEADINGS), self.words(self.some(1, 6)).capitalize(), True)
            elif r < 0.13:
                inside += ["<ul>", *[x for _ in range(3) for x in self.item("li", self.sentences(1, 2), True)], "</ul>"]
            elif r < 0.17:
                inside += self.wrap("blockquote", self.paragraph(True))
            elif r < 0.20:
                inside += ["<table><tr><td>", (self.words(2), True), "</td><td>", (self.words(2), True), "</td></tr></table>"]
            elif r < 0.24:
                inside += ["<pre>", (self.words(6), True), "</pre>"]
            elif r < 0.36:
                inside += self.one((self.advert, self.aside, self.notice, self.form))()
        if self.random.random() < 0.15:
            inside += self.comments()
        return self.wrap(self.one(ARTICLES), inside)

    def page(self):
        parts, r = [], self.random.random
        for chance, make in ((0.3, self.notice), (0.6, self.header)):
            if r() < chance:
                parts += make()
        if r() < 0.7:
            parts += self.wrap(self.one(MENUS), self.links())
        for chance, make in ((0.2, self.form), (0.4, self.advert), (0.25, self.aside)):
            if r() < chance:
                parts += make()
        parts += self.article()
        for chance, make in ((0.3, self.advert), (0.35, self.comments), (0.2, self.form), (0.4, self.aside), (0.2, self.notice), (0.75, self.footer)):
            if r() < chance:
                parts += make()
        return parts


def labelled_page(seed: int):
    """A page's html and its article texts in order."""
    parts = Draw(seed).page()
    body = "".join(x if isinstance(x, str) else x[0] for x in parts)
    texts = [x[0] for x in parts if not isinstance(x, str) and x[1]]
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>", texts

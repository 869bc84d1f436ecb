"""Labelled pages for the extraction model: layouts composed at random, the same for a seed, with every block's label known.

Content is marked by the attribute data-content="1" on the elements that are wholly content, and data-content="0" on those inside
them that aren't; what has no mark inherits, and the page itself is not content.
"""

from __future__ import annotations

import random

# The names that pages give to their parts, by what the parts are.
CONTENT = "content article post entry story main body text article-body post-content entry-content story-body main-content page-content read blog-post news-article prose".split()
NEUTRAL = "row col inner block box wrap section group x1 y2 item left-part a1 module css-1x9 container grid clearfix".split()
WRAPPERS = "wrapper container page site layout outer root app frame columns".split()
ROLES = {
    "menu": (["nav", "nav", "div", "ul"], "menu nav navbar navigation topnav main-menu site-nav breadcrumb breadcrumbs toolbar tabs pagination pager links skip toc submenu".split(), "links"),
    "header": (["header", "header", "div"], "header masthead top brand logo site-header topbar page-header".split(), "short"),
    "footer": (["footer", "footer", "div"], "footer bottom copyright colophon legal site-footer page-footer imprint".split(), "footer"),
    "sidebar": (["aside", "aside", "div", "section"], "sidebar side rail widget related recommended popular trending more recent tags categories archive most-read teaser teasers secondary complementary".split(), "mixed"),
    "notice": (["div", "section", "p", "div", "aside"], "cookie cookies consent notice gdpr alert popup modal overlay banner privacy message disclaimer paywall warning cookie-banner cookie-notice cookie-consent notification toast".split(), "sentences"),
    "advert": (["div", "div", "aside", "ins", "section"], "ad ads advert adverts advertisement advertising sponsored promo promoted promotion ad-slot adbox sponsor commercial google-ad adsbygoogle ad-container".split(), "sentences"),
    "form": (["form", "form", "div"], "search newsletter subscribe signup login contact form register subscription search-form".split(), "form"),
    "comments": (["section", "div", "div", "ol", "ul", "aside"], "comments comment comment-list replies reply respond discussion disqus feedback responses reviews user-comments thread commentlist comment-section reader-comments".split(), "comments"),
    "share": (["div", "ul"], "share social sharing follow buttons share-bar social-links tools".split(), "links"),
}


class Pages:
    """A source of labelled pages; texts are words made of syllables, for the model sees their sizes and marks only."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.suffix, self.loud, self.plain, self.brief = "", False, False, 0.07  # of the page at hand: marks after words, capitals, no full stops

    def restyle(self) -> None:
        """Some pages are odd throughout, in content and elsewhere."""
        self.suffix = self.r.choice(("!!", "***", "$$$", "&amp;&amp;", "...", "|")) if self.r.random() < 0.15 else ""
        self.loud, self.plain = self.r.random() < 0.08, self.r.random() < 0.1
        self.brief = 0.9 if self.r.random() < 0.2 else 0.07  # share of paragraphs of a few words

    def word(self) -> str:
        word = self.syllables() + (self.suffix if self.r.random() < 0.9 else "")
        return word.upper() if self.loud else word

    def syllables(self) -> str:
        return "".join(self.r.choice(("the", "ra", "on", "li", "est", "ka", "mo", "und", "é", "s", "vi", "ter")) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi))).capitalize()

    def sentences(self, lo: int, hi: int) -> str:
        return " ".join(self.words(2, 16) + ("" if self.plain else self.r.choice("....!?")) for _ in range(self.r.randint(lo, hi)))

    def named(self, tag: str, names: list[str], inner: str, mark: str = "", bare: float = 0.0) -> str:
        name = self.r.choice(names)
        if self.r.random() < 0.3:
            name += self.r.choice((" ", "-", "_")) + self.r.choice(NEUTRAL)
        how = self.r.choice(("class", "class", "id"))
        return f"<{tag}{mark}>{inner}</{tag}>" if self.r.random() < bare else f'<{tag}{mark} {how}="{name}">{inner}</{tag}>'

    def links(self, lo: int, hi: int) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(lo, hi))]
        return self.r.choice(("<ul><li>" + "</li><li>".join(items) + "</li></ul>", " | ".join(items), "".join(f"<span>{x}</span> " for x in items), "".join(f"<p>{x}</p>" for x in items)))

    def comment(self) -> str:
        said = "".join(f"<p>{self.sentences(1, self.r.choice((2, 5, 15)))}</p>" for _ in range(self.r.choice((1, 1, 2))))
        by = self.r.choice((f"<b>{self.words(1, 2)}</b>", f"<cite>{self.words(1, 2)}</cite> <time>{self.r.randint(1, 30)} May</time>", f'<span class="author">{self.words(1, 2)}</span>', ""))
        return self.named(self.r.choice(("div", "li", "article", "div", "p")), ["comment", "reply", "comment-body", "user", "thread"], by + said if self.r.random() < 0.8 else by + self.sentences(1, 3), bare=0.3)

    def inside(self, style: str) -> str:
        r = self.r
        if style == "links":
            return self.links(2, 12)
        if style == "short":
            return r.choice((f"<h1>{self.words(1, 3)}</h1>", f"<a href='/'>{self.words(1, 3)}</a>", f"<p>{self.words(2, 8)}</p>", f"<div>{self.words(1, 4)}</div>{self.links(2, 6)}", f"<h1>{self.words(1, 3)}</h1><p>{self.words(2, 7)}</p>"))
        if style == "footer":
            return r.choice(("&copy; 2024 ", "", "Copyright ")) + r.choice((self.sentences(1, 2), self.words(2, 8), f"<p>{self.sentences(1, 3)}</p>")) + r.choice(("", self.links(2, 6)))
        if style == "sentences":
            text = self.sentences(1, r.choice((2, 4, 10, 25)))
            return r.choice((text, f"<p>{text}</p>", f"<h3>{self.words(1, 4)}</h3><p>{text}</p>", f"<p>{text}</p><a href='#'>{self.words(1, 2)}</a>", f"<span>{text}</span>", f"<div><p>{text}</p></div>"))
        if style == "form":
            return f"<label>{self.words(1, 4)}</label><input name=q>" + r.choice(("", f"<p>{self.sentences(1, 2)}</p>", f"<h4>{self.words(1, 4)}</h4>", "<fieldset><legend>" + self.words(1, 3) + "</legend></fieldset>"))
        if style == "comments":
            return r.choice(("", f"<h2>{self.words(1, 3)}</h2>", f"<h3>{r.randint(2, 90)} {self.words(1, 1)}</h3>")) + "".join(self.comment() for _ in range(r.randint(1, 6)))
        return f"<h3>{self.words(1, 4)}</h3>" + r.choice((self.links(2, 8), f"<p>{self.sentences(1, 3)}</p>", "".join(f"<h4>{self.words(2, 8)}</h4><p>{self.sentences(1, 2)}</p>" for _ in range(r.randint(1, 4))), self.links(1, 3) + f"<p>{self.sentences(1, 2)}</p>"))

    def other(self, role: str, mark: str = "") -> str:
        tags, names, style = ROLES[role]
        tag = self.r.choice(tags)
        inner = self.inside(style if self.r.random() < 0.85 else "sentences")
        if tag == "ul" and "<li" not in inner:
            tag = "div"
        return self.named(tag, names, inner, mark, 0.5 if tag in ("nav", "header", "footer", "aside", "form") else 0.0)

    def paragraph(self) -> str:
        r, n = self.r, self.r.choice((1, 1, 2, 4, 8, 14, 40))
        text = self.sentences(1, n) if r.random() > self.brief else self.words(1, 6)
        if r.random() < 0.25:
            text = r.choice((f"<b>{text}", f"<em>{self.words(1, 5)}</em> {text}", f'{text} <a href="/x">{self.words(1, 4)}</a> {self.sentences(1, 1)}', f"{text}<br>"))
        return f"<p>{text}" + r.choice(("</p>", "</p>", "</p>", ""))

    def piece(self) -> str:
        r = self.r
        x = r.random()
        if x < 0.78:
            return self.paragraph()
        if x < 0.84:
            return f"<h{r.choice('2234')}>{self.words(1, 8)}</h2>"
        if x < 0.89:
            return "<ul>" + "".join(f"<li>{self.words(2, 20)}" + r.choice(("", ".")) + "</li>" for _ in range(r.randint(2, 6))) + "</ul>"
        if x < 0.92:
            return f"<blockquote><p>{self.sentences(1, 4)}</p></blockquote>"
        if x < 0.95:
            return f"<figure><img src=x><figcaption>{self.words(3, 12)}.</figcaption></figure>"
        if x < 0.97:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{r.randint(1, 999)}</td></tr>" for _ in range(r.randint(2, 5))) + "</table>"
        return r.choice((f"<pre>{self.words(4, 20)}</pre>", f"<div>{self.sentences(1, 6)}</div>", self.named("div", NEUTRAL, self.paragraph() + self.paragraph()), f"<section><h2>{self.words(1, 5)}</h2>{self.paragraph()}{self.paragraph()}</section>"))

    def story(self) -> list[str]:
        r = self.r
        title = f"<h{r.choice('1112')}>{self.words(2, 12)}</h1>"
        if r.random() < 0.1:
            title = f"<header>{title}</header>"
        parts = [title] * (r.random() < 0.9) + [self.piece() for _ in range(r.choice((1, 2, 4, 7, 12, 30) if self.brief < 0.5 else (4, 12, 40)))]
        if r.random() < 0.1:
            parts += [r.choice((self.paragraph, self.piece))()] * r.randint(2, 30)  # a line repeated
        for role in ("advert", "share", "sidebar", "comments", "form", "notice"):
            if r.random() < 0.12:
                parts.insert(r.randint(1, len(parts)), self.other(role, ' data-content="0"'))
        return parts

    def page(self) -> str:
        r = self.r
        self.restyle()
        kind = r.random()
        some = lambda role, p: [self.other(role)] if r.random() < p else []
        above = some("notice", 0.25) + some("header", 0.4) + some("menu", 0.7) + some("notice", 0.15) + some("form", 0.2) + some("advert", 0.4)
        below = some("share", 0.2) + some("comments", 0.35) + some("sidebar", 0.35) + some("advert", 0.3) + some("form", 0.2) + some("footer", 0.8) + some("notice", 0.2)
        beside = some("sidebar", 0.4) + some("menu", 0.1)
        if kind < 0.04:
            middle = beside
        elif kind < 0.16:  # the story stands in the page itself
            middle = [x if 'data-content="0"' in x else x.replace(">", ' data-content="1">', 1) for x in self.story()]
        else:
            tag = "td" if kind < 0.2 else r.choice(("article", "article", "div", "div", "main", "section"))
            mark = ' data-content="1"'
            inner = "".join(self.story())
            if r.random() < 0.2:
                inner = self.named("div", CONTENT + NEUTRAL, inner)
            box = self.named(tag, CONTENT if r.random() < 0.8 or tag == "div" else NEUTRAL, inner, mark, 0.5 if tag in ("article", "main", "td") else 0.05)
            middle = [box, *beside] if r.random() < 0.7 else [*beside, box]
            if tag == "td":
                side = f'<td class="{r.choice(("menu", "left", "side"))}">{self.links(3, 8)}</td>'
                middle = [f"<table><tr>{side}{box}</tr></table>"]
            elif r.random() < 0.35:
                middle = [self.named(r.choice(("div", "div", "main")), WRAPPERS, "".join(middle), bare=0.2)]
        whole = "".join(above + middle + below)
        if r.random() < 0.3:
            whole = self.named("div", WRAPPERS, whole, bare=0.2)
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><script>var x='<p>';</script></head><body>{whole}</body></html>"


def labelled_pages(many: int, seed: int) -> list[str]:
    source = Pages(seed)
    return [source.page() for _ in range(many)]

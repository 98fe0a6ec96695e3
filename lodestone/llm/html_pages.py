"""Labelled synthetic pages for training the main-text model: seeded, bounded, with the true label in the attribute ``data-keep``.

Layouts, container tags, attribute words, nesting, unclosed tags and lengths vary, with and without telling attributes, so that the trees learn
to weigh tags, attributes, density and neighbours instead of one template.
"""

from __future__ import annotations

import random

SYLLABLES = "an er the on re in ti st ch en ou le qua des al mi cor ve lu pra gen tor sil bo".split()
BOILERPLATE = {
    "menu": (["nav", "div", "ul"], ["nav", "menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "pagination", "topbar", "main-menu"]),
    "header": (["header", "div"], ["header", "masthead", "site-header", "banner", "logo", "page-header"]),
    "footer": (["footer", "div"], ["footer", "site-footer", "copyright", "legal", "bottom", "foot"]),
    "sidebar": (["aside", "div"], ["sidebar", "side", "widget", "rail", "related", "recommended", "see-also", "popular"]),
    "notice": (["div", "section", "dialog"], ["cookie", "cookie-notice", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter"]),
    "advert": (["div", "aside", "section"], ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "sponsor"]),
    "form": (["form"], ["search", "login", "signup", "subscribe", "contact", ""]),
    "comments": (["section", "div", "ol"], ["comments", "comment-list", "disqus", "discussion", "replies", "reader-comments", "responses"]),
    "share": (["div", "ul"], ["share", "social", "share-buttons", "follow"]),
}
CONTENT = (["article", "main", "div", "section"], ["content", "article", "main", "post", "entry", "story", "post-body", "article-body", "text", "entry-content"])


class PageMaker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        out = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(r.randint(lo, hi))]
        for i in range(0, len(out), r.randint(5, 14)):
            out[i] = out[i].capitalize()
            if i:
                out[i - 1] += r.choice([".", ".", ",", ";"])
        return " ".join(out) + r.choice([".", ".", "", "!"])

    def attr(self, names: list[str], chance: float) -> str:
        r = self.r
        if r.random() > chance:
            return ""
        name = r.choice(names)
        return f' {r.choice(["class", "class", "id"])}="{name}{r.choice(["", "", " wide", " box", " col-2"])}"' if name else ""

    def links(self, n: int) -> str:
        r = self.r
        if r.random() < 0.6:
            return "<ul>" + "".join(f'<li><a href="/{i}">{self.words(1, 3)}</a></li>' for i in range(n)) + "</ul>"
        return r.choice([" | ", " ", " &middot; "]).join(f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n))

    def boilerplate(self, kind: str) -> str:
        r = self.r
        tags, names = BOILERPLATE[kind]
        tag = r.choice(tags)
        attr = self.attr(names, 0.35 if tag in ("nav", "header", "footer", "aside", "form") else 0.97)
        if kind in ("menu", "share"):
            body = self.links(r.randint(2, 9))
        elif kind == "header":
            body = r.choice(["", f"<h1>{self.words(1, 3)}</h1>", f"<div>{self.words(1, 4)}</div>", f"<p>{self.words(2, 6)}</p>"]) + (self.links(r.randint(2, 6)) if r.random() < 0.5 else self.words(1, 5))
        elif kind == "footer":
            body = r.choice([f"&copy; {self.words(2, 40)}", f"<p>&copy; {self.words(2, 9)}</p>" + self.links(r.randint(1, 5)), f"<div>{self.words(4, 40)}</div>", self.words(2, 30)])
        elif kind == "sidebar":
            body = f"<h3>{self.words(1, 3)}</h3>" + r.choice([self.links(r.randint(2, 6)), f"<p>{self.words(5, 30)}</p>", f"<div>{self.words(3, 15)}</div>" * r.randint(1, 3)])
        elif kind == "advert":
            body = r.choice([self.words(3, 25), f'<a href="/x">{self.words(3, 9)}</a>', f"<p>{self.words(4, 25)}</p>"])
        elif kind == "notice":
            body = r.choice([self.words(6, 30), f"<p>{self.words(6, 40)}</p>"]) + r.choice(["", "<button>Ok</button>", '<a href="/p">More</a>'])
        elif kind == "form":
            body = r.choice(["<input><button>Go</button>", f"<label>{self.words(1, 3)}</label><input>", f"<p>{self.words(3, 15)}</p><input><button>{self.words(1, 2)}</button>"])
        else:
            body = "".join(f'<div{self.attr(["comment", "reply"], 0.5)}>{r.choice([f"<p>{self.words(4, 60)}</p>", self.words(4, 40)])}</div>' for _ in range(r.randint(1, 5)))
        return f'<{tag}{attr} data-keep="0">{body}</{tag}>'

    def block(self) -> str:
        r = self.r
        x = r.random()
        if x < 0.62:
            text = self.words(1, 90) if r.random() < 0.85 else self.words(1, 4)
            if r.random() < 0.25:
                text = text.replace(" ", f' <a href="/z">{self.words(1, 2)}</a> ', 1)
            return f"<p>{text}</p>" if r.random() < 0.8 else f"<p><b>{text}{r.choice(['<br>', '<br>', '</b></p>'])}"
        if x < 0.72:
            return f"<h{r.randint(2, 4)}>{self.words(1, 7)}</h{2}>"
        if x < 0.8:
            return "<ul>" + "".join(f"<li>{self.words(2, 16)}</li>" for _ in range(r.randint(1, 6))) + "</ul>"
        if x < 0.85:
            return f"<blockquote>{self.words(5, 40)}</blockquote>"
        if x < 0.9:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        if x < 0.94:
            return f"<figure><img src=x><figcaption>{self.words(2, 12)}</figcaption></figure>"
        return f"<div{self.attr(['text', 'paragraph', 'section'], 0.4)}>{self.words(6, 60)}</div>"

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{self.words(1, 12)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([1, 1, 1, 2, 3, 5, 8, 13])):
            parts.append(self.block())
            if r.random() < 0.07:
                parts.append(self.boilerplate(r.choice(["advert", "share", "sidebar", "form", "notice", "menu"])))
        if r.random() < 0.12:
            parts.append(self.boilerplate("comments"))
        tags, names = CONTENT
        tag = r.choices(tags, [5, 2, 3, 1])[0]
        body = "".join(parts)
        if r.random() < 0.3:
            body = f"<div{self.attr(names, 0.6)}>{body}</div>"
        return f"<{tag}{self.attr(names, 0.4 if tag in ('article', 'main') else 0.85)}>{body}</{tag}>"

    def page(self) -> str:
        r = self.r
        pick = lambda kinds, chance: [self.boilerplate(k) for k in kinds if r.random() < chance]
        before = pick(["notice", "header", "menu", "advert", "form"], 0.45)
        after = pick(["sidebar", "share", "comments", "advert", "menu"], 0.35) + pick(["footer"], 0.85) + pick(["notice"], 0.15)
        r.shuffle(before)
        middle = self.article()
        if r.random() < 0.3:
            side = pick(["sidebar", "advert", "menu", "comments"], 0.4)
            cut = r.randint(0, len(side))
            middle = f"<div{self.attr(['wrapper', 'container', 'page', 'row', 'layout'], 0.7)}>{''.join(side[:cut])}{middle}{''.join(side[cut:])}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>"

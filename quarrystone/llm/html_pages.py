"""Generated pages to learn from: an article among menus, notices, adverts, comments and the like, in many layouts.

Texts of the article hold MARKER, so that it is known of every node how much of it is main text.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

MARKER = ""


class _Writer:
    def __init__(self, rng: random.Random):
        self.r = rng

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        return " ".join("".join(r.choice("abcdefghiklmnoprstuvéüñ") for _ in range(r.randint(1, 10))) for _ in range(r.randint(lo, hi)))

    def sentence(self, lo: int = 3, hi: int = 22) -> str:
        return self.words(lo, hi).capitalize() + self.r.choice("...!?")

    def prose(self, lo: int, hi: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))

    def link(self, lo: int = 1, hi: int = 4) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(lo, hi)}</a>'

    def named(self, names: str, share: float = 0.85) -> str:
        r = self.r
        if r.random() > share:
            return ""
        name = r.choice(names.split())
        name = r.choice([name, name, f"{name}-{r.choice(['box', 'wrap', 'area', 'inner', 'block', 'list'])}", f"{name}{r.choice(['list', 's', 'left', 'bar'])}", f"{r.choice(['site', 'page', 'the', 'js'])}-{name}", f"{name} {r.choice(['col-3', 'row', 'wide', 'clearfix'])}"])
        return f' {r.choice(["class", "class", "id"])}="{name}"'

    def links(self) -> str:
        r, n = self.r, self.r.randint(2, 12)
        if r.random() < 0.7:
            return f"<ul>{''.join(f'<li>{self.link()}</li>' if r.random() < 0.9 else f'<li>{self.link()}' for _ in range(n))}</ul>"
        return r.choice([" ", " | ", " &middot; "]).join(self.link() for _ in range(n))

    def boxed(self, tags: str, names: str, inside: str, share: float = 0.85) -> str:
        tag = self.r.choice(tags.split())
        return f"<{tag}{self.named(names, share)}>{inside}</{tag}>"

    def menu(self) -> str:
        return self.boxed("nav nav div ul", "nav menu navbar navigation breadcrumbs toc", self.links())

    def header(self) -> str:
        r = self.r
        inside = "".join(r.sample([f"<h1>{self.words(1, 4)}</h1>", f"<h1>{self.link(1, 4)}</h1>", f"<p>{self.sentence(2, 9)}</p>", self.menu(), f"<div>{self.link()}</div>", f"<span>{self.words(1, 3)}</span>"], r.randint(1, 3)))
        return self.boxed("header header div", "header masthead topbar branding", inside, 0.9)

    def footer(self) -> str:
        r = self.r
        inside = "".join(r.sample([f"&copy; {self.words(1, 3)} &middot; {self.sentence(2, 14)}", f"<p>{self.prose(1, 3)}</p>", self.links(), f"<p>{self.sentence(3, 9)}</p>"], r.randint(1, 3)))
        return self.boxed("footer footer div", "footer bottom colophon copyright", inside, 0.9)

    def side(self) -> str:
        r = self.r
        inside = f"<h3>{self.words(1, 4)}</h3>" * r.randint(0, 1) + r.choice([self.links(), f"<p>{self.prose(1, 4)}</p>", f"<p>{self.sentence()}</p>{self.links()}", "".join(f"<div><h4>{self.link()}</h4><p>{self.sentence()}</p></div>" for _ in range(r.randint(1, 4)))])
        return self.boxed("aside aside div section", "sidebar widget related recommended popular trending", inside, 0.92)

    def advert(self) -> str:
        r = self.r
        inside = r.choice([self.sentence(2, 20), self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>", f"<p>{self.sentence()}</p>{self.link()}", f"<h4>{self.words(2, 5)}</h4><p>{self.prose(1, 2)}</p>"])
        tag = r.choice(["div", "div", "section", "aside", "p"])
        return f"<{tag}{self.named('ad ads advert advertisement sponsored promo banner sponsor', 1)}>{inside}</{tag}>"

    def notice(self) -> str:
        r = self.r
        inside = r.choice([self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>", f"<p>{self.sentence()}</p><button>{self.words(1, 2)}</button>", f"<p>{self.prose(1, 2)} {self.link()}</p>"])
        tag = r.choice(["div", "div", "section", "aside", "p"])
        return f"<{tag}{self.named('cookie cookies consent gdpr notice alert popup modal disclaimer warning', 1)}>{inside}</{tag}>"

    def form(self) -> str:
        r = self.r
        inside = "".join(r.choice([f"<label>{self.words(1, 3)}</label><input name=x>", f"<p>{self.sentence(2, 12)}</p>", f"<div>{self.words(1, 5)}<input></div>", f"<textarea>{self.words(1, 9)}</textarea>", f"<select><option>{self.words(1, 2)}<option>b</select>"]) for _ in range(r.randint(1, 5)))
        return f"<form{self.named('search login newsletter subscribe contact', 0.6)}>{inside}<button>{self.words(1, 2)}</button></form>"

    def comments(self) -> str:
        r = self.r
        one = lambda: self.boxed("div div li article", "comment reply", f"<b>{self.words(1, 2)}</b>" * r.randint(0, 1) + "".join(f"<p>{self.prose(1, 6)}</p>" for _ in range(r.randint(1, 3))) if r.random() < 0.8 else self.prose(1, 4), 0.8)
        inside = f"<h3>{self.words(1, 3)}</h3>" * r.randint(0, 1) + "".join(one() for _ in range(r.randint(1, 8))) + self.form() * (r.random() < 0.3)
        tag = r.choice(["div", "div", "section", "ol", "aside"])
        return f"<{tag}{self.named('comments comment-list replies discussion respond disqus', 1)}>{inside}</{tag}>"

    def share(self) -> str:
        return self.boxed("div p ul", "share social follow meta byline tags", self.links() if self.r.random() < 0.6 else self.words(1, 5), 0.95)

    def paragraph(self) -> str:
        r = self.r
        text = self.prose(1, r.choice([1, 3, 8, 25]))
        if r.random() < 0.2:
            text += f" {self.link()} {self.sentence()}"
        if r.random() < 0.15:
            text = self.words(1, 3)
        text = f"{MARKER}{text}"
        return r.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><{r.choice(['em', 'strong', 'span', 'i'])}>{text}", f"<p><em>{text}</em></p>", f"<p>{text}<br>{self.sentence()}</p>", f"<div>{text}</div>"])

    def piece(self) -> str:
        r = self.r
        return r.choices(
            [
                self.paragraph,
                lambda: f"<h{r.randint(2, 4)}>{MARKER}{self.words(1, 9)}</h2>",
                lambda: f"<ul>{''.join(f'<li>{MARKER}{self.sentence(2, 20)}</li>' for _ in range(r.randint(2, 7)))}</ul>",
                lambda: f"<blockquote>{MARKER}{self.prose(1, 3)}</blockquote>" if r.random() < 0.5 else f"<blockquote><p>{MARKER}{self.prose(1, 3)}</p></blockquote>",
                lambda: f"<figure><img src=x><figcaption>{MARKER}{self.sentence()}</figcaption></figure>",
                lambda: f"<table>{''.join(f'<tr><td>{MARKER}{self.words(1, 4)}<td>{MARKER}{self.words(1, 4)}' for _ in range(r.randint(2, 5)))}</table>",
                lambda: f"<pre>{MARKER}{self.words(3, 30)}</pre>",
            ],
            [14, 1.5, 1, 0.7, 0.5, 0.3, 0.3],
        )[0]()

    def article(self) -> str:
        r = self.r
        pieces = [self.piece() for _ in range(r.choice([1, 1, 2, 3, 6, 12, 25]))]
        title = f"<h1>{MARKER}{self.words(1, 12)}{r.choice(['', '.'])}</h1>" if r.random() < 0.8 else ""
        semantic = r.random() < 0.4
        if title and semantic and r.random() < 0.2:
            title = f"<header>{title}</header>"
        for extra, share in ((self.advert, 0.2), (self.share, 0.15), (self.side, 0.08), (self.notice, 0.1), (self.form, 0.15)):
            if r.random() < share:
                pieces.insert(r.randint(0, len(pieces)), extra())
        inside = title + "".join(pieces)
        if r.random() < 0.08:
            inside += self.comments()
        if r.random() < 0.08:
            inside += f"<footer>{r.choice([self.words(1, 6), self.links(), self.sentence()])}</footer>"
        if r.random() < 0.1:
            inside = inside.replace("</p>", "")
        kind = 0.0 if semantic else r.uniform(0.4, 1)
        if semantic:
            return f"<article{self.named('article post entry story hentry', 0.3)}>{inside}</article>"
        if kind < 0.85:
            tag = r.choice(["div", "div", "main", "section", "td"])
            out = f"<{tag}{self.named('content article post entry story main text body', 0.75)}>{inside}</{tag}>"
            return f"<table><tr>{out}</tr></table>" if tag == "td" else out
        return inside

    def in_table(self) -> str:
        """A page laid out by one table."""
        r = self.r
        cell = lambda names, inside, share=0.75: f"<td{self.named(names, share)}>{inside}</td>" if r.random() < 0.7 else f"<td{self.named(names, share)}>{inside}"
        top = cell("header masthead top branding logo", r.choice([self.link(), self.words(1, 5), f"<h1>{self.words(1, 4)}</h1>", self.links()]))
        menu = cell("menu nav navigation sidebar", r.choice([self.links(), "<br>".join(self.link() for _ in range(r.randint(2, 8)))]))
        foot = cell("footer bottom copyright", r.choice([self.prose(1, 3), f"{self.sentence()} {self.link()}", f"&copy; {self.sentence()} {self.links()}"]))
        side = [cell("sidebar widget ads related", r.choice([self.links(), f"<p>{self.sentence()}</p>", self.advert()]))] * (r.random() < 0.3)
        middle = [menu, cell("content main article story text", self.article(), 0.6), *side]
        return f"<table width=100%>{''.join(f'<tr>{row}</tr>' for row in (top, ''.join(middle), foot) if r.random() < 0.95 or row not in (top, foot))}</table>"

    def page(self) -> str:
        r = self.r
        if r.random() < 0.1:
            return f"<html><body>{self.in_table()}</body></html>"
        chance = lambda make, share: make() if r.random() < share else ""
        before = [chance(self.header, 0.5), chance(self.menu, 0.6), chance(self.notice, 0.25), chance(self.advert, 0.4), chance(self.form, 0.12), chance(self.side, 0.15)]
        after = [chance(self.side, 0.35), chance(self.comments, 0.3), chance(self.advert, 0.25), chance(self.share, 0.15), chance(self.form, 0.15), chance(self.notice, 0.15), chance(self.footer, 0.7)]
        if r.random() < 0.3:
            r.shuffle(before)
        main = self.article()
        if r.random() < 0.3:
            main = f"<div{self.named('wrapper container page layout', 0.7)}>{chance(self.side, 0.4)}{main}{chance(self.side, 0.3)}{chance(self.comments, 0.15)}</div>"
        if r.random() < 0.15:
            main = f"<main>{main}</main>"
        body = "".join(before) + main + "".join(after)
        if r.random() < 0.02:
            body = f"<form id=page>{body}</form>"
        if r.random() < 0.25:
            body = f"<div{self.named('wrapper container page layout', 0.7)}>{body}</div>"
        head = f"<head><title>{self.words(2, 8)}</title><style>.{self.words(1, 1)}{{width:{r.randint(1, 99)}px}}</style><script>{self.words(1, 9)}</script></head>"
        return f"<!DOCTYPE html><html>{head if r.random() < 0.9 else ''}<body>{f'<!-- {self.words(1, 4)} -->' * r.randint(0, 1)}{body}</body></html>" if r.random() < 0.95 else body


def generate(n: int, seed: int) -> Iterator[tuple[str, str]]:
    """n pages and the marker of their main text."""
    rng = random.Random(seed)
    for _ in range(n):
        yield _Writer(rng).page(), MARKER

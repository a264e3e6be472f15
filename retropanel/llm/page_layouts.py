"""Labelled pages for training: layouts of many kinds, filled with words that the caller has.

A page comes with its main text marked: every leaf block that belongs to it begins with ``MARK``.
"""

from __future__ import annotations

import numpy as np

MARK = "\ue000"

#: Vocabulary of layouts: elements that hold the main text, and names of what is never part of it.
HOLDERS = (
    "article", "article", "article", "main", "main|article", "article class=post", "article itemprop=articleBody", "div class=content", "div id=content", "div class=entry-content",
    "div class=article-body", "div class=post-body", "div class=story", "section class=article", "div role=main", "main id=main", "div class=main|div class=text", "section class=post-content",
    "table class=layout|tr|td class=content", "div itemprop=articleBody", "div class=page|div class=body-text",
)
MENUS = ("nav", "nav class=menu", "div class=menu", "div class=navbar", "ul class=nav", "div class=breadcrumbs", "nav id=navigation", "div class=toolbar", "div role=navigation", "menu", "div class=pagination", "div class=tabs")
HEADERS = ("header", "header class=site-header", "div class=header", "div id=header", "div class=masthead", "div class=topbar", "div class=logo", "header role=banner")
FOOTERS = ("footer", "footer class=site-footer", "div class=footer", "div id=footer", "div class=copyright", "footer role=contentinfo", "div class=legal", "div class=bottom")
SIDES = ("aside", "aside class=sidebar", "div class=sidebar", "div id=sidebar", "div class=widget", "section class=related", "div class=related-posts", "div class=recommended", "div class=trending", "div class=popular", "div class=side-column", "aside role=complementary")
ADS = ("div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "div class=sponsored", "div class=promo", "aside class=ad", "div id=banner", "section class=sponsor", "p class=ad", "div class=ad-slot", "div class=teaser")
NOTICES = ("div class=cookie-notice", "div class=cookie-banner", "div class=notice", "div class=alert", "div class=consent", "div id=gdpr", "dialog", "div class=popup", "div class=modal", "div role=alert", "p class=notice", "div class=disclaimer", "section class=warning", "div class=message", "div class=paywall")
SHARES = ("div class=share", "ul class=social", "div class=social-links", "div class=tags", "div class=tools", "div class=newsletter", "div class=subscribe", "section class=signup")
REMARKS = ("section class=comments", "div id=comments", "div class=comments", "section id=comments|ol class=comment-list", "div class=comment-thread", "div class=discussion", "section class=responses", "div class=reader-comments", "ul class=comments", "aside class=comments", "div class=replies", "div id=disqus-thread")
REMARK = ("div class=comment", "p", "li class=comment", "article class=comment", "div class=reply", "li", "div class=comment-body|p", "blockquote")
#: Sentences that notices, forms and adverts show.
PHRASES = (
    "We use cookies to improve this site.", "Accept all", "Sign up for our newsletter", "Please enable JavaScript", "Subscribe now", "Advertisement", "Sponsored content", "Share this page", "All rights reserved.",
    "Log in to post a comment", "Leave a reply", "Read more", "Related articles", "Privacy policy", "Terms of use", "Your e-mail address", "Search", "Send", "This site is best viewed in a new browser.", "Skip to content",
)


class Writer:
    """One random page at a time from a seeded generator."""

    def __init__(self, words: list[str], seed: int) -> None:
        self.words, self.rng = words or ["text"], np.random.default_rng(seed)

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def pick(self, options: tuple[str, ...]) -> str:
        return options[self.rng.integers(len(options))]

    def say(self, low: int, high: int) -> str:
        n = int(np.exp(self.rng.uniform(np.log(low), np.log(high + 1))))
        chosen = [self.words[i] for i in self.rng.integers(len(self.words), size=max(n, 1))]
        text = " ".join(chosen)
        return (text[0].upper() + text[1:] if self.chance(0.8) else text) + ("." if self.chance(0.7) else "")

    def inline(self, text: str) -> str:
        """Some markup inside a block, closed or not."""
        if self.chance(0.25):
            words = text.split(" ")
            at = int(self.rng.integers(len(words)))
            words[at] = {0: "<b>%s</b>", 1: "<em>%s</em>", 2: '<a href="/x">%s</a>', 3: "<b>%s"}[int(self.rng.integers(4))] % words[at]
            text = " ".join(words)
        return text

    def wrap(self, chain: str, inner: str) -> str:
        """``inner`` within a chain of elements such as ``div class=a|p``."""
        for element in reversed(chain.split("|")):
            tag, _, names = element.partition(" ")
            key, _, value = names.partition("=")
            inner = f'<{tag} {key}="{value}">{inner}</{tag}>' if names else f"<{tag}>{inner}</{tag}>"
        return inner

    def main_block(self) -> str:
        kind = int(self.rng.integers(14))
        text = MARK + self.inline(self.say(1, 120))
        if kind == 0:
            return f"<ul>{''.join(f'<li>{MARK}{self.inline(self.say(1, 25))}</li>' for _ in range(int(self.rng.integers(1, 6))))}</ul>"
        if kind == 1:
            return f"<blockquote>{self.wrap('p', text) if self.chance(0.5) else text}</blockquote>"
        if kind == 2:
            level = int(self.rng.integers(2, 5))
            return f"<h{level}>{MARK}{self.say(1, 10)}</h{level}>"
        if kind == 3:
            rows = "".join(f"<tr><td>{MARK}{self.say(1, 4)}</td><td>{MARK}{self.say(1, 4)}</td></tr>" for _ in range(int(self.rng.integers(1, 4))))
            return f"<table>{rows}</table>"
        if kind == 4:
            return f"<figure><img src=x><figcaption>{MARK}{self.say(2, 15)}</figcaption></figure>"
        if kind == 5:
            return f"<pre>{text}</pre>"
        if kind == 6:
            return f"<div>{text}</div>"
        if kind == 7:
            return f"<section><h2>{MARK}{self.say(1, 8)}</h2><p>{text}</p></section>"
        if kind == 8:
            return f"<p><b>{text}<br>"
        return f"<p>{text}</p>" if self.chance(0.8) else f"<p>{text}"

    def links(self, n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{self.say(1, 3)}</a></li>' for _ in range(n)) + "</ul>"

    def aside(self, kinds: tuple[str, ...]) -> str:
        """Something beside the main text."""
        form = int(self.rng.integers(5))
        if form == 0:
            inner = self.links(int(self.rng.integers(1, 8)))
        elif form == 1:
            inner = f"<h3>{self.say(1, 5)}</h3><p>{self.say(1, 40)}</p>"
        elif form == 2:
            inner = self.pick(PHRASES)
        else:
            inner = self.inline(self.say(1, 40))
        return self.wrap(self.pick(kinds), inner)

    def form(self) -> str:
        inner = f"<label>{self.say(1, 4)}</label><input name=q><button>{self.pick(PHRASES)}</button>"
        if self.chance(0.4):
            inner += f"<select><option>{self.say(1, 2)}<option>{self.say(1, 2)}</select><textarea>{self.say(1, 5)}</textarea>"
        if self.chance(0.4):
            inner = f"<p>{self.say(1, 20)}</p>" + inner
        return self.wrap(self.pick(("form", "form class=search", "form id=login", "div class=form|form", "form class=newsletter")), inner)

    def remarks(self) -> str:
        one = self.pick(REMARK)
        return self.wrap(self.pick(REMARKS), (f"<h3>{self.say(1, 4)}</h3>" if self.chance(0.5) else "") + "".join(self.wrap(one, self.say(1, 60)) for _ in range(int(self.rng.integers(1, 6)))))

    def page(self) -> str:
        head = f"<!DOCTYPE html><html><head><title>{self.say(2, 10)}</title><style>p{{margin:0}}</style></head><body>"
        before = [self.aside(k) for k, p in ((NOTICES, 0.25), (HEADERS, 0.5), (MENUS, 0.7), (ADS, 0.4), (SIDES, 0.15)) if self.chance(p)]
        title = f"<h1>{MARK}{self.say(1, 12)}</h1>" if self.chance(0.85) else ""
        inner = [f"<header>{title}</header>" if title and self.chance(0.2) else title]
        for _ in range(int(self.rng.integers(1, 12))):
            inner.append(self.main_block())
            if self.chance(0.1):
                inner.append(self.aside(self.pick_kind()))
            if self.chance(0.03):
                inner.append(self.form())
        if self.chance(0.15):
            inner.append(self.remarks())
        if self.chance(0.1):
            inner.append(self.aside(FOOTERS))
        body = [*before, self.wrap(self.pick(HOLDERS), "".join(inner))]
        for make, p in ((self.remarks, 0.3), (self.form, 0.2), (lambda: self.aside(SHARES), 0.2), (lambda: self.aside(SIDES), 0.3), (lambda: self.aside(ADS), 0.2)):
            if self.chance(p):
                body.append(make())
        if self.chance(0.8):
            footer = f"&copy; {self.say(1, 3)} &middot; {self.say(1, 15)}" if self.chance(0.6) else self.links(3)
            body.append(self.wrap(self.pick(FOOTERS), footer))
        if self.chance(0.15):
            body.append(self.aside(NOTICES))
        return head + "".join(body) + ("</body></html>" if self.chance(0.85) else "")

    def pick_kind(self) -> tuple[str, ...]:
        kinds = (ADS, NOTICES, SIDES, SHARES, MENUS)
        return kinds[int(self.rng.integers(len(kinds)))]

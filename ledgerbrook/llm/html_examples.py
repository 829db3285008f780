"""Labelled pages: layouts written for this library, with text filled in by a rule.

``data-keep="1"`` marks an element as content and ``"0"`` as none; what stands below
inherits the mark. ``{p}`` is a paragraph, ``{s}`` a short phrase, ``{w}`` a word.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

PAGES_PER_FRAME = 48
_SYLLABLES = "ka lo mi ter an so ve ri du el po na".split()

TOP = (
    '<nav><ul>{links}</ul></nav>',
    '<header><div class="logo">{s}</div><nav class="menu"><a href="/">{w}</a> <a href="/x">{w}</a></nav></header>',
    '<div id="header" class="site-header"><h1 class="site-title"><a href="/">{s}</a></h1><ul class="nav">{links}</ul></div>',
    '<div class="top-bar"><p>{s}</p></div><div role="navigation"><ul>{links}</ul></div>',
    '<header class="banner"><p class="tagline">{s}</p></header>',
    "",
)
NOTICE = (
    '<div class="cookie-notice"><p>{p}</p><button>{w}</button></div>',
    '<div id="consent-banner" role="dialog"><p>{p}</p><p><a href="/c">{s}</a></p></div>',
    '<div class="notice alert"><p>{p}</p></div>',
    '<div class="popup modal newsletter"><h2>{s}</h2><p>{p}</p></div>',
    "",
    "",
)
ADVERT = (
    '<div class="ad">{p}</div>',
    '<div class="advert sponsored"><p>{p}</p></div>',
    '<div id="ad-slot" class="ads"><a href="/b">{s}</a></div>',
    '<section class="promo promotion"><h3>{s}</h3><p>{p}</p></section>',
    '<aside class="advertisement">{s}</aside>',
    "",
    "",
)
SIDE = (
    '<aside><h3>{s}</h3><ul>{links}</ul></aside>',
    '<aside class="sidebar"><p>{p}</p><p>{p}</p></aside>',
    '<div class="sidebar widget"><h3>{s}</h3><p>{p}</p><ul>{links}</ul></div>',
    '<div id="related" class="related-posts"><h2>{s}</h2><ul>{links}</ul></div>',
    '<div class="share social"><a href="/f">{w}</a> <a href="/t">{w}</a></div>',
    '<div id="secondary" role="complementary"><p>{p}</p></div>',
    "",
)
FORM = (
    '<form class="search"><label>{w}</label><input></form>',
    '<form action="/login" id="login"><p>{s}</p><div>{w} <input></div></form>',
    '<div class="subscribe newsletter-signup"><p>{p}</p><form><p>{s}</p></form></div>',
    "",
    "",
)
COMMENTS = (
    '<div id="comments" class="comments"><h2>{s}</h2><div class="comment"><p class="author">{w}</p><p>{p}</p></div>'
    '<div class="comment reply"><p>{p}</p></div></div>',
    '<section class="comment-list"><h3>{s}</h3><ol><li class="comment"><p>{p}</p></li><li><p>{p}</p></li></ol></section>',
    '<section id="responses" class="discussion reader-comments"><article class="comment"><p>{p}</p></article></section>',
    '<ul class="replies">{posts}</ul>',
    "",
    "",
)
FOOT = (
    "<footer>&copy; {s}</footer>",
    '<footer class="site-footer"><p>{s}</p><ul>{links}</ul></footer>',
    '<div id="footer"><p>{p}</p><p><a href="/i">{w}</a> | <a href="/t">{w}</a></p></div>',
    '<div class="footer copyright" role="contentinfo">{s}</div>',
)
BODY = (
    "<p>{p}</p><p>{p}</p><p>{s}</p>",
    "<p>{s}.</p><p>{w}.</p><p>{s}, {s}.</p><p>{p}</p>",
    "<h2>{s}</h2><p>{p}</p><p>{w}.</p><p>{p}</p>",
    "<p>{p} <a href='/r'>{s}</a> {p}</p><blockquote><p>{p}</p></blockquote>",
    "<ul><li>{p}</li><li>{s}</li></ul><p>{p}</p>",
    "<h3>{s}</h3><pre>{p}</pre><table><tr><th>{w}</th><td>{s}</td></tr></table><p>{p}</p>",
    "<figure><figcaption>{s}</figcaption></figure><p>{p}</p><div>{p}</div>",
    '<section><h2>{s}</h2><p>{p}</p><p><b>{s}<br></p></section><ol><li>{s}</li></ol>',
    "<dl><dt>{w}</dt><dd>{p}</dd></dl><p>{p}</p>",
)
FRAME = (
    '<article data-keep="1"><h1>{s}</h1>{body}{inner}</article>',
    '<main data-keep="1"><article><h1>{s}</h1>{body}</article>{inner}</main>',
    '<main><article data-keep="1"><header><h1>{s}</h1></header>{body}</article>{inner}</main>',
    '<div class="container wrapper"><div id="content" class="content" data-keep="1"><h1>{s}</h1>{body}{inner}</div></div>',
    '<div id="page"><div class="post entry" data-keep="1"><h2 class="entry-title">{s}</h2><div class="entry-content">{body}</div>{inner}</div></div>',
    '<div class="row"><div class="article-body story text" data-keep="1"><h1 class="headline">{s}</h1>{body}</div>{inner}</div>',
    '<section class="main" role="main" data-keep="1"><h1>{s}</h1>{body}{inner}</section>',
    '<div data-keep="1"><h1>{s}</h1>{body}</div>{inner}',
)


def _fill(text: str, rng: random.Random) -> str:
    """Replace the places of a layout one after another."""

    def word() -> str:
        return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))

    def phrase(low: int, high: int) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high)))

    fills = {
        "{p}": lambda: phrase(1, 4) + "." if rng.random() < 0.2 else ". ".join(phrase(3, 14).capitalize() for _ in range(rng.randint(1, 6))) + ".",
        "{s}": lambda: phrase(1, 6),
        "{w}": word,
        "{links}": lambda: "".join(f'<li><a href="/{word()}">{phrase(1, 3)}</a></li>' for _ in range(rng.randint(2, 8))),
        "{posts}": lambda: "".join(f'<li class="comment"><p>{phrase(4, 30)}</p></li>' for _ in range(rng.randint(1, 4))),
    }
    out, at = [], 0
    while (start := text.find("{", at)) >= 0:
        end = text.index("}", start) + 1
        out += [text[at:start], fills[text[start:end]]()]
        at = end
    return "".join([*out, text[at:]])


def pages() -> Iterator[str]:
    """Every frame with parts drawn from the lists above, by a fixed seed."""
    rng = random.Random(5)

    def none(parts: tuple[str, ...]) -> str:
        return _marked(rng.choice(parts))

    for frame in FRAME:
        for _ in range(PAGES_PER_FRAME):
            body = "".join(rng.choice(BODY) for _ in range(rng.randint(1, 4)))
            inner = "".join(none(parts) for parts in (NOTICE, SIDE, FORM, ADVERT, COMMENTS) if rng.random() < 0.4)
            middle = frame.replace("{body}", body).replace("{inner}", inner)
            before = none(TOP) + none(NOTICE) + none(ADVERT)
            after = none(COMMENTS) + none(SIDE) + none(FORM) + none(FOOT)
            yield _fill(f"<html><head><title>{{s}}</title></head><body>{before}{middle}{after}</body></html>", rng)


def _marked(part: str) -> str:
    """A part without content, its outermost elements marked so."""
    out, depth, at = [], 0, 0
    while (start := part.find("<", at)) >= 0:
        end = part.index(">", start)
        tag = part[start:end]
        out.append(part[at:start] + tag + (' data-keep="0"' if depth == 0 and not tag.startswith("</") else "") + ">")
        if tag.startswith("</"):
            depth -= 1
        elif not tag.startswith(("<input", "<br", "<img")):
            depth += 1
        at = end + 1
    return "".join([*out, part[at:]])

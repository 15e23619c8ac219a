"""Seeded labelled pages for the block labeller: blocks of random words in
random page layouts, each labelled as main text or not."""

from __future__ import annotations

import random
import re

from logcube.llm.html_blocks import Block, blocks

SYLLABLES = "an ber cion de en er ge he ing ment os que re sch th ti ung vi qu ou é è ü ñ ó ß".split()

#: Names of main text containers and of what surrounds or interrupts it.
MAIN = [
    "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="content"><article class="post">', '<section class="article-body">',
    '<div class="post-content">', '<div class="entry-content">', '<article itemprop="articleBody">', '<div role="main">', '<div id="main-text">', '<td class="story">',
]
LINK_LISTS = ["<nav>", '<div class="menu">', '<ul class="nav navbar">', '<div id="navigation">', '<aside class="sidebar">', '<div class="sidebar widget">', '<div class="related-posts">', '<div class="share social">', '<div class="breadcrumb">', '<ol class="pagination">', "<aside>", '<div class="tags">']
TEXTS = ["<nav>", '<div class="menu">', "<header>", '<div class="header banner">', "<footer>", '<div id="footer">', '<div class="ad">', '<div class="ads advert">', '<aside class="sponsored promo">', '<div class="cookie-notice">', '<div class="notice alert">', '<div class="newsletter subscribe">', '<div class="popup modal">', '<p class="copyright">', '<aside class="sidebar">', '<div class="advertisement">', '<section class="promo">', '<div class="consent">']
COMMENTS = ['<div id="comments">', '<section class="comments">', '<ol class="commentlist">', '<div class="comment-thread reader-comments">', '<div class="discussion replies">', '<aside class="comments">']
#: What embeds other content, or stands for it: main text or not by where it is.
EMBEDDED = ["<noscript>{}</noscript>", "<noscript><p>{}</p></noscript>", '<object data="/x"><p>{}</p></object>', '<iframe src="/x">{}</iframe>']
DRAWN = ['<svg class="icon"/>', '<svg viewBox="0 0 8 8"><path d="M0 0"/></svg>', '<svg class="chart"><g><text>{}</text></g></svg>', "<math><mi>{}</mi><mo>=</mo><mn>{}</mn></math>", '<iframe src="/x" />', '<svg class="i">']
FORMS = ["<form>", '<form class="search">', '<form id="login">', '<div class="form contact"><form>']
MARK = "\x02"  # before every word of the main text; never in a page


def _words(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    text = " ".join(words).capitalize()
    return text + rng.choice([".", ".", ".", "", "!", "?"])


def _length(rng: random.Random) -> int:
    return rng.choice([1, 2, 4, 8, 15, 30, 60, 120])


def _ends(tags: str) -> str:
    return "".join(f"</{t.split()[0].rstrip('>')}>" for t in reversed(tags.split("<")[1:]))


def _boilerplate(rng: random.Random) -> str:
    kind = rng.random()
    if kind < 0.35:
        tag = rng.choice(LINK_LISTS)
        items = "".join(f'<li><a href="/{i}">{_words(rng, rng.randint(1, 6))}</a></li>' for i in range(rng.randint(1, 8)))
        if rng.random() < 0.25:  # links in a line
            items = rng.choice([" ", " | ", ""]).join(re.findall("<a .*?</a>", items))
        return f"{tag}<ul>{items}</ul>{_ends(tag)}" if rng.random() < 0.7 and "<li>" in items else f"{tag}{items}{_ends(tag)}"
    if kind < 0.41:
        tag, body = rng.choice(TEXTS), rng.choice(EMBEDDED + DRAWN)
        return f"{tag}{body.format(*[_words(rng, _length(rng)) for _ in range(2)])}<p>{_words(rng, _length(rng))}</p>{_ends(tag)}"
    if kind < 0.75:
        tag, body = rng.choice(TEXTS), _words(rng, _length(rng))
        return f"{tag}{body}{_ends(tag)}" if rng.random() < 0.6 else f"{tag}<p>{body}</p><p>{_words(rng, _length(rng))}</p>{_ends(tag)}"
    if kind < 0.9:
        tag = rng.choice(COMMENTS)
        items = "".join(rng.choice(["<p>{}</p>", '<div class="comment"><b>{}</b><p>{}</p></div>', "<li>{}</li>"]).format(_words(rng, _length(rng)), _words(rng, _length(rng))) for _ in range(rng.randint(1, 5)))
        return f"{tag}{rng.choice(['', '<h3>Comments</h3>'])}{items}{_ends(tag)}"
    tag = rng.choice(FORMS)
    return f"{tag}<label>{_words(rng, 2)}</label><input><select><option>{_words(rng, 1)}<option>{_words(rng, 1)}</select><button>{_words(rng, 1)}</button>{_ends(tag)}"


def _main(rng: random.Random) -> str:
    def text() -> str:
        return " ".join(MARK + w for w in _words(rng, _length(rng)).split())

    forms = ["<p>{}</p>"] * 8 + ["<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<h3>{}</h3>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", '<p>{}<a href="/x">{}</a> {}</p>', "<div>{}</div>", "<p><em>{}</em></p>", "{}<br><br>"]
    out = [f"<h1>{text()}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 25])):
        form = rng.choice(forms)
        if rng.random() < 0.06:
            form = rng.choice(EMBEDDED)
        elif rng.random() < 0.06:
            form = rng.choice(["<p>{} DRAWN {}</p>", "<p>DRAWN{}</p>", "<div>DRAWN</div><p>{}</p>", "DRAWN<p>{}</p>"]).replace("DRAWN", rng.choice(DRAWN))
        out.append(form.format(*[text() for _ in range(form.count("{}"))]))
        if rng.random() < 0.08:
            out.append(_boilerplate(rng))
    return "".join(out)


def page(seed: int) -> tuple[list[Block], list[bool]]:
    """Blocks of a page, and which of them are main text."""
    rng = random.Random(seed)
    tag = rng.choice(MAIN) if rng.random() < 0.95 else ""  # or right in the body
    wrappers = ["<div>", '<div class="wrapper">', '<div id="page">', '<div class="container row">', '<body class="single post">', '<div class="site main-column">']
    wrap = "".join(rng.sample(wrappers, rng.choice([0, 0, 1, 2])))
    inner = tag + _main(rng) + (_boilerplate(rng) if rng.random() < 0.15 else "") + _ends(tag)
    before = "".join(_boilerplate(rng) for _ in range(rng.choice([0, 1, 2, 3, 4])))
    after = "".join(_boilerplate(rng) for _ in range(rng.choice([0, 1, 1, 2, 4])))
    html = f"<html><head><title>{_words(rng, 5)}</title></head><body>{wrap}{before}{inner}{after}{_ends(wrap)}" + rng.choice(["</body></html>", ""])
    found = blocks(html)
    labels = [MARK in b.text for b in found]
    return [Block(b.text.replace(MARK, ""), b.path, b.link_chars) for b in found], labels

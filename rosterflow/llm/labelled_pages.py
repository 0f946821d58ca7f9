"""Pages whose elements are marked as content or not, to train the extraction from.

The mark ``data-y`` holds for an element and what is in it, unless that is marked anew. The words are
made up; what the pages teach is how layouts look.
"""

from __future__ import annotations

from itertools import count, product

LABEL = "data-y"
SYLLABLES = ("ba", "ke", "lo", "mi", "nu", "ra", "se", "ti", "vo", "zu")


class Filler:
    """Made-up sentences; each call goes on where the last one ended."""

    def __init__(self, seed: int):
        self.state = seed

    def number(self, below: int) -> int:
        self.state = (self.state * 1103515245 + 12345) % (1 << 31)
        return (self.state >> 8) % below

    def words(self, n: int) -> str:
        return " ".join("".join(SYLLABLES[self.number(10)] for _ in range(1 + self.number(4))) for _ in range(n))

    def sentence(self, n: int) -> str:
        return self.words(n).capitalize() + "."

    def paragraph(self) -> str:
        sizes = (1, 2, 4, 9, 15, 30)
        return " ".join(self.sentence(sizes[self.number(6)]) for _ in range(1 + self.number(5)))

    def links(self, n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{self.words(1)}">{self.words(1 + self.number(2))}</a></li>' for _ in range(n)) + "</ul>"


def article_body(f: Filler, style: int) -> str:
    """What an article holds: a title and paragraphs, and at times lists, quotes, tables or captions."""
    title = f"<h1>{f.sentence(6)}</h1>"
    parts = [f"<p>{f.paragraph()}</p>" for _ in range(2 + f.number(5))]
    extra = (
        "",
        f"<h2>{f.words(3)}</h2><ul><li>{f.sentence(5)}</li><li>{f.words(2)}</li></ul>",
        f"<blockquote>{f.paragraph()}</blockquote>",
        f"<pre>{f.words(9)}</pre><ol><li>{f.sentence(8)}</li><li>{f.sentence(3)}</li></ol>",
        f"<table><tr><th>{f.words(1)}</th><td>{f.words(2)}</td></tr></table>",
        f"<figure><figcaption>{f.sentence(5)}</figcaption></figure>",
        f'<div>{f.paragraph()}</div><p>{f.words(3)} <a href="/x">{f.words(4)}</a></p>',
    )[style % 7]
    inside = (
        "",
        f'<div class="ad" {LABEL}="0">{f.paragraph()}</div>',
        f'<aside {LABEL}="0"><h3>{f.words(2)}</h3>{f.links(3)}</aside>',
        f'<div class="share-buttons" {LABEL}="0">{f.links(3)}</div>',
        f'<form {LABEL}="0"><p>{f.sentence(6)}</p><label>{f.words(1)}</label></form>',
        f'<div class="related-posts" {LABEL}="0"><h4>{f.words(2)}</h4>{f.links(4)}</div>',
        f'<p class="notice" {LABEL}="0">{f.paragraph()}</p>',
        f'<nav class="toc" {LABEL}="0">{f.links(3)}</nav>',
        f'<div {LABEL}="0" class="user-comments"><h3>{f.words(1)}</h3><p>{f.paragraph()}</p><p>{f.paragraph()}</p></div>',
        f'<section {LABEL}="0" id="comments"><article class="comment"><p>{f.paragraph()}</p></article></section>',
        f'<footer {LABEL}="0"><p>{f.sentence(4)}</p></footer>',
        f'<header {LABEL}="0"><p>{f.words(3)}</p></header>',
    )[style % 12]
    middle = len(parts) // 2
    bare = f"<p><b>{f.sentence(5)}<br>" if style % 3 == 0 else ""
    return title + bare + "".join(parts[:middle]) + inside + extra + "".join(parts[middle:])


def around(f: Filler, style: int) -> tuple[str, str]:
    """What stands before and after the article, none of it content."""
    p, links = f.paragraph, f.links
    before = (
        f"<nav>{links(5)}</nav><!-- ad --><div class=ad>{p()}</div>",
        f"<header><h1>{f.words(2)}</h1><p>{f.sentence(5)}</p>{links(4)}</header>",
        f'<div id="header"><h2>{f.words(2)}</h2></div><div id="menu">{links(6)}</div>',
        f'<div class="cookie-banner"><p>{p()}</p></div><div role="navigation">{links(4)}</div>',
        f'<div class="site-header"><div class="logo">{f.words(1)}</div></div><div class="breadcrumbs">{f.words(1)} | {f.words(2)}</div>',
        f'<div class="topbar">{f.words(3)}</div><nav class="main-nav">{links(7)}</nav><div class="notice">{p()}</div>',
        f'<div class="advert"><p>{p()}</p></div><div class="popup">{p()}<p>{p()}</p></div>',
    )[style % 7]
    after = (
        f"<footer>&copy; {f.words(2)} &middot; {p()}</footer>",
        f'<section class="comments"><h2>{f.words(1)}</h2><div class="comment"><p>{p()}</p></div><div class="comment"><p>{p()}</p></div></section>'
        f"<footer><p>{p()}</p></footer>",
        f'<div class="sidebar"><h3>{f.words(2)}</h3><p>{p()}</p>{links(4)}</div><div id="footer">{p()}</div>',
        f'<aside><p>{p()}</p><p>{p()}</p></aside><div class="newsletter-signup"><p>{f.sentence(7)}</p></div>',
        f'<div id="comments"><ol><li><p>{p()}</p></li><li><p>{p()}</p></li></ol></div><form><p>{p()}</p></form>',
        f'<div class="related">{links(5)}</div><div class="sponsored"><p>{p()}</p></div><footer>{links(3)}<p>{p()}</p></footer>',
        f'<div style="display:none"><p>{p()}</p></div><div hidden>{p()}</div><div class="legal">{p()}</div>',
    )[(style // 2 + style) % 7]
    return before, after


def labelled_pages() -> list[str]:
    """Pages of every way to hold an article, with all kinds of things around it."""
    holders = (
        "<article {y}>{body}</article>",
        "<main><article {y}>{body}</article></main>",
        '<div class="content" {y}>{body}</div>',
        '<div id="main"><div class="post-body entry" {y}>{body}</div></div>',
        '<div class="wrapper"><section {y}>{body}</section></div>',
        "<main {y}>{body}</main>",
        '<div id="page"><div class="story" {y}>{body}</div></div>',
    )
    pages = []
    for style, (holder, turn) in zip(count(), product(holders, range(8))):
        f = Filler(style + 1)
        body = article_body(f, style)
        before, after = around(f, style + turn)
        inside = holder.replace("{y}", f'{LABEL}="1"').replace("{body}", body)
        pages.append(f"<html><head><title>{f.words(3)}</title></head><body>{before}{inside}{after}</body></html>")
    f = Filler(99)
    # Pages without any frame, and pages with nothing but a frame.
    pages += [f'<body {LABEL}="1"><h1>{f.words(3)}</h1>' + "".join(f"<p>{f.paragraph()}</p>" for _ in range(n)) + "</body>" for n in (1, 2, 5)]
    pages += [f"<body><nav>{f.links(4)}</nav><footer>{f.paragraph()}</footer></body>", f'<body><div class="menu">{f.links(5)}</div></body>']
    return pages

"""Leaf text blocks of a page, and labelled pages to learn from."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s>/]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden|aria-label)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Element names of HTML by their part in the layout.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong
    sub sup time tt u var wbr img br math mi mn mo mrow ms mspace mtext mfrac msqrt mroot msub msup msubsup""".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
#: Where a raw element ends; letters outside A-Z are not folded, so places stay those of the page.
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I | re.A) for name in RAW}
#: Elements that an implied end tag does not reach beyond.
WALLS = frozenset("article aside body div footer form header main nav section table ul ol dl blockquote figure".split())


@dataclass(frozen=True)
class Block:
    """Text of a leaf block, the part of it in links, and its ancestors, outermost first: tag and words of its attributes."""
    text: str
    linked: int
    ancestors: tuple[tuple[str, tuple[str, ...]], ...]


def attribute_words(raw: str) -> tuple[str, ...]:
    words = []
    for name, value in ATTRIBUTE.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name == "style":
            words += ["hidden"] if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else []
        elif name == "hidden" or name == "aria-hidden":
            words += ["hidden"] if value.lower() != "false" else []
        else:
            words += [w.lower() for w in PIECES.findall(value)]
    return tuple(words)


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order. Raw elements (scripts, styles, titles ...) and comments give none, and reach to the page's end where they are not
    closed, as in browsers. All other elements are ancestors, however they are closed: missing end tags are implied, a slash closes, and
    stray end tags are passed over. A line break counts as white space."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, at, page = 0, 0, 0, page or ""

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, linked, tuple(x for x in stack if x[0] not in INLINE)))
            parts.clear()
        linked = 0

    while (m := TOKEN.match(page, at)) is not None:
        at = m.end()
        name = m.group(2)
        if name is None:
            token = m.group()
            if token[0] != "<" or len(token) == 1:
                parts.append(token)
                if in_link:
                    linked += len(token.strip())
            continue
        name = name.lower()
        if m.group(1):
            if name not in INLINE:
                flush()
            if any(x[0] == name for x in stack):
                while stack:
                    top = stack.pop()[0]
                    in_link -= top == "a"
                    if top == name:
                        break
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            close = page.find(">", end.start()) if end else -1
            at = len(page) if close < 0 else close + 1
            if name not in INLINE:
                flush()
            continue
        if name == "br":
            parts.append(" ")
        if name not in INLINE:
            flush()
            shut = CLOSES.get(name, {"p"})
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    in_link -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                elif stack[k][0] in WALLS:
                    break
        if name not in VOID and not m.group(3).endswith("/"):
            stack.append((name, attribute_words(m.group(3)) if m.group(3) else ()))
            in_link += name == "a"
    flush()
    return out


# Frames of pages to learn from. {p} stands for paragraphs, {l} for links, {s} for a short line.
CONTENT = ["<article>{p}</article>", "<main>{p}</main>", '<div class="content">{p}</div>', '<div id="main-content">{p}</div>', '<div class="post-body entry">{p}</div>',
           '<section class="story">{p}</section>', '<div class="article-text">{p}</div>', "<main><article>{p}</article></main>", '<div><div class="text">{p}</div></div>',
           '<article class="post"><header><h1>{s}</h1></header>{p}</article>', "<article><section>{p}</section></article>", '<div role="main">{p}</div>']
NOISE_BEFORE = ["<nav><ul>{l}</ul></nav>", '<div class="menu">{l}</div>', '<ul id="nav">{l}</ul>', '<div class="breadcrumb">{l}</div>', "<header><p>{s}</p></header>",
                '<div id="header"><h2>{s}</h2></div>', '<div class="masthead">{s}</div>', '<div class="ad">{s}</div>', '<div class="ad"><p>{p1}</p></div>',
                '<div class="advert banner">{s}</div>', '<div class="ads">{p1}</div>', '<div class="cookie-notice"><p>{p1}</p></div>', '<div class="notice">{s}</div>',
                '<div class="alert" role="alert">{p1}</div>', '<form class="search"><label>{s}</label><p>{s}</p></form>', '<aside><p>{p1}</p></aside>', '<div class="sidebar">{p}</div>',
                '<div id="sidebar"><ul>{l}</ul></div>', '<div role="navigation">{l}</div>', '<div class="sponsored promo">{p1}</div>', '<div class="cookie-banner">{s}</div>',
                '<noscript><p>{p1}</p></noscript>', '<div class="toolbar"><button>{s}</button></div>', '<select><option>{s}</option><option>{s}</option></select>',
                '<div role="banner">{s}</div>', '<div style="display:none"><p>{p1}</p></div>', '<div class="consent popup">{p1}</div>']
NOISE_AFTER = ["<footer>{s}</footer>", "<footer><p>{p1}</p></footer>", '<div class="footer">{s}</div>', '<div id="footer"><p>{s}</p></div>', '<div class="related"><ul>{l}</ul></div>',
               '<div class="share social">{l}</div>', '<section class="comments"><h3>{s}</h3><div class="comment"><p>{p1}</p></div><div class="comment"><p>{p1}</p></div></section>',
               '<div id="comments"><ol><li class="comment">{p1}</li><li class="comment">{p1}</li></ol></div>', '<ul class="comment-list"><li><p>{p1}</p></li></ul>',
               '<div class="reader-comments"><article class="comment"><p>{p1}</p></article></div>', '<div class="newsletter subscribe"><p>{p1}</p></div>',
               "<form><p>{s}</p><p>{p1}</p></form>", '<div class="widget">{p1}</div>', '<aside class="related"><h3>{s}</h3><p>{p1}</p></aside>', '<div class="pagination">{l}</div>',
               '<div role="contentinfo">{s}</div>', '<div role="complementary"><p>{p1}</p></div>', '<div class="copyright">{s}</div>', '<div class="responses replies"><p>{p1}</p></div>']
NOISE_INSIDE = ['<div class="ad">{s}</div>', "<aside><p>{p1}</p></aside>", '<div class="advertisement">{p1}</div>', '<div class="share">{l}</div>', '<div class="related">{l}</div>',
                '<form><p>{s}</p></form>', '<div class="newsletter">{p1}</div>', "<footer><p>{s}</p></footer>", "<nav>{l}</nav>", '<div class="notice">{p1}</div>', "<button>{s}</button>",
                "<select><option>{s}</option><option>{s}</option></select>"]
PARAGRAPH = ["<p>{t}</p>"] * 6 + ["<h2>{t}</h2>", "<ul><li>{t}</li><li>{t}</li></ul>", "<blockquote><p>{t}</p></blockquote>", "<p><b>{t}<br>", "<div>{t}</div>", "<pre>{t}</pre>",
                                 "<table><tr><td>{t}</td><td>{t}</td></tr></table>", "<p>{t} <a href='#'>{t}</a> {t}</p>", "<h1>{t}</h1>", "<p><a href='#'>{t}</a></p>"]


def made_pages(n: int, seed: int = 7) -> list[tuple[str, list[bool]]]:
    """Pages put together from the frames, with the label of every block: True for the main text.

    Words are random letters on both sides, so only the structure tells main text from the rest.
    """
    rng = random.Random(seed)
    out = []
    for k in range(n):
        def words(low, high):
            return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 9))) for _ in range(rng.randint(low, high))) + rng.choice([".", ".", "", "!"])

        def fill(frame, mark):
            def text(low, high):
                return mark + words(low, high)
            frame = re.sub(r"\{p1\}", lambda _: text(3, 50), frame)
            frame = re.sub(r"\{s\}", lambda _: text(1, 9), frame)
            frame = re.sub(r"\{l\}", lambda _: "".join(f"<li><a href='#'>{text(1, 3)}</a></li>" for _ in range(rng.randint(2, 6))), frame)
            return re.sub(r"\{p\}", lambda _: "".join(re.sub(r"\{t\}", lambda _: text(*rng.choice([(1, 2), (3, 12), (20, 60)])), rng.choice(PARAGRAPH)) for _ in range(rng.randint(2, 8))), frame)

        body = fill(CONTENT[k % len(CONTENT)], "Ktrue")
        if rng.random() < 0.4:
            close = body.rfind("</")
            close = body.rfind("</", 0, close) if body.endswith(("</article></main>", "</div></div>", "</section></article>")) else close
            body = body[:close] + fill(rng.choice(NOISE_INSIDE), "Knoise") + body[close:]
        page = "".join(fill(f, "Knoise") for f in rng.sample(NOISE_BEFORE, rng.randint(1, 4))) + body + "".join(fill(f, "Knoise") for f in rng.sample(NOISE_AFTER, rng.randint(1, 4)))
        page = f"<html><head><title>{words(1, 8)}</title></head><body>{page}</body></html>"
        labels = ["Ktrue" in b.text for b in blocks_of(page)]
        out.append((page.replace("Ktrue", "").replace("Knoise", ""), labels))
    return out

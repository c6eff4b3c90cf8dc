"""Labelled pages to train the extraction model on.

Hand-written page layouts. ``y`` on an element says whether it and what is inside, up to the next
``y``, is article content (1) or not (0); it is a label, not a feature. (Of what is not content,
elements that hold some count as wrappers; see the model.) ``{p}`` stands for
paragraphs, ``{s}`` for a sentence, ``{w}`` for a word or two, ``{a}`` for some links in items.
"""

from __future__ import annotations

import random

LAYOUTS = (
    '<html y=0><head><title>{s}</title></head><body><nav><ul>{a}</ul></nav><div class="ad">{s}</div><article y=1><h1>{s}</h1>{p}</article><footer>&copy; {w} &middot; {s}</footer></body></html>',
    '<html y=0><body><header><h1>{w}</h1><ul>{a}</ul></header><main><article y=1><h2>{s}</h2>{p}<ul><li>{s}</li><li>{w}</li></ul>{p}</article><aside><h3>{w}</h3><ul>{a}</ul><p>{s}</p></aside></main><footer><p>{s}</p><ul>{a}</ul></footer></body></html>',
    '<html y=0><body><div id="header"><a href="/">{w}</a><div class="menu"><ul>{a}</ul></div></div><div id="content" y=1><h1>{s}</h1>{p}<blockquote>{s}</blockquote>{p}</div><div id="sidebar"><p>{s}</p><ul>{a}</ul></div><div id="footer"><p>{s}</p></div></body></html>',
    '<html y=0><body><div class="cookie-notice"><p>{s}</p><button>{w}</button></div><nav>{l}</nav><div class="wrap"><div class="post" y=1><h1>{s}</h1>{p}<div y=0 class="ad">{s}</div>{p}</div><section class="comments"><h2>{w}</h2><div class="comment"><p>{s}</p></div><div class="comment"><p>{s} {s}</p></div><form><label>{w}</label><textarea></textarea></form></section></div><footer>{s}</footer></body></html>',
    '<html y=0><body><div class="banner">{s}</div><article y=1><header y=0><nav><ul>{a}</ul></nav></header><h1>{s}</h1><section>{p}<h2>{w}</h2>{p}</section><pre>{s}</pre><table><tr><td>{w}</td><td>{s}</td></tr></table><footer y=0><p>{s}</p></footer></article><div id="comments"><h3>{w}</h3><ul><li><p>{s}</p></li><li><p>{s} {s}</p></li></ul></div></body></html>',
    '<html y=0><body><form><p>{w}</p><label>{w}</label></form><main y=1><h1>{s}</h1>{p}<ol><li>{s}</li><li>{s}</li></ol>{p}<aside y=0 class="related"><h4>{w}</h4><ul>{a}</ul></aside></main><div class="notice"><p>{s}</p></div></body></html>',
    '<html y=0><body><ul class="nav">{a}</ul><div class="article-body" y=1>{p}<h2>{w}</h2>{p}<figure><figcaption>{s}</figcaption></figure></div><div class="share">{l}</div><div class="newsletter"><p>{s}</p><form><label>{w}</label></form></div><div class="copyright">&copy; {w}</div></body></html>',
    '<html y=0><body><div class="top">{l}</div><div><h1 y=1>{s}</h1><p y=1>{s} {s}</p><p y=1>{s} {s} {s}</p><p y=1>{s} {s}</p></div><div class="promo"><p>{s}</p></div><div class="footer"><p>{w}</p></div></body></html>',
    '<html y=0><body><nav><ul>{a}</ul></nav><article y=1><h1>{s}</h1><p>{s}</p><p>{w}</p><div>{s} {s}</div><p>{w}</p><dl><dt>{w}</dt><dd>{s}</dd></dl></article><section id="reader-comments"><h2>{w}</h2><article class="comment"><p>{s}</p></article><article class="comment"><p>{s} {s} {s}</p></article></section><footer><div>{s}</div></footer></body></html>',
    '<html y=0><body><header><p>{s}</p></header><div class="alert"><p>{s}</p></div><section y=1><h1>{s}</h1>{p}</section><div class="advert"><div><p>{s} {s}</p></div></div><div class="sidebar"><div><h3>{w}</h3><p>{s} {s}</p></div></div><footer><p>{s} {s}</p></footer></body></html>',
)

WORDS = "the of river and letter market in was light house when from many years city work found after small water they could still every old road story under people told".split()


def labelled_pages(copies: int = 30, seed: int = 5) -> list[str]:
    """Every layout filled in with invented text, several times; the same at every call."""
    rng = random.Random(seed)

    def sentence(low: int = 4, high: int = 24) -> str:
        words = [rng.choice(WORDS) for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + rng.choice("...?!")

    def fill(layout: str) -> str:
        out, rest = "", layout
        while "{" in rest:
            before, _, after = rest.partition("{")
            kind, rest = after[0], after[2:]
            if kind == "p":
                made = "".join(f"<p>{' '.join(sentence(1, 18) for _ in range(rng.choice((1, 1, 2, 3, 5))))}</p>" for _ in range(rng.randint(1, 6)))
            elif kind == "s":
                made = sentence()
            elif kind == "w":
                made = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3)))
            else:
                links = [f'<a href="/{i}">{" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 4)))}</a>' for i in range(rng.randint(3, 8))]
                made = "".join(f"<li>{x}</li>" for x in links) if kind == "a" else " | ".join(links)
            out += before + made
        return out + rest

    return [fill(layout) for _ in range(copies) for layout in LAYOUTS]

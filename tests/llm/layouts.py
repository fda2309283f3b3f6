"""Pages of layouts the test tables lack, with their main text marked by hand."""

P = [
    "The committee met on Tuesday to discuss the new bridge, which has been delayed twice since spring.",
    "Engineers said that the foundations are sound, but that the steel for the second span arrived late.",
    "Residents on both sides of the river have waited for years. Many of them now take the ferry to work.",
    "A final decision is expected in autumn, when the council votes on the budget for the coming year.",
    "Until then, the old crossing stays open to cars on weekdays and closed to heavy lorries at all times.",
]
BODY = "".join(f"<p>{p}</p>" for p in P)
TEXT = "\n".join(P)
LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "World", "Sport", "Business", "Weather", "Contact"))
NAV = f"<nav><ul>{LINKS}</ul></nav>"
FOOT = "<footer><p>&copy; 2024 The Daily. All rights reserved.</p></footer>"
ROW = "".join(f'<a href="/{w}">{w}</a> ' for w in ("Older posts", "Newer posts", "Archive", "Imprint"))
AD = '<div class="ad">Buy two lamps and get one free today.</div>'
NOTICE = '<div class="cookie-notice"><p>We use cookies to make this site work. By staying here you agree to it.</p></div>'
COMMENTS = (
    '<section id="comments"><h3>3 comments</h3><ol class="comment-list">'
    '<li class="comment"><p>I have been waiting for this bridge since I was a child, and I doubt it will ever be built.</p></li>'
    '<li class="comment"><p>The ferry is fine, thank you very much. Nobody needs yet another road through the valley.</p></li>'
    '<li class="comment"><p>Who pays for all this? The council should say so before it votes on anything at all.</p></li></ol></section>'
)


def page(body: str, attributes: str = "") -> str:
    return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>A bridge | The Daily</title></head><body{attributes}>{body}</body></html>'


H1 = "A bridge for the valley"
LAYOUTS = [
    ("form around all", page(f'<form id="aspnetForm">{NAV}<article>{BODY}</article></form>{FOOT}'), TEXT),
    ("form around the article", page(f'{NAV}<form id="aspnetForm"><article>{BODY}</article></form>{FOOT}'), TEXT),
    ("form without landmarks", page(f'<form id="aspnetForm" action="/x">{NAV}<div id="c1"><div class="x2">{BODY}</div></div>{FOOT}</form>'), TEXT),
    ("header's name around the article", page(f'{NAV}<div class="post-header"><article>{BODY}</article></div>{FOOT}'), TEXT),
    ("header's name right around the text", page(f'{NAV}<div class="page-header">{BODY}</div>{FOOT}'), TEXT),
    ("article of unlucky name", page(f'{NAV}<article class="related-posts-enabled">{BODY}</article>{FOOT}'), TEXT),
    ("plain divs, links after", page(f'<div id="a"><div class="b">{BODY}</div><div class="c">{ROW}</div></div>'), TEXT),
    ("plain divs, links before", page(f'<div id="a"><div class="c"><ul>{LINKS}</ul></div><div class="b">{BODY}</div></div>'), TEXT),
    ("no divs at all", page(f"<ul>{LINKS}</ul>{BODY}<p>{ROW}</p>"), TEXT),
    ("body of unlucky name", page(f'{NAV}<div class="entry-content">{BODY}</div>{FOOT}', ' class="has-sidebar header-fixed comments-open"'), TEXT),
    ("main around menus", page(f"<main>{NAV}<article>{BODY}</article>{AD}</main>{FOOT}"), TEXT),
    ("comments below", page(f"{NAV}<article>{BODY}</article>{COMMENTS}{FOOT}"), TEXT),
    ("comments inside", page(f"{NAV}<article>{BODY}{COMMENTS}</article>{FOOT}"), TEXT),
    ("comments as articles", page(f'{NAV}<article>{BODY}</article><div><article class="comment"><p>{P[2]} Says who?</p></article></div>{FOOT}'), TEXT),
    ("sidebar with sentences", page(f'{NAV}<div class="content">{BODY}</div><div class="sidebar"><h3>About</h3><p>{P[3]} Read on.</p></div>{FOOT}'), TEXT),
    ("notice and advert", page(f"{NOTICE}{NAV}{AD}<article>{BODY}</article>{AD}{FOOT}"), TEXT),
    ("newsletter form inside", page(f'{NAV}<article>{BODY}<form class="newsletter"><label>Your address</label><button>Subscribe</button></form></article>{FOOT}'), TEXT),
    ("heading in the article's header", page(f"{NAV}<article><header><h1>{H1}</h1></header>{BODY}</article>{FOOT}"), f"{H1}\n{TEXT}"),
    ("heading", page(f"{NAV}{AD}<article><h1>{H1}</h1>{BODY}</article>{FOOT}"), f"{H1}\n{TEXT}"),
    ("microdata", page(f'{NAV}<div itemprop="articleBody">{BODY}</div>{FOOT}'), TEXT),
    ("formula", page(f"{NAV}<article>{BODY}<p>The formula <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds.</p></article>"), f"{TEXT}\nThe formula E=m holds."),
    ("without scripts", page(f"{NAV}<noscript><article>{BODY}</article></noscript>{FOOT}"), TEXT),
    ("fallbacks", page(f"{NAV}<article>{BODY}<p>See <object>the plan</object> and <canvas>the chart</canvas> here.</p></article>"), f"{TEXT}\nSee the plan and the chart here."),
    ("unknown elements in a line", page(f"{NAV}<article>{BODY}<p>Press the <button>red</button> <x-key>key</x-key> and <label>wait</label> a while.</p></article>"), f"{TEXT}\nPress the red key and wait a while."),
]

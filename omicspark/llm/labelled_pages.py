"""Small labelled pages to train HTML extraction on.

An element with ``data-main="1"`` is main text with all below it, until one with
``data-main="0"``. The attribute is never a feature. Fixed values: the layouts
name the usual ways in which pages mark articles and what surrounds them.
"""

_LONG = "The committee met on Tuesday and agreed, after some debate, that the plan should go ahead. Members asked for figures; none were ready. A second report, longer and more careful than the first, is due before the end of the month, and a vote will follow when all have read it."
_MORE = "Prices rose again in the north, while in the south, where harvests were good, they fell. Traders said that they had not seen such a gap for ten years."
_LINE = "Nobody was hurt."
_HEAD = '<head><meta charset="utf-8"><title>A plan goes ahead</title><style>p{margin:0}</style><script>var a = 1;</script></head>'
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li><li><a href="/contact">Contact</a></li></ul>'
_COMMENT = '<div class="comment"><p>I do not agree at all with what was written here, it is quite wrong.</p></div><div class="comment"><p>Thanks, well said!</p></div>'

LABELLED_PAGES = (
    f'<html>{_HEAD}<body><nav>{_MENU}</nav><div class="ad">Buy one, get one free.</div><article data-main="1"><h1>A plan goes ahead</h1><p>{_LONG}</p><p>{_MORE}</p><p>{_LINE}</p></article><footer>&copy; example.com &middot; All rights reserved.</footer></body></html>',
    f'<html>{_HEAD}<body><nav>{_MENU}</nav><div class="ad">Now only today: shoes and hats for little money.</div><article data-main="1"><h1>Short</h1><p><b>{_LINE}<br><p>{_LONG}</p></article><footer>&copy; m.example.com &middot; {_LINE}</footer></body></html>',
    f'<html>{_HEAD}<body><header><h1>The Daily</h1><p>News since 1901</p></header><nav class="menu">{_MENU}</nav><main><article data-main="1"><h2>Prices</h2><p>{_MORE}</p><p>{_LONG}</p><blockquote><p>{_LINE}</p></blockquote><ul><li>{_MORE}</li><li>{_LINE}</li></ul><div class="advert" data-main="0"><p>Advertisement: {_LINE}</p></div><p>{_MORE}</p></article><aside class="sidebar"><h3>Related</h3>{_MENU}</aside></main><section class="comments"><h3>Comments</h3>{_COMMENT}</section><footer class="footer"><p>Imprint and terms of use</p></footer></body></html>',
    f'<html>{_HEAD}<body><div id="header" class="header"><a href="/">Site name</a></div><div id="nav" class="nav navigation">{_MENU}</div><div id="wrapper" class="container"><div id="content" class="content" data-main="1"><h1>Report</h1><p>{_LONG}</p><h2>More</h2><p>{_MORE} See <a href="/x">the figures</a>.</p><table><thead><tr><th>Place</th><th>Price</th></tr></thead><tbody><tr><td>North</td><td>12</td></tr><tr><td>South</td><td>9</td></tr></tbody></table></div><div id="sidebar" class="sidebar widget"><h3>Popular</h3>{_MENU}<p>Subscribe to our letter.</p></div></div><div id="comments" class="comments">{_COMMENT}<form><label>Your name</label><input name="n"><textarea>Write here</textarea><button>Send</button></form></div><div id="footer" class="footer">Copyright 2020. All rights reserved.</div></body></html>',
    f'<html>{_HEAD}<body><div class="cookie notice banner"><p>We use cookies to make this site better. By going on you agree.</p><button>Accept</button></div><div class="topbar"><form class="search"><input><button>Search</button></form></div><div class="post entry" data-main="1"><h1 class="title">Harvest</h1><div class="post-body entry-content"><p>{_LONG}</p><p>{_LONG}</p><p>{_MORE}</p><figure><img><figcaption>{_LINE}</figcaption></figure></div><div class="share social" data-main="0"><a href="#">Share</a> <a href="#">Tweet</a></div></div><div class="related"><h3>Read also</h3>{_MENU}</div><div class="ads sponsored"><p>{_MORE}</p></div><div class="footer copyright"><p>{_LINE}</p></div></body></html>',
    f'<html><body><div class="page"><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">News</a></div><div class="main story" data-main="1"><h1>A day</h1><p>{_MORE}</p><p>{_LONG}</p><ol><li>{_LINE}</li><li>{_MORE}</li></ol><pre>a = b + c</pre></div><div class="newsletter signup subscribe"><p>Sign up and never miss a story: it is free and takes a minute of your time.</p><form><input><button>Go</button></form></div></div><div class="notice alert"><p>{_LINE} This site will be down on Sunday.</p></div></body></html>',
    f'<html>{_HEAD}<body data-main="1"><h1>Plain</h1><p>{_LONG}</p><p>{_MORE}</p></body></html>',
    f'<body data-main="1">{_LONG} {_MORE}</body>',
    f'<div data-main="1"><p>{_LONG}</p><p>{_LINE}</p></div>',
    f'<html><body><main data-main="1"><section><h2>One</h2><p>{_LONG}</p></section><section><h2>Two</h2><p>{_MORE}</p><dl><dt>North</dt><dd>{_LINE}</dd></dl></section></main><footer><nav>{_MENU}</nav><p>{_MORE}</p></footer></body></html>',
    f'<html>{_HEAD}<body><header><nav>{_MENU}</nav></header><aside><p>{_LONG}</p>{_MENU}</aside><article data-main="1"><header><h1>With a header</h1></header><p>{_LONG}</p><p>{_MORE}</p><p><a href="/y">{_LINE}</a></p></article><form><label>Email</label><p>{_MORE}</p></form><section id="comments">{_COMMENT}<article class="comment"><p>{_LONG}</p></article></section><footer><p>{_LONG}</p></footer></body></html>',
    f'<html>{_HEAD}<body><div class="promo banner"><p>{_LONG}</p></div><div class="text body" data-main="1"><p>{_LINE}</p><p>{_LINE}</p><p>{_MORE}</p><div><p>{_LONG}</p></div></div><div class="reviews responses discussion"><p>{_LONG}</p><p>{_MORE}</p></div><div class="popup modal overlay"><p>{_MORE}</p></div></body></html>',
    f'<html>{_HEAD}<body><nav>{_MENU}</nav><div class="ad">{_LONG}</div><article data-main="1"><h1>{_LINE}</h1><p><b>{_LINE}<br></article><footer>&copy; example.com &middot; {_MORE}</footer>',
    f'<html>{_HEAD}<body><nav>{_MENU}{_MENU}</nav><div class="ad">{_LINE}</div><article data-main="1"><h1>{_LINE}</h1><p><b>{_LINE}<br><p>{_LINE}</p><p>Yes.</p><p><b>{_MORE}<br><p>{_LONG}</p></article><footer>&copy; www.example.com &middot; {_LONG}</footer></body></html>',
    f'<html>{_HEAD}<body><div class="nav">{_MENU}</div><div class="content" data-main="1"><p>Yes.</p></div><div class="sidebar"><p>{_MORE}</p></div><div class="footer">{_LONG}</div></body></html>',
    f'<html>{_HEAD}<body><header>{_MENU}</header><main data-main="1"><h1>Hm.</h1><p>{_LINE}</p><ul><li><a href="/a">North</a></li><li><a href="/b">South</a></li></ul></main><aside><p>{_LONG}</p></aside><footer><p>{_LINE}</p></footer></body></html>',
    f'<html>{_HEAD}<body><table><tr><td class="top banner" colspan="2"><b>Site</b></td></tr><tr><td class="left navigation"><a href="/1">One</a><br><a href="/2">Two</a><br><a href="/3">Three</a></td><td class="main" data-main="1"><h1>Old ways</h1><p>{_LONG}<p>{_LINE}</td></tr><tr><td class="bottom" colspan="2">{_LINE}</td></tr></table></body></html>',
    f'<html>{_HEAD}<body><table class="layout"><tr><td><a href="/1">One</a> | <a href="/2">Two</a></td></tr><tr><td data-main="1"><p>{_MORE}</p><p>{_LONG}</p></td></tr></table></body></html>',
    f'<html>{_HEAD}<body><div id="site"><div class="main"><div data-main="1" class="article"><h1>One</h1><p>{_LONG}</p><div class="ad ad-box" data-main="0"><p>{_LINE}</p></div><p>{_MORE}</p><div class="author bio" data-main="0"><p>{_MORE}</p></div></div><ol class="comment-list"><li class="comment"><p>{_LONG}</p></li><li class="comment"><p>{_LINE}</p></li></ol></div></div></body></html>',
    f'<html><body><div role="main"><div data-main="1"><h1>Two</h1><p>{_MORE}</p><p>{_LINE}</p></div><div class="commenting"><ol><li><p>{_MORE}</p></li><li><p>{_LINE}</p></li></ol></div><div class="advertising"><p>{_LONG}</p></div></div></body></html>',
    f'<html><body><main data-main="1"><h1>Three</h1><p>{_MORE}</p><div class="advertisement" data-main="0"><p>{_LINE}</p></div><p>{_LONG}</p><ul class="comments" data-main="0"><li><p>{_MORE}</p></li></ul></main></body></html>',
    f'<html><body data-main="1"><p>{_LINE}</p></body></html>',
    '<body data-main="1">Yes.</body>',
    f'<p data-main="1">{_LONG}</p>',
)

# Words that name what surrounds main text, or stands within it without being part of it.
_NOISE = (
    "advert advertising adslot banner-ad promo promotion promoted sponsor sponsored partner-content outbrain taboola teaser upsell donate paywall offer deals",
    "newsletter newsletter-signup subscribe subscription mailing-list signup join-us follow-us follow social share sharing share-bar socials addthis",
    "related related-posts more-stories recommended recommendations popular trending most-read latest recent read-next also-like see-also suggestions",
    "consent cookie cookies gdpr privacy-notice notice alert announcement banner info-bar toast popup modal overlay dialog survey poll feedback quiz",
    "comment comments comments-area reply replies respond discussion disqus feedback-list reviews review ratings rating guestbook",
    "byline author-box author-bio bio about-author meta post-meta tags tag-list taglist categories breadcrumb breadcrumbs pagination pager page-nav skip-link print-link toolbar",
    "sidebar side-column rail widget widgets widget-area aside secondary nav navbar menu submenu topnav footer footer-links colophon copyright legal disclaimer imprint masthead branding login search search-form",
)
# Words that name main text.
_MAIN = "article article-body article-text post post-body entry entry-content story story-body content page-content body-text text main main-text prose markdown description section-body report paper document document-body lead chapter".split()
_SHORT = ("Get the best of our stories in your inbox.", "We use cookies on this site.", "Tell your friends about this.", "Three things to read today", "This offer ends soon, so order now.", "Your view counts: what do you say?")


def _about(main: str, names: str, at: int) -> str:
    """A page with one element for each name, in turn before, within and after the main text; one in three is a paragraph long."""
    own = names.split()
    texts = [_LONG if i % 3 == at % 3 else _SHORT[(i + at) % len(_SHORT)] for i in range(len(own))]
    kinds = [("div", "<p>", "</p>"), ("aside", "<p>", "</p>"), ("section", "<h3>", "</h3>"), ("div", '<a href="#">', "</a> <input><button>Go</button>"), ("div", "", "")]
    parts = []
    for i, (name, text) in enumerate(zip(own, texts)):
        tag, a, b = kinds[(i + at) % len(kinds)]
        named = f'id="{name}"' if (i + at) % 4 == 1 else f'class="{name}"'
        parts.append(f'<{tag} {named} data-main="0">{a}{text}{b}</{tag}>')
    before, within, after = parts[0::3], parts[1::3], parts[2::3]
    whole = [f"<p>{_LONG}</p>", f"<p>{_MORE}</p>", f"<h2>{_LINE}</h2>", f"<p>{_LINE} {_MORE}</p>", f"<ul><li>{_MORE}</li><li>{_LINE}</li></ul>", f"<p>{_LONG}</p>"]
    body = "".join(x for pair in zip(whole, within + [""] * len(whole)) for x in pair) + "".join(within[len(whole) :])
    tag = "article" if at % 2 else "div"
    return f'<html>{_HEAD}<body>{"".join(before)}<{tag} class="{main}" data-main="1"><h1>{_LINE}</h1>{body}</{tag}>{"".join(after)}</body></html>'


LABELLED_PAGES += tuple(_about(_MAIN[(7 * i + at) % len(_MAIN)], names, at) for i, names in enumerate(_NOISE) for at in range(4))
LABELLED_PAGES += (
    f'<html>{_HEAD}<body><article data-main="1"><h1>{_LINE}</h1><p>{_LONG}</p><aside data-main="0"><p>{_MORE}</p></aside><p>{_MORE}</p><aside data-main="0">{_LINE}</aside><p>{_LONG}</p></article></body></html>',
    f'<html>{_HEAD}<body><aside data-main="0"><h3>{_LINE}</h3><ul><li>{_LINE}</li></ul></aside><main data-main="1"><p>{_LONG}</p><aside data-main="0"><p>{_LONG}</p></aside><p>{_LINE}</p></main></body></html>',
    f'<div data-main="1">{_LONG}<br><br>{_MORE}<br><br>{_LINE}</div>',
    f'<html>{_HEAD}<body><div id="text" data-main="1">{_LINE}<br><br>{_LINE}<br><br>{_LINE}</div></body></html>',
    f'<html><body><nav>{_MENU}</nav><div data-main="1">{_LONG}<br><br>{_MORE}</div><footer>{_LINE}</footer></body></html>',
    f'<div data-main="1">{_LINE}</div>',
    f'<p data-main="1">{_LINE}</p>',
    f'<body data-main="1"><p>{_LINE}</p><p>{_LINE}</p></body>',
)
# Main text in elements that no name tells.
LABELLED_PAGES += tuple(
    f'<html>{_HEAD}<body>{before}<{tag} data-main="1">{head}{text}</{tag}>{after}</body></html>'
    for tag, head in (("div", f"<h1>{_LINE}</h1>"), ("section", f"<h2>{_LINE}</h2>"), ("div", ""), ("main", f"<h1>{_LINE}</h1>"))
    for before, text, after in (
        (f"<nav>{_MENU}</nav>", f"<p>{_LONG}</p><p>{_MORE}</p>", f"<footer>{_LINE}</footer>"),
        (f"<div>{_MENU}</div>", f"<p>{_MORE}</p><h3>{_LINE}</h3><p>{_LONG}</p><ol><li>{_MORE}</li><li>{_LINE}</li></ol>", f'<div class="footer"><p>{_LINE}</p></div>'),
        (f'<div class="header"><a href="/">{_LINE}</a></div>', f"<pre>{_LINE}</pre><p>{_LONG}</p><table><tr><td>North</td><td>12</td></tr></table><dl><dt>South</dt><dd>9</dd></dl>", ""),
        ('<form><input name="q"><button>Find</button></form>', f"{_LONG}<br><br>{_MORE}", f"<aside><p>{_LINE}</p></aside>"),
    )
)
# One notice at a time, amid an article.
LABELLED_PAGES += tuple(
    f'<html>{_HEAD}<body><article data-main="1"><h1>{_LINE}</h1><p>{_LONG}</p>{notice}<p>{_MORE}</p>{notice}<p>{_LINE}</p></article></body></html>'
    for notice in (
        f'<aside data-main="0">{_MORE}</aside>',
        f'<aside data-main="0">{_SHORT[3]}</aside>',
        *(f'<div class="{name}" data-main="0">{_SHORT[i % len(_SHORT)]}</div>' for i, name in enumerate("newsletter promo sponsored share subscribe related advert consent signup social".split())),
    )
)

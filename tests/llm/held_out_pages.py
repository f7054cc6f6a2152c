"""Pages of layouts that training doesn't hold, each with the blocks of its main text."""

A = "The bridge was closed for nine days while divers looked at the piers, and buses took the long way round by the mill."
B = "Engineers found two cracks, neither of them deep. They say that both can be filled before winter, at little cost."
C = "Shops on the far bank lost a third of their trade in that week; some want to be paid for it."
D = "It opened again on Monday."

HELD_OUT = (
    # a weblog with a masthead, a byline and a blogroll
    (
        f'<!doctype html><html><head><title>t</title></head><body class="home"><div id="masthead"><h1><a href="/">My log</a></h1><p>Notes from a small town</p></div><div id="page"><div class="hentry"><h2 class="entry-title">Bridge</h2><div class="entry"><p>{A}</p><p>{B}</p><p>{D}</p></div></div><div id="blogroll" class="sidebar"><h4>Links</h4><ul><li><a href="/1">Anna</a></li><li><a href="/2">Bert</a></li></ul></div></div><div id="colophon" class="footer"><p>Powered by a kettle. All rights reserved.</p></div></body></html>',
        ["Bridge", A, B, D],
    ),
    # a paper: header with several bars, related stories amid the text, a sign-up form
    (
        f'<html><body><header class="site-header"><div class="logo"><a href="/">Courier</a></div><nav aria-label="main"><a href="/n">News</a> <a href="/s">Sport</a> <a href="/w">Weather</a></nav></header><main id="main"><article class="story"><h1>Bridge to stay shut</h1><p>{A}</p><aside class="related"><h3>More on this</h3><ul><li><a href="/a">The mill</a></li><li><a href="/b">The buses</a></li></ul></aside><p>{B}</p><p>{C}</p></article><form class="newsletter"><p>Get our letter each morning, free of charge.</p><input><button>Go</button></form></main><footer class="site-footer"><ul><li><a href="/t">Terms</a></li><li><a href="/p">Privacy</a></li></ul><p>Courier Ltd.</p></footer></body></html>',
        ["Bridge to stay shut", A, B, C],
    ),
    # an encyclopedia: tables, lists and links in the text
    (
        f'<html><body><div id="mw-navigation" class="navigation"><ul><li><a href="/">Main page</a></li><li><a href="/r">Random</a></li></ul></div><div id="content" class="body"><h1>Mill bridge</h1><p>{A} It is named for the <a href="/mill">old mill</a>.</p><table><tr><th>Length</th><td>210 m</td></tr><tr><th>Opened</th><td>1911</td></tr></table><h2>History</h2><p>{B}</p><ul><li>{C}</li><li>{D}</li></ul></div><div id="footer"><p>Text is free to use.</p></div></body></html>',
        ["Mill bridge", f"{A} It is named for the old mill.", "Length", "210 m", "Opened", "1911", "History", B, C, D],
    ),
    # documentation with a table of contents beside it and code
    (
        f'<html><body><div class="navbar"><a href="/">Docs</a></div><div class="sidebar toc"><ul><li><a href="#a">Setup</a></li><li><a href="#b">Use</a></li></ul></div><div class="document"><section id="a"><h1>Setup</h1><p>{A}</p><pre>make all\nmake test</pre></section><section id="b"><h2>Use</h2><p>{B}</p></section></div><div class="footer">Built yesterday.</div></body></html>',
        ["Setup", A, "make all make test", "Use", B],
    ),
    # cookies, adverts by data attributes, comments as an ordered list
    (
        f'<html><body><div id="cookie-notice" role="dialog"><p>This site keeps cookies to count its readers. Do you agree?</p><button>Yes</button></div><div id="wrap"><div role="main"><h1>Bridge</h1><p>{A}</p><div class="ad-slot"><p>Boots at half price, only today!</p></div><p>{B}</p></div><ol class="commentlist"><li class="comment"><p>I walk there each day and saw no crack.</p></li><li class="comment"><p>They should have asked us first, as ever.</p></li></ol></div></body></html>',
        ["Bridge", A, B],
    ),
    # a page of an age when layout was by tables
    (
        f'<html><body bgcolor="#ffffff"><table width="100%"><tr><td colspan="2"><div class="banner"><b>THE TOWN PAGES</b></div></td></tr><tr><td class="menu"><a href="a.html">Home</a><br><a href="b.html">Map</a><br><a href="c.html">Guests</a></td><td class="content"><h1>The bridge</h1><p>{A}<p>{B}<p>{D}</td></tr></table></body></html>',
        ["The bridge", A, B, D],
    ),
    # nothing but paragraphs, no names at all
    (f"<html><body><h1>Bridge</h1><p>{A}</p><p>{B}</p><p>{C}</p><p>{D}</p></body></html>", ["Bridge", A, B, C, D]),
    # reviews below a product text, a search form above
    (
        f'<html><body><div class="search"><form><input name="q"><button>Find</button></form></div><div itemscope class="product-description text"><h1>Lamp</h1><p>{A}</p><p>{C}</p></div><div id="reviews" class="reviews"><h3>What buyers say</h3><div class="review"><p>Broke after two days, would not buy it again.</p></div><div class="review"><p>Lovely light.</p></div></div><nav class="pagination"><a href="?p=2">Next</a></nav></body></html>',
        ["Lamp", A, C],
    ),
    # unclosed elements, upper-case tags, a skip link
    (
        f'<HTML><BODY><A HREF="#m" CLASS="skip-link">Skip to text</A><UL CLASS="nav"><LI><A HREF="/">Home</A><LI><A HREF="/x">X</A></UL><DIV CLASS="article-body" ID="m"><H1>Bridge</H1><P>{A}<P>{B}<BLOCKQUOTE><P>{D}</BLOCKQUOTE></DIV><DIV CLASS="copyright">(c) The town</DIV>',
        ["Bridge", A, B, D],
    ),
    # sharing buttons, tags and an author box around the text
    (
        f'<html><body><div class="share-buttons"><a href="#">Post</a> <a href="#">Mail</a></div><article><header><h1>Bridge</h1></header><div class="article-content"><p>{A}</p><p>{B}</p><figure><img src="x"><figcaption>{D}</figcaption></figure></div></article><div class="tags"><a href="/t/1">bridges</a> <a href="/t/2">towns</a></div><section class="comments-area"><h2>2 replies</h2><p>No need for all that fuss, it will hold.</p></section><div class="widget recent-posts"><h3>Recent</h3><ul><li><a href="/9">Mills</a></li></ul></div></body></html>',
        ["Bridge", A, B, D],
    ),
)

# Written after the training pages were last changed, and measured once.
FRESH = (
    (
        f'<html><body class="single"><div class="top-bar"><span>Call us: 555</span></div><div id="branding"><a href="/">Valley Gazette</a></div><div class="breadcrumbs"><a href="/">Home</a> / <a href="/l">Local</a></div><div class="single-post"><h1>Bridge shut</h1><div class="post-content"><p>{A}</p><h3>Cracks</h3><p>{B}</p><p>{C}</p></div><div class="subscribe-box"><p>Never miss a story, join our readers today.</p></div></div><div class="footer-widgets"><p>About this paper and its owners.</p></div></body></html>',
        ["Bridge shut", A, "Cracks", B, C],
    ),
    (
        f'<html><body><nav class="navbar"><ul><li><a href="/">Start</a></li></ul></nav><div class="alert alert-warning"><p>The site is slow today, we are sorry.</p></div><section class="story-body"><h1>Bridge</h1><p>{A}</p><p>{D}</p></section><div class="promo"><p>Win a week at the lake!</p></div><div id="disqus_comments"><div class="comment-body"><p>Well, who pays for it in the end?</p></div></div></body></html>',
        ["Bridge", A, D],
    ),
    (
        f'<html><body><div class="layout"><div class="col-left"><ul class="menu"><li><a href="/1">Rivers</a></li><li><a href="/2">Roads</a></li></ul></div><div class="col-main"><h2>Bridge</h2><p>{B}</p><ol><li>{C}</li><li>{D}</li></ol><dl><dt>Length</dt><dd>210 m</dd></dl></div></div><address>Town hall, Mill Lane</address></body></html>',
        ["Bridge", B, C, D, "Length", "210 m"],
    ),
    (
        f'<html><body><header role="banner"><p>Reports of the council</p></header><div role="navigation"><a href="/a">All reports</a></div><div role="main" class="report"><h1>Report 12</h1><p>{A}</p><table><thead><tr><th>Pier</th></tr></thead><tbody><tr><td>North</td></tr></tbody></table><p>{C}</p></div><div role="contentinfo"><p>Council press office</p></div><div role="complementary" class="sponsor"><p>Paid for by the brewers.</p></div></body></html>',
        ["Report 12", A, "Pier", "North", C],
    ),
)

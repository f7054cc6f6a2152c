"""Twenty more layouts, written before the training pages were last changed and not used to change them, each with the blocks of its main text."""

A = "The ferry left at dawn with forty people on board, most of them on the way to the market."
B = "By noon the wind had turned, and the captain chose to wait behind the island until evening."
C = "No one complained: there was soup, and somebody had brought a fiddle."
D = "They landed after dark."

UNSEEN = (
    (f'<html><body><div class="site-nav"><a href="/">Start</a></div><div class="news-item"><h1>Ferry</h1><p>{A}</p><p>{B}</p></div><div class="site-info">Harbour office</div></body></html>', ["Ferry", A, B]),
    (f'<html><body><article class="h-entry"><h1 class="p-name">Ferry</h1><div class="e-content"><p>{A}</p><p>{C}</p></div></article><div class="webmentions"><p>Anna liked this.</p></div></body></html>', ["Ferry", A, C]),
    (f'<html><body><header class="page-header"><a href="/">Harbour news</a></header><main class="page-main"><h1>Ferry</h1><p>{A}</p><div class="inline-ad"><p>Buy a boat.</p></div><p>{B}</p><p>{D}</p></main><footer class="page-footer"><p>Write to us.</p></footer></body></html>', ["Ferry", A, B, D]),
    (f'<html><body><div id="container"><div id="left"><ul><li><a href="/1">Boats</a></li><li><a href="/2">Nets</a></li></ul></div><div id="middle"><h2>Ferry</h2><p>{A}</p><p>{B}</p><p>{C}</p></div></div></body></html>', ["Ferry", A, B, C]),
    (f'<html><body><section class="hero"><h1>Ferry</h1></section><section class="copy"><p>{A}</p><p>{B}</p></section><section class="cta"><p>Book a trip today!</p><a href="/b">Book</a></section></body></html>', ["Ferry", A, B]),
    (f'<html><body><div class="wp-block-group"><h1>Ferry</h1><p class="wp-block-paragraph">{A}</p><p class="wp-block-paragraph">{B}</p></div><div id="comments"><h2>Comments</h2><ol class="comment-list"><li><p>I was on it.</p></li></ol></div></body></html>', ["Ferry", A, B]),
    (f'<html><body><ul class="breadcrumbs"><li><a href="/">Home</a></li></ul><div class="detail"><h1>Ferry</h1><p>{A}</p><blockquote>{C}</blockquote><p>{D}</p></div><div class="social-links"><a href="#">Send</a></div></body></html>', ["Ferry", A, C, D]),
    (f'<html><body><article><h1>Ferry</h1><p>{A}</p><figure><img src="f.png"><figcaption>{D}</figcaption></figure><p>{B}</p><div class="article-tags"><a href="/t">ferries</a></div></article></body></html>', ["Ferry", A, D, B]),
    (f'<html><body><nav><a href="/">Home</a></nav><p>{A}</p><p>{B}</p><p>{C}</p><nav><a href="/2">Next</a></nav></body></html>', [A, B, C]),
    (f'<html><body><div role="banner">Harbour</div><div role="main"><h1>Ferry</h1><p>{A}</p><table><tr><td>Dawn</td><td>Dark</td></tr></table></div><div role="contentinfo">Since 1950</div></body></html>', ["Ferry", A, "Dawn", "Dark"]),
    (f'<html><body><div class="cookie-banner"><p>We store small files on your machine.</p></div><div class="post-single"><h1>Ferry</h1><p>{A}</p><p>{B}</p><div class="related-articles"><h4>More</h4><a href="/n">Nets</a></div></div></body></html>', ["Ferry", A, B]),
    (f'<html><body><table><tr><td width="150"><a href="/a">Boats</a><br><a href="/b">Nets</a></td><td><h1>Ferry</h1><p>{A}</p><p>{B}</p></td></tr></table></body></html>', ["Ferry", A, B]),
    (f'<html><body><div class="question"><h1>Which ferry?</h1><p>{A}</p></div><div class="site-footer"><p>All content as it is.</p></div></body></html>', ["Which ferry?", A]),
    (f'<html><body><main><article><h1>Ferry</h1><p>{A}</p><form class="newsletter-form"><p>Letters each week.</p><input></form><p>{B}</p></article><aside><p>Weather: wind.</p></aside></main></body></html>', ["Ferry", A, B]),
    (f'<html><body><pre>{A}</pre><pre>{B}</pre></body></html>', [A, B]),
    (f'<html><body><div class="top"><form><input name="q"></form></div><div class="recipe"><h1>Soup</h1><ol><li>{C}</li><li>{D}</li></ol><p>{A}</p></div><div class="user-reviews"><p>Too salty.</p></div></body></html>', ["Soup", C, D, A]),
    (f'<html><body><div class="lesson-content"><h1>Ferry</h1><h2>Morning</h2><p>{A}</p><h2>Noon</h2><p>{B}</p></div><div class="lesson-nav"><a href="/2">Next lesson</a></div></body></html>', ["Ferry", "Morning", A, "Noon", B]),
    (f'<html><body><div id="header-wrap"><h2><a href="/">Harbour log</a></h2></div><div id="main-wrap"><div class="post hentry"><h3 class="post-title">Ferry</h3><div class="post-body">{A}<br><br>{B}</div></div></div><div id="footer-wrap">Theme by a friend.</div></body></html>', ["Ferry", f"{A} {B}"]),
    (f'<html><body><div class="ad-container"><p>Cheap ropes.</p></div><section itemprop="articleBody"><p>{A}</p><p>{B}</p><p>{D}</p></section><div class="subscribe-prompt"><p>Read all for a coin a week.</p></div></body></html>', [A, B, D]),
    (f'<html><body><div class="press-release"><h1>Ferry</h1><p>{A}</p><p>{B}</p><dl><dt>Start</dt><dd>Dawn</dd></dl></div><div class="contact-box"><p>Ask the office.</p></div></body></html>', ["Ferry", A, B, "Start", "Dawn"]),
)

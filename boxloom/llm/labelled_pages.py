"""Labelled pages to train the extraction model on: `keep="1"` marks content, `keep="0"` the rest; children inherit.

Made up for training; texts are filler. Forms of the same parts vary over pages.
"""

LONG = "The harbour was quiet in the early morning and the boats lay in two rows along the wall, while the first carts came down from the town with salt and rope. "
MID = "Nobody had expected the bridge to be finished before the winter. "
SHORT = "A short remark."

_HEADS = [
    '<head keep="0"><meta charset="utf-8"><title>The harbour</title><style>p{margin:0}</style><script>var t="</p>";</script></head>',
    '<head keep="0"><title>News of the day</title><link rel="stylesheet" href="/s.css"></head>',
]
_BEFORE = [
    '<nav keep="0"><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li><a href="/c">Sport</a></li></ul></nav><!-- ad 1 --><div class="ad" keep="0">Buy two, get one free today.</div>',
    '<header keep="0"><h1><a href="/">The Daily Filler</a></h1><p>News for everyone, since long ago.</p></header><div id="menu" keep="0"><a href="/x">One</a> <a href="/y">Two</a></div>',
    '<div class="cookie-notice" keep="0"><p>We use cookies to make this site work. By going on you agree to our use of them.</p><button>Agree</button></div>',
    '<div class="topnav" keep="0"><a href="/">Start</a><a href="/p">Politics</a></div><form keep="0" action="/search"><label>Search</label><input name="q"><button>Go</button></form>',
    '<div role="banner" class="site-header" keep="0">Filler Times</div><div class="breadcrumb" keep="0"><a href="/">Home</a> / <a href="/n">News</a></div>',
    "",
]
_AFTER = [
    '<footer keep="0">&copy; example.com &middot; All rights reserved. Terms apply to every page.</footer>',
    '<aside keep="0"><h2>Related</h2><ul><li><a href="/1">Another story about boats</a></li><li><a href="/2">What the town said</a></li></ul></aside><div id="footer" keep="0">Imprint and contact</div>',
    f'<section class="comments" keep="0"><h3>Comments</h3><div class="comment"><p>{LONG}</p></div><div class="comment"><p>{SHORT}</p></div></section><footer keep="0"><p>Contact us</p></footer>',
    f'<div id="disqus_thread" keep="0"><ol><li>Reader: {MID}</li></ol></div>',
    '<div class="sidebar widget" keep="0"><p>Most read this week</p><ul><li><a href="/3">Third</a></li></ul></div><div class="newsletter" keep="0"><form><p>Sign up for our letter, every week in your mail.</p><input></form></div>',
    '<div class="share social" keep="0"><a href="/t">Share</a></div><div class="sponsored" keep="0"><p>Advertisement: the best shoes in town, at half the price, only today.</p></div>',
]
_BODIES = [
    f'<article keep="1"><h1>The harbour</h1><p><b>{LONG * 3}<br><p>{LONG}{MID}</p><p>{SHORT}</p><p>{MID}</article>',
    f'<article keep="1"><h1>Title</h1><p>{SHORT}</p></article>',
    f'<main keep="1"><h1>The bridge</h1><p>{MID}</p><h2>Before</h2><p>{LONG}</p><blockquote><p>{SHORT}</p></blockquote><ul><li>{MID}</li><li>{SHORT}</li></ul></main>',
    f'<div class="post-content" keep="1"><p>{LONG * 2}</p><div>{MID}<p>{MID}</p></div><table><tr><td>{SHORT}</td><td>12</td></tr></table><pre>x = 1</pre></div>',
    f'<div id="content" keep="1"><h2>On salt</h2><p>{LONG}<a href="/s">salt</a></p><figure><figcaption>{SHORT}</figcaption></figure><p>{LONG}</p></div>',
    f'<article keep="1"><header keep="0"><p>By A. Writer, 3 May</p></header><h1>Rope</h1><p>{LONG}</p><aside keep="0"><p>{MID}</p></aside><div class="ad" keep="0">{MID}</div><p>{MID}</p><footer keep="0">Filed under news</footer></article>',
    f'<article keep="1"><h1>Carts</h1><nav keep="0"><a href="#1">To the first part</a></nav><p>{MID}</p><div class="notice" keep="0"><p>{MID}</p></div><section><h2>Part</h2><p>{LONG}</p></section><form keep="0"><p>Rate this page</p><input></form><div class="comments" keep="0"><p>{LONG}</p><p>{MID}</p></div></article>',
    f'<div keep="1"><p>{LONG * 4}</p><p>{LONG}</p><p>{MID}</p></div>',
    f'<p keep="1">{LONG}{MID}</p><p keep="1">{SHORT}</p><p keep="1">{LONG * 2}</p><h2 keep="1">More</h2><p keep="1">{MID}</p>',
    f'<div keep="1"><div><p>{MID}</p><p>{SHORT}</p></div><div><p>{LONG}</p></div></div>',
    f'<article keep="1">{LONG}<br>{MID}<p>{SHORT}</article>',
    f'<article keep="1"><h1>Words!! AND!! MORE!!</h1><p>{"WORDS!! " * 40}<p>{"a " * 9}</p><dl><dt>{SHORT}</dt><dd>{MID}</dd></dl></article>',
]

#: Every body with every second mix of what stands around it.
PAGES = [
    f'<!DOCTYPE html><html lang="en">{_HEADS[(i + j) % 2]}<body keep="0">{_BEFORE[(i + j) % 6]}{body}{_AFTER[(2 * i + j) % 6]}</body></html>'
    for i, body in enumerate(_BODIES)
    for j in range(3)
]

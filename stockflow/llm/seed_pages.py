"""Labelled pages that train the extraction model: common layouts, each section with its label.

``data-label`` is ``main`` or ``rest`` and holds for what is below it. The texts are invented.
"""

_TEXT = (
    "The river had risen overnight and the lower fields lay under a sheet of still brown water. "
    "By noon the ferry was running again, slowly, with two men at the rope and a third in the bow."
)
_SHORT = "Nobody could say when the bridge would open."
_P = f"<p>{_TEXT}</p><p>{_SHORT} {_TEXT}</p><p>{_TEXT} See the <a href='/map'>map</a> for details.</p>"
_LIST = "<ul><li>" + "</li><li>".join(f"<a href='/{w}'>{w}</a>" for w in "home news sport travel about".split()) + "</li></ul>"
_HEAD = "<!DOCTYPE html><html><head><title>River</title><script>var a=1;</script><style>p{margin:0}</style></head><body>"
_COMMENT = f"<p>{_SHORT}</p><p>I crossed it last year, before the repairs.</p>"


def _part(tag: str, names: str, label: str, inner: str) -> str:
    kind = f" class='{names}'" if names else ""
    return f"<{tag}{kind} data-label='{label}'>{inner}</{tag}>"


def _page(main: str, before: str = "", after: str = "") -> str:
    return f"{_HEAD}{before}{main}{after}</body></html>"


#: Names of sections that are not main text, with the element and content they come with.
_RESTS = [
    ("div", "menu nav navigation navbar topnav", _LIST),
    ("nav", "menu breadcrumb breadcrumbs", _LIST),
    ("header", "header masthead site topbar top bar", f"<h2>The River Post</h2>{_LIST}"),
    ("div", "header banner masthead site page top", "<h2>The River Post</h2><p>Daily news</p>"),
    ("aside", "sidebar side widget", f"<h3>Most read</h3>{_LIST}<p>{_SHORT}</p>"),
    ("div", "sidebar side rail widget secondary right left column", f"<h3>Most read</h3>{_LIST}<p>{_SHORT}</p>"),
    ("div", "ad ads advert advertisement adsbox sponsor sponsored promo promotion banner", f"<p>{_SHORT}</p>"),
    ("div", "ad", "Buy two pairs of boots today."),
    ("aside", "ad advert promo sponsored", "Buy two pairs of boots today."),
    ("section", "ad advert advertisement promo sponsored", "<p>Buy two pairs of boots today.</p>"),
    ("div", "cookie cookies consent notice gdpr privacy banner", f"<p>We use cookies. {_SHORT}</p><button>Accept</button>"),
    ("div", "notice alert warning message info popup modal overlay dialog", f"<p>{_SHORT}</p>"),
    ("section", "notice cookie alert", f"<p>We use cookies. {_SHORT}</p>"),
    ("p", "notice cookie ad", _SHORT),
    ("form", "form search subscribe newsletter signup login contact", "<label>Mail</label><input name='m'><button>Send</button>"),
    ("div", "newsletter subscribe signup form search login paywall", f"<p>Get our letters. {_SHORT}</p><form><label>Mail</label><input></form>"),
    ("div", "comments comment discussion replies reply responses disqus reader readers", f"<h3>Comments</h3><div data-label='rest' class='comment reply'>{_COMMENT}</div>"),
    ("section", "comments comment discussion responses reader readers", f"<h3>Comments</h3><article data-label='rest' class='comment'>{_COMMENT}</article>"),
    ("ol", "comments comment commentlist", f"<li data-label='rest' class='comment'>{_COMMENT}</li>"),
    ("ul", "comments comment", f"<li data-label='rest' class='comment'>{_COMMENT}</li>"),
    ("div", "related recommended recommendations more teaser teasers links", f"<h3>Read next</h3>{_LIST}"),
    ("div", "share social sharing follow toolbar buttons tools", _LIST),
    ("footer", "footer bottom copyright legal", f"<p>&copy; The River Post. {_SHORT}</p>"),
    ("div", "footer bottom copyright legal imprint colophon site", f"<p>&copy; The River Post. {_SHORT}</p>{_LIST}"),
    ("div", "pagination pager tags breadcrumb breadcrumbs", _LIST),
]

#: Names of sections that hold the main text, with their element.
_MAINS = [
    ("article", ""),
    ("article", "post article story entry"),
    ("main", ""),
    ("main", "content main"),
    ("div", "content main article post entry body text"),
    ("div", "story article text content page body"),
    ("section", "article content post story"),
    ("div", "main"),
    ("section", "content"),
]


def _outside() -> list[str]:
    """Every kind of rest before or after every kind of main part, and inside a wrapper."""
    pages = []
    for i, (tag, names) in enumerate(_MAINS):
        for j, (rest_tag, rest_names, inner) in enumerate(_RESTS):
            if (i + j) % 3:
                continue
            main = _part(tag, names, "main", f"<h1>A rising river</h1>{_P}")
            rest = "".join(_part(rest_tag, n, "rest", inner) for n in rest_names.split())
            plain = _part("nav", "", "rest", _LIST), _part("footer", "", "rest", f"&copy; The River Post. {_SHORT}")
            body = f"<div class='wrapper container' data-label='rest'>{rest}{main}</div>" if j % 2 else f"{main}{rest}"
            pages.append(_page(body, plain[0], plain[1]))
    return pages


def _inside() -> list[str]:
    """Every kind of rest between the paragraphs of a main part."""
    pages = []
    for j, (rest_tag, rest_names, inner) in enumerate(_RESTS):
        tag, names = _MAINS[j % len(_MAINS)]
        rest = "".join(_part(rest_tag, n, "rest", inner) for n in rest_names.split()[:3])
        quote = f"<blockquote>{_SHORT}</blockquote><ul><li>{_SHORT}</li><li>The ferry runs.</li></ul>"
        table = f"<table><tr><td>{_SHORT}</td><td>12</td></tr></table><h2>After the flood</h2><pre>a = 1</pre>"
        main = _part(tag, names, "main", f"<h1>A rising river</h1>{_P}{rest}{quote}{_P}{table}<p><b>{_SHORT}</b></p>")
        pages.append(_page(main, _part("header", "", "rest", f"<h2>The River Post</h2>{_LIST}")))
    return pages


_PLAIN_HEAD = "<!DOCTYPE html><html><head><title>River</title></head>"
_NAV, _FOOT = _part("nav", "", "rest", _LIST), _part("footer", "", "rest", f"<p>&copy; The River Post. {_SHORT}</p>")
_SIDE = _part("aside", "sidebar", "rest", f"<h3>Most read</h3>{_LIST}<p>{_SHORT}</p>")
_ADVERT = _part("div", "ad", "rest", "<p>Buy two pairs of boots today.</p>")
_QUOTE = f"<blockquote>{_TEXT}</blockquote><ul><li>{_SHORT}</li><li>The ferry runs.</li></ul>"
#: Main texts that no section holds.
_BARE = [
    f"<h1>A rising river</h1>{_P}",
    _P,
    f"<h1>A rising river</h1><h2>The flood</h2>{_P}{_QUOTE}<h2>After</h2>{_P}",
    f"{_P}{_QUOTE}",
    f"{_TEXT}<br><br>{_SHORT} {_TEXT}<br><br>{_TEXT}",
    f"<h1>A rising river</h1>{_TEXT} <b>{_SHORT}</b><br>{_TEXT}",
]


def _unnamed() -> list[str]:
    """Main texts directly in the body, and in divisions without a name, alone and among rests."""
    pages = []
    for text in _BARE:
        for before, after in (("", ""), (_NAV, _FOOT), (_NAV + _ADVERT, _SIDE + _FOOT)):
            pages.append(f"{_PLAIN_HEAD}<body data-label='main'>{before}{text}{after}</body></html>")
            inner = f"<div data-label='main'>{text}</div>"
            for depth in (0, 1, 2):
                pages.append(f"{_PLAIN_HEAD}<body>{before}{'<div>' * depth}{inner}{'</div>' * depth}{after}</body></html>")
    return pages


PAGES = _outside() + _inside() + _unnamed()
#: Pages without a body: the root itself holds the main text.
FRAGMENTS = [f"{before}{text}{after}" for text in _BARE for before, after in (("", ""), (_NAV, _FOOT))]

"""Main text of HTML pages by a tree-structured graphical model over the DOM.

Each element is main text or not. Its tag, the words of its class, id and role,
whether it holds text directly or other parts of a page, and the share of its
text in links speak for one or the other; potentials between parent and child say how readily
either passes on. All are trained on labelled pages, by the likelihood of their
labels. The graph is the DOM tree, so one pass of sum-product messages upward and
one downward gives the exact marginal of every element. Text of elements with a
marginal of at least a half is kept.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F, types as T

from omicspark.llm.labelled_pages import LABELLED_PAGES

# Elements of HTML by what they do to the text around them.
BLOCKS = frozenset("html head body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table caption tbody thead tfoot tr td th ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template textarea title select option button iframe object svg math canvas audio video datalist".split())
RAW = frozenset("script style textarea title noscript iframe template svg select".split())
FOREIGN = frozenset({"svg", "math"})  # a slash at the end of their tags closes them
HEAD = frozenset("html head title meta link base script style noscript template".split())  # what doesn't begin a body
ENDS_P = BLOCKS - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "dd", "dt", "li", "summary", "figcaption"}
PLAIN = frozenset("html head title body div p b i em strong span h1 h2 h3 pre blockquote".split())
PARTS = frozenset("article aside div footer header main nav section".split())
ROLES = {"article": "article", "banner": "header", "complementary": "aside", "contentinfo": "footer", "form": "form", "main": "main", "navigation": "nav", "search": "form"}  # the elements that roles stand for
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

_OPEN = re.compile(r"""<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)(?:((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>)?)""")
_COMMENT_END = re.compile(r"--!?>")
_NO_COMMENT = re.compile(r"-?>")  # right after its beginning
_QUOTED = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")  # attributes with < or > in their values
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w-])(hidden)(?![\w-])""")
_WORD = re.compile(r"[a-z]+")
# On the page itself: its lower case can be longer (one letter becomes two), so places there are not the page's.
_RAW_END = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.I | re.A) for tag in RAW}
STEM = 5
STEPS = 200
RATE = 0.3
PENALTY = 0.01
UNLIKELY = 0.1


@dataclass
class Dom:
    """Elements in document order; parents come before children."""

    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)  # element, number of block breaks before, text
    breaks: int = 0


def parse(page: str) -> Dom:
    """A forgiving parse in time linear in the page: element 0 is the page itself; unclosed and misplaced tags are borne.

    What is open is kept by tag as well, so the nearest open element of a tag is
    found without a walk. A search that failed once is not tried again further on.
    """
    dom = Dom(["#page"], [""], [-1])
    stack, at, n = [0], 0, len(page)
    depths: dict[str, list[int]] = defaultdict(list)  # where in the stack elements of a tag are
    silent = 0  # open silent elements
    comments = True  # false once a comment turned out to stay open
    body = False  # once there is one, said or implied
    quotes = True  # false once a quote turned out to stay open
    endless: set[str] = set()  # raw tags without an end tag further on

    def push(tag: str, attributes: str) -> None:
        nonlocal silent
        dom.tags.append(tag)
        dom.attributes.append(attributes)
        dom.parents.append(stack[-1])
        depths[tag].append(len(stack))
        stack.append(len(dom.tags) - 1)
        silent += tag in SILENT

    def in_body() -> None:
        """What is shown stands in a body, though no tag may have begun it."""
        nonlocal body
        if not body and not silent:
            body = True
            if depths["head"]:
                close_to(depths["head"][-1])
            push("body", "")

    def add(text: str) -> None:
        if text and not silent:
            if not body and not text.isspace():
                in_body()
            dom.texts.append((stack[-1], dom.breaks, html.unescape(text) if "&" in text else text))

    def close_to(depth: int) -> None:
        nonlocal silent
        for e in reversed(stack[depth:]):
            tag = dom.tags[e]
            depths[tag].pop()
            dom.breaks += tag in BLOCKS
            silent -= tag in SILENT
        del stack[depth:]

    def nearest(tags: Iterable[str]) -> int:
        return max((depths[t][-1] for t in tags if depths[t]), default=0)

    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        m = _OPEN.match(page, begin)
        if not m:
            add(page[at : begin + 1])
            at = begin + 1
            continue
        add(page[at:begin])
        if m[1]:
            ended = _COMMENT_END.search(page, m.end()) if comments else None
            comments = ended is not None
            at = ended.end() if ended else n
            short = _NO_COMMENT.match(page, m.end())
            if short:
                at, comments = short.end(), True
            continue
        if m[2]:
            end = page.find("]]>", m.end())
            at = end + 3 if end >= 0 else n
            continue
        attributes, at = m[6], m.end()
        if attributes is None:
            inner = _QUOTED.match(page, at) if quotes and m[5] else None
            quotes = quotes and (inner is not None or not m[5])
            end = inner.end() - 1 if inner else page.find(">", at)
            if end < 0:  # no tag ends any more
                add(page[begin:])
                break
            attributes, at = page[at:end], end + 1
        if m[3]:
            continue
        tag = m[5].lower()
        if m[4]:
            if depths[tag]:
                close_to(depths[tag][-1])
            continue
        if tag == "body":
            body = True
        elif tag not in HEAD:
            in_body()
        if tag == "br":
            add(" ")
            continue
        if tag in FOREIGN and attributes.endswith("/"):
            continue
        if tag in ENDS_P or tag in SIBLINGS:
            ends, inside = SIBLINGS.get(tag, ((), ()))
            wall = nearest((*inside, "table", "button"))
            while (depth := nearest((*ends, "p") if tag in ENDS_P else ends)) > wall:
                more = dom.tags[stack[depth]] in ("td", "th")
                close_to(depth)
                if not more:
                    break
        if tag in BLOCKS:
            dom.breaks += 1
        if tag in VOID:
            continue
        if tag in RAW and tag not in endless:
            end = _RAW_END[tag].search(page, at)
            if end:
                at = page.find(">", end.start()) + 1 or n
                continue
            endless.add(tag)
        if tag in endless and tag in ("script", "style", "textarea", "title"):
            break  # never closed: the rest is not text
        if not attributes.endswith("/") or tag in BLOCKS or tag in SILENT:
            push(tag, attributes)
    return dom


def features(dom: Dom) -> list[list[str]]:
    """What speaks for or against each element."""
    n = len(dom.tags)
    own, linked, holds = [0] * n, [0] * n, [False] * n
    for e, _, text in dom.texts:
        own[e] += len(text.strip())
    total = own[:]
    for i in range(n - 1, 0, -1):
        p = dom.parents[i]
        if dom.tags[i] == "a":
            linked[i] = total[i]
        total[p] += total[i]
        linked[p] += linked[i]
        holds[p] = holds[p] or holds[i] or dom.tags[i] in PARTS
    found = []
    for i in range(n):
        tag = dom.tags[i]
        own_features = [f"tag={tag}", "own=some" if own[i] else "own=none"]
        if total[i]:
            share = linked[i] / total[i]
            own_features.append("links=none" if share == 0 else "links=few" if share < 0.4 else "links=many")
        if tag in ("#page", "body", "div", "section"):
            own_features.append(f"{tag}={'parts' if holds[i] else 'plain'}")
        if dom.attributes[i]:
            words = set()
            for m in _ATTRIBUTE.finditer(dom.attributes[i]):
                if m[5]:
                    words.add("hidden")
                elif m[1].lower() in ("class", "id", "role"):
                    words.update(_WORD.findall((m[2] or m[3] or m[4] or "").lower()))
            own_features += sorted(f"word={w}" for w in words)
            own_features += sorted(f"tag={ROLES[w]}" for w in words if w in ROLES and w != tag and f"tag={ROLES[w]}" != own_features[0] and f'role="{w}"' in dom.attributes[i])
            own_features += sorted({f"stem={w[:STEM]}" for w in words if len(w) >= STEM})  # plurals and compounds
        found.append(own_features)
    return found


def _clip(x: float) -> float:
    return max(-300.0, min(300.0, x))


@dataclass
class TreeModel:
    weights: dict[str, float] = field(default_factory=dict)  # log potential of main text that a feature adds
    pairs: tuple[float, float, float] = (0.0, 0.0, 0.0)  # log potential of (parent, child): (main, main), (main, not), (not, main)

    def messages(self, dom: Dom, found: list[list[str]]) -> tuple[list[float], list[float], list[float]]:
        """Log odds of each element from below, those of its message upward, and those of the message it gets from above."""
        get, parents = self.weights.get, dom.parents
        below = [sum([get(f, 0.0) for f in own]) for own in found]
        n = len(below)
        up, down = [0.0] * n, [0.0] * n
        exp, log = math.exp, math.log
        both, left, entered = (exp(t) for t in self.pairs)
        for i in range(n - 1, 0, -1):
            b = exp(_clip(below[i]))
            up[i] = log((left + both * b) / (1 + entered * b))
            below[parents[i]] += up[i]
        for i in range(1, n):
            p = parents[i]
            k = exp(_clip(below[p] + down[p] - up[i]))
            down[i] = log((entered + both * k) / (1 + left * k))
        return below, up, down

    def marginals(self, dom: Dom, found: list[list[str]] | None = None) -> list[float]:
        """P(main text) of each element: sum-product upward, then downward."""
        below, _, down = self.messages(dom, found or features(dom))
        return [1 / (1 + math.exp(-_clip(b + d))) for b, d in zip(below, down)]


def _labels(dom: Dom) -> list[bool]:
    found: list[bool] = []
    for i, attributes in enumerate(dom.attributes):
        own = re.search(r'data-main="([01])"', attributes)
        found.append(own[1] == "1" if own else i > 0 and found[dom.parents[i]])
    return found


def _expected(model: TreeModel, dom: Dom, found: list[list[str]]) -> tuple[list[float], list[float]]:
    """Marginals of elements, and the expected numbers of (main, main), (main, not) and (not, main) pairs."""
    below, up, down = model.messages(dom, found)
    both, left, entered = (math.exp(t) for t in model.pairs)
    pairs = [0.0, 0.0, 0.0]
    for i in range(1, len(below)):
        p = dom.parents[i]
        k, b = math.exp(_clip(below[p] + down[p] - up[i])), math.exp(_clip(below[i]))
        each = (both * k * b, left * k, entered * b)
        total = 1 + sum(each)
        pairs = [x + y / total for x, y in zip(pairs, each)]
    return [1 / (1 + math.exp(-_clip(b + d))) for b, d in zip(below, down)], pairs


def train(pages: Iterable[str] = LABELLED_PAGES, steps: int = STEPS) -> TreeModel:
    """The most likely potentials given labelled pages: gradient ascent on what was counted less what the model expects.

    Elements without text, and the page's skeleton, are labelled like others, so
    the potentials of parent and child learn where main text begins and ends.
    """
    known = [(dom, _labels(dom), features(dom)) for dom in map(parse, pages)]
    model, speed, pair_speed = TreeModel(), defaultdict(float), [0.0] * 3
    for _ in range(steps):
        slope, pair_slope = defaultdict(float), [0.0] * 3
        for dom, labels, found in known:
            marginals, expected = _expected(model, dom, found)
            for own, label, p in zip(found, labels, marginals):
                for f in own:
                    slope[f] += label - p
            for i in range(1, len(labels)):
                up_label = labels[dom.parents[i]]
                if up_label or labels[i]:
                    pair_slope[0 if up_label and labels[i] else 1 if up_label else 2] += 1
            pair_slope = [a - b for a, b in zip(pair_slope, expected)]
        for f, g in slope.items():  # steps are scaled by the slopes so far
            g -= PENALTY * model.weights.get(f, 0.0)
            speed[f] += g * g
            model.weights[f] = model.weights.get(f, 0.0) + RATE * g / math.sqrt(speed[f] + 1e-9)
        pair_slope = [g - PENALTY * t for g, t in zip(pair_slope, model.pairs)]
        pair_speed = [v + g * g for v, g in zip(pair_speed, pair_slope)]
        model.pairs = tuple(t + RATE * g / math.sqrt(v + 1e-9) for t, g, v in zip(model.pairs, pair_slope, pair_speed))
    return model


def extract(page: str | None, model: TreeModel) -> str:
    """Blocks of main text in page order, two line feeds between them; empty for null and empty pages."""
    if not page:
        return ""
    dom = parse(page)
    main = model.marginals(dom)
    # A page without any main text is rare: where no element is likely, those near the likeliest count, unless all are
    # unlikely. Where nothing but text and plain elements is there, nothing speaks against them.
    best = max((main[e] for e, _, text in dom.texts if not text.isspace()), default=0.0)
    plain = not any(dom.attributes) and PLAIN.issuperset(dom.tags[1:])
    least = 0.5 if best >= 0.5 or best < UNLIKELY and not plain else best / 2
    blocks, now, parts = [], -1, []
    for e, block, text in dom.texts:
        if block != now:
            blocks.append(parts)
            now, parts = block, []
        if main[e] >= least:
            parts.append(text)
    blocks.append(parts)
    joined = (" ".join("".join(p).split()) for p in blocks)
    return "\n\n".join(b for b in joined if b)


def main_text(html_col: str, model: TreeModel | None = None) -> Column:
    """The main text of a column of pages, never null. Bytes that are no UTF-8 are replaced."""
    own = model or train()

    @F.arrow_udf(T.StringType())
    def column(pages: pa.Array) -> pa.Array:
        return pa.array([extract((p or b"").decode("utf-8", "replace"), own) for p in pages.to_pylist()], pa.string())

    return column(F.col(html_col).cast("binary"))

"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page's DOM.

A leaf block is a run of text between block-level tags. Its features are the tags, class and id words of its ancestors
and coarse properties of its text; transitions tie neighbouring blocks. The field is trained in numpy on labelled
pages, which a generator lays out in many ways from invented words, and pages are decoded by Viterbi.
"""

from __future__ import annotations

import functools
import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import tidy

# Tags by their role in HTML.
BLOCK_TAGS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
#: their content is no markup; unclosed, they take the rest of the page
RAW_TAGS = "script|style|title|textarea|iframe|noframes"
#: their content is no text of the page either; unclosed, only the tag itself goes
SOFT_TAGS = "template|noscript|svg|math|object|canvas"
#: an opening tag ends the open elements named here, up to the nearest of the second group
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
NO_P = BLOCK_TAGS - {"button", "option", "select", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "summary", "legend"} | {"li", "dd", "dt"}

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({RAW_TAGS})(?=[\s/>])[^>]*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    rf"|<(?:svg|math)(?=[\s/])[^>]*(?<=/)>|<({SOFT_TAGS})(?=[\s/>])[^>]*+>.*?</\2(?=[\s/>])[^>]*+>"
    r"|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIMENSIONS = 1 << 13


@functools.lru_cache(1 << 16)
def feature(name: str) -> int:
    return zlib.crc32(name.encode()) % DIMENSIONS


@functools.lru_cache(1 << 14)
def hints(attributes: str) -> tuple[str, ...]:
    """Lower-case words of class, id and role."""
    return tuple(w.lower() for m in ATTRIBUTE.finditer(attributes) for w in WORD.findall(m[2] or m[3] or m[4] or ""))


@functools.lru_cache(1 << 14)
def path_features(path: tuple) -> tuple[int, ...]:
    names = {"bias"}
    for tag, attributes in path:
        names.add(f"in {tag}")
        names.update(f"hint {w}" for w in hints(attributes))
    blocks = [tag for tag, _ in path if tag in BLOCK_TAGS] or ["none"]
    names |= {f"own {blocks[-1]}", f"pair {' '.join(blocks[-2:])}"}
    return tuple(sorted(feature(x) for x in names))


def text_features(text: str, linked: int) -> tuple[int, ...]:
    n = len(text)
    share = linked / n
    return (
        feature(f"chars {min(n.bit_length(), 11)}"),
        feature(f"links {0 if share == 0 else 1 if share < 0.5 else 2 if share < 0.95 else 3}"),
        feature(f"stop {text[-1] in '.!?…:;'}"),
        feature(f"mark {text[0] in '©®|»›'}"),
    )


def leaf_blocks(page: str) -> list[tuple[str, tuple[int, ...]]]:
    """(text, features) of every leaf block with text, in page order. Character references are decoded, white space
    becomes one space. Raw elements (scripts, styles, titles and the like), drawings, objects and comments have no text;
    a drawing or object that is not closed loses its tag alone. Unclosed tags end as HTML has it, and what looks like no
    tag is text."""
    out, stack, parts, linked, links = [], [], [], 0, 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, path_features(tuple(stack)) + text_features(text, min(linked, len(text)))))
        parts, linked = [], 0

    def pop(i):
        nonlocal links
        links -= sum(1 for tag, _ in stack[i:] if tag == "a")
        del stack[i:]

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        tag = m[4] or m[7]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        if tag in VOID_TAGS and tag != "hr":
            continue
        if tag in BLOCK_TAGS or tag == "head":
            flush()
        if m[3] or m[6]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        ends, within = IMPLIED.get(tag, (set(), set()))
        if tag in NO_P:
            ends = ends | {"p"}
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    pop(i)
                    if tag not in ("tr", "dt", "dd", "li"):
                        break
                elif stack[i][0] in within or stack[i][0] in BLOCK_TAGS - ends and tag != "tr":
                    break
        if tag != "hr":
            attributes = m[5] or m[8] or ""
            stack.append((tag, attributes if "=" in attributes else ""))
            links += tag == "a"
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


class Field:
    """Weights of the features for the two labels (0 other, 1 main text), of transitions and of the first label."""

    def __init__(self):
        self.weights = np.zeros((DIMENSIONS, 2))
        self.moves, self.first = np.zeros((2, 2)), np.zeros(2)

    def potentials(self, blocks) -> np.ndarray:
        flat = np.fromiter((f for _, fs in blocks for f in fs), np.int64)
        sizes = np.array([len(fs) for _, fs in blocks])
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0)

    def viterbi(self, potentials: np.ndarray) -> list[int]:
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = (self.first + potentials[0]).tolist()
        back = []
        for x, y in potentials[1:].tolist():
            from0, from1 = (0 if a + m00 >= b + m10 else 1), (0 if a + m01 >= b + m11 else 1)
            a, b = max(a + m00, b + m10) + x, max(a + m01, b + m11) + y
            back.append((from0, from1))
        labels = [0 if a >= b else 1]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def marginals(self, potentials: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and transition probabilities, by forward and backward sums."""
        n = len(potentials)
        forward, backward = np.empty((n, 2)), np.zeros((n, 2))
        forward[0] = self.first + potentials[0]
        for i in range(1, n):
            forward[i] = np.logaddexp(*(forward[i - 1][:, None] + self.moves)) + potentials[i]
        for i in range(n - 2, -1, -1):
            backward[i] = np.logaddexp(*(self.moves + potentials[i + 1] + backward[i + 1]).T)
        total = np.logaddexp(*forward[-1])
        single = np.exp(forward + backward - total)
        pairs = np.exp(forward[:-1, :, None] + self.moves + (potentials[1:] + backward[1:])[:, None, :] - total).sum(axis=0) if n > 1 else np.zeros((2, 2))
        return single, pairs


def train(pages: list[tuple[list, list[int]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 3) -> Field:
    """Adagrad on the conditional log-likelihood of (leaf blocks, labels), page by page, with weight decay."""
    field, r = Field(), np.random.default_rng(seed)
    sums = [np.full_like(x, 1e-2) for x in (field.weights, field.moves, field.first)]
    for _ in range(epochs):
        for k in r.permutation(len(pages)):
            blocks, labels = pages[k]
            if not blocks:
                continue
            single, pairs = field.marginals(field.potentials(blocks))
            truth = np.eye(2)[labels]
            error = truth - single
            flat = np.fromiter((f for _, fs in blocks for f in fs), np.int64)
            at = np.repeat(np.arange(len(blocks)), [len(fs) for _, fs in blocks])
            rows, place = np.unique(flat, return_inverse=True)
            g = np.zeros((len(rows), 2))
            np.add.at(g, place, error[at])
            g -= decay * field.weights[rows]
            sums[0][rows] += g * g
            field.weights[rows] += rate * g / np.sqrt(sums[0][rows])
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            for p, s, g in ((field.moves, sums[1], seen - pairs - decay * field.moves), (field.first, sums[2], error[0] - decay * field.first)):
                s += g * g
                p += rate * g / np.sqrt(s)
    return field


def labelled_page(seed: int) -> tuple[str, list[str]]:
    """A page laid out at random from invented words, and the texts of its main blocks in order."""
    r = np.random.default_rng(seed)
    pick = lambda *xs: xs[int(r.integers(len(xs)))]
    chance = lambda p: r.random() < p
    letters = "abcdefghijklmnoprstuvyzéüñ"
    word = lambda: "".join(letters[int(i)] for i in r.integers(0, len(letters), int(r.integers(2, 10))))
    words = lambda a, b: " ".join(word() for _ in range(int(r.integers(a, b))))
    sentence = lambda a=1, b=25: words(a, b).capitalize() + pick(".", ".", ".", "!", "?", "")
    main = []

    def box(tags, names, body):
        tag = pick(*tags)
        name = f' {pick("class", "class", "id")}="{pick(*names)}"' if tag in ("div", "section", "ul", "p", "span") or chance(0.3) else ""
        return f"<{tag}{name}>{body}</{tag}>"

    link = lambda: f'<a href="/{word()}">{words(1, 4)}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}" + pick("</li>", "</li>", "") for _ in range(int(r.integers(2, 9)))) + "</ul>"
    menu = lambda: box(["nav", "nav", "div", "ul"], ["nav", "menu", "main-menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "topnav"], pick(links(), " ".join(link() for _ in range(int(r.integers(2, 7))))))
    advert = lambda: box(["div", "div", "aside", "section"], ["ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot", "adbox", "sponsor"], pick(sentence(), f"<p>{sentence()}</p>", link(), f"<p>{sentence()}</p><p>{sentence()}</p>"))
    notice = lambda: box(["div", "div", "section", "aside"], ["cookie", "cookie-notice", "consent", "notice", "gdpr", "popup", "modal", "alert", "newsletter", "subscribe", "paywall"], f"<p>{sentence(4, 30)}</p><button>{words(1, 3)}</button>")
    share = lambda: box(["div", "ul"], ["share", "social", "sharing", "tags", "toolbar"], " ".join(link() for _ in range(3)))
    form = lambda: f"<form><label>{words(1, 4)}</label><input name=q><select><option>{word()}<option>{word()}</select><button>{word()}</button></form>"
    side = lambda: box(["aside", "aside", "div"], ["sidebar", "side", "related", "widget", "recommended", "most-read", "rail", "teaser"], f"<h3>{words(1, 4)}</h3>" + pick(links(), f"<p>{sentence()}</p>", f"<p>{sentence()}</p>{links()}"))
    comment = lambda: pick("<li>", '<div class="comment">', "<article>") + f"<p>{sentence(1, 40)}</p>" + pick("", f"<p>{sentence()}</p>")
    comments = lambda: box(["div", "section"], ["comments", "comment-list", "responses", "discussion", "disqus", "replies", "reader-comments"], f"<h2>{words(1, 3)}</h2>" + "".join(x + {"<li": "</li>", "<di": "</div>", "<ar": "</article>"}[x[:3]] for x in (comment() for _ in range(int(r.integers(1, 5))))))

    def part(tag, text, inner=None):
        main.append(" ".join(text.split()))
        shown = html.escape(inner or text, quote=False) if inner is None else inner
        return f"<{tag}>{shown}" + ("" if tag in ("p", "li") and chance(0.2) else f"</{tag}>")

    def paragraph():
        n = 1 if chance(0.15) else int(r.integers(1, 8))
        text = " ".join(sentence(1, 30) for _ in range(n))
        if chance(0.3):
            a, _, b = text.partition(" ")
            wrap = pick("b", "em", "strong", "i", "a", "span")
            return part("p", text, f"<{wrap}>{html.escape(a)}</{wrap}> {html.escape(b)}" if b else f"<{wrap}>{html.escape(a)}")
        return part("p", text)

    plain = lambda: pick("", "", f' class="{pick("row", "col", "inner", "wrap", "section", "block", "clearfix", word())}"', f' id="{word()}"')
    body = part("h1", words(2, 12).capitalize()) if chance(0.85) else ""
    if body and chance(0.15):
        body = f"<header>{body}" + (part("p", sentence(4, 20)) if chance(0.3) else "") + "</header>"
    pieces = []
    for _ in range(int(r.integers(1, 14))):
        kind = r.random()
        if kind < 0.68:
            pieces.append(paragraph())
        elif kind < 0.76:
            pieces.append(part(pick("h2", "h3"), words(1, 9).capitalize()))
        elif kind < 0.82:
            tag = pick("ul", "ol")
            pieces.append(f"<{tag}>" + "".join(part("li", sentence(1, 15)) for _ in range(int(r.integers(2, 5)))) + f"</{tag}>")
        elif kind < 0.86:
            pieces.append("<blockquote>" + paragraph() + "</blockquote>")
        elif kind < 0.88:
            pieces.append("<table><tr>" + "".join(part("td", words(1, 4)) for _ in range(4)) + "</tr></table>")
        elif kind < 0.90:
            pieces.append(part("pre", words(3, 12)))
        else:
            pieces.append(pick(advert, notice, share, side, form)())
    if chance(0.25):
        # parts of the article in boxes of their own
        cut, tag = int(r.integers(0, len(pieces) + 1)), pick("section", "div")
        pieces = [f"<{tag}{plain()}>{''.join(x)}</{tag}>" for x in (pieces[:cut], pieces[cut:]) if x]
    body += "".join(pieces)
    if chance(0.1):
        body += comments()
    content = pick("article", "article", "article", "main", "div", "section")
    name = f' class="{pick("content", "post", "entry", "article", "story", "post-content", "article-body", "main", "text", "entry-content")}"' if content in ("div", "section") or chance(0.3) else ""
    center = f"<{content}{name}>{body}</{content}>"
    if content == "article" and chance(0.25):
        center = f"<main{plain()}>{center}{side() if chance(0.2) else ''}{comments() if chance(0.2) else ''}</main>"
    elif chance(0.15):
        center = f"<div{plain()}>{center}</div>"
    if chance(0.2):
        center = f'<div id="{pick("page", "wrapper", "container", "content", "main")}">{center}{side() if chance(0.5) else ""}</div>'
    before = "".join(x() for x, p in ((lambda: box(["header", "header", "div"], ["header", "masthead", "site-header", "top", "logo"], pick(sentence(1, 8), f"{link()} <span>{words(1, 4)}</span>", f"<h2>{words(1, 4)}</h2>{menu()}", f"<p>{sentence()}</p>")), 0.5), (menu, 0.8), (notice, 0.3), (advert, 0.5), (form, 0.15), (side, 0.15)) if chance(p))
    after = "".join(x() for x, p in ((advert, 0.3), (share, 0.2), (comments, 0.35), (side, 0.35), (form, 0.2), (notice, 0.15), (lambda: box(["footer", "footer", "footer", "div"], ["footer", "site-footer", "copyright", "bottom", "legal"], pick(f"&copy; {words(1, 5)} &middot; {sentence()}", sentence(1, 30), f"<p>{sentence()}</p>{links()}")), 0.9)) if chance(p))
    ad = f"<!-- {word()} -->" if chance(0.3) else ""
    return f'<!DOCTYPE html><html lang="{word()}"><head><title>{words(2, 8)}</title><script>var a="<p>{word()}</p>";</script></head><body{plain() if chance(0.3) else ""}>{before}{ad}{center}{after}</body></html>', main


def training_pages(n: int = 400, seed: int = 11) -> list[tuple[list, list[int]]]:
    """Leaf blocks and labels of generated pages: a block is main text if it is the next main block."""
    out = []
    for k in range(n):
        page, main = labelled_page(seed * 100_003 + k)
        blocks, labels, at = leaf_blocks(page), [], 0
        for text, _ in blocks:
            labels.append(int(at < len(main) and text == main[at]))
            at += labels[-1]
        if at == len(main):
            out.append((blocks, labels))
    return out


@functools.lru_cache(1)
def trained() -> Field:
    return train(training_pages())


def main_text(page: str, field: Field) -> str:
    blocks = leaf_blocks(page)
    if not blocks:
        return ""
    labels = field.viterbi(field.potentials(blocks))
    return "\n".join(text for (text, _), label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None, html_col: str = "html", keep: tuple = ("page_id", "url")) -> DataFrame:
    """The columns `keep`, text and n_chars of every row.

    A null or empty page, or one without main text, has the empty text. Equal rows each get a row, an empty table
    none; further columns play no part. Columns of `keep` named text or n_chars are replaced.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    sent = pages.sparkSession.sparkContext.broadcast(field or trained())
    kept = [c for c in keep if c not in ("text", "n_chars")]

    def run(batches):
        for batch in batches:
            found = [main_text(x, sent.value) if x else "" for x in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=[*kept, "text", "n_chars"])

    rows = pages.select(*kept, F.col(html_col).cast("string").alias("__html"))
    return rows.mapInArrow(tidy(run), StructType([*(pages.schema[c] for c in kept), StructField("text", StringType()), StructField("n_chars", LongType())]))


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))

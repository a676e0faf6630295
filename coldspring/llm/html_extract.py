"""Main text of html pages: boosted trees over the nodes of the page, decoded from the root down.

No page comes with labels. The trees are fitted on pages that are written here from pieces of text of a bounded sample of the
given pages, in many layouts with known article nodes, so what they learn is layout and not words. Words of attributes are hashed,
and what a bucket speaks for is learned on the other half of the written pages. In those, some names are made up, some articles carry
the names of other things, and some things carry none, so that a name is evidence beside the layout and never decides alone.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.llm import boosting, dom


TRUTH = "\ue0f1"   # in written pages, marks loose text that is part of the article

# Class and id names of the written pages.
AWAY = ("ad ads advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored outbrain taboola dfp "
        "werbung anzeige publicidad anuncio publicite reklama").split()
NAVIGATION = "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc skip tabs topbar toolbar sitemap".split()
ASIDE = "sidebar side aside related recommended widget widgets share sharing social trending popular tags more newsletter subscribe signup promo".split()
NOTICE = "notice notices cookie cookies consent gdpr alert alerts banner popup modal overlay paywall disclaimer toast legal".split()
TALK = ("comment comments commentlist reply replies respond discussion disqus discourse thread reader readers responses feedback "
        "kommentare comentarios commentaires").split()
EDGE = "header masthead footer foot bottom copyright site top logo branding head credits".split()
FORM = "form login search input field newsletter subscribe signin register contact".split()
CALLOUT = "warning note tip info message hint caution important infobox box highlight".split()
ARTICLE = "content post entry-content story article-body main-content text post-body article entry main body copy prose hentry".split()
SUBJECT = "review reviews news social more tag-social more-news legal advertising promotion widgets menu search discussion site-content site featured top".split()


@dataclass(frozen=True)
class ExtractConfig:
    sample: int = 300       # pages that give text for training, those with the least hash of their id
    sample_units: int = 40  # pieces of text taken of each
    unit_chars: int = 400   # characters taken of each piece
    layouts: int = 1200     # pages written for training, some of them with hundreds of blocks


class _Writer:
    """Writes pages in random layouts. What is article text is marked by ``data-truth`` on the elements that hold it, and by
    ``TRUTH`` where no element does."""

    def __init__(self, pool: list[str], seed: int):
        self.draw = np.random.default_rng(seed)
        self.pool = pool

    def pick(self, values):
        return values[int(self.draw.integers(len(values)))]

    def chance(self, share: float) -> bool:
        return bool(self.draw.random() < share)

    def text(self, longest: int = 4) -> str:
        words = " ".join(self.pick(self.pool) for _ in range(int(self.draw.integers(1, longest + 1))))
        return html.escape(words, quote=False)

    def short(self) -> str:
        return html.escape(" ".join(self.pick(self.pool).split()[:int(self.draw.integers(1, 5))]), quote=False)

    def made_up(self) -> str:
        """A name that says nothing: of a style sheet's compiler, or any word."""
        if self.chance(0.6):
            return f'{self.pick(["css-", "sc-", "x", "_", "c"])}{int(self.draw.integers(1 << 24)):x}'
        return "".join(c for c in self.pick(self.pool).split()[0].lower() if c.isalpha())[:12] or "k"

    def name(self, names: list[str], made_up: float = 0.2) -> str:
        return self.made_up() if self.chance(made_up) else self.pick(names)

    def attributes(self, names) -> str:
        if not names or self.chance(0.15):
            return ""
        name = self.name(names)
        other = self.pick(["", "", "", " wrap", " clearfix", " col-8", " box", " block1"])
        return f' {self.pick(["class", "class", "class", "id"])}="{name}{other}"'

    def many(self, build, low: int, high: int) -> str:
        return "".join(build() for _ in range(int(self.draw.integers(low, high + 1))))

    # what an article is made of
    def paragraph(self) -> str:
        kind = self.draw.random()
        if kind < 0.62:
            body = self.text(6)
            if self.chance(0.15):
                body = f"<b>{body}"
            elif self.chance(0.2):
                body = f'{self.text(1)} <a href="/x">{self.short()}</a> {self.text(3)}'
            end = self.pick(["</p>", "</p>", "</p>", "<br>", ""])
            return f'<p{self.attributes(["lead", "text", "intro"]) if self.chance(0.1) else ""} data-truth>{body}{end}'
        if kind < 0.70:
            return f"<h{self.pick([2, 3, 4])} data-truth>{self.short()}</h2>".replace("</h2>", "") + "</h2></h3></h4>"
        if kind < 0.77:
            return "<ul data-truth>" + self.many(lambda: f"<li data-truth>{self.text(2)}</li>", 2, 6) + "</ul>"
        if kind < 0.82:
            return f"<blockquote data-truth><p data-truth>{self.text(3)}</p></blockquote>"
        if kind < 0.87:
            mark = f' class="{self.made_up()}"' if self.chance(0.15) else ""
            return f"<div{mark} data-truth>{self.text(5)}</div>"
        if kind < 0.91:
            return f"<figure data-truth><img src=x><figcaption data-truth>{self.text(1)}</figcaption></figure>"
        if kind < 0.95:
            row = lambda: "<tr data-truth>" + self.many(lambda: f"<td data-truth>{self.short()}</td>", 2, 3) + "</tr>"
            return f"<table data-truth>{self.many(row, 1, 4)}</table>"
        tag, mark = self.pick([("section", ""), ("section", ""), ("div", f' class="{self.name(CALLOUT)}"'), ("div", f' class="{self.made_up()}"'),
                               ("aside", f' class="{self.pick(CALLOUT)}"')])
        return f"<{tag}{mark} data-truth>{self.many(lambda: f'<p data-truth>{self.text(4)}</p>', 1, 4)}</{tag}>"

    def loose(self) -> str:
        inner = self.pick([self.text(6), self.text(3) + "<br>" + self.text(5), f'{self.text(2)} <a href="/x">{self.short()}</a> {self.text(4)}', f"<b>{self.short()}</b> {self.text(4)}"])
        return TRUTH + inner + self.pick(["<br>", "<br><br>", "<hr>", "\n"])

    # what stands around and inside it
    def stray(self) -> str:
        """Loose text that is not of the article."""
        return self.pick([f'<a href="#x">{self.short()}</a>', self.short(), f"&copy; {self.short()} {self.text(1)}",
                          self.many(lambda: f'<a href="/y">{self.short()}</a> {self.pick(["|", "&gt;", ""])} ', 2, 8)]) + "<hr>"

    def links(self) -> str:
        return "<ul>" + self.many(lambda: f'<li><a href="/{self.short().split(" ")[0]}">{self.short()}</a></li>', 2, 200 if self.chance(0.01) else 9) + "</ul>"

    def navigation(self) -> str:
        tag = self.pick(["nav", "nav", "div", "ul"])
        inner = self.links() if self.chance(0.7) else self.many(lambda: f'<a href="/y">{self.short()}</a> ', 3, 8)
        return f'<{tag}{self.attributes(NAVIGATION)}>{inner}</{tag}>' if tag != "div" else f'<div class="{self.name(NAVIGATION)}">{inner}</div>'

    def advert(self) -> str:
        return f'<{(t := self.pick(["div", "div", "aside", "section"]))} class="{self.name(AWAY)}{self.pick(["", "-box", "-top", " unit", "-unit"])}">{self.inside()}</{t}>'

    def notice(self) -> str:
        where = self.pick([f'class="{self.name(NOTICE, 0.1)}"', 'role="alert"', f'id="{self.pick(NOTICE)}-bar"', f'class="{self.pick(["cookie", "consent", "site"])}-{self.pick(["notice", "banner"])}"'])
        return f"<div {where}>{self.inside()}{self.pick(['', '<button>' + self.short() + '</button>'])}</div>"

    def inside(self) -> str:
        kind = self.draw.random()
        if kind < 0.45:
            return self.text(4)
        if kind < 0.85:
            return self.many(lambda: f"<p>{self.text(4)}</p>", 1, 3)
        return f'<h3>{self.short()}</h3><p>{self.text(2)} <a href="/z">{self.short()}</a></p>'

    def sidebar(self) -> str:
        tag = self.pick(["aside", "aside", "div", "section"])
        names = ASIDE
        mark = f' class="{self.name(names)}"' if tag != "aside" or self.chance(0.6) else ""
        return f"<{tag}{mark}>{self.pick([self.links, self.inside, lambda: f'<h3>{self.short()}</h3>' + self.links()])()}</{tag}>"

    def form(self) -> str:
        inner = "".join([f"<label>{self.short()}</label><input type=text>", f"<p>{self.text(1)}</p>" if self.chance(0.5) else "",
                         f"<textarea>{self.short()}</textarea>" if self.chance(0.4) else "", f"<button>{self.short()}</button>"])
        return f"<form{self.attributes(FORM)}>{inner}</form>"

    def comments(self) -> str:
        one = self.pick(["div", "li", "article", "section"])
        name = self.name(["comment", "reply", "comment-body", "reader-comment", "response"])
        each = lambda: f'<{one} class="{name}"><p>{self.text(3)}</p>{self.pick(["", f"<span>{self.short()}</span>"])}</{one}>'
        outer = self.pick(["section", "div", "div", "ul", "aside"])
        return (f'<{outer} {self.pick(["class", "id"])}="{self.name(TALK)}">{self.pick(["", f"<h3>{self.short()}</h3>"])}'
                f'{self.many(each, 1, 150 if self.chance(0.02) else 5)}{self.form() if self.chance(0.3) else ""}</{outer}>')

    def head(self) -> str:
        tag = self.pick(["header", "header", "div"])
        mark = self.attributes(EDGE) if tag == "header" else f' class="{self.name(EDGE)}"'
        return f"<{tag}{mark}>{self.pick([f'<h1>{self.short()}</h1>', f'<p>{self.text(2)}</p>', self.short()])}{self.navigation() if self.chance(0.4) else ''}</{tag}>"

    def foot(self) -> str:
        tag = self.pick(["footer", "footer", "footer", "div"])
        mark = self.attributes(["footer", "site-footer", "bottom"]) if tag == "footer" else ' class="footer"'
        return f"<{tag}{mark}>{self.pick([self.text(2), f'<p>&copy; {self.short()} &middot; {self.text(1)}</p>', f'&copy; {self.short()} &middot; {self.text(2)}', self.links()])}</{tag}>"

    def page(self) -> str:
        extras = [self.advert, self.notice, self.sidebar, self.form]
        body = f"<h1 data-truth>{self.short() if self.chance(0.5) else self.text(1)}</h1>" if self.chance(0.85) else ""
        long = self.chance(0.02)
        # some articles stand in the page itself, and some elements of articles end too early: text is loose there
        bare = self.pick([0.1, 0.4, 0.8, 1.0]) if self.chance(0.2) else 0
        early = "" if not bare or self.chance(0.6) else self.many(self.paragraph, 1, 5)
        for _ in range(int(self.draw.integers(65, 400) if long else self.draw.integers(1, 16))):
            body += self.loose() if bare and self.chance(bare) else self.paragraph()
            if self.chance(0.01 if long else 0.08):
                body += self.pick([*extras, self.comments])()
        if self.chance(0.25):
            body += self.comments()
        if self.chance(0.1):
            body += self.foot()
        if self.chance(0.1) and not bare:
            body = f"<header data-truth>{body[:body.find('</h1>') + 5]}</header>{body[body.find('</h1>') + 5:]}" if "</h1>" in body else body
        style = self.draw.random()
        # names of articles may say what they are about, and then they sound like other parts of a page
        names = [self.pick(ARTICLE), self.pick(ARTICLE), self.pick(ARTICLE), self.pick(SUBJECT), f"{self.pick(ARTICLE)} {self.pick(SUBJECT)} {self.pick(SUBJECT)}",
                 f"{self.pick(ARTICLE)} tag-{self.pick(SUBJECT)} category-{self.pick([*ASIDE, *TALK])}"]
        if bare:
            head, inner = (body[:body.find("</h1>") + 5], body[body.find("</h1>") + 5:]) if "</h1>" in body else ("", body)
            body = f"<article data-truth>{head}{early}</article>{inner}" if early else body
        elif style < 0.55:
            body = f"<article{self.attributes(names) if self.chance(0.4) else ''} data-truth>{body}</article>"
        elif style < 0.75:
            body = f'<div {self.pick(["class", "id"])}="{self.pick(names)}" data-truth>{body}</div>'
        elif style < 0.9:
            body = f"<main{self.attributes(names)} data-truth>{body}</main>"
        else:
            body = f"<div data-truth>{body}</div>"
        if self.chance(0.25) and not bare:
            body = f'<div{self.attributes(["page", "container", "wrapper", "row", "site", "site-content", "main-area"])} data-truth>{self.pick(["", self.navigation()])}{body}{self.sidebar() if self.chance(0.5) else ""}</div>'
        before = "".join(f() for f, share in ((self.head, 0.5), (self.navigation, 0.7), (self.notice, 0.3), (self.advert, 0.45)) if self.chance(share))
        after = "".join(f() for f, share in ((self.comments, 0.3), (self.sidebar, 0.4), (self.advert, 0.25), (self.form, 0.2), (self.notice, 0.2), (self.foot, 0.8)) if self.chance(share))
        if self.chance(0.15):
            before = self.stray() + before
        if self.chance(0.15):
            after = f"<hr>{self.stray()}{after}" if self.chance(0.5) else f"{after}<hr>{self.stray()}"
        page = f"<!DOCTYPE html><html><head><title>{self.short()}</title></head><body>{before}{body}{after}</body></html>"
        return page[:int(len(page) * self.draw.uniform(0.5, 1))] if self.chance(0.08) else page


def written_pages(pool: list[str], config: ExtractConfig, seed: int = 1) -> list[str]:
    writer = _Writer(pool, seed)
    return [writer.page() for _ in range(config.layouts)]


def labelled_pages(pages: list[str]) -> list[list[dom.Node]]:
    """The nodes of written pages; ``truth`` says which are part of the article."""
    out = []
    for page in pages:
        # the mark must not be seen by the features, so it travels in a word of its own
        nodes = dom.parse(page.replace(" data-truth", ' role="zztruthzz"'))
        for node in nodes:
            node.truth = "zztruthzz" in node.tokens or any(TRUTH in text for _, text, _ in node.units)
            node.units = [(place, text.replace(TRUTH, ""), linked) for place, text, linked in node.units]
            node.tokens = frozenset(t for t in node.tokens if "zztruthzz" not in t)
        out.append(nodes)
    return out


def token_evidence(pages: list[list[dom.Node]], doubt: float = 4.0) -> np.ndarray:
    """Log odds of article for each bucket of attribute words against the odds of all nodes with words; ``doubt`` nodes of
    average odds are added to each, so a bucket never seen has 0."""
    seen = [(dom.bucket(token), node.truth) for nodes in pages for node in nodes[1:] for token in node.tokens]
    if not seen:
        return dom.NO_EVIDENCE
    where, truth = (np.array(c) for c in zip(*seen))
    yes = np.bincount(where[truth], minlength=dom.TOKEN_BUCKETS)
    no = np.bincount(where[~truth], minlength=dom.TOKEN_BUCKETS)
    share = (truth.sum() + 1) / (len(truth) + 2)
    return np.log((yes + doubt * share) / (no + doubt * (1 - share)) / (share / (1 - share)))


def node_rows(pages: list[list[dom.Node]], evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all nodes but the roots, and whether they are part of the article."""
    rows = [dom.features(nodes, evidence)[1:] for nodes in pages]
    return np.concatenate(rows), np.array([node.truth for nodes in pages for node in nodes[1:]], dtype=float)


@dataclass
class Extractor:
    evidence: np.ndarray      # of the buckets of attribute words
    trees: boosting.Trees

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.trees.score(x)


def fit_written(pages: list[str], trees: int = 60, depth: int = 5) -> Extractor:
    """The trees see each half of the pages with the evidence of the other half, as they will see names on pages not written here."""
    parsed = labelled_pages(pages)
    halves = parsed[::2], parsed[1::2]
    parts = [node_rows(own, token_evidence(other)) for own, other in (halves, halves[::-1]) if own]
    fitted = boosting.fit(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]), trees=trees, depth=depth)
    return Extractor(token_evidence(parsed), fitted)


def fit_extractor(pages: DataFrame, config: ExtractConfig = ExtractConfig(), id_col: str = "page_id", html_col: str = "html") -> Extractor:
    """Fitted on pages written from the text of ``sample`` ids of ``pages``: of each at most ``sample_units`` pieces of at most
    ``unit_chars`` characters, which are cut out in the tasks. A repeated id gives its least html, so reruns agree."""
    named = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html")).filter("_id is not null and _html is not null")
    # Ids first, so that only the pages drawn travel.
    drawn = named.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(config.sample)
    chosen = named.join(F.broadcast(drawn), "_id").groupBy("_id").agg(F.min("_html").alias("_html"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [[text[:config.unit_chars].replace(TRUTH, " ") for node in dom.parse(page) for _, text, _ in node.units[:config.sample_units]][:config.sample_units]
                     for page in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(units, pa.list_(pa.string()))], names=["_id", "_units"])
    rows = chosen.select(F.col("_id").cast("long"), "_html").mapInArrow(pieces, "_id long, _units array<string>").collect()
    pool = [text for row in sorted(rows, key=lambda r: r["_id"]) for text in row["_units"]] or ["text"]
    return fit_written(written_pages(pool, config))


def extract(page: str | None, model: Extractor) -> str:
    return extract_all([page], model)[0]


def extract_all(pages: list[str | None], model: Extractor) -> list[str]:
    """The text of each page."""
    trees = [dom.parse(p) if p else [] for p in pages]
    rows = [dom.features(t, model.evidence)[1:] for t in trees if len(t) > 1]
    scores = model.score(np.concatenate(rows)) if rows else np.empty(0)
    out, at = [], 0
    for nodes in trees:
        own = np.append(0.0, scores[at:at + max(len(nodes) - 1, 0)])
        at += max(len(nodes) - 1, 0)
        # text without any block element: there is nothing else to choose from
        bare = all(n.tag == dom.LOOSE for n in nodes[1:])
        out.append(dom.kept_text(nodes, [True] * len(nodes) if bare else dom.decode(nodes, own)))
    return out


def extract_pages(pages: DataFrame, model: Extractor, config: ExtractConfig = ExtractConfig(), id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row (id, url, text, n_chars) per row of ``pages``.

    text: the blocks of the article in page order, one per line, character references decoded, white space inside a block as one
    space; empty if there is none, and for null and empty html. Html of any quality is read; what is cut off inside a tag is
    left out. An empty table gives an empty table. Only the id, url and html columns are read; ids may be null or repeat.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("_html").to_pylist()
            for at in range(0, len(bodies), 64):
                texts = extract_all(bodies[at:at + 64], model)
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["_id", "_url", "text", "n_chars"])
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    out = rows.mapInArrow(run, "_id long, _url string, text string, n_chars long")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")

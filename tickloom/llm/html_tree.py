"""Main text of web pages by a tree-structured graphical model.

A page is parsed into its element tree.  Every element has a hidden state,
content or not; an edge potential ties it to its parent's state and node
potentials tie it to what can be seen of it (its tag, the words of its class, id
and role, and how much text, linked text and punctuation it holds).  Sum-product
messages go up from the leaves and down from the root and give each element's
marginal; text whose element is content with probability one half or more is
kept.  The potentials are counts over labelled pages: a page that marks its
article (MARKERS) labels its own elements, those inside the mark and outside
boilerplate in it being content.  Only scripts, styles, form controls and the like
(UNSEEN) are cut whatever the potentials say.  Pages without such a mark are extracted with the same
potentials.  Fixed shares stand for what the labelled pages do not show.

Fitting takes a bounded sample, the SAMPLE pages with the smallest hash of their
id, and counts them in Spark.  Extraction covers every page and all of it.

Defined cases: null and empty html give empty text; unclosed tags end where the
markup rules end them, an unclosed comment or script ends with the page; repeated
rows are extracted each; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, table

SAMPLE = 4000

# Groups of tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
UNSEEN = frozenset("head title script style noscript template iframe object svg textarea select option button".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
caption head title""".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
MARKERS = frozenset("article main".split())
TEXT = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figcaption caption table thead tbody tfoot tr td th".split())
OUTER = frozenset("#page html body".split())
# What an opening tag ends, up to the nearest of its holders.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"})}
# Words of class, id and role.
POOR_WORDS = frozenset("""ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent
notice alert warning popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside complementary
related recommended share sharing social footer foot header masthead contentinfo comment comments reply replies respond disqus discussion
subscribe newsletter signup login search form widget toolbar skip copyright legal disclaimer tags meta""".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus discussion".split())
GOOD_WORDS = frozenset("""article articlebody content body entry main post story text page prose hentry""".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
VALUE = re.compile(r"""=\s*+(?:(["'])|[^\s>"'][^\s>]*+)|>""")          # of an attribute, quoted or not; or the tag's end
NAMES = re.compile(r"""([^\s=/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|(\S*+)))?""")
NAMED = frozenset("class id role itemprop".split())
WORDS = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"[.,;:!?]")


class Tree:
    """Elements of a page in page order: tag, class words, parent; and the text
    runs with the element each belongs to.  ``None`` runs are block ends."""

    def __init__(self, page: str):
        self.tag, self.names, self.parent = ["#page"], [frozenset()], [-1]
        self.runs: list[tuple[int, str | None]] = []
        self.stack = [0]
        self.open: Counter = Counter()
        self.lost: set[int] = set()          # opening quotes from which no tag end was found
        self.parse(page)

    def tag_end(self, page: str, at: int) -> int:
        """Position of the ``>`` that ends the tag whose attributes begin at ``at``,
        not one within a quoted value; where a quote stays open to the page's end,
        of the first ``>``.  Linear: no quote is followed in vain twice."""
        first, tried = at, []
        while m := VALUE.search(page, at):
            if m[0] == ">":
                return m.start()
            at = m.end()
            if m[1]:
                if at in self.lost:
                    break
                tried.append(at)
                at = page.find(m[1], at) + 1
                if not at:
                    break
        self.lost.update(tried)
        return page.find(">", first)

    def parse(self, page: str) -> None:
        at, last = 0, page.rfind(">")
        while at < len(page):
            left = page.find("<", at)
            if left < 0:
                left = len(page)
            m = TAG.match(page, left) if left < last else None
            if m:
                end = self.tag_end(page, m.end())
                attributes, stop = page[m.end():end], end + 1
            elif page.startswith("<!--", left):
                stop = page.find("-->", left + 4) + 3
            elif page.startswith(("<!", "<?"), left):
                stop = page.find(">", left) + 1
            else:                            # no markup: text, or a tag that the page's end cuts
                stop = left + 1 if left < last or not page[left + 1:left + 2].isalpha() else 0
                left = min(stop, len(page)) if stop else left
            if left > at:
                self.runs.append((self.stack[-1], html.unescape(page[at:left])))
            if stop <= at:
                return
            at = stop
            tag = m[2].lower() if m else ""
            if tag and m[1]:
                self.close(tag)
            elif tag:
                self.start(tag, attributes)
                if tag in RAW and self.stack[-1] == len(self.tag) - 1:
                    end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
                    at = end.start() if end else len(page)

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK and self.open["p"]:
            self.pop_until({"p"}, {"table", "td", "th", "button"})
        if tag in ENDS:
            self.pop_until(*ENDS[tag])
        found = " ".join(a or b or c for k, a, b, c in NAMES.findall(attributes) if k.lower() in NAMED) if "=" in attributes else ""
        self.tag.append(tag)
        self.names.append(frozenset(WORDS.findall(found.lower())) if found else frozenset())
        self.parent.append(self.stack[-1])
        if tag in BLOCK:
            self.runs.append((self.stack[-1], None))
        elif tag == "br":
            self.runs.append((self.stack[-1], " "))
        if tag not in VOID and not attributes.endswith("/"):
            self.stack.append(len(self.tag) - 1)
            self.open[tag] += 1

    def pop_until(self, wanted: set[str], holders: set[str]) -> None:
        """End the outermost open element of ``wanted`` inside the nearest holder."""
        if not any(self.open[t] for t in wanted):
            return
        last = None
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[k]]
            if tag in wanted:
                last = k
                if not holders & {"tr", "table"}:
                    break
            elif tag in holders:
                break
        if last is not None:
            self.cut(last)

    def close(self, tag: str) -> None:
        if not self.open[tag]:
            return
        inline = tag not in BLOCK
        for k in range(len(self.stack) - 1, 0, -1):
            here = self.tag[self.stack[k]]
            if here == tag:
                return self.cut(k)
            if inline and here in BLOCK:
                return                  # an inline end does not end blocks

    def cut(self, k: int) -> None:
        for i in self.stack[k:]:
            self.open[self.tag[i]] -= 1
            if self.tag[i] in BLOCK:
                self.runs.append((self.parent[i], None))
        del self.stack[k:]


def marks(tree: Tree) -> list[bool]:
    """Elements that mark an article."""
    return [tag in MARKERS or "articlebody" in names for tag, names in zip(tree.tag, tree.names)]


def inside_of(tree: Tree, mark: list[bool]) -> list[bool]:
    """Elements that are a mark or lie within one."""
    inside = mark[:]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[tree.parent[i]]
    return inside


def poor_words(names: frozenset[str]) -> bool:
    return bool(names & POOR_WORDS) and not names & GOOD_WORDS


def cut_off(tree: Tree) -> list[bool]:
    """Elements whose text is not for readers, with all they hold.  They take no part in
    the model: they are never content and send no message."""
    out = [False] * len(tree.tag)
    for i in range(1, len(out)):
        out[i] = out[tree.parent[i]] or tree.tag[i] in UNSEEN
    return out


def contexts(tree: Tree, chars: list[int]) -> list[str]:
    """What each element stands in: the nearest of itself and the elements around it that marks an article, is
    a boilerplate tag or names itself by class, id or role; ``most`` where boilerplate outside any mark holds half
    of the page's text.  Headings, paragraphs and table parts are no surroundings.  Empty for none."""
    out, mark = [""] * len(tree.tag), marks(tree)
    inside = inside_of(tree, mark)
    for i in range(1, len(out)):
        tag, names = tree.tag[i], tree.names[i]
        own = ""
        if mark[i]:
            own = "mark"
        elif tag in BOILERPLATE:
            own = tag
        elif tag not in TEXT and tag not in OUTER and poor_words(names):
            own = "comments" if names & COMMENT_WORDS else "poor"
        elif tag in BLOCK and tag not in OUTER and names & GOOD_WORDS:
            own = "good"
        if own and own not in ("mark", "good", "comments") and not inside[i] and 2 * chars[i] >= chars[0]:
            own = "most"
        out[i] = own or out[tree.parent[i]]
    return out


def bucket(x: float, edges: tuple[float, ...]) -> int:
    return sum(x >= e for e in edges)


def observed(tree: Tree) -> list[tuple[str, ...]]:
    """What can be seen of each element: one value of each kind."""
    n = len(tree.tag)
    chars, linked, marks, paragraphs = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    unseen = [False] * n
    for i in range(1, n):
        p = tree.parent[i]
        in_link[i] = in_link[p] or tree.tag[i] == "a"
        unseen[i] = unseen[p] or tree.tag[i] in UNSEEN
    for i, text in tree.runs:
        if text and not unseen[i]:
            size = len(text.strip())
            chars[i] += size
            linked[i] += size if in_link[i] else 0
            marks[i] += len(SENTENCE.findall(text))
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        paragraphs[p] += (tree.tag[i] == "p" and chars[i] >= 80) + paragraphs[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
    out, around = [], contexts(tree, chars)
    for i in range(n):
        tag, names = tree.tag[i], tree.names[i]
        word = ["word=" + ("mixed" if names & POOR_WORDS else "good")] if names & GOOD_WORDS else ["word=poor"] if poor_words(names) else []
        if tag in OUTER:
            seen = ["tag=" + tag]
        elif tag not in BLOCK:
            seen = word + (["under=" + around[i]] if i and around[i] != around[tree.parent[i]] else [])      # inline elements go with their parent
        else:
            seen = ["tag=" + tag, *word] + (["under=" + around[i]] if around[i] else [])
            if chars[i]:
                seen.append(f"linked={bucket(linked[i] / chars[i], (0.01, 0.3, 0.7))}")
            if chars[i] >= 80:                    # shorter text says little
                seen.append(f"size={bucket(chars[i], (250, 1000))}")
                seen.append(f"marks={bucket(100 * marks[i] / chars[i], (0.5, 1.5))}")
            if paragraphs[i]:
                seen.append(f"paragraphs={bucket(paragraphs[i], (3,))}")
        out.append(tuple(seen))
    return out


def labels(tree: Tree) -> list[int] | None:
    """States of a page that marks its article: what is inside a mark, but for the boilerplate there and
    what is cut off; None for a page without a mark."""
    mark, cut = marks(tree), cut_off(tree)
    if not any(mark):
        return None
    state = [0] * len(mark)
    for i in range(1, len(mark)):
        tag = tree.tag[i]
        poor = cut[i] or tag in BOILERPLATE or tag not in TEXT and poor_words(tree.names[i])
        state[i] = int(mark[i] and not cut[i] or state[tree.parent[i]] and not poor)
    return state


# Shares among (not content, content) that stand for what labelled pages do not show.
PRIOR = {"word=good": (0.01, 0.2), "word=poor": (0.2, 0.02), "tag=article": (0.005, 0.2), "tag=main": (0.01, 0.2), "tag=p": (0.05, 0.3), "tag=h1": (0.04, 0.1),
         "tag=blockquote": (0.01, 0.05), "tag=pre": (0.01, 0.05), "tag=body": (0.3, 0.03), "tag=html": (0.3, 0.01), "linked=3": (0.3, 0.02),
         "linked=0": (0.2, 0.5), "paragraphs=0": (0.05, 0.2), "paragraphs=1": (0.02, 0.2), "size=1": (0.1, 0.3), "size=2": (0.05, 0.3),
         "marks=0": (0.4, 0.1), "marks=2": (0.1, 0.4), "under=mark": (0.02, 0.6), "under=good": (0.05, 0.3), "under=most": (0.1, 0.1),
         **{"under=" + v: (0.1, 0.0001) for v in ("comments", "poor", *sorted(BOILERPLATE))}}
OTHERWISE = 0.02
PRIOR_SHARE = 0.2
EDGE_PRIOR = {(0, 0): 0.83, (0, 1): 0.17, (1, 0): 0.05, (1, 1): 0.95}
STRONGEST, AROUND = 4.0, 8.0      # log odds that one seen value, and that the surroundings, may give


def counts(pages: list[str | None]) -> Counter:
    """Counts of (seen value, state) and (parent's state, state) over labelled pages."""
    found: Counter = Counter()
    for page in pages:
        tree = Tree(page or "")
        state = labels(tree)
        if state is None:
            continue
        poor = cut_off(tree)
        for i, seen in enumerate(observed(tree)):
            # what is cut off still shows how boilerplate text looks, but not where it stands
            found.update((v, str(state[i])) for v in seen if not poor[i] or not v.startswith(("tag=", "word=", "under=")))
            if i and not poor[i]:
                found[f"edge{state[tree.parent[i]]}", str(state[i])] += 1
    return found


def log_sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b)); ``a`` is finite."""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


class Model:
    """Node and edge potentials."""

    def __init__(self, found: dict[tuple[str, str], int]):
        self.edge = [[0.0, 0.0], [0.0, 0.0]]
        for up in (0, 1):
            n = [found.get((f"edge{up}", str(s)), 0) for s in (0, 1)]
            known = 1 - PRIOR_SHARE if sum(n) else 0.0
            self.edge[up] = [known * x / max(1, sum(n)) + (1 - known) * EDGE_PRIOR[up, s] for s, x in enumerate(n)]
        total: Counter = Counter()
        for (v, state), n in found.items():
            total[v.split("=")[0], state] += n
        self.node = {}
        for v in {v for v, _ in found if "=" in v} | set(PRIOR):
            p = [(1 - PRIOR_SHARE) * found.get((v, str(s)), 0) / max(1, total[v.split("=")[0], str(s)])
                 + PRIOR_SHARE * PRIOR.get(v, (OTHERWISE, OTHERWISE))[s] for s in (0, 1)]
            most = AROUND if v.startswith("under=") else STRONGEST
            self.node[v] = max(-most, min(most, math.log(p[1] / p[0])))

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of each element by messages up and down the tree."""
        seen, poor = observed(tree), cut_off(tree)
        n = len(seen)
        below = [sum(self.node.get(v, 0.0) for v in s) for s in seen]      # log odds: own potential and messages from the children
        below[0] = -math.inf                 # the page itself holds no content
        (e00, e01), (e10, e11) = [[math.log(x) for x in row] for row in self.edge]
        up = [0.0] * n                       # message to the parent, as log odds
        for i in range(n - 1, 0, -1):
            if not poor[i]:
                up[i] = log_sum(e10, e11 + below[i]) - log_sum(e00, e01 + below[i])
                below[tree.parent[i]] += up[i]
        belief = below[:]
        for i in range(1, n):
            rest = belief[tree.parent[i]] - up[i]         # the parent without this child's message
            belief[i] = -math.inf if poor[i] else below[i] + log_sum(e01, e11 + rest) - log_sum(e00, e10 + rest)
        return [1 / (1 + math.exp(-b)) if b > -700 else 0.0 for b in belief]


def extract(page: str, model: Model) -> str:
    tree = Tree(page)
    keep = [p >= 0.5 for p in model.marginals(tree)]
    blocks, now = [], []
    for i, text in [*tree.runs, (0, None)]:
        if text is None:
            words = "".join(now).split()
            if words:
                blocks.append(" ".join(words))
            now = []
        elif keep[i]:
            now.append(text)
    return "\n".join(blocks)


def fit(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", source: str = "html", sample: int = SAMPLE) -> Model:
    """Potentials from the labelled pages of a bounded sample."""
    chosen = pages.select(page_id).where(F.col(page_id).isNotNull()).orderBy(F.xxhash64(page_id), page_id).limit(sample).distinct()
    rows = pages.select(page_id, source).join(F.broadcast(chosen), page_id).select(source)       # SAMPLE ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = counts(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in found], pa.string()), pa.array([s for _, s in found], pa.string()),
                                              pa.array(list(found.values()), pa.int64())], names=["value", "state", "n"])

    summed = rows.mapInArrow(run, "value string, state string, n long").groupBy("value", "state").agg(F.sum("n").alias("n"))
    return Model({(r.value, r.state): r.n for r in summed.collect()})        # a few hundred rows


def main_text(pages: DataFrame, model: Model, keep: list[str], source: str = "html") -> DataFrame:
    """``keep`` and the main ``text`` of every page."""
    def make():
        return lambda found: [[extract(p, model) for p in found]]
    return map_texts(pages, keep, source, T.StructType([T.StructField("text", T.StringType())]), make)


def op8_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = main_text(pages, fit(spark, pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))

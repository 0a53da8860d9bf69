"""Main text of web pages by a tree-structured graphical model.

Every block element of a page has a hidden label: content or not.  Its tag, its class names and the look of its text
speak for or against content, and a potential between parent and child lets the labels of a branch support each other.
Messages are passed from the leaves to the root and back (sum-product), which gives the exact marginal of every node.
Weights are fitted to pages whose labels are known by gradient ascent on the conditional likelihood, whose gradient
needs just these marginals.  Text of elements that are likelier content than not is the main text.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.html_layouts import known_label, layouts
from tidewatch.llm.html_tree import Node, attribute, parse
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

# Bounds of the pages that the model is fitted on, besides the layouts that come with the package.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 30_000
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Weights:
    node: dict[str, float]
    # Log potential of (parent label, child label).
    edge: list[list[float]]


def features(nodes: list[Node]) -> list[list[str]]:
    n = len(nodes)
    own = [sum(len(t) for _, t, _ in x.runs) for x in nodes]
    linked = [sum(k for _, _, k in x.runs) for x in nodes]
    stops = [sum(t.count(". ") + t.count(", ") + (t[-1:] in ".!?") for _, t, _ in x.runs) for x in nodes]
    total, links, marks = own[:], linked[:], stops[:]
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        total[p] += total[i]
        links[p] += links[i]
        marks[p] += marks[i]
    found = []
    for i, x in enumerate(nodes):
        share = links[i] / total[i] if total[i] else 0.0
        size = min(6, int(math.log10(total[i] + 1) * 2))
        above = nodes[x.parent].tag if i else ""
        out = ["bias", f"tag={x.tag}", f"inside={above}", f"tag,inside={x.tag},{above}", f"size={size}", f"links={int(share * 4)}", f"size,links={size},{int(share * 4)}"]
        out.append(f"marks={min(3, int(200 * marks[i] / (total[i] + 20)))}")
        out.append(f"page share={int(4 * total[i] / (total[0] + 1))}")
        for name in ("class", "id", "role"):
            if x.attributes:
                value = attribute(x.attributes, name)
                out += [f"word={w.lower()}" for w in dict.fromkeys(_PART.findall(value))]
        found.append(out)
    return found


def marginals(nodes: list[Node], scores: list[float], edge: list[list[float]]) -> tuple[list[float], list[list[list[float]]]]:
    """Probability of content of every node, and of (parent label, child label) of every node but the root.

    ``scores`` are the log potentials of label 1 against 0.  Messages are kept normalised, so long pages don't
    under- or overflow.
    """
    n = len(nodes)
    pot = [[math.exp(v) for v in row] for row in edge]
    inward = []
    for s in scores:
        s = max(-30.0, min(30.0, s))
        p = 1 / (1 + math.exp(-s))
        inward.append([1 - p, p])
    up = [[1.0, 1.0]] * n
    for i in range(n - 1, 0, -1):
        a, b = inward[i]
        m0, m1 = pot[0][0] * a + pot[0][1] * b, pot[1][0] * a + pot[1][1] * b
        up[i] = [m0 / (m0 + m1), m1 / (m0 + m1)]
        q = inward[nodes[i].parent]
        c, d = q[0] * up[i][0], q[1] * up[i][1]
        inward[nodes[i].parent] = [c / (c + d), d / (c + d)]
    out, pairs = [0.0] * n, [None] * n
    out[0] = inward[0][1]
    for i in range(1, n):
        p = nodes[i].parent
        above = [(1 - out[p]) / max(up[i][0], 1e-300), out[p] / max(up[i][1], 1e-300)]
        joint = [[above[a] * pot[a][b] * inward[i][b] for b in (0, 1)] for a in (0, 1)]
        z = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
        pairs[i] = [[v / z for v in row] for row in joint]
        out[i] = pairs[i][0][1] + pairs[i][1][1]
    return out, pairs


def fit(pages: list[tuple[list[Node], list[int]]], epochs: int = 30, rate: float = 0.5, decay: float = 1e-3) -> Weights:
    """Maximum conditional likelihood by Adagrad over pages with a label for every node."""
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    edge, edge_squares = [[0.0, 0.0], [0.0, 0.0]], [[1e-2, 1e-2], [1e-2, 1e-2]]
    known = [(nodes, labels, features(nodes)) for nodes, labels in pages]
    for _ in range(epochs):
        for nodes, labels, found in known:
            scores = [sum(weights.get(f, 0.0) for f in fs) for fs in found]
            p, pairs = marginals(nodes, scores, edge)
            gradient: dict[str, float] = {}
            for i, fs in enumerate(found):
                for f in fs:
                    gradient[f] = gradient.get(f, 0.0) + labels[i] - p[i]
            for f, g in gradient.items():
                g = g / len(nodes) - decay * weights.get(f, 0.0)
                squares[f] = squares.get(f, 1e-2) + g * g
                weights[f] = weights.get(f, 0.0) + rate * g / math.sqrt(squares[f])
            for a in (0, 1):
                for b in (0, 1):
                    g = sum((labels[nodes[i].parent] == a and labels[i] == b) - pairs[i][a][b] for i in range(1, len(nodes)))
                    g = g / len(nodes) - decay * edge[a][b]
                    edge_squares[a][b] += g * g
                    edge[a][b] += rate * g / math.sqrt(edge_squares[a][b])
    return Weights(weights, edge)


def extract(page: str | None, weights: Weights) -> str:
    """The text of all elements that are likelier content than not, one block a line, in page order."""
    nodes = parse(page)
    get = weights.node.get
    scores = [sum(get(f, 0.0) for f in fs) for fs in features(nodes)]
    content, _ = marginals(nodes, scores, weights.edge)
    runs = [run for x, p in zip(nodes, content, strict=True) if p > 0.5 for run in x.runs]
    return "\n".join(t for _, t, _ in sorted(runs))


def fitted(pages: DataFrame, sample: int = SAMPLE_PAGES, max_chars: int = SAMPLE_CHARS) -> Weights:
    """Fit on the layouts of the package and on at most ``sample`` pages that mark their article themselves.

    Sampled are the first by a hash of page_id and text, of at most ``max_chars`` characters.
    """
    marked = pages.where((F.char_length("html") <= max_chars) & F.col("html").rlike("(?i)<(article|main)[ >]"))
    keyed = marked.select(F.xxhash64("page_id", "html").alias("h"), "html")
    # Only hashes are ordered; the texts of the chosen ones alone come to the driver.
    first = F.broadcast(keyed.select("h").distinct().orderBy("h").limit(sample))
    chosen = keyed.join(first, "h").groupBy("h").agg(F.first("html").alias("html")).orderBy("h").collect()
    found = []
    for source in [*layouts(), *(r.html for r in chosen)]:
        nodes = parse(source)
        labels = known_label(nodes)
        if labels is not None:
            found.append((nodes, labels))
    return fit(found)


def _extracted(shared):
    def run(batches):
        weights = Weights(*shared.value)
        for batch in batches:
            texts = [extract(h.as_py(), weights) for h in batch.column(2)]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return run


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """One row per page: page_id, url, text ("" if there is none), n_chars in code points.

    Null html counts as empty.  Pages keep their order in a partition; repeated rows give repeated results, an empty
    table none; other columns are ignored.
    """
    weights = weights or fitted(pages)
    shared = pages.sparkSession.sparkContext.broadcast((weights.node, weights.edge))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted(shared), "page_id bigint, url string, text string, n_chars bigint")

"""Main text of HTML pages by a recurrent block labeller.

A numpy bidirectional LSTM reads a page's blocks in order, each as hashed tag path, hashed words
and a few proportions, and says for each whether it is main text. It is fitted on a bounded
sample of pages whose landmarks (article, nav, footer ...) label their blocks; the copies it
learns from have other layouts, so that it knows more than one.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxrisk.llm import common
from wxrisk.llm.blocks import Block, blocks_of

PATH_DIM, WORD_DIM, SHAPE_DIM = 256, 32, 8
INPUTS = PATH_DIM + WORD_DIM + SHAPE_DIM
HIDDEN = 16
#: Pages that the labeller is fitted on, at most, and their largest size.
SAMPLE_PAGES = 240
SAMPLE_PAGE_BYTES = 50_000
LAYOUTS = 8
EPOCHS = 6
#: Pages whose steps are taken together, and the blocks they may have in all.
BATCH_PAGES, BATCH_BLOCKS = 128, 20_000

# Common names of page parts.
MAIN_PARTS = (
    "article", "main", "div content", "div post body", "div entry content", "section article", "div article body", "div story",
    "div main", "div", "section", "div text", "div page", "td", "article post", "main content", "div id main content",
)
SIDE_PARTS = (
    "nav", "div nav", "ul menu", "div menu", "div navbar", "header", "div header", "div banner", "div top bar", "footer", "div footer",
    "div bottom", "aside", "div sidebar", "div widget", "div side", "div ad", "div ads", "div advert", "div advertisement", "div sponsored",
    "div promo", "div cookie notice", "div cookie banner", "div consent", "div notice", "div alert", "div popup", "div modal",
    "div newsletter", "div subscribe", "form", "form search", "form login", "div comments", "section comments", "div comment",
    "ol comment list", "div reply", "div disqus", "div related", "div recommended", "div share", "div social", "div breadcrumb",
    "div breadcrumbs", "div copyright", "div legal", "div pagination", "div tags", "div toolbar", "dialog", "fieldset", "select",
    "button", "label", "menu", "section related", "div author box", "div skip link", "div masthead",
)
SIDE_MARKS = frozenset(
    "nav menu navbar header footer aside sidebar widget ad ads advert advertisement sponsored promo cookie consent notice alert popup modal "
    "newsletter subscribe form comments comment reply disqus related recommended share social breadcrumb breadcrumbs copyright legal "
    "pagination toolbar dialog fieldset select option button label masthead banner".split()
)
MAIN_MARKS = frozenset(("article", "main"))


def path_places(path: tuple[tuple[str, ...], ...]) -> list[int]:
    """Cells of the hashed tag path: every tag and name around a block, the innermost tag, and the depth."""
    marks = {mark for step in path for mark in step} - {"html", "body"}
    marks |= {f"last:{path[-1][0]}"} if path else set()
    marks |= {f"depth:{min(len(path), 12)}"}
    return sorted({zlib.crc32(mark.encode()) % PATH_DIM for mark in marks})


def features(pages: list[list[Block]]) -> np.ndarray:
    """Inputs of all blocks of all pages, one after the other."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), INPUTS), np.float32)
    if not blocks:
        return out
    seen: dict[tuple, list[int]] = {}
    for k, b in enumerate(blocks):
        places = seen.get(b.path)
        if places is None:
            places = seen[b.path] = path_places(b.path)
        out[k, places] = 1
    words, starts = common.word_hashes(pa.array([b.text for b in blocks], pa.large_string()))
    counts = np.diff(starts)
    row = np.repeat(np.arange(len(blocks)), counts)
    hashed = np.bincount(row * WORD_DIM + (words % np.uint64(WORD_DIM)).astype(np.int64), minlength=len(blocks) * WORD_DIM)
    out[:, PATH_DIM:PATH_DIM + WORD_DIM] = np.sqrt(hashed.reshape(len(blocks), WORD_DIM)) / np.sqrt(np.maximum(counts, 1))[:, None]
    length = np.array([len(b.text) for b in blocks], float)
    at = np.concatenate([np.arange(len(p)) for p in pages])
    whole = np.concatenate([np.full(len(p), len(p)) for p in pages])
    out[:, PATH_DIM + WORD_DIM:] = np.stack([
        np.log1p(length) / 8, np.log1p(counts) / 6, np.array([b.linked for b in blocks]) / length,
        np.array([sum(map(b.text.count, ".,;!?")) for b in blocks]) / np.maximum(counts, 1),
        np.array([b.text[-1] in ".!?:\"'" for b in blocks]), at / whole, 1 / (1 + at), 1 / (whole - at),
    ], axis=1)
    return out


class Labeller:
    """The network: two LSTMs over the blocks of a page, and a logistic output on both states."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.weights = {}
        for side in "fb":
            self.weights[f"x{side}"] = draw.normal(0, 0.15, (INPUTS, 4 * HIDDEN)).astype(np.float32)
            self.weights[f"h{side}"] = draw.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.weights[f"c{side}"] = np.zeros(4 * HIDDEN, np.float32)
        self.weights["out"] = draw.normal(0, 0.15, (2 * HIDDEN, 1)).astype(np.float32)
        self.weights["bias"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States of one direction for padded inputs (pages, blocks, inputs), and what the way back needs."""
        w, pages = self.weights, len(x)
        put = x @ w[f"x{side}"] + w[f"c{side}"]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        states, kept = np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        for t in range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1):
            z = put[:, t] + h @ w[f"h{side}"]
            gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            new = f * c + i * g
            th = np.tanh(new)
            kept.append((t, h, c, i, f, o, g, th, m))
            c = m * new + (1 - m) * c
            h = m * (o * th) + (1 - m) * h
            states[:, t] = h
        return states, kept

    def chances(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, side)[0] for side in "fb"], axis=2)
        return 1 / (1 + np.exp(-(both @ self.weights["out"] + self.weights["bias"])[:, :, 0]))

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the blocks, and its slopes."""
        w = self.weights
        runs = {side: self._run(x, mask, side) for side in "fb"}
        both = np.concatenate([runs[s][0] for s in "fb"], axis=2)
        p = 1 / (1 + np.exp(-(both @ w["out"] + w["bias"])[:, :, 0]))
        n = mask.sum()
        loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n)
        d = (mask * (p - y) / n)[:, :, None]
        slopes = {"out": (both * d).sum((0, 1))[:, None], "bias": d.sum((0, 1))}
        into = d * w["out"][:, 0]
        for k, side in enumerate("fb"):
            dstate = into[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            dput = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            dwh = np.zeros_like(w[f"h{side}"])
            for t, h, c, i, f, o, g, th, m in reversed(runs[side][1]):
                dh = dh + dstate[:, t]
                live, dnew = m * dh, m * dc
                dnew = dnew + live * o * (1 - th * th)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), live * th * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                dput[:, t] = dz
                dwh += h.T @ dz
                dc = dnew * f + (1 - m) * dc
                dh = dz @ w[f"h{side}"].T + (1 - m) * dh
            slopes[f"x{side}"] = np.tensordot(x, dput, ([0, 1], [0, 1]))
            slopes[f"c{side}"] = dput.sum((0, 1))
            slopes[f"h{side}"] = dwh
        return loss, slopes

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 7) -> float:
        """Adam over batches of pages of like length; returns the last epoch's mean loss."""
        draw = random.Random(seed)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k][1]))
        groups = [order[a:a + 48] for a in range(0, len(order), 48)]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, loss = 0, 0.0
        for _ in range(epochs):
            draw.shuffle(groups)
            losses = []
            for group in groups:
                x, mask = padded([pages[k][0] for k in group])
                y, _ = padded([pages[k][1][:, None].astype(np.float32) for k in group])
                loss, slopes = self.gradients(x, y[:, :, 0], mask)
                losses.append(loss)
                step += 1
                for k, slope in slopes.items():
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.99 * second[k] + 0.01 * slope * slope
                    self.weights[k] = (self.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page which of its blocks are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < BATCH_PAGES and (end - at + 1) * len(pages[order[end]]) <= BATCH_BLOCKS:
                end += 1
            group = order[at:end]
            inputs = features([pages[k] for k in group])
            cuts = np.cumsum([len(pages[k]) for k in group])[:-1]
            x, mask = padded(np.split(inputs, cuts))
            for k, chances in zip(group, self.chances(x, mask), strict=True):
                out[k] = chances[:len(pages[k])] >= 0.5
            at = end
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    most = max(map(len, rows))
    x, mask = np.zeros((len(rows), most, rows[0].shape[1]), np.float32), np.zeros((len(rows), most), np.float32)
    for k, r in enumerate(rows):
        x[k, :len(r)], mask[k, :len(r)] = r, 1
    return x, mask


def landmark(block: Block) -> bool | None:
    """What a page's own landmarks say of a block; None where they say nothing."""
    marks = {m for step in block.path for m in step}
    if marks & SIDE_MARKS:
        return False
    return True if marks & MAIN_MARKS else None


def relaid(pages: list[list[Block]], layouts: int = LAYOUTS, seed: int = 7) -> list[tuple[list[Block], np.ndarray]]:
    """Labelled pages in other layouts: main text and side parts of the given pages under other names and in other places."""
    draw = random.Random(seed)
    mains = [[b for b in page if landmark(b)] for page in pages]
    sides = [b for page in pages for b in page if landmark(b) is False] or [Block("Home", (("nav",),), 4)]
    mains = [m for m in mains if m]
    out = []

    def steps(name: str) -> tuple[tuple[str, ...], ...]:
        return (tuple(name.split()),)

    def told(own: tuple, b: Block) -> list[Block]:
        """A block of main text in its own tags, or as a list, table or quotation, whole or in pieces."""
        inner = tuple(step for step in b.path if step[0] in ("p", "h1", "h2", "h3", "ul", "li", "blockquote", "pre"))
        if layout and draw.random() < 0.2:
            inner = draw.choice(((("blockquote",), ("p",)), (("pre",),), (("ul",), ("li",)), (("table",), ("tr",), ("td",)), (("dl",), ("dd",)), (("h2",),), (("div",),)))
            words = b.text.split()
            if draw.random() < 0.5 and len(words) > 12:
                cuts = [0, *sorted(draw.sample(range(1, 12), 3)), len(words)]
                return [Block(" ".join(words[a:z]), (*own, *inner), 0) for a, z in zip(cuts, cuts[1:], strict=False)]
        return [Block(b.text, (*own, *inner), b.linked)]

    def side(name: str) -> list[Block]:
        around = tuple(steps(draw.choice(("div", "div wrapper", "div container")))) if draw.random() < 0.3 else ()
        made = []
        wordy = any(m in name for m in ("comment", "reply", "disqus", "related", "newsletter", "notice", "legal", "consent"))
        for _ in range(draw.randint(1, 6)):
            found = draw.choice(draw.choice(mains)) if wordy and draw.random() < 0.7 else draw.choice(sides)
            inner = draw.choice(((), (("li",),), (("p",),), (("ul",), ("li",)), (("div",),), (("h1",),), (("h2",),), (("h3",),), (("td",),)))
            made.append(Block(found.text, (("html",), ("body",), *around, *steps(name), *inner), len(found.text) if found.linked and draw.random() < 0.8 else 0))
        return made

    for main in mains:
        for layout in range(layouts):
            name = "article" if layout < 2 else draw.choice(MAIN_PARTS)
            around = tuple(steps(draw.choice(("div", "div wrapper", "div container", "div page", "main")))) if draw.random() < 0.3 else ()
            own = tuple((("html",), ("body",), *around, *steps(name)))
            body = [(block, True) for b in main for block in told(own, b)]
            if draw.random() < 0.35:  # something that is no main text inside the article
                at = draw.randint(1, len(body))
                body[at:at] = [(Block(b.text, (*own, *b.path[2:]), b.linked), False) for b in side(draw.choice(SIDE_PARTS))]
            before = [(b, False) for _ in range(draw.randint(0, 3)) for b in side(draw.choice(SIDE_PARTS))]
            after = [(b, False) for _ in range(draw.randint(0, 3)) for b in side(draw.choice(SIDE_PARTS))]
            page = before + body + after
            out.append(([b for b, _ in page], np.array([y for _, y in page])))
    return out


def fitted(pages: DataFrame, limit: int = SAMPLE_PAGES) -> Labeller:
    """A labeller of a bounded sample of pages: those with landmarks, up to a size, with the smallest hash of page_id."""
    usable = pages.where(F.octet_length("html").between(1, SAMPLE_PAGE_BYTES))
    chosen = [r["page_id"] for r in common.sampled(usable.select("page_id").distinct(), "page_id", limit).collect()]
    sample = usable.where(F.col("page_id").isin(chosen)).groupBy("page_id").agg(F.min("html").alias("html")).collect()
    found = [blocks_of(r["html"]) for r in sorted(sample, key=lambda r: r["page_id"])]
    own = [([b for b in page if landmark(b) is not None], page) for page in found]
    examples = [(kept, np.array([bool(landmark(b)) for b in kept])) for kept, page in own if len(kept) == len(page) and kept]
    examples += relaid([kept for kept, _ in own if kept])
    model = Labeller()
    if examples:
        model.fit([(features([page]), labels) for page, labels in examples])
    return model


def extracted(pages: DataFrame, model: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars) per row: the blocks that are main text, joined by single spaces.

    Null or empty html, and pages without a main block, give an empty text. Pages are labelled
    alone, so copies, ties, null keys and other columns don't matter.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            html = batch.column(2)
            for a, b in common.chunks(html):
                found = [blocks_of(h) for h in html[a:b].to_pylist()]
                texts = [" ".join(x.text for x, y in zip(page, main, strict=True) if y)
                         for page, main in zip(found, shared.value.label(found), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return plain.mapInArrow(rows, "page_id long, url string, text string, n_chars long")

"""Trains the block labeller on invented pages: python -m tidemart.llm.train_block_labeller

Pages are drawn from a small grammar of layouts (semantic tags or named divs; menus, headers, sidebars, notices, adverts, forms,
comments and footers around an article), with invented words, so every block's label is known.  The weights are written next to
the labeller.
"""

from __future__ import annotations

import random
import time

import numpy as np

from tidemart.llm.block_labeller import HIDDEN, PATH_DIM, WEIGHTS, WORD_DIM, BlockLabeller, Features, padded
from tidemart.llm.html_blocks import blocks_of

# Private-use characters that mark text of a known label while a page is written.
MAIN, OTHER = "\ue000", "\ue001"
# What real sites call these parts.
NAMES = {
    "menu": "nav menu navbar main-nav breadcrumb breadcrumbs topbar tabs toc links".split(),
    "header": "header masthead site-header banner logo page-header top branding".split(),
    "sidebar": "sidebar side aside widget related rail secondary most-read recommended trending".split(),
    "notice": "notice cookie cookies consent gdpr banner alert popup modal newsletter disclaimer privacy overlay".split(),
    "advert": "ad ads advert advertisement sponsored promo promotion adbox banner-ad sponsor".split(),
    "form": "form search login signup subscribe contact search-box newsletter-form".split(),
    "comments": "comments comment comment-list replies responses discussion reply comment-body thread".split(),
    "footer": "footer site-footer bottom copyright legal colophon foot".split(),
    "share": "share social sharing buttons tags tools meta byline-share".split(),
    "article": "content article post entry main-content story article-body post-content entry-content body-text text main page-content story-body".split(),
}
SAID = {
    "menu": "home about contact news products services blog archive login more".split(),
    "header": "welcome site daily news online portal search menu".split(),
    "sidebar": "related popular latest posts read more trending recommended see also top stories".split(),
    "notice": "we use cookies accept privacy policy consent agree settings browser javascript enabled".split(),
    "advert": "buy now sale offer free discount sponsored advertisement shop click here deal".split(),
    "form": "email name password submit search subscribe sign up your message send required".split(),
    "comments": "reply says posted comment great thanks agree ago likes report user guest".split(),
    "footer": "copyright all rights reserved terms privacy contact © · imprint sitemap".split(),
    "share": "share tweet facebook email print tags filed under".split(),
}
SYLLABLES = "an th er in re on es ti en at ed nd ou ha le la que ment ción rr os ie ei sch ung ver ß ä ü é è ra lo mi ka to su ne po".split()


class Writer:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.choice([1, 1, 2, 2, 3, 4])))

    def words(self, n: int, said: list[str] = ()) -> str:
        out = [self.rng.choice(said) if said and self.rng.random() < 0.35 else self.word() for _ in range(n)]
        if self.rng.random() < 0.1:
            out = [w + self.rng.choice(["", "%%%", "***", "&amp;&amp;", "###", " | "]) for w in out]
        return " ".join(out)

    def sentence(self, n: int, said: list[str] = ()) -> str:
        return self.words(n, said).capitalize() + self.rng.choice([".", ".", ".", "!", "?", ""])

    def prose(self, said: list[str] = ()) -> str:
        n = self.rng.choice([1, 1, 2, 3, 6])
        parts = [self.sentence(self.rng.choice([1, 2, 4, 8, 15, 30]), said) for _ in range(n)]
        if self.rng.random() < 0.3:
            i = self.rng.randrange(n)
            parts[i] = self.rng.choice(['<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<span>{}</span>", "{}<br>"]).format(parts[i])
        return " ".join(parts)

    def part(self, kind: str, inner: str) -> str:
        """An element of this kind: its own tag where HTML has one, or a div with a telling name."""
        tags = {"menu": "nav", "header": "header", "sidebar": "aside", "form": "form", "footer": "footer", "article": "article"}
        name = self.rng.choice(NAMES[kind])
        attr = self.rng.choice([f' class="{name}"', f' id="{name}"', f' class="{self.word()} {name}"', f' class="{name}-{self.word()}"'])
        tag = tags.get(kind) if self.rng.random() < 0.6 else None
        if tag:
            return f"<{tag}{attr if self.rng.random() < 0.3 else ''}>{inner}</{tag}>"
        box = self.rng.choice(["div", "div", "section", "ul" if "<li>" in inner else "div"])
        return f"<{box}{attr}>{inner}</{box}>"

    def other(self, kind: str) -> str:
        r, said = self.rng, SAID[kind]
        item = lambda n: OTHER + self.words(r.randrange(1, n), said)
        if kind in ("menu", "share") or (kind in ("footer", "sidebar", "header") and r.random() < 0.4):
            items = "".join(f'<li><a href="/{self.word()}">{item(4)}</a></li>' for _ in range(r.randrange(2, 9)))
            if r.random() < 0.2:
                return self.part(kind, OTHER + " ".join(f'<a href="/">{self.words(1)}</a>' for _ in range(4)))
            return self.part(kind, f"<ul>{items}</ul>" if r.random() < 0.7 else items.replace("li>", "div>"))
        if kind == "form":
            return self.part(kind, f"<label>{item(4)}</label><input name=q><button>{item(3)}</button>" + (f"<p>{OTHER}{self.prose(said)}</p>" if r.random() < 0.3 else ""))
        if kind == "comments":
            return self.part(kind, f"<h3>{item(3)}</h3>" + "".join(
                f"<{b}{a}><p>{OTHER}{self.prose(said)}</p></{b}>" for b, a in r.choices([("div", ' class="comment"'), ("li", ""), ("article", ' class="comment"')], k=r.randrange(1, 6))))
        if kind == "header" and r.random() < 0.6:
            return self.part(kind, f"<h1>{item(5)}</h1>" if r.random() < 0.5 else f"<div>{item(6)}</div>")
        if r.random() < 0.4:  # nothing in the words tells the part
            said = []
            lead = r.choice(["", "&copy; ", ""]) + f"{self.word()}.example.{r.choice(['com', 'org', 'net'])} &middot; " if kind == "footer" else ""
            return self.part(kind, OTHER + lead + self.sentence(r.randrange(3, 20)))
        text = OTHER + (self.prose(said) if r.random() < 0.6 else self.sentence(r.randrange(2, 14), said))
        return self.part(kind, text if r.random() < 0.5 else f"<p>{text}</p>" + (f"<p>{OTHER}{self.sentence(5, said)}</p>" if r.random() < 0.3 else ""))

    def article(self) -> str:
        r, out = self.rng, []
        if r.random() < 0.8:
            out.append(f"<h1>{MAIN}{self.words(r.randrange(1, 12))}</h1>")
        for _ in range(r.choice([1, 2, 3, 5, 8, 14, 25])):
            kind = r.random()
            text = MAIN + self.prose()
            if kind < 0.75:
                out.append(r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>"]).format(text))
            elif kind < 0.83:
                out.append(f"<h{r.choice('23')}>{MAIN}{self.words(r.randrange(1, 7))}</h{r.choice('23')}>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{MAIN}{self.sentence(r.randrange(2, 12))}</li>" for _ in range(r.randrange(2, 6))) + "</ul>")
            elif kind < 0.94:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.97:
                out.append(f"<div>{text}</div>")
            else:
                out.append("<table>" + "".join(f"<tr><td>{MAIN}{self.words(2)}</td><td>{MAIN}{self.words(3)}</td></tr>" for _ in range(3)) + "</table>")
            if r.random() < 0.06:
                out.append(self.other(r.choice(["advert", "share", "notice", "sidebar", "form"])))
        body = "".join(out)
        if r.random() < 0.1:
            return f"<main>{body}</main>" if r.random() < 0.5 else body
        inner = self.part("article", body)
        return f"<main>{inner}</main>" if r.random() < 0.3 else inner

    def page(self) -> str:
        r = self.rng
        before = [k for k in ("notice", "header", "menu", "advert", "form", "sidebar") if r.random() < 0.5]
        after = [k for k in ("share", "comments", "sidebar", "advert", "form", "notice", "footer") if r.random() < 0.5]
        r.shuffle(before)
        parts = [*map(self.other, before), self.article() if r.random() < 0.95 else "", *map(self.other, after)]
        if r.random() < 0.3:
            parts.insert(r.randrange(len(parts) + 1), f"<script>var x=\"</p>{self.word()}\";</script><!-- {self.word()} -->")
        body = "".join(parts)
        if r.random() < 0.3:
            body = f'<div class="{r.choice(["page", "wrapper", "container", "site", self.word()])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(4)}</title><style>p{{margin:0}}</style></head><body>{body}" + r.choice(["</body></html>", ""])


def labelled(seed: int, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    writer, features, out = Writer(seed), Features(), []
    for _ in range(n):
        blocks = blocks_of(writer.page())
        kept = [(text.replace(MAIN, "").replace(OTHER, "").strip() or "-", path, links) for text, path, links in blocks]
        x = features.page(kept)
        if writer.rng.random() < 0.3:  # some pages without words, so that paths are learned for themselves
            x[:, PATH_DIM:PATH_DIM + WORD_DIM] = 0
        out.append((x, np.array([MAIN in b[0] for b in blocks], np.float32)))
    return [x for x in out if len(x[1])]


def gradients(model: BlockLabeller, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean logistic loss over blocks and its gradient, back through time."""
    w = model.w
    sides = {s: model.states(x, mask, s) for s in "fb"}
    both = np.concatenate([np.stack([s[0] for s in sides[k]], 1) for k in "fb"], 2)
    z = both @ w["out"] + w["bias"]
    n = mask.sum()
    loss = float((mask * (np.logaddexp(0, z) - y * z)).sum() / n)
    dz = mask * (1 / (1 + np.exp(-z)) - y) / n
    grads = {"out": np.einsum("pt,pth->h", dz, both), "bias": dz.sum(keepdims=True)[0]}
    for k, side in enumerate("fb"):
        given = dz[:, :, None] * w["out"][k * HIDDEN:(k + 1) * HIDDEN]
        dx, dh_w = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32), np.zeros_like(w[f"h{side}"])
        dh, dc = (np.zeros((len(x), HIDDEN), np.float32) for _ in range(2))
        for t in range(x.shape[1] - 1, -1, -1) if side == "f" else range(x.shape[1]):
            _, c, i, f, o, g, before, was = sides[side][t]
            m, tanh = mask[:, t, None], np.tanh(c)
            dh = dh + given[:, t]
            own = m * dh
            dcell = m * dc + own * o * (1 - tanh**2)
            d = np.concatenate([dcell * g * i * (1 - i), dcell * before * f * (1 - f), own * tanh * o * (1 - o), dcell * i * (1 - g**2)], 1)
            dx[:, t] = d
            dh_w += was.T @ d
            dh = d @ w[f"h{side}"].T + (1 - m) * dh
            dc = dcell * f + (1 - m) * dc
        grads |= {f"x{side}": np.einsum("pti,pth->ih", x, dx, optimize=True), f"h{side}": dh_w, f"b{side}": dx.sum((0, 1))}
    return loss, grads


def train(pages: int = 7000, epochs: int = 8, batch: int = 64, rate: float = 0.006, seed: int = 7) -> BlockLabeller:
    model, data, rng = BlockLabeller.fresh(), labelled(seed, pages), np.random.default_rng(seed)
    first, second, step = ({k: np.zeros_like(v) for k, v in model.w.items()} for _ in range(2)), None, 0
    first, second = first
    for epoch in range(epochs):
        order = sorted(rng.permutation(len(data)), key=lambda i: len(data[i][1]))
        starts = rng.permutation(range(0, len(order), batch))
        total = 0.0
        for at in starts:
            some = [data[i] for i in order[at:at + batch]]
            longest = max(len(y) for _, y in some)
            x, mask = padded([a for a, _ in some], longest)
            y = np.zeros(mask.shape, np.float32)
            for row, (_, labels) in enumerate(some):
                y[row, :len(labels)] = labels
            loss, grads = gradients(model, x, mask, y)
            total, step = total + loss, step + 1
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model.w[k] = (model.w[k] - rate * (1 - epoch / epochs) * move).astype(np.float32)
        print(f"epoch {epoch}: loss {total / len(starts):.4f}", flush=True)
    return model


def accuracy(model: BlockLabeller, seed: int = 99, pages: int = 1000) -> float:
    data = labelled(seed, pages)
    found = model.label([x for x, _ in data])
    return sum(int((f == (y > 0)).sum()) for f, (_, y) in zip(found, data, strict=True)) / sum(len(y) for _, y in data)


if __name__ == "__main__":
    began = time.time()
    trained = train()
    print(f"held-out accuracy of blocks {accuracy(trained):.4f}, {time.time() - began:.0f} s")
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in trained.w.items()})

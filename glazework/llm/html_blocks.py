"""Main text of web pages by a recurrent block labeller (operator 5).

A page is cut into leaf blocks. Each block becomes a vector: its path of elements (names, and
class, id and role words, hashed), its words (hashed) and a few sizes. A
bidirectional LSTM in numpy reads the blocks of a page in both directions, so each is
labelled in the context of the whole document; the blocks labelled 1 are the main
text, joined by blank lines.

The network is trained on made-up pages (``TRAIN_PAGES`` of them, the documented bound) on the
driver, from a fixed seed, and sent to the tasks: some 100 kB, whatever the input.

Defined results: null, empty and markup-only pages give the empty text; a page cut off inside a
tag, comment or reference is read up to there; repeated rows each get a row; an empty
table gives no rows. Extra columns are carried if named.

Scale: one pass, no shuffle. Pages of like length are labelled together, at most
``STEP_BLOCKS`` blocks at a time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_pages import Block, leaf_blocks
from .html_train import made_up_page, word_pool

PATH_DIMS, LAST_DIMS, WORD_DIMS, SIZES = 512, 512, 32, 5
DIMS = PATH_DIMS + LAST_DIMS + WORD_DIMS + SIZES
HIDDEN = 24
#: Salt of the hashed names, chosen so that few containers of the made-up pages share a place.
SALT = 1315
TRAIN_PAGES = 1600
EPOCHS = 4
BATCH_PAGES = 32
RATE = 0.01
SEED = 20240229
STEP_BLOCKS = 16_384


@lru_cache(maxsize=100_000)
def path_slots(path: tuple[tuple[str, ...], ...]) -> tuple[int, ...]:
    """Vector places of a path: every element by name and by class words, the last two also by themselves."""
    slots = set()
    for depth, element in enumerate(reversed(path)):
        for i, word in enumerate(element):
            key = f"{SALT}{'w' if i else 'e'}:{word}".encode()
            slots.add(zlib.crc32(key) % PATH_DIMS)
            if depth < 2:
                slots.add(PATH_DIMS + zlib.crc32(key, depth + 1) % LAST_DIMS)
    return tuple(sorted(slots))


def _dense_part(block: Block) -> np.ndarray:
    words = block.text.lower().split()
    n, chars = len(words), len(block.text)
    hashed = np.bincount([zlib.crc32(w.encode()) % WORD_DIMS for w in words], minlength=WORD_DIMS)
    sizes = (
        min(math.log1p(n) / 5, 2.0), min(math.log1p(chars) / 7, 2.0), min(chars / n / 10, 2.0),
        min(sum(map(block.text.count, ".,;:")) / n, 2.0), float(block.text[-1] in ".!?"),
    )
    return np.concatenate([hashed / math.sqrt(float(hashed @ hashed)), sizes]).astype(np.float32)


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(blocks), DIMS), np.float32)
    for row, block in zip(out, blocks):
        row[list(path_slots(block.path))] = 1.0
        row[PATH_DIMS + LAST_DIMS :] = _dense_part(block)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Labeller:
    """Bidirectional LSTM over block vectors and a logistic output."""

    def __init__(self, rng: np.random.Generator) -> None:
        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

        self.p = {}
        for d in "fb":
            self.p[f"{d}x"] = start(DIMS, 4 * HIDDEN)
            self.p[f"{d}h"] = start(HIDDEN, 4 * HIDDEN)
            self.p[f"{d}c"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"{d}c"][HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
        self.p["o"] = start(2 * HIDDEN + DIMS)
        self.p["oc"] = np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (pages, steps, HIDDEN) of one direction, and what the gradient needs."""
        pages, steps, _ = x.shape
        pre = x @ self.p[f"{d}x"] + self.p[f"{d}c"]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        states, kept = np.zeros((pages, steps, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + h @ self.p[f"{d}h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new = f * c + i * g
            kept.append((t, h, c, i, f, o, g, np.tanh(new)))
            h, c = m * (o * np.tanh(new)) + (1 - m) * h, m * new + (1 - m) * c
            states[:, t] = h
        return states, kept

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Probability of main text for every block."""
        fs, fk = self._pass(x, mask, "f")
        bs, bk = self._pass(x, mask, "b")
        joined = np.concatenate([fs, bs, x], axis=2)
        return _sigmoid(joined @ self.p["o"] + self.p["oc"]), (joined, fk, bk)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        prob, (joined, fk, bk) = self.forward(x, mask)
        n = mask.sum()
        loss = -(mask * (y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))).sum() / n
        delta = mask * (prob - y) / n
        grad = {"o": np.einsum("pt,ptk->k", delta, joined), "oc": np.array([delta.sum()], np.float32)}
        for d, kept, at in (("f", fk, 0), ("b", bk, HIDDEN)):
            out = delta[:, :, None] * self.p["o"][at : at + HIDDEN]
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            gh = np.zeros_like(self.p[f"{d}h"])
            for t, h0, c0, i, f, o, g, tc in reversed(kept):
                m = mask[:, t, None]
                total = dh + out[:, t]
                into = m * total
                dcell = m * dc + into * o * (1 - tc * tc)
                dz = np.concatenate(
                    [dcell * g * i * (1 - i), dcell * c0 * f * (1 - f), into * tc * o * (1 - o), dcell * i * (1 - g * g)],
                    axis=1,
                )
                dz_all[:, t] = dz
                gh += h0.T @ dz
                dh = dz @ self.p[f"{d}h"].T + (1 - m) * total
                dc = dcell * f + (1 - m) * dc
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grad |= {f"{d}x": x.reshape(-1, DIMS).T @ flat, f"{d}h": gh, f"{d}c": flat.sum(axis=0)}
        return grad, float(loss)

    def label(self, pages: list[list[Block]]) -> list[list[bool]]:
        """Whether each block of each page is main text."""
        result: list[list[bool]] = [[] for _ in pages]
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            last = at + 1  # pages of like length, padded to the longest
            while last < len(order) and (last + 1 - at) * len(pages[order[last]]) <= STEP_BLOCKS:
                last += 1
            group = order[at:last]
            x, mask = padded([vectors(pages[i]) for i in group])
            prob, _ = self.forward(x, mask)
            for i, row in zip(group, prob):
                result[i] = (row[: len(pages[i])] >= 0.5).tolist()
            at = last
        return result


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(pages, steps, DIMS) and the mask of real blocks."""
    steps = max(map(len, rows))
    x = np.zeros((len(rows), steps, DIMS), np.float32)
    mask = np.zeros((len(rows), steps), np.float32)
    for i, r in enumerate(rows):
        x[i, : len(r)] = r
        mask[i, : len(r)] = 1.0
    return x, mask


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """A labeller fitted to ``pages`` made-up pages with Adam."""
    rng = np.random.default_rng(seed)
    pool = word_pool(rng)
    made = [made_up_page(rng, pool) for _ in range(pages)]
    made.sort(key=len)  # batches of like length
    data = []
    for k in range(0, len(made), BATCH_PAGES):
        part = made[k : k + BATCH_PAGES]
        x, mask = padded([vectors([b for b, _ in page]) for page in part])
        y = np.zeros_like(mask)
        for row, page in zip(y, part):
            row[: len(page)] = [label for _, label in page]
        data.append((x, mask, y))
    model = Labeller(rng)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(data)):
            grad, _ = model.gradients(*data[k])
            step += 1
            for name, g in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                move = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                model.p[name] -= (RATE * 0.5**epoch * move).astype(np.float32)
    return model


def main_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    """The main text of each page."""
    blocks = [leaf_blocks(p) for p in pages]
    return [
        "\n\n".join(b.text for b, keep in zip(page, labels) if keep)
        for page, labels in zip(blocks, model.label(blocks))
    ]


def _extract_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Labeller = shared.value
        for batch in batches:
            carried = batch.num_columns - 1
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = main_texts(model, [v.as_py() for v in part.column(carried)])
                arrays = [
                    *(part.column(i) for i in range(carried)),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "text", "n_chars"])

    return run


def extract_main_text(
    pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), model: Labeller | None = None
) -> DataFrame:
    """(carried columns, text, n_chars) of every page."""
    carry = [c for c in keep if c not in ("text", "n_chars")]
    plain = pages.select(*carry, F.col(html_col).alias("_html"))
    shared = pages.sparkSession.sparkContext.broadcast(model or train())
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in plain.schema.fields[:-1])
    return plain.mapInArrow(_extract_batches(shared), f"{schema}text string, n_chars bigint")

"""Main text of pages by a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks as row_blocks
from .common import free
from .html_blocks import Block, leaf_blocks
from .html_labelled import labelled_pages

#: Labelled pages that the field is trained on, passes over them, and step.
PAGES, PASSES, STEP = 800, 16, 0.3


def text_features(block: Block) -> list[str]:
    """What a block's own text tells, independent of its language."""
    text = block.text
    size = len(text)
    words = text.count(" ") + 1
    share = block.linked / size
    return [
        "bias",
        f"tag={block.tag}",
        f"words={min(6, words.bit_length())}",
        f"links={'all' if share > 0.9 else 'many' if share > 0.4 else 'some' if share > 0 else 'no'}",
        f"end={'stop' if text[-1] in '.!?。…:' else 'word'}",
        f"long={size > 80 and share < 0.3}",
        *(["copyright"] if "©" in text or "copyright" in text.lower()[:200] else ()),
    ]


@dataclass
class Field:
    """Weights for "is main text": of features, and of pairs of successive labels."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def known(self) -> frozenset[str]:
        return frozenset(name for name in self.weights if name[0] in "<.")

    def score(self, block: Block) -> float:
        get = self.weights.get
        return sum(get(name, 0.0) for name in text_features(block)) + sum(get(name, 0.0) for name in block.around)

    def decode(self, scores: list[float]) -> list[bool]:
        """The most probable labels (Viterbi); of equal ones the one without text."""
        if not scores:
            return []
        p = self.pairs
        best = (0.0, scores[0])
        back: list[tuple[int, int]] = []
        for s in scores[1:]:
            no = 0 if best[0] + p[0][0] >= best[1] + p[1][0] else 1
            yes = 0 if best[0] + p[0][1] >= best[1] + p[1][1] else 1
            back.append((no, yes))
            best = (best[no] + p[no][0], best[yes] + p[yes][1] + s)
        label = int(best[1] > best[0])
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return [bool(x) for x in reversed(out)]


def _log_sum(a: float, b: float) -> float:
    m = max(a, b)
    return m + math.log1p(math.exp(min(a, b) - m))


def train_field(pages: Iterable[tuple[list[Block], list[int]]], passes: int = PASSES, step: float = STEP) -> Field:
    """Maximum likelihood by stochastic gradient with a step per weight that shrinks as it is used."""
    data = [([[*text_features(b), *b.around] for b in bs], labels) for bs, labels in pages if bs]
    crf = Field({name: 0.0 for names, _ in data for x in names for name in x})
    used = dict.fromkeys(crf.weights, 1e-3)
    used_pairs = [[1e-3, 1e-3], [1e-3, 1e-3]]
    order = random.Random(5)
    for _ in range(passes):
        order.shuffle(data)
        for names, labels in data:
            n, p = len(names), crf.pairs
            scores = [sum(crf.weights[x] for x in block) for block in names]
            ahead = [(0.0, scores[0])]
            for s in scores[1:]:
                a, b = ahead[-1]
                ahead.append((_log_sum(a + p[0][0], b + p[1][0]), _log_sum(a + p[0][1], b + p[1][1]) + s))
            behind = [(0.0, 0.0)]
            for s in reversed(scores[1:]):
                a, b = behind[-1]
                behind.append((_log_sum(p[0][0] + a, p[0][1] + s + b), _log_sum(p[1][0] + a, p[1][1] + s + b)))
            behind.reverse()
            whole = _log_sum(*ahead[-1])
            slope: dict[str, float] = {}
            for block, label, f, b in zip(names, labels, ahead, behind, strict=True):
                miss = label - math.exp(f[1] + b[1] - whole)
                for x in block:
                    slope[x] = slope.get(x, 0.0) + miss
            for x, g in slope.items():
                g -= 1e-3 * crf.weights[x]
                used[x] += g * g
                crf.weights[x] += step * g / math.sqrt(used[x])
            for i in range(2):
                for j in range(2):
                    g = sum(labels[k] == i and labels[k + 1] == j for k in range(n - 1)) - sum(
                        math.exp(ahead[k][i] + p[i][j] + j * scores[k + 1] + behind[k + 1][j] - whole) for k in range(n - 1)
                    )
                    used_pairs[i][j] += g * g
                    crf.pairs[i][j] += step * g / math.sqrt(used_pairs[i][j])
    return crf


def default_field(n: int = PAGES, seed: int = 3) -> Field:
    """A field trained on ``n`` labelled pages."""
    return train_field((labelled(page, texts) for page, texts in labelled_pages(n, seed)))


def labelled(page: str, texts: frozenset[str]) -> tuple[list[Block], list[int]]:
    found = leaf_blocks(page)
    return found, [int(block.text in texts) for block in found]


def main_text(page: str, crf: Field, known: frozenset[str]) -> str:
    found = leaf_blocks(page, known)
    keep = crf.decode([crf.score(block) for block in found])
    return "\n".join(block.text for block, yes in zip(found, keep, strict=True) if yes)


def extract_text(pages: DataFrame, crf: Field | None = None, column: str = "html") -> DataFrame:
    """``pages`` with the main ``text`` of each and its ``n_chars``, in place of ``column``.

    A page is cut into leaf blocks (the text between block tags, character
    references decoded, white space inside a block one blank, trimmed; scripts,
    styles, comments in markup and the like are no text). The field labels them
    and the blocks that are main text are joined by line feeds. A null, empty or
    wholly filtered page has an empty text; broken markup is read as far as it
    goes; repeated rows are alike; columns named ``text`` or ``n_chars`` are
    replaced; an empty table gives an empty one.
    """
    sent = pages.sparkSession.sparkContext.broadcast(crf or default_field())
    names = [name for name in pages.columns if name.lower() not in (column.lower(), "text", "n_chars")]
    (raw_html,) = free(names, "raw_html")
    schema = pages.select(*names).schema.add("text", "string").add("n_chars", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known = model.known()
        for batch in batches:
            for block in row_blocks(batch, raw_html):
                texts = [
                    main_text(raw.decode("utf-8", "replace"), model, known) if raw else ""
                    for raw in block.column(raw_html).to_pylist()
                ]
                columns = [block.column(name) for name in names]
                sizes = pa.array([len(text) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string()), sizes], names=[*names, "text", "n_chars"]
                )

    return pages.select(*names, F.col(column).cast("binary").alias(raw_html)).mapInArrow(work, schema)

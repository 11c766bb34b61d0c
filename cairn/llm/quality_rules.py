"""Quality rules: exact counts of each text, and a linear-chain conditional random field over its lines."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import parts

#: Labelled documents of each label at most from which the field is trained.
SAMPLE = 1_500
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
OTHER, LOWER, UPPER, DIGIT, SPACE, SYMBOL, SHOUT, STOP = range(8)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _classes() -> np.ndarray:
    out = np.full(0x110000, LOWER, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        kind = unicodedata.category(c)
        out[i] = SPACE if i == 0x20 or 9 <= i <= 0xD else SYMBOL if c in SYMBOLS else SHOUT if c == "!" else STOP if c in ".?:;" else UPPER if kind == "Lu" else DIGIT if kind == "Nd" else LOWER if kind[0] == "L" else OTHER
    return out


CLASS = _classes()
#: Of a line: word-count bins, capitals, symbols, exclamation marks, digits, word lengths, end, repeats, place.
FEATURES = 22


def repeated_words(words: list[str]) -> int:
    """Words in windows of three that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * np.int64(len(known)) + ids[2:], return_inverse=True, return_counts=True)
    many = np.flatnonzero(times[which] > 1)
    marked = np.zeros(n, bool)
    for i in range(3):
        marked[many + i] = True
    return int(marked.sum())


def measure(texts: list[str | None]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each text; then for all lines with a word, in order: features, number of words, number of the text."""
    texts = [t or "" for t in texts]
    joined = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = CLASS[joined]
    ends = np.flatnonzero(joined == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = np.array([t.count("\n") + 1 for t in texts])
    text_of = np.repeat(np.arange(len(texts)), size)
    word = kind != SPACE
    first = word.copy()
    first[1:] &= ~word[:-1]
    total = lambda flags: np.add.reduceat(flags, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    by = {k: total(kind == k) for k in (LOWER, UPPER, DIGIT, SYMBOL, SHOUT)}
    n_words, chars = total(first), total(word)
    lines = [x for t in texts for x in t.split("\n")]
    repeat = np.zeros(len(lines), bool)
    at = 0
    for n in size:
        seen: set[str] = set()
        for i in range(at, at + n):
            if n_words[i]:
                if lines[i] in seen:
                    repeat[i] = True
                seen.add(lines[i])
        at += n
    per_text = lambda x: np.bincount(text_of, x, len(texts)).astype(np.int64)
    counts = {"n_words": per_text(n_words), "word_chars": per_text(chars), "n_symbols": per_text(by[SYMBOL]), "n_dup_lines": per_text(repeat), "n_repeat_words": np.array([repeated_words(WORDS.findall(t)) for t in texts], np.int64)}
    keep = np.flatnonzero(n_words)
    w, c, r, own = n_words[keep], chars[keep], repeat[keep], text_of[keep]
    letters = np.maximum(1, by[LOWER][keep] + by[UPPER][keep])
    last = kind[np.maximum(ends[keep] - 1, 0)]
    edge = np.ones(len(own) + 1, bool)
    edge[1:-1] = own[1:] != own[:-1]
    up, sym, shout, dig, long_ = by[UPPER][keep] / letters, by[SYMBOL][keep] / w, by[SHOUT][keep] / w, by[DIGIT][keep] / c, c / w
    x = np.stack([np.ones(len(w)), w == 1, (w > 1) & (w < 5), (w >= 5) & (w < 10), (w >= 10) & (w < 25), w >= 25, up > 0.5, (up > 0.15) & (up <= 0.5), sym > 0, sym > 0.05, sym > 0.3, sym > 0.8, shout > 0, shout > 0.3, dig > 0.05, dig > 0.3, long_ < 3, long_ > 9, (last == STOP) | (last == SHOUT), r, edge[:-1], edge[1:]], 1).astype(float)
    return counts, x, w, own


@dataclass
class Field:
    """Labels 0 (content) and 1 (boilerplate): weights of the features for label 1, and of neighbouring labels."""

    emit: np.ndarray
    step: np.ndarray
    least_share: float = 0.5

    def decode(self, x: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
        """Viterbi's most likely labels of all lines, all texts side by side."""
        score = np.stack([np.zeros(len(x)), x @ self.emit], 1)
        size = np.bincount(own, minlength=n)
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        order = np.argsort(-size, kind="stable")
        size, start = size[order], start[order]
        back = np.zeros((len(x), 2), np.int8)
        labels = np.zeros(len(x), np.int8)
        best = np.zeros((n, 2))
        most = int(size.max(initial=0))
        for t in range(most):
            k = int(np.searchsorted(-size, -t, "left"))  # texts with more than t lines
            rows = start[:k] + t
            if t == 0:
                best[:k] = score[rows]
                continue
            ways = best[:k, :, None] + self.step[None]
            back[rows] = ways.argmax(1)
            best[:k] = ways.max(1) + score[rows]
        now = best.argmax(1).astype(np.int8)
        for t in range(most - 1, -1, -1):
            k = int(np.searchsorted(-size, -t, "left"))
            rows = start[:k] + t
            labels[rows] = now[:k]
            now[:k] = back[rows, now[:k]] if t else now[:k]
        return labels

    def share(self, labels: np.ndarray, words: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
        """The share of each text's words in content lines; 0 without a word."""
        return np.bincount(own, words * (labels == 0), n) / np.maximum(1, np.bincount(own, words, n))


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def likelihood(xs: np.ndarray, mask: np.ndarray, ys: np.ndarray, emit: np.ndarray, step: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of the labels ``ys`` of the lines in ``mask`` (a text a row), and its gradients by ``emit``
    and ``step``, by the forward-backward sums."""
    n, t_max = mask.shape
    s = np.stack([np.zeros((n, t_max)), xs @ emit], 2)
    ahead, behind = np.zeros((n, t_max, 2)), np.zeros((n, t_max, 2))
    ahead[:, 0] = s[:, 0]
    for t in range(1, t_max):
        z = np.logaddexp(ahead[:, t - 1, 0, None] + step[0], ahead[:, t - 1, 1, None] + step[1]) + s[:, t]
        ahead[:, t] = np.where(mask[:, t, None], z, ahead[:, t - 1])
    whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    for t in range(t_max - 2, -1, -1):
        z = s[:, t + 1] + behind[:, t + 1]
        z = np.logaddexp(step[:, 0] + z[:, 0, None], step[:, 1] + z[:, 1, None])
        behind[:, t] = np.where(mask[:, t + 1, None], z, 0.0)
    one = np.exp(ahead[..., 1] + behind[..., 1] - whole[:, None]) * mask
    grad_emit = ((ys * mask - one)[..., None] * xs).sum((0, 1))
    both = mask[:, 1:]
    grad_step = np.zeros((2, 2))
    for a in range(2):
        for b in range(2):
            seen = ((ys[:, :-1] == a) & (ys[:, 1:] == b) & both).sum()
            p = np.exp(ahead[:, :-1, a] + step[a, b] + s[:, 1:, b] + behind[:, 1:, b] - whole[:, None]) * both
            grad_step[a, b] = seen - p.sum()
    own = (np.where(ys == 1, s[..., 1], 0.0) * mask).sum() + (step[ys[:, :-1], ys[:, 1:]] * both).sum()
    return float(own - whole.sum()), grad_emit, grad_step


def fit(texts: list[str], good: np.ndarray, longest: int = 100, steps: int = 80, loss: float = 0.005) -> Field:
    """Maximum likelihood of the lines' labels, each line labelled as its document; long texts are cut in pieces of
    ``longest`` lines. ``least_share`` drops as many bad texts as it can while losing ``loss`` of the good ones
    that pass the base rules and hold content at all; it is positive."""
    counts, x, words, own = measure(texts)
    bad = ~good.astype(bool)
    y = bad[own].astype(int)
    piece = np.concatenate([[0], np.cumsum((own[1:] != own[:-1]))]) if len(own) else np.zeros(0, int)
    place = np.arange(len(own)) - np.searchsorted(own, own)
    seq = np.unique(piece * 100_000 + place // longest, return_inverse=True)[1]
    place %= longest
    n, t_max = (int(seq.max()) + 1, int(place.max()) + 1) if len(seq) else (0, 0)
    xs, mask, ys = np.zeros((n, t_max, FEATURES)), np.zeros((n, t_max), bool), np.zeros((n, t_max), int)
    xs[seq, place], mask[seq, place], ys[seq, place] = x, True, y
    emit, step = np.zeros(FEATURES), np.zeros((2, 2))
    m, v = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    for it in range(1, steps + 1 if n else 1):
        _, grad_emit, grad_step = likelihood(xs, mask, ys, emit, step)
        g = np.concatenate([grad_emit, grad_step.ravel()]) / max(1, n) - 1e-3 * np.concatenate([emit, step.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.1 * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.999**it)) + 1e-8)
        emit, step = emit + d[:FEATURES], step + d[FEATURES:].reshape(2, 2)
    field = Field(emit, step)
    share = np.sort(field.share(field.decode(x, own, len(texts)), words, own, len(texts))[good.astype(bool) & ~base_failed(counts)])
    share = share[share > 0]
    field.least_share = float(min(0.5, share[int(loss * len(share))])) if len(share) else 0.5
    return field


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """From at most SAMPLE labelled documents of each label, those of the least hash of the id; rows without an id,
    label or word are left out. With no such rows of either label the field keeps every text."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    part = lambda test: known.where(test).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    chosen = part("y > 0").union(part("y <= 0"))
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y")).orderBy("doc_id").collect()
    good = np.array([r.y > 0 for r in rows], bool)
    if not len(good) or good.all():
        return Field(np.zeros(FEATURES), np.zeros((2, 2)), 0.0)
    return fit([r.text for r in rows], good)


def judge(df: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``df`` with the counts (COUNTS), ``base_failed``, ``content_share`` and ``kept``.

    Words are runs without space, tab, line feed, vertical tab, form feed and return. A null text has no words and
    fails the base rules. Columns of these names are replaced; rows, repeated ones too, are judged one by one.
    """
    df = df.drop(*COUNTS, "base_failed", "content_share", "kept")
    shared = df.sparkSession.sparkContext.broadcast(field)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for b in parts(batches, 200, column=text_col):
            counts, x, words, own = measure(b.column(text_col).to_pylist())
            share = f.share(f.decode(x, own, b.num_rows), words, own, b.num_rows)
            failed = base_failed(counts)
            made = [*(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(share), pa.array(~failed & (share >= f.least_share))]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, *COUNTS, "base_failed", "content_share", "kept"])

    more = [*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()), T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return df.mapInArrow(judged, T.StructType([*df.schema.fields, *more]))

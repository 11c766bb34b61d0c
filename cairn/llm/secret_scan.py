"""Secrets: base patterns, and a character convolutional network over every other candidate with its context."""

from __future__ import annotations

import base64
import hashlib
import re
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import cut, parts, tidy

#: Labelled findings of each label, at most.
SAMPLE = 3_000
KINDS = ("assign", "access", "hex", "network")
# fixed values: the base patterns
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Every run of such characters is a candidate, less the base findings in it. The last two base kinds lie within runs.
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
SHORTEST = 16
BEFORE, INSIDE, AFTER, WIDTH, FILTERS = 24, 64, 12, 5, 24
ALPHABET = {c: i + 3 for i, c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n\t=:\"'+/_.-,;<>()[]{}@#$%&*|!?\\~^`")}
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))


def base_findings(text: str, runs: list[tuple[int, int]]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the base patterns' matches, leftmost first within each kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        out += [(kind, m.start(), m.end(), m.start()) for a, b in runs for m in pattern.finditer(text, a, b) if m.end() - m.start() >= LEAST[kind]]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def look(text: str) -> tuple[list[tuple[str, int, int, int]], list[tuple[int, int]]]:
    """The base findings, and the candidates: what they leave of each run, in parts of SHORTEST or more."""
    runs = [m.span() for m in RUN.finditer(text)]
    base = base_findings(text, runs)
    rest = []
    for a, b in runs:
        for _, x, y, _ in base:
            if a < y and x < b:
                rest.append((a, x))
                a = y
        rest.append((a, b))
    return base, [(a, b) for a, b in rest if b - a >= SHORTEST]


def windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """A candidate with its context; one longer than INSIDE in windows that cover it and overlap by half."""
    starts = [*range(start, end - INSIDE, INSIDE // 2), max(start, end - INSIDE)]
    return [(text[max(0, a - BEFORE) : a], text[a : min(end, a + INSIDE)], text[min(end, a + INSIDE) : min(end, a + INSIDE) + AFTER]) for a in starts]


def codes(windows: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Character numbers (0 pads, 1 is any other letter, 2 any other character) and which places are inside."""
    size = BEFORE + INSIDE + AFTER
    x, inside = np.zeros((len(windows), size), np.int64), np.zeros((len(windows), size), bool)
    for i, (a, b, c) in enumerate(windows):
        at = BEFORE - len(a)
        for ch in a + b + c:
            x[i, at] = ALPHABET.get(ch) or (1 if ch.isalpha() else 2)
            at += 1
        inside[i, BEFORE : BEFORE + len(b)] = True
    return x, inside


_CLASS = {c: k for k, some in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")) for c in some}
#: Changes of the kind of character, a character, from which a candidate without a label may well be a secret.
RESTLESS = 0.3


def restless(candidate: str) -> bool:
    """Whether a candidate has digits and goes from small letters to capitals to digits and back as random text does, signs left
    out: words, paths and addresses do so at their joints only. What no base pattern vouches for isn't shown as harmless then."""
    kinds = [_CLASS[c] for c in candidate if c in _CLASS]
    return 2 in kinds and sum(a != b for a, b in zip(kinds, kinds[1:])) >= RESTLESS * len(candidate)


def recoded(value: str) -> str:
    """A base finding's value as secrets look that no base pattern names: in base64, as a key with a prefix, as a signed token of three parts, or
    in capitals. Which, and what it holds, follows from the value alone."""
    seed = hashlib.blake2b(value.encode(), digest_size=64).digest()
    plain = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    mixed = "".join(letters[b % 62] for b in seed)
    match seed[0] % 5:
        case 0:
            return base64.b64encode(seed[1 : 19 + seed[1] % 24]).decode()
        case 1:
            return plain(seed[1 : 19 + seed[1] % 24])
        case 2:
            return mixed[2 : 22 + seed[1] % 24]
        case 3:
            return "".join("abcdefghijklmnopqrstuvwxyz"[b % 26] for b in seed[1 : 3 + seed[1] % 3]) + "_" + mixed[8 : 32 + seed[2] % 16]
        case _:
            return ".".join((plain(b'{"alg":"%s"}' % mixed[:5].encode()), plain(b'{"sub":"%s"}' % mixed[5 : 13 + seed[1] % 8].encode()), plain(seed[16:48])))


@dataclass
class Network:
    """Convolution over characters, the largest response inside and outside the candidate, one dense layer."""

    conv: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    scale: tuple[float, float] = (0.0, 1.0)
    threshold: float = 0.5

    def pooled(self, x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        n = x.shape[1]
        h = self.bias + sum(self.conv[k][padded[:, k : k + n]] for k in range(WIDTH))
        both = np.stack([np.where(inside[:, :, None], h, -1e9), np.where(inside[:, :, None], -1e9, h)], 1)
        at = both.argmax(2)
        return np.maximum(np.take_along_axis(both, at[:, :, None], 2)[:, :, 0], 0.0), at

    def raw(self, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
        p, _ = self.pooled(x, inside)
        return p.reshape(len(x), -1) @ self.dense[:-1] + self.dense[-1]

    def scores(self, windows: list[tuple[str, str, str]]) -> np.ndarray:
        out = [np.zeros(0)]
        for lo in range(0, len(windows), 256):
            z = self.scale[0] + self.scale[1] * self.raw(*codes(windows[lo : lo + 256]))
            out.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
        return np.concatenate(out)


def fresh(g: np.random.Generator) -> Network:
    """A network of small random weights."""
    return Network(g.normal(0, 0.1, (WIDTH, len(ALPHABET) + 3, FILTERS)), np.zeros(FILTERS), np.concatenate([g.normal(0, 0.1, 2 * FILTERS), [0.0]]))


class Steps:
    """Adam's steps on a network's parameters, in place."""

    def __init__(self, net: Network):
        self.net, self.params, self.n = net, [net.conv, net.bias, net.dense], 0
        self.m, self.v = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params]

    def down(self, x: np.ndarray, inside: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float = 0.01) -> None:
        net = self.net
        p, at = net.pooled(x, inside)
        flat = p.reshape(len(x), -1)
        z = flat @ net.dense[:-1] + net.dense[-1]
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight / len(x)
        grads = [np.zeros_like(net.conv), np.zeros(FILTERS), np.concatenate([flat.T @ d, [d.sum()]]) + 1e-4 * net.dense]
        back = (d[:, None] * net.dense[:-1]).reshape(p.shape) * (p > 0)
        padded = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        grads[1] = back.sum((0, 1))
        filters = np.broadcast_to(np.arange(FILTERS), at.shape)
        for k in range(WIDTH):
            seen = padded[np.arange(len(x))[:, None, None], at + k].astype(np.intp)
            grads[0][k] = np.bincount((seen * FILTERS + filters).ravel(), back.ravel(), net.conv[k].size).reshape(net.conv[k].shape)
        self.n += 1
        for i, q in enumerate(self.params):
            self.m[i] = 0.9 * self.m[i] + 0.1 * grads[i]
            self.v[i] = 0.999 * self.v[i] + 0.001 * grads[i] ** 2
            q -= rate * (self.m[i] / (1 - 0.9**self.n)) / (np.sqrt(self.v[i] / (1 - 0.999**self.n)) + 1e-8)


def calibrate(net: Network, z: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float = 0.98, alarms: float = 0.001, balance: bool = False) -> None:
    """Scale and threshold from held-out raw scores ``z`` of label ``y``, each ``n`` times; ``balance``: the scale takes both labels for equally many."""
    a, b = 0.0, 1.0
    of = n * np.where(y == 1, n.sum() / (2 * max(n[y == 1].sum(), 1)), n.sum() / (2 * max(n[y == 0].sum(), 1))) if balance else n
    for _ in range(100):  # Platt's calibration, by Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -40, 40)))
        w, e = of * (p * (1 - p) + 1e-6), of * (y - p)
        h = np.array([[w.sum() + 0.1, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 0.1]])
        da, db = np.linalg.solve(h, [e.sum() - 0.1 * a, (e * z).sum() - 0.1 * (b - 1)])
        a, b = a + float(np.clip(da, -2, 2)), b + float(np.clip(db, -2, 2))
    net.scale = (a, b)
    p = 1 / (1 + np.exp(-np.clip(a + b * z, -40, 40)))

    def at(label: int, share: float) -> float | None:
        """The score with the number int(share * all) of the label's, in ascending order."""
        order = np.flatnonzero(y == label)[np.argsort(p[y == label], kind="stable")]
        ends = np.cumsum(n[order])
        return float(p[order[np.searchsorted(ends, min(int(share * ends[-1]), ends[-1] - 1), "right")]]) if len(order) else None

    # as low as few false alarms allow, since other secrets score less than those it learned from, but never so high that recall is lost
    net.threshold = max(0.5, at(0, 1 - alarms) or 0.5)
    least = at(1, 1 - recall)
    if least is not None:
        net.threshold = min(net.threshold, least)


def fit(windows: list[tuple[str, str, str]], y: np.ndarray, recall: float = 0.98, alarms: float = 0.001, epochs: int = 30, seed: int = 5) -> Network | None:
    """Train on four fifths of the findings; calibrate on the rest, and take a threshold that keeps ``recall`` there and, if that
    allows, lets a share of ``alarms`` of the other candidates pass at most.

    Half of the examples get the context of another one, so that the candidate itself has to tell. None without
    at least ten findings of each label.
    """
    if min(y.sum(), len(y) - y.sum()) < 10:
        return None
    g = np.random.default_rng(seed)
    order = g.permutation(len(y))
    test, teach = order[: len(y) // 5], order[len(y) // 5 :]
    net = fresh(g)
    step = Steps(net)
    for _ in range(epochs):
        g.shuffle(teach)
        for lo in range(0, len(teach), 128):
            rows = teach[lo : lo + 128]
            swap = [windows[g.choice(teach)] if g.random() < 0.5 else windows[i] for i in rows]
            x, inside = codes([(s[0], windows[i][1], s[2]) for i, s in zip(rows, swap, strict=True)])
            step.down(x, inside, y[rows], np.ones(len(rows)))
    z = net.raw(*codes([windows[i] for i in test]))
    calibrate(net, z, y[test], np.ones(len(test)), recall, alarms)
    return net


def labelled(text: str) -> Iterator[tuple[int, str, int, int]]:
    """(label, text, start, end) of the findings with a label: base findings 1, and so each of them recoded; other candidates 0, but for restless ones."""
    base, rest = look(text)
    yield from ((1, text, value, end) for _, _, end, value in base)
    for _, _, end, value in base:
        other = recoded(text[value:end])
        yield 1, text[max(0, value - BEFORE) : value] + other + text[end : end + AFTER], min(BEFORE, value), min(BEFORE, value) + len(other)
    yield from ((0, text, x, z) for x, z in rest if not restless(text[x:z]))


def train(docs: DataFrame, text_col: str = "text") -> Network | None:
    """Label findings of all documents: base findings 1, and so each of them recoded; other candidates 0, but for restless ones, which have no label.

    At most SAMPLE distinct values of each label, those of the least hash, leave a task and come to the driver. Warns
    if they are too few for a network.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[dict[tuple[int, str], tuple[str, str]]] = [{}, {}]
        bound = [1 << 64, 1 << 64]

        def shrink(y: int, size: int) -> None:
            if len(least[y]) > size:
                chosen = sorted(least[y])[:SAMPLE]
                least[y], bound[y] = {k: least[y][k] for k in chosen}, chosen[-1][0]

        for b in parts(batches, column=text_col):
            for t in b.column(text_col).to_pylist():
                for y, own, x, z in labelled(t):
                    for before, inside, after in windows(own, x, z):
                        h = int.from_bytes(hashlib.blake2b(inside.encode(), digest_size=7).digest())
                        if h <= bound[y]:
                            old = least[y].get((h, inside), (before, after))
                            least[y][h, inside] = min(old, (before, after))
                shrink(0, 2 * SAMPLE)
                shrink(1, 2 * SAMPLE)
        shrink(0, SAMPLE)
        shrink(1, SAMPLE)
        out = [(y, h, w, a, c) for y in (0, 1) for (h, w), (a, c) in least[y].items()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()))], ["y", "h", "b", "a", "c"])

    examples = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(tidy(found), "y int, h long, b string, a string, c string")
    examples = examples.groupBy("y", "h", "b").agg(F.min(F.struct("a", "c")).alias("m")).select("y", "h", "b", "m.*").persist()
    taken = [r for y in (1, 0) for r in examples.where(F.col("y") == y).orderBy("h", "b").limit(SAMPLE).collect()]
    examples.unpersist()
    net = fit([(r.a, r.b, r.c) for r in taken], np.array([r.y for r in taken], float))
    if net is None:
        n = sum(r.y for r in taken)
        warnings.warn(f"no network: {n} base findings and {len(taken) - n} other candidates, ten of each are needed", stacklevel=2)
    return net


#: Examples that a share of the training data has, as long as there are at most SHARES of them.
SHARE, SHARES = 20_000, 256
#: Rounds are as many as show so many findings, four at least.
SHOWN = 180_000
#: Cells of a raw score's unit in which held-out findings are counted.
CELLS = 256


def examples_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All labelled findings of all documents, each distinct value of a label once, with the least of its contexts: rows (y, h, b, a, c) as in
    ``train``, which takes the least hashes of them."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, column=text_col):
            least: dict[tuple[int, int, str], tuple[str, str]] = {}
            for t in b.column(text_col).to_pylist():
                for y, own, x, z in labelled(t):
                    for before, inside, after in windows(own, x, z):
                        k = (y, int.from_bytes(hashlib.blake2b(inside.encode(), digest_size=7).digest()), inside)
                        least[k] = min(least.get(k, (before, after)), (before, after))
            out = [(*k, *v) for k, v in least.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()))], ["y", "h", "b", "a", "c"])

    rows = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(tidy(found), "y int, h long, b string, a string, c string")
    return rows.groupBy("y", "h", "b").agg(F.min(F.struct("a", "c")).alias("m")).select("y", "h", "b", "m.*")


def learn(docs: DataFrame, text_col: str = "text", passes: int = 30, seed: int = 5) -> Network | None:
    """The network, learned from all labelled findings of all documents (see ``train`` for the labels); None, with a warning, if they are too few.

    Findings are dealt by their hash to shares, and in each round a task takes each share through steps from the network of the round before;
    the next one is the mean over shares, weighted by their findings. Shares don't depend on Spark's partitions. Four rounds at least pass
    over all findings, more if they are few. A fifth of the findings, by hash, is held out: the scale and the threshold come from counts of
    all of its raw scores, in cells of 1 / CELLS. Both labels weigh the same in all.

    The driver gets a network for each share, 97 KB, of which there are SHARES at most, and the counts of the cells.
    """
    rows = cut(examples_of(docs, text_col))
    n = {(r.y, r.test): r.n for r in rows.groupBy("y", (F.col("h") % 5 == 0).alias("test")).agg(F.count("*").alias("n")).collect()}
    all_of = [n.get((y, True), 0) + n.get((y, False), 0) for y in (0, 1)]
    if min(all_of) < 10:
        warnings.warn(f"no network: {all_of[1]} base findings and {all_of[0]} other candidates, ten of each are needed", stacklevel=2)
        return None
    total = sum(all_of)
    weight = np.array([total / (2 * k) for k in all_of])
    shares = min(SHARES, -(-total // SHARE))
    rounds = max(4, min(passes, -(-SHOWN // total)))
    size = BEFORE + INSIDE + AFTER

    def coded(table: pa.Table) -> pa.Table:
        """A share's findings as one row: labels, hashes, lengths and characters, in the order of the hashes."""
        t = table.sort_by([("h", "ascending"), ("y", "ascending"), ("b", "ascending")])
        b = t.column("b").to_pylist()
        x, _ = codes(list(zip(t.column("a").to_pylist(), b, t.column("c").to_pylist(), strict=True)))
        held = [x.astype(np.uint8), t.column("y").to_numpy().astype(np.uint8), np.array([len(w) for w in b], np.uint8), (t.column("h").to_numpy() % 5 == 0).astype(np.uint8)]
        return pa.table({"share": t.column("share").slice(0, 1), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in zip("xynt", held, strict=True)}})

    dealt = rows.withColumn("share", F.floor(F.col("h") / 5) % shares)  # hashes that are held out are in all shares
    dealt = cut(dealt.repartition(shares, "share").groupBy("share").applyInArrow(coded, "share long, x binary, y binary, n binary, t binary"))

    def shares_of(batches: Iterator[pa.RecordBatch], test: bool) -> Iterator[tuple]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, y, k, t = (np.frombuffer(batch.column(c)[r].as_buffer(), np.uint8) for c in "xynt")
                keep = t == test
                yield batch.column("share")[r].as_py(), x.reshape(-1, size)[keep], y[keep].astype(float), k[keep].astype(np.intp)

    places = np.arange(size)[None, :]

    def inner(k: np.ndarray) -> np.ndarray:
        return (places >= BEFORE) & (places < BEFORE + k[:, None])

    net = fresh(np.random.default_rng(seed))

    def taught(turn: int, net: Network) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for share, x, y, k in shares_of(batches, False):
                if not len(x):
                    continue
                g = np.random.default_rng([seed, turn, share])
                own = Network(net.conv.copy(), net.bias.copy(), net.dense.copy())
                step, order = Steps(own), g.permutation(len(x))
                for lo in range(0, len(order), 128):
                    i = order[lo : lo + 128]
                    other = np.where(g.random(len(i)) < 0.5, g.integers(0, len(x), len(i)), i)  # half of them get another one's context
                    inside = inner(k[i])
                    behind = places >= BEFORE + k[i][:, None]
                    from_ = np.minimum(places - k[i][:, None] + k[other][:, None], size - 1)
                    after = np.where(places - BEFORE - k[i][:, None] < AFTER, np.take_along_axis(x[other], np.maximum(from_, 0), 1), 0)
                    shown = np.where(inside, x[i], np.where(behind, after, x[other]))
                    step.down(shown, inside, y[i], weight[y[i].astype(int)], 0.01 / (1 + turn / 8))
                flat = np.concatenate([own.conv.ravel(), own.bias, own.dense])
                yield pa.RecordBatch.from_arrays([pa.array([share], pa.int64()), pa.array([len(x)], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["share", "n", "net"])

        return work

    for turn in range(rounds):
        made = sorted(dealt.mapInArrow(tidy(taught(turn, net)), "share long, n long, net binary").collect(), key=lambda r: r.share)
        if not made:
            break
        flat = sum(np.frombuffer(r.net) * r.n for r in made) / sum(r.n for r in made)
        conv, bias, dense = np.split(flat, [net.conv.size, net.conv.size + FILTERS])
        net = Network(conv.reshape(net.conv.shape).copy(), bias.copy(), dense.copy())

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, y, k in shares_of(batches, True):
            for lo in range(0, len(x), 256):
                z = net.raw(x[lo : lo + 256], inner(k[lo : lo + 256]))
                yield pa.RecordBatch.from_arrays([pa.array(y[lo : lo + 256].astype(np.int32)), pa.array(np.rint(np.clip(z, -40, 40) * CELLS).astype(np.int32))], ["y", "cell"])

    cells = dealt.mapInArrow(tidy(judged), "y int, cell int").groupBy("y", "cell").agg(F.count("*").alias("n")).orderBy("y", "cell").collect()
    y, z, many = (np.array([r[c] for r in cells], float) for c in ("y", "cell", "n"))
    # whole counts set the threshold's places; the scale takes both labels for equally many
    calibrate(net, z / CELLS, y, many, balance=True)
    return net


def scan(df: DataFrame, network: Network | None, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``df`` with ``out``: array of (kind, start, end, score), code points, end exclusive, by start and kind.

    Base findings are all kept, with the network's score of their value; further candidates are added as kind
    ``network`` if their score reaches the threshold. A null or empty text has none; a column ``out`` is replaced.
    """
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(network)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in parts(batches, 1000, column=text_col):
            spans: list[list[dict]] = []
            asked: list[tuple[str, str, str]] = []
            of: list[tuple[int, dict, bool, int]] = []
            for i, t in enumerate(b.column(text_col).to_pylist()):
                spans.append([])
                base, rest = look(t) if t else ([], [])
                for kind, x, y, value in [*base, *(("network", x, y, x) for x, y in rest)]:
                    of.append((i, {"kind": kind, "start": x, "end": y, "score": None}, kind != "network", len(asked)))
                    asked += windows(t, value, y)
            # of a long candidate the window with the largest score counts
            scores = np.maximum.reduceat(net.scores(asked), [x[3] for x in of]) if net and of else [None] * len(of)
            for (i, span, sure, _), s in zip(of, scores, strict=True):
                if sure or (s is not None and s >= net.threshold):
                    spans[i].append(span | {"score": None if s is None else float(s)})
            for s in spans:
                s.sort(key=lambda x: (x["start"], KINDS.index(x["kind"])))
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, kind)], [*b.schema.names, out])

    return df.mapInArrow(tidy(scanned), T.StructType([*df.schema.fields, T.StructField(out, SPANS)]))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", spans_col: str = "secrets", mark: str = "[REDACTED]") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by ``mark``, overlapping and touching spans by one mark."""
    spans, text = F.col(spans_col), F.col(text_col)
    empty = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def put(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        more = F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.when(fresh, more).otherwise(acc["done"]).alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))

    cleaned = F.aggregate(spans, empty, put, lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.length(text))))
    return df.withColumn(text_col, F.when(F.size(spans) > 0, cleaned).otherwise(text))



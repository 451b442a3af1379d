"""Personal data by candidate gradient boosting.

Generators with high recall propose spans, which may overlap: addresses around every `@` and spelt-out ones, numbers
with dots, colons or separators, chains of digits of any grouping. Each candidate gets features of its format
(lengths, groups, checksum, number ranges, top-level domain) and of its context (neighbouring characters, cue words
to its left). Boosted trees (Spark ML) score them; an isotonic curve per kind turns scores into probabilities, and a
threshold per kind is set on rows kept apart, so that of the candidates beyond it at least PRECISION were personal data.

Four kinds have base patterns, whose matches are always spans: leftmost, non-overlapping, and dropped without another
try where a check fails. The model adds spans of the same kinds that overlap no base span; of overlapping additions the
likeliest stays, then the longest, then the first.

No table labels personal data. Labels are made: made items of many forms and look-alikes of them are set into passages
of TRAIN_DOCS documents (a bound, whatever the table); candidates that hold such an item are positive, those
over a look-alike negative. `train` takes any labelled candidates.

Offsets count code points, ends are exclusive. Null and empty texts have no spans. Rows without an id and repeated
rows are scanned like others. Whole texts are searched, in time that grows with their length (a local part longer than
64 characters or a domain longer than 255 is found by the base pattern, not proposed). An empty table gives no rows;
without documents to learn from, only base spans are given. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents that labelled candidates are made from, and made items of each.
TRAIN_DOCS, ITEMS = 1200, 4
TREES, DEPTH, STEP, SEED = 20, 4, 0.3, 11
#: Least precision of the additions, on rows kept apart from training.
PRECISION = 0.95
#: Characters of context on either side.
AROUND = 40
SPAN = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

# ---- base patterns -----------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Matches start where a run of digits does, and take all of a chain: no text takes more than linear time.
_DOTTED = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3,}+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    """The check of card numbers."""
    values = [int(c) for c in reversed(digits)]
    return sum(v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for k, v in enumerate(values)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts = list(_DIGITS.finditer(text, chain.start(), chain.end()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(p.group().lstrip("0")) <= 3 and int(p.group().lstrip("0") or 0) <= 255 for p in four):
                yield four[0].start(), four[3].end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The matches of the base patterns, by kind and then by place."""
    out = [("email", *s) for s in _emails(text)]
    if _DIGITS.search(text):
        out += [("ip", *s) for s in _addresses(text)]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


# ---- generators --------------------------------------------------------------------------------

_TRIM = "<>()[]{}\"'`.,;:!?*_|#$%&=\\/"
_SPELT_AT = re.compile(r"\s?[\[({]\s?(?:at|AT|@|arobase)\s?[\])}]\s?|\s(?:at|AT)\s")
_SPELT_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({]\s?(?:dot|DOT|punto|point)\s?[\])}]\s?|\s(?:dot|DOT)\s)[A-Za-z0-9-]{1,63}){1,8}")
_DEFANGED = re.compile(r"(?<![0-9])(?:[0-9]{1,3}(?:\[\.\]|\(\.\)|\s\.\s)){3}[0-9]{1,3}(?![0-9])")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_CHAIN = re.compile(r"(?<![0-9])[0-9](?:[ ().\-/]{0,3}[0-9]){6,}+")


def _number_kinds(digits: int) -> tuple[str, ...]:
    return tuple(k for k, low, high in (("card", 13, 19), ("phone", 7, 15)) if low <= digits <= high)


def _pieces(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Of a chain of digits: all of it, its longest stretches with one separator, and its long groups."""
    groups = [m.span() for m in _DIGITS.finditer(text, start, end)]
    yield start, end
    at = 0
    for k in range(1, len(groups)):
        here = text[groups[k - 1][1] : groups[k][0]]
        if k - 1 > at and here != text[groups[at][1] : groups[at + 1][0]]:
            yield groups[at][0], groups[k - 1][1]
            at = k
    if groups:
        yield groups[at][0], groups[-1][1]
    yield from groups


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Candidate spans (kind, start, end), base matches included; each once, in no order that matters."""
    out = set(base_spans(text))
    at = text.find("@")
    while at >= 0:
        left, right = text[max(0, at - 64) : at], text[at + 1 : at + 256]
        local, domain = re.split(r"\s", left)[-1].lstrip(_TRIM), re.split(r"\s", right, maxsplit=1)[0]
        domain = domain.split("@")[0].rstrip(_TRIM)
        if local and domain and "@" not in local:
            out.add(("email", at - len(local), at + 1 + len(domain)))
        at = text.find("@", at + 1)
    for m in _SPELT_AT.finditer(text):
        local = _SPELT_LOCAL.search(text, max(0, m.start() - 64), m.start())
        domain = _SPELT_DOMAIN.match(text, m.end()) if local else None
        if domain:
            out.add(("email", local.start(), domain.end()))
    if _DIGITS.search(text):
        if "[.]" in text or "(.)" in text or " . " in text:
            out.update(("ip", *m.span()) for m in _DEFANGED.finditer(text))
        for m in _CHAIN.finditer(text):
            for s, e in _pieces(text, *m.span()):
                for kind in _number_kinds(len(_digits(text[s:e]))):
                    if kind == "phone" and text[s - 1 : s] == "(" and ")" in text[s:e]:
                        s -= 1
                    out.add((kind, s, e))
    if "::" in text or text.count(":") > 1:
        out.update(("ip", *m.span()) for m in _COLONS.finditer(text))
    return list(out)


# ---- features ----------------------------------------------------------------------------------

# Words to the left that speak for a kind, or for a number that is none of them.
CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel", "schreib", "escrib"),
    "ip": ("ip", "host", "server", "addr", "client", "login", "adresse", "serveur"),
    "card": ("card", "visa", "credit", "pay", "tarjeta", "carte", "karte", "amex"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "ruf", "llam", "appel", "whatsapp"),
    "none": ("order", "invoice", "ref", "isbn", "version", "date", "no.", "nr.", "id", "serial", "token", "key", "sha", "commit", "part", "page", "#"),
}
DOMAINS = frozenset("com org net edu gov info io de fr es uk it eu ch at nl".split())
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-/. ][01]?[0-9][-/. ][0-3]?[0-9]|[0-3]?[0-9][-/. ][01]?[0-9][-/. ](?:19|20)[0-9]{2}")


def _side(c: str) -> list[float]:
    return [float(not c or c.isspace()), float(c.isalpha()), float(c.isdigit()), float(bool(c) and c in "=\"'_-/")]


def features(kind: str, before: str, value: str, after: str) -> list[float]:
    digits = _digits(value)
    groups = [len(g) for g in _DIGITS.findall(value)] or [0]
    letters = sum(c.isalpha() for c in value)
    marks = value.replace("[", "").replace("]", "")
    left = before.lower()
    top = re.split(r"[.\s\])}]", value.lower())[-1]
    parts = _DIGITS.findall(value) if kind == "ip" else []
    return [
        *[float(kind == k) for k in KINDS],
        float(min(len(value), 400)),
        float(min(len(digits), 64)),
        letters / max(1, len(value)),
        float(min(len(groups), 32)),
        float(max(groups)),
        float(min(groups)),
        float(groups[0]),
        float(groups[-1]),
        float(bool(digits) and luhn(digits[:19])),
        float(digits[:1] or -1),
        len(set(digits)) / max(1, min(10, len(digits))),
        *[float(min(value.count(c), 9)) for c in " -.(/:@"],
        float(value[:1] == "+" or digits[:2] == "00"),
        float(top in DOMAINS),
        float(1 < len(top) < 7 and top.isalpha()),
        float(sum(len(p) <= 3 and int(p) <= 255 for p in parts)),
        float("::" in value),
        float(bool(_DATE.search(value))),
        float(any(c in marks for c in "(){}") or marks != value),
        float(any(ord(c) > 127 for c in value)),
        *_side(before[-1:]),
        *_side(after[:1]),
        *[float(any(w in left[-24:] for w in CUES[k])) for k in (*KINDS, "none")],
    ]


def _around(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - AROUND) : start], text[start:end], text[end : end + AROUND]


# ---- labelled candidates -----------------------------------------------------------------------


def _checked(rng: np.random.Generator, size: int, good: bool) -> str:
    """Digits that pass the card check, or do not."""
    body = "".join(map(str, [int(rng.integers(1, 10)), *rng.integers(0, 10, size - 2).tolist()]))
    last = next(c for c in "0123456789" if luhn(body + c))
    return body + (last if good else str((int(last) + int(rng.integers(1, 10))) % 10))


def _cut(digits: str, sizes: tuple[int, ...], by: str) -> str:
    out, at = [], 0
    for s in sizes:
        out.append(digits[at : at + s])
        at += s
    return by.join(p for p in [*out, digits[at:]] if p)


def _made(rng: np.random.Generator, words: list[str]) -> tuple[str, str, str, str, int]:
    """(kind, before, value, after, label): an item of a drawn form, or something that looks like one."""
    pick = lambda *xs: xs[int(rng.integers(0, len(xs)))]
    number = lambda n: "".join(map(str, rng.integers(0, 10, n).tolist()))
    some = lambda n: "".join("0123456789abcdef"[k] for k in rng.integers(0, 16, n))
    word = lambda: re.sub(r"\W", "", str(pick(*words)).lower()) or "name" if words else "name"
    byte = lambda: str(int(rng.integers(1, 256)))
    kind, label = KINDS[int(rng.integers(0, 4))], int(rng.integers(0, 2))
    cue = f"{pick(*CUES[kind])}{pick(': ', ' ', ':')}" if rng.integers(0, 2) else ""
    plain, after = f"{pick(*CUES['none'])}{pick(': ', ' ', '=', ' no. ')}", pick("", "", ".", ",", ")", ";")
    area, one, two = number(3), number(3), number(4)
    if kind == "email":
        name, host, top = f"{word()}{pick('.', '_', '')}{word()}{pick('', number(2))}", f"{pick('mail.', '')}{word()}", pick("com", "org", "net", "de", "fr", "es", "io")
        if label:
            value = pick(f"{name}@{host}.{top}", f"{name} [at] {host}.{top}", f"{name}(at){host}(dot){top}", f"{name} at {host} dot {top}", f"{name}é@{host}.{top}", f"{name} [at] {host} [dot] {top}")
        else:
            cue, value = pick("", "git ", "see "), pick(f"{name}@{host}", f"@{name}@{host}", f"{name}@{number(2)}", f"{number(2)}@{number(1)}.{number(2)}€", f"{word()} at {word()}.{word()}", f"{word()} at {word()}. {word()}")
    elif kind == "ip":
        if label:
            value = pick(".".join(byte() for _ in range(4)), "[.]".join(byte() for _ in range(4)), ":".join(some(4) for _ in range(8)), f"fe80::{some(4)}:{some(4)}", f"2001:{some(4)}::{some(3)}")
        else:
            cue, value = pick(cue, plain), pick(".".join(str(int(rng.integers(256, 999))) for _ in range(4)), f"{int(rng.integers(0, 24)):02d}:{int(rng.integers(0, 60)):02d}:{int(rng.integers(0, 60)):02d}", ":".join(some(2) for _ in range(6)), f"{number(1)}:{number(2)}:{number(2)}", " . ".join(str(int(rng.integers(256, 999))) for _ in range(4)))
    elif kind == "card":
        size = pick(15, 16, 16, 16, 19, 13, 14)
        shape, by = pick((4, 4, 4, 4), (4, 6, 5), (20,)), pick(" ", "-", ".", " - ")
        value = _cut(_checked(rng, size, bool(label)), shape, by)
        cue = cue if label else pick(cue, plain, "")
        if not label and rng.integers(0, 3) == 0:
            cue, value, after = pick("token = \"", "key=", "sha ", plain) + some(4) + "a", number(pick(13, 14, 15, 16)), "f" + some(6)
    elif label:
        value = pick(f"+1 ({area}) {one}-{two}", f"({area}) {one}-{two}", f"{area}-{one}-{two}", f"{area}.{one}.{two}", f"00{number(2)} {number(3)} {number(4)} {number(2)}", f"0{number(3)} {number(7)}", f"0{number(1)} {number(2)} {number(2)} {number(2)} {number(2)}", f"0{number(2)}/{number(7)}", f"+{number(2)} {number(3)} {number(6)}")
        if not value.startswith(("+", "(")) and not cue:
            cue = f"{pick(*CUES['phone'])}{pick(': ', ' ')}"
    else:
        month, day, year = int(rng.integers(1, 13)), int(rng.integers(1, 29)), int(rng.integers(1950, 2030))
        cue, value = pick(plain, ""), pick(f"{year}-{month:02d}-{day:02d}", f"{day}.{month}.{year}", f"{day}/{month}/{year} {number(2)}", f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", number(pick(7, 8, 9, 10, 12)), f"{number(1)}.{number(9)}", f"{year}-{year + 1} {number(4)}", f"{number(3)}.{number(3)}.{number(3)}", f"{number(2)} {number(3)} {number(3)}")
        if rng.integers(0, 3) == 0:
            cue, value, after = pick("token = \"", "key=", "sha ", plain) + some(4) + "e", number(pick(7, 8, 9, 10, 11)), "b" + some(6)
    return kind, cue, value, after, label


def labelled(documents: DataFrame, id_col: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(part, kind, f, label): candidates in made passages, from the `train_docs` documents of the smallest hash of
    their text; `part` from 0 to 9 deals them to training and calibration by document. A passage is a stretch of
    a document around a drawn place, with an item set into it."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sample = documents.select(F.xxhash64(body).alias("h"), body.alias("t")).where("t <> ''")
    chosen = sample.select("h").distinct().orderBy("h").limit(train_docs)
    # `train_docs` numbers; equal texts are one
    texts = sample.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("t").alias("t"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for seed, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rng = np.random.default_rng([seed & 0xFFFFFFFF, seed >> 32 & 0xFFFFFFFF])
                for _ in range(ITEMS):
                    at = int(rng.integers(0, len(t) + 1))
                    left, right = t[max(0, at - 200) : at], t[at : at + 200]
                    kind, before, value, after, label = _made(rng, (left + right).split())
                    head = f"{left} {before}"
                    passage, s, e = f"{head}{value}{after} {right}", len(head), len(head) + len(value)
                    for k, a, b in proposals(passage):
                        exact = (k, a, b) == (kind, s, e)
                        if a < e and b > s and (exact or not label):
                            rows.append((seed % 10, k, features(k, *_around(passage, a, b)), label))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int32(), pa.string(), pa.list_(pa.float64()), pa.int32())
            yield pa.record_batch({n: pa.array(list(c), k) for n, c, k in zip(("part", "kind", "f", "label"), columns, kinds, strict=True)})

    return texts.mapInArrow(make, "part int, kind string, f array<double>, label int")


# ---- the model ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Trees as arrays of nodes (feature -1: a leaf), each tree's root, and per kind a curve from score to
    probability and the least probability of a span."""

    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    curves: dict[str, tuple[np.ndarray, np.ndarray]]
    least: dict[str, float]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Score of each row of features, from 0 to 1."""
        total = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while (inner := self.feature[at] >= 0).any():
                k = np.flatnonzero(inner)
                node = at[k]
                at[k] = np.where(rows[k, self.feature[node]] <= self.bound[node], self.left[node], self.right[node])
            total += self.value[at]
        return 1 / (1 + np.exp(-2 * total))

    def probability(self, kinds: list[str], rows: np.ndarray) -> np.ndarray:
        score, out = self.raw(rows), np.zeros(len(rows))
        for kind, (x, y) in self.curves.items():
            mine = np.array([k == kind for k in kinds], bool)
            out[mine] = np.interp(score[mine], x, y)
        return out


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising curve that fits labels best, by pooling neighbours that fall."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first score, last score
    for s, v in zip(score[order].tolist(), label[order].tolist(), strict=True):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, _, last = blocks.pop()
            v1, w1, first, _ = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, first, last])
    return np.array([x for b in blocks for x in b[2:]]), np.array([b[0] for b in blocks for _ in range(2)])


def _threshold(probability: np.ndarray, label: np.ndarray, precision: float) -> float:
    """The least probability from which on the precision is reached; beyond 1 where it never is."""
    for p in np.unique(probability):
        if p > 0.5 and label[probability >= p].mean() >= precision:
            return float(p)
    return 2.0


def train(rows: DataFrame, precision: float = PRECISION) -> Model | None:
    """Trees from the labelled candidates of parts 0 to 6, curves and thresholds from the other parts; None where
    either has no two labels."""
    rows = rows.where("label IN (0, 1)").coalesce(1).sortWithinPartitions("part", "kind", "label", "f")  # a bounded sample, in one order
    rows = rows.persist()
    try:
        apart = rows.where("part >= 7").select("kind", "f", "label").toPandas()
        if apart["label"].nunique() < 2 or rows.where("part < 7").select("label").distinct().count() < 2:
            return None
        learn = rows.where("part < 7").select(array_to_vector("f").alias("features"), F.col("label").cast("double").alias("label"))
        forest = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED).fit(learn)
    finally:
        rows.unpersist()
    nodes, roots = [], []

    def add(node, weight: float) -> int:
        here = len(nodes)
        nodes.append([-1, 0.0, -1, -1, 0.0])
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            nodes[here][:2] = split.featureIndex(), split.threshold()
            nodes[here][2] = add(node.leftChild(), weight)
            nodes[here][3] = add(node.rightChild(), weight)
        else:
            nodes[here][4] = weight * node.prediction()
        return here

    for tree, weight in zip(forest.trees, forest.treeWeights, strict=True):
        roots.append(add(tree._call_java("rootNode"), weight))
    feature, bound, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    model = Model(feature, bound, left, right, value, np.array(roots), {}, {})
    score, label = model.raw(np.array(apart["f"].tolist())), apart["label"].to_numpy(float)
    for kind in KINDS:
        mine = (apart["kind"] == kind).to_numpy()
        if mine.any():
            model.curves[kind] = isotonic(score[mine], label[mine])
            model.least[kind] = _threshold(np.interp(score[mine], *model.curves[kind]), label[mine], precision)
    return model


# ---- spans -------------------------------------------------------------------------------------


def additions(text: str, base: list[tuple[str, int, int]], asked: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of the likely candidates (kind, start, end, probability), those that overlap neither a base span nor a better one."""
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    out = []
    for kind, s, e, p in sorted(asked, key=lambda c: (-c[3], c[1] - c[2], c[1], c[0])):
        k = int(np.searchsorted(starts, e))  # spans that start before e
        if any(b > s for _, b in taken[max(0, k - len(KINDS)) : k]):
            continue
        taken.insert(k, (s, e))
        starts.insert(k, s)
        out.append((kind, s, e, p))
    return out


def spans_of(texts: list[str | None], model: Model | None) -> list[list[dict]]:
    """The spans of each text: by kind as in KINDS, then by start."""
    bases = [base_spans(t) if t else [] for t in texts]
    asked: list[tuple[int, str, int, int]] = []
    rows: list[list[float]] = []
    if model:
        for n, t in enumerate(texts):
            known = set(bases[n])
            for c in proposals(t) if t else ():
                if c not in known:
                    asked.append((n, *c))
                    rows.append(features(c[0], *_around(t, c[1], c[2])))
    likely: dict[int, list[tuple[str, int, int, float]]] = {}
    if rows:
        kinds = [a[1] for a in asked]
        for (n, kind, s, e), p in zip(asked, model.probability(kinds, np.array(rows)).tolist(), strict=True):
            if p >= model.least.get(kind, 2.0):
                likely.setdefault(n, []).append((kind, s, e, p))
    out = []
    for n, base in enumerate(bases):
        found = [(*b, 1.0, True) for b in base]
        if n in likely:
            found += [(*a, False) for a in additions(texts[n], base, likely[n])]
        found.sort(key=lambda f: (KINDS.index(f[0]), f[1]))
        out.append([dict(zip(("kind", "start", "end", "score", "base"), f, strict=True)) for f in found])
    return out


def find(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, `spans`) for every row; narrow, one pass. Without a model only base spans."""
    kind = dict(documents.dtypes)[id_col]
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few hundred nodes
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = spans_of(part.column(1).to_pylist(), shared.value)
                yield pa.record_batch({id_col: part.column(0), "spans": pa.array(found, pa.list_(item))})

    return documents.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(run, f"`{id_col}` {kind}, spans {SPAN}")


def span_text(spans: Column) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_of(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_of(spans: Column, kind: str) -> Column:
    """How many base spans of a kind there are."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def redacted(text: str | None, spans: list[dict]) -> str | None:
    """The text with every span replaced by its kind in brackets; spans that overlap become one, named by the first."""
    if not text or not spans:
        return text
    out, done, cover = [], 0, []
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if cover and s["start"] < cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], s["end"])
        else:
            cover.append([s["start"], s["end"], s["kind"]])
    for start, end, kind in cover:
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def redact(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`documents` with their personal data replaced; all other columns stay, null texts stay null."""

    @F.pandas_udf("string")
    def clean(column: pd.Series) -> pd.Series:
        texts = [t if isinstance(t, str) else None for t in column]
        return pd.Series([redacted(t, s) for t, s in zip(texts, spans_of(texts, model), strict=True)], dtype=object)

    return documents.withColumn(text, clean(F.col(f"`{text}`")))

"""Secret scan: broad patterns find candidates, a random forest removes the false ones.

Candidates are strings of formats that keys have, values given to names like `password`, and long
unbroken strings. The forest (Spark ML) judges each by its length, its character transitions (classes
and the corpus's own pairs of characters), the share of it that dictionary words cover, whether it looks
like a path, and the words around it. It learns from labelled findings: `train` takes any frame of
(before, value, after, label). Where no findings are at hand, `labelled_findings` makes some: secrets and
look-alikes (paths, checksums, placeholders, identifiers) of many formats are set into real passages, and
strings that the prose itself holds are labelled false.

Corpus statistics cover all documents and have a fixed size: a table of character pairs and a table of
document counts by word hash; a dictionary word is one that a share of all documents holds.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm import grams

U = np.uint64
#: Documents that give passages for labelled findings, those of the smallest hash of their id.
TRAIN_DOCS = 1500
TREES, DEPTH, SEED = 30, 8, 11
AROUND = 48
WORD_BUCKETS = 1 << 22
COMMON = 0.002
LEAST = 0.5

# Public formats of keys.
# Name, a string that every such key has, and its form.
_FORMATS = (
    ("private_key", "PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}?-----END [A-Z ]*PRIVATE KEY-----"),
    ("access_key_id", "AKIA", r"\bAKIA[0-9A-Z]{16}\b"),
    ("access_key_id", "ASIA", r"\bASIA[0-9A-Z]{16}\b"),
    ("host_token", "gh", r"\bgh[pousr]_[A-Za-z0-9]{36,}\b"),
    ("web_token", "eyJ", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("url_password", "://", r"(?<=://)[^\s/:@]{1,64}:[^\s/@]{4,}(?=@)"),
)
_NAMES = r"token|passw(?:or)?d|pwd|passphrase|secret|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|client[_-]?secret|credentials?"
_NAME_BEFORE = re.compile(rf"(?i)(?:{_NAMES})[\w-]{{0,24}}[\"']?[ \t]{{0,4}}:?$")
_VALUE_AFTER = re.compile(r">?[ \t]{0,4}[\"']?([^\s\"',;<>]{6,})")
_LONG = re.compile(r"(?<![A-Za-z0-9+/_=.~-])[A-Za-z0-9+/_=.~-]{20,}")
_FORMS = [(name, mark, re.compile(form)) for name, mark, form in _FORMATS]
_SIGN = re.compile(r"[:=]")
_WORD = re.compile(r"\S{20,}")
_SECRET_WORD = re.compile(rf"(?i){_NAMES}|bearer|key\b")
_HARMLESS_WORD = re.compile(r"(?i)commit|sha\d*|md5|checksum|digest|hash|etag|uuid|version|example|sample|placeholder|dummy|path|file|dir|href|src|image|http|import|class|test")
_PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|\.{3,}|change.?me|your[_-]|example|placeholder|dummy|redacted|<[a-z_ ]+>|\$\{|1234|abcd|password|secret")

_CLASS = np.full(128, 4, np.int64)
_CLASS[48:58] = 2
_CLASS[65:91] = 1
_CLASS[97:123] = 0
_CLASS[[ord(c) for c in "/\\._-"]] = 3
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[97:123] = np.arange(26) + 1
_SYMBOLS[65:91] = np.arange(26) + 1
_SYMBOLS[48:58] = np.arange(10) + 27
_SYMBOLS[[ord(c) for c in "+/=_-."]] = np.arange(6) + 37
PAIRS = 64
FEATURES = 28


@dataclass
class Corpus:
    """What the documents say of characters and words: log shares of pairs, document counts by word hash."""

    pairs: np.ndarray
    words: np.ndarray
    documents: int

    def common(self, h: np.ndarray) -> np.ndarray:
        return self.words[(h % U(len(self.words))).astype(np.int64)] >= max(2, COMMON * self.documents)


def corpus(documents: DataFrame, text: str = "text") -> Corpus:
    """Statistics of all documents; the driver gets tables of fixed size."""
    body = documents.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def pairs(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        data = np.concatenate([np.zeros(0, np.uint8), *grams.text_bytes(batch.column(0))])
        for at in range(0, len(data), grams.PIECE):
            k = _SYMBOLS[data[at : at + grams.PIECE + 1]]
            n = np.bincount(k[:-1] * PAIRS + k[1:], minlength=PAIRS * PAIRS)
            yield n

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS * PAIRS, np.int64)
        rows = 0
        for batch in batches:
            rows += len(batch.column(0))
            for n in pairs(batch):
                total += n
        seen = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(np.append(seen, -1), pa.int32()), "n": pa.array(np.append(total[seen], rows), pa.int64())})

    found = {r["pair"]: r["n"] for r in body.mapInArrow(count_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()}  # PAIRS**2 + 1 rows at most
    counts = np.ones(PAIRS * PAIRS)
    for k, n in found.items():
        if k >= 0:
            counts[k] += n
    table = counts.reshape(PAIRS, PAIRS)
    words = grams.count_table(body, lambda b: (np.unique(h) for h, _, _ in grams.texts_words(b.column(0), grams.PUNCTUATION)), WORD_BUCKETS)
    return Corpus(np.log2(table / table.sum(1, keepdims=True)).astype(np.float32), words, int(found.get(-1, 0)))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(rule, start, end) of each candidate value, in code points, by place. Of overlapping ones the format
    wins over the assignment and both over the long string; of the same rank, the first."""
    found = [(0, m.start(), m.end(), name) for name, mark, form in _FORMS if mark in text for m in form.finditer(text)]
    if ":" in text or "=" in text:
        for m in _SIGN.finditer(text):
            if _NAME_BEFORE.search(text, max(0, m.start() - 64), m.start()) and (v := _VALUE_AFTER.match(text, m.end())):
                found.append((1, *v.span(1), "assigned"))
    # only words of so many characters can hold a long string; most texts have none
    if len(max(text.split(), key=len, default="")) >= 20:
        found += [(2, m.start(), m.end(), "long") for w in _WORD.finditer(text) for m in _LONG.finditer(text, w.start(), w.end())]
    taken: list[tuple[int, int, str]] = []
    for _, start, end, name in sorted(found):
        k = bisect.bisect_left(taken, (start, end, ""))
        if (k == len(taken) or taken[k][0] >= end) and (k == 0 or taken[k - 1][1] <= start):
            taken.insert(k, (start, end, name))
    return [(name, start, end) for start, end, name in taken]


def _words(part: str) -> tuple[np.ndarray, np.ndarray]:
    h, s, e = grams.words(np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8), grams.PUNCTUATION)
    return h, e - s


def features(before: str, value: str, after: str, known: Corpus) -> list[float]:
    raw = np.frombuffer(value.encode("utf-8", "surrogatepass"), np.uint8)
    ascii_ = raw[raw < 128]
    kinds = _CLASS[ascii_]
    n = max(len(raw), 1)
    counts = np.bincount(kinds, minlength=5) / n
    _, repeat = np.unique(raw, return_counts=True)
    share = repeat / n
    symbols = _SYMBOLS[raw]
    pair = known.pairs[symbols[:-1], symbols[1:]]
    h, size = _words(value)
    long = size >= 3
    covered = float(size[long & known.common(h)].sum()) / n if len(h) else 0.0
    parts = re.split(r"[/\\]", value)
    left, right = before[-AROUND:], after[:AROUND]
    near, _ = _words(" ".join(left.split()[-3:] + right.split()[:3]))
    return [
        float(min(n, 512)),
        *counts.tolist(),
        float(np.count_nonzero(kinds[1:] != kinds[:-1])) / n,
        float(-(share * np.log2(share)).sum()),
        float(len(repeat)) / n,
        float(pair.mean()) if len(pair) else 0.0,
        float(pair.min()) if len(pair) else 0.0,
        covered,
        float(size.max()) / n if len(size) else 0.0,
        float(len(h)),
        float(len(parts) - 1),
        float(value.startswith(("/", "./", "../", "~")) or "://" in left[-8:] + value),
        float(bool(re.search(r"\.[a-z]{2,4}$", value))),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
        float(bool(_PLACEHOLDER.search(value))),
        float(bool(_SECRET_WORD.search(left[-24:]))),
        float(bool(_HARMLESS_WORD.search(left[-24:]))),
        float(left.rstrip()[-1:] in ("=", ":") or left.rstrip(" \"'")[-1:] in ("=", ":")),
        float(left[-1:] in ("'", '"')),
        float(np.mean(known.common(near))) if len(near) else 0.0,
        float(left[-1:].isspace() or not left),
        float(right[:1].isspace() or not right),
        float(right[:1] == "@" and ":" in value),
        float(value.startswith("-----BEGIN")),
    ]


# ---- labelled findings -------------------------------------------------------------------------

_HEX, _ALNUM = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def _made(rng: np.random.Generator, words: list[str]) -> list[tuple[str, str, str, int]]:
    """(before, value, after, label): a secret and a look-alike, each of a drawn form."""
    take = lambda letters, n: "".join(letters[k] for k in rng.integers(0, len(letters), n))
    name = str(rng.choice(["token", "password", "passwd", "secret", "api_key", "API-KEY", "auth_token", "client_secret", "access_key", "db_password"]))
    equals = str(rng.choice(["=", " = ", ": ", ":", "=>"]))
    quote = str(rng.choice(["", '"', "'"]))
    word = lambda: str(rng.choice(words)) if words else "name"
    kind = int(rng.integers(0, 11))
    plain = [take(_HEX, int(rng.integers(16, 65))), take(_ALNUM, int(rng.integers(12, 49))), take(_ALNUM + "!#%^&*-_+", int(rng.integers(10, 30))), take(_ALNUM + "+/", int(rng.integers(24, 64))) + "="]
    web = f"eyJ{take(_ALNUM, 20)}.{take(_ALNUM, 40)}.{take(_ALNUM + '_-', 30)}"
    before, after = f"{name}{equals}{quote}", quote
    bare = rng.integers(0, 2) == 0
    if kind < 4:
        secret, bare = plain[kind], False
    elif kind == 4:
        secret = str(rng.choice(["AKIA", "ASIA"])) + take("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)
    elif kind == 5:
        secret = f"gh{rng.choice(list('pousr'))}_{take(_ALNUM, 36)}"
    elif kind == 6:
        secret = web
    elif kind == 7:
        secret, bare = f"{rng.choice(['root', 'admin', 'user', 'app', word().lower()])}:{take(_ALNUM, int(rng.integers(8, 25)))}", False
        before, after = str(rng.choice(["postgres", "mysql", "https", "redis", "amqp", "ftp"])) + "://", "@" + str(rng.choice(["db", "host", "example.com", "localhost:5432"])) + "/" + word()
    elif kind == 8:
        which, line = str(rng.choice(["", "RSA ", "EC ", "OPENSSH "])), str(rng.choice(["\n", "\n", " "]))
        body = line.join(take(_ALNUM + "+/", 64) for _ in range(int(rng.integers(1, 27))))
        secret = f"-----BEGIN {which}PRIVATE KEY-----{line}{body}={line}-----END {which}PRIVATE KEY-----"
    elif kind == 9:
        secret, bare = [take(_HEX, int(rng.integers(32, 65))), take(_ALNUM, int(rng.integers(20, 49))), plain[3], web][int(rng.integers(0, 4))], False
        before, after = str(rng.choice(["Authorization: Bearer ", "authorization: bearer ", "Bearer ", "-H 'Authorization: Bearer "])), str(rng.choice(["", "'", '"']))
    else:
        secret, bare = [take(_ALNUM, int(rng.integers(20, 49))), plain[3]][int(rng.integers(0, 2))], False
        before, after = str(rng.choice(["", "", "key ", "use ", "the key is ", "my token "])), str(rng.choice(["", " ", "."]))
    if bare:
        before, after = "", ""
    harmless = [
        (str(rng.choice(["commit ", "sha256: ", "md5=", "checksum ", "etag: "])), take(_HEX, int(rng.choice([32, 40, 64]))), ""),
        (f"{name}{equals}{quote}", str(rng.choice(["changeme", "your_token_here", "xxxxxxxxxxxx", "********", "<password>", "example-secret", "${SECRET}", "REDACTED_VALUE", "placeholder_key"])), quote),
        (str(rng.choice(["see ", "path: ", "file=", ""])), "/" + "/".join(word().lower().strip(".,") for _ in range(int(rng.integers(3, 7)))) + str(rng.choice(["", ".txt", ".html", ".py"])), ""),
        ("https://", ".".join([word().lower().strip(".,") or "a", "example", "com"]) + "/" + "/".join(word().strip(".,") for _ in range(3)), ""),
        (f"{name}{equals}", word() + word(), ""),
        ("", "_".join(word().lower().strip(".,") for _ in range(int(rng.integers(3, 6)))), "()"),
        ("", "-".join(word().strip(".,") for _ in range(int(rng.integers(4, 7)))), ""),
        ("uuid ", "-".join(take(_HEX, k) for k in (8, 4, 4, 4, 12)), ""),
        ("", str(rng.choice(["=", "-", "_", "."])) * int(rng.integers(20, 60)), ""),
        (str(rng.choice(["https://", "postgres://"])), str(rng.choice(["user:password", "username:changeme", "user:xxxxxxxx", "${USER}:${PASSWORD}", "user:your_password"])), "@example.com/"),
        ("Authorization: Bearer ", str(rng.choice(["<your_token_here>", "xxxxxxxxxxxxxxxxxxxxxxxx", "your_access_token_goes_here", "example-token-example-token"])), ""),
    ][int(rng.integers(0, 11))]
    return [(before, secret, after, 1), (*harmless, 0)]


def _harmless(before: str, value: str) -> bool:
    """Whether a string of the prose is known to be no key: words, short numbers and signs, with no word for a secret before it."""
    parts = [p for p in re.split(r"[^A-Za-z0-9]+", value) if p]
    return not _SECRET_WORD.search(before[-24:]) and all(len(set(p)) == 1 or re.fullmatch(r"[A-Z]?[a-z]{1,19}|[A-Z]{1,12}|[0-9]{1,8}", p) for p in parts)


def labelled_findings(documents: DataFrame, id_col: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(before, value, after, label) from the `train_docs` documents of the smallest hash of their id.

    Each gives one made secret, one made look-alike, and as false findings the strings of its own
    that stand in no assignment and are made of words, short numbers and signs (at most four). Other
    strings of its own may be keys and get no label.
    """
    sample = documents.where(F.col(f"`{id_col}`").isNotNull()).select(F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("h"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    chosen = documents.where(F.col(f"`{id_col}`").isNotNull()).select(F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("h")).distinct().orderBy("h").limit(train_docs)
    texts = sample.join(F.broadcast(chosen), "h")  # `train_docs` numbers

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for seed, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rng = np.random.default_rng([seed & 0xFFFFFFFF, seed >> 32 & 0xFFFFFFFF])
                spaces = [m.start() for m in re.finditer(r"[ \n]", t)]
                words = [w for w in t[:4000].split() if w.isalpha()]
                for before, value, after, label in _made(rng, words):
                    at = int(rng.choice(spaces)) if spaces else 0
                    rows.append(((t[max(0, at - AROUND) : at] + " " + before)[-AROUND:], value, after + t[at : at + AROUND], label))
                own = [(t[max(0, s - AROUND) : s], t[s:e], t[e : e + AROUND], 0) for rule, s, e in candidates(t) if rule == "long" and not re.search(r"[=:]\s*[\"']?$", t[max(0, s - 4) : s]) and _harmless(t[max(0, s - AROUND) : s], t[s:e])]
                rows += own[:4]
            yield pa.record_batch({k: pa.array([r[i] for r in rows], pa.string() if i < 3 else pa.int32()) for i, k in enumerate(("before", "value", "after", "label"))})

    return texts.mapInArrow(find, "before string, value string, after string, label int")


def train(findings: DataFrame, known: Corpus, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel | float:
    """A forest from labelled findings (rows with a null value or label are left out), ordered first so
    that a run repeats. Findings of one label alone give that label as a constant."""
    shared = findings.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("array<double>")
    def described(before, value, after):
        import pandas as pd

        return pd.Series([features(b or "", v, a or "", shared.value) for b, v, a in zip(before, value, after, strict=True)], dtype=object)

    rows = findings.where(F.col("value").isNotNull() & F.col("label").isin(0, 1)).orderBy("value", "before", "after", "label")
    seen = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(seen) < 2:
        return float(seen[0]) if seen else 1.0
    learn = rows.select(array_to_vector(described("before", "value", "after")).alias("features"), F.col("label").cast("double").alias("label")).coalesce(1)  # a bounded sample
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, subsamplingRate=0.8, featureSubsetStrategy="sqrt").fit(learn)


def scan(documents: DataFrame, known: Corpus, model: RandomForestClassificationModel | float, id_col: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """One row per candidate: id, `rule`, `start` and `length` (code points), `value`, `score` and `secret`
    (score at least `least`).

    Null and empty texts have no candidates. Rows without an id are scanned, their id is null. Repeated
    rows give repeated findings. Overlapping candidates: the first rule in the list of formats wins.
    """
    shared = documents.sparkSession.sparkContext.broadcast(known)
    kind = dict(documents.dtypes)[id_col]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows = [], []
            for k, t in enumerate(batch.column(1)):
                t = t.as_py()
                for rule, s, e in candidates(t) if t else ():
                    owner.append(k)
                    rows.append((rule, s, e - s, t[s:e], features(t[max(0, s - AROUND) : s], t[s:e], t[e : e + AROUND], shared.value)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()))
            yield pa.record_batch({"id": batch.column(0).take(pa.array(owner, pa.int64())), **{n: pa.array(list(c), t) for n, c, t in zip(("rule", "start", "length", "value", "f"), columns, kinds, strict=True)}})

    found = documents.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(find, f"id {kind}, rule string, start long, length long, value string, f array<double>")
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        scored = model.transform(found.withColumn("features", array_to_vector("f"))).withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(id_col), "rule", "start", "length", "value", "score", (F.col("score") >= least).alias("secret"))

"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 12 or more letters, digits and ``+/_-=.`` with a digit in it, or the value of an assignment to a
telling name (``token = "..."``, ``DB_PASSWORD=...``): to the closing quote if it is quoted, else to the next space, quote,
comma, semicolon or bar, or to the next parameter (``&name=``). An assigned value wins over runs that overlap it; what it
leaves of them on either side are runs of their own, and so are the sides of a sign after any other name if the value is a
candidate by itself. Each gets numbers for its length and alphabet, how usual its character transitions are, how much of it
is covered by dictionary words, whether it is part of a path, address or number, and which words stand next to it. A random forest (Spark ML) tells secrets from look-alikes such as card and phone numbers, addresses, identifiers,
versions, file names and long words.

The forest is trained from labelled findings: ``training_findings`` gives ``TRAIN_ROWS`` of them, made from a fixed seed, and
any DataFrame of (text, begin, end, label) can be used instead. Character transitions and word frequencies are counted over
all texts; the dictionary is the ``DICTIONARY`` most frequent words of 4 to 14 letters. The trained forest is a table of nodes of
fixed size; it is sent to all tasks, which look at whole texts, one batch at a time.

Edge cases: null and empty texts have no finding; a text of any length is searched whole; candidates do not
overlap; repeated rows are scanned each; an empty table gives no rows; other columns, whatever their names, are ignored here
and come back as they are from ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stored, shared_dir, stored
from .words import LOWER, blocks, words

TRAIN_ROWS = 6_000
DICTIONARY = 50_000
LEAST_COUNT = 5
WORD_LENGTHS = (4, 14)
TALLY_WORDS = 100_000
TREES, DEPTH = 40, 8
THRESHOLD = 0.5
PLACEHOLDER = "[SECRET]"

#: Names whose assigned value is looked at whatever it looks like (fixed values).
NAMES = ["access_key", "api_key", "apikey", "auth", "client_secret", "credential", "passwd", "password", "private_key", "pwd", "secret", "token"]
#: Words that speak against a secret when they stand before a value (fixed values).
PLAIN = ["call", "card", "checksum", "commit", "email", "file", "id", "isbn", "md5", "page", "phone", "sha1", "sha256", "tel", "uuid", "version"]

_value = r"[A-Za-z0-9+/_=.\-]"
_name = r"(?:" + "|".join(NAMES).replace("_", "[_-]?") + r")[\"']?\s{0,3}(?:=>|:=|[:=])\s{0,3}"
_ASSIGNED = re.compile(  # of names in a row (auth: token=...) the last one's value
    rf"(?i){_name}(?![\"'`]?[a-z0-9_\-]*{_name}[\"'`]?[^\s\"'`,;|]{{6}})"
    r"(?:([\"'`])((?:(?!\1)\S){6,})\1|[\"'`]?((?:(?!&(?:amp;)?[a-z_][\w.\-]*=)[^\s\"'`,;|]){6,}))"
)
_SIGN = re.compile(r"(?<=[A-Za-z0-9_])=(?=[A-Za-z0-9+/_])")
_RUN = re.compile(rf"{_value}{{12,}}")
_WORD = re.compile(r"[A-Za-z_]+")
_LETTERS = string.ascii_lowercase + "_"
_CODES = np.zeros(256, np.uint8)  # 0: no part of a word
for _n, _c in enumerate(_LETTERS):
    _CODES[[ord(_c), ord(_c.upper())]] = _n + 1

FEATURES = ["length", "entropy", "transitions", "dictionary", "digits", "uppers", "hex", "alphabets", "vowels", "switches", "path", "dotted", "at_sign", "digits_only", "quoted", "assigned", "named", "plain", "word_before", "known_prefix"]
SCHEMA = "doc_id long, begin int, end int, value_sha256 string, score double, is_secret boolean"


def _long_enough(text: str, a: int, b: int) -> bool:
    return b - a >= 12 and any(x.isdigit() for x in text[a:b])


def _pieces(text: str, a: int, b: int, values: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of a run after assigned values are cut out of it, without signs and points at the borders."""
    for c, d in [*values, (b, b)]:
        begin, end, strip = a, min(c, b), ".-" if c >= b else ".-="
        while begin < end and text[begin] in ".-=":
            begin += 1
        while begin < end and text[end - 1] in strip:
            end -= 1
        # whether a digit follows a place is known from the last one's: the rest of the run is looked at once, not at each sign
        digit = next((i for i in range(end - 1, begin - 1, -1) if text[i].isdigit()), -1)
        for sign in _SIGN.finditer(text, begin, end):  # any other name, if what follows is a candidate by itself
            if digit >= sign.end() <= end - 12:
                if _long_enough(text, begin, sign.start()):
                    yield begin, sign.start()
                begin = sign.end()
        if digit >= begin <= end - 12:
            yield begin, end
        a = max(a, d)


def candidates(text: str) -> list[tuple[int, int]]:
    values = []
    if "=" in text or ":" in text:
        values = [m.span(2 if m[1] else 3) for m in _ASSIGNED.finditer(text)]
    found, k = list(values), 0
    for m in _RUN.finditer(text):
        a, b = m.span()
        while k < len(values) and values[k][1] <= a:
            k += 1
        last = k
        while last < len(values) and values[last][0] < b:
            last += 1
        found += _pieces(text, a, b, values[k:last])
    return sorted(found)


@dataclass
class Language:
    """What ordinary text looks like: log-likelihood of letter pairs and frequent words."""

    pairs: dict[str, float]
    words: set[str]

    def transitions(self, value: str) -> float:
        v = value.lower()
        return sum(self.pairs.get(a + b, -14.0) for a, b in zip(v, v[1:], strict=False)) / max(len(v) - 1, 1)

    def coverage(self, value: str) -> float:
        v, i, covered = value.lower(), 0, 0
        while i < len(v):
            for k in range(min(WORD_LENGTHS[1], len(v) - i), WORD_LENGTHS[0] - 1, -1):
                if v[i : i + k] in self.words:
                    covered, i = covered + k, i + k
                    break
            else:
                i += 1
        return covered / max(len(v), 1)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter pairs (two characters) and of words; a task holds at most about ``TALLY_WORDS`` words at a time."""
    pairs, spelled, counts = np.zeros(28 * 28, np.int64), {}, Counter()
    out = lambda rows: pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["key", "n"])
    for batch in batches:
        for _, _, raw, at in blocks(batch.column(0)):
            code = _CODES[raw].astype(np.int64)
            both = np.where((code[:-1] > 0) & (code[1:] > 0), code[:-1] * 28 + code[1:], 0)
            seams = at[(at > 0) & (at < len(raw))]
            both[seams - 1] = 0  # from one text to the next
            pairs += np.bincount(both, minlength=len(pairs))
            hashes, starts, ends, _ = words(raw, at, _CODES == 0, LOWER)
            own = np.flatnonzero((ends - starts >= WORD_LENGTHS[0]) & (ends - starts <= WORD_LENGTHS[1]))
            found, first, n = np.unique(hashes[own], return_index=True, return_counts=True)
            for h, i, k in zip(found.tolist(), own[first].tolist(), n.tolist(), strict=True):
                if h not in spelled:
                    spelled[h] = raw[starts[i] : ends[i]].tobytes().decode("ascii").lower()
                counts[h] += k
            if len(spelled) > TALLY_WORDS:
                yield out([(spelled[h], k) for h, k in counts.items()])
                spelled, counts = {}, Counter()
    rows = [(_LETTERS[i // 28 - 1] + _LETTERS[i % 28 - 1], int(pairs[i])) for i in np.flatnonzero(pairs).tolist() if i]
    if rows := rows + [(spelled[h], k) for h, k in counts.items()]:
        yield out(rows)


def learn_language(spark: SparkSession, docs: DataFrame) -> Language:
    """Letter pairs and words counted over all texts; the ``DICTIONARY`` most frequent words are known (ties by spelling)."""
    kept: list[str] = []
    counted = stored(spark, docs.select("text").mapInArrow(_tally, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")), "letters", kept)
    pairs = counted.filter(F.length("key") == 2).collect()  # at most 27 * 27
    known = counted.filter((F.length("key") > 2) & (F.col("n") >= LEAST_COUNT)).orderBy(F.desc("n"), "key").limit(DICTIONARY).collect()
    drop_stored(spark, kept)
    total = sum(r["n"] for r in pairs) + 1
    return Language({r["key"]: math.log(r["n"] / total) for r in pairs}, {r["key"] for r in known} | set(NAMES) | set(PLAIN))


def describe(text: str, begin: int, end: int, known: Language) -> list[float]:
    v, before, after = text[begin:end], text[max(0, begin - 48) : begin], text[end : end + 8]
    n, counts = len(v), Counter(v)
    kinds = [sum(c.isdigit() for c in v), sum(c.isupper() for c in v), sum(c.islower() for c in v)]
    kinds.append(n - sum(kinds))
    cls = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in v]
    line = before.rsplit("\n", 1)[-1]
    near = [w.lower() for w in _WORD.findall(line)][-3:]
    named = any(w.replace("-", "_") in NAMES or any(k in w for k in ("token", "secret", "passw", "key")) for w in near)
    return [
        n, -sum(k / n * math.log2(k / n) for k in counts.values()), known.transitions(v), known.coverage(v), kinds[0] / n, kinds[1] / n,
        sum(c in "0123456789abcdefABCDEF" for c in v) / n, sum(k > 0 for k in kinds), sum(c in "aeiouAEIOU" for c in v) / n,
        sum(a != b for a, b in zip(cls, cls[1:], strict=False)) / n, v.count("/") + 2 * ("://" in line[-12:]) + before.endswith(("/", "\\")), v.count("."),
        float("@" in before[-1:] + after[:1] + v), float(kinds[0] + v.count("-") + v.count(".") == n), float(before[-1:] in "\"'`" and before[-1:] != ""),
        float(bool(re.search(r"[:=]\s{0,3}[\"'`]?$", line))), float(named), float(any(w in PLAIN for w in near)), float(len(near)),
        float(bool(re.match(r"AKIA|ASIA|gh[pousr]_|github_pat_|sk[-_]|xox[abpr]-|eyJ|glpat-|AIza|npm_|SG\.", v))),
    ]


def training_findings(rows: int = TRAIN_ROWS, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Labelled findings (text, begin, end, label), half of them secrets, from templates and a fixed seed."""
    r = random.Random(seed)
    pick = lambda alphabet, a, b: "".join(r.choice(alphabet) for _ in range(r.randint(a, b)))
    hexes, alnum, digits = "0123456789abcdef", string.ascii_letters + string.digits, string.digits
    syllables = ["the", "er", "ing", "on", "an", "re", "th", "st", "en", "ed", "tion", "ou", "ha", "le", "que", "ment", "sch", "ver", "ci", "ra"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    prose = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    secret = [
        lambda: pick(hexes, 32, 64), lambda: pick(hexes, 40, 40), lambda: pick(alnum, 20, 64), lambda: pick(alnum + "+/", 40, 40), lambda: "AKIA" + pick(string.ascii_uppercase + digits, 16, 16),
        lambda: "ghp_" + pick(alnum, 36, 36), lambda: "sk-" + pick(alnum, 32, 48), lambda: "xoxb-" + pick(digits, 11, 12) + "-" + pick(alnum, 24, 24), lambda: "eyJ" + pick(alnum + "_-", 30, 60) + "." + pick(alnum + "_-", 20, 60),
        lambda: pick(alnum + "!#$%&*", 10, 20), lambda: "AIza" + pick(alnum + "_-", 35, 35),
    ]
    bare = secret[4:9] + [secret[10]]
    plain = [
        lambda: ("", pick(digits, 12, 19)), lambda: ("", f"{pick(digits, 3, 3)}-{pick(digits, 3, 3)}-{pick(digits, 4, 6)}"), lambda: ("", ".".join(str(r.randrange(256)) for _ in range(4))),
        lambda: ("", f"{word()}.{word()}{r.randrange(100)}"), lambda: ("https://", f"www.{word()}{r.randrange(99)}.example.com/{word()}/{r.randrange(10**6)}"), lambda: ("", str(uuid.UUID(int=r.getrandbits(128)))),
        lambda: ("commit ", pick(hexes, 40, 40)), lambda: (r.choice(["md5: ", "sha256 = ", "checksum: "]), pick(hexes, 32, 64)), lambda: ("version ", ".".join(pick(digits, 1, 4) for _ in range(5))),
        lambda: ("/usr/", f"{word()}/{word()}-{r.randrange(100)}/{word()}.txt"), lambda: ("", word() + word() + str(r.randrange(10000)) + word()), lambda: ("", f"{r.randint(1990, 2030)}-0{r.randint(1, 9)}-{r.randint(10, 28)}T{r.randint(10, 23)}"),
        lambda: (r.choice(["password: ", "token = "]), r.choice(["required", "changeme", "your_password", "<password>", "xxxxxxxxxxxx", "example", "undefined", "os.environ", "config.token", "getToken()"])),
        lambda: (r.choice(["card: ", "phone = ", "id: ", "page = "]), pick(digits, 12, 17)), lambda: ("", "=" * r.randint(0, 3) + word() + "-" * r.randint(2, 9) + str(r.randrange(99)) + "-" * r.randint(4, 9)),
    ]
    out = []
    for i in range(rows):
        if i % 2:
            value = r.choice(secret)()
            name, sign, quote = r.choice(NAMES), r.choice([" = ", "=", ": ", ":", " := "]), r.choice(['"', "'", ""])
            head = f"{name}{sign}{quote}" if r.random() < 0.85 else ""
            if not head:
                value, quote = r.choice(bare)(), ""
            head = f"{prose(0, 6)} {head}"
        else:
            lead, value = r.choice(plain)()
            quote, head = r.choice(['"', "", "", ""]), f"{prose(0, 6)} {lead}"
            head += quote
        out.append((f"{head}{value}{quote} {prose(0, 6)}", len(head), len(head) + len(value), i % 2))
    return out


@dataclass
class Forest:
    """Node tables: feature (-1 in leaves), threshold, left and right child, share of secrets in leaves; one root a tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                go = x[np.arange(len(x)), np.maximum(self.feature[at], 0)] <= self.threshold[at]
                at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
            total += self.value[at]
        return total / len(self.roots)


def featured(spark: SparkSession, findings: DataFrame, known: Language) -> DataFrame:
    """(label, features) of labelled findings (text, begin, end, label)."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [describe(r["text"], r["begin"], r["end"], known) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(3).cast(pa.float64()), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])

    return findings.select("text", "begin", "end", "label").mapInArrow(features, "label double, x array<double>").select("label", array_to_vector("x").alias("features"))


def grow(spark: SparkSession, findings: DataFrame, known: Language) -> RandomForestClassificationModel:
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="sqrt").fit(featured(spark, findings, known))


def tables(spark: SparkSession, model: RandomForestClassificationModel) -> Forest:
    """The forest as node tables, read from what Spark ML writes of its model."""
    path = f"{shared_dir(spark).rstrip('/')}/changeflow-forest-{uuid.uuid4().hex}"
    model.save(path)
    forest = nodes(spark, path)
    drop_stored(spark, [path])
    return forest


def train(spark: SparkSession, docs: DataFrame, findings: DataFrame | None = None) -> tuple[Forest, Language]:
    """The forest, and the corpus statistics that its features need."""
    known = learn_language(spark, docs)
    if findings is None:
        findings = spark.createDataFrame(training_findings(), "text string, begin int, end int, label int")
    return tables(spark, grow(spark, findings, known)), known


def nodes(spark: SparkSession, path: str) -> Forest:
    rows = spark.read.parquet(f"{path}/data").selectExpr(
        "treeID", "nodeData.id as id", "nodeData.leftChild as l", "nodeData.rightChild as r", "nodeData.split.featureIndex as f", "nodeData.split.leftCategoriesOrThreshold as t", "nodeData.impurityStats as s"
    ).collect()  # at most trees * 2 ** (depth + 1)
    rows.sort(key=lambda r: (r["treeID"], r["id"]))
    place = {(r["treeID"], r["id"]): i for i, r in enumerate(rows)}
    leaf = [r["l"] < 0 for r in rows]
    return Forest(
        np.asarray([-1 if end else r["f"] for r, end in zip(rows, leaf, strict=True)]), np.asarray([0.0 if end else r["t"][0] for r, end in zip(rows, leaf, strict=True)]),
        np.asarray([0 if end else place[r["treeID"], r["l"]] for r, end in zip(rows, leaf, strict=True)]), np.asarray([0 if end else place[r["treeID"], r["r"]] for r, end in zip(rows, leaf, strict=True)]),
        np.asarray([r["s"][1] / max(sum(r["s"]), 1e-9) for r in rows]), np.asarray([i for i, r in enumerate(rows) if r["id"] == 0]),
    )


_LONG = np.zeros(256, bool)
_LONG[[ord(c) for c in string.ascii_letters + string.digits + "+/_=.-"]] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True


def suspects(column: pa.Array) -> np.ndarray:
    """Texts that may hold a candidate: a run of 12 with a digit, or an assignment. Found on bytes, a block of texts at a time."""
    hit = np.zeros(len(column), bool)
    for first_row, rows, raw, at in blocks(column):
        run = _LONG[raw]
        edge = np.flatnonzero(np.diff(run.astype(np.int8), prepend=0, append=0))
        begin, end = edge[::2], edge[1::2]
        long_ = end - begin >= 12
        begin, end = begin[long_], end[long_]
        digits = np.flatnonzero(_DIGITS[raw])
        good = np.searchsorted(digits, end) > np.searchsorted(digits, begin)
        own = hit[first_row : first_row + rows]
        first, last = np.searchsorted(at, begin[good], "right") - 1, np.searchsorted(at, end[good] - 1, "right") - 1
        own[first] = own[last] = True
        for a, b in zip(first[last > first], last[last > first], strict=True):  # a run that crosses from one text to the next marks both
            own[a : b + 1] = True
        own[np.searchsorted(at, np.flatnonzero((raw == ord("=")) | (raw == ord(":"))), "right") - 1] = True
    return hit


def _findings(batch_texts: pa.Array, forest: Forest, known: Language) -> Iterator[tuple[int, str, list[tuple[int, int]], np.ndarray]]:
    for r in np.flatnonzero(suspects(batch_texts)) if len(batch_texts) else []:
        text = batch_texts[int(r)].as_py()
        if text and (spans := candidates(text)):
            yield int(r), text, spans, forest.score(np.asarray([describe(text, a, b, known) for a, b in spans]))


def scan(spark: SparkSession, docs: DataFrame, model: tuple[Forest, Language] | None = None) -> DataFrame:
    """One row a candidate: doc_id, begin and end in code points, digest of the value, score, is_secret."""
    sent = spark.sparkContext.broadcast(model or train(spark, docs))
    kinds = pa.schema([("doc_id", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("value_sha256", pa.string()), ("score", pa.float64()), ("is_secret", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, known = sent.value
        for batch in batches:
            rows = []
            for r, text, spans, scores in _findings(batch.column(1), forest, known):
                doc_id = batch.column(0)[r].as_py()
                rows += [(doc_id, a, b, hashlib.sha256(text[a:b].encode()).hexdigest(), float(s), bool(s >= THRESHOLD)) for (a, b), s in zip(spans, scores, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, SCHEMA)


def redact(spark: SparkSession, docs: DataFrame, model: tuple[Forest, Language] | None = None) -> DataFrame:
    """The same rows with every secret in ``text`` replaced by a placeholder; other columns as they came."""
    sent = spark.sparkContext.broadcast(model or train(spark, docs))
    place = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, known = sent.value
        for batch in batches:
            changed = {}
            for r, text, spans, scores in _findings(batch.column(place), forest, known):
                parts, last = [], 0
                for (a, b), s in zip(spans, scores, strict=True):
                    if s >= THRESHOLD:
                        parts += text[last:a], PLACEHOLDER
                        last = b
                if parts:
                    changed[r] = "".join(parts) + text[last:]
            if changed:
                texts = batch.column(place).to_pylist()
                for r, text in changed.items():
                    texts[r] = text
                batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            yield batch

    return docs.mapInArrow(task, docs.schema)

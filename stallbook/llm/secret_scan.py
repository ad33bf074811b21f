"""Secret scan: candidate strings judged by a random forest that removes false positives.

Candidates are values assigned to a name that sounds like a credential, and long unbroken strings.
Names, blanks around the operator and values are read to their ends, however long; finding them
takes time linear in the text. A forest (Spark ML, fitted on labelled findings) decides on each by
its length, classes of characters and transitions between them, how usual its letter pairs are, the
share of it covered by dictionary words, its path (an assignment, a URL or e-mail around it,
slashes) and the words beside it (whether they are ordinary, and how often labelled findings beside
them were secrets). The small forest is read out as arrays and applied in place to every whole text,
so scanning needs no shuffle.

Labelled findings are a table (candidate, before, after, is_secret). ``labelled_findings`` makes one
from the candidates of all documents with checks of known key formats, at most about
``TRAIN_FINDINGS`` of each kind chosen by a hash, so rare secrets are all among them; letter pairs
and the dictionary are counted on all documents, and hold what makes up at least a fixed share of
them. ``planted_findings`` writes secrets and strings that look like secrets (digests, UUIDs,
placeholders, expressions, identifiers, paths) between words of the dictionary; their labels come from
how they were made, so the forest learns what the formats do not tell. ``trained`` fits on both.

Cases: null text has no findings; findings never overlap; with fewer than ``LEAST`` labelled findings
of a kind there is nothing to learn from, and the key formats decide instead of a forest (``trained``
always has enough); equal texts get equal findings.
"""

from __future__ import annotations

import math
import random
import re
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.frames import map_rows, sampled
from stallbook.operators.materialize import materialize

TRAIN_FINDINGS = 5_000
TRAIN_BYTES = 1 << 26
LEAST = 10
PLANTED = 2_000
DICTIONARY_SHARE = 1e-5  # so the dictionary has at most 100,000 words
PAIR_SHARE = 5e-6
BESIDE_LEAST = 20
TREES, DEPTH = 24, 6
CONTEXT = 40
MASK = "[SECRET]"
# Names that credentials are assigned to, and formats of known keys.
NAMES = r"(?:api_?key|access_?key|secret|token|passw(?:or)?d|pwd|credentials?|auth)"
KNOWN = r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}"
NAME = re.compile(NAMES, re.I)
# Possessive, and never begun inside a name, so that a search is linear in the text.
ASSIGNMENT = re.compile(r"(?<![\w.-])([\w.-]++)[\"']?\s*+(?:=>|[:=]=?)\s*+[\"']?")
VALUE = re.compile(r"[^\s\"'<>]{6}")
# A value ends before white space, a quote or a bracket; one of over LONG characters also before the next assignment in the same string.
END = re.compile(r"[\s\"'<>]")
STOP = re.compile(r"[\s\"'<>&;,?|]")
LONG = 200
LEAST_STRING = 16
STRING = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_STRING},}}(?:={{1,2}}(?![\w\"']))?")
TOKEN = re.compile(r"\w+")


@dataclass
class Usage:
    """Letter pairs and words of ordinary text, and the log odds of a secret beside a word."""

    pairs: dict[str, float] = field(default_factory=dict)
    rare: float = -9.0
    words: frozenset[str] = frozenset()
    beside: dict[str, float] = field(default_factory=dict)


def _value_at(text: str, found: re.Match) -> bool:
    """Whether the name of an assignment sounds like a credential and a value follows."""
    return bool(NAME.search(text, found.start(1), found.end(1)) and VALUE.match(text, found.end()))


def _end(text: str, at: int) -> int:
    """The end of a long value, ``at`` a place inside it."""
    for stop in STOP.finditer(text, at):
        following = ASSIGNMENT.match(text, stop.end()) if stop[0] in "&;,?|" else None
        if stop[0] not in "&;,?|" or (following and _value_at(text, following)):
            return stop.start()
    return len(text)


def assigned(text: str) -> list[tuple[int, int, int]]:
    """``(start of the name, start, end)`` of the values assigned to names that sound like a credential."""
    spans, at = [], 0
    while found := ASSIGNMENT.search(text, at):
        at = found.end()
        if _value_at(text, found):
            end = END.search(text, at, at + LONG)
            spans.append((found.start(), at, end.start() if end else _end(text, at + LONG)))
            at = spans[-1][2]
    return spans


def named(before: str) -> bool:
    """Whether ``before`` ends in an assignment to a name that sounds like a credential."""
    last = None
    for last in ASSIGNMENT.finditer(before):
        pass
    return bool(last and last.end() == len(before) and NAME.search(last[1]))


def placed(text: str | None) -> list[tuple[int, int, int]]:
    """Spans of a text that may be secrets, in order and without overlap, and where the context before each begins.

    The context is ``CONTEXT`` characters, or more where the name of an assigned value begins earlier.
    """
    if not text:
        return []
    values = assigned(text)
    out = [(a, b, min(name, max(0, a - CONTEXT))) for name, a, b in values]
    at = 0
    for m in STRING.finditer(text):
        a, b = m.span()
        while at < len(values) and values[at][2] <= a:
            at += 1
        if at < len(values):
            b = min(b, values[at][0])  # names and values are no strings of their own
        if b - a >= LEAST_STRING:
            out.append((a, b, max(0, a - CONTEXT)))
    return sorted(out)


def candidates(text: str | None) -> list[tuple[int, int]]:
    """Spans of a text that may be secrets, in order and without overlap."""
    return [(a, b) for a, b, _ in placed(text)]


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def neighbours(before: str, after: str) -> list[str]:
    """The last three words before a candidate and the first one after it."""
    return TOKEN.findall(before[-CONTEXT:].lower())[-3:] + TOKEN.findall(after[:CONTEXT].lower())[:1]


def describe(candidate: str, before: str, after: str, usage: Usage) -> list[float]:
    """Numbers that the forest decides on."""
    n = max(1, len(candidate))
    kinds = [_kind(c) for c in candidate]
    shares = [kinds.count(k) / n for k in range(4)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / n
    counts = Counter(candidate)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    low = candidate.lower()
    usual = sum(usage.pairs.get(low[i : i + 2], usage.rare) for i in range(len(low) - 1)) / max(1, n - 1)
    covered = sum(len(w) for w in re.findall(r"[^\W\d_]+", low) if w in usage.words) / n
    inside, at = 0, 0
    while at < len(low):  # greedy cover by dictionary words of four letters or more
        step = next((k for k in (12, 10, 8, 7, 6, 5, 4) if low[at : at + k] in usage.words and at + k <= len(low)), 0)
        inside += step
        at += step or 1
    beside = neighbours(before, after)
    odds = [usage.beside.get(w, 0.0) for w in beside]
    return [
        float(n), *shares, changes, entropy, len(counts) / n, usual, covered, inside / n,
        float(named(before)), float(before.rstrip(" \t\"'")[-1:] in (":", "=")), float(bool(NAME.search(candidate))), min(odds, default=0.0), max(odds, default=0.0), float("://" in before[-CONTEXT:] or "@" in before[-1:] or after[:1] == "@"),
        candidate.count("/") / n, float(candidate[:1].isupper()), sum(w in usage.words for w in beside) / 4,
    ]


def _most(counts: DataFrame, key: str, share: float) -> tuple[dict[str, int], int]:
    """The keys that make up at least ``share`` of the sum of all ``n`` (so at most 1 / share), and that sum."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r[key]: r["n"] for r in counts.where(F.col("n") >= total * share).collect()}, total


def usage_of(docs: DataFrame, text: str = "text") -> Usage:
    """Letter pairs and the most frequent words of all documents."""

    def count_words(rows: dict[str, list]) -> dict[str, list]:
        words: Counter[str] = Counter()
        for t in rows["_text"]:
            words.update(TOKEN.findall(t.lower()) if t else ())
        some = [w for w in words if len(w) > 1 and not any(map(str.isdigit, w))]
        return {"word": some, "n": [words[w] for w in some]}

    def count_pairs(rows: dict[str, list]) -> dict[str, list]:
        pairs: Counter[str] = Counter()
        for w, c in zip(rows["word"], rows["n"]):
            for i in range(len(w) - 1):
                pairs[w[i : i + 2]] += c
        return {"pair": list(pairs), "n": list(pairs.values())}

    words = map_rows(docs.select(F.col(text).alias("_text")), count_words, "word string, n bigint")
    words = materialize(words.groupBy("word").agg(F.sum("n").alias("n")), "secret-words")
    pairs = map_rows(words, count_pairs, "pair string, n bigint")
    pairs = materialize(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "secret-pairs")
    common, _ = _most(words, "word", DICTIONARY_SHARE)
    usual, total = _most(pairs, "pair", PAIR_SHARE)
    total += 1
    return Usage({p: math.log10((c + 1) / total) for p, c in usual.items()}, -math.log10(total), frozenset(common))


def known(candidate: str, before: str) -> bool:
    """Whether a candidate has the format of a key, or is an assigned value of 16 or more letters and digits that mixes both."""
    if re.fullmatch(KNOWN, candidate):
        return True
    mixed = len(candidate) >= 16 and re.search(r"\d", candidate) and re.search(r"[A-Za-z]", candidate) and re.fullmatch(r"[\w+/=.-]+", candidate)
    return bool(mixed and named(before))


def labelled_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_findings: int = TRAIN_FINDINGS) -> tuple[list[tuple[str, str, str, int]], Usage]:
    """``(candidate, before, after, is_secret)`` of a bounded sample of each kind, and the usage counted on all documents.

    The candidates of every document are labelled: known secrets by ``known``, any other is a false
    positive. About ``max_findings`` of each kind, and no more than about ``TRAIN_BYTES``, are drawn by
    a hash; a kind with fewer is taken whole.
    """

    def label(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("_id", "start", "candidate", "before", "after", "is_secret")}
        for key, t in zip(rows["_id"], rows["_text"]):
            for a, b, start in placed(t):
                c, before = t[a:b], t[start:a]
                for name, value in zip(out, (key, a, c, before, t[b : b + CONTEXT], int(known(c, before)))):
                    out[name].append(value)
        return out

    kind = dict(docs.dtypes)[doc_id]
    schema = f"_id {kind}, start int, candidate string, before string, after string, is_secret int"
    found = map_rows(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), label, schema)
    found = materialize(found, "secret-candidates")
    sizes = found.groupBy("is_secret").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("candidate") + F.octet_length("before")).alias("bytes")).collect()
    drawn: list[tuple[str, str, str, int]] = []
    for y, n, size in sorted(sizes):
        wanted = min(max_findings, max(1, n * TRAIN_BYTES // max(1, size)))
        chosen = sampled(found.where(F.col("is_secret") == y), wanted, n, "_id", "start", "candidate", "before", "after")
        drawn += sorted(tuple(r) for r in chosen.select("candidate", "before", "after", "is_secret").collect())
    return drawn, usage_of(docs, text)


def planted_findings(words: list[str], n: int = PLANTED, seed: int = 1) -> list[tuple[str, str, str, int]]:
    """``n`` secrets and ``n`` strings that only look like secrets, as labelled findings between ``words``."""
    rng = random.Random(seed)
    words = words or ["text"]
    some = lambda k, letters: "".join(rng.choice(letters) for _ in range(k))
    word = lambda: rng.choice(words)
    hexes, small, digits = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed = small + small.upper() + digits

    def name() -> str:
        head = rng.choice(["api_key", "apikey", "access_key", "secret", "client_secret", "token", "auth_token", "password", "passwd", "pwd", "credential"])
        head = "_".join([*(word() for _ in range(rng.randint(0, 2))), head, *(word() for _ in range(rng.choice([0, 0, 1])))])
        return rng.choice([str.lower, str.upper])(head)

    def assignment() -> str:
        return name() + rng.choice(["=", " = ", ": ", ' = "', ": '", '": "', "=", ":  "])

    def secret() -> tuple[str, str]:
        kind = rng.randrange(6)
        if kind == 0:
            return rng.choice(["AKIA" + some(16, small.upper() + digits), "ghp_" + some(36, mixed), "xoxb-" + some(24, digits), "AIza" + some(35, mixed)]), f"{word()} {rng.choice(['', assignment()])}"
        if kind == 1:
            return some(rng.randint(20, 64), mixed), f"{word()} {rng.choice(['key', 'secret', 'token', 'password'])} {rng.choice(['', 'is ', 'was '])}"
        value = [some(rng.choice([16, 18, 24, 32, 40, 64]), hexes), some(rng.randint(16, 64), mixed), some(rng.randint(24, 88), mixed + "+/"), some(rng.randint(8, 14), mixed + "!@#$%^*-_.")]
        return value[kind - 2], f"{word()} {assignment()}"

    def look_alike() -> tuple[str, str]:
        kind = rng.randrange(8)
        if kind == 0:
            return some(rng.choice([32, 40, 64]), hexes), f"{word()} {rng.choice(['commit', 'sha256', 'md5', 'checksum', 'revision', 'digest', 'etag'])}{rng.choice([' ', ': ', '='])}"
        if kind == 1:
            return str(uuid.UUID(int=rng.getrandbits(128), version=4)), f"{word()} {rng.choice(['id ', 'request ', 'session_id=', 'uuid: ', 'trace '])}"
        if kind == 2:
            value = rng.choice(["your_{}_here", "<{}>", "REPLACE_{}", "example_{}_12345", "my-{}-2024", "changeme_{}", "{}_placeholder1", "insert_{}"]).format(rng.choice(["api_key", "token_value", "password", word()]))
            return rng.choice([value.strip("<>"), "x" * rng.randint(8, 32), "*" * rng.randint(8, 32), "1234567890" * 2, "0" * rng.randint(16, 40)]), f"{word()} {assignment()}"
        if kind == 3:
            value = rng.choice(["${{{}}}", "os.environ[{}]", "process.env.{}", "config.get({})", "settings.{}_v2", "vault:{}/1", "self.{}()", "{{{{{}}}}}", "getenv({})"]).format(name())
            return value, f"{word()} {assignment()}"
        if kind == 4:
            return "_".join(word() for _ in range(rng.randint(3, 6)))[:80], f"{word()} {rng.choice(['', assignment()])}"
        if kind == 5:
            return "/" + "/".join(word() for _ in range(rng.randint(3, 6)))[:80], f"{word()} {rng.choice(['', 'path=', 'https://host', assignment()])}"
        if kind == 6:
            return some(rng.randint(16, 20), digits), f"{word()} {rng.choice(['', 'number ', 'id=', 'account: '])}"
        return rng.choice(["".join(word().title() for _ in range(4)), "".join(word() for _ in range(4)), word() + rng.choice(["", ",", "."])])[:80], f"{word()} {rng.choice(['', assignment()])}"

    made = [(*make(), y) for y, make in ((1, secret), (0, look_alike)) for _ in range(n)]
    return [(c, f"{word()} {before}", f"{rng.choice(['', chr(34)])} {word()} {word()}", y) for c, before, y in made]


@dataclass
class Forest:
    """Trees as arrays: feature (-1 at a leaf), threshold, left, right, share of secrets.

    Without trees ``constant`` decides, or the key formats if ``by_format``.
    """

    trees: list[tuple[np.ndarray, ...]]
    usage: Usage
    constant: float = 1.0
    by_format: bool = False

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(rows), self.constant)
        votes = np.zeros(len(rows))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                f = feature[at]
                below = rows[np.arange(len(rows)), np.maximum(f, 0)] <= threshold[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            votes += value[at]
        return votes / len(self.trees)


def _arrays(tree) -> tuple[np.ndarray, ...]:
    rows: list[list[float]] = []

    def visit(node) -> int:
        at = len(rows)
        stats = list(node.impurityStats().stats())
        rows.append([-1, 0.0, 0, 0, stats[1] / max(1e-9, sum(stats))])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][:2] = split.featureIndex(), split.threshold()
            rows[at][2] = visit(node.leftChild())
            rows[at][3] = visit(node.rightChild())
        return at

    visit(tree._call_java("rootNode"))
    columns = list(zip(*rows))
    return (*(np.array(columns[i], np.int64 if i != 1 else float) for i in range(4)), np.array(columns[4], float))


def fit(spark, findings: list[tuple[str, str, str, int]], usage: Usage) -> Forest:
    """Random forest on labelled findings (a bounded list)."""
    kinds = Counter(int(f[3]) for f in findings)
    if min(kinds[0], kinds[1]) < LEAST:
        return Forest([], usage, by_format=True)
    beside = {y: Counter(w for _, before, after, kind in findings if kind == y for w in set(neighbours(before, after))) for y in (0, 1)}
    seen = {w for w, n in (beside[0] + beside[1]).items() if n >= BESIDE_LEAST}  # rarer words would name single findings
    odds = {w: math.log((beside[1][w] + 1) / (kinds[1] + 2) / ((beside[0][w] + 1) / (kinds[0] + 2))) for w in seen}
    usage = Usage(usage.pairs, usage.rare, usage.words, odds)
    data = [(float(y), describe(c, b, a, usage)) for c, b, a, y in findings]
    frame = spark.createDataFrame(data, "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt").fit(frame)
    return Forest([_arrays(t) for t in model.trees], usage)


def trained(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Forest:
    """Forest fitted on the labelled findings of all documents and on planted ones between their words."""
    found, usage = labelled_findings(docs, doc_id, text)
    return fit(docs.sparkSession, found + planted_findings(sorted(usage.words)), usage)


def findings(texts: list[str | None], forest: Forest) -> list[list[tuple[int, int]]]:
    """Per text the spans that the forest takes for secrets."""
    spans = [placed(t) for t in texts]
    if forest.by_format:
        return [[(a, b) for a, b, start in s if known(t[a:b], t[start:a])] for t, s in zip(texts, spans)]
    rows = [describe(t[a:b], t[start:a], t[b : b + CONTEXT], forest.usage) for t, s in zip(texts, spans) for a, b, start in s]
    yes = iter((forest.predict(np.array(rows)) >= 0.5).tolist() if rows else [])
    return [[(a, b) for a, b, _ in s if next(yes)] for s in spans]


def scan(docs: DataFrame, forest: Forest, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``n_secrets``, ``spans`` (start, end in characters)."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    kind = dict(docs.dtypes)[doc_id]

    def run(rows: dict[str, list]) -> dict[str, list]:
        found = findings(rows["_text"], shared.value)
        return {"_id": rows["_id"], "n_secrets": [len(s) for s in found], "spans": [[{"start": a, "end": b} for a, b in s] for s in found]}

    out = map_rows(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), run, f"_id {kind}, n_secrets int, spans array<struct<start:int,end:int>>")
    return out.withColumnRenamed("_id", doc_id)


def redacted(docs: DataFrame, forest: Forest, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with each secret replaced by ``[SECRET]``; ``length``, if there is such a column, follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(rows: dict[str, list]) -> dict[str, list]:
        out = []
        for t, spans in zip(rows[text], findings(rows[text], shared.value)):
            for a, b in reversed(spans):
                t = t[:a] + MASK + t[b:]
            out.append(t)
        return {**rows, text: out}

    done = map_rows(docs, run, docs.schema)
    if length in docs.columns:
        done = done.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return done
